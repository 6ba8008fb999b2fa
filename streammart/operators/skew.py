"""Joins that stay even when one key holds a large share of the rows.

The side with many rows per key is called the facts, the other side the lookup.
A lookup whose measured size is small is broadcast, so the facts do not move at
all.  Otherwise both sides are shuffled, and every hot key is split into several
parts: its facts are spread over the parts and its lookup rows are repeated once
per part, so that each pair still meets exactly once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A lookup is broadcast only when its measured content is below this.
BROADCAST_BYTES = 32 << 20

#: A key with more than this share of all facts, and more than this many rows, is
#: hot.  At most ``1 / HOT_SHARE`` keys can be, whatever the size of the data, so
#: their list may be held by the driver and broadcast.
HOT_SHARE = 1e-4
HOT_MIN_ROWS = 1_000_000

#: Rows with a null key match nothing; they are spread over this many parts.
_NULL_PARTS = 1024


def content_bytes(df: DataFrame) -> int:
    """The size of a table's content, measured by one distributed aggregate."""
    fixed = 8 * len(df.columns)
    texts = [
        F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)).cast("bigint")
        for f in df.schema.fields
        if isinstance(f.dataType, (T.StringType, T.BinaryType))
    ]
    row = F.lit(fixed).cast("bigint")
    for text in texts:
        row = row + text
    return df.agg(F.sum(row).alias("n")).first()["n"] or 0


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return content_bytes(df) <= limit


def hot_keys(
    facts: DataFrame,
    keys: Sequence[str],
    share: float = HOT_SHARE,
    min_rows: int = HOT_MIN_ROWS,
) -> list[tuple]:
    """The hot keys, each with the number of parts to split it into.

    Reads only the key columns, and combines counts before the shuffle.  A table
    of no more than ``min_rows`` rows has none, which one count settles.  A null
    key can be hot too.  Give a stored table, as the keys are read in a job of
    their own.
    """
    present = facts.select(*keys)
    total = present.count()
    if total <= min_rows:
        return []
    limit = max(total * share, min_rows)
    counts = present.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    found = counts.filter(F.col("_n") > limit).collect()
    return [(*row[:-1], math.ceil(row["_n"] / limit)) for row in found]


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: dict[str, str],
    how: str = "inner",
    condition: Column | None = None,
    small: bool | None = None,
    hot: list[tuple] | None = None,
    keep_keys: bool = False,
) -> DataFrame:
    """Join ``facts`` to ``lookup`` on ``{fact column: lookup column}``.

    The result has the fact columns, then the lookup columns other than its
    keys, then with ``keep_keys`` the lookup's keys; rows lie by these after a
    shuffle join, which spares shuffles by the same key that follow.
    ``condition`` may name columns of both.  ``small`` skips measuring the
    lookup.  ``hot`` skips the search for hot keys: a list as :func:`hot_keys`
    gives, its keys in the order of ``on``; an empty one when there are none.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"lookup_join does not support {how!r}")
    columns = facts.columns
    renamed = {column: f"_key_{i}" for i, column in enumerate(on.values())}
    keys = set(on.values())
    extra = [c for c in lookup.columns if c not in keys]
    kept = {name: column for column, name in renamed.items()} if keep_keys else {}
    clash = set([*extra, *kept.values()]) & set(columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    right = lookup.withColumnsRenamed(renamed)
    match = condition
    for i, column in enumerate(on):
        same = F.col(column) == F.col(f"_key_{i}")
        match = same if match is None else match & same

    if small is None:
        small = fits_broadcast(right)
    if small:
        return facts.join(F.broadcast(right), match, how).select(*columns, *extra, *kept).withColumnsRenamed(kept)
    if hot is None:
        hot = [] if facts.isStreaming else hot_keys(facts, list(on))
    if hot:
        flags = _flags(facts, list(on), hot)
        facts = _spread(facts, list(on), flags)
        right = _repeat(right, list(renamed.values()), flags)
        match = match & (F.col("_part") == F.col("_part_of"))
    if not facts.isStreaming:
        # Compressed files look smaller than they are: keep the optimizer from
        # broadcasting either side on such an estimate.  A merge join spills.
        right = right.hint("merge")
    return facts.join(right, match, how).select(*columns, *extra, *kept).withColumnsRenamed(kept)


def _flags(facts: DataFrame, keys: list[str], hot: list[tuple]) -> DataFrame:
    """The hot keys as a table; at most ``1 / HOT_SHARE`` rows."""
    kinds = facts.select(*keys).schema.fields
    fields = [T.StructField(f"_hot_{i}", f.dataType) for i, f in enumerate(kinds)]
    schema = T.StructType([*fields, T.StructField("_parts", T.IntegerType())])
    return F.broadcast(facts.sparkSession.createDataFrame(hot, schema))


def _is_hot(keys: list[str]) -> Column:
    match = F.lit(True)
    for i, key in enumerate(keys):
        match = match & (F.col(key) == F.col(f"_hot_{i}"))
    return match


def _spread(facts: DataFrame, keys: list[str], flags: DataFrame) -> DataFrame:
    """Give every fact the part it goes to.

    The part depends on the row and on the input partition it is read from, so
    equal copies of a row are spread too, and a task run again after a lost
    executor places every row as before.
    """
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    hashable = [
        f.name
        for f in facts.schema.fields
        if not isinstance(f.dataType, (T.VariantType, T.MapType, T.ArrayType, T.StructType))
    ]
    place = F.abs(F.xxhash64(*hashable) % 1_000_000_007) + F.spark_partition_id()
    parts = F.when(missing, F.lit(_NULL_PARTS)).otherwise(F.coalesce("_parts", F.lit(1)))
    return facts.join(flags, _is_hot(keys), "left").withColumn(
        "_part", F.pmod(place, parts).cast("int")
    ).drop(*flags.columns)


def _repeat(lookup: DataFrame, keys: list[str], flags: DataFrame) -> DataFrame:
    """Repeat the lookup rows of every hot key once per part."""
    last = F.coalesce("_parts", F.lit(1)) - 1
    return lookup.join(flags, _is_hot(keys), "left").withColumn(
        "_part_of", F.explode(F.sequence(F.lit(0), last))
    ).drop(*flags.columns)
