"""Lookups as of a time: each fact meets the version of its dimension row that held when it happened."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streammart.operators.latest import last_per_key
from streammart.operators.skew import hot_keys

#: A key with more rows than this, and than 1/10,000 of all, has its history cut into stretches of time.
STRETCH_ROWS = 1_000_000


def row_versions(changes: DataFrame, key: str, time: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Add ``valid_to``: when the next version of the same key begins, null for the newest.

    Of changes of a key at one time the last by ``tiebreak`` counts.  Changes without a key or a time are
    left out.
    """
    dated = changes.filter(F.col(key).isNotNull() & F.col(time).isNotNull())
    last = last_per_key(dated, [key, time], [*tiebreak]) if tiebreak else dated.dropDuplicates([key, time])
    return last.withColumn("valid_to", F.lead(time).over(Window.partitionBy(key).orderBy(time)))


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    on: tuple[str, str],
    times: tuple[str, str],
    columns: dict[str, str],
    removed: str | None = None,
    stretch_rows: int = STRETCH_ROWS,
) -> DataFrame:
    """Every fact once, with the columns of the last version of its key that began at or before its time.

    ``on`` and ``times`` name key and time of facts and of versions; (key, time) is unique among versions.
    ``columns`` maps version columns to their names in the result.  A fact before the first version, or
    without key or time, keeps nulls, and so does one whose version is marked by the boolean ``removed``.

    Facts and versions are sorted together once; no pair of a fact and a version that does not hold for it
    is ever made.  A hot key, of more than ``stretch_rows`` rows, is cut into stretches of time with about
    equally many, and a stretch starts with the last version before it.  Give stored tables: both are read
    twice.
    """
    key, fact_time = on[0], times[0]
    clash = set(columns.values()) & set(facts.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    held = F.struct(*[F.col(c).alias(n) for c, n in columns.items()])
    if removed:
        held = F.when(~F.coalesce(F.col(removed), F.lit(False)), held)
    own = [F.col(c) for c in facts.columns]
    both = facts.select(F.col(key).alias("_key"), F.col(fact_time).alias("_at"), F.lit(True).alias("_fact"), F.struct(*own).alias("_row")).unionByName(
        versions.select(F.col(on[1]).alias("_key"), F.col(times[1]).alias("_at"), F.lit(False).alias("_fact"), F.struct(held.alias("h")).alias("_version")),
        allowMissingColumns=True,
    )
    both = both.filter(F.col("_fact") | (F.col("_key").isNotNull() & F.col("_at").isNotNull()))
    placed = F.col("_key").isNotNull() & F.col("_at").isNotNull()
    lone = both.filter(~placed).select(*[F.col("_row")[c].alias(c) for c in facts.columns], *_nulls(both, columns))
    found = both.filter(placed)
    hot = hot_keys(found, ["_key"], min_rows=stretch_rows)
    # A version at a fact's own time holds for it.
    upto = [F.col("_at"), F.col("_fact")]
    last = lambda window: F.last("_version", ignorenulls=True).over(window)
    if hot:
        found = _carried(_in_stretches(found, hot), upto)
        seen = F.coalesce(last(Window.partitionBy("_key", "_stretch").orderBy(*upto)), F.col("_before"))
    else:
        seen = last(Window.partitionBy("_key").orderBy(*upto))
    joined = found.withColumn("_seen", seen).filter("_fact")
    return joined.select(
        *[F.col("_row")[c].alias(c) for c in facts.columns], *[F.col("_seen")["h"][n].alias(n) for n in columns.values()]
    ).unionByName(lone)


def _nulls(both: DataFrame, columns: dict[str, str]) -> list[Column]:
    held = both.schema["_version"].dataType["h"].dataType
    return [F.lit(None).cast(held[n].dataType).alias(n) for n in columns.values()]


def _in_stretches(rows: DataFrame, hot: list[tuple]) -> DataFrame:
    """Number the stretches of hot keys, by quantiles of their times; other keys have one.

    A key has about as many cuts as ``hot_keys`` gives it parts, so all cuts together are bounded as the
    hot keys are.
    """
    most = 1 << (max(parts for *_, parts in hot) - 1).bit_length()
    schema = T.StructType([T.StructField("_hot", rows.schema["_key"].dataType), T.StructField("_parts", T.IntegerType())])
    listed = F.broadcast(rows.sparkSession.createDataFrame(hot, schema))
    micros = F.unix_micros(F.col("_at").cast("timestamp"))
    fine = F.approx_percentile(micros, [k / most for k in range(1, most)] or [0.5], 10_000)
    cuts = rows.join(listed, F.col("_key") == F.col("_hot")).groupBy("_hot", "_parts").agg(fine.alias("_fine"))
    # Of the finest cuts, every so many-th.
    step = F.lit(most) / F.pow(F.lit(2), F.ceil(F.log2(F.col("_parts"))))
    cuts = cuts.select("_hot", F.filter("_fine", lambda c, k: (k + 1) % step == 0).alias("_cuts"))
    known = rows.join(F.broadcast(cuts), F.col("_key") == F.col("_hot"), "left")
    before = F.size(F.filter("_cuts", lambda c: c < micros))
    return known.withColumn("_stretch", F.when(F.col("_hot").isNotNull(), before).otherwise(0)).drop("_hot", "_cuts")


def _carried(rows: DataFrame, upto: list[Column]) -> DataFrame:
    """Add ``_before``: the last version of the key in an earlier stretch."""
    ends = rows.groupBy("_key", "_stretch").agg(
        F.max_by("_version", F.when(~F.col("_fact"), F.col("_at"))).alias("_own")
    )
    earlier = Window.partitionBy("_key").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(
        F.col("_key").alias("_end_key"), F.col("_stretch").alias("_end_stretch"), F.last("_own", ignorenulls=True).over(earlier).alias("_before")
    )
    match = (F.col("_key") == F.col("_end_key")) & (F.col("_stretch") == F.col("_end_stretch"))
    return rows.join(ends.hint("merge"), match).drop("_end_key", "_end_stretch")


def asof_join_batches(
    versions: Callable[..., DataFrame], write: Callable[[DataFrame, int], None], **how
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: each micro-batch of facts meets the versions known at its start.

    ``versions`` is called with the session for every batch; ``how`` is passed to :func:`asof_join`.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        write(asof_join(batch, versions(batch.sparkSession), **how), batch_id)

    return run
