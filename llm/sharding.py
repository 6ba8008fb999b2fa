"""Shards that all match the mixture of sources, by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.tables import bucket_count, ranked, stored, table


def _unit(hex_digits: Column) -> Column:
    """The first eight hexadecimal digits as a number from 0 up to, not including, 1."""
    return F.conv(F.substring(hex_digits, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def interleave(rows: DataFrame, source: str, shuffle_key: Column, shards: int = 8, seed: int = 1) -> DataFrame:
    """Add ``shard`` (0 to ``shards`` - 1) and ``slot`` (from 0, gapless in its shard).

    Rows of each source are put into a seeded random order; the row of rank r of n gets the fraction
    (r + offset of the source) / n; rows are sorted by fraction and cut into equal runs.  Row counts of
    shards differ by one at most, and a source's rows in a shard by about one from its share.

    ``rows`` must be a stored table.  Nulls in the source are a source of their own.  Rows with equal
    shuffle keys (repeated rows) are exchangeable.  An empty table gives an empty result; existing
    columns named ``shard`` or ``slot`` are replaced.
    """
    total = rows.count()
    buckets = bucket_count(total)
    names = [c for c in rows.columns if c not in ("shard", "slot")]
    own = [F.col(c) for c in names]
    wide = rows.select(
        F.struct(*own).alias("row_"),
        F.col(source).alias("stratum_"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), shuffle_key)).alias("shuffled_"),
    )
    ties = [F.col("shuffled_"), F.to_json("row_")]
    in_source = ranked(wide, ["stratum_"], (_unit(F.col("shuffled_")) * buckets).cast("int"), ties)
    # Sources with few rows would all meet in the middle; an offset of their own spreads them.
    offset = _unit(F.md5(F.concat_ws(":", F.lit(f"offset{seed}"), F.coalesce("stratum_", F.lit("")))))
    fractions = stored(in_source.withColumn("fraction_", (F.col("rank") + offset) / F.col("rank_of")).drop("rank", "rank_of"))
    along = ranked(
        fractions,
        [],
        F.least((F.col("fraction_") * buckets).cast("int"), F.lit(buckets - 1)),
        [F.col("fraction_"), F.col("stratum_"), *ties],
        "position_",
    )
    start = F.ceil(F.col("shard") * F.lit(total) / F.lit(shards)).cast("long")
    return along.withColumn("shard", F.expr(f"int(position_ * {shards} div {max(total, 1)})")).select(
        *[F.col("row_")[c].alias(c) for c in names], "shard", (F.col("position_") - start).alias("slot")
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 under the law ``rows``."""
    text = F.coalesce("text", F.lit(""))
    narrow = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
    )
    placed = interleave(stored(narrow), "source", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source"
    )
