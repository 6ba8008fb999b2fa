"""Helpers all operators share: stored intermediate tables and ranks without large groups."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streammart.session import shared_dir


def stored(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder (``spark.checkpoint.dir``) and read again.

    Cuts the lineage, survives lost executors, and fixes what a later step refers to.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def set_aside(df: DataFrame, names: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with those of its columns that have one of the names renamed, and how: new names by old ones.

    For operators that use such names themselves; they give the old names back at the end.
    """
    taken = set(df.columns)
    renamed = {}
    for name in names:
        if name in taken:
            fresh = f"{name}_own"
            while fresh in taken:
                fresh += "_"
            renamed[name] = fresh
    return df.withColumnsRenamed(renamed), renamed


def ranked(rows: DataFrame, group: list[str], bucket: Column, order: list[Column], name: str = "rank") -> DataFrame:
    """Add each row's rank from 0 within ``group``: by ``bucket``, then by ``order``.

    A group is never sorted in one task: rows are numbered within (group, bucket), and what stands
    in earlier buckets is added from a table of bucket sizes.  ``rows`` must be a stored table; the
    caller chooses buckets that keep both a bucket and the list of buckets small.
    Also adds ``<name>_of``, the size of the group.
    """
    inside, before = f"{name}_inside", f"{name}_before"
    rows = rows.withColumn("bucket_", bucket)
    sizes = rows.groupBy(*group, "bucket_").agg(F.count("*").alias("n_"))
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    upto = whole.orderBy("bucket_").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        *[F.col(g).alias(f"{g}_g") for g in group],
        F.col("bucket_").alias("bucket_g"),
        F.coalesce(F.sum("n_").over(upto), F.lit(0)).alias(before),
        F.sum("n_").over(whole).alias(f"{name}_of"),
    )
    numbered = rows.withColumn(inside, F.row_number().over(Window.partitionBy(*group, "bucket_").orderBy(*order)))
    same = F.col("bucket_") == F.col("bucket_g")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"{g}_g"))
    return (
        numbered.join(sizes, same)
        .withColumn(name, F.col(before) + F.col(inside) - 1)
        .drop(inside, before, "bucket_", "bucket_g", *[f"{g}_g" for g in group])
    )


def bucket_count(n: int) -> int:
    """About the square root of the rows: as many buckets as rows in one of them."""
    return max(1, int(n**0.5) // 2)
