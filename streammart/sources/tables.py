"""Reading and writing tables: Parquet, JDBC, statistics tables by day, raw log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from streammart.functions.decimals import moved
from streammart.schemas import CODES, RULES, STATS
from streammart.sources import files


def jdbc_options(url: str, table: str, **more: str) -> dict[str, str]:
    """Options shared by JDBC reads and writes.

    Rows are sent in thousands.  For a large read give ``partitionColumn``,
    ``lowerBound``, ``upperBound`` and ``numPartitions`` so that it runs in many
    tasks.
    """
    return {"url": url, "dbtable": table, "batchsize": "5000", "fetchsize": "5000", **more}


def read_jdbc(spark: SparkSession, url: str, table: str, **more: str) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **more)).load()


def read_rules(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    """Routing rules from a table given as Parquet path or DataFrame, with all columns."""
    rules = spark.read.parquet(source) if isinstance(source, str) else source
    present = set(rules.columns)
    return rules.select(
        *[
            (F.col(n) if n in present else F.lit(None)).cast("string").alias(n)
            for n in RULES.fieldNames()
        ]
    )


def query(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Run SQL text over the given tables."""
    return spark.sql(sql, **tables)


def jdbc_sink(url: str, table: str, columns: Sequence[str], **more: str):
    """A ``foreachBatch`` function that appends the named columns to a JDBC table.

    Columns are bound by name, and only the named ones are sent.
    """
    opts = jdbc_options(url, table, **more)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select(*columns).write.format("jdbc").options(**opts).mode("append").save()

    return write


def write_stats(stats: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a statistics table with one partition per day of ``stt``.

    The rebalance hint gathers a day's rows into few files, and splits a day
    that is too large for one task.
    """
    by_day = stats.withColumn("dt", F.to_date(F.substring("stt", 1, 10)))
    moved(by_day, lambda rows: rows.hint("rebalance", "dt")).write.mode(mode).option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("dt").parquet(path)


def read_stats(spark: SparkSession, name: str, path: str, date: int | None = None) -> DataFrame:
    """A statistics table, which may still be empty, with its day column ``dt``.

    With a ``date`` (``yyyymmdd``) only that day's folder is listed and read, however many days there are.
    """
    schema = T.StructType([*STATS[name].fields, T.StructField("dt", T.DateType())])
    if date is None:
        return spark.read.schema(schema).parquet(path)
    text = str(date)
    day = f"{path}/dt={text[:4]}-{text[4:6]}-{text[6:]}"
    if not files.names(spark, day):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(day)


def stats_sink(path: str, columns: Sequence[str]):
    """A ``foreachBatch`` function that adds finished windows to a statistics table.

    A repeated batch replaces what it wrote before.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*columns).withColumns(
            {"dt": F.to_date(F.substring("stt", 1, 10)), "batch": F.lit(batch_id)}
        )
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "dt", "batch"
        ).parquet(path)

    return write


def ingest_lines(
    spark: SparkSession, landing: str, raw_table: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append every line that arrives in a landing folder to the raw log table.

    The table keeps the line as ``value`` and is partitioned by the day of
    arrival.
    """
    lines = spark.readStream.text(landing).withColumn("ingest_day", F.current_date())
    return (
        lines.writeStream.format("parquet")
        .option("path", raw_table)
        .option("checkpointLocation", checkpoint)
        .partitionBy("ingest_day")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def code_table(spark: SparkSession) -> DataFrame:
    """``code_group``, ``code``, ``label`` of every business code."""
    rows = [(group, code, label) for group, codes in CODES.items() for code, label in codes.items()]
    return spark.createDataFrame(rows, "code_group STRING, code STRING, label STRING")
