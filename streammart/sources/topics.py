"""Named topics of text records, on Kafka or on a folder of Parquet files."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from streammart.functions.jsons import typed
from streammart.sources import files

#: Every topic read has these columns.  The last two are the record's unique
#: position, which orders records of equal time and never changes on a re-read.
#: Numbers in the text of ``src_partition`` (Kafka's partition, a folder's batch) are
#: padded, so text order is their order.
COLUMNS = ("value", "topic", "src_partition", "src_offset")


#: Bytes, as compressed, of a part of a topic's file that one task reads.  With Parquet's own 128 MB one task
#: parsed 800,000 records, however many others were free.
ROW_GROUP = 8 << 20


def checkpoint_id(spark: SparkSession) -> str:
    """What tells the running query's checkpoint from any other; batch numbers start anew with each."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""


@dataclass(frozen=True)
class Topics:
    """Where topics live.

    With ``bootstrap`` they are Kafka topics (the connector must be on the class
    path).  Otherwise ``root`` is a shared folder with one sub-folder per topic.
    """

    root: str | None = None
    bootstrap: str | None = None
    group: str = "streammart"
    starting: str = "latest"
    max_files_per_trigger: int | None = None
    checkpoints: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if bool(self.root) == bool(self.bootstrap):
            raise ValueError("give either a root folder or Kafka bootstrap servers")

    # -- reading ---------------------------------------------------------

    def read_options(self, topic: str, streaming: bool) -> dict[str, str]:
        """Source options for one topic."""
        if self.bootstrap:
            opts = {"kafka.bootstrap.servers": self.bootstrap, "subscribe": topic, **self.options}
            if streaming:
                opts.update({"startingOffsets": self.starting, "groupIdPrefix": self.group})
            return opts
        opts = {"recursiveFileLookup": "true"}
        if streaming and self.max_files_per_trigger:
            opts["maxFilesPerTrigger"] = str(self.max_files_per_trigger)
        return opts

    def read(self, spark: SparkSession, topic: str, streaming: bool = True) -> DataFrame:
        """The records of a topic, as a stream or as a batch of all of them."""
        reader = spark.readStream if streaming else spark.read
        reader = reader.options(**self.read_options(topic, streaming))
        if self.bootstrap:
            records = reader.format("kafka").load()
            return records.select(
                F.col("value").cast("string").alias("value"),
                "topic",
                F.lpad(F.col("partition").cast("string"), 10, "0").alias("src_partition"),
                F.col("offset").alias("src_offset"),
            )
        try:
            records = reader.schema("value STRING").parquet(self.folder(topic))
        except AnalysisException:
            # A job may start before the one that feeds it has written anything.
            spark.createDataFrame([], "value STRING").write.mode("append").parquet(self.folder(topic))
            records = reader.schema("value STRING").parquet(self.folder(topic))
        path = F.col("_metadata.file_path")
        batch = F.lpad(F.regexp_extract(path, r"/batch=(\d+)/", 1), 19, "0")
        return records.select(
            "value",
            F.lit(topic).alias("topic"),
            F.concat_ws("/", batch, path).alias("src_partition"),
            F.col("_metadata.row_index").alias("src_offset"),
        )

    def read_typed(self, spark: SparkSession, topic: str, schema, streaming: bool = True):
        """The records of a topic as typed columns and their position."""
        raw = self.read(spark, topic, streaming)
        return raw.select("src_partition", "src_offset", typed("value", schema).alias("_row")).select(
            "src_partition", "src_offset", "_row.*"
        )

    def view(self, spark: SparkSession, topic: str, name: str, schema, computed: dict[str, str],
             watermark: tuple[str, str] | None = None, streaming: bool = True) -> None:
        """Register a topic as a SQL view with computed columns and a watermark."""
        rows = self.read_typed(spark, topic, schema, streaming)
        rows = rows.withColumns({c: F.expr(e) for c, e in computed.items()})
        if watermark:
            rows = rows.withWatermark(*watermark)
        rows.createOrReplaceTempView(name)

    def folder(self, topic: str) -> str:
        return f"{self.root}/topic={topic}"

    # -- writing ---------------------------------------------------------

    @staticmethod
    def source(spark: SparkSession, job: str) -> str:
        """A job under the checkpoint of the streaming query that is running."""
        return f"{job}.{checkpoint_id(spark)}"

    def write(
        self, df: DataFrame, topic: str, job: str, trigger: dict | None = None
    ) -> StreamingQuery:
        """Send the ``value`` column of a stream to one topic."""
        return self.write_routed(df.select(F.lit(topic).alias("topic"), "value"), job, trigger)

    def write_routed(self, df: DataFrame, job: str, trigger: dict | None = None) -> StreamingQuery:
        """Send each record of a stream to the topic named in its ``topic`` column.

        On folders each record arrives once, also when Spark repeats a micro-batch after a failure.
        """
        records = df.select("topic", "value")
        writer = records.writeStream.queryName(job).trigger(**(trigger or {"availableNow": True}))
        writer = writer.option("checkpointLocation", self.checkpoint(df.sparkSession, job))
        if self.bootstrap:
            return (
                writer.format("kafka")
                .option("kafka.bootstrap.servers", self.bootstrap)
                .options(**self.options)
                .start()
            )
        return writer.foreachBatch(lambda rows, i: self.put(rows, self.source(rows.sparkSession, job), i)).start()

    def put(self, records: DataFrame, source: str, batch: int = 0) -> None:
        """Write one batch of (``topic``, ``value``) records, each once, however often it is repeated.

        On folders the batch is written aside and moved into each topic as a whole, so a reader sees all of
        its records of a topic or none.  A batch that was moved before stays as it is: a reader may have
        taken it.  A note of every finished batch spares writing it again.  ``source`` has to tell a
        job's checkpoint from any other, as batch numbers start anew with each.  On Kafka a repeated batch
        sends its records again.
        """
        spark = records.sparkSession
        if self.bootstrap:
            writer = records.write.format("kafka").options(**self.options)
            writer.option("kafka.bootstrap.servers", self.bootstrap).save()
            return
        name = quote(source, safe="")
        done = f"{self.root}/_done/{name}/{batch:019d}.json"
        if files.names(spark, done):
            return
        aside = f"{self.root}/_aside/{name}-{batch}-{uuid.uuid4().hex}"
        # Small batches make one file per topic; a topic with many records is split.
        dealt = records.select("topic", "value").hint("rebalance", "topic")
        dealt.write.option("parquet.block.size", ROW_GROUP).partitionBy("topic").parquet(aside)
        topics = [n for n in files.names(spark, aside) if n.startswith("topic=")]
        for topic in topics:
            self._deliver(spark, f"{aside}/{topic}", f"{self.root}/{topic}/src={name}/batch={batch}")
        files.write_once(spark, done, json.dumps({"topics": topics}))
        files.remove(spark, aside)

    @staticmethod
    def _deliver(spark: SparkSession, written: str, place: str) -> None:
        files.move(spark, written, place)

    def checkpoint(self, spark: SparkSession, job: str) -> str:
        """The job's checkpoint, which has to outlive this process: a root must be named."""
        root = self.checkpoints or spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise ValueError(f"{job}: name a checkpoint root (Topics.checkpoints or spark.checkpoint.dir)")
        return f"{root.rstrip('/')}/{'' if self.checkpoints else 'streammart/'}{job}"
