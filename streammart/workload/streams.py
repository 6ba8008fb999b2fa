"""The streaming forms over the same tables, checked by the same SQL.

Each query runs a stream to its end and returns what it wrote.  A closing record,
far in the future, moves the watermark past all data so that every window and
waiting time ends; it never shows in a result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streammart.functions.times import as_stream_time
from streammart.operators.visits import daily_unique_visits
from streammart.operators.windows import union_feeds
from streammart.plans.keyword_stats import keyword_stats
from streammart.plans.order_wide import join_order_lines, join_payments
from streammart.plans.product_stats import MEASURED, measure_rows, product_measures, sources, with_product_dims
from streammart.plans.province_stats import province_stats
from streammart.plans.visitor_stats import visitor_stats
from streammart.schemas import PROVINCE_STATS
from streammart.session import ROCKSDB, shared_dir
from streammart.streaming.batches import Kept, Write, interval_join_batches, tagged, window_batches
from streammart.streaming.visits import (
    daily_unique_visits_stream,
    detect_bounces_stream,
    repair_is_new_stream,
)
from streammart.workload import roles
from streammart.workload.queries import ANY_TIME, BOUNCE, money, payment_columns

_END = "2100-01-01 00:00:00"


class Run:
    """One run's own place on the shared folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.folder = f"{shared_dir(spark)}/streammart-runs/{uuid.uuid4().hex}"
        self.count = 0

    def path(self, kind: str) -> str:
        self.count += 1
        return f"{self.folder}/{kind}-{self.count}"

    def follow(self, df: DataFrame) -> DataFrame:
        """A finished table as a stream."""
        path = self.path("table")
        df.write.parquet(path)
        return self.spark.readStream.schema(df.schema).parquet(path)

    def table(self, name: str, closing: DataFrame | None = None) -> DataFrame:
        """A test table as a stream, with a closing record."""
        schema = roles.table(self.spark, self.sf_dir, name).schema
        reader = self.spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
        rows = reader.parquet(self.sf_dir)
        if closing is None:
            return rows
        last = closing.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
        return rows.unionByName(self.follow(last))

    def closing(self, **values) -> DataFrame:
        return self.spark.range(1).select(*[F.lit(v).alias(n) for n, v in values.items()])

    def events(self, *kinds: str) -> DataFrame:
        """The events, with a closing record of each kind named."""
        last = self.closing(event_id=-1, ts=_END, user_id=-1, value=0.0, props='{"k": 0}')
        kind = F.explode(F.array(*[F.lit(k) for k in kinds or ("error",)]))
        return self.table("events", last.withColumn("event_type", kind))

    def pages(self) -> DataFrame:
        return as_stream_time(roles.page_log_of(self.events()), "event_time")

    @contextmanager
    def settings(self, waits: bool = True) -> Iterator[None]:
        """State in RocksDB, in one partition per core, written as changes and without a count of its rows,
        for which every write would read first.

        A stream that ``waits`` emits rows as the watermark passes them, and gets a micro-batch without data
        for that.  An inner join emits its pairs as rows arrive: there that batch could only empty the state.
        """
        conf = self.spark.conf
        new = {
            "spark.sql.shuffle.partitions": str(self.spark.sparkContext.defaultParallelism),
            "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
            "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
            "spark.sql.streaming.noDataMicroBatches.enabled": str(waits).lower(),
        }
        old = {name: conf.get(name, None) for name in new}
        conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        for name, value in new.items():
            conf.set(name, value)
        try:
            yield
        finally:
            for name, value in old.items():
                conf.unset(name) if value is None else conf.set(name, value)

    def finish(self, stream: DataFrame, waits: bool = True, each: Callable[[Write], Callable[[DataFrame, int], None]] | None = None) -> DataFrame:
        """Run a stream until its input is used up; what it wrote.

        ``each`` makes a ``foreachBatch`` function of the one that writes what a micro-batch gives.
        """
        spark, out = self.spark, self.path("out")

        def write(rows: DataFrame, batch_id: int) -> None:
            rows.write.mode("overwrite").parquet(f"{out}/batch-{batch_id}")

        with nullcontext() if each else self.settings(waits):
            writer = stream.writeStream.option("checkpointLocation", self.path("checkpoint")).trigger(availableNow=True)
            query = writer.foreachBatch(each(write)).start() if each else writer.format("parquet").start(out)
            query.awaitTermination()
        return spark.read.parquet(f"{out}/*") if each else spark.read.schema(stream.schema).parquet(out)

    def chained(self, stream: DataFrame, waits: bool = True, each=None) -> DataFrame:
        """What a stream writes to its end, as a stream again."""
        done = self.finish(stream, waits, each)
        folder = done.inputFiles()[0].rsplit("/", 1)[0]
        return self.spark.readStream.schema(done.schema).parquet(f"{folder.rsplit('/', 1)[0]}/*" if each else folder)


def stream_repair_is_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = Run(spark, sf_dir)
    fixed = repair_is_new_stream(run.pages(), ["event_time", "event_id"])
    return run.finish(fixed.select("event_id", "mid", "is_new")).filter("event_id >= 0")


def stream_daily_unique_visit(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = Run(spark, sf_dir)
    return run.finish(daily_unique_visits_stream(run.pages()).select("mid", "visit_date"))


def stream_bounce_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = Run(spark, sf_dir)
    pages = run.pages().select("event_id", "mid", "last_page_id", "event_time")
    return run.finish(detect_bounces_stream(pages, "event_id", BOUNCE)).select("event_id", "mid")


def stream_visitor_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages, unique visits and bounces as three streams into hourly measures."""
    run = Run(spark, sf_dir)
    found = run.finish(detect_bounces_stream(run.pages(), "event_id", BOUNCE))
    uniques = daily_unique_visits(roles.page_log(spark, sf_dir), ["event_id"])
    uniques = uniques.withColumn("event_time", F.col("event_time").cast("timestamp"))
    stats = visitor_stats(run.pages(), run.follow(uniques), run.follow(found), "1 hour")
    return run.finish(stats)


def _order_feed(run: Run) -> DataFrame:
    return run.table(
        "orders",
        run.closing(o_orderkey=-1, o_custkey=-1, o_orderstatus="F", o_totalprice=0.0,
                    o_orderdate=_END, o_orderpriority=""),
    )


def _line_feed(run: Run) -> DataFrame:
    return run.table(
        "lineitem",
        run.closing(l_orderkey=-1, l_partkey=-1, l_suppkey=-1, l_linenumber=1, l_quantity=0.0,
                    l_extendedprice=0.0, l_discount=0.0, l_tax=0.0, l_returnflag="R",
                    l_linestatus="", l_shipdate=_END),
    )


def _orders(run: Run) -> tuple[DataFrame, DataFrame]:
    """Orders and their lines as streams."""
    customers = roles.table(run.spark, run.sf_dir, "customer")
    return roles.orders_of(_order_feed(run), customers), roles.details_of(_line_feed(run))


def _joined(run: Run, one: tuple[DataFrame, str], many: tuple[DataFrame, str], join, **bounds: str) -> tuple[DataFrame, Callable]:
    """Two feeds, each with its time column, as one stream, and what makes the pairs of each of its micro-batches."""
    feeds = {"one": one, "many": many}
    at = tuple((name, time) for name, (_, time) in feeds.items())
    return tagged(feeds), lambda write: interval_join_batches(join, write, Kept(run.path("kept")), *at, **bounds)


def _wide_lines(run: Run, **bounds: str) -> tuple[DataFrame, Callable]:
    """Orders and their lines.  The stream has the rows as they come; they get their shape as they are joined."""
    customers = roles.table(run.spark, run.sf_dir, "customer")
    orders = _order_feed(run).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    lines = _line_feed(run).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate")

    def join(heads: DataFrame, details: DataFrame) -> DataFrame:
        return join_order_lines(roles.orders_of(heads, customers), roles.details_of(details), hot=[], **bounds)

    return _joined(run, (orders, "o_orderdate"), (lines, "l_shipdate"), join, **bounds)


def _paid_lines(run: Run, wide: DataFrame) -> tuple[DataFrame, Callable]:
    """Payments and the wide lines of their orders, of up to 15 days before."""
    bounds = {"lower": "-15 days", "upper": "0 seconds"}
    payments = roles.payments_of(_order_feed(run))
    join = lambda paid, lines: join_payments(paid, lines, hot=[], **bounds)
    return _joined(run, (payments, "event_time"), (wide, "event_time"), join, **bounds)


def stream_order_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The interval join of two streams."""
    run = Run(spark, sf_dir)
    stream, pairs = _wide_lines(run, **_WITHIN)
    out = run.finish(stream, each=pairs).filter("order_id >= 0")
    return out.select(
        "order_id", "detail_id", "sku_id", "sku_num", "user_id", "province_id", "order_status",
        "create_date", "create_hour",
        F.col("total_amount").cast("double").alias("total_amount"),
        F.col("split_total_amount").cast("double").alias("split_total_amount"),
    )


def stream_province_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The interval join and the windowed aggregate after it, as one stream."""
    run = Run(spark, sf_dir)
    stats = province_stats(join_order_lines(*_orders(run), **_WITHIN), "1 day", delay=None)
    out = run.finish(stats.select(*PROVINCE_STATS)).filter("stt < '2099'")
    return out.select(
        "stt", "edt", "province_id", F.col("order_amount").cast("double").alias("order_amount"),
        "order_count",
    )


_WITHIN = {"lower": "-5 days", "upper": "5 days"}


def stream_keyword_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of product names, one search per order line, joined with a static table."""
    run = Run(spark, sf_dir)
    _, lines = _orders(run)
    parts = roles.table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("full_word"))
    named = lines.join(parts, F.col("sku_id") == F.col("p_partkey"), "left")
    texts = named.select(F.coalesce("full_word", F.lit("end")).alias("full_word"), "event_time")
    return run.finish(keyword_stats(texts, size="1 day"))


def stream_payment_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments joined with the wide lines of their orders, both as streams."""
    run = Run(spark, sf_dir)
    stream, pairs = _wide_lines(run, **_WITHIN)
    stream, pairs = _paid_lines(run, run.chained(stream, each=pairs))
    return payment_columns(run.finish(stream, each=pairs).filter("order_id >= 0"))


def stream_product_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven feeds of the product statistics as streams, with their distinct orders.

    Wide orders and paid lines are written by streams of their own, as the jobs before do.
    """
    run = Run(spark, sf_dir)
    events = lambda: run.events("error", "click", "view", "signup")
    pages = lambda: as_stream_time(roles.page_log_of(events()), "event_time")
    stream, pairs = _wide_lines(run, **ANY_TIME)
    wide = run.chained(stream, each=pairs)
    stream, pairs = _paid_lines(run, wide)
    paid = run.chained(stream, each=pairs)
    feeds = sources(
        pages=pages(),
        displays=pages().filter("ch = 'view'"),
        favors=roles.product_events_of(events(), "signup"),
        carts=roles.product_events_of(events(), "view"),
        order_wide=wide,
        payment_wide=paid,
        refunds=roles.refunds_of(_line_feed(run)),
        comments=roles.product_events_of(events(), "error"),
    )
    rows = {f"feed {k}": df for k, df in enumerate(measure_rows(feeds))}
    measure = lambda ended: product_measures([(ended, {n: F.col(n) for n in MEASURED})], "1 day", micro_batch=True)
    windows = lambda write: window_batches(measure, write, Kept(run.path("kept")), rows, "1 day", "10 seconds")
    stream = union_feeds([df.withColumn("_feed", F.lit(name)) for name, df in rows.items()], None)
    stats = run.finish(stream, each=windows).filter("stt < '2099'")
    named = with_product_dims(stats, roles.dims(spark, sf_dir))
    return money(named, "sku_price", "order_amount", "payment_amount", "refund_amount")


STREAMS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_repair_is_new": stream_repair_is_new,
    "stream_daily_unique_visit": stream_daily_unique_visit,
    "stream_bounce_detect": stream_bounce_detect,
    "stream_visitor_stats": stream_visitor_stats,
    "stream_order_wide": stream_order_wide,
    "stream_province_stats": stream_province_stats,
    "stream_keyword_stats": stream_keyword_stats,
    "stream_payment_wide": stream_payment_wide,
    "stream_product_stats": stream_product_stats,
}
