"""The warehouse's streaming jobs, one query with one checkpoint each."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streammart import schemas
from streammart.functions.jsons import as_value, split_dirty
from streammart.functions.times import parse_time, with_create_parts
from streammart.operators import changes as ch
from streammart.operators import logs
from streammart.plans import keyword_stats as kw
from streammart.plans import order_wide as ow
from streammart.plans import product_stats as ps
from streammart.plans.province_stats import province_stats
from streammart.plans.visitor_stats import visitor_stats
from streammart.sources.dim_table import SET_COLUMNS, dims_of_rules
from streammart.sources.tables import stats_sink
from streammart.sources.topics import Topics, checkpoint_id
from streammart.streaming.visits import (
    daily_unique_visits_stream,
    detect_bounces_stream,
    mark_newcomers,
    repair_marked,
)

POSITION = ["ts", "src_partition", "src_offset"]


@dataclass(frozen=True)
class Warehouse:
    """What the jobs share.

    ``rules`` and ``dims`` are called for every micro-batch, so each batch works
    with the rules and dimension rows of its moment.  ``sinks`` replaces the
    Parquet statistics table of a job by a ``foreachBatch`` function, such as
    ``streammart.sources.tables.jdbc_sink``.  ``own_watermarks`` gives each feed of the visitor and
    product statistics a watermark of its own (see ``streammart.operators.windows.union_feeds``).
    """

    topics: Topics
    stats_root: str
    dim_root: str
    rules: Callable[[SparkSession], DataFrame] | None = None
    dims: Callable[[SparkSession], ow.Dims] | None = None
    trigger: dict = field(default_factory=lambda: {"processingTime": "10 seconds"})
    sinks: dict[str, Callable[[DataFrame, int], None]] = field(default_factory=dict)
    own_watermarks: bool = False

    def start(self, df: DataFrame, job: str, write: Callable, mode: str = "append"):
        """Run a stream through a ``foreachBatch`` function under the job's checkpoint."""
        return (
            df.writeStream.queryName(job)
            .outputMode(mode)
            .option("checkpointLocation", self.topics.checkpoint(df.sparkSession, job))
            .trigger(**self.trigger)
            .foreachBatch(write)
            .start()
        )

    def stats(self, job: str, columns: Iterable[str]) -> Callable[[DataFrame, int], None]:
        return self.sinks.get(job) or stats_sink(f"{self.stats_root}/{job}", list(columns))


def rules_from_feed(topics: Topics, topic: str) -> Callable[[SparkSession], DataFrame]:
    """Rules as the change feed of their table leaves them (the feed is small).

    The last change is the one of the latest change time, then of the last position.
    """

    def read(spark: SparkSession) -> DataFrame:
        feed = topics.read(spark, topic, streaming=False)
        return ch.latest_rules(ch.flatten_feed(feed), ["ts_ms", "src_partition", "src_offset"])

    return read


# -- detail layer ----------------------------------------------------------------


def log_base(
    spark: SparkSession,
    wh: Warehouse,
    source: str = "ods_base_log",
    dirty_topic: str = "ods_base_log_dirty",
) -> StreamingQuery:
    """Raw log to start, page and display topics, with repaired new-visitor flags.

    Records that are not JSON, or name no visitor, go to a topic of their own.
    """
    log = mark_newcomers(logs.parse_app_log(wh.topics.read(spark, source)))

    def route(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            visitors = batch.filter("_newcomer OR NOT dirty AND mid IS NOT NULL").drop("dirty")
            aside = batch.filter("NOT _newcomer AND (dirty OR mid IS NULL)")
            records = logs.split_records(repair_marked(visitors, POSITION))
            records = records.unionByName(aside.select(F.lit(dirty_topic).alias("topic"), "value"))
            wh.topics.put(records, wh.topics.source(batch.sparkSession, "log_base"), batch_id)
        finally:
            batch.unpersist()

    return wh.start(log, "log_base", route)


def db_base(
    spark: SparkSession,
    wh: Warehouse,
    source: str = "ods_base_db_m",
    unrouted_topic: str = "ods_base_db_unrouted",
) -> StreamingQuery:
    """Change events to topics and dimension tables, as the rules say."""

    def route(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rules = wh.rules(spark)
        good, dirty = split_dirty(ch.parse_changes(batch))
        routed = ch.route_changes(ch.normalise_type(ch.with_data(good)), rules)
        routed.persist()
        try:
            deliver(spark, routed, rules, dirty, batch_id)
        finally:
            routed.unpersist()

    def deliver(spark, routed: DataFrame, rules: DataFrame, dirty: DataFrame, batch_id: int) -> None:
        to_topics, to_dims, unrouted = ch.split_routes(routed)
        outgoing = (
            to_topics.select(F.col("sink_table").alias("topic"), F.col("data").alias("value"))
            .unionByName(unrouted.select(F.lit(unrouted_topic).alias("topic"), "value"))
            .unionByName(dirty.select(F.lit(unrouted_topic).alias("topic"), "value"))
        )
        wh.topics.put(outgoing, wh.topics.source(spark, "db_base"), batch_id)
        changed = {r["sink_table"] for r in to_dims.select("sink_table").distinct().collect()}
        for name, dim in dims_of_rules(rules, wh.dim_root).items():
            dim.create(spark)
            if name not in changed:
                continue
            mine = to_dims.filter(F.col("sink_table") == name)
            mine = mine.withColumn(SET_COLUMNS.removeprefix("_"), F.json_object_keys("data"))
            rows = ch.typed_data(mine, dim.schema, keep=(*_UPSERT_ORDER, SET_COLUMNS))
            dim.upsert(rows, list(_UPSERT_ORDER), batch_id, f"db_base/{checkpoint_id(spark)}")

    return wh.start(wh.topics.read(spark, source), "db_base", route)


_UPSERT_ORDER = ("_ts", "_src_partition", "_src_offset")


# -- middle layer ----------------------------------------------------------------


def _pages(spark: SparkSession, wh: Warehouse, topic: str) -> DataFrame:
    """The usable records of a page topic; ``unique_visit`` and ``user_jump`` report the others."""
    good, _ = _pages_and_dirty(spark, wh, topic)
    return good


def _pages_and_dirty(spark: SparkSession, wh: Warehouse, topic: str) -> tuple[DataFrame, DataFrame]:
    """Records with a visitor and a time, and all others."""
    good, dirty = split_dirty(logs.parse_app_log(wh.topics.read(spark, topic)))
    usable = F.col("mid").isNotNull() & F.col("event_time").isNotNull()
    aside = dirty.select("value").unionByName(good.filter(~usable).select("value"))
    return good.filter(usable), aside


def _with_dirty(wh: Warehouse, found: DataFrame, topic: str, dirty: DataFrame, job: str):
    """Write what a job found to its topic, and what it could not read to ``<topic>_dirty``."""
    rows = found.select(F.lit(topic).alias("topic"), "value")
    return wh.topics.write_routed(
        rows.unionByName(dirty.select(F.lit(f"{topic}_dirty").alias("topic"), "value")), job, wh.trigger
    )


def unique_visit(spark: SparkSession, wh: Warehouse, source: str = "dwd_page_log"):
    """Page log to the first entry page per visitor and day; unusable records to a topic of their own."""
    pages, dirty = _pages_and_dirty(spark, wh, source)
    return _with_dirty(wh, daily_unique_visits_stream(pages), "dwm_unique_visit", dirty, "unique_visit")


def user_jump(
    spark: SparkSession, wh: Warehouse, source: str = "dwd_page_log", within: str = "10 seconds"
):
    """Page log to the entry pages that were not followed; unusable records to a topic of their own."""
    position = F.concat_ws("#", "src_partition", F.lpad(F.col("src_offset").cast("string"), 19, "0"))
    pages, dirty = _pages_and_dirty(spark, wh, source)
    pages = pages.select("mid", "last_page_id", "event_time", position.alias("position"), "value")
    found = detect_bounces_stream(pages, "position", within)
    return _with_dirty(wh, found, "dwm_user_jump_detail", dirty, "user_jump")


def order_wide(
    spark: SparkSession,
    wh: Warehouse,
    lower: str = "-5 seconds",
    upper: str = "5 seconds",
):
    """Orders and their lines to wide rows with all dimensions."""
    orders = with_create_parts(
        wh.topics.read_typed(spark, "dwd_order_info", schemas.ORDER_INFO)
    )
    details = wh.topics.read_typed(spark, "dwd_order_detail", schemas.ORDER_DETAIL)
    details = details.withColumn("event_time", parse_time("create_time"))
    joined = ow.join_order_lines(orders, details, lower, upper)

    def write(batch: DataFrame, batch_id: int) -> None:
        wide = ow.with_dimensions(batch.drop("event_time"), wh.dims(batch.sparkSession))
        _put(wh, wide, "dwm_order_wide", "order_wide", batch_id)

    return wh.start(joined, "order_wide", write)


def _put(wh: Warehouse, rows: DataFrame, topic: str, job: str, batch_id: int) -> None:
    source = wh.topics.source(rows.sparkSession, job)
    wh.topics.put(as_value(rows).withColumn("topic", F.lit(topic)), source, batch_id)


def _wide(spark: SparkSession, wh: Warehouse) -> DataFrame:
    wide = wh.topics.read_typed(spark, "dwm_order_wide", schemas.ORDER_WIDE)
    return wide.withColumn("event_time", parse_time("create_time"))


def payment_wide(
    spark: SparkSession,
    wh: Warehouse,
    lower: str = "-15 minutes",
    upper: str = "0 seconds",
):
    """Payments with the wide lines of their orders."""
    payments = wh.topics.read_typed(spark, "dwd_payment_info", schemas.PAYMENT_INFO)
    payments = payments.withColumn("event_time", parse_time("create_time"))
    paid = ow.join_payments(payments, _wide(spark, wh), lower, upper).drop("event_time")
    return wh.topics.write(as_value(paid), "dwm_payment_wide", "payment_wide", wh.trigger)


# -- statistics layer ------------------------------------------------------------


def visitor_stats_job(
    spark: SparkSession, wh: Warehouse, size: str = "2 seconds", delay: str = "30 seconds"
):
    stats = visitor_stats(
        _pages(spark, wh, "dwd_page_log"),
        _pages(spark, wh, "dwm_unique_visit"),
        _pages(spark, wh, "dwm_user_jump_detail"),
        size,
        delay,
        wh.own_watermarks,
    )
    return wh.start(stats, "visitor_stats", wh.stats("visitor_stats", schemas.VISITOR_STATS))


def product_stats_job(
    spark: SparkSession, wh: Warehouse, size: str = "2 seconds", delay: str = "10 seconds"
):
    def timed(topic: str, schema, column: str = "create_time") -> DataFrame:
        rows = wh.topics.read_typed(spark, topic, schema)
        return rows.withColumn("event_time", parse_time(column))

    pages = _pages(spark, wh, "dwd_page_log")
    measures = ps.product_measures(
        ps.sources(
            pages=pages,
            displays=logs.display_log(pages, carry=("event_time",)),
            favors=timed("dwd_favor_info", schemas.FAVOR_INFO),
            carts=timed("dwd_cart_info", schemas.CART_INFO),
            order_wide=_wide(spark, wh),
            payment_wide=timed("dwm_payment_wide", schemas.PAYMENT_WIDE, "payment_create_time"),
            refunds=timed("dwd_order_refund_info", schemas.ORDER_REFUND_INFO),
            comments=timed("dwd_comment_info", schemas.COMMENT_INFO),
        ),
        size,
        delay,
        own_watermarks=wh.own_watermarks,
    )
    sink = wh.stats("product_stats", schemas.PRODUCT_STATS)

    def write(batch: DataFrame, batch_id: int) -> None:
        sink(ps.with_product_dims(batch, wh.dims(batch.sparkSession)), batch_id)

    return wh.start(measures, "product_stats", write)


def province_stats_job(
    spark: SparkSession, wh: Warehouse, size: str = "2 seconds", delay: str = "0 seconds"
):
    stats = province_stats(_wide(spark, wh), size, delay)
    return wh.start(stats, "province_stats", wh.stats("province_stats", schemas.PROVINCE_STATS))


def keyword_stats_job(
    spark: SparkSession,
    wh: Warehouse,
    size: str = "2 seconds",
    delay: str = "2 seconds",
    dictionary: Iterable[str] = (),
):
    stats = kw.keyword_stats(
        kw.searches(_pages(spark, wh, "dwd_page_log")), size=size, delay=delay,
        dictionary=dictionary,
    )
    return wh.start(stats, "keyword_stats", wh.stats("keyword_stats", schemas.KEYWORD_STATS))


#: Jobs in the order in which their topics feed each other.
JOBS = {
    "log_base": log_base,
    "db_base": db_base,
    "unique_visit": unique_visit,
    "user_jump": user_jump,
    "order_wide": order_wide,
    "payment_wide": payment_wide,
    "visitor_stats": visitor_stats_job,
    "product_stats": product_stats_job,
    "province_stats": province_stats_job,
    "keyword_stats": keyword_stats_job,
}
