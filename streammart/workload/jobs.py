"""Whole jobs over the test tables: topics, several micro-batches with a restart before each, stored tables."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streammart.operators.asof import asof_join_batches, row_versions
from streammart.operators.windows import running_agg
from streammart.operators.visits import daily_unique_visits, detect_bounces
from streammart.plans.charts import chart
from streammart.plans.keyword_stats import keyword_stats
from streammart.plans.province_stats import province_stats
from streammart.plans.visitor_stats import GROUP, MEASURES, measures
from streammart.plans.warehouse import REPORTS
from streammart.schemas import STATS
from streammart.sources.dim_table import DimTable, dim_schema, keyed_sink
from streammart.sources.tables import read_stats, write_stats
from streammart.sources.topics import Topics, checkpoint_id
from streammart.streaming.jobs import Warehouse, db_base, log_base, rules_from_feed
from streammart.workload import queries as q
from streammart.workload import roles
from streammart.workload.streams import Run

#: Micro-batches each job is fed in.
PARTS = 3


def _warehouse(run: Run, **how) -> Warehouse:
    topics = Topics(root=run.path("topics"), checkpoints=run.path("checkpoints"))
    return Warehouse(topics, run.path("stats"), run.path("dims"), trigger={"availableNow": True}, **how)


def _part(number: str, last: Column) -> Column:
    """The micro-batch of a row by its number, 0 to PARTS - 1."""
    return F.call_function("div", F.col(number) * PARTS, last + 1)


def _newest(rows: DataFrame, number: str) -> Column:
    return F.lit(rows.agg(F.max(number).alias("n")).first()["n"])


def _to_end(run: Run, query: Callable[[], object]) -> None:
    """Start a job over what its topics hold now and wait until it has read all."""
    with run.settings():
        running = query()
        running.awaitTermination()
        if running.exception():
            raise running.exception()


def job_log_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log through ``log_base``: what each topic holds by visitor and repaired flag."""
    run = Run(spark, sf_dir)
    wh = _warehouse(run)
    raw = roles.raw_app_log(spark, sf_dir)
    raw = raw.withColumn("part", _part("src_offset", _newest(raw, "src_offset")))
    for part in range(PARTS):
        wh.topics.put(raw.filter(F.col("part") == part).select(F.lit("ods_base_log").alias("topic"), "value"), "client", part)
        _to_end(run, lambda: log_base(spark, wh))
    found = None
    for topic in ("dwd_start_log", "dwd_page_log", "dwd_display_log", "ods_base_log_dirty"):
        rows = wh.topics.read(spark, topic, streaming=False)
        field = lambda name: F.get_json_object("value", f"$.common.{name}").alias(name)
        counted = rows.select("topic", field("mid"), field("is_new")).groupBy("topic", "mid", "is_new").agg(F.count(F.lit(1)).alias("n"))
        found = counted if found is None else found.unionByName(counted)
    return found


#: What the feed of rules says before each micro-batch: operation and rule, as in ``roles.RULE_ROWS``.
_RULE_CHANGES = [
    [("c", rule) for rule in roles.RULE_ROWS],
    [("u", ("order_info", "insert", "kafka", "dwd_order_new", "id,note", "id", None))],
    [("d", roles.RULE_ROWS[2]), ("c", ("user_info", "delete", "kafka", "dwd_user_gone", "id", "id", None))],
]
_RULE_FIELDS = ("source_table", "operate_type", "sink_type", "sink_table", "sink_columns", "sink_pk", "sink_extend")


def job_db_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change events through ``db_base`` while its rules change: topics and dimension tables it filled."""
    run = Run(spark, sf_dir)
    topics = Topics(root=run.path("topics"), checkpoints=run.path("checkpoints"))
    feed = "server.conf.table_process"
    wh = Warehouse(topics, run.path("stats"), run.path("dims"), rules_from_feed(topics, feed), trigger={"availableNow": True})
    raw = roles.raw_changes(spark, sf_dir).withColumn("of", F.get_json_object("value", "$.table"))
    newest = raw.groupBy("of").agg(F.max("src_offset").alias("newest")).withColumnRenamed("of", "of_")
    raw = raw.join(F.broadcast(newest), F.col("of") == F.col("of_")).withColumn("part", _part("src_offset", F.col("newest")))
    for part, said in enumerate(_RULE_CHANGES):
        told = []
        for kind, rule in said:
            state = dict(zip(_RULE_FIELDS, rule))
            told.append((feed, json.dumps({"op": kind, "ts_ms": part, "before" if kind == "d" else "after": state})))
        topics.put(spark.createDataFrame(told, "topic STRING, value STRING"), "rules", part)
        topics.put(raw.filter(F.col("part") == part).select(F.lit("ods_base_db_m").alias("topic"), "value"), "database", part)
        _to_end(run, lambda: db_base(spark, wh))
    found = None
    for topic in ("dwd_order_info", "dwd_order_new", "dwd_user_gone", "ods_base_db_unrouted"):
        rows = topics.read(spark, topic, streaming=False)
        number = F.coalesce(F.get_json_object("value", "$.id"), F.get_json_object("value", "$.data.id")).cast("bigint")
        keys = F.when(F.lit(topic.startswith("dwd")), F.array_join(F.array_sort(F.json_object_keys("value")), ","))
        counted = rows.select(F.col("topic").alias("place"), keys.alias("fields"), number.alias("id"))
        found = counted if found is None else found.unionByName(counted)
    for name, columns in (("dim_order_info", "id,status"), ("dim_user_info", "id,name")):
        rows = DimTable(f"{wh.dim_root}/{name}", dim_schema(columns)).read(spark)
        rows = rows.filter(F.col(columns.split(",")[1]).isNotNull())
        found = found.unionByName(rows.select(F.lit(name).alias("place"), F.lit(columns).alias("fields"), F.col("id").cast("bigint").alias("id")))
    return found.groupBy("place", "fields").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))


def stream_running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visitor measures so far, in update mode into a keyed table, restarted twice on the way."""
    run = Run(spark, sf_dir)
    pages = roles.page_log(spark, sf_dir)
    feeds = {
        "pages": pages,
        "uniques": daily_unique_visits(pages, ["event_id"]),
        "bounces": detect_bounces(pages, "event_id", q.BOUNCE),
    }
    newest = _newest(pages, "event_id")
    places, checkpoint = {name: run.path(name) for name in feeds}, run.path("checkpoint")
    totals = DimTable(run.path("totals"), dim_schema(",".join(["key", *GROUP, *MEASURES]), "key"))
    for part in range(PARTS):
        for name, rows in feeds.items():
            rows.filter(_part("event_id", newest) == part).write.mode("append").parquet(places[name])
        streams = [spark.readStream.schema(rows.schema).parquet(places[name]) for name, rows in feeds.items()]
        sums = running_agg(measures(*streams), GROUP, {m: F.sum(m) for m in MEASURES})

        def write(batch: DataFrame, batch_id: int) -> None:
            keyed_sink(totals, GROUP, checkpoint_id(batch.sparkSession))(batch, batch_id)

        def start(sums=sums, write=write):
            writer = sums.writeStream.outputMode("update").foreachBatch(write).trigger(availableNow=True)
            return writer.option("checkpointLocation", checkpoint).start()

        _to_end(run, start)
    return totals.read(spark).select(*GROUP, *[F.col(m).cast("bigint").alias(m) for m in MEASURES])


def stream_asof_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views as a stream meet the profiles known so far, which change between its micro-batches."""
    run = Run(spark, sf_dir)
    facts, changes = roles.profile_feeds(roles.table(spark, sf_dir, "events"))
    newest = _newest(roles.table(spark, sf_dir, "events"), "event_id")
    fact_place, change_place, out, checkpoint = (run.path(k) for k in ("facts", "profiles", "out", "checkpoint"))

    def versions(session: SparkSession) -> DataFrame:
        known = session.read.schema(changes.schema).parquet(change_place)
        return row_versions(known, "user_id", "ts", ["event_id"])

    write = asof_join_batches(
        versions, lambda rows, batch_id: rows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}"), **roles.PROFILE
    )
    for part in range(PARTS):
        changes.filter(_part("event_id", newest) == part).write.mode("append").parquet(change_place)
        facts.filter(_part("event_id", newest) == part).write.mode("append").parquet(fact_place)
        stream = spark.readStream.schema(facts.schema).parquet(fact_place)
        _to_end(run, lambda: stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    return spark.read.parquet(out).select("event_id", "user_id", "since", "profile")


# -- reports over stored statistics ------------------------------------------------

_stored: dict[tuple[str, str, str], str] = {}


def _statistics(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "product_stats":
        return q.products(spark, sf_dir)
    if name == "visitor_stats":
        return q.visitor_day(spark, sf_dir)
    if name == "province_stats":
        return province_stats(q.province_wide(spark, sf_dir), "1 day")
    words = None
    for source, texts in q.keyword_sources(spark, sf_dir).items():
        part = keyword_stats(texts, source=source, size="1 day")
        words = part if words is None else words.unionByName(part)
    return words


def stored_statistics(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The folder of a statistics table, one partition per day, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path = Run(spark, sf_dir).path(name)
        rows = _statistics(spark, sf_dir, name)
        known = set(rows.columns)
        whole = [(F.col(f.name) if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name) for f in STATS[name]]
        write_stats(rows.select(*whole), path, "error")
        _stored[key] = path
    return _stored[key]


def _report(name: str, day: int, *amounts: str, **options) -> Callable[[SparkSession, str], DataFrame]:
    table, build = REPORTS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        stats = read_stats(spark, table, stored_statistics(spark, sf_dir, table), day)
        return q.money(build(stats, day, **options), *amounts)

    run.__name__ = f"stored_report_{name}"
    run.__doc__ = f"The {name} report of a day, from that day's partition of the stored {table}."
    return run


def _chart(name: str, day: int, **options) -> Callable[[SparkSession, str], DataFrame]:
    table, build = REPORTS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        stats = read_stats(spark, table, stored_statistics(spark, sf_dir, table), day)
        return chart(name, build(stats, day, **options))

    run.__name__ = f"report_chart_{name}"
    run.__doc__ = f"The {name} report of a day, from the stored {table}, as one JSON document."
    return run


JOB_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "job_log_base": job_log_base,
    "job_db_base": job_db_base,
    "stream_running_totals": stream_running_totals,
    "stream_asof_enrich": stream_asof_enrich,
    "stored_report_gmv": _report("gmv", q.ORDER_DAY, "gmv"),
    "stored_report_trademark": _report("trademark", q.ORDER_DAY, "order_amount"),
    "stored_report_category3": _report("category3", q.ORDER_DAY, "order_amount"),
    "stored_report_spu": _report("spu", q.ORDER_DAY, "order_amount"),
    "stored_report_visitor": _report("visitor", q.VISIT_DAY, "new", "old"),
    "stored_report_hr": _report("hr", q.VISIT_DAY),
    "stored_report_province": _report("province", q.ORDER_DAY, "order_amount"),
    "stored_report_keyword": _report("keyword", q.ORDER_DAY),
    "report_chart_visitor": _chart("visitor", q.VISIT_DAY),
    "report_chart_province": _chart("province", q.ORDER_DAY),
    "report_chart_keyword": _chart("keyword", q.ORDER_DAY, plain=True),
}
