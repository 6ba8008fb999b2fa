"""The registered queries: every operator over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streammart.functions.jsons import split_dirty
from streammart.functions.text import register_word_table, words
from streammart.functions.times import time_text
from streammart.operators import changes as ch
from streammart.operators import logs, skew
from streammart.operators.asof import asof_join, row_versions
from streammart.operators.joins import enrich
from streammart.operators.latest import last_per_key
from streammart.operators.skew import hot_keys
from streammart.operators.visits import daily_unique_visits, detect_bounces, repair_is_new
from streammart.operators.windows import tumbling_agg
from streammart.plans import charts, reports
from streammart.plans.keyword_stats import keyword_stats
from streammart.plans.order_wide import (
    join_order_lines,
    join_payments,
    merge_wide,
    with_dimensions,
    with_province,
)
from streammart.plans.product_stats import (
    order_rows,
    product_measures,
    sources,
    with_product_dims,
)
from streammart.plans.province_stats import province_stats
from streammart.plans.visitor_stats import visitor_stats, visitor_totals
from streammart.session import shared_dir
from streammart.sources.dim_table import REMOVED, SET_COLUMNS, DimTable, dim_schema
from streammart.sources.tables import code_table
from streammart.workload import roles

#: Durations widened to the test data, whose rows are minutes to years apart.
BOUNCE = "6 hours"
ANY_TIME = {"lower": "-10000 days", "upper": "10000 days"}
AGE_AS_OF = "2024-06-01"
VISIT_DAY = 20240115
ORDER_DAY = 19970528

Query = Callable[[SparkSession, str], DataFrame]


def money(df: DataFrame, *columns: str) -> DataFrame:
    """Decimal columns as doubles, for comparison."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


# -- change events -----------------------------------------------------------


def _changes(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = split_dirty(ch.parse_changes(roles.raw_changes(spark, sf)))
    return ch.normalise_type(ch.with_data(good))


def _routed(spark: SparkSession, sf: str) -> DataFrame:
    return ch.route_changes(_changes(spark, sf), roles.rules(spark))


def cdc_filter_normalise(spark, sf):
    counted = _changes(spark, sf).groupBy("table", "type").agg(F.count(F.lit(1)).alias("n"))
    return counted


def cdc_route(spark, sf):
    routed = _routed(spark, sf)
    sink = F.coalesce("sink_table", F.lit("none")).alias("sink_table")
    return routed.groupBy("table", "type", sink).agg(F.count(F.lit(1)).alias("n"))


def cdc_prune_columns(spark, sf):
    to_topics, _, _ = ch.split_routes(_routed(spark, sf))
    keys = F.array_join(F.array_sort(F.json_object_keys("data")), ",")
    return to_topics.select(
        "src_offset",
        keys.alias("kept"),
        F.get_json_object("data", "$.id").cast("bigint").alias("id"),
        F.get_json_object("data", "$.total_amount").cast("double").alias("total_amount"),
    )


def cdc_to_dimension(spark, sf):
    _, to_dims, _ = ch.split_routes(_routed(spark, sf))
    return to_dims.select(
        "sink_table",
        "sink_pk",
        F.get_json_object("data", "$.id").cast("bigint").alias("id"),
        F.coalesce(
            F.get_json_object("data", "$.status"), F.get_json_object("data", "$.name")
        ).alias("detail"),
    )


def rules_latest(spark, sf):
    feed = ch.flatten_feed(roles.rule_feed(spark, sf))
    return ch.latest_rules(feed, ["src_offset"]).select(
        "source_table", "operate_type", "sink_table"
    )


def rules_flatten(spark, sf):
    feed = ch.flatten_feed(roles.rule_feed(spark, sf))
    empty = (F.to_json("data") == "{}").alias("empty")
    return feed.groupBy("database", "table", "type", empty).agg(F.count(F.lit(1)).alias("n"))


def dim_upsert_latest(spark, sf):
    events = roles.table(spark, sf, "events")
    last = last_per_key(events, ["user_id"], ["ts", "event_id"])
    return last.select("user_id", "event_id", "event_type", "value")


def dim_upsert_batches(spark, sf):
    """A user dimension after five updates by the events: sign-ups set all columns, purchases two, clicks
    and views one, errors remove the row."""
    kind = F.col("event_type")
    events = roles.table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("id"),
        "event_id",
        kind.alias("last_type"),
        F.col("value").cast("string").alias("amount"),
        "props",
        (kind == "error").alias(REMOVED),
        F.when(kind == "signup", F.array(F.lit("last_type"), F.lit("amount"), F.lit("props")))
        .when(kind == "purchase", F.array(F.lit("last_type"), F.lit("amount")))
        .otherwise(F.array(F.lit("last_type")))
        .alias(SET_COLUMNS),
    )
    dim = DimTable(f"{shared_dir(spark)}/streammart-runs/{uuid.uuid4().hex}", dim_schema("id,last_type,amount,props"), max_changes=2)
    ends = events.agg(F.min("event_id").alias("first"), F.max("event_id").alias("last")).first()
    if ends["first"] is not None:
        width = (ends["last"] - ends["first"]) // 5 + 1
        for batch in range(5):
            start = ends["first"] + batch * width
            changes = events.filter(F.col("event_id").between(start, start + width - 1))
            dim.upsert(changes, ["event_id"], batch, "events")
    rows = dim.read(spark)
    return rows.select(F.col("id").cast("bigint").alias("user_id"), "last_type", F.col("amount").cast("double").alias("amount"), "props")


def asof_enrich(spark, sf):
    """Page views with the profile their user had at that moment: sign-ups set it, errors end it."""
    facts, versions = roles.profile_feeds(roles.table(spark, sf, "events"))
    return asof_join(facts, row_versions(versions, "user_id", "ts", ["event_id"]), **roles.PROFILE).select(
        "event_id", "user_id", "since", "profile"
    )


def code_labels(spark, sf):
    """Comments with the labels of their codes, from the table of all groups of codes."""
    codes = code_table(spark)
    comments = roles.product_events(spark, sf, "error").select("appraise")
    named = comments.join(
        F.broadcast(codes.where("code_group = 'appraise'")), F.col("appraise") == F.col("code"), "left"
    )
    return named.groupBy("appraise", "label").agg(F.count(F.lit(1)).alias("n"))


# -- click log -----------------------------------------------------------------


def _log(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = split_dirty(logs.parse_app_log(roles.raw_app_log(spark, sf)))
    return good


def dirty_quarantine(spark, sf):
    _, dirty = split_dirty(logs.parse_app_log(roles.raw_app_log(spark, sf)))
    return dirty.select("src_offset", "value")


def log_split_page(spark, sf):
    return logs.page_log(_log(spark, sf)).select(
        "src_offset", "mid", "ch", "is_new", "page_id", "last_page_id", "item", "during_time"
    )


def log_split_start(spark, sf):
    return logs.start_log(_log(spark, sf)).select("src_offset", "mid", "ch", "is_new", "start")


def log_explode_display(spark, sf):
    return logs.display_log(_log(spark, sf), carry=("src_offset",)).select(
        "src_offset", "page_id", "display_no", "item", "item_type",
        F.get_json_object("value", "$.page_id").alias("own_page_id"),
        F.get_json_object("value", "$.pos").cast("bigint").alias("pos"),
    )


def log_repaired_value(spark, sf):
    """The topic records after repair: new-visitor flag and start part of each."""
    fixed = repair_is_new(_log(spark, sf), ["ts", "src_offset"])
    sent = logs.log_value(fixed)
    return (
        sent.groupBy(
            F.get_json_object("value", "$.common.mid").alias("mid"),
            F.get_json_object("value", "$.common.is_new").alias("is_new"),
        )
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count(F.get_json_object("value", "$.start.entry")).alias("starts"),
        )
    )


def repair(spark, sf):
    fixed = repair_is_new(roles.page_log(spark, sf), ["event_time", "event_id"])
    return fixed.select("event_id", "mid", "is_new")


def daily_unique(spark, sf):
    found = daily_unique_visits(roles.page_log(spark, sf), ["event_id"])
    return found.select("event_id", "mid", "visit_date")


def bounces(spark, sf):
    return _bounces(spark, sf).select("event_id", "mid")


def _bounces(spark, sf):
    return detect_bounces(roles.page_log(spark, sf), "event_id", BOUNCE)


# -- order feeds -------------------------------------------------------------


def _hot_orders(spark, sf) -> list[tuple]:
    """Hot order keys, found on the stored lines rather than on joined ones."""
    return hot_keys(roles.table(spark, sf, "lineitem"), ["l_orderkey"])


def _wide(spark, sf, hot=None, **bounds) -> DataFrame:
    hot = _hot_orders(spark, sf) if hot is None else hot
    return join_order_lines(
        roles.orders(spark, sf), roles.details(spark, sf), hot=hot, **bounds
    )


def _wide_on(spark, sf, day: int | None) -> DataFrame:
    """The wide lines of the orders of a day; of all orders without one."""
    if day is None:
        return _wide(spark, sf, **ANY_TIME)
    heads = roles.orders(spark, sf).withColumn("_window", F.window("event_time", "1 day"))
    heads = reports.on_day(heads.withColumn("stt", time_text("_window.start")), day).drop("_window", "stt")
    return join_order_lines(heads, roles.details(spark, sf), small=None, **ANY_TIME)


def order_wide_interval(spark, sf):
    wide = _wide(spark, sf, lower="-5 days", upper="5 days")
    return money(
        wide.select(
            "order_id", "detail_id", "sku_id", "sku_num", "user_id", "province_id", "order_status",
            "create_date", "create_hour", "total_amount", "split_total_amount",
        ),
        "total_amount",
        "split_total_amount",
    )


def _paid(spark, sf, hot=None, **bounds) -> DataFrame:
    hot = _hot_orders(spark, sf) if hot is None else hot
    return join_payments(
        roles.payments(spark, sf), _wide(spark, sf, hot, **bounds), lower="-15 days", hot=hot
    )


def payment_wide_interval(spark, sf):
    paid = _paid(spark, sf, lower="-5 days", upper="5 days")
    return payment_columns(paid)


def payment_wide_all(spark, sf):
    """All payments with all lines of their orders."""
    return payment_columns(_paid(spark, sf, **ANY_TIME))


def payment_columns(paid: DataFrame) -> DataFrame:
    return money(
        paid.select(
            "payment_id", "order_id", "detail_id", "sku_id", "user_id", "subject",
            "payment_create_time", "order_create_time", "total_amount", "split_total_amount",
        ),
        "total_amount",
        "split_total_amount",
    )


def _full_wide(spark, sf) -> DataFrame:
    as_of = F.lit(AGE_AS_OF).cast("timestamp")
    return with_dimensions(_wide(spark, sf, **ANY_TIME), roles.dims(spark, sf), as_of)


def order_wide_full(spark, sf):
    """Every order line with its order and all six dimensions."""
    return _full_wide(spark, sf).select(
        "order_id", "detail_id", "sku_id", "sku_name", "province_name", "province_area_code",
        "province_iso_code", "province_3166_2_code", "user_age", "user_gender", "spu_id",
        "spu_name", "tm_id", "tm_name", "category3_id", "category3_name",
        F.col("split_total_amount").cast("double").alias("split_total_amount"),
    )


def _orders_plain(spark, sf):
    return roles.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")


def enrich_user_age(spark, sf):
    from streammart.functions.times import age_years

    as_of = F.lit(AGE_AS_OF).cast("timestamp")
    users = roles.users(spark, sf).select(
        F.col("id").cast("bigint").alias("id"), age_years("birthday", as_of).alias("age"), "gender"
    )
    return enrich(
        _orders_plain(spark, sf), users, {"o_custkey": "id"},
        {"age": "user_age", "gender": "user_gender"},
    ).select("o_orderkey", "user_age", "user_gender")


def enrich_province(spark, sf):
    customers = roles.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    provinces = roles.provinces(spark, sf).withColumn("id", F.col("id").cast("int"))
    return enrich(
        customers, provinces, {"c_nationkey": "id"},
        {"name": "province_name", "area_code": "province_area_code",
         "iso_code": "province_iso_code", "iso_3166_2": "province_3166_2_code"},
    )


def enrich_sku_chain(spark, sf):
    lines = roles.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    chain = roles.dims(spark, sf).flat_sku()
    columns = ("sku_name", "spu_id", "spu_name", "tm_id", "tm_name", "category3_id",
               "category3_name")
    return enrich(lines, chain, {"l_partkey": "id"}, {c: c for c in columns})


def enrich_dim_miss(spark, sf):
    """A dimension without its small parts: their lines stay, with null names."""
    lines = roles.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    large = roles.table(spark, sf, "part").filter("p_size >= 10").select("p_partkey", "p_name")
    return enrich(lines, large, {"l_partkey": "p_partkey"}, {"p_name": "sku_name"})


def enrich_large_dim(spark, sf):
    """The same kind of lookup as a shuffle join with hot keys split."""
    lines = roles.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = roles.table(spark, sf, "part").select("p_partkey", "p_name")
    hot = hot_keys(lines, ["l_partkey"], min_rows=20)
    return enrich(
        lines, parts, {"l_partkey": "p_partkey"}, {"p_name": "sku_name"}, small=False, hot=hot
    )


def coalesce_wide_merge(spark, sf):
    """Orders merged with customers' data, first value that is not null wins."""
    left = roles.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("detail_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("order_status"),
        F.col("o_custkey").alias("user_id"),
    )
    right = roles.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("detail_id"), F.col("o_orderpriority").alias("order_status")
    )
    return merge_wide(left, right)


# -- statistics ----------------------------------------------------------------


def _visitors(spark, sf, size: str) -> DataFrame:
    pages = roles.page_log(spark, sf)
    return visitor_stats(
        pages, daily_unique_visits(pages, ["event_id"]), _bounces(spark, sf), size
    )


def visitor_stats_hour(spark, sf):
    return _visitors(spark, sf, "1 hour")


def visitor_stats_2s(spark, sf):
    return _visitors(spark, sf, "2 seconds")


def visitor_running_totals(spark, sf):
    pages = roles.page_log(spark, sf)
    return visitor_totals(pages, daily_unique_visits(pages, ["event_id"]), _bounces(spark, sf))


def _product_feeds(spark, sf):
    pages = roles.page_log(spark, sf)
    hot = _hot_orders(spark, sf)
    wide = _wide(spark, sf, hot, **ANY_TIME)
    return sources(
        pages=pages,
        displays=roles.displays(spark, sf),
        favors=roles.product_events(spark, sf, "signup"),
        carts=roles.product_events(spark, sf, "view"),
        order_wide=wide,
        payment_wide=_paid(spark, sf, hot, **ANY_TIME),
        refunds=roles.refunds(spark, sf),
        comments=roles.product_events(spark, sf, "error"),
    )


def products(spark, sf, size: str = "1 day", **options) -> DataFrame:
    """Product statistics with their dimensions.

    Where the product dimension is too large to broadcast, the statistics are made where they meet it, by sku.
    Hot skus are measured apart, combined before they move, and meet their few dimension rows by broadcast.
    """
    feeds, dims = _product_feeds(spark, sf), roles.dims(spark, sf)
    if skew.fits_broadcast(dims.flat_sku()):
        return with_product_dims(product_measures(feeds, size, **options), dims, small=True)
    hot = [sku for sku, _ in hot_keys(roles.table(spark, sf, "lineitem"), ["l_partkey"]) if sku is not None]
    of_hot = F.col("sku_id").cast("bigint").isin(hot)
    some = [(df.filter(~of_hot), own) for df, own in feeds] if hot else feeds
    found = with_product_dims(product_measures(some, size, by_sku=True, **options), dims, small=False)
    if hot:
        few = replace(dims, sku=dims.sku.filter(F.col("id").try_cast("bigint").isin(hot)))
        some = [(df.filter(of_hot), own) for df, own in feeds]
        found = found.unionByName(with_product_dims(product_measures(some, size, **options), few, small=True))
    return found


def product_stats_day(spark, sf):
    return money(
        products(spark, sf), "sku_price", "order_amount", "payment_amount", "refund_amount"
    )


def product_stats_single_row_quirk(spark, sf):
    stats = product_measures(_product_feeds(spark, sf), "1 day", single_row_zero=True)
    return stats.select("stt", "sku_id", "order_ct", "paid_order_ct", "refund_order_ct")


def province_stats_day(spark, sf):
    return money(province_stats(province_wide(spark, sf), "1 day"), "order_amount")


def province_distinct_orders(spark, sf):
    stats = province_stats(province_wide(spark, sf), "1 day", distinct_orders=True)
    return stats.select("stt", "province_id", "order_count")


def province_wide(spark, sf, day: int | None = None) -> DataFrame:
    """Order lines, of a day or all, with their province only: no other dimension is read."""
    return with_province(_wide_on(spark, sf, day), roles.provinces(spark, sf))


def _searches(spark, sf) -> DataFrame:
    """Product names as search texts, one search per order line."""
    lines = roles.table(spark, sf, "lineitem").select("l_partkey", "l_shipdate")
    parts = roles.table(spark, sf, "part").select("p_partkey", "p_name")
    named = enrich(lines, parts, {"l_partkey": "p_partkey"}, {"p_name": "full_word"})
    return named.select("full_word", F.col("l_shipdate").alias("event_time"))


def keyword_stats_day(spark, sf):
    return keyword_stats(_searches(spark, sf), size="1 day")


def keyword_table_function(spark, sf):
    """The same word split through the SQL table function, over all documents."""
    register_word_table(spark, "ik_analyze")
    docs = roles.table(spark, sf, "documents").select("lang", "text")
    return spark.sql(
        "SELECT lang, word AS keyword, count(*) AS ct "
        "FROM {docs}, LATERAL ik_analyze(text) GROUP BY lang, word",
        docs=docs,
    )


def keyword_dictionary(spark, sf):
    """Dictionary words with blanks and punctuation, through the SQL table function."""
    entries = ["cc by-nc 4.0", "apache license", "mit license", "version 3"]
    register_word_table(spark, "ik_dictionary", entries)
    docs = roles.table(spark, sf, "documents").select("lang", "text")
    found = spark.sql(
        "SELECT lang, word AS keyword, count(*) AS ct "
        "FROM {docs}, LATERAL ik_dictionary(text) GROUP BY lang, word",
        docs=docs,
    )
    return found.where(F.col("keyword").isin(entries))


#: Entries that overlap: from the left, "the apache" hides the longer entry after it.
SMART_ENTRIES = ["the apache", "apache license, version 2.0", "license, version", "the mit", "mit license", "license"]


def keyword_smart(spark, sf):
    """All words of the documents, overlapping dictionary entries chosen by the best path."""
    docs = roles.table(spark, sf, "documents").select("lang", words("text", SMART_ENTRIES, smart=True).alias("words"))
    return docs.select("lang", F.explode("words").alias("keyword")).groupBy("lang", "keyword").agg(F.count(F.lit(1)).alias("ct"))


def tumble_sql(spark, sf):
    """A tumbling aggregate written in SQL."""
    return spark.sql(
        "SELECT date_format(w.start, 'yyyy-MM-dd HH:mm:ss') AS stt, "
        "date_format(w.end, 'yyyy-MM-dd HH:mm:ss') AS edt, event_type, n FROM "
        "(SELECT window(ts, '2 hours') AS w, event_type, count(*) AS n "
        "FROM {events} GROUP BY 1, 2)",
        events=roles.table(spark, sf, "events"),
    )


# -- reports ---------------------------------------------------------------------


def report_gmv(spark, sf):
    return money(reports.gmv(_sales(spark, sf, ORDER_DAY), ORDER_DAY), "gmv")


def report_gmv_empty_day(spark, sf):
    return money(reports.gmv(_sales(spark, sf, 19000101), 19000101), "gmv")


def _sales(spark, sf, day: int) -> DataFrame:
    """The sales part of a day's product statistics: order amounts and counts."""
    sold = product_measures([order_rows(_wide_on(spark, sf, day))], "1 day")
    return with_product_dims(sold, roles.dims(spark, sf))


def report_trademark(spark, sf):
    return money(reports.by_trademark(_sales(spark, sf, ORDER_DAY), ORDER_DAY), "order_amount")


def report_category3(spark, sf):
    return money(reports.by_category3(_sales(spark, sf, ORDER_DAY), ORDER_DAY), "order_amount")


def report_spu(spark, sf):
    return money(reports.by_spu(_sales(spark, sf, ORDER_DAY), ORDER_DAY), "order_amount")


def visitor_day(spark, sf) -> DataFrame:
    return _visitors(spark, sf, "1 hour")


def report_visitor_flag(spark, sf):
    return reports.by_visitor_flag(visitor_day(spark, sf), VISIT_DAY)


def report_visitor_ratios(spark, sf):
    rated = reports.with_ratios(reports.by_visitor_flag(visitor_day(spark, sf), VISIT_DAY))
    return money(rated, "uj_rate", "dur_per_sv", "pv_per_sv")


def report_visitor_pivot(spark, sf):
    return money(reports.new_versus_old(visitor_day(spark, sf), VISIT_DAY), "new", "old")


def report_hour(spark, sf):
    return reports.by_hour(visitor_day(spark, sf), VISIT_DAY)


def report_hour_dense(spark, sf):
    return reports.all_hours(visitor_day(spark, sf), VISIT_DAY)


def report_province(spark, sf):
    stats = province_stats(province_wide(spark, sf, ORDER_DAY), "1 day")
    return money(reports.by_province(stats, ORDER_DAY), "order_amount")


def report_keyword_weighted(spark, sf):
    """Words searched for, ordered, put in carts and clicked: one source per status."""
    lines = roles.table(spark, sf, "lineitem").select("l_partkey", "l_returnflag", "l_shipdate")
    parts = roles.table(spark, sf, "part").select("p_partkey", "p_name")
    named = enrich(lines, parts, {"l_partkey": "p_partkey"}, {"p_name": "full_word"})
    stats = None
    for flag, source in (("A", "SEARCH"), ("N", "CART"), ("R", "CLICK")):
        texts = named.filter(F.col("l_returnflag") == flag).select(
            "full_word", F.col("l_shipdate").alias("event_time")
        )
        part = keyword_stats(texts, source=source, size="1 day")
        stats = part if stats is None else stats.unionByName(part)
    return reports.by_keyword(stats, ORDER_DAY)


def keyword_sources(spark, sf) -> dict[str, DataFrame]:
    """Product names as texts of all four kinds: first lines of returned orders were ordered."""
    lines = roles.table(spark, sf, "lineitem").select("l_partkey", "l_returnflag", "l_linenumber", "l_shipdate")
    parts = roles.table(spark, sf, "part").select("p_partkey", "p_name")
    named = enrich(lines, parts, {"l_partkey": "p_partkey"}, {"p_name": "full_word"})
    back, first = F.col("l_returnflag") == "R", F.col("l_linenumber") == 1
    kinds = {"SEARCH": F.col("l_returnflag") == "A", "CART": F.col("l_returnflag") == "N", "ORDER": back & first, "CLICK": back & ~first}
    return {kind: named.filter(which).select("full_word", F.col("l_shipdate").alias("event_time")) for kind, which in kinds.items()}


def report_chart_json(spark, sf):
    hours = reports.all_hours(visitor_day(spark, sf), VISIT_DAY)
    return charts.series(hours, "hr", ["uv_ct", "pv_ct", "new_uv"], [F.col("hr")])


def report_chart_trademark(spark, sf):
    return charts.chart("trademark", reports.by_trademark(_sales(spark, sf, ORDER_DAY), ORDER_DAY))


def report_chart_spu(spark, sf):
    return charts.chart("spu", reports.by_spu(_sales(spark, sf, ORDER_DAY), ORDER_DAY))


def report_chart_category3(spark, sf):
    return charts.chart("category3", reports.by_category3(_sales(spark, sf, ORDER_DAY), ORDER_DAY))


def report_chart_gmv(spark, sf):
    return charts.chart("gmv", reports.gmv(_sales(spark, sf, ORDER_DAY), ORDER_DAY))


QUERIES: dict[str, Query] = {
    "cdc_filter_normalise": cdc_filter_normalise,
    "cdc_route": cdc_route,
    "cdc_prune_columns": cdc_prune_columns,
    "cdc_to_dimension": cdc_to_dimension,
    "rules_flatten": rules_flatten,
    "rules_latest": rules_latest,
    "dim_upsert_latest": dim_upsert_latest,
    "dim_upsert_batches": dim_upsert_batches,
    "asof_enrich": asof_enrich,
    "code_labels": code_labels,
    "dirty_quarantine": dirty_quarantine,
    "log_split_page": log_split_page,
    "log_split_start": log_split_start,
    "log_explode_display": log_explode_display,
    "log_repaired_value": log_repaired_value,
    "repair_is_new": repair,
    "daily_unique_visit": daily_unique,
    "bounce_detect": bounces,
    "order_wide_interval": order_wide_interval,
    "payment_wide_interval": payment_wide_interval,
    "payment_wide_all": payment_wide_all,
    "order_wide_full": order_wide_full,
    "enrich_user_age": enrich_user_age,
    "enrich_province": enrich_province,
    "enrich_sku_chain": enrich_sku_chain,
    "enrich_dim_miss": enrich_dim_miss,
    "enrich_large_dim": enrich_large_dim,
    "coalesce_wide_merge": coalesce_wide_merge,
    "visitor_stats": visitor_stats_hour,
    "visitor_stats_2s": visitor_stats_2s,
    "visitor_running_totals": visitor_running_totals,
    "product_stats": product_stats_day,
    "product_stats_single_row_quirk": product_stats_single_row_quirk,
    "province_stats": province_stats_day,
    "province_distinct_orders": province_distinct_orders,
    "keyword_stats": keyword_stats_day,
    "keyword_table_function": keyword_table_function,
    "keyword_dictionary": keyword_dictionary,
    "keyword_smart": keyword_smart,
    "tumble_sql": tumble_sql,
    "report_gmv": report_gmv,
    "report_gmv_empty_day": report_gmv_empty_day,
    "report_trademark": report_trademark,
    "report_category3": report_category3,
    "report_spu": report_spu,
    "report_visitor_flag": report_visitor_flag,
    "report_visitor_ratios": report_visitor_ratios,
    "report_visitor_pivot": report_visitor_pivot,
    "report_hour": report_hour,
    "report_hour_dense": report_hour_dense,
    "report_province": report_province,
    "report_keyword_weighted": report_keyword_weighted,
    "report_chart_json": report_chart_json,
    "report_chart_trademark": report_chart_trademark,
    "report_chart_spu": report_chart_spu,
    "report_chart_category3": report_chart_category3,
    "report_chart_gmv": report_chart_gmv,
}
