"""The warehouse's feeds and dimensions, read from the test tables.

The test tables are a TPC-H-like star schema and an event table.  Each function
gives one feed of the warehouse the columns its operators expect.  Event times
stay timestamps without zone in batch, so results do not depend on the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streammart.functions.times import time_text
from streammart.plans.order_wide import Dims
from streammart.schemas import MONEY

#: Birthdays in the user dimension count days back from here.
BIRTHDAY_BASE = "2000-01-01"


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table.  Its schema is looked up in the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _number() -> F.Column:
    return F.get_json_object("props", "$.k")


def page_log_of(events: DataFrame) -> DataFrame:
    """Every event as a page view; sign-ups and views open a visit."""
    k = _number().cast("int")
    return events.select(
        F.col("event_id"),
        F.col("user_id").cast("string").alias("mid"),
        F.when(F.col("value") >= 20, "v2").otherwise("v1").alias("vc"),
        F.col("event_type").alias("ch"),
        F.when(k < 30, "north").when(k < 60, "east").otherwise("south").alias("ar"),
        F.when(k < 50, "1").otherwise("0").alias("is_new"),
        F.when(F.col("event_type") == "click", "good_detail").otherwise("home").alias("page_id"),
        F.when(F.col("event_type").isin("signup", "view"), F.lit(None).cast("string"))
        .otherwise(F.col("event_type"))
        .alias("last_page_id"),
        _number().alias("item"),
        F.lit("sku_id").alias("item_type"),
        F.round(F.col("value") * 1000).cast("bigint").alias("during_time"),
        F.col("ts").alias("event_time"),
    )


def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_log_of(table(spark, sf_dir, "events"))


def raw_app_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as raw JSON log records with their topic position.

    Errors are start records; views display a product and an activity; half of
    the records of one type are not JSON objects with a usable time.
    """
    kind, k = F.col("event_type"), _number()
    display = F.array(
        F.struct(k.alias("item"), F.lit("sku_id").alias("item_type"), F.lit(1).alias("pos")),
        F.struct(k.alias("item"), F.lit("activity_id").alias("item_type"), F.lit(2).alias("pos")),
    )
    page = F.struct(
        F.when(kind == "click", "good_detail").otherwise("home").alias("page_id"),
        F.when(kind.isin("click", "purchase"), "home").alias("last_page_id"),
        k.alias("item"),
        F.round(F.col("value") * 1000).cast("bigint").alias("during_time"),
    )
    record = F.struct(
        F.struct(
            F.col("user_id").cast("string").alias("mid"),
            kind.alias("ch"),
            F.when(k.cast("int") < 50, "1").otherwise("0").alias("is_new"),
        ).alias("common"),
        F.when(kind != "error", page).alias("page"),
        F.when(kind == "error", F.struct(F.lit("icon").alias("entry"))).alias("start"),
        F.when(kind == "view", display).alias("displays"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
    )
    broken = F.concat(F.lit("not json "), F.col("props"))
    value = F.when((kind == "signup") & (F.col("value") < 5), broken).otherwise(F.to_json(record))
    return table(spark, sf_dir, "events").select(
        value.alias("value"), F.col("event_id").alias("src_offset")
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_of(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))


def orders_of(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Order headers; the province is the nation of the customer."""
    nations = customers.select("c_custkey", "c_nationkey")
    head = orders.join(nations, F.col("o_custkey") == F.col("c_custkey"), "left")
    created = time_text("o_orderdate")
    return head.select(
        F.col("o_orderkey").alias("id"),
        F.col("c_nationkey").cast("bigint").alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").cast(MONEY).alias("total_amount"),
        created.alias("create_time"),
        F.substring_index(created, " ", 1).alias("create_date"),
        F.substring_index(created, " ", -1).alias("create_hour"),
        F.col("o_orderdate").alias("event_time"),
    )


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return details_of(table(spark, sf_dir, "lineitem"))


def details_of(lines: DataFrame) -> DataFrame:
    """Order lines; the split amount is the line's price."""
    price = F.col("l_extendedprice").cast(MONEY)
    return lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        price.alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        price.alias("split_total_amount"),
        F.col("l_shipdate").alias("event_time"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments_of(table(spark, sf_dir, "orders"))


def payments_of(orders: DataFrame) -> DataFrame:
    """Payments of the finished orders, one day after ordering."""
    paid_at = F.col("o_orderdate") + F.expr("INTERVAL '1' DAY")
    return (
        orders.filter("o_orderstatus = 'F'")
        .select(
            F.col("o_orderkey").alias("id"),
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_totalprice").cast(MONEY).alias("total_amount"),
            F.col("o_orderpriority").alias("subject"),
            F.lit("1101").alias("payment_type"),
            time_text(paid_at).alias("create_time"),
            time_text(paid_at).alias("callback_time"),
            paid_at.alias("event_time"),
        )
    )


def refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refunds_of(table(spark, sf_dir, "lineitem"))


def refunds_of(lines: DataFrame) -> DataFrame:
    """The returned order lines."""
    return (
        lines.filter("l_returnflag = 'R'")
        .select(
            F.col("l_partkey").alias("sku_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_extendedprice").cast(MONEY).alias("refund_amount"),
            F.col("l_shipdate").alias("event_time"),
        )
    )


def product_events(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return product_events_of(table(spark, sf_dir, "events"), kind)


def product_events_of(events: DataFrame, kind: str) -> DataFrame:
    """Favourites, cart entries or comments: the events of one type."""
    k = _number()
    return (
        events.filter(F.col("event_type") == kind)
        .select(
            k.cast("bigint").alias("sku_id"),
            F.when(k.cast("int") < 50, "1203").otherwise("1201").alias("appraise"),
            F.col("ts").alias("event_time"),
        )
    )


def displays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products displayed: the item of every view."""
    pages = page_log(spark, sf_dir).filter("ch = 'view'")
    return pages.select("event_time", "item", "item_type")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as users; the balance sets the birthday, the segment the gender."""
    born = F.date_sub(F.lit(BIRTHDAY_BASE).cast("date"), F.floor(F.abs("c_acctbal")).cast("int"))
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.date_format(born, "yyyy-MM-dd").alias("birthday"),
        F.substring("c_mktsegment", 1, 1).alias("gender"),
    )


def provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as provinces, with codes made of nation and region."""
    regions = table(spark, sf_dir, "region")
    nations = table(spark, sf_dir, "nation").join(
        regions, F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    return nations.select(
        F.col("n_nationkey").cast("string").alias("id"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").cast("string").alias("area_code"),
        F.concat(F.lit("N-"), F.col("n_nationkey")).alias("iso_code"),
        F.concat(F.col("r_name"), F.lit("-"), F.col("n_nationkey")).alias("iso_3166_2"),
    )


def skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as products; size, brand number and type stand for spu, brand, category."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("sku_name"),
        F.col("p_retailprice").cast("string").alias("price"),
        F.col("p_size").cast("string").alias("spu_id"),
        F.split("p_brand", "#")[1].alias("tm_id"),
        F.length("p_type").cast("string").alias("category3_id"),
    )


def spus(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "part").select(F.col("p_size").cast("string").alias("id"))
    return sizes.distinct().withColumn("spu_name", F.concat(F.lit("size "), F.col("id")))


def trademarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = table(spark, sf_dir, "part").select(F.col("p_brand").alias("tm_name")).distinct()
    return brands.select(F.split("tm_name", "#")[1].alias("id"), "tm_name")


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type names by length; of several with one length the first by name."""
    types = table(spark, sf_dir, "part").groupBy(F.length("p_type").cast("string").alias("id"))
    return types.agg(F.min("p_type").alias("name"))


def dims(spark: SparkSession, sf_dir: str) -> Dims:
    return Dims(
        user=users(spark, sf_dir),
        province=provinces(spark, sf_dir),
        sku=skus(spark, sf_dir),
        spu=spus(spark, sf_dir),
        trademark=trademarks(spark, sf_dir),
        category3=categories(spark, sf_dir),
    )


def raw_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order and customer rows as change envelopes.

    The status of an order tells the kind of change; empty data marks the
    lowest-priority open orders.
    """
    status = F.col("o_orderstatus")
    row = F.struct(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderpriority").alias("note"),
        status.alias("status"),
    )
    no_data = (status == "P") & (F.col("o_orderpriority") == "5-LOW")
    order_changes = table(spark, sf_dir, "orders").select(
        _envelope(
            "order_info",
            F.when(status == "F", "bootstrap-insert")
            .when(status == "O", "insert")
            .otherwise("update"),
            F.when(~no_data, row),
        ),
        F.col("o_orderkey").alias("src_offset"),
    )
    person = F.struct(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    segment = F.col("c_mktsegment")
    user_changes = table(spark, sf_dir, "customer").select(
        _envelope(
            "user_info",
            F.when(segment == "BUILDING", "delete").otherwise("insert"),
            person,
        ),
        F.col("c_custkey").alias("src_offset"),
    )
    return order_changes.unionByName(user_changes)


def _envelope(name: str, kind, data) -> F.Column:
    return F.to_json(
        F.struct(
            F.lit("shop").alias("database"),
            F.lit(name).alias("table"),
            kind.alias("type"),
            data.alias("data"),
        )
    ).alias("value")


#: How page views meet the profiles of their users.
PROFILE = {
    "on": ("user_id", "user_id"),
    "times": ("ts", "ts"),
    "columns": {"ts": "since", "props": "profile"},
    "removed": "removed",
}


def profile_feeds(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Views, clicks and purchases as facts; sign-ups and errors as changes of a user's profile."""
    kind = F.col("event_type")
    facts = events.filter(kind.isin("view", "click", "purchase")).select("event_id", "user_id", "ts")
    changes = events.filter(kind.isin("signup", "error"))
    return facts, changes.select("event_id", "user_id", "ts", "props", (kind == "error").alias("removed"))


#: (source_table, operate_type, sink_type, sink_table, sink_columns, sink_pk, sink_extend)
RULE_ROWS = [
    ("order_info", "insert", "kafka", "dwd_order_info", "id,user_id,total_amount", "id", None),
    ("order_info", "update", "hbase", "dim_order_info", "id,status", None, None),
    ("user_info", "insert", "hbase", "dim_user_info", "id,name", "id", None),
]


def rules(spark: SparkSession) -> DataFrame:
    from streammart.schemas import RULES

    return spark.createDataFrame(RULE_ROWS, RULES)


def rule_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed of rule changes made of the orders: every order sets or drops the
    rule of its customer and status."""
    state = F.struct(
        F.concat(F.lit("t"), F.col("o_custkey")).alias("source_table"),
        F.col("o_orderstatus").alias("operate_type"),
        F.lit("kafka").alias("sink_type"),
        F.concat(F.lit("dwd_"), F.col("o_orderkey")).alias("sink_table"),
        F.lit("id").alias("sink_columns"),
    )
    drops = F.col("o_orderpriority") == "5-LOW"
    value = F.to_json(
        F.struct(
            F.when(drops, "d").otherwise("c").alias("op"),
            F.when(drops, state).alias("before"),
            F.when(~drops, state).alias("after"),
        )
    )
    return table(spark, sf_dir, "orders").select(
        F.lit("server.conf.table_process").alias("topic"),
        value.alias("value"),
        F.col("o_orderkey").alias("src_offset"),
    )
