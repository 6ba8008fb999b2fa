"""Product measures by sku from seven feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streammart.functions.decimals import moved
from streammart.functions.times import as_stream_time, time_text
from streammart.operators.joins import enrich
from streammart.operators.windows import tumbling_agg, union_feeds
from streammart.plans.order_wide import Dims
from streammart.schemas import APPRAISE_GOOD, MONEY_SUM, PRODUCT_STATS

COUNTS = ["display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num", "comment_ct",
          "good_comment_ct"]
AMOUNTS = ["order_amount", "payment_amount", "refund_amount"]
#: distinct count -> the id it counts
DISTINCT = {"order_ct": "order_id", "paid_order_ct": "paid_order_id",
            "refund_order_ct": "refund_order_id"}
#: What every row of every feed carries besides time and sku, as :func:`measure_rows` gives them.
MEASURED = [*COUNTS, *AMOUNTS, *DISTINCT.values()]


def page_rows(pages: DataFrame, displays: DataFrame) -> list[tuple[DataFrame, dict]]:
    """Clicks on a product page and displays of a product."""
    clicks = pages.filter("page_id = 'good_detail'").withColumn("sku_id", _sku("item"))
    shown = displays.filter("item_type = 'sku_id'").withColumn("sku_id", _sku("item"))
    return [(clicks, {"click_ct": F.lit(1)}), (shown, {"display_ct": F.lit(1)})]


def sources(
    pages: DataFrame,
    displays: DataFrame,
    favors: DataFrame,
    carts: DataFrame,
    order_wide: DataFrame,
    payment_wide: DataFrame,
    refunds: DataFrame,
    comments: DataFrame,
    amount: str = "total_amount",
) -> list[tuple[DataFrame, dict[str, Column]]]:
    """Every feed with the measures its rows contribute.

    Each feed has ``sku_id`` and ``event_time``; ``displays`` must carry the page
    time.  The order amount adds the whole order's total once per line unless
    ``amount`` names another column.
    """
    good = F.when(F.col("appraise") == APPRAISE_GOOD, 1).otherwise(0)
    return [
        *page_rows(pages, displays),
        (favors, {"favor_ct": F.lit(1)}),
        (carts, {"cart_ct": F.lit(1)}),
        order_rows(order_wide, amount),
        (
            payment_wide,
            {"payment_amount": F.col("split_total_amount"), "paid_order_id": F.col("order_id")},
        ),
        (
            refunds,
            {"refund_amount": F.col("refund_amount"), "refund_order_id": F.col("order_id")},
        ),
        (comments, {"comment_ct": F.lit(1), "good_comment_ct": good}),
    ]


def order_rows(order_wide: DataFrame, amount: str = "total_amount") -> tuple[DataFrame, dict]:
    """Amount, number and order of every line sold."""
    return (
        order_wide,
        {
            "order_amount": F.col(amount),
            "order_sku_num": F.col("sku_num"),
            "order_id": F.col("order_id"),
        },
    )


def measure_rows(feeds: list[tuple[DataFrame, dict[str, Column]]]) -> list[DataFrame]:
    """The rows of every feed with a sku, all with the same columns: what they do not measure is 0."""
    rows = []
    for df, own in feeds:
        value = lambda m, kind: own.get(m, F.lit(0)).cast(kind).alias(m)
        rows.append(
            as_stream_time(df, "event_time").filter(F.col("sku_id").isNotNull()).select(
                "event_time",
                F.col("sku_id").cast("bigint").alias("sku_id"),
                *[value(m, "bigint") for m in COUNTS],
                *[value(m, "decimal(16,2)") for m in AMOUNTS],
                *[own.get(i, F.lit(None)).cast("bigint").alias(i) for i in DISTINCT.values()],
            )
        )
    return rows


def product_measures(
    feeds: list[tuple[DataFrame, dict[str, Column]]],
    size: str = "2 seconds",
    delay: str = "10 seconds",
    single_row_zero: bool = False,
    own_watermarks: bool = False,
    micro_batch: bool = False,
    by_sku: bool = False,
) -> DataFrame:
    """Sums and distinct order counts by sku and window.

    ``single_row_zero`` gives 0 as the distinct counts of a window that holds one
    row only.  Rows without a sku are left out.  ``own_watermarks`` is that of ``union_feeds``.  ``micro_batch`` is
    for tables that hold windows of a stream: like the stream, they sum what is null only to null.  With ``by_sku`` the
    rows of a table lie by sku, so that a join by sku need not move them again: for skus none of which is hot.
    """
    if micro_batch or any(df.isStreaming for df, _ in feeds):
        return _stream_measures(feeds, size, delay, single_row_zero, own_watermarks)
    return _batch_measures(feeds, size, single_row_zero, by_sku)


def _batch_measures(feeds, size: str, single_row_zero: bool, by_sku: bool = False) -> DataFrame:
    """One aggregate over the union of all feeds, with orders reduced beforehand.

    A feed with order ids is first reduced to one row per sku, window and order,
    which then counts 1.  That makes the distinct counts plain sums, and it
    spreads a hot sku by its orders; an aggregate with three distinct columns
    would multiply its input rows instead.  Rows travel with the start of their window only.
    """
    union = None
    for df, own in feeds:
        rows = df.filter(F.col("sku_id").isNotNull()).select(
            F.window("event_time", size)["start"].alias("_start"),
            F.col("sku_id").cast("bigint").alias("sku_id"),
            *[c.alias(n) for n, c in own.items()],
        )
        counted = {m: i for m, i in DISTINCT.items() if i in own}
        if counted:
            sums = [F.sum(n).alias(n) for n in own if n not in counted.values()]
            rows = rows.groupBy("_start", "sku_id", *counted.values()).agg(
                F.count(F.lit(1)).alias("_rows"), *sums
            )
            present = {m: F.col(i).isNotNull().cast("bigint") for m, i in counted.items()}
            rows = rows.withColumns(present).drop(*counted.values())
        elif by_sku:
            rows = rows.groupBy("_start", "sku_id").agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(n).alias(n) for n in own])
        else:
            rows = rows.withColumn("_rows", F.lit(1).cast("bigint"))
        union = rows if union is None else union.unionByName(rows, allowMissingColumns=True)
    kinds = dict.fromkeys([*COUNTS, *DISTINCT], "bigint") | dict.fromkeys(AMOUNTS, MONEY_SUM)
    present = set(union.columns)
    sums = [
        (F.coalesce(F.sum(m), F.lit(0)) if m in present else F.lit(0)).cast(kind).alias(m)
        for m, kind in kinds.items()
    ]
    if by_sku:
        union = moved(union, lambda rows: rows.repartition("sku_id"))
    out = union.groupBy("_start", "sku_id").agg(F.sum("_rows").alias("_rows"), *sums)
    return _finish(
        out.withColumn("_window", F.window("_start", size)).select(
            time_text("_window.start").alias("stt"),
            time_text("_window.end").alias("edt"),
            "sku_id",
            "_rows",
            *kinds,
        ),
        single_row_zero,
    )


def _stream_measures(feeds, size: str, delay: str, single_row_zero: bool, own_watermarks: bool) -> DataFrame:
    """Two windowed aggregates in a chain over the union of all feeds.

    The first keeps one row per window, sku and order, and one for all rows without an order; the second
    adds them up, an order counting 1.  Streams allow no distinct aggregate, and a set of ids in the state
    of a sku would grow with its orders; here no row of state grows, and all go as their window ends.
    """
    ids, rows = list(DISTINCT.values()), measure_rows(feeds)
    sums = {m: F.sum(m) for m in COUNTS} | {m: F.sum(m).cast(MONEY_SUM) for m in AMOUNTS}
    once = union_feeds(rows, delay, own_watermarks).groupBy(F.window("event_time", size).alias("_window"), "sku_id", *ids).agg(
        F.count(F.lit(1)).alias("_rows"), *[c.alias(m) for m, c in sums.items()]
    )
    counted = once.select(
        F.window_time("_window").alias("event_time"), "sku_id", "_rows", *sums,
        *[F.col(i).isNotNull().cast("bigint").alias(m) for m, i in DISTINCT.items()],
    )
    aggs = {"_rows": F.sum("_rows"), **sums, **{m: F.sum(m) for m in DISTINCT}}
    return _finish(tumbling_agg(counted, ["sku_id"], aggs, size), single_row_zero)


def _finish(df: DataFrame, single_row_zero: bool) -> DataFrame:
    if single_row_zero:
        df = df.withColumns(
            {m: F.when(F.col("_rows") == 1, 0).otherwise(F.col(m)).cast("bigint") for m in DISTINCT}
        )
    return df.drop("_rows")


def with_product_dims(stats: DataFrame, dims: Dims, small: bool | None = None) -> DataFrame:
    """Add product names and keys to the aggregated rows (few compared to the feeds).

    A sku has one row per window, so no sku is hot: looking for hot ones would compute the statistics again.
    """
    columns = ("sku_name", "sku_price", "spu_id", "spu_name", "tm_id", "tm_name", "category3_id",
               "category3_name")
    out = enrich(
        stats, dims.flat_sku(), {"sku_id": "id"}, {c: c for c in columns}, small=small, hot=[]
    )
    return out.select(*PRODUCT_STATS)


def _sku(column: str) -> Column:
    return F.col(column).try_cast("bigint")
