"""Day reports over the statistics tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streammart.functions.ratios import bounce_rate, pages_per_visit, seconds_per_visit
from streammart.functions.times import today_number
from streammart.schemas import KEYWORD_WEIGHTS, MONEY_SUM


def on_day(stats: DataFrame, date: int | None = None) -> DataFrame:
    """The rows of one day (``yyyymmdd``, today by default).

    Compares the stored text with constants, so the filter reaches the scan; on a
    table partitioned by ``dt`` it selects the partition.
    """
    day = dt.datetime.strptime(str(date or today_number()), "%Y%m%d").date()
    first, after = day.isoformat(), (day + dt.timedelta(days=1)).isoformat()
    rows = stats.filter((F.col("stt") >= first) & (F.col("stt") < after))
    return rows.filter(F.col("dt") == F.lit(day)) if "dt" in stats.columns else rows


def gmv(product_stats: DataFrame, date: int | None = None) -> DataFrame:
    """Total order amount of the day; 0 for a day without orders."""
    total = F.coalesce(F.sum("order_amount"), F.lit(0)).cast(MONEY_SUM)
    return on_day(product_stats, date).agg(total.alias("gmv"))


def _top(product_stats, date, limit, keys: list[str], **more: Column) -> DataFrame:
    amount = F.sum("order_amount").cast(MONEY_SUM).alias("order_amount")
    return (
        on_day(product_stats, date)
        .groupBy(*keys)
        .agg(amount, *[c.alias(n) for n, c in more.items()])
        .filter("order_amount > 0")
        .orderBy(F.desc("order_amount"), *keys)
        .limit(limit)
    )


def by_trademark(product_stats: DataFrame, date: int | None = None, limit: int = 10) -> DataFrame:
    """Best-selling trademarks of the day."""
    return _top(product_stats, date, limit, ["tm_id", "tm_name"])


def by_category3(product_stats: DataFrame, date: int | None = None, limit: int = 10) -> DataFrame:
    return _top(product_stats, date, limit, ["category3_id", "category3_name"])


def by_spu(product_stats: DataFrame, date: int | None = None, limit: int = 10) -> DataFrame:
    return _top(product_stats, date, limit, ["spu_id", "spu_name"], order_ct=F.sum("order_ct"))


_VISITOR_SUMS = ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")


def by_visitor_flag(visitor_stats: DataFrame, date: int | None = None) -> DataFrame:
    """Measures of new and of returning visitors."""
    sums = [F.sum(m).alias(m) for m in _VISITOR_SUMS]
    return on_day(visitor_stats, date).groupBy("is_new").agg(*sums)


def with_ratios(visitors: DataFrame) -> DataFrame:
    """Add bounce rate, seconds per visit and pages per visit."""
    return visitors.withColumns(
        {
            "uj_rate": bounce_rate(),
            "dur_per_sv": seconds_per_visit(),
            "pv_per_sv": pages_per_visit(),
        }
    )


#: metric label -> column, in table order
VISITOR_METRICS = {
    "users": "uv_ct",
    "pages": "pv_ct",
    "bounce_rate": "uj_rate",
    "seconds_per_visit": "dur_per_sv",
    "pages_per_visit": "pv_per_sv",
}


def new_versus_old(visitor_stats: DataFrame, date: int | None = None) -> DataFrame:
    """Five metrics by row, new and returning visitors by column."""
    rated = with_ratios(by_visitor_flag(visitor_stats, date))
    new = F.col("is_new") == "1"
    sides = []
    for name in VISITOR_METRICS.values():
        value = F.col(name).cast("decimal(20,2)")
        sides.append(F.coalesce(F.max(F.when(new, value)), F.lit(0)).alias(f"new_{name}"))
        sides.append(F.coalesce(F.max(F.when(~new, value)), F.lit(0)).alias(f"old_{name}"))
    wide = rated.agg(*sides)
    lines = [
        F.struct(
            F.lit(i).alias("line"),
            F.lit(label).alias("type"),
            F.col(f"new_{name}").cast("decimal(20,2)").alias("new"),
            F.col(f"old_{name}").cast("decimal(20,2)").alias("old"),
        )
        for i, (label, name) in enumerate(VISITOR_METRICS.items())
    ]
    return wide.select(F.inline(F.array(*lines)))


def by_hour(visitor_stats: DataFrame, date: int | None = None) -> DataFrame:
    """Visitors by hour; hours without visits are absent."""
    new = F.when(F.col("is_new") == "1", F.col("uv_ct")).otherwise(0)
    return (
        on_day(visitor_stats, date)
        .groupBy(F.hour("stt").alias("hr"))
        .agg(
            F.sum("uv_ct").alias("uv_ct"),
            F.sum("pv_ct").alias("pv_ct"),
            F.sum("uj_ct").alias("uj_ct"),
            F.sum(new).cast("bigint").alias("new_uv"),
        )
        .orderBy("hr")
    )


def all_hours(visitor_stats: DataFrame, date: int | None = None) -> DataFrame:
    """Visitors for each of the 24 hours, 0 where there were none."""
    hours = visitor_stats.sparkSession.range(24).select(F.col("id").cast("int").alias("_hour"))
    found = by_hour(visitor_stats, date)
    filled = [F.coalesce(c, F.lit(0)).alias(c) for c in ("uv_ct", "pv_ct", "new_uv")]
    label = F.lpad(F.col("_hour").cast("string"), 2, "0").alias("hr")
    joined = hours.join(found, F.col("_hour") == F.col("hr"), "left")
    return joined.orderBy("_hour").select(label, *filled)


def by_province(province_stats: DataFrame, date: int | None = None) -> DataFrame:
    """Order amount by province; provinces are told apart by id, shown by name."""
    amount = F.sum("order_amount").cast(MONEY_SUM).alias("order_amount")
    grouped = on_day(province_stats, date).groupBy("province_id", "province_name").agg(amount)
    return grouped.select("province_name", "order_amount")


def keyword_weight(source: str = "source") -> Column:
    weight = F.lit(0)
    for name, value in KEYWORD_WEIGHTS.items():
        weight = F.when(F.col(source) == name, value).otherwise(weight)
    return weight


def by_keyword(
    keyword_stats: DataFrame, date: int | None = None, limit: int = 20, plain: bool = False
) -> DataFrame:
    """Top keywords: shown with their weighted score, ranked by their plain count.

    ``plain`` adds the count they are ranked by.
    """
    top = (
        on_day(keyword_stats, date)
        .groupBy("keyword")
        .agg(
            F.sum(F.col("ct") * keyword_weight()).alias("score"),
            F.sum("ct").alias("plain_ct"),
        )
        .orderBy(F.desc("plain_ct"), "keyword")
        .limit(limit)
    )
    return top.select("keyword", F.col("score").alias("ct"), *(["plain_ct"] if plain else []))
