"""Order amount and count by province."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streammart.operators.windows import tumbling_agg
from streammart.schemas import MONEY_SUM

PROVINCE = ["province_id", "province_name", "province_area_code", "province_iso_code",
            "province_3166_2_code"]


def province_stats(
    order_wide: DataFrame,
    size: str = "2 seconds",
    delay: str = "0 seconds",
    distinct_orders: bool = False,
) -> DataFrame:
    """Split amounts by province and window.

    ``order_count`` counts order lines; ``distinct_orders`` counts orders instead.
    """
    if not distinct_orders:
        count = F.count(F.lit(1))
    elif order_wide.isStreaming:
        count = F.size(F.collect_set("order_id")).cast("bigint")
    else:
        count = F.count_distinct("order_id")
    aggs = {
        "order_amount": F.sum("split_total_amount").cast(MONEY_SUM),
        "order_count": count,
    }
    return tumbling_agg(order_wide, PROVINCE, aggs, size, delay=delay)
