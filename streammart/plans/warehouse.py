"""The whole warehouse in batch: every layer written as a table, then the reports.

Each step reads stored tables and writes one.  A step is therefore computed once
however many steps use it, has a short lineage, and can be repeated by itself.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streammart.functions.jsons import split_dirty
from streammart.operators import logs
from streammart.functions.times import today_number
from streammart.operators.skew import hot_keys
from streammart.operators.visits import daily_unique_visits, detect_bounces, repair_is_new
from streammart.plans import order_wide as ow
from streammart.plans import product_stats as ps
from streammart.plans import charts, reports
from streammart.plans.keyword_stats import keyword_stats, searches
from streammart.plans.province_stats import province_stats
from streammart.plans.visitor_stats import visitor_stats
from streammart.sources.tables import read_stats, write_stats

#: Feeds of the product statistics that are stored as they arrive.
PRODUCT_FEEDS = ("favor_info", "cart_info", "order_refund_info", "comment_info")


@dataclass(frozen=True)
class Batch:
    """A batch run over stored feeds.

    ``root`` is the folder of the warehouse on shared storage.  The feeds of the
    detail layer are written with :meth:`put` (or by the routing job) before the
    steps that read them.
    """

    spark: SparkSession
    root: str
    size: str = "2 seconds"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def put(self, name: str, rows: DataFrame, *partitions: str) -> None:
        rows.write.mode("overwrite").partitionBy(*partitions).parquet(f"{self.root}/{name}")

    # -- detail ------------------------------------------------------------

    def split_log(self, raw: DataFrame, order_by: Iterable[str]) -> None:
        """Raw log to ``dwd_log`` (by kind: start, page), ``dwd_display``, ``dwd_dirty``."""
        parsed = logs.parse_app_log(raw)
        good, dirty = split_dirty(parsed)
        fixed = repair_is_new(good, list(order_by))
        kind = F.when(logs.is_start(), "start").otherwise("page")
        self.put("dwd_log", fixed.withColumn("kind", kind), "kind")
        self.put("dwd_dirty", dirty.select(*raw.columns))
        self.put("dwd_display", logs.display_log(self.pages(), carry=("event_time",)))

    def pages(self) -> DataFrame:
        return self.table("dwd_log").filter("kind = 'page'")

    # -- middle ------------------------------------------------------------

    def visits(self, tiebreak: str, within: str = "10 seconds") -> None:
        """``dwm_unique_visit`` and ``dwm_user_jump`` from the page log."""
        pages = self.pages()
        self.put("dwm_unique_visit", daily_unique_visits(pages, [tiebreak]))
        self.put("dwm_user_jump", detect_bounces(pages, tiebreak, within))

    def wide_orders(self, dims: ow.Dims, as_of: Column | None = None, **bounds: str) -> None:
        """``dwm_order_wide`` from ``order_info`` and ``order_detail``."""
        details = self.table("order_detail")
        hot = hot_keys(details, ["order_id"])
        lines = ow.join_order_lines(self.table("order_info"), details, hot=hot, **bounds)
        self.put("dwm_order_wide", ow.with_dimensions(lines, dims, as_of))

    def wide_payments(self, **bounds: str) -> None:
        """``dwm_payment_wide`` from ``payment_info`` and the wide orders."""
        wide = self.table("dwm_order_wide")
        hot = hot_keys(wide, ["order_id"])
        self.put(
            "dwm_payment_wide",
            ow.join_payments(self.table("payment_info"), wide, hot=hot, **bounds),
        )

    # -- statistics --------------------------------------------------------

    def statistics(self, dims: ow.Dims) -> None:
        """The four statistics tables, one partition per day."""
        pages, wide = self.pages(), self.table("dwm_order_wide")
        visitors = visitor_stats(
            pages, self.table("dwm_unique_visit"), self.table("dwm_user_jump"), self.size
        )
        favors, carts, refunds, comments = (self.table(n) for n in PRODUCT_FEEDS)
        products = ps.product_measures(
            ps.sources(
                pages=pages, displays=self.table("dwd_display"), favors=favors, carts=carts,
                order_wide=wide, payment_wide=self.table("dwm_payment_wide"), refunds=refunds,
                comments=comments,
            ),
            self.size,
        )
        tables = {
            "visitor_stats": visitors,
            "product_stats": ps.with_product_dims(products, dims),
            "province_stats": province_stats(wide, self.size),
            "keyword_stats": keyword_stats(searches(pages), size=self.size),
        }
        for name, rows in tables.items():
            write_stats(rows, f"{self.root}/{name}")

    # -- reports -----------------------------------------------------------

    def report(self, name: str, date: int | None = None, **options) -> DataFrame:
        """A day's report by name; see :data:`REPORTS`."""
        source, build = REPORTS[name]
        date = date or today_number()
        return build(read_stats(self.spark, source, f"{self.root}/{source}", date), date, **options)

    def chart(self, name: str, date: int | None = None, **options) -> DataFrame:
        """The same as one JSON document for a chart."""
        if name == "keyword":
            options["plain"] = True
        return charts.chart(name, self.report(name, date, **options))


#: report -> (statistics table, function)
REPORTS = {
    "gmv": ("product_stats", reports.gmv),
    "trademark": ("product_stats", reports.by_trademark),
    "category3": ("product_stats", reports.by_category3),
    "spu": ("product_stats", reports.by_spu),
    "visitor": ("visitor_stats", reports.new_versus_old),
    "hr": ("visitor_stats", reports.all_hours),
    "province": ("province_stats", reports.by_province),
    "keyword": ("keyword_stats", reports.by_keyword),
}
