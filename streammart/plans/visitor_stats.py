"""Visits, page views, unique visitors, bounces and stay by visitor group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streammart.operators.visits import is_entry
from streammart.operators.windows import running_agg, tumbling_agg, union_feeds

GROUP = ["vc", "ch", "ar", "is_new"]
MEASURES = ["uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"]


def measures(
    pages: DataFrame,
    uniques: DataFrame,
    bounces: DataFrame,
    delay: str | None = None,
    own_watermarks: bool = False,
) -> DataFrame:
    """One row per page, unique visit and bounce, in a common shape.

    Page views, visits and stay come from the page rows in a single pass.  ``delay`` and
    ``own_watermarks`` are those of ``union_feeds``.
    """
    visit = F.when(is_entry(), 1).otherwise(0)
    stay = F.coalesce("during_time", F.lit(0))

    def rows(df: DataFrame, **own) -> DataFrame:
        values = [own.get(m, F.lit(0)).cast("bigint").alias(m) for m in MEASURES]
        return df.select("event_time", *GROUP, *values)

    feeds = [
        rows(pages, pv_ct=F.lit(1), sv_ct=visit, dur_sum=stay),
        rows(uniques, uv_ct=F.lit(1)),
        rows(bounces, uj_ct=F.lit(1)),
    ]
    return union_feeds(feeds, delay, own_watermarks)


def visitor_stats(
    pages: DataFrame,
    uniques: DataFrame,
    bounces: DataFrame,
    size: str = "2 seconds",
    delay: str = "30 seconds",
    own_watermarks: bool = False,
) -> DataFrame:
    """Measures by visitor group and window.

    A bounce is only known once its waiting time is over, so on a stream the
    default delay covers two bounce windows and ten seconds of disorder.  With ``own_watermarks`` (see
    ``union_feeds``) windows wait for the bounces instead, and the delay need not cover that.
    """
    rows = measures(pages, uniques, bounces, delay, own_watermarks)
    return tumbling_agg(rows, GROUP, {m: F.sum(m) for m in MEASURES}, size)


def visitor_totals(pages: DataFrame, uniques: DataFrame, bounces: DataFrame) -> DataFrame:
    """Measures by visitor group so far, without windows."""
    rows = measures(pages, uniques, bounces)
    return running_agg(rows, GROUP, {m: F.sum(m) for m in MEASURES})
