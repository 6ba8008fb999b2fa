"""Derived visit ratios, in exact decimal arithmetic rounded half up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ratio(top: Column, visits: str, users: str, places: int) -> Column:
    """``top / visits`` rounded, 0 where there was no user or no visit."""
    usable = (F.col(users) != 0) & (F.col(visits) != 0)
    exact = top.cast("decimal(20,0)") / F.col(visits).cast("decimal(20,0)")
    return F.when(usable, F.round(exact, places)).otherwise(F.lit(0))


def bounce_rate(bounces: str = "uj_ct", visits: str = "sv_ct", users: str = "uv_ct") -> Column:
    """Bounces per hundred visits."""
    return _ratio(F.col(bounces) * 100, visits, users, 2).cast("decimal(20,2)")


def seconds_per_visit(
    duration: str = "dur_sum", visits: str = "sv_ct", users: str = "uv_ct"
) -> Column:
    """Mean stay in seconds: whole milliseconds first, then one decimal place."""
    millis = _ratio(F.col(duration), visits, users, 0).cast("decimal(20,0)")
    return F.round(millis / F.lit(1000).cast("decimal(4,0)"), 1).cast("decimal(20,1)")


def pages_per_visit(pages: str = "pv_ct", visits: str = "sv_ct", users: str = "uv_ct") -> Column:
    return _ratio(F.col(pages), visits, users, 2).cast("decimal(20,2)")
