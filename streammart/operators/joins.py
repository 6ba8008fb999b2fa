"""Interval joins of two event feeds, and enrichment from dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streammart.functions.times import as_stream_time, interval
from streammart.operators.skew import lookup_join


def interval_join(
    one: DataFrame,
    many: DataFrame,
    on: tuple[str, str],
    times: tuple[str, str],
    lower: str,
    upper: str,
    delays: tuple[str, str] = ("0 seconds", "0 seconds"),
    hot: list[tuple] | None = None,
    small: bool | None = False,
) -> DataFrame:
    """Pairs with equal keys where the second feed's time lies in a range.

    A pair is kept when ``one.time + lower <= many.time <= one.time + upper``,
    both ends included.  On streams both sides get a watermark, which lets Spark
    drop rows from state once no partner can come.  In batch, ``many`` is the
    side with many rows per key; its hot keys are split.  ``small=None`` measures
    ``one`` and leaves the rows of ``many`` where they are if it can be broadcast.
    Column names must differ between the sides.
    """
    one_key, many_key = on
    one_time, many_time = times
    in_range = F.col(many_time).between(
        F.col(one_time) + interval(lower), F.col(one_time) + interval(upper)
    )
    clash = set(one.columns) & set(many.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    if one.isStreaming or many.isStreaming:
        left = as_stream_time(one, one_time).withWatermark(one_time, delays[0])
        right = as_stream_time(many, many_time).withWatermark(many_time, delays[1])
        return left.join(right, (F.col(one_key) == F.col(many_key)) & in_range, "inner")
    joined = lookup_join(
        many, one, on={many_key: one_key}, condition=in_range, small=small, hot=hot, keep_keys=True
    )
    return joined.select(*one.columns, *many.columns)


def enrich(
    facts: DataFrame,
    dim: DataFrame,
    on: dict[str, str],
    columns: dict[str, str],
    small: bool | None = None,
    hot: list[tuple] | None = None,
) -> DataFrame:
    """Add dimension columns to facts; a fact without a match keeps nulls.

    ``on`` maps fact columns to dimension key columns (several are combined with
    AND), ``columns`` maps dimension columns to their names in the result.  The
    dimension holds at most one row per key.  An existing fact column of the
    same name is replaced where the dimension has a value.
    """
    wanted = dim.select(*on.values(), *[F.col(c).alias(f"_new_{n}") for c, n in columns.items()])
    joined = lookup_join(facts, wanted, on=on, how="left", small=small, hot=hot)
    fresh = {}
    for name in columns.values():
        value = F.col(f"_new_{name}")
        fresh[name] = F.coalesce(value, F.col(name)) if name in facts.columns else value
    return joined.withColumns(fresh).drop(*[f"_new_{n}" for n in columns.values()])


def point_lookup(table: DataFrame, **equals: object) -> DataFrame:
    """The rows of a table with the given column values; pushed to the scan."""
    for column, value in equals.items():
        table = table.filter(F.col(column) == F.lit(value))
    return table
