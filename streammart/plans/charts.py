"""Finished reports as one JSON document for a chart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _listed(report: DataFrame, order_by: list[Column], *columns: Column) -> DataFrame:
    """The report's rows as one ordered array ``_rows``.

    For reports that their own limit or shape bounds (a ranking, 24 hours, 5 measures): they are
    one document.  ``as_rows`` writes reports of any size.
    """
    keys = [c.alias(f"key_{i}") for i, c in enumerate(order_by)]
    row = F.struct(F.struct(*keys).alias("order"), F.struct(*columns).alias("row"))
    rows = F.transform(F.array_sort(F.collect_list(row)), lambda r: r["row"])
    return report.agg(rows.alias("_rows"))


def as_rows(report: DataFrame, name: str, value: str) -> DataFrame:
    """``name``, ``value`` of each row, largest value first, as a table of any size."""
    rows = report.select(F.col(name).alias("name"), F.col(value).alias("value"))
    return rows.orderBy(-F.col("value"), "name")


def _document(data: Column) -> Column:
    return F.to_json(F.struct(F.lit(0).alias("status"), data.alias("data"))).alias("chart")


def name_values(
    report: DataFrame, name: str, value: str, order_by: list[Column] | None = None
) -> DataFrame:
    """``{"data": [{"name": ..., "value": ...}, ...]}``, largest value first by default."""
    listed = _listed(
        report,
        order_by or [-F.col(value), F.col(name)],
        F.col(name).alias("name"),
        F.col(value).alias("value"),
    )
    return listed.select(_document(F.col("_rows")))


def map_values(report: DataFrame, name: str, value: str) -> DataFrame:
    """``{"data": {"mapData": [{"name": ..., "value": ...}, ...]}}``."""
    listed = _listed(
        report, [F.col(name)], F.col(name).alias("name"), F.col(value).alias("value")
    )
    return listed.select(_document(F.struct(F.col("_rows").alias("mapData"))))


def series(
    report: DataFrame, category: str, values: list[str], order_by: list[Column]
) -> DataFrame:
    """``{"data": {"categories": [...], "series": [{"name": ..., "data": [...]}, ...]}}``."""
    listed = _listed(report, order_by, F.col(category), *[F.col(v) for v in values])
    lines = [
        F.struct(F.lit(v).alias("name"), F.col("_rows")[v].alias("data")) for v in values
    ]
    data = F.struct(
        F.col("_rows")[category].alias("categories"), F.array(*lines).alias("series")
    )
    return listed.select(_document(data))


def table(report: DataFrame, columns: dict[str, str], order_by: list[Column]) -> DataFrame:
    """``{"data": {"columns": [{"name", "id"}, ...], "rows": [{...}, ...]}}``."""
    listed = _listed(report, order_by, *[F.col(c) for c in columns])
    heads = [
        F.struct(F.lit(label).alias("name"), F.lit(column).alias("id"))
        for column, label in columns.items()
    ]
    data = F.struct(F.array(*heads).alias("columns"), F.col("_rows").alias("rows"))
    return listed.select(_document(data))


def single(report: DataFrame, value: str) -> DataFrame:
    """``{"data": value}`` for a report of one row."""
    return report.select(_document(F.col(value)))


def chart(name: str, report: DataFrame) -> DataFrame:
    """The chart document of one of the eight day reports."""
    return _CHARTS[name](report)


def _by_amount(name: str) -> list[Column]:
    return [-F.col("order_amount"), F.col(name)]


_CHARTS = {
    "gmv": lambda r: single(r, "gmv"),
    "trademark": lambda r: series(r, "tm_name", ["order_amount"], _by_amount("tm_name")),
    "category3": lambda r: name_values(r, "category3_name", "order_amount"),
    "spu": lambda r: table(
        r,
        {"spu_name": "SPU", "order_amount": "amount", "order_ct": "orders"},
        _by_amount("spu_name"),
    ),
    "visitor": lambda r: table(r, {"type": "type", "new": "new", "old": "old"}, [F.col("line")]),
    "hr": lambda r: series(r, "hr", ["uv_ct", "pv_ct", "new_uv"], [F.col("hr")]),
    "province": lambda r: map_values(r, "province_name", "order_amount"),
    "keyword": lambda r: name_values(
        r, "keyword", "ct", [-F.col("plain_ct"), F.col("keyword")]
    ),
}
