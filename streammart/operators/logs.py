"""Click log: parsing raw records and splitting them into three feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streammart.functions.jsons import parse_rows, put_field
from streammart.functions.times import from_millis
from streammart.schemas import APP_LOG


def parse_app_log(raw: DataFrame, value: str = "value", on_error: str = "quarantine") -> DataFrame:
    """Raw JSON text to flat log columns; the text itself is kept in ``value``.

    The start part and each display stay JSON text, as their attributes vary.
    """
    parsed = parse_rows(raw, APP_LOG, value, on_error)
    kept = [c for c in parsed.columns if c not in ("common", "page", "start", "displays")]
    flat = ["common.mid", "common.vc", "common.ch", "common.ar", "common.is_new", "page.page_id",
            "page.last_page_id", "page.item", "page.item_type", "page.during_time"]
    return parsed.select(
        *kept,
        *flat,
        F.to_json("start").alias("start"),
        F.transform("displays", lambda d: F.to_json(d)).alias("displays"),
        from_millis("ts").alias("event_time"),
    )


def is_start(start: str = "start") -> Column:
    """A record with a ``start`` part, even an empty object, is a start record."""
    return F.coalesce(F.length(start), F.lit(0)) > 0


def start_log(log: DataFrame) -> DataFrame:
    return log.filter(is_start())


def page_log(log: DataFrame) -> DataFrame:
    return log.filter(~is_start())


def display_log(log: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per display of a page record, with the page's id.

    ``value`` is the display's own JSON with ``page_id`` put in.  As displays
    carry neither visitor nor time, ``carry`` names log columns to take along.
    """
    shown = page_log(log).select(
        "page_id", *carry, F.posexplode("displays").alias("display_no", "_display")
    )
    return shown.select(
        *carry,
        "page_id",
        "display_no",
        F.get_json_object("_display", "$.item").alias("item"),
        F.get_json_object("_display", "$.item_type").alias("item_type"),
        _display_value(F.col("_display")).alias("value"),
    )


def _display_value(display: Column) -> Column:
    return F.to_json(put_field(F.parse_json(display), "page_id", F.col("page_id")))


def _log_value() -> Column:
    whole = F.parse_json("value")
    common = put_field(F.variant_get(whole, "$.common", "variant"), "is_new", F.col("is_new"))
    return F.to_json(put_field(whole, "common", F.to_variant_object(common)))


def log_value(log: DataFrame) -> DataFrame:
    """The log as topic records: the original JSON with the repaired flag put in.

    Every attribute the client sent is kept.
    """
    return log.select(_log_value().alias("value"))


def split_records(
    log: DataFrame,
    start: str = "dwd_start_log",
    page: str = "dwd_page_log",
    display: str = "dwd_display_log",
) -> DataFrame:
    """All three feeds in one pass, as (``topic``, ``value``) records."""
    def record(topic: Column, value: Column) -> Column:
        return F.struct(topic.alias("topic"), value.alias("value"))

    main = record(F.when(is_start(), start).otherwise(page), _log_value())
    shown = F.when(~is_start(), F.col("displays"))
    displays = F.transform(shown, lambda d: record(F.lit(display), _display_value(d)))
    nothing = F.array().cast("array<struct<topic:string,value:string>>")
    return log.select(F.inline(F.concat(F.array(main), F.coalesce(displays, nothing))))
