"""Database change events: normalising, rule-driven routing, column pruning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streammart.functions.jsons import keep_fields, once, parse_rows, typed
from streammart.operators.latest import last_per_key
from streammart.operators.skew import lookup_join
from streammart.schemas import CHANGE, FEED_RECORD, RULES

#: Operation codes of the change feed.
OPERATIONS = {"c": "create", "u": "update", "d": "delete", "r": "read"}


def parse_changes(raw: DataFrame, value: str = "value", on_error: str = "quarantine") -> DataFrame:
    """JSON envelopes to ``database``, ``table``, ``type`` and ``data``.

    ``data`` maps the row's column names to their values, each of its own type.
    """
    return parse_rows(raw, CHANGE, value, on_error)


def with_data(changes: DataFrame) -> DataFrame:
    """Drop change events that carry no row."""
    return changes.filter(F.col("data").isNotNull())


def normalise_type(changes: DataFrame) -> DataFrame:
    """A row read while bootstrapping counts as an insert."""
    kind = F.when(F.col("type") == "bootstrap-insert", "insert").otherwise(F.col("type"))
    return changes.withColumn("type", kind)


def route_changes(
    changes: DataFrame,
    rules: DataFrame,
    prune: bool = True,
    small_rules: bool | None = None,
) -> DataFrame:
    """Attach each change to the rule of its table and operation.

    Adds ``sink_type``, ``sink_table`` and ``sink_pk`` (``id`` where the rule has
    none).  Changes without a rule stay, with a null ``sink_type``: see
    :func:`split_routes`.  ``data`` becomes JSON text, cut to the rule's columns
    unless ``prune`` is off.
    """
    wanted = rules.select(
        F.col("source_table").alias("_rule_table"),
        F.col("operate_type").alias("_rule_type"),
        "sink_type",
        "sink_table",
        "sink_columns",
        F.coalesce("sink_pk", F.lit("id")).alias("sink_pk"),
    )
    routed = lookup_join(
        changes,
        wanted,
        on={"table": "_rule_table", "type": "_rule_type"},
        how="left",
        small=small_rules,
    )
    text = F.to_json("data")
    if prune:
        pruned = F.to_json(keep_fields(F.col("data"), F.split("sink_columns", ",")))
        text = F.when(F.col("sink_columns").isNotNull(), pruned).otherwise(text)
    order = [c for c in routed.columns if c not in ("data", "sink_columns")]
    return once(routed, text, "_text").select(*order, F.col("_text").alias("data"))


def split_routes(routed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Changes for topics, changes for dimension tables, changes without a sink."""
    kind = F.coalesce("sink_type", F.lit(""))
    return (
        routed.filter(kind == "kafka"),
        routed.filter(kind == "hbase"),
        routed.filter(~kind.isin("kafka", "hbase")),
    )


def flatten_feed(feed: DataFrame, topic: str = "topic", value: str = "value") -> DataFrame:
    """Change records of a database log reader to the envelope above.

    The topic is named ``server.database.table``; the value holds ``op``,
    ``before`` and ``after``.  ``data`` is the row after the change, or an empty
    object for a delete; ``before`` is kept to identify what a delete removes.
    """
    record = parse_rows(feed, FEED_RECORD, value, on_error="fail")
    op = F.lower("op")
    no_row = F.create_map().cast(CHANGE["data"].dataType)
    codes = F.create_map(*[F.lit(x) for pair in OPERATIONS.items() for x in pair])
    names = F.split(topic, r"\.")
    return record.withColumns(
        {
            "database": names[1],
            "table": names[2],
            "type": F.coalesce(F.try_element_at(codes, op), op),
            "data": F.coalesce("after", no_row),
        }
    ).drop("op", "after")


def latest_rules(feed: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """The rules in force after a feed of rule changes.

    Per source table and operation the last change wins, and a delete removes
    the rule.  ``feed`` comes from :func:`flatten_feed`; ``order_by`` tells the
    changes apart.
    """
    gone = F.col("type") == "delete"
    row = F.when(gone, F.col("before")).otherwise(F.col("data"))
    fields = [row[name].cast("string").alias(name) for name in RULES.fieldNames()]
    rules = feed.select("type", *order_by, *fields)
    last = last_per_key(rules, ["source_table", "operate_type"], order_by)
    return last.filter("type <> 'delete'").select(*RULES.fieldNames())


def typed_data(changes: DataFrame, schema, keep: Sequence[str] = ()) -> DataFrame:
    """The rows inside routed changes, as typed columns.

    ``keep`` takes columns of the change along, by name or with an underscore in
    front where the row has a column of that name.
    """
    kept = [F.col(c.removeprefix("_")).alias(c) for c in keep]
    names = [F.col("_data")[n].alias(n) for n in schema.fieldNames()]
    rows = changes.select(*kept, typed("data", schema).alias("_data"))
    return rows.select(*keep, *names)
