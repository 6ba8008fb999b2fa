"""Streaming forms of the per-visitor operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from streammart.functions.times import as_stream_time, seconds
from streammart.operators.visits import is_entry, repair_is_new, visit_date


def daily_unique_visits_stream(
    log: DataFrame,
    mid: str = "mid",
    event_time: str = "event_time",
    last_page_id: str = "last_page_id",
    keep_for: str = "1 day",
) -> DataFrame:
    """The first entry row to arrive per visitor and day.

    A visitor's day is remembered until the watermark is ``keep_for`` past it.
    """
    entries = as_stream_time(log, event_time).filter(is_entry(last_page_id))
    return (
        entries.withColumn("visit_date", visit_date(event_time))
        .withWatermark(event_time, keep_for)
        .dropDuplicatesWithinWatermark([mid, "visit_date"])
    )


class _FirstClaim(StatefulProcessor):
    """Lets one row per key keep its flag.  State: one boolean per visitor."""

    def __init__(self, flag: int, order: list[int], names: list[str]):
        self.flag, self.order, self.names = flag, order, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", T.StructType([T.StructField("s", T.BooleanType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first = None
        known = self.seen.exists()
        for row in rows:
            values = list(row)
            if known:
                yield self._flagged(values, "0")
            elif first is None:
                first = values
            elif self._place(values) < self._place(first):
                yield self._flagged(first, "0")
                first = values
            else:
                yield self._flagged(values, "0")
        if first is not None:
            self.seen.update((True,))
            yield self._flagged(first, "1")

    def _place(self, values: list):
        return [values[i] for i in self.order]

    def _flagged(self, values: list, flag: str) -> Row:
        values[self.flag] = flag
        return Row(**dict(zip(self.names, values)))

    def close(self) -> None:
        pass


def repair_is_new_stream(
    log: DataFrame, order_by: list[str], mid: str = "mid", flag: str = "is_new"
) -> DataFrame:
    """Streaming form of ``repair_is_new``.

    Within a micro-batch the earliest row wins, between batches the earlier
    batch.  Only rows that claim to be new pass through the stateful step, in Python; where the
    micro-batch is at hand, :func:`mark_newcomers` and :func:`repair_marked` do the same without it.
    """
    claims = F.col(flag) == "1"
    new = log.filter(claims)
    columns = log.columns
    step = _FirstClaim(columns.index(flag), [columns.index(c) for c in order_by], columns)
    repaired = new.groupBy(mid).transformWithState(
        statefulProcessor=step,
        outputStructType=log.schema,
        outputMode="Append",
        timeMode="None",
    )
    return repaired.unionByName(log.filter(F.coalesce(~claims, F.lit(True))))


def mark_newcomers(log: DataFrame, mid: str = "mid", flag: str = "is_new") -> DataFrame:
    """The log, and one row more for every visitor who claims to be new for the first time.

    That row has the visitor only, and true as ``_newcomer``.  The state is one key per visitor, and no row
    leaves the JVM.  :func:`repair_marked` then repairs each micro-batch.
    """
    claims = log.filter((F.col(flag) == "1") & F.col(mid).isNotNull())
    marks = claims.select(mid).dropDuplicates([mid]).withColumn("_newcomer", F.lit(True))
    return log.withColumn("_newcomer", F.lit(False)).unionByName(marks, allowMissingColumns=True)


def repair_marked(batch: DataFrame, order_by: list[str], mid: str = "mid", flag: str = "is_new") -> DataFrame:
    """A micro-batch of :func:`mark_newcomers`, repaired as by :func:`repair_is_new_stream`.

    Only a newcomer's earliest row stays ``'1'``.  The micro-batch is read several times: persist it.
    """
    rows = batch.filter(~F.col("_newcomer")).drop("_newcomer")
    return repair_is_new(rows, order_by, mid, flag, newcomers=batch.filter("_newcomer").select(mid))


def detect_bounces_stream(
    log: DataFrame,
    tiebreak: str,
    within: str = "10 seconds",
    mid: str = "mid",
    event_time: str = "event_time",
    last_page_id: str = "last_page_id",
    delay: str = "0 seconds",
) -> DataFrame:
    """Streaming form of ``detect_bounces``: an outer join of entries with follow-ups in time.

    Time is cut into slots of ``within``.  An entry's waiting time covers the end of its own slot and the
    beginning of the next, so of a visitor's follow-ups in a slot only the first and the last can matter:
    the last of the own slot comes after the entry if any does, and the first of the next comes in time if
    any does.  The join therefore makes at most two pairs per entry, however many pages a visitor loads.  An
    entry left without a pair is reported when its own slot and the next are over.  ``tiebreak`` is a
    column of any type that has an order.  Rows without a visitor or a time are left out.
    """
    span = seconds(within) * 1_000_000
    log = as_stream_time(log, event_time).filter(F.col(mid).isNotNull() & F.col(event_time).isNotNull())
    log = log.withWatermark(event_time, delay)
    entry = is_entry(last_page_id)
    place = F.struct(F.unix_micros(F.col(event_time)).alias("at"), F.col(tiebreak).alias("tie"))
    slots = (
        log.filter(~entry)
        .groupBy(F.col(mid).alias("_mid"), F.window(event_time, within).alias("_slot"))
        .agg(F.min(place).alias("_first"), F.max(place).alias("_last"))
        .select("_mid", F.window_time("_slot").alias("_slot_end"), "_first", "_last")
    )
    own_or_next = (F.col("_slot_end") >= F.col(event_time)) & (
        F.col("_slot_end") < F.col(event_time) + F.expr(f"INTERVAL '{2 * seconds(within)}' SECOND")
    )
    in_time = lambda p: (p > place) & (p["at"] < F.unix_micros(F.col(event_time)) + span)
    follows = in_time(F.col("_first")) | in_time(F.col("_last"))
    waiting = log.filter(entry)
    joined = waiting.join(slots, (F.col(mid) == F.col("_mid")) & own_or_next & follows, "left_outer")
    return joined.filter("_mid IS NULL").select(*log.columns)
