"""Per-visitor operators: new-visitor repair, daily unique visits, bounces.

These are the batch forms; ``streammart.streaming.visits`` has the stateful
ones.  None of them gathers all rows of a visitor in one task: a visitor may
hold a third of the log.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streammart.functions.times import seconds
from streammart.operators.latest import first_per_key


def is_entry(last_page_id: str = "last_page_id") -> Column:
    """A page reached from no other page."""
    return F.coalesce(F.length(last_page_id), F.lit(0)) == 0


def visit_date(event_time: str = "event_time") -> Column:
    return F.date_format(event_time, "yyyy-MM-dd")


def repair_is_new(
    log: DataFrame,
    order_by: Sequence[str],
    mid: str = "mid",
    flag: str = "is_new",
    newcomers: DataFrame | None = None,
) -> DataFrame:
    """Let only a visitor's first ``'1'`` row stay ``'1'``; the rest become ``'0'``.

    Rows with any other flag, or without a visitor, are neither changed nor counted.  ``order_by`` must
    tell any two rows of a visitor apart (time plus an id or topic position).  With ``newcomers``, a table
    of visitors, no row of any other visitor stays ``'1'``.

    The first row per visitor is found on the narrow key columns and joined back
    on visitor *and* position, a key no two rows share, so the wide rows of one
    visitor are spread over all tasks.
    """
    claims = (F.col(flag) == "1") & F.col(mid).isNotNull()
    new = log.filter(claims)
    firsts = first_per_key(new.select(mid, *order_by), [mid], order_by)
    if newcomers is not None:
        firsts = firsts.join(newcomers.select(F.col(mid).alias("_newcomer")), F.col(mid) == F.col("_newcomer"), "left_semi")
    keys = [mid, *order_by]
    marks = firsts.select(
        *[F.col(c).alias(f"_first_{i}") for i, c in enumerate(keys)], F.lit(True).alias("_first")
    )
    match = F.lit(True)
    for i, c in enumerate(keys):
        match = match & F.col(c).eqNullSafe(F.col(f"_first_{i}"))
    repaired = new.join(marks, match, "left").withColumn(
        flag, F.when(F.col("_first"), "1").otherwise("0")
    )
    rest = log.filter(F.coalesce(~claims, F.lit(True)))
    return repaired.select(*log.columns).unionByName(rest)


def daily_unique_visits(
    log: DataFrame,
    tiebreak: Sequence[str],
    mid: str = "mid",
    event_time: str = "event_time",
    last_page_id: str = "last_page_id",
) -> DataFrame:
    """The first entry row of every visitor on every day; rows without a visitor are none."""
    entries = log.filter(is_entry(last_page_id) & F.col(mid).isNotNull()).withColumn("visit_date", visit_date(event_time))
    return first_per_key(entries, [mid, "visit_date"], [event_time, *tiebreak])


def detect_bounces(
    log: DataFrame,
    tiebreak: str,
    within: str = "10 seconds",
    mid: str = "mid",
    event_time: str = "event_time",
    last_page_id: str = "last_page_id",
) -> DataFrame:
    """Entry rows that the visitor does not follow with a non-entry page in time.

    A follow-up counts when it comes later (by time, then ``tiebreak``) and less
    than ``within`` after the entry; exactly ``within`` is too late.  Entry rows
    in between change nothing.  Rows without a visitor are left out.

    The log is first reduced to one mark per visitor and timestamp.  Marks are
    cut into stretches of ``within``; a stretch also sees the follow-ups of the
    next one, which is as far as any of its entries can look.  A window therefore
    never holds more marks than two stretches have distinct timestamps.
    """
    span = seconds(within) * 1_000_000
    log = log.filter(F.col(mid).isNotNull())
    at = F.unix_micros(F.col(event_time).cast("timestamp"))
    entry = is_entry(last_page_id)
    marks = (
        log.select(mid, at.alias("_at"), entry.alias("_entry"), F.col(tiebreak).alias("_tie"))
        .groupBy(mid, "_at")
        .agg(
            F.max("_entry").alias("_has_entry"),
            F.max(F.when(~F.col("_entry"), F.col("_tie"))).alias("_last_follow"),
        )
    )
    own = F.call_function("div", F.col("_at"), F.lit(span))
    follows = F.col("_last_follow").isNotNull()
    stretches = F.when(follows, F.array(own, own - 1)).otherwise(F.array(own))
    later = (
        Window.partitionBy(mid, "_stretch")
        .orderBy(F.col("_at").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    lonely = (
        marks.withColumn("_stretch", F.explode(stretches))
        .withColumn("_next", F.min(F.when(follows, F.col("_at"))).over(later))
        .filter(F.col("_has_entry") & (F.col("_stretch") == own))
        .filter(F.col("_next").isNull() | (F.col("_next") - F.col("_at") >= span))
        .select(F.col(mid).alias("_mid"), F.col("_at").alias("_lonely_at"), "_last_follow")
    )
    entries = log.filter(entry).withColumn("_at", at)
    match = F.col(mid).eqNullSafe(F.col("_mid")) & (F.col("_at") == F.col("_lonely_at"))
    followed_at_once = F.col("_last_follow") > F.col(tiebreak)
    return (
        entries.join(lonely, match, "inner")
        .filter(F.coalesce(~followed_at_once, F.lit(True)))
        .select(*log.columns)
    )
