"""Joins and windows of streams, a micro-batch at a time, with what must wait kept in files.

Spark's state store looks up and writes every row of a stream by its key, one after the other, which a long
backlog pays for each of its rows.  Here a micro-batch is joined or added up as a table is (sorted, spilled,
skewed keys split), and only rows that later ones can still need are written for the next micro-batch.  Which
rows come too late, and which can still be needed, follows the rules of Spark's own operators: a watermark per
feed, the slowest counts, and it moves between micro-batches.  It holds for the very next one, as it does for
Spark's where a micro-batch without data comes in between.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streammart.functions.times import as_stream_time, seconds
from streammart.sources import files

Join = Callable[[DataFrame, DataFrame], DataFrame]
Write = Callable[[DataFrame, int], None]


def tagged(feeds: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Several feeds as one stream, each row in a column named after its feed.  ``feeds``: rows and time column."""
    rows = {name: as_stream_time(df, time) for name, (df, time) in feeds.items()}
    union = None
    for name, df in rows.items():
        others = {n: F.lit(None).cast(d.schema) for n, d in rows.items()}
        one = df.select(F.lit(name).alias("_feed"), *[c.alias(n) for n, c in (others | {name: F.struct(*df.columns)}).items()])
        union = one if union is None else union.unionByName(one)
    return union


class Kept:
    """What micro-batches leave to the next one: rows, and how far every feed has come.

    A micro-batch that is repeated reads what the one before it left and writes its own part anew.  The folder
    belongs to one checkpoint.
    """

    def __init__(self, root: str):
        self.root = root

    def _last(self, spark: SparkSession, batch_id: int) -> str | None:
        """The part of the micro-batch before; older ones are removed."""
        before = [n for n in sorted(int(n) for n in files.names(spark, self.root)) if n < batch_id]
        for old in before[:-1]:
            files.remove(spark, f"{self.root}/{old}")
        return f"{self.root}/{before[-1]}" if before else None

    def read(self, batch: DataFrame, batch_id: int) -> tuple[DataFrame | None, dict[str, int], int]:
        """The rows kept so far, the latest time of every feed, and the watermark, in microseconds."""
        spark = batch.sparkSession
        if not (last := self._last(spark, batch_id)):
            return None, {}, 0
        known = json.loads(files.read_text(spark, f"{last}/newest.json"))
        return spark.read.schema(batch.schema).parquet(f"{last}/rows"), known["feeds"], known["watermark"]

    def leave(self, rows: DataFrame, batch_id: int, newest: dict[str, int], watermark: int) -> None:
        spark, place = rows.sparkSession, f"{self.root}/{batch_id}"
        files.remove(spark, place)
        rows.write.parquet(f"{place}/rows")
        files.write_once(spark, f"{place}/newest.json", json.dumps({"feeds": newest, "watermark": watermark}))


@contextmanager
def _as_tables(spark: SparkSession) -> Iterator[None]:
    """Streams run with adaptive execution off, for the sake of state stores; there are none here."""
    name = "spark.sql.adaptive.enabled"
    old = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, old)


def _moved(rows: DataFrame, time: Column, delays: Mapping[str, str], newest: dict[str, int], watermark: int) -> tuple[dict[str, int], int]:
    """How far the feeds have come with the rows of a micro-batch, and the watermark after it."""
    latest = rows.groupBy("_feed").agg(F.max(F.unix_micros(time)).alias("at")).where("at IS NOT NULL")
    newest = dict(newest)
    for feed, at in latest.collect():
        newest[feed] = max(at, newest.get(feed, at))
    if newest.keys() == delays.keys():
        # Spark counts watermarks in milliseconds.
        watermark = max(watermark, min(at // 1000 * 1000 - seconds(delays[feed]) * 1_000_000 for feed, at in newest.items()))
    return newest, watermark


def _at(micros: int) -> Column:
    return F.timestamp_micros(F.lit(micros))


def _with(rows: DataFrame, held: DataFrame | None) -> DataFrame:
    return rows if held is None else rows.unionByName(held)


def interval_join_batches(
    join: Join,
    write: Write,
    kept: Kept,
    one: tuple[str, str],
    many: tuple[str, str],
    lower: str,
    upper: str,
    delays: tuple[str, str] = ("0 seconds", "0 seconds"),
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function over :func:`tagged` feeds: the pairs of two feeds, as both arrive.

    ``one`` and ``many`` are the name and the time column of a feed.  ``join`` gives the pairs of two tables
    with ``one.time + lower <= many.time <= one.time + upper``.  New rows meet new and kept rows of the other
    feed; a row is kept until no row of the other feed that is still in time can meet it.
    """
    (one_feed, one_time), (many_feed, many_time) = one, many
    is_one = F.col("_feed") == one_feed
    time = F.when(is_one, F.col(f"{one_feed}.{one_time}")).otherwise(F.col(f"{many_feed}.{many_time}"))
    of = lambda rows, feed: rows.filter(F.col("_feed") == feed).select(f"{feed}.*")

    def run(batch: DataFrame, batch_id: int) -> None:
        with _as_tables(batch.sparkSession):
            held, newest, late = kept.read(batch, batch_id)
            new = batch.filter(time > _at(late))
            known = _with(new, held)
            pairs = join(of(known, one_feed), of(new, many_feed))
            if held is not None:
                pairs = pairs.unionByName(join(of(new, one_feed), of(held, many_feed)))
            write(pairs, batch_id)
            newest, watermark = _moved(batch, time, dict(zip((one_feed, many_feed), delays)), newest, late)
            # The time of the other feed's last row that a row can meet.
            last = time + F.make_interval(secs=F.when(is_one, seconds(upper)).otherwise(-seconds(lower)))
            kept.leave(known.filter(last > _at(watermark)), batch_id, newest, watermark)

    return run


def window_batches(
    measure: Callable[[DataFrame], DataFrame],
    write: Write,
    kept: Kept,
    feeds: Iterable[str],
    size: str,
    delay: str,
    event_time: str = "event_time",
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function over rows with the name of their feed in ``_feed``: tumbling windows, each measured
    once, when it ends.

    ``measure`` gets the rows of all windows that have ended; rows of the others are kept.  Every feed has a
    watermark ``delay`` behind, and the slowest counts.
    """
    length, delays, time = seconds(size) * 1_000_000, dict.fromkeys(feeds, delay), F.col(event_time)
    # The start of the window that is open at a watermark: windows before it have ended.
    opened = lambda watermark: _at(watermark // length * length)

    def run(batch: DataFrame, batch_id: int) -> None:
        with _as_tables(batch.sparkSession):
            held, newest, late = kept.read(batch, batch_id)
            newest, watermark = _moved(batch, time, delays, newest, late)
            known = _with(batch.filter(time >= opened(late)), held)
            write(measure(known.filter(time < opened(watermark))), batch_id)
            kept.leave(known.filter(time >= opened(watermark)), batch_id, newest, watermark)

    return run
