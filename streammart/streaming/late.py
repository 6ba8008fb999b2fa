"""Late rows set aside instead of dropped, and the count of those Spark drops."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from streammart.functions.times import seconds
from streammart.sources import files


@dataclass(frozen=True)
class LateRows:
    """Parts every micro-batch into rows that are on time for windows of ``size`` and rows that are late.

    A row is late if its window had ended when its micro-batch began: the watermark is the newest event
    time of all earlier micro-batches less ``delay``, the rule by which Spark drops rows from windows.  A
    window over the rows on time with the same delay thus drops nothing, as long as it takes in whole
    micro-batches, and rows in are rows in windows plus rows set aside.  Rows without a time are late.

    The newest time after each micro-batch is kept in a small file under ``marks``, a folder on the shared
    storage that belongs to one checkpoint, so a repeated micro-batch is parted as it was the first time.
    """

    marks: str
    size: str
    delay: str
    event_time: str = "event_time"
    keep: int = 20

    def writer(self, write: Callable[[DataFrame, DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` function that calls ``write(on time, late, batch id)``."""

        def run(batch: DataFrame, batch_id: int) -> None:
            newest = self._newest(batch.sparkSession, batch_id - 1)
            at = F.unix_micros(F.col(self.event_time).cast("timestamp"))
            width = seconds(self.size) * 1_000_000
            ends = (F.floor(at / F.lit(width)) + 1) * width
            late = F.lit(False) if newest is None else ends <= newest - seconds(self.delay) * 1_000_000
            late = F.coalesce(late, F.lit(True)) | at.isNull()
            write(batch.filter(~late), batch.filter(late), batch_id)
            seen = batch.agg(F.max(at).alias("newest")).first()["newest"]
            known = [t for t in (newest, seen) if t is not None]
            self._keep(batch.sparkSession, batch_id, max(known) if known else None)

        return run

    def _newest(self, spark, batch_id: int) -> int | None:
        earlier = [n for n in files.names(spark, self.marks) if n.endswith(".json") and int(n[:-5]) <= batch_id]
        return json.loads(files.read_text(spark, f"{self.marks}/{earlier[-1]}"))["newest"] if earlier else None

    def _keep(self, spark, batch_id: int, newest: int | None) -> None:
        files.write_once(spark, f"{self.marks}/{batch_id:019d}.json", json.dumps({"newest": newest}))
        for name in files.names(spark, self.marks)[: -self.keep]:
            files.remove(spark, f"{self.marks}/{name}")


class DroppedRows(StreamingQueryListener):
    """Counts the rows that windows and joins of each named query have dropped as late."""

    def __init__(self):
        self.dropped: Counter[str] = Counter()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.dropped[progress.name or str(progress.id)] += sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
