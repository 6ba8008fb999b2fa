"""Dimension tables: created from routing rules, updated row by row key, merged when they are read."""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streammart.schemas import RULES
from streammart.sources import files

#: Name of the column that lists the columns a change sets.
SET_COLUMNS = "_set_columns"
#: Name of the boolean column that marks a change as the removal of its row.
REMOVED = "_removed"


def dim_schema(sink_columns: str, sink_pk: str | None = None) -> T.StructType:
    """All columns of a rule as text, the key marked in its metadata."""
    key = sink_pk or "id"
    return T.StructType(
        [
            T.StructField(name, T.StringType(), True, {"primary_key": name == key})
            for name in sink_columns.split(",")
        ]
    )


@dataclass(frozen=True)
class DimTable:
    """A table with one row per key on a shared folder, merged on read.

    Rows are dealt by their key into a fixed number of buckets.  An update appends one small file of
    changes to each bucket it touches; nothing is read and no other bucket is written.  A bucket with more
    than ``max_changes`` such files is compacted: its rows are merged into one file, and removed rows go.

    Every update ends with a manifest, a small file that names the files of each bucket, so readers see one
    whole version, an interrupted update leaves no trace, and versions up to ``keep`` back stay readable.
    The manifest also holds the last batch of every writer.  A batch number means something only together
    with its writer, such as a job and its checkpoint: a writer's repeated batch is skipped, another
    writer's batch of the same or a lower number is not.
    """

    path: str
    schema: T.StructType
    buckets: int = 16
    max_changes: int = 8
    keep: int = 20

    @property
    def key(self) -> str:
        marked = [f.name for f in self.schema.fields if (f.metadata or {}).get("primary_key")]
        if len(marked) != 1:
            raise ValueError(f"{self.path}: the rule's columns do not hold its key")
        return marked[0]

    @property
    def _others(self) -> list[str]:
        return [n for n in self.schema.fieldNames() if n != self.key]

    @property
    def _file_schema(self) -> T.StructType:
        """A value is wrapped, which tells a null that was set from a column that was not."""
        wrapped = T.StructType([T.StructField("v", T.StringType())])
        fixed = [T.StructField(self.key, T.StringType()), T.StructField("_version", T.LongType()), T.StructField("_present", T.BooleanType())]
        return T.StructType([*fixed, *[T.StructField(n, wrapped) for n in self._others]])

    # -- versions --------------------------------------------------------

    def _manifest(self, spark: SparkSession, version: int | None = None) -> dict | None:
        """A version's manifest, the newest without a number; None if there is none."""
        found = [n for n in files.names(spark, f"{self.path}/manifest") if n.endswith(".json")]
        if version is not None:
            found = [n for n in found if int(n[:-5]) == version]
        return json.loads(files.read_text(spark, f"{self.path}/manifest/{found[-1]}")) if found else None

    def _commit(self, spark: SparkSession, manifest: dict) -> None:
        version = manifest["version"]
        if not files.write_once(spark, f"{self.path}/manifest/{version:012d}.json", json.dumps(manifest)):
            raise RuntimeError(f"{self.path}: version {version} was written by someone else")
        old = self._manifest(spark, version - self.keep)
        if old:
            still = _folders(self._manifest(spark, version - self.keep + 1) or manifest)
            for folder in _folders(old) - still:
                files.remove(spark, f"{self.path}/data/{folder}")
            files.remove(spark, f"{self.path}/manifest/{old['version']:012d}.json")

    def version(self, spark: SparkSession) -> int:
        """The newest version; -1 before the table is created."""
        manifest = self._manifest(spark)
        return manifest["version"] if manifest else -1

    def create(self, spark: SparkSession) -> None:
        """Record an empty first version unless there is one."""
        if self._manifest(spark) is None:
            self._commit(spark, {"version": 0, "buckets": self.buckets, "whole": {}, "changes": {}, "done": {}})

    # -- reading ---------------------------------------------------------

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The rows of a version, by default the newest.  Call again to see later updates."""
        manifest = self._manifest(spark, version)
        if manifest is None and version is not None:
            raise ValueError(f"{self.path}: version {version} is not kept")
        return self._rows(spark, manifest, None)

    def lookup(self, spark: SparkSession, key: str) -> DataFrame:
        """The row of a key, from the files of its bucket."""
        manifest = self._manifest(spark)
        bucket = str(zlib.crc32(key.encode()) % manifest["buckets"]) if manifest else ""
        return self._rows(spark, manifest, {bucket}).filter(F.col(self.key) == key)

    def _rows(self, spark: SparkSession, manifest: dict | None, only: set[str] | None) -> DataFrame:
        if manifest is None:
            return spark.createDataFrame([], self.schema)
        open_ = {b for b, c in manifest["changes"].items() if c and (only is None or b in only)}
        whole = {b: f for b, f in manifest["whole"].items() if only is None or b in only}
        unwrapped = [F.col(n) if n == self.key else F.col(n)["v"].alias(n) for n in self.schema.fieldNames()]
        settled = [f"{f}/bucket={b}" for b, f in whole.items() if b not in open_]
        unsettled = [f"{f}/bucket={b}" for b in open_ for f in [*manifest["changes"][b], *([whole[b]] if b in whole else [])]]
        parts = []
        if settled:
            parts.append(self._files(spark, settled).select(*unwrapped))
        if unsettled:
            parts.append(self._merged(self._files(spark, unsettled)).filter("_present").select(*unwrapped))
        if not parts:
            return spark.createDataFrame([], self.schema)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def _files(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        return spark.read.schema(self._file_schema).parquet(*[f"{self.path}/data/{f}" for f in folders])

    def _merged(self, rows: DataFrame) -> DataFrame:
        """The last set value of every column; at most one file per update meets here for a key."""
        last = [F.max_by(n, F.when(F.col(n).isNotNull(), F.col("_version"))).alias(n) for n in self._others]
        return rows.groupBy(self.key).agg(F.max("_version").alias("_version"), F.max_by("_present", "_version").alias("_present"), *last)

    # -- writing ---------------------------------------------------------

    def upsert(self, changes: DataFrame, order_by: list[str], batch: int, writer: str = "") -> None:
        """Bring the rows of all changed keys up to date; a batch without changes writes nothing.

        ``changes`` holds the table's columns and those of ``order_by``, which order the changes of a
        key.  With a column ``SET_COLUMNS``, an array of names, a change sets those columns only (to null
        as well), and the others keep what earlier changes or the table have; without it, it sets all.
        With a column ``REMOVED``, a change in which it is true removes the row: what earlier changes set
        is gone, and the row is back only with a later change.
        """
        spark = changes.sparkSession
        manifest = self._manifest(spark)
        if manifest is None:
            self.create(spark)
            manifest = self._manifest(spark)
        if manifest["done"].get(writer, batch - 1) >= batch:
            return
        version = manifest["version"] + 1
        rows = self._folded(changes, order_by).withColumns({"_version": F.lit(version).cast("long")})
        folder, touched = self._write(spark, rows, manifest["buckets"], version)
        if not touched:
            return
        for bucket in touched:
            manifest["changes"].setdefault(bucket, []).append(folder)
        manifest.update(version=version, done={**manifest["done"], writer: batch})
        self._commit(spark, manifest)
        self._compact(spark, manifest, [b for b in touched if len(manifest["changes"][b]) > self.max_changes])

    def compact(self, spark: SparkSession) -> None:
        """Merge the changes of all buckets."""
        manifest = self._manifest(spark)
        if manifest:
            self._compact(spark, manifest, [b for b, c in manifest["changes"].items() if c])

    def _folded(self, changes: DataFrame, order_by: list[str]) -> DataFrame:
        """One change per key: what the batch sets, and whether the row is there after it."""
        rows = changes.filter(F.col(self.key).isNotNull())
        order = F.struct(*order_by)
        removed = F.coalesce(F.col(REMOVED), F.lit(False)) if REMOVED in changes.columns else F.lit(False)
        partial = SET_COLUMNS in changes.columns
        sets: dict[str, Column] = {n: F.array_contains(SET_COLUMNS, n) if partial else F.lit(True) for n in self._others}
        last = [
            F.max(F.when(sets[n] & ~removed, F.struct(order.alias("at"), F.struct(F.col(n).cast("string").alias("v")).alias("set")))).alias(n)
            for n in self._others
        ]
        folded = rows.groupBy(F.col(self.key).cast("string").alias(self.key)).agg(
            F.max(F.when(removed, order)).alias("_gone"), F.max(F.when(~removed, order)).alias("_there"), *last
        )
        gone = F.col("_gone").isNotNull()
        empty = F.struct(F.lit(None).cast("string").alias("v"))
        after = lambda at: at.isNotNull() & (~gone | (at > F.col("_gone")))
        return folded.select(
            self.key,
            after(F.col("_there")).alias("_present"),
            *[F.when(after(F.col(n)["at"]), F.col(n)["set"]).when(gone, empty).alias(n) for n in self._others],
        )

    def _write(self, spark: SparkSession, rows: DataFrame, buckets: int, version: int) -> tuple[str, list[str]]:
        """One file per bucket that has rows; the folder, and the buckets."""
        folder = f"{version:012d}-{uuid.uuid4().hex}"
        dealt = rows.select(*self._file_schema.fieldNames(), F.pmod(F.crc32(self.key), F.lit(buckets)).alias("bucket"))
        dealt.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/data/{folder}")
        found = files.names(spark, f"{self.path}/data/{folder}")
        return folder, [n.removeprefix("bucket=") for n in found if n.startswith("bucket=")]

    def _compact(self, spark: SparkSession, manifest: dict, buckets: list[str]) -> None:
        if not buckets:
            return
        parts = [f"{f}/bucket={b}" for b in buckets for f in [*manifest["changes"][b], *([manifest["whole"][b]] if b in manifest["whole"] else [])]]
        version = manifest["version"] + 1
        rows = self._merged(self._files(spark, parts)).filter("_present")
        folder, kept = self._write(spark, rows, manifest["buckets"], version)
        for bucket in buckets:
            manifest["changes"].pop(bucket)
            manifest["whole"].pop(bucket, None)
            if bucket in kept:
                manifest["whole"][bucket] = folder
        manifest["version"] = version
        self._commit(spark, manifest)


def _folders(manifest: dict) -> set[str]:
    return {*manifest["whole"].values(), *[f for c in manifest["changes"].values() for f in c]}


def keyed_sink(table: DimTable, keys: list[str], writer: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps the newest row of each key; for streams in update mode.

    The table's key holds the values of ``keys`` as one JSON text.  ``writer`` names the job's checkpoint,
    so a repeated micro-batch changes nothing and a restarted one goes on where it stopped.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn(table.key, F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}))
        table.upsert(rows, [table.key], batch_id, writer)

    return write


def dims_of_rules(rules: DataFrame, root: str) -> dict[str, DimTable]:
    """The dimension tables the rules ask for, by name.

    Rules are configuration, one per source table and operation, so their list
    is read to the driver.  A table that several rules feed has the columns of all.
    """
    wanted = (
        rules.filter("sink_type = 'hbase'")
        .select(*RULES.fieldNames())
        .groupBy("sink_table")
        .agg(
            F.array_join(
                F.array_distinct(
                    F.flatten(F.array_sort(F.collect_list(F.split("sink_columns", r"\s*,\s*"))))
                ),
                ",",
            ).alias("sink_columns"),
            F.max("sink_pk").alias("sink_pk"),
        )
        .collect()
    )
    return {
        r["sink_table"]: DimTable(
            f"{root}/{r['sink_table']}", dim_schema(r["sink_columns"], r["sink_pk"])
        )
        for r in wanted
    }
