"""Session settings the library is designed for."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Settings that matter at scale.  On a cluster put them in spark-defaults;
#: ``build_session`` applies them for tests and the benchmark.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # Upload the changes of a micro-batch instead of whole state snapshots.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "streammart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(RECOMMENDED)
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_private: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A private folder is made only where the setting is absent, which is the case
    in single-machine tests.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        app = spark.sparkContext.applicationId
        named = _private.setdefault(app, "") or tempfile.mkdtemp(prefix="streammart-")
        _private[app] = named
    return named.rstrip("/")
