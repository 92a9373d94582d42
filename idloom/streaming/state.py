"""Keyed streaming state: the newest change of each key, held in the state store between micro-batches.

``newest_changes`` groups a change stream by key and keeps the newest change seen for it, by the order columns, as a
built-in streaming aggregate (``max_by``, update mode) over the RocksDB state store. The changes of a micro-batch are
combined per key before the shuffle, so a key with very many changes sends one row per task, and no row passes
through Python. State is kept for every key seen, in RocksDB on the executors' disks and in the checkpoint. Idle keys
are not ended (an aggregate ends keys only behind a watermark on the grouping, and no row is too late here), so
``idle_ms`` is accepted and not used.

A micro-batch emits one row for each of its keys, the newest one the state knows. A fresh checkpoint starts with empty
state, so that row is not necessarily newer than what a sink holds: sinks keep the newer of what they hold and what arrives.

A null in the order is older than any value. A null key is a key of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def newest_changes(stream: DataFrame, key: str = "pcode", order: tuple[str, ...] = ("change_time", "seq"),
                   idle_ms: int = 24 * 3600 * 1000) -> DataFrame:
    """For each key of a micro-batch the newest row of ``stream`` so far."""
    spark = stream.sparkSession
    if spark.conf.get(PROVIDER, "") != ROCKSDB:
        spark.conf.set(PROVIDER, ROCKSDB)
    newest = F.max_by(F.struct(*stream.columns), F.struct(*order)).alias("_newest")
    return stream.groupBy(F.col(key).alias("_key")).agg(newest).select("_newest.*")
