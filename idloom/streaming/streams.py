"""The change log and the audit log as streams.

Every micro-batch is one commit of a ``Store``. Its batch id is made of the id that the checkpoint gives the query and
of the micro-batch's number, so one that is delivered again is skipped, and a fresh checkpoint never
meets the ids of an old one. What was seen before lies in the store and not in a watermark: no row is too late.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from idloom.plans.pipelines import pipeline_delta_b
from idloom.session import cut, temporary
from idloom.sources.source_b import delta_latest
from idloom.sources.store import Change, CommitConflict, Snapshot, Store, without
from idloom.streaming.state import newest_changes


def _batches(stream: DataFrame, store: Store, checkpoint: str, name: str, apply: Callable[[DataFrame, str], None],
             mode: str = "append") -> StreamingQuery:
    """Run ``apply`` on each micro-batch with its batch id, until all that is there is read."""
    def each(batch: DataFrame, number: int) -> None:
        query = store.spark.read.json(f"{checkpoint}/metadata").first()["id"]
        apply(batch, f"{name}-{query}-{number}")
    return stream.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _merged(store: Store, batch_id: str, change: Callable[[Snapshot], dict[str, Change]]) -> None:
    """Commit what ``change`` makes of the newest version, again if another writer was faster."""
    while True:
        base = store.snapshot()
        with temporary(store.spark):
            try:
                if batch_id not in base.attempts:
                    store.commit(batch_id, base, **change(base))
                return
            except CommitConflict:
                continue


def stream_delta_apply(stream: DataFrame, store: Store, checkpoint: str, as_of, name: str = "delta-b") -> StreamingQuery:
    """Apply the change log micro-batch by micro-batch; changes older than the one applied to their key have no effect."""
    return _batches(stream, store, checkpoint, name, lambda batch, batch_id: pipeline_delta_b({"delta": batch}, store, as_of, batch_id) and None)


def stream_latest_state(stream: DataFrame, store: Store, checkpoint: str, order: tuple[str, ...] = ("change_time", "seq"),
                        name: str = "latest", idle_ms: int = 24 * 3600 * 1000) -> StreamingQuery:
    """Keep the newest change of each key in the table ``changes``.

    The newest change per key is kept in streaming state (``state.newest_changes``), so a micro-batch passes on one row
    for each of its keys; the commit writes only the buckets of those keys and keeps the newer of stored and arriving
    rows, so a key that starts afresh is still right.
    """
    def apply(batch: DataFrame, batch_id: str) -> None:
        def change(base: Snapshot) -> dict[str, Change]:
            # staged once: each action on a micro-batch would run its stateful stage again
            last = cut(delta_latest(batch, "pcode", order))
            held = without(base.around("changes", last), last, ["pcode"], "left_semi")
            return {"changes": Change(delta_latest(last.select(*held.columns).unionByName(held), "pcode", order))}
        _merged(store, batch_id, change)
    return _batches(newest_changes(stream, "pcode", order, idle_ms), store, checkpoint, name, apply, "update")


def stream_dedup(stream: DataFrame, store: Store, checkpoint: str, name: str = "dedup") -> StreamingQuery:
    """Every change once in the table ``deliveries``, by its ``seq``, however late it is delivered again."""
    def apply(batch: DataFrame, batch_id: str) -> None:
        def change(base: Snapshot) -> dict[str, Change]:
            once = batch.dropDuplicates(["seq"])
            seen = base.around("deliveries", once).select("seq")
            return {"deliveries": Change(once.join(seen, "seq", "left_anti").select(*batch.columns), replace=False)}
        _merged(store, batch_id, change)
    return _batches(stream, store, checkpoint, name, apply)


def stream_activity_window(stream: DataFrame, store: Store, checkpoint: str, size: str = "1 hour", name: str = "activity") -> StreamingQuery:
    """Audit rows per source and tumbling window in the table ``activity``. Counts are added up as rows come, so late rows
    and windows that are still open count."""
    keys = ["window_start", "window_end", "source"]

    def apply(batch: DataFrame, batch_id: str) -> None:
        def change(base: Snapshot) -> dict[str, Change]:
            new = (batch.withColumn("w", F.window(F.col("match_time").cast("timestamp"), size)).groupBy(
                F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.col("w.end").cast("timestamp_ntz").alias("window_end"), "source")
                .agg(F.count("*").alias("count")))
            held = base.around("activity", new).join(new.select("window_start", "source"), ["window_start", "source"], "left_semi")
            return {"activity": Change(new.unionByName(held).groupBy(*keys).agg(F.sum("count").alias("count")))}
        _merged(store, batch_id, change)
    return _batches(stream, store, checkpoint, name, apply)
