"""The three loads of the integrated tables and the choice between them.

A pipeline stages its conformed batch once, resolves it, and commits all it changed as one version of the store: records,
golden rows, registrations, protocols, the merges, the log, rejects, and the progress of the source. A batch
that was committed before changes nothing and gives back what it wrote then.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idloom import schemas
from idloom.operators import conform as C
from idloom.operators import stats
from idloom.operators.matching import Resolution, resolve
from idloom.operators.merge import repoint_mobile, upsert_known
from idloom.schemas import stamp
from idloom.session import cut, temporary
from idloom.sources import source_a, source_b
from idloom.sources.control import watermark_state
from idloom.sources.store import KEY, Change, CommitConflict, Snapshot, Store, insert_if_absent, soft_delete, split_known

Parts = dict[str, DataFrame | Change]


def content_id(name: str, *inputs: DataFrame) -> str:
    """A batch id made of the rows that are loaded: the same rows give the same id, in any order."""
    marks = [df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first() for df in inputs]
    return "-".join([name, *(f"{n}:{h or 0}" for n, h in marks)])


def _run_id(base: Snapshot, content: str, again: Callable[[Snapshot, str], bool]) -> str:
    """The batch id of a load without a given one: that of its last run, or a new one if ``again`` asks for it
    and other batches have been committed since."""
    runs = [b for b in base.attempts if b == content or b.startswith(f"{content}@")]
    if not runs:
        return content
    return f"{content}@{base.version}" if runs[-1] != list(base.attempts)[-1] and again(base, runs[-1]) else runs[-1]


def _commit(store: Store, batch_id: str, build: Callable[[Snapshot], Parts], again: Callable[[Snapshot, str], bool] | None = None) -> Resolution:
    """Build and commit on the newest version, again if another writer was faster; what the batch wrote.

    With ``again`` the id names only the content, see ``_run_id``.
    """
    content = batch_id
    while True:
        base = store.snapshot()
        if again:
            batch_id = _run_id(base, content, again)
        if batch_id in base.attempts:
            break
        with temporary(store.spark):
            try:
                store.commit(batch_id, base, **build(base))
            except CommitConflict:
                continue
        break
    now = store.snapshot()
    log = now.of_batch("matching_log", batch_id)
    return Resolution(
        assigned=now.read("det").join(log.select(*KEY).distinct(), KEY, "left_semi"), golden=now.read("patients"), log=log,
        rejects=now.of_batch("rejects", batch_id))


def _rejected(*parts: DataFrame) -> DataFrame:
    out = schemas.fit(parts[0], schemas.REJECTS)
    for p in parts[1:]:
        out = out.unionByName(schemas.fit(p, schemas.REJECTS))
    return out


def pipeline_initial_load(inputs: dict[str, DataFrame], store: Store, as_of, last_id: int | None = None,
                          batch_id: str | None = None) -> Resolution:
    """Full load of source B (``clients``): known keys are skipped, so it resumes by itself; ``last_id``
    narrows the scan to later keys. The commit also holds the watermark and a status row that says whether the load is complete.

    ``batch_id`` defaults to one made of the loaded rows. A load of the same rows runs again if the last one had
    rejects and the store has changed since, as they may go in now.
    """
    everything = source_b.scan_source_b(inputs["clients"])
    clients = inputs["clients"] if last_id is None else inputs["clients"].filter(F.col("pcode") > last_id)
    scanned = source_b.scan_source_b(clients)

    def build(base: Snapshot) -> Parts:
        staged = cut(C.validated(C.conform_b(scanned)))
        good, rejects = C.split_rejects(staged)
        det = base.read("det")
        out = resolve(insert_if_absent(det, good), base.read("mobile"), base.read("patients"), as_of)
        rows, refused = cut(out.assigned), cut(_rejected(rejects, out.rejects))
        after = det.select("source").unionByName(rows.select("source"))
        status = stats.completion_rate(everything, after, source_b.SOURCE_ID).select(
            F.lit("initial_load").alias("pipeline"), F.lit(source_b.SOURCE_ID).alias("source"), stamp(as_of).alias("at"),
            "source_count", "destination_count", F.lit(refused.count()).alias("rejected"), "is_complete")
        seen = staged.select("source", F.col("hisnumber").alias("id"))
        return {"det": Change(rows), "patients": Change(out.touched), "matching_log": out.log, "rejects": refused,
                "control": Change(watermark_state(base.read("control"), seen, as_of)), "status": status}

    again = None if batch_id else lambda base, last: not base.of_batch("rejects", last).isEmpty()
    return _commit(store, batch_id or content_id("initial-b", scanned), build, again)


def apply_batch(good: DataFrame, base: Snapshot, as_of) -> tuple[Parts, DataFrame]:
    """What conformed rows (one per key) change: known keys first, then the new ones against the result. Also the rejects."""
    det, patients, mobile, protocols = (base.read(t) for t in ("det", "patients", "mobile", "protocols"))
    known, new = split_known(good, det)
    updated, pairs = upsert_known(known, det, patients, mobile, as_of)
    losers = pairs.select(F.col("loser").alias("uuid"), "survivor")
    sides = losers.select("uuid").unionByName(pairs.select(F.col("survivor").alias("uuid")))
    moved = cut(repoint_mobile(pairs, mobile.join(sides, "uuid", "left_semi")))
    registrations = mobile.join(sides, "uuid", "left_anti").unionByName(moved.select(*mobile.columns))
    added = resolve(new, registrations, updated.golden, as_of)
    written = cut(updated.assigned.unionByName(added.assigned))
    # records and protocols of losers follow their survivor
    followed = det.join(losers, "uuid").join(written.select(*KEY), KEY, "left_anti").withColumn("uuid", F.col("survivor"))
    new_golden = cut(added.touched)
    golden = new_golden.unionByName(updated.touched.join(new_golden.select("uuid"), "uuid", "left_anti").select(*new_golden.columns))
    parts: Parts = {
        "det": Change(written.unionByName(followed.select(*written.columns))),
        "patients": Change(golden, gone=losers), "mobile": Change(moved, gone=sides),
        "protocols": Change(protocols.join(losers, "uuid").withColumn("uuid", F.col("survivor")), gone=losers, replace=False),
        "merges": pairs, "matching_log": updated.log.unionByName(added.log)}
    return parts, _rejected(updated.rejects, added.rejects)


def pipeline_sync_a(inputs: dict[str, DataFrame], store: Store, as_of, batch_id: str | None = None,
                    numbered: bool = False, changed: bool = False) -> Resolution:
    """Sync of source A: ``lines`` of the export. Ids that the store or ``processed`` holds as processed are left alone;
    with ``changed`` they are taken again if their record differs from the stored one.

    The processed set is part of the commit and includes the rejects, which would come back for ever otherwise.
    ``batch_id`` defaults to one made of the inputs and options; with ``changed`` the same export runs again
    once the store has changed since, as it may go back to an earlier content.
    """
    def build(base: Snapshot) -> Parts:
        parsed = cut(source_a.build_source_a_record(source_a.parse_source_a(inputs["lines"], numbered=numbered)))
        done = base.read("processed")
        if "processed" in inputs:
            done = done.unionByName(inputs["processed"].select("hisnumber"))
        todo = source_a.unprocessed_a(parsed, done)
        if changed:
            now = schemas.fit(C.validated(C.conform_a(source_a.last_by_id(parsed))), schemas.RECORD)
            stored = base.read("det").filter(F.col("source") == source_a.SOURCE_ID)
            again = source_a.changed_a(now, stored.select("hisnumber", F.xxhash64(*now.columns).alias("fingerprint")))
            todo = todo.unionByName(parsed.join(again.select("hisnumber"), "hisnumber", "left_semi").join(
                todo.select("hisnumber"), "hisnumber", "left_anti").select(*todo.columns))
        staged = cut(C.validated(C.conform_a(source_a.last_by_id(todo))))
        good, rejects = C.split_rejects(staged)
        parts, refused = apply_batch(good, base, as_of)
        ids = done.select("hisnumber").unionByName(staged.select("hisnumber")).filter(F.trim("hisnumber") != "").distinct()
        new_ids = ids.join(base.read("processed"), "hisnumber", "left_anti")
        state = _synced(base, source_a.SOURCE_ID, as_of)
        return parts | {"rejects": _rejected(rejects, refused), "processed": Change(new_ids), "control": Change(state)}

    if batch_id:
        return _commit(store, batch_id, build)
    name = "-".join(["sync-a", *["numbered"] * numbered, *["changed"] * changed])
    used = [inputs["lines"], *([inputs["processed"].select("hisnumber")] if "processed" in inputs else [])]
    return _commit(store, content_id(name, *used), build, lambda base, last: changed)


def _synced(base: Snapshot, source: int, as_of) -> DataFrame:
    """The source's progress with a new time of its last sync."""
    old = base.read("control").filter(F.col("source") == source)
    now = base.spark.range(1).select(F.lit(source).alias("source"), F.lit(None).cast("long").alias("last_id"), stamp(as_of).alias("last_sync"))
    return old.unionByName(now).groupBy("source").agg(F.max("last_id").alias("last_id"), F.max("last_sync").alias("last_sync"))


def pipeline_delta_b(inputs: dict[str, DataFrame], store: Store, as_of, batch_id: str | None = None) -> Resolution:
    """Change log of source B (``delta``, pending rows): the last change of each key decides. INSERT and
    UPDATE upsert, DELETE is noted, other operations are ignored.

    A change that is older than the one applied to its key before has no effect, whichever batch brings it.
    The consumed rows are marked, the delete requests noted and the sync time moved by the same commit.
    """
    pending = inputs["delta"].filter(F.col("processed") == "N")

    def build(base: Snapshot) -> Parts:
        have = set(pending.columns)
        when = [F.col("change_time").cast("timestamp_ntz") if "change_time" in have else F.lit(None).cast("timestamp_ntz"),
                F.col("seq").cast("long") if "seq" in have else F.lit(None).cast("long")]
        order = tuple(c for c in ("change_time", "seq") if c in have)
        last = cut(source_b.delta_latest(pending, "pcode", order or ("pcode",)).withColumns(
            {"operation": F.upper("operation"), "_hisnumber": F.col("pcode").cast("string"), "_time": when[0], "_seq": when[1]}))
        known = base.read("applied").filter(F.col("source") == source_b.SOURCE_ID).select(
            F.col("hisnumber").alias("_hisnumber"), F.col("change_time").alias("_t0"), F.col("seq").alias("_s0"))
        older = F.coalesce((F.col("_time") < F.col("_t0")) | (F.col("_time").eqNullSafe(F.col("_t0")) & (F.col("_seq") <= F.col("_s0")))
                           | (F.col("_time").isNull() & F.col("_t0").isNotNull()), F.lit(False))
        fresh = cut(last.join(known, "_hisnumber", "left").filter(~older) if order else last)
        upserts = fresh.filter(F.col("operation").isin("INSERT", "UPDATE"))
        staged = cut(C.validated(C.conform_b(source_b.scan_delta_b(upserts.select(*pending.columns)))))
        good, rejects = C.split_rejects(staged)
        parts, refused = apply_batch(good, base, as_of)
        asked = fresh.filter(F.col("operation") == "DELETE").select(
            F.col("_hisnumber").alias("hisnumber"), F.lit(source_b.SOURCE_ID).alias("source"))
        applied = fresh.select(F.col("_hisnumber").alias("hisnumber"), F.lit(source_b.SOURCE_ID).alias("source"),
                               F.col("_time").alias("change_time"), F.col("_seq").alias("seq"))
        marks = pending.select(F.col("pcode").cast("long").alias("pcode"), when[1].alias("seq"))
        parts |= {"rejects": _rejected(rejects, refused), "deletes": soft_delete(asked), "marks": marks,
                  "control": Change(_synced(base, source_b.SOURCE_ID, as_of))}
        return parts | ({"applied": Change(applied)} if order else {})

    return _commit(store, batch_id or content_id("delta-b", pending), build)


def delete_requests(delta: DataFrame) -> DataFrame:
    """Keys whose last pending change is a DELETE, as records for ``soft_delete``."""
    last = source_b.delta_latest(delta.filter(F.col("processed") == "N"))
    return last.filter(F.upper("operation") == "DELETE").select(
        F.col("pcode").cast("string").alias("hisnumber"), F.lit(source_b.SOURCE_ID).alias("source"))


def route_sync_mode(clients: DataFrame, det: DataFrame, control: DataFrame, source: int) -> DataFrame:
    """What the next run of a source has to be: INITIAL_LOAD, SET_SYNC_TIME or DELTA_SYNC."""
    state = stats.completion_rate(clients, det, source).withColumn("source", F.lit(source))
    synced = control.select("source", "last_sync").filter(F.col("source") == source)
    return state.join(F.broadcast(synced.groupBy("source").agg(F.max("last_sync").alias("last_sync"))), "source", "left").select(
        "source", "source_count", "destination_count", "is_complete",
        F.when(~F.col("is_complete"), "INITIAL_LOAD").when(F.col("last_sync").isNull(), "SET_SYNC_TIME")
        .otherwise("DELTA_SYNC").alias("mode"))
