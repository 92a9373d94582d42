"""Versioned, bucketed snapshots of the integrated tables, and the writes the pipelines do on them."""

from __future__ import annotations

import json
import uuid as ids
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from idloom import schemas
from idloom.schemas import RECORD_COLUMNS
from idloom.session import cut, remove

KEY = ["source", "hisnumber"]

#: snapshot tables: columns, and the key they are bucketed by and changed by
TABLES = {
    "det": (schemas.DET, KEY), "patients": (schemas.GOLDEN, ["uuid"]), "mobile": (schemas.MOBILE, ["uuid"]),
    "protocols": (schemas.PROTOCOLS, ["uuid"]), "processed": (schemas.PROCESSED, ["hisnumber"]),
    "control": (schemas.CONTROL, ["source"]), "applied": (schemas.APPLIED, KEY),
    # what the streams keep: the newest change of each key, every change once, audit rows per window
    "changes": (schemas.DELTA, ["pcode"]), "deliveries": (schemas.DELTA, ["seq"]),
    "activity": (schemas.ACTIVITY, ["window_start", "source"])}
#: append-only tables; those with a time are laid out by day
LOG_TABLES = {
    "matching_log": schemas.LOG, "rejects": schemas.REJECTS, "merges": schemas.MERGES, "deletes": schemas.DELETES,
    "marks": schemas.MARKS, "status": schemas.STATUS}
_DAY = {"matching_log": "match_time"}

_MANIFEST = "version long, batch_id string, attempt string, tables string"


class CommitConflict(RuntimeError):
    """Another writer committed the version this one was going to write."""


@dataclass
class Change:
    """Rows to write into a table. ``gone`` are keys whose stored rows go first; with ``replace`` so do those
    of the keys in ``rows``."""

    rows: DataFrame
    gone: DataFrame | None = None
    replace: bool = True


class Snapshot:
    """All tables of one version."""

    def __init__(self, store: Store, entries: list):
        self.store, self.spark = store, store.spark
        head = entries[-1] if entries else None
        self.version = head["version"] if head else 0
        self.tables: dict[str, dict[str, str]] = json.loads(head["tables"]) if head else {}
        self.attempts = {e["batch_id"]: e["attempt"] for e in entries}

    def read(self, name: str) -> DataFrame:
        """The rows of a table, or all committed rows of a log."""
        if name in LOG_TABLES:
            return self._log(name, list(self.attempts.values()))
        schema = TABLES[name][0]
        folders = list(self.tables.get(name, {}).values())
        return self.spark.read.schema(schema).parquet(*folders) if folders else schemas.empty(self.spark, schema)

    def around(self, name: str, keys: DataFrame) -> DataFrame:
        """The rows of a table that lie in the buckets of some keys: all that a change of these keys can meet."""
        schema, key = TABLES[name]
        touched = {str(r[0]) for r in keys.select(self.store.bucket(key)).distinct().collect()}
        folders = [f for b, f in self.tables.get(name, {}).items() if b in touched]
        return self.spark.read.schema(schema).parquet(*folders) if folders else schemas.empty(self.spark, schema)

    def of_batch(self, name: str, batch_id: str) -> DataFrame:
        """What one batch wrote to a log."""
        return self._log(name, [self.attempts[batch_id]])

    def _log(self, name: str, attempts: list[str]) -> DataFrame:
        schema = LOG_TABLES[name]
        known = self.spark.createDataFrame([(a,) for a in attempts], "attempt string")
        try:
            stored = self.spark.read.schema(StructType([*schema.fields, StructField("attempt", StringType())])).parquet(
                f"{self.store.path}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return schemas.empty(self.spark, schema)
        # folders of attempts that never committed are left out
        return stored.join(F.broadcast(known), "attempt", "left_semi").select(*schema.fieldNames())


class Store:
    """Snapshots below one folder of shared storage.

    Every table lies in hash buckets of its key, and a manifest entry names one folder for each bucket. A commit
    writes the buckets it touches to folders of its own attempt, then one manifest entry that takes the other
    buckets over from the version before. The entry's file is created only if it is not there, so of two writers on
    one version the second gets ``CommitConflict`` and nothing of it is seen. Readers see all
    tables of a commit or none. A batch id is committed once; repeating it is a no-op.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _entries(self) -> list:
        try:
            return self.spark.read.schema(_MANIFEST).json(f"{self.path}/_manifest").orderBy("version").collect()
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return []
            raise

    def snapshot(self) -> Snapshot:
        return Snapshot(self, self._entries())

    def version(self) -> int:
        return self.snapshot().version

    def has_batch(self, batch_id: str) -> bool:
        return batch_id in self.snapshot().attempts

    def read(self, name: str) -> DataFrame:
        return self.snapshot().read(name)

    def bucket(self, key: list[str]) -> Column:
        return F.pmod(F.xxhash64(*key), F.lit(self.buckets)).cast("int")

    def commit(self, batch_id: str, base: Snapshot | None = None, **parts: DataFrame | Change) -> int:
        """Write one version on top of ``base`` (default: the newest); returns its number.

        A frame replaces its table, a ``Change`` touches some keys of it; logs take frames to append.
        """
        base = base or self.snapshot()
        if batch_id in base.attempts:
            return base.version
        version, attempt = base.version + 1, f"a{ids.uuid4().hex}"
        tables = {name: dict(folders) for name, folders in base.tables.items()}
        for name, part in parts.items():
            if name in LOG_TABLES:
                self._append(name, part, attempt)
            elif isinstance(part, Change):
                tables[name] = tables.get(name, {}) | self._change(base, name, part, attempt)
            else:
                tables[name] = self._write(name, schemas.fit(part, TABLES[name][0]), attempt)
        self._publish(version, batch_id, attempt, tables)
        return version

    def _append(self, name: str, rows: DataFrame, attempt: str) -> None:
        out = schemas.fit(rows, LOG_TABLES[name]).withColumn("attempt", F.lit(attempt))
        layout = ["attempt"]
        if name in _DAY:
            out, layout = out.withColumn("day", F.to_date(_DAY[name])), ["day", "attempt"]
        out.write.mode("append").partitionBy(*layout).parquet(f"{self.path}/{name}")

    def _write(self, name: str, rows: DataFrame, attempt: str) -> dict[str, str]:
        """Folder of each bucket that has rows."""
        folder = f"{self.path}/{name}/{attempt}"
        # adaptive execution splits large buckets over several tasks
        rows.withColumn("_bucket", self.bucket(TABLES[name][1])).hint("rebalance", F.col("_bucket")).write.partitionBy("_bucket").parquet(folder)
        where = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        found = where.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(where)
        names = [f.getPath().getName() for f in found]
        return {n.split("=")[1]: f"{folder}/{n}" for n in names if n.startswith("_bucket=")}

    def _change(self, base: Snapshot, name: str, change: Change, attempt: str) -> dict[str, str]:
        schema, key = TABLES[name]
        rows = cut(schemas.fit(change.rows, schema))
        gone = [rows.select(*key)] if change.replace else []
        if change.gone is not None:
            gone.append(change.gone.select(*key))
        stale = gone[0] if gone else schemas.empty(self.spark, schema).select(*key)
        for more in gone[1:]:
            stale = stale.unionByName(more)
        stale = stale.distinct()
        touched = {str(r[0]) for r in stale.unionByName(rows.select(*key)).select(self.bucket(key)).distinct().collect()}
        if not touched:
            return {}
        held = [f for b, f in base.tables.get(name, {}).items() if b in touched]
        after = rows
        if held:
            after = without(self.spark.read.schema(schema).parquet(*held), stale, key).select(*schema.fieldNames()).unionByName(rows)
        written = self._write(name, after, attempt)
        emptied = [b for b in touched if b in base.tables.get(name, {}) and b not in written]
        return written | (dict.fromkeys(emptied, self._nothing(name, schema, attempt)) if emptied else {})

    def _nothing(self, name: str, schema: StructType, attempt: str) -> str:
        """A folder without rows, for buckets that a change leaves empty."""
        path = f"{self.path}/{name}/{attempt}-empty"
        schemas.empty(self.spark, schema).write.mode("overwrite").parquet(path)
        return path

    def _publish(self, version: int, batch_id: str, attempt: str, tables: dict) -> None:
        entry = json.dumps({"version": version, "batch_id": batch_id, "attempt": attempt, "tables": json.dumps(tables, sort_keys=True)})
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_manifest/{version:012d}.json")
        try:
            out = where.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(where, False)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in str(e.java_exception):
                raise CommitConflict(f"version {version} of {self.path} is taken") from e
            raise
        out.write(bytearray(entry.encode()))
        out.close()

    def vacuum(self, keep: int = 2) -> int:
        """Remove table folders that none of the newest ``keep`` versions names; returns how many. Logs stay.

        For times without a writer: the folders of a commit under way are not named yet.
        """
        entries = self._entries()[-keep:]
        named = {f.removeprefix(f"{self.path}/{t}/").split("/")[0]
                 for e in entries for t, buckets in json.loads(e["tables"]).items() for f in buckets.values()}
        removed = 0
        for name in TABLES:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            fs = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
            for f in fs.listStatus(where) if fs.exists(where) else []:
                if f.getPath().getName() not in named:
                    remove(self.spark, f.getPath().toString())
                    removed += 1
        return removed


def without(df: DataFrame, keys: DataFrame, key: list[str], how: str = "left_anti") -> DataFrame:
    """The rows whose key is not among ``keys`` (``left_semi``: is); a null key is a key like any other."""
    named = keys.select(*[F.col(k).alias(f"_is_{k}") for k in key])
    return df.join(named, [F.col(k).eqNullSafe(F.col(f"_is_{k}")) for k in key], how)


def split_known(batch: DataFrame, det: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Batch rows whose key is stored already, and the others. The stored keys are reduced to those of
    the batch first, so a small batch only scans them."""
    keys = det.select(*KEY).join(batch.select(*KEY), KEY, "left_semi")
    return batch.join(keys, KEY, "left_semi"), batch.join(keys, KEY, "left_anti")


def sink_insert_det(det: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plain insert: rows with a new key are added, rows with a known key are rejects."""
    known, new = split_known(batch, det)
    return (schemas.fit(det, schemas.DET).unionByName(schemas.fit(new, schemas.DET)),
            known.withColumn("reject_reason", F.lit("DUPLICATE_KEY")))


def insert_if_absent(det: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows an initial load has to add; known keys are skipped and count as done."""
    return split_known(batch, det)[1].select(*batch.columns)


def sink_upsert_det(det: DataFrame, batch: DataFrame) -> DataFrame:
    """Insert or overwrite by key (unique in the batch); the golden link of a known row is kept. Rows the
    batch does not touch pass through, without a shuffle when the batch is small."""
    new, old = schemas.fit(batch, schemas.RECORD), schemas.fit(det, schemas.DET)
    links = old.select(*KEY, "uuid").join(new.select(*KEY), KEY, "left_semi")
    return old.join(new.select(*KEY), KEY, "left_anti").select(*RECORD_COLUMNS, "uuid").unionByName(
        new.join(links, KEY, "left").select(*RECORD_COLUMNS, "uuid"))


def soft_delete(batch: DataFrame, tombstones: bool = False) -> DataFrame:
    """Delete requests: noted, counted as done, nothing removed. ``tombstones`` marks the rows instead."""
    out = batch.select("hisnumber", "source", F.lit("DELETE_REQUEST").alias("action"))
    return out.withColumn("deleted", F.lit(True)) if tombstones else out
