"""Session settings, and the shared folder in which plans are cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_dirs: dict[str, str] = {}
_DEBUGGING = "spark.python.sql.dataFrameDebugging.enabled"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "idloom", **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution; everything else is left to the cluster."""
    b = (SparkSession.builder.appName(app)
         .config("spark.sql.session.timeZone", "UTC")
         .config(_DEBUGGING, "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true"))
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        b = b.config(key.replace("__", "."), value)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a folder of one machine
    is lost with that machine, so a missing setting is an error there.
    """
    path = spark.conf.get(CHECKPOINT_DIR, None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_DIR} must name a shared folder")
        path = _local_dirs.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="idloom-")
        _local_dirs[spark.sparkContext.applicationId] = path
    return path


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/idloom/{name}-{uuid.uuid4().hex}"


_open_scopes: list[list[str]] = []


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Remove the folders that ``cut`` writes inside this block when it ends.

    Only for blocks whose results are stored elsewhere by then, such as a pipeline that ends with a commit.
    """
    _open_scopes.append([])
    try:
        yield
    finally:
        for path in _open_scopes.pop():
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of shared storage."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there.

    Later steps neither recompute it nor depend on the executor that produced it; they read only
    the columns they need, and the file sizes tell Spark how to join it.
    """
    path = scratch(df.sparkSession, "cut")
    if _open_scopes:
        _open_scopes[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_BROADCAST = "spark.sql.autoBroadcastJoinThreshold"
#: largest size, as Spark estimates it, of a join side that is broadcast without a hint
BROADCAST_BYTES = 1 << 20


def _bound_broadcasts(spark: SparkSession) -> None:
    """Keep Spark's own choice of broadcasts to small sides.

    The size it goes by is that of compressed files or shuffle blocks; uuids and other hashes take 16 times as much
    in memory, and each such side passes through the driver.
    """
    now = int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    if now > BROADCAST_BYTES:
        spark.conf.set(_BROADCAST, str(BROADCAST_BYTES))


def tune(spark: SparkSession) -> SparkSession:
    """Settings the operators count on, for a session that was built elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    _bound_broadcasts(spark)
    # call-site capture for every Column expression; it costs more than analysing the plans here
    if spark.conf.get(_DEBUGGING, "true") == "true" and spark.conf.isModifiable(_DEBUGGING):
        spark.conf.set(_DEBUGGING, "false")
    return spark
