"""Progress of the sources: processed ids, watermarks, totals, batches, run status."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from idloom.schemas import stamp
from idloom.session import cut


def processed_set_union(processed: DataFrame, batch: DataFrame) -> DataFrame:
    """Processed ids after a batch; the reset is an empty table."""
    return processed.select("hisnumber").unionByName(batch.select("hisnumber")).filter(
        F.trim("hisnumber") != "").distinct()


def watermark_state(control: DataFrame, batch: DataFrame, as_of) -> DataFrame:
    """Last id and last sync time per source after a batch.

    ``control``: (source, last_id, last_sync), ``batch``: (source, id). Ids compare as numbers.
    """
    now = batch.groupBy("source").agg(F.max(F.col("id").try_cast("bigint")).alias("last_id")).select(
        "source", "last_id", stamp(as_of).alias("last_sync"))
    return control.select("source", "last_id", "last_sync").unionByName(now).groupBy("source").agg(
        F.max("last_id").alias("last_id"), F.max("last_sync").alias("last_sync"))


def source_totals(src: DataFrame, key: str) -> DataFrame:
    """Number of records and the greatest key (as a number or as text, by its type)."""
    return src.agg(F.count("*").alias("total"), F.max(key).cast("string").alias("last_id"))


def number_rows(src: DataFrame, key: str) -> DataFrame:
    """``src`` with ``rn`` = 1, 2, ... in key order, without bringing all rows into one task.

    Each range partition numbers its rows as it is written; only the row counts of the partitions
    are summed up in order.
    """
    ranged = cut(src.repartitionByRange(key).sortWithinPartitions(key)
                 .withColumn("_pos", F.monotonically_increasing_id()))
    part, pos = F.shiftright("_pos", 33), F.col("_pos").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_skip"))
    return ranged.withColumn("_part", part).withColumn("rn", pos + 1).join(
        F.broadcast(starts), "_part").withColumn("rn", F.col("rn") + F.col("_skip")).select(*src.columns, "rn")


def batch_range(src: DataFrame, key: str, n: int) -> DataFrame:
    """Least and greatest key and size of each batch of ``n`` records in key order."""
    return number_rows(src.select(key), key).groupBy(
        F.floor((F.col("rn") - 1) / n).alias("batch")).agg(
        F.min(key).alias("min_id"), F.max(key).alias("max_id"), F.count("*").alias("size"))


def write_status(metrics: DataFrame, path: str) -> None:
    """Append run metrics (one row per run and source) as JSON, times in ISO format."""
    stamps = [c for c, t in metrics.dtypes if t.startswith("timestamp")]
    metrics.withColumns({c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss") for c in stamps}).coalesce(1).write.mode(
        "append").json(path)
