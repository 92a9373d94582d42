"""Sharding by rendezvous hashing, in DataFrame expressions only.

Every record has a stable key (``doc_id``). For each shard s the pair (key, s) is hashed with XXH64 to a number u in
(0, 1); the shard of greatest weight_s / -ln(u) wins, ties to the smaller shard. Adding a shard moves only the records
that the new shard wins, and those move into it: every other shard's score of a record is unchanged. The law is ``key``.

The slot of a record is its place in its shard, gapless from 0, in the order (doc_id, text_crc32, size). Records are
range-partitioned on (shard, doc_id, text_crc32, size, scan number) and numbered inside their partitions; a table of
one row per (partition, shard) gives each partition's offset. Equal keys, even a third of all rows, are split between
partitions by the scan number, and nothing but that small table passes through one task.

Nulls: a null key hashes as a null column (XXH64 skips it: its hash is that of the shard number alone), so all null
keys share a shard. A null text has size 1 and text_crc32 0, like an empty one. Repeated rows each get a slot; which
of two identical rows has which slot is immaterial. An empty table gives no rows. Other columns of the input are
not read and cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from idloom.session import cut

#: seed of the key hashes
SEED = 42


def _unit(key: Column, shard: Column) -> Column:
    """A number in (0, 1) from the 53 high bits of XXH64(key, shard)."""
    bits = F.shiftrightunsigned(F.xxhash64(key, shard), 11)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(2 ** 53))


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard of ``key`` among ``len(weights)`` shards: one expression whatever their number."""
    w = F.array(*[F.lit(float(x)) for x in weights])
    scored = F.transform(F.sequence(F.lit(0), F.lit(len(weights) - 1)), lambda s: F.struct(
        (F.element_at(w, s + 1) / -F.log(_unit(key, s.cast("long")))).alias("score"), (-s).alias("neg")))
    return -F.array_max(scored)["neg"]


def shard(docs: DataFrame, shards: int = 16, weights: list[float] | None = None, grown_weight: float = 1.0,
          key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs``.

    ``size`` is the UTF-8 bytes of the text plus 1; ``grown_shard`` is the shard with one more of weight
    ``grown_weight``: the same as ``shard`` or the new one, ``shards``.
    """
    weights = list(weights) if weights is not None else [1.0] * shards
    if len(weights) != shards or min(weights) <= 0:
        raise ValueError("one positive weight per shard")
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    k = F.col(f"`{key}`").cast("long")
    keyed = cut(docs.select(
        k.alias("doc_id"), (F.octet_length(body) + F.lit(1)).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        rendezvous(k, weights).alias("shard"), rendezvous(k, weights + [grown_weight]).alias("grown_shard"),
        F.monotonically_increasing_id().alias("_scan")))
    order = ["shard", "doc_id", "text_crc32", "size", "_scan"]
    placed = cut(keyed.repartitionByRange(*order).sortWithinPartitions(*order)
                 .withColumn("_pos", F.monotonically_increasing_id()))
    # one row per partition and shard it holds: as many as partitions plus shards at most
    runs = placed.groupBy(F.shiftright("_pos", 33).alias("_part"), "shard").agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select("_part", F.col("shard").alias("_shard"), "_first",
                          F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    out = placed.join(F.broadcast(offsets), (F.shiftright("_pos", 33) == F.col("_part")) & (F.col("shard") == F.col("_shard")))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"),
                      (F.col("_pos") - F.col("_first") + F.col("_offset")).alias("slot"), F.col("grown_shard").cast("int").alias("grown_shard"))
