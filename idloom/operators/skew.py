"""Joins that keep their balance when one key holds a large share of the rows.

Every lookup here has one row per key on the right, so a hot key costs nothing there: the few hot
right rows go to all tasks as a broadcast of proven size, and the left rows they serve stay where
they are instead of meeting in one shuffle partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = "idloom.skew.hotRows"
_SALTS = 4096
_HOT_KEYS = 4096
#: buckets of hashed keys whose rows are counted before the keys themselves
_BOUNDS = 1 << 16


def hot_rows(df: DataFrame) -> int:
    """How many rows of one key are too many for one task (session setting ``idloom.skew.hotRows``)."""
    return int(df.sparkSession.conf.get(HOT_ROWS, "1000000"))


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def attach(left: DataFrame, right: DataFrame, keys: list[str], rows: str,
           null_safe: bool = False, threshold: int | None = None) -> DataFrame:
    """Left join of ``left`` with ``right``, which has one row per key.

    ``rows`` names the right column that says how many left rows carry the key. Keys above the
    threshold T are broadcast: with N left rows there are at most N / T of them. Their left rows,
    and rows whose key is NULL, are spread over the shuffle by a hash of the whole row, because no
    partner is left to find for them. The left rows must differ somewhere (they have a primary key).
    """
    payload = [c for c in right.columns if c not in keys]
    packed = right.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.struct(*payload).alias("_p"), F.col(rows).alias("_rows"))
    hot = packed.filter(F.col("_rows") > (threshold or hot_rows(left))).select(
        *[F.col(f"_k{i}").alias(f"_h{i}") for i in range(len(keys))], F.col("_p").alias("_hot"))
    cold = packed.select(*[f"_k{i}" for i in range(len(keys))], F.lit(0).alias("_salt0"),
                         F.col("_p").alias("_cold"))

    def same(a: Column, b: Column) -> Column:
        return a.eqNullSafe(b) if null_safe else a == b

    found = left.join(F.broadcast(hot), _all([
        same(F.col(k), F.col(f"_h{i}")) for i, k in enumerate(keys)]), "left")
    done = F.col("_hot").isNotNull()
    if not null_safe:
        done = done | reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    spread = found.select(
        *left.columns, "_hot",
        *[F.when(~done, F.col(k)).alias(f"_l{i}") for i, k in enumerate(keys)],
        F.when(done, F.pmod(F.xxhash64(*left.columns), F.lit(_SALTS)) + 1)
        .otherwise(F.lit(0)).cast("int").alias("_salt"))
    joined = spread.join(cold, _all(
        [same(F.col(f"_l{i}"), F.col(f"_k{i}")) for i in range(len(keys))]
        + [F.col("_salt") == F.col("_salt0")]), "left")
    hit = F.coalesce("_hot", "_cold")
    return joined.select(*left.columns, *[hit[c].alias(c) for c in payload])


def lookup(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """``attach`` with the rows per key counted first; meant for a batch against a large table.

    The distinct keys of the batch meet the table before anything else does. If they are few, Spark
    broadcasts them (by its own size check) and the table is only scanned.
    """
    counts = left.groupBy(*keys).agg(F.count("*").alias("_n_left"))
    return attach(left, right.join(counts, keys), keys, "_n_left").drop("_n_left")


def attach_by(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``attach`` of two large tables on one key, hot keys found by a frequent-items sketch.

    The sketch over the key column costs one scan and no shuffle of keys. It names at most 4,096
    candidates, among them every key with more than that part of the rows, and only decides the route of a row, never the result.
    """
    top = left.select(F.expr(
        f"approx_top_k({key}, {_HOT_KEYS}, 100000)").alias("_t")).select(F.explode("_t").alias("_t"))
    counts = top.select(F.col("_t.item").alias("_item"), F.col("_t.count").alias("_n"))
    sized = right.join(F.broadcast(counts), F.col(key) == F.col("_item"), "left").select(
        *right.columns, F.coalesce("_n", F.lit(0)).alias("_n_left"))
    return attach(left, sized, [key], "_n_left").drop("_n_left")


def salted(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Left or left semi join with a right side that has one row per key.

    The rows per key are bounded first, by those of its hash bucket: one scan that shuffles no keys. If every bucket
    fits one task it is a plain join; else the keys are counted, the right rows of keys above the threshold are
    broadcast, and the threshold rises with the number of rows so that there are at most 4,096 of them.
    """
    if _most_in_bucket(left, keys) <= hot_rows(left):
        return left.join(right, keys, how)
    counts = left.join(right.select(*keys), keys, "left_semi").groupBy(*keys).agg(F.count("*").alias("_n_left"))
    most, total = counts.agg(F.max("_n_left"), F.sum("_n_left")).first()
    if (most or 0) <= hot_rows(left):
        return left.join(right, keys, how)
    hit = right.withColumn("_met", F.lit(True)).join(counts, keys)
    found = attach(left, hit, keys, "_n_left", threshold=max(hot_rows(left), total // _HOT_KEYS)).drop("_n_left")
    return (found.filter("_met").select(*left.columns) if how == "left_semi" else found).drop("_met")


def _most_in_bucket(df: DataFrame, keys: list[str]) -> int:
    """Rows of the largest hash bucket of ``keys``: no key has more. NULL keys find no partner and do not count."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(_BOUNDS)).alias("_bucket")
    sizes = df.dropna(subset=keys).groupBy(bucket).agg(F.count("*").alias("_n"))
    return sizes.agg(F.max("_n")).first()[0] or 0
