"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Vectors are rotated so that the signs of their components keep as much of them as possible (iterative
quantisation of the principal components, several rotations one after the other), and the signs are the code. A
code is cut into bytes, each with an index of its own. Codes within a Hamming radius must, by the pigeonhole
principle, be close in one of the bytes: probing visits the buckets of all near byte values, keeps the
codes within the radius, and reranks them by inner product of the original vectors in double precision.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from idloom.llm.vectors import by_key, common_size, matrix, sample, usable
from idloom.session import cut

#: vectors the rotations are fitted on, and those of them asked to set the radius; bits of a code; wanted recall
SAMPLE_ROWS, ASKED, BITS, RECALL = 20_000, 200, 128, 0.97
#: rows of an index shard and queries of a block
SHARD, BLOCK = 4096, 2048

_NEAR = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8))


@dataclass
class Coder:
    """Codes of vectors for the inner product; ``longest`` is the greatest norm of all rows."""
    longest: float
    mean: np.ndarray
    turns: np.ndarray
    radius: int = 0

    def lift(self, x: np.ndarray, query: bool) -> np.ndarray:
        """One more component makes all rows equally long, so that the largest inner product is the least angle."""
        if query:
            return np.concatenate([x / np.sqrt((x ** 2).sum(1))[:, None], np.zeros((len(x), 1))], 1)
        unit = x / self.longest
        return np.concatenate([unit, np.sqrt(np.maximum(0, 1 - (unit ** 2).sum(1)))[:, None]], 1)

    def codes(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Codes as rows of bytes."""
        return np.packbits((self.lift(x, query) - self.mean) @ self.turns > 0, axis=1)


def fit(x: np.ndarray, longest: float, k: int, bits: int = BITS, recall: float = RECALL, seed: int = 3, rounds: int = 20) -> Coder:
    """Rotations from a sample, and the least radius that holds ``recall`` of the sample's ``k`` nearest neighbours."""
    rng = np.random.default_rng(seed)
    coder = Coder(longest, np.zeros(x.shape[1] + 1), np.zeros((x.shape[1] + 1, 0)))
    base = coder.lift(x, False)
    coder.mean = base.mean(0)
    centred = base - coder.mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    turns, left = [], bits
    while left > 0:
        d = min(left, x.shape[1])
        part = axes[:, ::-1][:, :d]
        y = centred @ part
        turn = np.linalg.qr(rng.normal(size=(d, d)))[0]
        for _ in range(rounds):
            u, _, v = np.linalg.svd(np.where(y @ turn > 0, 1.0, -1.0).T @ y)
            turn = (u @ v).T
        turns.append(part @ turn)
        left -= d
    coder.turns = np.concatenate(turns, 1)
    asked = rng.choice(len(x), min(ASKED, len(x)), replace=False)
    score = x[asked] @ x.T
    score[np.arange(len(asked)), asked] = -np.inf
    near = np.argsort(-score, 1, kind="stable")[:, :min(k, len(x) - 1)]
    if near.shape[1]:
        codes, own = coder.codes(x, False), coder.codes(x[asked], True)
        far = np.bitwise_count(own[:, None] ^ codes[near]).sum(2)
        coder.radius = int(np.quantile(far, recall, method="higher"))
    return coder


class Shard:
    """Codes of some rows with an index for every byte of them."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = np.argsort(codes, 0, kind="stable")
        self.start = np.stack([np.searchsorted(codes[self.order[:, j], j], np.arange(257)) for j in range(codes.shape[1])])

    def probe(self, queries: np.ndarray, radius: int) -> np.ndarray:
        """Distance of each query to each row that probing meets within ``radius``, 255 or more to the others.

        With radius = m * t + a over m bytes, one of the first a + 1 bytes differs in t bits at most or one
        of the others in t - 1.
        """
        m = self.codes.shape[1]
        t, a = divmod(radius, m)
        met = np.zeros((len(queries), len(self.codes)), bool)
        for j in range(m):
            reach = t if j <= a else t - 1
            if reach < 0:
                continue
            near = _NEAR[queries[:, j]] <= reach
            for value in np.flatnonzero(np.diff(self.start[j])):
                rows = self.order[self.start[j][value]:self.start[j][value + 1], j]
                asking = np.flatnonzero(near[:, value])
                met[np.ix_(asking, rows)] = True
        far = np.full(met.shape, 1 << 14, np.int16)
        q, r = np.nonzero(met)
        for i in range(0, len(q), 1 << 20):
            b = slice(i, i + (1 << 20))
            d = np.bitwise_count(queries[q[b]] ^ self.codes[r[b]]).sum(1, dtype=np.int16)
            far[q[b], r[b]] = np.where(d <= radius, d, 1 << 14)
        return far


def nearest(df: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", bits: int = BITS,
            recall: float = RECALL, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its ``k`` rows of largest inner product found, nearest first.

    ``queries`` has the columns of ``df``. Vectors that are null, zero, not finite or not of the most
    common length take no part, and neither do rows without an id. A row of the query's own id is no candidate; ties
    go to the smaller id. A query id that is repeated is asked once, repeated rows are candidates each.
    Every shard of the index answers every block of queries; where fewer than ``k`` codes of a shard lie within the radius,
    it widens for that query until there are k or the shard is exhausted, so a query never comes back short.
    """
    def valid(rows):
        return rows.select(rows[vec_id].alias("id"), rows[vector].alias("v")).filter(usable("v") & F.col("id").isNotNull())

    base = valid(df)
    size = common_size(base, "v")
    kept = cut(base.filter(F.size("v") == size))
    asked = cut(valid(queries).filter(F.size("v") == size).groupBy("id").agg(F.min("v").alias("v")))
    id_type = kept.schema["id"].dataType.simpleString()
    out = f"query_id {id_type}, vec_id {id_type}, score double"
    total, n_asked = kept.count(), asked.count()
    longest = kept.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double")))).first()[0]
    if not total or not n_asked:
        return df.sparkSession.createDataFrame([], f"query_id {id_type}, rank int, vec_id {id_type}, score double")
    coder = fit(sample(kept, "v", size, SAMPLE_ROWS), float(np.sqrt(longest)) * (1 + 1e-9), k, bits, recall)
    shards, blocks = -(-total // shard), -(-n_asked // block)

    def dealt(rows, own, own_parts, other, other_parts, query):
        # rows are numbered in their written files, which keeps repeated rows apart and stays the same in a second attempt
        return rows.withColumn(own, F.pmod(F.monotonically_increasing_id(), F.lit(own_parts))).withColumn(
            other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(other_parts - 1).cast("long")))).select(
            "shard", "block", F.lit(query).alias("query"), "id", "v")

    tasks = dealt(kept, "shard", shards, "block", blocks, False).unionByName(dealt(asked, "block", blocks, "shard", shards, True))

    def answer(table):
        query = table["query"].to_numpy()
        vectors, ids = matrix(table["v"], size), table["id"].to_numpy()
        rows, asking = np.flatnonzero(~query), np.flatnonzero(query)
        if not len(rows) or not len(asking):
            return
        x, x_id = vectors[rows], ids[rows]
        index = Shard(coder.codes(x, False))
        for part in np.array_split(asking, -(-len(asking) // 256)):
            code = coder.codes(vectors[part], True)
            far = index.probe(code, coder.radius)
            found = ([], [], [])
            for i, at in enumerate(part.tolist()):
                other = x_id != ids[at]
                near = np.flatnonzero((far[i] <= coder.radius) & other)
                radius = coder.radius
                while len(near) < min(k, int(other.sum())):
                    radius = min(2 * radius + 1, index.codes.shape[1] * 8)
                    near = np.flatnonzero((index.probe(code[i:i + 1], radius)[0] <= radius) & other)
                score = np.einsum("ij,j->i", x[near], vectors[at])
                if len(near) > k:  # all rows as near as the k-th stay, for ties across shards
                    top = score >= np.partition(score, -k)[-k]
                    near, score = near[top], score[top]
                    best = np.lexsort((x_id[near], -score))[:k]
                    near, score = near[best], score[best]
                found[0].append(np.full(len(near), at))
                found[1].append(near)
                found[2].append(score)
            q, r, s = (np.concatenate(f) for f in found)
            yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(x_id[r]), pa.array(s)], names=["query_id", "vec_id", "score"])

    found = by_key(tasks, ["shard", "block"], answer, out)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
