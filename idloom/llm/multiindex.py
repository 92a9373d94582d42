"""Embedding near-dedup with an inverted multi-index.

Unit vectors are cut in two halves, each with a codebook of its own; the pairs of code words form a grid of
cells. A vector is filed in one cell and visits others in the order of a lower bound of its distance to
them: the two sorted lists of half distances are walked together, least sum first, until the sum
passes a limit. The limit is set so that a neighbour just within the threshold is met with the target
recall; closer neighbours are met more surely, and a pair counts if either of its vectors visits the
other's cell. Every pair that meets is verified by its cosine in double precision.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idloom.llm.links import components, stars
from idloom.llm.vectors import by_key, common_size, matrix, sample, usable
from idloom.session import cut

#: vectors the codebooks are fitted on; code words of a half; vectors of a shard of a cell; share of neighbours that one side must meet
SAMPLE_ROWS, WORDS, SHARD, RECALL = 20_000, 16, 512, 0.99


def codebook(x: np.ndarray, words: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Lloyd's k-means."""
    centre = x[rng.choice(len(x), min(words, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = ((centre ** 2).sum(1) - 2 * x @ centre.T).argmin(1)
        for k in range(len(centre)):
            if (own == k).any():
                centre[k] = x[own == k].mean(0)
    return centre


@dataclass
class Grid:
    """Codebooks of both halves, and the limit of a traversal."""
    books: tuple[np.ndarray, np.ndarray]
    limit: float

    def bounds(self, x: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
        """Nearest word, and squared lower bounds of the distance to the region of every word.

        The region of another word begins no nearer than the plane midway between it and the own word.
        """
        book = self.books[half]
        part = x[:, :x.shape[1] // 2] if half == 0 else x[:, x.shape[1] // 2:]
        far = (part ** 2).sum(1)[:, None] - 2 * part @ book.T + (book ** 2).sum(1)
        own = far.argmin(1)
        apart = np.sqrt(((book[:, None] - book) ** 2).sum(2))[own]
        low = np.maximum(far - far[np.arange(len(x)), own][:, None], 0) / np.where(apart > 0, 2 * apart, 1)
        return own, low ** 2

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Own cell of each unit vector, and the cells it visits, nearest first; the own cell is the first."""
        (a, low_a), (b, low_b) = self.bounds(x, 0), self.bounds(x, 1)
        width = len(self.books[1])
        order_a, order_b = np.argsort(low_a, 1, kind="stable"), np.argsort(low_b, 1, kind="stable")
        out = []
        for i in range(len(x)):
            first, second = low_a[i, order_a[i]], low_b[i, order_b[i]]
            # the staircase of all pairs within the limit, then least sum first
            n = np.searchsorted(second, self.limit - first[first <= self.limit], "right")
            rows = np.repeat(np.arange(len(n)), n)
            cols = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
            near = np.argsort(first[rows] + second[cols], kind="stable")
            cells = order_a[i, rows[near]] * width + order_b[i, cols[near]]
            own = a[i] * width + b[i]
            out.append(np.r_[own, cells[cells != own]])
        return a * width + b, out


def fit(x: np.ndarray, threshold: float, words: int = WORDS, recall: float = RECALL, seed: int = 5) -> Grid:
    """Codebooks from unit vectors, and the limit that meets a neighbour at exactly ``threshold`` with ``recall``."""
    rng = np.random.default_rng(seed)
    half = x.shape[1] // 2
    grid = Grid((codebook(x[:, :half], words, rng), codebook(x[:, half:], words, rng)), 0.0)
    side = rng.normal(size=x.shape)
    side -= (side * x).sum(1)[:, None] * x
    norm = np.sqrt((side ** 2).sum(1))[:, None]
    neighbour = threshold * x + np.sqrt(1 - threshold ** 2) * side / np.where(norm > 0, norm, 1)
    total = np.zeros(len(x))
    for h in (0, 1):
        own, _ = grid.bounds(neighbour, h)
        total += grid.bounds(x, h)[1][np.arange(len(x)), own]
    grid.limit = float(np.quantile(total, recall))
    return grid


def near_duplicates(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.93,
                    words: int = WORDS, shard: int = SHARD, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row: links to other rows of the same label.

    Rows whose label is null or whose vector is null, zero, not finite or not of the most common length
    have no links and are kept. Equal vectors of a label are one class with a count; they are linked
    by definition and never compared; a class has a number of its own, so its ids may be null or on other vectors too.
    Repeated ids get a row each, and each counts as a vector. A component is named by its least id; the rows
    of that id and those without an id are kept. Cells of many
    members or visitors are cut into shards, so no task holds more than two of them.
    """
    rows = df.select(df[vec_id].alias("vec_id"), df[vector].alias("v"), df[label].alias("label"))
    good = rows.filter(usable("v") & F.col("label").isNotNull())
    size = common_size(good, "v")
    classes = cut(good.filter(F.size("v") == size).groupBy("label", "v").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
                  .withColumn("first", F.monotonically_increasing_id()))
    x = sample(classes, "v", size, SAMPLE_ROWS)
    if not len(x) or size < 2:
        # no vectors, or single numbers, which a grid of halves cannot hold
        if len(x):
            raise ValueError("vectors need two components at least")
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    grid = fit(x / np.sqrt((x ** 2).sum(1))[:, None], threshold, words, recall)

    def file(batches):
        """One row per visit; the own cell comes with ``visitor`` false."""
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = matrix(batch.column("v"), size)
            unit /= np.sqrt((unit ** 2).sum(1))[:, None]
            own, cells = grid.visits(unit)
            n = np.array([len(c) for c in cells])
            at = np.repeat(np.arange(len(n)), n)
            start = np.cumsum(n) - n
            take = pa.array(at)
            visitor = np.ones(len(at), bool)
            visitor[start] = False
            # only members are asked which cells they visit
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.where(visitor, 0, n[at]))], pa.int32()),
                                             pa.array(np.concatenate(cells).astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").take(take), pa.array(np.concatenate(cells).astype(np.int32)), pa.array(visitor), batch.column("first").take(take),
                 batch.column("n").take(take), pa.array(own[at].astype(np.int32)),
                 lists, batch.column("v").take(take)],
                names=["label", "cell", "visitor", "first", "n", "own", "visited", "v"])

    kind = {f.name: f.dataType.simpleString() for f in classes.schema}
    filed = classes.select("label", "first", "n", "v").mapInArrow(
        file, f"label {kind['label']}, cell int, visitor boolean, first long, n long, own int, visited array<int>, v {kind['v']}")
    filed = cut(filed)
    sizes = filed.groupBy("label", "cell").agg(
        F.ceil(F.count(F.when(~F.col("visitor"), 1)) / shard).alias("own_shards"),
        F.ceil(F.count(F.when(F.col("visitor"), 1)) / shard).alias("visit_shards")).filter("own_shards > 0")
    dealt = filed.join(sizes, ["label", "cell"]).withColumn("key", F.xxhash64("label")).withColumn(
        "part", F.pmod(F.xxhash64("v", "visitor"), F.when(F.col("visitor"), F.col("visit_shards")).otherwise(F.col("own_shards"))))
    # task (i, j): shard i of the members against shard j, which is one of members (i <= j) or one of visitors
    side = F.when(F.col("visitor"), F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("own_shards") - 1), lambda i: F.struct(i.alias("i"), (F.col("own_shards") + F.col("part")).alias("j"))))
    side = side.otherwise(F.concat(
        F.transform(F.sequence(F.lit(0).cast("long"), F.col("own_shards") - 1), lambda i: F.struct(
            F.least(i, "part").alias("i"), F.greatest(i, "part").alias("j"))),
        F.when(F.col("visit_shards") > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col("visit_shards") - 1), lambda b: F.struct(
            F.col("part").alias("i"), (F.col("own_shards") + b).alias("j")))).otherwise(
                F.array().cast("array<struct<i:bigint,j:bigint>>"))))
    tasks = dealt.withColumn("task", F.explode(side)).select(
        "key", "cell", "task.i", "task.j", "visitor", "part", "first", "n", "own", "visited", "v")

    def verify(table):
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        visitor, part = table["visitor"].to_numpy(), table["part"].to_numpy()
        unit = matrix(table["v"], size)
        unit /= np.sqrt((unit ** 2).sum(1))[:, None]
        members = np.flatnonzero(~visitor & (part == i))
        others = np.flatnonzero(visitor) if visitor.any() else np.flatnonzero(~visitor & (part == j))
        if not len(members) or not len(others):
            return
        a, b = np.nonzero(unit[members] @ unit[others].T >= threshold)
        a, b = members[a], others[b]
        first, own = table["first"].to_numpy(), table["own"].to_numpy()
        if visitor.any():  # a pair whose vectors visit each other meets twice; the one with the lesser visitor counts
            lists = table["visited"].combine_chunks()
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            mutual = np.array([own[y] in flat[at[x]:at[x + 1]] for x, y in zip(a.tolist(), b.tolist())], bool)
            keep = ~mutual | (first[b] < first[a])
        else:
            keep = a < b if i == j else a != b
        a, b = a[keep], b[keep]
        if not len(a):
            return
        n = table["n"].to_numpy()
        links = np.bincount(a, n[b], len(first)) + np.bincount(b, n[a], len(first))
        label_ = stars(len(first), a, b)
        on = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays(
            [pa.array(first[on]), pa.array(links[on].astype(np.int64)), pa.array(first[label_[on]])], names=["first", "links", "root"])

    found = cut(by_key(tasks, ["key", "cell", "i", "j"], verify, "first long, links long, root long"))
    counts = found.groupBy("first").agg(F.sum("links").alias("links"))
    parts = components(found.filter("first <> root"), "first", "root", "first")
    linked = cut(classes.select("first", "least").join(parts, "first"))
    name = linked.groupBy("component").agg(F.min("least").alias("name"))
    linked = linked.join(name, "component").select("first", "name", F.lit(True).alias("linked"))
    named = classes.join(counts, "first", "left").join(linked, "first", "left").select(
        "label", "v", F.col("n"), F.coalesce("links", F.lit(0)).alias("links"), F.when(F.col("linked"), F.col("name")).otherwise(F.col("least")).alias("component"))
    keyed = rows.withColumn("ok", usable("v") & F.col("label").isNotNull())
    out = keyed.filter("ok").join(named, ["label", "v"], "left").unionByName(keyed.filter("NOT ok"), allowMissingColumns=True)
    return out.select(
        "vec_id", F.coalesce(F.col("links") + F.col("n") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"), F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(True)).alias("kept"))
