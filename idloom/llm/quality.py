"""Quality scores by random Fourier features over document statistics.

Cosines of random projections approximate a Gaussian kernel over some twenty statistics of a text. Ridge
regression on them needs only the sums of outer products, which every partition makes for its own rows
and Spark adds up; isotonic regression turns the regression value into a probability.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idloom.llm.tables import annotate
from idloom.session import cut

#: random features, width of the kernel in standard deviations, ridge penalty per row, bins of the calibration
FEATURES, WIDTH, RIDGE, BINS, SEED = 160, 5.0, 1e-4, 400, 7

STATISTICS = ("chars words word_length letters upper digits spaces symbols accents distinct top_word top_pair repeated_lines "
              "line_length stopped compressed bare_words longest_word paired_symbols capital_words").split()

_classes: list[np.ndarray] = []


def _kinds() -> np.ndarray:
    """Per code point: 1 lower or caseless letter, 2 upper-case letter, 3 digit, 4 white space, 0 other."""
    if not _classes:
        kind = np.zeros(0x110000, np.uint8)
        for c in range(0x110000):
            s = chr(c)
            if s.isalpha():
                kind[c] = 2 if s.isupper() else 1
            elif s.isdigit():
                kind[c] = 3
            elif s.isspace():
                kind[c] = 4
        _classes.append(kind)
    return _classes[0]


def statistics(text: str | None) -> list[float]:
    """The statistics of one whole text, in the order of ``STATISTICS``; all zero for a null or empty text."""
    if not text:
        return [0.0] * len(STATISTICS)
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    kind = _kinds()[codes]
    n = len(codes)
    other, low, up, digit, space = np.bincount(kind, minlength=5)[:5].tolist()
    words = text.split()
    lines = [x for x in text.split("\n") if x]
    m = max(1, len(words))
    count = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    raw = text.encode("utf-8", "replace")
    return [
        float(np.log1p(n)), float(np.log1p(len(words))), sum(map(len, words)) / m, (low + up) / n, up / max(1, low + up), digit / n,
        space / n, other / n, int(((codes > 127) & (kind < 3) & (kind > 0)).sum()) / max(1, low + up), len(count) / m,
        max(count.values(), default=0) / m, max(pairs.values(), default=0) / m, 1 - len(set(lines)) / max(1, len(lines)),
        float(np.log1p(n / max(1, len(lines)))), sum(w[-1] in ".,;:!?" for w in words) / m, len(zlib.compress(raw, 1)) / len(raw),
        sum(not any(map(str.isalnum, w)) for w in words) / m, float(np.log1p(max(map(len, words), default=0))),
        int(((kind[1:] == 0) & (kind[:-1] == 0)).sum()) / n, sum(w[0].isupper() for w in words) / m]


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    projection: np.ndarray
    shift: np.ndarray
    weight: np.ndarray
    #: calibration: regression values and the probability at each, both ascending
    value: np.ndarray
    probability: np.ndarray

    def expand(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features of rows of statistics, and a constant."""
        z = (x - self.mean) / self.scale
        phi = np.sqrt(2 / len(self.shift)) * np.cos(z @ self.projection + self.shift)
        return np.concatenate([phi, np.ones((len(x), 1))], 1)

    def regress(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.weight

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.regress(x), self.value, self.probability)


def isotonic(mean: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Non-decreasing values closest to ``mean`` (pooling of adjacent violators)."""
    pools: list[list[float]] = []
    for m, w in zip(mean.tolist(), weight.tolist()):
        pools.append([m, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            b, a = pools.pop(), pools.pop()
            w2 = a[1] + b[1]
            pools.append([(a[0] * a[1] + b[0] * b[1]) / w2, w2, a[2] + b[2]])
    return np.concatenate([np.full(int(n), m) for m, _, n in pools]) if pools else np.empty(0)


def measured(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) and ``stats``, an array of the statistics of the whole text."""
    def work(texts):
        rows = [statistics(t) for t in texts.to_pylist()]
        flat = pa.array(np.array(rows, np.float64).reshape(-1))
        yield pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * len(STATISTICS), pa.int32()), flat)

    return annotate(docs, text, "stats array<double>", work, keep or docs.columns)


def _matrix(batch: pa.RecordBatch, name: str = "stats") -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def train(rows: DataFrame, features: int = FEATURES) -> Model:
    """Fit on all of ``rows``: ``stats`` and ``y`` (0 to 1; null rows are left out).

    Three passes over this narrow table: means and deviations, the normal equations, the calibration
    counts. Only sums of a fixed size come to the driver. Without rows every score is 0.5.
    """
    rows = rows.filter("y IS NOT NULL").select("stats", F.col("y").cast("double").alias("y"))
    k = len(STATISTICS)
    moments = rows.agg(*[f(F.col("stats")[i]).alias(f"{f.__name__}{i}") for i in range(k) for f in (F.avg, F.stddev_pop)]).first()
    mean = np.array([moments[2 * i] or 0.0 for i in range(k)])
    scale = np.array([moments[2 * i + 1] or 1.0 for i in range(k)])
    rng = np.random.default_rng(SEED)
    model = Model(mean, scale, rng.normal(size=(k, features)) / WIDTH, rng.uniform(0, 2 * np.pi, features),
                  np.r_[np.zeros(features), 0.5], np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    if moments[0] is None:
        return model
    size = features + 2  # random features, the constant, the label

    def outer(batches):
        total = np.zeros((size, size))
        for batch in batches:
            a = np.concatenate([model.expand(_matrix(batch)), batch.column("y").to_numpy(zero_copy_only=False)[:, None]], 1)
            total += a.T @ a
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size)), pa.ListArray.from_arrays(pa.array(np.arange(size + 1) * size, pa.int32()), pa.array(total.reshape(-1)))],
            names=["i", "v"])

    parts = rows.mapInArrow(outer, "i long, v array<double>")
    sums = parts.groupBy("i").agg(F.array(*[F.sum(F.col("v")[j]) for j in range(size)]).alias("v")).orderBy("i").collect()
    gram = np.array([r["v"] for r in sums])
    n = gram[-2, -2]
    left, right = gram[:-1, :-1] + RIDGE * n * np.eye(size - 1), gram[:-1, -1]
    model.weight = np.linalg.solve(left, right)

    def valued(batches):
        for batch in batches:
            value = model.regress(_matrix(batch))
            bin_ = np.clip(np.floor((value + 0.5) / 2 * BINS), 0, BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bin_), pa.array(value), batch.column("y")], names=["bin", "value", "y"])

    bins = rows.mapInArrow(valued, "bin long, value double, y double").groupBy("bin").agg(
        F.avg("value").alias("value"), F.avg("y").alias("y"), F.count("*").alias("n")).orderBy("value").collect()
    value, y, n = (np.array([r[c] for r in bins], float) for c in ("value", "y", "n"))
    # one half row of either kind keeps thin bins away from certainty
    model.value, model.probability = value, isotonic((y * n + 0.5 * y.mean()) / (n + 0.5), n)
    return model


def scored(rows: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """All columns of ``rows`` but ``stats``, plus ``score`` and ``predicted``."""
    kept = [c for c in rows.columns if c not in ("stats", "score", "predicted")]

    def run(batches):
        for batch in batches:
            s = np.clip(model.score(_matrix(batch)), 0, 1) if batch.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                             names=[*kept, "score", "predicted"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in kept] + ["score double, predicted int"])
    return rows.mapInArrow(run, schema)


def predict(docs: DataFrame, labels: DataFrame, label: str, doc_id: str = "doc_id", text: str = "text",
            threshold: float = 0.3, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: the id), ``score`` (0 to 1, higher is better) and ``predicted`` for each row of ``docs``.

    ``labels`` holds the training labels only. Texts are read once, for their statistics, which are
    written to the shared folder; all further passes read those. Repeated ids get a row each and share
    their label, the mean of repeated labels. Null and empty texts are scored by their zero statistics.
    """
    kept = keep or [doc_id]
    stats = cut(measured(docs, text, list(dict.fromkeys([*kept, doc_id]))))
    known = labels.filter(labels[label].isNotNull()).groupBy(labels[doc_id].alias("_id")).agg(F.avg(label).alias("y"))
    model = train(stats.join(known, stats[doc_id] == known["_id"]))
    return scored(stats.select(*[f"`{c}`" for c in kept], "stats"), model, threshold)
