"""Toxicity by non-negative positive-unlabelled learning.

A linear numpy classifier over hashed words and word beginnings is trained from confirmed toxic texts
and unlabelled texts. The risk of unlabelled texts as negatives also counts the toxic ones among them;
the class prior takes their share off again, and an estimate that falls below zero is pushed back instead
of being followed (the non-negative correction), which keeps a flexible model from overfitting. The prior is
estimated on the unlabelled sample, so it does not matter how rich in toxic rows the labels are.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idloom.llm.tables import annotate, hashed_sample, retain

#: hashed features (a power of two), and the letters of a word beginning
FEATURES, BEGINNING = 1 << 17, 5
#: bounds of the training sample: confirmed positives (and as many confirmed negatives), unlabelled rows
POSITIVES, UNLABELLED = 4_000, 12_000
#: prior of the models that only score rows for the estimate of the class prior
SCORING_PRIOR = 0.1
#: rounds of full-batch Adam, its step, the weight of the ridge penalty
ROUNDS, STEP, RIDGE = 150, 0.05, 5e-4
#: a feature must occur in so many rows, and its share among positives be so many standard errors off its share among all
LEAST_ROWS, STANDARD_ERRORS = 4, 5.0
#: sampled rows whose features the driver unpacks at a time; the others stay packed
BLOCK = 512

_WORD = re.compile(r"[^\W\d_]+")


def features(text: str | None) -> np.ndarray:
    """Hashed features present in a whole text, each once and in order."""
    words = set(_WORD.findall((text or "").lower()))
    marks = [zlib.crc32(w.encode()) for w in words]
    marks += [zlib.crc32(w.encode(), 1) for w in {w[:BEGINNING] for w in words if len(w) > BEGINNING}]
    return np.unique(np.array(marks, np.int64) & (FEATURES - 1))


def _blocks(lists: list[np.ndarray]):
    """(first row, features, row of each) of ``BLOCK`` rows at a time."""
    for i in range(0, len(lists), BLOCK):
        some = lists[i:i + BLOCK]
        yield np.concatenate(some).astype(np.int64), np.repeat(np.arange(i, i + len(some)), [len(x) for x in some])


def _counts(lists: list[np.ndarray]) -> np.ndarray:
    """In how many rows each feature occurs."""
    out = np.zeros(FEATURES, np.int64)
    for at, _ in _blocks(lists):
        out += np.bincount(at, minlength=FEATURES)
    return out


def _rows(lists: list[np.ndarray], told: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features marked in ``told`` of all rows one after the other, and the row of each."""
    parts = [(at[told[at]], row[told[at]]) for at, row in _blocks(lists)]
    return tuple(np.concatenate(x) for x in zip(*parts))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Model:
    weight: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        """Estimated probability that the text is toxic; an empty text is scored by the bias alone."""
        return float(self.scores([features(text)])[0])

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        """The score of each row of features."""
        return _sigmoid(np.array([self.bias + self.weight[x].sum() for x in rows]))


def _telling(in_p: np.ndarray, n_p: int, in_u: np.ndarray, n_u: int) -> np.ndarray:
    """Features whose share among positives differs clearly from that among unlabelled rows."""
    share = (in_u + 0.5) / (n_u + 1)
    off = np.abs(in_p / n_p - share) / np.sqrt(share * (1 - share) / n_p)
    return (in_p + in_u >= LEAST_ROWS) & (off >= STANDARD_ERRORS)


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, rounds: int = ROUNDS) -> Model:
    """Minimise prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)) for the logistic loss.

    Without positives every score is near zero, without unlabelled rows the prior decides. The bias stays
    at or below the prior's log odds: a text without features is no more likely toxic than any other.
    """
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    start = float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return Model(np.zeros(FEATURES), start)
    n_p, n_u = len(positive), len(unlabelled)
    at, row = _rows(positive + unlabelled, _telling(_counts(positive), n_p, _counts(unlabelled), n_u))
    w = np.zeros(FEATURES + 1)
    w[-1] = start
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        z = w[-1] + np.bincount(row, w[at], minlength=n_p + n_u)
        p = _sigmoid(z)
        loss_negative = np.logaddexp(0, z)  # loss of calling a row negative
        rest = loss_negative[n_p:].mean() - prior * loss_negative[:n_p].mean()
        gain = np.empty_like(z)
        if rest >= 0:
            gain[:n_p] = prior * (p[:n_p] - 1) / n_p - prior * p[:n_p] / n_p
            gain[n_p:] = p[n_p:] / n_u
        else:  # the negative part went below zero: undo it
            gain[:n_p] = prior * p[:n_p] / n_p
            gain[n_p:] = -p[n_p:] / n_u
        g = np.r_[np.bincount(at, gain[row], minlength=FEATURES), gain.sum()]
        g[:-1] += RIDGE * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= STEP * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w[-1] = min(w[-1], start)
    return Model(w[:-1], float(w[-1]))


def class_prior(positive: list[np.ndarray], negative: list[np.ndarray], unlabelled: list[np.ndarray]) -> float:
    """The share of positives among unlabelled rows, whatever their share among labelled ones.

    Scores of unlabelled rows are a mixture of those of positives and negatives, so the means of the three tell
    the share. Each half of the rows is scored by a model of the other half. Without negatives it is the least
    ratio of unlabelled to positive rows at or above a score that half of the positives reach, which is an upper bound.
    """
    off = span = 0.0
    bounds = []
    for half in (0, 1):
        if not positive[half::2] or not unlabelled[half::2]:
            continue
        model = fit(positive[half::2], unlabelled[half::2], SCORING_PRIOR)
        p, n, u = (model.scores(rows[1 - half::2]) for rows in (positive, negative, unlabelled))
        if len(p) and len(n) and len(u):
            off, span = off + u.mean() - n.mean(), span + p.mean() - n.mean()
        elif len(p) and len(u):
            cuts = np.unique(p[p <= np.median(p)])
            bounds.append(min((u >= c).mean() / (p >= c).mean() for c in cuts))
    if span > 0:
        return float(np.clip(off / span, 0, 1))
    if bounds:
        return float(np.mean(bounds))
    labelled = len(positive) + len(negative)
    return len(positive) / labelled if labelled else 0.0  # nothing to compare


def _sample(docs: DataFrame, ids: list[DataFrame], doc_id: str, text: str) -> list[list[np.ndarray]]:
    """Features of the documents named by each of ``ids``, bounded tables of distinct ids, from one scan."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(
                [features(t).astype("<i4").tobytes() for t in batch.column(2).to_pylist()], pa.binary())], names=["kind", "f"])

    asked = reduce(DataFrame.unionAll, [x.select("_id", F.lit(k).alias("_kind")) for k, x in enumerate(ids)])
    found = docs.select(docs[doc_id].alias("_id"), docs[text].cast("string").alias("_text")).join(
        F.broadcast(asked), "_id").dropDuplicates(["_id", "_kind"]).select("_kind", "_id", "_text")
    out: list[list[np.ndarray]] = [[] for _ in ids]
    for batch in found.mapInArrow(run, "kind int, f binary").toArrow().to_batches():
        packed = batch.column(1).cast(pa.large_binary())
        _, ends, data = packed.buffers()
        at = np.frombuffer(ends, np.int64)[packed.offset:packed.offset + len(packed) + 1] // 4
        flat = np.frombuffer(data or b"", "<i4")
        for kind, a, b in zip(batch.column(0).to_pylist(), at.tolist(), at[1:].tolist()):
            out[kind].append(flat[a:b])  # a view: the driver holds the rows once, packed
    return out


def train(docs: DataFrame, labels: DataFrame, label: str, doc_id: str = "doc_id", text: str = "text",
          positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """Fit the model on training rows only; the caller leaves held-out rows out of ``docs`` and ``labels``.

    The sample holds at most ``positives`` documents labelled 1, as many labelled 0, and ``unlabelled`` others taken
    without a look at any label, each chosen by a hash of the id; both bounds are parameters. The class prior is
    estimated on the others (``class_prior``); documents labelled 0 serve for nothing else. Repeated ids count once.
    """
    def chosen(ids: DataFrame, seed: int, n: int) -> DataFrame:
        return hashed_sample(ids.filter("_id IS NOT NULL").distinct(), ["_id"], n, seed)

    known = labels.select(labels[doc_id].alias("_id"), labels[label].alias("_y"))
    some = chosen(known.filter("_y = 1").select("_id"), 1, positives)
    clear = chosen(known.filter("_y = 0").select("_id"), 3, positives)
    others = chosen(docs.select(docs[doc_id].alias("_id")), 2, unlabelled)
    found = _sample(docs, [some, clear, others], doc_id, text)
    return fit(found[0], found[2], class_prior(*found))


def predict(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.3, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) plus ``score`` and ``predicted`` of every whole text; nothing is shuffled.

    Null and empty texts get the score of a text without features.
    """
    def work(texts):
        score = np.array([model.score(t) for t in texts.to_pylist()])
        yield pa.array(score, pa.float64())
        yield pa.array((score >= threshold).astype(np.int32))

    return annotate(docs, text, "score double, predicted int", work, keep or docs.columns)


def clean(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, columns unchanged, that score below the threshold."""
    return retain(docs, text, lambda texts: [model.score(t) < threshold for t in texts.to_pylist()])
