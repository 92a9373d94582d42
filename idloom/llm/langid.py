"""Language identification by rank-order profiles of letter n-grams.

A profile is the list of the most frequent n-grams (one to three letters, a mark at both ends of a
word) of a language. A document is compared by its own list: every n-gram counts the number of places
it is away from its place in the profile, and a full list length if the profile lacks it. The language
of least distance wins, the alphabetically first one on a tie.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idloom.llm.tables import annotate, retain, slices
from idloom.session import cut

#: n-grams of a profile
PLACES = 300
#: distinct n-grams a task counts before it hands them on
HELD = 1_000_000
UNKNOWN = "und"

_letter: list[np.ndarray] = []
_TWO = np.uint64(1 << 63)


def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    if not _letter:
        _letter.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letter[0]


def grams(text: str) -> np.ndarray:
    """All n-grams of a text as numbers, repeats included; 21 bits a letter, 0 for the edge of a word."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    codes = np.where(_letters()[codes], codes, 0)
    codes = np.concatenate([[0], codes[(codes != 0) | np.r_[True, codes[:-1] != 0]], [0]]).astype(np.uint64)
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    inside = b != 0
    left, right = codes[:-1], codes[1:]
    pair = (left << np.uint64(21) | right)[(left != 0) | (right != 0)] | _TWO
    return np.concatenate([b[inside], pair, (a << np.uint64(42) | b << np.uint64(21) | c)[inside]])


def places(text: str, k: int = PLACES) -> np.ndarray:
    """The ``k`` most frequent n-grams of a text, most frequent first, ties by number."""
    found, n = np.unique(grams(text), return_counts=True)
    return found[np.argsort(-n, kind="stable")[:k]]


@dataclass
class Profiles:
    """``rank[l, v]`` is the place of n-gram ``grams[v]`` in language ``l``, ``places`` if it has none."""
    languages: list[str]
    grams: np.ndarray
    rank: np.ndarray
    places: int

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and 1 - distance / greatest possible distance; (und, 0) for texts without a letter."""
        own = places(text, self.places) if text else np.empty(0, np.uint64)
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        known = self.grams[at] == own
        mine = np.arange(len(own))[known]
        away = np.abs(np.minimum(self.rank[:, at[known]], self.places) - mine)
        away = np.where(self.rank[:, at[known]] >= self.places, self.places, away).sum(1) + self.places * int((~known).sum())
        best = int(away.argmin())
        return self.languages[best], 1.0 - float(away[best]) / (self.places * len(own))


def gram_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, n) over whole texts: merged per task, then summed by Spark."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def rows():
            for name, parts in held.items():
                keys, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                n = np.bincount(back, np.concatenate([p[1] for p in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(keys)), pa.array(keys.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

        for part in slices(batches, "_text"):
            by: dict[str, list[str]] = {}
            for name, body in zip(part.column("_lang").to_pylist(), part.column("_text").to_pylist()):
                by.setdefault(name, []).append(body)
            for name, bodies in by.items():
                keys, n = np.unique(grams("\n".join(bodies)), return_counts=True)
                held.setdefault(name, []).append((keys, n))
                size += len(keys)
            if size > HELD:
                yield from rows()
                held, size = {}, 0
        yield from rows()

    source = docs.filter(F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull()).select(
        F.col(f"`{lang}`").cast("string").alias("_lang"), F.col(f"`{text}`").cast("string").alias("_text"))
    counted = source.mapInArrow(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, text: str = "text", lang: str = "lang", k: int = PLACES) -> Profiles:
    """Profiles of all languages in ``lang``, from every row that has both a text and a language.

    The driver gets ``k`` n-grams of each language and no more. Without such rows there are no
    languages, and every prediction is ``und``. Texts without letters add nothing.
    """
    counts = cut(gram_counts(docs, text, lang))
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if not languages:
        return Profiles([], np.empty(0, np.uint64), np.empty((0, 0), np.int64), k)
    top = reduce(DataFrame.unionAll, [
        counts.filter(F.col("lang") == name).orderBy(F.desc("n"), "gram").limit(k) for name in languages])
    lists: dict[str, list] = {name: [] for name in languages}
    for r in top.collect():
        lists[r["lang"]].append((-r["n"], r["gram"]))
    own = {name: np.array([g for _, g in sorted(rows)], np.int64).view(np.uint64) for name, rows in lists.items()}
    every = np.unique(np.concatenate(list(own.values())))
    rank = np.full((len(languages), len(every)), k, np.int64)
    for i, name in enumerate(languages):
        rank[i, np.searchsorted(every, own[name])] = np.arange(len(own[name]))
    return Profiles(languages, every, rank, k)


def predict(docs: DataFrame, profiles: Profiles, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) plus ``lang_pred`` and ``score`` for each row, from its whole text.

    The profiles, a few thousand numbers, go to the tasks; no row is shuffled. Null, empty and letterless
    texts get ``und`` and 0.
    """
    def work(texts):
        found = [profiles.predict(t) for t in texts.to_pylist()]
        yield pa.array([f[0] for f in found], pa.string())
        yield pa.array([f[1] for f in found], pa.float64())

    return annotate(docs, text, "lang_pred string, score double", work, keep or docs.columns)


def identified(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """The rows of ``docs``, columns unchanged, whose language is one of the profiles; the others are rejected."""
    return retain(docs, text, lambda texts: [profiles.predict(t)[0] != UNKNOWN for t in texts.to_pylist()])
