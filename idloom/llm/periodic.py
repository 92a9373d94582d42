"""Periodic runs of words, found with longest-common-extension queries on a recompressed grammar.

The words of a slice of documents (about ``SLICE_BYTES`` of text) are numbered and laid end to end, each document
between separators that occur nowhere else. Recompression turns that sequence into a run-length grammar: a block
round replaces every maximal block x^k (k >= 2) by one symbol, a pair round replaces the pairs xy in which x is
"left" and y "right" by one symbol, the side of a symbol being a hash bit of the symbol and the round. Equal pairs and
blocks get equal symbols throughout the slice, so equal symbols expand to equal words. Every level keeps, for each
of its symbols, the word position where it starts and where it ends.

LCE(i, j) walks both positions together: it climbs a level while the symbols that start at both are one symbol,
jumps over equal symbols, and descends where they differ; it stops where two single words differ. Backwards, the
same over the symbols that end at both positions. Because the parse of equal stretches agrees away from their ends,
a long extension takes a number of steps in the order of the levels, not of its length.

Candidates come from the harmonic grid: for each period q, the positions 0, q, 2q, ... whose word equals the word q
further, as do the next three words or the three before it. LCE forwards from (i, i + q) and backwards from
(i - 1, i + q - 1) give the whole stretch of period q around it; of candidates one period apart the first is asked
first, and those that its stretch holds are not asked. A stretch of length >= max(12, 2q) is a run. A run found under several periods is kept under
the least, which is its smallest period. Words of a run after its first q are dropped from the collapsed text.

Edge cases: a null text has no words (n_runs 0, four nulls, hashes of the empty text). A null doc_id counts as the
empty decimal text (crc32 0) for the planted period. Very long texts are processed whole, alone in their slice.
Repeated rows give a row each; an empty table gives none. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idloom.llm.tables import slices

# fixed values of the contract: word pattern, least run length
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LEAST = 12
#: a run of period q repeats at least max(12 - q, q) >= 6 words in a row, so of those around a grid position at least
#: AHEAD from it on or BEHIND before it; other candidates are not asked of the grammar
AHEAD, BEHIND = 4, 3
#: about so many grid positions are compared at a time
GRID = 1 << 20
#: bytes of text per grammar
SLICE_BYTES = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)

SCHEMA = ("doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


def words_of(doc_id: int | None, text: str | None) -> list[str]:
    """The words of ``text``, with the planted period of the contract applied."""
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def _codes(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Number of each pair (x, y): equal pairs have equal numbers, from 0 without gaps. Both hold numbers below 2^31."""
    return np.unique(x << np.int64(32) | y, return_inverse=True)[1].ravel()


class Grammar:
    """A run-length grammar of ``seq`` by recompression, with LCE queries over it."""

    def __init__(self, seq: np.ndarray):
        self.n = n = len(seq)
        starts, syms = np.arange(n, dtype=np.int64), seq.astype(np.int64)
        levels = [(starts, syms)]
        fresh = int(syms.max()) + 1 if n else 0
        turn = 0
        while len(syms) > 1:
            cut = np.flatnonzero(syms[1:] != syms[:-1]) + 1
            if len(cut) < len(syms) - 1:
                first = np.r_[0, cut]
                count = np.diff(np.r_[first, len(syms)])
                block = syms[first].copy()
                many = count > 1
                code = _codes(block[many], count[many])
                block[many] = fresh + code
                fresh += int(code.max()) + 1 if len(code) else 0
                starts, syms = starts[first], block
                levels.append((starts, syms))
            side = ((syms.astype(np.uint64) + np.uint64(turn + 1)) * _MIX >> np.uint64(61)) & np.uint64(1)
            join = np.flatnonzero((side[:-1] == 1) & (side[1:] == 0))
            turn += 1
            if len(join):
                code = _codes(syms[join], syms[join + 1])
                merged = syms.copy()
                merged[join] = fresh + code
                fresh += int(code.max()) + 1
                keep = np.ones(len(syms), bool)
                keep[join + 1] = False
                starts, syms = starts[keep], merged[keep]
                levels.append((starts, syms))
        self.top = len(levels) - 1
        lens = [np.diff(np.r_[s, n]) for s, _ in levels]
        self.starting = self._by_position([s for s, _ in levels], [y for _, y in levels], lens)
        self.ending = self._by_position([s + ln - 1 for (s, _), ln in zip(levels, lens)], [y for _, y in levels], lens)

    def _by_position(self, at: list[np.ndarray], syms: list[np.ndarray], lens: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """(first entry, number of levels, symbols, lengths) of the symbols at each position, by position, then level.

        A position that bounds a symbol bounds one on every lower level, so its levels are 0, 1, ... without gaps.
        """
        pos = np.concatenate(at)
        order = np.argsort(pos, kind="stable")
        count = np.bincount(pos, minlength=self.n)
        return np.cumsum(count) - count, count, np.concatenate(syms)[order], np.concatenate(lens)[order]

    def _at(self, table: tuple[np.ndarray, ...], level: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol, length) of the symbol of ``level`` that starts or ends at ``pos``, else (-1, 0)."""
        first, count, sym, length = table
        p = np.clip(pos, 0, self.n - 1)
        hit = (level < count[p]) & (pos == p)
        i = np.where(hit, first[p] + level, 0)
        return np.where(hit, sym[i], -1), np.where(hit, length[i], 0)

    def lce(self, a: np.ndarray, b: np.ndarray, backwards: bool = False) -> np.ndarray:
        """Number of equal words from a and b on (leftwards from them, if ``backwards``)."""
        keys = self.ending if backwards else self.starting
        step = -1 if backwards else 1
        a, b = a.astype(np.int64).copy(), b.astype(np.int64).copy()
        out = np.zeros(len(a), np.int64)
        level = np.zeros(len(a), np.int64)
        live = np.arange(len(a))
        while live.size:
            pa_, pb, lv = a[live], b[live], level[live]
            upper = np.minimum(lv + 1, self.top)
            ua, _ = self._at(keys, upper, pa_)
            ub, _ = self._at(keys, upper, pb)
            up = (lv < self.top) & (ua >= 0) & (ua == ub)
            ha, ln = self._at(keys, lv, pa_)
            hb, _ = self._at(keys, lv, pb)
            here = ~up & (ha >= 0) & (ha == hb)
            level[live[up]] += 1
            j = live[here]
            a[j] += step * ln[here]
            b[j] += step * ln[here]
            out[j] += ln[here]
            down = ~up & ~here
            level[live[down & (lv > 0)]] -= 1
            live = live[~(down & (lv == 0))]
        return out


def _grid(seq: np.ndarray, base: np.ndarray, lengths: np.ndarray):
    """Candidates (document, word, position, period) of the harmonic grid, by document, period and word, in bounded parts.

    Separators differ from everything, so no comparison that counts leaves the document.
    """
    half, last = lengths // 2, len(seq) - 1
    many = np.cumsum(half) // GRID
    for docs in np.split(np.arange(len(lengths)), np.flatnonzero(np.diff(many)) + 1):
        who = np.repeat(docs, half[docs])
        period = np.arange(len(who)) - np.repeat(np.cumsum(half[docs]) - half[docs], half[docs]) + 1
        per = (lengths[who] - period - 1) // period + 1
        block = np.cumsum(per) // GRID
        for some in np.split(np.arange(len(who)), np.flatnonzero(np.diff(block)) + 1):
            n = per[some]
            pair = np.repeat(some, n)
            q = period[pair]
            i = (np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)) * q
            pos = base[who[pair]] + i
            same = np.flatnonzero(seq[pos] == seq[pos + q])
            here, there = pos[same], (pos + q)[same]
            ahead, behind = np.ones(len(same), bool), np.ones(len(same), bool)
            for d in range(1, AHEAD):
                ahead &= seq[np.minimum(here + d, last)] == seq[np.minimum(there + d, last)]
            for d in range(1, BEHIND + 1):
                behind &= seq[np.maximum(here - d, 0)] == seq[np.maximum(there - d, 0)]
            same = same[ahead | behind]
            yield who[pair[same]], i[same], pos[same], q[same]


def runs_of_slice(docs: list[list[str]]) -> list[list[tuple[int, int, int]]]:
    """For each document (its words), its runs (start, length, period) by start, then period."""
    vocab: dict[str, int] = {}
    ids = [np.fromiter((vocab.setdefault(w, len(vocab)) for w in ws), np.int64, len(ws)) for ws in docs]
    sep = len(vocab)
    parts, base = [np.array([sep], np.int64)], []
    at = 1
    for k, x in enumerate(ids):
        base.append(at)
        parts += [x, np.array([sep + k + 1], np.int64)]
        at += len(x) + 1
    seq = np.concatenate(parts)
    lengths = np.array([len(x) for x in ids], np.int64)
    base = np.array(base, np.int64)
    grid = [c for c in _grid(seq, base, lengths) if len(c[0])]
    found: list[tuple[np.ndarray, ...]] = []
    if grid:
        # all periods' candidates at once; of a chain of them, one period apart, the first answers for its whole stretch
        grammar = Grammar(seq)
        doc, i, pos, period = (np.concatenate(c) for c in zip(*grid))
        head = np.r_[True, (pos[1:] - pos[:-1] != period[1:]) | (period[1:] != period[:-1])]
        chain = np.cumsum(head) - 1
        ahead = grammar.lce(pos[head], pos[head] + period[head])
        rest = ~head & (pos >= (pos[head] + ahead)[chain])
        more = grammar.lce(pos[rest], pos[rest] + period[rest])
        ask = np.flatnonzero(head | rest)
        ahead = np.concatenate([ahead, more])[np.argsort(np.r_[np.flatnonzero(head), np.flatnonzero(rest)])]
        doc, i, pos, period = doc[ask], i[ask], pos[ask], period[ask]
        behind = grammar.lce(pos - 1, pos + period - 1, backwards=True)
        length = ahead + behind + period
        ok = length >= np.maximum(LEAST, 2 * period)
        if ok.any():
            found.append((doc[ok], (i - behind)[ok], length[ok], period[ok]))
    out: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    if found:
        doc, start, length, period = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((period, length, start, doc))
        doc, start, length, period = doc[order], start[order], length[order], period[order]
        first = np.r_[True, (doc[1:] != doc[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])]
        for d, s, ln, p in zip(doc[first].tolist(), start[first].tolist(), length[first].tolist(), period[first].tolist()):
            out[d].append((s, ln, p))
        for r in out:
            r.sort(key=lambda x: (x[0], x[2]))
    return out


def summary(words: list[str], runs: list[tuple[int, int, int]]) -> tuple:
    """(n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of one document."""
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    drop = np.zeros(len(words) + 1, np.int64)
    for s, ln, p in runs:
        drop[s + p] += 1
        drop[s + ln] -= 1
    kept = np.cumsum(drop)[: len(words)] == 0
    listing = "".join(f"{s},{ln},{p}\n" for s, ln, p in runs)
    collapsed = " ".join(w for w, k in zip(words, kept.tolist()) if k)
    head = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None, None, None, None)
    return (len(runs), *head, hashlib.sha256(listing.encode()).hexdigest(), hashlib.sha256(collapsed.encode()).hexdigest())


def detect(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_runs, the longest run (start, length, period, exponent_milli), hashes."""
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches):
        for part in slices(batches, "text", SLICE_BYTES):
            ids, texts = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
            words = [words_of(i, t) for i, t in zip(ids, texts)]
            rows = [summary(w, r) for w, r in zip(words, runs_of_slice(words))]
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(w) for w in words], pa.int64())]
                + [pa.array(c, pa.int64()) for c in cols[:5]] + [pa.array(c, pa.string()) for c in cols[5:]],
                names=[f.split()[0] for f in SCHEMA.split(", ")])

    return source.mapInArrow(run, SCHEMA)
