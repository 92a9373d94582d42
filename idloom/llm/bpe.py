"""Byte-level BPE: frequent words through a minimal acyclic transducer, all others by exact merges.

A word here is what stands between two spaces, with the space before it; its ids are those of its
pre-tokens, one after the other. White-space runs in which a space is neither the first nor the last
character, and the special token, are the two cases in which a text does not fall apart at its spaces;
such texts are cut by the pre-tokenisation pattern itself.

``lexicon`` counts the words of a corpus with Spark and compiles the most frequent ones into an
automaton with shared prefixes and suffixes. Every transition holds how many words are passed over by
taking it; the sum along a word is its rank, and the rank addresses its ids. The arrays are written
to the shared folder and go to the executors as files, where tasks map them into memory.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idloom.llm.tables import slices
from idloom.session import cut, scratch

#: words longer than this are never in a lexicon and are merged one by one
LONG_WORD = 64
#: words whose ids a task remembers besides the lexicon; a slice of 4 MB alone may bring more than 150,000
CACHE_WORDS = 300_000

_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_SPLITS_ELSEWHERE = re.compile(f"[{_SPACE}] [{_SPACE}]|[{_SPACE}] \\Z")


def _ranges(kind: str) -> str:
    """A character class of all code points of a general category, as ranges."""
    codes = np.array([c for c in range(0x110000) if unicodedata.category(chr(c))[0] == kind])
    cuts = np.flatnonzero(np.diff(codes) > 1)
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(codes[np.r_[0, cuts + 1]], codes[np.r_[cuts, len(codes) - 1]]))


_pattern: list[re.Pattern] = []


def pattern() -> re.Pattern:
    """The pre-tokenisation pattern of byte-level BPE, with letters and numbers by general category."""
    if not _pattern:
        letter, number = _ranges("L"), _ranges("N")
        _pattern.append(re.compile(
            f"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^{_SPACE}{letter}{number}]+"
            f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"))
    return _pattern[0]


class Vocabulary:
    """Merges, ids and token bytes of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or spec.get("normalizer") or model.get("byte_fallback") or model.get("dropout"):
            raise ValueError(f"{path} is no plain byte-level BPE")
        vocab = model["vocab"]
        # bytes that print stand for themselves, the others for code points from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        to_char = {b: chr(b) for b in plain} | {
            b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        to_byte = {c: b for b, c in to_char.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        key = left << 32 | right
        order = np.argsort(key, kind="stable")
        self.pair, self.rank = key[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)  # by rank
        self.of_byte = np.array([vocab[to_char[b]] for b in range(256)], np.int64)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        token = {i: bytes(to_byte[c] for c in t) for t, i in vocab.items()}
        token |= {i: t.encode() for t, i in self.special.items()}
        size = max(token) + 1
        self.length = np.array([len(token.get(i, b"")) for i in range(size)], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(token.get(i, b"") for i in range(size)), np.uint8)
        self._rank_of: dict[int, int] = {}
        # rank of each pair of bytes, the first pairs of every pre-token
        self.byte_rank = self.ranks(np.repeat(self.of_byte, 256), np.tile(self.of_byte, 256)).astype(np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, the number of merges where a pair has none."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.rank[at], len(self.merged))

    def merge_long(self, piece: bytes) -> np.ndarray:
        """Ids of one pre-token of any length: a heap of pairs over a linked list."""
        if not self._rank_of:
            self._rank_of = dict(zip(self.pair.tolist(), self.rank.tolist()))
        ids = self.of_byte[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        get = self._rank_of.get
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := get(a << 32 | b)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.merged[rank]), -1
            after[i] = after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < len(ids) and (r := get(ids[x] << 32 | ids[y])) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return np.array([i for i in ids if i >= 0], np.uint32)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of many pre-tokens: all ids, where each one's start, how many there are.

        In every round each pre-token merges its leftmost pair of least rank.
        """
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        return self.merge_spans(np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(sizes) - sizes, sizes)

    def merge_spans(self, raw: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``merge`` of the pre-tokens that lie at ``first`` in the bytes ``raw``."""
        start, count = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        flat, done, none = [np.empty(0, np.uint32)], 0, len(self.merged)
        for i in np.flatnonzero(sizes > LONG_WORD):
            flat.append(self.merge_long(raw[first[i]:first[i] + sizes[i]].tobytes()))
            start[i], count[i] = done, len(flat[-1])
            done += len(flat[-1])
        for low, width in ((0, 6), (6, 9), (9, 12), (12, 16), (16, 24), (24, LONG_WORD)):
            which = np.flatnonzero((sizes > low) & (sizes <= width))
            for block in np.array_split(which, len(which) // 20_000 + 1):
                if not len(block):
                    continue
                size_of = sizes[block]
                inside = np.arange(width) < size_of[:, None]
                own_bytes = np.zeros((len(block), width), np.int32)
                own_bytes[inside] = raw[_spans(first[block], size_of)]
                ids = np.where(inside, self.of_byte[own_bytes], -1).astype(np.int32)
                rank = np.full((len(block), width), none, np.int32)
                rank[:, :-1] = np.where(inside[:, 1:], self.byte_rank[own_bytes[:, :-1] << 8 | own_bytes[:, 1:]], none)
                # tokens of a pre-token hang in a list: a merge takes the right one out, columns keep their places
                after = np.tile(np.arange(1, width + 1, dtype=np.int32), (len(block), 1))
                before = after - 2
                rows, open_rank = np.arange(len(block)), rank
                while True:
                    at = open_rank.argmin(1)
                    best = open_rank[np.arange(len(rows)), at]
                    go = np.flatnonzero(best < none)
                    if not len(go):
                        break
                    if len(go) < len(rows):
                        rows, at, best, open_rank = rows[go], at[go], best[go], open_rank[go]
                    k = np.arange(len(rows))
                    gone = after[rows, at]
                    right, left = after[rows, gone], before[rows, at]
                    token = self.merged[best]
                    ids[rows, at], ids[rows, gone] = token, -1
                    after[rows, at] = right
                    open_rank[k, at] = open_rank[k, gone] = none
                    on = np.flatnonzero(right < size_of[rows])
                    before[rows[on], right[on]] = at[on]
                    open_rank[on, at[on]] = self.ranks(token[on], ids[rows[on], right[on]])
                    on = np.flatnonzero(left >= 0)
                    open_rank[on, left[on]] = self.ranks(ids[rows[on], left[on]], token[on])
                n = (ids >= 0).sum(1)
                flat.append(ids[ids >= 0].astype(np.uint32))
                start[block], count[block] = done + np.cumsum(n) - n, n
                done += len(flat[-1])
        return np.concatenate(flat), start, count

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids; what is no UTF-8 comes out as replacement characters."""
        if not len(ids):
            return b""
        if int(ids.max()) >= len(self.length):
            raise ValueError("an id is not in the vocabulary")
        raw = self.bytes[_spans(self.start[ids], self.length[ids])].tobytes()
        return raw.decode("utf-8", "replace").encode()


def _spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions start .. start + length of all spans, one after the other."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(start - (ends - length), length)


# ---- the lexicon ---------------------------------------------------------------------------------

def compile_lexicon(words: list[bytes], ids: list[np.ndarray]) -> dict[str, np.ndarray]:
    """Minimal acyclic transducer of distinct words, each with its ids.

    Words are added in byte order; the part of the last word that the next one does not share is
    frozen, and a frozen state equal to an earlier one (same end flag, same transitions) is replaced by it.
    """
    order = sorted(range(len(words)), key=words.__getitem__)
    known: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []
    path: list[list] = [[False, {}]]  # end flag, byte -> state number

    def freeze(depth: int, last: bytes) -> None:
        while len(path) > depth:
            end, edges = path.pop()
            state = (end, tuple(edges.items()))
            number = known.setdefault(state, len(states))
            if number == len(states):
                states.append(state)
            if path:
                path[-1][1][last[len(path) - 1]] = number

    last = b""
    for i in order:
        word, common = words[i], 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        freeze(common + 1, last)
        path.extend([False, {}] for _ in word[common:])
        path[-1][0] = True
        last = word
    freeze(1, last)
    root_end, root_edges = path.pop()
    states.append((root_end, tuple(root_edges.items())))
    below = np.zeros(len(states), np.int64)  # words from a state on; children are numbered before parents
    edge_key, edge_to, edge_skip = [], [], []
    for s, (end, edges) in enumerate(states):
        passed = int(end)
        for byte, to in edges:
            edge_key.append(s << 8 | byte)
            edge_to.append(to)
            edge_skip.append(passed)
            passed += int(below[to])
        below[s] = passed
    sizes = np.array([len(ids[i]) for i in order], np.int64)
    return {
        "key": np.array(edge_key, np.int64), "to": np.array(edge_to, np.int64), "skip": np.array(edge_skip, np.int64),
        "end": np.array([e for e, _ in states], np.int64), "at": np.r_[0, np.cumsum(sizes)].astype(np.int64),
        "ids": np.concatenate([ids[i] for i in order]).astype(np.int64) if order else np.empty(0, np.int64)}


class Lexicon:
    """A compiled lexicon in one file of int64 words: array lengths, then the arrays, mapped into memory."""

    NAMES = ("key", "to", "skip", "end", "at", "ids")

    def __init__(self, path: str):
        whole = np.memmap(path, np.int64, "r")
        bounds = np.cumsum(np.r_[len(self.NAMES), whole[:len(self.NAMES)]])
        for name, a, b in zip(self.NAMES, bounds, bounds[1:]):
            setattr(self, name, whole[a:b])

    @classmethod
    def dump(cls, arrays: dict[str, np.ndarray]) -> bytes:
        head = np.array([len(arrays[n]) for n in cls.NAMES], np.int64)
        return b"".join(x.astype("<i8").tobytes() for x in (head, *(arrays[n] for n in cls.NAMES)))

    def find(self, words: pa.Array) -> np.ndarray:
        """Rank of each word, -1 if it is not in the lexicon; all words take their steps side by side."""
        raw, start, size = _buffers(words)
        rank = np.full(len(size), -1, np.int64)
        if not len(self.key):
            return rank
        open_ = np.flatnonzero((size > 0) & (size <= LONG_WORD))
        state = np.full(len(open_), len(self.end) - 1, np.int64)
        total = np.zeros(len(open_), np.int64)
        for step in range(LONG_WORD + 1):
            done = size[open_] == step
            final = done & (self.end[state] == 1)
            rank[open_[final]] = total[final]
            open_, state, total = open_[~done], state[~done], total[~done]
            if not len(open_):
                break
            key = state << 8 | raw[start[open_] + step]
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            on = self.key[at] == key
            open_, at = open_[on], at[on]
            state, total = self.to[at], total[on] + self.skip[at]
        return rank


def _buffers(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and sizes of a string array without nulls."""
    words = words.cast(pa.large_binary())
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1]
    return np.frombuffer(data or b"", np.uint8), at[:-1], np.diff(at)


def _pre_tokens(words: list[str]) -> tuple[list[str], np.ndarray]:
    """The pre-tokens of all words one after the other, and how many each word has.

    Words that begin with a space and end with something else are cut in one go: put together they are a text that
    falls apart at its spaces. The others are cut one by one. ``words`` is put into that order.
    """
    split = pattern().findall
    plain = [len(w) > 1 and w[0] == " " and not w[-1].isspace() for w in words]
    words[:] = [w for w, p in zip(words, plain) if p] + [w for w, p in zip(words, plain) if not p]
    n = sum(plain)
    found = split("".join(words[:n]))
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
    word_ends = np.cumsum(np.fromiter(map(len, words[:n]), np.int64, n))
    parts = np.diff(np.r_[0, np.searchsorted(ends, word_ends) + 1])
    alone = [split(w) for w in words[n:]]
    return found + [p for own in alone for p in own], np.r_[parts, np.array([len(own) for own in alone], np.int64)]


# ---- encoding ------------------------------------------------------------------------------------

class Encoder:
    """Ids of whole texts; one per task. ``lexicon`` is optional, the ids do not depend on it."""

    def __init__(self, path: str, lexicon: str | None = None):
        self.vocabulary = Vocabulary(path)
        self.lexicon = Lexicon(lexicon) if lexicon else None
        special = sorted(self.vocabulary.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self._reset()

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.start, self.size = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words without the lexicon: all ids known so far, where each word's start, how many there are."""
        if len(self.known) > CACHE_WORDS:
            self._reset()
        known = self.known
        new = [w for w in words if w not in known]
        if new:
            found, parts = _pre_tokens(new)
            pieces = pa.array(found, pa.large_string()).dictionary_encode()
            ids, start, size = self.vocabulary.merge_spans(*_buffers(pieces.dictionary))
            at = pieces.indices.to_numpy()
            ends = np.cumsum(parts)
            tokens = np.r_[0, np.cumsum(size[at])]
            total = tokens[ends] - tokens[ends - parts]
            known.update(zip(new, range(len(self.start), len(self.start) + len(new))))
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(total) - total])
            self.size = np.concatenate([self.size, total])
            self.flat = np.concatenate([self.flat, ids[_spans(start[at], size[at])]])
        which = np.array([known[w] for w in words], np.int64)
        return self.flat, self.start[which], self.size[which]

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of distinct words: all ids, where each word's ids start, how many there are."""
        n = len(words)
        start, size = np.zeros(n, np.int64), np.zeros(n, np.int64)
        rank = self.lexicon.find(words) if self.lexicon else np.full(n, -1)
        hit, miss = np.flatnonzero(rank >= 0), np.flatnonzero(rank < 0)
        flat, start[miss], size[miss] = self.words(words.take(pa.array(miss)).to_numpy(zero_copy_only=False).tolist())
        if not len(hit):
            return flat, start, size
        first = np.asarray(self.lexicon.at[rank[hit]])
        size[hit] = self.lexicon.at[rank[hit] + 1] - first
        own = np.asarray(self.lexicon.ids[_spans(first, size[hit])]).astype(np.uint32)
        start[hit] = len(flat) + np.cumsum(size[hit]) - size[hit]
        return np.concatenate([flat, own]), start, size

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids (unsigned 32 bit) of all texts one after the other, and the n + 1 offsets between them; null is empty."""
        texts = texts.cast(pa.string()).fill_null("")
        odd = np.zeros(len(texts), bool)
        if self.special:
            for t in self.vocabulary.special:
                odd |= pc.match_substring(texts, t).to_numpy(zero_copy_only=False)
        double = np.flatnonzero(pc.match_substring_regex(texts, r"[\t-\r \x{80}-\x{10ffff}] ([\t-\r \x{80}-\x{10ffff}]|\z)").to_numpy(zero_copy_only=False) & ~odd)
        for i in double:  # a coarse net that is cheap; the exact test runs on what it holds
            odd[i] = bool(_SPLITS_ELSEWHERE.search(texts[int(i)].as_py()))
        plain = np.flatnonzero(~odd)
        words = pc.split_pattern(texts.take(pa.array(plain)), " ")
        offsets = words.offsets.to_numpy().astype(np.int64)
        flat = words.flatten()
        # the first word of a text has no space before it
        heads = flat.take(pa.array(offsets[:-1] - offsets[0]))
        rest = flat.dictionary_encode()
        spaced = pc.binary_join_element_wise("", rest.dictionary, " ")
        head = heads.dictionary_encode()
        which = rest.indices.to_numpy().astype(np.int64)
        which[offsets[:-1] - offsets[0]] = len(spaced) + head.indices.to_numpy()
        table = pa.concat_arrays([spaced, head.dictionary])
        ids, start, size = self._distinct(table)
        # two equal strings, one as head and one spaced, are two entries with the same ids
        word_size = size[which]
        plain_ids = ids[_spans(start[which], word_size)]
        ends = np.r_[0, np.cumsum(word_size)][offsets - offsets[0]]
        if not odd.any():
            return plain_ids, ends
        parts: list[np.ndarray] = [np.empty(0, np.uint32)] * len(texts)
        for k, i in enumerate(plain):
            parts[i] = plain_ids[ends[k]:ends[k + 1]]
        for i in np.flatnonzero(odd):
            parts[i] = self._odd(texts[int(i)].as_py())
        return np.concatenate(parts), np.r_[0, np.cumsum([len(p) for p in parts])]

    def _odd(self, text: str) -> np.ndarray:
        """Ids of a text that has to be cut by the pattern: around special tokens, then into pre-tokens."""
        out = [np.empty(0, np.uint32)]
        for part in self.special.split(text) if self.special else [text]:
            if part in self.vocabulary.special:
                out.append(np.array([self.vocabulary.special[part]], np.uint32))
            elif part:
                pieces = pattern().findall(part)
                distinct = {p: i for i, p in enumerate(dict.fromkeys(pieces))}
                ids, start, size = self.vocabulary.merge([p.encode() for p in distinct])
                at = np.array([distinct[p] for p in pieces], np.int64)
                out.append(ids[_spans(start[at], size[at])])
        return np.concatenate(out)


# ---- on Spark ------------------------------------------------------------------------------------

def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) over all texts: counted batch by batch in the tasks, summed by Spark."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text", 8 << 20):
            words = pc.split_pattern(part.column("_text").drop_null(), " ").flatten()
            got = words.value_counts()
            yield pa.RecordBatch.from_arrays(
                [pc.binary_join_element_wise("", got.field("values"), " "), got.field("counts")], names=["word", "n"])

    counted = docs.select(F.col(f"`{text}`").cast("string").alias("_text")).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, size: int) -> list[str]:
    """The most frequent words of (word, n), at most ``size`` and each at least twice; words of one count class go together.

    A histogram of the counts says where to cut, so only these words come to the driver.
    """
    known = cut(counts.filter((F.octet_length("word") <= LONG_WORD) & (F.col("n") > 1)))
    grade = F.when(F.col("n") < 1000, F.col("n")).otherwise(1000 + F.floor(F.log(F.col("n") / 1000) / F.log(F.lit(1.01)))).cast("long")
    least, total = None, 0
    for r in known.groupBy(grade.alias("grade")).agg(F.count("*").alias("words")).orderBy(F.desc("grade")).collect():
        total += r["words"]
        if total > size:
            break
        least = r["grade"]
    return [] if least is None else [r["word"] for r in known.filter(grade >= least).select("word").collect()]


def lexicon(docs: DataFrame, path: str, size: int = 32768, text: str = "text") -> str:
    """Compile the most frequent words of all documents, ``size`` at most and of ``LONG_WORD`` bytes at most.

    Returns the name under which tasks find the file.
    """
    words = frequent(word_counts(docs, text), size)
    ids, start, size = Encoder(path).words(words)
    arrays = compile_lexicon([w.encode() for w in words], [ids[a:a + n] for a, n in zip(start, size)])
    return publish(docs.sparkSession, Lexicon.dump(arrays), "lexicon")


def publish(spark: SparkSession, content: bytes, name: str) -> str:
    """Write a file to the shared folder and have Spark hand it to every executor; returns its name there."""
    target = f"{scratch(spark, name)}.bin"
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(target)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    spark.sparkContext.addFile(target)
    return target.rsplit("/", 1)[1]


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, name: str | None = None) -> Encoder:
    """The encoder of this Python worker; tasks that follow each other share it."""
    if (path, name) not in _encoders:
        _encoders.clear()
        _encoders[path, name] = Encoder(path, SparkFiles.get(name) if name else None)
    return _encoders[path, name]
