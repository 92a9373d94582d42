"""Packing of tokenised documents into sequences by multiway number partitioning.

Each task packs the documents it reads, block by block. A block is a bounded number of tokens. Whole
windows inside a long document are sequences of their own; what is left of every document is halved a few
times, and Karmarkar-Karp differencing spreads the parts over the windows: it merges the two partial
partitions of largest spread, the fullest window of one with the emptiest of the other, until one
partition is left whose windows are near-equal. If one of them is over capacity, the partition is made
anew with one window more. Small documents that follow each other form one item, which bounds their number.

Tokens of a block that do not fill a window, and a slack of a few tokens a window for what the
differencing leaves unequal, are cut from the block's last documents and go to sequences of a power of
two, which need no padding.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from idloom.llm import bpe
from idloom.llm.tables import slices

#: windows of a block; how often the rest of a document is halved; tokens by which a window may miss its capacity.
#: The halves differ in size, and the small ones even out what the large ones leave.
BLOCK_WINDOWS, HALVINGS, SLACK = 64, 5, 6


def differencing(sizes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Window (0 to k - 1) of each item and the k sums, by largest-differencing with k-way partial partitions.

    Ties go to the partition that was made first, so equal input gives equal output.
    """
    n = len(sizes)
    follow, tail = np.full(n, -1), np.arange(n)  # items of one window hang in a list
    sums = {}
    heads = {}
    heap = []
    for i, s in enumerate(sizes.tolist()):
        v, h = np.zeros(k, np.int64), np.full(k, -1)
        v[-1], h[-1] = s, i
        sums[i], heads[i] = v, h
        heap.append((-s, i))
    heapq.heapify(heap)
    made = n
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        va, ha, vb, hb = sums.pop(a), heads.pop(a), sums.pop(b)[::-1], heads.pop(b)[::-1]
        both = (ha >= 0) & (hb >= 0)
        first, second = ha[both], hb[both]
        follow[tail[first]] = second
        tail[first] = tail[second]
        v, h = va + vb, np.where(ha >= 0, ha, hb)
        order = np.argsort(v, kind="stable")
        v, h = v[order], h[order]
        sums[made], heads[made] = v, h
        heapq.heappush(heap, (int(v[0] - v[-1]), made))
        made += 1
    where = np.zeros(n, np.int64)
    if not n:
        return where, np.zeros(k, np.int64)
    last = heap[0][1]
    for w, i in enumerate(heads[last].tolist()):
        while i >= 0:
            where[i] = w
            i = int(follow[i])
    return where, sums[last]


def pack_block(lengths: np.ndarray, window: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one block; every token is in exactly one piece."""
    pieces: list[tuple[int, int, int, int, int]] = []
    begin, end = np.zeros(len(lengths), np.int64), lengths.astype(np.int64)
    sequence = 0
    for d in np.flatnonzero(end >= window).tolist():
        for start in range(0, int(end[d]) - window + 1, window):
            pieces.append((d, start, window, sequence, 0))
            sequence += 1
            begin[d] = start + window
    total = int((end - begin).sum())
    k = max(0, (total - 1) // window)
    spare = total - k * (window - SLACK) if k else total
    d, room, offset = len(lengths) - 1, 0, 0
    while spare:
        if not room:
            room, offset, sequence = min(window, 1 << (spare.bit_length() - 1)), 0, sequence + 1
        while end[d] == begin[d]:
            d -= 1
        take = int(min(end[d] - begin[d], room))
        end[d] -= take
        pieces.append((d, int(end[d]), take, sequence - 1, offset))
        offset, room, spare = offset + take, room - take, spare - take
    items: list[list[tuple[int, int, int]]] = []  # (document, start, length) of what stays together
    small: list[tuple[int, int, int]] = []
    least = window // 32
    for d in np.flatnonzero(end > begin).tolist():
        a, n = int(begin[d]), int(end[d] - begin[d])
        if n < least:
            small.append((d, a, n))
            if sum(x[2] for x in small) >= least:
                items.append(small)
                small = []
            continue
        for _ in range(HALVINGS):
            items.append([(d, a, n - n // 2)])
            a, n = a + n - n // 2, n // 2
        if n:
            items.append([(d, a, n)])
    if small:
        items.append(small)
    if not items:
        return pieces
    size = np.array([sum(x[2] for x in item) for item in items])
    where, sums = differencing(size, k)
    while sums.max() > window:
        k += 1
        where, sums = differencing(size, k)
    used = np.zeros(k, np.int64)
    for item, w in zip(items, where.tolist()):
        for d, a, n in item:
            pieces.append((d, a, n, sequence + w, int(used[w])))
            used[w] += n
    return pieces


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int | None = 1, doc_id: str = "doc_id",
         text: str = "text", ids: bool = True) -> DataFrame:
    """One row per piece: the id, ``start`` (tokens of its document before it), ``length``, ``ids`` (the tokens
    themselves; with ``ids=False`` left out), ``ids_crc32``, ``doc_tokens``, ``sequence_id`` and ``offset``.

    Null and empty texts consist of the closing id alone (without one they have no piece). Repeated rows
    are documents of their own. A document may be cut anywhere; in its sequence a piece begins where
    the one before it ends. Only the task that reads a text sees it; nothing is shuffled. Sequence ids are
    made of the partition number and a count, so a task that runs again gives the same ones.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    added = ("start bigint, length bigint, " + "ids array<bigint>, " * ids
             + "ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint")

    def run(batches):
        coder = bpe.encoder(tokenizer)
        first = TaskContext.get().partitionId() << 33
        closing = np.array([] if end_id is None else [end_id], np.uint32)
        names, tokens, held = [], [], 0

        def flush():
            nonlocal first, names, tokens, held
            rows = pack_block(np.array([len(t) for t in tokens]), window)
            if rows:
                d, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*rows))
                spans = [tokens[i][a:a + n] for i, a, n in zip(d.tolist(), start.tolist(), length.tolist())]
                columns = [pa.concat_arrays(names).take(pa.array(d)), pa.array(start), pa.array(length)]
                if ids:
                    columns.append(pa.ListArray.from_arrays(
                        pa.array(np.r_[0, np.cumsum(length)], pa.int32()), pa.array(np.concatenate(spans).astype(np.int64))))
                columns += [pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in spans], pa.int64()),
                            pa.array(np.array([len(t) for t in tokens])[d]), pa.array(sequence + first), pa.array(offset)]
                yield pa.RecordBatch.from_arrays(columns, names=["_id", *[c.split()[0] for c in added.split(", ")]])
                first += int(sequence.max()) + 1
            names, tokens, held = [], [], 0

        for part in slices(batches, "_text"):
            flat, at = coder.encode(part.column("_text"))
            for i, (a, b) in enumerate(zip(at.tolist(), at[1:].tolist())):
                names.append(part.column("_id").slice(i, 1))
                tokens.append(np.concatenate([flat[a:b], closing]))
                held += b - a + len(closing)
                if held >= BLOCK_WINDOWS * window:
                    yield from flush()
        yield from flush()

    source = docs.select(docs[doc_id].alias("_id"), docs[text].cast("string").alias("_text"))
    return source.mapInArrow(run, f"_id {kind}, {added}").withColumnRenamed("_id", doc_id)
