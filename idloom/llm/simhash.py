"""SimHash near-dedup: 64-bit fingerprints of word shingles, neighbours found in BK-trees.

Fingerprints within ``radius`` bits agree in some of their blocks, so each one is filed under a few keys
(block choice, bits of those blocks) and only fingerprints of one key are compared. In a key, shards of
bounded size become BK-trees: every child hangs on its parent by the Hamming distance to it, and a search
follows only edges whose distance is within the radius of its own distance to the parent. A key with
more fingerprints than a shard holds has several trees, and each shard's members go to every tree once.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idloom.llm.links import components, stars
from idloom.llm.tables import annotate
from idloom.session import cut

SEED = 42
_ROWS = 1 << 16
#: pairs of query and tree node that a search may have open at a time
VISITS = 2_000_000


def fingerprint(text: str | None, words: int = 3) -> int:
    """SimHash of a whole text; 0 if it has no word. A to Z count as lower case, shingles with repeats."""
    own = (text or "").encode("utf-8", "replace").lower().split()
    if not own:
        return 0
    whole = b" ".join(own)
    if len(own) <= words:
        return xxhash.xxh64_intdigest(whole, SEED)
    size = np.fromiter(map(len, own), np.int64, len(own))
    start = np.cumsum(size + 1) - size - 1
    end = (start + size)[words - 1:]
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    bounds = list(zip(start.tolist(), end.tolist()))
    for i in range(0, len(bounds), _ROWS):
        h = np.array([digest(whole[a:b], SEED) for a, b in bounds[i:i + _ROWS]], ">u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(bounds)).tobytes(), "big")


# ---- BK-trees ------------------------------------------------------------------------------------

class Forest:
    """BK-trees of many groups, built and searched side by side.

    ``group`` is ascending. The first row of a group is its root. In each step the first row of every
    pending set becomes a node, and the rest of the set is divided by the distance to it.
    """

    def __init__(self, group: np.ndarray, code: np.ndarray):
        n = len(group)
        self.row = np.empty(n, np.int64)  # the row behind each node
        self.child_key = np.empty(n, np.int64)  # parent * 65 + distance; ascending, roots come first
        pending, key = np.arange(n), group - group[-1] - 2 if n else group  # roots: below every child key
        made = 0
        while len(pending):
            first = np.r_[True, key[1:] != key[:-1]]
            nodes = pending[first]
            self.row[made:made + len(nodes)] = nodes
            self.child_key[made:made + len(nodes)] = key[first]
            parent = made + np.cumsum(first) - 1
            made += len(nodes)
            rest, parent = pending[~first], parent[~first]
            key = parent * 65 + np.bitwise_count(code[rest] ^ code[self.row[parent]])
            order = np.argsort(key, kind="stable")
            pending, key = rest[order], key[order]
        self.code = code[self.row]
        self.groups = group[self.row]
        self.roots = int((self.child_key < 0).sum()) if n else 0

    def search(self, group: np.ndarray, code: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, tree row) of all pairs of one group within ``radius``; queries of groups without a tree find nothing."""
        root = np.minimum(np.searchsorted(self.groups[:self.roots], group), max(self.roots - 1, 0))
        if not self.roots:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        query = np.flatnonzero(self.groups[root] == group)
        node = root[query]
        found = []
        while len(query):
            far = np.bitwise_count(code[query] ^ self.code[node]).astype(np.int64)
            hit = far <= radius
            found.append((query[hit], self.row[node[hit]]))
            low = np.searchsorted(self.child_key, node * 65 + np.maximum(far - radius, 0))
            n = np.searchsorted(self.child_key, node * 65 + np.minimum(far + radius, 64), "right") - low
            query = np.repeat(query, n)
            node = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 2


def _linked(group: np.ndarray, tree: np.ndarray, query: np.ndarray, code: np.ndarray, radius: int) -> np.ndarray:
    """Label of each row after joining all links of the groups; ``tree`` and ``query`` mark the rows of either side."""
    own = np.flatnonzero(tree)
    forest = Forest(group[own], code[own])
    asked = np.flatnonzero(query)
    per = np.diff(np.searchsorted(group[own], np.arange(group[-1] + 2)))[group[asked]]  # tree size of each query
    a, b = [], []
    block = np.cumsum(per) // VISITS
    for part in np.split(asked, np.flatnonzero(np.diff(block)) + 1):
        q, t = forest.search(group[part], code[part], radius)
        q, t = part[q], own[t]
        a.append(q[q != t])
        b.append(t[q != t])
    return stars(len(group), np.concatenate(a), np.concatenate(b))


def block_masks(radius: int, blocks: int) -> list[int]:
    """Masks of all choices of ``blocks - radius`` of the blocks: codes within the radius agree under one of them."""
    if not radius < blocks <= 64:
        raise ValueError("more blocks than the radius are needed")
    edge = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edge, edge[1:])]
    return [sum(c) for c in combinations(masks, blocks - radius)]


def links(codes: DataFrame, radius: int, blocks: int, shard: int) -> DataFrame:
    """(code, other): star edges that join all distinct codes within ``radius`` bits, directly or by steps."""
    def signed(x: int) -> int:
        return x - (1 << 64) if x >> 63 else x

    keyed = codes.select("code", F.posexplode(F.array(*[
        F.col("code").bitwiseAND(F.lit(signed(m))) for m in block_masks(radius, blocks)])).alias("choice", "bits"))
    sizes = keyed.groupBy("choice", "bits").agg(F.count("*").alias("n")).filter("n > 1")
    # a key of many codes has several trees; pair (i, j) is tree i searched by the members of shard j
    spread = keyed.join(sizes, ["choice", "bits"]).withColumn("parts", F.ceil(F.col("n") / shard)).withColumn(
        "own", F.pmod(F.xxhash64("code", "choice"), F.col("parts"))).withColumn(
        "met", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).select(
        "choice", "bits", F.least("own", "met").alias("i"), F.greatest("own", "met").alias("j"), "own", "code")
    key = ["choice", "bits", "i", "j"]
    ready = spread.repartition(*key).sortWithinPartitions(*key)

    def run(batches):
        left: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if left is None else pa.concat_tables([left, table])
            keys = np.stack([table[c].to_numpy() for c in key])
            new = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            cut_at = int(new[-1]) if len(new) else 0  # the last key may go on in the next batch
            left = table.slice(cut_at)
            yield from joined(table.slice(0, cut_at), keys[:, :cut_at])
        if left is not None:
            yield from joined(left, np.stack([left[c].to_numpy() for c in key]))

    def joined(table, keys):
        if not len(table):
            return
        group = np.cumsum(np.r_[0, (keys[:, 1:] != keys[:, :-1]).any(0)])
        own, code = table["own"].to_numpy(), table["code"].to_numpy().view(np.uint64)
        label = _linked(group, own == keys[2], own == keys[3], code, radius)
        moved = np.flatnonzero(label != np.arange(len(label)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(code[moved].view(np.int64)), pa.array(code[label[moved]].view(np.int64))], names=["code", "other"])

    return ready.mapInArrow(run, "code long, other long")


def _codes(texts: pa.Array, words: int):
    yield pa.array(np.array([fingerprint(t, words) for t in texts.to_pylist()], np.uint64).view(np.int64))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """(doc_id, code): the fingerprint of each whole text as a signed long; texts without words have 0."""
    return annotate(docs, text, "code bigint", lambda texts: _codes(texts, words), [doc_id])


def _named(found: DataFrame, doc_id: str, radius: int, blocks: int, shard: int) -> DataFrame:
    """(code, component_id) of all fingerprints in ``found``."""
    codes = cut(found.groupBy("code").agg(F.min(doc_id).alias("first")))
    edges = cut(links(codes.select("code"), radius, blocks, shard))
    parts = components(edges, "code", "other", "code")
    linked = cut(codes.join(parts, "code"))
    least = linked.groupBy("component").agg(F.min("first").alias("component_id"))
    moved = linked.select("code", "component").join(least, "component").select("code", "component_id")
    return codes.join(moved, "code", "left").select("code", F.coalesce("component_id", "first").alias("component_id"))


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, radius: int = 3,
           blocks: int = 5, shard: int = 1024) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs``: the least id reachable by links.

    Equal fingerprints are one node, so copies cost a count and no links. No text, null or empty, or one
    without words has fingerprint zero and is linked like any other. Repeated rows get a row each. Null
    ids name no component; one that has no other ids is null.
    """
    found = cut(fingerprints(docs, doc_id, text, words))
    named = _named(found, doc_id, radius, blocks, shard)
    return found.join(named, "code").select(
        doc_id, F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, radius: int = 3,
                    blocks: int = 5, shard: int = 1024) -> DataFrame:
    """One row of each group of ``docs``, columns unchanged: the one of least id, once if its id is repeated.

    A group all of whose ids are null keeps a row of each fingerprint.
    """
    found = cut(fingerprints(docs, doc_id, text, words))
    named = cut(_named(found, doc_id, radius, blocks, shard))
    kept = named.filter("component_id IS NOT NULL").select(F.col("component_id").alias("_kept")).distinct()
    chosen = docs.join(kept, docs[doc_id] == F.col("_kept"), "left_semi").dropDuplicates([doc_id])
    nameless = docs.filter(docs[doc_id].isNull())
    marked = annotate(nameless, text, "_code bigint", lambda texts: _codes(texts, words), nameless.columns)
    alone = named.filter("component_id IS NULL").select(F.col("code").alias("_code"))
    return chosen.unionByName(marked.join(alone, "_code", "left_semi").dropDuplicates(["_code"]).select(*docs.columns))
