"""SimHash groups, embedding near-duplicates and nearest neighbours against brute force."""

import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from compare import connect, difference
from conftest import SF

from idloom.llm import hashing, links, multiindex, queries, simhash

LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LETTERS))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


class Union(dict):
    def find(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self[b] = a


def brute_groups(rows):
    """(id, text) -> id: (fingerprint, least id reachable)."""
    code = {i: brute_fingerprint(t) for i, t in rows}
    union = Union()
    ids = sorted(code)
    for x, a in enumerate(ids):
        union.find(a)
        for b in ids[:x]:
            if (code[a] ^ code[b]).bit_count() <= 3:
                union.join(a, b)
    return {i: (f"{code[i]:016x}", union.find(i)) for i in ids}


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one TWO", "a b c", "A b\u00a0c d É é x\x1cy", "x " * 3000, "İ ẞ ǅ words here"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def random_codes(rng, n):
    base = rng.integers(0, 2**63, n, dtype=np.uint64)
    near = [b ^ np.uint64(sum(1 << int(x) for x in rng.choice(64, int(rng.integers(1, 7)), replace=False))) for b in base for _ in range(12)]
    return np.unique(np.concatenate([base, np.array(near, np.uint64)]))


@pytest.mark.parametrize("radius", [0, 1, 3, 8])
def test_bk_search_finds_exactly_what_is_near(radius):
    rng = np.random.default_rng(radius)
    code = random_codes(rng, 25)
    group = np.sort(rng.integers(0, 5, len(code)))
    tree = rng.random(len(code)) < 0.7
    forest = simhash.Forest(group[tree], code[tree])
    q, t = forest.search(group, code, radius)
    own = np.flatnonzero(tree)
    want = {(i, j) for i in range(len(code)) for j in own.tolist() if group[i] == group[j] and int(code[i] ^ code[j]).bit_count() <= radius}
    assert len(q) == len(want) and set(zip(q.tolist(), own[t].tolist())) == want
    # every child's key is its distance to the parent
    for key, c in zip(forest.child_key.tolist(), forest.code):
        if key >= 0:
            assert key % 65 == int(c ^ forest.code[key // 65]).bit_count()


@pytest.mark.parametrize("blocks", [4, 5, 6])
@pytest.mark.parametrize("shard", [4, 1000])
def test_links_join_all_near_codes(spark, blocks, shard):
    code = random_codes(np.random.default_rng(9), 15)
    codes = spark.createDataFrame([(int(c),) for c in code.view(np.int64)], "code long")
    union = Union()
    for r in simhash.links(codes, 3, blocks, shard).collect():
        assert r.code != r.other
        union.join(r.code, r.other)
    want = Union()
    for i, a in enumerate(code):
        for b in code[:i]:
            if int(a ^ b).bit_count() <= 3:
                want.join(int(a.view(np.int64)), int(b.view(np.int64)))
    assert all(union.find(int(c)) == want.find(int(c)) for c in code.view(np.int64))


def test_stars_are_components():
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 200, 150), rng.integers(0, 200, 150)
    union = Union()
    for x, y in zip(a.tolist(), b.tolist()):
        union.join(x, y)
    assert links.stars(200, a, b).tolist() == [union.find(i) for i in range(200)]


def test_simhash_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op5_simhash_bktree"](spark, SF).collect()}
    assert got == brute_groups(rows)
    assert len({g for _, g in got.values()}) < len(got)


def test_simhash_on_odd_rows(spark):
    long = "some words of a very long text " * 20000
    rows = [(3, None, 1), (4, "", 2), (4, "", 2), (5, " \t", 3), (8, long, 4), (7, long + "end", 5), (9, "alone here now", 6), (None, "alone here now", 7),
            (None, "nobody knows this one", 8), (None, "nobody knows this one", 9), (2, "AlonE here now", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, code long")
    got = [(r.doc_id, r.component_id) for r in simhash.groups(docs).collect()]
    assert sorted(got, key=str) == sorted([(3, 3), (4, 3), (4, 3), (5, 3), (8, 7), (7, 7), (9, 2), (None, 2), (None, None), (None, None), (2, 2)], key=str)
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == [2, 3, 7, None]
    assert simhash.groups(docs.limit(0)).collect() == [] and simhash.representatives(docs.limit(0)).collect() == []


# ---- embeddings ----------------------------------------------------------------------------------

def clustered(rng, n=60, copies=8, noise=0.02, d=16):
    base = rng.normal(size=(n, d))
    base /= np.linalg.norm(base, axis=1)[:, None]
    return np.concatenate([base] + [base + noise * rng.normal(size=base.shape) for _ in range(copies)]).astype(np.float32)


def brute_links(rows, threshold=0.93):
    union, n = Union(), defaultdict(int)
    ok = [(i, np.array(v, np.float64), lab) for i, v, lab in rows
          if lab is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    for i, v, lab in ok:
        for j, w, other in ok:
            if i < j and lab == other and v @ w / np.sqrt((v @ v) * (w @ w)) >= threshold:
                n[i] += 1
                n[j] += 1
                union.join(i, j)
    return {i: (n[i], union.find(i), union.find(i) == i) for i, _, _ in rows}


@pytest.mark.parametrize("shard", [7, 512])
def test_near_duplicate_vectors(spark, shard):
    rng = np.random.default_rng(2)
    x = clustered(rng)
    x[100:140] = x[100]  # copies
    order = rng.permutation(len(x))
    rows = [(int(i), x[k].tolist(), int(k % 60 % 3)) for i, k in enumerate(order)]
    rows += [(1000, None, 1), (1001, [0.0] * 16, 1), (1002, [float("nan")] * 16, 1), (1003, x[0].tolist(), None), (1004, [None] * 16, 1),
             (1005, [float("inf")] + [0.0] * 15, 2), (1006, [1.0, 2.0], 2)]
    df = spark.createDataFrame([(*r, 7) for r in rows], "vec_id long, embedding array<float>, label int, first int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in multiindex.near_duplicates(df, words=6, shard=shard).collect()}
    want = brute_links(rows[:-1])
    want[1006] = (0, 1006, True)
    assert got == want


def test_recall_near_the_threshold():
    """The share of neighbours at exactly the threshold that one side or the other visits."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    grid = multiindex.fit(x[:2000], 0.93)
    x = x[2000:]
    side = rng.normal(size=x.shape)
    side -= (side * x).sum(1)[:, None] * x
    y = 0.93 * x + np.sqrt(1 - 0.93**2) * side / np.linalg.norm(side, axis=1)[:, None]
    (own_x, see_x), (own_y, see_y) = grid.visits(x), grid.visits(y)
    met = [b in s or a in t for a, s, b, t in zip(own_x, see_x, own_y, see_y)]
    assert np.mean(met) >= 0.98
    assert all(s[0] == a and len(set(s.tolist())) == len(s) for a, s in zip(own_x, see_x))
    assert np.mean([len(s) for s in see_x]) < 0.25 * multiindex.WORDS**2


def test_vector_queries_on_odd_tables(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert multiindex.near_duplicates(empty).collect() == []
    assert hashing.nearest(empty, empty).collect() == []
    same = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 2), (None, [1.0, 0.0], 1)], empty.schema)
    got = sorted(map(tuple, multiindex.near_duplicates(same).collect()), key=str)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (2, 0, 2, True), (None, 2, 1, True)], key=str)


def test_near_duplicate_query(spark):
    assert difference(queries.QUERIES["op2_embedding_dedup"](spark, SF), connect(SF), queries.ORACLE["op2_embedding_dedup"]) is None


def brute_nearest(ids, x, asked, k):
    out = {}
    for q in asked:
        score = x @ x[ids.index(q)]
        found = sorted(((-s, i) for s, i in zip(score.tolist(), ids) if i != q))[:k]
        out[q] = [(i, -s) for s, i in found]
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in want])


def answers(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_probing_retrieves_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 256, (300, 4), dtype=np.uint8)
    asked = codes[:40] ^ (1 << rng.integers(0, 8, (40, 4))).astype(np.uint8)
    far = np.bitwise_count(asked[:, None] ^ codes).sum(2)
    for radius in (0, 3, 4, 9, 17, 32):
        got = hashing.Shard(codes).probe(asked, radius)
        assert ((got <= radius) == (far <= radius)).all() and (got[got <= radius] == far[got <= radius]).all()


@pytest.mark.parametrize("shard", [150, 4096])
def test_search_with_unequal_norms_ties_and_odd_rows(spark, shard):
    rng = np.random.default_rng(5)
    x = clustered(rng, 50, 9, 0.2, 24).astype(np.float64) * rng.uniform(0.2, 3, 500)[:, None]
    x[40:60] = x[40]
    x = x.astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(600, None), (620, [0.0] * 24), (640, [float("nan")] * 24), (None, x[0].tolist())]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rank int")
    got = answers(hashing.nearest(df, df.filter("vec_id % 20 = 0"), k=20, shard=shard))
    want = brute_nearest(list(range(500)), x.astype(np.float64), range(0, 500, 20), 20)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.95
    for q, found in got.items():
        for i, s in found:
            assert s == pytest.approx(float(x[q].astype(np.float64) @ x[i].astype(np.float64)), rel=1e-12)
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
    few = answers(hashing.nearest(df.filter("vec_id < 10"), df.filter("vec_id = 0"), k=20))
    assert len(few[0]) == 9


def test_search_query_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows], np.float64)
    got = answers(queries.QUERIES["op9_multi_index_hashing"](spark, sf))
    want = brute_nearest(ids, x, [i for i in ids if i % 20 == 0], 20)
    assert set(got) == set(want) and recall(got, want) >= 0.93
