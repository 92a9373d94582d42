"""Periodic runs against scanning every period directly, and the grammar's LCE against plain comparison."""

import random

import numpy as np
import pyarrow.parquet as pq

from conftest import SF
from idloom.llm import periodic


def brute_runs(words):
    """For each period, the maximal stretches where words q apart are equal; the least period of each stretch."""
    n, found = len(words), {}
    ids = np.array([hash(w) for w in words])
    for q in range(1, n // 2 + 1):
        eq = np.r_[ids[:-q] == ids[q:], False] if n > q else np.array([False])
        k = 0
        while k < len(eq):
            if eq[k]:
                e = k
                while e < len(eq) and eq[e]:
                    e += 1
                length = e - k + q
                if length >= max(12, 2 * q):
                    found.setdefault((k, length), q)
                k = e
            else:
                k += 1
    return sorted(((s, ln, q) for (s, ln), q in found.items()), key=lambda r: (r[0], r[2]))


def test_lce_equals_plain_comparison():
    rng = random.Random(1)
    seq = np.array([rng.choice([0, 1, 2]) for _ in range(3000)] + [5] * 40 + [0, 1] * 300, np.int64)
    g = periodic.Grammar(seq)
    a = np.array([rng.randrange(len(seq)) for _ in range(500)])
    b = np.array([rng.randrange(len(seq)) for _ in range(500)])

    def plain(i, j, d):
        t = 0
        while 0 <= i + d * t < len(seq) and 0 <= j + d * t < len(seq) and seq[i + d * t] == seq[j + d * t]:
            t += 1
        return t
    assert g.lce(a, b).tolist() == [plain(i, j, 1) for i, j in zip(a, b)]
    assert g.lce(a, b, backwards=True).tolist() == [plain(i, j, -1) for i, j in zip(a, b)]


def test_runs_equal_brute_force():
    rng = random.Random(7)
    docs = []
    for k in range(60):
        vocab = [f"w{i}" for i in range(rng.randint(1, 6))]
        ws = [rng.choice(vocab) for _ in range(rng.randint(0, 300))]
        if k % 3 == 0 and ws:
            a = rng.randrange(len(ws))
            p = rng.randint(1, 40)
            ws = ws[:a] + [ws[a + (i - a) % p] if a + (i - a) % p < len(ws) else "z" for i in range(a, len(ws) + 3 * p)]
        docs.append(ws)
    assert periodic.runs_of_slice(docs) == [brute_runs(ws) for ws in docs]
    assert periodic.runs_of_slice([[]]) == [[]]


def test_query_equals_brute_force_on_whole_table(spark):
    import hashlib
    from idloom.llm import queries
    got = {r.doc_id: r for r in queries.queries()["op12_periodic_runs"](spark, SF).collect()}
    table = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    assert len(got) == len(table)
    planted = 0
    for row in table:
        words = periodic.words_of(row["doc_id"], row["text"])
        runs = brute_runs(words)
        r = got[row["doc_id"]]
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{ln},{p}\n" for s, ln, p in runs).encode()).hexdigest()
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert (r.start, r.length, r.period) == (best or (None, None, None))
        planted += bool(runs)
    assert planted


def test_nulls_and_edges(spark):
    docs = spark.createDataFrame([(1, None), (None, "a"), (3, ""), (4, "x " * 50), (4, "x " * 50)], "doc_id long, text string")
    rows = sorted(periodic.detect(docs.withColumn("period", docs.doc_id)).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    empty = hashlib_empty()
    assert rows[1].n_runs == 0 and rows[1].start is None and rows[1].runs_sha256 == empty and rows[1].collapsed_sha256 == empty
    assert rows[3].n_runs == 1 and (rows[3].start, rows[3].length, rows[3].period, rows[3].exponent_milli) == (0, 50, 1, 50000)
    assert rows[3] == rows[4]
    assert periodic.detect(docs.limit(0)).count() == 0


def hashlib_empty():
    import hashlib
    return hashlib.sha256(b"").hexdigest()


def test_repeats_that_are_no_runs_and_many_periods():
    assert periodic.runs_of_slice([["a", "b", "a", "b"]]) == [[]]  # candidates, but no run in the whole slice
    near = "a b c d x a b c d y".split()
    assert periodic.runs_of_slice([near, near]) == [[], []]
    rng = random.Random(11)
    docs = [["x"] * 900, list("xxy") * 200 + ["z"] * 70 + list("xxy") * 90, ["u"] * 5 + ["v"] * 12 + ["u"] * 12 + ["v"] * 5]
    for _ in range(20):  # stretches of one period side by side
        words = []
        for _ in range(12):
            words += [rng.choice("abc") for _ in range(rng.randint(1, 4))] * rng.randint(2, 9) + ["s"] * rng.randint(0, 2)
        docs.append(words)
    assert periodic.runs_of_slice(docs) == [brute_runs(ws) for ws in docs]


def test_grid_in_small_parts(monkeypatch):
    rng = random.Random(5)
    docs = [[rng.choice("ab") for _ in range(rng.randint(0, 80))] for _ in range(40)]
    whole = periodic.runs_of_slice(docs)
    monkeypatch.setattr(periodic, "GRID", 50)
    assert periodic.runs_of_slice(docs) == whole == [brute_runs(ws) for ws in docs]
