"""Rendezvous shards against a brute-force version in Python."""

import math
import struct
import zlib
from collections import defaultdict

import xxhash

from idloom.llm import sharding


def unit(key, shard):
    h = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), seed=42)
    h = xxhash.xxh64_intdigest(struct.pack("<q", shard), seed=h)
    return ((h >> 11) + 0.5) / 2.0 ** 53


def brute(rows, weights, grown_weight=1.0):
    def winner(key, ws):
        return max(range(len(ws)), key=lambda s: (ws[s] / -math.log(unit(key, s)), -s))

    out = []
    for key, text in rows:
        body = (text or "").encode()
        out.append([key, len(body) + 1, zlib.crc32(body), "key", winner(key, weights), None, winner(key, weights + [grown_weight])])
    by = defaultdict(list)
    for r in out:
        by[r[4]].append(r)
    for rs in by.values():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[1]))
        for i, r in enumerate(rs):
            r[5] = i
    return sorted((tuple(r) for r in out), key=nulls_first)


def nulls_first(row):
    return tuple((x is not None, x) for x in row)


def test_shards_equal_brute_force(spark):
    rows = [(i, "word " * (i % 7)) for i in range(300)] + [(5, "word " * 5)] * 40 + [(None, None), (None, "x"), (7, None), (8, "é" * 3000)]
    docs = spark.createDataFrame([(k, t, 1, 2) for k, t in rows], "doc_id long, text string, shard int, _pos long")
    weights = [1.0, 2.0, 0.5, 1.0]
    got = sorted((tuple(r) for r in sharding.shard(docs, shards=4, weights=weights).collect()), key=nulls_first)
    assert got == brute(rows, weights)
    moved = [r for r in got if r[6] != r[4]]
    assert moved and all(r[6] == 4 for r in moved)


def test_hot_key_and_empty(spark):
    rows = [(1, "same")] * 500 + [(i, str(i)) for i in range(2, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = sharding.shard(docs).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sharding.shard(docs.limit(0)).count() == 0
