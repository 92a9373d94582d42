"""Updates and merges against brute force."""

import random

import pytest
from pyspark.sql import functions as F
from test_matching import AS_OF, BLOCK, frame, plain, record

from idloom import schemas
from idloom.operators import merge as G

DOC = ("documenttypes", "document_number")


def components(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {x: find(x) for x in root}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, hot, seed):
    rnd = random.Random(seed)
    edges = [(f"r{rnd.randrange(80):02d}", f"r{rnd.randrange(80):02d}") for _ in range(60)]
    edges += [(f"c{i:02d}", f"c{i + 1:02d}") for i in rnd.sample(range(40), 40)]      # one long chain
    edges += [("hub", f"leaf{i:03d}") for i in range(150)] + [("self", "self")]
    df = spark.createDataFrame(edges, "uuid string, other_uuid string")
    want = components(edges)
    assert {r.uuid: r.component for r in G.merge_components(df).collect()} == want


def test_components_fail_loudly(spark):
    df = spark.createDataFrame([(f"c{i:03d}", f"c{i + 1:03d}") for i in range(200)], "uuid string, other_uuid string")
    with pytest.raises(RuntimeError):
        G.merge_components(df, max_rounds=1)


def fold(members):
    """First value per field; type and number together."""
    out = dict(members[0])
    for c in schemas.GOLDEN.fieldNames():
        out[c] = next((p[c] for p in members if p[c] is not None), None)
    doc = next((p for p in members if p["document_number"] is not None), members[0])
    out.update({c: doc[c] for c in DOC}, uuid=members[0]["uuid"],
               registered_via_mobile=any(p["registered_via_mobile"] for p in members),
               matching_locked=members[0]["matching_locked"])
    return out


def upsert_model(batch, det, patients):
    rows = {p["uuid"]: dict(p) for p in patients}
    stored = {(d["source"], d["hisnumber"]): d for d in det}
    good, changed, rejects = [], [], []
    for r in sorted(batch, key=lambda r: (r["source"], r["hisnumber"])):
        d = stored[r["source"], r["hisnumber"]]
        p = rows[d["uuid"]]
        if p["matching_locked"]:
            rejects.append((r["source"], r["hisnumber"]))
            continue
        good.append((d["uuid"], r))
        if any(r[c] != d[c] for c in DOC):
            changed.append((d["uuid"], r))
        p.update({c: r[c] for c in ("lastname", "name", "surname", "birthdate", *DOC)})
        x = "a" if r["source"] == 1 else "b"
        p.update({f"{g}_{x}": r[c] for c, g in BLOCK.items()})
    edges = []
    for doc in {tuple(r[c] for c in DOC) for _, r in changed if r["document_number"] is not None}:
        holders = [u for u, p in rows.items() if not p["matching_locked"] and tuple(p[c] for c in DOC) == doc]
        edges += [(holders[0], h) for h in holders]
    pairs = {}
    groups = {}
    for u, c in components(edges).items():
        groups.setdefault(c, []).append(u)
    for members in groups.values():
        if len(members) == 1:
            continue
        best = min(members, key=lambda u: (not rows[u]["registered_via_mobile"], u))
        losers = sorted(set(members) - {best})
        merged = fold([rows[best], *[rows[u] for u in losers]])
        for u, r in changed:
            if u in members:
                x = "a" if r["source"] == 1 else "b"
                merged.update({f"{g}_{x}": r[c] for c, g in BLOCK.items()})
        for u in losers:
            pairs[u] = best
            del rows[u]
        rows[best] = merged
    return rows, pairs, rejects, good, changed


def known_world(seed, n=90):
    rnd = random.Random(seed)
    patients, det, batch = [], [], []
    for i in range(n):
        p = {c: None for c in schemas.GOLDEN.fieldNames()}
        p.update(uuid=f"u{i:03d}", documenttypes=1, document_number=100 + i, lastname=f"l{i}", primary_source=1,
                 registered_via_mobile=rnd.random() < 0.2, matching_locked=rnd.random() < 0.1)
        for s, x in ((1, "a"), (2, "b")):
            for k in range(rnd.choice([0, 1, 1, 2])):
                r = dict(record(rnd, f"{i}-{s}-{k}", n), source=s, documenttypes=1, document_number=100 + i)
                p.update({f"{g}_{x}": r[c] for c, g in BLOCK.items()})
                det.append(dict(r, uuid=p["uuid"]))
                if rnd.random() < 0.6:
                    # a third of the updates take one placeholder document, some another person's, some none
                    number = rnd.choice([7, 7, 100 + rnd.randrange(n), 100 + i, None])
                    batch.append(dict(record(rnd, f"{i}-{s}-{k}", n), source=s, documenttypes=1, document_number=number))
        patients.append(p)
    return patients, det, batch


@pytest.mark.parametrize("seed", [1, 2])
def test_upserts_and_merges_equal_model(spark, hot, seed):
    patients, det, batch = known_world(seed)
    rows, pairs, rejects, good, changed = upsert_model(batch, det, patients)
    assert pairs and rejects
    out, got_pairs = G.upsert_known(frame(spark, batch, schemas.RECORD), frame(spark, det, schemas.DET),
                                    frame(spark, patients, schemas.GOLDEN), schemas.empty(spark, schemas.MOBILE), AS_OF)
    assert {r.loser: r.survivor for r in got_pairs.collect()} == pairs
    assert plain(out.golden) == plain(frame(spark, list(rows.values()), schemas.GOLDEN))
    assert sorted((r.source, r.hisnumber) for r in out.rejects.collect()) == sorted(rejects)
    assert sorted((r.source, r.hisnumber, r.uuid) for r in out.assigned.collect()) == sorted(
        (r["source"], r["hisnumber"], pairs.get(u, u)) for u, r in good)
    log = out.log.groupBy("match_type").count().collect()
    merged = set(pairs) | set(pairs.values())
    want = {"UPDATED_EXISTING": len(good), "MERGED_ON_UPDATE": len(pairs),
            "REGULAR_UPDATE": sum(u not in merged for u, _ in changed)}
    assert {r["match_type"]: r["count"] for r in log} == {k: v for k, v in want.items() if v}


def test_manual_merges_follow_chains_and_reject_circles(spark, hot):
    names = "abcdefghij"
    patients = [dict({c: None for c in schemas.GOLDEN.fieldNames()}, uuid=u, registered_via_mobile=u == "a", matching_locked=False,
                     lastname=f"l{u}" if u not in "ce" else None, document_number=ord(u) if u in "ab" else None,
                     documenttypes=1, hisnumber_a=u if u in "bd" else None) for u in names]
    # a -> b -> c, d -> c; g <-> h is a circle and i runs into it; x and y are unknown
    asked = [("a", "b"), ("b", "c"), ("d", "c"), ("g", "h"), ("h", "g"), ("i", "g"), ("x", "a"), ("j", "y")]
    det = [dict(record(random.Random(0), u, 9), source=1, uuid=u) for u in names]
    protocols = spark.createDataFrame([(i, u) for i, u in enumerate(names * 3)], "id int, uuid string")
    out = G.manual_merge(spark.createDataFrame(asked, "source_uuid string, target_uuid string"), frame(spark, patients, schemas.GOLDEN),
                         frame(spark, det, schemas.DET), protocols, AS_OF)
    got = {r.uuid: r for r in out["patients"].collect()}
    assert sorted(got) == list("cefghij")
    # depth first (b and d before a), then uuid
    assert (got["c"].lastname, got["c"].document_number, got["c"].hisnumber_a, got["c"].registered_via_mobile) == ("lb", ord("b"), "b", True)
    assert {r.source_uuid: r.reject_reason for r in out["rejects"].collect()} == {
        "g": "CIRCLE", "h": "CIRCLE", "i": "CIRCLE", "x": "NOT_FOUND", "j": "NOT_FOUND"}
    assert out["det"].filter("uuid = 'c'").count() == 4 and out["protocols"].filter("uuid IN ('a', 'b', 'd')").count() == 0
    assert sorted(r.hisnumber for r in out["log"].collect()) == ["MERGE:a->b", "MERGE:b->c", "MERGE:d->c"]


def test_long_chain_of_manual_merges(spark):
    uuids = [f"u{i:02d}" for i in range(30)]
    patients = frame(spark, [{"uuid": u} for u in uuids], schemas.GOLDEN)
    asked = spark.createDataFrame(list(zip(uuids, uuids[1:])), "source_uuid string, target_uuid string")
    got = {r.source_uuid: (r.survivor, r.depth) for r in G.merge_targets(asked, patients).collect()}
    assert got == {u: ("u29", 29 - i) for i, u in enumerate(uuids[:-1])}


def test_registrations_of_losers_are_folded(spark):
    mobile = frame(spark, [{"uuid": "a", "hisnumber_a": "1", "hisnumber_b": None}, {"uuid": "b", "hisnumber_a": "2", "hisnumber_b": "3"},
                           {"uuid": "z", "hisnumber_a": "9", "hisnumber_b": None}], schemas.MOBILE)
    pairs = spark.createDataFrame([("b", "a")], "loser string, survivor string")
    assert sorted(tuple(r) for r in G.repoint_mobile(pairs, mobile).collect()) == [("a", "1", "3"), ("z", "9", None)]


def test_locked_documents_do_not_move(spark):
    patients = frame(spark, [{"uuid": "a", "documenttypes": 1, "document_number": 5, "matching_locked": True},
                             {"uuid": "b", "documenttypes": 1, "document_number": 6, "matching_locked": False}], schemas.GOLDEN)
    updates = spark.createDataFrame([("a", 1, 6), ("b", 1, 6)], "uuid string, documenttypes int, document_number long")
    changed = G.changed_documents(updates, patients)
    assert [(r.uuid, r.reject_reason) for r in changed.collect()] == [("a", "LOCKED")]
    after = G.apply_documents(changed, patients)
    assert {r.uuid: r.document_number for r in after.collect()} == {"a": 5, "b": 6}
    assert G.merge_pairs(changed, after).filter(F.col("uuid") == "a").count() == 0
