"""Joins under skew, registration, lookups, constraints, statistics: small cases and brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from idloom import schemas
from idloom.operators import lookups as J
from idloom.operators import quality as Q
from idloom.operators import registration as R
from idloom.operators import stats as A
from idloom.operators.skew import attach, attach_by, lookup, salted


def test_joins_with_a_hot_key_lose_and_double_nothing(spark, hot):
    rnd = random.Random(3)
    keys = [rnd.choice(["hot"] * 6 + [None] * 2 + [f"k{i}" for i in range(12)]) for _ in range(400)]
    left = spark.createDataFrame(list(enumerate(keys)), "id int, k string")
    right = spark.createDataFrame([(k, f"v-{k}") for k in sorted({k for k in keys if k} - {"k3"})], "k string, v string")
    want = sorted((i, k or "", f"v-{k}" if k and k != "k3" else "") for i, k in enumerate(keys))

    def rows(df):
        return sorted((r.id, r.k or "", r.v or "") for r in df.collect())
    counts = left.groupBy("k").agg(F.count("*").alias("n"))
    assert rows(attach(left, right.join(counts, "k"), ["k"], "n")) == want
    assert rows(lookup(left, right, ["k"])) == want
    assert rows(attach_by(left, right, "k")) == want
    assert rows(salted(left, right, ["k"])) == want


def test_balanced_keys_are_joined_once(spark, monkeypatch):
    left = spark.createDataFrame([(i, f"k{i % 5}" if i % 7 else None) for i in range(40)], "id int, k string")
    right = spark.createDataFrame([(f"k{i}", i) for i in range(3)], "k string, v int")
    joins, join = [], type(left).join
    monkeypatch.setattr(type(left), "join", lambda *a, **more: joins.append(1) or join(*a, **more))
    got = salted(left, right, ["k"])
    assert len(joins) == 1
    assert sorted((r.id, r.v) for r in got.filter("v IS NOT NULL").collect()) == [
        (i, i % 5) for i in range(40) if i % 7 and i % 5 < 3] and got.count() == 40


def test_null_safe_attach(spark, hot):
    left = spark.createDataFrame([(i, "a", None if i % 2 else "x") for i in range(9)], "id int, p string, q string")
    groups = left.groupBy("p", "q").agg(F.count("*").alias("n"))
    assert {(r.q, r.n) for r in attach(left, groups, ["p", "q"], "n", null_safe=True).collect()} == {(None, 4), ("x", 5)}


@pytest.mark.parametrize("a, b, accepted", [("A", "B", True), ("A", None, True), (None, "B", True), (None, None, False), ("", "", False)])
def test_registration_policy(spark, a, b, accepted):
    asked = spark.createDataFrame([(1, a, b)], "request_id long, hisnumber_a string, hisnumber_b string")
    none = schemas.empty(spark, schemas.MOBILE)
    ok, rejects = R.mobile_register(asked, none)
    assert (ok.count(), rejects.count()) == ((1, 0) if accepted else (0, 1))
    ok, rejects = R.mobile_register(asked, none, require_both=True)
    assert ok.count() == (1 if a and b else 0)
    assert R.mobile_register(asked, none, enabled=False)[1].first().reject_reason == "DISABLED"


def test_registrations_in_request_order(spark, hot):
    rnd = random.Random(5)
    asked = [(i, rnd.choice([None, *[f"A{k}" for k in range(25)]]), rnd.choice([None, "B0", *[f"B{k}" for k in range(25)]])) for i in range(80)]
    mobile = [("m", "A1", "B2")]
    taken, want = {"A1", "B2"}, set()
    for i, a, b in asked:
        numbers = {x for x in (a, b) if x}
        if numbers and not numbers & taken:
            want.add(i)
            taken |= numbers
    ok, rejects = R.mobile_register(spark.createDataFrame(asked, "request_id long, hisnumber_a string, hisnumber_b string"),
                                    spark.createDataFrame(mobile, schemas.MOBILE))
    assert {r.request_id for r in ok.collect()} == want
    assert sorted(r.request_id for r in rejects.collect()) == sorted(set(range(80)) - want)


def test_one_source_number_update(spark):
    mobile = spark.createDataFrame([("u", "1", "2")], schemas.MOBILE)
    new = spark.createDataFrame([(1, "u", "7"), (2, "u", "8"), (3, "zz", "9")], "request_id int, uuid string, hisnumber string")
    assert [tuple(r) for r in R.mobile_update_number(mobile, new, 2).collect()] == [("u", "1", "8")]


def test_credentials_brute_force(spark, hot):
    rnd = random.Random(7)
    people = [{"uuid": f"u{i:02d}", "lastname": rnd.choice("XY"), "name": rnd.choice("PQ"), "surname": rnd.choice([None, "", "M"]),
               "login_a": rnd.choice([None, "l1", "l2"]), "password_a": rnd.choice(["p", "q"]), "login_b": rnd.choice([None, "l1", "l3"]),
               "password_b": rnd.choice(["p", "q"])} for i in range(40)]
    asked = [(i, rnd.choice("XYZ"), rnd.choice("PQ"), rnd.choice([None, "", "M", "N"]), rnd.choice(["1990-01-15", "1990-1-15", "bad"]),
              rnd.choice(["l1", "l2", "l3", "l9"]), rnd.choice(["p", "q", "z"])) for i in range(120)]
    frame = spark.createDataFrame([tuple(p.values()) for p in people], "uuid string, lastname string, name string, surname string, "
                                  "login_a string, password_a string, login_b string, password_b string").withColumn("birthdate", F.lit("1990-01-15").cast("date"))
    requests = spark.createDataFrame(asked, "request_id int, lastname string, firstname string, midname string, bdate string, cllogin string, clpassword string")
    want = {}
    for i, last, first, mid, born, login, pw in asked:
        hits = [p["uuid"] for p in people if (p["login_a"], p["password_a"]) == (login, pw) or (p["login_b"], p["password_b"]) == (login, pw)]
        if not hits and born != "bad":
            hits = [p["uuid"] for p in people if (p["lastname"], p["name"]) == (last, first) and p["surname"] == (mid or None)]
        want[i] = min(hits, default=None)
    assert {r.request_id: r.uuid for r in J.find_by_credentials(requests, frame).collect()} == want


def test_similar_ids(spark):
    ids = spark.createDataFrame([(f"{i}/A{i % 3}",) for i in range(300)], "hisnumber string")
    asked = spark.createDataFrame([("12/A1",), ("7",), ("zzz",)], "hisnumber string")
    got = {}
    for r in J.similar_ids(asked, ids, 20).orderBy("rank").collect():
        got.setdefault(r.hisnumber, []).append(r.similar_id)
    every = [f"{i}/A{i % 3}" for i in range(300)]
    assert got == {"12/A1": sorted(x for x in every if "12" in x)[:20], "7": sorted(x for x in every if "7" in x)[:20]}
    assert J.similar_ids(asked.filter("false"), ids).count() == 0


def test_similar_ids_broadcasts_no_pieces(spark):
    ids = spark.createDataFrame([(f"{i}/A{i % 3}",) for i in range(300)], "hisnumber string")
    asked = spark.createDataFrame([("12/A1",), ("7",)], "hisnumber string")
    found = J.similar_ids(asked, ids)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[n#\d+, gram#\d+\]", plan) and not re.search(r"BroadcastHashJoin \[n#\d+, gram#\d+\]", plan)


def test_unique_keys_fold_copies(spark, hot):
    df = spark.createDataFrame([("a", 1)] * 5 + [("a", 2)] * 3 + [("b", 1)] + [(None, 1)] * 4, "k string, v int")
    got = {(r.k, r.v): (r.n_kept, r.n_rejected) for r in Q.check_unique_keys(df, ["k"]).collect()}
    assert got == {("a", 1): (1, 4), ("a", 2): (0, 3), ("b", 1): (1, 0), (None, 1): (4, 0)}


def test_duplicate_lists_are_bounded(spark, hot):
    people = spark.createDataFrame([(f"u{i:03d}", 1, 7 if i < 50 else i) for i in range(80)], "uuid string, documenttypes int, document_number long")
    members = A.dup_by_document(people)
    assert members.count() == 50
    lists = A.duplicate_lists(members, chunk=10).collect()
    assert sum(len(r.uuids) for r in lists) == 50 and len(lists) == 5 and {r.patient_count for r in lists} == {50}


def test_statistics_of_empty_tables(spark):
    mobile = schemas.empty(spark, schemas.MOBILE)
    assert tuple(A.mobile_stats(mobile).first()) == (0, 0, 0, 0)
    det, clients = schemas.empty(spark, schemas.DET), spark.createDataFrame([], "hisnumber string")
    r = A.completion_rate(clients, det, 2).first()
    assert (r.source_count, r.rate, r.is_complete) == (0, 0.0, True)
    assert A.null_document_share(det).first().percent is None
    assert A.processing_progress(clients, clients).first().percent == 0.0


def test_mobile_counts(spark):
    rows = [(f"u{i}", "a" if i < 130 else None, "b" if i < 100 or i >= 130 else None) for i in range(150)]
    assert tuple(A.mobile_stats(spark.createDataFrame(rows, schemas.MOBILE)).first()) == (150, 100, 30, 20)


def test_sample_is_stable(spark):
    df = spark.range(100).selectExpr("CAST(id AS STRING) AS hisnumber", "1 AS source", "CAST(NULL AS INT) AS documenttypes", "1L AS document_number")
    one, two = (A.sample_rows(df.repartition(n), 10, 3, ["source", "hisnumber"], True).collect() for n in (1, 7))
    assert one == two and len(one) == 10
