"""The set-based ladder against a model that takes one record after the other."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from idloom import schemas
from idloom.operators import matching as M

BLOCK = {"hisnumber": "hisnumber", "email": "email", "telephone": "telephone", "his_password": "password", "login_email": "login"}
AS_OF = "2024-01-31 00:00:00"


class Model:
    """Golden rows as dicts; ``add`` takes a record through the priorities."""

    def __init__(self, patients, mobile):
        self.rows = {p["uuid"]: dict(p) for p in patients}
        self.by_mobile = {(s, m[f"hisnumber_{x}"]): m["uuid"] for m in mobile for s, x in ((1, "a"), (2, "b")) if m[f"hisnumber_{x}"]}
        self.by_number = {(s, p[f"hisnumber_{x}"]): p["uuid"] for p in patients for s, x in ((1, "a"), (2, "b")) if p[f"hisnumber_{x}"]}

    def run(self, batch):
        def rank(r):
            k = (r["source"], r["hisnumber"])
            return (0 if k in self.by_mobile or k in self.by_number else 1, *k)
        return [self.add(r) for r in sorted(batch, key=rank)]

    def add(self, r):
        key = (r["source"], r["hisnumber"])
        m, held = self.by_mobile.get(key), self.by_number.get(key)
        before = {u: p for u, p in self.rows.items()}
        if any(u in before and before[u]["matching_locked"] for u in (m, held) if u):
            return (*key, None, "LOCKED")
        if m and held and m != held:
            return (*key, None, "NUMBER_TAKEN")
        if m:
            kind = "MOBILE_APP_UPDATE" if m in self.rows else "MOBILE_APP_NEW"
            p = self.rows.setdefault(m, self.blank(m, mobile=True))
            self.fill(p, r, doc=True)
        elif held:
            kind, p = "UPDATED_EXISTING", self.rows[held]
            self.fill(p, r, doc=True, primary=False)
        elif r["document_number"] is None or r["documenttypes"] is None:
            kind, p = "NEW_NO_DOCUMENT", self.create(r)
            self.fill(p, r)
        else:
            owners = [u for u, p in self.rows.items() if not p["matching_locked"]
                      and (p["documenttypes"], p["document_number"]) == (r["documenttypes"], r["document_number"])]
            if owners:
                kind, p = "MATCHED_DOCUMENT", self.rows[min(owners, key=lambda u: (not self.rows[u]["registered_via_mobile"], u))]
                self.fill(p, r)
            else:
                kind, p = "NEW_WITH_DOCUMENT", self.create(r)
                self.fill(p, r, doc=True)
        return (*key, p["uuid"], kind)

    def blank(self, uuid, mobile=False):
        p = {f: None for f in schemas.GOLDEN.fieldNames()}
        p.update(uuid=uuid, registered_via_mobile=mobile, matching_locked=False)
        return p

    def create(self, r):
        u = hashlib.md5(f"p|{r['source']}|{r['hisnumber']}".encode()).hexdigest()
        return self.rows.setdefault(u, self.blank(u))

    @staticmethod
    def fill(p, r, doc=False, primary=True):
        x = "a" if r["source"] == 1 else "b"
        for c, g in BLOCK.items():
            p[f"{g}_{x}"] = r[c]
        gaps = ["lastname", "name", "surname"] + (["documenttypes", "document_number"] if doc else [])
        for c in gaps:
            p[c] = r[c] if p[c] is None else p[c]
        if primary and p["primary_source"] is None:
            p["primary_source"] = r["source"]


def record(rnd, i, docs):
    pick = lambda c, n: rnd.choice([None, *[f"{c}{k}" for k in range(n)]])
    number = None if rnd.random() < 0.1 else rnd.randrange(docs)
    return {"hisnumber": f"{i}", "source": rnd.choice([1, 2]), "businessunit": 1, "lastname": pick("l", 9), "name": pick("n", 5),
            "surname": pick("s", 5), "birthdate": None, "documenttypes": rnd.choice([1, 1, 1, 3]), "document_number": number,
            "email": pick("e", 9), "telephone": pick("t", 9), "his_password": pick("p", 3), "login_email": pick("g", 9)}


def world(seed, n=120):
    """Three batches, registrations, and a share of records with one placeholder document."""
    rnd = random.Random(seed)
    numbers = list(range(3 * n))
    rnd.shuffle(numbers)
    batches = []
    for b in range(3):
        batch = [record(rnd, i, n) for i in numbers[b * n:(b + 1) * n]]
        for r in batch:
            if rnd.random() < 0.3:
                r["documenttypes"], r["document_number"] = 1, 0
        batches.append(batch)
    mobile = [{"uuid": f"m{k:03d}", "hisnumber_a": str(a) if rnd.random() < 0.8 else None, "hisnumber_b": str(b)}
              for k, (a, b) in enumerate(zip(rnd.sample(range(3 * n), 30), rnd.sample(range(3 * n), 30)))]
    return rnd, batches, mobile


def frame(spark, rows, schema):
    return spark.createDataFrame([tuple(r.get(c) for c in schema.fieldNames()) for r in rows], schema)


def plain(df, schema=schemas.GOLDEN):
    return sorted((tuple(str(r[c]) for c in schema.fieldNames()) for r in df.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_ladder_equals_model_over_growing_store(spark, hot, seed):
    rnd, batches, mobile = world(seed)
    patients = []
    for i, batch in enumerate(batches):
        if i == 2:  # number changes hands: known numbers come again under new keys
            batch = batch + [dict(record(rnd, 0, 50), hisnumber=p["hisnumber_a"], source=1) for p in patients[::9] if p["hisnumber_a"]]
        model = Model(patients, mobile)
        want = sorted(str(x) for x in model.run(batch))
        out = M.resolve(frame(spark, batch, schemas.RECORD), frame(spark, mobile, schemas.MOBILE),
                        frame(spark, patients, schemas.GOLDEN), AS_OF)
        got = [(r.source, r.hisnumber, r.matched_patient_uuid, r.match_type) for r in out.log.collect()]
        got += [(r.source, r.hisnumber, None, r.reject_reason) for r in out.rejects.collect()]
        assert sorted(map(str, got)) == want
        assert plain(out.golden) == plain(frame(spark, list(model.rows.values()), schemas.GOLDEN))
        patients = [r.asDict() for r in out.golden.collect()]
        for p in patients:
            if rnd.random() < 0.12:
                p["matching_locked"] = True


def test_result_is_the_same_on_a_retry(spark):
    _, batches, mobile = world(5)
    args = (frame(spark, batches[0], schemas.RECORD), frame(spark, mobile, schemas.MOBILE), schemas.empty(spark, schemas.GOLDEN), AS_OF)
    assert plain(M.resolve(*args).golden) == plain(M.resolve(*args).golden)


def test_lock_and_unlock(spark):
    patients = frame(spark, [{"uuid": u, "matching_locked": False} for u in "abc"], schemas.GOLDEN)
    asked = spark.createDataFrame([("a", "why"), ("zz", None)], "uuid string, reason string")
    locked = M.lock_matching(patients, asked, True, AS_OF)
    r = locked.filter("uuid = 'a'").first()
    assert (r.matching_locked, str(r.matching_locked_at), r.matching_locked_reason) == (True, AS_OF, "why")
    assert {x.uuid: x.found for x in M.lock_outcome(asked, patients).collect()} == {"a": True, "zz": False}
    freed = M.lock_matching(locked, asked, False, AS_OF).filter("uuid = 'a'").first()
    assert (freed.matching_locked, freed.matching_locked_at, freed.matching_locked_reason) == (False, None, None)
    assert locked.filter(F.col("matching_locked")).count() == 1
