"""Default batch ids: what a replay is, and what has to run again."""

import pytest
from test_matching import AS_OF

from idloom.plans import pipelines as P
from idloom.sources.store import Change, Store


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"), buckets=4)


def test_an_export_that_goes_back_is_taken_again(spark, store):
    def sync(last, **options):
        lines = spark.createDataFrame([(0, f"1/A|{last}|N|S|19900101|16|45|1|e@x|8 900|login")], "line_no long, line string")
        P.pipeline_sync_a({"lines": lines}, store, AS_OF, **options)
        return store.read("det").first().lastname

    assert sync("a", changed=True) == "a" and sync("b") == "a"
    assert sync("b", changed=True) == "b"  # the same lines were read without it before
    assert sync("a", changed=True) == "a"
    version = store.version()
    assert sync("a", changed=True) == "a" and store.version() == version


def test_a_load_with_rejects_runs_again_on_a_changed_store(spark, store, monkeypatch):
    clients = spark.range(1, 4).selectExpr("id AS pcode", "7 AS filial", "'L' AS lastname", "CAST(NULL AS STRING) AS firstname", "'M' AS midname",
                                           "DATE '1990-01-01' AS bdate", "99 AS pasptype", "'1-2' AS paspser", "CAST(id AS STRING) AS paspnum")
    split = P.C.split_rejects

    def refuse(staged):
        good, rejects = split(staged)
        return good.filter("hisnumber <> '2'"), rejects.unionByName(good.filter("hisnumber = '2'").selectExpr(
            *[c if c in good.columns else f"'LOCKED' AS {c}" for c in rejects.columns]))

    monkeypatch.setattr(P.C, "split_rejects", refuse)
    P.pipeline_initial_load({"clients": clients}, store, AS_OF)
    assert store.read("det").count() == 2
    monkeypatch.setattr(P.C, "split_rejects", split)
    P.pipeline_initial_load({"clients": clients}, store, AS_OF)  # nothing has changed: a replay
    assert store.version() == 1
    store.commit("unlocked", det=Change(store.read("det").limit(0)))
    P.pipeline_initial_load({"clients": clients}, store, AS_OF)
    assert store.read("det").count() == 3
