"""Snapshots, pipelines, streams."""

import pytest
from pyspark.sql import functions as F
from test_matching import AS_OF, plain

from idloom import schemas
from idloom.plans import pipelines as P
from idloom.sources import source_b
from idloom.sources.store import Change, CommitConflict, Store
from idloom.streaming import streams as ST
from idloom.streaming.state import newest_changes

DELTA = schemas.DELTA.simpleString()[len("struct<"):-1].replace(":", " ")


def changes(spark, rows):
    return spark.createDataFrame([(s, p, f"2024-01-01 00:{m:02d}:00", op, done, last, "F", "m@x") for s, p, m, op, done, last in rows],
                                 "seq long, pcode long, change_time string, operation string, processed string, lastname string, firstname string, clmail string"
                                 ).withColumn("change_time", F.col("change_time").cast("timestamp_ntz")).select(*schemas.DELTA.fieldNames())


ROWS = [(1, 1, 1, "INSERT", "N", "a"), (2, 2, 2, "INSERT", "N", "b"), (3, 1, 3, "update", "N", "c"), (4, 3, 4, "TOUCH", "N", "d"),
        (5, 2, 5, "DELETE", "N", "e"), (6, 4, 6, "UPDATE", "Y", "f"), (7, 5, 1, "INSERT", "N", "g"), (8, 5, 1, "UPDATE", "N", "h")]


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"), buckets=4)


def test_commits_are_versions_and_replays_are_skipped(spark, store):
    assert store.version() == 0 and store.read("det").count() == 0
    one = spark.createDataFrame([("u1", None, "1")], schemas.MOBILE)
    assert store.commit("b1", mobile=one) == 1
    assert store.commit("b1", mobile=one.union(one)) == 1
    assert store.commit("b2", det=spark.createDataFrame([("9", 1)], "hisnumber string, source int")) == 2
    assert store.read("mobile").count() == 1 and store.read("det").first().hisnumber == "9"


def test_log_only_shows_committed_versions(spark, store):
    entry = spark.createDataFrame([("1", 1, "X")], "hisnumber string, source int, match_type string")
    store.commit("b1", matching_log=entry)
    store.commit("b2", matching_log=entry)
    store._append("matching_log", entry, "died-before-its-manifest")
    assert store.read("matching_log").count() == 2
    store.commit("b3", matching_log=entry)
    assert store.read("matching_log").count() == 3 and store.snapshot().of_batch("matching_log", "b2").count() == 1


def test_of_two_writers_on_one_version_the_second_is_told(spark, store):
    one = spark.createDataFrame([("u1", None, "1")], schemas.MOBILE)
    store.commit("seed", mobile=one)
    base = store.snapshot()
    store.commit("b1", base, mobile=Change(spark.createDataFrame([("u2", None, "2")], schemas.MOBILE)))
    with pytest.raises(CommitConflict):
        store.commit("b2", base, mobile=Change(spark.createDataFrame([("u3", None, "3")], schemas.MOBILE)))
    assert {r.uuid for r in store.read("mobile").collect()} == {"u1", "u2"} and not store.has_batch("b2")


def test_a_pipeline_builds_again_after_a_conflict(spark, store):
    seen = []

    def build(base):
        seen.append(base.version)
        if len(seen) == 1:   # another writer is faster
            store.commit("other", mobile=spark.createDataFrame([("u1", None, "1")], schemas.MOBILE))
        empty = schemas.empty(spark, schemas.LOG)
        return {"mobile": Change(spark.createDataFrame([("u2", None, "2")], schemas.MOBILE)), "matching_log": empty, "rejects": empty}
    P._commit(store, "mine", build)
    assert seen == [0, 1] and store.read("mobile").count() == 2


def test_a_small_change_writes_few_buckets(spark, store):
    rows = [(f"u{i}", None, str(i)) for i in range(200)]
    store.commit("seed", mobile=spark.createDataFrame(rows, schemas.MOBILE))
    before = store.snapshot().tables["mobile"]
    store.commit("one", mobile=Change(spark.createDataFrame([("u7", "x", "7")], schemas.MOBILE), gone=spark.createDataFrame([("u8",)], "uuid string")))
    after = store.snapshot().tables["mobile"]
    assert len(before) == store.buckets and 1 <= sum(before[b] != after[b] for b in before) <= 2
    assert plain(store.read("mobile"), schemas.MOBILE) == plain(
        spark.createDataFrame([r for r in rows if r[0] not in ("u7", "u8")] + [("u7", "x", "7")], schemas.MOBILE), schemas.MOBILE)
    assert store.vacuum(keep=1) == 0 or store.read("mobile").count() == 199
    store.commit("none", mobile=Change(schemas.empty(spark, schemas.MOBILE), gone=spark.createDataFrame([(f"u{i}",) for i in range(200)], "uuid string")))
    assert store.read("mobile").count() == 0


def test_delta_pipeline_routes_operations(spark, store):
    out = P.pipeline_delta_b({"delta": changes(spark, ROWS)}, store, AS_OF, "d1")
    assert {(r.hisnumber, r.lastname) for r in store.read("det").collect()} == {("1", "c"), ("5", "h")}
    assert {r.match_type for r in out.log.collect()} == {"NEW_NO_DOCUMENT"}
    assert [r.hisnumber for r in P.delete_requests(changes(spark, ROWS)).collect()] == ["2"]
    # an insert without a number leaves the document type open, an update writes what the record says
    def state():
        return plain(store.read("patients").withColumn("documenttypes", F.lit(None))), plain(store.read("det"), schemas.DET)
    before = state()
    P.pipeline_delta_b({"delta": changes(spark, ROWS)}, store, AS_OF, "d1")
    assert store.version() == 1
    # the same changes under another id are no newer than what was applied
    P.pipeline_delta_b({"delta": changes(spark, ROWS)}, store, AS_OF, "d2")
    assert state() == before and store.read("matching_log").count() == 2
    later = [(s + 10, p, m + 10, *rest) for s, p, m, *rest in ROWS]
    P.pipeline_delta_b({"delta": changes(spark, later)}, store, AS_OF, "d3")
    assert state() == before
    assert {r.documenttypes for r in store.read("patients").collect()} == {1}
    assert store.read("matching_log").count() == 4


def test_initial_load_resumes(spark, store):
    def clients(n):
        return spark.range(n).selectExpr("id AS pcode", "7 AS filial", "'L' AS lastname", "CAST(NULL AS STRING) AS firstname", "'M' AS midname",
                                         "DATE '1990-01-01' AS bdate", "99 AS pasptype", "'1-2' AS paspser", "CAST(id % 3 AS STRING) AS paspnum")
    P.pipeline_initial_load({"clients": clients(10)}, store, AS_OF, batch_id="i1")
    assert store.read("det").count() == 9 and store.read("patients").count() == 3
    out = P.pipeline_initial_load({"clients": clients(15)}, store, AS_OF, batch_id="i2")
    assert out.log.filter("match_type = 'MATCHED_DOCUMENT'").count() == 5
    assert store.read("det").count() == 14 and store.read("patients").count() == 3
    control = spark.createDataFrame([], "source int, last_sync timestamp_ntz")
    assert P.route_sync_mode(source_b.scan_source_b(clients(15)), store.read("det"), control, 2).first()["mode"] == "SET_SYNC_TIME"
    assert P.route_sync_mode(source_b.scan_source_b(clients(90)), store.read("det"), control, 2).first()["mode"] == "INITIAL_LOAD"


def test_loads_without_a_batch_id_are_told_apart_by_their_rows(spark, store):
    def clients(n):
        return spark.range(n).selectExpr("id AS pcode", "7 AS filial", "'L' AS lastname", "CAST(NULL AS STRING) AS firstname", "'M' AS midname",
                                         "DATE '1990-01-01' AS bdate", "99 AS pasptype", "'1-2' AS paspser", "CAST(id % 3 AS STRING) AS paspnum")
    first = P.pipeline_initial_load({"clients": clients(4)}, store, AS_OF)
    P.pipeline_initial_load({"clients": clients(9)}, store, AS_OF)
    assert store.read("det").count() == 8 and store.version() == 2
    again = P.pipeline_initial_load({"clients": clients(4)}, store, AS_OF)
    assert store.version() == 2 and plain(again.log, schemas.LOG) == plain(first.log, schemas.LOG)
    status = {(r.source_count, r.destination_count, r.is_complete) for r in store.read("status").collect()}
    assert status == {(3, 3, True), (8, 8, True)}
    assert [(r.source, r.last_id) for r in store.read("control").collect()] == [(2, 8)]


def test_merges_reach_registrations_and_protocols(spark, store):
    def line(i, number):
        return f"{i}/A|L{i}|N|S|19900101|16|45|{number}|e@x|8 900|login"
    lines = spark.createDataFrame([(i, line(i, n)) for i, n in enumerate([10, 11, 12])], "line_no long, line string")
    P.pipeline_sync_a({"lines": lines}, store, AS_OF)
    ids = {r.hisnumber: r.uuid for r in store.read("det").collect()}
    protocols = spark.createDataFrame([(i, u) for i, u in enumerate(sorted(ids.values()) * 2)], "id long, uuid string")
    store.commit("protocols", protocols=protocols, processed=schemas.empty(spark, schemas.PROCESSED))
    # two known persons now have one document, and a new record comes with them
    lines = spark.createDataFrame([(0, line(0, 11)), (1, line(1, 11)), (3, line(3, 13))], "line_no long, line string")
    P.pipeline_sync_a({"lines": lines}, store, AS_OF)
    now = {r.hisnumber: r.uuid for r in store.read("det").collect()}
    survivor = min(ids["0/A"], ids["1/A"])
    assert now["0/A"] == now["1/A"] == survivor and now["2/A"] == ids["2/A"] and set(now) == {f"{i}/A" for i in range(4)}
    assert {r.uuid for r in store.read("patients").collect()} == set(now.values())
    assert sorted(r.uuid for r in store.read("protocols").collect()) == sorted([survivor] * 4 + [ids["2/A"]] * 2)
    assert [(r.survivor) for r in store.read("merges").collect()] == [survivor]
    assert sorted(r.hisnumber for r in store.read("processed").collect()) == ["0/A", "1/A", "3/A"]


def test_changed_records_of_source_a_come_again(spark, store):
    def lines(last):
        return spark.createDataFrame([(0, f"1/A|{last}|N|S|19900101|16|45|1|e@x|8 900|login"), (1, "2/A|same|N|S|19900101|16|45|2|e@x|8 900|login")], "line_no long, line string")
    P.pipeline_sync_a({"lines": lines("old")}, store, AS_OF)
    P.pipeline_sync_a({"lines": lines("new")}, store, AS_OF, batch_id="left alone")
    assert {r.lastname for r in store.read("det").collect()} == {"old", "same"}
    out = P.pipeline_sync_a({"lines": lines("new")}, store, AS_OF, batch_id="changed", changed=True)
    assert {r.lastname for r in store.read("det").collect()} == {"new", "same"} and {r.hisnumber for r in out.log.collect()} == {"1/A"}


def test_an_older_change_that_comes_late_has_no_effect(spark, store):
    P.pipeline_delta_b({"delta": changes(spark, [(5, 1, 50, "INSERT", "N", "new"), (6, 2, 10, "DELETE", "N", "x")])}, store, AS_OF)
    P.pipeline_delta_b({"delta": changes(spark, [(4, 1, 40, "UPDATE", "N", "older"), (7, 2, 20, "INSERT", "N", "later")])}, store, AS_OF)
    assert {(r.hisnumber, r.lastname) for r in store.read("det").collect()} == {("1", "new"), ("2", "later")}
    assert [r.hisnumber for r in store.read("deletes").collect()] == ["2"]
    assert sorted(r.seq for r in store.read("marks").collect()) == [4, 5, 6, 7]


def test_text_dates_of_source_b(spark, store):
    rows = [(1, "05.03.1980"), (2, "5.3.1980"), (3, "1980-3-05"), (4, "31.02.1980"), (5, " "), (6, None), (7, "soon")]
    clients = spark.createDataFrame([(k, "seven", d) for k, d in rows], "pcode long, filial string, bdate string")
    out = P.pipeline_initial_load({"clients": clients}, store, AS_OF)
    assert {r.hisnumber: str(r.birthdate) for r in store.read("det").collect()} == {
        "1": "1980-03-05", "2": "1980-03-05", "3": "1980-03-05", "5": "None", "6": "None"}
    assert {r.hisnumber: r.reject_reason for r in out.rejects.collect()} == {"4": "BAD_DATE", "7": "BAD_DATE"}


def test_sync_a_takes_the_last_of_a_repeated_id_and_marks_rejects(spark, store):
    def line(i, last, birth="19900101"):
        return f"{i}/A|{last}|N|S|{birth}|16|45|{i}|e@x|8 900|login"
    lines = spark.createDataFrame([(0, line(1, "old")), (1, line(2, "x", "20200231")), (2, line(1, "new")), (3, line(3, "done"))], "line_no long, line string")
    done = spark.createDataFrame([("3/A",)], "hisnumber string")
    out = P.pipeline_sync_a({"lines": lines, "processed": done}, store, AS_OF)
    processed = store.read("processed")
    assert [(r.hisnumber, r.lastname) for r in store.read("det").collect()] == [("1/A", "new")]
    assert [(r.hisnumber, r.reject_reason) for r in out.rejects.collect()] == [("2/A", "BAD_DATE")]
    assert sorted(r[0] for r in processed.collect()) == ["1/A", "2/A", "3/A"]


def land(df, path, n):
    """The rows as ``n`` files, which become ``n`` micro-batches."""
    for i in range(n):
        df.filter(F.col("seq") % n == i).coalesce(1).write.mode("append").parquet(path)


def stream_of(spark, path):
    return spark.readStream.schema(schemas.DELTA).option("maxFilesPerTrigger", 1).parquet(path)


def test_latest_state_over_micro_batches_equals_batch(spark, tmp_path, store):
    rows = [(i, i * 7 % 11, i * 13 % 59, "UPDATE", "N", f"l{i}") for i in range(60)]
    df = changes(spark, rows)
    land(df, str(tmp_path / "in"), 5)
    ST.stream_latest_state(stream_of(spark, str(tmp_path / "in")), store, str(tmp_path / "cp")).awaitTermination()
    assert plain(store.read("changes"), schemas.DELTA) == plain(source_b.delta_latest(df), schemas.DELTA)
    assert store.version() == 5
    # a fresh checkpoint on the same store starts at batch 0 again and changes nothing
    ST.stream_latest_state(stream_of(spark, str(tmp_path / "in")), store, str(tmp_path / "cp2")).awaitTermination()
    assert store.version() == 10 and plain(store.read("changes"), schemas.DELTA) == plain(source_b.delta_latest(df), schemas.DELTA)


def test_repeated_delivery_is_dropped_and_late_changes_stay(spark, tmp_path, store):
    df = changes(spark, ROWS)
    for _ in range(2):
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    late = df.filter("seq = 8").withColumn("seq", F.lit(9).cast("long")).withColumn("change_time", F.lit("2020-01-01 00:00:00").cast("timestamp_ntz"))
    late.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    ST.stream_dedup(stream_of(spark, str(tmp_path / "in")), store, str(tmp_path / "cp")).awaitTermination()
    assert plain(store.read("deliveries"), schemas.DELTA) == plain(df.unionByName(late), schemas.DELTA)


def test_windows_count_late_rows(spark, tmp_path, store):
    times = ["2024-01-01 10:59:00", "2024-01-05 00:00:00", "2024-01-01 10:01:00", "2024-01-01 11:00:00"]
    log = spark.createDataFrame([(t, 1, i) for i, t in enumerate(times)], "t string, source int, seq int").withColumn("match_time", F.col("t").cast("timestamp_ntz"))
    land(log, str(tmp_path / "in"), 4)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    ST.stream_activity_window(stream, store, str(tmp_path / "cp")).awaitTermination()
    assert sorted((str(r.window_start), r["count"]) for r in store.read("activity").collect()) == [
        ("2024-01-01 10:00:00", 2), ("2024-01-01 11:00:00", 1), ("2024-01-05 00:00:00", 1)]


def test_stream_apply_in_order_equals_one_batch(spark, tmp_path):
    one, many = Store(spark, str(tmp_path / "one")), Store(spark, str(tmp_path / "many"))
    df = changes(spark, [(i, i % 4, i, "UPDATE", "N", f"l{i}") for i in range(12)])
    P.pipeline_delta_b({"delta": df}, one, AS_OF)
    for i in range(2):      # two files in the order of the changes
        df.filter(F.floor(F.col("seq") / 6) == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        ST.stream_delta_apply(stream_of(spark, str(tmp_path / "in")), many, str(tmp_path / "cp"), AS_OF).awaitTermination()
    assert many.version() == 2
    assert plain(many.read("det"), schemas.DET) == plain(one.read("det"), schemas.DET)
    untyped = [s.read("patients").withColumn("documenttypes", F.lit(None)) for s in (one, many)]
    assert plain(untyped[0]) == plain(untyped[1])


def test_latest_state_expired_key_that_returns(spark, tmp_path, store):
    """An old change of a key delivered after a newer one, in a later micro-batch, leaves the newer one."""
    new = changes(spark, [(10, 1, 50, "UPDATE", "N", "new"), (11, 2, 5, "UPDATE", "N", "b"), (12, None, 5, "UPDATE", "N", "n")])
    old = changes(spark, [(3, 1, 1, "UPDATE", "N", "old"), (13, 2, 9, "UPDATE", "N", "b2"), (4, None, 1, "UPDATE", "N", "n0")])
    new.coalesce(1).write.parquet(str(tmp_path / "in"))
    ST.stream_latest_state(stream_of(spark, str(tmp_path / "in")), store, str(tmp_path / "cp"), idle_ms=1).awaitTermination()
    old.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    ST.stream_latest_state(stream_of(spark, str(tmp_path / "in")), store, str(tmp_path / "cp"), idle_ms=1).awaitTermination()
    assert plain(store.read("changes"), schemas.DELTA) == plain(source_b.delta_latest(new.unionByName(old)), schemas.DELTA)


def test_latest_state_runs_without_python_and_keeps_known_times(spark, tmp_path, store):
    """The state is a built-in aggregate; a change without a time is older than any other, whenever it comes."""
    first = changes(spark, [(1, 1, 5, "UPDATE", "N", "a"), (2, 2, 5, "UPDATE", "N", "b")])
    later = first.withColumns({"change_time": F.when(F.col("pcode") == 2, F.lit("2030-01-01 00:00:00")).cast("timestamp_ntz"), "seq": F.col("seq") + 10})
    first.coalesce(1).write.parquet(str(tmp_path / "in"))
    later.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = stream_of(spark, str(tmp_path / "in"))
    plan = newest_changes(stream)._jdf.queryExecution().analyzed().toString()
    assert "max_by" in plan and "InP" not in plan
    ST.stream_latest_state(stream, store, str(tmp_path / "cp")).awaitTermination()
    assert plain(store.read("changes"), schemas.DELTA) == plain(source_b.delta_latest(first.unionByName(later)), schemas.DELTA)
    assert {r.seq for r in store.read("changes").collect()} == {1, 12}
