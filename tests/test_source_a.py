"""Record assembly against a line-by-line model, numbering of landed files, processed ids."""

import random

import pytest

from idloom.sources import control, source_a as A


def model(lines):
    out, current = [], []
    for line in lines:
        line = line.strip()
        if not line:
            continue
        fields = line.split("|")
        head = fields[0].strip()
        if "/" in head and head.split("/")[0].isdigit():
            current = []
        current = current + fields
        if len(current) >= 10:
            out.append(current)
            current = []
    return out


def lines_of(seed, n=900):
    """Starts, continuations, blank lines, and a long stretch without any start."""
    rnd, out = random.Random(seed), []
    for i in range(n):
        garbage = n // 4 < i < n // 2
        size = rnd.choice([1, 2, 3, 4, 9] if garbage else [1, 2, 3, 5, 9, 10, 11, 12])
        head = f"{i}/A" if not garbage and rnd.random() < 0.5 else f"x{i}"
        text = "|".join([head] + [f"f{i}_{j}" for j in range(size - 1)])
        out.append(text if rnd.random() < 0.9 else rnd.choice(["", "  ", "\t"]))
    return out


@pytest.mark.parametrize("seed, chunk, block", [(1, 16, 64), (2, 32, 50), (3, 64, 1 << 18), (4, 2048, 64)])
def test_parser_equals_model(spark, monkeypatch, seed, chunk, block):
    monkeypatch.setattr(A, "CHUNK", chunk)
    monkeypatch.setattr(A, "_BLOCK", block)
    lines = lines_of(seed)
    df = spark.createDataFrame([(i * 3, x) for i, x in enumerate(lines)], "line_no long, line string")
    assert [r.fields for r in A.parse_source_a(df).orderBy("line_no").collect()] == model(lines)


def test_landed_files_are_numbered_across_splits(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(A, "CHUNK", 16)
    files = {f"f{k}.txt": lines_of(k, 400) for k in range(3)}
    for name, lines in files.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        landed = A.scan_source_a_lines(spark, str(tmp_path))
        got = {}
        for r in A.parse_source_a(landed, numbered=True).orderBy("file", "line_no").collect():
            got.setdefault(r.file.rsplit("/", 1)[1], []).append(r.fields)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {name: model(lines) for name, lines in files.items()}


def test_short_and_nameless_records_are_dropped(spark):
    df = spark.createDataFrame([(["1/A"] + ["x"] * 9,), (["  "] + ["x"] * 9,), (["2/A"] * 9,)], "fields array<string>")
    out = A.build_source_a_record(df).collect()
    assert [(r.hisnumber, r.login_email, r.source, r.businessunit) for r in out] == [("1/A", "", 1, 1)]


def test_processed_set(spark):
    records = spark.createDataFrame([(f"TEST_{i:03d}",) for i in range(1, 6)], "hisnumber string")
    done = spark.createDataFrame([], "hisnumber string")
    assert A.unprocessed_a(records, done).count() == 5
    done = control.processed_set_union(done, records.filter("hisnumber <= 'TEST_003'"))
    assert [r[0] for r in A.unprocessed_a(records, done, 1).collect()] == ["TEST_004"]
    assert A.unprocessed_a(records, done).count() == 2


def test_changed_records_are_found_by_content(spark):
    old = spark.createDataFrame([("1", "a"), ("2", "b")], "hisnumber string, lastname string")
    seen = A.changed_a(old, spark.createDataFrame([], "hisnumber string, fingerprint long")).select("hisnumber", "fingerprint")
    new = spark.createDataFrame([("1", "a"), ("2", "c"), ("3", "d")], "hisnumber string, lastname string")
    assert sorted(r.hisnumber for r in A.changed_a(new, seen).collect()) == ["2", "3"]


def test_rows_are_numbered_without_gaps(spark):
    df = spark.range(0, 1000, 1, 7).selectExpr("id * 37 % 1009 AS k")
    got = [(r.k, r.rn) for r in control.number_rows(df, "k").orderBy("rn").collect()]
    want = sorted(i * 37 % 1009 for i in range(1000))
    assert got == [(k, i + 1) for i, k in enumerate(want)]
