"""WARC derivatives, the url filter, the pipeline, and the driver's entry point."""

import base64
import hashlib

import pytest
from compare import connect, difference
from conftest import SF
from pyspark.sql import functions as F

import corpus_pipeline
from idloom.llm import queries, simhash, urlfilter, warc

PAGE = """<!DOCTYPE html><html><head><title>A &amp; B</title><style>p{x:1}</style><script>var t="</p>";</script></head><body><!-- no -->
<h1>Head</h1><p>One <b>two</b>&nbsp;three<br>four</p><a href="/x?a=1&amp;b=2">link</a><a href='/y'>y</a><script>open"""


def test_plain_text_and_links():
    assert warc.plain_text(PAGE) == "A & B\nHead\nOne two three\nfour\nlinky"
    assert warc.plain_text("") == "" and warc.plain_text("a < b") == "a < b"
    assert warc.headers("HTTP/1.1 200 OK\r\nA: 1\r\nB:2\r\na: 3\r\nnothing\r\n") == {"a": "1, 3", "b": "2"}


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_derivatives_refer_to_their_response(spark):
    pages = spark.createDataFrame([(1, "http://a/x", PAGE, 5), (2, None, None, 6), (None, "", "", None), (1, "http://a/x", PAGE, 5),
                                   (4, "http://long/", "<p>word " * 100000, 1)], "page_id long, url string, html string, block long")
    responses = warc.responses_of(pages, "2024-01-01T00:00:00Z")
    sources = {r.record_id: r for r in responses.collect()}
    out = warc.derivatives(responses, keep=["page_id", "block"] if "block" in responses.columns else ["page_id"]).collect()
    assert len(out) == 10 and {r.warc_type for r in out} == {"metadata", "conversion"}
    for r in out:
        source = sources[r.refers_to]
        assert (r.target_uri, r.date, r.source_payload_digest) == (source.target_uri, source.date, sha1(source.payload.encode()))
        assert r.block_digest == sha1(r.block.encode()) and r.content_length == len(r.block.encode())
        assert r.source_headers == warc.headers(source.http_headers)
        if r.warc_type == "conversion":
            assert r.block == warc.plain_text(source.payload)
        else:
            assert f"source-payload-digest: {source.payload_digest}\r\n" in r.block
    first = next(r for r in out if r.warc_type == "metadata" and r.page_id == 1)
    assert "title: A & B\r\n" in first.block and "outlink: /x?a=1&b=2\r\noutlink: /y\r\n" in first.block
    assert warc.derivatives(responses.limit(0)).collect() == []
    nulls = spark.createDataFrame([(None,) * 7], warc.RESPONSES)
    assert [r.refers_to for r in warc.derivatives(nulls).collect()] == [None, None]


@pytest.mark.parametrize("compress", [True, False])
def test_records_are_a_warc_file(spark, compress):
    responses = warc.responses_of(spark.read.parquet(f"{SF}/pages.parquet"), "2024-01-01T00:00:00Z")
    derived = warc.derivatives(responses)
    rows = warc.serialized(derived, compress).collect()
    parsed = list(warc.records(b"".join(bytes(r.record) for r in rows)))
    want = {(r.record_id, r.refers_to, r.block_digest): r.block for r in derived.collect()}
    assert {(f["warc-record-id"], f["warc-refers-to"], f["warc-block-digest"]): b.decode() for f, b in parsed} == want


def test_responses_are_read_from_archives(spark):
    body = b"<p>hi</p>"
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + body
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Target-URI: http://a/\r\nWARC-Date: 2024\r\nContent-Length: {len(block)}\r\n\r\n"
    data = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 2\r\n\r\nab\r\n\r\n" + head.encode() + block + b"\r\n\r\n" + head.encode() + block[:5]
    files = spark.createDataFrame([("f", bytearray(data)), ("g", None)], "path string, content binary")
    r, = warc.read_responses(files).collect()
    assert (r.record_id, r.target_uri, r.payload, r.payload_digest, r.block_digest) == ("<urn:uuid:1>", "http://a/", "<p>hi</p>", sha1(body), sha1(block))
    assert warc.derivatives(warc.read_responses(files)).filter("warc_type = 'conversion'").first().block == "hi"


def test_warc_query(spark):
    rows = queries.QUERIES["op1_warc_derivatives"](spark, SF).collect()
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(rows) == 2 * len(pages)
    assert all(r.block == warc.plain_text(pages[r.page_id].html) for r in rows if r.warc_type == "conversion")
    assert len({r.record_id for r in rows}) == len(rows)


URLS = [(None, "", ""), ("nothing", "", ""), ("http://Ex.ORG/A?b", "ex.org", "/A"), ("x://É.Com", "É.com", ""), ("http://h?x://y/z", "h", ""),
        ("a://b/c://d#e", "b", "/c://d"), ("://", "", ""), ("http:///p#", "", "/p"), ("h://a/b\nc?d", "a", "/b\nc")]


def test_host_and_path(spark):
    df = spark.createDataFrame([(u,) for u, _, _ in URLS], "url string")
    assert [tuple(r) for r in df.select(*urlfilter.host_and_path(F.col("url"))).collect()] == [(h, p) for _, h, p in URLS]


def test_longest_rule_wins(spark):
    cases = {("a.example.org", "/es/1"): "example.org/es/", ("org", "/x"): "org/", ("xorg", "/x"): None, ("example.org", "/en/12"): "example.org/en/1",
             ("example.org", "/en/2"): "org/", ("a.com", "/fr/"): "com/fr/", ("com", "/fr"): None, ("example.org", ""): None, ("", ""): None}
    df = spark.createDataFrame(list(cases), "host string, path string")
    got = df.select(urlfilter.rule_of(F.col("host"), F.col("path"), queries.RULES)["rule"]).collect()
    assert [r[0] for r in got] == list(cases.values())


def test_url_query_equals_its_sql(spark):
    assert difference(queries.QUERIES["op6_url_templates"](spark, SF), connect(SF), queries.ORACLE["op6_url_templates"]) is None


def test_template_tree(spark):
    rows = [(i, f"http://h/good/{i}.html", 1) for i in range(60)] + [(100 + i, f"http://h/bad/{i}.html", 0) for i in range(60)]
    rows += [(200 + i, f"http://w/t{chr(97 + i % 26)}{chr(97 + i // 26)}/x", i % 2) for i in range(60)] + [(300, None, 1), (301, "http://h/a/b/c/d/e/f/g/h", None)]
    pages = spark.createDataFrame([(i, u) for i, u, _ in rows], "page_id long, url string")
    labels = spark.createDataFrame([(i, g) for i, _, g in rows] + [(None, 1), (0, 1)], "page_id long, good int")
    got = {r.page_id: r for r in urlfilter.judge(pages.withColumn("host", F.lit(1)), labels, []).collect()}
    assert len(got) == len(rows)
    assert {got[i].template for i in range(60)} == {"/good/~"} and {got[i].verdict for i in range(60)} == {"allow"}
    assert {got[100 + i].template for i in range(60)} == {"/bad/~"} and {got[100 + i].verdict for i in range(60)} == {"block"}
    assert {got[200 + i].template for i in range(60)} == {"/*/~"}  # many alike children: a wildcard
    assert got[300].host == "" and got[301].template.count("/") == urlfilter.LEVELS
    free = urlfilter.judge(pages, labels.limit(0), []).collect()
    assert {r.verdict for r in free} == {"allow"} and urlfilter.judge(pages.limit(0), labels, []).collect() == []
    sql = urlfilter.judge_sql("SELECT * FROM p", "SELECT * FROM l", [])
    con = connect(SF)
    con.register("p", pages.toPandas())
    con.register("l", labels.toPandas())
    assert difference(urlfilter.judge(pages, labels, [("none", "/", "allow")]), con, urlfilter.judge_sql(
        "SELECT * FROM p", "SELECT page_id::BIGINT AS page_id, good FROM l", [("none", "/", "allow")])) is None, sql


def test_url_plan_is_native(spark):
    plan = queries.QUERIES["op6_url_templates"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# ---- the pipeline --------------------------------------------------------------------------------

def test_stages_keep_columns_and_clean_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, "en", None, None), (10**6 + 1, "12 !", None, None, 4), (None, "ein langer Text der nicht", None, None, 1)], docs.schema)
    docs, sizes = docs.unionByName(odd), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf).persist()
        assert after.columns == docs.columns and after.exceptAll(docs).count() == 0, name
        sizes.append((docs.count(), after.count()))
        docs = after
    (a, b), (c, d), (e, f) = sizes
    assert a - b == 2  # no text, and no letter
    toxic = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").filter("toxic = 1").collect()}
    assert c - d >= 0.7 * len(toxic) * 0.9 and c - d < 0.25 * c
    want = simhash.groups(after.unionByName(after.limit(0))).select("component_id").distinct().count()
    assert f == want < e
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert packed.select("doc_id").distinct().count() == f and packed.filter("start + length > doc_tokens").isEmpty()


def test_pipeline_on_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_entry_registers_every_operator():
    import __spark_entry__
    names = list(__spark_entry__.queries())
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11)) and "pipeline" in names
