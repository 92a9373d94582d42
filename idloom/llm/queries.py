"""The operators as queries over the driver's tables, with production parameters, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idloom.llm import codec, collocations, hashing, langid, multiindex, packing, periodic, quality, sharding, simhash, tables, toxicity, urlfilter, warc
from idloom.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: vocabulary of the packing and coding queries
VOCABULARY = "byte_bpe_50k.json"


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = lambda spark, sf_dir: f(tune(spark), sf_dir)
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


@query
def op1_warc_derivatives(spark, sf_dir):
    """Metadata and conversion records of all pages, captured at one stated time."""
    responses = warc.responses_of(table(spark, sf_dir, "pages"), date="2024-01-01T00:00:00Z")
    return warc.derivatives(responses, keep=["page_id"])


@query
def op2_embedding_dedup(spark, sf_dir):
    return multiindex.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


@query
def op3_language_profiles(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = tables.fold("doc_id", 5) == 0
    profiles = langid.train(docs.filter(~held_out))
    return langid.predict(docs, profiles, keep=["doc_id"]).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op4_toxicity_pu(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = tables.fold("doc_id", 4) == 2
    model = toxicity.train(docs.filter(~held_out), table(spark, sf_dir, "labels").filter(~held_out), "toxic")
    return toxicity.predict(docs, model, keep=["doc_id"], threshold=0.3).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op5_simhash_bktree(spark, sf_dir):
    return simhash.groups(table(spark, sf_dir, "documents"), words=3, radius=3)


#: (host, path, verdict)
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


@query
def op6_url_templates(spark, sf_dir):
    """A page's url ends in the number of the document it shows; a good page is one of good quality that is not toxic."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    shown = pages.select("page_id", F.regexp_extract(urlfilter.host_and_path(F.col("url"))[1], "/([0-9]+)", 1).try_cast("long").alias("doc_id"))
    good = shown.join(labels, "doc_id").select("page_id", (F.col("quality") * (1 - F.col("toxic"))).alias("good"))
    return urlfilter.judge(pages, good, RULES)


ORACLE["op6_url_templates"] = urlfilter.judge_sql(
    "SELECT page_id, url FROM pages",
    """SELECT page_id, quality * (1 - toxic) AS good FROM labels JOIN (SELECT page_id, try_cast(regexp_extract(regexp_extract(
        substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*'), '/([0-9]+)', 1) AS BIGINT) AS doc_id
        FROM (SELECT page_id, substr(url, instr(url, '://') + 3) AS rest FROM pages WHERE instr(url, '://') > 0)) USING (doc_id)""", RULES)

ORACLE["op2_embedding_dedup"] = """
    WITH RECURSIVE good AS (
        SELECT vec_id, label, e, sqrt(list_inner_product(e, e)) AS norm
        FROM (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings)
        WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND list_inner_product(e, e) > 0),
    links AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
    reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
    SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(least_b, vec_id)) AS component_id,
        vec_id <= coalesce(least_b, vec_id) AS kept
    FROM embeddings LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
        LEFT JOIN (SELECT a AS vec_id, min(b) AS least_b FROM reach GROUP BY a) USING (vec_id)"""


@query
def op7_bpe_codec(spark, sf_dir):
    return codec.digests(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op8_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), window=2048, end_id=1, ids=False)


@query
def op9_multi_index_hashing(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return hashing.nearest(rows, rows.filter(F.col("vec_id") % 20 == 0), k=20)


@query
def op10_quality_fourier(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = tables.fold("doc_id", 5) == 0
    scored = quality.predict(docs, labels.filter(~held_out), "quality", threshold=0.3)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op11_rendezvous_shards(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"), shards=16)


@query
def op12_periodic_runs(spark, sf_dir):
    return periodic.detect(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_words")


@query
def op13_collocations(spark, sf_dir):
    return collocations.mine(table(spark, sf_dir, "documents"), top=2000, least=10, share=50)


#: the same definitions, counting every bigram and trigram
ORACLE["op13_collocations"] = """
    WITH w AS (
        SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS ws
        FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) AS piece
            FROM documents)),
    n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
    c1 AS (SELECT lang, g AS phrase, count(*) AS f FROM (SELECT lang, unnest(ws) AS g FROM w) GROUP BY ALL),
    c2 AS (SELECT lang, g AS phrase, count(*) AS f FROM (SELECT lang, unnest(list_transform(range(1, len(ws)),
            lambda i: ws[i] || ' ' || ws[i + 1])) AS g FROM w) GROUP BY ALL HAVING count(*) >= 10),
    c3 AS (SELECT lang, g AS phrase, count(*) AS f, split_part(g, ' ', 1) || ' ' || split_part(g, ' ', 2) AS pre,
            split_part(g, ' ', 2) || ' ' || split_part(g, ' ', 3) AS suf FROM (SELECT lang, unnest(list_transform(range(1, len(ws) - 1),
            lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS g FROM w) GROUP BY ALL HAVING count(*) >= 10),
    t AS (SELECT c3.lang, c3.phrase, c3.f AS a, x.f AS fx, yz.f AS fyz, xy.f AS fxy, z.f AS fz,
            (1000000 * c3.f::HUGEINT * c3.f) // (x.f::HUGEINT * yz.f) AS s1, (1000000 * c3.f::HUGEINT * c3.f) // (xy.f::HUGEINT * z.f) AS s2
          FROM c3 JOIN c1 x ON x.lang = c3.lang AND x.phrase = split_part(c3.phrase, ' ', 1)
          JOIN c1 z ON z.lang = c3.lang AND z.phrase = split_part(c3.phrase, ' ', 3)
          JOIN c2 xy ON xy.lang = c3.lang AND xy.phrase = c3.pre JOIN c2 yz ON yz.lang = c3.lang AND yz.phrase = c3.suf),
    b AS (SELECT c2.lang, c2.phrase, c2.f AS a, x.f AS l, y.f AS r, (1000000 * c2.f::HUGEINT * c2.f) // (x.f::HUGEINT * y.f) AS score
          FROM c2 JOIN c1 x ON x.lang = c2.lang AND x.phrase = split_part(c2.phrase, ' ', 1)
          JOIN c1 y ON y.lang = c2.lang AND y.phrase = split_part(c2.phrase, ' ', 2)
          WHERE NOT EXISTS (SELECT 1 FROM c3 WHERE c3.lang = c2.lang AND 100 * c3.f >= 50 * c2.f
              AND (c3.pre = c2.phrase OR c3.suf = c2.phrase))),
    s AS (SELECT lang, phrase, a, l, r, score FROM b
          UNION ALL SELECT lang, phrase, a, CASE WHEN s2 < s1 THEN fxy ELSE fx END, CASE WHEN s2 < s1 THEN fz ELSE fyz END, least(s1, s2) FROM t)
    SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM s) JOIN n USING (lang)
    WHERE rank <= 2000"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
