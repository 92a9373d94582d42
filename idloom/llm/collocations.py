"""Phrase collocations per language, found by best-first branch and bound over n-gram counts.

Texts are lower-cased (A-Z only) and cut at ``.,;:!?`` and line ends into pieces, pieces into words at spaces and tabs.
Per language (null: ``und``) n is the number of words, f(p) the number of contiguous occurrences of phrase p within
pieces. Candidates are phrases of 2 or 3 words with a = f >= ``least``. A candidate is cut after each of its first
words; a cut gives l = f(first part), r = f(rest) and floor(1e6 a^2 / (l r)), and the lowest cut (ties: the first)
is the score. A bigram inside a trigram candidate with 100 f(trigram) >= ``share`` a is dropped.

Words and bigrams are counted in one aggregation. Each bigram xy is a node of the search: its own score is known, and
every trigram xyz that grows from it scores at most floor(1e6 f(xy) / f(x)) (the first cut, as f(yz) >= f(xyz)), so
its key is the greater of the two. Rounds expand the unexpanded nodes of highest key of each open language, a growing
number at a time: the trigrams that begin or end with them are counted in one pass over the texts (a semi-join with
the frontier), which scores those trigrams and settles whether the expanded bigrams survive. A language is closed
when its 2000th settled score is above every key still unexpanded, so ties with it are settled too. Scores are exact
(38-digit decimals, integer division).

Nulls: a null text has no words, a null lang is ``und``. Empty tables and languages without candidates give no rows;
repeated rows count each time. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from idloom.session import cut

# fixed values of the contract: what cuts pieces (here all become line feeds), what cuts words (all become spaces)
PIECES, WORDS = ".,;:!?\n\x0B\f\r", " \t"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: nodes expanded per open language in the first round, as a multiple of ``top``; growth of that number per round
FIRST, GROWTH = 4, 4
#: largest frontier, in bytes of phrases, that is broadcast; a larger one is joined by a shuffle
BROADCAST_BYTES = 64 << 20


def _lowered(text: Column) -> Column:
    """The text in lower case, a line feed for all that ends a piece and a space for all that ends a word."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER + PIECES + WORDS,
                       _LOWER + "\n" * len(PIECES) + " " * len(WORDS))


def pieces(text: Column) -> Column:
    """array<array<string>>: the words of each piece."""
    # one plain character cuts without a regular expression, which would be compiled for every piece
    return F.transform(F.split(_lowered(text), "\n"), lambda p: F.array_remove(F.split(p, " "), F.lit("")))


def tokens(text: Column) -> Column:
    """array<string>: the words of all pieces in order, with a line feed wherever a piece ends within the text.

    The same as ``pieces``, but cut in one go: nothing is evaluated for one piece or word at a time.
    """
    return F.array_remove(F.split(F.replace(_lowered(text), F.lit("\n"), F.lit(" \n ")), " "), F.lit(""))


def _windows(ts: Column, *names: str) -> Column:
    """array<struct>: each token with those that follow it, null beyond the end."""
    return F.arrays_zip(*[F.slice(ts, F.lit(i + 1), F.size(ts)).alias(n) for i, n in enumerate(names)])


def _word(c: str) -> Column:
    return F.coalesce(F.col(c) != "\n", F.lit(False))


def _exact(a: str, l_: str, r_: str) -> Column:
    return F.expr(f"(CAST(1000000 AS DECIMAL(38,0)) * CAST({a} AS DECIMAL(38,0)) * CAST({a} AS DECIMAL(38,0))) "
                  f"div (CAST({l_} AS DECIMAL(38,0)) * CAST({r_} AS DECIMAL(38,0)))")


def mine(docs: DataFrame, top: int = 2000, least: int = 10, share: int = 50, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's first ``top`` candidates by score, a, phrase."""
    spark = docs.sparkSession
    words = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), tokens(F.col(f"`{text}`")).alias("ts"))
    # the row without a phrase carries the number of words, which is known before the rows are made
    sized = words.select("lang", F.concat("ts", F.array(F.lit(None).cast("string"))).alias("ts"),
                         F.size(F.array_remove("ts", F.lit("\n"))).cast("long").alias("m"))
    pairs = sized.select("lang", "m", F.inline(_windows(F.col("ts"), "x", "y"))).filter(F.col("x").isNull() | _word("x"))
    counted = pairs.select("lang", "m", F.explode(
        F.when(_word("x") & _word("y"), F.array("x", F.concat("x", F.lit(" "), "y"))).otherwise(F.array("x"))).alias("phrase")).groupBy("lang", "phrase").agg(
        F.sum(F.when(F.col("phrase").isNull(), F.col("m")).otherwise(F.lit(1).cast("long"))).alias("f"))
    base = cut(counted.filter(F.col("phrase").isNull() | (F.col("f") >= least)))
    n = base.filter(F.col("phrase").isNull()).select("lang", F.col("f").alias("n"))
    uni = base.filter(F.col("phrase").isNotNull() & ~F.col("phrase").contains(" ")).select("lang", "phrase", "f")
    bi = base.filter(F.size(F.split("phrase", " ")) == 2).select("lang", "phrase", F.col("f").alias("a"))

    def f_of(df: DataFrame, column: str, name: str, table: DataFrame = uni) -> DataFrame:
        t = table.select(F.col("lang").alias("_l"), F.col("phrase").alias("_p"), F.col(table.columns[2]).alias(name))
        return df.join(t, (df["lang"] == t["_l"]) & (df[column] == t["_p"])).drop("_l", "_p")

    nodes = f_of(f_of(bi.withColumn("x", F.split("phrase", " ")[0]).withColumn("y", F.split("phrase", " ")[1]), "x", "l"), "y", "r")
    nodes = cut(nodes.select("lang", "phrase", "a", "l", "r", _exact("a", "l", "r").alias("score"),
                             F.expr("(CAST(a AS DECIMAL(38,0)) * 1000000) div l").alias("bound"))
                .withColumn("key", F.greatest("score", "bound")))

    expanded: DataFrame | None = None
    trigrams: DataFrame | None = None
    open_langs = nodes.select("lang").distinct()
    rounds = 0
    while True:
        k = top * FIRST * GROWTH ** rounds
        rounds += 1
        waiting = nodes.join(open_langs, "lang", "left_semi")
        if expanded is not None:
            waiting = waiting.join(expanded, ["lang", "phrase"], "left_anti")
        frontier = cut(waiting.withColumn("_i", F.row_number().over(
            Window.partitionBy("lang").orderBy(F.desc("key"), "phrase"))).filter(F.col("_i") <= k).select("lang", "phrase"))
        size = frontier.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("phrase")).alias("bytes")).first()
        if not size["rows"]:
            break
        counted3 = _count_trigrams(words, frontier, size["bytes"] or 0, least)
        trigrams = counted3 if trigrams is None else cut(trigrams.unionByName(counted3).dropDuplicates(["lang", "tri"]))
        expanded = frontier if expanded is None else cut(expanded.unionByName(frontier))
        settled = _settled(nodes, expanded, trigrams, bi, uni, share)
        ranked = settled.withColumn("_i", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")))
        last = ranked.filter(F.col("_i") == top).select("lang", F.col("score").alias("_last"))
        highest = nodes.join(expanded, ["lang", "phrase"], "left_anti").groupBy("lang").agg(F.max("key").alias("_high"))
        status = open_langs.join(last, "lang", "left").join(highest, "lang", "left")
        open_langs = cut(status.filter(F.col("_high").isNotNull() & (F.col("_last").isNull() | (F.col("_high") >= F.col("_last")))).select("lang"))
        if not open_langs.take(1):
            break
    if expanded is None:
        settled = nodes.limit(0).select("lang", "phrase", "a", "l", "r", "score")
    else:
        settled = _settled(nodes, expanded, trigrams, bi, uni, share)
    ranked = settled.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")))
    return ranked.filter(F.col("rank") <= top).join(n, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def _count_trigrams(words: DataFrame, frontier: DataFrame, frontier_bytes: int, least: int) -> DataFrame:
    """(lang, tri, pre, suf, a) of the trigrams with a >= ``least`` that begin or end with a frontier bigram."""
    threes = words.select("lang", F.inline(_windows(F.col("ts"), "x", "y", "z"))).filter(_word("x") & _word("y") & _word("z"))
    # a trigram is its two bigrams; its text is made of those that are counted, after counting
    occ = threes.select("lang", F.concat("x", F.lit(" "), "y").alias("pre"), F.concat("y", F.lit(" "), "z").alias("suf"))
    hits = frontier.select(F.col("lang").alias("_fl"), F.col("phrase").alias("_fp"), F.lit(True).alias("_hit"))
    if frontier_bytes <= BROADCAST_BYTES:
        hits = F.broadcast(hits)
    p = hits.select(F.col("_fl").alias("_pl"), F.col("_fp").alias("_pp"), F.col("_hit").alias("_ph"))
    s = hits.select(F.col("_fl").alias("_sl"), F.col("_fp").alias("_sp"), F.col("_hit").alias("_sh"))
    met = (occ.join(p, (occ["lang"] == p["_pl"]) & (occ["pre"] == p["_pp"]), "left")
           .join(s, (occ["lang"] == s["_sl"]) & (occ["suf"] == s["_sp"]), "left")
           .filter(F.col("_ph").isNotNull() | F.col("_sh").isNotNull()))
    counted = met.groupBy("lang", "pre", "suf").agg(F.count(F.lit(1)).alias("a")).filter(F.col("a") >= least)
    tri = F.concat("pre", F.lit(" "), F.substring_index("suf", " ", -1))
    return cut(counted.select("lang", tri.alias("tri"), "pre", "suf", "a"))


def _settled(nodes: DataFrame, expanded: DataFrame, trigrams: DataFrame, bi: DataFrame, uni: DataFrame, share: int) -> DataFrame:
    """(lang, phrase, a, l, r, score): surviving expanded bigrams and all counted trigrams."""
    around = trigrams.select("lang", F.explode(F.array("pre", "suf")).alias("phrase"), F.col("a").alias("_ta")).groupBy(
        "lang", "phrase").agg(F.max("_ta").alias("_most"))
    kept = (nodes.join(expanded, ["lang", "phrase"], "left_semi").join(around, ["lang", "phrase"], "left")
            .filter(F.col("_most").isNull() | (F.col("_most") * 100 < F.col("a") * share))
            .select("lang", "phrase", "a", "l", "r", "score"))
    x = F.split("tri", " ")
    t = trigrams.select("lang", "tri", "pre", "suf", "a", x[0].alias("_x"), x[2].alias("_z"))

    def look(df, table, column, name):
        u = table.select(F.col("lang").alias("_k"), F.col("phrase").alias("_q"), F.col(table.columns[2]).alias(name))
        return df.join(u, (df["lang"] == u["_k"]) & (df[column] == u["_q"])).drop("_k", "_q")

    t = look(look(look(look(t, uni, "_x", "_fx"), uni, "_z", "_fz"), bi, "pre", "_fxy"), bi, "suf", "_fyz")
    t = t.withColumn("_s1", _exact("a", "_fx", "_fyz")).withColumn("_s2", _exact("a", "_fxy", "_fz"))
    second = F.col("_s2") < F.col("_s1")
    tri = t.select("lang", F.col("tri").alias("phrase"), "a", F.when(second, F.col("_fxy")).otherwise(F.col("_fx")).alias("l"),
                   F.when(second, F.col("_fz")).otherwise(F.col("_fyz")).alias("r"), F.least("_s1", "_s2").alias("score"))
    return kept.unionByName(tri)
