"""Collocations by branch and bound against counting every phrase in Python."""

import random
import re
from collections import Counter

from idloom.llm import collocations

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, top, least, share=50):
    out = []
    by_lang = {}
    for text, lang in rows:
        by_lang.setdefault(lang or "und", []).append(text)
    for lang, texts in by_lang.items():
        f, n = Counter(), 0
        for text in texts:
            for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOW)):
                ws = [w for w in re.split(r"[ \t]+", piece) if w]
                n += len(ws)
                for k in (1, 2, 3):
                    for i in range(len(ws) - k + 1):
                        f[tuple(ws[i:i + k])] += 1
        cands = [p for p in f if len(p) > 1 and f[p] >= least]
        found = []
        for p in cands:
            a = f[p]
            if len(p) == 2 and any(len(q) == 3 and f[q] >= least and 100 * f[q] >= share * a and p in (q[:2], q[1:]) for q in cands):
                continue
            cuts = [(10 ** 6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((score, a, " ".join(p), f[p[:k]], f[p[k:]]))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, p, a, l_, r_, n, s) for i, (s, a, p, l_, r_) in enumerate(found[:top])]
    return sorted(out)


def test_rounds_equal_brute_force(spark):
    rng = random.Random(3)
    vocab = ["a", "b", "c", "D", "e%", "f_g", "h", "i", "j", "k"]
    rows = [(" ".join(rng.choice(vocab[: 4 + i % 7]) for _ in range(rng.randint(0, 60))) + rng.choice([". x y", "", "!\tb c"]),
             rng.choice(["en", None, "de"])) for i in range(150)]
    rows += [(None, "en"), ("", None), ("a b c " * 30, "en")] * 2
    docs = spark.createDataFrame([(t, g, 1) for t, g in rows], "text string, lang string, rank long")
    for top, least in ((3, 2), (40, 3), (2000, 10)):
        got = sorted(tuple(r) for r in collocations.mine(docs, top=top, least=least).collect())
        assert got == brute(rows, top, least), (top, least)
    assert collocations.mine(docs.limit(0)).count() == 0


def test_pieces_cut_at_plain_characters(spark):
    from pyspark.sql import functions as F
    texts = ["A b\tC,\td  e", "", None, "x.\n\x0b\f\ry!z?", " \t ", "É ÀB;c:D", "a\x1cb\xa0c d", "..", "\t\tq\tr\t"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    cut = docs.select("i", collocations.pieces(F.col("text")).alias("ws"))
    up = str.maketrans(collocations._UPPER, collocations._LOWER)
    for r in cut.collect():
        low = (texts[r.i] or "").translate(up)
        want = [re.findall(r"[^\x20\x09]+", p) for p in re.split("[.,;:!?\n\x0b\f\r]", low)]
        assert [p for p in r.ws if p] == [p for p in want if p]
    # no pattern that has to be compiled for every piece
    assert "[" not in "".join(re.findall(r"split\(.*?, (.*?), -1\)", cut._jdf.queryExecution().optimizedPlan().toString()))


def test_words_are_cut_in_one_go_and_pieces_stay_apart(spark):
    from pyspark.sql import functions as F
    texts = ["Ab, c\td.. E\r\nf ", "", None, " !? ", "one"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").select("i", collocations.tokens(F.col("text")).alias("ts"))
    got = {r.i: r.ts for r in df.collect()}
    assert got == {0: ["ab", "\n", "c", "d", "\n", "\n", "e", "\n", "\n", "f"], 1: [], 2: [], 3: ["\n", "\n"], 4: ["one"]}
    # no function that is evaluated for one word at a time outside generated code
    assert "lambda" not in df._jdf.queryExecution().executedPlan().toString()
