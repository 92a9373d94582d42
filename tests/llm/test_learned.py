"""Language, toxicity and quality: held-out accuracy, brute force, and rows that are out of the ordinary."""

import zlib
from collections import Counter

import numpy as np
import pytest

from idloom.llm import langid, quality, queries, toxicity

SF01 = "/root/testdata/sf0.01"


def table(spark, name):
    return spark.read.parquet(f"{SF01}/{name}.parquet")


def brute_places(text, k):
    """Most frequent n-grams by plain loops."""
    words, word = [], ""
    for c in text.lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            words.append(word)
            word = ""
    count = Counter()
    for w in words:
        padded = [0, *map(ord, w), 0]
        for i, c in enumerate(padded):
            if c:
                count[c] += 1
                count[(padded[i - 1] << 42) | (c << 21) | padded[i + 1]] += 1
        for a, b in zip(padded, padded[1:]):
            count[(a << 21 | b) | 1 << 63] += 1
    return sorted(count, key=lambda g: (-count[g], g))[:k]


@pytest.mark.parametrize("text", ["Hello, hello world", "a", "été à la plage; ÉTÉ", "  x1y2 ", "漢字 かな", "straße STRASSE"])
def test_places_of_a_document(text):
    # a boundary between two words is one mark, so counts of marks agree with padded words
    assert sorted(langid.places(text, 10**6).tolist()) == sorted(brute_places(text, 10**6))
    assert Counter(langid.grams(text).tolist()).most_common(1)[0][1] >= 1


def test_out_of_place_distance():
    a, b = langid.places("the cat and the dog", 50), langid.places("el gato y el perro", 50)
    every = np.unique(np.concatenate([a, b]))
    rank = np.full((2, len(every)), 50)
    rank[0, np.searchsorted(every, a)] = np.arange(len(a))
    rank[1, np.searchsorted(every, b)] = np.arange(len(b))
    p = langid.Profiles(["en", "es"], every, rank, 50)
    own = langid.places("the dog", 50).tolist()
    away = [sum(abs(i - list(x).index(g)) if g in list(x) else 50 for i, g in enumerate(own)) for x in (a, b)]
    assert p.predict("the dog") == ("en", 1 - away[0] / (50 * len(own))) and away[0] < away[1]
    assert p.predict("the cat and the dog") == ("en", 1.0)
    for nothing in (None, "", "123 !?"):
        assert p.predict(nothing) == ("und", 0.0)


def test_languages_are_found(spark):
    rows = queries.QUERIES["op3_language_profiles"](spark, SF01).collect()
    truth = {r.doc_id: r.lang for r in table(spark, "documents").select("doc_id", "lang").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_on_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "the cat and the dog", "en", 0.5), (2, "el gato y el perro", "es", 0.5), (2, "el gato y el perro", "es", 0.5), (None, None, None, None),
         (4, "", "en", 0.1), (5, "123", None, 0.2), (6, "the " * 50000, None, None)], "doc_id long, text string, lang string, score double")
    profiles = langid.train(docs)
    out = langid.predict(docs, profiles, keep=["doc_id", "score"])
    assert out.columns == ["doc_id", "lang_pred", "score"]
    assert {r.doc_id: r.lang_pred for r in out.collect()} == {1: "en", 2: "es", None: "und", 4: "und", 5: "und", 6: "en"}
    kept = langid.identified(docs, profiles)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 2, 6]
    empty = langid.train(docs.limit(0))
    assert empty.languages == [] and {r.lang_pred for r in langid.predict(docs, empty).collect()} == {"und"}
    assert langid.predict(docs.limit(0), profiles).collect() == []


def test_gradient_of_the_pu_risk():
    """One step of the fit moves along the gradient of the risk, checked by differences."""
    rng = np.random.default_rng(0)
    pos, un = [np.array([1, 2]), np.array([1])], [np.array([2]), np.array([3]), np.array([1, 3])]

    def risk(w, b, prior=0.3):
        z = np.array([b + w[f].sum() for f in pos + un])
        neg = np.logaddexp(0, z)
        return prior * np.logaddexp(0, -z[:2]).mean() + max(0.0, neg[2:].mean() - prior * neg[:2].mean())

    w, b, eps = rng.normal(size=4) * 0.1, -0.2, 1e-6
    numeric = (risk(w, b + eps) - risk(w, b - eps)) / (2 * eps)
    z = np.array([b + w[f].sum() for f in pos + un])
    p = 1 / (1 + np.exp(-z))
    assert np.isclose(numeric, 0.3 * (p[:2] - 1).mean() + p[2:].mean() - 0.3 * p[:2].mean(), atol=1e-6)


def test_negative_part_is_held_at_zero():
    rng = np.random.default_rng(1)
    pos = [np.r_[7, rng.integers(100, 200, 3)] for _ in range(60)]
    un = [np.r_[7, rng.integers(100, 200, 3)] for _ in range(20)] + [rng.integers(200, 300, 4) for _ in range(180)]
    model = toxicity.fit(pos, un, 0.1)
    assert model.weight[7] > 1 and toxicity._sigmoid(np.array(model.bias + model.weight[7])) > 0.5
    assert toxicity._sigmoid(np.array(model.bias)) < 0.2
    assert not toxicity.fit([], un, 0.1).weight.any() and not toxicity.fit(pos, [], 0.1).weight.any()


def test_toxic_documents_are_found(spark):
    rows = {r.doc_id: r for r in queries.QUERIES["op4_toxicity_pu"](spark, "/root/testdata/sf0.1").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    assert len(rows) == 10000 and all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in rows.items())
    held = [(rows[d].predicted, y) for d, y in labels.items() if rows[d].held_out]
    hit = sum(p and y for p, y in held)
    assert hit >= 0.85 * sum(y for _, y in held) and hit >= 0.7 * sum(p for p, _ in held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())


def test_toxicity_on_odd_rows(spark):
    docs = spark.createDataFrame([(i, f"clean text {i}", 1.0) for i in range(200)] + [(1000 + i, f"you idiot {i}", 1.0) for i in range(60)]
                                 + [(None, None, None), (5, "", 1.0), (5, "", 1.0), (7, "idiot " * 50000, 1.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1000 + i, 1) for i in range(30)] + [(i, 0) for i in range(110)] + [(None, 1), (3, None), (1000, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, "toxic")
    out = {r.doc_id: r.predicted for r in toxicity.predict(docs, model, keep=["doc_id", "score"]).collect()}
    assert out[1050] == 1 and out[7] == 1 and out[150] == 0 and out[None] == 0 and out[5] == 0
    kept = toxicity.clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == 203
    none = toxicity.train(docs.limit(0), labels.limit(0), "toxic")
    assert toxicity.clean(docs, none).count() == docs.count()


def test_isotonic_is_monotone_and_pools():
    assert quality.isotonic(np.array([0.1, 0.5, 0.3, 0.9]), np.array([1, 1, 3, 1])).tolist() == pytest.approx([0.1, 0.35, 0.35, 0.9])
    assert quality.isotonic(np.array([]), np.array([])).tolist() == []


def test_normal_equations_equal_one_machine(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, len(quality.STATISTICS)))
    y = (x[:, 0] > 0).astype(float)
    rows = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "stats array<double>, y double").repartition(7)
    model = quality.train(rows, features=40)
    phi = model.expand(x)
    weight = np.linalg.solve(phi.T @ phi + quality.RIDGE * len(x) * np.eye(41), phi.T @ y)
    assert np.allclose(weight, model.weight, atol=1e-6)
    assert (np.diff(model.probability) >= 0).all()


def test_quality_is_told(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in queries.QUERIES["op10_quality_fourier"](spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == 10000 and all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in rows.items())
    held = [(rows[d].predicted, y) for d, y in labels.items() if rows[d].held_out]
    assert sum(p == y for p, y in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())


def test_quality_on_odd_rows(spark):
    docs = spark.createDataFrame([(i, ("Good text, with many words. " * (1 + i % 3)) if i % 2 else "%%% &&& " * 20, 1.0) for i in range(80)]
                                 + [(None, None, None), (5, "", 1.0), (5, "", 1.0), (7, "x " * 50000, 1.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (3, None), (8, 0)], "doc_id long, quality int")
    rows = quality.predict(docs, labels, "quality", keep=["doc_id", "score"]).collect()
    out = {r.doc_id: r.predicted for r in rows}
    assert len(rows) == 84 and out[71] == 1 and out[70] == 0
    assert {r.score for r in quality.predict(docs.limit(3), labels.limit(0), "quality").collect()} <= {0.5}
    assert quality.predict(docs.limit(0), labels, "quality").collect() == []


def test_toxicity_training_keeps_its_sample_packed():
    import tracemalloc
    rng = np.random.default_rng(3)
    packed = np.sort(rng.integers(0, toxicity.FEATURES, (5000, 400)).astype("<i4"), axis=1)
    rows = list(packed)
    tracemalloc.start()
    toxicity.class_prior(rows[:1000], rows[1000:2000], rows[2000:])
    toxicity.fit(rows[:1000], rows[2000:], 0.1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * packed.nbytes, f"{peak} bytes beside {packed.nbytes}"


def test_toxicity_sample_equals_features_of_the_texts(spark):
    docs = spark.createDataFrame([(1, "Some words here"), (2, None), (3, ""), (4, "other WORDS, longer"), (4, "other WORDS, longer")],
                                 "doc_id long, text string").repartition(3)
    ids = [spark.createDataFrame([(i,) for i in part], "_id long") for part in ([1, 3], [4], [2, 9])]
    found = toxicity._sample(docs, ids, "doc_id", "text")
    assert sorted(x.tolist() for x in found[0]) == sorted(toxicity.features(t).tolist() for t in ("Some words here", ""))
    assert [x.tolist() for x in found[1]] == [toxicity.features("other WORDS, longer").tolist()]
    assert [x.tolist() for x in found[2]] == [[]]
