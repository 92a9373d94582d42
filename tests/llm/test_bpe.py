"""Encoding, decoding and packing against the tokenizers library and exhaustive checks."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF

from idloom.llm import bpe, codec, packing, queries

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def path():
    return queries.tokenizer_path()


@pytest.fixture(scope="module")
def library(path):
    return tokenizers.Tokenizer.from_file(path)


def want(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def odd_texts(n=3000):
    rng = random.Random(1)
    chars = list(" \n\t\r\x0b\x1c\x85\xa0   　ab'sZ1²Ⅷé漢!?_-.́​\x00\x7f😀") + ["<|endoftext|>"]
    made = ["".join(rng.choice(chars) for _ in range(rng.randint(0, 14))) for _ in range(n)]
    return made + [None, "", " ", "   ", " a  b   c ", "x<|endoftext|> y  <|endoftext|>", "a" * 5000, "don't we're I'll", "ab " * 3000]


def test_ids_equal_the_library(path, library):
    coder = bpe.Encoder(path)
    texts = odd_texts()
    ids, at = coder.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want(library, texts)
    for own in want(library, texts)[:500]:
        assert coder.vocabulary.decode(np.array(own, np.int64)).decode() == library.decode(own, skip_special_tokens=False)


def test_ids_that_are_no_text_decode_as_in_the_library(path, library):
    vocabulary = bpe.Vocabulary(path)
    rng = np.random.default_rng(0)
    for _ in range(200):
        ids = rng.integers(0, 50257, 20)
        assert vocabulary.decode(ids).decode() == library.decode(ids.tolist(), skip_special_tokens=False)


def test_lexicon_is_minimal_and_exact(tmp_path):
    words = [b" walking", b" talking", b" walked", b" talked", b" walk", b"\xc3\xa9", b" "]
    ids = [np.array([i, i + 1], np.uint32) for i in range(len(words))]
    arrays = bpe.compile_lexicon(words, ids)
    signatures = {(int(arrays["end"][s]), tuple((int(k) & 255, int(t)) for k, t in zip(arrays["key"], arrays["to"]) if k >> 8 == s))
                  for s in range(len(arrays["end"]))}
    assert len(signatures) == len(arrays["end"])  # no two equal states
    assert len(arrays["key"]) < sum(map(len, words)) / 2
    file = tmp_path / "lexicon"
    file.write_bytes(bpe.Lexicon.dump(arrays))
    lexicon = bpe.Lexicon(str(file))
    rank = lexicon.find(pa.array([w.decode() for w in words] + ["", " wal", " walks", "x"]))
    assert sorted(rank[:7]) == list(range(7)) and (rank[7:] == -1).all()
    for w, own in zip(rank, ids):
        assert lexicon.ids[lexicon.at[w]:lexicon.at[w + 1]].tolist() == own.tolist()
    empty = bpe.compile_lexicon([], [])
    file.write_bytes(bpe.Lexicon.dump(empty))
    assert (bpe.Lexicon(str(file)).find(pa.array(["a", ""])) == -1).all()


def test_lexicon_does_not_change_ids(path, library, tmp_path):
    texts = [" a word and a word", "another word", "words and  words"]
    coder = bpe.Encoder(path)
    words = [" a", " word", " and"]
    file = tmp_path / "lexicon"
    flat, start, size = coder.words(words)
    file.write_bytes(bpe.Lexicon.dump(bpe.compile_lexicon([w.encode() for w in words], [flat[a:a + n] for a, n in zip(start, size)])))
    ids, at = bpe.Encoder(path, str(file)).encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want(library, texts)


def test_query_is_an_exact_round_trip(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = dict(zip(docs, want(library, docs.values())))
    rows = queries.QUERIES["op7_bpe_codec"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        own = ids[r.doc_id]
        assert r.n_tokens == len(own)
        assert r.ids_sha256 == hashlib.sha256(np.array(own, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()


def test_codec_on_odd_rows(spark, path, library):
    rows = [(1, None, "x"), (1, None, "x"), (2, "", "y"), (None, "a  b", "z"), (4, "word " * 20000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = codec.encode(docs, path)
    assert sorted((r.doc_id or 0, len(r.ids)) for r in out.collect()) == sorted(
        (d or 0, len(i)) for (d, _, _), i in zip(rows, want(library, [r[1] for r in rows])))
    back = codec.decode(out, path).collect()
    assert sorted((r.doc_id or 0, r.text) for r in back) == sorted((d or 0, t or "") for d, t, _ in rows)
    assert codec.digests(docs.limit(0), path).collect() == []


@pytest.mark.parametrize("lengths", [[1], [2048], [2047], [2049], [4096], [1] * 5000, [3, 5], [60000], [700] * 300, list(range(1, 400))])
def test_every_token_is_in_one_piece(lengths):
    pieces = packing.pack_block(np.array(lengths), 2048)
    seen, fill = defaultdict(list), defaultdict(list)
    for d, start, n, sequence, offset in pieces:
        seen[d].append((start, n))
        fill[sequence].append((offset, n))
    for d, n in enumerate(lengths):
        at = 0
        for start, m in sorted(seen[d]):
            assert start == at and m > 0
            at += m
        assert at == n
    sizes = []
    for parts in fill.values():
        at = 0
        for offset, m in sorted(parts):
            assert offset == at
            at += m
        assert at <= 2048
        sizes.append(at)
    assert sum(2048 - s for s in sizes if s & (s - 1)) <= 0.02 * sum(sizes) + 2048 * (sum(sizes) < 50 * 2048) * 0.02


def test_differencing_is_near_equal():
    rng = np.random.default_rng(0)
    sizes = np.concatenate([rng.integers(1, 1000, 60), rng.integers(1, 60, 200)])
    where, sums = packing.differencing(sizes, 16)
    assert (np.bincount(where, sizes, 16) == sums).all() and sums.max() - sums.min() <= 8


def test_window_count_rises_over_capacity():
    # three equal halves of a little more than half a window never fit two windows
    pieces = packing.pack_block(np.full(3, 1400), 2048)
    sums = defaultdict(int)
    for _, _, n, sequence, _ in pieces:
        sums[sequence] += n
    assert max(sums.values()) <= 2048


def test_packing_query(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = {d: own + [1] for d, own in zip(docs, want(library, docs.values()))}
    rows = queries.QUERIES["op8_packing"](spark, SF).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        own = ids[r.doc_id][r.start:r.start + r.length]
        assert zlib.crc32(np.array(own, "<u4").tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        by_doc[r.doc_id].append((r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts, size in [(p, len(ids[d])) for d, p in by_doc.items()] + [(p, None) for p in by_sequence.values()]:
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at == size if size is not None else at <= 2048
    assert set(by_doc) == set(ids)


def test_packing_on_odd_rows(spark, path):
    docs = spark.createDataFrame([(1, None, 1), (1, None, 1), (2, "", 2), (None, "a b", 3)], "doc_id long, text string, length long")
    rows = packing.pack(docs, path).collect()
    assert sum(r["length"] for r in rows) == 3 + 3 and all(r.ids[-1:] == [1] or r.start + r["length"] < r.doc_tokens for r in rows)
    assert packing.pack(docs.limit(0), path).collect() == []
    assert packing.pack(docs, path, end_id=None).filter("doc_id IS NOT NULL").collect() == []


def test_words_of_one_slice_stay_known(path, monkeypatch):
    coder = bpe.Encoder(path)
    words = [f" w{i:06d}" for i in range(151_000)]  # as many as 4 MB of text may hold
    first = [x.copy() for x in coder.words(words)]
    asked = []
    merge = coder.vocabulary.merge_spans
    monkeypatch.setattr(coder.vocabulary, "merge_spans", lambda raw, at, n: asked.append(len(n)) or merge(raw, at, n))
    flat, start, size = coder.words(words[::-1] + [" new"])
    assert sum(asked) == 1
    for i in (0, 7, 150_999):
        assert flat[start[-2 - i]:start[-2 - i] + size[-2 - i]].tolist() == first[0][first[1][i]:first[1][i] + first[2][i]].tolist()


def test_words_cut_together_equal_words_cut_alone():
    words = [" a", " b,c", " ", "head", " it's", " x\n", " \ny", "  ", " é ", " 12ab", " 'll", "\n", " \x1c", " \x1cq", "", " !?", " ß1'd"]
    order = list(words)
    found, parts = bpe._pre_tokens(order)
    assert sorted(order) == sorted(words) and len(parts) == len(words)
    at = 0
    for w, n in zip(order, parts.tolist()):
        assert found[at:at + n] == bpe.pattern().findall(w)
        at += n
    assert at == len(found)
