"""BPE encoding and decoding of whole texts, with the frequent words in a minimal acyclic transducer."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from idloom.llm import bpe
from idloom.llm.tables import annotate


def encode(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
           lexicon_size: int = 32768, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: the id) and ``ids``, the token ids of each whole text.

    Null and empty texts have no ids. Equal rows give equal results, whichever task they are in. One
    pass counts the words of all texts, a second one encodes; words outside the lexicon are merged
    exactly, so its size changes the time and never the ids. No text is shuffled.
    """
    name = bpe.lexicon(docs, tokenizer, lexicon_size, text)

    def work(texts):
        ids, at = bpe.encoder(tokenizer, name).encode(texts)
        yield pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int64)))

    return annotate(docs, text, "ids array<bigint>", work, keep or [doc_id])


def decode(tokens: DataFrame, tokenizer: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all other columns) and ``text``, the decoded ids; null ids give a null text."""
    kept = [c for c in keep or tokens.columns if c not in (ids, "text")]

    def run(batches):
        for batch in batches:
            vocabulary = bpe.encoder(tokenizer).vocabulary
            rows = batch.column("_ids").to_pylist()
            out = [None if r is None else vocabulary.decode(np.array(r, np.int64)).decode() for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(out, pa.string())], names=[*kept, "text"])

    source = tokens.select(*[f"`{c}`" for c in kept], tokens[ids].alias("_ids"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "_ids"] + ["text string"])
    return source.mapInArrow(run, schema)


def digests(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
            lexicon_size: int = 32768) -> DataFrame:
    """Round trip of each whole text: (doc_id, n_tokens, ids_sha256, decoded_sha256).

    The ids of a batch are encoded, hashed and decoded again in the task that reads its texts, so
    neither ids nor decoded texts leave it. Null and empty texts: no tokens, the digest of nothing.
    """
    name = bpe.lexicon(docs, tokenizer, lexicon_size, text)

    def work(texts):
        coder = bpe.encoder(tokenizer, name)
        ids, at = coder.encode(texts)
        spans = [ids[a:b] for a, b in zip(at, at[1:])]
        yield pa.array(np.diff(at), pa.int64())
        yield pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in spans])
        yield pa.array([hashlib.sha256(coder.vocabulary.decode(x)).hexdigest() for x in spans])

    return annotate(docs, text, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", work, [doc_id])
