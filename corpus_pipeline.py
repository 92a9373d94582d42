"""A cleaning pipeline over ``documents``: language, toxicity, near-duplicates, packing.

Every stage takes (spark, docs, sf_dir) and works on all documents that the one before it kept. All but the last
return the columns of ``documents`` unchanged; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from idloom.llm import langid, packing, simhash, toxicity
from idloom.llm.queries import table, tokenizer_path
from idloom.session import cut, tune


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; null, empty and letterless texts are rejected.

    The profiles are learned from the documents that name their language.
    """
    return langid.identified(docs, langid.train(docs))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold of toxicity. Labels of documents that are gone by now still train."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), "toxic")
    return toxicity.clean(docs, model, threshold=0.3)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, that of least id."""
    return simhash.representatives(docs, words=3, radius=3)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer_path(), window=2048, end_id=1, ids=False)


STAGES = [("language", language), ("toxicity", toxic), ("near_duplicates", near_duplicates), ("packing", packed)]

#: SQL has no XXH64, no tokenizer and no training; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, each one's result written and read again."""
    docs = table(tune(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
