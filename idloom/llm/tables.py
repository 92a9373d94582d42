"""Small helpers shared by the operators: label folds, Arrow batches by bytes, row-wise annotation."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: bytes of text that a task works on at a time; bounds its memory whatever the row sizes are
SLICE_BYTES = 4 << 20


def fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as an empty text (crc32 is 0)."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(modulus))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of one piece hold about ``limit`` bytes (one text at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        block = np.cumsum(lengths) // limit
        starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], len(block)]):
            yield batch.slice(int(a), int(b - a))


def annotate(df: DataFrame, text: str, columns: str, work: Callable, keep: list[str]) -> DataFrame:
    """``df`` reduced to the columns ``keep`` plus what ``work`` makes of the texts, row by row.

    ``work`` takes a string array and returns one array for each column of the DDL string ``columns``;
    it runs inside the scan's own tasks, without a shuffle. A kept column of one of the new names is
    replaced, so extra columns never clash.
    """
    added = [c.split()[0] for c in columns.split(", ")]
    kept = [c for c in keep if c not in added]
    source = df.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(kept)],
                       F.col(f"`{text}`").cast("string").alias("_text"))

    def run(batches):
        for part in slices(batches, "_text"):
            yield pa.RecordBatch.from_arrays(
                [part.column(i) for i in range(len(kept))] + list(work(part.column("_text"))), names=kept + added)

    schema = ", ".join([f"`{c}` {f.dataType.simpleString()}" for c, f in zip(kept, source.schema)] + [columns])
    return source.mapInArrow(run, schema)


def retain(df: DataFrame, text: str, test: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """The rows of ``df``, columns unchanged, whose text passes ``test`` (string array in, booleans out)."""
    def run(batches):
        for part in slices(batches, text):
            yield part.filter(pa.array(test(part.column(text)), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def hashed_sample(df: DataFrame, key: list[str], n: int, seed: int = 0) -> DataFrame:
    """The ``n`` rows (all, if there are fewer) of least hash of ``key``: the same ones wherever they lie.

    Rows whose hash is far above the n-th least are filtered out in the scan, so that tasks do not each send ``n`` rows.
    """
    total = df.count()
    share = min(1.0, 2 * n / max(1, total) + 50 / max(1, total))
    h = F.xxhash64(*key, F.lit(seed))
    few = df if share == 1.0 else df.filter(h < F.lit(int(-(2 ** 63) + share * 2.0 ** 64)))
    return few.orderBy(h, *key).limit(n)
