"""What the vector operators share: which vectors take part, samples, keyed task groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idloom.llm.tables import hashed_sample


def usable(vector: str) -> Column:
    """Not null, no null or non-finite component, and not zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def common_size(df: DataFrame, vector: str) -> int:
    """The most frequent vector length, the least one on a tie; 0 without rows."""
    top = df.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return top[0]["d"] if top else 0


def matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    """An array column without nulls as a double matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def sample(df: DataFrame, vector: str, size: int, rows: int) -> np.ndarray:
    """At most ``rows`` vectors, chosen by a hash of their components."""
    some = hashed_sample(df.select(vector), [vector], rows).toArrow()
    return matrix(some[vector], size) if some.num_rows else np.empty((0, size))


def by_key(df: DataFrame, key: list[str], work: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``work`` on the rows of each key together; the caller bounds how many rows a key has.

    Rows are dealt by the key and sorted, so a task holds one key at a time.
    """
    def run(batches):
        left = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if left is None else pa.concat_tables([left, table])
            keys = np.stack([table[c].to_numpy() for c in key])
            cuts = np.r_[0, np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1]
            for a, b in zip(cuts, cuts[1:]):
                yield from work(table.slice(int(a), int(b - a)))
            left = table.slice(int(cuts[-1]))
        if left is not None:
            yield from work(left)

    return df.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, schema)
