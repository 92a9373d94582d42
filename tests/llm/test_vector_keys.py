"""Near-duplicate vectors whose ids are null, or name several different vectors."""

import pytest

from idloom.llm import multiindex


def unit(turn):
    return [1.0, 0.0, turn, 0.0]


@pytest.mark.parametrize("shard", [1, 512])
def test_null_and_repeated_ids_on_different_near_vectors(spark, shard):
    rows = [(None, unit(0.0), 1), (3, unit(0.05), 1), (None, unit(0.1), 1),  # one component, two rows of it without an id
            (7, unit(0.0), 2), (7, unit(0.05), 2), (9, unit(0.1), 2),  # one id on two vectors
            (None, unit(0.0), 3), (None, unit(0.05), 3),  # no id at all
            (5, unit(0.0), 4), (5, [0.0, 1.0, 0.0, 0.0], 4), (6, [0.0, 1.0, 0.05, 0.0], 4)]  # one id in two components
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(map(tuple, multiindex.near_duplicates(df, words=2, shard=shard, recall=1.0).collect()), key=str)
    want = [(None, 2, 3, True), (3, 2, 3, True), (None, 2, 3, True), (7, 2, 7, True), (7, 2, 7, True), (9, 2, 7, False),
            (None, 1, None, True), (None, 1, None, True), (5, 0, 5, True), (5, 1, 5, True), (6, 1, 5, False)]
    assert got == sorted(want, key=str)
