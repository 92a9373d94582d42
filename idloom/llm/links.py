"""From links to components: stars inside a task, connected components across tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idloom.operators.merge import merge_components


def stars(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the least node it is joined to by the links (a, b): a star instead of all pairs."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            break
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:  # every node straight to its root
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def components(edges: DataFrame, a: str, b: str, node: str) -> DataFrame:
    """(``node``, component): every node that occurs in an edge, with the least node it is connected to."""
    found = merge_components(edges.select(F.col(a).alias("uuid"), F.col(b).alias("other_uuid")).distinct())
    return found.withColumnRenamed("uuid", node)
