"""Table constraints as operators: the input plus ``reject_reason``, NULL where the rule holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idloom.functions.normalize import doc_number_overflow
from idloom.operators.skew import attach, lookup

#: column -> greatest length
LENGTHS = {"hisnumber": 255, "email": 255, "telephone": 50, "his_password": 100, "login_email": 255}


def check_unique_keys(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """The first row of a key (by ``order``, then all columns) is kept, the rest are rejects.

    Equal rows are folded to one with ``n_kept`` and ``n_rejected``, so neither a key nor a row
    that occurs very often meets in one task.
    """
    cols = df.columns
    rank = F.struct(*(order or []), *cols)
    folded = df.groupBy(*cols).agg(F.count("*").alias("_copies"))
    first = folded.groupBy(*keys).agg(F.min(rank).alias("_first"), F.count("*").alias("_rows"))
    checked = attach(folded, first, keys, "_rows", null_safe=True)
    unbound = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    kept = F.when(unbound, F.col("_copies")).when(rank.eqNullSafe(F.col("_first")), 1).otherwise(0).cast("long")
    return checked.select(
        *cols, kept.alias("n_kept"), (F.col("_copies") - kept).alias("n_rejected"),
        F.when(F.col("_copies") > kept, "DUPLICATE_KEY").alias("reject_reason"))


def check_mobile_has_number(mobile: DataFrame) -> DataFrame:
    return mobile.withColumn("reject_reason", F.when(
        F.col("hisnumber_a").isNull() & F.col("hisnumber_b").isNull(), "NO_NUMBER"))


def check_foreign_keys(df: DataFrame, dims: dict[str, DataFrame], patients: DataFrame | None = None) -> DataFrame:
    """First reference that points nowhere: source, unit, document type, golden row. NULL references pass."""
    out, rules = df, []
    for col, dim, reason in (("source", "sources", "FK_SOURCE"), ("businessunit", "businessunits", "FK_UNIT"),
                             ("documenttypes", "documenttypes", "FK_DOCUMENT_TYPE")):
        if col in df.columns:
            ids = dims[dim].select(F.col("id").alias(f"_{col}"))
            out = out.join(F.broadcast(ids), F.col(col) == F.col(f"_{col}"), "left")
            rules.append((F.col(col).isNotNull() & F.col(f"_{col}").isNull(), reason))
    if patients is not None:
        out = lookup(out, patients.select("uuid", F.lit(True).alias("_known")), ["uuid"])
        rules.append((F.col("uuid").isNotNull() & F.col("_known").isNull(), "FK_PATIENT"))
    reason = F.lit(None).cast("string")
    for broken, name in reversed(rules):
        reason = F.when(broken, name).otherwise(reason)
    return out.select(*df.columns, reason.alias("reject_reason"))


def check_not_null(df: DataFrame, required: list[str]) -> DataFrame:
    """Name of the first required column that is NULL."""
    reason = F.lit(None).cast("string")
    for c in reversed(required):
        reason = F.when(F.col(c).isNull(), f"NULL_{c.upper()}").otherwise(reason)
    return df.withColumn("reject_reason", reason)


def check_lengths(df: DataFrame, limits: dict[str, int] | None = None, number: str | None = "document_number") -> DataFrame:
    """Text longer than its column, or document digits beyond the BIGINT range."""
    reason = F.lit(None).cast("string")
    if number in df.columns:
        reason = F.when(doc_number_overflow(F.col(number).cast("string")), "DOCUMENT_RANGE")
    for c, n in reversed((limits or LENGTHS).items()):
        if c in df.columns:
            reason = F.when(F.length(c) > n, f"TOO_LONG_{c.upper()}").otherwise(reason)
    return df.withColumn("reject_reason", reason)
