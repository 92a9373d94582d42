"""Mobile registrations and credentials, as request tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idloom.operators.lookups import find_by_credentials
from idloom.session import cut


def _latest(updates: DataFrame, columns: list[str]) -> DataFrame:
    """One update per uuid: the last filled value of each column by request_id."""
    return updates.groupBy("uuid").agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), F.col("request_id"))).alias(f"_{c}") for c in columns])


def _filled(df: DataFrame, updates: DataFrame, columns: list[str]) -> DataFrame:
    """New value where there is one, else the old."""
    return df.join(_latest(updates, columns), "uuid", "left").withColumns(
        {c: F.coalesce(f"_{c}", c) for c in columns}).select(*df.columns)


NUMBERS = ("hisnumber_a", "hisnumber_b")


def _asked(requests: DataFrame) -> DataFrame:
    """(request_id, kind, number): each number a request asks for."""
    pairs = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("number")) for c in NUMBERS])
    return requests.select("request_id", F.explode(pairs).alias("n")).select("request_id", "n.kind", "n.number").filter("number IS NOT NULL")


def mobile_register(requests: DataFrame, mobile: DataFrame, enabled: bool = True,
                    require_both: bool = False) -> tuple[DataFrame, DataFrame]:
    """Accepted registrations (uuid, hisnumber_a, hisnumber_b, request_id) and rejects.

    Requests count in the order of ``request_id``; a number that is registered, or was given to an
    earlier accepted request, is taken. Blank numbers count as missing.

    In each round the requests that come first for all their numbers win, and in the next those that ask for a
    number just given lose. The least open request always wins, so rounds go on until none is open; each one
    reads the open requests only, and a chain of n requests that wait for each other takes n / 2 rounds.
    """
    asked = requests.select("request_id", *[F.nullif(F.col(c), F.lit("")).alias(c) for c in NUMBERS])
    a, b = F.col("hisnumber_a"), F.col("hisnumber_b")
    policy = F.when(F.lit(not enabled), "DISABLED").when(a.isNull() & b.isNull(), "NO_NUMBER")
    if require_both:
        policy = policy.when(a.isNull() | b.isNull(), "BOTH_REQUIRED")
    ruled = cut(asked.withColumn("reject_reason", policy))
    settled = [ruled.filter(F.col("reject_reason").isNotNull()).withColumn("state", F.lit("rejected"))]
    rest = ruled.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    given = mobile.select(F.lit(None).cast("long").alias("request_id"), *NUMBERS)
    while True:
        taken = _asked(given).select("kind", "number").distinct()
        numbers = _asked(rest)
        lost = numbers.join(taken, ["kind", "number"], "left_semi").select("request_id").distinct().withColumn("_lost", F.lit(True))
        left = rest.join(lost, "request_id", "left")
        # of the requests that have not lost, those that are first for every number they ask for
        standing = numbers.join(lost, "request_id", "left_anti")
        firsts = standing.groupBy("kind", "number").agg(F.min("request_id").alias("request_id")).groupBy("request_id").agg(
            F.count("*").alias("_firsts"))
        wanted = sum((F.col(c).isNotNull().cast("int") for c in NUMBERS), F.lit(0))
        state = F.when(F.col("_lost"), "rejected").when(F.col("_firsts") == wanted, "accepted").otherwise("open")
        done = cut(left.join(firsts, "request_id", "left").select(*asked.columns, F.when(F.col("_lost"), "NUMBER_TAKEN").alias("reject_reason"),
                                                                 state.alias("state")))
        settled.append(done.filter("state <> 'open'"))
        rest = done.filter("state = 'open'").select(*asked.columns)
        given = done.filter("state = 'accepted'").select(*asked.columns)
        if rest.isEmpty():
            break
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    accepted, rejected = out.filter("state = 'accepted'"), out.filter("state = 'rejected'")
    return accepted.select(
        F.md5(F.concat(F.lit("mobile-request|"), F.col("request_id").cast("string"))).alias("uuid"), *NUMBERS, "request_id"), \
        rejected.select(*asked.columns, "reject_reason")


def mobile_update_numbers(mobile: DataFrame, updates: DataFrame) -> DataFrame:
    """Registrations after number updates (request_id, uuid, hisnumber_a, hisnumber_b); NULL keeps the old number."""
    return _filled(mobile, updates, ["hisnumber_a", "hisnumber_b"])


def mobile_update_number(mobile: DataFrame, updates: DataFrame, source: int) -> DataFrame:
    """The one-source variant: (request_id, uuid, hisnumber) sets the number of ``source``."""
    mine, other = ("hisnumber_a", "hisnumber_b") if source == 1 else ("hisnumber_b", "hisnumber_a")
    return mobile_update_numbers(mobile, updates.select(
        "request_id", "uuid", F.col("hisnumber").alias(mine), F.lit(None).cast("string").alias(other)))


def credentials_update(patients: DataFrame, updates: DataFrame) -> DataFrame:
    """Golden rows after credential updates (request_id, uuid, login_a, password_a, login_b, password_b)."""
    return _filled(patients, updates, ["login_a", "password_a", "login_b", "password_b"])


def classify_requests(requests: DataFrame, patients: DataFrame) -> DataFrame:
    """What a check-and-modify request has to do: operation, and the sources it has to be created in."""
    found = cut(find_by_credentials(requests, patients))
    numbers = patients.select("uuid", *[F.nullif(F.col(c), F.lit("")).alias(c) for c in ("hisnumber_a", "hisnumber_b")])
    hits = found.filter(F.col("uuid").isNotNull())
    wanted = numbers.join(hits.select("uuid"), "uuid", "left_semi")
    known = found.join(wanted.withColumn("_k", F.lit(True)), "uuid", "left")
    missing = F.array_compact(F.array(F.when(F.col("hisnumber_a").isNull(), "A"), F.when(F.col("hisnumber_b").isNull(), "B")))
    return known.select(
        "request_id", "uuid", "hisnumber_a", "hisnumber_b",
        F.when(F.col("_k").isNull(), "new_patient_created").when(F.size(missing) == 0, "both_exist_updated")
        .otherwise("missing_created").alias("operation"),
        F.concat_ws(",", missing).alias("targets"))
