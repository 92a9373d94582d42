"""Lookups over the integrated tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from idloom.functions.normalize import iso_date
from idloom.operators.matching import mobile_user_lookup  # noqa: F401  (part of this surface)
from idloom.operators.skew import attach_by
from idloom.session import cut


def det_with_golden(det: DataFrame, patients: DataFrame) -> DataFrame:
    """Stored records with the document of their golden row; records without one are left out."""
    golden = patients.select("uuid", F.col("documenttypes").alias("p_documenttypes"),
                             F.col("document_number").alias("p_document_number"), F.col("uuid").alias("p_uuid"))
    return attach_by(det, golden, "uuid").filter(F.col("p_uuid").isNotNull())


def key_exists(keys: DataFrame, det: DataFrame) -> DataFrame:
    """Whether each (hisnumber, source) is stored."""
    asked = keys.select("hisnumber", "source").distinct()
    there = det.select("hisnumber", "source").join(asked, ["hisnumber", "source"], "left_semi").distinct()
    return asked.join(there.withColumn("_k", F.lit(True)), ["hisnumber", "source"], "left").select(
        "hisnumber", "source", F.col("_k").isNotNull().alias("found"))


def patient_details(patients: DataFrame, protocols: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Golden rows with the name of their primary source and their number of protocols."""
    names = dims["sources"].select(F.col("id").alias("primary_source"), F.col("name").alias("primary_source_name"))
    counts = protocols.groupBy("uuid").agg(F.count("*").alias("protocol_count"))
    return (patients.join(F.broadcast(names), "primary_source", "left").join(counts, "uuid", "left")
            .withColumn("protocol_count", F.coalesce("protocol_count", F.lit(0)))
            .select(*patients.columns, "primary_source_name", "protocol_count"))


def _named(df: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    src = dims["sources"].select(F.col("id").alias("source"), F.col("name").alias("source_name"))
    unit = dims["businessunits"].select(F.col("id").alias("businessunit"), F.col("name").alias("businessunit_name"))
    return df.join(F.broadcast(src), "source").join(F.broadcast(unit), "businessunit")


def patient_protocols(protocols: DataFrame, dims: dict[str, DataFrame], uuids: DataFrame | None = None) -> DataFrame:
    """Protocols with names: of all persons in no order, or of the persons in the table ``uuids``, the latest
    of a person first and the lesser id first within a day."""
    rows = protocols if uuids is None else protocols.join(uuids.select("uuid").distinct(), "uuid", "left_semi")
    out = _named(rows, dims).select(
        "id", "uuid", "source", "source_name", "businessunit", "businessunit_name", "date", "doctor",
        "protocolname", "servicename", "servicecode")
    return out if uuids is None else out.orderBy("uuid", F.col("date").desc(), "id")


def patient_raw_records(det: DataFrame, dims: dict[str, DataFrame], uuids: DataFrame | None = None) -> DataFrame:
    """Stored records with names: of all persons in no order, or of the persons in the table ``uuids`` in the
    order source, number of a person."""
    rows = det if uuids is None else det.join(uuids.select("uuid").distinct(), "uuid", "left_semi")
    cols = [c for c in ("email", "telephone") if c in det.columns]
    out = _named(rows, dims).select(
        "uuid", "hisnumber", "source", "source_name", "businessunit", "businessunit_name", "lastname", "name",
        "surname", "birthdate", "documenttypes", "document_number", *cols)
    return out if uuids is None else out.orderBy("uuid", "source", "hisnumber")


def mobile_user_by_uuid(uuids: DataFrame, mobile: DataFrame) -> DataFrame:
    return mobile.join(uuids.select("uuid").distinct(), "uuid", "left_semi").select("uuid", "hisnumber_a", "hisnumber_b")


def find_by_credentials(requests: DataFrame, patients: DataFrame) -> DataFrame:
    """Golden row of each request: by login and password of either source, else by name and birth date.

    Requests are (request_id, lastname, firstname, midname, bdate, cllogin, clpassword). Several hits:
    the least uuid. Both passes ask each distinct question once, so neither a popular name nor a shared login piles up.
    """
    logins = patients.select(F.explode(F.array(
        F.struct(F.col("login_a").alias("cllogin"), F.col("password_a").alias("clpassword")),
        F.struct(F.col("login_b").alias("cllogin"), F.col("password_b").alias("clpassword")))).alias("l"), "uuid").select(
        "l.cllogin", "l.clpassword", "uuid").dropna(subset=["cllogin", "clpassword"])
    on = ["cllogin", "clpassword"]
    by_login = logins.join(requests.select(*on), on, "left_semi").groupBy(*on).agg(F.min("uuid").alias("by_login"))
    # staged once: the names that are still asked for meet the people, then the answers meet the requests
    asked = cut(requests.join(by_login, on, "left").withColumns({
        "_l": F.when(F.col("by_login").isNull(), F.col("lastname")), "_f": F.col("firstname"),
        "_m": F.coalesce("midname", F.lit("")), "_b": iso_date(F.col("bdate"))}))
    names = ["_l", "_f", "_m", "_b"]
    # a missing middle name asks for patients without one; '' in a patient is a value and matches nothing
    people = patients.filter(F.col("surname").isNull() | (F.col("surname") != "")).select(
        F.col("lastname").alias("_l"), F.col("name").alias("_f"), F.coalesce("surname", F.lit("")).alias("_m"),
        F.col("birthdate").alias("_b"), "uuid").dropna(subset=["_l", "_f", "_b"])
    by_name = people.join(asked.select(*names), names, "left_semi").groupBy(*names).agg(F.min("uuid").alias("by_name"))
    return asked.join(by_name, names, "left").select(
        *requests.columns, F.coalesce("by_login", "by_name").alias("uuid"),
        F.when(F.col("by_login").isNotNull(), "LOGIN").when(F.col("by_name").isNotNull(), "PERSONAL").alias("found_by"))


def _grams(text: Column, n: int) -> Column:
    """All substrings of length ``n``."""
    starts = F.sequence(F.lit(1), F.length(text) - (n - 1))
    return F.when(F.length(text) >= n, F.transform(starts, lambda i: F.struct(F.lit(n).alias("n"), F.substring(text, i, F.lit(n)).alias("gram")))).otherwise(
        F.array().cast("array<struct<n:int,gram:string>>"))


def similar_ids(requests: DataFrame, ids: DataFrame, k: int = 20) -> DataFrame:
    """Ids that contain the part before '/' of a requested id, the first ``k`` of each request.

    An id is a candidate if it has the end of the pattern, cut to a power of two characters: an id has at most
    eight lengths of such pieces whatever is asked, and a piece is at least half of the pattern. Candidates are
    checked for the whole pattern.
    """
    patterns = requests.select("hisnumber", F.split("hisnumber", "/")[0].alias("pattern")).distinct()
    size = F.pow(F.lit(2), F.floor(F.log2(F.length("pattern")))).cast("int")
    asked = patterns.filter("pattern <> ''").select("pattern").distinct().withColumn("n", size).withColumn(
        "gram", F.expr("right(pattern, n)"))
    parts = F.array_distinct(F.flatten(F.array(*[_grams(F.col("id"), 1 << i) for i in range(8)])))
    named = ids.select(F.col("hisnumber").alias("id")).distinct()
    pieces = named.select("id", F.explode(parts).alias("p")).select("id", "p.n", "p.gram").join(
        F.broadcast(asked.select("n").distinct()), "n", "left_semi")
    # a size estimate knows nothing of the explode, by which the pieces outgrow any broadcast
    hits = pieces.hint("merge").join(asked, ["n", "gram"]).filter(F.contains("id", "pattern"))
    # the row number filter keeps k rows of a pattern per map task already
    top = hits.withColumn("rank", F.row_number().over(Window.partitionBy("pattern").orderBy("id"))).filter(F.col("rank") <= k)
    return patterns.join(top, "pattern").select("hisnumber", "pattern", F.col("id").alias("similar_id"), "rank")


def trace_record(keys: DataFrame, stages: dict[str, DataFrame]) -> DataFrame:
    """Each key followed through the stages, dry run: what is in ``raw``, what ``conformed`` makes of
    it, whether ``det`` has it, and what a sync would do."""
    on = ["hisnumber", "source"]
    asked = keys.select(*on).distinct()
    raw = stages["raw"].join(asked, on, "left_semi").groupBy(*on).agg(F.count("*").alias("raw_rows"))
    conformed = stages["conformed"].join(asked, on, "left_semi").select(
        *on, "businessunit", "birthdate", "documenttypes", "document_number", "telephone", "reject_reason", F.lit(True).alias("_c"))
    stored = stages["det"].join(asked, on, "left_semi").select(
        *on, "uuid", F.col("documenttypes").alias("stored_documenttypes"), F.col("document_number").alias("stored_document_number"), F.lit(True).alias("_d"))
    out = asked.join(raw, on, "left").join(conformed, on, "left").join(stored, on, "left")
    return out.select(
        *on, F.coalesce("raw_rows", F.lit(0)).alias("raw_rows"), F.col("_c").isNotNull().alias("is_conformed"),
        "businessunit", "birthdate", "documenttypes", "document_number", "telephone", "reject_reason",
        F.col("_d").isNotNull().alias("is_stored"), "uuid", "stored_documenttypes", "stored_document_number",
        F.when(F.col("_c").isNull(), "NOT_IN_SOURCE").when(F.col("reject_reason").isNotNull(), "REJECT")
        .when(F.col("_d").isNotNull(), "UPSERT").otherwise("INSERT").alias("decision"))
