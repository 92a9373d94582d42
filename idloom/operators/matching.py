"""Identity resolution of new records: mobile registration, source number, document, new.

The order in which records reach a golden row decides what wins. It is fixed here as
(phase, source, hisnumber): phase 0 holds the records linked by a registration or a number, phase 1
the rest. All "first record wins" rules are aggregates over that order, which combine on the map
side; no step sorts the members of a cluster.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from idloom import schemas
from idloom.operators.skew import attach, salted
from idloom.schemas import BLOCK, DEMOGRAPHICS, SUFFIX
from idloom.session import cut


@dataclass
class Resolution:
    """``assigned``: records with uuid and match type; ``golden``: all golden rows afterwards;
    ``log``: audit rows; ``rejects``: records with reason; ``touched``: the golden rows that are new or changed."""

    assigned: DataFrame
    golden: DataFrame
    log: DataFrame
    rejects: DataFrame
    touched: DataFrame | None = None


def order() -> Column:
    return F.struct("phase", "source", "hisnumber")


def new_uuid(source: Column, hisnumber: Column) -> Column:
    """Golden id of a new person, from the key of its first record: a retry gives the same id."""
    return F.md5(F.concat_ws("|", F.lit("p"), source.cast("string"), hisnumber))


def is_mobile() -> Column:
    return F.coalesce("registered_via_mobile", F.lit(False))


def is_locked() -> Column:
    return F.coalesce("matching_locked", F.lit(False))


def by_number(df: DataFrame, *columns: str) -> DataFrame:
    """One row per source number: (source, hisnumber, *columns)."""
    pairs = F.array(*[F.struct(F.lit(s).alias("source"), F.col(f"hisnumber_{x}").alias("hisnumber"))
                      for s, x in SUFFIX.items()])
    return df.select(F.explode(pairs).alias("_n"), *columns).select(
        "_n.source", "_n.hisnumber", *columns).filter(F.col("hisnumber").isNotNull())


def mobile_user_lookup(records: DataFrame, mobile: DataFrame) -> DataFrame:
    """Registration of each (source, hisnumber), NULL if there is none."""
    users = by_number(mobile.withColumnRenamed("uuid", "mobile_app_uuid"), "mobile_app_uuid")
    return records.join(users, ["source", "hisnumber"], "left").select(*records.columns, "mobile_app_uuid")


def number_links(batch: DataFrame, mobile: DataFrame, patients: DataFrame) -> DataFrame:
    """What is known about each source number of the batch: its registration and the golden row that
    holds it. The large tables are reduced to the batch's keys before anything is shuffled."""
    keys = batch.select("source", "hisnumber")
    users = by_number(mobile.withColumnRenamed("uuid", "m_uuid"), "m_uuid").join(keys, ["source", "hisnumber"], "left_semi")
    state = patients.select(F.col("uuid").alias("m_uuid"), is_locked().alias("m_locked")).join(
        users.select("m_uuid"), "m_uuid", "left_semi")
    registered = users.join(state, "m_uuid", "left").select(
        "source", "hisnumber", "m_uuid", F.col("m_locked").isNotNull().alias("m_known"),
        F.coalesce("m_locked", F.lit(False)).alias("m_locked"))
    held = by_number(patients.select(
        F.col("uuid").alias("p_uuid"), is_locked().alias("p_locked"), "hisnumber_a", "hisnumber_b"),
        "p_uuid", "p_locked").join(keys, ["source", "hisnumber"], "left_semi")
    return registered.unionByName(held, allowMissingColumns=True).groupBy("source", "hisnumber").agg(
        *[F.max(c).alias(c) for c in ("m_uuid", "m_known", "m_locked", "p_uuid", "p_locked")])


def keyed(batch: DataFrame, mobile: DataFrame, patients: DataFrame) -> DataFrame:
    """Batch rows with what priorities 1 and 2 find, ``link``, ``phase`` and ``reject_reason``."""
    found = batch.join(number_links(batch, mobile, patients), ["source", "hisnumber"], "left")
    taken = F.col("m_uuid").isNotNull() & F.col("p_uuid").isNotNull() & (F.col("m_uuid") != F.col("p_uuid"))
    link = F.coalesce("m_uuid", "p_uuid")
    return found.withColumns({
        "link": link, "phase": F.when(link.isNull(), 1).otherwise(0),
        "reject_reason": F.when(F.coalesce("m_locked", F.lit(False)) | F.coalesce("p_locked", F.lit(False)), "LOCKED")
        .when(taken, "NUMBER_TAKEN")})


def document_owners(patients: DataFrame, linked: DataFrame, asked: DataFrame) -> DataFrame:
    """Unlocked golden row that owns each ``asked`` document once the linked records are in:
    (documenttypes, document_number, owner). Several owners: a mobile registration first, then the
    least uuid."""
    docs = ["documenttypes", "document_number"]
    held = patients.filter(~is_locked()).select("uuid", *docs, is_mobile().alias("mobile"))
    brought = linked.groupBy(F.col("link").alias("uuid")).agg(
        F.min_by("documenttypes", order()).alias("t1"),
        F.min_by("document_number", F.when(F.col("document_number").isNotNull(), order())).alias("n1"),
        F.bool_or(F.col("m_uuid").isNotNull()).alias("m1"))
    before = held.join(brought.select("uuid"), "uuid", "left_semi")
    after = brought.join(before, "uuid", "left").select(
        "uuid", F.coalesce("documenttypes", "t1").alias("documenttypes"),
        F.coalesce("document_number", "n1").alias("document_number"), F.coalesce("mobile", "m1").alias("mobile"))
    owned = salted(held, asked.select(*docs), docs, "left_semi").unionByName(after.dropna(subset=docs))
    return owned.groupBy(*docs).agg(F.min(F.struct(~F.col("mobile"), F.col("uuid").alias("uuid")))["uuid"].alias("owner"))


def assign(batch: DataFrame, mobile: DataFrame, patients: DataFrame,
           keep: Callable[[DataFrame], DataFrame] = cut) -> DataFrame:
    """The priority ladder: every batch row with uuid, match_type and mobile_app_uuid, or a reject reason.

    ``keep`` materialises the batch with its links, from which several branches start.
    """
    rows = keep(keyed(batch, mobile, patients))
    good = rows.filter(F.col("reject_reason").isNull())
    # priorities 1 and 2: a golden row has one number per source, so a link has a handful of records
    linked = good.filter(F.col("link").isNotNull())
    first = F.row_number().over(Window.partitionBy("link").orderBy("source", "hisnumber")) == 1
    by_link = linked.withColumn("_first", first).withColumns({
        "uuid": F.col("link"),
        "match_type": F.when(F.col("m_uuid").isNull(), "UPDATED_EXISTING")
        .when(~F.col("m_known") & F.col("_first"), "MOBILE_APP_NEW").otherwise("MOBILE_APP_UPDATE")}).drop("_first")
    # priority 3: settle each document once, then hand the answer to its records
    free = good.filter(F.col("link").isNull())
    has_doc = F.col("documenttypes").isNotNull() & F.col("document_number").isNotNull()
    groups = free.filter(has_doc).groupBy("documenttypes", "document_number").agg(
        F.min(F.struct("source", "hisnumber")).alias("_lead"), F.count("*").alias("_rows"))
    settled = groups.join(document_owners(patients, linked, groups), ["documenttypes", "document_number"], "left").select(
        F.col("documenttypes").alias("_t"), F.col("document_number").alias("_n"), "_lead", "_rows", "owner")
    placed = attach(free.withColumns({"_t": F.when(has_doc, F.col("documenttypes")),
                                      "_n": F.when(has_doc, F.col("document_number"))}), settled, ["_t", "_n"], "_rows")
    leads = F.col("_lead").isNull() | (F.col("_lead") == F.struct("source", "hisnumber"))
    by_doc = placed.withColumns({
        "uuid": F.coalesce("owner", new_uuid(F.coalesce("_lead.source", "source"), F.coalesce("_lead.hisnumber", "hisnumber"))),
        "match_type": F.when(F.col("_lead").isNull(), "NEW_NO_DOCUMENT")
        .when(F.col("owner").isNotNull() | ~leads, "MATCHED_DOCUMENT").otherwise("NEW_WITH_DOCUMENT")})
    bad = rows.filter(F.col("reject_reason").isNotNull()).withColumns({
        "uuid": F.lit(None).cast("string"), "match_type": F.lit(None).cast("string")})
    cols = [*batch.columns, "phase", "m_uuid", "reject_reason"]
    cols = [c for c in cols if c != "uuid"] + ["uuid", "match_type"]
    return by_link.select(*cols).unionByName(by_doc.select(*cols)).unionByName(bad.select(*cols)).withColumnRenamed(
        "m_uuid", "mobile_app_uuid")


def survivorship(assigned: DataFrame, patients: DataFrame) -> DataFrame:
    """All golden rows after the batch. Rows the batch does not touch pass through without a shuffle when the batch is small."""
    return overlay(patients, touched_by(assigned, patients))


def overlay(patients: DataFrame, touched: DataFrame, gone: DataFrame | None = None) -> DataFrame:
    """Golden rows with those in ``touched`` put in, and those of the uuids in ``gone`` taken out."""
    stale = touched.select("uuid") if gone is None else touched.select("uuid").unionByName(gone.select("uuid"))
    kept = schemas.fit(patients, schemas.GOLDEN).join(stale, "uuid", "left_anti")
    return touched.select(*schemas.GOLDEN.fieldNames()).unionByName(kept.select(*schemas.GOLDEN.fieldNames()))


def touched_by(assigned: DataFrame, patients: DataFrame) -> DataFrame:
    """Golden rows that the batch makes or changes: what a golden row has stays, gaps are filled by the first
    record that has a value, the contact block of a source is the one of its last record."""
    linked = F.col("phase") == 0
    numbered = F.col("document_number").isNotNull()

    def first(c: str, when: Column) -> Column:
        return F.min_by(c, F.when(when, order()))

    block = F.struct(*[F.col(c).alias(p) for c, p in BLOCK.items()])
    brought = assigned.groupBy("uuid").agg(
        *[first(c, F.col(c).isNotNull()).alias(f"_{c}") for c in DEMOGRAPHICS],
        first("source", F.col("match_type") != "UPDATED_EXISTING").alias("_primary_source"),
        first("documenttypes", numbered | linked).alias("_documenttypes"),
        first("document_number", numbered).alias("_document_number"),
        *[F.max_by(block, F.when(F.col("source") == s, order())).alias(f"_{x}") for s, x in SUFFIX.items()],
        F.bool_or(F.col("mobile_app_uuid").isNotNull()).alias("_registered_via_mobile"))
    held = schemas.fit(patients, schemas.GOLDEN).join(brought.select("uuid"), "uuid", "left_semi")
    filled = [*DEMOGRAPHICS, "documenttypes", "document_number", "primary_source", "registered_via_mobile"]
    out = {c: F.coalesce(c, f"_{c}") for c in filled}
    for x in SUFFIX.values():
        for p in BLOCK.values():
            out[f"{p}_{x}"] = F.when(F.col(f"_{x}").isNotNull(), F.col(f"_{x}")[p]).otherwise(F.col(f"{p}_{x}"))
    out["matching_locked"] = is_locked()
    return brought.join(held, "uuid", "left").withColumns(out).select(*schemas.GOLDEN.fieldNames())


def match_log(assigned: DataFrame, as_of) -> DataFrame:
    """Audit rows of resolved records."""
    mobile = F.col("mobile_app_uuid").isNotNull()
    return assigned.select(
        "hisnumber", "source", schemas.stamp(as_of).alias("match_time"), "match_type", "document_number",
        (F.col("match_type").startswith("NEW_") | (F.col("match_type") == "MOBILE_APP_NEW")).alias("created_uuid"),
        "mobile_app_uuid", F.col("uuid").alias("matched_patient_uuid"),
        F.to_json(F.struct(
            mobile.alias("is_mobile_match"), "hisnumber", "source",
            (F.col("document_number").isNotNull() & F.col("documenttypes").isNotNull()).alias("has_document")
        )).alias("details"))


def resolve(batch: DataFrame, mobile: DataFrame, patients: DataFrame, as_of,
            keep: Callable[[DataFrame], DataFrame] = cut) -> Resolution:
    """Resolve new keys against the golden rows. Rows that carry a uuid already pass unmatched.

    ``keep`` materialises the assignment, which golden rows, log and rejects are all derived from.
    """
    given = None
    if "uuid" in batch.columns:
        given = batch.filter(F.col("uuid").isNotNull())
        batch = batch.filter(F.col("uuid").isNull()).drop("uuid")
    result = keep(assign(batch, mobile, patients, keep))
    done = result.filter(F.col("reject_reason").isNull())
    stored = schemas.fit(done, schemas.DET)
    if given is not None:
        stored = stored.unionByName(schemas.fit(given, schemas.DET))
    touched = touched_by(done, patients)
    return Resolution(
        assigned=stored, golden=overlay(patients, touched), touched=touched, log=match_log(done, as_of),
        rejects=result.filter(F.col("reject_reason").isNotNull()).select(*batch.columns, "reject_reason"))


def lock_matching(patients: DataFrame, requests: DataFrame, lock: bool, as_of) -> DataFrame:
    """Golden rows after lock (or unlock) requests (uuid[, reason]), which are unique by uuid."""
    asked = requests.groupBy("uuid").agg(
        (F.min("reason") if "reason" in requests.columns else F.lit(None).cast("string")).alias("_reason"),
        F.lit(True).alias("_asked"))
    now = schemas.stamp(as_of)
    hit = F.col("_asked").isNotNull()
    return schemas.fit(patients, schemas.GOLDEN).join(asked, "uuid", "left").withColumns({
        "matching_locked": F.when(hit, F.lit(lock)).otherwise(is_locked()),
        "matching_locked_at": F.when(hit, now if lock else F.lit(None)).otherwise(F.col("matching_locked_at")),
        "matching_locked_reason": F.when(
            hit, F.coalesce("_reason", F.lit("Manual lock")) if lock else F.lit(None)).otherwise(F.col("matching_locked_reason")),
        "updated_at": F.when(hit, now).otherwise(F.col("updated_at"))}).select(*schemas.GOLDEN.fieldNames())


def lock_outcome(requests: DataFrame, patients: DataFrame) -> DataFrame:
    """Whether each requested uuid exists."""
    return requests.select("uuid").distinct().join(
        patients.select("uuid", F.lit(True).alias("_k")), "uuid", "left").select(
        "uuid", F.col("_k").isNotNull().alias("found"))


def touch_updated_at(df: DataFrame, as_of) -> DataFrame:
    """Stamp changed rows with the time of the batch."""
    return df.withColumn("updated_at", schemas.stamp(as_of))
