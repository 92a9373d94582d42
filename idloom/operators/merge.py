"""Changes of known records, and merging golden rows whose documents converge."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idloom import schemas
from idloom.operators.matching import Resolution, is_locked, is_mobile, mobile_user_lookup, overlay
from idloom.operators.skew import attach, lookup, salted
from idloom.schemas import BLOCK, DEMOGRAPHICS, SUFFIX
from idloom.session import cut

DOC = ["documenttypes", "document_number"]


def doc_changed(old_type: Column, old_number: Column, new_type: Column, new_number: Column) -> Column:
    """Either document field differs, NULL being a value like any other."""
    return ~old_type.eqNullSafe(new_type) | ~old_number.eqNullSafe(new_number)


def changed_documents(updates: DataFrame, patients: DataFrame) -> DataFrame:
    """Document updates (uuid, documenttypes, document_number; one per golden row) that change something.

    ``reject_reason`` is LOCKED where the golden row must not be touched.
    """
    old = patients.select("uuid", *[F.col(c).alias(f"old_{c}") for c in DOC], is_locked().alias("locked"))
    return updates.join(old, "uuid").filter(doc_changed(
        F.col("old_documenttypes"), F.col("old_document_number"), F.col("documenttypes"), F.col("document_number"))
    ).select("uuid", *DOC, "old_documenttypes", "old_document_number",
             F.when(F.col("locked"), "LOCKED").alias("reject_reason"))


def apply_documents(changed: DataFrame, patients: DataFrame) -> DataFrame:
    """Golden rows with the accepted document changes written (also a change to NULL)."""
    new = changed.filter(F.col("reject_reason").isNull()).select("uuid", F.struct(*DOC).alias("_new"))
    return patients.join(new, "uuid", "left").withColumns({
        c: F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)) for c in DOC}
    ).select(*patients.columns)


def merge_pairs(changed: DataFrame, patients: DataFrame) -> DataFrame:
    """Pairs to merge: (uuid, other_uuid) for unlocked golden rows that share a just-changed, complete document.

    ``patients`` carries the changes already. Every holder of such a document is paired with the
    one that will survive among them, so a document held by very many rows gives as many pairs and not their square.
    """
    complete = changed.filter(F.col("reject_reason").isNull()).dropna(subset=DOC)
    holders = salted(patients.filter(~is_locked()).select("uuid", *DOC, is_mobile().alias("mobile")),
                     complete.select(*DOC).distinct(), DOC, "left_semi")
    groups = holders.groupBy(*DOC).agg(
        F.min(F.struct(~F.col("mobile"), F.col("uuid").alias("uuid")))["uuid"].alias("other_uuid"),
        F.count("*").alias("_rows")).filter("_rows > 1")
    return attach(holders, groups, DOC, "_rows").filter(
        F.col("other_uuid").isNotNull() & (F.col("uuid") != F.col("other_uuid"))).select("uuid", "other_uuid")


def merge_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of (uuid, other_uuid) pairs: (uuid, component), the label is the least uuid.

    Alternates the two star steps of the published large-star / small-star method: neighbours are
    hung on the least node of their star until nothing moves. It needs about log2 of the longest
    chain rounds; each round is written to the shared folder, so its lineage stays short.
    """
    nodes = cut(edges.select("uuid", "other_uuid").filter("uuid IS NOT NULL AND other_uuid IS NOT NULL"))
    lonely = nodes.filter("uuid = other_uuid").select("uuid", F.col("uuid").alias("component"))
    e = _distinct_pairs(nodes.filter("uuid <> other_uuid"), "uuid", "other_uuid")
    mark = _fingerprint(e)
    for _ in range(max_rounds if mark[0] else 0):
        e = cut(_small_star(_large_star(e)))
        last, mark = mark, _fingerprint(e)
        if mark == last:
            break
    else:
        if mark[0]:
            raise RuntimeError(f"components not settled after {max_rounds} rounds")
    # now every edge is (node, least node of its component)
    roots = e.select(F.col("v").alias("uuid"), F.col("v").alias("component")).distinct()
    members = e.select(F.col("u").alias("uuid"), F.col("v").alias("component"))
    return members.unionByName(roots).unionByName(lonely).groupBy("uuid").agg(F.min("component").alias("component"))


def _fingerprint(e: DataFrame):
    """Number of edges and a hash of them, to see whether a round changed anything."""
    return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def _distinct_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """Edges as (u, v) with u > v, each once."""
    return df.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()


def _large_star(e: DataFrame) -> DataFrame:
    """Hang the greater neighbours of each node on the least node of its star."""
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("_rows")).withColumn("m", F.least("u", "m"))
    return _distinct_pairs(attach(both, least, ["u"], "_rows").filter("v > u"), "v", "m")


def _small_star(e: DataFrame) -> DataFrame:
    """Hang each node and its smaller neighbours on the least one."""
    least = e.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("_rows"))
    hung = attach(e, least, ["u"], "_rows")
    return _distinct_pairs(hung.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
        least.select(F.col("u").alias("a"), F.col("m").alias("b"))), "a", "b")


def merge_survivor(components: DataFrame, patients: DataFrame) -> DataFrame:
    """(loser, survivor): the mobile-registered row of a component if there is one, then the least uuid."""
    members = components.join(patients.select("uuid", is_mobile().alias("mobile")), "uuid")
    best = members.groupBy("component").agg(
        F.min(F.struct(~F.col("mobile"), F.col("uuid").alias("uuid")))["uuid"].alias("survivor"), F.count("*").alias("_rows"))
    return attach(members, best, ["component"], "_rows").filter(F.col("uuid") != F.col("survivor")).select(
        F.col("uuid").alias("loser"), "survivor")


def fold(members: DataFrame, rank: Column) -> DataFrame:
    """One golden row per ``survivor``: every field from the first member by ``rank`` that has it.

    The document is one field, so type and number come from the same member.
    """
    def first(c: str) -> Column:
        return F.min_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c)

    doc = F.coalesce(F.min_by(F.struct(*DOC), F.when(F.col("document_number").isNotNull(), rank)),
                     F.min_by(F.struct(*DOC), rank))
    skip = {"uuid", *DOC, "registered_via_mobile"}
    rest = [c for c in schemas.GOLDEN.fieldNames() if c not in skip and c in members.columns]
    return members.groupBy("survivor").agg(
        doc.alias("_doc"), *[first(c) for c in rest],
        F.bool_or(is_mobile()).alias("registered_via_mobile")).select(
        F.col("survivor").alias("uuid"), *[F.col(f"_doc.{c}").alias(c) for c in DOC], *rest, "registered_via_mobile")


def merge_fields(pairs: DataFrame, patients: DataFrame, newest: DataFrame | None = None) -> DataFrame:
    """Surviving golden rows of a (loser, survivor) map with the fields of their losers folded in.

    ``newest`` (uuid, source, o, <record columns>) are the records whose changed documents caused the
    merge: the last one of a source overwrites that source's contact block.
    """
    keep = pairs.select("survivor").distinct()
    roles = pairs.select(F.col("loser").alias("uuid"), "survivor", F.lit(1).alias("_role")).unionByName(
        keep.select(F.col("survivor").alias("uuid"), "survivor", F.lit(0).alias("_role")))
    out = fold(patients.join(roles, "uuid"), F.struct("_role", "uuid"))
    if newest is None:
        return out
    block = F.struct(*[F.col(c).alias(p) for c, p in BLOCK.items()])
    landed = newest.join(roles.select("uuid", "survivor"), "uuid").groupBy(F.col("survivor").alias("uuid")).agg(
        *[F.max_by(block, F.when(F.col("source") == s, F.col("o"))).alias(f"_{x}") for s, x in SUFFIX.items()])
    cols = {}
    for x in SUFFIX.values():
        for p in BLOCK.values():
            if f"{p}_{x}" in out.columns:
                cols[f"{p}_{x}"] = F.when(F.col(f"_{x}").isNotNull(), F.col(f"_{x}.{p}")).otherwise(F.col(f"{p}_{x}"))
    return out.join(landed, "uuid", "left").withColumns(cols).select(*out.columns)


def merge_repoint(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """Rows of losers now refer to their survivor. The map is small next to the table, so copies of
    it keep a golden row with very many rows from meeting in one task."""
    moved = pairs.select(F.col("loser").alias("uuid"), "survivor")
    return salted(table, moved, ["uuid"]).withColumn("uuid", F.coalesce("survivor", "uuid")).select(*table.columns)


def repoint_mobile(pairs: DataFrame, mobile: DataFrame) -> DataFrame:
    """Registrations of losers move to the survivor; where several meet, their numbers are folded, the
    survivor's own first (a uuid has one registration)."""
    moved = mobile.join(pairs.select(F.col("loser").alias("uuid"), "survivor"), "uuid", "left")
    rank = F.struct(F.col("survivor").isNotNull(), F.col("uuid"))
    return moved.withColumn("_r", rank).withColumn("uuid", F.coalesce("survivor", "uuid")).groupBy("uuid").agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_r"))).alias(c) for c in ("hisnumber_a", "hisnumber_b")])


def merge_patients(pairs: DataFrame, patients: DataFrame, newest: DataFrame | None = None) -> DataFrame:
    """All golden rows after the merges: survivors folded, losers gone, the rest as they were."""
    folded = merge_fields(pairs, patients, newest)
    gone = pairs.select(F.col("loser").alias("uuid")).unionByName(folded.select("uuid"))
    return patients.join(gone, "uuid", "left_anti").select(*folded.columns).unionByName(folded)


def merge_log(pairs: DataFrame, causes: DataFrame, as_of) -> DataFrame:
    """Audit row per loser; ``causes`` (uuid, hisnumber, source, document_number) names the record
    that led to the merge, the first one of the component."""
    sides = pairs.select("loser", "survivor", F.explode(F.array("loser", "survivor")).alias("uuid"))
    cause = sides.join(causes, "uuid").groupBy("loser", "survivor").agg(
        F.min(F.struct("source", "hisnumber", "document_number")).alias("c"))
    return pairs.join(cause, ["loser", "survivor"], "left").select(
        F.col("c.hisnumber").alias("hisnumber"), F.col("c.source").alias("source"),
        schemas.stamp(as_of).alias("match_time"), F.lit("MERGED_ON_UPDATE").alias("match_type"),
        F.col("c.document_number").alias("document_number"), F.lit(False).alias("created_uuid"),
        F.lit(None).cast("string").alias("mobile_app_uuid"), F.col("survivor").alias("matched_patient_uuid"),
        F.to_json(F.struct(F.col("loser").alias("merged_from"), F.col("survivor").alias("merged_to"),
                           F.lit(True).alias("document_based_merge"))).alias("details"))


def newest_records(batch: DataFrame, det: DataFrame, patients: DataFrame) -> DataFrame:
    """Rows of known keys with their golden row, the stored document and ``reject_reason`` (LOCKED)."""
    old = det.select("source", "hisnumber", "uuid", *[F.col(c).alias(f"old_{c}") for c in DOC])
    state = patients.select("uuid", is_locked().alias("locked"))
    found = schemas.fit(batch, schemas.RECORD).join(old, ["source", "hisnumber"])
    return lookup(found, state, ["uuid"]).withColumns({
        "o": F.struct("source", "hisnumber"),
        "changed": doc_changed(F.col("old_documenttypes"), F.col("old_document_number"),
                               F.col("documenttypes"), F.col("document_number")),
        "reject_reason": F.when(F.col("locked"), "LOCKED")}).drop("locked")


def update_regular(rows: DataFrame, patients: DataFrame) -> DataFrame:
    """All golden rows, those of accepted records overwritten."""
    return overlay(patients, overwritten(rows, patients))


def overwritten(rows: DataFrame, patients: DataFrame) -> DataFrame:
    """Golden rows overwritten by the newest accepted record: demographics and document by the last record
    of the person, the contact block by the last one of each source, NULLs included."""
    person = F.struct(*DEMOGRAPHICS, *DOC)
    block = F.struct(*[F.col(c).alias(p) for c, p in BLOCK.items()])
    new = rows.filter(F.col("reject_reason").isNull()).groupBy("uuid").agg(
        F.max_by(person, F.col("o")).alias("_p"),
        *[F.max_by(block, F.when(F.col("source") == s, F.col("o"))).alias(f"_{x}") for s, x in SUFFIX.items()])
    old = schemas.fit(patients, schemas.GOLDEN)
    cols = {c: F.col(f"_p.{c}") for c in [*DEMOGRAPHICS, *DOC]}
    for x in SUFFIX.values():
        for p in BLOCK.values():
            cols[f"{p}_{x}"] = F.when(F.col(f"_{x}").isNotNull(), F.col(f"_{x}.{p}")).otherwise(F.col(f"{p}_{x}"))
    return old.join(new, "uuid").withColumns(cols).select(*old.columns)


def update_log(rows: DataFrame, mobile: DataFrame, as_of) -> DataFrame:
    """Audit rows of accepted updates: one for the matched key, one more if the document changed."""
    good = mobile_user_lookup(rows.filter(F.col("reject_reason").isNull()), mobile)
    kind = F.when(F.col("mobile_app_uuid").isNotNull(), "MOBILE_APP_UPDATE").otherwise("UPDATED_EXISTING")
    has_doc = F.col("document_number").isNotNull() & F.col("documenttypes").isNotNull()
    details = F.to_json(F.struct(F.col("mobile_app_uuid").isNotNull().alias("is_mobile_match"), "hisnumber", "source",
                                 has_doc.alias("has_document")))
    regular = F.to_json(F.struct(F.lit(True).alias("document_changed")))
    none = F.lit(None).cast("string")
    entry = F.explode(F.filter(F.array(
        F.struct(kind.alias("match_type"), F.col("mobile_app_uuid").alias("mobile"), details.alias("details")),
        F.when(F.col("changed"), F.struct(F.lit("REGULAR_UPDATE").alias("match_type"), none.alias("mobile"), regular.alias("details")))),
        lambda x: x.isNotNull())).alias("e")
    return good.select("*", entry).select(
        "hisnumber", "source", schemas.stamp(as_of).alias("match_time"), F.col("e.match_type").alias("match_type"),
        "document_number", F.lit(False).alias("created_uuid"), F.col("e.mobile").alias("mobile_app_uuid"),
        F.col("uuid").alias("matched_patient_uuid"), F.col("e.details").alias("details"))


def upsert_known(batch: DataFrame, det: DataFrame, patients: DataFrame, mobile: DataFrame, as_of,
                 keep: Callable[[DataFrame], DataFrame] = cut) -> tuple[Resolution, DataFrame]:
    """Apply changed records of known keys (one row per key): overwrite, then merge golden rows whose
    documents now agree. Returns the resolution and the (loser, survivor) map for the other tables.

    A record whose document led to a merge is logged as MERGED_ON_UPDATE, not as a regular update.
    """
    rows = keep(newest_records(batch, det, patients))
    good = rows.filter(F.col("reject_reason").isNull())
    fresh = keep(overwritten(rows, patients))
    after = overlay(patients, fresh)
    changed = good.filter("changed").select("uuid", *DOC, "reject_reason")
    pairs = keep(merge_survivor(merge_components(merge_pairs(changed, after)), after))
    merged = pairs.select(F.explode(F.array("loser", "survivor")).alias("uuid")).distinct()
    flagged = salted(rows, merged.withColumn("_merged", F.lit(True)), ["uuid"])
    log = update_log(flagged.withColumn("changed", F.col("changed") & F.col("_merged").isNull()), mobile, as_of)
    causes = good.filter("changed").select("uuid", "hisnumber", "source", "document_number")
    # only survivors and the rows overwritten before are written again
    folded = schemas.fit(merge_fields(pairs, after, good.filter("changed")), schemas.GOLDEN)
    losers = pairs.select(F.col("loser").alias("uuid"))
    touched = keep(overlay(fresh.join(losers, "uuid", "left_anti"), folded))
    assigned = merge_repoint(pairs, schemas.fit(good, schemas.DET))
    return Resolution(
        assigned=assigned, golden=overlay(patients, touched, losers), touched=touched, log=log.unionByName(merge_log(pairs, causes, as_of)),
        rejects=rows.filter(F.col("reject_reason").isNotNull()).select(*schemas.RECORD_COLUMNS, "reject_reason")), pairs


def merge_targets(requests: DataFrame, patients: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Where each admin request (source_uuid, target_uuid) ends: (source_uuid, target_uuid, survivor, depth, reject_reason).

    A source is merged once (the least target wins, further requests find it gone); both sides must
    exist. Chains are followed by doubling the step, so a chain of n requests takes log2 n rounds;
    requests that run in a circle never end and are rejected.
    """
    known = patients.select("uuid")
    asked = requests.select("source_uuid", "target_uuid").distinct()
    there = asked.join(known.withColumnRenamed("uuid", "source_uuid"), "source_uuid", "left_semi")
    exists = lookup(there, known.select(F.col("uuid").alias("target_uuid"), F.lit(True).alias("_k")), ["target_uuid"]
                    ).filter(F.col("_k") & (F.col("source_uuid") != F.col("target_uuid")))
    steps = cut(exists.groupBy("source_uuid").agg(F.min("target_uuid").alias("target_uuid")))
    n_steps = steps.count()
    reach = steps.select("source_uuid", F.col("target_uuid").alias("end"), F.lit(1).cast("long").alias("depth"))
    for _ in range(max_rounds):
        hop = reach.select(F.col("source_uuid").alias("end"), F.col("end").alias("_end"), F.col("depth").alias("_depth"))
        moved = lookup(reach, hop, ["end"])
        open_ = moved.filter(F.col("_end").isNotNull())
        state = open_.agg(F.count("*").alias("n"), F.min("depth").alias("least")).first()
        if state["n"] == 0:
            break
        # a path longer than the number of requests has gone round in a circle
        if state["least"] > n_steps:
            break
        reach = cut(moved.select("source_uuid", F.coalesce("_end", "end").alias("end"),
                                 (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth")))
    ended = lookup(reach, steps.select(F.col("source_uuid").alias("end"), F.lit(True).alias("_more")), ["end"]).filter(
        F.col("_more").isNull()).select("source_uuid", F.col("end").alias("survivor"), "depth")
    out = asked.join(steps.select("source_uuid", F.col("target_uuid").alias("_t")), "source_uuid", "left").join(
        ended, "source_uuid", "left")
    runs = F.col("_t") == F.col("target_uuid")
    return out.select(
        "source_uuid", "target_uuid", F.when(runs, F.col("survivor")).alias("survivor"),
        F.when(runs, F.col("depth")).alias("depth"),
        F.when(F.col("_t").isNull() | ~runs, "NOT_FOUND").when(F.col("survivor").isNull(), "CIRCLE").alias("reject_reason"))


def manual_merge(requests: DataFrame, patients: DataFrame, det: DataFrame, protocols: DataFrame, as_of) -> dict[str, DataFrame]:
    """Admin merges of source into target: target's fields stay, gaps are filled from the nearest source."""
    targets = cut(merge_targets(requests, patients))
    done = targets.filter(F.col("reject_reason").isNull())
    pairs = done.select(F.col("source_uuid").alias("loser"), "survivor")
    roles = done.select(F.col("source_uuid").alias("uuid"), "survivor", "depth").unionByName(
        done.select(F.col("survivor").alias("uuid"), "survivor", F.lit(0).cast("long").alias("depth")).distinct())
    folded = fold(schemas.fit(patients, schemas.GOLDEN).join(roles, "uuid"), F.struct("depth", "uuid"))
    gone = roles.select("uuid").distinct()
    kept = schemas.fit(patients, schemas.GOLDEN).join(gone, "uuid", "left_anti").select(*folded.columns)
    number = patients.select(F.col("uuid").alias("source_uuid"), "document_number")
    log = done.join(number, "source_uuid").select(
        F.concat(F.lit("MERGE:"), "source_uuid", F.lit("->"), "target_uuid").alias("hisnumber"), F.lit(0).alias("source"),
        schemas.stamp(as_of).alias("match_time"), F.lit("MANUAL_MERGE").alias("match_type"), "document_number",
        F.lit(False).alias("created_uuid"), F.lit(None).cast("string").alias("mobile_app_uuid"),
        F.lit(None).cast("string").alias("matched_patient_uuid"), F.lit(None).cast("string").alias("details"))
    return {"patients": kept.unionByName(folded), "det": merge_repoint(pairs, det),
            "protocols": merge_repoint(pairs, protocols), "log": log,
            "rejects": targets.filter(F.col("reject_reason").isNotNull())}
