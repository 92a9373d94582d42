"""Every operator as a query over the driver's tables: name -> function of ``Inputs``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idloom import schemas
from idloom.functions import normalize as N
from idloom.operators import conform as C
from idloom.operators import lookups as J
from idloom.operators import matching as M
from idloom.operators import merge as G
from idloom.operators import quality as Q
from idloom.operators import registration as R
from idloom.operators import stats as A
from idloom.plans import pipelines as P
from idloom.plans.fixtures import AS_OF, Inputs
from idloom.session import cut, scratch
from idloom.sources import control, source_a, source_b, store
from idloom.sources import dims as D
from idloom.streaming import streams as ST

QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {}


def query(f: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[f.__name__] = f
    return f


# ---- shared inputs -------------------------------------------------------------------------

def parsed_a(fx: Inputs) -> DataFrame:
    """Records assembled from the lines of the export."""
    return source_a.build_source_a_record(source_a.parse_source_a(fx.stored("a_lines"))).drop("file", "line_no")


def raw_a(fx: Inputs) -> DataFrame:
    """The same records as a table, for queries about what comes after the parser."""
    return fx.a_records.withColumns({"source": F.lit(source_a.SOURCE_ID), "businessunit": F.lit(source_a.UNIT_ID)})


def raw_b(fx: Inputs) -> DataFrame:
    return source_b.scan_source_b(fx.b_clients)


def conformed(fx: Inputs) -> DataFrame:
    return C.conform_union(raw_a(fx), raw_b(fx))


def batch(fx: Inputs) -> DataFrame:
    """Both feeds, from lines and clients, conformed and staged once as a pipeline does."""
    return cut(C.split_rejects(C.conform_union(parsed_a(fx), raw_b(fx)))[0])


def newcomers(fx: Inputs) -> DataFrame:
    return schemas.fit(fx.stored("newcomers"), schemas.RECORD)


def golden(fx: Inputs) -> DataFrame:
    return schemas.fit(fx.stored("patients_fix"), schemas.GOLDEN)


def no_golden(fx: Inputs) -> DataFrame:
    return schemas.empty(fx.spark, schemas.GOLDEN)


def det(fx: Inputs) -> DataFrame:
    return schemas.fit(fx.stored("det_fix"), schemas.DET)


def without_times(df: DataFrame) -> DataFrame:
    return df.drop("matching_locked_at", "matching_locked_reason", "updated_at", "matching_locked")


# ---- sources and sinks ---------------------------------------------------------------------

@query
def scan_source_b(fx):
    return raw_b(fx)


@query
def keyset_page_b(fx):
    return source_b.keyset_page_b(fx.b_clients, 40, 1000)


@query
def scan_delta_b(fx):
    return source_b.scan_delta_b(fx.stored("delta_clients")).select(
        "hisnumber", "source", "businessunit", "lastname", "name", "email", "operation", "seq", "change_time")


@query
def scan_source_a_lines(fx):
    path = scratch(fx.spark, "landing")
    fx.a_lines.select("line").write.text(path)
    return source_a.scan_source_a_lines(fx.spark, path).select("line")


@query
def parse_source_a(fx):
    return source_a.parse_source_a(fx.stored("a_lines")).select(
        F.size("fields").alias("n_fields"), F.concat_ws("|", "fields").alias("record"))


@query
def build_source_a_record(fx):
    return parsed_a(fx)


@query
def unprocessed_a(fx):
    return source_a.unprocessed_a(raw_a(fx), fx.processed_a).select("hisnumber", "lastname", "birthdate")


@query
def delta_summary_a(fx):
    return source_a.delta_summary_a(raw_a(fx), fx.processed_a, 500)


@query
def processed_set_union(fx):
    return control.processed_set_union(fx.processed_a, raw_a(fx))


@query
def watermark_state(fx):
    log = fx.stored("matching_log")
    before = log.groupBy("source").agg(F.max(F.col("hisnumber").try_cast("bigint")).alias("last_id"),
                                       F.max("match_time").alias("last_sync"))
    return control.watermark_state(before, raw_b(fx).select("source", F.col("hisnumber").cast("string").alias("id")), AS_OF)


@query
def source_totals(fx):
    a = control.source_totals(raw_a(fx), "hisnumber").withColumn("source", F.lit(1))
    b = control.source_totals(raw_b(fx), "hisnumber").withColumn("source", F.lit(2))
    return a.unionByName(b)


@query
def batch_range(fx):
    return control.batch_range(raw_b(fx), "hisnumber", 1000)


@query
def mark_delta_processed(fx):
    delta = fx.stored("delta_clients")
    keys = delta.filter(F.upper("operation") == "INSERT").select("pcode")
    return source_b.mark_delta_processed(delta, keys).select("seq", "pcode", "processed")


@query
def verify_delta_processed(fx):
    delta = fx.stored("delta_clients")
    return source_b.verify_delta_processed(delta, delta.filter(F.upper("operation") == "INSERT").select("pcode"))


@query
def delta_pending_count(fx):
    return source_b.delta_pending_count(fx.stored("delta_clients"))


@query
def delta_recent_topk(fx):
    return source_b.delta_recent_topk(fx.stored("delta_clients"))


@query
def ref_dims(fx):
    dims = _dims(fx)
    used = det(fx).select(F.explode(F.array(
        F.struct(F.lit("sources").alias("dim"), F.col("source").alias("id")),
        F.struct(F.lit("businessunits").alias("dim"), F.col("businessunit").alias("id")),
        F.struct(F.lit("documenttypes").alias("dim"), F.col("documenttypes").alias("id")))).alias("r")).groupBy(
        "r.dim", "r.id").agg(F.count("*").alias("n_records"))
    rows = None
    for name, df in dims.items():
        part = df.select(F.lit(name).alias("dim"), "id", "name")
        rows = part if rows is None else rows.unionByName(part)
    return rows.join(used, ["dim", "id"], "left").withColumn("n_records", F.coalesce("n_records", F.lit(0)))


@query
def sink_insert_det(fx):
    rows = C.split_rejects(conformed(fx))[0]
    stored, rejects = store.sink_insert_det(det(fx), rows)
    return stored.groupBy("source").agg(F.count("*").alias("stored"), F.count_if(F.col("uuid").isNull()).alias("added")).join(
        rejects.groupBy("source").agg(F.count("*").alias("rejected")), "source", "left")


@query
def sink_upsert_det(fx):
    return store.sink_upsert_det(det(fx), newcomers(fx))


@query
def insert_if_absent(fx):
    return store.insert_if_absent(det(fx), newcomers(fx))


@query
def soft_delete(fx):
    return store.soft_delete(P.delete_requests(fx.stored("delta_clients")))


@query
def write_status(fx):
    rows = conformed(fx)
    metrics = rows.groupBy("source").agg(
        F.count("*").alias("processed_records"), F.count_if(F.col("reject_reason").isNull()).alias("success_count"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("error_count")).withColumns({
            "status": F.lit("completed"), "end_time": schemas.stamp(AS_OF)})
    path = scratch(fx.spark, "status")
    control.write_status(metrics, path)
    return fx.spark.read.schema(
        "source int, processed_records long, success_count long, error_count long, status string, end_time string").json(path)


# ---- normalisation and validation ----------------------------------------------------------

@query
def norm_business_unit(fx):
    return fx.b_clients.select("pcode", N.norm_business_unit(F.col("filial")).alias("businessunit"))


@query
def norm_doc_concat_b(fx):
    return fx.b_clients.select("pcode", N.norm_doc_concat_b(F.col("paspser"), F.col("paspnum")).alias("document_text"))


@query
def norm_doc_number(fx):
    return fx.bad_records.select("hisnumber", "document_number", N.norm_doc_number(F.col("document_number")).alias("number"))


@query
def norm_doc_number_a(fx):
    return raw_a(fx).select("hisnumber", N.norm_doc_number_a(F.col("series"), F.col("number")).alias("document_number"))


@query
def norm_phone_b(fx):
    return fx.b_clients.select("pcode", N.norm_phone_b(F.col("phone1"), F.col("phone2"), F.col("phone3")).alias("telephone"))


@query
def norm_phone_a(fx):
    return raw_a(fx).select("hisnumber", N.norm_phone_a(F.col("telephone")).alias("telephone"))


@query
def norm_date_a(fx):
    return raw_a(fx).select("hisnumber", N.norm_date_a(F.col("birthdate")).alias("birthdate")).unionByName(
        fx.bad_records.select("hisnumber", N.norm_date_a(F.col("birthdate")).alias("birthdate")))


@query
def norm_date_dmy(fx):
    text = N.norm_date_dmy(F.col("birthdate"))
    return fx.bad_records.select("hisnumber", text.alias("birthdate_text"), N.iso_date(text).alias("birthdate"))


@query
def map_doc_type_a(fx):
    return raw_a(fx).select("hisnumber", N.map_doc_type_a(F.col("documenttypes")).alias("documenttypes"))


@query
def map_doc_type_b(fx):
    return fx.b_clients.select(F.col("pcode").cast("string").alias("id"), N.map_doc_type_b(F.col("pasptype")).alias("documenttypes")).unionByName(
        fx.bad_records.select(F.col("hisnumber").alias("id"), N.map_doc_type_b(F.col("documenttypes")).alias("documenttypes")))


@query
def clamp_doc_type(fx):
    return fx.b_clients.select("pcode", N.clamp_doc_type(F.col("pasptype")).alias("documenttypes"))


@query
def default_doc_type(fx):
    number = N.norm_doc_number(N.norm_doc_concat_b(F.col("paspser"), F.col("paspnum")))
    return fx.b_clients.select("pcode", N.default_doc_type(F.col("pasptype"), number).alias("documenttypes"))


@query
def conform_text_dates(fx):
    return C.validated(C.conform_b(source_b.scan_source_b(fx.b_text_dates))).select("hisnumber", "birthdate", "reject_reason")


@query
def validate_record(fx):
    return C.parse_text_records(fx.bad_records)


@query
def transform_fallback(fx):
    return C.transform_fallback(fx.bad_records)


@query
def conform_union(fx):
    return conformed(fx)


@query
def record_flags(fx):
    return C.record_flags(C.split_rejects(conformed(fx))[0])


@query
def display_names(fx):
    return C.display_names(fx.stored("det_fix").unionByName(
        fx.bad_records.select("hisnumber", "source", "businessunit"), allowMissingColumns=True), _dims(fx))


@query
def valid_iso_birthdate(fx):
    return fx.bad_records.select("hisnumber", "birthdate", N.valid_iso_birthdate(F.col("birthdate")).alias("is_valid")).unionByName(
        fx.credential_requests.select(F.col("request_id").cast("string").alias("hisnumber"), F.col("bdate").alias("birthdate"),
                                      N.valid_iso_birthdate(F.col("bdate")).alias("is_valid")))


@query
def mask_credentials(fx):
    return C.mask_credentials(fx.stored("patients_fix").select("uuid", "login_a", "password_a", "login_b", "password_b"))


@query
def transliterate_name(fx):
    return fx.table("documents").select("doc_id", N.transliterate_name(F.col("text")).alias("latin"))


@query
def doc_type_name(fx):
    return C.doc_type_name(fx.b_clients.select("pcode", F.col("pasptype").alias("documenttypes")), _dims(fx))


@query
def reject_stats(fx):
    return C.reject_stats(C.split_rejects(C.parse_text_records(fx.bad_records))[1])


def _dims(fx: Inputs) -> dict[str, DataFrame]:
    return D.ref_dims(fx.spark)


# ---- joins and lookups ---------------------------------------------------------------------

@query
def det_with_golden(fx):
    return J.det_with_golden(fx.stored("det_fix"), fx.stored("patients_fix"))


@query
def key_exists(fx):
    return J.key_exists(newcomers(fx), fx.stored("det_fix"))


@query
def patient_details(fx):
    return J.patient_details(fx.stored("patients_fix"), fx.stored("protocols"), _dims(fx))


@query
def patient_protocols(fx):
    return J.patient_protocols(fx.stored("protocols"), _dims(fx))


@query
def patient_protocols_of(fx):
    """Of the persons in a request table."""
    return J.patient_protocols(fx.stored("protocols"), _dims(fx), fx.stored("doc_updates").select("uuid"))


@query
def patient_raw_records(fx):
    return J.patient_raw_records(fx.stored("det_fix"), _dims(fx))


@query
def mobile_user_lookup(fx):
    return M.mobile_user_lookup(newcomers(fx).select("hisnumber", "source"), fx.stored("mobile_app_users"))


@query
def mobile_user_by_uuid(fx):
    return J.mobile_user_by_uuid(fx.number_updates, fx.stored("mobile_app_users"))


@query
def find_by_credentials(fx):
    return J.find_by_credentials(fx.stored("credential_requests"), fx.stored("patients_fix")).select("request_id", "uuid", "found_by")


@query
def similar_ids(fx):
    return J.similar_ids(fx.stored("matching_log").select("hisnumber"), raw_a(fx))


@query
def trace_record(fx):
    c = conformed(fx)
    return J.trace_record(newcomers(fx), {"raw": c, "conformed": c, "det": fx.stored("det_fix")})


# ---- identity resolution -------------------------------------------------------------------

_ASSIGNED = ["hisnumber", "source", "uuid", "match_type", "mobile_app_uuid"]


def _ladder(fx: Inputs) -> DataFrame:
    return M.assign(newcomers(fx), fx.stored("mobile_app_users"), golden(fx))


@query
def match_skip_assigned(fx):
    rows = schemas.fit(fx.stored("det_fix"), schemas.DET).unionByName(schemas.fit(fx.stored("newcomers"), schemas.DET))
    out = M.resolve(rows, fx.stored("mobile_app_users"), golden(fx), AS_OF).assigned
    return out.select("hisnumber", "source", "uuid")


@query
def match_mobile(fx):
    return _ladder(fx).filter(F.col("match_type").startswith("MOBILE")).select(*_ASSIGNED)


@query
def match_hisnumber(fx):
    return _ladder(fx).filter(F.col("match_type") == "UPDATED_EXISTING").select(*_ASSIGNED)


@query
def match_document(fx):
    return _ladder(fx).filter(F.col("match_type") == "MATCHED_DOCUMENT").select(*_ASSIGNED)


@query
def match_new(fx):
    return _ladder(fx).filter(F.col("match_type").startswith("NEW_")).select(*_ASSIGNED)


@query
def match_types(fx):
    rows = M.assign(batch(fx), fx.stored("mobile_app_users"), no_golden(fx))
    return rows.select(*_ASSIGNED, (F.col("match_type").startswith("NEW_") | (F.col("match_type") == "MOBILE_APP_NEW")).alias("created_uuid"))


@query
def golden_records(fx):
    return without_times(M.resolve(batch(fx), fx.stored("mobile_app_users"), no_golden(fx), AS_OF).golden)


@query
def golden_records_existing(fx):
    return without_times(M.resolve(newcomers(fx), fx.stored("mobile_app_users"), golden(fx), AS_OF).golden)


@query
def match_log(fx):
    return M.resolve(newcomers(fx), fx.stored("mobile_app_users"), golden(fx), AS_OF).log.select(
        "*", F.get_json_object("details", "$.has_document").alias("has_document"),
        F.get_json_object("details", "$.is_mobile_match").alias("is_mobile_match")).drop("details")


@query
def match_rejects(fx):
    return M.resolve(newcomers(fx), fx.stored("mobile_app_users"), golden(fx), AS_OF).rejects.select("hisnumber", "source", "reject_reason")


def _changed(fx: Inputs) -> DataFrame:
    return cut(G.changed_documents(fx.stored("doc_updates"), golden(fx)))


def _merge(fx: Inputs) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Changed documents, golden rows with them, and the (loser, survivor) map."""
    changed = _changed(fx)
    after = G.apply_documents(changed, golden(fx))
    pairs = G.merge_survivor(G.merge_components(G.merge_pairs(changed, after)), golden(fx))
    return changed, after, cut(pairs)


@query
def doc_changed(fx):
    return _changed(fx).select("uuid", "documenttypes", "document_number", "old_documenttypes", "old_document_number")


@query
def locked_guard(fx):
    return _changed(fx).select("uuid", F.col("reject_reason").isNotNull().alias("is_rejected"))


@query
def merge_pairs(fx):
    changed = _changed(fx)
    return G.merge_pairs(changed, G.apply_documents(changed, golden(fx)))


@query
def merge_survivor(fx):
    return _merge(fx)[2]


@query
def merge_fields(fx):
    _, after, pairs = _merge(fx)
    return without_times(G.merge_fields(pairs, after))


@query
def merge_repoint(fx):
    return G.merge_repoint(_merge(fx)[2], fx.stored("protocols")).select("id", "uuid", "source", "businessunit", "date", "qty")


@query
def merge_components(fx):
    return G.merge_components(fx.stored("merge_requests").select(F.col("source_uuid").alias("uuid"), F.col("target_uuid").alias("other_uuid")))


@query
def merge_log(fx):
    changed, _, pairs = _merge(fx)
    causes = changed.filter(F.col("reject_reason").isNull()).join(
        fx.stored("det_fix").select("uuid", "hisnumber", "source"), "uuid").select("uuid", "hisnumber", "source", "document_number")
    return G.merge_log(pairs, causes, AS_OF).select(
        "hisnumber", "source", "match_time", "match_type", "document_number", "created_uuid", "matched_patient_uuid",
        F.get_json_object("details", "$.merged_from").alias("merged_from"))


@query
def update_regular(fx):
    rows = G.newest_records(newcomers(fx), det(fx), golden(fx))
    return without_times(G.update_regular(rows, golden(fx)))


@query
def lock_matching(fx):
    locked = M.lock_matching(golden(fx), fx.lock_requests, True, AS_OF)
    freed = M.lock_matching(locked, fx.stored("doc_updates").select("uuid"), False, AS_OF)
    return freed.select("uuid", "matching_locked", "matching_locked_at", "matching_locked_reason", "updated_at")


@query
def manual_merge(fx):
    out = G.manual_merge(fx.stored("merge_requests"), golden(fx), det(fx), fx.stored("protocols"), AS_OF)
    return without_times(out["patients"])


@query
def manual_merge_det(fx):
    out = G.manual_merge(fx.stored("merge_requests"), golden(fx), det(fx), fx.stored("protocols"), AS_OF)
    return out["det"].select("hisnumber", "source", "uuid")


@query
def manual_merge_protocols(fx):
    out = G.manual_merge(fx.stored("merge_requests"), golden(fx), det(fx), fx.stored("protocols"), AS_OF)
    return out["protocols"].select("id", "uuid")


@query
def lock_outcome(fx):
    return M.lock_outcome(fx.stored("merge_requests").select(F.col("source_uuid").alias("uuid")), golden(fx))


@query
def mobile_update_number(fx):
    updates = fx.stored("number_updates").select("request_id", "uuid", F.col("hisnumber_a").alias("hisnumber"))
    return R.mobile_update_number(fx.stored("mobile_app_users"), updates, 1)


@query
def manual_merge_log(fx):
    out = G.manual_merge(fx.stored("merge_requests"), golden(fx), det(fx), fx.protocols, AS_OF)
    return out["log"].select("hisnumber", "source", "match_type", "document_number", "created_uuid")


@query
def touch_updated_at(fx):
    return M.touch_updated_at(golden(fx), AS_OF).select("uuid", "updated_at")


# ---- registration --------------------------------------------------------------------------

@query
def mobile_register(fx):
    accepted, rejects = R.mobile_register(fx.stored("registrations"), fx.stored("mobile_app_users"))
    return accepted.select("request_id", "hisnumber_a", "hisnumber_b", "uuid", F.lit(None).cast("string").alias("reject_reason")).unionByName(
        rejects.select("request_id", "hisnumber_a", "hisnumber_b", F.lit(None).cast("string").alias("uuid"), "reject_reason"))


@query
def mobile_update_numbers(fx):
    return R.mobile_update_numbers(fx.stored("mobile_app_users"), fx.number_updates)


@query
def credentials_update(fx):
    return R.credentials_update(fx.stored("patients_fix"), fx.credential_updates).select("uuid", "login_a", "password_a", "login_b", "password_b")


@query
def classify_requests(fx):
    return R.classify_requests(fx.stored("credential_requests"), fx.stored("patients_fix"))


# ---- statistics ----------------------------------------------------------------------------

@query
def dup_by_document(fx):
    return A.dup_by_document(fx.stored("patients_fix"))


@query
def dup_by_name(fx):
    return A.dup_by_name(fx.stored("namesakes"))


def _as_text(lists: DataFrame) -> DataFrame:
    return lists.withColumn("uuids", F.concat_ws(",", "uuids"))


@query
def dup_by_name_lists(fx):
    """One row per group and part, largest groups first."""
    return _as_text(A.duplicate_lists(A.dup_by_name(fx.stored("namesakes"))))


@query
def dup_by_document_lists(fx):
    return _as_text(A.duplicate_lists(A.dup_by_document(fx.stored("patients_fix"))))


@query
def total_patients(fx):
    return A.total_patients(fx.stored("patients_fix"), fx.stored("mobile_app_users"))


@query
def count_by_match_type(fx):
    return A.count_by_match_type(fx.stored("matching_log"))


@query
def stats_by_source(fx):
    return A.stats_by_source(fx.stored("det_fix"), _dims(fx))


@query
def multi_source_histogram(fx):
    return A.multi_source_histogram(fx.stored("det_fix"))


@query
def mobile_stats(fx):
    return A.mobile_stats(fx.stored("mobile_app_users"))


@query
def matching_stats(fx):
    return A.matching_stats(fx.stored("matching_log"))


@query
def matching_stats_24h(fx):
    return A.matching_stats_24h(fx.stored("matching_log"), AS_OF)


@query
def activity_24h(fx):
    return A.activity_24h(fx.stored("matching_log"), AS_OF)


@query
def activity_1h_by_source(fx):
    return A.activity_1h_by_source(fx.stored("matching_log"), AS_OF)


@query
def count_by_source(fx):
    return A.count_by_source(fx.stored("det_fix"))


@query
def completion_rate(fx):
    return A.completion_rate(raw_b(fx), fx.stored("det_fix"), 2)


@query
def processing_progress(fx):
    return A.processing_progress(raw_a(fx), fx.processed_a)


@query
def null_document_share(fx):
    return A.null_document_share(fx.stored("det_fix"))


@query
def doc_type_distribution(fx):
    return A.doc_type_distribution(fx.stored("det_fix"))


@query
def match_log_delta(fx):
    log = fx.stored("matching_log")
    noon = schemas.stamp(AS_OF) - F.expr("INTERVAL 24 HOURS")
    return A.match_log_delta(A.count_by_match_type(log.filter(F.col("match_time") <= noon)), A.count_by_match_type(log))


@query
def merged_count(fx):
    _, after, pairs = _merge(fx)
    return A.merged_count(fx.stored("patients_fix"), G.merge_patients(pairs, after))


@query
def max_id_counter(fx):
    return A.max_id_counter(fx.stored("det_fix"))


@query
def sync_counts(fx):
    return A.sync_counts(C.validated(C.conform_a(source_a.unprocessed_a(raw_a(fx), fx.processed_a))), fx.stored("det_fix"))


@query
def delta_op_counts(fx):
    return A.delta_op_counts(source_b.delta_latest(source_b.scan_delta_b(fx.stored("delta_clients")), "hisnumber"))


# ---- windows, sampling, constraints --------------------------------------------------------

@query
def delta_latest(fx):
    return source_b.delta_latest(fx.stored("delta_clients"))


@query
def sample_rows(fx):
    return A.sample_rows(fx.stored("det_fix"), 50, 7, ["source", "hisnumber"], null_document_only=True).select("source", "hisnumber")


@query
def check_unique_keys(fx):
    return Q.check_unique_keys(fx.bad_records, ["hisnumber", "source"])


@query
def check_mobile_has_number(fx):
    return Q.check_mobile_has_number(fx.stored("mobile_app_users"))


@query
def check_foreign_keys(fx):
    rows = fx.bad_records.select("hisnumber", "source", "businessunit", F.col("documenttypes").try_cast("int").alias("documenttypes"),
                                 F.lit(None).cast("string").alias("uuid")).unionByName(
        fx.stored("det_fix").select("hisnumber", "source", "businessunit", "documenttypes", "uuid")).unionByName(
        fx.stored("merge_requests").select(F.lit("R").alias("hisnumber"), F.lit(1).alias("source"), F.lit(1).alias("businessunit"),
                                 F.lit(1).alias("documenttypes"), F.col("source_uuid").alias("uuid")))
    return Q.check_foreign_keys(rows, _dims(fx), fx.stored("patients_fix"))


@query
def check_not_null(fx):
    return Q.check_not_null(fx.bad_records, ["hisnumber", "source", "businessunit"])


@query
def check_lengths(fx):
    return Q.check_lengths(fx.bad_records)


# ---- pipelines and streams -----------------------------------------------------------------

def _store(fx: Inputs, seeded: bool, protocols: bool = False) -> store.Store:
    s = store.Store(fx.spark, scratch(fx.spark, "store"))
    tables = {"mobile": fx.stored("mobile_app_users")}
    if seeded:
        tables |= {"det": det(fx), "patients": golden(fx)}
    if protocols:
        tables["protocols"] = fx.protocols
    s.commit("seed", **tables)
    return s


def _loaded(fx: Inputs) -> store.Store:
    s = _store(fx, seeded=False)
    P.pipeline_initial_load({"clients": fx.b_clients}, s, AS_OF)
    return s


def _synced(fx: Inputs, **options) -> store.Store:
    s = _store(fx, seeded=True, **options)
    P.pipeline_sync_a({"lines": fx.stored("a_lines"), "processed": fx.processed_a}, s, AS_OF)
    return s


def _applied(fx: Inputs) -> store.Store:
    s = _store(fx, seeded=True)
    P.pipeline_delta_b({"delta": fx.stored("delta_clients")}, s, AS_OF)
    return s


@query
def pipeline_initial_load(fx):
    return _loaded(fx).read("det")


@query
def pipeline_load_status(fx):
    """What the load notes about itself: completion, rejects, watermark."""
    s = _loaded(fx)
    return s.read("status").join(s.read("control"), "source").select(
        "source", "source_count", "destination_count", "rejected", "is_complete", "last_id", F.col("last_sync").isNotNull().alias("synced"))


@query
def pipeline_load_twice(fx):
    """Two loads into one store, the second one of clients that came later."""
    s = _store(fx, seeded=False)
    P.pipeline_initial_load({"clients": fx.b_clients.filter("pcode % 3 <> 0")}, s, AS_OF)
    P.pipeline_initial_load({"clients": fx.b_clients}, s, AS_OF)
    return s.read("det").drop("uuid")


@query
def pipeline_sync_a(fx):
    return without_times(_synced(fx).read("patients"))


@query
def pipeline_sync_processed(fx):
    return _synced(fx).read("processed")


@query
def pipeline_sync_protocols(fx):
    """Protocols after a sync whose merges they have to follow."""
    return _synced(fx, protocols=True).read("protocols").select("id", "uuid")


@query
def pipeline_delta_b(fx):
    return _applied(fx).read("matching_log").drop("details")


@query
def pipeline_delta_deletes(fx):
    return _applied(fx).read("deletes")


@query
def pipeline_delta_marks(fx):
    """The change log after the batch, the rows that it consumed marked."""
    marks = _applied(fx).read("marks").select("seq").distinct().withColumn("_m", F.lit(True))
    return fx.stored("delta_clients").join(marks, "seq", "left").select(
        "seq", "pcode", F.when(F.col("_m"), "Y").otherwise(F.col("processed")).alias("processed"))


@query
def route_sync_mode(fx):
    control_table = fx.stored("matching_log").groupBy("source").agg(F.max("match_time").alias("last_sync"))
    return P.route_sync_mode(raw_b(fx), fx.stored("det_fix"), control_table, 2)


#: micro-batches the events arrive in; each one holds events of all times
DELIVERIES = 5


def _delivered(fx: Inputs, run: Callable[[Inputs, str], object]) -> None:
    """Land the events in out-of-order deliveries, and run the stream after each one from the same checkpoint."""
    landing, checkpoint = scratch(fx.spark, "landing"), scratch(fx.spark, "checkpoint")
    events = fx.table("events")
    for i in range(DELIVERIES):
        events.filter(F.col("event_id") % DELIVERIES == i).write.mode("append").parquet(landing)
        stream = fx.spark.readStream.schema(events.schema).parquet(landing)
        run(Inputs(fx.spark, fx.sf_dir, events=stream), checkpoint).awaitTermination()


@query
def stream_delta_apply(fx):
    s = _store(fx, seeded=True)
    _delivered(fx, lambda late, checkpoint: ST.stream_delta_apply(late.delta_clients, s, checkpoint, AS_OF))
    return s.read("det")


@query
def stream_latest_state(fx):
    s = store.Store(fx.spark, scratch(fx.spark, "store"))
    _delivered(fx, lambda late, checkpoint: ST.stream_latest_state(late.delta_clients, s, checkpoint))
    return s.read("changes")


@query
def stream_dedup(fx):
    s = store.Store(fx.spark, scratch(fx.spark, "store"))
    _delivered(fx, lambda late, checkpoint: ST.stream_dedup(late.delta_clients.unionByName(late.delta_clients), s, checkpoint))
    return s.read("deliveries")


@query
def stream_activity_window(fx):
    s = store.Store(fx.spark, scratch(fx.spark, "store"))
    _delivered(fx, lambda late, checkpoint: ST.stream_activity_window(late.matching_log, s, checkpoint))
    return s.read("activity")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, f=f: f(Inputs(spark, sf_dir))) for name, f in QUERIES.items()}
