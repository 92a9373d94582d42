"""The same questions in plain SQL for the driver's check, written against the same inputs."""

from __future__ import annotations

from idloom.functions.normalize import DOC_TYPE_CODES_A, LATIN
from idloom.plans.fixtures import AS_OF, with_clause
from idloom.sources import dims

ORACLE: dict[str, str] = {}
NOW = f"TIMESTAMP '{AS_OF}'"


def digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '', 'g')"


def bigint(x: str) -> str:
    return f"TRY_CAST(nullif({digits(x)}, '') AS BIGINT)"


def overflow(x: str) -> str:
    return f"(coalesce({digits(x)} <> '', false) AND {bigint(x)} IS NULL)"


def values(name: str, rows: list[tuple[int, str]]) -> str:
    body = ", ".join("({}, '{}')".format(i, n.replace("'", "''")) for i, n in rows)
    return f"{name} AS (SELECT CAST(id AS INT) AS id, name FROM (VALUES {body}) v(id, name))"


DIMS = ",\n".join(values(f"dim_{n}", rows) for n, rows in dims.TABLES.items())

YMD = "regexp_matches({d}, '^[0-9]{{4}}(0[1-9]|1[0-2])(0[1-9]|[12][0-9]|3[01])$')"


def ymd_ok(x: str) -> str:
    return YMD.format(d=digits(x))


def date_a(x: str) -> str:
    d = digits(x)
    return (f"CASE WHEN {ymd_ok(x)} THEN TRY_CAST(substr({d}, 1, 4) || '-' || substr({d}, 5, 2) || '-' || substr({d}, 7, 2) AS DATE) END")


def iso_date(x: str) -> str:
    return (f"CASE WHEN regexp_matches({x}, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$') THEN TRY_CAST(split_part({x}, '-', 1) || '-' || "
            f"lpad(split_part({x}, '-', 2), 2, '0') || '-' || lpad(split_part({x}, '-', 3), 2, '0') AS DATE) END")


def dmy(x: str) -> str:
    return (f"CASE WHEN len(string_split({x}, '.')) = 3 THEN split_part({x}, '.', 3) || '-' || split_part({x}, '.', 2) || '-' || "
            f"split_part({x}, '.', 1) ELSE {x} END")


def phone_a(x: str) -> str:
    d = digits(x)
    return f"CASE WHEN regexp_matches({d}, '^8[0-9]{{10}}$') THEN '7' || substr({d}, 2) ELSE nullif({d}, '') END"


def phone_b() -> str:
    pick = "CASE WHEN phone3 <> '' THEN phone3 WHEN phone2 <> '' THEN phone2 ELSE phone1 END"
    return digits(pick)


def type_a(x: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in DOC_TYPE_CODES_A.items())
    return f"CAST(CASE WHEN {x} IS NULL OR {x} = '' THEN 1 ELSE CASE {x} {cases} ELSE 17 END END AS INT)"


def type_b(x: str) -> str:
    n = f"TRY_CAST(CAST({x} AS VARCHAR) AS BIGINT)"
    return f"CAST(CASE WHEN {n} IS NULL OR {n} = 0 THEN 1 WHEN {n} BETWEEN 1 AND 17 THEN {n} ELSE 17 END AS INT)"


DOC_B = "replace(replace(paspser, '-', ''), ' ', '') || replace(replace(paspnum, '-', ''), ' ', '')"
CONF_COLS = ("hisnumber, source, businessunit, lastname, name, surname, birthdate, documenttypes, document_number, "
             "email, telephone, his_password, login_email")
CONF_A = f"""conf_a AS (SELECT hisnumber, 1 AS source, 1 AS businessunit, lastname, name, surname, {date_a('birthdate')} AS birthdate,
 {type_a('documenttypes')} AS documenttypes, {bigint('series || number')} AS document_number, email, {phone_a('telephone')} AS telephone,
 CAST(NULL AS VARCHAR) AS his_password, login_email,
 CASE WHEN {ymd_ok('birthdate')} AND {date_a('birthdate')} IS NULL THEN 'BAD_DATE' WHEN {overflow('series || number')} THEN 'DOCUMENT_RANGE' END AS reject_reason
 FROM a_records)"""
CONF_B = f"""scan_b AS (SELECT pcode AS hisnumber, 2 AS source, CASE WHEN filial = 7 THEN 3 ELSE 2 END AS businessunit, lastname,
 firstname AS name, midname AS surname, bdate AS birthdate, pasptype AS documenttypes, {DOC_B} AS document_number, clmail AS email,
 {phone_b()} AS telephone, clpassword AS his_password, cllogin AS login_email FROM b_clients WHERE pcode > 0),
conf_b AS (SELECT CAST(hisnumber AS VARCHAR) AS hisnumber, source, businessunit, lastname, name, surname, birthdate,
 {type_b('documenttypes')} AS documenttypes, {bigint('document_number')} AS document_number, email, telephone, his_password, login_email,
 CASE WHEN {overflow('document_number')} THEN 'DOCUMENT_RANGE' END AS reject_reason FROM scan_b)"""
CONF = f"{CONF_A},\n{CONF_B},\nconf AS (SELECT * FROM conf_a UNION ALL SELECT * FROM conf_b)"
CONF_DEPS = ["a_records", "b_clients"]

GOLD_COLS = ("uuid, documenttypes, document_number, lastname, name, surname, birthdate, hisnumber_a, email_a, telephone_a, password_a, login_a, "
             "hisnumber_b, email_b, telephone_b, password_b, login_b, primary_source, registered_via_mobile")
GOLD = """gold AS (SELECT uuid, CAST(documenttypes AS INT) AS documenttypes, document_number, lastname, name, surname, birthdate,
 hisnumber_a, CAST(NULL AS VARCHAR) AS email_a, CAST(NULL AS VARCHAR) AS telephone_a, password_a, login_a,
 hisnumber_b, CAST(NULL AS VARCHAR) AS email_b, CAST(NULL AS VARCHAR) AS telephone_b, password_b, login_b,
 primary_source, registered_via_mobile, matching_locked FROM patients_fix)"""
NO_GOLD = GOLD.replace("gold AS", "no_gold AS") + ""
NO_GOLD = NO_GOLD[:-1] + " WHERE false)"


def ladder(d: str, m: str, p: str) -> str:
    """Priority ladder of batch ``d`` with registrations ``m`` over golden rows ``p``; result in ``lad``."""
    return f"""l_m AS (SELECT 1 AS source, hisnumber_a AS hisnumber, uuid AS m_uuid FROM {m} WHERE hisnumber_a IS NOT NULL
 UNION ALL SELECT 2, hisnumber_b, uuid FROM {m} WHERE hisnumber_b IS NOT NULL),
l_p AS (SELECT 1 AS source, hisnumber_a AS hisnumber, uuid AS p_uuid, matching_locked AS p_locked FROM {p} WHERE hisnumber_a IS NOT NULL
 UNION ALL SELECT 2, hisnumber_b, uuid, matching_locked FROM {p} WHERE hisnumber_b IS NOT NULL),
l_k AS (SELECT d.*, m.m_uuid, g.uuid AS known_uuid, q.p_uuid, coalesce(m.m_uuid, q.p_uuid) AS link,
 CASE WHEN coalesce(m.m_uuid, q.p_uuid) IS NULL THEN 1 ELSE 0 END AS phase,
 CASE WHEN coalesce(g.matching_locked, false) OR coalesce(q.p_locked, false) THEN 'LOCKED'
  WHEN m.m_uuid IS NOT NULL AND q.p_uuid IS NOT NULL AND m.m_uuid <> q.p_uuid THEN 'NUMBER_TAKEN' END AS reject_reason
 FROM {d} d LEFT JOIN l_m m ON m.source = d.source AND m.hisnumber = d.hisnumber LEFT JOIN {p} g ON g.uuid = m.m_uuid
 LEFT JOIN l_p q ON q.source = d.source AND q.hisnumber = d.hisnumber),
l_g AS (SELECT *, phase || '|' || source || '|' || hisnumber AS o FROM l_k WHERE reject_reason IS NULL),
l_link AS (SELECT link AS uuid, arg_min(documenttypes, o) AS t1, arg_min(document_number, o) FILTER (WHERE document_number IS NOT NULL) AS n1,
 bool_or(m_uuid IS NOT NULL) AS m1 FROM l_g WHERE link IS NOT NULL GROUP BY link),
l_docs AS (SELECT coalesce(g.uuid, l.uuid) AS uuid, coalesce(g.documenttypes, l.t1) AS t, coalesce(g.document_number, l.n1) AS n,
 coalesce(g.registered_via_mobile, l.m1) AS mobile FROM (SELECT * FROM {p} WHERE NOT matching_locked) g FULL OUTER JOIN l_link l ON g.uuid = l.uuid),
l_own AS (SELECT t, n, substr(min(CASE WHEN mobile THEN '0' ELSE '1' END || uuid), 2) AS owner FROM l_docs WHERE t IS NOT NULL AND n IS NOT NULL GROUP BY t, n),
l_c AS (SELECT g.*, coalesce(g.link, w.owner) AS known, coalesce(g.link, w.owner,
  CASE WHEN g.document_number IS NOT NULL THEN 'd' || g.documenttypes || '_' || g.document_number END, 's' || g.source || '_' || g.hisnumber) AS cid
 FROM l_g g LEFT JOIN l_own w ON g.phase = 1 AND w.t = g.documenttypes AND w.n = g.document_number),
l_n AS (SELECT *, row_number() OVER w AS rn, first_value('p|' || source || '|' || hisnumber) OVER w AS lead_key FROM l_c
 WINDOW w AS (PARTITION BY cid ORDER BY phase, source, hisnumber)),
lad AS (SELECT *, m_uuid AS mobile_app_uuid, coalesce(known, md5(lead_key)) AS uuid,
 CASE WHEN m_uuid IS NOT NULL THEN CASE WHEN known_uuid IS NULL AND rn = 1 THEN 'MOBILE_APP_NEW' ELSE 'MOBILE_APP_UPDATE' END
  WHEN p_uuid IS NOT NULL THEN 'UPDATED_EXISTING' WHEN document_number IS NULL THEN 'NEW_NO_DOCUMENT'
  WHEN known IS NOT NULL OR rn > 1 THEN 'MATCHED_DOCUMENT' ELSE 'NEW_WITH_DOCUMENT' END AS match_type FROM l_n)"""


def survivors(p: str) -> str:
    """Golden rows after the ladder; result in ``gold2``."""
    firsts = ", ".join(f"arg_min({c}, o) FILTER (WHERE {c} IS NOT NULL) AS n_{c}" for c in ("lastname", "name", "surname", "birthdate"))
    fields = {"hisnumber": "hisnumber", "email": "email", "telephone": "telephone", "password": "his_password", "login": "login_email"}
    blocks = ", ".join(f"max(o) FILTER (WHERE source = {s}) AS last_{x}" for s, x in ((1, "a"), (2, "b")))
    cols = ", ".join(
        f"CASE WHEN {x}.o IS NOT NULL THEN {x}.{f} ELSE g.{c}_{x} END AS {c}_{x}" for x in "ab" for c, f in fields.items())
    return f"""s_n AS (SELECT uuid, {firsts}, arg_min(source, o) FILTER (WHERE match_type <> 'UPDATED_EXISTING') AS n_ps,
 arg_min(documenttypes, o) FILTER (WHERE document_number IS NOT NULL OR link IS NOT NULL) AS n_t,
 arg_min(document_number, o) FILTER (WHERE document_number IS NOT NULL) AS n_n, bool_or(m_uuid IS NOT NULL) AS n_m, {blocks} FROM lad GROUP BY uuid),
gold2 AS (SELECT coalesce(g.uuid, n.uuid) AS uuid, coalesce(g.documenttypes, n_t) AS documenttypes, coalesce(g.document_number, n_n) AS document_number,
 coalesce(g.lastname, n_lastname) AS lastname, coalesce(g.name, n_name) AS name, coalesce(g.surname, n_surname) AS surname,
 coalesce(g.birthdate, n_birthdate) AS birthdate, {cols}, coalesce(g.primary_source, n_ps) AS primary_source,
 coalesce(g.registered_via_mobile, n_m) AS registered_via_mobile
 FROM {p} g FULL OUTER JOIN s_n n ON g.uuid = n.uuid LEFT JOIN lad a ON a.o = n.last_a AND a.uuid = n.uuid LEFT JOIN lad b ON b.o = n.last_b AND b.uuid = n.uuid)"""


def add(name: str, sql: str, *views: str, ctes: str = "") -> None:
    parts = [p for p in (with_clause(list(views)) if views else "", ctes) if p]
    ORACLE[name] = ("WITH RECURSIVE " + ",\n".join(parts) + "\n" if parts else "") + sql.strip()


# ---- sources and sinks ---------------------------------------------------------------------

add("scan_source_b", "SELECT * FROM scan_b", "b_clients", ctes=CONF_B)
add("keyset_page_b", "SELECT * FROM scan_b WHERE hisnumber > 40 ORDER BY hisnumber LIMIT 1000", "b_clients", ctes=CONF_B)
add("scan_delta_b", """SELECT pcode AS hisnumber, 2 AS source, 2 AS businessunit, lastname, firstname AS name, clmail AS email, operation, seq,
 change_time FROM delta_clients WHERE processed = 'N'""", "delta_clients")
add("scan_source_a_lines", "SELECT line FROM a_lines WHERE trim(line) <> ''", "a_lines")
REC = ("hisnumber || '|' || lastname || '|' || name || '|' || surname || '|' || birthdate || '|' || documenttypes || '|' || series || '|' || "
       "number || '|' || email || '|' || telephone || '|' || login_email")
add("parse_source_a", f"SELECT 11 AS n_fields, {REC} AS record FROM a_records", "a_records")
add("build_source_a_record", "SELECT *, 1 AS source, 1 AS businessunit FROM a_records", "a_records")
add("unprocessed_a", "SELECT hisnumber, lastname, birthdate FROM a_records WHERE hisnumber NOT IN (SELECT hisnumber FROM processed_a)",
    "a_records", "processed_a")
add("delta_summary_a", """SELECT least(count(*), 500) AS batch, count(*) AS total_unprocessed FROM a_records
 WHERE hisnumber NOT IN (SELECT hisnumber FROM processed_a)""", "a_records", "processed_a")
add("processed_set_union", "SELECT hisnumber FROM processed_a UNION SELECT hisnumber FROM a_records", "a_records", "processed_a")
add("watermark_state", f"""SELECT source, max(last_id) AS last_id, max(last_sync) AS last_sync FROM (
 SELECT source, TRY_CAST(hisnumber AS BIGINT) AS last_id, match_time AS last_sync FROM matching_log
 UNION ALL SELECT source, hisnumber, {NOW} FROM scan_b) t GROUP BY source""", "matching_log", "b_clients", ctes=CONF_B)
add("source_totals", """SELECT 1 AS source, count(*) AS total, max(hisnumber) AS last_id FROM a_records
 UNION ALL SELECT 2, count(*), CAST(max(hisnumber) AS VARCHAR) FROM scan_b""", "a_records", "b_clients", ctes=CONF_B)
add("batch_range", """SELECT batch, min(hisnumber) AS min_id, max(hisnumber) AS max_id, count(*) AS size FROM (
 SELECT hisnumber, CAST(floor((row_number() OVER (ORDER BY hisnumber) - 1) / 1000) AS BIGINT) AS batch FROM scan_b) t GROUP BY batch""", "b_clients", ctes=CONF_B)
INS = "(SELECT pcode FROM delta_clients WHERE upper(operation) = 'INSERT')"
add("mark_delta_processed", f"""SELECT seq, pcode, CASE WHEN processed = 'N' AND pcode IN {INS} THEN 'Y' ELSE processed END AS processed
 FROM delta_clients""", "delta_clients")
add("verify_delta_processed", f"""SELECT count(*) AS total, CAST(coalesce(sum(CASE WHEN processed = 'Y' THEN 1 ELSE 0 END), 0) AS BIGINT) AS processed
 FROM delta_clients WHERE pcode IN {INS}""", "delta_clients")
add("delta_pending_count", "SELECT count(*) FILTER (WHERE processed = 'N') AS pending, count(*) AS total FROM delta_clients", "delta_clients")
add("delta_recent_topk", """SELECT pcode, operation, processed, change_time, seq FROM delta_clients WHERE processed = 'N'
 ORDER BY change_time DESC, seq DESC LIMIT 5""", "delta_clients")
add("ref_dims", """SELECT d.dim, d.id, d.name, count(u.id) AS n_records FROM (
 SELECT 'sources' AS dim, id, name FROM dim_sources UNION ALL SELECT 'businessunits', id, name FROM dim_businessunits
 UNION ALL SELECT 'documenttypes', id, name FROM dim_documenttypes) d
 LEFT JOIN (SELECT 'sources' AS dim, source AS id FROM det_fix UNION ALL SELECT 'businessunits', businessunit FROM det_fix
 UNION ALL SELECT 'documenttypes', documenttypes FROM det_fix) u ON u.dim = d.dim AND u.id = d.id GROUP BY d.dim, d.id, d.name""", "det_fix", ctes=DIMS)
add("sink_insert_det", """SELECT s.source, (SELECT count(*) FROM det_fix d WHERE d.source = s.source) + s.added AS stored, s.added, s.rejected FROM (
 SELECT c.source, count(*) FILTER (WHERE d.hisnumber IS NULL) AS added, count(*) FILTER (WHERE d.hisnumber IS NOT NULL) AS rejected
 FROM conf c LEFT JOIN det_fix d ON d.source = c.source AND d.hisnumber = c.hisnumber WHERE c.reject_reason IS NULL GROUP BY c.source) s""",
    *CONF_DEPS, "det_fix", ctes=CONF)
_STORED = ("businessunit", "lastname", "name", "surname", "birthdate", "documenttypes", "document_number", "login_email")
NEW_OR_OLD = ", ".join([f"CASE WHEN n.hisnumber IS NOT NULL THEN n.{c} ELSE d.{c} END AS {c}" for c in _STORED]
                       + [f"n.{c}" for c in ("email", "telephone", "his_password")])
add("sink_upsert_det", f"""SELECT coalesce(d.hisnumber, n.hisnumber) AS hisnumber, coalesce(d.source, n.source) AS source, {NEW_OR_OLD}, d.uuid
 FROM det_fix d FULL OUTER JOIN newcomers n ON n.source = d.source AND n.hisnumber = d.hisnumber""", "det_fix", "newcomers")
add("insert_if_absent", """SELECT n.* FROM newcomers n WHERE NOT EXISTS (SELECT 1 FROM det_fix d WHERE d.source = n.source AND d.hisnumber = n.hisnumber)""",
    "det_fix", "newcomers")
LATEST = "(SELECT *, row_number() OVER (PARTITION BY pcode ORDER BY change_time DESC, seq DESC) AS rn FROM delta_clients WHERE processed = 'N')"
add("soft_delete", f"""SELECT CAST(pcode AS VARCHAR) AS hisnumber, 2 AS source, 'DELETE_REQUEST' AS action FROM {LATEST} t
 WHERE rn = 1 AND upper(operation) = 'DELETE'""", "delta_clients")
add("write_status", f"""SELECT source, count(*) AS processed_records, count(*) FILTER (WHERE reject_reason IS NULL) AS success_count,
 count(*) FILTER (WHERE reject_reason IS NOT NULL) AS error_count, 'completed' AS status, '{AS_OF.replace(' ', 'T')}' AS end_time
 FROM conf GROUP BY source""", *CONF_DEPS, ctes=CONF)

# ---- normalisation and validation ----------------------------------------------------------

add("norm_business_unit", "SELECT pcode, CASE filial WHEN 7 THEN 3 ELSE 2 END AS businessunit FROM b_clients", "b_clients")
add("norm_doc_concat_b", f"SELECT pcode, {DOC_B} AS document_text FROM b_clients", "b_clients")
add("norm_doc_number", f"SELECT hisnumber, document_number, {bigint('document_number')} AS number FROM bad_records", "bad_records")
add("norm_doc_number_a", f"SELECT hisnumber, {bigint('series || number')} AS document_number FROM a_records", "a_records")
add("norm_phone_b", f"SELECT pcode, {phone_b()} AS telephone FROM b_clients", "b_clients")
add("norm_phone_a", f"SELECT hisnumber, {phone_a('telephone')} AS telephone FROM a_records", "a_records")
add("norm_date_a", f"""SELECT hisnumber, {date_a('birthdate')} AS birthdate FROM a_records
 UNION ALL SELECT hisnumber, {date_a('birthdate')} FROM bad_records""", "a_records", "bad_records")
add("norm_date_dmy", f"SELECT hisnumber, t AS birthdate_text, {iso_date('t')} AS birthdate FROM (SELECT hisnumber, {dmy('birthdate')} AS t FROM bad_records) x", "bad_records")
add("map_doc_type_a", f"SELECT hisnumber, {type_a('documenttypes')} AS documenttypes FROM a_records", "a_records")
add("map_doc_type_b", f"""SELECT CAST(pcode AS VARCHAR) AS id, {type_b('pasptype')} AS documenttypes FROM b_clients
 UNION ALL SELECT hisnumber, {type_b('documenttypes')} FROM bad_records""", "b_clients", "bad_records")
add("clamp_doc_type", "SELECT pcode, CASE WHEN pasptype NOT BETWEEN 1 AND 17 THEN 17 ELSE pasptype END AS documenttypes FROM b_clients", "b_clients")
add("default_doc_type", f"SELECT pcode, CASE WHEN pasptype IS NULL AND {bigint('(' + DOC_B + ')')} IS NOT NULL THEN 1 ELSE pasptype END AS documenttypes FROM b_clients", "b_clients")
TYPED = f"""typed AS (SELECT hisnumber, source, businessunit, {iso_date('t')} AS birthdate, {type_b('documenttypes')} AS documenttypes,
 {bigint('document_number')} AS document_number, telephone,
 CASE WHEN t <> '' AND {iso_date('t')} IS NULL THEN 'BAD_DATE' WHEN {overflow('document_number')} THEN 'DOCUMENT_RANGE' END AS broken
 FROM (SELECT *, {dmy('birthdate')} AS t FROM bad_records) x),
judged AS (SELECT hisnumber, source, businessunit, birthdate, documenttypes, document_number, telephone,
 CASE WHEN source NOT IN (1, 2) THEN 'BAD_SOURCE' WHEN businessunit NOT IN (1, 2, 3) THEN 'BAD_UNIT' ELSE broken END AS reject_reason FROM typed)"""
add("validate_record", "SELECT * FROM judged", "bad_records", ctes=TYPED)
add("transform_fallback", """SELECT hisnumber, source, businessunit, CASE WHEN NOT bad THEN birthdate END AS birthdate,
 CASE WHEN bad THEN 17 ELSE documenttypes END AS documenttypes, CASE WHEN NOT bad THEN document_number END AS document_number,
 CASE WHEN NOT bad THEN telephone END AS telephone, bad AS is_fallback
 FROM (SELECT *, coalesce(reject_reason IN ('BAD_DATE', 'DOCUMENT_RANGE'), false) AS bad FROM judged) t""", "bad_records", ctes=TYPED)
add("conform_union", "SELECT * FROM conf", *CONF_DEPS, ctes=CONF)
add("record_flags", """SELECT hisnumber, source, documenttypes IS NOT NULL AND coalesce(document_number, 0) > 0 AS has_document,
 coalesce(email, '') <> '' OR coalesce(telephone, '') <> '' AS has_contact_info,
 coalesce(login_email, '') <> '' AND coalesce(his_password, '') <> '' AS has_login_credentials FROM conf WHERE reject_reason IS NULL""", *CONF_DEPS, ctes=CONF)
add("display_names", """SELECT r.hisnumber, r.source, r.businessunit, coalesce(s.name, 'Unknown') AS source_name, coalesce(u.name, 'Unknown') AS businessunit_name,
 concat_ws(' ', nullif(r.lastname, ''), nullif(r.name, ''), nullif(r.surname, '')) AS full_name FROM (
 SELECT hisnumber, source, businessunit, lastname, name, surname FROM det_fix
 UNION ALL SELECT hisnumber, source, businessunit, NULL, NULL, NULL FROM bad_records) r
 LEFT JOIN dim_sources s ON s.id = r.source LEFT JOIN dim_businessunits u ON u.id = r.businessunit""", "det_fix", "bad_records", ctes=DIMS)
add("valid_iso_birthdate", f"""SELECT hisnumber, birthdate, coalesce({iso_date('birthdate')} IS NOT NULL, false) AS is_valid FROM (
 SELECT hisnumber, birthdate FROM bad_records UNION ALL SELECT CAST(request_id AS VARCHAR), bdate FROM credential_requests) t""", "bad_records", "credential_requests")
add("mask_credentials", """SELECT uuid, login_a, CASE WHEN password_a <> '' THEN '********' ELSE password_a END AS password_a, login_b,
 CASE WHEN password_b <> '' THEN '********' ELSE password_b END AS password_b FROM patients_fix""", "patients_fix")


def _latin() -> str:
    out = "lower(text)"
    for k, v in LATIN.items():
        out = f"replace({out}, '{k}', '{v}')"
    return out


add("transliterate_name", f"SELECT doc_id, {_latin()} AS latin FROM documents")
add("doc_type_name", """SELECT b.pcode, b.pasptype AS documenttypes, coalesce(d.name, 'Unknown type (' || CAST(b.pasptype AS VARCHAR) || ')') AS doc_name
 FROM b_clients b LEFT JOIN dim_documenttypes d ON d.id = b.pasptype""", "b_clients", ctes=DIMS)
add("reject_stats", "SELECT reject_reason, count(*) AS n FROM judged WHERE reject_reason IS NOT NULL GROUP BY reject_reason", "bad_records", ctes=TYPED)

# ---- joins and lookups ---------------------------------------------------------------------

add("det_with_golden", """SELECT d.*, p.documenttypes AS p_documenttypes, p.document_number AS p_document_number, p.uuid AS p_uuid
 FROM det_fix d JOIN patients_fix p ON p.uuid = d.uuid""", "det_fix", "patients_fix")
add("key_exists", """SELECT DISTINCT n.hisnumber, n.source, EXISTS (SELECT 1 FROM det_fix d WHERE d.hisnumber = n.hisnumber AND d.source = n.source) AS found
 FROM newcomers n""", "det_fix", "newcomers")
add("patient_details", """SELECT p.*, s.name AS primary_source_name, coalesce(c.n, 0) AS protocol_count FROM patients_fix p
 LEFT JOIN dim_sources s ON s.id = p.primary_source LEFT JOIN (SELECT uuid, count(*) AS n FROM protocols GROUP BY uuid) c ON c.uuid = p.uuid""",
    "patients_fix", "protocols", ctes=DIMS)
add("patient_protocols", """SELECT r.id, r.uuid, r.source, s.name AS source_name, r.businessunit, u.name AS businessunit_name, r.date, r.doctor, r.protocolname,
 r.servicename, r.servicecode FROM protocols r JOIN dim_sources s ON s.id = r.source JOIN dim_businessunits u ON u.id = r.businessunit""", "protocols", ctes=DIMS)
add("patient_raw_records", """SELECT r.uuid, r.hisnumber, r.source, s.name AS source_name, r.businessunit, u.name AS businessunit_name, r.lastname, r.name, r.surname,
 r.birthdate, r.documenttypes, r.document_number FROM det_fix r JOIN dim_sources s ON s.id = r.source JOIN dim_businessunits u ON u.id = r.businessunit""", "det_fix", ctes=DIMS)
add("mobile_user_lookup", """SELECT n.hisnumber, n.source, m.uuid AS mobile_app_uuid FROM newcomers n LEFT JOIN mobile_app_users m
 ON (n.source = 1 AND m.hisnumber_a = n.hisnumber) OR (n.source = 2 AND m.hisnumber_b = n.hisnumber)""", "newcomers", "mobile_app_users")
add("mobile_user_by_uuid", "SELECT * FROM mobile_app_users WHERE uuid IN (SELECT uuid FROM number_updates)", "mobile_app_users", "number_updates")
FOUND = f"""by_login AS (SELECT r.request_id, min(p.uuid) AS uuid FROM credential_requests r JOIN (
 SELECT login_a AS l, password_a AS w, uuid FROM patients_fix UNION ALL SELECT login_b, password_b, uuid FROM patients_fix) p
 ON p.l = r.cllogin AND p.w = r.clpassword GROUP BY r.request_id),
by_name AS (SELECT r.request_id, min(p.uuid) AS uuid FROM credential_requests r JOIN patients_fix p ON p.lastname = r.lastname AND p.name = r.firstname
 AND p.birthdate = {iso_date('r.bdate')} AND CASE WHEN coalesce(r.midname, '') = '' THEN p.surname IS NULL ELSE p.surname = r.midname END GROUP BY r.request_id),
found AS (SELECT r.request_id, coalesce(l.uuid, n.uuid) AS uuid, CASE WHEN l.uuid IS NOT NULL THEN 'LOGIN' WHEN n.uuid IS NOT NULL THEN 'PERSONAL' END AS found_by
 FROM credential_requests r LEFT JOIN by_login l ON l.request_id = r.request_id LEFT JOIN by_name n ON n.request_id = r.request_id)"""
add("find_by_credentials", "SELECT * FROM found", "credential_requests", "patients_fix", ctes=FOUND)
add("similar_ids", """SELECT hisnumber, pattern, similar_id, CAST(rank AS INT) AS rank FROM (SELECT q.hisnumber, q.pattern, a.hisnumber AS similar_id,
 row_number() OVER (PARTITION BY q.hisnumber ORDER BY a.hisnumber) AS rank FROM (SELECT DISTINCT hisnumber, split_part(hisnumber, '/', 1) AS pattern FROM matching_log) q
 JOIN (SELECT DISTINCT hisnumber FROM a_records) a ON contains(a.hisnumber, q.pattern)) t WHERE rank <= 20""", "matching_log", "a_records")
add("trace_record", """SELECT n.hisnumber, n.source, CAST(CASE WHEN c.hisnumber IS NULL THEN 0 ELSE 1 END AS BIGINT) AS raw_rows, c.hisnumber IS NOT NULL AS is_conformed,
 c.businessunit, c.birthdate, c.documenttypes, c.document_number, c.telephone, c.reject_reason, d.hisnumber IS NOT NULL AS is_stored, d.uuid,
 d.documenttypes AS stored_documenttypes, d.document_number AS stored_document_number,
 CASE WHEN c.hisnumber IS NULL THEN 'NOT_IN_SOURCE' WHEN c.reject_reason IS NOT NULL THEN 'REJECT' WHEN d.hisnumber IS NOT NULL THEN 'UPSERT' ELSE 'INSERT' END AS decision
 FROM (SELECT DISTINCT hisnumber, source FROM newcomers) n LEFT JOIN conf c ON c.hisnumber = n.hisnumber AND c.source = n.source
 LEFT JOIN det_fix d ON d.hisnumber = n.hisnumber AND d.source = n.source""", *CONF_DEPS, "newcomers", "det_fix", ctes=CONF)

# ---- identity resolution -------------------------------------------------------------------

NEWCOMERS = ["newcomers", "mobile_app_users", "patients_fix"]
LAD = f"{GOLD},\n{ladder('newcomers', 'mobile_app_users', 'gold')}"
PICK = "SELECT hisnumber, source, uuid, match_type, mobile_app_uuid FROM lad WHERE match_type "
add("match_skip_assigned", "SELECT hisnumber, source, uuid FROM lad UNION ALL SELECT hisnumber, source, uuid FROM det_fix", *NEWCOMERS, "det_fix", ctes=LAD)
add("match_mobile", PICK + "LIKE 'MOBILE%'", *NEWCOMERS, ctes=LAD)
add("match_hisnumber", PICK + "= 'UPDATED_EXISTING'", *NEWCOMERS, ctes=LAD)
add("match_document", PICK + "= 'MATCHED_DOCUMENT'", *NEWCOMERS, ctes=LAD)
add("match_new", PICK + "LIKE 'NEW_%'", *NEWCOMERS, ctes=LAD)
FRESH = [*CONF_DEPS, "mobile_app_users", "patients_fix"]
LAD0 = f"{CONF},\nfeed AS (SELECT {CONF_COLS} FROM conf WHERE reject_reason IS NULL),\n{NO_GOLD},\n{ladder('feed', 'mobile_app_users', 'no_gold')}"
add("match_types", """SELECT hisnumber, source, uuid, match_type, mobile_app_uuid, match_type LIKE 'NEW_%' OR match_type = 'MOBILE_APP_NEW' AS created_uuid
 FROM lad""", *FRESH, ctes=LAD0)
add("golden_records", f"SELECT {GOLD_COLS} FROM gold2", *FRESH, ctes=f"{LAD0},\n{survivors('no_gold')}")
add("golden_records_existing", f"SELECT {GOLD_COLS} FROM gold2", *NEWCOMERS, ctes=f"{LAD},\n{survivors('gold')}")
add("match_log", f"""SELECT hisnumber, source, {NOW} AS match_time, match_type, document_number, match_type LIKE 'NEW_%' OR match_type = 'MOBILE_APP_NEW' AS created_uuid,
 mobile_app_uuid, uuid AS matched_patient_uuid, CASE WHEN document_number IS NOT NULL AND documenttypes IS NOT NULL THEN 'true' ELSE 'false' END AS has_document,
 CASE WHEN mobile_app_uuid IS NOT NULL THEN 'true' ELSE 'false' END AS is_mobile_match FROM lad""", *NEWCOMERS, ctes=LAD)
add("match_rejects", "SELECT hisnumber, source, reject_reason FROM l_k WHERE reject_reason IS NOT NULL", *NEWCOMERS, ctes=LAD)

CHANGED = f"""{GOLD},
chg AS (SELECT u.uuid, u.documenttypes, u.document_number, g.documenttypes AS old_documenttypes, g.document_number AS old_document_number,
 g.matching_locked AS is_rejected FROM doc_updates u JOIN gold g ON g.uuid = u.uuid
 WHERE u.documenttypes IS DISTINCT FROM g.documenttypes OR u.document_number IS DISTINCT FROM g.document_number)"""
AFTER = f"""{CHANGED},
aft AS (SELECT g.* REPLACE (CASE WHEN c.uuid IS NOT NULL THEN c.documenttypes ELSE g.documenttypes END AS documenttypes,
  CASE WHEN c.uuid IS NOT NULL THEN c.document_number ELSE g.document_number END AS document_number)
 FROM gold g LEFT JOIN (SELECT * FROM chg WHERE NOT is_rejected) c ON c.uuid = g.uuid),
hold AS (SELECT a.uuid, a.documenttypes, a.document_number, CASE WHEN registered_via_mobile THEN '0' ELSE '1' END || a.uuid AS rank FROM aft a
 WHERE NOT matching_locked AND EXISTS (SELECT 1 FROM chg c WHERE NOT c.is_rejected AND c.documenttypes = a.documenttypes AND c.document_number = a.document_number)),
mrg AS (SELECT h.uuid AS loser, g.survivor FROM hold h JOIN (SELECT documenttypes, document_number, substr(min(rank), 2) AS survivor FROM hold GROUP BY 1, 2) g
 ON g.documenttypes = h.documenttypes AND g.document_number = h.document_number AND g.survivor <> h.uuid)"""


def folded(members: str) -> str:
    """One row per survivor out of ``members`` (survivor, rank, golden columns)."""
    cols = [c.strip() for c in GOLD_COLS.split(",")]
    first = ", ".join(f"arg_min({c}, rank) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in cols
                      if c not in ("uuid", "documenttypes", "document_number", "registered_via_mobile"))
    return f"""SELECT survivor AS uuid, coalesce(arg_min(documenttypes, rank) FILTER (WHERE document_number IS NOT NULL), arg_min(documenttypes, rank)) AS documenttypes,
 arg_min(document_number, rank) FILTER (WHERE document_number IS NOT NULL) AS document_number, {first}, bool_or(registered_via_mobile) AS registered_via_mobile
 FROM {members} GROUP BY survivor"""


UPDATES = ["doc_updates", "patients_fix"]
ROLES = """roles AS (SELECT loser AS uuid, survivor, '1' || loser AS rank FROM mrg UNION SELECT survivor, survivor, '0' FROM mrg),
memb AS (SELECT r.survivor, r.rank, a.* FROM roles r JOIN aft a ON a.uuid = r.uuid)"""
add("doc_changed", "SELECT uuid, documenttypes, document_number, old_documenttypes, old_document_number FROM chg", *UPDATES, ctes=CHANGED)
add("locked_guard", "SELECT uuid, is_rejected FROM chg", *UPDATES, ctes=CHANGED)
add("merge_pairs", "SELECT loser AS uuid, survivor AS other_uuid FROM mrg", *UPDATES, ctes=AFTER)
add("merge_survivor", "SELECT * FROM mrg", *UPDATES, ctes=AFTER)
add("merge_fields", folded("memb"), *UPDATES, ctes=f"{AFTER},\n{ROLES}")
add("merge_repoint", "SELECT p.id, coalesce(m.survivor, p.uuid) AS uuid, p.source, p.businessunit, p.date, p.qty FROM protocols p LEFT JOIN mrg m ON m.loser = p.uuid",
    *UPDATES, "protocols", ctes=AFTER)
add("merge_log", f"""SELECT c.hisnumber, c.source, {NOW} AS match_time, 'MERGED_ON_UPDATE' AS match_type, c.document_number, false AS created_uuid,
 m.survivor AS matched_patient_uuid, m.loser AS merged_from FROM mrg m LEFT JOIN (SELECT m.loser, d.hisnumber, d.source, c.document_number,
 row_number() OVER (PARTITION BY m.loser ORDER BY d.source, d.hisnumber) AS rn FROM mrg m JOIN chg c ON c.uuid IN (m.loser, m.survivor) AND NOT c.is_rejected
 JOIN det_fix d ON d.uuid = c.uuid) c ON c.loser = m.loser AND c.rn = 1""", *UPDATES, "det_fix", ctes=AFTER)
add("merge_components", """SELECT uuid, min(label) AS component FROM reach GROUP BY uuid""", "merge_requests", ctes="""
both_ways AS (SELECT source_uuid AS a, target_uuid AS b FROM merge_requests UNION SELECT target_uuid, source_uuid FROM merge_requests),
reach AS (SELECT a AS uuid, a AS label FROM both_ways UNION SELECT e.b, r.label FROM reach r JOIN both_ways e ON e.a = r.uuid)""")
UPS = """ups AS (SELECT n.*, d.uuid FROM newcomers n JOIN det_fix d ON d.source = n.source AND d.hisnumber = n.hisnumber JOIN gold g ON g.uuid = d.uuid WHERE NOT g.matching_locked),
ups_p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uuid ORDER BY source DESC, hisnumber DESC) AS rn FROM ups) t WHERE rn = 1),
ups_s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uuid, source ORDER BY hisnumber DESC) AS rn FROM ups) t WHERE rn = 1)"""
_F = {"hisnumber": "hisnumber", "email": "email", "telephone": "telephone", "password": "his_password", "login": "login_email"}


def overwritten(person: str, block: str, p: str) -> str:
    cols = [f"CASE WHEN n.uuid IS NOT NULL THEN n.{c} ELSE g.{c} END AS {c}" for c in
            ("documenttypes", "document_number", "lastname", "name", "surname", "birthdate")]
    cols += [f"CASE WHEN {x}.uuid IS NOT NULL THEN {x}.{f} ELSE g.{c}_{x} END AS {c}_{x}" for x in "ab" for c, f in _F.items()]
    return f"""SELECT g.uuid, {', '.join(cols)}, g.primary_source, g.registered_via_mobile, g.matching_locked FROM {p} g LEFT JOIN {person} n ON n.uuid = g.uuid
 LEFT JOIN {block} a ON a.uuid = g.uuid AND a.source = 1 LEFT JOIN {block} b ON b.uuid = g.uuid AND b.source = 2"""


add("update_regular", f"SELECT {GOLD_COLS} FROM ({overwritten('ups_p', 'ups_s', 'gold')}) t", "newcomers", "det_fix", "patients_fix", ctes=f"{GOLD},\n{UPS}")
add("lock_matching", f"""SELECT p.uuid, CASE WHEN u.uuid IS NOT NULL THEN false WHEN l.uuid IS NOT NULL THEN true ELSE p.matching_locked END AS matching_locked,
 CASE WHEN u.uuid IS NULL AND l.uuid IS NOT NULL THEN {NOW} END AS matching_locked_at,
 CASE WHEN u.uuid IS NULL THEN l.reason END AS matching_locked_reason,
 CASE WHEN u.uuid IS NOT NULL OR l.uuid IS NOT NULL THEN {NOW} END AS updated_at
 FROM patients_fix p LEFT JOIN lock_requests l ON l.uuid = p.uuid LEFT JOIN (SELECT DISTINCT uuid FROM doc_updates) u ON u.uuid = p.uuid""",
    "patients_fix", "lock_requests", "doc_updates")
MANUAL = f"""{GOLD},
step AS (SELECT r.source_uuid, min(r.target_uuid) AS target_uuid FROM merge_requests r JOIN gold s ON s.uuid = r.source_uuid JOIN gold t ON t.uuid = r.target_uuid
 WHERE r.source_uuid <> r.target_uuid GROUP BY r.source_uuid),
walk AS (SELECT source_uuid, target_uuid AS survivor, 1 AS depth FROM step UNION ALL SELECT w.source_uuid, s.target_uuid, w.depth + 1 FROM walk w JOIN step s ON s.source_uuid = w.survivor),
gone AS (SELECT source_uuid, survivor, depth FROM walk w WHERE survivor NOT IN (SELECT source_uuid FROM step)),
roles AS (SELECT source_uuid AS uuid, survivor, lpad(CAST(depth AS VARCHAR), 9, '0') || source_uuid AS rank FROM gone UNION SELECT survivor, survivor, '0' FROM gone),
memb AS (SELECT r.survivor, r.rank, g.* FROM roles r JOIN gold g ON g.uuid = r.uuid)"""
add("manual_merge", f"""SELECT * FROM ({folded('memb')}) t UNION ALL BY NAME SELECT {GOLD_COLS} FROM gold WHERE uuid NOT IN (SELECT uuid FROM roles)""",
    "merge_requests", "patients_fix", ctes=MANUAL)
add("manual_merge_log", """SELECT 'MERGE:' || s.source_uuid || '->' || s.target_uuid AS hisnumber, 0 AS source, 'MANUAL_MERGE' AS match_type, g.document_number, false AS created_uuid
 FROM step s JOIN gone USING (source_uuid) JOIN gold g ON g.uuid = s.source_uuid""", "merge_requests", "patients_fix", ctes=MANUAL)
add("touch_updated_at", f"SELECT uuid, {NOW} AS updated_at FROM patients_fix", "patients_fix")

# ---- registration --------------------------------------------------------------------------

def latest_filled(table: str, cols: list[str]) -> str:
    picks = ", ".join(f"arg_max({c}, request_id) FILTER (WHERE {c} IS NOT NULL) AS n_{c}" for c in cols)
    return f"(SELECT uuid, {picks} FROM {table} GROUP BY uuid)"


add("mobile_update_numbers", f"""SELECT m.uuid, coalesce(n_hisnumber_a, hisnumber_a) AS hisnumber_a, coalesce(n_hisnumber_b, hisnumber_b) AS hisnumber_b
 FROM mobile_app_users m LEFT JOIN {latest_filled('number_updates', ['hisnumber_a', 'hisnumber_b'])} u ON u.uuid = m.uuid""", "mobile_app_users", "number_updates")
# one step per request in order, with the numbers given away so far
add("mobile_register", """SELECT q.request_id, q.hisnumber_a, q.hisnumber_b, CASE WHEN s.ok THEN md5('mobile-request|' || q.request_id) END AS uuid,
 CASE WHEN q.i IS NULL THEN 'NO_NUMBER' WHEN NOT s.ok THEN 'NUMBER_TAKEN' END AS reject_reason FROM asked q LEFT JOIN run s ON s.i = q.i""",
    "registrations", "mobile_app_users", ctes="""
nulled AS (SELECT request_id, nullif(hisnumber_a, '') AS hisnumber_a, nullif(hisnumber_b, '') AS hisnumber_b FROM registrations),
asked AS (SELECT *, row_number() OVER (ORDER BY request_id) AS i FROM nulled WHERE hisnumber_a IS NOT NULL OR hisnumber_b IS NOT NULL
 UNION ALL SELECT *, NULL FROM nulled WHERE hisnumber_a IS NULL AND hisnumber_b IS NULL),
run AS (SELECT CAST(0 AS BIGINT) AS i, NULL::BOOLEAN AS ok, (SELECT list('a' || hisnumber_a) || list('b' || hisnumber_b) FROM mobile_app_users) AS taken
 UNION ALL SELECT n.i, n.ok, CASE WHEN n.ok THEN n.taken || ['a' || n.hisnumber_a, 'b' || n.hisnumber_b] ELSE n.taken END FROM (
 SELECT q.i, q.hisnumber_a, q.hisnumber_b, r.taken, NOT coalesce(list_contains(r.taken, 'a' || q.hisnumber_a), false)
 AND NOT coalesce(list_contains(r.taken, 'b' || q.hisnumber_b), false) AS ok FROM run r JOIN asked q ON q.i = r.i + 1) n)""")
CRED = ["login_a", "password_a", "login_b", "password_b"]
add("credentials_update", f"""SELECT p.uuid, {', '.join(f'coalesce(n_{c}, {c}) AS {c}' for c in CRED)}
 FROM patients_fix p LEFT JOIN {latest_filled('credential_updates', CRED)} u ON u.uuid = p.uuid""", "patients_fix", "credential_updates")
add("classify_requests", """SELECT f.request_id, f.uuid, nullif(p.hisnumber_a, '') AS hisnumber_a, nullif(p.hisnumber_b, '') AS hisnumber_b,
 CASE WHEN p.uuid IS NULL THEN 'new_patient_created' WHEN nullif(p.hisnumber_a, '') IS NOT NULL AND nullif(p.hisnumber_b, '') IS NOT NULL THEN 'both_exist_updated' ELSE 'missing_created' END AS operation,
 concat_ws(',', CASE WHEN nullif(p.hisnumber_a, '') IS NULL THEN 'A' END, CASE WHEN nullif(p.hisnumber_b, '') IS NULL THEN 'B' END) AS targets
 FROM found f LEFT JOIN patients_fix p ON p.uuid = f.uuid""", "credential_requests", "patients_fix", ctes=FOUND)

# ---- statistics ----------------------------------------------------------------------------

add("dup_by_document", """SELECT documenttypes, document_number, patient_count, uuid FROM (SELECT documenttypes, document_number, uuid,
 count(*) OVER (PARTITION BY documenttypes, document_number) AS patient_count FROM patients_fix WHERE document_number IS NOT NULL AND documenttypes IS NOT NULL) t
 WHERE patient_count > 1""", "patients_fix")
add("dup_by_name", """SELECT lastname, name, surname, birthdate, patient_count, uuid FROM (SELECT lastname, name, surname, birthdate, uuid,
 count(*) OVER (PARTITION BY lastname, name, surname, birthdate) AS patient_count FROM namesakes
 WHERE lastname IS NOT NULL AND name IS NOT NULL AND birthdate IS NOT NULL) t WHERE patient_count > 1""", "namesakes")
add("total_patients", "SELECT (SELECT count(*) FROM patients_fix) AS total_patients, (SELECT count(*) FROM mobile_app_users) AS total_mobile_users", "patients_fix", "mobile_app_users")
add("count_by_match_type", "SELECT match_type, count(*) AS count FROM matching_log GROUP BY match_type", "matching_log")
add("stats_by_source", """SELECT s.name AS source_name, count(DISTINCT d.uuid) AS patient_count, count(*) AS record_count FROM det_fix d
 JOIN dim_sources s ON s.id = d.source GROUP BY s.name""", "det_fix", ctes=DIMS)
add("multi_source_histogram", """SELECT source_count, count(*) AS patient_count FROM (SELECT uuid, count(DISTINCT source) AS source_count FROM det_fix GROUP BY uuid) t
 GROUP BY source_count""", "det_fix")
add("mobile_stats", """SELECT count(*) AS total_mobile_users, count(CASE WHEN hisnumber_a IS NOT NULL AND hisnumber_b IS NOT NULL THEN 1 END) AS both_registered,
 count(CASE WHEN hisnumber_a IS NOT NULL AND hisnumber_b IS NULL THEN 1 END) AS a_only, count(CASE WHEN hisnumber_a IS NULL AND hisnumber_b IS NOT NULL THEN 1 END) AS b_only
 FROM mobile_app_users""", "mobile_app_users")
MSTATS = """SELECT match_type, count(*) AS count, count(CASE WHEN created_uuid THEN 1 END) AS new_patients_created,
 count(CASE WHEN mobile_app_uuid IS NOT NULL THEN 1 END) AS mobile_app_matches FROM matching_log {w} GROUP BY match_type"""
DAY = f"WHERE match_time > {NOW} - INTERVAL 24 HOUR"
add("matching_stats", MSTATS.format(w=""), "matching_log")
add("matching_stats_24h", MSTATS.format(w=DAY), "matching_log")
add("activity_24h", f"SELECT match_type, count(*) AS count FROM matching_log {DAY} GROUP BY match_type", "matching_log")
add("activity_1h_by_source", f"""SELECT CASE WHEN source = 1 THEN 'A' ELSE 'B' END AS source_name, count(*) AS count FROM matching_log
 WHERE match_time > {NOW} - INTERVAL 1 HOUR GROUP BY 1""", "matching_log")
add("count_by_source", "SELECT source, count(*) AS count FROM det_fix GROUP BY ROLLUP (source)", "det_fix")
RATE = """rate AS (SELECT s AS source_count, d AS destination_count, CASE WHEN s > 0 THEN CAST(d AS DOUBLE) / s ELSE 0.0 END AS rate,
 CASE WHEN s > 0 THEN d >= s * 0.95 ELSE true END AS is_complete FROM (SELECT (SELECT count(*) FROM scan_b) AS s, (SELECT count(*) FROM det_fix WHERE source = 2) AS d) t)"""
add("completion_rate", "SELECT source_count, destination_count, CAST(rate AS DOUBLE) AS rate, is_complete FROM rate", "b_clients", "det_fix", ctes=f"{CONF_B},\n{RATE}")
add("processing_progress", """SELECT total, total - unprocessed AS processed, unprocessed, CAST((total - unprocessed) * 100.0 AS DOUBLE) / total AS percent FROM (
 SELECT count(*) AS total, count(*) FILTER (WHERE hisnumber NOT IN (SELECT hisnumber FROM processed_a)) AS unprocessed FROM a_records) t""", "a_records", "processed_a")
add("null_document_share", """SELECT total, n AS null_document_count, CAST(n * 100.0 AS DOUBLE) / total AS percent FROM (SELECT count(*) AS total,
 count(*) FILTER (WHERE documenttypes IS NULL OR document_number IS NULL) AS n FROM det_fix) t""", "det_fix")
add("doc_type_distribution", """SELECT documenttypes, count(*) AS count, CAST(count(*) * 100.0 AS DOUBLE) / (SELECT count(*) FROM det_fix WHERE documenttypes IS NOT NULL
 AND document_number IS NOT NULL) AS percent FROM det_fix WHERE documenttypes IS NOT NULL GROUP BY documenttypes""", "det_fix")
add("match_log_delta", f"""SELECT match_type, count(*) AS increase FROM matching_log {DAY} GROUP BY match_type""", "matching_log")
add("merged_count", """SELECT (SELECT count(*) FROM gold) AS patients_before, (SELECT count(*) FROM gold) - (SELECT count(*) FROM mrg) AS patients_after,
 (SELECT count(*) FROM mrg) AS merged""", *UPDATES, ctes=AFTER)
add("max_id_counter", f"""SELECT source, max({bigint('hisnumber')}) AS max_number FROM det_fix WHERE regexp_matches(hisnumber, '^[A-Za-z]*[0-9]+') GROUP BY source""", "det_fix")
add("sync_counts", """SELECT count(*) FILTER (WHERE reject_reason IS NULL AND d.hisnumber IS NULL) AS new_records,
 count(*) FILTER (WHERE reject_reason IS NULL AND d.hisnumber IS NOT NULL) AS updated_records, count(*) FILTER (WHERE reject_reason IS NOT NULL) AS error_count
 FROM conf_a c LEFT JOIN det_fix d ON d.source = 1 AND d.hisnumber = c.hisnumber WHERE c.hisnumber NOT IN (SELECT hisnumber FROM processed_a)""",
    "a_records", "processed_a", "det_fix", ctes=CONF_A)
add("delta_op_counts", f"""SELECT CASE WHEN upper(operation) IN ('INSERT', 'UPDATE', 'DELETE') THEN upper(operation) ELSE 'UNKNOWN' END AS operation, count(*) AS count
 FROM {LATEST} t WHERE rn = 1 GROUP BY 1""", "delta_clients")

# ---- windows, sampling, constraints --------------------------------------------------------

add("delta_latest", """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY pcode ORDER BY change_time DESC, seq DESC) AS rn FROM delta_clients) t
 WHERE rn = 1""", "delta_clients")
add("sample_rows", """SELECT source, hisnumber FROM det_fix WHERE documenttypes IS NULL OR document_number IS NULL
 ORDER BY md5(source || '|' || hisnumber || '|7'), source, hisnumber LIMIT 50""", "det_fix")
add("check_unique_keys", """SELECT hisnumber, source, businessunit, birthdate, documenttypes, document_number, telephone,
 count(*) FILTER (WHERE kept) AS n_kept, count(*) FILTER (WHERE NOT kept) AS n_rejected, max(CASE WHEN NOT kept THEN 'DUPLICATE_KEY' END) AS reject_reason FROM (
 SELECT *, hisnumber IS NULL OR source IS NULL OR row_number() OVER (PARTITION BY hisnumber, source ORDER BY businessunit NULLS FIRST, birthdate NULLS FIRST,
 documenttypes NULLS FIRST, document_number NULLS FIRST, telephone NULLS FIRST) = 1 AS kept FROM bad_records) t GROUP BY ALL""", "bad_records")
add("check_mobile_has_number", "SELECT *, CASE WHEN hisnumber_a IS NULL AND hisnumber_b IS NULL THEN 'NO_NUMBER' END AS reject_reason FROM mobile_app_users", "mobile_app_users")
add("check_foreign_keys", """SELECT r.*, CASE WHEN r.source IS NOT NULL AND s.id IS NULL THEN 'FK_SOURCE' WHEN r.businessunit IS NOT NULL AND u.id IS NULL THEN 'FK_UNIT'
 WHEN r.documenttypes IS NOT NULL AND t.id IS NULL THEN 'FK_DOCUMENT_TYPE' WHEN r.uuid IS NOT NULL AND p.uuid IS NULL THEN 'FK_PATIENT' END AS reject_reason FROM (
 SELECT hisnumber, source, businessunit, TRY_CAST(documenttypes AS INT) AS documenttypes, CAST(NULL AS VARCHAR) AS uuid FROM bad_records
 UNION ALL SELECT hisnumber, source, businessunit, documenttypes, uuid FROM det_fix UNION ALL SELECT 'R', 1, 1, 1, source_uuid FROM merge_requests) r
 LEFT JOIN dim_sources s ON s.id = r.source LEFT JOIN dim_businessunits u ON u.id = r.businessunit LEFT JOIN dim_documenttypes t ON t.id = r.documenttypes
 LEFT JOIN patients_fix p ON p.uuid = r.uuid""", "bad_records", "det_fix", "merge_requests", "patients_fix", ctes=DIMS)
add("check_not_null", """SELECT *, CASE WHEN hisnumber IS NULL THEN 'NULL_HISNUMBER' WHEN source IS NULL THEN 'NULL_SOURCE' WHEN businessunit IS NULL THEN 'NULL_BUSINESSUNIT' END AS reject_reason
 FROM bad_records""", "bad_records")
add("check_lengths", f"""SELECT *, CASE WHEN length(hisnumber) > 255 THEN 'TOO_LONG_HISNUMBER' WHEN length(telephone) > 50 THEN 'TOO_LONG_TELEPHONE'
 WHEN {overflow('document_number')} THEN 'DOCUMENT_RANGE' END AS reject_reason FROM bad_records""", "bad_records")

# ---- pipelines and streams -----------------------------------------------------------------

FEED_B = f"feed AS (SELECT {CONF_COLS} FROM conf_b WHERE reject_reason IS NULL)"
add("pipeline_initial_load", f"SELECT {CONF_COLS}, uuid FROM lad", "b_clients", "mobile_app_users", "patients_fix",
    ctes=f"{CONF_B},\n{FEED_B},\n{NO_GOLD},\n{ladder('feed', 'mobile_app_users', 'no_gold')}")
# every unprocessed record of source A has a stored key, so the sync is updates and merges only
SYNC = f"""{GOLD},
{CONF_A},
rec AS (SELECT c.*, d.uuid, d.documenttypes AS old_t, d.document_number AS old_n FROM conf_a c JOIN det_fix d ON d.source = 1 AND d.hisnumber = c.hisnumber
 JOIN gold g ON g.uuid = d.uuid WHERE c.reject_reason IS NULL AND NOT g.matching_locked AND c.hisnumber NOT IN (SELECT hisnumber FROM processed_a)),
chg AS (SELECT * FROM rec WHERE documenttypes IS DISTINCT FROM old_t OR document_number IS DISTINCT FROM old_n),
aft AS ({overwritten('rec', 'rec', 'gold')}),
hold AS (SELECT a.uuid, a.documenttypes, a.document_number, CASE WHEN registered_via_mobile THEN '0' ELSE '1' END || a.uuid AS rank FROM aft a WHERE NOT matching_locked
 AND EXISTS (SELECT 1 FROM chg c WHERE c.documenttypes = a.documenttypes AND c.document_number = a.document_number)),
mrg AS (SELECT h.uuid AS loser, g.survivor FROM hold h JOIN (SELECT documenttypes, document_number, substr(min(rank), 2) AS survivor FROM hold GROUP BY 1, 2) g
 ON g.documenttypes = h.documenttypes AND g.document_number = h.document_number AND g.survivor <> h.uuid),
{ROLES},
fol AS ({folded('memb')}),
land AS (SELECT * FROM (SELECT r.survivor, c.*, row_number() OVER (PARTITION BY r.survivor ORDER BY c.hisnumber DESC) AS rn FROM chg c JOIN roles r ON r.uuid = c.uuid) t WHERE rn = 1),
done AS (SELECT f.* REPLACE ({', '.join(f'CASE WHEN l.survivor IS NOT NULL THEN l.{f} ELSE f.{c}_a END AS {c}_a' for c, f in _F.items())})
 FROM fol f LEFT JOIN land l ON l.survivor = f.uuid)"""
add("pipeline_sync_a", f"""SELECT {GOLD_COLS} FROM done UNION ALL SELECT {GOLD_COLS} FROM aft WHERE uuid NOT IN (SELECT uuid FROM roles)""",
    "a_records", "processed_a", "det_fix", "patients_fix", ctes=SYNC)
# the change log carries no documents: known records lose theirs, new ones come in without
DELTA = f"""{GOLD},
feed AS (SELECT CAST(pcode AS VARCHAR) AS hisnumber, 2 AS source, 2 AS businessunit, lastname, firstname AS name, CAST(NULL AS VARCHAR) AS surname, CAST(NULL AS DATE) AS birthdate,
 1 AS documenttypes, CAST(NULL AS BIGINT) AS document_number, clmail AS email, CAST(NULL AS VARCHAR) AS telephone, CAST(NULL AS VARCHAR) AS his_password,
 CAST(NULL AS VARCHAR) AS login_email FROM {LATEST} t WHERE rn = 1 AND upper(operation) IN ('INSERT', 'UPDATE')),
kn AS (SELECT f.*, d.uuid, d.documenttypes AS old_t, d.document_number AS old_n, m.uuid AS mobile FROM feed f JOIN det_fix d ON d.source = 2 AND d.hisnumber = f.hisnumber
 JOIN gold g ON g.uuid = d.uuid LEFT JOIN mobile_app_users m ON m.hisnumber_b = f.hisnumber WHERE NOT g.matching_locked),
nw AS (SELECT * FROM feed f WHERE NOT EXISTS (SELECT 1 FROM det_fix d WHERE d.source = 2 AND d.hisnumber = f.hisnumber)),
{ladder('nw', 'mobile_app_users', 'gold')}"""
add("pipeline_delta_b", f"""SELECT hisnumber, source, {NOW} AS match_time, CASE WHEN mobile IS NOT NULL THEN 'MOBILE_APP_UPDATE' ELSE 'UPDATED_EXISTING' END AS match_type, document_number,
 false AS created_uuid, mobile AS mobile_app_uuid, uuid AS matched_patient_uuid FROM kn
 UNION ALL SELECT hisnumber, source, {NOW}, 'REGULAR_UPDATE', document_number, false, NULL, uuid FROM kn WHERE old_t IS DISTINCT FROM documenttypes OR old_n IS DISTINCT FROM document_number
 UNION ALL SELECT hisnumber, source, {NOW}, match_type, document_number, match_type LIKE 'NEW_%' OR match_type = 'MOBILE_APP_NEW', mobile_app_uuid, uuid FROM lad""",
    "delta_clients", "det_fix", "patients_fix", "mobile_app_users", ctes=DELTA)
add("route_sync_mode", """SELECT 2 AS source, source_count, destination_count, is_complete, CASE WHEN NOT is_complete THEN 'INITIAL_LOAD'
 WHEN (SELECT max(match_time) FROM matching_log WHERE source = 2) IS NULL THEN 'SET_SYNC_TIME' ELSE 'DELTA_SYNC' END AS mode FROM rate""",
    "b_clients", "det_fix", "matching_log", ctes=f"{CONF_B},\n{RATE}")
add("dup_by_name_lists", """SELECT lastname, name, surname, birthdate, count(*) AS patient_count, CAST(0 AS BIGINT) AS part, string_agg(uuid, ',' ORDER BY uuid) AS uuids
 FROM namesakes WHERE lastname IS NOT NULL AND name IS NOT NULL AND birthdate IS NOT NULL GROUP BY 1, 2, 3, 4 HAVING count(*) > 1""", "namesakes")
add("dup_by_document_lists", """SELECT documenttypes, document_number, count(*) AS patient_count, CAST(0 AS BIGINT) AS part, string_agg(uuid, ',' ORDER BY uuid) AS uuids
 FROM patients_fix WHERE documenttypes IS NOT NULL AND document_number IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1""", "patients_fix")
add("patient_protocols_of", """SELECT r.id, r.uuid, r.source, s.name AS source_name, r.businessunit, u.name AS businessunit_name, r.date, r.doctor, r.protocolname,
 r.servicename, r.servicecode FROM protocols r JOIN dim_sources s ON s.id = r.source JOIN dim_businessunits u ON u.id = r.businessunit
 WHERE r.uuid IN (SELECT uuid FROM doc_updates)""", "protocols", "doc_updates", ctes=DIMS)
add("manual_merge_det", """SELECT d.hisnumber, d.source, coalesce(r.survivor, d.uuid) AS uuid FROM det_fix d
 LEFT JOIN (SELECT DISTINCT uuid, survivor FROM roles WHERE uuid <> survivor) r ON r.uuid = d.uuid""", "merge_requests", "patients_fix", "det_fix", ctes=MANUAL)
add("manual_merge_protocols", """SELECT d.id, coalesce(r.survivor, d.uuid) AS uuid FROM protocols d
 LEFT JOIN (SELECT DISTINCT uuid, survivor FROM roles WHERE uuid <> survivor) r ON r.uuid = d.uuid""", "merge_requests", "patients_fix", "protocols", ctes=MANUAL)
add("lock_outcome", "SELECT DISTINCT source_uuid AS uuid, source_uuid IN (SELECT uuid FROM patients_fix) AS found FROM merge_requests", "merge_requests", "patients_fix")
add("mobile_update_number", f"""SELECT m.uuid, coalesce(n_hisnumber_a, hisnumber_a) AS hisnumber_a, hisnumber_b
 FROM mobile_app_users m LEFT JOIN {latest_filled('number_updates', ['hisnumber_a'])} u ON u.uuid = m.uuid""", "mobile_app_users", "number_updates")
add("conform_text_dates", """SELECT CAST(t.pcode AS VARCHAR) AS hisnumber, CASE WHEN t.pcode % 6 < 3 THEN c.bdate END AS birthdate,
 CASE WHEN t.pcode % 6 = 3 THEN 'BAD_DATE' END AS reject_reason FROM b_text_dates t JOIN b_clients c USING (pcode) WHERE t.pcode > 0""", "b_text_dates", "b_clients")

# what a load, a sync and a change log leave beside the records
add("pipeline_load_status", """SELECT 2 AS source, (SELECT count(*) FROM scan_b) AS source_count, (SELECT count(*) FROM lad) AS destination_count,
 (SELECT count(*) FROM scan_b) - (SELECT count(*) FROM lad) AS rejected, (SELECT count(*) FROM lad) >= 0.95 * (SELECT count(*) FROM scan_b) AS is_complete,
 (SELECT max(pcode) FROM b_clients) AS last_id, true AS synced""", "b_clients", "mobile_app_users", "patients_fix",
    ctes=f"{CONF_B},\n{FEED_B},\n{NO_GOLD},\n{ladder('feed', 'mobile_app_users', 'no_gold')}")
add("pipeline_load_twice", f"SELECT {CONF_COLS} FROM feed", "b_clients", ctes=f"{CONF_B},\n{FEED_B}")
add("pipeline_sync_processed", "SELECT hisnumber FROM processed_a UNION SELECT hisnumber FROM a_records", "a_records", "processed_a")
add("pipeline_sync_protocols", "SELECT id, coalesce(m.survivor, p.uuid) AS uuid FROM protocols p LEFT JOIN mrg m ON m.loser = p.uuid",
    "a_records", "processed_a", "det_fix", "patients_fix", "protocols", ctes=SYNC)
ORACLE["pipeline_delta_deletes"] = ORACLE["soft_delete"]
add("pipeline_delta_marks", "SELECT seq, pcode, 'Y' AS processed FROM delta_clients", "delta_clients")
OLD_ROW = ("d.hisnumber, d.source, d.businessunit, d.lastname, d.name, d.surname, d.birthdate, d.documenttypes, d.document_number, CAST(NULL AS VARCHAR) AS email, "
           "CAST(NULL AS VARCHAR) AS telephone, CAST(NULL AS VARCHAR) AS his_password, d.login_email, d.uuid")
# five deliveries, each with its last change of a key; one that is older than what came before has no effect
LATE = """(SELECT *, row_number() OVER (PARTITION BY pcode ORDER BY age DESC) AS rn FROM (
 SELECT *, max(age) OVER (PARTITION BY pcode ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM (
 SELECT *, row_number() OVER (PARTITION BY pcode, part ORDER BY age DESC) AS last FROM (
 SELECT *, seq % 5 AS part, CAST(epoch_us(change_time) AS HUGEINT) * 1000000000 + seq AS age FROM delta_clients WHERE processed = 'N') a) b WHERE last = 1) c
 WHERE (before IS NULL OR age > before) AND upper(operation) IN ('INSERT', 'UPDATE'))"""
add("stream_delta_apply", f"""SELECT {OLD_ROW} FROM det_fix d WHERE NOT EXISTS (SELECT 1 FROM kn WHERE kn.source = d.source AND kn.hisnumber = d.hisnumber)
 UNION ALL SELECT {CONF_COLS}, uuid FROM kn UNION ALL SELECT {CONF_COLS}, uuid FROM lad""", "delta_clients", "det_fix", "patients_fix", "mobile_app_users",
    ctes=DELTA.replace(LATEST, LATE))
ORACLE["stream_latest_state"] = ORACLE["delta_latest"]
add("stream_dedup", "SELECT * FROM delta_clients", "delta_clients")
add("stream_activity_window", """SELECT date_trunc('hour', match_time) AS window_start, date_trunc('hour', match_time) + INTERVAL 1 HOUR AS window_end, source, count(*) AS count
 FROM matching_log GROUP BY 1, 2, 3""", "matching_log")


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
