"""Test inputs derived from the driver's tables by SQL that runs unchanged in Spark and in the oracle.

The views follow FIXTURES.md, with one change: the lines of the export are numbered by the person
key and not by a sort of all records, which would pass through a single task.
``{table}`` stands for a driver table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from idloom.session import scratch, tune

TABLES = ("customer", "events", "supplier", "lineitem", "orders", "part", "documents")

#: tables that are joined to a larger one by a unique key: its rows need not be sorted to look them up
HASHED = ("orders", "part")

#: point in time the statistics look back from
AS_OF = "2024-01-31 00:00:00"

VIEWS = {
    "people": """
SELECT c_custkey AS k, c_nationkey % 10 AS filial, c_mktsegment AS lastname,
 CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE 'N' || CAST(c_custkey % 50 AS STRING) END AS firstname,
 CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'M' || CAST(c_custkey % 12 AS STRING) END AS midname,
 DATE '1940-01-01' + CAST((c_custkey * 37) % 25000 AS INT) AS bdate,
 CASE WHEN c_custkey % 10 = 7 THEN c_custkey - 1 ELSE c_custkey END AS dk, c_custkey % 10 AS dt10
FROM {customer}""",
    "b_clients": """
SELECT k AS pcode, filial, lastname, firstname, midname, bdate,
 CASE dt10 WHEN 0 THEN 99 WHEN 1 THEN 0 WHEN 2 THEN NULL WHEN 3 THEN 88 WHEN 4 THEN 42 WHEN 5 THEN 3 ELSE 1 END AS pasptype,
 CASE WHEN dk % 13 = 0 THEN NULL ELSE lpad(CAST(dk % 97 AS STRING), 2, '0') || '-' || lpad(CAST(dk % 89 AS STRING), 2, '0') END AS paspser,
 CASE WHEN dk % 19 = 0 THEN '' ELSE substr(lpad(CAST(dk * 7 AS STRING), 9, '0'), 1, 3) || ' ' || substr(lpad(CAST(dk * 7 AS STRING), 9, '0'), 4, 6) END AS paspnum,
 'c' || CAST(k AS STRING) || '@example.com' AS clmail,
 '8 (495) ' || lpad(CAST(k AS STRING), 7, '0') AS phone1,
 CASE k % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE '+7-900-' || lpad(CAST(k AS STRING), 7, '0') END AS phone2,
 CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE '8 901 ' || lpad(CAST(k AS STRING), 7, '0') END AS phone3,
 'pw' || CAST(k % 1000 AS STRING) AS clpassword, 'login' || CAST(k AS STRING) AS cllogin
FROM people""",
    "a_records": """
SELECT CAST(100000 + k AS STRING) || '/A' || CAST(22 + k % 3 AS STRING) AS hisnumber, lastname, coalesce(firstname, '') AS name, coalesce(midname, '') AS surname,
 CASE WHEN k % 31 = 0 THEN '19901301' WHEN k % 37 = 0 THEN '' ELSE replace(CAST(bdate AS STRING), '-', '') END AS birthdate,
 CASE dt10 WHEN 0 THEN '99' WHEN 1 THEN '' WHEN 2 THEN '16' WHEN 3 THEN '47' WHEN 4 THEN '777' WHEN 5 THEN '17' ELSE '16' END AS documenttypes,
 CASE WHEN dk % 13 = 0 THEN '' ELSE lpad(CAST(dk % 97 AS STRING), 2, '0') || ' ' || lpad(CAST(dk % 89 AS STRING), 2, '0') END AS series,
 CASE WHEN dk % 11 = 0 THEN '' ELSE lpad(CAST(dk * 7 AS STRING), 9, '0') END AS number,
 'a' || CAST(k AS STRING) || '@example.org' AS email, CASE WHEN k % 9 = 0 THEN 'none' ELSE '8 (912) ' || lpad(CAST(k AS STRING), 7, '0') END AS telephone,
 'alogin' || CAST(k AS STRING) AS login_email
FROM people WHERE k % 3 <> 1""",
    "a_lines": """
SELECT 2 * CAST(split_part(hisnumber, '/', 1) AS BIGINT) AS line_no,
 CASE WHEN right(lastname, 1) = 'Y' THEN hisnumber || '|' || lastname || '|' || name || '|' || surname
 ELSE hisnumber || '|' || lastname || '|' || name || '|' || surname || '|' || birthdate || '|' || documenttypes || '|' || series || '|' || number || '|' || email || '|' || telephone || '|' || login_email END AS line
FROM a_records
UNION ALL
SELECT 2 * CAST(split_part(hisnumber, '/', 1) AS BIGINT) + 1, birthdate || '|' || documenttypes || '|' || series || '|' || number || '|' || email || '|' || telephone || '|' || login_email
FROM a_records WHERE right(lastname, 1) = 'Y'""",
    "mobile_app_users": """
SELECT md5('mobile|' || CAST(k AS STRING)) AS uuid,
 CASE WHEN k % 3 <> 1 AND k % 2 = 0 THEN CAST(100000 + k AS STRING) || '/A' || CAST(22 + k % 3 AS STRING) END AS hisnumber_a,
 CASE WHEN k % 4 <> 0 OR k % 3 = 1 OR k % 2 = 1 THEN CAST(k AS STRING) END AS hisnumber_b
FROM people WHERE k % 17 = 0 AND k > 0""",
    "processed_a": """
SELECT CAST(100000 + k AS STRING) || '/A' || CAST(22 + k % 3 AS STRING) AS hisnumber FROM people WHERE k % 4 = 0""",
    "delta_clients": """
SELECT event_id AS seq, user_id + 1 AS pcode, ts AS change_time,
 CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' WHEN 'view' THEN 'update' WHEN 'click' THEN 'TOUCH' ELSE 'UPDATE' END AS operation,
 CASE WHEN event_id % 4 = 0 THEN 'Y' ELSE 'N' END AS processed,
 'L' || CAST(event_id % 100 AS STRING) AS lastname, 'F' || CAST(event_id % 7 AS STRING) AS firstname,
 'd' || CAST(event_id AS STRING) || '@example.com' AS clmail
FROM {events}""",
    "patients_fix": """
SELECT md5('p|' || CAST(k AS STRING)) AS uuid, CASE WHEN dt10 = 5 THEN 3 ELSE 1 END AS documenttypes,
 CASE WHEN dk % 13 = 0 THEN NULL ELSE 1000000 + dk * 7 END AS document_number, lastname, firstname AS name, midname AS surname, bdate AS birthdate,
 CASE WHEN k % 3 <> 1 THEN CAST(100000 + k AS STRING) || '/A' || CAST(22 + k % 3 AS STRING) END AS hisnumber_a,
 CASE WHEN k % 4 <> 3 OR k % 3 = 1 THEN CAST(k AS STRING) END AS hisnumber_b,
 CASE WHEN k % 3 <> 1 THEN 'alogin' || CAST(k AS STRING) END AS login_a, CASE WHEN k % 6 = 0 THEN 'apw' || CAST(k AS STRING) END AS password_a,
 CASE WHEN k % 4 <> 3 THEN 'login' || CAST(k AS STRING) END AS login_b, CASE WHEN k % 4 <> 3 THEN 'pw' || CAST(k % 1000 AS STRING) END AS password_b,
 CASE WHEN k % 3 <> 1 THEN 1 ELSE 2 END AS primary_source, k % 17 = 0 AS registered_via_mobile, k % 23 = 0 AS matching_locked
FROM people""",
    "det_fix": """
SELECT hisnumber_a AS hisnumber, 1 AS source, 1 AS businessunit, lastname, name, surname, birthdate, documenttypes, document_number, login_a AS login_email, uuid FROM patients_fix WHERE hisnumber_a IS NOT NULL
UNION ALL
SELECT hisnumber_b, 2, CASE WHEN CAST(hisnumber_b AS BIGINT) % 10 = 7 THEN 3 ELSE 2 END, lastname, name, surname, birthdate, documenttypes, document_number, login_b, uuid FROM patients_fix WHERE hisnumber_b IS NOT NULL""",
    "protocols": """
SELECT l_orderkey * 10 + l_linenumber AS id, md5('p|' || CAST(o_custkey AS STRING)) AS uuid, 1 + l_linenumber % 2 AS source, CAST(1 + l_suppkey % 3 AS INT) AS businessunit,
 l_shipdate AS date, s_name AS doctor, p_name AS protocolname, p_type AS servicename, p_brand AS servicecode, l_quantity AS qty
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {supplier} ON l_suppkey = s_suppkey JOIN {part} ON l_partkey = p_partkey""",
    "matching_log": """
SELECT CAST(user_id AS STRING) AS hisnumber, CAST(1 + event_id % 2 AS INT) AS source, ts AS match_time,
 CASE event_id % 8 WHEN 0 THEN 'NEW_WITH_DOCUMENT' WHEN 1 THEN 'NEW_NO_DOCUMENT' WHEN 2 THEN 'MATCHED_DOCUMENT' WHEN 3 THEN 'UPDATED_EXISTING'
  WHEN 4 THEN 'MOBILE_APP_NEW' WHEN 5 THEN 'MOBILE_APP_UPDATE' WHEN 6 THEN 'MERGED_ON_UPDATE' ELSE 'REGULAR_UPDATE' END AS match_type,
 event_id % 8 IN (0, 1, 4) AS created_uuid, CASE WHEN event_id % 8 IN (4, 5) THEN md5('mobile|' || CAST(user_id AS STRING)) END AS mobile_app_uuid
FROM {events}""",
    "credential_requests": """
SELECT k AS request_id, lastname, coalesce(firstname, 'N0') AS firstname, CASE WHEN k % 5 = 0 THEN '' ELSE midname END AS midname, CAST(bdate AS STRING) AS bdate,
 CASE k % 4 WHEN 0 THEN 'login' || CAST(k AS STRING) WHEN 1 THEN 'alogin' || CAST(k AS STRING) ELSE 'wrong' || CAST(k AS STRING) END AS cllogin,
 CASE k % 4 WHEN 0 THEN 'pw' || CAST(k % 1000 AS STRING) WHEN 1 THEN 'apw' || CAST(k AS STRING) ELSE 'x' END AS clpassword
FROM people WHERE k % 3 = 0 OR k % 7 = 0
UNION ALL SELECT 1000000 + s_suppkey, 'NOBODY', 'X', NULL, '1990-01-15', 'nobody' || CAST(s_suppkey AS STRING), 'x' FROM {supplier}""",
    "doc_updates": """
SELECT p.uuid, CAST(q.documenttypes AS INT) AS documenttypes, q.document_number
FROM people x JOIN patients_fix p ON p.uuid = md5('p|' || CAST(x.k AS STRING)) JOIN patients_fix q ON q.uuid = md5('p|' || CAST(x.k + 1 AS STRING))
WHERE x.dt10 IN (1, 2) AND q.document_number IS NOT NULL
UNION ALL SELECT md5('p|' || CAST(k AS STRING)), 1, 900000000 + k FROM people WHERE dt10 = 8""",
    "merge_requests": """
SELECT md5('p|' || CAST(k AS STRING)) AS source_uuid, md5('p|' || CAST(k + 1 AS STRING)) AS target_uuid FROM people WHERE dt10 IN (3, 4)
UNION ALL SELECT md5('unknown|' || CAST(k AS STRING)), md5('p|' || CAST(k AS STRING)) FROM people WHERE dt10 = 8""",
    "lock_requests": """
SELECT uuid, 'Manual lock' AS reason FROM patients_fix WHERE registered_via_mobile AND NOT matching_locked""",
    "bad_records": """
SELECT CASE WHEN s_suppkey % 11 = 3 THEN NULL ELSE 'X' || CAST(s_suppkey % 60 AS STRING) END AS hisnumber,
 CAST(CASE WHEN s_suppkey % 7 = 2 THEN 3 ELSE 1 + s_suppkey % 2 END AS INT) AS source, CAST(CASE WHEN s_suppkey % 5 = 4 THEN 9 ELSE 1 + s_suppkey % 3 END AS INT) AS businessunit,
 CASE s_suppkey % 6 WHEN 0 THEN '05.03.1980' WHEN 1 THEN '20200231' WHEN 2 THEN '1990-01-15' WHEN 3 THEN '1990-1-1' WHEN 4 THEN '90-01-15' ELSE '' END AS birthdate,
 CASE s_suppkey % 4 WHEN 0 THEN '99' WHEN 1 THEN 'abc' WHEN 2 THEN NULL ELSE '-1' END AS documenttypes,
 CASE s_suppkey % 8 WHEN 0 THEN '99999999999999999999' WHEN 1 THEN 'n/a' WHEN 2 THEN NULL ELSE '45 ' || CAST(100000 + s_suppkey AS STRING) END AS document_number,
 CASE WHEN s_suppkey % 9 = 1 THEN repeat('7', 60) ELSE '79991234567' END AS telephone
FROM {supplier}""",
    # New keys against the ready golden table: known numbers, registered numbers, known and new documents, none.
    "newcomers": """
SELECT CASE k % 5 WHEN 0 THEN CAST(k AS STRING) WHEN 1 THEN CAST(100000 + k AS STRING) || '/A' || CAST(22 + k % 3 AS STRING) ELSE 'W' || CAST(k AS STRING) END AS hisnumber,
 CAST(CASE k % 5 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 1 + k % 2 END AS INT) AS source, CAST(1 + k % 3 AS INT) AS businessunit,
 lastname, CASE WHEN k % 11 = 0 THEN NULL ELSE 'W' || CAST(k % 40 AS STRING) END AS name, midname AS surname, bdate AS birthdate,
 CAST(CASE WHEN dt10 = 5 THEN 3 ELSE 1 END AS INT) AS documenttypes,
 CASE WHEN k % 10 = 4 THEN NULL WHEN k % 10 = 9 THEN 7000000 + k % 40 ELSE 1000000 + dk * 7 END AS document_number,
 'w' || CAST(k AS STRING) || '@example.net' AS email, CASE WHEN k % 6 = 0 THEN NULL ELSE '7' || lpad(CAST(k AS STRING), 10, '9') END AS telephone,
 CASE WHEN k % 2 = 1 THEN 'wpw' || CAST(k AS STRING) END AS his_password, 'wlogin' || CAST(k AS STRING) AS login_email
FROM people""",
    "registrations": """
SELECT k AS request_id,
 CASE WHEN k % 4 = 0 THEN NULL WHEN k % 10 = 7 THEN CAST(100000 + k - 1 AS STRING) || '/A' || CAST(22 + (k - 1) % 3 AS STRING) ELSE CAST(100000 + k AS STRING) || '/A' || CAST(22 + k % 3 AS STRING) END AS hisnumber_a,
 CASE WHEN k % 6 = 0 THEN '' WHEN k % 10 = 8 THEN CAST(k - 1 AS STRING) ELSE CAST(k AS STRING) END AS hisnumber_b
FROM people""",
    "number_updates": """
SELECT k AS request_id, md5('mobile|' || CAST(CASE WHEN k % 17 = 1 THEN k - 1 ELSE k END AS STRING)) AS uuid,
 CASE WHEN k % 3 = 0 THEN NULL ELSE 'U' || CAST(k AS STRING) END AS hisnumber_a, CASE WHEN k % 2 = 0 THEN NULL ELSE 'V' || CAST(k AS STRING) END AS hisnumber_b
FROM people""",
    "credential_updates": """
SELECT k AS request_id, md5('p|' || CAST(CASE WHEN k % 9 = 1 THEN k - 1 ELSE k END AS STRING)) AS uuid,
 CASE WHEN k % 2 = 0 THEN 'na' || CAST(k AS STRING) END AS login_a, CASE WHEN k % 3 = 0 THEN 'npa' || CAST(k AS STRING) END AS password_a,
 CASE WHEN k % 4 = 0 THEN 'nb' || CAST(k AS STRING) END AS login_b, CASE WHEN k % 5 = 0 THEN 'npb' || CAST(k AS STRING) END AS password_b
FROM people""",
}

VIEWS |= {
    # birth dates of source B as text: day first and year first, padded and not, impossible, blank, missing
    "b_text_dates": """
SELECT pcode, filial, lastname, firstname, midname, CASE pcode % 6
 WHEN 0 THEN lpad(CAST(day(bdate) AS STRING), 2, '0') || '.' || lpad(CAST(month(bdate) AS STRING), 2, '0') || '.' || CAST(year(bdate) AS STRING)
 WHEN 1 THEN CAST(day(bdate) AS STRING) || '.' || CAST(month(bdate) AS STRING) || '.' || CAST(year(bdate) AS STRING)
 WHEN 2 THEN CAST(bdate AS STRING) WHEN 3 THEN '31.02.1980' WHEN 4 THEN ' ' END AS bdate
FROM b_clients""",
    # golden rows some of which are there twice under another uuid, with and without a middle name
    "namesakes": """
SELECT uuid, lastname, name, surname, birthdate, documenttypes, document_number FROM patients_fix
UNION ALL SELECT md5('n|' || uuid), lastname, name, surname, birthdate, documenttypes, document_number + 5 FROM patients_fix WHERE substr(uuid, 1, 1) < '3'
UNION ALL SELECT md5('o|' || uuid), lastname, name, surname, birthdate, 2, document_number FROM patients_fix WHERE substr(uuid, 1, 1) = '1'""",
}

_NEEDS = {name: [v for v in VIEWS if v != name and re.search(rf"\b(FROM|JOIN) {v}\b", sql)] for name, sql in VIEWS.items()}


def closure(names: list[str]) -> list[str]:
    """The views with everything they are built on, in order."""
    seen: set[str] = set()

    def add(n: str) -> None:
        if n not in seen:
            for d in _NEEDS[n]:
                add(d)
            seen.add(n)
    for n in names:
        add(n)
    return [v for v in VIEWS if v in seen]


def with_clause(names: list[str]) -> str:
    """``WITH`` body of the views as text for the oracle."""
    plain = {t: t for t in TABLES}
    return ",\n".join(f"{v} AS ({VIEWS[v].format(**plain)})" for v in closure(names))


_SCHEMAS: dict[tuple, StructType] = {}
_STORED: dict[tuple, tuple[str, StructType]] = {}


class Inputs:
    """The views as DataFrames over one folder of driver tables; ``streams`` replaces tables by streams."""

    def __init__(self, spark: SparkSession, sf_dir: str, **streams: DataFrame):
        self.spark, self.sf_dir, self.streams = tune(spark), sf_dir, streams
        self._states: dict[str, tuple] = {}

    def table(self, name: str) -> DataFrame:
        if name in self.streams:
            return self.streams[name]
        path = f"{self.sf_dir}/{name}.parquet"
        key = (self.spark.sparkContext.applicationId, path, self.state(name))
        if key not in _SCHEMAS:
            _SCHEMAS[key] = self.spark.read.parquet(path).schema
        df = self.spark.read.schema(_SCHEMAS[key]).parquet(path)
        return df.hint("shuffle_hash") if name in HASHED else df

    def state(self, name: str) -> tuple:
        """Size and time of a table's file or folder, which tell whether it is still the one that was read before."""
        if name not in self._states:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.sf_dir}/{name}.parquet")
            found = where.getFileSystem(self.spark._jsc.hadoopConfiguration()).getFileStatus(where)
            self._states[name] = (found.getLen(), found.getModificationTime())
        return self._states[name]

    def stored(self, view: str) -> DataFrame:
        """The view as a stored table, the form in which the operators meet these inputs in use; written
        to the shared folder once per session and state of the driver's tables."""
        used = " ".join(VIEWS[v] for v in closure([view]))
        key = (self.spark.sparkContext.applicationId, self.sf_dir, view, *(self.state(t) for t in TABLES if "{" + t + "}" in used))
        if key not in _STORED:
            path = scratch(self.spark, view)
            df = getattr(self, view)
            df.write.parquet(path)
            _STORED[key] = (path, df.schema)
        path, schema = _STORED[key]
        return self.spark.read.schema(schema).parquet(path)

    def __getattr__(self, view: str) -> DataFrame:
        if view not in VIEWS:
            raise AttributeError(view)
        ctes = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in closure([view]))
        sql = f"WITH {ctes}\nSELECT * FROM {view}"
        return self.spark.sql(sql, **{t: self.table(t) for t in TABLES if "{" + t + "}" in sql})
