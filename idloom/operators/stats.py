"""Statistics and monitoring. All are aggregates that combine on the map side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from idloom import schemas
from idloom.operators.skew import attach

# Fixed value: share of the source rows from which on an initial load counts as complete.
COMPLETE_FROM = 0.95


def _duplicates(patients: DataFrame, keys: list[str], required: list[str]) -> DataFrame:
    """Members of every group of more than one golden row: (keys, patient_count, uuid).

    One row per member, not an array per group: a placeholder value may be shared by any number of rows.
    """
    rows = patients.dropna(subset=required).select(*keys, "uuid")
    groups = rows.groupBy(*keys).agg(F.count("*").alias("patient_count")).filter("patient_count > 1")
    return attach(rows, groups, keys, "patient_count", null_safe=True).filter(
        F.col("patient_count").isNotNull()).select(*keys, "patient_count", "uuid")


def dup_by_document(patients: DataFrame) -> DataFrame:
    return _duplicates(patients, ["documenttypes", "document_number"], ["documenttypes", "document_number"])


def dup_by_name(patients: DataFrame) -> DataFrame:
    """Same last name, name, middle name (NULL counts as equal) and birth date."""
    return _duplicates(patients, ["lastname", "name", "surname", "birthdate"], ["lastname", "name", "birthdate"])


def duplicate_lists(members: DataFrame, chunk: int = 1000) -> DataFrame:
    """Groups as sorted uuid arrays, largest groups first; a group beyond ``chunk`` members is spread over several arrays."""
    keys = [c for c in members.columns if c not in ("uuid", "patient_count")]
    parts = F.ceil(F.col("patient_count") / chunk)
    return (members.withColumn("part", F.pmod(F.xxhash64("uuid"), parts))
            .groupBy(*keys, "patient_count", "part").agg(F.sort_array(F.collect_list("uuid")).alias("uuids"))
            .orderBy(F.col("patient_count").desc(), *keys, "part"))


def _counts(**parts: DataFrame) -> DataFrame:
    """One row with the number of rows of each part."""
    tagged = [df.select(F.lit(name).alias("_part")) for name, df in parts.items()]
    return reduce(DataFrame.unionAll, tagged).agg(*[F.count_if(F.col("_part") == name).alias(name) for name in parts])


def total_patients(patients: DataFrame, mobile: DataFrame) -> DataFrame:
    return _counts(total_patients=patients, total_mobile_users=mobile)


def count_by_match_type(log: DataFrame) -> DataFrame:
    return log.groupBy("match_type").agg(F.count("*").alias("count")).orderBy(F.col("count").desc(), "match_type")


def stats_by_source(det: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Persons and records per source name."""
    names = dims["sources"].select(F.col("id").alias("source"), F.col("name").alias("source_name"))
    return det.groupBy("source").agg(
        F.count_distinct("uuid").alias("patient_count"), F.count("*").alias("record_count")).join(
        F.broadcast(names), "source").select("source_name", "patient_count", "record_count")


def multi_source_histogram(det: DataFrame) -> DataFrame:
    """How many persons have records in how many sources."""
    per_person = det.groupBy("uuid").agg(F.count_distinct("source").alias("source_count"))
    return per_person.groupBy("source_count").agg(F.count("*").alias("patient_count")).orderBy("source_count")


def mobile_stats(mobile: DataFrame) -> DataFrame:
    a, b = F.col("hisnumber_a").isNotNull(), F.col("hisnumber_b").isNotNull()
    return mobile.agg(F.count("*").alias("total_mobile_users"), F.count_if(a & b).alias("both_registered"),
                      F.count_if(a & ~b).alias("a_only"), F.count_if(~a & b).alias("b_only"))


def matching_stats(log: DataFrame) -> DataFrame:
    return log.groupBy("match_type").agg(
        F.count("*").alias("count"), F.count_if("created_uuid").alias("new_patients_created"),
        F.count_if(F.col("mobile_app_uuid").isNotNull()).alias("mobile_app_matches")
    ).orderBy(F.col("count").desc(), "match_type")


def recent(log: DataFrame, as_of, interval: str) -> DataFrame:
    """Rows of the last ``interval`` before ``as_of`` (exclusive bound, which prunes a log partitioned or sorted by time)."""
    return log.filter(F.col("match_time") > schemas.stamp(as_of) - F.expr(f"INTERVAL {interval}"))


def matching_stats_24h(log: DataFrame, as_of) -> DataFrame:
    return matching_stats(recent(log, as_of, "24 HOURS"))


def activity_24h(log: DataFrame, as_of) -> DataFrame:
    return count_by_match_type(recent(log, as_of, "24 HOURS"))


def activity_1h_by_source(log: DataFrame, as_of) -> DataFrame:
    """Audit rows of the last hour per source; every source but the first goes under the second name."""
    return recent(log, as_of, "1 HOUR").groupBy("source").agg(F.count("*").alias("count")).groupBy(
        F.when(F.col("source") == 1, "A").otherwise("B").alias("source_name")).agg(F.sum("count").alias("count"))


def count_by_source(det: DataFrame) -> DataFrame:
    """Stored records per source and, with source NULL, in all."""
    return det.rollup("source").agg(F.count("*").alias("count"))


def completion_rate(clients: DataFrame, det: DataFrame, source: int) -> DataFrame:
    """Loaded share of a source; complete from 95 % on, and when the source is empty."""
    rate = F.when(F.col("source_count") > 0, F.col("destination_count") / F.col("source_count"))
    return _counts(source_count=clients, destination_count=det.filter(F.col("source") == source)).select(
        "source_count", "destination_count", F.coalesce(rate, F.lit(0.0)).alias("rate"),
        F.when(F.col("source_count") > 0, F.col("destination_count") >= F.col("source_count") * COMPLETE_FROM)
        .otherwise(True).alias("is_complete"))


def processing_progress(records: DataFrame, processed: DataFrame) -> DataFrame:
    """Total, processed and unprocessed records of source A and the processed share in percent."""
    done = processed.select("hisnumber").distinct().withColumn("_done", F.lit(True))
    return records.select("hisnumber").join(done, "hisnumber", "left").agg(
        F.count("*").alias("total"), F.count_if(F.col("_done").isNull()).alias("unprocessed")).select(
        "total", (F.col("total") - F.col("unprocessed")).alias("processed"), "unprocessed",
        F.coalesce(F.when(F.col("total") > 0, (F.col("total") - F.col("unprocessed")) * 100.0 / F.col("total")),
                   F.lit(0.0)).alias("percent"))


def null_document_share(det: DataFrame) -> DataFrame:
    lacking = F.col("documenttypes").isNull() | F.col("document_number").isNull()
    return det.agg(F.count("*").alias("total"), F.count_if(lacking).alias("null_document_count")).withColumn(
        "percent", F.when(F.col("total") > 0, F.col("null_document_count") * 100.0 / F.col("total")))


def doc_type_distribution(det: DataFrame) -> DataFrame:
    """Records per document type and their share of the records with a complete document."""
    types = det.groupBy("documenttypes").agg(
        F.count("*").alias("count"), F.count_if(F.col("document_number").isNotNull()).alias("_n"))
    typed = types.filter(F.col("documenttypes").isNotNull())
    # at most one row per known type is left here, so one window over all of them is small
    return typed.withColumn("documented", F.sum("_n").over(Window.partitionBy())).select(
        "documenttypes", "count", F.when(F.col("documented") > 0, F.col("count") * 100.0 / F.col("documented")).alias("percent"))


def match_log_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Growth per match type between two snapshots of counts (match_type, count), where there is any."""
    return before.select("match_type", F.col("count").alias("b")).join(
        after.select("match_type", F.col("count").alias("a")), "match_type", "full_outer").select(
        "match_type", (F.coalesce("a", F.lit(0)) - F.coalesce("b", F.lit(0))).alias("increase")).filter("increase > 0")


def merged_count(before: DataFrame, after: DataFrame) -> DataFrame:
    """Golden rows that disappeared between two snapshots."""
    return _counts(patients_before=before, patients_after=after).withColumn(
        "merged", F.greatest(F.col("patients_before") - F.col("patients_after"), F.lit(0)))


def max_id_counter(det: DataFrame) -> DataFrame:
    """Greatest number in the ids of each source, of ids that are letters followed by digits."""
    number = F.nullif(F.regexp_replace("hisnumber", "[^0-9]", ""), F.lit("")).try_cast("bigint")
    return det.filter(F.col("hisnumber").rlike("^[A-Za-z]*[0-9]+")).groupBy("source").agg(F.max(number).alias("max_number"))


def sync_counts(conformed: DataFrame, det: DataFrame) -> DataFrame:
    """New, updated and failed records of a sync run."""
    keys = ["source", "hisnumber"]
    known = det.select(*keys, F.lit(True).alias("_k")).join(conformed.select(*keys), keys, "left_semi")
    good = F.col("reject_reason").isNull()
    return conformed.select(*keys, "reject_reason").join(known, keys, "left").agg(
        F.count_if(good & F.col("_k").isNull()).alias("new_records"),
        F.count_if(good & F.col("_k").isNotNull()).alias("updated_records"),
        F.count_if(~good).alias("error_count"))


# Operations of the change log.
OPERATIONS = ("INSERT", "UPDATE", "DELETE")


def delta_op_counts(delta: DataFrame) -> DataFrame:
    """Changes per operation, unknown ones together."""
    op = F.upper("operation")
    return delta.groupBy(F.when(op.isin(*OPERATIONS), op).otherwise("UNKNOWN").alias("operation")).agg(F.count("*").alias("count"))


def sample_rows(df: DataFrame, n: int, seed: int, keys: list[str], null_document_only: bool = False) -> DataFrame:
    """``n`` rows in an order that only depends on their key and the seed."""
    rows = df
    if null_document_only:
        rows = rows.filter(F.col("documenttypes").isNull() | F.col("document_number").isNull())
    mix = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    return rows.withColumn("_o", mix).orderBy("_o", *keys).limit(n).drop("_o")
