"""Column layouts of the integrated tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: One conformed record of a source system.
RECORD = T.StructType([
    T.StructField("hisnumber", T.StringType()),
    T.StructField("source", T.IntegerType()),
    T.StructField("businessunit", T.IntegerType()),
    T.StructField("lastname", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("surname", T.StringType()),
    T.StructField("birthdate", T.DateType()),
    T.StructField("documenttypes", T.IntegerType()),
    T.StructField("document_number", T.LongType()),
    T.StructField("email", T.StringType()),
    T.StructField("telephone", T.StringType()),
    T.StructField("his_password", T.StringType()),
    T.StructField("login_email", T.StringType()),
])
RECORD_COLUMNS = RECORD.fieldNames()

#: A stored record: conformed columns plus the golden row it belongs to.
DET = T.StructType(RECORD.fields + [T.StructField("uuid", T.StringType())])

DEMOGRAPHICS = ["lastname", "name", "surname", "birthdate"]
#: record column -> prefix of the golden column of one source
BLOCK = {"hisnumber": "hisnumber", "email": "email", "telephone": "telephone",
         "his_password": "password", "login_email": "login"}
#: source id -> suffix of its golden columns
SUFFIX = {1: "a", 2: "b"}

GOLDEN = T.StructType(
    [T.StructField("uuid", T.StringType()),
     T.StructField("documenttypes", T.IntegerType()),
     T.StructField("document_number", T.LongType()),
     T.StructField("lastname", T.StringType()),
     T.StructField("name", T.StringType()),
     T.StructField("surname", T.StringType()),
     T.StructField("birthdate", T.DateType())]
    + [T.StructField(f"{p}_{s}", T.StringType()) for s in SUFFIX.values() for p in BLOCK.values()]
    + [T.StructField("primary_source", T.IntegerType()),
       T.StructField("registered_via_mobile", T.BooleanType()),
       T.StructField("matching_locked", T.BooleanType()),
       T.StructField("matching_locked_at", T.TimestampNTZType()),
       T.StructField("matching_locked_reason", T.StringType()),
       T.StructField("updated_at", T.TimestampNTZType())])

MOBILE = T.StructType([
    T.StructField("uuid", T.StringType()),
    T.StructField("hisnumber_a", T.StringType()),
    T.StructField("hisnumber_b", T.StringType()),
])

LOG = T.StructType([
    T.StructField("hisnumber", T.StringType()),
    T.StructField("source", T.IntegerType()),
    T.StructField("match_time", T.TimestampNTZType()),
    T.StructField("match_type", T.StringType()),
    T.StructField("document_number", T.LongType()),
    T.StructField("created_uuid", T.BooleanType()),
    T.StructField("mobile_app_uuid", T.StringType()),
    T.StructField("matched_patient_uuid", T.StringType()),
    T.StructField("details", T.StringType()),
])

#: Change log of source B as it is delivered.
DELTA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("pcode", T.LongType()),
    T.StructField("change_time", T.TimestampNTZType()),
    T.StructField("operation", T.StringType()),
    T.StructField("processed", T.StringType()),
    T.StructField("lastname", T.StringType()),
    T.StructField("firstname", T.StringType()),
    T.StructField("clmail", T.StringType()),
])

PROTOCOLS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("uuid", T.StringType()),
    T.StructField("source", T.IntegerType()),
    T.StructField("businessunit", T.IntegerType()),
    T.StructField("date", T.DateType()),
    T.StructField("doctor", T.StringType()),
    T.StructField("protocolname", T.StringType()),
    T.StructField("servicename", T.StringType()),
    T.StructField("servicecode", T.StringType()),
])

#: Ids of source A that have been processed, rejects included.
PROCESSED = T.StructType([T.StructField("hisnumber", T.StringType())])

#: Progress of each source.
CONTROL = T.StructType([
    T.StructField("source", T.IntegerType()),
    T.StructField("last_id", T.LongType()),
    T.StructField("last_sync", T.TimestampNTZType()),
])

#: The newest change of source B that was applied to a key, so that an older one that comes late has no effect.
APPLIED = T.StructType([
    T.StructField("hisnumber", T.StringType()),
    T.StructField("source", T.IntegerType()),
    T.StructField("change_time", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
])

#: Audit rows per source and window.
ACTIVITY = T.StructType([
    T.StructField("window_start", T.TimestampNTZType()), T.StructField("window_end", T.TimestampNTZType()),
    T.StructField("source", T.IntegerType()), T.StructField("count", T.LongType())])

REJECTS = T.StructType(RECORD.fields + [T.StructField("reject_reason", T.StringType())])
#: Golden rows that went into another one.
MERGES = T.StructType([T.StructField("loser", T.StringType()), T.StructField("survivor", T.StringType())])
#: Delete requests of source B, which are noted and remove nothing.
DELETES = T.StructType([T.StructField("hisnumber", T.StringType()), T.StructField("source", T.IntegerType()),
                        T.StructField("action", T.StringType())])
#: Rows of the change log that a batch consumed.
MARKS = T.StructType([T.StructField("pcode", T.LongType()), T.StructField("seq", T.LongType())])
STATUS = T.StructType([
    T.StructField("pipeline", T.StringType()), T.StructField("source", T.IntegerType()), T.StructField("at", T.TimestampNTZType()),
    T.StructField("source_count", T.LongType()), T.StructField("destination_count", T.LongType()),
    T.StructField("rejected", T.LongType()), T.StructField("is_complete", T.BooleanType())])


def fit(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select exactly ``schema``: cast what is there, NULL for what is not."""
    have = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def empty(spark, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def stamp(as_of) -> Column:
    """A given point in time (datetime or ISO text) as a timestamp without zone; never the clock."""
    return F.lit(str(as_of)).cast("timestamp_ntz")
