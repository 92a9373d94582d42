"""From raw records of both sources to one conformed shape, with rejects instead of exceptions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from idloom import schemas
from idloom.functions import normalize as N

SOURCES, UNITS = (1, 2), (1, 2, 3)


def conform_a(raw: DataFrame) -> DataFrame:
    """Source A records (text fields) conformed."""
    birth, series, number = F.col("birthdate"), F.col("series"), F.col("number")
    return raw.select(
        "hisnumber", "source", "businessunit", "lastname", "name", "surname",
        N.norm_date_a(birth).alias("birthdate"),
        N.map_doc_type_a(F.col("documenttypes")).alias("documenttypes"),
        N.norm_doc_number_a(series, number).alias("document_number"),
        "email", N.norm_phone_a(F.col("telephone")).alias("telephone"),
        F.lit(None).cast("string").alias("his_password"), "login_email",
        F.when(N.impossible_date_a(birth), "BAD_DATE")
        .when(N.doc_number_overflow(N.doc_text_a(series, number)), "DOCUMENT_RANGE").alias("reject_reason"))


def conform_b(raw: DataFrame) -> DataFrame:
    """Source B records (as scanned) conformed. Birth dates that come as text may be D.M.Y or Y-M-D, padded or not."""
    number = F.col("document_number")
    born, bad_date = F.col("birthdate"), F.lit(False)
    if dict(raw.dtypes)["birthdate"] == "string":
        text = F.trim(N.norm_date_dmy(F.trim("birthdate")))
        born, bad_date = N.iso_date(text), F.coalesce(text != "", F.lit(False)) & N.iso_date(text).isNull()
    return raw.select(
        F.col("hisnumber").cast("string").alias("hisnumber"), "source", "businessunit", "lastname", "name", "surname",
        born.alias("birthdate"), N.map_doc_type_b(F.col("documenttypes")).alias("documenttypes"),
        N.norm_doc_number(number).alias("document_number"),
        "email", "telephone", "his_password", "login_email",
        F.when(bad_date, "BAD_DATE").when(N.doc_number_overflow(number), "DOCUMENT_RANGE").alias("reject_reason"))


def validated(df: DataFrame) -> DataFrame:
    """The model rules on top of conformed rows: known source, known unit, type in range."""
    earlier = F.col("reject_reason") if "reject_reason" in df.columns else F.lit(None).cast("string")
    return df.withColumns({
        "documenttypes": N.default_doc_type(N.clamp_doc_type(F.col("documenttypes")), F.col("document_number")),
        "reject_reason": F.when(~F.coalesce(F.col("source").isin(*SOURCES), F.lit(False)), "BAD_SOURCE")
        .when(~F.coalesce(F.col("businessunit").isin(*UNITS), F.lit(False)), "BAD_UNIT").otherwise(earlier)})


def conform_union(raw_a: DataFrame, raw_b: DataFrame) -> DataFrame:
    """Both feeds in the 13-column shape plus ``reject_reason`` (NULL for good rows)."""
    def shaped(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f.name).cast(f.dataType) for f in schemas.RECORD.fields], "reject_reason")
    return validated(shaped(conform_a(raw_a)).unionByName(shaped(conform_b(raw_b))))


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without the reason, and rejects with it."""
    return df.filter(F.col("reject_reason").isNull()).drop("reject_reason"), df.filter(F.col("reject_reason").isNotNull())


def validate_record(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_rejects(validated(df))


def parse_text_records(df: DataFrame) -> DataFrame:
    """Unified records that arrive as text: typed columns plus ``reject_reason`` for what has no type."""
    date_text = N.norm_date_dmy(F.col("birthdate"))
    born = N.iso_date(date_text)
    number = F.col("document_number")
    return validated(df.select(
        "hisnumber", "source", "businessunit",
        born.alias("birthdate"), N.map_doc_type_b(F.col("documenttypes")).alias("documenttypes"),
        N.norm_doc_number(number).alias("document_number"), "telephone",
        F.when(F.coalesce(date_text != "", F.lit(False)) & born.isNull(), "BAD_DATE")
        .when(N.doc_number_overflow(number), "DOCUMENT_RANGE").alias("reject_reason")))


def transform_fallback(df: DataFrame) -> DataFrame:
    """Records that cannot be converted keep their identity only: type 'other', no document, date or contact."""
    typed = parse_text_records(df)
    bad = F.coalesce(F.col("reject_reason").isin("BAD_DATE", "DOCUMENT_RANGE"), F.lit(False))
    return typed.select(
        "hisnumber", "source", "businessunit",
        F.when(~bad, F.col("birthdate")).alias("birthdate"),
        F.when(bad, F.lit(N.DOC_TYPE_OTHER)).otherwise(F.col("documenttypes")).alias("documenttypes"),
        F.when(~bad, F.col("document_number")).alias("document_number"),
        F.when(~bad, F.col("telephone")).alias("telephone"), bad.alias("is_fallback"))


def record_flags(df: DataFrame) -> DataFrame:
    """has_document, has_contact_info, has_login_credentials."""
    def filled(c: str):
        return F.coalesce(F.col(c) != "", F.lit(False))
    return df.select(
        "hisnumber", "source",
        (F.col("documenttypes").isNotNull() & F.coalesce(F.col("document_number") > 0, F.lit(False))).alias("has_document"),
        (filled("email") | filled("telephone")).alias("has_contact_info"),
        (filled("login_email") & filled("his_password")).alias("has_login_credentials"))


def display_names(df: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Source, unit and full name for display; an unknown id is 'Unknown'."""
    src = dims["sources"].select(F.col("id").alias("source"), F.col("name").alias("source_name"))
    unit = dims["businessunits"].select(F.col("id").alias("businessunit"), F.col("name").alias("businessunit_name"))
    parts = [F.nullif(F.col(c), F.lit("")) for c in ("lastname", "name", "surname")]
    return (df.join(F.broadcast(src), "source", "left").join(F.broadcast(unit), "businessunit", "left").select(
        "hisnumber", "source", "businessunit",
        F.coalesce("source_name", F.lit("Unknown")).alias("source_name"),
        F.coalesce("businessunit_name", F.lit("Unknown")).alias("businessunit_name"),
        F.concat_ws(" ", *parts).alias("full_name")))


def doc_type_name(df: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Label of the document type; an unknown id is shown with its number."""
    types = dims["documenttypes"].select(F.col("id").alias("documenttypes"), F.col("name").alias("doc_name"))
    return df.join(F.broadcast(types), "documenttypes", "left").withColumn(
        "doc_name", F.coalesce("doc_name", F.concat(F.lit("Unknown type ("), F.col("documenttypes").cast("string"), F.lit(")"))))


# A column is secret if its name contains one of these; the mask that replaces it.
SECRET_WORDS, MASK = ("password", "secret", "key", "token"), "********"


def mask_credentials(df: DataFrame) -> DataFrame:
    """Mask the filled text values of secret columns, in nested structs as well."""
    def masked(col, name: str, dtype):
        if any(w in name.lower() for w in SECRET_WORDS) and isinstance(dtype, T.StringType):
            return F.when(col != "", F.lit(MASK)).otherwise(col)
        if isinstance(dtype, T.StructType):
            return F.when(col.isNotNull(), F.struct(*[
                masked(col[f.name], f.name, f.dataType).alias(f.name) for f in dtype.fields]))
        if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
            return F.transform(col, lambda x: masked(x, "", dtype.elementType))
        return col
    return df.select([masked(F.col(f"`{f.name}`"), f.name, f.dataType).alias(f.name) for f in df.schema.fields])


def reject_stats(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("reject_reason").agg(F.count("*").alias("n"))
