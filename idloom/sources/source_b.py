"""Source B: the relational client table and its change log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from idloom.functions import normalize as N
from idloom.operators.skew import salted

SOURCE_ID = 2

#: client columns the scan reads
CLIENT_COLUMNS = ["pcode", "filial", "lastname", "firstname", "midname", "bdate", "pasptype", "paspser",
                  "paspnum", "clmail", "phone1", "phone2", "phone3", "clpassword", "cllogin"]


def read_jdbc(spark: SparkSession, url: str, table: str, lower: int, upper: int, partitions: int,
              **options: str) -> DataFrame:
    """Full read of a client table over JDBC, cut into key ranges that are fetched in parallel."""
    return (spark.read.format("jdbc").options(url=url, dbtable=table, **options)
            .option("partitionColumn", "pcode").option("lowerBound", lower)
            .option("upperBound", upper).option("numPartitions", partitions).load())


def _shape(df: DataFrame) -> list:
    """Raw client columns in the order and under the names of a record; absent ones are NULL."""
    have = set(df.columns)

    def c(name: str):
        return F.col(name) if name in have else F.lit(None).cast("string")

    return [
        F.col("pcode").alias("hisnumber"),
        F.lit(SOURCE_ID).alias("source"),
        N.norm_business_unit(c("filial").try_cast("int")).alias("businessunit"),
        c("lastname").alias("lastname"), c("firstname").alias("name"), c("midname").alias("surname"),
        # text dates stay text: what they mean, and whether they are dates, is settled when records are conformed
        (c("bdate") if dict(df.dtypes).get("bdate") == "string" else c("bdate").cast("date")).alias("birthdate"),
        c("pasptype").alias("documenttypes"),
        N.norm_doc_concat_b(c("paspser"), c("paspnum")).alias("document_number"),
        c("clmail").alias("email"),
        N.norm_phone_b(c("phone1"), c("phone2"), c("phone3")).alias("telephone"),
        c("clpassword").alias("his_password"), c("cllogin").alias("login_email"),
    ]


def scan_source_b(clients: DataFrame) -> DataFrame:
    """All clients with a positive key, columns renamed."""
    return clients.filter(F.col("pcode") > 0).select(*_shape(clients))


def keyset_page_b(clients: DataFrame, last_id: int | str | None, n: int) -> DataFrame:
    """The next ``n`` clients after ``last_id`` in key order (text comparison if it is no number)."""
    page = clients
    if last_id is not None and str(last_id) != "":
        try:
            page = page.filter(F.col("pcode") > int(last_id))
        except ValueError:
            page = page.filter(F.col("pcode").cast("string") > str(last_id))
    return scan_source_b(page).orderBy("hisnumber").limit(n)


def scan_delta_b(delta: DataFrame, n: int | None = None) -> DataFrame:
    """Pending change rows; with ``n`` the first ones in key order."""
    pending = delta.filter(F.col("processed") == "N")
    order = [c for c in ("seq", "change_time") if c in delta.columns]
    out = pending.select(*_shape(delta), "operation", *order)
    return out if n is None else out.orderBy("hisnumber", *order).limit(n)


def delta_latest(delta: DataFrame, key: str = "pcode", order: tuple[str, ...] = ("change_time", "seq")) -> DataFrame:
    """The last change of each key.

    ``rn = 1`` lets Spark keep one row per key on the map side already, so a key with very many
    changes never meets in one task.
    """
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return delta.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def mark_delta_processed(delta: DataFrame, keys: DataFrame) -> DataFrame:
    """Status 'Y' for the pending rows of the given keys; everything else unchanged."""
    hit = keys.select("pcode").distinct().withColumn("_hit", F.lit(True))
    return salted(delta, hit, ["pcode"]).withColumn(
        "processed", F.when((F.col("processed") == "N") & F.col("_hit"), F.lit("Y"))
        .otherwise(F.col("processed"))).select(*delta.columns)


def verify_delta_processed(delta: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of the given keys, and how many of them are marked."""
    counts = delta.groupBy("pcode").agg(
        F.count("*").alias("total"), F.count_if(F.col("processed") == "Y").alias("processed"))
    hit = keys.select("pcode").distinct()
    return counts.join(hit, "pcode", "left_semi").agg(
        F.coalesce(F.sum("total"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("processed"), F.lit(0)).alias("processed"))


def delta_pending_count(delta: DataFrame) -> DataFrame:
    return delta.agg(F.count_if(F.col("processed") == "N").alias("pending"), F.count("*").alias("total"))


def delta_recent_topk(delta: DataFrame, k: int = 5) -> DataFrame:
    """The latest ``k`` pending changes."""
    return (delta.filter(F.col("processed") == "N")
            .select("pcode", "operation", "processed", "change_time", "seq")
            .orderBy(F.col("change_time").desc(), F.col("seq").desc()).limit(k))
