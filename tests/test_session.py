"""Settings that the operators count on."""

import re

import pytest
from pyspark.sql import functions as F

from idloom import schemas
from idloom.operators.matching import keyed
from idloom.session import BROADCAST_BYTES, cut, tune

THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


def test_unhinted_broadcasts_are_bounded(spark):
    before = spark.conf.get(THRESHOLD)
    try:
        for given, want in (("10485760b", BROADCAST_BYTES), ("64m", BROADCAST_BYTES), ("256k", 256 << 10), ("-1", -1)):
            spark.conf.set(THRESHOLD, given)
            tune(spark)
            assert int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()) == want
    finally:
        spark.conf.set(THRESHOLD, before)


@pytest.mark.parametrize("tuned", [False, True])
def test_the_keys_of_a_large_batch_do_not_pass_through_the_driver(spark, tuned):
    """The lookups of ``pipeline_sync_a``: more keys than the limit, which Spark's default would broadcast."""
    before = spark.conf.get(THRESHOLD)
    try:
        spark.conf.set(THRESHOLD, "10485760b")
        if tuned:
            tune(spark)
        people = spark.range(40_000).select(F.md5(F.col("id").cast("string")).alias("uuid"), F.lit(1).alias("source"))
        batch = cut(people.select("source", F.col("uuid").alias("hisnumber")))
        mobile = cut(schemas.fit(people.select("uuid", F.col("uuid").alias("hisnumber_a")), schemas.MOBILE))
        patients = cut(schemas.fit(people.select("uuid", F.col("uuid").alias("hisnumber_a")), schemas.GOLDEN))
        found = keyed(batch, mobile, patients)
        assert len(found.filter("m_uuid = hisnumber AND p_uuid = hisnumber").select("phase").collect()) == 40_000
        met = keyed(batch, mobile, patients).select("link", "phase", "reject_reason")
        met.collect()
        final = met._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        by_key = re.findall(r"(\w+Join) \[source#\d+, hisnumber#\d+\]", final)
        assert by_key and ("BroadcastHashJoin" not in by_key) is tuned
    finally:
        spark.conf.set(THRESHOLD, before)
