"""Plans with automatic broadcasts off, as they are on large tables: no nested-loop or cross join, no
window over all rows, and only the broadcasts that are asked for."""

import importlib
import re

import pytest
from conftest import SF

from idloom.plans import catalog
from idloom.plans.fixtures import Inputs

MODULES = ["idloom.operators.matching", "idloom.operators.merge", "idloom.operators.registration", "idloom.sources.control",
           "idloom.sources.source_a", "idloom.plans.pipelines", "idloom.plans.catalog"]

#: queries and whether they ask for a broadcast (dimensions, hot keys, partition counts)
CHECKED = ["match_types", "merge_survivor", "manual_merge_log", "mobile_register", "classify_requests", "similar_ids",
           "check_unique_keys", "check_foreign_keys", "dup_by_name", "det_with_golden", "trace_record", "sink_upsert_det",
           "processing_progress", "batch_range", "parse_source_a"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CHECKED)
def test_no_join_or_window_meets_in_one_task(spark, monkeypatch, name):
    plans = []
    from idloom.session import cut
    for m in MODULES:
        monkeypatch.setattr(importlib.import_module(m), "cut", lambda df: plans.append(plan(df)) or cut(df))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans.append(plan(catalog.QUERIES[name](Inputs(spark, SF))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for p in plans:
        assert "NestedLoop" not in p and "CartesianProduct" not in p
        for spec in re.findall(r"windowspecdefinition\(([^,]*),", p):
            # the first part is a partition key; only running sums over one count per partition or block have none
            assert not re.search(r" (ASC|DESC) |frame", spec) or re.match(r"(_part|block)#", spec), spec


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(catalog.QUERIES["matching_stats_24h"](Inputs(spark, SF)))
    assert "PushedFilters: [IsNotNull(match_time), GreaterThan(match_time," in p
    assert "ReadSchema: struct<match_time:timestamp_ntz,match_type:string,created_uuid:boolean,mobile_app_uuid:string>" in p


def test_one_row_per_key_is_kept_on_the_map_side(spark):
    p = plan(catalog.QUERIES["delta_latest"](Inputs(spark, SF)))
    assert p.count("WindowGroupLimit") == 2


def test_protocols_that_are_only_counted_are_not_stored(spark, monkeypatch):
    stored, keep = [], Inputs.stored
    monkeypatch.setattr(Inputs, "stored", lambda fx, view: stored.append(view) or keep(fx, view))
    catalog.QUERIES["manual_merge_log"](Inputs(spark, SF))
    assert "merge_requests" in stored and "protocols" not in stored


def test_protocols_are_looked_up_without_sorting_them(spark):
    assert plan(Inputs(spark, SF).protocols).count("ShuffledHashJoin") == 2


def test_the_seed_takes_protocols_from_the_view(spark, monkeypatch):
    stored, keep = [], Inputs.stored
    monkeypatch.setattr(Inputs, "stored", lambda fx, view: stored.append(view) or keep(fx, view))
    fx = Inputs(spark, SF)
    seeded = catalog._store(fx, seeded=False, protocols=True).read("protocols")
    assert "protocols" not in stored
    assert seeded.exceptAll(fx.protocols.select(*seeded.columns)).isEmpty() and seeded.count() == fx.protocols.count()
