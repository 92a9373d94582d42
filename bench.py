"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The first run of a query is reported as ``cold`` (it also derives and stores the inputs), then the median of up to three
runs; a query is not repeated once its runs have taken 15 seconds. Every result is computed in full (``noop`` sink).
``shuffle_mb`` and ``written_mb`` are what the last run shuffled and wrote, intermediate tables included, from the
event log of the session.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from idloom.plans import catalog  # noqa: E402
from idloom.session import build_session  # noqa: E402

HEADLINE = [
    "parse_source_a", "conform_union", "golden_records", "delta_latest", "merge_repoint", "dup_by_name",
    "patient_protocols", "matching_stats", "match_types", "golden_records_existing", "find_by_credentials",
    "update_regular", "merge_components", "dup_by_document", "patient_details", "mark_delta_processed",
    "stats_by_source", "check_foreign_keys", "pipeline_delta_b",
]


def moved(log: Path, spans: dict[str, tuple[float, float]]) -> dict[str, list[float]]:
    """MB shuffled and written by the tasks that began within each span."""
    out = {name: [0.0, 0.0] for name in spans}
    for file in log.rglob("*"):
        for line in file.open(errors="replace") if file.is_file() else []:
            if '"SparkListenerTaskEnd"' not in line:
                continue
            e = json.loads(line)
            at, m = e["Task Info"]["Launch Time"] / 1000, e.get("Task Metrics") or {}
            for name, (start, end) in spans.items():
                if start <= at <= end:
                    out[name][0] += m.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0) / 1e6
                    out[name][1] += m.get("Output Metrics", {}).get("Bytes Written", 0) / 1e6
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    log = Path(tempfile.mkdtemp(prefix="bench-events-"))
    spark = build_session(f"local[{cpus}]", cpus, app="bench", spark__ui__enabled="false",
                          spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
                          spark__ui__showConsoleProgress="false", spark__eventLog__enabled="true",
                          spark__eventLog__dir=log.as_uri(), spark__eventLog__compress="false")
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    seconds, cold, spans = {}, {}, {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        taken = []
        for i in range(runs + 1):
            begun, start = time.time(), time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - start
            spans[name] = (begun, time.time())
            if i:
                taken.append(spent)
            else:
                cold[name] = round(spent, 3)
            if sum(taken) > 15:
                break
        seconds[name] = round(statistics.median(taken), 3)
    spark.stop()
    sizes = moved(log, spans)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cold": cold,
                      "shuffle_mb": {n: round(x[0], 3) for n, x in sizes.items()},
                      "written_mb": {n: round(x[1], 3) for n, x in sizes.items()}}))


if __name__ == "__main__":
    main()
