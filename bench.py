"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) select data and cores;
BENCH_RUNS the number of warm runs, of which the median counts; BENCH_QUERIES a subset.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog import QUERIES  # noqa: E402
from tablewright.session import build_session  # noqa: E402

HEADLINE = (
    "agg_basic",
    "agg_stats",
    "agg_nunique",
    "agg_topk",
    "summary_grouped",
    "dedup_full",
    "dedup_whole_text",
    "dedup_keep_first",
    "fill_with_mean",
    "fill_with_mode",
    "filter_by_condition",
    "convert_column_types",
    "remove_value_outliers",
    "clean_events",
    "correlation_matrix",
    "duplicate_documents",
    "outliers_by_column",
    "profile_as_rows",
    "quality_rules",
    "violations_by_row",
    "merge_nodes",
    "merge_edges",
    "matched_edges",
    "cumulative",
    "group_first_rows",
    "sql_join_inner",
    "sql_window_topn",
    "aggregate_from_config",
)


def shuffles(frame) -> int:
    """Shuffles in the plan of the result; jobs that ran while it was built are not in it."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange " in line and "BroadcastExchange" not in line for line in plan.split("\n"))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = build_session(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds, exchanges = {}, {}
    for name in names:
        times = []
        for turn in range(runs + 1):  # the first run warms up
            start = time.perf_counter()
            frame = QUERIES[name](spark, folder)
            frame.write.format("noop").mode("overwrite").save()
            if turn:
                times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
        exchanges[name] = shuffles(frame)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "exchanges": exchanges,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
