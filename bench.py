"""Time the queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query is built and written to Spark's no-op sink, so all rows and columns are
computed. The headline queries cover each kind of operator; ``BENCH_ALL=1`` runs all of
them and ``python bench.py NAME ...`` the named ones. Each runs ``BENCH_REPEAT`` times and
the fastest run counts; what it kept is removed after it. Bytes written to shuffles, of the
last run, come from Spark's event log. A first, untimed query starts the session's threads
and Python workers.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from lanewise.catalog.queries import all_queries
from lanewise.operators.sharing import release

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINES = [
    "read_cleaned", "decision_log", "dup_counts", "dedup_full_row", "value_counts",
    "quantile_table", "iqr_fences", "winsorize", "avg_rank", "delay_overview",
    "delay_by_group", "monthly_trend", "cycle_segments", "unit_freight_by",
    "freight_share_by_mode", "yearly_cost_composition", "vendor_metrics", "scorecard",
    "country_mode_heatmap", "vendor_product_cross", "kruskal_wallis", "dunn_posthoc",
    "bh_fdr", "ols_drivers", "spearman", "histogram", "box_stats", "log_density",
    "otd_by_mode", "supplier_summary", "freight_share_pivot",
]


REPEAT = int(os.environ.get("BENCH_REPEAT", "1"))


def shuffled(folder: str, spans: dict[str, tuple[float, float]]) -> dict[str, int]:
    """Bytes that the tasks launched in each span of time wrote to shuffles."""
    out = dict.fromkeys(spans, 0)
    for path in glob.glob(f"{folder}/*"):
        with open(path) as log:
            for line in log:
                if '"SparkListenerTaskEnd"' not in line:
                    continue
                task = json.loads(line)
                at = task["Task Info"]["Launch Time"] / 1000
                written = (task.get("Task Metrics") or {}).get("Shuffle Write Metrics", {})
                for name, (start, end) in spans.items():
                    if start <= at <= end:
                        out[name] += written.get("Shuffle Bytes Written", 0)
    return out


def main() -> None:
    events = tempfile.mkdtemp(prefix="lanewise-events-")
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("lanewise-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file://{events}")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        # Wide rows make methods too large for the JIT; Spark then splits them instead.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    names = sys.argv[1:] or (list(queries) if os.environ.get("BENCH_ALL") else HEADLINES)

    spans: dict[str, tuple[float, float]] = {}

    def run(name: str) -> float:
        start, began = time.perf_counter(), time.time()
        queries[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - start
        spans[name] = (began, time.time())
        release(spark)
        return round(seconds, 3)

    run("dunn_posthoc")
    seconds = {name: min(run(name) for _ in range(max(1, REPEAT))) for name in names}
    spark.stop()
    moved = shuffled(events, {name: spans[name] for name in names})
    print(json.dumps({
        "metric": "total wall time of the queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "shuffle_bytes": moved,
        "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
