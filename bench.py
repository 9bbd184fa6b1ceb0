"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from gaugeworks.plans.registered import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "json_event_decode",
    "enrich_project",
    "tumbling_window_assign",
    "window_sensor_summary_minute",
    "window_sensor_summary_hour",
    "window_sensor_summary_day",
    "sql_window_summary",
    "json_sink_encode",
    "result_readback",
    "stream_window_agg",
    "stream_late_drop",
    "stream_lookup_refresh",
]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED_DIR", "/tmp/checkpoints"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        begin = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    # The first run of a session pays for class loading and code generation.
    seconds("window_sensor_summary_minute")
    timed = {name: round(min(seconds(name) for _ in range(2)), 3) for name in HEADLINE}

    events = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    print(
        json.dumps(
            {
                "metric": "total seconds, better of two runs each",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "events": events,
                "stream_rows_per_sec": round(events / timed["stream_window_agg"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
