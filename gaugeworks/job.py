"""The streaming job for ``spark-submit``: message log in, dimension, message log out.

    spark-submit --packages <spark-sql-kafka-0-10 coordinate> --jars <jdbc driver> \\
        --conf spark.checkpoint.dir=<shared folder> gaugeworks/job.py

Addresses and credentials come from the environment; none has a default.

| variable | meaning | default |
| --- | --- | --- |
| KAFKA_BOOTSTRAP_SERVERS | the message log | required |
| KAFKA_GROUP_ID | consumer group that the log sees | the log's own choice |
| MAX_OFFSETS_PER_TRIGGER | messages per micro-batch, so that a backlog comes in parts | 1000000 |
| DIMENSION | ``jdbc``, ``table`` or a file format | jdbc |
| POSTGRES_URL, POSTGRES_USER, POSTGRES_PASSWORD | the database, for ``jdbc`` | required then |
| DIMENSION_PATH | the files of a file format | required then |
| DIMENSION_TTL_SECONDS | age at which the dimension is read again | 600 |
| SINK | ``kafka`` or ``console`` | kafka |
| TRIGGER | interval of micro-batches | 5 seconds |

The dimension is read, checked and measured once per time to live, and all micro-batches until then
use that copy: a database is not scanned every few seconds.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Mapping
from dataclasses import replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gaugeworks.functions.messages import decode  # noqa: E402
from gaugeworks.settings import DEFAULTS, Settings  # noqa: E402
from gaugeworks.sources import dimension, messages_stream, write_results  # noqa: E402
from gaugeworks.storage import remove, scratch_path, shared_dir, staged  # noqa: E402
from gaugeworks.streaming import run_refreshing  # noqa: E402


def log_options(env: Mapping[str, str]) -> dict[str, str]:
    return {"kafka.bootstrap.servers": env["KAFKA_BOOTSTRAP_SERVERS"]}


def source_options(env: Mapping[str, str]) -> dict[str, str]:
    options = {
        **log_options(env),
        "maxOffsetsPerTrigger": env.get("MAX_OFFSETS_PER_TRIGGER", "1000000"),
    }
    if env.get("KAFKA_GROUP_ID"):
        options["kafka.group.id"] = env["KAFKA_GROUP_ID"]
    return options


def database_options(env: Mapping[str, str]) -> dict[str, str]:
    return {
        "url": env["POSTGRES_URL"],
        "user": env["POSTGRES_USER"],
        "password": env["POSTGRES_PASSWORD"],
    }


def dimension_source(env: Mapping[str, str]) -> tuple[str, dict[str, str]]:
    """Kind and options of the dimension."""
    kind = env.get("DIMENSION", "jdbc")
    if kind == "jdbc":
        return kind, database_options(env)
    return kind, {} if kind == "table" else {"path": env["DIMENSION_PATH"]}


def job_settings(env: Mapping[str, str]) -> Settings:
    seconds = env.get("DIMENSION_TTL_SECONDS")
    return replace(DEFAULTS, dimension_ttl_seconds=int(seconds)) if seconds else DEFAULTS


def main(env: Mapping[str, str] = os.environ) -> None:
    spark = SparkSession.builder.appName("sensor-summaries").getOrCreate()
    sink = log_options(env)
    kind, options = dimension_source(env)
    copies: list[str] = []

    def write(summary: DataFrame, batch_id: int) -> None:
        write_results(summary, env.get("SINK", "kafka"), batch_id, **sink)

    def names() -> DataFrame:
        """A copy of the dimension as it is now; the one before is not used any more."""
        copies.append(scratch_path(spark, "dimension"))
        copy = staged(dimension(spark, kind, **options), copies[-1])
        for path in copies[:-1]:
            remove(spark, path)
        del copies[:-1]
        return copy

    run_refreshing(
        lambda: decode(messages_stream(spark, "kafka", **source_options(env))),
        names,
        write,
        f"{shared_dir(spark).rstrip('/')}/sensor-summaries",
        job_settings(env),
        processingTime=env.get("TRIGGER", "5 seconds"),
    )


if __name__ == "__main__":
    main()
