"""Small inputs and plain-Python answers."""

from __future__ import annotations

import statistics
from collections import defaultdict
from datetime import datetime, timedelta, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from gaugeworks.schema import DEVICE_TYPES, READING

JOB_FAILED = (PySparkException, Py4JJavaError)

START = datetime(2024, 1, 15, 14, 23, tzinfo=timezone.utc)


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def readings(spark, rows):
    """``rows`` of (type_id, seconds after 14:23, temperature, humidity)."""
    full = [(f"device_{t}_001", t, float(c), float(h), at(s)) for t, s, c, h in rows]
    return spark.createDataFrame(full, READING)


def dimension(spark, names: dict[int, str]):
    return spark.createDataFrame(list(names.items()), DEVICE_TYPES)


def expected(rows, names: dict[int, str], seconds: int = 60):
    """(window start, type_id, events, label, name, mean, median) by brute force."""
    groups = defaultdict(list)
    for type_id, second, temperature, humidity in rows:
        groups[(int(second // seconds), type_id)].append((temperature, humidity))
    out = []
    for (window, type_id), members in groups.items():
        start = at(window * seconds)
        temperatures = [m[0] for m in members]
        out.append(
            (
                start.replace(tzinfo=None),
                type_id,
                len(members),
                start.strftime("%H:%M"),
                names.get(type_id, "Unknown"),
                round(sum(temperatures) / len(members), 2),
                round(statistics.median(m[1] for m in members), 2),
            )
        )
    return sorted(out)


def collected(summary):
    rows = summary.selectExpr(
        "to_utc_timestamp(window_start, current_timezone()) AS s",
        "type_id",
        "n_events",
        "window_time",
        "type_name",
        "avg_temperature",
        "median_humidity",
    ).collect()
    return sorted(tuple(row) for row in rows)
