"""First aggregation step: one row per (window, type, humidity value), and per band of temperatures
(see functions/exact_sum.py; ordinary ones are all in one band).

The median needs every humidity value of a window, but only how often each occurs. Counting
equal values first keeps the result exact, shrinks the data on the map side, and spreads a type
that holds a large share of all readings over as many tasks as it has values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.exact_sum import BAND, PIECES, exact_sum_columns
from gaugeworks.functions.messages import EPOCH, required

GROUP = ["window_start", "type_id"]


def grouped_readings(readings: DataFrame, window: str, *more: Column) -> DataFrame:
    """``window``, ``type_id``, ``humidity``, ``temperature`` and ``more`` of each reading.

    Readings from elsewhere than ``decode`` may hold nulls, which have no place in a summary. In a
    stream the event time has to stay the column the watermark is on, so it is not checked here.
    """
    humidity = required(F.col("humidity"), F.col("temperature"), F.col("type_id"), never=0.0)
    if not readings.isStreaming:
        readings = readings.withColumn("event_time", required(F.col("event_time"), never=EPOCH))
    return readings.select(
        F.window("event_time", window).alias("window"),
        "type_id",
        humidity.alias("humidity"),
        "temperature",
        *more,
    )


def reading_cells(readings: DataFrame, window: str, seen_at: Column | None = None) -> DataFrame:
    """Cells of ``readings``. With ``seen_at`` the type names are carried along, each with the
    time it was last seen; without it ``type_name`` is left out.

    All aggregation buffers are fixed-width, so this runs as a hash aggregation with partial
    aggregation before the shuffle. The same call is the state of the streaming query.
    """
    named = [F.col("type_name"), seen_at.alias("seen_at")] if seen_at is not None else []
    cells = add_up(grouped_readings(readings, window, *named), "window", "type_id", "humidity")
    return cells.select(
        F.col("window.start").alias("window_start"),
        *[c for c in cells.columns if c != "window"],
    )


def add_up(rows: DataFrame, *keys: str) -> DataFrame:
    """Cells of ``rows`` (``temperature``, and maybe ``type_name`` and ``seen_at``) by ``keys``."""
    named = "type_name" in rows.columns
    pieces = exact_sum_columns(F.col("temperature"))
    prepared = rows.select(
        *[c for c in rows.columns if c != "temperature"], *[piece.alias(name) for name, piece in pieces.items()]
    )
    return prepared.groupBy(*keys, BAND, *(["type_name"] if named else [])).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(name).alias(name) for name in PIECES],
        *([F.max("seen_at").alias("seen_at")] if named else []),
    )
