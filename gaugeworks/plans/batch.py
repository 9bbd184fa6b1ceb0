"""The summary over bounded data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.exact_sum import (
    BAND,
    PIECES,
    band_pieces,
    exact_sum_columns,
    exact_sum_value,
)
from gaugeworks.functions.messages import EPOCH, required
from gaugeworks.functions.rounding import round_half_even_2
from gaugeworks.functions.times import window_label
from gaugeworks.operators.cells import GROUP
from gaugeworks.operators.lookup import lookup_join, lookup_names, measure
from gaugeworks.operators.median import fold_readings
from gaugeworks.schema import RESULT_COLUMNS
from gaugeworks.settings import DEFAULTS, Settings
from gaugeworks.sources.sinks import write_results
from gaugeworks.storage import remove, scratch_path


def publishable(groups: DataFrame, settings: Settings) -> DataFrame:
    """Folded groups with names, as summary rows: the group's key and the published record."""
    # Never null, and marked so: else a filter on it would be pushed down to the scan, where it would decode
    # every reading once more.
    start = F.coalesce("window_start", F.lit(EPOCH))
    return groups.select(
        *GROUP,
        F.window(start, settings.window)["end"].alias("window_end"),
        "n_events",
        window_label(F.col("window_start")).alias("window_time"),
        "type_name",
        round_half_even_2(F.col("mean_temperature")).alias("avg_temperature"),
        round_half_even_2(F.col("median_humidity")).alias("median_humidity"),
    )


def batch_summary(
    readings: DataFrame,
    dimension: DataFrame,
    settings: Settings = DEFAULTS,
    work: str | None = None,
) -> DataFrame:
    """Summary of unnamed readings. Intermediate tables, if any, go below ``work``: see ``fold_readings``.

    The name depends on ``type_id`` alone and the dimension does not change during a batch, so
    it is looked up once per group rather than once per reading.
    """
    groups = fold_readings(readings, settings, work)
    return publishable(lookup_join(groups, dimension, settings), settings)


def named_summary(readings: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Summary of readings that already carry ``type_name``; that of a group's latest reading counts."""
    groups = fold_readings(readings, settings, seen_at=F.col("event_time"))
    return publishable(groups, settings)


def public_result(summary: DataFrame) -> DataFrame:
    """The published four columns. They hold no date and no id, so rows may look alike."""
    return summary.select(*RESULT_COLUMNS)


def write_batch_summary(
    readings: DataFrame,
    dimension: DataFrame,
    fmt: str,
    settings: Settings = DEFAULTS,
    **options: str,
) -> None:
    """Write the summary (``write_results``), and leave no intermediate table behind."""
    spark = readings.sparkSession
    work = scratch_path(spark, "summary")
    try:
        write_results(batch_summary(readings, dimension, settings, work), fmt, **options)
    finally:
        remove(spark, work)


def mean_temperatures(readings: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """``window_start``, ``type_id``, ``avg_temperature``: sums only, no value is kept."""
    pieces = exact_sum_columns(F.col("temperature"))
    checked = [required(F.col("type_id"), F.col("temperature"), never=0).alias("type_id")]
    event_time = required(F.col("event_time"), never=EPOCH)
    prepared = readings.withColumn("event_time", event_time).select(
        F.window("event_time", settings.window)["start"].alias("window_start"),
        *checked,
        *[piece.alias(name) for name, piece in pieces.items()],
    )
    banded = prepared.groupBy(*GROUP, BAND).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(name).alias(name) for name in PIECES]
    )
    whole = banded.groupBy(*GROUP).agg(
        F.sum("n").alias("n"), F.collect_list(band_pieces()).alias("bands")
    )
    mean = exact_sum_value(F.col("bands")) / F.col("n")
    return whole.select(*GROUP, round_half_even_2(mean).alias("avg_temperature"))


def latest_names(named: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """``window_start``, ``type_id``, ``type_name`` of the latest reading, of readings with names. Of
    several names at one time the greatest is taken."""
    event_time = required(F.col("event_time"), never=EPOCH)
    seen = named.withColumn("event_time", event_time).select(
        F.window("event_time", settings.window)["start"].alias("window_start"),
        required(F.col("type_id"), never=0).alias("type_id"),
        "type_name",
        F.col("event_time").alias("seen_at"),
    )
    by_name = seen.groupBy(*GROUP, "type_name").agg(F.max("seen_at").alias("seen_at"))
    latest = F.max_by("type_name", F.struct("seen_at", "type_name"))
    return by_name.groupBy(*GROUP).agg(latest.alias("type_name"))


ENRICH_SQL = """
SELECT /*+ BROADCAST(names) */ readings.*, coalesce(names.__name, :fallback) AS type_name
FROM {readings} AS readings
LEFT JOIN {names} AS names ON names.type_id = readings.type_id
"""

# For a dimension that is too large to broadcast: see operators/joins.py.
ENRICH_SALTED_SQL = """
SELECT /*+ MERGE(names) */ readings.* EXCEPT (__salt), coalesce(names.__name, :fallback) AS type_name
FROM (SELECT *, CAST({salt} AS INT) AS __salt FROM {readings}) AS readings
LEFT JOIN (SELECT *, explode(sequence(0, :salts - 1)) AS __salt FROM {names}) AS names
  ON names.type_id = readings.type_id AND names.__salt = readings.__salt
"""


def sql_enriched(
    readings: DataFrame, dimension: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """The lookup join written in SQL; ``readings`` may be a stream. Keys and size are checked and the
    rows salted as in ``lookup_join``. The frames are passed to the statement, so views of the
    session stay as they are.
    """
    frames = {"readings": readings, "names": lookup_names(readings, dimension)}
    args = {"fallback": settings.fallback_name}
    spark = readings.sparkSession
    if measure(dimension).fits(settings):
        return spark.sql(ENRICH_SQL, args=args, **frames)
    if readings.isStreaming:
        salt = f"floor(rand(0) * {settings.salts})"
    else:
        columns = ", ".join(f"`{name}`" for name in readings.columns)
        salt = f"pmod(xxhash64({columns}), {settings.salts})"
    args["salts"] = settings.salts
    return spark.sql(ENRICH_SALTED_SQL.replace("{salt}", salt), args=args, **frames)


def sql_summary(
    readings: DataFrame, dimension: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """The summary with its enrichment in SQL."""
    return named_summary(sql_enriched(readings, dimension, settings), settings)
