"""Left lookup join to the device-type dimension."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.operators.joins import frequent_keys, join_lookup
from gaugeworks.settings import DEFAULTS, Settings


@dataclass(frozen=True)
class DimensionSize:
    rows: int
    bytes: int

    def fits(self, settings: Settings) -> bool:
        return (
            self.rows <= settings.broadcast_max_rows and self.bytes <= settings.broadcast_max_bytes
        )


def measure(dimension: DataFrame) -> DimensionSize:
    """Size of the dimension, after checking that its key is usable.

    Spark enforces no primary key, and a repeated id would multiply readings.
    """
    found = dimension.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("id").alias("ids"),
        F.coalesce(F.sum(F.octet_length("type_name") + F.lit(16)), F.lit(0)).alias("bytes"),
    ).first()
    if found["rows"] != found["ids"]:
        raise ValueError("dimension ids must be unique and not null")
    return DimensionSize(found["rows"], found["bytes"])


def checked_names(dimension: DataFrame) -> DataFrame:
    """``type_id``, ``__name``, failing the job where an id is null or occurs twice.

    ``measure`` looks at the dimension as it is when a plan is made. A stream's dimension is scanned
    by every micro-batch and may have changed by then, so the check is part of the plan there.
    """
    once = dimension.groupBy("id").agg(
        F.count(F.lit(1)).alias("rows"), F.max("type_name").alias("type_name")
    )
    failure = F.raise_error(F.lit("dimension ids must be unique and not null"))
    usable = F.col("id").isNotNull() & (F.col("rows") == 1)
    return once.select(
        F.col("id").alias("type_id"), F.when(usable, F.col("type_name")).otherwise(failure).alias("__name")
    )


def lookup_names(readings: DataFrame, dimension: DataFrame) -> DataFrame:
    if readings.isStreaming:
        return checked_names(dimension)
    return dimension.select(F.col("id").alias("type_id"), F.col("type_name").alias("__name"))


def frequent_ids(readings: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The ids of bounded ``readings`` that need spreading in ``lookup_join``. For a stream they come from
    what has been read before, such as yesterday's readings; an id that gets frequent later is joined
    all the same, but in one task until the stream is started with a new table."""
    return frequent_keys(readings, ["type_id"], settings.frequent_ids)


def lookup_join(
    readings: DataFrame,
    dimension: DataFrame,
    settings: Settings = DEFAULTS,
    frequent: DataFrame | None = None,
) -> DataFrame:
    """``readings`` with ``type_name`` added; ids the dimension lacks get the fallback name.

    If the dimension is too large to broadcast, its rows are copied so that frequent ids can be spread:
    all of them, or with ``frequent`` (see ``frequent_ids``) only those ids.

    Works on anything with a ``type_id`` column, streaming or not. In a stream the dimension is
    scanned by every micro-batch, so a database source is read afresh each time.
    """
    size = measure(dimension)
    joined = join_lookup(
        readings,
        lookup_names(readings, dimension),
        ["type_id"],
        "left",
        broadcast=size.fits(settings),
        salts=settings.salts,
        frequent=frequent,
    )
    return joined.select(
        *readings.columns,
        F.coalesce("__name", F.lit(settings.fallback_name)).alias("type_name"),
    )
