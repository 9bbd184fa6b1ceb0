"""The registered queries: each operator run over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugeworks.functions import (
    decode,
    encode_reading,
    encode_result,
    epoch_ms,
    from_epoch_ms,
    iso_text,
    parse_iso,
    round_half_even_2,
    window_label,
)
from gaugeworks.operators.cells import reading_cells
from gaugeworks.operators.dimension import ensure, seed
from gaugeworks.operators.lookup import frequent_ids, lookup_join
from gaugeworks.operators.lookup_cache import cached_lookup
from gaugeworks.plans.batch import (
    batch_summary,
    latest_names,
    mean_temperatures,
    sql_summary,
    write_batch_summary,
)
from gaugeworks.schema import DEVICE_TYPES
from gaugeworks.settings import DEFAULTS, Settings
from gaugeworks.sources import (
    follow_results,
    messages_stream,
    newest_version,
    publish_version,
    results,
    results_stream,
    sensor_table,
    version_names,
    write_results,
)
from gaugeworks.storage import remove, scratch_path, set_times
from gaugeworks.streaming import run_available, start, start_rows, streaming_cells, window_rows, windows

HOUR = replace(DEFAULTS, window="1 hour")
DAY = replace(DEFAULTS, window="1 day")


def _utc(spark: SparkSession) -> None:
    """The test tables' zone-less timestamps are UTC; the session has to agree."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    _utc(spark)
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def readings_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensor_table(events_table(spark, sf_dir))


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/region.parquet").select(
        F.col("r_regionkey").alias("id"), F.col("r_name").alias("type_name")
    )


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/nation.parquet").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("type_name")
    )


def _zoneless(frame: DataFrame) -> DataFrame:
    """Timestamps as the test tables have them."""
    return frame.select(
        *[
            F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
            for name, kind in frame.dtypes
        ]
    )


# --- messages and scalar functions -------------------------------------------------------------


def json_event_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = readings_table(spark, sf_dir).select(encode_reading().alias("value"))
    return _zoneless(decode(messages))


def iso_timestamp_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return _zoneless(
        events_table(spark, sf_dir).select("event_id", parse_iso(text).alias("event_time"))
    )


def timestamp_to_epoch_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_table(spark, sf_dir).select(
        "event_id", epoch_ms(F.col("ts").cast("timestamp")).alias("event_time_ms")
    )


def epoch_ms_to_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = epoch_ms(F.col("ts").cast("timestamp"))
    return _zoneless(
        events_table(spark, sf_dir).select(
            "event_id",
            from_epoch_ms(ms).alias("event_time"),
            iso_text(F.col("ts").cast("timestamp")).alias("event_time_text"),
        )
    )


def round_half_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An eighth of each value: many of them lie exactly between two cents."""
    return events_table(spark, sf_dir).select(
        "event_id",
        round_half_even_2(F.col("value") / 8).alias("eighth"),
        round_half_even_2(F.col("value") / 3).alias("third"),
    )


def window_time_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.window("event_time", DEFAULTS.window)["start"]
    return _zoneless(
        events_table(spark, sf_dir)
        .select("event_id", F.col("ts").cast("timestamp").alias("event_time"))
        .select("event_id", start.alias("window_start"))
        .withColumn("window_time", window_label(F.col("window_start")))
    )


# --- enrichment ---------------------------------------------------------------------------------


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup_join(readings_table(spark, sf_dir), regions(spark, sf_dir))


def lookup_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoneless(_enriched(spark, sf_dir)).select(
        "device_id", "type_id", "event_time", "type_name"
    )


def lookup_join_frequent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join as with a dimension that is too large to broadcast: frequent ids are spread."""
    readings = readings_table(spark, sf_dir)
    large = replace(DEFAULTS, broadcast_max_rows=0, frequent_ids=10)
    named = lookup_join(readings, regions(spark, sf_dir), large, frequent_ids(readings, large))
    return _zoneless(named).select("device_id", "type_id", "event_time", "type_name")


def coalesce_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _enriched(spark, sf_dir).groupBy("type_id", "type_name").agg(F.count("*").alias("n_events"))
    )


def enrich_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoneless(_enriched(spark, sf_dir)).select(
        "device_id", "type_id", "temperature", "humidity", "event_time", "type_name"
    )


def dimension_insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regions as a seeded table, to which the nations are added."""
    table, path = f"device_types_{uuid4().hex}", scratch_path(spark, "dimension")
    ensure(spark, table, path)
    try:
        seed(spark, regions(spark, sf_dir), table)
        seed(spark, nations(spark, sf_dir), table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # the files stay
    return spark.read.schema(DEVICE_TYPES).parquet(path)


# --- windows ------------------------------------------------------------------------------------


def tumbling_window_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoneless(
        readings_table(spark, sf_dir)
        .groupBy(F.window("event_time", DEFAULTS.window).alias("w"))
        .agg(F.count("*").alias("n_events"))
        .select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n_events"
        )
    )


def _summary(spark: SparkSession, sf_dir: str, settings: Settings) -> DataFrame:
    return batch_summary(readings_table(spark, sf_dir), regions(spark, sf_dir), settings)


def _summary_query(settings: Settings) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _zoneless(_summary(spark, sf_dir, settings))

    return query


def window_avg_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoneless(mean_temperatures(readings_table(spark, sf_dir), HOUR))


def window_median_humidity(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = _zoneless(_summary(spark, sf_dir, HOUR))
    return summary.select("window_start", "type_id", "median_humidity")


def window_latest_type_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoneless(latest_names(_enriched(spark, sf_dir), HOUR))


def sql_window_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoneless(
        sql_summary(readings_table(spark, sf_dir), regions(spark, sf_dir), HOUR)
    )


# --- published records --------------------------------------------------------------------------


def json_sink_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = _summary(spark, sf_dir, HOUR)
    return _zoneless(summary.select("window_start", "type_id", encode_result().alias("value")))


def result_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "published")
    readings = readings_table(spark, sf_dir)
    write_batch_summary(readings, regions(spark, sf_dir), "text", HOUR, path=path)
    return results(spark, "text", path=path)


# --- streams ------------------------------------------------------------------------------------


def _published(spark: SparkSession, path: str) -> DataFrame:
    return _zoneless(spark.read.parquet(path).drop("batch_id"))


ARRIVALS = 6


def _arriving(spark: SparkSession, sf_dir: str, work: str) -> DataFrame | None:
    """A stream of the events in ``ARRIVALS`` files in order of time, but up to four seconds out of order
    at their ends, one file per micro-batch; None without events."""
    readings = readings_table(spark, sf_dir)
    span = readings.agg(
        F.min(F.unix_seconds("event_time")).alias("low"), F.max(F.unix_seconds("event_time")).alias("high")
    ).first()
    if span["low"] is None:
        return None
    # As many seconds late as the device's number says.
    late = F.pmod(F.xxhash64("device_id"), F.lit(5))
    part = (F.unix_seconds("event_time") + late - F.lit(span["low"])) * F.lit(ARRIVALS)
    number = F.call_function("div", part, F.lit(span["high"] - span["low"] + 5)).cast("int")
    arriving = readings.select(encode_reading().alias("value"), number.alias("arrival"))
    # One task and file per arrival: the source takes whole files.
    arriving.repartition(F.col("arrival")).write.partitionBy("arrival").text(f"{work}/in")
    shown = spark.read.text(f"{work}/in").select("arrival").distinct().collect()
    set_times(spark, [f"{work}/in/arrival={row[0]}" for row in sorted(shown)])
    stream = messages_stream(
        spark,
        "text",
        path=f"{work}/in/arrival=*",
        recursiveFileLookup="true",
        maxFilesPerTrigger="1",
    )
    return decode(stream)


def stream_window_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of the arriving events, in as many micro-batches of one query."""
    work = scratch_path(spark, "stream")
    stream = _arriving(spark, sf_dir, work)
    if stream is not None:
        run_available(
            streaming_cells(stream, regions(spark, sf_dir)),
            f"{work}/checkpoint",
            "parquet",
            path=f"{work}/out",
        )
    return _finished(spark, work)


def stream_window_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same summary by a function over all rows of each window, closed at its last millisecond."""
    work, schema = scratch_path(spark, "windows"), StructType.fromDDL(windows.SUMMARY)
    stream = _arriving(spark, sf_dir, work)
    if stream is not None:
        named = lookup_join(stream, regions(spark, sf_dir))
        rows = window_rows(named, windows.summary, schema)
        query = start_rows(rows, f"{work}/out", f"{work}/checkpoint", availableNow=True)
        query.awaitTermination()
        for folder in ("in", "checkpoint"):
            remove(spark, f"{work}/{folder}")
    published = spark.read.schema(schema).parquet(f"{work}/out") if stream is not None else spark.createDataFrame([], schema)
    end = F.col("window_start") + F.expr("INTERVAL 1 MINUTE")
    return _zoneless(published.withColumn("window_end", end))


def _finished(spark: SparkSession, work: str) -> DataFrame:
    """What a finished stream published; its input and checkpoint go."""
    for folder in ("in", "checkpoint"):
        remove(spark, f"{work}/{folder}")
    return _published(spark, f"{work}/out")


def _replay(
    spark: SparkSession,
    readings: DataFrame,
    arrivals: int,
    dimension: Callable[[int], DataFrame],
    settings: Settings,
) -> DataFrame:
    """Stream ``readings`` as JSON messages, those with ``arrival`` 0 first, then 1, and so on.

    The messages are written in one pass. Each run of the query, all on one checkpoint, is shown
    one more arrival than the run before.
    """
    work = scratch_path(spark, "replay")
    messages = readings.select(encode_reading().alias("value"), "arrival")
    messages.write.partitionBy("arrival").text(f"{work}/in")
    for arrival in range(arrivals):
        shown = ",".join(str(number) for number in range(arrival + 1))
        stream = messages_stream(
            spark, "text", path=f"{work}/in/arrival={{{shown}}}", recursiveFileLookup="true"
        )
        run_available(
            streaming_cells(decode(stream), dimension(arrival), settings),
            f"{work}/checkpoint",
            "parquet",
            settings,
            path=f"{work}/out",
        )
    return _finished(spark, work)


def _in_order(spark: SparkSession, readings: DataFrame, work: str) -> DataFrame:
    """A stream of ``readings`` as JSON messages, one micro-batch for each value of ``arrival``."""
    messages = readings.select(encode_reading().alias("value"), "arrival")
    messages.repartition(F.col("arrival")).write.partitionBy("arrival").text(f"{work}/in")
    shown = spark.read.text(f"{work}/in").select("arrival").distinct().collect()
    set_times(spark, [f"{work}/in/arrival={row[0]}" for row in sorted(shown)])
    stream = messages_stream(
        spark, "text", path=f"{work}/in/arrival=*", recursiveFileLookup="true", maxFilesPerTrigger="1"
    )
    return decode(stream)


def _readings_arriving(spark: SparkSession, sf_dir: str, arrival: Column) -> DataFrame:
    return sensor_table(events_table(spark, sf_dir).withColumn("arrival", arrival), "arrival")


def stream_late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten days of events per arrival, but errors come one arrival late."""
    part = F.floor((F.least(F.dayofmonth("ts"), F.lit(30)) - 1) / 10).cast("int")
    arrival = part + F.when(F.col("event_type") == "error", 1).otherwise(0)
    readings = _readings_arriving(spark, sf_dir, arrival)
    return _replay(spark, readings, 4, lambda _: regions(spark, sf_dir), HOUR)


def stream_lookup_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Between the two arrivals, in the middle of a day's window, every name changes."""
    change = F.lit("2024-01-16 12:00:00").cast("timestamp_ntz")
    arrival = F.when(F.col("ts") < change, 0).otherwise(1)
    readings = _readings_arriving(spark, sf_dir, arrival)
    versions = [regions(spark, sf_dir), nations(spark, sf_dir)]
    return _replay(spark, readings, 2, lambda number: versions[number], DAY)


def stream_lookup_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same change of names while one query runs: after its first micro-batch they are published
    as a new version, which the second one joins."""
    change = F.lit("2024-01-16 12:00:00").cast("timestamp_ntz")
    readings = _readings_arriving(spark, sf_dir, F.when(F.col("ts") < change, 0).otherwise(1))
    work = scratch_path(spark, "live")
    if not readings.isEmpty():
        publish_version(regions(spark, sf_dir), f"{work}/names")

        def write(summary: DataFrame, batch_id: int) -> None:
            write_results(summary, "parquet", batch_id, path=f"{work}/out")

        def rename(batch_id: int) -> None:
            if batch_id == 0:
                publish_version(nations(spark, sf_dir), f"{work}/names")

        cells = streaming_cells(_in_order(spark, readings, work), newest_version(spark, f"{work}/names"), DAY)
        start(cells, write, f"{work}/checkpoint", DAY, rename, availableNow=True).awaitTermination()
    return _finished(spark, work)


def stream_lookup_cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of the arriving events with names asked for one by one, behind the workers' caches."""
    work = scratch_path(spark, "cached")
    stream = _arriving(spark, sf_dir, work)
    if stream is not None:
        publish_version(regions(spark, sf_dir), f"{work}/names")
        named = cached_lookup(stream, version_names(f"{work}/names"))
        named = named.withWatermark("event_time", DEFAULTS.watermark)
        cells = reading_cells(named, DEFAULTS.window, seen_at=F.current_timestamp())
        run_available(cells, f"{work}/checkpoint", "parquet", path=f"{work}/out")
    return _finished(spark, work)


def stream_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published records followed as a stream, in two runs on one checkpoint: one before the second
    half is published, and one after."""
    work, readings = scratch_path(spark, "followed"), readings_table(spark, sf_dir)
    odd = F.hour("event_time") % 2 == 1
    for run, half in enumerate((readings.where(odd), readings.where(~odd))):
        write_batch_summary(half.repartition(3), regions(spark, sf_dir), "text", HOUR, path=f"{work}/published/{run}")
        records = results_stream(
            spark, "text", path=f"{work}/published", recursiveFileLookup="true", maxFilesPerTrigger="2"
        )

        def write(rows: DataFrame, batch_id: int) -> None:
            rows.write.mode("overwrite").parquet(f"{work}/out/batch_id={batch_id}")

        follow_results(records, write, f"{work}/checkpoint", availableNow=True).awaitTermination()
    return _published(spark, f"{work}/out")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "json_event_decode": json_event_decode,
    "iso_timestamp_parse": iso_timestamp_parse,
    "timestamp_to_epoch_ms": timestamp_to_epoch_ms,
    "epoch_ms_to_timestamp": epoch_ms_to_timestamp,
    "round_half_even_2": round_half_even,
    "window_time_label": window_time_label,
    "lookup_join": lookup_join_query,
    "lookup_join_frequent": lookup_join_frequent,
    "coalesce_unknown": coalesce_unknown,
    "enrich_project": enrich_project,
    "dimension_insert_ignore": dimension_insert_ignore,
    "tumbling_window_assign": tumbling_window_assign,
    "window_avg_temperature": window_avg_temperature,
    "window_median_humidity": window_median_humidity,
    "window_latest_type_name": window_latest_type_name,
    "window_sensor_summary_minute": _summary_query(DEFAULTS),
    "window_sensor_summary_hour": _summary_query(HOUR),
    "window_sensor_summary_day": _summary_query(DAY),
    # Most groups count as large here, so their medians are sought between the bounds of a sketch.
    "window_sensor_summary_bounded": _summary_query(replace(DAY, group_cells_per_task=20)),
    "sql_window_summary": sql_window_summary,
    "json_sink_encode": json_sink_encode,
    "result_readback": result_readback,
    "stream_window_agg": stream_window_agg,
    "stream_window_function": stream_window_function,
    "stream_late_drop": stream_late_drop,
    "stream_lookup_refresh": stream_lookup_refresh,
    "stream_lookup_live": stream_lookup_live,
    "stream_lookup_cached": stream_lookup_cached,
    "stream_readback": stream_readback,
}
