"""Where messages, the dimension and published results are read from.

``kafka`` needs the spark-sql-kafka-0-10 package and ``jdbc`` a driver jar on the session's
classpath; addresses and credentials are passed as options and have no defaults here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeworks.functions.messages import EPOCH, is_single, parse_whole, required
from gaugeworks.schema import DEVICE_TYPES, RESULT

# Where the job's messages and results are kept.
INPUT_TOPIC = "iot-events"
OUTPUT_TOPIC = "iot-aggregated"
DIMENSION_TABLE = "device_types"


def _values(reader, fmt: str, log: dict[str, str], options: dict[str, str]) -> DataFrame:
    """Message values only; ``log`` are the options that apply to the message log."""
    path = options.pop("path", None)
    if fmt == "kafka":
        options = {**log, **options}
    frame = reader.format(fmt).options(**options).load(path)
    return frame.select(F.col("value").cast("string").alias("value"))


def messages_stream(spark: SparkSession, fmt: str, **options: str) -> DataFrame:
    """Unbounded message values. A first start on ``kafka`` begins at the newest message."""
    log = {"subscribe": INPUT_TOPIC, "startingOffsets": "latest"}
    return _values(spark.readStream, fmt, log, options)


def messages(spark: SparkSession, fmt: str, **options: str) -> DataFrame:
    """The same values, bounded."""
    return _values(spark.read, fmt, {"subscribe": INPUT_TOPIC}, options)


def dimension(spark: SparkSession, fmt: str, **options: str) -> DataFrame:
    """``id``, ``type_name`` from ``jdbc``, ``table`` (a catalog name) or a file format."""
    if fmt == "table":
        frame = spark.table(options.get("name", DIMENSION_TABLE))
    else:
        reader = spark.read.format(fmt)
        if fmt == "jdbc":
            reader = reader.option("dbtable", DIMENSION_TABLE)
        else:
            reader = reader.schema(DEVICE_TYPES)
        path = options.pop("path", None)
        frame = reader.options(**options).load(path)
    return frame.select(
        F.col("id").cast("int").alias("id"), F.col("type_name").cast("string").alias("type_name")
    )


def sensor_table(events: DataFrame, *keep: str) -> DataFrame:
    """The ``events`` test table (or a stream of it) as readings, with the ``keep`` columns added.

    Its ``ts`` has no zone and is taken as UTC, so the session zone has to be UTC.
    """
    type_id = (F.col("user_id") % 7).cast("int")
    humidity = F.get_json_object("props", "$.k").cast("double")
    event_time = F.col("ts").cast("timestamp")
    return events.select(
        F.concat(F.lit("device_"), F.col("user_id").cast("string")).alias("device_id"),
        type_id.alias("type_id"),
        F.col("value").alias("temperature"),
        humidity.alias("humidity"),
        event_time.alias("event_time"),
        *keep,
    ).withColumn(
        "event_time",
        required(
            F.col("event_time"),
            *[F.col(name) for name in ("type_id", "temperature", "humidity")],
            never=EPOCH,
        ),
    )


def decode_results(values: DataFrame) -> DataFrame:
    """Published message values as records, with the viewer's defaults for missing fields."""
    parsed = values.select(
        parse_whole(F.col("value"), RESULT).alias("m"), is_single(F.col("value")).alias("single")
    )
    usable = F.col("m.whole") & F.col("single") & F.col("m.message").isNotNull()
    failure = F.raise_error(F.lit("published value that is not one record"))
    record = parsed.select(F.coalesce(F.when(usable, F.col("m.message")), failure).alias("r"))
    return record.select(
        F.coalesce("r.window_time", F.lit("?")).alias("window_time"),
        F.coalesce("r.type_name", F.lit("?")).alias("type_name"),
        F.coalesce("r.avg_temperature", F.lit(0.0)).alias("avg_temperature"),
        F.coalesce("r.median_humidity", F.lit(0.0)).alias("median_humidity"),
    )


def results(spark: SparkSession, fmt: str, **options: str) -> DataFrame:
    """Everything published so far, from the earliest record on."""
    log = {"subscribe": OUTPUT_TOPIC, "startingOffsets": "earliest"}
    return decode_results(_values(spark.read, fmt, log, options))


def results_stream(spark: SparkSession, fmt: str, **options: str) -> DataFrame:
    """The same records as an unbounded stream: all published so far, then those to come. What has been
    read is kept by the checkpoint of the query that reads it."""
    log = {"subscribe": OUTPUT_TOPIC, "startingOffsets": "earliest"}
    return decode_results(_values(spark.readStream, fmt, log, options))


def follow_results(
    records: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, **trigger: object
) -> StreamingQuery:
    """Start passing the records of ``results_stream`` to ``write(records, batch_id)``. A restart on the
    same checkpoint goes on behind the last batch that was written."""
    writer = records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()
