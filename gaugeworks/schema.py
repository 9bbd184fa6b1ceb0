"""Declared schemas; nothing is inferred."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# JSON message value, as sent by the devices.
MESSAGE = StructType(
    [
        StructField("device_id", StringType()),
        StructField("type_id", IntegerType()),
        StructField("event_time", StringType()),
        StructField("temperature", DoubleType()),
        StructField("humidity", DoubleType()),
    ]
)

# Decoded reading.
READING = StructType(
    [
        StructField("device_id", StringType()),
        StructField("type_id", IntegerType()),
        StructField("temperature", DoubleType()),
        StructField("humidity", DoubleType()),
        StructField("event_time", TimestampType()),
    ]
)

# Dimension: id is the key, type_name is never null.
DEVICE_TYPES = StructType(
    [
        StructField("id", IntegerType(), nullable=False),
        StructField("type_name", StringType(), nullable=False),
    ]
)

# Published record, in its published field order.
RESULT = StructType(
    [
        StructField("window_time", StringType()),
        StructField("type_name", StringType()),
        StructField("avg_temperature", DoubleType()),
        StructField("median_humidity", DoubleType()),
    ]
)
RESULT_COLUMNS = RESULT.fieldNames()
