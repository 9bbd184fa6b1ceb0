"""JSON in and out."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from gaugeworks.functions.times import epoch_ms, from_epoch_ms, iso_text, parse_iso
from gaugeworks.schema import MESSAGE, RESULT_COLUMNS


def required(column: Column, *others: Column, never: object) -> Column:
    """``column``, failing the job on a row where it or any of ``others`` is null.

    The column has to be one that is used in any case; an unused one is pruned, and the check with
    it. ``never`` is a value of the column's type that is not reached: it marks the column as not
    null. ``window()`` would otherwise add a null filter on its event time, which is pushed below
    the projection and evaluates the whole decoding a second time for every row.
    """
    complete = column.isNotNull()
    for field in others:
        complete = complete & field.isNotNull()
    failure = F.raise_error(F.lit("reading with a missing or unusable field"))
    return F.coalesce(F.when(complete, column), failure, F.lit(never))


EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def parse_whole(value: Column, schema: StructType) -> Column:
    """``value`` as a struct of ``message``, in the given schema, and ``whole``, true if the text ends
    there. Malformed and mistyped text fails the job. See ``is_single`` as well.

    The parser stops after the first value of a text, so by itself it would pass over anything that
    follows, even a second message. Inside another object that is a syntax error, or leaves out the
    closing mark, or else it goes on as members of that object.
    """
    enclosed = F.concat(F.lit('{"message":'), value.cast("string"), F.lit(',"whole":true}'))
    both = StructType([StructField("message", schema), StructField("whole", BooleanType())])
    return F.from_json(enclosed, both, {"mode": "FAILFAST", "allowSingleQuotes": "false"})


def is_single(value: Column) -> Column:
    """Whether the text is one element of an array. What is legal after a member of an object, and so
    gets through ``parse_whole``, is not legal after an element of an array; and what would be a
    second element is not legal in an object. Together they leave nothing over.

    A text that begins with a brace and has its only closing one at its end is one object or malformed, so
    ordinary messages need no such count. The function that counts elements knows no bare NaN or Infinity,
    so they are replaced by a digit; inside a string this does no harm, as only elements are counted.
    """
    text = value.cast("string")
    plain = F.regexp_replace(text, r"-?\b(NaN|Infinity)\b", "0")
    counted = F.json_array_length(F.concat(F.lit("["), plain, F.lit("]"))) == 1
    closed = F.instr(text, "}") == F.char_length(text)
    return F.when(F.startswith(text, F.lit("{")) & closed, F.lit(True)).otherwise(counted)


def decode(messages: DataFrame, value: str = "value") -> DataFrame:
    """Message text to readings, strictly: anything malformed, mistyped or missing fails the job."""
    parsed = messages.select(
        parse_whole(F.col(value), MESSAGE).alias("m"), is_single(F.col(value)).alias("single")
    )
    readings = parsed.select(
        "m.message.device_id",
        "m.message.type_id",
        "m.message.temperature",
        "m.message.humidity",
        from_epoch_ms(epoch_ms(parse_iso(F.col("m.message.event_time")))).alias("event_time"),
        F.when(F.col("single"), F.col("m.whole")).alias("whole"),
    )
    # A projection of its own, so that the time is parsed once although it is used twice here.
    others = [F.col(name) for name in readings.columns if name != "event_time"]
    event_time = required(F.col("event_time"), *others, never=EPOCH)
    return readings.withColumn("event_time", event_time).drop("whole")


def encode_reading() -> Column:
    """A reading as a message value."""
    return F.to_json(
        F.struct(
            "device_id",
            "type_id",
            iso_text(F.col("event_time")).alias("event_time"),
            "temperature",
            "humidity",
        )
    )


def encode_result() -> Column:
    """A published record as a message value, fields in their published order."""
    return F.to_json(F.struct(*RESULT_COLUMNS))
