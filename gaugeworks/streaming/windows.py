"""Any function over all rows of a closed window, in a stream.

For what no aggregate expresses. The rows of a window are kept in state, in RocksDB, in the order in
which they came, and handed over one by one when the window closes, with its key and start; the
function yields any number of rows. This runs Python workers, and all rows of one window and key
meet in one task; the summary of ``streaming_cells`` does neither.

A window closes when the watermark reaches its last millisecond, so a row at 14:24:04.999 closes the
minute 14:23 if the watermark stays five seconds behind. Rows that come later are dropped.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from datetime import datetime, timedelta, timezone
from statistics import median
from typing import Any

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from gaugeworks.settings import DEFAULTS, Settings
from gaugeworks.streaming.runner import query_session

# Workers need not have this package: what they run of this module is sent along.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ARRIVAL = "__arrival"

#: Gets the key, the window's start in UTC, and its rows; yields the values of rows.
WindowFunction = Callable[[Any, datetime, Iterator[Row]], Iterable[tuple]]


class _Windows(StatefulProcessor):
    """State by key and window: the window's rows and a timer for its end."""

    def __init__(self, function: WindowFunction, names: list[str], kept: StructType):
        self.function, self.names, self.kept = function, names, kept

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.kept)

    def handleInputRows(self, key, rows, timerValues):
        came = sorted(rows, key=lambda row: row[ARRIVAL])
        last = came[0]["__end"] - 1
        if timerValues.getCurrentWatermarkInMs() >= last:
            return iter(())  # the window is closed
        columns = self.kept.fieldNames()
        self.rows.appendList([tuple(row[name] for name in columns) for row in came])
        self.handle.registerTimer(last)  # fires when the watermark reaches it
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        columns = self.kept.fieldNames()
        start = datetime.fromtimestamp(0, timezone.utc) + timedelta(milliseconds=key[1])
        rows = (Row(**dict(zip(columns, values, strict=True))) for values in self.rows.get())
        for found in self.function(key[0], start, rows):
            yield Row(**dict(zip(self.names, found, strict=True)))
        self.rows.clear()

    def close(self) -> None:
        pass


def _numbered(readings: DataFrame) -> DataFrame:
    """The rows with a number that ascends with the source's partition and the place in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            own = pa.array(range(first, first + batch.num_rows), pa.int64())
            yield batch.append_column(ARRIVAL, own)
            first += batch.num_rows

    return readings.mapInArrow(run, StructType([*readings.schema, StructField(ARRIVAL, LongType())]))


def window_rows(
    readings: DataFrame,
    function: WindowFunction,
    schema: StructType,
    settings: Settings = DEFAULTS,
    key: str = "type_id",
) -> DataFrame:
    """What ``function`` yields, in the columns of ``schema``, for every key and closed window of the
    stream ``readings`` (``event_time``, the key, and any other columns, all of which the function sees).

    The rows of a window come in the order of the micro-batches, and within one in that of the
    source: by its partitions, then by place. So the last one is the last that arrived.
    """
    others = [name for name in readings.columns if name != key]
    marked = _numbered(readings).withWatermark("event_time", settings.watermark)
    # The watermark is on the window from here on: a row is too late when its window is closed, not
    # when others are ahead of it.
    plain = F.timestamp_micros(F.unix_micros("event_time")).alias("event_time")
    window = F.window("event_time", settings.window)
    rows = marked.select(
        F.col(key),
        window.alias("__window"),
        *[plain if name == "event_time" else F.col(name) for name in others],
        ARRIVAL,
    ).withColumns(
        {"__start": F.unix_millis("__window.start"), "__end": F.unix_millis("__window.end")}
    )
    kept = StructType([rows.schema[name] for name in others])
    processor = _Windows(function, schema.fieldNames(), kept)
    return rows.groupBy(key, "__start").transformWithState(
        processor, outputStructType=schema, outputMode="append", timeMode="EventTime"
    )


def start_rows(
    rows: DataFrame, path: str, checkpoint: str, settings: Settings = DEFAULTS, **trigger: object
) -> StreamingQuery:
    """Start writing the rows of ``window_rows`` as Parquet files, each row once."""
    writer = rows.writeStream.format("parquet").option("path", path).outputMode("append")
    with query_session(rows.sparkSession, settings):
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


SUMMARY = (
    "window_start timestamp, type_id int, n_events long, window_time string, type_name string, "
    "avg_temperature double, median_humidity double"
)


def summary(key: int, start: datetime, rows: Iterator[Row]) -> Iterator[tuple]:
    """The published summary as a window function."""
    import math

    name, temperatures, humidities = None, [], []
    for row in rows:
        name = row.type_name
        temperatures.append(row.temperature)
        humidities.append(row.humidity)
    mean = math.fsum(temperatures) / len(temperatures)
    label = start.strftime("%H:%M")
    yield start, key, len(temperatures), label, name, round(mean, 2), round(median(humidities), 2)
