"""The summary over a stream.

One stateful operator keeps the open windows as cells (see operators/cells.py): state rows are
small and spread by value, however many readings one type has. When the watermark passes a
window's end its cells are emitted once, and ``foreachBatch`` folds them with the batch code.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeworks.operators.cells import reading_cells
from gaugeworks.operators.lookup import lookup_join
from gaugeworks.operators.median import fold_staged
from gaugeworks.plans.batch import publishable
from gaugeworks.settings import DEFAULTS, Settings
from gaugeworks.sources.sinks import write_results
from gaugeworks.storage import remove, scratch_path, staged


def streaming_cells(
    readings: DataFrame, dimension: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Named cells of a reading stream, each emitted once its window is closed.

    The name is looked up as each reading is processed; the last one seen in a window wins.
    """
    named = lookup_join(
        readings.withWatermark("event_time", settings.watermark), dimension, settings
    )
    return reading_cells(named, settings.window, seen_at=F.current_timestamp())


ROW_OVERHEAD = 64


def _query_conf(settings: Settings) -> dict[str, str]:
    return {
        # With a single stateful operator, late rows are judged by the current watermark instead
        # of the previous batch's: a closed window takes no more rows.
        "spark.sql.streaming.statefulOperator.allowMultiple": "false",
        # State beyond the executor heap, saved as changes only.
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # Counting state rows would cost one more read per write.
        "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
        # The dimension is measured at start. Should it outgrow the bound while running, the
        # batch fails, and the restart measures again and joins without broadcasting. Spark
        # compares the size of its hash table: that needs up to ROW_OVERHEAD bytes more a row,
        # and its storage grows by doubling.
        "spark.sql.maxBroadcastTableSize": str(
            2 * (settings.broadcast_max_bytes + ROW_OVERHEAD * settings.broadcast_max_rows)
        ),
    }


@contextmanager
def _session_conf(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """A query copies the session's settings when it starts; put them back afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def query_session(spark: SparkSession, settings: Settings) -> AbstractContextManager[None]:
    """The session's settings as a query of this package needs them when it starts."""
    return _session_conf(spark, _query_conf(settings))


def start(
    cells: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    settings: Settings = DEFAULTS,
    after: Callable[[int], None] | None = None,
    **trigger: object,
) -> StreamingQuery:
    """Start the query; ``write(summary, batch_id)`` receives the summaries of closed windows, and
    ``after(batch_id)`` is called when a micro-batch is done, with or without any."""

    spark = cells.sparkSession

    def fold(closed: DataFrame, batch_id: int) -> None:
        # Read once and whole, to be stored; after that the state is not touched again. The rest
        # runs in the caller's session: a query's own has adaptive execution switched off.
        work = scratch_path(spark, "closed")
        try:
            cells_closed = staged(closed, f"{work}/cells", spark)
            total = cells_closed.count()  # from the files' footers
            if total:
                groups = fold_staged(cells_closed, settings, work, total)
                write(publishable(groups, settings), batch_id)
        finally:
            remove(spark, work)
        if after is not None:
            after(batch_id)

    writer = cells.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    with query_session(spark, settings):
        return writer.foreachBatch(fold).trigger(**trigger).start()


def run_available(
    cells: DataFrame,
    checkpoint: str,
    fmt: str,
    settings: Settings = DEFAULTS,
    **options: str,
) -> None:
    """Process what is there now, then stop. Windows not yet passed by the watermark stay open
    in the checkpoint."""

    def write(summary: DataFrame, batch_id: int) -> None:
        write_results(summary, fmt, batch_id, **options)

    start(cells, write, checkpoint, settings, availableNow=True).awaitTermination()


def run_refreshing(
    readings: Callable[[], DataFrame],
    dimension: Callable[[], DataFrame],
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    settings: Settings = DEFAULTS,
    rounds: int | None = None,
    **trigger: object,
) -> None:
    """Run on, reopening the dimension whenever it reaches its time to live.

    For dimensions kept in files, which a running query lists only once. A database dimension is
    read by every micro-batch and needs no more than ``start``.
    """
    done = 0
    while rounds is None or done < rounds:
        opened = time.monotonic()
        cells = streaming_cells(readings(), dimension(), settings)
        query = start(cells, write, checkpoint, settings, **trigger)
        query.awaitTermination(settings.dimension_ttl_seconds)
        stop_between_batches(query, settings.dimension_ttl_seconds)
        done += 1
        if rounds is None:
            # A query that ends by itself is not started again before the dimension's time is up.
            time.sleep(max(0.0, opened + settings.dimension_ttl_seconds - time.monotonic()))


def stop_between_batches(query: StreamingQuery, patience: float) -> None:
    """Stop ``query`` while it waits for its next trigger, so that no batch is cut off and has to be
    repeated. A query that never waits is stopped after ``patience`` seconds anyway."""
    until = time.monotonic() + patience
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
        time.sleep(0.02)
    query.stop()
