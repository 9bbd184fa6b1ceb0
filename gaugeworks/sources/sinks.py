"""Where summaries are written to."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gaugeworks.functions.messages import encode_result
from gaugeworks.schema import RESULT_COLUMNS
from gaugeworks.sources.inputs import OUTPUT_TOPIC


def kafka_options(**options: str) -> dict[str, str]:
    return {"topic": OUTPUT_TOPIC, **options}


def _print_all(records: DataFrame) -> None:
    """Every record, one partition at a time in the driver."""
    print(" | ".join(records.columns), flush=True)
    for record in records.toLocalIterator(prefetchPartitions=True):
        print(" | ".join(str(value) for value in record))


def write_results(
    summary: DataFrame, fmt: str, batch_id: int | None = None, **options: str
) -> None:
    """Write a summary: ``kafka`` and ``text`` as JSON values, ``console`` printed, any other
    format as columns.

    File output of a stream goes to one folder per batch, replaced when the batch is repeated, so
    that a restart leaves no duplicates. Messages may repeat after a restart.
    """
    if fmt == "console":
        _print_all(summary.select(*RESULT_COLUMNS))
        return
    if fmt in ("kafka", "text"):
        summary = summary.select(encode_result().alias("value"))
    if fmt == "kafka":
        summary.write.format(fmt).options(**kafka_options(**options)).save()
        return
    path = options.pop("path").rstrip("/")
    if batch_id is not None:
        path = f"{path}/batch_id={batch_id}"
    mode = "append" if batch_id is None else "overwrite"
    summary.write.format(fmt).options(**options).mode(mode).save(path)
