"""What the operators share: staging, row identity, and texts as seen by Arrow tasks."""

from __future__ import annotations

import gc
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.storage import remove, scratch_path

#: Bytes of text that a Python task looks at together. A longer text is a batch of its own.
BATCH_BYTES = 4 << 20
#: Bytes that Spark sends to a Python task together.
ARROW_BYTES = 16 << 20


class Work:
    """A folder below the shared one for an operator's intermediate tables.

    A table there is written once and read by every later pass, so a lost executor costs only
    the tasks it was running and nothing random or order-dependent is computed twice.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = scratch_path(spark, label)
        self.paths: dict[str, list[str]] = {}

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"
        self.paths.setdefault(name, []).append(path)
        schema = df.schema
        df.write.option("compression", "zstd").parquet(path)
        del df
        release(self.spark)
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables staged under ``names``: everything made from them is staged itself."""
        for name in names:
            for path in self.paths.pop(name, []):
                remove(self.spark, path)


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per Spark application; a cluster need not have it
    installed, nor a local session be started in a certain folder. Rows go to them in batches of
    at most ``ARROW_BYTES``, which bounds their memory where texts are long."""
    context = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    if getattr(context, "_gaugeworks_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(context._temp_dir) / f"{package.name}.zip"  # Spark serves it to executors
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._gaugeworks_shipped = True


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner see that shuffle files of finished jobs are not referenced any more, so
    that disk holds the files of one step and not of all of them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def row_key(*columns: str) -> list[Column]:
    """Two 64-bit hashes that identify a row by the named columns, never null. Rows equal in all
    of them share the key, also if some are null."""
    marks = [F.col(c).isNull() for c in columns]
    given = [F.col(c) for c in columns]
    return [
        F.xxhash64(*marks, *given).alias("_k1"),
        F.xxhash64(F.lit("second"), *given, *marks).alias("_k2"),
    ]


def with_row_key(docs: DataFrame, *columns: str) -> DataFrame:
    """Each row as the struct ``_row``, beside its ``row_key``; so no column can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *row_key(*columns))


def utf8(column: str = "text") -> Column:
    """A text's UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary").alias(column)


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ends = binary_offsets(batch.column(batch.schema.get_field_index(column)))
        begin = 0
        while begin < batch.num_rows:
            end = begin + 1
            while end < batch.num_rows and ends[end + 1] - ends[begin] <= limit:
                end += 1
            yield batch.slice(begin, end - begin)
            begin = end


def binary_offsets(column: pa.Array):
    """Byte offsets of a string or binary column without nulls, relative to its buffer."""
    import numpy as np

    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)
    return offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)


def binary_bytes(column: pa.Array):
    """The concatenated bytes of a string or binary column without nulls, and their offsets."""
    import numpy as np

    offsets = binary_offsets(column)
    data = column.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    whole = np.frombuffer(data, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(starts, lengths):
    """The indexes ``starts[i] .. starts[i] + lengths[i] - 1`` of every i, concatenated."""
    import numpy as np

    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, np.int64) - before, lengths)
