"""A table kept as numbered versions, of which every scan sees the newest.

A running query lists the files of an ordinary Parquet table only once. This source lists them whenever
it is scanned, so each micro-batch of a stream joins the names that were published last, without a
restart. A version is a folder ``version=<n>`` written by Spark; it counts once it is complete.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader

# Workers need not have this package: the source is sent along.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "newest_version"
DONE = "_SUCCESS"


def newest_files(path: str) -> tuple[Any, list[str]]:
    """The file system of ``path``, and the Parquet files of its newest complete version."""
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
    numbered = sorted(
        ((int(m[1]), info.path) for info in found if (m := re.fullmatch(r"version=(\d+)", info.base_name))), reverse=True
    )
    for _, folder in numbered:
        names = {info.base_name: info.path for info in system.get_file_info(fs.FileSelector(folder))}
        if DONE in names:
            return system, sorted(p for n, p in names.items() if n.endswith(".parquet"))
    raise FileNotFoundError(f"no complete version in {path}")


class _Reader(DataSourceReader):
    """One task, which looks for the newest version itself: a plan's partitions are made only once. So a
    scan is of one version, and for names rather than for large tables."""

    def __init__(self, path: str):
        self.path = path

    def read(self, partition) -> Iterator[Any]:
        import pyarrow.parquet as pq

        system, files = newest_files(self.path)
        for file in files:
            with system.open_input_file(file) as source:
                yield from pq.ParquetFile(source).iter_batches(columns=["id", "type_name"])


class NewestVersion(DataSource):
    """``id``, ``type_name`` of the newest version at ``path``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "id int, type_name string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])


def _versions(spark: SparkSession, path: str) -> list[int]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(int(m[1]) for name in names if (m := re.fullmatch(r"version=(\d+)", name)))


def publish_version(dimension: DataFrame, path: str) -> int:
    """Write ``dimension`` as the next version of the table at ``path``, and return its number. Scans that
    have begun keep to the version they found; there is one writer at a time."""
    number = max(_versions(dimension.sparkSession, path), default=0) + 1
    rows = dimension.selectExpr("cast(id AS int) AS id", "cast(type_name AS string) AS type_name")
    rows.write.parquet(f"{path}/version={number}")
    return number


def newest_version(spark: SparkSession, path: str) -> DataFrame:
    """``id``, ``type_name`` as last published, seen anew by every scan."""
    spark.dataSource.register(NewestVersion)
    return spark.read.format(FORMAT).option("path", path).load()


def version_names(path: str) -> Callable[[list[int]], dict[int, str]]:
    """A function that looks ids up in the newest version at ``path``, for ``cached_lookup``."""

    def fetch(ids: list[int]) -> dict[int, str]:
        import pyarrow.parquet as pq

        system, files = newest_files(path)
        found: dict[int, str] = {}
        for file in files:
            rows = pq.read_table(file, columns=["id", "type_name"], filters=[("id", "in", ids)], filesystem=system)
            found.update(zip(rows["id"].to_pylist(), rows["type_name"].to_pylist(), strict=True))
        return found

    return fetch
