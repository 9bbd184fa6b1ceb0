"""Lookup by a function, row by row as rows are processed, with a cache in front of it.

For a dimension that is asked rather than read: a database behind a driver, a service. Every Python
worker keeps a cache of its own, bounded in rows and with an age for each id by itself, so no shuffle is
needed and a frequent id costs one request per worker and time to live.
"""

from __future__ import annotations

import sys
import time
import types
import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from gaugeworks.settings import DEFAULTS, Settings

# Workers need not have this package: what they run of this module is sent along.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Gets different ids and returns the names of those it knows.
Fetch = Callable[[list[int]], dict[int, str]]

#: Where a worker's caches outlast its tasks.
_HOME = "_lookup_caches_of_this_worker"


class LookupCache:
    """Names by id, each for ``ttl`` seconds after it was fetched; ids without a name are kept too. Beyond
    ``max_rows`` the ids that were not asked for longest go."""

    def __init__(self, fetch: Fetch, max_rows: int, ttl: float, clock: Callable[[], float] = time.monotonic):
        self.fetch, self.max_rows, self.ttl, self.clock = fetch, max_rows, ttl, clock
        self.held: OrderedDict[int, tuple[str | None, float]] = OrderedDict()

    def names(self, ids: Iterable[int]) -> dict[int, str | None]:
        """The names of all ``ids``, which may be more than are kept."""
        now, found, missing = self.clock(), {}, []
        for key in dict.fromkeys(ids):
            name, since = self.held.get(key, (None, None))
            if since is not None and now - since < self.ttl:
                found[key] = name
                self.held.move_to_end(key)
            else:
                missing.append(key)
        if missing:
            fetched = self.fetch(missing)
            for key in missing:
                found[key] = fetched.get(key)
                self.held.pop(key, None)
                self.held[key] = (found[key], now)
            while len(self.held) > self.max_rows:
                self.held.popitem(last=False)
        return found


def worker_cache(token: str, make: Callable[[], LookupCache]) -> LookupCache:
    """This process's cache for one plan, made at its first use."""
    home = sys.modules.setdefault(_HOME, types.ModuleType(_HOME))
    caches = home.__dict__.setdefault("caches", OrderedDict())
    if token not in caches:
        caches[token] = make()
        while len(caches) > 8:  # of plans that have ended
            caches.popitem(last=False)
    caches.move_to_end(token)
    return caches[token]


def cached_lookup(readings: DataFrame, fetch: Fetch, settings: Settings = DEFAULTS) -> DataFrame:
    """``readings``, streaming or not, with ``type_name`` as ``fetch`` gives it when they are processed, or
    up to ``dimension_ttl_seconds`` before; ids it does not know, and null ids, get the fallback name.

    A stream's watermark is lost on the way, so it has to be put on the result.
    """
    token, fallback = uuid.uuid4().hex, settings.fallback_name
    max_rows, ttl = settings.lookup_cache_rows, settings.dimension_ttl_seconds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        cache = worker_cache(token, lambda: LookupCache(fetch, max_rows, ttl))
        for batch in batches:
            coded = batch.column(batch.schema.get_field_index("type_id")).dictionary_encode()
            ids = coded.dictionary.to_pylist()
            known = cache.names(key for key in ids if key is not None)
            names = pa.array([known.get(key) for key in ids], pa.string()).take(coded.indices)
            column = pc.fill_null(names, fallback)
            yield batch.append_column("type_name", column)

    return readings.mapInArrow(run, StructType([*readings.schema, StructField("type_name", StringType())]))
