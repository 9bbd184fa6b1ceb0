"""Names that change while a query runs, cached lookups, and results followed as a stream."""

from __future__ import annotations

import json
import sys
from dataclasses import replace

import pytest
from pyspark import cloudpickle

from gaugeworks import Settings
from gaugeworks.functions import decode, encode_reading
from gaugeworks.operators.lookup_cache import LookupCache, cached_lookup
from gaugeworks.sources import follow_results, newest_version, publish_version, results_stream, version_names
from gaugeworks.storage import set_times
from gaugeworks.sources import messages_stream, write_results
from gaugeworks.streaming import start, streaming_cells
from helpers import JOB_FAILED, collected, dimension, expected, readings

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers do not see tests


def test_newest_complete_version_is_read(spark, tmp_path):
    path = str(tmp_path / "names")
    with pytest.raises(JOB_FAILED):
        newest_version(spark, path).collect()
    assert publish_version(dimension(spark, {1: "a"}), path) == 1
    table = newest_version(spark, path)
    assert [tuple(r) for r in table.collect()] == [(1, "a")]
    assert publish_version(dimension(spark, {1: "b", 2: "c"}).repartition(2), path) == 2
    assert sorted(tuple(r) for r in table.collect()) == [(1, "b"), (2, "c")]
    # One that is still being written does not count.
    dimension(spark, {1: "d"}).write.parquet(f"{path}/version=3")
    (tmp_path / "names" / "version=3" / "_SUCCESS").unlink()
    assert sorted(r.type_name for r in newest_version(spark, f"file:{path}").collect()) == ["b", "c"]
    publish_version(dimension(spark, {}), path)
    assert newest_version(spark, path).collect() == [] and newest_version(spark, path).columns == ["id", "type_name"]
    assert version_names(path)([1, 2]) == {}


def test_names_change_between_batches_of_one_query(spark, tmp_path):
    names, parts = str(tmp_path / "names"), [[(1, 1, 20, 50), (9, 2, 1, 1)], [(1, 30, 22, 60), (2, 31, 3, 3)], [(3, 600, 0, 0)]]
    for n, rows in enumerate(parts):
        readings(spark, rows).coalesce(1).select(encode_reading().alias("value")).write.text(str(tmp_path / "in" / str(n)))
    set_times(spark, [str(tmp_path / "in" / str(n)) for n in range(3)])
    publish_version(dimension(spark, {1: "old", 9: "nine"}), names)
    later = {0: {1: "new", 9: "gone"}, 1: {1: "too late", 2: "too late"}}
    done = []

    def after(batch):
        done.append(batch)
        if batch in later:
            publish_version(dimension(spark, later[batch]), names)

    stream = messages_stream(spark, "text", path=str(tmp_path / "in"), recursiveFileLookup="true", maxFilesPerTrigger="1")
    query = start(
        streaming_cells(decode(stream), newest_version(spark, names)),
        lambda summary, batch: write_results(summary, "parquet", batch, path=str(tmp_path / "out")),
        str(tmp_path / "checkpoint"),
        after=after,
        availableNow=True,
    )
    query.awaitTermination()
    assert done[:3] == [0, 1, 2]
    assert collected(spark.read.parquet(str(tmp_path / "out"))) == expected(parts[0] + parts[1], {1: "new", 9: "nine"})


class Clock:
    now = 0.0

    def __call__(self):
        return self.now


def test_each_id_has_its_own_age():
    clock, asked = Clock(), []

    def fetch(ids):
        asked.append(list(ids))
        return {i: f"{i}@{clock.now:.0f}" for i in ids if i != 5}

    cache = LookupCache(fetch, 100, 600, clock)
    assert cache.names([1, 1, 5]) == {1: "1@0", 5: None} and asked == [[1, 5]]
    clock.now = 300
    assert cache.names([1, 2, 5]) == {1: "1@0", 2: "2@300", 5: None} and asked[1:] == [[2]]
    clock.now = 599.9
    assert cache.names([1, 2]) == {1: "1@0", 2: "2@300"} and len(asked) == 2
    clock.now = 600  # being used does not make a name younger
    assert cache.names([1, 2]) == {1: "1@600", 2: "2@300"} and asked[2:] == [[1]]
    clock.now = 900
    assert cache.names([1, 2]) == {1: "1@600", 2: "2@900"}


def test_rows_are_bounded_and_the_least_recent_go():
    asked = []

    def fetch(ids):
        asked.extend(ids)
        return dict.fromkeys(ids, "x")

    cache = LookupCache(fetch, 100, 600, Clock())
    assert len(cache.names(range(250))) == 250 and len(cache.held) == 100
    del asked[:]
    cache.names([150])  # the oldest that is kept becomes the latest
    cache.names([1000])
    cache.names([150, 152])
    assert asked == [1000] and 151 not in cache.held
    cache.names([151])
    assert asked == [1000, 151] and len(cache.held) == 100


def test_lookup_asks_once_per_id_and_worker(spark, tmp_path):
    log = str(tmp_path / "asked")

    def fetch(ids):
        with open(log, "a") as out:
            out.write(json.dumps(ids) + "\n")
        return {i: f"name {i}" for i in ids if i != 2}

    rows = readings(spark, [(n % 3 + 1, n % 60, 1, n) for n in range(300)]).coalesce(1)
    named = cached_lookup(rows, fetch)
    for _ in range(2):
        found = named.collect()
        assert len(found) == 300 and named.columns == [*rows.columns, "type_name"]
        assert {(r.type_id, r.type_name) for r in found} == {(1, "name 1"), (2, "Unknown"), (3, "name 3")}
    asked = [i for line in open(log) for i in json.loads(line)]
    workers = 4  # at most, in local[4]
    assert 3 <= len(asked) <= 3 * workers
    assert cached_lookup(rows.limit(0), fetch).collect() == []


def test_old_names_are_asked_for_again(spark, tmp_path):
    path = str(tmp_path / "names")
    publish_version(dimension(spark, {1: "a"}), path)
    rows = readings(spark, [(1, 1, 1, 1)])
    always = cached_lookup(rows, version_names(path), replace(Settings(), dimension_ttl_seconds=0))
    assert [r.type_name for r in always.collect()] == ["a"]
    publish_version(dimension(spark, {1: "b"}), path)
    assert [r.type_name for r in always.collect()] == ["b"]


def test_null_ids_get_the_fallback(spark):
    frame = spark.createDataFrame([(1, "x"), (None, "y")], "type_id int, other string")
    got = cached_lookup(frame, lambda ids: {1: "one"}).collect()
    assert sorted((r.other, r.type_name) for r in got) == [("x", "one"), ("y", "Unknown")]


def test_following_repeats_nothing_after_a_restart(spark, tmp_path):
    records = ['{"window_time":"14:%02d","type_name":"T%d","avg_temperature":1.5,"median_humidity":2.5}' % (n % 60, n) for n in range(90)]
    seen = []

    def run():
        def write(rows, batch):
            seen.extend(r.type_name for r in rows.collect())

        stream = results_stream(spark, "text", path=str(tmp_path / "in"), recursiveFileLookup="true", maxFilesPerTrigger="1")
        follow_results(stream, write, str(tmp_path / "checkpoint"), availableNow=True).awaitTermination()

    for n in range(3):
        part = spark.createDataFrame([(r,) for r in records[30 * n : 30 * n + 30]], "value string")
        part.repartition(2).write.text(str(tmp_path / "in" / str(n)))
        run()
    run()
    assert sorted(seen) == sorted(f"T{n}" for n in range(90))


def test_following_stops_at_a_broken_record(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"window_time":"14:23"}\nnot a record\n')
    stream = results_stream(spark, "text", path=str(tmp_path / "in"))
    query = follow_results(stream, lambda rows, batch: rows.collect(), str(tmp_path / "checkpoint"), availableNow=True)
    with pytest.raises(JOB_FAILED):
        query.awaitTermination()
