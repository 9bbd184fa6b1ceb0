import math
import random
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gaugeworks import Settings, batch_summary, public_result
from gaugeworks.operators.cells import reading_cells
from gaugeworks.operators.lookup import lookup_join, measure
from gaugeworks.operators.median import fold_cells
from gaugeworks.plans.batch import named_summary, sql_enriched, sql_summary, write_batch_summary
from helpers import JOB_FAILED, collected, dimension, expected, readings

NAMES = {1: "Temperature Sensor", 2: "Humidity Sensor"}
# Bounds so low that every group is range-partitioned and every lookup is salted.
TIGHT = Settings(group_cells_per_task=5, broadcast_max_rows=0, salts=3)


def random_rows(n, seed, digits=2):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        # A third of all rows fall into one type and window, and a third of those are copies.
        if rng.random() < 1 / 3:
            copied = rng.random() < 1 / 3
            humidity = 55.5 if copied else round(rng.uniform(0, 100), digits)
            rows.append((1, 5.0, round(rng.uniform(-20, 45), 2), humidity))
        else:
            rows.append(
                (
                    rng.randint(1, 5),
                    round(rng.uniform(0, 600), 3),
                    round(rng.uniform(-20, 45), 2),
                    round(rng.uniform(0, 100), digits),
                )
            )
    return rows


@pytest.mark.parametrize("limits", [Settings(), TIGHT], ids=["plain", "tight"])
@pytest.mark.parametrize("digits", [0, 2, 12])
def test_summary_equals_brute_force(spark, limits, digits):
    rows = random_rows(3000, seed=digits, digits=digits)
    got = batch_summary(readings(spark, rows), dimension(spark, NAMES), limits)
    assert collected(got) == expected(rows, NAMES)


@pytest.mark.parametrize("limits", [Settings(), TIGHT], ids=["plain", "tight"])
def test_named_and_sql_summaries_agree(spark, limits):
    rows = random_rows(800, seed=11)
    df, dim = readings(spark, rows), dimension(spark, NAMES)
    want = expected(rows, NAMES)
    assert collected(named_summary(lookup_join(df, dim, limits), limits)) == want
    assert collected(sql_summary(df, dim, limits)) == want


def test_order_and_partitioning_do_not_matter(spark):
    rows = random_rows(1500, seed=5)
    dim = dimension(spark, NAMES)
    results = []
    for seed, parts in [(1, 1), (2, 3), (3, 16)]:
        shuffled = rows[:]
        random.Random(seed).shuffle(shuffled)
        df = readings(spark, shuffled).repartition(parts)
        results.append(collected(batch_summary(df, dim)))
    assert results[0] == results[1] == results[2] == expected(rows, NAMES)


@pytest.mark.parametrize(
    ("values", "median"), [([5], 5.0), ([1, 2], 1.5), ([1, 2, 9], 2.0), ([4, 4, 4, 9], 4.0)]
)
@pytest.mark.parametrize("limit", [1, 1000])
def test_small_medians(spark, values, median, limit):
    rows = [(1, 1, 20, v) for v in values]
    cells = reading_cells(readings(spark, rows), "1 minute")
    got = fold_cells(cells, Settings(group_cells_per_task=limit)).first()
    assert (got.n_events, got.median_humidity) == (len(values), median)


@pytest.mark.parametrize("limit", [2, 1000])
def test_median_across_wide_ranges_and_repeats(spark, limit):
    values = [1e300, -1e300, 0.0, 1e-300, 7.0, 7.0, 7.0, math.inf, 3.0, 7.5]
    rows = [(1, 1, 20, v) for v in values]
    cells = reading_cells(readings(spark, rows).repartition(3), "1 minute")
    got = fold_cells(cells, Settings(group_cells_per_task=limit)).first()
    assert got.median_humidity == 7.0


def test_one_group_of_distinct_values_in_many_slices(spark):
    n = 4001
    rows = [(1, 1, 20, i / 7) for i in range(n)]
    random.Random(1).shuffle(rows)
    cells = reading_cells(readings(spark, rows), "1 minute")
    got = fold_cells(cells, Settings(group_cells_per_task=100)).first()
    assert got.median_humidity == (n // 2) / 7


@pytest.mark.parametrize("names", [False, True])
def test_slices_are_sliced_again_until_they_fit(spark, names):
    """Three slices at a time of at most five cells: several levels."""
    rows = [(t, 1, t, i / 7) for t, n in ((1, 700), (2, 301), (3, 4)) for i in range(n)]
    rows += [(1, 1, 5, 50.0)] * 40
    random.Random(4).shuffle(rows)
    df = readings(spark, rows).repartition(4)
    seen = None
    if names:
        seen = F.col("event_time")
        df = df.withColumn("type_name", F.concat(F.lit("n"), F.pmod(F.hash("humidity"), F.lit(3))))
    few = Settings(group_cells_per_task=5, max_slices=3)
    got = fold_cells(reading_cells(df, "1 minute", seen), few).collect()
    want = {r[1]: r[6] for r in expected(rows, {})}
    assert {r.type_id: round(r.median_humidity, 2) for r in got} == want


def test_equal_values_with_many_names_are_one_value(spark):
    df = readings(spark, [(1, 1, 20, 7)] * 30 + [(1, 1, 20, 9)])
    named = df.withColumn("type_name", F.expr("concat('n', cast(floor(rand(1) * 20) AS string))"))
    few = Settings(group_cells_per_task=2, max_slices=2)
    got = fold_cells(reading_cells(named, "1 minute", F.col("event_time")), few).first()
    assert (got.n_events, got.median_humidity) == (31, 7.0)


def test_temperatures_of_all_sizes_have_one_mean(spark):
    rng = random.Random(8)
    rows = [(1, 1, rng.choice([1.0, 1e5, 1e9, 1e17, -1e17]) * rng.random(), i % 7) for i in range(500)]
    means = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = readings(spark, rows).repartition(1 + 2 * seed)
        for limits in (Settings(), TIGHT):
            means.add(fold_cells(reading_cells(df, "1 minute"), limits).first().mean_temperature)
    assert len(means) == 1
    assert means.pop() == pytest.approx(math.fsum(r[2] for r in rows) / 500, rel=1e-14)


def test_written_summary_leaves_nothing_behind(spark, tmp_path):
    from gaugeworks.storage import shared_dir

    shared = Path(shared_dir(spark).removeprefix("file:"))
    before = {p.name for p in shared.iterdir()} if shared.exists() else set()
    rows = random_rows(500, seed=6)
    path = str(tmp_path / "out")
    for limits in (Settings(), TIGHT):
        write_batch_summary(readings(spark, rows), dimension(spark, NAMES), "parquet", limits, path=path)
    assert len(spark.read.parquet(path).collect()) == 2 * len(expected(rows, NAMES))
    with pytest.raises(ValueError, match="unique"):
        twice = dimension(spark, NAMES).unionByName(dimension(spark, NAMES))
        write_batch_summary(readings(spark, rows), twice, "parquet", path=path)
    assert {p.name for p in shared.iterdir()} - before == set()


@pytest.mark.parametrize("limits", [Settings(), TIGHT], ids=["plain", "tight"])
def test_sql_enrichment_checks_keys_and_keeps_views(spark, limits):
    df = readings(spark, [(1, 1, 20, 50)])
    for name in ("iot_events", "device_types"):
        spark.range(3).createOrReplaceTempView(name)
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "id int, type_name string")
    with pytest.raises(ValueError, match="unique"):
        sql_enriched(df, twice, limits)
    assert sql_enriched(df, dimension(spark, NAMES), limits).first().type_name == NAMES[1]
    for name in ("iot_events", "device_types"):
        assert spark.table(name).count() == 3
        spark.catalog.dropTempView(name)


def test_window_edges_are_half_open(spark):
    rows = [(1, 0, 10, 1), (1, 59.999, 20, 3), (1, 60, 99, 99)]
    got = collected(batch_summary(readings(spark, rows), dimension(spark, NAMES)))
    assert got == expected(rows, NAMES)
    assert [r[2] for r in got] == [2, 1]


def test_two_unknown_types_stay_apart(spark):
    rows = [(1, 1, 20, 50), (1, 30.5, 22, 60), (9, 2, 1, 1), (8, 3, 1, 1)]
    got = batch_summary(readings(spark, rows), dimension(spark, NAMES))
    assert sorted(map(tuple, public_result(got).collect())) == [
        ("14:23", "Temperature Sensor", 21.0, 55.0),
        ("14:23", "Unknown", 1.0, 1.0),
        ("14:23", "Unknown", 1.0, 1.0),
    ]


def test_latest_name_wins_within_a_window(spark):
    df = readings(spark, [(1, 1, 20, 50), (1, 2, 20, 50), (1, 3, 20, 70)])
    named = df.withColumn(
        "type_name", F.when(F.col("event_time") < "2024-01-15 14:23:03", "Z old").otherwise("A new")
    )
    cells = reading_cells(named, "1 minute", seen_at=F.col("event_time"))
    for limit in (1, 1000):
        got = fold_cells(cells, Settings(group_cells_per_task=limit)).first()
        assert (got.type_name, got.n_events, got.median_humidity) == ("A new", 3, 50.0)


def test_label_in_another_zone(spark, other_zone):
    got = batch_summary(readings(spark, [(1, 1, 20, 50)]), dimension(spark, NAMES)).first()
    assert got.window_time == "14:23"


def test_nan_temperature_makes_the_mean_nan(spark):
    rows = [(1, 1, math.nan, 50), (1, 2, 20, 60), (2, 1, 20, 10)]
    got = batch_summary(readings(spark, rows), dimension(spark, NAMES)).orderBy("type_id").collect()
    assert math.isnan(got[0].avg_temperature) and got[0].median_humidity == 55.0
    assert got[1].avg_temperature == 20.0


@pytest.mark.parametrize("column", ["type_id", "temperature", "humidity", "event_time"])
def test_null_in_a_reading_fails_the_job(spark, column):
    good = readings(spark, [(1, 1, 20, 50), (1, 2, 20, 60)])
    first = F.col("humidity") == 50
    bad = good.withColumn(column, F.when(first, F.lit(None)).otherwise(F.col(column)))
    with pytest.raises(JOB_FAILED):
        batch_summary(bad, dimension(spark, NAMES)).collect()


def test_empty_input(spark):
    got = batch_summary(readings(spark, []), dimension(spark, NAMES))
    assert got.collect() == []


# --- lookup join --------------------------------------------------------------------------------


def test_salted_lookup_equals_broadcast_lookup(spark):
    rows = random_rows(1000, seed=2) + [(1, 5.0, 1.0, 1.0)] * 500
    df, dim = readings(spark, rows), dimension(spark, NAMES)
    plain = lookup_join(df, dim)
    salted = lookup_join(df, dim, replace(Settings(), broadcast_max_rows=1))
    assert sorted(plain.collect()) == sorted(salted.collect())
    assert plain.count() == len(rows)


def partitions_used(spark, joined):
    """Partitions with rows, without adaptive execution merging small ones."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return joined.select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_salting_spreads_one_type(spark):
    df = readings(spark, [(1, i / 10, 1.0, 1.0) for i in range(600)])
    dim = dimension(spark, NAMES)
    assert partitions_used(spark, lookup_join(df, dim, replace(TIGHT, salts=1))) == 1
    assert partitions_used(spark, lookup_join(df, dim, replace(TIGHT, salts=8))) > 1


def test_adaptive_execution_splits_copies_of_one_row(spark):
    copies = [(1, 5.0, 1.0, 1.0)] * 20_000
    others = [(t, i / 10, 1.0, 1.0) for i in range(300) for t in (1, 2, 3)]
    df = readings(spark, copies + others).repartition(16)
    small = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        joined = lookup_join(df, dimension(spark, NAMES), replace(TIGHT, salts=8))
        assert len(joined.collect()) == len(copies + others)
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in small:
            spark.conf.unset(key)


def test_size_of_the_dimension_decides(spark):
    df, dim = readings(spark, [(1, 1, 1, 1)]), dimension(spark, NAMES)
    size = measure(dim)
    assert size.rows == 2 and size.bytes > 0

    def plan(settings):
        return lookup_join(df, dim, settings)._jdf.queryExecution().toString()

    assert "BroadcastHashJoin" in plan(Settings())
    assert "BroadcastHashJoin" not in plan(replace(Settings(), broadcast_max_rows=1))
    assert "BroadcastHashJoin" not in plan(replace(Settings(), broadcast_max_bytes=10))


@pytest.mark.parametrize("bad", [[(1, "a"), (1, "b")], [(None, "a")]])
def test_unusable_dimension_keys_fail(spark, bad):
    dim = spark.createDataFrame(bad, "id int, type_name string")
    with pytest.raises(ValueError, match="unique"):
        lookup_join(readings(spark, [(1, 1, 1, 1)]), dim)


def test_null_name_gets_the_fallback(spark):
    dim = spark.createDataFrame([(1, None)], "id int, type_name string")
    assert lookup_join(readings(spark, [(1, 1, 1, 1)]), dim).first().type_name == "Unknown"
