"""Medians of large groups by bounds from a sketch, and of others without stored tables."""

import math
import random
from dataclasses import replace

import pytest

from gaugeworks import Settings, batch_summary
from gaugeworks.functions import decode
from gaugeworks.operators.median import fold_readings
from helpers import collected, dimension, expected, readings
from test_batch import NAMES, random_rows
from test_plans import message_files, plan  # noqa: F401

SMALL_GROUPS = Settings(group_cells_per_task=40)


def stored(root):
    return sorted(p.name for p in root.iterdir()) if root.exists() else []


def test_no_table_is_stored_without_a_large_group(spark, tmp_path):
    rows = random_rows(600, seed=3)
    summary = batch_summary(readings(spark, rows), dimension(spark, NAMES), Settings(), str(tmp_path / "w"))
    assert collected(summary) == expected(rows, NAMES)
    assert stored(tmp_path / "w") == []


def test_messages_are_parsed_once_by_the_summary(spark, message_files):
    text = plan(batch_summary(decode(message_files), dimension(spark, NAMES)))
    assert text.count("from_json") == 1 and text.count("Exchange hashpartitioning") == 1


def test_bounded_groups_are_shuffled_once_and_join_nothing(spark):
    text = plan(fold_readings(readings(spark, [(1, 1, 20, 50), (2, 1, 20, 50)])))
    assert text.count("Exchange hashpartitioning") == 1
    assert "Join" not in text and "Python" not in text
    # The pieces of the sum are made behind the shuffle.
    assert "rint" not in text[text.index("Exchange hashpartitioning") :].split("\n", 1)[1]


@pytest.mark.parametrize("seed", range(3))
def test_only_the_middle_of_large_groups_keeps_its_values(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(1, rng.random() * 59, rng.random() * 50, rng.random() * 100) for _ in range(4000)]
    rows += [(2, rng.random() * 59, 1.5, float(rng.randrange(3))) for _ in range(500)] + [(3, 1, 2, 3)]
    settings = Settings(group_cells_per_task=300)
    summary = batch_summary(readings(spark, rows), dimension(spark, NAMES), settings, str(tmp_path / "w"))
    assert collected(summary) == expected(rows, NAMES)
    assert spark.read.parquet(str(tmp_path / "w" / "near-0")).count() < 0.06 * 4000 + 10
    # What is left is small enough to be sorted by one task.
    assert not any(name.startswith("sliced") for name in stored(tmp_path / "w"))


def test_bounds_that_miss_the_middle_are_widened(spark, tmp_path):
    rng = random.Random(8)
    rows = [(t, 5, 20.25, rng.random()) for t in (1, 2, 3, 4) for _ in range(1000)] + random_rows(300, seed=8)
    blind = replace(SMALL_GROUPS, sketch_size=8, sketch_margin=1e-6)
    summary = batch_summary(readings(spark, rows), dimension(spark, NAMES), blind, str(tmp_path / "w"))
    assert collected(summary) == expected(rows, NAMES)
    assert any(name.startswith("near-1") for name in stored(tmp_path / "w"))


def test_infinite_and_nan_values(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, 1, 1, v) for v in [nan] * 60 + [1.0] * 30]
    rows += [(2, 1, 1, v) for v in [-inf] * 60 + [5.0] * 10] + [(3, 1, 1, v) for v in [inf] * 50 + [nan] * 20]
    rows += [(4, 1, 1, v) for v in [-inf] * 45 + [7.0] + [inf] * 45] + [(5, 1, 1, v) for v in [-inf] * 46 + [nan] * 46]
    for settings in (Settings(), SMALL_GROUPS):
        got = {r.type_id: r.median_humidity for r in fold_readings(readings(spark, rows), settings).collect()}
        assert math.isnan(got[1]) and got[2] == -inf and got[3] == inf and got[4] == 7.0 and math.isnan(got[5])


def test_the_name_of_the_latest_reading_counts(spark):
    from gaugeworks.plans.batch import latest_names, named_summary

    frame = readings(spark, [(1, s, 1, s) for s in range(50)])
    named = frame.selectExpr("*", "if(humidity = 49, 'a', if(humidity = 48, 'z', 'b')) AS type_name")
    for settings in (Settings(), SMALL_GROUPS):
        for parts in (1, 5):
            (row,) = named_summary(named.repartition(parts), settings).collect()
            assert row.type_name == "a" and row.n_events == 50
    assert [r.type_name for r in latest_names(named.repartition(3)).collect()] == ["a"]
