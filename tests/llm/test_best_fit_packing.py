import random

import pytest
from pyspark.sql import functions as F

from cases import clashing, docs, empty, words
from gaugeworks.llm import best_fit_packing
from gaugeworks.llm.best_fit_packing import CAPACITIES, bin_cost, pack, plan_packing


def brute(lengths, sizes, cost, largest):
    """Best-fit decreasing one item after the other, bins opened and downsized by the same rules."""
    bins = []  # [free, capacity]
    items = sorted(lengths, reverse=True)
    k = 0
    while k < len(items):
        x = items[k]
        fitting = [b for b in bins if b[0] >= x]
        if fitting:
            min(fitting, key=lambda b: b[0])[0] -= x
            k += 1
            continue
        allowed = [s for s in sizes if x <= s <= largest] or [min(s for s in sizes if s >= x)]
        size = min(allowed, key=lambda s: (cost(s) / (s // x * x), s))
        bins.append([size - x, size])
        k += 1
    used = [c - f for f, c in bins]
    return sum(cost(min(s for s in sizes if s >= u)) for u in used), len(bins)


@pytest.mark.parametrize("seed", range(60))
def test_plan_equals_item_by_item_best_fit(seed):
    rng = random.Random(seed)
    sizes = sorted(rng.sample(range(2, 40), rng.randrange(1, 5)))
    lengths = [rng.randrange(1, sizes[-1] + 1) for _ in range(rng.randrange(1, 120))]
    histogram = {x: lengths.count(x) for x in set(lengths)}
    def cost(size):
        return size + 3 + size * size // 50

    plan = plan_packing(histogram, tuple(sizes), cost)
    assert plan.cost == min(brute(lengths, sizes, cost, largest)[0] for largest in sizes)


def valid(rows, lengths, capacities):
    """Every token has one place, no bin overflows, places do not overlap."""
    bins, pieces = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append((r.doc_start, r.n_tokens))
        if r.bin_id is not None:
            bins.setdefault((r.bin_id, r.capacity), []).append((r.bin_start, r.n_tokens))
    for (_, capacity), held in bins.items():
        end = 0
        for start, n in sorted(held):
            assert start == end  # gapless from the bin's begin
            end += n
        assert end <= capacity and capacity == min(c for c in capacities if c >= end)
    assert len({b for b, _ in bins}) == len(bins)
    for doc, n in lengths.items():
        end = 0
        for start, size in sorted(pieces[doc]):
            assert start == end
            end += size
        assert end == n
    return bins


@pytest.mark.parametrize("per_bucket", [3, 1000])
def test_places_are_whole_and_disjoint(spark, monkeypatch, per_bucket):
    monkeypatch.setattr(best_fit_packing, "ROWS_PER_BUCKET", per_bucket)
    rng = random.Random(per_bucket)
    texts = [(i, words(rng, rng.choice([0, 1, 5, 5, 5, 30, 100, 700, 9000, 20_000]))) for i in range(300)]
    got = pack(docs(spark, texts)).collect()
    lengths = {i: len(t.split()) + 1 for i, t in texts}
    bins = valid(got, lengths, CAPACITIES)
    histogram = {}
    for r in got:
        histogram[r.n_tokens] = histogram.get(r.n_tokens, 0) + 1
    assert sum(bin_cost(c) for _, c in bins) == plan_packing(histogram).cost


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (None, "a b"), (3, " \t\x0ba\x0cb\r\n")]
    got = pack(clashing(spark, rows)).collect()
    assert sorted(r.n_tokens for r in got) == [1, 1, 1, 3, 3, 3]
    assert len({(r.bin_id, r.bin_start) for r in got}) == 6


def test_own_lengths_and_capacities(spark):
    frame = docs(spark, ["x"] * 6).withColumn("n", F.expr("CASE doc_id WHEN 0 THEN 0 WHEN 1 THEN null ELSE doc_id * 5 END"))
    got = pack(frame, F.col("n"), capacities=(8, 20)).collect()
    valid([r for r in got if r.n_tokens], {i: i * 5 for i in range(2, 6)}, (8, 20))
    assert [(r.bin_id, r.capacity) for r in got if r.doc_id < 2] == [(None, None)] * 2


def test_empty_table(spark):
    assert pack(empty(spark)).collect() == []
    assert plan_packing({}).bins == []
