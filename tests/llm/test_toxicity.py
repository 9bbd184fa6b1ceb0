import random

import numpy as np
import pyarrow as pa
import pytest

from cases import clashing, docs, empty, words
from gaugeworks.llm import toxicity

BAD = ["grunk", "frobbish", "snarlet", "mogwort", "blightish"]


def corpus(seed, n=600):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        own = words(rng, rng.randrange(20, 120), 300).split()
        share = rng.choice([0, 0, 0, 0.03, 0.1, 0.3])
        for _ in range(int(np.ceil(len(own) * share))):
            own[rng.randrange(len(own))] = rng.choice(BAD) + rng.choice(["", "s", "er"])
        rows.append((i, " ".join(own)))
        labels.append((i, 1, int(share > 0), share))
    return rows, labels


def labelled(spark, labels):
    return spark.createDataFrame([r[:3] for r in labels], "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_order(spark):
    rows, labels = corpus(1, 900)
    frame = docs(spark, rows)
    model = toxicity.train(frame, labelled(spark, labels[:500]))
    got = {r.doc_id: r for r in toxicity.severity(frame, model).collect()}
    held = labels[500:]
    right = [got[i].toxic == bool(t) for i, _, t, _ in held]
    assert np.mean(right) > 0.97
    by_share = [np.mean([got[i].expected_severity for i, _, _, s in held if s == share]) for share in (0, 0.03, 0.1, 0.3)]
    assert by_share == sorted(by_share) and by_share[0] < 0.3 and by_share[3] > 2.3
    for r in got.values():
        assert r.p_at_least == sorted(r.p_at_least, reverse=True)
        assert r.expected_severity == pytest.approx(sum(r.p_at_least))
    assert list(model.thresholds) == sorted(model.thresholds)


def test_unknown_words_with_known_beginnings_count(spark):
    rows, labels = corpus(2)
    model = toxicity.train(docs(spark, rows), labelled(spark, labels))
    got = toxicity.severity(docs(spark, [words(random.Random(1), 30, 300) + " grunkyish frobbot mogworthy"]), model)
    assert got.first().toxic


def test_nulls_repeats_and_clashing_names(spark):
    rows, labels = corpus(3, 200)
    model = toxicity.train(docs(spark, rows), labelled(spark, labels))
    odd = [(1, None), (2, ""), (3, " .,!"), (4, "grunk frobbish"), (4, "grunk frobbish"), (None, "grunk mogwort snarlet")]
    got = toxicity.severity(clashing(spark, odd), model).collect()
    found = sorted((r.doc_id or 0, r.toxic, r.expected_severity > 1) for r in got)
    assert found == [(0, True, True), (1, False, False), (2, False, False), (3, False, False), (4, True, True), (4, True, True)]
    assert {r.expected_severity for r in got if r.doc_id in (1, 2, 3)} == {0.0}


def test_odd_labels(spark):
    rows, _ = corpus(4, 40)
    frame = docs(spark, rows)
    one_kind = spark.createDataFrame([(1, 0), (2, 0), (2, None), (None, 1), (777, 1)], "doc_id long, toxic int")
    model = toxicity.train(frame, one_kind)
    assert {r.expected_severity for r in toxicity.severity(frame, model).collect()} == {0.0}
    assert toxicity.severity(empty(spark), model).collect() == []
    assert len(toxicity.train(empty(spark), one_kind).weights) == 0


def test_sample_is_bounded_and_repeatable(spark):
    rows, labels = corpus(5, 300)
    frame, known = docs(spark, rows), labelled(spark, labels)
    a, b = (toxicity.train(frame.repartition(k), known, sample=60) for k in (2, 5))
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.features, b.features)


def test_gradient_is_that_of_the_likelihood():
    """One step from a fitted model cannot make the labels likelier by much."""
    rng = np.random.default_rng(1)
    text = np.repeat(np.arange(300), 3)
    number = rng.integers(0, 12, 900)
    grade = np.minimum(np.bincount(text, number < 4, 300).astype(int), 3)
    model = toxicity.fit(text, number, np.ones(900), grade, l1=0)

    def loss(w, t):
        score = np.bincount(text, (w[np.minimum(np.searchsorted(model.features, number), len(w) - 1)] * np.isin(number, model.features)), 300)
        p = 1 / (1 + np.exp(-(score[:, None] - t[None, :])))
        edges = np.concatenate([np.ones((300, 1)), p, np.zeros((300, 1))], axis=1)
        weight = np.where(grade > 0, 0.5 / (grade > 0).sum(), 0.5 / (grade == 0).sum())
        return -(weight * np.log(edges[np.arange(300), grade] - edges[np.arange(300), grade + 1])).sum()

    best = loss(model.weights, np.asarray(model.thresholds))
    for _ in range(50):
        w = model.weights + rng.normal(size=len(model.weights)) * 0.05
        t = np.sort(model.thresholds + rng.normal(size=3) * 0.05)
        assert loss(w, t) > best - 0.01


def test_features_count_words_and_beginnings():
    text, number, value, n = toxicity.features(pa.array(["Alpha alpha, BETA.", "", "ab"]))
    assert n.tolist() == [3, 0, 1]
    assert np.bincount(text, minlength=3).tolist() == [3, 0, 1]  # alpha, ^alph, beta; ab
    assert value.max() == pytest.approx(np.log1p(200 / 3)) or value.max() == pytest.approx(np.log1p(100))
