import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cases import SF, clashing, docs, empty, words
from gaugeworks.llm import kneser_ney
from gaugeworks.llm.kneser_ney import BEGIN, END, ORDER, SYMBOLS, keep_good, perplexities
from gaugeworks.llm.queries import op3_kneser_ney


class Brute:
    """Interpolated modified Kneser-Ney over bytes, by the formulas."""

    def __init__(self, texts):
        self.counts = {n: Counter() for n in range(1, ORDER + 1)}
        for text in texts:
            s = bytes([BEGIN] * (ORDER - 1)) + text.encode() + bytes([END])
            for i in range(len(s) - ORDER + 1):
                self.counts[ORDER][s[i : i + ORDER]] += 1
        for n in range(ORDER - 1, 0, -1):
            self.counts[n] = Counter(gram[1:] for gram in self.counts[n + 1])
        self.discounts, self.total, self.taken = {}, {}, {}
        for n, counts in self.counts.items():
            times = Counter(counts.values())
            y = times[1] / (times[1] + 2 * times[2]) if times[1] else 0
            ds = []
            for k in (1, 2, 3):
                if times[1] and times[k]:
                    d = k - (k + 1) * y * times[k + 1] / times[k]
                else:
                    d = k / 2
                ds.append(max(min(d, k), 0.01))
            self.discounts[n] = ds
            self.total[n], self.taken[n] = defaultdict(int), defaultdict(float)
            for gram, c in counts.items():
                self.total[n][gram[:-1]] += c
                self.taken[n][gram[:-1]] += min(ds[min(c, 3) - 1], c)

    def p(self, gram):
        if not gram:
            return 1 / SYMBOLS
        n, h = len(gram), gram[:-1]
        if h not in self.total[n]:
            return self.p(gram[1:])
        c = self.counts[n].get(gram, 0)
        own = max(c - self.discounts[n][min(c, 3) - 1], 0) if c else 0
        return (own + self.taken[n][h] * self.p(gram[1:])) / self.total[n][h]

    def perplexity(self, text):
        s = bytes([BEGIN] * (ORDER - 1)) + text.encode() + bytes([END])
        cost = [-math.log(self.p(s[i : i + ORDER])) for i in range(len(s) - ORDER + 1)]
        return math.exp(sum(cost) / len(cost))


def trusted(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "doc_id long")


@pytest.mark.parametrize("blocks", [kneser_ney.BLOCK_BYTES, 2000])
def test_perplexities_equal_the_formulas(spark, monkeypatch, blocks):
    monkeypatch.setattr(kneser_ney, "BLOCK_BYTES", blocks)
    monkeypatch.setattr(kneser_ney, "SHARD_ROWS", kneser_ney.SHARD_ROWS if blocks > 2000 else 500)
    rng = random.Random(1)
    texts = [(i, words(rng, rng.randrange(1, 60), 50)) for i in range(80)]
    texts += [(80, "ZZZ !!! ###"), (81, "w1 w2 été"), (82, "x")]
    ids = list(range(0, 60))
    got = {r.doc_id: r for r in perplexities(docs(spark, texts), trusted(spark, ids), held_out=0).collect()}
    model = Brute([t for i, t in texts if i in ids])
    for i, t in texts:
        assert got[i].perplexity == pytest.approx(model.perplexity(t), rel=1e-5)
    assert got[80].perplexity > 4 * got[70].perplexity


def test_probabilities_sum_to_one():
    model = Brute(["abracadabra", "banana", "cabana"])
    for h in (b"", b"a", b"an", b"bana"):
        assert sum(model.p(h[-(ORDER - 1) :] + bytes([c])) for c in range(256)) == pytest.approx(1)


def test_thresholds_are_by_language_and_junk_goes(spark):
    rng = random.Random(2)
    en = [(i, words(rng, 80, 60)) for i in range(120)]
    fr = [(1000 + i, words(rng, 80, 60).replace("w", "é")) for i in range(120)]
    junk = [(500, "#!?~ ^^ " * 60), (501, words(rng, 80, 60).replace("w", "é"))]
    frame = docs(spark, en + junk).unionByName(docs(spark, fr, "fr"))
    ids = [i for i, _ in en + fr if i % 2]
    judged = perplexities(frame, trusted(spark, ids), quantile=1.0)
    got = {r.doc_id: r for r in judged.collect()}
    assert not got[500].kept and not got[501].kept
    clean = [got[i].kept for i, _ in en + fr]
    assert sum(clean) >= len(clean) - 4
    limits = {r.lang: r.threshold for r in got.values()}
    assert len(set(limits.values())) == 2
    left = keep_good(frame, trusted(spark, ids), quantile=1.0)
    assert {r.doc_id for r in left.collect()} == {i for i, r in got.items() if r.kept}


def test_the_quantile_decides_where_many_texts_are_held_out(spark):
    rng = random.Random(5)
    frame = docs(spark, [(i, words(rng, 40, 60)) for i in range(600)])
    rows = perplexities(frame, trusted(spark, range(600)), quantile=0.5, held_out=60).collect()
    left = keep_good(frame, trusted(spark, range(600)), quantile=0.5, held_out=60).count()
    assert left == sum(r.kept for r in rows)
    # Half of the held-out texts and an allowance; those trained on have lower scores.
    assert 0.02 * len(rows) < len(rows) - left < 0.4 * len(rows)


def test_nulls_repeats_and_clashing_names(spark):
    rng = random.Random(3)
    good = [(i, words(rng, 50, 30)) for i in range(40)]
    rows = [*good, good[0], (90, None), (91, ""), (None, words(rng, 50, 30)), (None, "%%%% ####" * 30)]
    frame = clashing(spark, rows)
    other = frame.withColumn("lang", F.lit(None).cast("string")).where("doc_id = 5 or doc_id = 91")
    frame = frame.unionByName(other)
    ids = spark.createDataFrame([(i,) for i in [*range(40), 1, 1, 90, None]], "doc_id long")
    got = perplexities(frame, ids, quantile=1.0).collect()
    assert len(got) == len(rows) + 2
    assert all(r.perplexity is None and r.kept for r in got if r.n_bytes == 0)
    assert len([r for r in got if r.doc_id == 0]) == 2
    odd = [r for r in got if r.doc_id is None]
    assert sorted(r.kept for r in odd) == [False, True]
    left = keep_good(frame, ids, quantile=1.0)
    assert left.columns == frame.columns and left.count() == sum(r.kept for r in got)


def test_without_trusted_texts_everything_stays(spark):
    frame = docs(spark, ["a b c", "d e f"])
    assert all(r.kept and r.perplexity is None for r in perplexities(frame, trusted(spark, [])).collect())
    assert keep_good(frame, trusted(spark, [77])).count() == 2
    assert perplexities(empty(spark), trusted(spark, [1])).collect() == []
    assert keep_good(empty(spark), trusted(spark, [])).collect() == []


def test_language_without_training_text_stays(spark):
    frame = docs(spark, [(i, f"a b c {i}") for i in range(20)]).unionByName(docs(spark, [(99, "%%%")], "xx"))
    got = {r.doc_id: r for r in perplexities(frame, trusted(spark, range(20)), held_out=30).collect()}
    assert got[99].kept and got[99].perplexity is None and got[3].perplexity is not None


def test_very_long_text(spark):
    rng = random.Random(4)
    rows = [(i, words(rng, 60, 40)) for i in range(20)] + [(50, words(rng, 300_000, 40))]
    got = {r.doc_id: r for r in perplexities(docs(spark, rows), trusted(spark, range(20)), held_out=0).collect()}
    assert got[50].perplexity < 2 * got[3].perplexity


@pytest.mark.skipif(not SF.exists(), reason="test tables are not here")
def test_labelled_junk_goes_and_trusted_texts_stay(spark):
    tables = SF.parent / "sf0.1"
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    rows = op3_kneser_ney(spark, str(tables)).join(labels, "doc_id").collect()
    for lang in ("de", "en", "es", "fr"):
        bad = [r.kept for r in rows if r.lang == lang and r.quality == 0]
        good = [r.kept for r in rows if r.lang == lang and r.quality == 1 and r.toxic == 0]
        assert bad.count(False) >= 0.85 * len(bad), lang
        assert good.count(False) <= 0.01 * len(good), lang
