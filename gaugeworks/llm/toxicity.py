"""Toxicity as an ordered severity, by cumulative-link regression on sparse text features.

P(severity >= k) = sigmoid(w . x - t_k) with one weight vector for all thresholds t_1 < t_2 < ...
Features are hashed words and word beginnings; a feature's value grows with the logarithm of its
share of the words. The model is fitted on a bounded sample of labelled documents; every document is
scored by whole text, in tasks that hold the weights and one batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import Work, slices, utf8

FEATURE_BITS = 20
PREFIX = 4
GRADES = 3
#: Labelled documents of each kind that the model is fitted on.
SAMPLE = 3000


@dataclass
class Model:
    """``weights`` by feature number, in the order of ``features``; ``thresholds`` ascending."""

    features: Any
    weights: Any
    thresholds: Any = field(default_factory=list)

    def at_least(self, score):
        """P(severity >= k) for each threshold, by text."""
        import numpy as np

        z = np.asarray(score)[:, None] - np.asarray(self.thresholds)[None, :]
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        return np.where(np.isneginf(z), 0.0, p)  # no model


def features(texts: pa.Array, wanted=None):
    """Index of the text, feature number (only those in the sorted ``wanted``, if given) and value of
    every feature present, and the number of words by text.

    Words are runs of letters and digits in lower case.
    """
    import numpy as np
    import pyarrow.compute as pc
    from xxhash import xxh64_intdigest

    bare = pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\p{L}\p{N}]+", " ")
    split = pc.ascii_split_whitespace(bare)
    size = split.value_lengths().to_numpy().astype(np.int64)
    coded = split.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    mask = (1 << FEATURE_BITS) - 1
    whole = np.array([xxh64_intdigest(w) & mask for w in words], np.int64)
    begin = np.array([xxh64_intdigest(w[:PREFIX], 1) & mask for w in words], np.int64)
    blank = np.array([w == "" for w in words], bool)
    long = np.array([len(w) > PREFIX for w in words], bool)
    word = coded.indices.to_numpy()
    text = np.repeat(np.arange(len(size)), size)
    n_words = np.bincount(text, ~blank[word], len(size)).astype(np.int64)
    keys = []
    for number, present in ((whole, ~blank), (begin, long)):
        if wanted is not None:
            present = present & _among(number, wanted)
        at = np.flatnonzero(present[word])
        keys.append((text[at] << FEATURE_BITS) | number[word[at]])
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    text, number = key >> FEATURE_BITS, key & mask
    return text, number, np.log1p(100 * count / n_words[text]), n_words


def _among(numbers, wanted):
    import numpy as np

    if not len(wanted):
        return np.zeros(len(numbers), bool)
    at = np.minimum(np.searchsorted(wanted, numbers), len(wanted) - 1)
    return wanted[at] == numbers


def grades(text, number, value, toxic, grade_count: int = GRADES):
    """Severity grades from labels that only say whether: 0 for clean texts, and for toxic ones the
    part of ``grade_count`` equal ones in which their amount of marker features lies. A marker is a
    feature much more frequent among toxic texts (log odds of 2 or more, in three texts or more)."""
    import numpy as np

    marker = _log_odds(text, number, toxic)
    strong = marker[number] >= 2
    amount = np.bincount(text[strong], value[strong], len(toxic))
    cuts = np.quantile(amount[toxic], np.arange(1, grade_count) / grade_count)
    return np.where(toxic, 1 + np.searchsorted(cuts, amount, "right"), 0)


def _log_odds(text, number, toxic):
    """By feature number; 0 for features in fewer than three toxic texts."""
    import numpy as np

    n = 1 << FEATURE_BITS
    bad = np.bincount(number[toxic[text]], minlength=n)
    good = np.bincount(number[~toxic[text]], minlength=n)
    odds = np.log((bad + 0.5) / (toxic.sum() + 1)) - np.log((good + 0.5) / ((~toxic).sum() + 1))
    return np.where(bad + good >= 3, odds, 0)


def fit(text, number, value, grade, rounds: int = 300, l1: float = 2e-4, step: float = 0.5) -> Model:
    """Cumulative-link regression of ``grade`` by text, with an L1 penalty, from sparse features.

    Features whose log odds of any toxicity are small carry nothing and are left out beforehand.
    """
    import numpy as np

    grade = np.asarray(grade)
    top = int(grade.max())
    odds = _log_odds(text, number, grade > 0)
    chosen = np.flatnonzero(np.abs(odds) >= 1)
    use = _among(number, chosen)
    text, column, value = text[use], np.searchsorted(chosen, number[use]), value[use]
    # Clean texts weigh as much as all toxic ones: they are what most texts are.
    kinds = np.bincount(grade > 0, minlength=2)
    weight = (0.5 / np.maximum(kinds, 1))[(grade > 0).astype(int)]
    w, t = np.zeros(len(chosen)), np.linspace(1, 1 + top - 1, top)
    seen_w, seen_t = np.full(len(w), 1e-8), np.full(len(t), 1e-8)
    texts = np.arange(len(grade))
    for _ in range(rounds):
        score = np.bincount(text, value * w[column], len(grade))
        p = 1 / (1 + np.exp(-np.clip(score[:, None] - t[None, :], -50, 50)))
        # P(severity = k) is the difference of two neighbours, 1 and 0 at the ends.
        edges = np.concatenate([np.ones((len(grade), 1)), p, np.zeros((len(grade), 1))], axis=1)
        chance = np.maximum(edges[texts, grade] - edges[texts, grade + 1], 1e-9)
        slope = edges * (1 - edges)
        d_score = -(slope[texts, grade] - slope[texts, grade + 1]) / chance * weight
        d_t = np.zeros(top)
        for k in range(1, top + 1):
            at, before = grade == k, grade == k - 1
            d_t[k - 1] = (slope[at, k] / chance[at] * weight[at]).sum()
            d_t[k - 1] -= (slope[before, k] / chance[before] * weight[before]).sum()
        d_w = np.bincount(column, value * d_score[text], len(w))
        seen_w += d_w**2
        seen_t += d_t**2
        rate = step / np.sqrt(seen_w)
        w = w - rate * d_w
        w = np.sign(w) * np.maximum(np.abs(w) - rate * l1, 0)
        t = np.maximum.accumulate(t - step / np.sqrt(seen_t) * d_t)
        t = t + 1e-6 * np.arange(top)  # thresholds stay in order
    kept = np.flatnonzero(w)
    return Model(chosen[kept], w[kept], t)


def train(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    text: str = "text",
    doc: str = "doc_id",
    toxic: str = "toxic",
) -> Model:
    """A model from at most ``sample`` toxic and ``sample`` clean labelled documents, chosen by a hash
    of their id. Of their features those that can matter reach the driver, not the others nor texts.

    Labels with a null are ignored; of repeated ids the largest label counts, and of documents with
    one id the features of one of them. Without both kinds there is no model to learn: it gives
    every text severity 0.
    """
    import numpy as np

    known = labels.where(F.col(doc).isNotNull() & F.col(toxic).isNotNull())
    known = known.groupBy(F.col(doc).cast("long").alias("_id")).agg((F.max(toxic) > 0).alias("_toxic"))
    known = known.join(
        docs.where(F.col(doc).isNotNull()).select(F.col(doc).cast("long").alias("_id")).distinct(),
        "_id",
        "left_semi",
    )
    order = F.xxhash64("_id", F.lit("sample"))
    chosen = known.where("_toxic").orderBy(order, "_id").limit(sample)
    chosen = chosen.unionByName(known.where("not _toxic").orderBy(order, "_id").limit(sample))
    ids = {row["_id"]: row["_toxic"] for row in chosen.collect()}
    if len(set(ids.values())) < 2:
        return Model(np.zeros(0, np.int64), np.zeros(0), np.full(GRADES, np.inf))
    spark = docs.sparkSession
    few = F.broadcast(spark.createDataFrame(list(ids.items()), "_id long, _toxic boolean"))  # 2 * sample at most
    texts = docs.select(F.col(doc).cast("long").alias("_id"), utf8(text).alias("_text")).join(few, "_id")
    work = Work(spark, "toxicity")
    texts = work.stage(texts.dropDuplicates(["_id"]), "sample")
    wanted = spark.sparkContext.broadcast(_telling(texts))  # bounded by the number of features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            at, number, value, _ = features(batch.column(1).cast(pa.string()), wanted.value)
            ends = np.searchsorted(at, np.arange(batch.num_rows + 1)).tolist()
            columns = [
                pa.array([x[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)], pa.binary())
                for x in (number, value)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["_id", "f", "x"])

    found = texts.select("_id", "_text").mapInArrow(run, "_id long, f binary, x binary").collect()
    work.drop("sample")
    found.sort(key=lambda row: row["_id"])
    at = np.repeat(np.arange(len(found)), [len(row["f"]) // 8 for row in found])
    number = np.concatenate([np.frombuffer(row["f"], np.int64) for row in found])
    value = np.concatenate([np.frombuffer(row["x"]) for row in found])
    bad = np.array([ids[row["_id"]] for row in found])
    return fit(at, number, value, grades(at, number, value, bad))


def _telling(texts: DataFrame):
    """The features of the sample ``texts`` (``_id``, ``_text``, ``_toxic``) that can matter to a model: in
    three texts or more, and with log odds of nearly one or more. The others stay where they are."""
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            at, number, _, _ = features(batch.column(0).cast(pa.string()))
            toxic = batch.column(1).to_numpy(zero_copy_only=False)[at]
            found, index = np.unique(number, return_inverse=True)
            bad, good = (np.bincount(index[of], minlength=len(found)) for of in (toxic, ~toxic))
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(bad), pa.array(good)], ["number", "bad", "good"])

    kinds = texts.agg(F.count_if("_toxic").alias("bad"), F.count_if(~F.col("_toxic")).alias("good")).first()
    counts = texts.select("_text", "_toxic").mapInArrow(run, "number long, bad long, good long")
    counts = counts.groupBy("number").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    odds = F.log((F.col("bad") + 0.5) / (kinds["bad"] + 1)) - F.log((F.col("good") + 0.5) / (kinds["good"] + 1))
    rows = counts.where((F.col("bad") + F.col("good") >= 3) & (F.abs(odds) >= 0.99)).select("number").collect()
    return np.array(sorted(row["number"] for row in rows), np.int64)


def severity(docs: DataFrame, model: Model, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``expected_severity`` (0 to the number of grades),
    ``p_at_least`` (by grade, descending chances), ``grade`` (the largest that is at least as likely
    as not) and ``toxic``, whether that is above 0.

    Texts without words (null, empty, blank) have severity 0. Null ids are kept and repeated rows
    repeated; further columns are left out.
    """
    import numpy as np

    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the number of features
    names = ["doc_id", "expected_severity", "p_at_least", "grade", "toxic"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, "_text"):
            at, number, value, n_words = features(batch.column(1).cast(pa.string()), model.features)
            each = value * model.weights[np.searchsorted(model.features, number)] if len(number) else value
            p = model.at_least(np.bincount(at, each, batch.num_rows))
            p[n_words == 0] = 0
            grade = (p >= 0.5).sum(axis=1)
            ends = np.arange(0, p.size + 1, p.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(p.sum(axis=1)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(p.ravel())),
                    pa.array(grade.astype(np.int32)),
                    pa.array(grade > 0),
                ],
                names,
            )

    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), utf8(text).alias("_text"))
    return rows.mapInArrow(
        run, "doc_id long, expected_severity double, p_at_least array<double>, grade int, toxic boolean"
    )
