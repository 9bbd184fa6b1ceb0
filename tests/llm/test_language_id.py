import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

import gaugeworks.llm.language_id as language_id
from cases import SF, clashing, docs, empty
from gaugeworks.llm.language_id import characters, held_out, numbers, predict, train
from gaugeworks.llm.queries import QUERIES

LETTERS = {"aa": "abcde ", "bb": "cdefg ", "cc": "aegéß "}


def sample(seed, n=90):
    rng = random.Random(seed)
    texts = []
    for i in range(n):
        lang = rng.choice(sorted(LETTERS))
        texts.append((i, "".join(rng.choice(LETTERS[lang]) for _ in range(rng.randrange(60))), lang))
    return texts


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)


def plain(text):
    """Lower-case letters, one space around and between runs of them."""
    runs = "".join(c.lower() if c.isalpha() else " " for c in text).split()
    return "".join(f" {r}" for r in runs) + " " if runs else " "


def number(gram):
    mask = (1 << 64) - 1
    h = 0
    for n, c in enumerate(gram, 1):
        h = (h + ord(c) + n) * 0x9E3779B97F4A7C15 & mask
        h ^= h >> 29
    return (h * 0xBF58476D1CE4E5B9 & mask) >> 48


def grams(text):
    p = plain(text)
    return Counter(number(p[i : i + n]) for n in range(1, 5) for i in range(len(p) - n + 1))


def brute(learn, texts):
    counts, docs_ = {}, Counter()
    for text, lang in learn:
        if text is not None and lang is not None:
            counts.setdefault(lang, Counter()).update(grams(text))
            docs_[lang] += 1
    result = []
    for text in texts:
        if text is None or not any(c.isalpha() for c in text) or not counts:
            result.append(("und", 0.0))
            continue
        logs = {}
        for lang, c in counts.items():
            whole = sum(c.values()) + 0.5 * 65536
            logs[lang] = math.log(docs_[lang] / sum(docs_.values()))
            logs[lang] += sum(k * math.log((c[g] + 0.5) / whole) for g, k in grams(text).items())
        best = max(sorted(logs), key=logs.get)
        result.append((best, 1 / sum(math.exp(v - logs[best]) for v in logs.values())))
    return result


def test_characters_and_numbers():
    chars, starts = characters(["Ab, c", "", "12 !", "É"])
    assert "".join(map(chr, chars)) == " ab c    é " and starts.tolist() == [0, 6, 7, 8]
    for text in ("Ab, c", "x", "  a  b-c  "):
        chars, starts = characters([text])
        assert "".join(map(chr, chars)) == plain(text)
        found = Counter()
        for n, _ in numbers(chars, starts):
            found.update(n.tolist())
        assert found == grams(text)


@pytest.mark.parametrize("part", [7, 64])
def test_parts_of_long_texts_give_the_same(monkeypatch, part):
    rng = random.Random(part)
    texts = ["".join(rng.choice("abé, 1") for _ in range(rng.randrange(200))) for _ in range(40)] + [",", ""]
    whole = characters(texts)

    def found(chars, starts):
        pairs = Counter()
        for n, of in numbers(chars, starts):
            pairs.update(zip(n.tolist(), of.tolist(), strict=True))
        return pairs

    want = found(*whole)
    monkeypatch.setattr(language_id, "PART", part)
    again = characters(texts)
    assert all(np.array_equal(a, b) for a, b in zip(whole, again, strict=True))
    assert found(*again) == want


def test_equals_brute_force(spark):
    learn, texts = sample(1), [t for _, t, _ in sample(2)]
    model = train(frame_of(spark, learn))
    got = {r.doc_id: (r.lang_pred, r.score) for r in predict(docs(spark, texts), model).collect()}
    for i, (lang, score) in enumerate(brute([x[1:] for x in learn], texts)):
        assert got[i][0] == lang and got[i][1] == pytest.approx(score, rel=1e-3)


def test_nulls_empty_repeats_ties_and_clashing_names(spark):
    learn = [(1, "abc", "x"), (2, "abc", "w"), (3, None, "x"), (4, "zzz", None), (5, "abc", "x"), (6, "abc", "w")]
    model = train(frame_of(spark, learn))
    assert model.languages == ["w", "x"]
    rows = [(1, None), (2, ""), (3, "12, 3"), (4, "abc"), (4, "abc"), (None, "q")]
    got = predict(clashing(spark, rows), model)
    assert got.columns == ["doc_id", "lang_pred", "score"]
    assert sorted(((r.doc_id or 0, r.lang_pred, round(r.score, 6)) for r in got.collect())) == [
        (0, "w", 0.5), (1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (4, "w", 0.5), (4, "w", 0.5)
    ]


def test_nothing_to_learn_or_to_predict(spark):
    model = train(empty(spark))
    assert model.languages == [] and predict(empty(spark), model).collect() == []
    assert [tuple(r) for r in predict(docs(spark, ["abc"]), model).collect()] == [(0, "und", 0.0)]


def test_very_long_text_and_hot_language(spark):
    learn = [(i, "abcab " * 5, "en") for i in range(500)] + [(500, "xyz " * 400_000, "zz")]
    model = train(frame_of(spark, learn))
    got = predict(docs(spark, ["xyz " * 500_000, "abcab"]), model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in got] == ["zz", "en"]


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 2)
    with pytest.raises(ValueError):
        train(frame_of(spark, [(i, "a", f"l{i}") for i in range(3)]))


def test_held_out_share(spark):
    frame = docs(spark, [(7, "a"), (12, "b"), (None, "c")])
    got = {r.doc_id: r.h for r in frame.select("doc_id", held_out().alias("h")).collect()}
    assert got == {7: zlib.crc32(b"7") % 4 == 2, 12: zlib.crc32(b"12") % 4 == 2, None: None}


@pytest.mark.skipif(not SF.exists(), reason="test tables are not here")
def test_held_out_accuracy_on_the_tables(spark):
    path = str(SF.parent / "sf0.01")
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op13_language_id"](spark, path).collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
