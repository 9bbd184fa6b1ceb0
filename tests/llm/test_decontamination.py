import random
import time

import pytest

from cases import clashing, docs, empty, words
from gaugeworks.llm.decontamination import clean, contaminated, tiles

ITEMS = "item_id long, text string"


def brute_tiles(doc, item, n):
    """Greedy string tiling by comparing everywhere, round by round."""
    in_doc, in_item, found = set(), set(), []
    while True:
        best = (0, 0, 0)
        for d in range(len(doc)):
            for i in range(len(item)):
                k = 0
                while (
                    d + k < len(doc) and i + k < len(item) and doc[d + k] == item[i + k]
                    and d + k not in in_doc and i + k not in in_item
                ):
                    k += 1
                if k > best[0]:
                    best = (k, d, i)
        length, d, i = best
        if length < n:
            return found
        found.append((d, i, length))
        in_doc |= set(range(d, d + length))
        in_item |= set(range(i, i + length))


@pytest.mark.parametrize("seed", range(40))
def test_tiles_equal_brute_force(seed):
    rng = random.Random(seed)
    item = [rng.randrange(6) for _ in range(rng.randrange(25))]
    doc = [rng.randrange(6) for _ in range(rng.randrange(10))] + item[8:] + [9] + item[:8]
    doc = doc + [rng.randrange(6) for _ in range(rng.randrange(10))]
    n = rng.choice([1, 2, 3])
    pairs = [
        (d, i) for d in range(len(doc) - n + 1) for i in range(len(item) - n + 1) if doc[d : d + n] == item[i : i + n]
    ]
    assert tiles(pairs, n) == brute_tiles(doc, item, n)


def test_scripts_without_spaces(spark):
    items = [
        (1, "水の沸点は標高が高いほど低くなる"),
        (2, "中国最长的河流是哪一条，它流经多少个省份？"),
        (3, "ต้นไม้ที่สูงที่สุดในโลกอยู่ที่ไหน"),
        (4, "ラーメンabcとカレー"),
    ]
    texts = [(10 * i, f"前文{t}。後文") for i, t in items] + [
        (21, "它流经多少个省份？ 中国最长的河流是哪一条"),
        (50, "中国最高的山在哪里？水は冷たい。"),
    ]
    found = contaminated(docs(spark, texts), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(10, 1), (20, 2), (30, 3), (40, 4), (21, 2)}
    assert {r.item_id: r.item_tokens for r in found}[2] == 19


def test_whole_reordered_and_partial_passages(spark):
    rng = random.Random(5)
    item = words(rng, 40, 10_000).split()
    def other():
        return words(rng, 60, 10_000)

    texts = [
        (1, f"{other()}. {' '.join(item).upper()}, {other()}"),
        (2, f"{' '.join(item[20:])} {other()} {' '.join(item[:20])}"),
        (3, f"{other()} {' '.join(item[:12])} {other()}"),
        (4, other()),
        (5, "; ".join(item[i] for i in range(40))),
        (6, " ".join(x for i, w in enumerate(item) for x in ([w, "x"] if i % 4 == 3 else [w]))),
    ]
    bench = spark.createDataFrame([(7, " ".join(item)), (8, other())], ITEMS)
    got = {(r.doc_id, r.item_id): r for r in contaminated(docs(spark, texts), bench).collect()}
    assert sorted(got) == [(1, 7), (2, 7), (5, 7)]
    assert got[2, 7].coverage == 1.0 and len(got[2, 7].tiles) == 2
    assert [(t.doc_token, t.item_token, t.length) for t in got[1, 7].tiles] == [(60, 0, 40)]
    some = contaminated(docs(spark, texts), bench, coverage=0.3).collect()
    assert sorted(r.doc_id for r in some) == [1, 2, 3, 5]


def test_nulls_short_items_repeats_and_clashing_names(spark):
    passage = "one two three four five six seven"
    rows = [(1, passage), (1, passage), (1, passage + " and more"), (None, passage), (2, None), (3, ""), (4, "one two")]
    frame = clashing(spark, rows)
    bench = spark.createDataFrame(
        [(None, None, 1), (1, "", 1), (2, "one two", 1), (3, passage, 1), (3, passage, 1), (None, passage, 1)],
        ITEMS + ", _hash int",
    )
    got = sorted((r.doc_id or 0, r.item_id or 0) for r in contaminated(frame, bench).collect())
    assert got == [(0, 0), (0, 3), (1, 0), (1, 0), (1, 3), (1, 3)]
    left = clean(frame, bench)
    assert left.columns == frame.columns
    assert sorted((r.doc_id, r.text or "") for r in left.collect()) == [(2, ""), (3, ""), (4, "one two")]


def test_empty_tables_and_very_long_text(spark):
    none = spark.createDataFrame([], ITEMS)
    frame = docs(spark, ["some words that are here now"])
    assert contaminated(empty(spark), none).collect() == []
    assert clean(frame, none).count() == 1
    assert clean(empty(spark), spark.createDataFrame([(1, "some words that are here now")], ITEMS)).count() == 0
    rng = random.Random(3)
    item = words(rng, 30, 10_000)
    long = words(rng, 200_000, 10_000) + " " + item
    bench = spark.createDataFrame([(1, item)], ITEMS)
    assert [r.coverage for r in contaminated(docs(spark, [long]), bench).collect()] == [1.0]


def test_passage_repeated_very_often(spark):
    passage = "alpha beta gamma delta epsilon zeta"
    frame = docs(spark, [(1, " . ".join([passage] * 3000))])
    got = contaminated(frame, spark.createDataFrame([(1, passage)], ITEMS)).first()
    assert (got.tiled_tokens, got.item_tokens) == (6, 6)


def test_long_regular_document_and_item(spark):
    """Every other position matches every other one: millions of pairs, of which only stretches are kept."""
    frame = docs(spark, [(1, "a b " * 20_000), (2, "b a " * 70), (3, "a c " * 100)])
    bench = spark.createDataFrame([(1, "a b " * 60), (2, "x y z u v w")], ITEMS)
    begin = time.monotonic()
    got = {r.doc_id: r for r in contaminated(frame, bench).collect()}
    assert time.monotonic() - begin < 60
    assert {d: (r.tiled_tokens, r.coverage) for d, r in got.items()} == {1: (120, 1.0), 2: (120, 1.0)}
    assert [(t.doc_token, t.item_token, t.length) for t in got[1].tiles] == [(0, 0, 120)]


@pytest.mark.parametrize("seed", range(4))
def test_pairs_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    texts = [words(rng, rng.randrange(5, 60), 3) for _ in range(12)]
    items = [words(rng, rng.randrange(3, 25), 3) for _ in range(6)]
    bench = spark.createDataFrame(list(enumerate(items)), ITEMS)
    want = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            tiles_ = brute_tiles(text.split(), item.split(), 5)
            marked = sum(n for _, _, n in tiles_)
            if tiles_ and marked / len(item.split()) >= 0.6:
                want[d, i] = (marked, [tuple(t) for t in tiles_])
    got = {(r.doc_id, r.item_id): (r.tiled_tokens, [tuple(t) for t in r.tiles]) for r in contaminated(docs(spark, texts), bench).collect()}
    assert got == want and want
