import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import gaugeworks.llm.phrases as phrases
from cases import CLASHING, empty
from gaugeworks.llm.common import Work
from gaugeworks.llm.phrases import Block, mine


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text or "")):
        yield re.findall(r"[^\x20\x09]+", piece)


def brute(rows, least, top=2000, same=80):
    counts, words = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            words[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    counts[lang][tuple(w[i : i + k])] += 1
    result = []
    for lang, f in counts.items():
        able = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in able.items():
            if any(
                len(q) > len(p) and 100 * b >= same * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in able.items()
            ):
                continue
            cuts = [(2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            result.append((lang, rank, p.decode(), -a, left, right, words[lang], -score))
    return sorted(result)


def table(spark, rows, extra=False):
    if extra:
        flags = [None if k % 2 else "x" for k in range(CLASHING.count(",") + 1)]
        return spark.createDataFrame([(i, t, l, *flags) for i, (t, l) in enumerate(rows)], f"doc_id long, text string, lang string, {CLASHING}")
    return spark.createDataFrame([(i, t, l) for i, (t, l) in enumerate(rows)], "doc_id long, text string, lang string").repartition(3)


def answers(frame, **options):
    return sorted(tuple(r) for r in mine(frame, **options).collect())


def sample(seed, n=120):
    rng = random.Random(seed)
    stock = [" ".join(f"S{rng.randrange(12)}" for _ in range(rng.randrange(3, 9))) for _ in range(8)]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(8)):
            parts.append(rng.choice([*stock, f"é{rng.randrange(9)}", "Ab  ab\tAB", "it's", "…", "w" + str(rng.randrange(30))]))
            parts.append(rng.choice([" ", " ", "\t", ", ", ".", "\n", "\r\n", "\x0b", "; ", "\xa0"]))
        rows.append(("".join(parts), rng.choice(["en", "en", "fr", None, "und"])))
    return rows


@pytest.mark.parametrize("seed, least, top", [(1, 3, 2000), (2, 2, 5), (3, 10, 2000), (4, 1, 2000)])
def test_equals_brute_force(spark, seed, least, top):
    rows = sample(seed)
    assert answers(table(spark, rows), least=least, top=top) == brute(rows, least, top)


def test_a_crowded_field_changes_nothing(spark, monkeypatch):
    rows = sample(5)
    full = spark.sparkContext.broadcast(np.full(1 << (phrases.FIELD_BITS - 3), 255, np.uint8))
    monkeypatch.setattr(phrases, "_field", lambda texts, least, pairs=None: full)
    assert answers(table(spark, rows), least=3) == brute(rows, 3)


def test_long_texts_in_parts(monkeypatch):
    rng = random.Random(6)
    text = "".join(rng.choice(["a", "bb", "c", "é", " ", " ", ".", "\n"]) for _ in range(3000)).encode()
    want, got = Counter(), Counter()

    def count(into, block):
        names = block.spelled.to_pylist()
        for i in range(block.own):
            gram = [names[block.number[i] - 1]]
            while len(gram) < 4 and block.joined[i + len(gram) - 1]:
                gram.append(names[block.number[i + len(gram)] - 1])
            into[tuple(gram)] += 1

    def raw(part):
        return np.frombuffer(part, np.uint8), np.array([0, len(part)])

    count(want, Block(*raw(text)))
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 40)
    for part, limit in phrases._parts(text):
        count(got, Block(*raw(part), limit))
    assert got == want


def test_paths_are_unbranched_and_whole(spark, monkeypatch):
    monkeypatch.setattr(phrases, "PATH_ROW", 7)
    text = " ".join(f"p{i}" for i in range(40))
    rows = [(text, "en")] * 5 + [("p10 p11 p12 p13 q1 q2 q3 q4. x x x x x x x", "en")] * 3
    frame = table(spark, rows).selectExpr("lang", "cast(text as binary) as _text")
    work = Work(spark, "test")
    pairs = phrases._field(frame, 2)
    edges = work.stage(phrases._edges(frame, pairs, phrases._field(frame, 2, pairs)), "edges")
    found = phrases.paths(edges, phrases.levels(edges, work)[3], 2, work).orderBy("path", "part").collect()
    whole = defaultdict(list)
    for r in found:
        assert len(r.words) <= 7 + 3
        whole[r.path] += r.words[3:] if whole[r.path] else r.words
    assert sorted((" ".join(w), n) for w, n in zip(whole.values(), [r.n for r in found if r.part == 0], strict=True)) == sorted([
        (" ".join(f"p{i}" for i in range(13)), 5),
        ("p10 p11 p12 p13", 8),
        (" ".join(f"p{i}" for i in range(11, 40)), 5),
        ("p11 p12 p13 q1 q2 q3 q4", 3),
        ("x x x x", 12),
    ])
    assert answers(table(spark, rows), least=2) == brute(rows, 2)


def test_nulls_empty_repeats_and_clashing_names(spark):
    rows = [(None, "en"), ("", None), (" .,; ", "en"), ("a b a b", None), ("a b a b", None), ("A B", "und"), ("solo", "de")]
    assert answers(table(spark, rows, extra=True), least=2) == brute(rows, 2)
    assert answers(table(spark, rows, extra=True).limit(0)) == [] and mine(empty(spark)).collect() == []
    assert answers(table(spark, rows), least=100) == []


def test_exact_beyond_64_bits(spark):
    known = spark.createDataFrame(
        [("en", "a b", 2, 9 * 10**18), ("en", "a", 1, 9 * 10**18), ("en", "b", 1, 9 * 10**18 + 7)], "lang string, phrase string, size int, n long"
    )
    r = phrases._parts_of(known).collect()[0]
    assert r.score == 2_000_000 * 9 * 10**18 // (18 * 10**18 + 7)


def test_very_long_text_and_one_hot_phrase(spark):
    rows = [("the same words again " * 150_000, "en"), ("u" * 2_000_000, "en"), *[("the same words again", "en")] * 500]
    got = answers(table(spark, rows))
    n, more = 150_000, 500
    # Every three words are part of four that occur as often, but for the ends.
    assert [(r[2], r[3], r[6]) for r in got] == [
        ("the same words again", n + more, 4 * (n + more) + 1),
        ("again the same words", n - 1, 4 * (n + more) + 1),
        ("same words again the", n - 1, 4 * (n + more) + 1),
        ("words again the same", n - 1, 4 * (n + more) + 1),
    ]
