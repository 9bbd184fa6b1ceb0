import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from cases import SF, clashing, docs, empty
from gaugeworks.llm.oracle import PERIODIC_RUNS
from gaugeworks.llm.periodic_runs import Catcher, find_runs, periodic_runs, periodic_tail
from gaugeworks.llm.queries import QUERIES

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def brute(x):
    """Every maximal run as (start, length, period), by the definition."""
    n, found = len(x), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                # The smallest period comes first.
                if not any(a <= i and i <= a + l and j + q <= a + l and q % p == 0 for (a, l, p) in found):
                    found[(i, j + q - i, q)] = True
            i = j + 1 if j > i else i + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts_of(seed):
    rng = random.Random(seed)
    result = []
    for kind in range(60):
        alphabet = rng.choice([1, 2, 2, 3, 5, 40])
        x = []
        while len(x) < rng.randrange(1, 220):
            if rng.random() < 0.5:
                unit = [rng.randrange(alphabet) for _ in range(rng.randrange(1, 14))]
                size = int(len(unit) * rng.uniform(1, 7))
                x += (unit * 8)[:size]
            else:
                x += [rng.randrange(alphabet) for _ in range(rng.randrange(12))]
        result.append(x)
    return result


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    texts = texts_of(seed)
    found = find_runs(np.array([w for x in texts for w in x], np.int64), [len(x) for x in texts])
    got = [[] for _ in texts]
    for text, start, length, period in zip(*(c.tolist() for c in found), strict=True):
        got[text].append((start, length, period))
    assert got == [brute(x) for x in texts]


@pytest.mark.parametrize("seed", range(3))
def test_words_appended_one_by_one_or_in_parts_give_the_same(seed):
    rng = random.Random(seed)
    x = [w for text in texts_of(seed)[:8] for w in text]
    whole, single, parts = Catcher(), Catcher(), Catcher()
    whole.append(x)
    for w in x:
        single.append([w])
    at = 0
    while at < len(x):
        n = rng.randrange(1, 60)
        parts.append(x[at : at + n])
        at += n
    want = [c.tolist() for c in whole.runs()]
    assert list(zip(want[0], [b - a for a, b in zip(want[0], want[1], strict=True)], want[2], strict=True)) == brute(x)
    for other in (single, parts):
        assert [c.tolist() for c in other.runs()] == want


def test_colliding_hashes_make_no_runs(monkeypatch):
    import gaugeworks.llm.periodic_runs as module

    real = module._doubled
    monkeypatch.setattr(module, "_doubled", lambda h, size: real(h, size) & np.uint64(3))
    for x in texts_of(7)[:20]:
        catcher = Catcher()
        catcher.append(x)
        begins, ends, periods = (c.tolist() for c in catcher.runs())
        assert [(a, b - a, p) for a, b, p in zip(begins, ends, periods, strict=True)] == brute(x)


def test_thue_morse_has_no_runs():
    x = [bin(i).count("1") % 2 for i in range(1 << 14)]
    assert [len(c) for c in find_runs(np.array(x), [len(x)])] == [0] * 4


def answers(spark, rows, tail=None):
    return {
        r.doc_id: (r.n_words, [tuple(x) for x in r.runs], r.collapsed)
        for r in periodic_runs(docs(spark, rows), tail=tail).collect()
    }


def test_texts_equal_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for i, x in enumerate(texts_of(11)):
        text = "".join(f"{rng.choice([' ', '  ', chr(10), chr(9)])}é{w}" for w in x)
        rows.append((i, text + rng.choice(["", " ", "\r\n"])))
    got = answers(spark, rows)
    for i, text in rows:
        words = SPLIT.findall(text)
        assert got[i] == (len(words), brute(words), collapsed(words, brute(words)))


def test_nulls_empty_repeats_and_clashing_names(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a a a a a a"), (4, "a a a a a a"), (None, "a a a a a"), (5, "b")]
    got = periodic_runs(clashing(spark, rows))
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    assert sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()) == [
        (0, 5, [], "a a a a a"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""),
        (4, 6, [(0, 6, 1)], "a"), (4, 6, [(0, 6, 1)], "a"), (5, 1, [], "b"),
    ]
    assert periodic_runs(empty(spark)).collect() == []


def test_very_long_texts(spark):
    rng = random.Random(5)
    unit = [f"u{rng.randrange(10**6)}" for _ in range(50_000)]
    rows = [(1, "x " * 600_000), (2, " ".join(unit * 5)), (3, " ".join(unit[:20_000])), (4, "y" * 3_000_000)]
    got = answers(spark, rows)
    assert got[1] == (600_000, [(0, 600_000, 1)], "x")
    assert got[2] == (250_000, [(0, 250_000, 50_000)], " ".join(unit))
    assert got[3][:2] == (20_000, []) and got[4] == (1, [], "y" * 3_000_000)


def test_tails_are_periodic(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(0, 90)))) for i in range(300)]
    got = answers(spark, rows, periodic_tail)
    planted = 0
    for i, text in rows:
        words = text.split()
        h = zlib.crc32(str(i).encode())
        if h % 10 == 0 and words:
            g = h // 10
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            words = words[:a] + [words[a + (k - a) % p] for k in range(a, len(words))]
            planted += 1
        assert got[i] == (len(words), brute(words), collapsed(words, brute(words)))
    assert planted > 15


@pytest.mark.skipif(not SF.exists(), reason="test tables are not here")
@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, size):
    path = SF.parent / size
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    want = con.sql(PERIODIC_RUNS)
    got = QUERIES["op12_periodic_runs"](spark, str(path))
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)


@pytest.mark.skipif(not SF.exists(), reason="test tables are not here")
def test_query_equals_brute_force(spark):
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, str(SF)).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for doc, text in rows:
        words = SPLIT.findall(text or "")
        change = periodic_tail(doc, len(words))
        if change:
            a, p = change
            words = words[:a] + [words[a + (k - a) % p] for k in range(a, len(words))]
        runs = brute(words)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
        r = got[doc]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
