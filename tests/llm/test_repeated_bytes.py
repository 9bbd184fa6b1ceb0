import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cases import SF, clashing, docs, empty, words
from gaugeworks.llm import repeated_bytes
from gaugeworks.llm.queries import op4_repeated_bytes
from gaugeworks.llm.repeated_bytes import remove_repeats, union_of
from gaugeworks.llm.suffix_array import suffix_array


@pytest.mark.parametrize("seed", range(200))
def test_suffix_array_equals_sorting(seed):
    rng = random.Random(seed)
    values = np.array([rng.randrange(rng.choice([1, 2, 3, 300])) for _ in range(rng.randrange(60))], np.int64)
    want = sorted(range(len(values)), key=lambda i: values[i:].tolist())
    assert suffix_array(values).tolist() == want


@pytest.mark.parametrize("text", ["a" * 500, "ab" * 300, "abc" * 200 + "x", ""])
def test_suffix_array_of_repetitions(text):
    values = np.frombuffer(text.encode(), np.uint8)
    want = sorted(range(len(text)), key=lambda i: text[i:])
    assert suffix_array(values).tolist() == want


def brute(texts, length):
    """(id, kept bytes, removed spans) in any order."""
    data = [(i, (t or "").encode()) for i, t in texts]
    seen = Counter(b[p : p + length] for _, b in data for p in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        spans, p = [], 0
        while (p := gone.find(1, p)) >= 0:
            end = gone.find(0, p) if 0 in gone[p:] else len(b)
            spans.append((p, end))
            p = end
        out.append((i, bytes(x for x, g in zip(b, gone, strict=True) if not g), spans))
    return sorted(out, key=repr)


def got(frame, length):
    rows = remove_repeats(frame, length).collect()
    return sorted(((r.doc_id, bytes(r.kept), [(s.begin, s.end) for s in r.removed]) for r in rows), key=repr)


def passages(seed, n=60):
    rng = random.Random(seed)
    shared = [words(rng, rng.randrange(5, 80), 5000) for _ in range(6)]
    texts = []
    for i in range(n):
        parts = [words(rng, rng.randrange(40), 5000) for _ in range(rng.randrange(1, 4))]
        for _ in range(rng.randrange(3)):
            own = list(rng.choice(shared))
            if rng.random() < 0.3:
                own[rng.randrange(len(own))] = "é"
            parts.insert(rng.randrange(len(parts) + 1), "".join(own)[rng.randrange(9) :])
        texts.append((i, " ".join(parts)))
    texts.append((n, "tick " * 200 + "tock"))
    texts.append((n + 1, texts[3][1]))
    return texts


@pytest.mark.parametrize("length", [20, 64, 150])
@pytest.mark.parametrize("most", [1, 2000, 1 << 20])
def test_equals_brute_force(spark, monkeypatch, length, most):
    """Also with representatives that are dealt out by string."""
    monkeypatch.setattr(repeated_bytes, "GROUP_BYTES", most)
    monkeypatch.setattr(repeated_bytes, "STRINGS", 64)
    texts = passages(length)
    assert got(docs(spark, texts), length) == brute(texts, length)


def test_texts_longer_than_a_segment(spark, monkeypatch):
    monkeypatch.setattr(repeated_bytes, "SEGMENT_BYTES", 300)
    texts = passages(7, 20)
    assert got(docs(spark, texts), 40) == brute(texts, 40)


def test_self_repetition_alone(spark):
    texts = [(1, "abcdefghij" * 30), (2, "x" * 100), (3, "once only, nothing here is repeated at all")]
    assert got(docs(spark, texts), 16) == brute(texts, 16)


def test_regular_texts_are_dealt_out(spark):
    """Long texts of one byte or two have one representative, far more of them than a task sorts."""
    rows = [(i, unit * (300_000 // len(unit) + i)) for i, unit in enumerate(["a"] * 6 + ["ab"] * 4)]
    rows += [(90, "c" * 20), (91, "cd" * 11), (92, "a" * 399), (93, "b" + "a" * 400)]
    found = {r.doc_id: (bytes(r.kept), [(s.begin, s.end) for s in r.removed]) for r in remove_repeats(docs(spark, rows)).collect()}
    for i, text in rows:
        if i < 90:
            assert found[i] == (b"", [(0, len(text))])
        elif i == 93:
            assert found[i] == (b"b", [(1, 401)])
        else:
            assert found[i] == (text.encode(), [])


def test_nulls_repeats_and_clashing_names(spark):
    text = "a passage of more than twenty bytes"
    rows = [(1, None), (2, ""), (3, text), (3, text), (None, "x " + text), (None, None), (4, "short")]
    assert got(clashing(spark, rows), 20) == brute(rows, 20)
    single = [(3, text), (4, "another one of more than twenty")]
    assert got(clashing(spark, single), 20) == brute(single, 20)


def test_empty_table_and_one_passage_in_every_document(spark):
    assert got(empty(spark), 400) == []
    rng = random.Random(1)
    passage = words(rng, 90, 5000)
    texts = [(i, f"{words(rng, 30, 5000)} {passage} {words(rng, 30, 5000)}") for i in range(150)]
    assert got(docs(spark, texts), 400) == brute(texts, 400)


def peak(function, *given):
    """Bytes that a call takes at most, with what it leaves behind."""
    tracemalloc.start()
    function(*given)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most


def test_memory_of_one_sort_and_of_one_segment():
    """Two tasks share an executor with its heap."""
    rng = random.Random(5)
    repeated_bytes._powers.cache_clear()
    texts = [words(rng, 400, 5000).encode()[:2000] for _ in range(repeated_bytes.SEGMENT_BYTES // 2000)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    assert peak(repeated_bytes.string_runs, data, offsets) < 64 << 20
    # Runs of 151 strings, ten each that differ in one byte, as many as are sorted together.
    rows = []
    for text in texts[: repeated_bytes.SORT_BYTES // 5500]:
        for _ in range(10):
            own = bytearray(text[:550])
            own[rng.randrange(550)] = 33
            rows.append(bytes(own))
    data, n = np.frombuffer(b"".join(rows), np.uint8), len(rows)
    given = data, np.arange(n) * 550, np.full(n, 151), np.zeros(n, bool)
    assert peak(repeated_bytes.repeated_strings, *given) < 64 << 20


def test_gram_hashes_do_not_depend_on_blocks(monkeypatch):
    rng = np.random.default_rng(3)
    data = rng.integers(0, 3, 2000).astype(np.uint8)
    want = repeated_bytes.gram_hashes(data, 7)
    grams = [data[i : i + 7].tobytes() for i in range(len(data) - 6)]
    assert len(set(zip(grams, want.tolist(), strict=True))) == len(set(grams)) == len(set(want.tolist()))
    monkeypatch.setattr(repeated_bytes, "STRINGS", 64)
    for gram in (7, 100, 2000):
        hashes = repeated_bytes.gram_hashes(data, gram)
        alone = [repeated_bytes.gram_hashes(data[i : i + gram], gram)[0] for i in range(len(data) - gram + 1)]
        assert hashes.tolist() == alone
    assert repeated_bytes.gram_hashes(data, 7).tolist() == want.tolist()
    assert len(repeated_bytes.gram_hashes(data, 2001)) == len(repeated_bytes.gram_hashes(data, 3000)) == 0


def test_no_more_is_sorted_together_than_the_limit_or_one_representative():
    rng = random.Random(9)
    rows = sorted((rng.randrange(60), ctx, ctx % 2 == 0, bytes(rng.randrange(1, 400))) for ctx in range(300))
    twice = [row for row in rows for _ in range(1 + (row[1] % 3 == 0))]
    names = ["key", "ctx", "copied", "bytes"]
    batches = [
        pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in twice[i : i + 7]]) for i in range(0, len(twice), 7)
    ]
    groups = list(repeated_bytes.sorting_groups(iter(batches), 1000))
    assert [row for group in groups for row in group] == rows
    keys = [{row[0] for row in group} for group in groups]
    assert sum(map(len, keys)) == len(set.union(*keys))
    assert any(len(k) > 1 for k in keys)
    assert all(len(k) == 1 or sum(len(row[3]) for row in group) <= 1000 for k, group in zip(keys, groups, strict=True))


def test_union_of_spans():
    b, e = union_of(np.array([5, 0, 7, 20, 3]), np.array([8, 3, 9, 30, 5]))
    assert list(zip(b, e, strict=True)) == [(0, 9), (20, 30)]


@pytest.mark.skipif(not SF.exists(), reason="test tables are not here")
def test_query_on_the_test_table(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    want = {
        i: (len(kept) + sum(e - b for b, e in spans), sum(e - b for b, e in spans), len(spans), hashlib.sha256(kept).hexdigest())
        for i, kept, spans in brute([tuple(r) for r in frame.collect()], 400)
    }
    rows = op4_repeated_bytes(spark, str(SF)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want
    assert all(r.n_kept == r.n_bytes - r.n_removed and r.repeats == (r.n_removed > 0) for r in rows)
    whole = {r.doc_id: len(r.text or "") for r in frame.collect()}
    assert all(r.n_chars == whole[r.doc_id] for r in rows if not r.repeats)
    assert any(n for _, n, _, _ in want.values())
