import random
import zlib
from array import array

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cases import SF, clashing, docs, empty, words
from gaugeworks.llm import token_orc
from gaugeworks.llm.common import Work
from gaugeworks.llm.queries import op1_token_orc

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "\n\t", "Hello, World.", "it's we'll THEY'RE don't.", "a.b,c..d,,", "...", ".,", "x.", "É.", "é́.", "É,",
    "<|endoftext|>", "<|ENDOFTEXT|>", "x<|endoftext|>y.", "<|startoftext|>.", "İstanbul ΣΑΣ. ς", "naïve café x",
    "١٢٣ ½ ²", "日本語、テスト。", "á ́b .́", "\x0b\x0cx\x1cy\x85z", "KK. Å.", "1.", "a1. 2,", "😀😀.", "ß.", "ﬁ.",
    # Capitals that compose with their mark in lower case only.
    "T\u0308", "J\u030c", "H\u0331", "W\u030a.", "Y\u030a", "The T\u0308AJ\u030cT\u0323\u0308 t\u0308 AND A\u0308.", "T\u0344",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def brute(tokenizer, rows):
    start, out = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(array("I", ids).tobytes())))
        start += len(ids)
    return out


def indexed(spark, frame, name):
    work = Work(spark, name)
    token_orc.write(frame, f"{work.path}/orc", PATH, 2)
    rows = work.stage(token_orc.index(spark, f"{work.path}/orc"), "index")
    return token_orc.with_starts(rows), f"{work.path}/orc"


def as_rows(frame):
    return sorted(map(tuple, frame.collect()), key=lambda r: r[1])


@pytest.mark.parametrize("known", [4, 100_000])
def test_word_by_word_equals_whole_texts(tokenizer, known):
    import pyarrow as pa

    rng = random.Random(known)
    plain = [t for t in ODD if "<|" not in t]
    both = ([*own, *("  ".join(rng.choices(own, k=rng.randrange(8))) for _ in range(200))] for own in (plain, ODD))
    encoder = token_orc.WordEncoder(PATH, known)
    for texts in (x for x in both for _ in range(2)):
        values, sizes = encoder.texts(pa.array(texts))
        at = 0
        for text, n in zip(texts, sizes.tolist(), strict=True):
            assert values[at : at + n].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
            at += n


def test_index_equals_whole_encoding(spark, tokenizer):
    rng = random.Random(1)
    rows = [(i * 3 - 50, words(rng, rng.randrange(60))) for i in range(200)] + [(10_000 + i, t) for i, t in enumerate(ODD)]
    got, _ = indexed(spark, docs(spark, rows).repartition(5), "t")
    assert as_rows(got) == brute(tokenizer, rows)


def test_nulls_repeats_and_clashing_names(spark, tokenizer):
    rows = [(2, None), (2, "b"), (2, "a"), (2, "a"), (None, "z"), (None, None), (1, "y")]
    got, path = indexed(spark, clashing(spark, rows), "t")
    assert as_rows(got) == brute(tokenizer, rows)
    ids = token_orc.read(spark, path).where("doc_id = 1").first().ids
    assert ids == [*tokenizer.encode("y", add_special_tokens=False).ids, 2]


def test_empty_table_and_very_long_text(spark, tokenizer):
    assert indexed(spark, empty(spark), "t")[0].collect() == []
    rows = [(1, words(random.Random(1), 400_000)), (2, "x")]
    assert as_rows(indexed(spark, docs(spark, rows), "t")[0]) == brute(tokenizer, rows)


def test_files_are_ordered_and_filters_are_pushed_down(spark):
    rng = random.Random(3)
    frame = docs(spark, [(i, words(rng, 50)) for i in range(4000)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _, path = indexed(spark, frame, "t")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = (
        token_orc.read(spark, path)
        .groupBy(F.col("_metadata.file_name").alias("file"))
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .orderBy("file")
        .collect()
    )
    assert len(files) > 1 and all(a.high < b.low for a, b in zip(files, files[1:]))
    one = token_orc.read(spark, path).where("doc_id = 1234")
    assert "EqualTo(doc_id,1234)" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1


@pytest.mark.skipif(not SF.exists(), reason="test tables are not here")
def test_query_on_the_test_table(spark, tokenizer):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert as_rows(op1_token_orc(spark, str(SF))) == brute(tokenizer, rows)
