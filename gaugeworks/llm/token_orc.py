"""Token ids as ORC files in ascending document order.

The texts are range-partitioned by document id and encoded in order, so the files follow each
other and each is sorted. ORC stores the id lists with its integer run-length encoding, a row index
with minima and maxima, and a Bloom filter of the document ids, so that a reader with a filter on
``doc_id`` skips whole files, stripes and row groups, and stripes are read in parallel.

A tokenizer whose words end at white space needs to see each distinct word only once. The texts of a
batch are split at ASCII white space by Arrow, and only words that the task does not know yet go to
the library; ``tests`` compare the result with that of whole texts.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import BATCH_BYTES, runs, slices, utf8

STRIPE_BYTES = 16 << 20
ROWS_PER_INDEX = 1000


#: A word of lower-case Latin letters up to U+00FF is in normal form, and one piece. After a letter, a
#: full stop or comma at the end is a piece of its own.
PLAIN = re.compile("([a-z\u00df-\u00f6\u00f8-\u00ff]+)([.,]?)").fullmatch
#: A capital and what may be a combining mark. Some compose in lower case only, so the library, which
#: composes before it lower-cases, must see the capitals of such texts.
MARKED = r"[A-Z][\x{300}-\x{10FFFF}]"


@cache
def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones of Latin-1 for
    themselves, the others for the following code points from U+0100 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordEncoder:
    """Encodes texts word by word, each distinct word once. Of the words met it remembers the latest,
    at most ``known_words``.

    Right for tokenizers that cut at white space and lower-case first. Special tokens inside a text
    count as such, as they do in a call of the library with default settings.
    """

    def __init__(self, tokenizer_path: str, known_words: int = 500_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.half = known_words // 2
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # The library's own names of the bytes, by its treatment of each.
        self.merge = self.tokenizer.model.tokenize
        self.bytes_as_letters = byte_letters()
        self.marks = {mark: self._encode([mark])[0] for mark in ".,"} | {"": b""}

    def _encode(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [array("i", x.ids).tobytes() for x in found]

    def _word(self, word: str) -> bytes:
        """A word of which it is known that it is normal and one piece: only merges are left."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.bytes_as_letters)
        return array("i", [t.id for t in self.merge(word)]).tobytes()

    def words(self, words: list[str]) -> list[bytes]:
        """The ids of each word as int32 bytes. Words with A-Z are left to the library."""
        if len(self.known) > self.half:
            self.known, self.older = {}, self.known
        known, older, marks = self.known, self.older, self.marks
        found, other = list(map(known.get, words)), []
        for i in [i for i, ids in enumerate(found) if ids is None]:
            word = words[i]
            plain = PLAIN(word)
            core, mark = plain.groups() if plain else (word, "")
            ids = known.get(core) or older.get(core)
            if ids is None:
                if not plain:
                    other.append(i)
                    continue
                ids = self._word(core)
            known[core] = ids
            found[i] = ids + marks[mark] if mark else ids
        if other:
            new = self._encode([words[i] for i in other])
            for i, ids in zip(other, new, strict=True):
                found[i] = known[words[i]] = ids
        return found

    def texts(self, texts: pa.Array):
        """All ids of a string array's texts, and the number of ids of each."""
        import numpy as np
        import pyarrow.compute as pc

        if pc.any(pc.match_substring(texts, "<|")).as_py():
            # Names of special tokens are in lower case only: these texts are left to the library.
            found = self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)
            sizes = np.fromiter((len(x.ids) for x in found), np.int64, len(found))
            return np.concatenate([np.array(x.ids, np.int32) for x in found]), sizes
        # Lower-casing A-Z is part of the encoding, but comes after composing.
        late = pc.match_substring_regex(texts, MARKED)
        split = pc.ascii_split_whitespace(pc.if_else(late, texts, pc.ascii_lower(texts)))
        coded = split.flatten().dictionary_encode()
        ids = self.words(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        table = np.frombuffer(b"".join(ids), np.int32)
        word = coded.indices.to_numpy()
        values = table[runs((np.cumsum(size) - size)[word], size[word])]
        n_words = split.value_lengths().to_numpy()
        up_to = np.concatenate([[0], np.cumsum(size[word])])
        last = np.cumsum(n_words)
        return values, up_to[last] - up_to[last - n_words]


@cache
def encoder(tokenizer_path: str) -> WordEncoder:
    """One for all tasks of a Python worker: loading takes time, and so do the first words."""
    return WordEncoder(tokenizer_path)


def write(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int,
    text: str = "text",
    doc: str = "doc_id",
) -> None:
    """Write ``doc_id``, ``pos`` (row number in the file) and ``ids`` (with ``end_id`` last) of every
    row of ``docs`` to ORC files below ``path``.

    Files are in ascending order of document id, null ids first, and rows with equal ids in the order
    of their texts. Null texts count as empty and have only the end id, as have blank ones. Repeated
    rows are repeated; further columns are left out; an empty table gives no rows.
    """
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), utf8(text).alias("_text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        import numpy as np

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        pos = 0
        for batch in slices(batches, "_text", 2 * BATCH_BYTES):
            values, sizes = encoder(tokenizer_path).texts(batch.column(1).cast(pa.string()))
            ends = np.cumsum(sizes)
            values = np.insert(values, ends, end_id)
            offsets = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            at = pa.array(np.arange(pos, pos + batch.num_rows, dtype=np.int64))
            pos += batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), at, ids], ["doc_id", "pos", "ids"])

    encoded = ordered.mapInArrow(run, "doc_id long, pos long, ids array<int>")
    (
        encoded.write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", str(ROWS_PER_INDEX))
        .option("orc.stripe.size", str(STRIPE_BYTES))
        .orc(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows. Filters on ``doc_id`` are pushed down to files, stripes and row groups."""
    return spark.read.schema("doc_id long, pos long, ids array<int>").orc(path)


def index(spark: SparkSession, path: str) -> DataFrame:
    """Per row of the files: ``doc_id``, ``start`` (number of ids before it in all files),
    ``n_tokens`` and ``ids_crc32``, of the ids as little-endian unsigned 32-bit integers."""
    from pyspark.sql.types import LongType, StructField, StructType

    # Files are numbered in the order of their ranges.
    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")
    rows = read(spark, path).select("doc_id", "pos", "ids", number.alias("file"))
    names = ["doc_id", "pos", "file", "n_tokens", "ids_crc32"]
    schema = StructType([StructField(n, LongType()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            ids = batch.column(2)
            offsets = np.asarray(ids.offsets, np.int64)
            data = memoryview(np.asarray(ids.values, "<u4")).cast("B")
            crc = [
                zlib.crc32(data[4 * a : 4 * b])
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
            ]
            columns = [
                batch.column(0),
                batch.column(1),
                batch.column(3),
                pa.array(np.diff(offsets)),
                pa.array(crc, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, schema)


def with_starts(rows: DataFrame) -> DataFrame:
    """Adds ``start`` to stored rows of ``index``: tokens of earlier files plus those of earlier rows
    in the file. The sum over files sees one row per file, that within files one file at a time."""
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("_in_file"))
    files = files.select("file", F.coalesce(F.sum("_in_file").over(before), F.lit(0)).alias("_base"))
    within = (
        Window.partitionBy("file").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.withColumn("_within", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
        .join(files, "file")
        .select("doc_id", (F.col("_base") + F.col("_within")).alias("start"), "n_tokens", "ids_crc32")
    )
