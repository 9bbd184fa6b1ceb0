"""Benchmark decontamination by greedy string tiling.

Tokens are words (runs of letters and digits in lower case), and single characters of scripts that put no
spaces between words. Running Karp-Rabin hashes of
``min_match`` tokens give the seeds. Documents are compared with a bit field of the benchmark's
seeds, whose size is fixed, and only what passes is joined with the seeds themselves. For each pair
of document and item, seeds on one diagonal are chained to maximal matches. The longest match is
marked in both, matches that it overlaps are trimmed, and so on, until no match of ``min_match``
unmarked tokens is left. The share of the item's tokens that are marked does not depend on the order
in which its passages appear in the document.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import Work, row_key, runs, slices, utf8, with_row_key

MIN_MATCH = 5
COVERAGE = 0.6
#: Bits of the field that documents are compared with: 16 MB, whatever the size of the benchmark.
FIELD_BITS = 27
BASE = 0x9E3779B97F4A7C15
#: Characters of scripts without spaces between words: each is a token.
UNSPACED = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}])"
_AGG_BITS = 15  # Spark's bitmaps have 2^15 bits


def rolling_hashes(texts: pa.Array, n: int):
    """Karp-Rabin hashes of all runs of ``n`` tokens of each text: the index of the text, the run's
    first token, its hash, and the number of tokens of each text."""
    import numpy as np
    import pyarrow.compute as pc
    from xxhash import xxh64_intdigest

    bare = pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\p{L}\p{N}]+", " ")
    bare = pc.replace_substring_regex(bare, UNSPACED, r" \1 ")
    split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(bare))
    size = split.value_lengths().to_numpy().astype(np.int64)
    coded = split.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    hashes = np.array([xxh64_intdigest(w.encode()) for w in words], np.uint64)
    word = coded.indices.to_numpy()
    # A text without tokens is split into one empty word.
    blank = np.zeros(len(size), bool)
    if "" in words:
        at = np.cumsum(size) - size
        blank = (size == 1) & (word[np.minimum(at, len(word) - 1)] == words.index(""))
    tokens = np.where(blank, 0, size)
    token = hashes[word]
    first = np.cumsum(size) - size
    count = np.maximum(tokens - n + 1, 0)
    at = runs(first, count)
    text = np.repeat(np.arange(len(size)), count)
    rolled = np.zeros(len(at), np.uint64)
    base = np.uint64(BASE)
    for step in range(n):
        rolled = rolled * base + token[at + step]
    # The field uses the low bits, which a product mixes least.
    rolled ^= rolled >> np.uint64(32)
    return text, at - first[text], rolled, tokens


def _hashed(frame: DataFrame, n: int, field=None) -> DataFrame:
    """``frame`` (``_k1``, ``_k2``, ``_id``, ``_text`` as bytes) as one row per run of ``n`` tokens
    (only those in the broadcast ``field`` of bits, if given), with ``_size``, the text's tokens."""
    import numpy as np

    names = ["_k1", "_k2", "_id", "_pos", "_hash", "_size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            text, pos, rolled, tokens = rolling_hashes(batch.column(3).cast(pa.string()), n)
            if field is not None:
                bits = field.value
                low = rolled & np.uint64((1 << FIELD_BITS) - 1)
                passed = (bits[low >> np.uint64(3)] >> (low & np.uint64(7)).astype(np.uint8)) & 1 == 1
                text, pos, rolled = text[passed], pos[passed], rolled[passed]
            own = [batch.column(i).take(pa.array(text)) for i in range(3)]
            rest = [pos.astype(np.int64), rolled.view(np.int64), tokens[text]]
            yield pa.RecordBatch.from_arrays([*own, *map(pa.array, rest)], names)

    return frame.mapInArrow(run, ", ".join(f"{name} long" for name in names))


def _field(seeds: DataFrame):
    """The bit field of the seeds: at most 4096 rows of 4 KB reach the driver."""
    import numpy as np

    bit = F.col("_hash").bitwiseAND((1 << FIELD_BITS) - 1)
    rows = (
        seeds.groupBy(F.expr(f"cast(shiftright(_hash & {(1 << FIELD_BITS) - 1}, {_AGG_BITS}) as int)").alias("at"))
        .agg(F.bitmap_construct_agg(F.pmod(bit, F.lit(1 << _AGG_BITS))).alias("bits"))
        .collect()
    )
    whole = np.zeros(1 << (FIELD_BITS - 3), np.uint8)
    size = 1 << (_AGG_BITS - 3)
    for row in rows:
        whole[row["at"] * size : (row["at"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return whole


def diagonal_runs(pairs: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """``pairs`` of first tokens, in the document and in the item, of equal runs of tokens, as stretches
    of pairs that follow each other: the first pair and their number."""
    runs_: list[list[int]] = []
    for diagonal, d in sorted((d - i, d) for d, i in set(pairs)):
        if runs_ and runs_[-1][0] - runs_[-1][1] == diagonal and runs_[-1][0] + runs_[-1][2] == d:
            runs_[-1][2] += 1
        else:
            runs_.append([d, d - diagonal, 1])
    return [(d, i, n) for d, i, n in runs_]


def tiles(pairs: list[tuple[int, int]], min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy string tiling of ``pairs``, as in ``diagonal_runs``, of runs of ``min_match`` tokens."""
    return tile_runs(diagonal_runs(pairs), min_match)


def tile_runs(
    stretches: list[tuple[int, int, int]], min_match: int = MIN_MATCH, item_tokens: int | None = None
) -> list[tuple[int, int, int]]:
    """Greedy string tiling from diagonal stretches of seeds. Returns the tiles (document token, item
    token, length), longest first; of equal ones, that first in the document, then that first in the
    item. An item of ``item_tokens`` tokens that has no room for one more ends the search."""
    heap = [(-(n + min_match - 1), d, i) for d, i, n in stretches]
    heapify(heap)
    in_doc: set[int] = set()
    in_item: set[int] = set()
    found = []
    while heap and (item_tokens is None or item_tokens - len(in_item) >= min_match):
        length, d, i = heappop(heap)
        length = -length
        free = [d + k not in in_doc and i + k not in in_item for k in range(length)]
        if all(free):
            found.append((d, i, length))
            in_doc.update(range(d, d + length))
            in_item.update(range(i, i + length))
            continue
        # Trimmed to what is not marked yet; these compete again by their new lengths.
        begin = None
        for k, ok in enumerate([*free, False]):
            if ok and begin is None:
                begin = k
            elif not ok and begin is not None:
                if k - begin >= min_match:
                    heappush(heap, (begin - k, d + begin, i + begin))
                begin = None
    return found


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    min_match: int = MIN_MATCH,
    text: str = "text",
    doc: str = "doc_id",
    item: str = "item_id",
) -> DataFrame:
    """The pairs of document and benchmark item of which at least ``coverage`` of the item's tokens
    are tiled by the document: ``_k1``, ``_k2`` (``row_key`` of the document), ``doc_id``,
    ``item_id``, ``item_tokens``, ``tiled_tokens``, ``coverage`` and ``tiles``, as structs of
    ``doc_token``, ``item_token`` and ``length``.

    Items of fewer than ``min_match`` tokens (null and empty ones too) match nothing, as they cannot
    be told from ordinary prose; neither do such documents. Rows are told apart by id and text:
    repeated rows give one row, and equal ids with different texts one each. Null ids are kept.
    Further columns are ignored. Without documents or items the result is empty.
    """
    spark = docs.sparkSession
    work = Work(spark, "tiling")

    def prepared(frame: DataFrame, key: str) -> DataFrame:
        return frame.select(*row_key(key, text), F.col(key).cast("long").alias("_id"), utf8(text).alias("_text"))

    seeds = work.stage(
        _hashed(prepared(benchmark, item), min_match)
        .distinct()
        .select(
            F.col("_k1").alias("_i1"),
            F.col("_k2").alias("_i2"),
            F.col("_id").alias("_item"),
            F.col("_pos").alias("_ipos"),
            "_hash",
            F.col("_size").alias("_isize"),
        ),
        "seeds",
    )
    field = spark.sparkContext.broadcast(_field(seeds))
    hits = work.stage(_hashed(prepared(docs, doc), min_match, field).drop("_size"), "hits")
    keys = ["_k1", "_k2", "_i1", "_i2"]
    matched = hits.join(seeds.hint("merge"), "_hash")
    # On a diagonal seeds follow each other in the document and in the item. A diagonal has no more of
    # them than the item has tokens, however often the document repeats a passage.
    diagonals = matched.groupBy(*keys, (F.col("_pos") - F.col("_ipos")).alias("diagonal")).agg(
        F.first("_id").alias("doc_id"),
        F.first("_item").alias("item_id"),
        F.first("_isize").alias("item_tokens"),
        F.array_sort(F.collect_set("_ipos")).alias("at"),
    )
    begins = F.filter("at", lambda x, k: (k == 0) | (F.get("at", k - 1) < x - 1))
    ends = F.filter("at", lambda x, k: F.coalesce(F.get("at", k + 1) > x + 1, F.lit(True)))
    stretches = F.transform(
        F.arrays_zip(begins.alias("b"), ends.alias("e")),
        lambda s: F.struct(
            (F.col("diagonal") + s["b"]).alias("_pos"), s["b"].alias("_ipos"), (s["e"] - s["b"] + 1).alias("n")
        ),
    )
    grouped = diagonals.select(*keys, "doc_id", "item_id", "item_tokens", F.size("at").alias("seeds"), stretches.alias("s"))
    grouped = grouped.groupBy(*keys).agg(
        F.first("doc_id").alias("doc_id"),
        F.first("item_id").alias("item_id"),
        F.first("item_tokens").alias("item_tokens"),
        F.sum("seeds").alias("seeds"),
        F.flatten(F.collect_list("s")).alias("stretches"),
    )
    # No more tokens can be tiled than seeds cover: most chance encounters end here.
    able = F.col("seeds") * min_match >= F.col("item_tokens") * coverage
    schema = (
        "_k1 long, _k2 long, doc_id long, item_id long, item_tokens long, tiled_tokens long, "
        "coverage double, tiles array<struct<doc_token:long,item_token:long,length:long>>"
    )
    names = [part.strip().split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                found = tile_runs([(p["_pos"], p["_ipos"], p["n"]) for p in row["stretches"]], min_match, row["item_tokens"])
                marked = sum(length for _, _, length in found)
                share = marked / row["item_tokens"]
                if share >= coverage:
                    rows.append(
                        {
                            **{k: row[k] for k in names[:5]},
                            "tiled_tokens": marked,
                            "coverage": share,
                            "tiles": [
                                {"doc_token": d, "item_token": i, "length": n} for d, i, n in found
                            ],
                        }
                    )
            yield pa.RecordBatch.from_pylist(rows, arrow_schema)

    tile = pa.struct([("doc_token", pa.int64()), ("item_token", pa.int64()), ("length", pa.int64())])
    kinds = [pa.int64()] * 6 + [pa.float64(), pa.list_(tile)]
    arrow_schema = pa.schema(list(zip(names, kinds, strict=True)))
    return grouped.where(able).select(*names[:5], "stretches").mapInArrow(run, schema)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that are in no contaminated pair, unchanged."""
    found = contaminated(docs, benchmark, text=text, doc=doc, **options).select("_k1", "_k2").distinct()
    found = Work(docs.sparkSession, "tiled").stage(found, "documents")
    keyed = with_row_key(docs, doc, text)
    return keyed.join(found.hint("merge"), ["_k1", "_k2"], "left_anti").select("_row.*")
