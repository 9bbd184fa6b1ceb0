"""Removal of byte strings that occur more than once, by suffix sorting with a difference cover.

What is sought are all positions at which a string of ``length`` bytes begins that also begins
elsewhere. Sorting every suffix of a corpus in one recursion would move tens of bytes per byte of
text through several shuffles. So suffixes are first brought together by content:

1. Each string of ``length`` bytes is represented by the least hash among its grams of a quarter of
   that length. Equal strings have the same one. Neighbouring strings mostly share it, so a text falls
   into runs of strings with one representative, about 150 strings each.
2. Runs are counted by representative. One that is met once holds nothing repeated and ends here
   (unless the text repeats itself within one run, which its representative shows).
   Where all runs of a representative hold the same bytes (copies, the inside of shared passages),
   all their strings are repeated, however many there are, and no text is moved.
3. For the rest, the few runs at the edges of shared passages and around edits, each distinct run's
   bytes are fetched once. Those of a representative come to one task, are suffix-sorted by the
   difference-cover algorithm, and adjacent suffixes are compared over ``length`` bytes.
   Representatives whose distinct runs have more bytes than a task may sort are dealt out by string.

In step 3 whole strings are compared. Copies, the inside of passages (step 2) and strings that are dealt
out are told apart by hashes alone, of 64 + 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import Work, binary_bytes, row_key, runs, slices, utf8
from gaugeworks.llm.suffix_array import suffix_array

LENGTH = 400
#: Bytes whose runs are sought together, which takes some 75 bytes a byte.
SEGMENT_BYTES = 1 << 19
#: Bytes of several representatives that are suffix-sorted together, which takes some 45 bytes a byte.
SORT_BYTES = 1 << 20
#: Bytes of one representative's distinct runs that one task sorts.
GROUP_BYTES = 1 << 20
#: Bytes that are compared together.
COMPARED_BYTES = 1 << 20
#: Strings that are hashed together.
STRINGS = 1 << 16
ODD = 0x9E3779B97F4A7C15
ROW, RUN = ["_k1", "_k2"], ["key", "ctx"]


@cache
def _powers(n: int):
    """Powers of an odd number and of its inverse, modulo 2^64."""
    import numpy as np

    def series(x: int):
        factors = np.full(n, x, np.uint64)
        factors[:1] = 1
        return np.multiply.accumulate(factors)

    return series(ODD), series(pow(ODD, -1, 1 << 64))


def gram_hashes(data, gram: int):
    """A 64-bit hash of every ``gram`` bytes."""
    import numpy as np

    step = max(STRINGS, gram)
    power, inverse = _powers(step + gram)
    hashes = np.empty(max(0, len(data) - gram + 1), np.uint64)
    for at in range(0, len(hashes), step):
        h, part = hashes[at : at + step], data[at : at + step + gram - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[: len(part)], out=sums[1:])
        np.multiply(sums[gram:] - sums[:-gram], inverse[: len(h)], out=h)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return hashes


def string_runs(data, offsets, length: int = LENGTH):
    """Runs of neighbouring strings with one representative: index of the text, first string,
    number of strings, representative, and whether that is the hash of several of the run's grams.
    Only then can a run repeat a string within itself. ``data`` holds the texts that begin at
    ``offsets``."""
    import numpy as np

    gram = max(1, length // 4)
    width = length - gram + 1  # grams in a string
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none.astype(bool)
    grams = gram_hashes(data, gram)
    least = grams
    size = 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if width > size:
        least = np.minimum(least[: len(least) - (width - size)], least[width - size :])
    # Strings that lie in one text.
    count = np.maximum(np.diff(offsets) - length + 1, 0)
    at = runs(offsets[:-1], count)
    text = np.repeat(np.arange(len(count)), count)
    key = least[at]
    begins = np.ones(len(at), bool)
    begins[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(begins)
    sizes = np.diff(np.append(first, len(at)))
    own, key = at[first], key[first]
    spans = sizes + width - 1
    same = grams[runs(own, spans)] == np.repeat(key, spans)
    several = np.add.reduceat(same, np.cumsum(spans) - spans, dtype=np.int64) > 1 if len(own) else own > 0
    return text[first], own - offsets[text[first]], sizes, key.view(np.int64), several


def _segments(n: int, length: int) -> list[tuple[int, int]]:
    """A text's parts of bounded size; every string lies in just one of them."""
    step = SEGMENT_BYTES
    return [(b, min(n, b + step + length - 1)) for b in range(0, max(n - length + 1, 1), step)]


def _runs(docs: DataFrame, text: str, doc: str, length: int) -> DataFrame:
    """``key`` (representative), ``ctx`` (hash of the run's bytes), the text's row key, ``low`` (first
    string), ``n`` (strings) and ``several`` (1 if the run may repeat a string within itself)."""
    import numpy as np

    names = ["key", "ctx", "_k1", "_k2", "low", "n", "several"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        for batch in slices(batches, "_text", SEGMENT_BYTES):
            data, offsets = binary_bytes(batch.column(2))
            view = memoryview(data)
            whole = len(data) <= 2 * SEGMENT_BYTES
            parts = [(0, data, offsets)] if whole else [
                (b, data[b:e], np.array([0, e - b], np.int64)) for b, e in _segments(len(data), length)
            ]
            for begin, part, at in parts:  # a batch beyond the limit is a single text
                text_, low, n, key, several = string_runs(part, at, length)
                low = low + begin
                where = (offsets[text_] + low).tolist()
                ends = (np.array(where, np.int64) + n + length - 1).tolist()
                ctx = np.array([xxh3_64_intdigest(view[a:b]) for a, b in zip(where, ends, strict=True)], np.uint64)
                own = [batch.column(i).take(pa.array(text_)) for i in (0, 1)]
                rest = [pa.array(x.astype(np.int64)) for x in (low, n, several)]
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ctx.view(np.int64)), *own, *rest], names)

    frame = docs.select(*row_key(doc, text), utf8(text).alias("_text"))
    return frame.where(F.octet_length("_text") >= length).mapInArrow(run, ", ".join(f"{c} long" for c in names))


def repeated_strings(data, begins, counts, copied, length: int = LENGTH):
    """Which strings of several distinct runs occur more than once, as a mask over all strings of all
    runs. Runs begin at ``begins`` in ``data`` and have ``counts`` strings; those of ``copied`` runs
    are repeated anyway."""
    import numpy as np

    order = suffix_array(data)
    at = runs(begins, counts)
    found = np.repeat(copied, counts)
    place = np.full(len(data), -1, np.int64)
    place[at] = np.arange(len(at))
    order = order[place[order] >= 0]
    # Suffixes in order: strings are equal to a neighbour or to none. Hashes say which are worth
    # comparing byte by byte.
    h = gram_hashes(data, length)
    likely = np.flatnonzero(h[order[1:]] == h[order[:-1]])
    span = np.arange(length)
    for some in np.array_split(likely, len(likely) * length // COMPARED_BYTES + 1):
        a, b = order[some], order[some + 1]
        equal = (data[a[:, None] + span] == data[b[:, None] + span]).all(axis=1)
        found[place[a[equal]]] = True
        found[place[b[equal]]] = True
    return found


def _spans(mask):
    """Begin and end of each stretch of true values."""
    import numpy as np

    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edges[::2], edges[1::2]


def sorting_groups(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[list[tuple]]:
    """Rows (``key``, ``ctx``, ``copied``, ``bytes``, in order of the first two) that are sorted together:
    all of one representative, and as many representatives as have ``limit`` bytes together."""

    def distinct():
        last = None
        for batch in batches:
            for at, row in enumerate(zip(*[c.to_pylist() for c in batch.columns[:3]], strict=True)):
                if row[:2] != last:  # else the same run, fetched from equal rows
                    yield (*row, batch.column(3)[at].as_py())
                last = row[:2]

    held, size = [], 0
    for _, rows in groupby(distinct(), key=lambda row: row[0]):
        own = list(rows)
        more = sum(len(row[3]) for row in own)
        if held and size + more > limit:
            yield held
            held, size = [], 0
        held += own
        size += more
    if held:
        yield held


def _sorted_marks(contexts: DataFrame, length: int) -> DataFrame:
    """Per distinct run of ``contexts`` (``key``, ``ctx``, ``copied``, ``bytes``) the stretches of its
    strings that are repeated: ``key``, ``ctx``, ``begin``, ``end``."""
    import numpy as np

    names = ["key", "ctx", "begin", "end"]

    def marks(rows):
        texts = [row[3] for row in rows]
        sizes = np.array([len(t) for t in texts], np.int64)
        begins, counts = np.cumsum(sizes) - sizes, sizes - length + 1
        copied = np.array([row[2] for row in rows], bool)
        mask = repeated_strings(np.frombuffer(b"".join(texts), np.uint8), begins, counts, copied, length)
        key, ctx, low, high = [], [], [], []
        first = np.cumsum(counts) - counts
        for row, a, n in zip(rows, first.tolist(), counts.tolist(), strict=True):
            b, e = _spans(mask[a : a + n])
            key += [row[0]] * len(b)
            ctx += [row[1]] * len(b)
            low += b.tolist()
            high += e.tolist()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (key, ctx, low, high)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sorting_groups(batches, SORT_BYTES):
            yield marks(rows)

    # Sorting takes far longer than moving, so tasks are sized by what they sort.
    size = contexts.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    parts = 1 + size // (4 * SORT_BYTES)
    dealt = contexts.repartition(parts, "key").sortWithinPartitions(*RUN)
    return dealt.select(*RUN, "copied", "bytes").mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _dealt_marks(contexts: DataFrame, length: int, work: Work) -> DataFrame:
    """The same for representatives with many bytes: their strings are dealt out by 128 bits of hash and
    counted. A string that occurs twice within its run is repeated anyway, so each run brings just one
    row for each of its different strings, however long and regular it is."""
    import numpy as np

    names = ["key", "ctx", "begin", "end", "h1", "h2", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            for key, ctx, copied, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                view, n = memoryview(text), len(text) - length + 1
                h = np.empty((n, 2), np.int64)
                for at in range(0, n, STRINGS):
                    some = b"".join(xxh3_128_digest(view[i : i + length]) for i in range(at, min(at + STRINGS, n)))
                    h[at : at + STRINGS] = np.frombuffer(some, np.int64).reshape(-1, 2)
                order = np.lexsort((h[:, 1], h[:, 0]))
                h = h[order]
                first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]).any(axis=1)))
                times = np.diff(np.append(first, n))
                twice = np.zeros(n, bool)
                twice[order] = np.repeat((times > 1) | copied, times)
                b, e = _spans(twice)
                # Stretches that are repeated anyway have no hash.
                yield _rows([np.full(len(b), key), np.full(len(b), ctx), b, e, None, None, np.full(len(b), 2)])
                for at in range(0, len(first), STRINGS):
                    some = slice(at, at + STRINGS)
                    begin, size = order[first[some]], len(first[some])
                    yield _rows(
                        [np.full(size, key), np.full(size, ctx), begin, begin + 1, *h[first[some]].T, times[some] + int(copied)]
                    )

    def _rows(columns) -> pa.RecordBatch:
        size = len(columns[0])
        given = [pa.nulls(size, pa.int64()) if c is None else pa.array(np.ascontiguousarray(c, np.int64)) for c in columns]
        return pa.RecordBatch.from_arrays(given, names)

    rows = contexts.dropDuplicates(RUN).select(*RUN, "copied", "bytes")
    strings = work.stage(rows.mapInArrow(run, ", ".join(f"{c} long" for c in names)), "strings")
    often = strings.where("h1 is not null").groupBy("h1", "h2").agg(F.sum("times").alias("times"))
    often = work.stage(often.where("times > 1").select("h1", "h2"), "often")
    met = strings.join(often.hint("merge"), ["h1", "h2"])
    return met.unionByName(strings.where("h1 is null"), allowMissingColumns=True).select(*RUN, "begin", "end")


def repeated_spans(docs: DataFrame, length: int = LENGTH, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """Per text with something repeated: its ``row_key`` and ``spans``, structs of ``begin`` and
    ``end`` in bytes that cover all its strings of ``length`` bytes which begin elsewhere too, in the
    same text or in another. Spans may overlap. Repeated rows are copies of each other.

    Null texts are empty. Texts shorter than ``length`` have nothing repeated. Null ids make no
    difference, further columns are ignored, an empty table gives no rows.
    """
    if length < 4:
        raise ValueError("length must be 4 or more")
    work = Work(docs.sparkSession, "repeats")
    all_runs = work.stage(_runs(docs, text, doc, length), "runs")
    again = all_runs.groupBy("key").agg(
        F.count(F.lit(1)).alias("times"),
        (F.min("ctx") != F.max("ctx")).alias("differ"),
        (F.max("several") > 0).alias("several"),
    )
    again = again.where("times > 1 or several").select("key", F.expr("differ or several").alias("mixed"))
    again = work.stage(again, "again")
    hits = work.stage(all_runs.drop("several").join(again.hint("merge"), "key"), "hits")

    # Distinct runs of representatives that have several: one occurrence of each gives the bytes.
    mixed = (
        hits.where("mixed")
        .groupBy(*RUN)
        .agg((F.count(F.lit(1)) > 1).alias("copied"), F.min(F.struct(*ROW, "low", "n")).alias("at"))
    )
    mixed = work.stage(mixed, "mixed")
    size = F.sum(F.col("at.n") + (length - 1))
    sizes = mixed.groupBy("key").agg((size > GROUP_BYTES).alias("many"))
    sizes = work.stage(sizes, "sizes")
    wanted = (
        mixed.join(sizes.hint("merge"), "key")
        .groupBy("at._k1", "at._k2")
        .agg(F.collect_list(F.struct(*RUN, "copied", "many", "at.low", "at.n")).alias("wanted"))
    )
    wanted = work.stage(wanted, "wanted")
    contexts = work.stage(_fetched(docs, wanted, text, doc, length), "contexts")
    marks = _sorted_marks(contexts.where("not many"), length)
    marks = work.stage(marks.unionByName(_dealt_marks(contexts.where("many"), length, work)), "marks")

    whole = hits.where("not mixed").select(*ROW, F.col("low").alias("begin"), (F.col("low") + F.col("n")).alias("end"))
    part = hits.where("mixed").join(marks.hint("merge"), RUN)
    part = part.select(*ROW, (F.col("low") + F.col("begin")).alias("begin"), (F.col("low") + F.col("end")).alias("end"))
    # From begins of strings to the bytes that they cover.
    spans = whole.unionByName(part).groupBy(*ROW).agg(
        F.collect_list(F.struct("begin", (F.col("end") + (length - 1)).alias("end"))).alias("spans")
    )
    spans = work.stage(spans, "spans")
    work.drop(*[name for name in work.paths if name != "spans"])
    return spans


def _fetched(docs: DataFrame, wanted: DataFrame, text: str, doc: str, length: int) -> DataFrame:
    """The bytes of the wanted runs: ``key``, ``ctx``, ``copied``, ``many``, ``bytes``."""
    names = ["key", "ctx", "copied", "many", "bytes"]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                data = memoryview(batch.column(0)[n].as_buffer())
                runs_ = batch.column(1)[n].as_py()
                for at in range(0, len(runs_), 4096):
                    rows = [
                        {c: r[c] for c in names[:4]} | {"bytes": bytes(data[r["low"] : r["low"] + r["n"] + length - 1])}
                        for r in runs_[at : at + 4096]
                    ]
                    yield pa.RecordBatch.from_pylist(rows, schema)

    keyed = docs.select(*row_key(doc, text), utf8(text).alias("_text"))
    found = keyed.join(wanted.hint("merge"), ROW).select("_text", "wanted")
    return found.mapInArrow(run, "key long, ctx long, copied boolean, many boolean, bytes binary")


def union_of(begins, ends):
    """Maximal stretches covered by spans that overlap or touch."""
    import numpy as np

    order = np.argsort(begins, kind="stable")
    begins, reach = begins[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(begins), bool)
    new[1:] = begins[1:] > reach[:-1]
    first = np.flatnonzero(new)
    return begins[first], reach[np.append(first[1:], len(begins)) - 1]


def remove_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: ``doc_id`` (a long), ``kept``, the remaining bytes, and ``removed``, the
    maximal removed stretches as structs of ``begin`` and ``end``. See ``repeated_spans``."""
    spans = repeated_spans(docs, length, text, doc)
    stretch = pa.struct([("begin", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            kept, removed = [], []
            for n in range(batch.num_rows):
                data, found = batch.column(1)[n].as_py(), batch.column(2)[n]
                pieces, gone, last = [], [], 0
                if found.is_valid:
                    both = found.values
                    begins, ends = union_of(np.asarray(both.field(0)), np.asarray(both.field(1)))
                    for b, e in zip(begins.tolist(), ends.tolist(), strict=True):
                        pieces.append(data[last:b])
                        gone.append({"begin": b, "end": e})
                        last = e
                pieces.append(data[last:])
                kept.append(b"".join(pieces))
                removed.append(gone)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.binary()), pa.array(removed, pa.list_(stretch))],
                ["doc_id", "kept", "removed"],
            )

    keyed = docs.select(*row_key(doc, text), F.col(doc).cast("long").alias("doc_id"), utf8(text).alias("_text"))
    joined = keyed.join(spans.hint("merge"), ROW, "left").select("doc_id", "_text", "spans")
    return joined.mapInArrow(run, "doc_id long, kept binary, removed array<struct<begin:long,end:long>>")


def n_removed(removed: str = "removed") -> Column:
    return F.aggregate(removed, F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["begin"])
