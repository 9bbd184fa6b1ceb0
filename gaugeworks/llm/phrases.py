"""Phrase mining on a weighted de Bruijn graph of words.

The graph of a language has the three words before and behind each occurrence of four consecutive ones
as its nodes, and the four words as a weighted edge between them. All counts come from the edges:

1. Tasks count the edges of blocks of text, and Spark adds them up. Where a piece ends, an edge leads to
   its end: it stands for the last three, two or one words, and is the correction that shorter counts need.
2. Three words occur as often as flows out of their node, ends included; two words as often as all three
   words that begin with them, or end there; one word likewise.
3. Nodes with one way in and one way out that carry the same flow are compacted: an unbranched path is
   one row, its words and its weight. Four words count what their path does, and so do the three words
   inside a path.
4. Phrases are scored by their parts' counts, and dropped if one word more has nearly the same count. A
   longer phrase that holds a phrase holds also one with one word more, at least as often, so it is
   enough to look at those.

Before that, two fields of fixed size tell what surely occurs too seldom to be in any phrase: pairs of
words, and then threes of them, are counted by hash, and a place with a low count can only hold rare
ones. An edge is cut before the word that makes it rare. That changes no count that is used, and leaves far fewer edges; if the fields are crowded, as with a
very large corpus, there are more edges and the same result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import Work, binary_bytes, release, slices, utf8

#: Words of an edge, and of the longest phrase.
ORDER = 4
LEAST, TOP = 30, 2000
#: Per cent of a phrase's count at which a longer one replaces it.
SAME = 80
SCALE = 2_000_000
NO_LANGUAGE = "und"
#: Bytes of text whose words are counted together.
BLOCK_BYTES = 8 << 20
#: Of a field, 16 MB whatever the size of the corpus.
FIELD_BITS = 27
_AGG_BITS = 15  # Spark's bitmaps have 2^15 bits
#: Edges of a path in one row; longer paths take several.
PATH_ROW = 1000
#: Parts of a language whose best phrases are found on their own first.
PARTS = 64
ENDS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
K1, K2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
WORDS = [f"w{k}" for k in range(1, ORDER + 1)]


@cache
def _tables():
    """By byte: in lower case, whether it ends a word, and whether it ends a piece."""
    import numpy as np

    lower = np.arange(256, dtype=np.uint8)
    lower[ord("A") : ord("Z") + 1] += 32
    end, blank = np.zeros(256, bool), np.zeros(256, bool)
    end[list(ENDS)] = True
    blank[list(BLANKS)] = True
    return lower, end | blank, end


class Block:
    """The words of texts that lie behind each other in ``data``: numbers of equal words (``number``,
    from 1), the words by number (``spelled``, from 0), and whether the next word is in the same piece
    (``joined``). Words from ``own`` on belong to the part of a long text that follows."""

    def __init__(self, data, offsets, limit: int | None = None):
        import numpy as np

        lower, stop, end = _tables()
        data = lower[data]
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = ~stop[data]
        at = np.flatnonzero(inside[1:] != inside[:-1])
        begins, ends = at[::2], at[1::2]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        split = np.unique(cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)])
        if len(split):  # a text's begin cuts a word in two
            begins, ends = np.sort(np.concatenate([begins, split])), np.sort(np.concatenate([ends, split]))
        # A piece ends at a mark or a text's end between a word and the next one.
        marks = np.flatnonzero(end[data])
        piece = np.searchsorted(marks, begins) + np.searchsorted(offsets, begins, "right")
        self.joined = np.zeros(len(begins), bool)
        self.joined[:-1] = piece[:-1] == piece[1:]
        sizes = np.concatenate([[0], np.cumsum(ends - begins)])
        wide = sizes[-1] >= 1 << 31
        words = pa.Array.from_buffers(
            pa.large_binary() if wide else pa.binary(),
            len(begins),
            [None, pa.py_buffer(sizes.astype(np.int64 if wide else np.int32).tobytes()), pa.py_buffer(data[~stop[data]].tobytes())],
        ).dictionary_encode()
        self.number = words.indices.to_numpy() + np.int32(1)
        self.spelled = words.dictionary
        self.own = len(begins) if limit is None else int(np.searchsorted(begins, limit))


def blocks(batches: Iterator[pa.RecordBatch], lang: int = 0, text: int = 1) -> Iterator[tuple[str, Block]]:
    """The texts of a task in blocks of one language. A very long text is cut between words; a part
    then reaches over the first words of the next one, so that all of its words' edges are whole."""
    import numpy as np
    import pyarrow.compute as pc

    held: dict[str, list[pa.RecordBatch]] = {}
    size: dict[str, int] = {}

    def block(name: str) -> Block:
        whole = pa.Table.from_batches(held.pop(name)).combine_chunks().to_batches()[0]
        del size[name]
        return Block(*binary_bytes(whole.column(text)))

    for batch in slices(batches, "_text", BLOCK_BYTES):
        for name in pc.unique(batch.column(lang)).to_pylist():
            part = batch.filter(pc.equal(batch.column(lang), name))
            data, _ = binary_bytes(part.column(text))
            if len(data) > BLOCK_BYTES:
                for piece, limit in _parts(data.tobytes()):
                    yield name, Block(np.frombuffer(piece, np.uint8), np.array([0, len(piece)]), limit)
                continue
            if name in held and size[name] + len(data) > BLOCK_BYTES:
                yield name, block(name)
            held.setdefault(name, []).append(part)
            size[name] = size.get(name, 0) + len(data)
            while sum(size.values()) > 2 * BLOCK_BYTES:  # many languages at once must not add up
                largest = max(size, key=size.get)
                yield largest, block(largest)
    for name in list(held):
        yield name, block(name)


_STOP = re.compile(rb"[\x20\x09.,;:!?\x0a-\x0d]")
_REACH = re.compile(rb"(?:[^\x20\x09.,;:!?\x0a-\x0d]*[\x20\x09.,;:!?\x0a-\x0d]+){0,%d}[^\x20\x09.,;:!?\x0a-\x0d]*" % ORDER)


def _parts(data: bytes) -> Iterator[tuple[bytes, int]]:
    """A long text in parts, each with the place where what belongs to the next part begins."""
    begin = 0
    while begin < len(data):
        found = _STOP.search(data, begin + BLOCK_BYTES)
        end = found.end() if found else len(data)
        yield data[begin : _REACH.match(data, end).end()], end - begin
        begin = end


def _hashes(block: Block, name: str):
    """A hash of each different word, by its number; 0 is none."""
    import numpy as np
    from xxhash import xxh3_64_intdigest

    seed = xxh3_64_intdigest(name.encode())
    return np.array([0, *(xxh3_64_intdigest(w, seed) for w in block.spelled.to_pylist())], np.uint64)


def _place(hashes, k: int):
    """The place in a field of each ``k`` words that follow each other, by the first one."""
    import numpy as np

    mixed = hashes[: max(len(hashes) - k + 1, 0)]
    for at in range(1, k):
        mixed = mixed * np.uint64(K1) + hashes[at : at + len(mixed)]
        mixed = mixed ^ (mixed >> np.uint64(32))
    return ((mixed * np.uint64(K2)) >> np.uint64(64 - FIELD_BITS)).astype(np.int32)


def _known(bits, place):
    """Whether the field has a bit at each place."""
    import numpy as np

    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _pairs(block: Block, hashes, bits):
    """Whether each word and the next one may be in a phrase."""
    may = block.joined.copy()
    may[:-1] &= _known(bits, _place(hashes[block.number], 2))
    may[-1:] = False
    return may


def _field(texts: DataFrame, least: int, pairs=None):
    """A bit for each place of the field that ``least`` or more pairs of words fall on, or three words if
    the field of the pairs is given: at most 4096 rows of 4 KB reach the driver."""
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, block in blocks(batches):
            hashes = _hashes(block, name)
            if pairs is None:
                place = _place(hashes[block.number], 2)
                use = block.joined[:-1].copy()
            else:
                may = _pairs(block, hashes, pairs.value)
                place = _place(hashes[block.number], 3)
                use = (may & _shifted(may, 1))[: len(place)]
            use[block.own :] = False
            place, n = np.unique(place[use], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(n)], ["place", "n"])

    counts = texts.mapInArrow(run, "place int, n long").groupBy("place").agg(F.sum("n").alias("n"))
    bits = F.bitmap_construct_agg((F.col("place") % (1 << _AGG_BITS)).cast("long")).alias("bits")
    rows = counts.where(F.col("n") >= least).groupBy(F.shiftright("place", _AGG_BITS).alias("at")).agg(bits)
    whole = np.zeros(1 << (FIELD_BITS - 3), np.uint8)
    size = 1 << (_AGG_BITS - 3)
    for row in rows.collect():
        whole[row["at"] * size : (row["at"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    del counts, rows
    release(texts.sparkSession)
    return texts.sparkSession.sparkContext.broadcast(whole)


def _edges(texts: DataFrame, pairs, triples) -> DataFrame:
    """``lang``, ``w1`` to ``w4`` and ``n``: an edge per different four words. With nulls behind, its first
    words, where the piece ends or, by the fields, no phrase goes on."""
    import numpy as np

    names = ["lang", *WORDS, "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, block in blocks(batches):
            number = block.number
            if not len(number):
                continue
            hashes = _hashes(block, name)
            two = _pairs(block, hashes, pairs.value)
            three = two & _shifted(two, 1)
            place = _place(hashes[number], 3)
            three[: len(place)] &= _known(triples.value, place)
            four = three & _shifted(three, 1)
            columns = [number]
            columns += [np.where(more, _shifted(number, k), 0) for k, more in enumerate((two, three, four), 1)]
            columns = [c[: block.own].astype(np.int64) for c in columns]
            size = len(block.spelled) + 1
            low, low_at = np.unique(columns[0] * size + columns[1], return_inverse=True)
            high, high_at = np.unique(columns[2] * size + columns[3], return_inverse=True)
            del columns, two, three, four, place
            both, n = np.unique(low_at * len(high) + high_at, return_counts=True)
            first, last = low[both // len(high)], high[both % len(high)]
            for some in range(0, len(both), 1 << 16):
                part = slice(some, some + (1 << 16))
                spelled = [
                    block.spelled.take(pa.array(c - 1, mask=c == 0)).cast(pa.string())
                    for c in (first[part] // size, first[part] % size, last[part] // size, last[part] % size)
                ]
                own = pa.array([name] * len(spelled[0]), pa.string())
                yield pa.RecordBatch.from_arrays([own, *spelled, pa.array(n[part].astype(np.int64))], names)

    found = texts.mapInArrow(run, "lang string, " + ", ".join(f"{w} string" for w in WORDS) + ", n long")
    return found.groupBy("lang", *WORDS).agg(F.sum("n").alias("n"))


def _shifted(values, by: int):
    """``values`` moved to the left, filled up with zeros."""
    import numpy as np

    result = np.zeros_like(values)
    result[: max(len(values) - by, 0)] = values[by:]
    return result


def levels(edges: DataFrame, work: Work) -> dict[int, DataFrame]:
    """By number of words how often these follow each other (``lang``, ``w1`` ..., ``n``): what flows
    out of a node, to its end too. Rows with nulls are the ends of shorter ones."""
    by = {ORDER: edges}
    for k in range(ORDER - 1, 0, -1):
        by[k] = work.stage(by[k + 1].groupBy("lang", *WORDS[:k]).agg(F.sum("n").alias("n")), f"level{k}")
    return by


def _frequent(level: DataFrame, k: int, least: int) -> DataFrame:
    return level.where(F.col(WORDS[k - 1]).isNotNull() & (F.col("n") >= least))


def paths(edges: DataFrame, nodes: DataFrame, least: int, work: Work) -> DataFrame:
    """The graph's edges with a weight of ``least`` or more as unbranched paths: ``lang``, ``words``,
    ``n``, and ``path`` and ``part``, as a path of more than ``PATH_ROW`` edges takes several rows, which
    overlap by a node.

    ``nodes`` is the level of three words. Inside a path every node has one way in and one way out,
    and as much flows through it as along the path. Each edge finds the first of its path by
    doubling: it points to the edge before it, then to the one that is twice as far away, and so on.
    """
    strong = _frequent(edges, ORDER, least).withColumn("id", F.monotonically_increasing_id())
    strong = work.stage(strong, "strong")
    flow = nodes.toDF("lang", *[f"v{k}" for k in range(1, ORDER)], "flow")
    node = [f"v{k}" for k in range(1, ORDER)]
    # The only way out of its node, and nothing ends there.
    only = strong.select("lang", *[F.col(w).alias(v) for w, v in zip(WORDS, node, strict=False)], "n", "id")
    only = only.join(flow.hint("merge"), ["lang", *node]).where("n = flow").drop("flow")
    before = strong.select("lang", *[F.col(w).alias(v) for w, v in zip(WORDS[1:], node, strict=True)], "n", F.col("id").alias("up"))
    links = work.stage(only.join(before.hint("merge"), ["lang", *node, "n"]).select("id", "up"), "links")
    found = strong.select("id").join(links.hint("merge"), "id", "left")
    table = found.select(
        "id", F.coalesce("up", "id").alias("up"), F.col("up").isNotNull().cast("long").alias("far"), F.col("up").isNull().alias("done")
    )
    table, number = work.stage(table, "jumps0"), 0
    while not table.where("not done").isEmpty():
        target = table.toDF("up", "_up", "_far", "_done")
        jumped = table.where("not done").join(target.hint("merge"), "up")
        jumped = jumped.select("id", F.col("_up").alias("up"), (F.col("far") + F.col("_far")).alias("far"), F.col("_done").alias("done"))
        table = work.stage(table.where("done").unionByName(jumped), f"jumps{number + 1}")
        work.drop(f"jumps{number}")
        number += 1
    placed = strong.join(table.hint("merge"), "id").withColumn("part", F.call_function("div", F.col("far"), F.lit(PATH_ROW)))
    # A row's edges in order; there are PATH_ROW at most.
    rows = placed.groupBy("lang", "up", "part", "n").agg(F.sort_array(F.collect_list(F.struct("far", *WORDS))).alias("e"))
    first = F.array(*[F.col("e")[0][w] for w in WORDS[:-1]])
    words = F.concat(first, F.transform("e", lambda e: e[WORDS[-1]]))
    return work.stage(rows.select("lang", words.alias("words"), "n", F.col("up").alias("path"), "part"), "paths")


def _spelled(k: int) -> Column:
    return F.concat_ws(" ", *WORDS[:k]).alias("phrase")


def _of_paths(rows: DataFrame, size: int, skip: int) -> DataFrame:
    """The stretches of ``size`` words of paths, without the first and last ``skip``."""
    last = F.size("words") - F.lit(size + skip)
    begins = F.when(last >= skip, F.sequence(F.lit(skip), last)).otherwise(F.array().cast("array<int>"))
    phrase = F.transform(begins, lambda i: F.array_join(F.slice("words", i + 1, size), " "))
    return rows.select("lang", F.explode(phrase).alias("phrase"), F.lit(size).alias("size"), "n")


def counts(by: dict[int, DataFrame], rows: DataFrame, least: int) -> DataFrame:
    """``lang``, ``phrase``, ``size`` (words) and ``n`` of all phrases of one to four words that occur
    ``least`` times or more. Those of four and the inner ones of three come from the paths ``rows``."""
    four, inner = _of_paths(rows, ORDER, 0), _of_paths(rows, ORDER - 1, 1)
    outer = _frequent(by[ORDER - 1], ORDER - 1, least).select("lang", _spelled(ORDER - 1), F.lit(ORDER - 1).alias("size"), "n")
    outer = outer.join(inner.select("lang", "phrase").hint("merge"), ["lang", "phrase"], "left_anti")
    result = four.unionByName(inner).unionByName(outer)
    for k in range(ORDER - 2, 0, -1):
        result = result.unionByName(_frequent(by[k], k, least).select("lang", _spelled(k), F.lit(k).alias("size"), "n"))
    return result


def _exact(column: Column) -> Column:
    return column.cast("decimal(20,0)")


def _parts_of(known: DataFrame) -> DataFrame:
    """Phrases of two words or more with the counts of the two parts at the cut of the least score."""
    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    cuts = known.where("size > 1").select("lang", "phrase", F.col("n").alias("a"), "size", cut)
    cuts = cuts.withColumns(
        {
            "left": F.expr("substring_index(phrase, ' ', k)"),
            "right": F.expr("substring_index(phrase, ' ', k - size)"),
        }
    )
    of = known.select("lang", "phrase", "n")
    cuts = cuts.join(of.toDF("lang", "left", "l").hint("merge"), ["lang", "left"])
    cuts = cuts.join(of.toDF("lang", "right", "r").hint("merge"), ["lang", "right"])
    score = F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * _exact(F.col("a")), _exact(F.col("l")) + _exact(F.col("r")))
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c"))
    return lowest.select("lang", "phrase", "a", "c.l", "c.r", "c.score")


def _longer(known: DataFrame) -> DataFrame:
    """``lang``, ``phrase``, ``over``: the largest count of a phrase with one word more."""
    shorter = F.array(F.expr("substring_index(phrase, ' ', size - 1)"), F.expr("substring_index(phrase, ' ', 1 - size)"))
    rows = known.where("size > 2").select("lang", F.explode(shorter).alias("phrase"), "n")
    return rows.groupBy("lang", "phrase").agg(F.max("n").alias("over"))


def mine(
    docs: DataFrame, least: int = LEAST, top: int = TOP, same: int = SAME, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """The best phrases of two to four words of each language: ``lang``, ``rank`` from 1, ``phrase``,
    ``a`` (how often it occurs), ``l`` and ``r`` (the same of its parts), ``n`` (the language's words) and
    ``score``.

    Capital A to Z count as small. A phrase lies within a piece, as punctuation marks and line ends
    divide it, and occurs ``least`` times or more. Its score is 2000000 a / (l + r), rounded down, at the
    cut where that is least; of equal ones the first cut counts. A phrase that is part of a longer one
    with ``same`` per cent of its count or more is dropped. Phrases are ranked by score, then count,
    both descending, then by their bytes.

    Null texts are empty, null languages are ``und``; repeated rows count each. Ids and further columns
    are not looked at. Languages without a phrase, and an empty table, give no rows.
    """
    work = Work(docs.sparkSession, "phrases")
    name = F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE)).alias("lang")
    texts = docs.select(name, utf8(text).alias("_text")).where(F.octet_length("_text") > 0)
    pairs = _field(texts, least)
    triples = _field(texts, least, pairs)
    edges = work.stage(_edges(texts, pairs, triples), "edges")
    by = levels(edges, work)
    rows = paths(edges, by[ORDER - 1], least, work)
    known = work.stage(counts(by, rows, least), "counts")
    scored = work.stage(_parts_of(known), "scored")
    found = scored.join(work.stage(_longer(known), "longer").hint("merge"), ["lang", "phrase"], "left")
    replaced = F.lit(100).cast("decimal(3,0)") * _exact(F.col("over")) >= F.lit(same).cast("decimal(3,0)") * _exact(F.col("a"))
    found = found.where(~F.coalesce(replaced, F.lit(False))).drop("over")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of each part of a language first: no task ranks all phrases of a language.
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    found = found.withColumn("part", part)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    found = found.where(F.col("rank") <= top)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    words = by[1].groupBy("lang").agg(F.sum("n").alias("n"))
    result = found.where(F.col("rank") <= top).join(words.hint("merge"), "lang")
    result = result.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    result = work.stage(result, "phrases")
    work.drop(*[name for name in work.paths if name != "phrases"])
    return result
