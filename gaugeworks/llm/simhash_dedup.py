"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A fingerprint has eight bytes. At most ``max_bits`` differing bits touch at most ``max_bits``
bytes, so linked fingerprints share at least ``8 - max_bits`` bytes in place. The index tallies
those. A posting list per single byte value would hold 1/256 of all fingerprints, so lists are kept
for combinations of three byte positions, chosen so that any set of ``8 - max_bits`` positions
contains one of them (20 of the 56 combinations for four bits). Within a list the shared positional
bytes of a pair are tallied, pairs that reach the guaranteed minimum are retained, and their
differing bits are counted.

Exact copies have been folded to one entry per fingerprint before, and a list yields no pairs but a
forest that connects what is linked. Lists beyond ``list_rows`` entries are cut into blocks, and
every pair of blocks is a task's work, so nothing is skipped.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import Work, slices, utf8, with_row_key
from gaugeworks.llm.components import components

SEED = 42


def positions(max_bits: int) -> list[tuple[int, ...]]:
    """Combinations of byte positions one of which every linked pair has in common.

    For four or more shared bytes: three groups of positions, and every triple within one group or
    with two members in one and one in the next. Four positions always hold such a triple.
    """
    if not 0 <= max_bits <= 7:
        raise ValueError("max_bits must be 0 to 7")
    shared = 8 - max_bits
    if shared < 4:
        return list(combinations(range(8), shared))
    group = [0, 0, 0, 1, 1, 1, 2, 2]

    def belongs(triple: tuple[int, ...]) -> bool:
        a, b, c = sorted(group[p] for p in triple)
        if a == b == c:
            return True
        if a == b or b == c:
            pair, single = (a, c) if a == b else (c, a)
            return (pair + 1) % 3 == single
        return False

    return [t for t in combinations(range(8), 3) if belongs(t)]


def fingerprint(text: bytes, shingle_words: int = 4) -> int:
    """The SimHash of one text, see ``fingerprints``."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle_words:
        return xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = [0, *(ends[: len(words) - shingle_words] + 1).tolist()]
    stops = ends[shingle_words - 1 :].tolist()
    hashes = np.array(
        [xxh64_intdigest(joined[i:j], SEED) for i, j in zip(begins, stops, strict=True)], "<u8"
    )
    set_in = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_in += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * set_in > len(hashes), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 4, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with a long ``_fp``: the 64 bits of the SimHash, of which a bit is
    1 if it is set in more than half of the XXH64 hashes (seed 42) of the text's word shingles.

    Words are separated by ASCII white space, A-Z count as lower case, repeated shingles count
    repeatedly. Fewer words than a shingle: the whole sequence is one; none (null, empty or blank
    text): 0.
    """
    import numpy as np

    others = [f for f in docs.schema.fields if f.name not in (text, "_fp")]
    frame = docs.select(*[f.name for f in others], utf8(text).alias("_text"))
    schema = docs.select(*[f.name for f in others], F.lit(0).cast("long").alias("_fp")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            texts = batch.column(batch.num_columns - 1)
            found = np.array([fingerprint(t.as_py(), shingle_words) for t in texts], np.uint64)
            columns = [*batch.columns[:-1], pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "_fp"])

    return frame.mapInArrow(run, schema)


def _postings(entries: DataFrame, max_bits: int) -> DataFrame:
    """``entries`` (``id``, ``_fp``) once per combination of positions, with the ``_list``: the
    combination's number and its byte values."""
    lists = []
    for number, chosen in enumerate(positions(max_bits)):
        mask = sum(0xFF << (8 * p) for p in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        lists.append(
            F.struct(
                F.lit(number).cast("short").alias("c"), F.col("_fp").bitwiseAND(F.lit(signed)).alias("v")
            )
        )
    return entries.select("id", "_fp", F.explode(F.array(*lists)).alias("_list")).select(
        "_list.c", "_list.v", "id", "_fp"
    )


def linked(entries: DataFrame, work: Work, max_bits: int = 4, list_rows: int = 50_000) -> DataFrame:
    """Links ``a``, ``b`` between the ``id`` of ``entries`` (one row per distinct long ``_fp``) that
    connect just what pairs of fingerprints with at most ``max_bits`` differing bits connect."""
    if max_bits == 0:
        return entries.select(F.col("id").alias("a"), F.col("id").alias("b")).where("false")
    postings = _postings(entries, max_bits)
    sizes = postings.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = work.stage(sizes.withColumn("blocks", F.ceil(F.col("n") / list_rows).cast("int")), "lists")
    # Lists of one entry end here. In a cut list an entry meets its own block and every other one.
    cut = postings.join(sizes.drop("n").hint("merge"), ["c", "v"]).withColumn(
        "own", F.pmod(F.xxhash64("_fp"), F.col("blocks")).cast("int")
    )
    tiles = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "c",
        "v",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        "id",
        "_fp",
    )
    keys = ["c", "v", "low", "high"]
    dealt = tiles.repartition(*keys).sortWithinPartitions(*keys)
    minimum = 8 - max_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, keys):
            for a, b in _forests(*group, max_bits, minimum):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]):
    """Whole groups of rows with equal ``keys``, many small ones together: the group starts, ids and
    fingerprints. Holds one batch and one group at a time."""
    import numpy as np

    held: list[np.ndarray] = []

    def emit(rows: list[np.ndarray]):
        whole = np.concatenate(rows)
        head = np.empty(len(whole), bool)
        head[:1] = True
        head[1:] = (whole[1:, :4] != whole[:-1, :4]).any(axis=1)
        return np.flatnonzero(head), whole[:, 4], whole[:, 5].copy().view(np.uint64)

    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = np.stack(
            [batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (*keys, "id", "_fp")],
            axis=1,
        )
        same = (rows[:, :4] == rows[-1, :4]).all(axis=1)
        begin = len(rows) - int(np.argmin(same[::-1])) if not same.all() else 0
        if begin:
            yield emit([*held, rows[:begin]])
            held = [rows[begin:]]
        elif held and (held[-1][-1, :4] != rows[0, :4]).any():
            yield emit(held)
            held = [rows]
        else:
            held.append(rows)
    if held:
        yield emit(held)


def _close(x, y, max_bits: int, minimum: int):
    """Whether fingerprints share the minimum of positional bytes and few enough bits differ."""
    import numpy as np

    differ = x ^ y
    tally = np.zeros(differ.shape, np.int8)
    for p in range(8):
        tally += (differ >> np.uint64(8 * p)) & np.uint64(0xFF) == 0
    return (tally >= minimum) & (np.bitwise_count(differ) <= max_bits)


def _forests(starts, ids, fps, max_bits: int, minimum: int):
    """Arrays of links for each group of rows that begins at one of ``starts``."""
    import numpy as np

    sizes = np.diff(np.append(starts, len(ids)))
    small = 16
    # Small groups: all pairs, one distance within the sorted rows after the other.
    group = np.repeat(np.where(sizes <= small, np.arange(len(starts)), -1), sizes)
    for step in range(1, min(small, int(sizes.max(initial=0)))):
        at = np.flatnonzero((group[step:] == group[:-step]) & (group[step:] >= 0))
        if len(at):
            at = at[_close(fps[at], fps[at + step], max_bits, minimum)]
            yield ids[at], ids[at + step]
    # Larger ones: search outwards from one entry after the other among those not reached yet.
    for begin, size in zip(starts[sizes > small], sizes[sizes > small], strict=True):
        rest = np.arange(begin, begin + size)
        while len(rest):
            reached, rest, front = [], rest[1:], [rest[0]]
            while front and len(rest):
                node = front.pop()
                hit = _close(fps[rest], fps[node], max_bits, minimum)
                if hit.any():
                    new = rest[hit]
                    reached.append((np.full(len(new), ids[node]), ids[new]))
                    front.extend(new.tolist())
                    rest = rest[~hit]
            for a, b in reached:
                yield a, b


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = 4,
    max_bits: int = 4,
    text: str = "text",
    doc: str = "doc_id",
    list_rows: int = 50_000,
) -> DataFrame:
    """Per row of ``docs``: ``doc`` (a long), ``fingerprint`` (16 lowercase hex digits) and
    ``component_id``, the smallest id reachable by links of at most ``max_bits`` differing bits.

    Texts without words have fingerprint 0 and are linked like any other. A row without an id keeps
    its fingerprint, links nothing and has no component. Rows with the same id and different texts
    link their fingerprints, as they are one document. Further columns are ignored.
    """
    work = Work(docs.sparkSession, "simhash")
    prints = work.stage(
        fingerprints(
            docs.select(F.col(doc).cast("long").alias("_id"), F.col(text).alias("text")), shingle_words
        ),
        "prints",
    )
    known = prints.where(F.col("_id").isNotNull())
    entries = work.stage(known.groupBy("_fp").agg(F.min("_id").alias("id")), "entries")
    # An id with two fingerprints connects them.
    same = (
        known.groupBy("_id")
        .agg(F.min("_fp").alias("low"), F.max("_fp").alias("high"))
        .where("low != high")
    )
    apart = known.join(same, "_id", "left_semi").join(entries, "_fp")
    links = linked(entries, work, max_bits, list_rows).unionByName(
        apart.select(F.col("_id").alias("a"), F.col("id").alias("b"))
    )
    roots = components(links, work)
    work.drop("lists")
    reps = work.stage(
        entries.join(roots.hint("merge"), "id", "left").select(
            "_fp", F.coalesce("root", "id").alias("_root")
        ),
        "reps",
    )
    return prints.join(reps.hint("merge"), "_fp", "left").select(
        F.col("_id").alias(doc),
        F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("_id").isNotNull(), F.col("_root")).alias("component_id"),
    )



def keep_one(docs: DataFrame, text: str = "text", doc: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that are the first of their group by id, unchanged, and those without an
    id. Of several rows with one id, one stays. ``options``: see ``near_duplicates``."""
    work = Work(docs.sparkSession, "groups")
    grouped = near_duplicates(docs, text=text, doc=doc, **options)
    first = grouped.where(F.col(doc) == F.col("component_id")).groupBy(F.col(doc).alias("_id"))
    first = work.stage(first.agg(F.count(F.lit(1)).alias("_rows")), "first")
    keyed = with_row_key(docs, doc, text).withColumn("_id", F.col(f"_row.`{doc}`").cast("long"))
    kept = work.stage(keyed.join(first.hint("merge"), "_id", "left").where("_rows > 0 or _id is null"), "kept")
    single = kept.where("_rows = 1 or _id is null").select("_row.*")
    several = kept.where("_rows > 1").groupBy("_id").agg(F.min_by("_row", F.struct("_k1", "_k2")).alias("_row"))
    return single.unionByName(several.select("_row.*"))
