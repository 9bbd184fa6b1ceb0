"""Line deduplication with compressed keep bitmaps, in DataFrame operations only.

Every line becomes a 128-bit hash of its key. The hashes are range-partitioned together with the
document id, so that a line found in a third of all documents is spread over many partitions, and
sorted by document and position within. In that order a document's repeats of a line are adjacent:
the first occurrence of each (line, document) is streamed into a count per line that is added up
map-side, one row per line and partition. Lines in enough documents are dropped (all of them, or
all but the first of the corpus). The result per document is no text but a run-length-encoded
bitmap of its lines.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import Work, row_key, with_row_key

#: Stripped from both ends of a line for its key: space, tab, \n, \v, \f, \r.
SPACE = " \t\n\x0b\x0c\r"
ROW = ["_k1", "_k2"]
LINE = ["_h1", "_h2"]


def line_array(text: str = "text") -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line stripped of white space, with A-Z in lower case. Spark's quick ``lower`` does for
    pure ASCII; it would change other letters too."""
    bare = F.btrim(line, F.lit(SPACE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    other = F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(ascii_only, F.lower(bare)).otherwise(other)


def keep_bitmaps(
    docs: DataFrame, min_docs: int = 10, keep: str = "none", text: str = "text", doc: str = "doc_id"
) -> DataFrame:
    """Per distinct (document id, text) that loses a line: ``_k1``, ``_k2`` (its ``row_key``),
    ``n_lines``, ``n_dropped`` and ``keep_runs``, the lengths of alternating runs of kept and
    dropped lines, beginning with kept ones (the first may be 0). No row: every line is kept.

    A line is dropped if its key is not empty and is in at least ``min_docs`` documents; with
    ``keep="first"`` its first occurrence by document id and position stays. Null and empty texts
    have one empty line, which stays. Rows with the same id are one document in the counts, and so
    are all rows with a null id; repeated rows share one bitmap. Any further columns are ignored.
    """
    if keep not in ("none", "first"):
        raise ValueError("keep must be 'none' or 'first'")
    work = Work(docs.sparkSession, "lines")
    lines = (
        docs.select(
            F.col(doc).alias("_doc"), *row_key(doc, text), line_array(text).alias("_lines")
        )
        .select(
            "_doc", *ROW, F.size("_lines").alias("_n"), F.posexplode("_lines").alias("_pos", "_line")
        )
        .withColumn("_key", line_key(F.col("_line")))
        .where(F.col("_key") != "")
        .select(
            F.xxhash64("_key").alias("_h1"),
            F.xxhash64(F.lit("second"), "_key").alias("_h2"),
            "_doc",
            F.struct("_pos", "_n", *ROW).alias("_at"),
        )
    )
    # One order by hash, document and position. A document's repeats of a line are neighbours in
    # it, so each (line, document) is streamed out once, with its positions, without a shuffle.
    ordered = lines.repartitionByRange(*LINE, "_doc").sortWithinPartitions(*LINE, "_doc", "_at")
    firsts = work.stage(
        ordered.groupBy(*LINE, "_doc").agg(F.array_sort(F.collect_set("_at")).alias("_at")),
        "firsts",
    )
    first = F.struct("_doc", F.col("_at")[0].alias("_at"))
    counts = firsts.groupBy(*LINE).agg(
        F.count(F.lit(1)).alias("_docs"), *([F.min(first).alias("_first")] * (keep == "first"))
    )
    common = work.stage(counts.where(F.col("_docs") >= min_docs).drop("_docs"), "common")

    # Both sides are plain scans, so adaptive execution can split the partitions of common lines.
    hits = firsts.join(common.hint("merge"), LINE)
    hits = hits.select("_doc", *common.columns[2:], F.explode("_at").alias("_at"))
    if keep == "first":
        hits = hits.where(~F.struct("_doc", "_at").eqNullSafe(F.col("_first")))
    dropped = hits.groupBy(F.col("_at._k1").alias("_k1"), F.col("_at._k2").alias("_k2")).agg(
        F.first("_at._n").alias("_n"), F.array_sort(F.collect_set("_at._pos")).alias("_gone")
    )
    return work.stage(
        dropped.select(
            *ROW,
            F.col("_n").cast("long").alias("n_lines"),
            F.size("_gone").cast("long").alias("n_dropped"),
            _run_lengths("_gone", "_n").alias("keep_runs"),
        ),
        "bitmaps",
    )


def _run_lengths(gone: str, n: str) -> Column:
    """Alternating run lengths from the sorted positions of dropped lines (one at least).

    Arrays are zipped with shifted copies of themselves, so that the work is linear in lines.
    """
    at = F.col(gone)
    outside = F.array(F.lit(-2))

    def where_apart(neighbours: Column, step: int) -> Column:
        marked = F.zip_with(at, neighbours, lambda x, other: F.when(other != x + step, x))
        return F.filter(marked, lambda x: x.isNotNull())

    begins = where_apart(F.concat(outside, at), -1)
    ends = where_apart(F.concat(F.slice(at, F.lit(2), F.col(n)), outside), 1)
    before = F.concat(F.array(F.lit(-1)), ends)
    spans = F.zip_with(begins, ends, lambda b, e: F.struct(b.alias("b"), e.alias("e")))
    lengths = F.zip_with(
        spans, before, lambda s, last: F.array(s["b"] - last - 1, s["e"] - s["b"] + 1)
    )
    rest = F.col(n) - 1 - F.element_at(at, -1)
    return F.concat(
        F.flatten(F.slice(lengths, F.lit(1), F.size(begins))),
        F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")),
    )


def kept_text(text: str = "text", keep_runs: str = "keep_runs") -> Column:
    """The kept lines joined by \\n, given the bitmap (null: every line is kept)."""
    mask = F.flatten(F.transform(keep_runs, lambda length, i: F.array_repeat(i % 2 == 0, length)))
    # array_join leaves out nulls.
    lines = F.zip_with(line_array(text), mask, lambda line, kept: F.when(kept, line))
    whole = F.coalesce(F.col(text), F.lit(""))
    return F.when(F.col(keep_runs).isNull(), whole).otherwise(F.array_join(lines, "\n"))


def drop_lines(
    docs: DataFrame, min_docs: int = 10, keep: str = "none", text: str = "text", doc: str = "doc_id"
) -> DataFrame:
    """``docs`` with ``text`` replaced by its kept lines, and ``n_lines`` and ``n_dropped`` added
    (they replace columns of these names). Every row stays, in any case; a text without lines left
    is empty, and so is a null text. See ``keep_bitmaps`` for what is dropped.
    """
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return _with_bitmaps(docs, min_docs, keep, text, doc).select(
        *_kept_columns(own, text),
        F.size(line_array(f"_row.`{text}`")).cast("long").alias("n_lines"),
        F.coalesce("_gone", F.lit(0).cast("long")).alias("n_dropped"),
    )


def clean(
    docs: DataFrame, min_docs: int = 10, keep: str = "none", text: str = "text", doc: str = "doc_id"
) -> DataFrame:
    """``drop_lines`` without further columns: just the columns of ``docs``, whatever their names."""
    return _with_bitmaps(docs, min_docs, keep, text, doc).select(*_kept_columns(docs.columns, text))


def _with_bitmaps(docs: DataFrame, min_docs: int, keep: str, text: str, doc: str) -> DataFrame:
    bitmaps = keep_bitmaps(docs, min_docs, keep, text, doc).select(
        *ROW, F.col("n_dropped").alias("_gone"), F.col("keep_runs").alias("_runs")
    )
    return with_row_key(docs, doc, text).join(bitmaps, ROW, "left")


def _kept_columns(names: list[str], text: str) -> list[Column]:
    return [
        kept_text(f"_row.`{c}`", "_runs").alias(c) if c == text else F.col(f"_row.`{c}`").alias(c)
        for c in names
    ]
