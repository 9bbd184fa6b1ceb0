"""Variable-capacity best-fit-decreasing packing of documents into training sequences.

Lengths are whole numbers up to the largest permitted sequence length, so the histogram of lengths
is a small table whatever the size of the corpus. Best fit is run on it, for all items of a length
and all bins with the same contents at once; a bin's free space at least halves whenever such a
group is visited, so a packing has a bounded number of steps. Several rules for opening bins are
tried, and the cheapest packing is taken. Its steps say which ranks within a length go to which
bins; documents then find their places in parallel by their rank.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import Work, row_key

CAPACITIES = (512, 1024, 2048, 4096, 8192)
#: A bin costs its capacity, a fixed part for a sequence, and its attention: capacity squared over this.
OVERHEAD = 32
ATTENTION = 65536
#: Rows of one length that are numbered together.
ROWS_PER_BUCKET = 1000


@dataclass
class Plan:
    """``steps``: (length, first rank, ranks, items per bin, first bin, offset in the bin), for
    each length in order of rank. ``bins``: (first bin, bins, capacity), in order."""

    steps: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    bins: list[tuple[int, int, int]] = field(default_factory=list)
    cost: int = 0


def bin_cost(capacity: int, overhead: int = OVERHEAD, attention: int = ATTENTION) -> int:
    return capacity + overhead + capacity * capacity // attention


def plan_packing(
    histogram: dict[int, int],
    capacities: tuple[int, ...] = CAPACITIES,
    cost: Callable[[int], int] = bin_cost,
) -> Plan:
    """The cheapest of several best-fit-decreasing packings of ``histogram`` (items by length, none
    longer than the largest capacity), by the ``cost`` of a bin of a capacity.

    The rules differ in the largest size at which a bin may be opened: up to it, the size that costs
    least per token of the items at hand is taken.
    """
    sizes = sorted(set(capacities))
    plans = [_pack(histogram, sizes, cost, largest) for largest in sizes]
    return min(plans, key=lambda p: p.cost)


def _pack(histogram: dict[int, int], sizes: list[int], cost: Callable, largest: int) -> Plan:
    plan = Plan()
    free: list[int] = []  # free spaces of open groups, ascending
    # By free space: first bin, bins, capacity; the group opened first is taken first.
    groups: dict[int, list[tuple[int, int, int]]] = {}
    n_bins = 0

    def put(space: int, first: int, bins: int, capacity: int) -> None:
        if bins == 0:
            return
        if space not in groups:
            groups[space] = []
            insort(free, space)
        heappush(groups[space], (first, bins, capacity))

    def take(space: int) -> tuple[int, int, int]:
        group = heappop(groups[space])
        if not groups[space]:
            del groups[space]
            free.pop(bisect_left(free, space))
        return group

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(free, length)
            if at < len(free):
                space = free[at]
                first, bins, capacity = take(space)
            else:
                # Nothing open has room: as many new bins as the items fill.
                fitting = [s for s in sizes if length <= s <= largest] or [
                    next(s for s in sizes if s >= length)
                ]
                capacity = min(fitting, key=lambda s: (cost(s) / (s // length * length), s))
                space, first, bins = capacity, n_bins, -(-left // (capacity // length))
                n_bins += bins
            each = space // length
            full = min(bins, left // each)
            used = capacity - space
            if full:
                plan.steps.append((length, rank, full * each, each, first, used))
                put(space - each * length, first, full, capacity)
                rank, left = rank + full * each, left - full * each
            rest = bins - full
            if rest and left:  # fewer items than one more bin takes
                plan.steps.append((length, rank, left, left, first + full, used))
                put(space - left * length, first + full, 1, capacity)
                full, rest, rank, left = full + 1, rest - 1, rank + left, 0
            put(space, first + full, rest, capacity)
    for space, found in groups.items():
        for first, bins, capacity in found:
            # Downsize to the contents.
            size = next(s for s in sizes if s >= capacity - space)
            plan.bins.append((first, bins, size))
            plan.cost += bins * cost(size)
    plan.bins.sort()
    return plan


def n_words(text: str = "text") -> Column:
    """Words separated by ASCII white space, and one end mark."""
    bare = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(bare == "", 0).otherwise(F.size(F.split(bare, "[ \\t\\n\\x0B\\f\\r]+", -1)))
    return (words + 1).cast("long")


def pack(
    docs: DataFrame,
    length: Column | None = None,
    capacities: tuple[int, ...] = CAPACITIES,
    cost: Callable[[int], int] = bin_cost,
    text: str = "text",
    doc: str = "doc_id",
) -> DataFrame:
    """Places for all tokens of all rows of ``docs``: ``doc_id``, ``piece`` (0 up), ``doc_start``
    (the piece's first token in the document), ``n_tokens`` of the piece, ``bin_id``, ``bin_start``
    (the piece's place in the bin) and ``capacity`` of the bin.

    ``length`` is a row's number of tokens; it defaults to words and an end mark. A row longer than
    the largest capacity is cut into pieces of that capacity and a rest. Rows of length null, zero
    or less have one row with null ``bin_id``, ``bin_start`` and ``capacity``. Repeated rows, and
    rows with equal or null ids, are items of their own. Further columns are left out. An empty
    table gives no rows. Bins are numbered from 0; none overflows; places don't overlap.
    """
    work = Work(docs.sparkSession, "packing")
    largest = max(capacities)
    tokens = F.coalesce((n_words(text) if length is None else length).cast("long"), F.lit(0))
    items = docs.select(F.col(doc).cast("long").alias("doc_id"), *row_key(doc, text), tokens.alias("n"))
    pieces = (
        items.withColumn(
            "piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"greatest(n - 1, 0) div {largest}")))
        )
        .select(
            "doc_id",
            "piece",
            (F.col("piece") * largest).alias("doc_start"),
            F.greatest(F.least(F.col("n") - F.col("piece") * largest, F.lit(largest)), F.lit(0)).alias(
                "n_tokens"
            ),
            F.xxhash64("_k1", "_k2", "piece").alias("_h"),
        )
    )
    pieces = work.stage(pieces, "pieces")
    # One row per length, of which there are no more than the largest capacity.
    counted = pieces.where("n_tokens > 0").groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n"))
    histogram = {row["n_tokens"]: row["n"] for row in counted.collect()}
    plan = plan_packing(histogram, capacities, cost)

    # Ranks within a length: numbered within hash buckets, plus the sizes of earlier buckets, so a
    # length that many documents have is numbered in as many tasks as it needs.
    buckets = -(-max(histogram.values(), default=1) // ROWS_PER_BUCKET)
    dealt = pieces.withColumn("_b", F.pmod(F.col("_h"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("n_tokens").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        dealt.groupBy("n_tokens", "_b")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("n_tokens", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    )
    bases = work.stage(bases, "bases")
    within = Window.partitionBy("n_tokens", "_b").orderBy("_h", "doc_id")
    ranked = (
        dealt.withColumn("_rank", F.row_number().over(within) - 1)
        .join(bases, ["n_tokens", "_b"])
        .select(
            "doc_id", "piece", "doc_start", "n_tokens", (F.col("_base") + F.col("_rank")).alias("_rank")
        )
    )
    return _placed(ranked, plan)


def _placed(ranked: DataFrame, plan: Plan) -> DataFrame:
    """Ranks turned into places. The plan is bounded by the number of lengths, not of items."""
    import numpy as np

    steps = np.array(sorted(plan.steps), np.int64).reshape(-1, 6)
    bins = np.array(plan.bins, np.int64).reshape(-1, 3)
    shared = ranked.sparkSession.sparkContext.broadcast((steps, bins))
    names = ["doc_id", "piece", "doc_start", "n_tokens", "bin_id", "bin_start", "capacity"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, bins = shared.value
        lengths = steps[:, 0]
        for batch in batches:
            if batch.num_rows == 0:
                continue
            length = batch.column(3).to_numpy()
            rank = batch.column(4).to_numpy()
            low = np.searchsorted(lengths, length, "left")
            high = np.searchsorted(lengths, length, "right")
            packed = length > 0
            # Steps of a length are consecutive and ordered by first rank: one search over pairs.
            step = _last_at_most(steps[:, 1], low, high, rank)
            chosen = steps[np.where(packed, step, 0)] if len(steps) else np.zeros((len(rank), 6), np.int64)
            each = np.maximum(chosen[:, 3], 1)
            nth = rank - chosen[:, 1]
            bin_id = chosen[:, 4] + nth // each
            start = chosen[:, 5] + nth % each * length
            if len(bins):
                capacity = bins[np.searchsorted(bins[:, 0], bin_id, "right") - 1, 2]
            else:
                capacity = np.zeros(len(rank), np.int64)
            placed = [pa.array(x, pa.int64(), mask=~packed) for x in (bin_id, start, capacity)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *placed], names)

    return ranked.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _last_at_most(sorted_in_parts, low, high, wanted):
    """For each i the last index in ``low[i] .. high[i] - 1`` whose value is at most ``wanted[i]``."""
    import numpy as np

    low, high = low.copy(), high.copy()
    while True:
        open_ = high - low > 1
        if not open_.any():
            return low
        middle = (low + high) // 2
        take = open_ & (sorted_in_parts[np.minimum(middle, len(sorted_in_parts) - 1)] <= wanted)
        low = np.where(take, middle, low)
        high = np.where(open_ & ~take, middle, high)
