"""Detection of periodic runs of words by online dyadic square catching.

Words are appended to a ``Catcher``. For every power of two M it holds the blocks of M words that begin
at multiples of M / 2. A completed block catches the squares whose period is between M / 2 and M: each
word appended behind it completes one more window of M words (a suffix), and where that equals the
block, the block and all up to the suffix's end repeat with the distance as period. For each window there
is just one block at such a distance. Windows are compared by hashes that double in length from one M
to the next; each finding is then compared word by word.

Squares of one period that overlap are one run, which is followed to the words that end it. A square
within a run of smaller period is a repetition of that run's and left out. So the runs of four or more
periods are found whole, each with its smallest period: such a run has a block of M words at a multiple
of M / 2, and the same block one period later. All words of many texts are appended at once, with a
separator that equals nothing between them; each step is an operation on arrays.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import cache
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import binary_bytes, runs, slices, utf8

#: A run has at least so many periods, and so many words.
PERIODS, LEAST_WORDS = 4, 6
#: Bytes that end a word.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
#: Words that are spelled out, and pairs of words that are compared, together.
SPELLED = COMPARED = 1 << 18
K1, K2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def _doubled(h, size: int):
    """Hashes of twice ``size`` words from those of ``size`` words."""
    import numpy as np

    both = h[:-size] * np.uint64(K1) + h[size:] * np.uint64(K2)
    both ^= both >> np.uint64(31)
    return both


class Catcher:
    """Runs of the words appended so far; words are whole numbers from 0.

    ``longest`` bounds the length of a stretch without separators, if known: blocks that could not
    be repeated ``PERIODS`` times in it are not kept.
    """

    def __init__(self, longest: int | None = None):
        import numpy as np

        self.longest = longest
        self.words = np.zeros(0, np.int64)
        self.levels: list[Any] = []  # by exponent of M: hash of the window at each position
        self.caught: list[Any] = []  # by exponent of M: (first word, period) of each square, in order
        self.seen: list[int] = []  # by exponent of M: windows that have met their blocks

    def append(self, words) -> None:
        """Take in the next words; the squares that end in them are caught."""
        import numpy as np

        self.words = np.concatenate([self.words, np.asarray(words, np.int64)])
        level, size = 0, 1
        while self._useful(size):
            if level == len(self.levels):
                self.levels.append(np.zeros(0, np.uint64))
                self.caught.append([])
                self.seen.append(0)
            old = self.levels[level]
            if level == 0:
                new = (self.words[len(old) :].astype(np.uint64) + np.uint64(1)) * np.uint64(K1)
                new ^= new >> np.uint64(32)
                new *= np.uint64(K2)
            else:
                new = _doubled(self.levels[level - 1][len(old) :], size // 2)
            self.levels[level] = np.concatenate([old, new]) if len(old) else new
            self._advance(level, size)
            level, size = level + 1, size * 2

    def _useful(self, size: int) -> bool:
        """Whether a run with a period of more than half of ``size`` has room."""
        room = len(self.words) if self.longest is None else min(self.longest, len(self.words))
        return PERIODS * (size // 2 + 1) <= room

    def _advance(self, level: int, size: int) -> None:
        """Compare the windows of ``size`` words that are complete since last time with the blocks before."""
        import numpy as np

        h, begin = self.levels[level], self.seen[level]
        self.seen[level] = len(h)
        step = max(size // 2, 1)
        # Windows by row, so that those of a row lie behind one block.
        first = begin // step
        rows = -(-len(h) // step) - first
        if rows <= 0:
            return
        at = np.arange(max(first - 2, 0), first + rows) * step
        block = h[at]
        back = first - max(first - 2, 0)
        padded = np.zeros(rows * step, np.uint64)
        padded[: len(h) - first * step] = h[first * step :]
        table = padded.reshape(rows, step)
        equal = np.zeros((rows, step), bool)
        gap = 2 if size > 1 else 1  # rows between a window at the row's begin and its block

        def against(target, distance: int) -> None:
            have = max(distance - back, 0)
            own = np.arange(have, rows)
            if not len(own):
                return
            values = block[own + back - distance]
            if target == 0:
                equal[own, 0] = table[own, 0] == values
            else:
                equal[own, 1:] = table[own, 1:] == values[:, None]

        against(0, gap)
        if step > 1:
            against(1, 1)
        flat = equal.ravel()
        flat[: begin - first * step] = False
        flat[len(h) - first * step :] = False
        found = np.flatnonzero(flat)
        if len(found):
            row, place = np.divmod(found, step)
            period = np.where(place == 0, gap * step, step + place)
            start = found + first * step - period
            self.caught[level].append((start, period))

    def runs(self):
        """Begin, end (exclusive) and smallest period of every run, by begin, then period."""
        import numpy as np

        x = self.words
        begins, ends, periods = (np.zeros(0, np.int64) for _ in range(3))
        for level, squares in enumerate(self.caught):
            if not squares:
                continue
            size = 1 << level
            start = np.concatenate([s for s, _ in squares])
            period = np.concatenate([p for _, p in squares])
            # Squares within a run of smaller period only repeat it.
            if len(begins):
                reach = np.maximum.accumulate(ends)  # of runs by begin
                before = np.searchsorted(begins, start, "right") - 1
                inside = (before >= 0) & (reach[np.maximum(before, 0)] >= start + period + size)
                start, period = start[~inside], period[~inside]
            true = _equal(x, start, period, size)
            start, period = start[true], period[true]
            if not len(start):
                continue
            order = np.lexsort((start, period))
            start, period = start[order], period[order]
            new = np.ones(len(start), bool)
            new[1:] = (period[1:] != period[:-1]) | (start[1:] > start[:-1] + size)
            head = np.flatnonzero(new)
            tail = np.append(head[1:], len(start)) - 1
            found = _whole(x, start[head], start[tail] + size, period[head], size)
            begins, ends, periods = (
                np.concatenate([a, b]) for a, b in zip((begins, ends, periods), found, strict=True)
            )
            order = np.lexsort((periods, begins))
            begins, ends, periods = begins[order], ends[order], periods[order]
        length = ends - begins
        long = (length >= PERIODS * periods) & (length >= LEAST_WORDS)
        return begins[long], ends[long], periods[long]


def _equal(x, start, period, size: int):
    """Whether the ``size`` words from ``start`` on are those from one ``period`` later on."""
    import numpy as np

    result = np.zeros(len(start), bool)
    step = max(1, COMPARED // size)
    for begin in range(0, len(start), step):
        part = slice(begin, begin + step)
        at = start[part, None] + np.arange(size)
        result[part] = (x[at] == x[at + period[part, None]]).all(axis=1)
    return result


def _whole(x, low, high, period, size: int):
    """The runs that hold merged squares: word by word, positions from ``low`` to ``high`` equal those
    one period later, and so may up to half of ``size`` more on either side."""
    import numpy as np

    if size <= 2:  # every position is a block's begin, so nothing is left to follow
        return low, high + period, period
    begins, ends, periods = [], [], []
    for a, b, p in zip(low.tolist(), high.tolist(), period.tolist(), strict=True):
        a, b = max(a - size // 2, 0), min(b + size // 2, len(x) - p)
        edges = np.diff(np.concatenate([[0], (x[a:b] == x[a + p : b + p]).view(np.int8), [0]]))
        first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        wide = last - first >= p
        begins += (a + first[wide]).tolist()
        ends += (a + last[wide] + p).tolist()
        periods += [p] * int(wide.sum())
    return tuple(np.array(v, np.int64) for v in (begins, ends, periods))


@cache
def _spaces():
    import numpy as np

    space = np.zeros(256, bool)
    space[list(SPACES)] = True
    return space


def word_spans(data, offsets):
    """The words of texts that lie behind each other in ``data``: begin, length, and index of the text."""
    import numpy as np

    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_spaces()[data]
    edge = inside[1:] != inside[:-1]
    # A text's begin cuts a word in two.
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    joined = np.unique(cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)])
    at = np.flatnonzero(edge)
    begins, ends = at[::2], at[1::2]
    if len(joined):
        begins = np.sort(np.concatenate([begins, joined]))
        ends = np.sort(np.concatenate([ends, joined]))
    text = np.searchsorted(offsets, begins, "right") - 1
    return begins, ends - begins, text


def word_numbers(data, lengths):
    """Equal numbers, from 0, for equal ones among the words of ``data``, which have these lengths."""
    import numpy as np

    at = np.concatenate([[0], np.cumsum(lengths)])
    spelled = data[~_spaces()[data]]
    kind, width = (pa.binary(), np.int32) if at[-1] < 1 << 31 else (pa.large_binary(), np.int64)
    words = pa.Array.from_buffers(
        kind, len(lengths), [None, pa.py_buffer(at.astype(width).tobytes()), pa.py_buffer(spelled.tobytes())]
    )
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def _spaced(data, begins, lengths):
    """The words with one space behind each, and where each ends."""
    import numpy as np

    size = lengths + 1
    ends = np.cumsum(size)
    result = np.empty(int(size.sum()), np.uint8)
    data = np.append(data, np.uint8(0x20))
    for some in range(0, len(size), SPELLED):
        part = slice(some, some + SPELLED)
        at = runs(begins[part], size[part])
        begin = ends[some] - size[some]
        result[begin : begin + len(at)] = data[at]
    result[ends - 1] = 0x20
    return result, ends


def periodic_tail(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """Where a text of ``n`` words is made periodic, and with which period, or None. Every tenth
    document by its id's checksum is; fixed values of the query."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def find_runs(words, counts):
    """The runs of several texts whose words (as numbers) lie behind each other: index of the text,
    first word, length and period of each, by text, first word and period."""
    import numpy as np

    counts = np.asarray(counts, np.int64)
    offset = np.cumsum(counts) - counts
    found = []
    # Texts of similar length together: blocks are kept as far as the longest of them needs.
    magnitude = np.frompyfunc(int.bit_length, 1, 1)(counts.astype(object)).astype(np.int64)
    for m in np.unique(magnitude[counts >= LEAST_WORDS]).tolist():
        text = np.flatnonzero(magnitude == m)
        size = counts[text]
        place = np.cumsum(size + 1) - (size + 1)
        x = np.empty(int(size.sum()) + len(text), np.int64)
        x[runs(place, size)] = words[runs(offset[text], size)]
        top = int(words.max(initial=0)) + 1
        x[place + size] = top + np.arange(len(text))
        catcher = Catcher(int(size.max()))
        catcher.append(x)
        begins, ends, periods = catcher.runs()
        own = np.searchsorted(place, begins, "right") - 1
        found.append((text[own], begins - place[own], ends - begins, periods))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    text, first, length, period = (np.concatenate(column) for column in zip(*found, strict=True))
    order = np.lexsort((period, first, text))
    return text[order], first[order], length[order], period[order]


def periodic_runs(
    docs: DataFrame,
    text: str = "text",
    doc: str = "doc_id",
    tail: Callable[[int | None, int], tuple[int, int] | None] | None = None,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``runs``, structs of ``start`` (word number),
    ``length`` and ``period`` by start and period, and ``collapsed``, the words that are in no run
    behind its first period, joined by one space.

    A run is a stretch of consecutive words with smallest period q, of ``PERIODS`` periods and
    ``LEAST_WORDS`` words at least, that no neighbouring word extends. ``tail(doc_id, n)`` may give the
    first word and the period of a text's end that is made periodic before runs are sought.

    Null, empty and blank texts have no words and no runs. Null ids are kept, repeated rows repeated,
    and further columns left out.
    """
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in slices(batches, "_text"):
            data, offsets = binary_bytes(batch.column(1))
            begins, lengths, of = word_spans(data, offsets)
            counts = np.bincount(of, minlength=batch.num_rows)
            first = np.cumsum(counts) - counts
            words = word_numbers(data, lengths)
            if tail is not None:
                taken = np.arange(len(begins))
                for n, (doc_id, size) in enumerate(zip(batch.column(0).to_pylist(), counts.tolist(), strict=True)):
                    change = tail(doc_id, size)
                    if change:
                        a, p = change
                        taken[first[n] + a : first[n] + size] = first[n] + a + np.arange(size - a) % p
                begins, lengths, words = begins[taken], lengths[taken], words[taken]
            owner, start, length, period = find_runs(words, counts)
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, first[owner] + start + period, 1)
            np.add.at(change, first[owner] + start + length, -1)
            kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
            spaced, ends = _spaced(data, begins[kept], lengths[kept])
            edge = np.concatenate([[0], ends])[np.searchsorted(kept, np.append(first, len(words)))]
            whole = memoryview(spaced)
            collapsed = [bytes(whole[a : max(b - 1, a)]) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
            at = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
            items = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], fields=list(run_type))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts.astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(at), items),
                    pa.array(collapsed, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), utf8(text).alias("_text"))
    kind = "array<struct<start:long,length:long,period:long>>"
    return rows.mapInArrow(run, f"doc_id long, n_words long, runs {kind}, collapsed string")

