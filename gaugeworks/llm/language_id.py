"""Language identification by multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, everything between them becomes one space, and the n-grams of one to
``LONGEST`` characters are hashed into ``BUCKETS`` numbers. Training counts the numbers by language over
all learning texts: tasks add up whole texts, Spark adds up what they found. The model is a matrix of
log probabilities, a row per language and a column per number. Its size is bounded, so it is broadcast.
A text is scored by adding up the entries of its n-grams, for a batch of texts at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import slices, utf8

LONGEST = 4
BUCKET_BITS = 16
#: Added to every count.
SMOOTHING = 0.5
#: Languages that a model may have: its matrix takes half a megabyte for each.
MAX_LANGUAGES = 256
#: Languages whose counts a task holds before it passes them on.
HELD_LANGUAGES = 32
UNKNOWN = "und"
#: Characters whose n-grams are looked at together.
PART = 1 << 18
SPACE = 0x20


@dataclass
class Model:
    """``languages`` in order, log ``priors``, and ``log_p`` by language and number of an n-gram."""

    languages: list[str]
    priors: Any
    log_p: Any


@cache
def _folded():
    """By code point: the letter in lower case, or a space for what is no letter."""
    import numpy as np

    table = np.full(0x110000, SPACE, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            lower = char.lower()
            table[code] = ord(lower) if len(lower) == 1 else code
    return table


def characters(texts: list[str]):
    """The texts as lower-case letters with one space before, after and between runs of them, all in
    one array, and where each text begins. A text without letters is at most two spaces."""
    import numpy as np

    pieces, begins, total = [], [], 0

    def add(text: str, starts, inside: bool) -> bool:
        """``starts`` are the places in ``text`` where texts begin; ``inside`` tells whether a letter
        stands just before it. Returns whether it ends with one."""
        nonlocal total
        folded = _folded()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
        letter = folded != SPACE
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[0] |= inside
        keep[starts] = True
        at = np.flatnonzero(keep)
        pieces.append(folded[at])
        begins.append(total + np.searchsorted(at, starts))
        total += len(at)
        return bool(letter[-1])

    held, size = [], 0
    for text in [*texts, None]:
        if held and (text is None or size + len(text) > PART):
            ends = np.cumsum([len(t) + 2 for t in held])
            add("".join(f" {t} " for t in held), np.concatenate([[0], ends[:-1]]), False)
            held, size = [], 0
        if text is None:
            break
        if len(text) <= PART:
            held.append(text)
            size += len(text)
            continue
        inside = add(" ", [0], False)
        for begin in range(0, len(text), PART):
            inside = add(text[begin : begin + PART], np.zeros(0, np.int64), inside)
        add(" ", np.zeros(0, np.int64), inside)
    none = np.zeros(0, np.int64)
    return np.concatenate([*pieces, none.astype(np.uint32)]), np.concatenate([*begins, none])


def numbers(chars, starts, longest: int = LONGEST):
    """For parts of the characters and each length of n-grams: the numbers of the n-grams that begin
    in the part and end in the text where they begin, and the texts' indexes, which ascend."""
    import numpy as np

    text = np.repeat(np.arange(len(starts), dtype=np.int32), np.diff(np.append(starts, len(chars))))
    for begin in range(0, len(chars), PART):
        end = min(begin + PART, len(chars))
        # The n-grams that begin at the part's last characters end behind it.
        wide = chars[begin : end + longest - 1].astype(np.uint64)
        of = text[begin : end + longest - 1]
        rolled = np.zeros(len(wide), np.uint64)
        for n in range(1, longest + 1):
            count = min(end - begin, len(wide) - n + 1)
            if count <= 0:
                break
            rolled = (rolled[: len(wide) - n + 1] + wide[n - 1 :] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            rolled ^= rolled >> np.uint64(29)
            mixed = (rolled[:count] * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BUCKET_BITS)
            within = of[:count] == of[n - 1 : n - 1 + count]
            yield mixed.astype(np.int64)[within], of[:count][within]


def _texts(column: pa.Array) -> list[str]:
    return column.cast(pa.large_string()).to_pylist()


def counted(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang``, ``number``, ``n``: how often each n-gram's number occurs in the texts of a language,
    and as number -1 how many texts it has. Rows with a null text or language are left out."""
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        held: dict[str, Any] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for name in list(held):
                found = held.pop(name)
                at = np.flatnonzero(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(at), pa.string()), pa.array(at - 1), pa.array(found[at])],
                    ["lang", "number", "n"],
                )

        for batch in slices(batches, "_text"):
            for name in pc.unique(batch.column(0)).to_pylist():
                own = batch.filter(pc.equal(batch.column(0), name))
                if name not in held and len(held) >= HELD_LANGUAGES:
                    yield from rows()
                total = held.setdefault(name, np.zeros((1 << BUCKET_BITS) + 1, np.int64))
                total[0] += own.num_rows
                for number, _ in numbers(*characters(_texts(own.column(1)))):
                    total[1:] += np.bincount(number, minlength=1 << BUCKET_BITS)
        yield from rows()

    learned = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    learned = learned.select(F.col(lang).cast("string").alias("lang"), utf8(text).alias("_text"))
    found = learned.mapInArrow(run, "lang string, number long, n long")
    return found.groupBy("lang", "number").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """A model of all given rows that have a text and a language. The driver gets one array of fixed
    size per language; more than ``MAX_LANGUAGES`` are refused. Without such rows the model has no
    language."""
    import numpy as np

    def packed(table: pa.Table) -> pa.Table:
        counts = np.zeros((1 << BUCKET_BITS) + 1, np.int64)
        counts[table.column("number").to_numpy() + 1] = table.column("n").to_numpy()
        return pa.table({"lang": table.column("lang").slice(0, 1), "counts": pa.array([counts.tobytes()], pa.binary())})

    # A group has a row per number at most.
    by_language = counted(docs, text, lang).groupBy("lang").applyInArrow(packed, "lang string, counts binary")
    rows = sorted(by_language.limit(MAX_LANGUAGES + 1).collect(), key=lambda row: row["lang"].encode())
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = np.array([np.frombuffer(row["counts"], np.int64) for row in rows], np.float64)
    if not len(counts):
        return Model([], np.zeros(0), np.zeros((0, 1 << BUCKET_BITS), np.float32))
    smooth = counts[:, 1:] + SMOOTHING
    log_p = np.log(smooth) - np.log(smooth.sum(axis=1, keepdims=True))
    priors = np.log(counts[:, 0] / counts[:, 0].sum())
    return Model([row["lang"] for row in rows], priors, log_p.astype(np.float32))


def likelihoods(texts: list[str], model: Model):
    """By text and language the log of the joint probability, and whether the text has a letter."""
    import numpy as np

    chars, starts = characters(texts)
    found = np.tile(model.priors, (len(texts), 1))
    for number, of in numbers(chars, starts):
        if not len(number):
            continue
        first = int(of[0])
        for k in range(len(model.languages)):
            sums = np.bincount(of - first, model.log_p[k][number])
            found[first : first + len(sums), k] += sums
    # The first character is a space, and the second one a letter if there is any.
    second = np.minimum(starts + 1, len(chars) - 1)
    letters = (np.diff(np.append(starts, len(chars))) > 1) & (chars[second] != SPACE)
    return found, letters


def predict(docs: DataFrame, model: Model, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``lang_pred``, the likeliest of the model's languages (of equal
    ones the first by name), and ``score``, its probability given the text.

    Texts that are null or have no letter get ``und`` with score 0, and so does every text if the
    model has no language. Null ids are kept and repeated rows repeated; further columns are left out.
    """
    import numpy as np

    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the number of languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in slices(batches, "_text"):
            if model.languages:
                found, letters = likelihoods(_texts(batch.column(1)), model)
                best = found.argmax(axis=1)
                chance = 1 / np.exp(found - found.max(axis=1, keepdims=True)).sum(axis=1)
            else:
                letters, best, chance = (np.zeros(batch.num_rows, kind) for kind in (bool, int, float))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(names[np.where(letters, best, len(names) - 1)], pa.string()),
                    pa.array(np.where(letters, chance, 0.0)),
                ],
                ["doc_id", "lang_pred", "score"],
            )

    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), utf8(text).alias("_text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(doc: str = "doc_id") -> Column:
    """Whether a document is kept from learning: by its id's checksum, one in four. Null for a null id,
    which neither learns nor is held out."""
    return F.crc32(F.col(doc).cast("string").cast("binary")) % 4 == 2
