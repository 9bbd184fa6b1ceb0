"""Text quality as perplexity under an interpolated modified Kneser-Ney model.

The model is over bytes, of order five, one per language, trained on all trusted texts. An n-gram is
the number its bytes form, so counts are exact and nothing is hashed. Counts, continuation counts,
discounts and back-off weights are tables, made by groupings and joins on (language, n-gram).

Documents are scored by joining them with those tables in shards. A task packs its texts into blocks
of one language and keeps the block's distinct n-grams, of which there are far fewer than bytes. The
distinct n-grams of all blocks are joined with the counts of every order. Shards of the result are
then matched with the blocks' lists, and what comes back to a block is one number for each of its
n-grams. So no task holds the model, and texts move once, compressed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import Work, binary_bytes, row_key, slices, utf8, with_row_key

ORDER = 5
#: Rows of a table of one-byte or two-byte n-grams up to which it is broadcast: fewer than 66 000 a language,
#: so only some dozens of languages have more.
FEW = 1_000_000
#: Bytes before and after every text.
BEGIN, END = 0x02, 0x03
SYMBOLS = 256
BLOCK_BYTES = 8 << 20
#: Of the compression of what moves between tasks.
LEVEL = 9
#: Distinct n-grams of the model, and n-grams of blocks, that one task matches.
SHARD_ROWS = 200_000
SHARD_LOOKUPS = 4_000_000
#: A text's mean cost is taken with this many bytes of average cost, so that a handful of odd words
#: does not decide on a short text.
PRIOR_BYTES = 200
#: Share of a language's trusted texts, of those not trained on, that are below its threshold. A share
#: nearer to one would be the maximum of fewer than a hundred texts, which one wrong label decides.
QUANTILE = 0.98
#: For its sampling error the quantile is widened by so many distances from the median to the 0.9 quantile
#: over the root of n, the number of held-out texts, and by one part in that root more as the distance is
#: from them too. That is two to three standard errors if scores are normal, and vanishes as n grows.
SPREAD = 6.0
#: Percentage of trusted texts that set the thresholds instead of training.
HELD_OUT = 20


def ngrams(data, offsets):
    """The n-grams ending at each byte of each text and at its end mark, as numbers, and the number
    of them by text."""
    import numpy as np

    sizes = np.diff(offsets)
    padded = np.full(len(data) + len(sizes) * ORDER, BEGIN, np.int64)
    # Each text has ORDER - 1 begin marks before it and one end mark behind.
    shift = np.arange(len(sizes)) * ORDER + ORDER - 1
    padded[np.arange(len(data)) + np.repeat(shift, sizes)] = data
    ends = offsets[1:] + shift
    padded[ends] = END
    codes = np.zeros(len(padded) - ORDER + 1 if len(sizes) else 0, np.int64)
    for k in range(ORDER):
        codes = (codes << 8) | padded[k : k + len(codes)]
    # Windows that begin in one text and end in the next one's begin marks are none.
    within = np.ones(len(codes), bool)
    for k in range(ORDER - 1):
        at = ends[:-1] + 1 + k - (ORDER - 1)
        within[at] = False
    return codes[within], sizes + 1


def _pack(codes) -> bytes:
    import numpy as np
    import zstandard

    return zstandard.compress(np.diff(codes, prepend=np.int64(0)).tobytes(), LEVEL)


def _unpack(packed: bytes):
    import numpy as np
    import zstandard

    return np.cumsum(np.frombuffer(zstandard.decompress(packed), np.int64))


def _blocks(docs: DataFrame, text: str, doc: str, lang: str) -> DataFrame:
    """Texts in blocks of one language: ``block``, ``lang``, the texts' keys and ids, their sizes and
    bytes, and the block's distinct n-grams in order."""
    import numpy as np

    names = ["block", "lang", "k1", "k2", "ids", "null_ids", "sizes", "texts", "codes"]
    kinds = [pa.int64(), pa.string(), *[pa.binary()] * 7]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def block(lang_, parts) -> pa.RecordBatch:
        import uuid

        import zstandard

        whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        data, offsets = binary_bytes(whole.column(4))
        codes = []
        for at in range(0, len(offsets) - 1, 256):
            to = min(at + 256, len(offsets) - 1)
            part = data[offsets[at] : offsets[to]]
            codes.append(np.unique(ngrams(part, offsets[at : to + 1] - offsets[at])[0]))
        ids = whole.column(2)
        values = [
            uuid.uuid4().int >> 65,
            lang_,
            whole.column(0).to_numpy().tobytes(),
            whole.column(1).to_numpy().tobytes(),
            ids.fill_null(0).to_numpy().tobytes(),
            ids.is_null().to_numpy(zero_copy_only=False).tobytes(),
            np.diff(offsets).tobytes(),
            zstandard.compress(data.tobytes(), LEVEL),
            _pack(np.unique(np.concatenate(codes))),
        ]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        held: dict[str | None, list[pa.RecordBatch]] = {}
        size: dict[str | None, int] = {}
        for batch in slices(batches, "_text", BLOCK_BYTES // 4):
            codes = batch.column(3)
            for value in pc.unique(codes).to_pylist():
                same = pc.is_null(codes) if value is None else pc.fill_null(pc.equal(codes, value), False)
                part = batch.filter(same)
                held.setdefault(value, []).append(part)
                size[value] = size.get(value, 0) + len(binary_bytes(part.column(4))[0])
                if size[value] >= BLOCK_BYTES:
                    yield block(value, held.pop(value))
                    del size[value]
            # Many languages at once must not add up.
            while sum(size.values()) > 4 * BLOCK_BYTES:
                value = max(size, key=size.get)
                yield block(value, held.pop(value))
                del size[value]
        for value, parts in held.items():
            yield block(value, parts)

    frame = docs.select(
        *row_key(doc, text),
        F.col(doc).cast("long").alias("_id"),
        F.col(lang).cast("string").alias("_lang"),
        utf8(text).alias("_text"),
    )
    return frame.mapInArrow(run, "block long, lang string, " + ", ".join(f"{n} binary" for n in names[2:]))


def _texts(row: dict):
    """A block's texts and their offsets."""
    import numpy as np
    import zstandard

    sizes = np.frombuffer(row["sizes"], np.int64)
    data = np.frombuffer(zstandard.decompress(row["texts"]), np.uint8)
    return data, np.concatenate([[0], np.cumsum(sizes)])


def _counts(blocks: DataFrame, trusted: DataFrame) -> DataFrame:
    """``lang``, ``w``, ``c``: how often each n-gram is in texts with a trusted id."""
    import numpy as np

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, own, null in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                known = ~np.frombuffer(null, bool)
                at = np.flatnonzero(known)
                doc = np.frombuffer(own, np.int64)[known]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), block)), pa.array(at), pa.array(doc)], ["block", "at", "_id"]
                )

    refs = blocks.select("block", "ids", "null_ids").mapInArrow(ids, "block long, at long, _id long")
    chosen = refs.join(trusted, "_id", "left_semi").groupBy("block").agg(F.collect_list("at").alias("at"))
    rows = blocks.select("block", "lang", "sizes", "texts").join(chosen.hint("merge"), "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = {c: batch.column(batch.schema.get_field_index(c))[n].as_py() for c in ("lang", "sizes", "texts", "at")}
                data, offsets = _texts(row)
                found, times = [], []
                at = np.sort(np.array(row["at"], np.int64))
                for some in np.array_split(at, len(at) // 256 + 1):
                    sizes = offsets[some + 1] - offsets[some]
                    part = np.concatenate([data[offsets[i] : offsets[i + 1]] for i in some] or [data[:0]])
                    codes, _ = ngrams(part, np.concatenate([[0], np.cumsum(sizes)]))
                    u, c = np.unique(codes, return_counts=True)
                    found.append(u)
                    times.append(c)
                codes, inverse = np.unique(np.concatenate(found), return_inverse=True)
                counts = np.bincount(inverse, np.concatenate(times), len(codes)).astype(np.int64)
                lang = pa.array([row["lang"]] * len(codes), pa.string())
                yield pa.RecordBatch.from_arrays([lang, pa.array(codes), pa.array(counts)], ["lang", "w", "c"])

    counted = rows.mapInArrow(run, "lang string, w long, c long")
    return counted.groupBy("lang", "w").agg(F.sum("c").alias("c"))


def _suffix(n: int) -> Column:
    """The last ``n`` bytes of ``w``."""
    return F.col("w").bitwiseAND(F.lit((1 << (8 * n)) - 1))


def _discounts(counts: DataFrame) -> DataFrame:
    """The three modified Kneser-Ney discounts by language, from the numbers of n-grams with one to
    four occurrences. Where such a number is zero the discount is half of what it can be."""
    of = {k: F.sum((F.col("c") == k).cast("double")).alias(f"n{k}") for k in (1, 2, 3, 4)}
    table = counts.groupBy("lang").agg(*of.values())
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))

    def discount(k: int) -> Column:
        ok = (F.col("n1") > 0) & (F.col(f"n{k}") > 0)
        value = F.when(ok, k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")).otherwise(k / 2)
        return F.greatest(F.least(value, F.lit(float(k))), F.lit(0.01)).alias(f"d{k}")

    return table.select("lang", discount(1), discount(2), discount(3))


def model(counts: DataFrame, work: Work) -> tuple[list[DataFrame], list[DataFrame]]:
    """By order from one up: probabilities (``lang``, ``w``, ``p``) of the n-grams seen, and back-off
    weights (``lang``, ``h``, ``g``) of the contexts seen."""
    tables = {ORDER: work.stage(counts, f"counts{ORDER}")}
    for n in range(ORDER - 1, 0, -1):
        # How many different bytes stand before it.
        lower = tables[n + 1].groupBy("lang", _suffix(n).alias("w")).agg(F.count(F.lit(1)).alias("c"))
        tables[n] = work.stage(lower, f"counts{n}")
    probabilities, weights = [], []
    for n in range(1, ORDER + 1):
        # One row per language with trusted text.
        discounts = F.broadcast(_discounts(tables[n]).withColumnRenamed("lang", "_of"))
        taken = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = (
            tables[n]
            .join(discounts, F.col("lang").eqNullSafe(F.col("_of")))
            .select("lang", "w", "c", F.least(taken, "c").alias("d"))
            .withColumn("h", F.shiftright("w", 8))
        )
        contexts = rows.groupBy("lang", "h").agg(F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("g"))
        contexts = work.stage(contexts, f"contexts{n}")
        own = _null_safe(rows, contexts, ["h"]).withColumn("own", (F.col("c") - F.col("d")) / F.col("total"))
        if n == 1:
            result = own.select("lang", "w", (F.col("own") + F.col("g") / SYMBOLS).alias("p"))
        else:
            shorter = probabilities[-1].select("lang", F.col("w").alias("s"), F.col("p").alias("q"))
            joined = _null_safe(own.withColumn("s", _suffix(n - 1)), shorter, ["s"])
            result = joined.select("lang", "w", (F.col("own") + F.col("g") * F.col("q")).alias("p"))
        probabilities.append(work.stage(result, f"order{n}"))
        work.drop(f"counts{n}")
        weights.append(contexts.select("lang", "h", "g"))
    return probabilities, weights


def _null_safe(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", hint: str = "merge"
) -> DataFrame:
    """Join on language and ``keys``; a null language equals itself."""
    renamed = right.toDF(*[f"_r_{c}" for c in right.columns])
    condition = F.col("lang").eqNullSafe(F.col("_r_lang"))
    for key in keys:
        condition &= F.col(key) == F.col(f"_r_{key}")
    kept = [F.col(f"_r_{c}").alias(c) for c in right.columns if c not in ("lang", *keys)]
    return left.join(renamed.hint(hint), condition, how).select(*left.columns, *kept)


def _costs(blocks: DataFrame, probabilities: list[DataFrame], weights: list[DataFrame], work: Work) -> DataFrame:
    """``lang``, ``w``, ``cost``: minus the log probability of every distinct n-gram of the blocks, by
    joins with the counts of each order."""
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                codes = _unpack(packed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(codes), pa.string()), pa.array(codes)], ["lang", "w"]
                )

    rows = blocks.select("lang", "codes").mapInArrow(run, "lang string, w long").distinct()
    rows = work.stage(rows, "wanted")
    # A language without trusted text has no model.
    trained = weights[0].select(F.col("lang").alias("_trained")).distinct()
    rows = rows.join(F.broadcast(trained), F.col("lang").eqNullSafe(F.col("_trained")), "left_semi")
    for n in range(ORDER, 0, -1):
        p, g = probabilities[n - 1], weights[n - 1]
        rows = rows.withColumns({f"s{n}": _suffix(n), f"h{n}": F.shiftright(_suffix(n), 8)})
        # Short n-grams are few and each is in very many of the rows, which must not meet in a task.
        hint = "broadcast" if n <= 2 and p.count() <= FEW else "merge"
        p = p.select("lang", F.col("w").alias(f"s{n}"), F.col("p").alias(f"p{n}"))
        g = g.select("lang", F.col("h").alias(f"h{n}"), F.col("g").alias(f"g{n}"))
        rows = _null_safe(rows, p, [f"s{n}"], "left", hint)
        rows = _null_safe(rows, g, [f"h{n}"], "left", hint).drop(f"s{n}", f"h{n}")
        if n > 2:
            rows = work.stage(rows, f"wanted{n}")
            work.drop("wanted" if n == ORDER else f"wanted{n + 1}", f"order{n}", f"contexts{n}")
    total = F.lit(1.0 / SYMBOLS)
    for n in range(1, ORDER + 1):
        # Seen: its probability, which has the shorter ones in it. Not seen: what the context leaves.
        total = F.coalesce(F.col(f"p{n}"), F.coalesce(F.col(f"g{n}"), F.lit(1.0)) * total)
    costs = work.stage(rows.select("lang", "w", (-F.log(total)).alias("cost")), "costs")
    work.drop("wanted3", *[f"{kind}{n}" for kind in ("order", "contexts") for n in (1, 2)])
    return costs


def _shard(codes, shards: int):
    import numpy as np

    mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)


def _answers(blocks: DataFrame, costs: DataFrame, shards: int) -> DataFrame:
    """``block``, ``shard``, ``costs``: those of the block's n-grams in the shard, in order."""
    import numpy as np

    names = ["shard", "kind", "lang", "block", "codes", "costs"]
    kinds = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.binary(), pa.binary()]
    form = pa.schema(list(zip(names, kinds, strict=True)))
    ddl = "shard long, kind int, lang string, block long, codes binary, costs binary"

    def of_model(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for batch in batches:
            langs = batch.column(0)
            for lang in pc.unique(langs).to_pylist():
                part = batch.filter(pc.is_null(langs) if lang is None else pc.fill_null(pc.equal(langs, lang), False))
                codes, cost = part.column(1).to_numpy(), part.column(2).to_numpy()
                order = np.lexsort((codes, _shard(codes, shards)))
                codes, cost = codes[order], cost[order]
                shard = _shard(codes, shards)
                rows = [
                    {"shard": int(s), "kind": 0, "lang": lang, "block": None, "codes": _pack(codes[a:b]), "costs": cost[a:b].tobytes()}
                    for s, a, b in _spans(shard)
                ]
                yield pa.RecordBatch.from_pylist(rows, form)

    def of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, lang, packed in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                codes = _unpack(packed)
                shard = _shard(codes, shards)
                order = np.argsort(shard, kind="stable")
                codes, shard = codes[order], shard[order]
                rows = [
                    {"shard": int(s), "kind": 1, "lang": lang, "block": block, "codes": _pack(codes[a:b]), "costs": None}
                    for s, a, b in _spans(shard)
                ]
                yield pa.RecordBatch.from_pylist(rows, form)

    both = costs.mapInArrow(of_model, ddl).unionByName(
        blocks.select("block", "lang", "codes").mapInArrow(of_blocks, ddl)
    )
    dealt = both.repartition(shards, "shard").sortWithinPartitions("shard", "kind")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, tables = None, {}, {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != now:
                    now, parts, tables = row["shard"], {}, {}
                if row["kind"] == 0:
                    one = _unpack(row["codes"]), np.frombuffer(row["costs"])
                    parts.setdefault(row["lang"], []).append(one)
                    continue
                if parts and not tables:
                    for lang, found in parts.items():
                        codes = np.concatenate([c for c, _ in found])
                        order = np.argsort(codes)
                        tables[lang] = codes[order], np.concatenate([x for _, x in found])[order]
                if row["lang"] not in tables:
                    continue  # no model of this language
                codes, cost = tables[row["lang"]]
                found = cost[np.searchsorted(codes, _unpack(row["codes"]))].astype(np.float32).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]]), pa.array([now]), pa.array([found], pa.binary())],
                    ["block", "shard", "costs"],
                )

    return dealt.mapInArrow(match, "block long, shard long, costs binary")


def _spans(sorted_values):
    """Value, begin and end of each run of equal values."""
    import numpy as np

    begins = np.flatnonzero(np.diff(sorted_values, prepend=-1))
    ends = np.append(begins[1:], len(sorted_values))
    return zip(sorted_values[begins], begins, ends, strict=True)


def _scores(blocks: DataFrame, answers: DataFrame, shards: int) -> DataFrame:
    """``_k1``, ``_k2``, ``_id``, ``_lang``, ``_n`` (symbols) and ``_cost`` (their sum) by text."""
    import numpy as np

    columns = ["block", "shard", "costs", "lang", "k1", "k2", "ids", "null_ids", "sizes", "texts", "codes"]
    empty = {c: F.lit(None).cast("binary").alias(c) for c in columns[2:]}
    empty["lang"] = F.lit(None).cast("string").alias("lang")
    of_model = answers.select("block", "shard", "costs", *[empty[c] for c in columns[3:]])
    # After the last shard.
    of_texts = blocks.select("block", F.lit(shards).cast("long").alias("shard"), empty["costs"], *columns[3:])
    dealt = of_model.unionByName(of_texts).repartition("block").sortWithinPartitions("block", "shard")
    names = ["_k1", "_k2", "_id", "_lang", "_n", "_cost"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, costs = None, []
        for batch in batches:
            for n in range(batch.num_rows):
                block, shard = batch.column(0)[n].as_py(), batch.column(1)[n].as_py()
                if block != now:
                    now, costs = block, []
                if shard < shards:
                    costs.append(np.frombuffer(batch.column(2)[n].as_py(), np.float32))
                    continue
                row = {c: batch.column(i)[n].as_py() for i, c in enumerate(columns) if i > 2}
                sizes = np.frombuffer(row["sizes"], np.int64)
                total = np.full(len(sizes), np.nan)
                if costs:
                    codes = _unpack(row["codes"])
                    by_code = np.empty(len(codes))
                    by_code[np.argsort(_shard(codes, shards), kind="stable")] = np.concatenate(costs)
                    data, offsets = _texts(row)
                    for at in range(0, len(sizes), 256):
                        to = min(at + 256, len(sizes))
                        part = data[offsets[at] : offsets[to]]
                        found, count = ngrams(part, offsets[at : to + 1] - offsets[at])
                        each = by_code[np.searchsorted(codes, found)]
                        total[at:to] = np.add.reduceat(each, np.cumsum(count) - count)
                ids = pa.array(np.frombuffer(row["ids"], np.int64), mask=np.frombuffer(row["null_ids"], bool))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(row["k1"], np.int64)),
                        pa.array(np.frombuffer(row["k2"], np.int64)),
                        ids,
                        pa.array([row["lang"]] * len(sizes), pa.string()),
                        pa.array(sizes + 1),
                        pa.array(total, mask=np.isnan(total)),
                    ],
                    names,
                )

    return dealt.select(*columns).mapInArrow(
        run, "_k1 long, _k2 long, _id long, _lang string, _n long, _cost double"
    )


def perplexities(
    docs: DataFrame,
    trusted: DataFrame,
    quantile: float = QUANTILE,
    held_out: int = HELD_OUT,
    prior_bytes: int = PRIOR_BYTES,
    text: str = "text",
    doc: str = "doc_id",
    lang: str = "lang",
) -> DataFrame:
    """Per row of ``docs``: its ``row_key``, ``doc_id``, ``lang``, ``n_bytes``, ``perplexity`` per
    byte, ``score`` (the perplexity taken with ``prior_bytes`` of the language's mean cost),
    ``threshold`` of its language and ``kept``.

    ``trusted`` has the ids (column ``doc_id``) of trusted texts among ``docs``. ``held_out`` percent
    of them, by a hash of the id, set the thresholds: by language the ``quantile`` of their scores and
    an allowance for its sampling error (``SPREAD``), which vanishes as they grow in number. All others
    train. Kept is what is not above the threshold. Empty and null texts, texts in a
    language (null is one) without training text, and those in one without held-out text have no
    perplexity or no threshold and are kept, as nothing speaks against them. Null ids are not trusted, repeated ids in
    ``trusted`` count once. Repeated rows have a row each, and each counts. Further columns are ignored.
    """
    work = Work(docs.sparkSession, "kneser-ney")
    blocks = work.stage(_blocks(docs, text, doc, lang), "blocks")
    known = trusted.select(F.col("doc_id").cast("long").alias("_id")).where("_id is not null").distinct()
    known = work.stage(known, "trusted")
    holds_out = F.pmod(F.xxhash64("_id", F.lit("held out")), F.lit(100)) < held_out
    probabilities, weights = model(_counts(blocks, known.where(~holds_out)), work)
    costs = _costs(blocks, probabilities, weights, work)
    shards = max(1, -(-costs.count() // SHARD_ROWS), -(-blocks.count() * SHARD_ROWS // SHARD_LOOKUPS))
    answers = work.stage(_answers(blocks, costs, shards), "answers")
    work.drop("costs")
    scores = work.stage(_scores(blocks, answers, shards), "scores")
    work.drop("blocks", "answers")

    scores = scores.withColumn("_cost", F.when(F.col("_n") > 1, F.col("_cost")))
    judges = work.stage(scores.join(known.where(holds_out), "_id", "left_semi"), "judges")
    mean = judges.groupBy("_lang").agg((F.sum("_cost") / F.sum("_n")).alias("_mean"))

    def with_score(frame: DataFrame) -> DataFrame:
        means = F.broadcast(mean.withColumnRenamed("_lang", "_m"))  # a row per language
        joined = frame.join(means, F.col("_lang").eqNullSafe(F.col("_m")), "left").drop("_m")
        shrunk = (F.col("_cost") + prior_bytes * F.col("_mean")) / (F.col("_n") + prior_bytes)
        return joined.withColumn("score", F.exp(shrunk))

    points = F.percentile_approx("score", [0.5, 0.9, quantile], 100_000)
    root = F.sqrt("n")
    error = SPREAD * (F.col("q")[1] - F.col("q")[0]) / root * (1 + 1 / root)
    limits = (
        with_score(judges)
        .groupBy("_lang")
        .agg(points.alias("q"), F.count("score").alias("n"))
        .select("_lang", (F.col("q")[2] + error).alias("threshold"))
    )
    limits = F.broadcast(work.stage(limits.withColumnRenamed("_lang", "_m"), "limits"))
    return (
        with_score(scores)
        .join(limits, F.col("_lang").eqNullSafe(F.col("_m")), "left")
        .select(
            "_k1",
            "_k2",
            F.col("_id").alias("doc_id"),
            F.col("_lang").alias("lang"),
            (F.col("_n") - 1).alias("n_bytes"),
            F.exp(F.col("_cost") / F.col("_n")).alias("perplexity"),
            "score",
            "threshold",
            F.coalesce(F.col("score") <= F.col("threshold"), F.lit(True)).alias("kept"),
        )
    )


def keep_good(docs: DataFrame, trusted: DataFrame, text: str = "text", doc: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that ``perplexities`` keeps, unchanged."""
    work = Work(docs.sparkSession, "kept")
    judged = perplexities(docs, trusted, text=text, doc=doc, **options)
    rejected = work.stage(judged.where("not kept").select("_k1", "_k2").distinct(), "rejected")
    keyed = with_row_key(docs, doc, text)
    return keyed.join(rejected.hint("merge"), ["_k1", "_k2"], "left_anti").select("_row.*")
