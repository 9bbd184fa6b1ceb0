"""Main text of web pages by gradient-boosted trees over DOM nodes and hierarchical decoding.

The trees give every block chances of lying outside around the article, in it, or in boilerplate.
Labels are then chosen for the whole page at once: below boilerplate is only boilerplate, below the
article only article or boilerplate, and of all such labellings the likeliest is taken. So a node
and its ancestors cannot contradict each other.

There are no labelled pages among the tables, so the trees learn from composed ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from math import log
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.boosting import Trees, fit
from gaugeworks.llm.common import slices, utf8
from gaugeworks.llm.dom import Node, node_features, parse
from gaugeworks.llm.page_layouts import BOILERPLATE, CONTENT, OUTER, Composer

#: Composed pages to learn from.
TRAINING_PAGES = 1600


@dataclass
class Model:
    trees: Trees
    odds: dict[str, tuple[float, float]]
    follows: Any  # log odds of a label below each label, against its share of all blocks


def labelled(seed: int) -> tuple[list[Node], list[int]]:
    """A composed page's blocks and labels. A block with children is what all texts below it are, or
    else outside; where the article has boilerplate in it, it is still the article."""
    page, texts = Composer(seed).page()
    nodes = parse(page)
    expected = iter(texts)
    below: list[set[int]] = [set() for _ in nodes]
    for node, found in zip(nodes, below, strict=True):
        if node.text:
            text, label = next(expected)
            assert text == node.text, (text, node.text)
            found.add(label)
    for i in range(len(nodes) - 1, 0, -1):
        below[nodes[i].parent] |= below[i]
    labels = [next(iter(b)) if len(b) == 1 else OUTER if b else BOILERPLATE for b in below]
    holds = [sum(CONTENT in below[c] for c in node.children) for node in nodes]
    for i, node in enumerate(nodes):
        # The smallest block around the whole article, and those within it, are the article.
        if labels[i] == OUTER and (holds[i] > 1 or (node.parent >= 0 and labels[node.parent] == CONTENT)):
            labels[i] = CONTENT
    return nodes, labels


@cache
def train(pages: int = TRAINING_PAGES, seed: int = 0) -> Model:
    """Trees and odds of attribute words, from composed pages."""
    import numpy as np

    examples = [labelled(seed + i) for i in range(pages)]
    times: dict[str, list[int]] = {}
    for nodes, labels in examples:
        for node, label in zip(nodes, labels, strict=True):
            for token in set(node.tokens):
                times.setdefault(token, [0, 0, 0])[label] += 1
    odds = {
        token: (log((c[CONTENT] + 0.5) / (sum(c) - c[CONTENT] + 0.5)), log((c[BOILERPLATE] + 0.5) / (sum(c) - c[BOILERPLATE] + 0.5)))
        for token, c in times.items()
        if sum(c) >= 5
    }
    x = np.concatenate([node_features(nodes, odds) for nodes, _ in examples])
    y = np.concatenate([labels for _, labels in examples])
    weight = (len(y) / (3 * np.bincount(y, minlength=3)))[y] ** 0.5
    pairs = np.ones((3, 3))
    for nodes, labels in examples:
        for node, label in zip(nodes[1:], labels[1:], strict=True):
            pairs[labels[node.parent], label] += 1
    share = np.bincount(y, minlength=3) / len(y)
    follows = np.log(pairs / pairs.sum(axis=1, keepdims=True)) - np.log(share)
    return Model(fit(x, y, 3, weight), odds, follows)


def decode(nodes: list[Node], log_p, follows) -> list[int]:
    """The likeliest labels without contradictions between a block and those above it."""
    best, follows = log_p.tolist(), follows.tolist()
    options = {OUTER: (OUTER, CONTENT, BOILERPLATE), CONTENT: (CONTENT, BOILERPLATE), BOILERPLATE: (BOILERPLATE,)}
    for i in range(len(nodes) - 1, 0, -1):  # children come after their parents
        up = best[nodes[i].parent]
        for label, allowed in options.items():
            up[label] += max(best[i][a] + follows[label][a] for a in allowed)
    labels = [OUTER] * len(nodes)
    for i, node in enumerate(nodes):
        above = labels[node.parent] if i else OUTER
        labels[i] = max(options[above], key=lambda a: best[i][a] + (follows[above][a] if i else 0))
    return labels


def main_texts(pages: list[str], model: Model) -> list[str]:
    """The main text of each page: its blocks joined by an empty line."""
    import numpy as np

    trees = [parse(page) for page in pages]
    x = np.concatenate([node_features(nodes, model.odds) for nodes in trees])
    log_p = model.trees.log_probabilities(x)
    found, at = [], 0
    for nodes in trees:
        labels = decode(nodes, log_p[at : at + len(nodes)], model.follows)
        at += len(nodes)
        found.append("\n\n".join(n.text for n, label in zip(nodes, labels, strict=True) if n.text and label == CONTENT))
    return found


def extract(
    pages: DataFrame,
    model: Model | None = None,
    html: str = "html",
    keep: tuple[str, ...] = ("page_id", "url"),
) -> DataFrame:
    """Per row of ``pages``: the columns ``keep``, ``text`` and ``n_chars``, its code points.

    Character references are decoded, white space within a block is one space. A page that is null,
    empty or without an article has an empty text. Repeated rows are repeated, nulls in ``keep`` are
    kept, columns that aren't in ``keep`` are left out. Pages are read whole, however long.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or train())  # a fixed number of trees

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_html"):
            texts = main_texts([h.as_py().decode() for h in batch.column(len(keep))], shared.value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(texts), pa.array(list(map(len, texts)), pa.int64())],
                [*keep, "text", "n_chars"],
            )

    rows = pages.select(*keep, utf8(html).alias("_html"))
    schema = rows.select(*keep, F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    return rows.mapInArrow(run, schema)
