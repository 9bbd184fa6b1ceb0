"""Connected components of a graph given as a table of links, by alternating stars.

Each round hooks every vertex's larger neighbours, and then its smaller ones, to the smallest
vertex known to it. Trees flatten in a logarithmic number of rounds. A vertex with very many
links is only ever a key of an aggregation with map-side partials, or of a merge join of two
stored tables, whose large partitions adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import Work


def components(links: DataFrame, work: Work) -> DataFrame:
    """``links`` has long columns ``a`` and ``b``. Returns ``id`` and ``root``, the smallest id
    reachable, for every id that is linked to another one. Links to itself, repeated links and
    links with a null are ignored; without links the result is empty.
    """
    edges = work.stage(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    while not _is_stars(edges):
        before = [name for name in ("links", "small") if name in work.paths]
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = work.stage(_least(both), "least")
        large = (
            both.where("v > u")
            .join(least.hint("merge"), "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        edges = work.stage(large.where("u != v").distinct(), "large")
        work.drop("least", *before)
        least = work.stage(_least(edges), "least")
        small = edges.join(least.hint("merge"), "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        edges = work.stage(small.where("u != v").distinct(), "small")
        work.drop("least", "large")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _is_stars(edges: DataFrame) -> bool:
    """Whether every larger end has one link, and none of them is a smaller end as well."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("ups"), F.lit(0).alias("downs"))
    ends = ends.unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("ups"), F.lit(1).alias("downs"))
    )
    found = ends.groupBy("x").agg(F.sum("ups").alias("ups"), F.max("downs").alias("downs"))
    return found.where("ups > 1 or (ups > 0 and downs > 0)").limit(1).count() == 0
