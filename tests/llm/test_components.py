import random

import pytest

from cases import Forest
from gaugeworks.llm.common import Work
from gaugeworks.llm.components import components


@pytest.mark.parametrize("seed", range(4))
def test_random_graphs_equal_union_find(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(rng.choice([20, 120, 300]))]
    if seed == 3:  # a path, the other way round
        links = [(i + 1, i) for i in range(40)]
    forest = Forest(range(200))
    for a, b in links:
        forest.link(a, b)
    frame = spark.createDataFrame([*links, (None, 3), (4, None), (5, 5)], "a long, b long")
    got = {r.id: r.root for r in components(frame, Work(spark, "t")).collect()}
    touched = {x for link in links if link[0] != link[1] for x in link}
    assert {i: got.get(i, i) for i in touched} == {i: forest.find(i) for i in touched}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long"), Work(spark, "t")).collect() == []
