"""Only frequent ids of a large dimension are spread and copied."""

import random

import pytest

from gaugeworks import Settings
from gaugeworks.operators.joins import join_lookup
from gaugeworks.operators.lookup import frequent_ids, lookup_join
from gaugeworks.sources import messages_stream
from gaugeworks.functions import decode, encode_reading
from helpers import dimension, readings
from test_plans import plan

LARGE = Settings(broadcast_max_rows=0, salts=8, frequent_ids=10)


def sample(seed):
    rng = random.Random(seed)
    return [(7 if rng.random() < 0.4 else rng.randrange(60), rng.random() * 59, 1, n) for n in range(900)]


def test_more_than_a_share_of_the_rows_is_frequent(spark):
    rows = [(1, 1, 1, n) for n in range(50)] + [(2, 1, 1, n) for n in range(41)] + [(n, 1, 1, 1) for n in range(3, 12)]
    frame = readings(spark, rows)
    assert sorted(r.type_id for r in frequent_ids(frame, LARGE).collect()) == [1, 2]
    assert [r.type_id for r in frequent_ids(frame, Settings(frequent_ids=2)).collect()] == []
    assert frequent_ids(frame.limit(0), LARGE).collect() == []


@pytest.mark.parametrize("seed", range(2))
def test_same_rows_as_without(spark, seed):
    frame, dim = readings(spark, sample(seed)), dimension(spark, {n: f"t{n}" for n in range(0, 60, 2)} | {7: "hot"})
    frequent = frequent_ids(frame, LARGE)
    assert [r.type_id for r in frequent.collect()] == [7]
    got = lookup_join(frame, dim, LARGE, frequent)
    text = plan(got)
    assert text.count("SortMergeJoin") == 1 and "explode" in text
    want = lookup_join(frame, dim)
    assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())


def test_only_frequent_ids_are_copied(spark):
    frame, dim = readings(spark, sample(5)), dimension(spark, {n: f"t{n}" for n in range(60)})
    names = dim.withColumnsRenamed({"id": "type_id"})
    options = {"broadcast": False, "salts": 8}
    joined = join_lookup(frame, names, ["type_id"], "left", **options, frequent=frequent_ids(frame, LARGE))
    joined.collect()
    made = joined._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in made
    copies = _rows_of_generate(joined)
    assert copies == 59 + 8
    whole = join_lookup(frame, names, ["type_id"], "left", **options)
    whole.collect()
    assert _rows_of_generate(whole) == 60 * 8


def _rows_of_generate(frame):
    def find(node):
        name = node.nodeName()
        if name == "Generate":
            return node.metrics().apply("numOutputRows").value()
        if name == "AdaptiveSparkPlan":
            return find(node.executedPlan())
        if name.endswith("QueryStage"):
            return find(node.plan())
        children = node.children()
        for i in range(children.size()):
            found = find(children.apply(i))
            if found is not None:
                return found
        return None

    return find(frame._jdf.queryExecution().executedPlan())


def test_null_ids_and_other_kinds_of_join(spark):
    left = spark.createDataFrame([(None, n) for n in range(40)] + [(1, 100), (2, 101)], "type_id int, x int")
    right = spark.createDataFrame([(1, "a"), (3, "c")], "type_id int, name string")
    hot = spark.createDataFrame([(1,), (1,), (9,)], "type_id int")
    for how, want in (("left", 42), ("inner", 1), ("left_semi", 1), ("left_anti", 41)):
        got = join_lookup(left, right, ["type_id"], how, broadcast=False, salts=4, frequent=hot)
        assert got.count() == want == left.join(right, "type_id", how).count()


def test_in_a_stream(spark, tmp_path):
    frame, dim = readings(spark, sample(9)), dimension(spark, {n: f"t{n}" for n in range(60)})
    frame.select(encode_reading().alias("value")).write.text(str(tmp_path / "in"))
    stream = decode(messages_stream(spark, "text", path=str(tmp_path / "in")))
    named = lookup_join(stream, dim, LARGE, frequent_ids(frame, LARGE))
    writer = named.writeStream.format("parquet").option("path", str(tmp_path / "out"))
    writer.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    got = sorted((r.type_id, r.humidity, r.type_name) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == sorted((r.type_id, r.humidity, r.type_name) for r in lookup_join(frame, dim).collect())
