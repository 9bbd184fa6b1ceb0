"""The registered queries and the pipeline on the smallest test tables."""

import duckdb
import pytest

import corpus_pipeline
from cases import SF, clashing
from gaugeworks.llm.best_fit_packing import CAPACITIES
from gaugeworks.llm.oracle import ORACLE
from gaugeworks.llm.queries import QUERIES
from test_best_fit_packing import valid
from test_line_dedup import brute as brute_lines
from test_simhash_dedup import brute_components, brute_print

pytestmark = pytest.mark.skipif(not SF.exists(), reason="test tables are not here")


def test_every_operator_is_registered():
    import __spark_entry__ as driver

    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= driver.queries().keys()
    assert driver.oracle_sql().keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_oracle(spark, name):
    con = duckdb.connect()
    for table in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    got = QUERIES[name](spark, str(SF)).toPandas()
    want = con.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)

    def rows(frame):
        return sorted(map(repr, frame[sorted(frame.columns)].itertuples(index=False, name=None)))

    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", ["op2_toxicity", "op3_kneser_ney"])
def test_one_row_per_document(spark, name):
    got = QUERIES[name](spark, str(SF))
    ids = [r.doc_id for r in got.collect()]
    assert len(ids) == len(set(ids)) == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_stages_keep_their_promises(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    after = [docs]
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, after[-1], str(SF))
        after.append(spark.createDataFrame(rows.collect(), rows.schema))
    assert all(f.columns == docs.columns for f in after[1:-1])
    texts = [{r.doc_id: r.text for r in f.collect()} for f in after[:-1]]
    # Quality: rows are unchanged, and trusted ones stay.
    assert texts[1].items() <= texts[0].items()
    # Lines.
    want = brute_lines(list(texts[1].items()), 10)
    assert texts[2] == {i: t for i, (_, _, t) in want.items()}
    assert all(r.n_chars == len(r.text) for r in after[2].collect())
    # Near duplicates.
    root = brute_components({i: brute_print(t) for i, t in texts[2].items()}, 4)
    assert texts[3] == {i: t for i, t in texts[2].items() if root[i] == i}
    # Benchmark: what goes holds a whole item, what stays none.
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    holds = {i for i, t in texts[3].items() if any(" ".join(x.split()) in " ".join(t.split()) for x in items)}
    assert texts[4].items() <= texts[3].items() and not holds & texts[4].keys()
    # Packing.
    valid(after[5].collect(), {i: len(t.split()) + 1 for i, t in texts[4].items()}, CAPACITIES)


def test_stages_take_odd_tables(spark):
    rows = [(1, None), (1, None), (2, ""), (None, "a b c"), (None, "a b c"), (3, "x " * 5000), (3, "y")]
    for frame in (clashing(spark, rows), clashing(spark, rows).limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            frame = stage(spark, frame, str(SF))
            assert frame.columns == clashing(spark, rows).columns, name
            frame = spark.createDataFrame(frame.collect(), frame.schema)
        assert corpus_pipeline.STAGES[-1][1](spark, frame, str(SF)).count() in (0, 4)
