"""Results after lost tasks: the first attempt of some tasks fails."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = '''
import sys
from pyspark import TaskContext
from pyspark.sql import SparkSession
sys.path[:0] = [{repo!r}, {tests!r}]
spark = (SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", {shared!r})
         .config("spark.sql.session.timeZone", "UTC").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
from gaugeworks import Settings, batch_summary
from gaugeworks.operators.lookup import lookup_join
from gaugeworks.plans.batch import named_summary
from helpers import collected, dimension, expected, readings
from test_batch import NAMES, TIGHT, random_rows

def failing_first(batches):
    context = TaskContext.get()
    for batch in batches:
        yield batch
    if context.partitionId() % 2 and context.attemptNumber() == 0:
        raise RuntimeError("lost")

rows = random_rows(1200, seed=3, digits=9)
frame = readings(spark, rows).repartition(6)
shaky = frame.mapInArrow(failing_first, frame.schema)
want = expected(rows, NAMES)
dim = dimension(spark, NAMES)
for settings in (Settings(), TIGHT):
    assert collected(batch_summary(shaky, dim, settings)) == want
    assert collected(named_summary(lookup_join(shaky, dim, settings), settings)) == want
print("same results")
'''


def test_results_survive_failed_tasks(tmp_path):
    tests = Path(__file__).resolve().parent
    code = SCRIPT.format(repo=str(tests.parent), tests=str(tests), shared=str(tmp_path / "shared"))
    done = subprocess.run(
        [sys.executable, "-c", code], capture_output=True, text=True, timeout=300, env=os.environ
    )
    assert "same results" in done.stdout, done.stderr[-3000:]
