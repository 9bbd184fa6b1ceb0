import pytest

from gaugeworks import job
from gaugeworks.operators.dimension import SEED, ensure, insert_ignore, seed
from gaugeworks.sources import dimension as read_dimension
from gaugeworks.sources import inputs, kafka_options, messages, results, write_results
from helpers import JOB_FAILED, dimension


def as_dict(df):
    return {row.id: row.type_name for row in df.collect()}


def test_insert_ignore_keeps_existing_names(spark):
    new = spark.createDataFrame([(1, "b"), (2, "c"), (2, "c")], "id int, type_name string")
    got = insert_ignore(dimension(spark, {1: "a"}), new)
    assert as_dict(got) == {1: "a", 2: "c"} and got.count() == 2


def test_table_is_created_and_seeded_once(spark):
    table = "device_types_seeded"
    rows = spark.createDataFrame(SEED, "id int, type_name string")
    for _ in range(2):
        ensure(spark, table)
        seed(spark, rows, table)
    more = spark.createDataFrame([(1, "x"), (6, "Gas Sensor")], "id int, type_name string")
    seed(spark, more, table)
    got = read_dimension(spark, "table", name=table)
    assert as_dict(got) == {**dict(SEED), 6: "Gas Sensor"} and got.count() == 6
    spark.sql(f"DROP TABLE {table}")


def test_dimension_from_files(spark, tmp_path):
    path = str(tmp_path / "dim")
    dimension(spark, {1: "a"}).write.parquet(path)
    assert as_dict(read_dimension(spark, "parquet", path=path)) == {1: "a"}


SAMPLE = [
    ("07:05", "Boiler", 61.5, 12.25),
    ("07:05", "Cellar", 8.75, 90.0),
]
RESULT_DDL = "window_time string, type_name string, avg_temperature double, median_humidity double"


def test_written_messages_read_back(spark, tmp_path):
    path = str(tmp_path / "out")
    write_results(spark.createDataFrame(SAMPLE, RESULT_DDL), "text", path=path)
    lines = sorted(r.value for r in messages(spark, "text", path=path).collect())
    assert lines[0] == (
        '{"window_time":"07:05","type_name":"Boiler",'
        '"avg_temperature":61.5,"median_humidity":12.25}'
    )
    assert sorted(map(tuple, results(spark, "text", path=path).collect())) == SAMPLE


def test_read_back_defaults(spark):
    values = spark.createDataFrame([('{"type_name":"A"}',), ("{}",)], "value string")
    got = sorted(map(tuple, inputs.decode_results(values).collect()))
    assert got == [("?", "?", 0.0, 0.0), ("?", "A", 0.0, 0.0)]


@pytest.mark.parametrize(
    "bad",
    ["null", "{} {}", "[{}]", "text", None, '{},"x":1', '{},"message":{}', '{},"whole":true} x', "{}],[{}"],
)
def test_read_back_of_anything_else_fails(spark, bad):
    values = spark.createDataFrame([("{}",), (bad,)], "value string")
    with pytest.raises(JOB_FAILED):
        inputs.decode_results(values).collect()


def test_repeated_batch_replaces_its_files(spark, tmp_path):
    path = str(tmp_path / "out")
    frame = spark.createDataFrame(SAMPLE, RESULT_DDL)
    for batch in (0, 1, 1):
        write_results(frame, "parquet", batch, path=path)
    assert spark.read.parquet(path).count() == 4


def test_console_sink(spark, capsys):
    write_results(spark.createDataFrame(SAMPLE, RESULT_DDL), "console")
    assert "Boiler" in capsys.readouterr().out


@pytest.mark.parametrize("n", [50, 1000])
def test_console_sink_prints_every_row(spark, capsys, n):
    rows = [("07:05", f"type {i}", float(i), 1.0) for i in range(n)]
    write_results(spark.createDataFrame(rows, RESULT_DDL).repartition(7), "console")
    printed = capsys.readouterr().out
    assert all(f"| type {i} |" in printed for i in range(n))


BAD_SEEDS = {
    "null id": [(None, "a")],
    "null name": [(7, None)],
    "long name": [(7, "x" * 101)],
    "null name beside another": [(7, None), (7, "a")],
}


@pytest.mark.parametrize("case", BAD_SEEDS)
def test_refused_seed_leaves_the_table_as_it_was(spark, case):
    table = "device_types_refusing"
    ensure(spark, table)
    try:
        seed(spark, spark.createDataFrame([(1, "x" * 100)], "id int, type_name string"), table)
        with pytest.raises(ValueError):
            seed(spark, spark.createDataFrame([(2, "b"), *BAD_SEEDS[case]], "id int, type_name string"), table)
        assert as_dict(spark.table(table)) == {1: "x" * 100}
        assert "type_name VARCHAR(100)" in spark.sql(f"SHOW CREATE TABLE {table}").first()[0]
    finally:
        spark.sql(f"DROP TABLE {table}")


class Recorder:
    """Stands in for a reader of a source whose jar is not here."""

    def __init__(self):
        self.calls = {}

    def format(self, name):
        self.calls["format"] = name
        return self

    def options(self, **options):
        self.calls.update(options)
        return self

    def option(self, key, value):
        self.calls[key] = value
        return self

    def load(self, path=None):
        raise StopIteration


class Session:
    def __init__(self):
        self.read = self.readStream = Recorder()


def recorded(call):
    session = Session()
    with pytest.raises(StopIteration):
        call(session)
    return session.read.calls


ENV = {
    "KAFKA_BOOTSTRAP_SERVERS": "broker:9092",
    "POSTGRES_URL": "jdbc:postgresql://db/iot",
    "POSTGRES_USER": "reader",
    "POSTGRES_PASSWORD": "secret",
}


def test_message_log_options():
    log = job.log_options(ENV)
    assert recorded(lambda s: inputs.messages_stream(s, "kafka", **log)) == {
        "format": "kafka",
        "subscribe": "iot-events",
        "startingOffsets": "latest",
        "kafka.bootstrap.servers": "broker:9092",
    }
    read_back = recorded(lambda s: inputs.results(s, "kafka", **log))
    assert read_back["subscribe"] == "iot-aggregated"
    assert read_back["startingOffsets"] == "earliest"
    assert kafka_options(**log) == {
        "topic": "iot-aggregated",
        "kafka.bootstrap.servers": "broker:9092",
    }


def test_source_options_bound_a_backlog_and_name_the_group():
    options = job.source_options({**ENV, "KAFKA_GROUP_ID": "summaries", "MAX_OFFSETS_PER_TRIGGER": "500"})
    calls = recorded(lambda s: inputs.messages_stream(s, "kafka", **options))
    assert calls["maxOffsetsPerTrigger"] == "500" and calls["kafka.group.id"] == "summaries"
    assert job.source_options(ENV)["maxOffsetsPerTrigger"] == "1000000"
    assert "kafka.group.id" not in job.source_options(ENV)


def test_kinds_of_dimension():
    assert job.dimension_source(ENV) == ("jdbc", job.database_options(ENV))
    assert job.dimension_source({"DIMENSION": "table"}) == ("table", {})
    parquet = {"DIMENSION": "parquet", "DIMENSION_PATH": "/types"}
    assert job.dimension_source(parquet) == ("parquet", {"path": "/types"})
    assert job.job_settings({"DIMENSION_TTL_SECONDS": "30"}).dimension_ttl_seconds == 30
    assert job.job_settings({}).dimension_ttl_seconds == 600


def test_database_options():
    options = job.database_options(ENV)
    calls = recorded(lambda s: inputs.dimension(s, "jdbc", **options))
    assert calls == {
        "format": "jdbc",
        "dbtable": "device_types",
        "url": "jdbc:postgresql://db/iot",
        "user": "reader",
        "password": "secret",
    }


def test_credentials_have_no_default():
    with pytest.raises(KeyError):
        job.database_options({})
