"""The submitted job, with files standing in for the message log and the database."""

from gaugeworks import job
from gaugeworks.functions import encode_reading
from gaugeworks.sources import messages_stream
from helpers import dimension, readings
from test_dimension_and_sources import ENV
from test_streaming import BASIC, LATER, NAMES


def test_job_runs_end_to_end(spark, tmp_path, monkeypatch, capsys):
    path = str(tmp_path / "in")
    readings(spark, BASIC + LATER).select(encode_reading().alias("value")).write.text(path)
    seen = {}

    def log_stream(session, fmt, **options):
        seen["log"] = (fmt, options)
        return messages_stream(session, "text", path=path)

    def database(session, fmt, **options):
        seen["database"] = (fmt, options)
        return dimension(session, NAMES)

    def run_once(readings, names, write, checkpoint, settings, **trigger):
        seen["trigger"], seen["ttl"] = trigger, settings.dimension_ttl_seconds
        refreshing(
            readings, names, write, str(tmp_path / "checkpoint"), settings, rounds=1, availableNow=True
        )

    refreshing = job.run_refreshing
    monkeypatch.setattr(job, "messages_stream", log_stream)
    monkeypatch.setattr(job, "dimension", database)
    monkeypatch.setattr(job, "run_refreshing", run_once)
    job.main({**ENV, "SINK": "console"})

    printed = capsys.readouterr().out
    assert "Temperature Sensor" in printed and printed.count("Unknown") == 2
    assert seen["log"] == (
        "kafka",
        {"kafka.bootstrap.servers": "broker:9092", "maxOffsetsPerTrigger": "1000000"},
    )
    assert seen["ttl"] == 600
    assert seen["database"][0] == "jdbc"
    assert seen["trigger"] == {"processingTime": "5 seconds"}
