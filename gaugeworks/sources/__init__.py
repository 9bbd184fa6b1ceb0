from gaugeworks.sources.inputs import (
    dimension,
    follow_results,
    messages,
    messages_stream,
    results,
    results_stream,
    sensor_table,
)
from gaugeworks.sources.sinks import kafka_options, write_results
from gaugeworks.sources.versions import newest_version, publish_version, version_names

__all__ = [
    "dimension",
    "follow_results",
    "kafka_options",
    "messages",
    "messages_stream",
    "newest_version",
    "publish_version",
    "results",
    "results_stream",
    "sensor_table",
    "version_names",
    "write_results",
]
