"""Event-time sensor summaries on Spark.

JSON readings are decoded strictly, named from a small changing dimension through a left
lookup join, and summarised per type in tumbling windows (mean temperature, exact median
humidity).  Batch tables and Structured Streaming share the same DataFrame functions.
"""

from gaugeworks.plans.batch import batch_summary, public_result
from gaugeworks.settings import Settings

__all__ = ["Settings", "batch_summary", "public_result"]
