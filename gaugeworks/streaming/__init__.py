from gaugeworks.streaming.runner import run_available, run_refreshing, start, streaming_cells
from gaugeworks.streaming.windows import start_rows, window_rows

__all__ = ["run_available", "run_refreshing", "start", "start_rows", "streaming_cells", "window_rows"]
