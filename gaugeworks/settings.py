"""Tunable values of the pipeline, in one place."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # Values fixed by the job's contract.
    window: str = "1 minute"
    watermark: str = "5 seconds"
    fallback_name: str = "Unknown"
    # Age at which a file-based dimension is read again by a long-running stream, and a cached name is
    # looked up again.
    dimension_ttl_seconds: int = 600
    # Ids that a worker's lookup cache keeps; each for the time above.
    lookup_cache_rows: int = 100

    # A lookup side is broadcast only when measured to be within both bounds.
    broadcast_max_rows: int = 1_000_000
    broadcast_max_bytes: int = 64 * 1024 * 1024
    # Copies of each lookup row when it is too large to broadcast; a hot key spreads over this
    # many partitions, and in batch adaptive execution splits those further if they are skewed.
    salts: int = 64
    # An id is frequent if more than one in so many readings have it.
    frequent_ids: int = 10_000

    # Readings, or distinct humidity values, that one (window, type) may bring into a single task.
    # Groups above it take the routes for large ones in operators/median.py; its slices have about this size.
    group_cells_per_task: int = 250_000
    # Size of a large group's quantile sketch, and how far from the middle its bounds are taken. The
    # sketch's rank error is about 2 / size; bounds that miss the middle are widened.
    sketch_size: int = 1024
    sketch_margin: float = 0.01
    # Slices made at a time; a slice that is too large by then is sliced again.
    max_slices: int = 10_000


DEFAULTS = Settings()
