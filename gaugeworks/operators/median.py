"""Second aggregation step: cells to one row per (window, type).

Counts and temperature sums simply add up. A group's exact median is the humidity at its middle
rank, or the mean of the two middle ones.

In batch (``fold_readings``) nothing is stored for groups of bounded size: their readings are shuffled
once by group and sorted, and one pass finds ranks, middles and sums. Of a larger group a quantile
sketch tells between which values the middle lies; the readings below and above collapse into one cell
each, and only those between keep their values.

Cells that are stored anyway, a stream's closed windows or what is between the bounds of a large group,
go to ``fold_cells``. A group with more cells than one task should sort is range-partitioned by value
there: slice totals tell which slice holds the middle, and only that slice is looked into, if need be by
slicing it again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions.exact_sum import BAND, PIECES, band_pieces, exact_sum_columns, exact_sum_value
from gaugeworks.operators.cells import GROUP, add_up, grouped_readings
from gaugeworks.operators.joins import join_lookup
from gaugeworks.settings import DEFAULTS, Settings
from gaugeworks.storage import scratch_path, staged


#: Beyond all readings below, and above, what may be the middle.
BELOW, ABOVE = float("-inf"), float("nan")


def fold_readings(
    readings: DataFrame, settings: Settings = DEFAULTS, work: str | None = None, seen_at: Column | None = None
) -> DataFrame:
    """Per group of ``readings``: ``n_events``, ``mean_temperature``, ``median_humidity`` (both unrounded),
    and with ``seen_at`` the ``type_name`` last seen.

    Tables are written below ``work`` only if some group has more readings than one task should
    sort: those groups, and their readings near the middle. See ``fold_cells`` on ``work``.
    """
    named = [F.col("type_name"), seen_at.alias("seen_at")] if seen_at is not None else []
    rows = grouped_readings(readings, settings.window, *named)
    rows = rows.withColumn("window_start", F.col("window.start")).drop("window")
    sizes = rows.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("readings"))
    large = sizes.where(F.col("readings") > settings.group_cells_per_task)
    if large.isEmpty():
        return _sorted_in_place(rows)

    work = work or scratch_path(readings.sparkSession, "fold")
    large = staged(large, f"{work}/large")
    split = {"broadcast": _few(large.count(), settings), "salts": settings.salts}
    keys = large.select(*GROUP)
    small = join_lookup(rows, keys, GROUP, "left_anti", **split)
    cells = _near_the_middle(join_lookup(rows, keys, GROUP, "left_semi", **split), large, split, settings, work)
    return _sorted_in_place(small).unionByName(fold_staged(cells, settings, work))


def _few(groups: int, settings: Settings) -> bool:
    """Whether so many groups may be broadcast; a key and its bounds take five words."""
    return groups <= settings.broadcast_max_rows and groups * 40 <= settings.broadcast_max_bytes


def _sorted_in_place(rows: DataFrame) -> DataFrame:
    """Groups of bounded size from their readings: the only shuffle is that by group."""
    ranked = _positions(rows.withColumn("n", F.lit(1).cast("long")), GROUP, "humidity", "n")
    pieces = exact_sum_columns(F.col("temperature"))
    return _folded(ranked.withColumns(pieces))


def _near_the_middle(rows: DataFrame, large: DataFrame, split: dict, settings: Settings, work: str) -> DataFrame:
    """Stored cells of the ``large`` groups in which all readings below the middle ones have the value
    ``BELOW``, and all above them ``ABOVE``.

    The bounds come from a sketch. A group whose middle turns out to lie outside of them gets wider
    ones, in the end none at all.
    """
    capped = F.when(F.isnan("humidity"), F.lit(float("inf"))).otherwise(F.col("humidity"))
    sketch = F.kll_sketch_agg_double(capped, F.lit(settings.sketch_size)).alias("sketch")
    sketches = staged(rows.groupBy(*GROUP).agg(sketch), f"{work}/sketches")
    pending, margin, done, level = large.select(*GROUP, "readings"), settings.sketch_margin, [], 0
    while True:
        known = pending.join(sketches.hint("merge"), GROUP)
        low, high = F.lit(BELOW), F.lit(ABOVE)
        if margin < 0.5:
            low = F.kll_sketch_get_quantile_double("sketch", F.lit(0.5 - margin))
            high = F.kll_sketch_get_quantile_double("sketch", F.lit(0.5 + margin))
        known = known.select(*GROUP, "readings", low.alias("low"), high.alias("high"))
        bounds = staged(known, f"{work}/bounds-{level}")
        found = join_lookup(rows, bounds.drop("readings"), GROUP, "inner", **split)
        humidity, infinite = F.col("humidity"), F.col("high") == F.lit(float("inf"))
        zone = F.when(humidity < F.col("low"), -1).when(~infinite & (humidity > F.col("high")), 1).otherwise(0)
        value = F.when(zone < 0, F.lit(BELOW)).when(zone > 0, F.lit(ABOVE)).otherwise(humidity)
        found = found.withColumn("zone", zone).withColumn("humidity", value).drop("low", "high")
        cells = staged(add_up(found, *GROUP, "humidity", "zone"), f"{work}/near-{level}")
        sides = cells.groupBy(*GROUP).agg(
            F.sum(F.when(F.col("zone") < 0, F.col("n")).otherwise(0)).alias("below"),
            F.sum(F.when(F.col("zone") == 0, F.col("n")).otherwise(0)).alias("between"),
        )
        lower = F.call_function("div", F.col("readings") - 1, F.lit(2))
        upper = F.call_function("div", F.col("readings"), F.lit(2))
        missed = bounds.join(sides.hint("merge"), GROUP).where(
            (F.col("below") > lower) | (F.col("below") + F.col("between") <= upper)
        )
        missed = staged(missed.select(*GROUP, "readings"), f"{work}/missed-{level}")
        cells = cells.drop("zone")
        if missed.isEmpty():
            done.append(cells)
            break
        done.append(join_lookup(cells, missed.select(*GROUP), GROUP, "left_anti", **split))
        pending, margin, level = missed, margin * 8, level + 1
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole


def fold_cells(
    cells: DataFrame, settings: Settings = DEFAULTS, work: str | None = None
) -> DataFrame:
    """Per group: ``n_events``, ``mean_temperature``, ``median_humidity`` (both unrounded), and
    ``type_name`` as last seen if the cells carry names.

    The cells are written below ``work`` first, as how the groups are sized decides the plan. In the
    worst case, when hardly any two readings of a window agree in type and humidity, they are as many
    as the readings. ``work`` has to stay until the result has been used; it defaults to a fresh
    folder in the shared one. A ``work`` left by a failed attempt can be used again.
    """
    work = work or scratch_path(cells.sparkSession, "fold")
    return fold_staged(staged(cells, f"{work}/cells"), settings, work)


def fold_staged(cells: DataFrame, settings: Settings, work: str, total: int | None = None) -> DataFrame:
    """``fold_cells`` for cells that are a stored table already, of ``total`` rows if that is known."""
    limit = settings.group_cells_per_task
    if (cells.count() if total is None else total) <= limit:
        return _in_place(cells)

    sizes = staged(cells.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("cells")), f"{work}/sizes")
    large = sizes.where(F.col("cells") > limit)
    found = large.agg(F.count(F.lit(1)).alias("groups"), F.sum("cells").alias("cells")).first()
    if found["groups"] == 0:
        return _in_place(cells)

    large = large.select(*GROUP)
    few = _few(found["groups"], settings)
    split = {"broadcast": few, "salts": settings.salts}
    small_cells = join_lookup(cells, large, GROUP, "left_anti", **split)
    large_cells = join_lookup(cells, large, GROUP, "left_semi", **split)
    medians = _medians_by_range(large_cells, found["groups"], found["cells"], few, settings, work)
    # Both sides are partitioned by group already, so a merge join shuffles nothing more, and no
    # size estimated from compressed files can turn it into an oversized broadcast.
    by_range = _totals(large_cells).join(medians.hint("merge"), GROUP)
    return _in_place(small_cells).unionByName(_result(by_range))


def _names(frame: DataFrame) -> list[Column]:
    """The name last seen, if the frame has names."""
    if "type_name" not in frame.columns:
        return []
    return [
        # Of names last seen at one time the greatest is taken, so the result does not depend on order.
        F.max_by("type_name", F.struct("seen_at", "type_name")).alias("type_name"),
        F.max("seen_at").alias("seen_at"),
    ]


def _sums(*names: str) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


def _in_place(cells: DataFrame) -> DataFrame:
    """Groups of bounded size: one shuffle by group and one sort, then everything in place."""
    return _folded(_positions(cells, GROUP, "humidity", "n"))


def _folded(ranked: DataFrame) -> DataFrame:
    middle = F.when(_holds_middle("n"), F.col("humidity"))
    banded = ranked.groupBy(*GROUP, BAND).agg(
        *_sums("n", *PIECES),
        F.min(middle).alias("low"),
        F.max(middle).alias("high"),
        *_names(ranked),
    )
    whole = banded.groupBy(*GROUP).agg(
        *_sums("n"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.collect_list(band_pieces()).alias("bands"),
        *_names(banded),
    )
    return _result(whole)


def _totals(cells: DataFrame) -> DataFrame:
    """Sums and name of groups of any size, by hash aggregation with map-side partials."""
    keys = [*GROUP, BAND]
    if "type_name" in cells.columns:
        # A string in an aggregation buffer would need sorted input. So the names are first a key,
        # and only their few rows are looked through for the latest.
        cells = cells.groupBy(*keys, "type_name").agg(
            *_sums("n", *PIECES), F.max("seen_at").alias("seen_at")
        )
    banded = cells.groupBy(*keys).agg(*_sums("n", *PIECES), *_names(cells))
    return banded.groupBy(*GROUP).agg(
        *_sums("n"), F.collect_list(band_pieces()).alias("bands"), *_names(banded)
    )


def _result(groups: DataFrame) -> DataFrame:
    low, high = F.col("low"), F.col("high")
    return groups.select(
        *GROUP,
        *(["type_name"] if "type_name" in groups.columns else []),
        F.col("n").alias("n_events"),
        (exact_sum_value(F.col("bands")) / F.col("n")).alias("mean_temperature"),
        F.when(low == high, low).otherwise((low + high) / 2).alias("median_humidity"),
    )


def _positions(frame: DataFrame, keys: list[str], order: str, amount: str) -> DataFrame:
    """Running sum ``up_to`` and overall sum ``total`` of ``amount`` within ``keys``."""
    ordered = Window.partitionBy(*keys).orderBy(order)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    overall = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return frame.withColumns(
        {"up_to": F.sum(amount).over(so_far), "total": F.sum(amount).over(overall)}
    )


def _holds_middle(amount: str) -> Column:
    """Whether the ``amount`` readings ending at position ``up_to`` of ``total`` include a middle
    one."""
    lower = F.call_function("div", F.col("total") - 1, F.lit(2))
    upper = F.call_function("div", F.col("total"), F.lit(2))
    return (F.col("up_to") > lower) & (F.col("up_to") - F.col(amount) <= upper)


def _medians_by_range(
    large: DataFrame, groups: int, n_cells: int, few: bool, settings: Settings, work: str
) -> DataFrame:
    """The middle values of ``groups`` groups of any size, by slices of about equal size; ``few`` such
    groups may be broadcast.

    A slice with a middle that is still too large for one task is sliced again by itself, as often as
    it takes. There are always more slices than groups, so some group is cut each time. ``part``
    tells a group's slices apart that are looked into (two at most), ``before`` counts the readings
    below them.
    """
    limit, found = settings.group_cells_per_task, []
    keys = [*GROUP, "part"]
    # One row per value, so that slices of more than one row can be cut.
    values = large.groupBy(*GROUP, "humidity").agg(F.sum("n").alias("n"))
    cells = values.withColumns({"part": F.lit(0), "before": F.lit(0).cast("long")})
    total = F.lit(None).cast("long")
    level = 0
    while True:
        slices = max(4 * groups, min(-(-n_cells // limit), settings.max_slices))
        # The sampled slice bounds differ between runs of the same plan, so they are fixed by
        # staging.
        sliced = staged(
            cells.withColumn("of", total)
            .drop("of_group")
            .repartitionByRange(slices, *keys, "humidity")
            .withColumn("slice", F.spark_partition_id()),
            f"{work}/sliced-{level}",
        )
        # At most one row per part and slice, so a part's window here has at most ``slices`` rows.
        by_slice = sliced.groupBy(*keys, "slice").agg(
            F.sum("n").alias("in_slice"),
            F.count(F.lit(1)).alias("cells"),
            F.first("before").alias("start"),
            F.first("of").alias("of"),
        )
        targets = (
            _positions(by_slice, keys, "slice", "in_slice")
            .withColumns(
                {
                    "total": F.coalesce("of", "total"),
                    "up_to": F.col("start") + F.col("up_to"),
                }
            )
            .where(_holds_middle("in_slice"))
            .select(
                *keys,
                "slice",
                (F.col("up_to") - F.col("in_slice")).alias("below"),
                "total",
                (F.col("cells") > limit).alias("again"),
                "cells",
                F.row_number().over(Window.partitionBy(*GROUP).orderBy("part", "slice")).alias("next"),
            )
        )
        # One or two slices per group, so the rest of the cells need not be shuffled again.
        targets = staged(targets, f"{work}/targets-{level}")
        hinted = targets.drop("cells").hint("broadcast" if few else "merge")
        chosen = sliced.drop("before", "of").join(hinted, [*keys, "slice"])
        within = Window.partitionBy(*keys, "slice").orderBy("humidity")
        so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = chosen.where("not again").withColumn(
            "up_to", F.col("below") + F.sum("n").over(so_far)
        )
        found.append(ranked.where(_holds_middle("n")).select(*GROUP, "humidity"))
        n_cells = targets.where("again").agg(F.sum("cells")).first()[0]
        if not n_cells:
            break
        cells = chosen.where("again").select(
            *GROUP,
            "humidity",
            "n",
            F.col("next").alias("part"),
            F.col("below").alias("before"),
            F.col("total").alias("of_group"),
        )
        total, level = F.col("of_group"), level + 1
    middles = found[0]
    for more in found[1:]:
        middles = middles.unionByName(more)
    return middles.groupBy(*GROUP).agg(
        F.min("humidity").alias("low"), F.max("humidity").alias("high")
    )
