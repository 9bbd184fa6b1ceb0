"""Near-duplicate embeddings within a label by PCA-ordered tiled comparison.

Copies are folded to one vector with a weight. Vectors are scaled to length one, rotated to the
principal axes of all vectors, and dealt into tiles by range of label and leading coordinate, so a
tile holds a bounded number of rows whatever the size of a label. Two tiles are compared only if
their boxes in the leading coordinates come near enough. Within a pair of tiles the dot products are
accumulated from the leading dimensions on; what the rest can add is bounded by the product of the
suffix norms, and a pair of vectors is given up as soon as it cannot reach the threshold. What is
left is decided by the full cosine in double precision.

A pair of tiles returns no pairs of vectors but link counts per vector and a forest that connects
what is linked.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import Work
from gaugeworks.llm.components import components

TILE_ROWS = 2048
BLOCK_DIMS = 16
BOX_DIMS = 8
#: Rotations and sums are off by less than this; candidates are kept with this much to spare.
SLACK = 1e-9
GROUP = ["_label", "_dim"]
NODE = ["_k1", "_k2"]


def _vectors(frame: DataFrame) -> DataFrame:
    """Valid vectors as ``_x``, doubles of length one in a binary; null for all others."""
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            units = []
            for label, vector in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                unit = None
                if label is not None and vector.is_valid and len(vector.values):
                    x = np.array(vector.values.to_numpy(zero_copy_only=False), float)
                    largest = np.abs(x).max()
                    if np.isfinite(largest) and largest > 0:
                        x = x / largest  # neither overflow nor underflow in the norm
                        unit = (x / np.sqrt(x @ x) + 0.0).tobytes()
                units.append(unit)
            columns = [*batch.columns[:2], pa.array(units, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "_label", "_x"])

    return frame.mapInArrow(run, "_id long, _label string, _x binary")


def _axes(nodes: DataFrame):
    """Principal axes by dimension: eigenvectors of the second moments of all vectors, largest first.

    Each task adds up its own moments; their sums are the only rows that are collected, as many as
    the square of the dimension.
    """
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, x in _matrices(batch):
                sums[dim] = sums.get(dim, 0) + x.T @ x
        for dim, moments in sums.items():
            i, j = np.triu_indices(dim)
            at = pa.array(np.full(len(i), dim)), pa.array(i), pa.array(j), pa.array(moments[i, j])
            yield pa.RecordBatch.from_arrays(list(at), ["dim", "i", "j", "s"])

    rows = nodes.select("_x").mapInArrow(run, "dim long, i long, j long, s double")
    total = rows.groupBy("dim", "i", "j").agg(F.sum("s").alias("s")).toPandas()
    axes = {}
    for dim, part in total.groupby("dim"):
        moments = np.zeros((dim, dim))
        moments[part.i, part.j] = part.s
        moments[part.j, part.i] = part.s
        axes[int(dim)] = np.linalg.eigh(moments)[1][:, ::-1].copy()
    return axes


def _matrices(batch: pa.RecordBatch):
    """The batch's vectors ``_x`` as one matrix per dimension."""
    import numpy as np

    column = batch.column(batch.schema.get_field_index("_x"))
    by_dim: dict[int, list[bytes]] = {}
    for x in column.to_pylist():
        by_dim.setdefault(len(x) // 8, []).append(x)
    for dim, rows in by_dim.items():
        yield dim, np.frombuffer(b"".join(rows)).reshape(-1, dim)


def _tiles(nodes: DataFrame, axes, work: Work, tile_rows: int) -> DataFrame:
    """One row per tile: ``_label``, ``_dim``, ``tile``, ``low`` and ``high`` (its box in the leading
    coordinates), and its vectors, ids, weights and keys."""
    import numpy as np

    shared = nodes.sparkSession.sparkContext.broadcast(axes)
    count = nodes.count()

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c1 = []
            for x in batch.column(batch.schema.get_field_index("_x")).to_pylist():
                x = np.frombuffer(x)
                c1.append(float(x @ shared.value[len(x)][:, 0]))
            names = [*batch.schema.names, "_c1"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(c1, pa.float64())], names)

    schema = nodes.select("*", F.lit(0.0).alias("_c1")).schema
    dealt = (
        nodes.mapInArrow(lead, schema)
        .repartitionByRange(max(1, -(-count // tile_rows)), *GROUP, "_c1")
        .withColumn("part", F.spark_partition_id())
    )
    # The bounds are sampled, so they are fixed by storing the rows.
    dealt = work.stage(dealt, "dealt")

    def box(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, cut = [], None, 0

        def tile():
            x = np.frombuffer(b"".join(r[2] for r in held)).reshape(len(held), -1)
            z = x @ shared.value[x.shape[1]][:, :BOX_DIMS]
            ints = [np.array([r[i] for r in held], np.int64).tobytes() for i in (0, 1, 3, 4)]
            row = {
                "_label": key[0],
                "_dim": key[1],
                "tile": (key[2] << 32) + cut,
                "low": z.min(axis=0).tolist(),
                "high": z.max(axis=0).tolist(),
                "x": x.tobytes(),
                **dict(zip(("id", "weight", "k1", "k2"), ints, strict=True)),
            }
            return pa.RecordBatch.from_pylist([row], tile_schema)

        # A range partition may be larger than meant, so it is cut into tiles of bounded size.
        names = ("_label", "_dim", "part", "_id", "_w", "_x", *NODE)
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]
            for label, dim, part, *row in zip(*columns, strict=True):
                if (label, dim, part) != key or len(held) == tile_rows:
                    if held:
                        yield tile()
                    cut = cut + 1 if (label, dim, part) == key else 0
                    held, key = [], (label, dim, part)
                held.append(row)
        if held:
            yield tile()

    fields = "_label string, _dim int, tile long, low array<double>, high array<double>"
    blobs = ", x binary, id binary, weight binary, k1 binary, k2 binary"
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
    tile_names = ["_label", "_dim", "tile", "low", "high", "x", "id", "weight", "k1", "k2"]
    tile_schema = pa.schema(list(zip(tile_names, kinds + [pa.binary()] * 5, strict=True)))
    keys = ["part", *GROUP]
    ordered = dealt.repartition(*keys).sortWithinPartitions(*keys, "_c1")
    return work.stage(ordered.mapInArrow(box, fields + blobs), "tiles")


def compare(a, b, axes, threshold: float, same: bool, rows: int = 256):
    """Links between two matrices of unit vectors, as batches of index arrays into ``a`` and ``b``.

    ``same``: they are one matrix, and a vector isn't compared with itself; each link is then found
    from both its ends.
    """
    import numpy as np

    za, zb = a @ axes, b @ axes
    dim = za.shape[1]
    edges = [*range(0, dim, BLOCK_DIMS), dim]

    def suffix(z):
        """Norms of what follows each block."""
        return [np.sqrt((z[:, e:] ** 2).sum(axis=1)) for e in edges[1:]]

    rest_a, rest_b = suffix(za), suffix(zb)
    for begin in range(0, len(a), rows):
        part = slice(begin, begin + rows)
        dots = za[part, : edges[1]] @ zb[:, : edges[1]].T
        i, j = np.nonzero(dots + np.outer(rest_a[0][part], rest_b[0]) >= threshold - SLACK)
        i += begin
        dots = dots[i - begin, j]
        for block in range(1, len(edges) - 1):
            if not len(i):
                break
            span = slice(edges[block], edges[block + 1])
            for at in range(0, len(i), 1 << 16):
                some = slice(at, at + (1 << 16))
                dots[some] += np.einsum("ij,ij->i", za[i[some], span], zb[j[some], span])
            able = dots + rest_a[block][i] * rest_b[block][j] >= threshold - SLACK
            i, j, dots = i[able], j[able], dots[able]
        if len(i):
            exact = np.concatenate(
                [
                    np.einsum("ij,ij->i", a[i[at : at + (1 << 16)]], b[j[at : at + (1 << 16)]])
                    for at in range(0, len(i), 1 << 16)
                ]
            )
            linked = (exact >= threshold) & ~(same & (i == j))
            if linked.any():
                yield i[linked], j[linked]


class _Union:
    """Components of the links in one pair of tiles."""

    def __init__(self, n: int):
        import numpy as np

        self.root = np.arange(n)

    def add(self, i, j) -> None:
        import numpy as np

        # Smallest label among neighbours, until nothing changes; then whole trees at once.
        while True:
            low = np.minimum(self.root[i], self.root[j])
            if (self.root[i] == self.root[j]).all():
                return
            best = self.root.copy()
            np.minimum.at(best, self.root[i], low)
            np.minimum.at(best, self.root[j], low)
            while (best[best] != best).any():
                best = best[best]
            self.root = best[self.root]


def near_duplicates(
    frame: DataFrame,
    threshold: float = 0.98,
    vector: str = "embedding",
    label: str = "label",
    doc: str = "vec_id",
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Per row of ``frame``: ``doc`` (a long), ``n_links`` (other vectors with the same label and a
    cosine of at least ``threshold``), ``component_id`` (smallest id reachable by links) and
    ``kept``, whether that is its own id.

    Vectors that are null, empty, zero or hold a null or a non-finite number, and such without a
    label, link with nothing; so do vectors of different dimensions. Rows without an id have no
    component, are not kept, and are not counted. Rows with equal id, label and vector are one vector
    (each gets its result). Further columns are ignored.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0, and 1 at most")
    import numpy as np

    work = Work(frame.sparkSession, "vectors")
    source = frame.select(
        F.col(doc).cast("long").alias("_id"),
        F.col(label).cast("string").alias("_label"),
        F.col(vector).cast("array<double>").alias("_v"),
    )
    rows = work.stage(
        _vectors(source).withColumns(
            {
                "_dim": (F.octet_length("_x") / 8).cast("int"),
                "_k1": F.xxhash64("_label", "_x"),
                "_k2": F.xxhash64(F.lit("second"), "_x", "_label"),
            }
        ),
        "rows",
    )
    valid = rows.where("_id is not null and _x is not null")
    # Copies: one vector, the smallest id, the number of ids. The distinct step keeps keys only.
    copies = (
        valid.groupBy(*NODE, "_id")
        .agg(F.count(F.lit(1)))
        .groupBy(*NODE)
        .agg(F.min("_id").alias("_id"), F.count(F.lit(1)).alias("_w"))
    )
    copies = work.stage(copies, "copies")
    firsts = valid.groupBy(*NODE).agg(*[F.first(c).alias(c) for c in ("_label", "_dim", "_x")])
    nodes = work.stage(firsts.join(copies.hint("merge"), NODE), "nodes")

    axes = _axes(nodes)
    tiles = _tiles(nodes, axes, work, tile_rows)
    shared = frame.sparkSession.sparkContext.broadcast(axes)
    reach = float(np.sqrt(2 - 2 * threshold)) + 1e-6
    boxes = tiles.select(*GROUP, "tile", "low", "high")
    left = boxes.toDF(*GROUP, "a", "low_a", "high_a")
    right = boxes.toDF(*GROUP, "b", "low_b", "high_b")
    # Unit vectors that far apart have a smaller cosine: the gap between boxes is no more than theirs.
    gap = F.zip_with(
        F.zip_with("low_a", "high_b", lambda low, high: F.greatest(low - high, F.lit(0.0))),
        F.zip_with("low_b", "high_a", lambda low, high: F.greatest(low - high, F.lit(0.0))),
        lambda x, y: (x + y) * (x + y),
    )
    near = F.aggregate(gap, F.lit(0.0), lambda s, x: s + x) <= reach**2
    pairs = left.join(right, GROUP).where("a <= b").where(
        (F.col("low_b")[0] - F.col("high_a")[0] <= reach) & (F.col("low_a")[0] - F.col("high_b")[0] <= reach)
    )
    pairs = work.stage(pairs.where(near).select(*GROUP, "a", "b"), "pairs")
    blobs = ["x", "id", "weight", "k1", "k2"]
    one = tiles.select(F.col("tile").alias("a"), *GROUP, *[F.col(c).alias(f"{c}_a") for c in blobs])
    two = tiles.select(F.col("tile").alias("b"), *GROUP, *[F.col(c).alias(f"{c}_b") for c in blobs])
    work_items = pairs.join(one, [*GROUP, "a"]).join(two, [*GROUP, "b"])
    columns = ["_dim", "a", "b", *[f"{c}_a" for c in blobs], *[f"{c}_b" for c in blobs]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = {c: batch.column(c)[n].as_py() for c in columns}
                yield _tile_links(row, shared.value, threshold, found_schema)

    found_schema = pa.schema([(c, pa.int64()) for c in ("a", "b", "_k1", "_k2", "n")])
    found = work.stage(
        work_items.select(*columns)
        .repartition(F.col("a"), F.col("b"))
        .mapInArrow(run, "a long, b long, _k1 long, _k2 long, n long"),
        "found",
    )
    counts = found.where("n is not null").groupBy(*NODE).agg(F.sum("n").alias("_n"))
    roots = components(found.where("n is null").select("a", "b"), work)
    results = (
        copies.join(counts, NODE, "left")
        .join(roots.withColumnRenamed("id", "_id"), "_id", "left")
        .select(
            *NODE,
            (F.coalesce("_n", F.lit(0)) + F.col("_w") - 1).alias("_links"),
            F.coalesce("root", "_id").alias("_root"),
        )
    )
    results = work.stage(results, "results")
    usable = F.col("_id").isNotNull() & F.col("_x").isNotNull()
    component = F.when(usable, F.col("_root")).otherwise(F.col("_id"))
    return rows.join(results.hint("merge"), NODE, "left").select(
        F.col("_id").alias(doc),
        F.when(usable, F.col("_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("_id"), F.lit(False)).alias("kept"),
    )


def _tile_links(row: dict, axes, threshold: float, schema: pa.Schema) -> pa.RecordBatch:
    """Weighted link counts by vector and connecting links of one pair of tiles."""
    import numpy as np

    dim, same = row["_dim"], row["a"] == row["b"]

    def side(s: str):
        ints = [np.frombuffer(row[f"{c}_{s}"], np.int64) for c in ("id", "weight", "k1", "k2")]
        return np.frombuffer(row[f"x_{s}"]).reshape(-1, dim), *ints

    xa, ida, wa, k1a, k2a = side("a")
    xb, idb, wb, k1b, k2b = side("b")
    na, nb = np.zeros(len(xa), np.int64), np.zeros(len(xb), np.int64)
    union = _Union(len(xa) if same else len(xa) + len(xb))
    for i, j in compare(xa, xb, axes[dim], threshold, same):
        np.add.at(na, i, wb[j])
        if not same:
            np.add.at(nb, j, wa[i])
        union.add(i, j if same else j + len(xa))
    ids, k1, k2, n = ida, k1a, k2a, na
    if not same:
        ids, n = np.concatenate([ida, idb]), np.concatenate([na, nb])
        k1, k2 = np.concatenate([k1a, k1b]), np.concatenate([k2a, k2b])
    member = np.flatnonzero(union.root != np.arange(len(ids)))
    counted = np.flatnonzero(n)
    none = np.zeros(len(member), np.int64)
    is_link = np.arange(len(member) + len(counted)) < len(member)

    def column(of_links, of_counts):
        return np.concatenate([of_links, of_counts]).astype(np.int64)

    zeros = np.zeros(len(counted), np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(column(ids[member], zeros), mask=~is_link),
            pa.array(column(ids[union.root[member]], zeros), mask=~is_link),
            pa.array(column(none, k1[counted]), mask=is_link),
            pa.array(column(none, k2[counted]), mask=is_link),
            pa.array(column(none, n[counted]), mask=is_link),
        ],
        schema=schema,
    )
