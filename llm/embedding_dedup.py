"""Embedding near-dedup by an epsilon grid order join.

Two unit vectors have a cosine of 0.9 or more when they are at most
sqrt(2 - 2 * 0.9) apart; that distance is the grid's cell width. Vectors are
rotated onto their principal axes (a rotation keeps distances), sorted by the
grid cells of the leading axes, and cut into blocks of that sequence. Two blocks
meet only if their bounding boxes are within the distance; inside a task the
join goes on recursively over halves of both intervals, leaving out those whose
boxes are too far apart, down to small dense products in double precision.

Equal vectors are one node with a weight, so copies cost nothing. A task gives
back one count per vector and a spanning forest of its links, never the pairs.
The number of block pairs grows with the square of the blocks that a cell and
its neighbours hold: on data without structure nothing can be proven distant,
and the join compares all blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import textbits, vectors
from llm.tables import components, stored

COSINE = 0.9

#: Axes whose cells order the sequence; vectors per block; side of a dense product.
AXES, BLOCK, LEAF = 8, 4096, 512

#: Added to distances, for what rotation and normalising round off.
SLACK = 1e-6


def near_vectors(
    table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE
) -> DataFrame:
    """`vec_id`, `n_links`, `component_id`, `kept` for every row of `table`.

    Rows whose vectors have a cosine of `cosine` (positive) or more are linked, in double precision.
    n_links counts the other rows a row is linked with; component_id is the
    smallest id reachable, its own included; kept is vec_id = component_id.

    Vectors that are null, empty, zero, or hold a null or non-finite component
    link with nothing, and so do vectors of different lengths with one another.
    Rows with a null id link nothing: n_links 0, no component, not kept. Repeated
    rows are rows of their own, linked with each other. No rows give no rows.
    Other columns are ignored.
    """
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = stored(rows.mapInArrow(_units, "vec_id long, dim int, s0 long, s1 long, unit binary"), "vectors")
    good = rows.where("dim > 0 and vec_id is not null")
    nodes = good.groupBy("s0", "s1").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("weight"))
    nodes = stored(nodes, "nodes")
    heads = good.join(nodes, ["s0", "s1"]).where("vec_id = node").dropDuplicates(["s0", "s1"])
    # Several different vectors may carry one id: a node is a vector.
    heads = stored(heads.select(F.col("s0").alias("key"), "node", "weight", "dim", "unit"), "heads")
    found = [_join(heads.where(F.col("dim") == d), d, cosine) for d in _dims(heads)]
    if not found:
        return rows.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
            F.col("vec_id").isNotNull().alias("kept"),
        )
    tiles = found[0]
    for more in found[1:]:
        tiles = tiles.union(more)
    degrees = tiles.where("b is null").groupBy(F.col("a").alias("s0")).agg(F.sum("n").alias("n"))
    # Links are between keys; the component's name is the smallest id of its nodes.
    labels = components(tiles.where("b is not null").select("a", "b"))
    nodes = nodes.join(labels.select(F.col("node").alias("s0"), "component"), "s0", "left")
    nodes = nodes.withColumn("component", F.coalesce("component", "s0"))
    names = nodes.groupBy("component").agg(F.min("node").alias("component_id"))
    nodes = nodes.join(names, "component").join(degrees, "s0", "left")
    nodes = nodes.select("s0", "s1", "component_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    out = rows.drop("unit").join(nodes, ["s0", "s1"], "left")
    usable = F.col("vec_id").isNotNull() & (F.col("dim") > 0)
    out = out.select(
        "vec_id",
        F.when(usable, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
        F.when(usable, F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _dims(heads: DataFrame) -> list[int]:
    """The lengths of vectors; a table of embeddings has one or a few."""
    return [r[0] for r in heads.select("dim").distinct().orderBy("dim").collect()]


def _join(heads: DataFrame, dim: int, cosine: float) -> DataFrame:
    """Rows (a, null, links of a) and (a, b, 0) that connect what is linked."""
    eps = math.sqrt(2 - 2 * cosine) + SLACK
    axes = _principal_axes(heads, dim)
    cells = heads.mapInArrow(_cells(axes, eps), "key long, weight long, unit binary, cell array<int>")
    n = heads.count()
    ordered = cells.repartitionByRange(max(1, -(-n // BLOCK)), "cell", "key").sortWithinPartitions("cell", "key")
    blocks = ordered.mapInArrow(
        _blocks(axes), "block long, keys binary, weights binary, units binary, lo array<double>, hi array<double>"
    )
    blocks = stored(blocks, "blocks")
    boxes = blocks.select("block", "lo", "hi")
    # Blocks within the distance lie in the same or neighbouring cells of the first axis.
    spread = boxes.withColumn(
        "cell", F.explode(F.expr(f"sequence(cast(floor(lo[0] / {eps}) as int), cast(floor(hi[0] / {eps}) as int) + 1)"))
    )
    other = spread.select(F.col("block").alias("block_b"), F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"), "cell")
    gap = F.expr(
        "aggregate(arrays_zip(lo, hi, lo_b, hi_b), 0D, (s, x) -> s + "
        "pow(greatest(x.lo - x.hi_b, x.lo_b - x.hi, 0D), 2))"
    )
    pairs = spread.join(other, "cell").where(F.col("block") <= F.col("block_b")).where(gap <= eps * eps)
    pairs = stored(pairs.select("block", "block_b").distinct(), "block_pairs")
    data = blocks.select("block", "keys", "weights", "units")
    joined = pairs.join(data, "block").join(data.toDF("block_b", "keys_b", "weights_b", "units_b"), "block_b")
    return stored(joined.mapInArrow(_tiles(axes, eps, cosine), "a long, b long, n long"), "tiles")


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dims, s0, s1, units = [], [], [], []
        for v in vectors.lists(batch.column("v")):
            norm = 0.0 if v is None or not len(v) else float(np.abs(v).max())
            if norm > 0:
                v = v / norm  # so that squares neither overflow nor vanish
                v = v / np.sqrt(v @ v)
            a, b = textbits.digest(v.tobytes()) if norm > 0 else (None, None)
            dims.append(len(v) if norm > 0 else 0)
            s0.append(a), s1.append(b), units.append(v.tobytes() if norm > 0 else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(dims, pa.int32()), pa.array(s0, pa.int64()), pa.array(s1, pa.int64()),
             pa.array(units, pa.binary())],
            ["vec_id", "dim", "s0", "s1", "unit"],
        )


def _principal_axes(heads: DataFrame, dim: int) -> np.ndarray:
    """Eigenvectors of the vectors' covariance, from sums that tasks add up; dim * (dim + 1) numbers come back."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim + 1, dim))
        n = 0
        for batch in batches:
            x = vectors.matrix(b"".join(batch.column("unit").to_pylist()), dim)
            total[:dim] += x.T @ x
            total[dim] += x.sum(0)
            n += len(x)
        values = np.append(total.ravel(), n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["i", "value"])

    sums = heads.select("unit").mapInArrow(moments, "i long, value double").groupBy("i").agg(F.sum("value").alias("v"))
    found = sums.toPandas().sort_values("i")["v"].to_numpy()
    n, mean, square = max(found[-1], 1.0), found[-1 - dim : -1], found[: dim * dim].reshape(dim, dim)
    _, axes = np.linalg.eigh(square / n - np.outer(mean / n, mean / n))
    return np.ascontiguousarray(axes[:, ::-1])


def _cells(axes: np.ndarray, eps: float):
    leading = min(AXES, len(axes))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = vectors.matrix(b"".join(batch.column("unit").to_pylist()), len(axes)) @ axes[:, :leading]
            cell = np.floor(x / eps).astype(np.int32)
            offsets = pa.array(np.arange(len(cell) + 1, dtype=np.int32) * leading)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("weight"), batch.column("unit"),
                 pa.ListArray.from_arrays(offsets, pa.array(cell.ravel()))],
                ["key", "weight", "unit", "cell"],
            )

    return cells


def _blocks(axes: np.ndarray):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []

        def block(table: pa.Table) -> pa.RecordBatch:
            units = b"".join(table.column("unit").to_pylist())
            x = vectors.matrix(units, len(axes)) @ axes
            one = [
                [number], [table.column("key").to_numpy().tobytes()], [table.column("weight").to_numpy().tobytes()],
                [units], [x.min(0).tolist()], [x.max(0).tolist()],
            ]
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(one, kinds)], ["block", "keys", "weights", "units", "lo", "hi"]
            )

        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            while len(table) >= 2 * BLOCK:
                yield block(table.slice(0, BLOCK))
                number, table = number + 1, table.slice(BLOCK)
            held = table.to_batches()
        table = pa.Table.from_batches(held) if held else None
        while table is not None and len(table):
            size = BLOCK if len(table) > 1.5 * BLOCK else len(table)
            yield block(table.slice(0, size))
            number, table = number + 1, table.slice(size)

    return blocks


class _Forest:
    """Disjoint sets over the rows of a tile; keeps the links that joined two of them."""

    def __init__(self, n: int):
        self.parent = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return int(i)

    def join(self, i: int, others: np.ndarray) -> None:
        for j in others[self.parent[others] != self.parent[i]]:
            a, b = self.root(i), self.root(int(j))
            if a != b:
                self.parent[max(a, b)] = min(a, b)
                self.links.append((i, int(j)))
        self.parent[others] = self.parent[i] = self.root(i)


def _tiles(axes: np.ndarray, eps: float, cosine: float):
    dim = len(axes)

    def tile(row: dict, same: bool) -> pa.RecordBatch:
        key_a, key_b = np.frombuffer(row["keys"], np.int64), np.frombuffer(row["keys_b"], np.int64)
        w_a, w_b = np.frombuffer(row["weights"], np.int64), np.frombuffer(row["weights_b"], np.int64)
        x, y = vectors.matrix(row["units"], dim), vectors.matrix(row["units_b"], dim)
        px, py = x @ axes, y @ axes
        n_a, n_b = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
        forest = _Forest(len(x) + (0 if same else len(y)))
        shift = 0 if same else len(x)

        def join(i0: int, i1: int, j0: int, j1: int) -> None:
            if same and i0 >= j1:
                return  # the mirror image
            a, b = px[i0:i1], py[j0:j1]
            gap = np.maximum(np.maximum(a.min(0) - b.max(0), b.min(0) - a.max(0)), 0)
            if gap @ gap > eps * eps:
                return
            if max(i1 - i0, j1 - j0) <= LEAF:
                return dense(i0, i1, j0, j1)
            if i1 - i0 >= j1 - j0:
                middle = (i0 + i1) // 2
                join(i0, middle, j0, j1), join(middle, i1, j0, j1)
            else:
                middle = (j0 + j1) // 2
                join(i0, i1, j0, middle), join(i0, i1, middle, j1)

        def dense(i0: int, i1: int, j0: int, j1: int) -> None:
            hits = x[i0:i1] @ y[j0:j1].T >= cosine
            if same:
                hits &= np.arange(i0, i1)[:, None] < np.arange(j0, j1)[None, :]
            rows = np.flatnonzero(hits.any(1))
            if not len(rows):
                return
            n_a[i0:i1] += hits @ w_b[j0:j1]
            n_b[j0:j1] += hits.T @ w_a[i0:i1]
            for i in rows:
                forest.join(int(i0 + i), np.flatnonzero(hits[i]) + j0 + shift)

        join(0, len(x), 0, len(y))
        keys = key_a if same else np.concatenate([key_a, key_b])
        counts = n_a + n_b if same else np.concatenate([n_a, n_b])
        some = np.flatnonzero(counts)
        ends = np.array(forest.links, np.int64).reshape(-1, 2)
        none = np.zeros(len(some), bool)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([keys[some], keys[ends[:, 0]]])),
                pa.array(np.concatenate([keys[some], keys[ends[:, 1]]]), mask=np.concatenate([~none, np.zeros(len(ends), bool)])),
                pa.array(np.concatenate([counts[some], np.zeros(len(ends), np.int64)])),
            ],
            ["a", "b", "n"],
        )

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                yield tile(row, row["block"] == row["block_b"])

    return tiles
