"""Exact top-k search: tiles of queries times shards, partial lists, a tree of merges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm import vectors
from llm.tables import stored

#: Queries per tile, vectors per shard, factor of components before rounding down.
TILE, SHARD, SCALE = 512, 8192, 1024

#: Integers up to here are exact in double precision.
EXACT = float(1 << 53)


def exact_topk(
    table: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """`query_id`, `rank` (from 1), `vec_id`, `score`: the `k` best rows of `table` for each row of `queries`.

    A component x counts as floor(1024 * x). The score is the integer inner
    product, ties go to the smaller vec_id, and a query's own id is no candidate.
    With fewer candidates all are returned.

    Vectors that are null or hold a null or non-finite component take no part,
    nor do rows with a null id; vectors of different lengths don't meet, and
    empty ones score 0. A query id that is repeated is asked once, with its
    smallest vector; repeated candidates count each. No rows give no rows. Other
    columns are ignored.
    """
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    asked = queries.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    asked = asked.where("id is not null").groupBy("id").agg(F.min("v").alias("v"))
    packed = "dim int, ids binary, ints binary"
    asked = stored(asked, "queries")
    tiles = asked.repartition(max(1, -(-asked.count() // TILE))).mapInArrow(_pack(TILE), packed)
    n_shards = max(1, -(-rows.count() // SHARD))
    shards = rows.where("id is not null").repartition(n_shards).mapInArrow(_pack(SHARD, True), f"shard int, {packed}")
    shards = stored(shards, "shards")
    # A tile of queries is a hundredth of a shard's weight or less: the tiles travel.
    tiles = tiles.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    tiles = tiles.select("shard", "dim", F.col("ids").alias("q_ids"), F.col("ints").alias("q_ints"))
    best = shards.join(tiles, ["shard", "dim"]).repartition(n_shards, "shard").mapInArrow(
        _partial(k), "shard int, query_id long, vec_id long, score long"
    )
    best = stored(best, "partial")
    order = [F.col("score").desc(), F.col("vec_id")]
    group = F.col("shard") % F.lit(max(1, int(n_shards**0.5)))
    best = _first(best.withColumn("part", group), ["query_id", "part"], order, k).drop("rank")
    return _first(best, ["query_id"], order, k).select("query_id", "rank", "vec_id", "score")


def _first(df: DataFrame, keys: list[str], order: list, k: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def _pack(size: int, numbered: bool = False):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        held: dict[int, list[tuple[int, np.ndarray]]] = {}

        def block(dim: int) -> pa.RecordBatch:
            part = sorted(held.pop(dim), key=lambda x: x[0])
            columns = [
                pa.array([dim], pa.int32()),
                pa.array([np.array([i for i, _ in part], np.int64).tobytes()], pa.binary()),
                pa.array([b"".join(v.tobytes() for _, v in part)], pa.binary()),
            ]
            names = ["dim", "ids", "ints"]
            if numbered:
                columns, names = [pa.array([number], pa.int32()), *columns], ["shard", *names]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for i, v in zip(batch.column("id").to_pylist(), vectors.lists(batch.column("v"))):
                if v is not None:
                    held.setdefault(len(v), []).append((i, np.floor(SCALE * v).astype(np.int64)))
                    if len(held[len(v)]) >= size:
                        yield block(len(v))
        for dim in list(held):
            yield block(dim)

    return pack


def _partial(k: int):
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                yield _tile(row, k)

    return partial


def _tile(row: dict, k: int) -> pa.RecordBatch:
    q_ids, ids = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
    dim = row["dim"]
    if dim:
        q, x = (np.frombuffer(row[c], np.int64).reshape(-1, dim) for c in ("q_ints", "ints"))
        bound = float(np.abs(q).max()) * float(np.abs(x).max()) * dim
        scores = (q.astype(float) @ x.astype(float).T).astype(np.int64) if bound < EXACT else q @ x.T
    else:
        scores = np.zeros((len(q_ids), len(ids)), np.int64)
    out_q, out_v, out_s = [], [], []
    for i, own in enumerate(q_ids):
        line, others = scores[i], ids
        hit = slice(*np.searchsorted(ids, [own, own + 1]))
        if hit.start < hit.stop:
            line, others = np.delete(line, hit), np.delete(ids, hit)
        if len(line) > k:
            least = np.partition(line, len(line) - k)[len(line) - k]
            at = np.flatnonzero(line >= least)
        else:
            at = np.arange(len(line))
        at = at[np.lexsort((others[at], -line[at]))][:k]
        out_q.append(np.full(len(at), own)), out_v.append(others[at]), out_s.append(line[at])
    q, v, s = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_q, out_v, out_s))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(q), row["shard"], np.int32)), pa.array(q), pa.array(v), pa.array(s)],
        ["shard", "query_id", "vec_id", "score"],
    )
