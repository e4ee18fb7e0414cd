"""Exact top-k by inner product: tiled matrix products, partial selection per tile, tree merging."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.llm.stages import keep
from bindery.operators.ordered import assign_row_id

SHARD_ROWS = 8192
QUERY_ROWS = 1024
FAN_IN = 32
_LONG = (1 - 2**63, 2**63 - 1)


def _packer(most: int):
    """Rows (id, vector as doubles that hold integers) into blocks of one dimension and at most ``most`` rows."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("_v")
            dims = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            ids = batch.column("_id").to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            first = np.concatenate([[0], np.cumsum(dims)])
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                rows = rows[np.argsort(ids[rows], kind="stable")]
                for part in np.array_split(rows, -(-len(rows) // most)):
                    vectors = flat[(first[part][:, None] + np.arange(dim)).reshape(-1)]
                    kind = "<i2" if np.abs(vectors).max(initial=0) < 2**15 else "<f8"
                    yield pa.record_batch(
                        {
                            "dim": pa.array([int(dim)], pa.int32()),
                            "kind": pa.array([kind]),
                            "ids": pa.array([ids[part].astype("<i8").tobytes()], pa.binary()),
                            "vectors": pa.array([vectors.astype(kind).tobytes()], pa.binary()),
                        }
                    )

    return pack


def _products(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Exact integer inner products, in the smallest type that holds every partial sum."""
    longest = lambda m: float(np.sqrt((m * m).sum(axis=1)).max(initial=0.0))
    bound = longest(queries) * longest(shard)
    if bound < 2**23:
        return queries.astype(np.float32) @ shard.astype(np.float32).T
    if bound < 2**52:
        return queries @ shard.T
    whole = [[int(x) for x in row] for row in shard]
    return np.array([[sum(int(a) * b for a, b in zip(q, row)) for row in whole] for q in queries], object)


def _selector(k: int):
    """The k best of a shard for every query of a tile; ties go to the smaller id."""

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile in batch.to_pylist():
                q_ids, ids = np.frombuffer(tile["q_ids"], "<i8"), np.frombuffer(tile["ids"], "<i8")
                queries = np.frombuffer(tile["q_vectors"], tile["q_kind"]).reshape(len(q_ids), tile["dim"])
                shard = np.frombuffer(tile["vectors"], tile["kind"]).reshape(len(ids), tile["dim"])
                scores = _products(queries.astype(float), shard.astype(float))
                out = {"q_row": [], "query_id": [], "vec_id": [], "score": []}
                for i, q in enumerate(q_ids):
                    own = scores[i]
                    other = np.flatnonzero(ids != q)
                    if len(other) < len(ids):
                        own = own[other]
                    if len(other) > k:
                        limit = np.partition(own, -k)[-k]  # ids rise, so ties keep the smaller ones
                        above, ties = np.flatnonzero(own > limit), np.flatnonzero(own == limit)
                        best = np.concatenate([above, ties[: k - len(above)]])
                    else:
                        best = np.arange(len(other))
                    out["q_row"] += [(tile["q_block"] << 16) + i] * len(best)
                    out["query_id"] += [int(q)] * len(best)
                    out["vec_id"] += ids[other[best]].tolist()
                    out["score"] += [min(max(int(s), _LONG[0]), _LONG[1]) for s in own[best]]
                if out["q_row"]:
                    yield pa.record_batch(
                        {"part": pa.array([tile["block"]] * len(out["q_row"]), pa.int64())}
                        | {c: pa.array(v, pa.int64()) for c, v in out.items()}
                    )

    return select


def top_k(
    queries: DataFrame, candidates: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, k: int = 5,
    shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """The ``k`` candidates of highest inner product per query row: query_id, rank, vec_id, score.

    Vectors are arrays of whole numbers as doubles; the products are exact (a score outside the range
    of long ends at its limit). Null vectors, vectors with null or non-finite components, and rows
    without an id take no part. Candidates with the query's own id are left out; ties go to the
    smaller id. Only vectors of one length are compared. Repeated rows count as often as they occur.
    Empty tables give an empty result.

    Queries and candidates are packed into blocks of bounded size, and every pair of blocks is one
    row of one join, so no task ever holds more than one tile at a time, whatever the data. A tile
    keeps k rows per query; lists are merged ``FAN_IN`` shards at a time.
    """
    sound = (
        F.col(id_col).isNotNull()
        & F.col(vector_col).isNotNull()
        & F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )

    def packed(df: DataFrame, most: int, name: str) -> DataFrame:
        blocks = df.mapInArrow(_packer(most), "dim int, kind string, ids binary, vectors binary")
        written = keep(blocks.withColumn("_block", F.monotonically_increasing_id()), name)
        numbers = assign_row_id(written.select("_block"), [F.col("_block")], "block")
        return written.join(numbers, "_block").drop("_block")

    rows = [x.filter(sound).select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).alias("_v")) for x in (queries, candidates)]
    # Blocks of queries are filled up before they are multiplied; shards are as the scan gives them.
    n_blocks = max(1, -(-rows[0].count() // query_rows))
    left = packed(rows[0].repartition(n_blocks), query_rows, "query-blocks")
    right = packed(rows[1], shard_rows, "shards")
    n_left, n_right = left.count(), right.count()
    if not n_left or not n_right:
        return queries.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    def copies(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    tiles = (
        left.select(*[F.col(c).alias(f"q_{c}") for c in left.columns], copies(n_right).alias("block"))
        .join(right.select("*", copies(n_left).alias("q_block")), ["q_block", "block"])
        .filter("dim = q_dim")
    )
    best = tiles.mapInArrow(_selector(k), "part long, q_row long, query_id long, vec_id long, score long")
    parts = n_right
    entry = F.struct((-F.col("score")).alias("s"), "vec_id")  # rises from the best
    merged = keep(best.select("part", "q_row", "query_id", entry.alias("e")), "tile-lists")
    while True:
        parts = -(-parts // FAN_IN)
        lists = merged.groupBy("q_row", "query_id", F.pmod("part", F.lit(parts)).alias("part"))
        top = lists.agg(F.slice(F.sort_array(F.collect_list("e")), 1, k).alias("top"))
        if parts == 1:
            break
        merged = keep(top.select("part", "q_row", "query_id", F.explode("top").alias("e")), "merged-lists")
    ranked = top.select("query_id", F.posexplode("top").alias("rank", "e"))
    return ranked.select("query_id", (F.col("rank") + 1).alias("rank"), "e.vec_id", (-F.col("e.s")).alias("score"))
