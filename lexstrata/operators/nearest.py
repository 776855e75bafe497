"""Nearest vectors of a stated query set."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Queries that one task holds; more are searched in blocks.
QUERY_BLOCK = 20_000


def nearest(queries: DataFrame, vectors: DataFrame, k: int = 3, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id_col``, neighbour, rank and score of the ``k`` vectors of largest inner product with each query.

    A query is not its own neighbour; ties go to the smaller id. Null vectors match nothing; fewer vectors than ``k`` give
    fewer neighbours; an empty side gives no rows.
    """
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    result = None
    for b in range(blocks):
        mine = queries.where(F.col(vector_col).isNotNull())
        mine = mine if blocks == 1 else mine.where(F.pmod(F.xxhash64(id_col), F.lit(blocks)) == b)
        held = mine.select(id_col, vector_col).collect()
        ids = np.array([r[0] for r in held], dtype=np.int64)
        matrix = np.array([r[1] for r in held], dtype=np.float64)

        def run(batches: Iterator[pa.RecordBatch], ids: np.ndarray = ids, matrix: np.ndarray = matrix) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not len(ids) or not batch.num_rows:
                    continue
                own = batch.column(0).to_numpy()
                rows = np.array(batch.column(1).to_pylist(), dtype=np.float64)
                score = np.round(matrix @ rows.T, 6)
                score[ids[:, None] == own[None, :]] = -np.inf
                order = np.lexsort((np.broadcast_to(own, score.shape), -score), axis=1)[:, :k]
                found = np.take_along_axis(score, order, axis=1)
                keep = np.isfinite(found)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, order.shape[1])[keep.ravel()]), pa.array(own[order][keep]), pa.array(found[keep])], names=["q", "neighbour", "score"])

        found = vectors.where(F.col(vector_col).isNotNull()).select(id_col, vector_col).mapInArrow(run, "q bigint, neighbour bigint, score double")
        result = found if result is None else result.unionByName(found)
    ranked = result.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "neighbour"))).where(F.col("rank") <= k)
    return ranked.select(F.col("q").alias(id_col), "neighbour", "rank", F.round("score", 4).alias("score"))
