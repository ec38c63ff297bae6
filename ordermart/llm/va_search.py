"""Exact top-k search with vector-approximation files.

Vectors are dealt into blocks by a hash of their id.  A block keeps, beside its
exact vectors, an approximation of ``BITS`` bits a component (the cell of the
component within the block's range).  For a batch of queries one matrix product
over the cells gives an upper bound of every score; exact vectors are then read
in the order of their bounds until the k-th best score found is above every
bound left, so the result is exact.  A query visits each block once; the best k
of its blocks are merged by a window.

Memory is one block and one batch of queries, whatever the table's size; the
queries are copied to the blocks by a shuffle, never broadcast.

Scores are inner products of floor(256 * x).  Defined results: a vector that is
null or holds null or non-finite components takes no part, nor does a row
without an id; only vectors of the query's length are candidates; rows with the
query's own id are its own; a repeated query id is searched once, with its
smallest vector; repeated candidates each take a rank; ties go to the smaller
id; a query with fewer candidates than k gets all; an empty table gives no rows.
Vectors so large that a score could pass a 64-bit integer raise a ValueError.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions

BITS, BLOCK_ROWS, QUERY_ROWS, READ = 6, 16_384, 256, 64
FOUND = "query_id long, vec_id long, score long"


class Block:
    """Vectors of one length: cells for the bounds, integers for the scores."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        self.low = vectors.min(0).astype(float)
        self.width = np.maximum(vectors.max(0) - self.low, 1) / (2 ** BITS - 1)
        self.largest = np.maximum(np.abs(self.low), np.abs(vectors.max(0).astype(float)))
        self.cells = np.round((vectors - self.low) / self.width).astype(np.uint8)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores: the cell's centre plus half its width
        in the direction of the query (and a little for rounding, also of
        scores beyond the exact range of float64)."""
        q = queries.astype(float)
        centre = (q @ self.low)[:, None] + (q * self.width) @ self.cells.T.astype(float)
        return centre + (np.abs(q) @ (self.width * (0.5 + 1e-6) + self.largest * 1e-9) + 1e-6)[:, None]

    def top(self, query_id: int, query: np.ndarray, bounds: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The best (score, -id) pairs of one query."""
        order = np.argsort(-bounds, kind="stable")
        best: list[tuple[int, int]] = []
        at, size = 0, READ
        while at < len(order) and (len(best) < k or bounds[order[at]] >= best[-1][0]):
            rows = order[at:at + size]
            scores = self.vectors[rows] @ query
            some = [(int(s), -int(i)) for s, i in zip(scores, self.ids[rows]) if i != query_id]
            best = sorted(best + some, reverse=True)[:k]
            at, size = at + size, size * 2
        return best


def search(vectors: DataFrame, k: int, every: int, key: str = "vec_id", vector: str = "embedding",
           scale: float = 256.0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for rows whose id is divisible by
    ``every``, the ``k`` other rows with the highest inner products."""
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = (vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
              .filter(F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad))
    n, largest, length = usable.agg(
        F.count("*"), F.coalesce(F.max(F.array_max(F.transform("v", F.abs))), F.lit(0.0)),
        F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    if (scale * largest + 1) ** 2 * length >= 2.0 ** 63:
        raise ValueError(f"components up to {largest} over {length} dimensions: a score can pass a 64-bit integer")
    rows = usable.select("id", F.transform("v", lambda x: F.floor(F.lit(scale) * x).cast("long")).alias("v"))
    n_blocks = max(shuffle_partitions(vectors.sparkSession), -(-n // block_rows))
    data = rows.select("id", "v", F.pmod(F.xxhash64("id", "v"), F.lit(n_blocks)).cast("int").alias("block"),
                       F.lit(0).alias("asks"))
    asked = rows.filter(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    asked = asked.select("id", "v", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"),
                         F.lit(1).alias("asks"))
    dealt = (data.unionByName(asked).withColumn("length", F.size("v"))
             .repartition(n_blocks, "block").sortWithinPartitions("block", "length", "asks"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, ids, held, block = None, [], [], None
        for b in batches:
            col = {n: b.column(n) for n in ("id", "block", "asks", "length")}
            col = {n: c.to_numpy(zero_copy_only=False) for n, c in col.items()}
            v, at = b.column("v"), 0
            while at < b.num_rows:
                # a run of rows of one block, length and kind
                same = ((col["block"] == col["block"][at]) & (col["length"] == col["length"][at])
                        & (col["asks"] == col["asks"][at]))[at:]
                end = b.num_rows if same.all() else at + int(np.argmin(same))
                end = min(end, at + QUERY_ROWS) if col["asks"][at] else end
                part = v.slice(at, end - at).flatten().to_numpy(zero_copy_only=False).reshape(end - at, -1)
                if where != (col["block"][at], col["length"][at]):
                    where, ids, held, block = (col["block"][at], col["length"][at]), [], [], None
                if not col["asks"][at]:
                    ids.append(col["id"][at:end])
                    held.append(part)
                elif held:
                    block = block or Block(np.concatenate(ids), np.concatenate(held))
                    bounds, found = block.bounds(part), []
                    for i, query in enumerate(part):
                        own = int(col["id"][at + i])
                        found += [(own, -i_, s) for s, i_ in block.top(own, query, bounds[i], k)]
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)],
                                                         names=["query_id", "vec_id", "score"])
                at = end

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (dealt.mapInArrow(work, FOUND).withColumn("rank", F.row_number().over(best))
            .filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
