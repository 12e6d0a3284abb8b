"""Exact top-k inner products by block-at-a-time pruning.

Vectors are dealt to shards of bounded size.  A shard's vectors, in order of their ids, are cut into blocks;
each block keeps, for each dimension, its largest and smallest component, and its vectors as a forward index.  The sum of a query's
components times these extremes bounds every score of a block.  A query visits blocks from the highest bound down, and stops when the
next bound is below its k-th best score.  Queries are sent to all shards in batches, so shards are as large as memory allows; a shard's best are merged by rank.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from wardflow.llm.common import batch, column

K = 20
SCALE = 64
BLOCK = 256
#: Components of a shard: as many as a task may hold, since every query goes to every shard, but fewer where tasks would stand idle.
SHARD_VALUES, LEAST_VALUES = 1 << 23, 1 << 20
QUERIES = 1024
#: A scaled component below this is held as a long.
MOST = 1 << 62
NONE = np.iinfo(np.int64).min
HIGHEST = np.iinfo(np.int64).max
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def scaled(vector: Column) -> Column:
    """floor(64 x) of each component; an error if that does not fit a long."""
    wide = F.raise_error(F.lit("a component times 64 does not fit a long")).cast("long")
    return F.transform(vector, lambda x: F.when(F.abs(x.cast("double") * SCALE) < float(MOST), F.floor(x.cast("double") * SCALE).cast("long")).otherwise(wide))


def whole(vector: Column) -> Column:
    """Neither null nor holding a null or a component that is not finite."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def matrix(vectors: pa.Array, width: int = 0) -> np.ndarray:
    """Rows of a list array, padded with zeros to the longest."""
    n = np.diff(vectors.offsets.to_numpy())
    width = max([width, *n.tolist()])
    out = np.zeros((len(n), width), np.int64)
    out[np.arange(width) < n[:, None]] = vectors.flatten().to_numpy()
    return out


class Shard:
    """Blocks of one shard's vectors: bounds and forward indexes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        first = np.arange(0, len(ids), BLOCK)
        self.blocks = [slice(a, a + BLOCK) for a in first]
        self.high = np.maximum.reduceat(self.vectors, first, axis=0)
        self.low = np.minimum.reduceat(self.vectors, first, axis=0)
        self.tops = np.abs(self.vectors).max(1, initial=0)
        self.top = int(self.tops.max(initial=0))
        self.block_tops = np.maximum.reduceat(self.tops, first)

    def wide(self, queries: np.ndarray, tops: np.ndarray) -> np.ndarray:
        """For each query and each largest component, whether a sum of products might not fit a long; never missed, if rounded."""
        size = np.abs(queries).max(1, initial=0).astype(np.float64) * max(1, queries.shape[1])
        return size[:, None] * tops.astype(np.float64) >= MOST

    def best(self, ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of each query's best, highest first, ties to the smaller id; NONE where there are fewer."""
        exact = self.top * int(np.abs(queries).max(initial=0)) * queries.shape[1] < 1 << 53
        kind = np.float64 if exact else np.int64  # products in floating point are exact below 2**53
        q, v = queries.astype(kind), self.vectors.astype(kind)
        bound = np.maximum(q, 0) @ self.high.astype(kind).T + np.minimum(q, 0) @ self.low.astype(kind).T
        bound = bound.astype(np.int64)
        large = self.top * int(np.abs(queries).max(initial=0)) * max(1, queries.shape[1]) >= MOST
        if large:
            bound[self.wide(queries, self.block_tops)] = HIGHEST
        visits = np.argsort(-bound, 1, kind="stable")
        found = np.full((len(q), k), NONE)
        scores = np.full((len(q), k), NONE)
        for turn in range(len(self.blocks)):
            block = visits[:, turn]
            open_ = np.flatnonzero(bound[np.arange(len(q)), block] >= scores[:, -1])
            if not len(open_):
                break
            for b in np.unique(block[open_]):
                rows = open_[block[open_] == b]
                s = (q[rows] @ v[self.blocks[b]].T).astype(np.int64)
                others = self.ids[self.blocks[b]]
                same = ids[rows, None] == others
                if large:
                    for i, j in np.argwhere(self.wide(queries[rows], self.tops[self.blocks[b]]) & ~same):
                        x = sum(a * c for a, c in zip(queries[rows[i]].tolist(), self.vectors[self.blocks[b]][j].tolist()))
                        if x > HIGHEST:
                            raise OverflowError("a score does not fit a long")
                        s[i, j] = max(x, NONE + 1)
                s[same] = NONE
                passed = ((s >= scores[rows, -1:]) & (s > NONE)).sum(1)
                rows, s, most = rows[passed > 0], s[passed > 0], int(passed.max(initial=0))
                if not most:
                    continue
                pick = np.argpartition(~s, most - 1, 1)[:, :most] if most < s.shape[1] else np.broadcast_to(np.arange(s.shape[1]), s.shape)
                all_scores = np.concatenate([scores[rows], np.take_along_axis(s, pick, 1)], 1)
                all_ids = np.concatenate([found[rows], others[pick]], 1)
                keep = np.lexsort((all_ids, ~all_scores), axis=1)[:, :k]
                scores[rows] = np.take_along_axis(all_scores, keep, 1)
                found[rows] = np.take_along_axis(all_ids, keep, 1)
        return found, scores


def search(batches, k: int):
    """Best of each query in each shard; rows are sorted by shard, its vectors before the queries."""
    shard, ids, parts, index = None, [], [], None
    for b in batches:
        of, kind, own = (column(b, c).to_numpy() for c in ("shard", "kind", "vec_id"))
        cut = np.flatnonzero((of[1:] != of[:-1]) | (kind[1:] != kind[:-1])) + 1
        for i, j in zip([0, *cut], [*cut, len(of)]):
            if i == j:
                continue
            if of[i] != shard:
                shard, ids, parts, index = of[i], [], [], None
            vectors = matrix(column(b, "vector").slice(i, j - i))
            if not kind[i]:
                ids.append(own[i:j])
                parts.append(vectors)
                continue
            if not parts:
                continue
            if index is None:
                width = max(p.shape[1] for p in parts)
                index = Shard(np.concatenate(ids), np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts]))
            width = index.vectors.shape[1]
            fit = np.pad(vectors, ((0, 0), (0, max(0, width - vectors.shape[1]))))[:, :width]
            for a in range(0, j - i, QUERIES):
                mine = own[i + a : min(j, i + a + QUERIES)]
                found, scores = index.best(mine, fit[a : a + QUERIES], k)
                real = scores > NONE
                yield batch(FOUND, np.repeat(mine, real.sum(1)), found[real], scores[real])


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of each query, ties to the smaller id; all, if there are fewer.

    A row's own id is never among its results.  Vectors that are null or hold a null or a component that is not finite take no
    part, nor do rows without an id.  Scores are exact; sums that may not fit a long are taken in Python's integers, and a result that
    does not fit, or a component that does not times 64, is an error.  Shorter vectors count as ending in zeros.  Repeated rows are results each; a repeated query id has the results of its rows together. An
    empty table gives no rows.
    """
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"), is_query.alias("q")).filter(F.col("vec_id").isNotNull() & whole(F.col("v")))
    rows = own.select("vec_id", scaled(F.col("v")).alias("vector"), F.coalesce("q", F.lit(False)).alias("q"))
    n, width = own.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    values = n * (width or 0)
    idle = min(-(-values // LEAST_VALUES), 2 * vectors.sparkSession.sparkContext.defaultParallelism)
    shards = max(1, -(-values // SHARD_VALUES), idle)
    dealt = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"), F.lit(0).alias("kind"), "vec_id", "vector")
    asked = rows.filter("q").select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), F.lit(1).alias("kind"), "vec_id", "vector")
    met = dealt.union(asked).repartition(shards, "shard").sortWithinPartitions("shard", "kind")
    found = met.mapInArrow(lambda batches: search(batches, k), "query_id long, vec_id long, score long")
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    score = F.when(F.col("score") > NONE + 1, F.col("score")).otherwise(F.raise_error(F.lit("a score does not fit a long")).cast("long"))
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", score.alias("score"))
