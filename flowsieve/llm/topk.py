"""Exact top-k search by inner product: MaxScore over the postings of sharded vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_FOUND = "query_id long, query array<long>, vec_id long, score long"
#: Rows whose bounds are taken together; queries that a task answers at once.
_BLOCK, _QUERIES = 2048, 256


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of a list column; a shorter row lacks its last terms, which counts as 0."""
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), int(size.max(initial=0))), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _stacked(parts: list[np.ndarray]) -> np.ndarray:
    wide = max((p.shape[1] for p in parts), default=0)
    return np.concatenate([np.pad(p, ((0, 0), (0, wide - p.shape[1]))) for p in parts])


class Shard:
    """Postings of a shard: a list of values per term, ordered by identifier, with bounds for each block of rows."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        # doubles hold the products of these integers exactly as long as the sums stay below 2**53
        self.postings = np.ascontiguousarray(values[order].T.astype(np.float64))
        self.blocks = [(a, min(a + _BLOCK, len(ids))) for a in range(0, len(ids), _BLOCK)]
        self.high = [self.postings[:, a:b].max(1) for a, b in self.blocks]
        self.low = [self.postings[:, a:b].min(1) for a, b in self.blocks]

    def top(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best (identifier, score) for a query, ties to the smaller identifier, without its own row.

        A term adds between a lower and an upper bound. Ordered by their difference, the last terms are
        non-essential as long as they can't lift a row from the lower bounds of the others to the k-th best score.
        The essential postings are added up for all rows; then the others are probed, widest first, only for the
        rows that could still reach the k-th best.
        """
        terms = min(len(query), len(self.postings))
        query = query[:terms].astype(np.float64)
        best_id, best = np.zeros(0, np.int64), np.zeros(0)
        for (a, b), high, low in zip(self.blocks, self.high, self.low, strict=True):
            need = best[k - 1] if len(best) >= k else -np.inf
            one, other = query * high[:terms], query * low[:terms]
            upper, lower = np.maximum(one, other), np.minimum(one, other)
            order = np.argsort(lower - upper, kind="stable")
            order = order[query[order] != 0]
            above = np.append(np.cumsum(upper[order][::-1])[::-1], 0.0)  # what the terms from here on can add
            if above[0] < need:
                continue
            below = np.append(0.0, np.cumsum(lower[order]))
            essential = int(np.argmax(below + above < need)) if need > -np.inf and (below + above < need).any() else len(order)
            rows = np.arange(a, b)
            score = query[order[:essential]] @ self.postings[order[:essential], a:b]
            at = essential
            while at < len(order):
                stay = score + above[at] >= need
                rows, score = rows[stay], score[stay]
                if not len(rows):
                    break
                some = order[at : at + 4]
                score = score + query[some] @ self.postings[np.ix_(some, rows)]
                at += len(some)
            stay = (score >= need) & (self.ids[rows] != own)
            ids, score = np.append(best_id, self.ids[rows[stay]]), np.append(best, score[stay])
            first = np.lexsort((ids, -score))[:k]
            best_id, best = ids[first], score[first]
        return best_id, best.astype(np.int64)


def search(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 50,
    k: int = 5,
    scale: int = 256,
    shard_rows: int = 32_768,
    least_shards: int = 8,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best of all rows for each row whose identifier ``every`` divides.

    A component x becomes floor(scale * x); the score is the integer inner product; ties go to the smaller
    identifier. Rows are dealt to shards by a hash of their identifier, each query meets every shard once, and the
    shards' best k are merged per query. What a task holds is one shard; queries stream past it.

    Rows without an identifier, and vectors that are null or hold null or non-finite components, take no part. A
    vector with fewer components lacks the last terms. Rows with a query's identifier are its own and no answer to
    it; other rows that repeat an identifier are answers each for itself. Scores must stay below 2**53. No other
    column is read. An empty table gives no rows.
    """
    x = F.col("v")
    usable = ~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = (
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
        .filter(F.col("id").isNotNull() & x.isNotNull() & F.coalesce(usable, F.lit(False)))
        .select("id", F.transform("v", lambda c: F.floor(c * scale)).alias("v"))
    )
    shards = max(least_shards, -(-rows.count() // shard_rows))
    queries = rows.filter(F.col("id") % every == 0).distinct()
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")).withColumn("asks", F.lit(False))
    asked = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("asks", F.lit(True))

    def answer(batches):
        number, ids, values, shard = None, [], [], None
        for batch in batches:
            of = batch.column(0).to_numpy()
            for lo, hi in _spans(of, batch.column(1).to_numpy(zero_copy_only=False)):
                part = batch.slice(lo, hi - lo)
                if number != of[lo]:
                    number, ids, values, shard = of[lo], [], [], None
                if not part.column(1)[0].as_py():
                    ids.append(part.column(2).to_numpy())
                    values.append(_matrix(part.column(3)))
                    continue
                if shard is None:
                    if not ids:
                        continue
                    shard, ids, values = Shard(np.concatenate(ids), _stacked(values)), [0], []
                yield from _answers(shard, part, k)

    found = (
        dealt.unionByName(asked)
        .repartition("shard")
        .sortWithinPartitions("shard", "asks")
        .select("shard", "asks", "id", "v")
        .mapInArrow(answer, _FOUND)
    )
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def _spans(shard: np.ndarray, asks: np.ndarray):
    """Ranges of rows of one shard and one kind, of bounded length for queries."""
    edge = np.flatnonzero((np.diff(shard) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
    for lo, hi in zip([0, *edge], [*edge, len(shard)], strict=True):
        step = _QUERIES if len(asks) and asks[lo] else max(1, hi - lo)
        for a in range(lo, hi, step):
            yield a, min(a + step, hi)


def _answers(shard: Shard, queries: pa.RecordBatch, k: int):
    out = [[], [], [], []]
    ids, values = queries.column(2).to_pylist(), _matrix(queries.column(3))
    for own, vector, listed in zip(ids, values, queries.column(3).to_pylist(), strict=True):
        near, score = shard.top(own, vector, k)
        for column, x in zip(out, ([own] * len(near), [listed] * len(near), near.tolist(), score.tolist()), strict=True):
            column.extend(x)
    kinds = pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64()
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["query_id", "query", "vec_id", "score"]
    )
