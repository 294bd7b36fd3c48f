"""Exact top-k search (operator 7): the threshold algorithm over sorted
per-dimension lists.

The vectors are dealt out by a hash of their id into parts of about
``part_rows`` rows. A task sorts each dimension of its part once. A query walks
the lists from the end that its component favours, scores what it meets by
random access, and stops when the bound (the sum of component times list value
at the present depth) is below its k-th score; equal bounds go on, so that ties
to smaller ids are exact. The parts' answers meet in one ranking per query.
Queries go in blocks of ``block`` rows, each broadcast (of a fixed size).

Cases: vectors that are null or hold null, NaN or infinite components take no
part, neither do null ids; vectors of unlike length count as padded with zeros;
an empty vector scores 0 against all; rows that repeat a vec_id are candidates
each on their own (equal scores and ids rank one after the other), a query is
asked once per vec_id, with its smallest vector, and none of the rows of its
own vec_id is a candidate; fewer than k candidates give all; an empty table
gives no rows; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import ship, table

ship(__name__)

RESULT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list array as an int64 matrix, padded with zeros."""
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lists), dims), np.int64)
    rows = np.repeat(np.arange(len(lists)), sizes)
    cols = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[rows, cols] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


class Lists:
    """A part's vectors with one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.by_dim = np.argsort(self.vectors, axis=0, kind="stable")     # ascending
        self.sorted = np.take_along_axis(self.vectors, self.by_dim, 0)
        # doubles are multiplied faster than integers, and as exactly while all sums stay below 2^53
        self.doubles = self.vectors.astype(np.float64)
        self.largest = float(np.abs(self.doubles).max(initial=0.0)) * self.vectors.shape[1]

    def scores(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        """The inner products of ``rows`` with ``q``."""
        if self.largest * float(np.abs(q.astype(np.float64)).max(initial=0.0)) < 2.0 ** 53:
            return (self.doubles[rows] @ q.astype(np.float64)).astype(np.int64)
        return self.vectors[rows] @ q

    def top(self, query_id: int, q: np.ndarray, k: int, step: int = 32) -> list[tuple[int, int]]:
        """The k best (score, id), by score descending, then id."""
        n = len(self.ids)
        dims = np.nonzero(q)[0]
        if not len(dims):   # all scores are 0: the first lists' order is the ids' order
            own = self.ids[self.ids != query_id][:k]
            return [(0, int(i)) for i in own]
        weight, down = q[dims], q[dims] > 0
        highest, lowest = dims[down], dims[~down]   # dimensions read from the high end, from the low end
        seen = np.zeros(n, bool)
        seen[np.searchsorted(self.ids, query_id):np.searchsorted(self.ids, query_id, "right")] = True
        best_rows, best = np.empty(0, np.int64), np.empty(0, np.int64)
        depth = 0
        while depth < n:
            stop = min(n, depth + step)
            hit = np.zeros(n, bool)     # marked, not sorted
            hit[self.by_dim[n - stop:n - depth, highest]] = True
            hit[self.by_dim[depth:stop, lowest]] = True
            met = np.flatnonzero(hit & ~seen)
            seen[met] = True
            rows, scores = np.concatenate([best_rows, met]), np.concatenate([best, self.scores(met, q)])
            if len(scores) > k:
                least = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]    # with all ties
                rows, scores = rows[least], scores[least]
            keep = np.lexsort((rows, -scores))[:k]      # rows are in the ids' order
            best_rows, best = rows[keep], scores[keep]
            depth, step = stop, step * 2
            if depth < n and len(best) == k:
                edge = np.where(down, n - 1 - (depth - 1), depth - 1)
                if int(weight @ self.sorted[edge, dims]) < best[-1]:
                    break       # nothing unseen can reach the k-th score
        return [(int(s), int(self.ids[r])) for s, r in zip(best, best_rows, strict=True)]


def usable(vector: Column) -> Column:
    """Neither null nor with null or non-finite components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return vector.isNotNull() & ~F.exists(F.coalesce(vector, F.array()), bad)


def top_k(vectors: DataFrame, queries: DataFrame, k: int, part_rows: int = 16384, block: int = 4096) -> DataFrame:
    """For each row of ``queries`` (vec_id, vector of integers) its ``k`` best
    rows of ``vectors`` (same columns) of another vec_id by inner product:
    query_id, rank, vec_id, score. The number of queries read to the driver at
    once is ``block``."""
    spark = vectors.sparkSession
    stats = vectors.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    asked = queries.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    dims = max(stats[1] or 0, asked.agg(F.max(F.size("vector"))).first()[0] or 0)
    parts = vectors.repartition(max(1, -(-stats[0] // part_rows)), F.xxhash64("vec_id"))
    found, after = [], None
    while True:     # blocks of queries by id
        rows = (asked if after is None else asked.filter(F.col("vec_id") > after)).orderBy("vec_id").limit(block).toArrow()
        if not rows.num_rows:
            break
        ids = rows["vec_id"].to_numpy()
        after = int(ids[-1])
        sent = spark.sparkContext.broadcast((ids, matrix(rows["vector"].combine_chunks(), dims)))
        found.append(parts.select("vec_id", "vector").mapInArrow(_search(sent, k, dims), "query_id long, vec_id long, score long"))
        if rows.num_rows < block:
            break
    if not found:
        found = [parts.limit(0).select(F.col("vec_id").alias("query_id"), "vec_id", F.lit(0).cast("long").alias("score"))]
    every = reduce(DataFrame.unionAll, found)
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return every.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(sent, k: int, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(b.column(0).to_numpy(), matrix(b.column(1), dims)) for b in batches if b.num_rows]
        if not rows:
            return
        lists = Lists(np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows]))
        ids, vectors = sent.value
        out = [(int(i), r, s) for i, q in zip(ids, vectors, strict=True) for s, r in lists.top(int(i), q, k)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=RESULT)
    return run


def op7_top_k(spark, sf_dir: str) -> DataFrame:
    """The 5 best partners of each vector whose vec_id is divisible by 50 among
    all ``embeddings``, components as floor(256 * x): query_id, rank, vec_id,
    score."""
    raw = table(spark, sf_dir, "embeddings").filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    vectors = raw.select(F.col("vec_id").cast("long").alias("vec_id"),
                         F.transform("embedding", lambda x: F.floor(F.lit(256) * x.cast("double")).cast("long")).alias("vector"))
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), 5)


OP7_SQL = """
WITH good AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
ints AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM good),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM ints q JOIN ints c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM pairs QUALIFY rank <= 5
"""
