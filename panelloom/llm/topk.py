"""Exact top-k by sequential reading of sorted lists (no random access).

Candidates are dealt out in blocks.  A block has one list per component, sorted by value.  A query reads all
lists in step, each from the end where its products with the query are largest.  A vector that was read in
some lists has a lower bound (its products so far, and the least product of every other list) and an upper
bound (the last product read in every other list).  Reading stops when only a few vectors, besides none
that is unread, can still reach the k-th lower bound; their scores are then resolved from all their products.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelloom.sources.sinks import stage

BLOCK = 8192  # candidates of a block


class Lists:
    """Sorted lists of a block of integer vectors."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").T.copy()  # per component: rows by growing value
        self.values = np.take_along_axis(vectors.T, self.order, axis=1)

    def top(self, query: np.ndarray, k: int, few: int = 64) -> tuple[np.ndarray, np.ndarray]:
        """Rows that hold the k best scores with all ties of the last, and their scores; all rows if there are fewer."""
        n, lists = len(self.vectors), np.flatnonzero(query)
        if n <= max(k, few) or not len(lists):
            return np.arange(n), self.vectors @ query
        weights = query[lists]
        up = weights > 0  # lists that are read from their largest value down
        partial, unread = np.zeros(n), np.ones((len(lists), n))
        worst = weights * np.where(up, self.values[lists, 0], self.values[lists, -1]).astype(np.float64)
        depth, step = 0, max(1, n // 12)
        while True:
            new, last = min(n, depth + step), np.empty(len(lists))
            for side, part, edge in ((up, slice(n - new, n - depth), 0), (~up, slice(depth, new), -1)):
                rows = self.order[lists[side], part]
                products = weights[side][:, None] * self.values[lists[side], part].astype(np.float64)
                partial += np.bincount(rows.ravel(), weights=products.ravel(), minlength=n)
                unread[np.flatnonzero(side)[:, None], rows] = 0.0
                last[side] = products[:, edge]
            depth = new
            lower = partial + worst @ unread
            least = np.partition(lower, n - k)[n - k]
            open_rows = np.flatnonzero(partial + last @ unread >= least)
            if len(open_rows) <= max(few, n // 50) or depth == n:
                break
        scores = self.vectors[open_rows] @ query
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        return open_rows[scores >= cut], scores[scores >= cut]


def valid(embedding: str = "embedding"):
    """Vectors without null and non-finite components."""
    return F.col(embedding).isNotNull() & ~F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def in_blocks(vectors: DataFrame, every: int, search: Callable, fields: str, block: int = BLOCK) -> DataFrame:
    """Queries (rows with an id divisible by `every`) against all rows, block by block.

    `vectors` has (place, vec_id, v).  Rows are dealt out evenly over blocks whatever their ids and values; every
    block gets all queries as a stream after its own rows.  `search(ids, places, candidates)` prepares a block
    and returns a function that answers a batch of queries (ids, places, vectors) with a record batch.
    """
    rows = stage(vectors)
    n = rows.count()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-n // block), min(cores, n // 2048))
    dealt = rows.repartition(blocks).withColumn("block", F.spark_partition_id()).withColumn("query", F.lit(False))
    asked = rows.where(F.col("vec_id") % every == 0).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("query", F.lit(True))
    stream = dealt.unionByName(asked).repartition(blocks, "block").sortWithinPartitions("block", "query")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, answer = None, [], None

        def parts(batch: pa.RecordBatch) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
            block_of, query = batch.column(3).to_numpy(), batch.column(4).to_numpy(zero_copy_only=False)
            marks = block_of.astype(np.int64) * 2 + query
            cuts = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), len(marks)]
            for a, b in zip(cuts, cuts[1:]):
                yield int(block_of[a]), bool(query[a]), batch.slice(a, b - a)

        def matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            return batch.column(1).to_numpy(), batch.column(0).to_numpy(), flat.reshape(batch.num_rows, -1)

        for batch in batches:
            for at, query, part in parts(batch) if batch.num_rows else ():
                if at != now:
                    now, held, answer = at, [], None
                if not query:
                    held.append(matrix(part))
                    continue
                if answer is None:
                    answer = search(*[np.concatenate(x) for x in zip(*held)])
                    held = []
                yield answer(*matrix(part))

    return stream.select("place", "vec_id", "v", "block", "query").mapInArrow(run, fields)


def ranked(found: DataFrame, k: int, score: str) -> DataFrame:
    """The k best of all blocks per query, ties to the smaller vec_id."""
    order = Window.partitionBy("place").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("score").cast(score).alias("score"))


def best_of_block(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, ties to the smaller id."""
    if len(scores) <= 2 * k:
        return np.lexsort((ids, -scores))[:k]
    able = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return able[np.lexsort((ids[able], -scores[able]))[:k]]


def placed(vectors: DataFrame, keep, value) -> DataFrame:
    """(place, vec_id, v) of the rows that take part; place tells repeated rows apart."""
    return vectors.where(keep & F.col("vec_id").isNotNull()).select(
        F.monotonically_increasing_id().alias("place"), F.col("vec_id").cast("bigint").alias("vec_id"), value.alias("v"))


def widest(vectors: DataFrame) -> DataFrame:
    """Rows with the number of components that most rows have; a product needs equal numbers."""
    sizes = vectors.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return vectors.where(F.size("v") == sizes["n"]) if sizes and sizes["n"] else vectors.where(F.lit(False))


def exact_top_k(vectors: DataFrame, *, k: int = 10, every: int = 100, scale: int = 1024, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best integer inner products of floor(scale * x), ties to the smaller id.

    Queries are the rows of `vectors` (vec_id, embedding) whose id is divisible by `every`; candidates are all
    rows but the query's own.  Vectors that are null, hold a null or non-finite component, have no id or
    another length than most take no part.  A repeated row is another row: a candidate, and a query of its own.
    Other columns are ignored; an empty table gives no rows.  Scores must stay below 2^53, where doubles count
    exactly; a vector whose square reaches that is an error, since its scores would be wrong.
    """
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    rows = widest(stage(placed(vectors, valid(), whole)))
    # No inner product, and no part of one, is larger than the largest square of a norm; a component beyond a long saturates.
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    if (rows.agg(F.max(squares)).first()[0] or 0.0) >= 2.0**53:
        raise ValueError("a score could reach 2^53, beyond which doubles do not count exactly; take a smaller scale")

    def search(ids: np.ndarray, places: np.ndarray, candidates: np.ndarray) -> Callable:
        lists = Lists(candidates)

        def answer(query_ids: np.ndarray, query_places: np.ndarray, queries: np.ndarray) -> pa.RecordBatch:
            out = []
            for q, place, vector in zip(query_ids, query_places, queries):
                found, scores = lists.top(vector, k + 1)
                other = places[found] != place
                found, scores = found[other], scores[other]
                best = best_of_block(ids[found], scores, k)
                out.append((np.full(len(best), place), np.full(len(best), q), ids[found][best], scores[best]))
            return pa.record_batch(dict(zip(("place", "query_id", "vec_id", "score"), map(pa.array, map(np.concatenate, zip(*out))))))

        return answer

    found = in_blocks(rows, every, search, "place bigint, query_id bigint, vec_id bigint, score bigint", block)
    return ranked(found, k, "bigint")
