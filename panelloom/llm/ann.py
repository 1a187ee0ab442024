"""Approximate nearest neighbours by collision counting.

Every vector is projected on `lines` random lines.  A block of vectors has one array per line, sorted by the
projection.  A query opens a window of equal width around its own projection on every line; a vector
collides on a line where it lies in the window.  The width grows by a factor from round to round (virtual
rehashing: the arrays stay, only the windows widen), and just the new ends of a window are counted.  A vector
with at least `threshold` * lines collisions is verified by its exact inner product.  A query is done when
`share` of the block is verified (16 * k rows at least).  Recall is measured, not guaranteed.

Nearness is the largest inner product: vectors get one more component, sqrt(M^2 - |x|^2) with M the largest
norm of all, queries are stretched to the norm M and get 0, so that the nearest by distance have the
largest inner product.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm.topk import best_of_block, in_blocks, placed, ranked, valid, widest
from panelloom.sources.sinks import stage

BLOCK = 8192
LINES = 64
THRESHOLD = 0.65
SHARE = 0.25
GROWTH = 1.2


class Windows:
    """Sorted projections of a block."""

    def __init__(self, vectors: np.ndarray, largest: float, lines: int, seed: int):
        self.vectors, self.largest = vectors, largest
        extra = np.sqrt(np.maximum(largest**2 - (vectors**2).sum(axis=1), 0.0))
        self.axes = np.random.default_rng(seed).normal(size=(lines, vectors.shape[1] + 1))
        projected = self.axes[:, :-1] @ vectors.T + self.axes[:, -1:] * extra
        self.order = np.argsort(projected, axis=1, kind="stable")
        self.sorted = np.take_along_axis(projected, self.order, axis=1)
        self.spread = float(np.median(self.sorted[:, -1] - self.sorted[:, 0]))
        # All arrays as one growing array, each line shifted beyond the one before: one search finds all ends.
        self.shift = np.arange(lines) * 4 * max(1.0, float(np.abs(projected).max()))
        self.joined = (self.sorted + self.shift[:, None]).ravel()
        self.first = np.arange(lines) * len(vectors)

    def _ends(self, values: np.ndarray) -> np.ndarray:
        """Place of a value in the array of each line."""
        limit = self.shift[1] / 2 if len(self.shift) > 1 else np.inf
        n = len(self.vectors)
        return np.clip(np.searchsorted(self.joined, np.clip(values, -limit, limit) + self.shift) - self.first, 0, n)

    def near(self, query: np.ndarray, k: int, threshold: float, share: float, growth: float) -> tuple[np.ndarray, np.ndarray]:
        """Verified rows and their exact inner products, k at least where the block has as many."""
        n, lines = len(self.vectors), len(self.axes)
        if n <= 16 * k:
            return np.arange(n), self.vectors @ query
        need, enough = int(np.ceil(threshold * lines)), min(n, max(16 * k, int(share * n)))
        centre = self.axes[:, :-1] @ query * (self.largest / np.linalg.norm(query))
        low = self._ends(centre)
        high = low.copy()
        hits, width = np.zeros(n, dtype=np.int64), self.spread / 12
        while True:
            a, b = np.minimum(self._ends(centre - width), low), np.maximum(self._ends(centre + width), high)
            new = [own[x:y] for own, x, y in zip(self.order, a.tolist(), low.tolist())]
            new += [own[x:y] for own, x, y in zip(self.order, high.tolist(), b.tolist())]
            hits += np.bincount(np.concatenate(new), minlength=n)
            low, high = a, b
            found = np.flatnonzero(hits >= need)
            if len(found) >= enough or (low.max() == 0 and high.min() == n):
                return found, self.vectors.take(found, axis=0) @ query
            width *= growth


def nearest(vectors: DataFrame, *, k: int = 20, every: int = 20, lines: int = LINES, threshold: float = THRESHOLD, share: float = SHARE,
            growth: float = GROWTH, block: int = BLOCK, seed: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): near the k largest inner products, in double precision.

    Queries are the rows of `vectors` (vec_id, embedding) whose id is divisible by `every`; candidates are all
    rows but the query's own, and every row is in the index.  Vectors that are null, zero, hold a null or
    non-finite component, have no id or another length than most take no part.  A repeated row is another
    row: a candidate, and a query of its own.  Other columns are ignored; an empty table gives no rows.  A query
    always gets k rows, or all other rows where there are fewer.
    """
    some = F.exists("embedding", lambda x: x != 0)
    rows = widest(stage(placed(vectors, valid() & some, F.transform("embedding", lambda x: x.cast("double")))))
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    largest = float(np.sqrt(rows.agg(F.max(squares)).first()[0] or 0.0))

    def search(ids: np.ndarray, places: np.ndarray, candidates: np.ndarray) -> Callable:
        windows = Windows(candidates, largest, lines, seed)

        def answer(query_ids: np.ndarray, query_places: np.ndarray, queries: np.ndarray) -> pa.RecordBatch:
            out = []
            for q, place, vector in zip(query_ids, query_places, queries):
                found, scores = windows.near(vector, k + 1, threshold, share, growth)
                other = places[found] != place
                found, scores = found[other], scores[other]
                best = best_of_block(ids[found], scores, k)
                out.append((np.full(len(best), place), np.full(len(best), q), ids[found][best], scores[best]))
            return pa.record_batch(dict(zip(("place", "query_id", "vec_id", "score"), map(pa.array, map(np.concatenate, zip(*out))))))

        return answer

    found = in_blocks(rows, every, search, "place bigint, query_id bigint, vec_id bigint, score double", block)
    return ranked(found, k, "double")
