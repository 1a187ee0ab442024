"""Ranked lexical search with range-maximum tables over posting lists.

Documents are indexed block by block: for each term of the queries a list of documents, with the impact (the exact
share of the score) that the term has in each, and a sparse table that gives the largest impact in any range of the
list.  A query starts from the interval of all documents of the block.  The sum of the largest impacts of its terms
bounds the scores in an interval.  Intervals are taken best bound first; each is split at the document with its
largest impact, which is scored exactly, and what lies to the left and right of it is bounded anew.  Intervals whose
bound is below the k-th score found so far are never opened.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelloom.llm.common import by_slice, utf8
from panelloom.sources.sinks import stage

POSTINGS = 1 << 20  # postings of a block
DOCUMENTS = 1 << 16  # documents of a block
QUERY_BYTES = 8 << 20  # text of the queries that are answered in one pass over the documents
BATCH = 128  # intervals that are opened at once

# Bytes of a term are digits, letters and all outside ASCII; A-Z become lower case.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def weight(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)


class Index:
    """Posting lists of a block of documents and their sparse tables of range maxima.

    `rows` gives (terms, counts) per document, terms as numbers below len(weights); documents keep their order.
    """

    def __init__(self, lengths: np.ndarray, sizes: np.ndarray, numbers: np.ndarray, counts: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int):
        self.n = len(lengths)
        m = 100 - 75 + (75 * lengths * n_docs) // n_terms
        place = np.repeat(np.arange(self.n), sizes)
        impact = weights[numbers] * ((1_000_000_000 * counts) // (1000 * counts + 8 * m[place]))
        some = impact > 0
        numbers, place, impact = numbers[some], place[some], impact[some]
        # Long lists come first, so that the level for ranges of 2^j is a prefix.
        have, sizes = np.unique(numbers, return_counts=True)
        by = np.argsort(-sizes, kind="stable")
        self.list_of = np.full(len(weights), -1, dtype=np.int64)
        self.list_of[have[by]] = np.arange(len(have))
        self.ends = np.concatenate([[0], np.cumsum(sizes[by])])
        self.keys = self.list_of[numbers] * self.n + place
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.impact = self.keys[order], impact[order]
        level, levels, j = np.arange(len(order), dtype=np.int32), [], 0
        while len(level):
            levels.append(level)
            j += 1
            covered = int(self.ends[np.count_nonzero(np.diff(self.ends) >= 1 << j)]) - (1 << j) + 1
            if covered <= 0:
                break
            a, b = level[:covered], level[1 << (j - 1) : covered + (1 << (j - 1))]
            level = np.where(self.impact[b] > self.impact[a], b, a)
        self.base = np.cumsum([0, *map(len, levels)])
        self.table = np.concatenate(levels) if levels else np.zeros(0, dtype=np.int32)

    def largest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Place of the largest impact in each non-empty range of a list."""
        j = np.frexp((high - low).astype(np.float64))[1] - 1
        a, b = self.table[self.base[j] + low], self.table[self.base[j] + high - (1 << j)]
        return np.where(self.impact[b] > self.impact[a], b, a)

    def search(self, numbers: np.ndarray, repeats: np.ndarray, best: Best) -> None:
        """Offer every document that may be among the best to `best`, by its place and score."""
        lists = self.list_of[numbers]
        repeats, lists = repeats[lists >= 0], lists[lists >= 0]
        if not len(lists):
            return
        frontier, made = [], 0

        def add(own: np.ndarray, which: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
            """Queue intervals: rows of one interval stand together, `own` tells them apart."""
            nonlocal made
            if not len(own):
                return
            top = self.largest(low, high)
            share = repeats[which] * self.impact[top]
            cuts = np.flatnonzero(np.concatenate([[True], np.diff(own) != 0]))
            bounds = np.add.reduceat(share, cuts)
            ends = np.append(cuts[1:], len(own))
            for k in np.flatnonzero(bounds >= best.least).tolist():
                part = slice(cuts[k], ends[k])
                made += 1
                heapq.heappush(frontier, (-int(bounds[k]), made, which[part], low[part], high[part], top[part], share[part]))

        add(np.zeros(len(lists), dtype=np.int64), np.arange(len(lists)), self.ends[lists], self.ends[lists + 1])
        while frontier and -frontier[0][0] >= best.least:
            batch = []
            while frontier and len(batch) < BATCH and -frontier[0][0] >= best.least:
                batch.append(heapq.heappop(frontier)[2:])
            which, low, high, top, share = map(np.concatenate, zip(*batch))
            sizes = np.array([len(x[0]) for x in batch])
            cuts = np.cumsum(sizes) - sizes
            own = np.repeat(np.arange(len(batch)), sizes)
            is_most = np.flatnonzero(share == np.maximum.reduceat(share, cuts)[own])
            split = self.keys[top[is_most[np.searchsorted(own[is_most], np.arange(len(batch)))]]] % self.n
            wanted = lists[which] * self.n + split[own]
            at = np.searchsorted(self.keys, wanted)
            here = (at < high) & (self.keys[np.minimum(at, len(self.keys) - 1)] == wanted)
            scores = np.add.reduceat(np.where(here, repeats[which] * self.impact[np.minimum(at, len(self.keys) - 1)], 0), cuts)
            best.offer(split, scores)
            left, right = at > low, at + here < high
            add(np.concatenate([2 * own[left], 2 * own[right] + 1]), *[np.concatenate([a[left], b[right]]) for a, b in ((which, which), (low, at + here), (at, high))])


class Best:
    """The k best (score, doc_id) so far, ties to the smaller id; a null id counts as the largest."""

    def __init__(self, k: int):
        self.k, self.heap, self.least, self.ids = k, [], 1, []

    def offer(self, places: np.ndarray, scores: np.ndarray) -> None:
        for i in np.flatnonzero(scores >= self.least).tolist():
            doc_id = self.ids[places[i]]
            entry = (int(scores[i]), -doc_id if doc_id is not None else -math.inf)
            if len(self.heap) < self.k:
                heapq.heappush(self.heap, entry)
            elif entry > self.heap[0]:
                heapq.heapreplace(self.heap, entry)
            if len(self.heap) == self.k:
                self.least = max(1, self.heap[0][0])


def _postings(docs: DataFrame, numbers: dict[bytes, int], doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, terms, counts) of the documents with a term: all their terms are counted, those of `numbers` listed."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        number, lengths, lists = shared.value.get, [], []
        for t in utf8(batch.column(1)):
            words = terms(t)
            lengths.append(len(words))
            lists.append([(k, c) for w, c in Counter(words).items() if (k := number(w)) is not None])
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in lists])]), pa.int32())
        pairs = np.array([p for x in lists for p in x], dtype=np.int64).reshape(-1, 2)
        out = pa.record_batch([batch.column(0), pa.array(lengths, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(pairs[:, 0].astype(np.int32))),
                               pa.ListArray.from_arrays(offsets, pa.array(pairs[:, 1]))], names=["doc_id", "n", "terms", "counts"])
        return out.filter(pa.array(np.array(lengths) > 0))

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        by_slice(run), "doc_id bigint, n bigint, terms array<int>, counts array<bigint>")


def _document_counts(postings: DataFrame, n: int) -> np.ndarray:
    """Documents that hold each term; every task sends one row per term it has seen."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(n, dtype=np.int64)
        for batch in batches:
            seen += np.bincount(batch.column(0).flatten().to_numpy(), minlength=n)
        some = np.flatnonzero(seen)
        yield pa.record_batch({"term": pa.array(some.astype(np.int32)), "c": pa.array(seen[some])})

    out = np.zeros(n, dtype=np.int64)
    for r in postings.select("terms").mapInArrow(run, "term int, c bigint").groupBy("term").agg(F.sum("c").alias("c")).collect():
        out[r.term] = r.c
    return out


def _answers(postings: DataFrame, queries: list, n_words: int, k: int) -> DataFrame:
    """The k best of every task for queries (place, item_id, term numbers, repeats)."""
    n_docs, n_terms = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    shared = postings.sparkSession.sparkContext.broadcast((queries, weight(n_docs, _document_counts(postings, n_words))))

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size = [], 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                held.append(part)
                rows, size = rows + part.num_rows, size + len(part.column(2).flatten())
                if rows >= DOCUMENTS or size >= POSTINGS:
                    yield pa.concat_batches(held)
                    held, rows, size = [], 0, 0
        if held:
            yield pa.concat_batches(held)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights = shared.value
        best = [Best(k) for _ in asked]
        for block in blocks(batches):
            lists = block.column(2)
            index = Index(block.column(1).to_numpy(), np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(),
                          block.column(3).flatten().to_numpy(), weights, n_docs, n_terms)
            ids = block.column(0).to_pylist()
            for own, (_, _, numbers, repeats) in zip(best, asked):
                own.ids = ids
                index.search(numbers, repeats, own)
        rows = [(q[0], q[1], -i if i != -math.inf else None, s) for own, q in zip(best, asked) for s, i in own.heap]
        yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * 4, names=["place", "item_id", "doc_id", "score"])

    return postings.mapInArrow(run, "place bigint, item_id bigint, doc_id bigint, score bigint")


def search(docs: DataFrame, items: DataFrame, *, k: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): for every row of `items` the k documents with the highest score above 0, ties to the smaller doc_id.

    Terms are maximal stretches of ASCII letters, digits and characters outside ASCII, A-Z in lower case.  A term in df
    of N documents (those with a term) weighs w = floor(1000 ln((2N+2)/(2df+1))); a document of n terms, of L in all, has
    m = 25 + 75nN div L, and scores the sum of w * (10^9 tf div (1000 tf + 8m)) over the terms of the item, repeats included.

    Items are answered in sets of at most `query_bytes` of text (one longer item stands alone), each by one pass over all
    documents, whose terms of that set are written once; every document is indexed in some block.  Null or empty texts have no
    terms: such an item has no rows, such a document is never found.  A repeated row of `docs` is another document, of `items`
    another query with rows of its own; a null doc_id comes last among ties; other columns are ignored; an empty table gives no rows.
    """
    asked = stage(items.select(F.monotonically_increasing_id().alias("place"), F.col(item_id).cast("bigint").alias("item_id"), F.col(text).cast("string").alias("text")))
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    total, largest = asked.agg(F.coalesce(F.sum(size), F.lit(0)), F.coalesce(F.max(size), F.lit(0))).first()
    sets = max(1, -(-total // query_bytes))
    part = lambda: F.pmod(F.xxhash64("place"), F.lit(sets))
    while asked.groupBy(part()).agg(F.sum(size).alias("s")).agg(F.coalesce(F.max("s"), F.lit(0))).first()[0] > max(query_bytes, largest):
        sets *= 2
    found = []
    for one in range(sets):
        numbers: dict[bytes, int] = {}
        queries = []
        for r in asked.where(part() == one).collect():
            own = Counter(numbers.setdefault(w, len(numbers)) for w in terms((r.text or "").encode()))
            queries.append((r.place, r.item_id, np.array(list(own), dtype=np.int64), np.array(list(own.values()), dtype=np.int64)))
        found.append(_answers(stage(_postings(docs, numbers, doc_id, text)), queries, len(numbers), k))
    order = Window.partitionBy("place").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = reduce(DataFrame.unionAll, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
