"""Periodic runs of words by the branching-tandem test on an enhanced suffix array.

The words of some documents stand one document after the other; suffixes are sorted by prefix doubling, first by
document, so that no interval crosses one.  A square of period q at i that cannot be shifted to the right is a
pair of suffixes i and i+q whose longest common prefix is exactly q: both lie in the LCP interval of depth q, in
different children.  So every suffix in a child, the largest excepted, is tested: is the inverse suffix array
at i+q or i-q inside the interval, outside the child?  No tree is built: intervals are the nearest smaller values
of the LCP array.  Each square found is rotated to the left as far as words agree, which gives a run; squares of
multiples of a period that end with its run belong to it and are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm.common import by_slice, utf8

WORK = 1 << 20  # members of intervals, or words of rotations, that are tested at once


class Documents:
    """Word codes of some documents, one after the other; `start` and `stop` bound the document of each place."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray):
        ends = np.cumsum(lengths)
        self.codes, self.number = codes.astype(np.int64), np.repeat(np.arange(len(lengths)), lengths)
        self.start, self.stop = np.repeat(ends - lengths, lengths), np.repeat(ends, lengths)

    def __len__(self) -> int:
        return len(self.codes)


def sorted_suffixes(docs: Documents, depth: int | None = None) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Suffixes in order, the marks of those that differ from the one before, and ranks by 1, 2, 4, ... words.

    With a `depth` the order stops at the first that many words (a power of two) and ranks are not kept.
    """
    n, levels, h = len(docs), [], 1
    key = docs.number * (docs.codes.max(initial=0) + 1) + docs.codes
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[True], np.diff(key[order]) != 0])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    while True:
        if depth is None:
            levels.append(rank.astype(np.int32) if n < 1 << 31 else rank.copy())
        places = np.flatnonzero(~(new & np.concatenate([new[1:], [True]])))
        if not len(places) or h == depth:
            return order, new, levels
        at = order[places]
        beyond = at + h
        second = np.where(beyond < docs.stop[at], rank[np.minimum(beyond, n - 1)] + 1, 0)
        key = rank[at] * (n + 1) + second
        by = np.argsort(key, kind="stable")
        order[places], key = at[by], key[by]
        new[places] = np.concatenate([[True], np.diff(key) != 0])
        rank[order[places]] = np.maximum.accumulate(np.where(new[places], places, 0))
        h *= 2


def common_prefixes(docs: Documents, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that each suffix shares with the one before it in order."""
    a, b = order[:-1], order[1:]
    shared, last = np.zeros(len(a), dtype=np.int64), len(docs) - 1
    for j in range(len(levels) - 1, -1, -1):
        x, y = a + shared, b + shared
        inside = (x < docs.stop[a]) & (y < docs.stop[b])
        shared += (inside & (levels[j][np.minimum(x, last)] == levels[j][np.minimum(y, last)])).astype(np.int64) << j
    return np.concatenate([[0], shared])


def first_below(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The first place after each of `places` with a smaller value; the number of values where there is none.

    A tree of pairwise minima is climbed to the first subtree on the right that holds one, then descended.
    """
    high = np.iinfo(np.int64).max
    tree = [np.concatenate([values, [-1]]).astype(np.int64)]
    while len(tree[-1]) > 1:
        if len(tree[-1]) % 2:
            tree[-1] = np.append(tree[-1], high)
        tree.append(np.minimum(tree[-1][::2], tree[-1][1::2]))
    bound, who, node, stopped = values[places], np.arange(len(places)), places, []
    for mins in tree[:-1]:
        here = (node % 2 == 0) & (mins[np.minimum(node + 1, len(mins) - 1)] < bound[who])
        stopped.append((who[here], node[here] + 1))
        who, node = who[~here], node[~here] >> 1
    who, node = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    for j in range(len(stopped) - 1, -1, -1):
        who, node = np.concatenate([who, stopped[j][0]]), np.concatenate([node, stopped[j][1]])
        if j:
            node = 2 * node + (tree[j - 1][2 * node] >= bound[who])
    out = np.empty(len(places), dtype=np.int64)
    out[who] = node
    return out


def children(shared: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first, end, lower, upper, depth) of every child of an LCP interval but its largest; ends are exclusive."""
    n, places = len(shared), np.flatnonzero(shared)
    depth = shared[places]
    upper = first_below(shared, places)
    lower = n - 1 - first_below(shared[::-1], n - 1 - places)
    by = np.lexsort((places, depth, lower))
    places, depth, lower, upper = places[by], depth[by], lower[by], upper[by]
    head = np.concatenate([[True], (np.diff(lower) != 0) | (np.diff(depth) != 0)])[: len(places)]
    tail = np.concatenate([head[1:], [True]])[: len(places)]
    group = np.cumsum(head) - 1
    first = np.concatenate([lower[head], places])
    end = np.concatenate([places[head], np.where(tail, upper, np.concatenate([places[1:], [0]])[: len(places)])])
    group = np.concatenate([group[head], group])
    lower, upper, depth = lower[head], upper[head], depth[head]
    by = np.lexsort((end - first, group))
    small = by[np.concatenate([group[by][1:] == group[by][:-1], [False]])[: len(by)]]
    g = group[small]
    return first[small], end[small], lower[g], upper[g], depth[g]


def branching_squares(docs: Documents, order: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(end, period) of the squares that cannot be shifted to the right, by end, then period."""
    n = len(docs)
    inverse = np.empty(n, dtype=np.int64)
    inverse[order] = np.arange(n)
    first, end, lower, upper, depth = children(shared)
    sizes = end - first
    part = (np.cumsum(sizes) - sizes) // WORK
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    found = [np.zeros((2, 0), dtype=np.int64)]
    for a, b in zip(cuts, cuts[1:]):
        child = np.repeat(np.arange(a, b), sizes[a:b])
        begin = np.cumsum(sizes[a:b]) - sizes[a:b]
        i = order[np.arange(len(child)) - np.repeat(begin - first[a:b], sizes[a:b])]
        q = depth[child]
        for other, inside, left in ((i + q, i + q < docs.stop[i], i), (i - q, i - q >= docs.start[i], i - q)):
            r = inverse[np.where(inside, other, 0)]
            hit = inside & (r >= lower[child]) & (r < upper[child]) & ((r < first[child]) | (r >= end[child]))
            found.append(np.stack([left[hit] + 2 * q[hit], q[hit]]))
    return tuple(np.unique(np.concatenate(found, axis=1), axis=1))


def rotated(docs: Documents, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Leftmost word of the run of each square, found by comparing words to the left of it with those a period on."""
    left, active, width = end - 2 * period, np.arange(len(end)), 8
    while len(active):
        rows = max(1, WORK // width)
        going = []
        for k in range(0, len(active), rows):
            some = active[k : k + rows]
            at = left[some][:, None] - 1 - np.arange(width)
            inside = at >= docs.start[end[some] - 1][:, None]
            at = np.maximum(at, 0)
            same = inside & (docs.codes[at] == docs.codes[at + period[some][:, None]])
            steps = np.where(same.all(axis=1), width, same.argmin(axis=1))
            left[some] -= steps
            going.append(some[steps == width])
        active, width = np.concatenate(going), min(2 * width, 1 << 16)
    return left


def runs(docs: Documents, least: int = 6, times: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of at least `least` words and `times` periods, as places in `docs`."""
    end, period = branching_squares(docs, *_suffixes(docs)) if len(docs) else (np.zeros(0, dtype=np.int64),) * 2
    out = [np.zeros((3, 0), dtype=np.int64)]
    while len(end):
        head = np.concatenate([[True], np.diff(end) != 0])
        own = np.cumsum(head) - 1
        left = rotated(docs, end[head], period[head])
        length = end[head] - left
        out.append(np.stack([left, length, period[head]]))
        merged = (period % period[head][own] == 0) & (2 * period <= length[own])
        end, period = end[~merged], period[~merged]
    start, length, period = np.concatenate(out, axis=1)
    wanted = length >= np.maximum(least, times * period)
    return start[wanted], length[wanted], period[wanted]


def _suffixes(docs: Documents) -> tuple[np.ndarray, np.ndarray]:
    order, _, levels = sorted_suffixes(docs)
    return order, common_prefixes(docs, order, levels)


def shared_words(least: int, times: int) -> int:
    """Words that the suffixes at the start of a run and one period on share at the least."""
    return min(max(least - q, (times - 1) * q) for q in range(1, least + 1))


def analysed(texts: list[list[bytes]], least: int = 6, times: int = 4) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """For each document its runs, rows (start, length, period) by start and period, and the words that are kept."""
    lengths = np.array([len(w) for w in texts], dtype=np.int64)
    codes = pa.array([x for w in texts for x in w], pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    found, dropped = [np.zeros((0, 3), dtype=np.int64)] * len(texts), {}
    if len(codes):
        # Documents that repeat nothing of the length that every run repeats hold none; the others are sorted in full.
        all_docs = Documents(codes, lengths)
        depth = 1 << (shared_words(least, times).bit_length() - 1)
        order, new, _ = sorted_suffixes(all_docs, depth)
        some = np.unique(all_docs.number[order[~new]])
        part = Documents(codes[np.isin(all_docs.number, some)], lengths[some])
        start, length, period = runs(part, least, times)
        own = part.number[start]
        by = np.lexsort((period, start))
        rows = np.stack([(start - part.start[start])[by], length[by], period[by]], axis=1)
        cuts = np.searchsorted(own[by], np.arange(len(some) + 1))
        for k, doc in enumerate(some):
            if cuts[k] < cuts[k + 1]:
                found[doc] = mine = rows[cuts[k] : cuts[k + 1]]
                depth_of = np.zeros(lengths[doc] + 1, dtype=np.int64)
                np.add.at(depth_of, mine[:, 0] + mine[:, 2], 1)
                np.add.at(depth_of, mine[:, 0] + mine[:, 1], -1)
                dropped[doc] = np.cumsum(depth_of)[:-1] > 0
    for k, words in enumerate(texts):
        yield found[k], words if k not in dropped else [w for w, gone in zip(words, dropped[k]) if not gone]


def periodic_runs(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least: int = 6, times: int = 4) -> DataFrame:
    """(doc_id, runs, collapsed) for every row of `docs`: the periodic runs of its words and the text with one period left of each.

    Words are stretches without ASCII white space.  A run is a stretch of words with smallest period q (words q
    apart are identical), of at least `least` words and `times` periods (two at least), that no neighbouring word
    extends; `runs` lists structs (start, length, period), counted in words from 0, by start, then period.  A word
    is dropped if any run contains it after that run's first period; `collapsed` joins the others by one space.
    Null and empty texts have no runs and an empty `collapsed`.  Repeated rows give repeated rows; other columns of
    `docs` are ignored; an empty table gives no rows.  A text is analysed whole by one task, in memory of some 150
    bytes a word, and 4 more for every doubling of its longest repeat.
    """
    if least < 2 or times < 2:
        raise ValueError("a run has at least two words and two periods")
    kind = docs.schema[doc_id].dataType.simpleString()
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = list(analysed([t.split() for t in utf8(batch.column(1))], least, times))
        rows = np.concatenate([r for r, _ in parts])
        structs = pa.StructArray.from_arrays([pa.array(rows[:, c]) for c in range(3)], fields=list(run_type))
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r, _ in parts])]), pa.int32())
        collapsed = pa.array([b" ".join(w) for _, w in parts], pa.binary()).cast(pa.string())
        return pa.record_batch([batch.column(0), pa.ListArray.from_arrays(offsets, structs), collapsed], names=["doc_id", "runs", "collapsed"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        by_slice(run), f"doc_id {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")
