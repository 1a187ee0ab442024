"""SimHash near-duplicates with Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits, each padded to a word of the
perfect binary Golay code (23 bits, 4096 codewords, every word within 3 bits of exactly one).  A word
is decoded to that codeword and, where it lies 3 bits away, to the five codewords 4 bits away.  Two
words that differ in at most 2 bits then share a codeword: the word halfway between them is within 3
bits of some codeword, so both are within 4.  If they differ in at most 1 bit, the nearest codeword of
either is among those of the other.

Up to 3 errors over three segments leave a pair of segments with errors (0, at most 2) or (1, 1).  For a
pair (i, j) the keys of a fingerprint are nearest(i) x near(j) and near(i) x nearest(j): in both cases
two fingerprints share one.  So each gets at most 33 keys of 24 bits, which are joined and verified.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm.common import by_batch, rows_at, staged_in_python, utf8, with_place
from panelloom.llm.components import components
from panelloom.sources.sinks import stage

# Generator polynomial of the Golay code, segment widths.
GENERATOR = 0b110001110101
WIDTHS = (22, 21, 21)

BLOCK = 2048  # fingerprints of one key that are compared in one group; larger ones are cut into pairs of blocks
SHORT = 64  # runs up to this length are compared batch-wise


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of the shingles of ASCII-lower-cased words; 0 where there is no word."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, 42) for g in grams), dtype=np.uint64, count=n)
    for at in range(0, n, 1 << 16):  # bounded unpacking for very long texts
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the upper 12 bits; per syndrome the error patterns up to weight 4; their number."""
    def remainder(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word

    unit = [remainder(1 << i) for i in range(23)]
    upper = np.zeros(4096, dtype=np.int64)
    for i in range(12):
        upper ^= np.where(np.arange(4096) >> i & 1, unit[11 + i], 0)
    found: dict[int, list[int]] = {}
    for weight in range(5):
        for bits in combinations(range(23), weight):
            syndrome = 0
            for b in bits:
                syndrome ^= unit[b]
            if weight < 4 or found[syndrome][0].bit_count() == 3:
                found.setdefault(syndrome, []).append(sum(1 << b for b in bits))
    patterns, many = np.zeros((2048, 6), dtype=np.int64), np.zeros(2048, dtype=np.int64)
    for s, own in found.items():
        patterns[s, : len(own)], many[s] = own, len(own)
    return upper, patterns, many


_TABLES: list = []


def decode(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices near each 23-bit word, the nearest first, and how many (1 or 6) there are."""
    if not _TABLES:
        _TABLES.extend(_golay())
    upper, patterns, many = _TABLES
    syndrome = (words & 2047) ^ upper[words >> 11]
    return (words[:, None] ^ patterns[syndrome]) >> 11, many[syndrome]


def fuzzy_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) arrays of the keys of 64-bit fingerprints."""
    values, near, at = prints.astype(np.uint64), [], 0
    for width in WIDTHS:
        near.append(decode((values >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64)))
        at += width
    rows, keys, every = [], [], np.arange(len(values))
    for pair, (i, j) in enumerate(combinations(range(3), 2)):
        (a, na), (b, nb) = near[i], near[j]
        for r in range(6):
            for left, right, has in ((a[:, 0], b[:, r], nb > r), (a[:, r], b[:, 0], (na > r) & (r > 0))):
                rows.append(every[has])
                keys.append((pair << 24 | left << 12 | right)[has])
    return np.concatenate(rows), np.concatenate(keys)


def _forest(prints: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect whatever is linked within a run: one per component that a print joins."""
    label = np.arange(len(prints))
    for i in range(1, len(prints)):
        near = np.flatnonzero(np.bitwise_count(prints[:i] ^ prints[i]) <= max_bits)
        if near.size:
            roots, first = np.unique(label[near], return_index=True)
            yield np.full(len(roots), prints[i]), prints[near[first]]
            label[i] = roots[0]
            if len(roots) > 1:
                label[:i][np.isin(label[:i], roots[1:])] = roots[0]


def run_links(buckets: np.ndarray, prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links within runs of equal bucket (sorted); long runs give a spanning forest only."""
    edges = np.flatnonzero(np.diff(buckets)) + 1
    starts = np.concatenate([[0], edges])
    sizes = np.diff(np.concatenate([starts, [len(buckets)]]))
    left, right = [], []
    size = np.repeat(sizes, sizes)
    short = (size > 1) & (size <= SHORT)
    some, values = buckets[short], prints[short]
    for d in range(1, SHORT):
        near = np.flatnonzero(some[d:] == some[:-d]) if len(some) > d else []
        if not len(near):
            break
        near = near[np.bitwise_count(values[near] ^ values[near + d]) <= max_bits]
        left.append(values[near])
        right.append(values[near + d])
    for start, n in zip(starts[sizes > SHORT], sizes[sizes > SHORT]):
        for x, y in _forest(prints[start : start + n], max_bits):
            left.append(x)
            right.append(y)
    none = np.zeros(0, dtype=np.uint64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _links(batches: Iterable[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, fp) sorted by bucket; a run that crosses batches is carried over (at most two blocks)."""
    buckets, prints = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)

    def out(n: int) -> pa.RecordBatch:
        a, b = run_links(buckets[:n], prints[:n], max_bits)
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1).astype(np.uint64).view(np.int64)
        return pa.record_batch({"a": pa.array(pairs[0]), "b": pa.array(pairs[1])})

    for batch in batches:
        buckets = np.concatenate([buckets, batch.column(0).to_numpy()])
        prints = np.concatenate([prints, batch.column(1).to_numpy().view(np.uint64)])
        if len(buckets) and (keep := int(np.searchsorted(buckets, buckets[-1]))):
            yield out(keep)
            buckets, prints = buckets[keep:], prints[keep:]
    if len(buckets):
        yield out(len(buckets))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed long.  Null text counts as empty: fingerprint 0."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.array([fingerprint(t, shingle) for t in utf8(batch.column(1))], dtype=np.uint64)
        return pa.record_batch([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        by_batch(run), f"doc_id {kind}, fp bigint")


def links(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links (a, b) between distinct fingerprints `fp`: every component of the links up to `max_bits` is connected.

    Two different fingerprints in a dense group may be linked through others instead of directly, so a
    group of n never gives n*n rows.  Keys with more than BLOCK fingerprints are cut by hash into blocks;
    every pair of blocks is one group.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("three Golay segments find up to 3 differing bits")

    def explode(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = batch.column(0).to_numpy()
        rows, keys = fuzzy_keys(values.view(np.uint64))
        return pa.record_batch({"key": pa.array(keys), "fp": pa.array(values[rows])})

    distinct = stage(prints.select("fp").where("fp is not null").distinct())
    keys = distinct.mapInArrow(by_batch(explode), "key bigint, fp bigint")
    large = stage(keys.groupBy("key").count().where(F.col("count") > BLOCK)
                  .select("key", F.ceil(F.col("count") / BLOCK).cast("bigint").alias("blocks")))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    pairs = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1),
                        lambda j: F.shiftleft(F.least(own, j), 18) + F.greatest(own, j))
    whole = F.array(F.lit(0).cast("bigint"))
    cut = keys.join(large, "key", "left").select("key", "fp", F.explode(F.when(F.col("blocks").isNull(), whole).otherwise(pairs)).alias("pair"))
    cut = cut.select((F.shiftleft("key", 36) + F.col("pair")).alias("bucket"), "fp")
    sorted_runs = cut.repartition("bucket").sortWithinPartitions("bucket")
    return sorted_runs.mapInArrow(lambda batches: _links(batches, max_bits), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id): the smallest id reachable over links up to `max_bits`.

    One row per input row, repeated rows included.  Null and empty texts have fingerprint 0 and link like
    any other.  A null id takes part but is never a component id, unless a group has no other (then null).
    Other columns of `docs` are ignored; an empty table gives no rows.
    """
    prints = staged_in_python(fingerprints(docs, doc_id, text, shingle))
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    groups = components(links(prints, max_bits))
    named = first.join(groups, first.fp == groups.node, "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    named = stage(named)
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = named.join(least, "component").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, text: str = "text", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """`docs` with one row kept of every group, the one read first; all columns stay, whatever their names.

    Null and empty texts are one group; of repeated rows one stays; an empty table gives no rows.
    """
    placed, place = with_place(docs)
    kept = near_duplicates(placed, place, text, shingle, max_bits).where("doc_id = component_id")
    return rows_at(placed, kept.select("doc_id"), place).select(*[f"`{c}`" for c in docs.columns])
