"""Packing of documents into sequences: best fit, then swap-based local search.

Only lengths matter.  Pieces are dealt out in groups of bounded size; in each group the longest pieces go
first into the fullest sequence that has room, then pieces move or change places between underfull
sequences as long as the sum of squared fills grows.  That empties the least filled sequences one by one.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelloom.llm.bpe import byte_characters
from panelloom.llm.common import once_per_worker, staged_in_python

GROUP = 40_000  # pieces that are packed together


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest first, each into the fullest bin with room."""
    bins: list[list[int]] = []
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_gaps = 0  # bit g is set where a bin has a gap of g
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[item]
        room = open_gaps >> size
        if room:
            gap = size + (room & -room).bit_length() - 1
            at = by_gap[gap].pop()
            if not by_gap[gap]:
                open_gaps ^= 1 << gap
            bins[at].append(item)
        else:
            gap, at = capacity, len(bins)
            bins.append([item])
        by_gap[gap - size].append(at)
        open_gaps |= 1 << (gap - size)
    return bins


def _sums(give: list[int], sizes: list[int]) -> tuple[int, int]:
    """Lengths of single items, and of one or two items, as sets of bits."""
    count = Counter(sizes[i] for i in give)
    one = 0
    for y in count:
        one |= 1 << y
    both = one
    for y, n in count.items():
        both |= (one if n > 1 else one ^ 1 << y) << y
    return one, both


def _exchange(to: list[int], gap: int, give: list[int], sizes: list[int]) -> tuple[int, list[int], list[int]]:
    """Best growth of `to` by items of `give`: a move, one for one, or two for one; (growth, taken, returned).

    Items of one length are alike, and a bin has few lengths (their sum is at most its capacity).
    """
    one, both = _sums(give, sizes)
    growth, size, back = 0, 0, 0
    for x in sorted({0, *(sizes[i] for i in to)}):
        fitting = ((both if x else one) & (2 << x + gap) - 1).bit_length() - 1
        if fitting - x > growth:
            growth, size, back = fitting - x, fitting, x
    if not growth:
        return 0, [], []
    lengths = [sizes[i] for i in give]
    if one >> size & 1:
        taken = [give[lengths.index(size)]]
    else:
        first = next(k for k, y in enumerate(lengths) if size - y in lengths[k + 1 :])
        taken = [give[first], give[lengths.index(size - lengths[first], first + 1)]]
    return growth, taken, [next(i for i in to if sizes[i] == back)] if back else []


class _Underfull:
    """Underfull bins by a length that they hold (0 for every bin) and by gap."""

    def __init__(self, capacity: int):
        self.gaps = [0] * capacity  # per length: bit g is set where a bin that holds it has a gap of g
        self.bins: dict[tuple[int, int], set[int]] = {}

    def add(self, k: int, lengths: set[int], gap: int) -> None:
        for x in (0, *lengths):
            self.gaps[x] |= 1 << gap
            self.bins.setdefault((x, gap), set()).add(k)

    def remove(self, k: int, lengths: set[int], gap: int) -> None:
        for x in (0, *lengths):
            found = self.bins[x, gap]
            found.remove(k)
            if not found:
                del self.bins[x, gap]
                self.gaps[x] ^= 1 << gap

    def taker(self, one: int, both: int, widest: int) -> int | None:
        """A bin with a gap of `widest` at most that items of these lengths make fuller: full if one can be, else by the largest growth."""
        best, where, within = 0, None, (2 << widest) - 1
        for x, gaps in enumerate(self.gaps):
            if gaps := gaps & within:
                top = gaps.bit_length()
                if growths := (both if x else one) >> x & (1 << top) - 2:
                    if full := growths & gaps:
                        return next(iter(self.bins[x, full.bit_length() - 1]))
                    if growths.bit_length() > best:
                        best, where = growths.bit_length(), (x, top - 1)
        return next(iter(self.bins[where])) if where else None


def local_search(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[int]]:
    """Raise the sum of squared fills by moves and swaps between underfull bins; emptied bins go.

    The least filled bin gives to any that is at least as full, then the next one, over and over until no bin can give;
    the sum grows with every exchange, so that ends.
    """
    bins = [list(b) for b in bins]
    fill = [sum(sizes[i] for i in b) for b in bins]
    index = _Underfull(capacity)

    def entry(k: int) -> tuple[int, set[int], int]:
        return k, {sizes[i] for i in bins[k]}, capacity - fill[k]

    underfull = [k for k in range(len(bins)) if fill[k] < capacity]
    for k in underfull:
        index.add(*entry(k))
    exchanges, kept = 0, {}  # contents that could not give after so many exchanges
    while True:
        before = exchanges
        underfull = sorted((k for k in underfull if 0 < fill[k] < capacity), key=lambda k: (fill[k], k))
        for giver in underfull:
            if fill[giver] == capacity:
                continue
            content = tuple(sorted(sizes[i] for i in bins[giver]))
            if kept.get(content) == exchanges:
                continue
            index.remove(*entry(giver))
            while bins[giver]:
                k = index.taker(*_sums(bins[giver], sizes), capacity - fill[giver])
                if k is None:
                    break
                index.remove(*entry(k))
                growth, taken, returned = _exchange(bins[k], capacity - fill[k], bins[giver], sizes)
                bins[k] = [i for i in bins[k] if i not in returned] + taken
                bins[giver] = [i for i in bins[giver] if i not in taken] + returned
                fill[k] += growth
                fill[giver] -= growth
                exchanges += 1
                if fill[k] < capacity:
                    index.add(*entry(k))
            if bins[giver]:
                index.add(*entry(giver))
                kept[tuple(sorted(sizes[i] for i in bins[giver]))] = exchanges
        if exchanges == before:
            return [b for b in bins if b]


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    return local_search(best_fit(sizes, capacity), sizes, capacity)


def ranks_of(definition: str) -> dict[bytes, int] | None:
    """Tokens with their ranks, if a tokenizer file is plain byte-level BPE whose merges make its ids in order.

    Then the pair that a merge list takes first is the pair whose token has the smallest id, so that an
    encoder by ranks gives the ids that the file defines.  None for any other file.
    """
    own = json.loads(definition)
    model, split = own["model"], own.get("pre_tokenizer") or {}
    plain = model.get("type", "BPE") == "BPE" and not any(model.get(k) for k in (
        "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    split_plain = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
    if not plain or not split_plain or own.get("normalizer"):
        return None
    vocabulary = model["vocab"]
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    if any(vocabulary.get(a + b) != len(byte_of) + i for i, (a, b) in enumerate(merges)):
        return None
    tokens = [*byte_of, *(a + b for a, b in merges)]
    return {bytes(byte_of[c] for c in t): vocabulary[t] for t in tokens}


class Encoder:
    """Ids of whole texts by a tokenizer file, as little-endian 32-bit integers; special tokens are ordinary text.

    Where the file allows it, the ids come from an encoder by ranks, which takes a fraction of the time.
    """

    def __init__(self, definition: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.ranks, self.tokenizer = ranks_of(definition), None
        if self.ranks:
            self.by_ranks = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
        else:
            self.tokenizer = Tokenizer.from_str(definition)
            self.tokenizer.encode_special_tokens = True

    def __call__(self, texts: list[str]) -> list[bytes]:
        if self.tokenizer is None:
            found = map(self.by_ranks.encode_ordinary, texts)
        else:
            found = (e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False))
        return [np.array(ids, dtype="<u4").tobytes() for ids in found]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: all but the first are as long as a sequence."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)] if n else []


def pieces(docs: DataFrame, tokenizer: str, pattern: str, *, capacity: int, end_id: int, doc_id: str = "doc_id", text: str = "text", step: int = 256) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every text's ids and one `end_id`, cut where they are too long."""
    with open(tokenizer, encoding="utf-8") as f:
        definition = f.read()
    key, shared = hashlib.sha256(definition.encode()).hexdigest(), docs.sparkSession.sparkContext.broadcast(definition)
    kind = docs.schema[doc_id].dataType.simpleString()
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = once_per_worker(key, lambda: Encoder(shared.value, pattern))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                rows = [(k, n, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]))
                        for k, ids in enumerate(x + end for x in own([x or "" for x in part.column(1).to_pylist()]))
                        for n, (start, length) in enumerate(cut(len(ids) // 4, capacity))]
                k, n, start, length, crc = zip(*rows)
                yield pa.record_batch([part.column(0).take(pa.array(k)), pa.array(n, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                                       pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack_documents(docs: DataFrame, tokenizer: str, pattern: str, *, capacity: int = 1024, end_id: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece with the sequence that holds it and its offset there.

    `tokenizer` is the path of a tokenizer file, `pattern` the pre-token pattern of byte-level files.
    Null and empty texts are one piece with the end id alone.  Repeated rows are packed as often as they
    stand there; other columns are ignored; an empty table gives no rows.  Sequences are gapless from 0.
    Full pieces have a sequence of their own.  The others are dealt out evenly over groups of about GROUP
    pieces, whatever their ids, so no id or copy makes a group larger, and each group is packed by itself:
    that costs about one underfull sequence a group.  The local search goes on until no exchange is left.
    """
    cuts = staged_in_python(pieces(docs, tokenizer, pattern, capacity=capacity, end_id=end_id, doc_id=doc_id, text=text))
    full = cuts.where(F.col("length") == capacity).select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    short = cuts.where(F.col("length") < capacity)
    groups = max(1, -(-short.count() // GROUP))
    names = [*cuts.columns, "sequence_id", "offset"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        whole = pa.Table.from_batches(rows).combine_chunks()
        sizes = whole.column("length").to_pylist()
        sequence, offset = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
        base = TaskContext.get().partitionId() << 32
        for k, items in enumerate(pack(sizes, capacity)):
            sequence[items] = base + k
            offset[items] = np.cumsum([0, *[sizes[i] for i in items[:-1]]])
        out = whole.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))
        yield from out.to_batches(max_chunksize=10_000)

    fields = ", ".join(f"`{c}` {full.schema[c].dataType.simpleString()}" for c in names)
    return short.repartition(groups).mapInArrow(run, fields).unionByName(full)
