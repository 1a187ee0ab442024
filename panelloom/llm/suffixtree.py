"""Language-model scoring with a probabilistic suffix tree over words.

Counts of all training words are gathered with Spark.  The tree predicts symbols: every word with at least
`least` training tokens is one, all other words of one final byte are one, and so is the end of a text.  A
context is a sequence of up to `depth` symbols.  It is a candidate if training holds it `least` times, and it is
retained if its next symbols diverge from those of its longest retained suffix: the sum of n * log2(p / p_suffix)
over them reaches `bits`.  Distributions are smoothed towards those of that suffix, by the share of distinct among
all next symbols.  A position is scored in its longest retained context; a word inside a symbol of many words then
costs its share of that symbol.

`least` is a fixed count, so symbols and contexts grow with the corpus in proportion; None stands for the square
root of the number of training tokens.  No task and no driver holds the words or the tree.  Texts are stored as
numbers into the vocabulary of their chunk (a bounded run of texts).  Every chunk deals its words out over buckets,
which add up what all chunks sent, number the words and answer each chunk.  Then, a level at a time, every chunk counts
its runs of a context and a next symbol, and deals them out over buckets by their context; those of a very frequent
context go to several buckets.  A bucket adds up, tests its contexts and answers each chunk.  Words are told apart by
their bytes, runs by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.llm.common import slices
from panelloom.sources.sinks import stage, unstage

DEPTH = 3
LEAST = 2  # what training holds once is no evidence
BITS = 200.0
CHUNK = 1_500_000  # tokens after which a chunk ends
CHUNK_BYTES = 64 << 20  # bytes of words after which it ends too
SPLIT = 500_000  # occurrences for every bucket over which a context is dealt out
WORD_BITS = 31  # of a word's place in its chunk; with the chunk's number above it, that numbers a word
CLASSES = 257  # keys of symbols: 0 is the end of a text, 1-256 are rare words by final byte, numbers from here on are frequent words


def pack(values: np.ndarray) -> bytes:
    """An array of numbers, compressed byte plane by byte plane."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)
    used = values.itemsize
    if values.dtype.kind in "iu" and len(values) and values.min() >= 0:
        used = max(1, -(-int(values.max()).bit_length() // 8))
    return used.to_bytes(1, "little") + len(values).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(planes[:, :used].T.tobytes(), asbytes=True)


def unpack(packed: bytes, kind: str) -> np.ndarray:
    used, n = packed[0], int.from_bytes(packed[1:9], "little")
    values = np.zeros((n, np.dtype(kind).itemsize), dtype=np.uint8)
    values[:, :used] = np.frombuffer(pa.Codec("zstd").decompress(packed[9:], used * n), dtype=np.uint8).reshape(used, n).T
    return values.view(kind).ravel()


def unique(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct numbers of 64 bits, the first place of each, and for every place which one it holds.

    The upper bits are sorted with the place in the lower ones; keys that only the bits left out tell apart are sorted in full.
    """
    if not len(keys):
        return np.unique(keys, return_index=True, return_inverse=True)
    low, top = len(keys).bit_length(), max(1, int(keys.max()).bit_length())
    whole = top + low <= 64
    tagged = keys.astype(np.uint64)
    tagged <<= np.uint64(low if whole else 64 - top)
    if not whole:
        tagged >>= np.uint64(low)
        tagged <<= np.uint64(low)
    tagged |= np.arange(len(keys), dtype=np.uint64)
    tagged.sort()
    at = (tagged & np.uint64((1 << low) - 1)).view(np.int64)
    tagged >>= np.uint64(low)
    values = tagged.astype(keys.dtype) if whole else keys[at]
    fresh = np.append(True, values[1:] != values[:-1])
    if not whole and (fresh[1:] & (tagged[1:] == tagged[:-1])).any():
        return np.unique(keys, return_index=True, return_inverse=True)
    place = np.empty(len(keys), dtype=np.int32)
    place[at] = np.cumsum(fresh, dtype=np.int32) - np.int32(1)
    return values[fresh], at[fresh], place


def _bytes(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Strings of bytes that stand one after another."""
    ends = np.append(0, np.cumsum(lengths)).astype("<i8")
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def _parts(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The reverse of `_bytes`."""
    strings = strings.cast(pa.large_binary())
    ends = np.frombuffer(strings.buffers()[1], dtype="<i8")[strings.offset : strings.offset + len(strings) + 1]
    data = strings.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]] if data and data.size else np.zeros(0, dtype=np.uint8)), np.diff(ends)


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of texts one after another, and how many each text has."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, ends = split.flatten(), split.offsets.to_numpy()
    full = pc.not_equal(pc.binary_length(words), 0)  # white space at an end of a text gives an empty one
    before = np.append(0, np.cumsum(full.to_numpy(zero_copy_only=False)))
    return words.filter(full), np.diff(before[ends - ends[0]])


def _one(values: pa.Array) -> pa.Array:
    """A column of a single row that holds all the values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every chunk: its texts as numbers of its words, and those words with their training counts."""
    part, number = TaskContext.get().partitionId(), 0
    held: list[tuple[pa.Array, pa.Array, pa.Array, np.ndarray]] = []
    tokens = size = 0

    def chunk() -> pa.RecordBatch:
        ids, out, words, n = zip(*held)
        out, n, coded = pa.concat_arrays(out), np.concatenate(n), pa.concat_arrays(words).dictionary_encode()
        codes, train = coded.indices.to_numpy(), ~pc.fill_null(out, False).to_numpy(zero_copy_only=False)
        learned = np.bincount(codes[np.repeat(train, n)], minlength=len(coded.dictionary))
        data, lengths = _parts(coded.dictionary)
        return pa.record_batch({
            "chunk": pa.array([part << 12 | number], pa.int64()), "doc_id": _one(pa.concat_arrays(ids)), "held_out": _one(out), "n_words": _one(pa.array(n, pa.int64())),
            "ids": pa.array([pack(codes)], pa.binary()), "words": pa.array([pack(data)], pa.binary()), "lengths": pa.array([pack(lengths)], pa.binary()),
            "n": pa.array([pack(learned)], pa.binary()), "ends": pa.array([train.sum()], pa.int64()), "taught": pa.array([learned.sum()], pa.int64())})

    for batch in batches:
        for own in slices(batch) if batch.num_rows else ():
            words, n = _words(own.column(2))
            held.append((own.column(0), own.column(1), words, n))
            tokens, size = tokens + len(words) + len(n), size + words.nbytes
            if tokens >= CHUNK or size >= CHUNK_BYTES:
                yield chunk()
                held.clear()
                tokens, size, number = 0, 0, number + 1
    if held:
        yield chunk()
    pa.default_memory_pool().release_unused()


def _dealt(batches: Iterable[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The words of every chunk by bucket, with their places in the chunk and their training counts."""
    for batch in batches:
        for k in range(batch.num_rows):
            data, lengths, n = (unpack(batch.column(c)[k].as_py(), kind) for c, kind in (("words", "u1"), ("lengths", "<i8"), ("n", "<i8")))
            if not len(lengths):
                continue
            starts = np.cumsum(lengths) - lengths
            place = np.arange(len(data)) - np.repeat(starts, lengths)
            powers = np.multiply.accumulate(np.full(int(lengths.max()), 0x9E3779B97F4A7C15, dtype=np.uint64))
            # Words are dealt out by a hash and told apart by their bytes.
            to = _mixed(np.add.reduceat((data + np.uint64(1)) * powers[place], starts), lengths.astype(np.uint64)) % np.uint64(buckets)
            order = np.argsort(to.astype(np.uint16) if buckets < 1 << 16 else to, kind="stable")
            data, lengths = _parts(_bytes(data, lengths).take(pa.array(order)))
            ends, keys = np.append(0, np.cumsum(lengths)), np.unique(to)
            cuts = np.append(np.searchsorted(to[order], keys), len(order)).tolist()
            rows = [(pack(data[ends[a] : ends[b]]), pack(lengths[a:b]), pack(np.diff(order[a:b], prepend=0)), pack(n[order[a:b]])) for a, b in zip(cuts, cuts[1:])]
            yield pa.record_batch({"chunk": pa.array([batch.column("chunk")[k].as_py()] * len(rows), pa.int64()), "bucket": pa.array(keys.astype(np.int64)),
                                   **{c: pa.array(x, pa.binary()) for c, x in zip(("words", "lengths", "ids", "n"), zip(*rows))}})
            pa.default_memory_pool().release_unused()


def _numbered(group: pa.Table, least: float) -> pa.Table:
    """A bucket of words: for every chunk the training counts of its words over all chunks and their symbols; training tokens and distinct words
    of every rare symbol, and in class 0 those of all frequent words."""
    group = group.sort_by("chunk")
    chunks = group.column("chunk").to_numpy()
    data, lengths, ids, n = ([unpack(x, kind) for x in group.column(c).to_pylist()] for c, kind in (("words", "u1"), ("lengths", "<i8"), ("ids", "<i8"), ("n", "<i8")))
    cuts = np.cumsum([len(x) for x in lengths])[:-1]
    data, lengths = np.concatenate(data), np.concatenate(lengths)
    place = _bytes(data, lengths).dictionary_encode().indices.to_numpy()  # numbered as they come
    c = np.bincount(place, weights=np.concatenate(n)).astype(np.int64)
    first = np.flatnonzero(np.diff(np.maximum.accumulate(place), prepend=-1))
    key = np.concatenate([np.cumsum(x) + (chunk << WORD_BITS) for x, chunk in zip(ids, chunks)])[first]  # of the first chunk that has the word
    symbol = np.where(c >= least, key + CLASSES, data[np.cumsum(lengths)[first] - 1].astype(np.int64) + 1)
    of_class = np.where(symbol < CLASSES, symbol, 0)[c > 0]
    tokens, words = np.bincount(of_class, weights=c[c > 0], minlength=CLASSES).astype(np.int64), np.bincount(of_class, minlength=CLASSES)
    classes = np.flatnonzero(words)

    def filled(rows: list[bytes]) -> pa.Array:
        return pa.array(rows + [None] * len(classes), pa.binary())

    none = [None] * len(chunks)
    return pa.table({
        "chunk": pa.array([*chunks.tolist(), *[None] * len(classes)], pa.int64()), "ids": filled(group.column("ids").to_pylist()),
        "c": filled([pack(x) for x in np.split(c[place], cuts)]), "symbol": filled([pack(x) for x in np.split(symbol[place], cuts)]),
        "class": pa.array([*none, *classes.tolist()], pa.int64()), "tokens": pa.array([*none, *tokens[classes].tolist()], pa.int64()),
        "words": pa.array([*none, *words[classes].tolist()], pa.int64())})


def _mixed(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Hash of a context followed by a symbol, from theirs."""
    x = context * np.uint64(0x9E3779B97F4A7C15) + symbol
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Runs:
    """Positions of the texts of a chunk, and level by level their runs: a context of so many symbols and the next one.

    `total`, `kinds` and `size` are those of the root: training tokens, symbols among them, all symbols.  A context
    goes to one more of the `buckets` for every `most` occurrences.
    """

    def __init__(self, codes: np.ndarray, lengths: np.ndarray, train: np.ndarray, keys: np.ndarray, counts: np.ndarray,
                 total: int, kinds: int, size: int, least: float, buckets: int, most: int):
        self.codes, self.lengths, self.keys, self.least, self.buckets, self.most, self.level = codes, lengths, keys.view(np.uint64), least, buckets, most, 0
        self.place = np.arange(len(codes), dtype=np.int32) - np.repeat((np.cumsum(lengths) - lengths).astype(np.int32), lengths)
        self.train = np.repeat(train, lengths)
        root = (counts + kinds / size) / (total + kinds) if total else np.full(len(keys), 1 / size)
        self.value = root[codes]  # of every position: probability in the longest retained context up to this level
        self.inside = np.append(self.place[1:] > 0, False)  # of every position: whether its text goes on
        self.at, self.inverse = np.arange(len(codes)), codes  # the positions of this level, and the run that ends at each
        self.contexts, self.often = _mixed(np.zeros_like(self.keys), self.keys), counts  # per run: hash, count

    def next_level(self) -> None:
        """Number the runs with a context that is one symbol longer than before, by bucket and context.

        The suffix of a run is no rarer than the run, so their positions are among those that follow positions of the level before.
        """
        self.level += 1
        able = self.inside[self.at] & (self.often >= self.least)[self.inverse]
        self.at, before = self.at[able] + 1, self.inverse[able]
        codes = self.codes[self.at]
        found, leader, inverse = unique(before.astype(np.int64) * len(self.keys) + codes)
        context = (found // max(1, len(self.keys))).astype(np.int32)
        symbol = (found - context * np.int64(len(self.keys))).astype(np.int32)
        first = np.flatnonzero(np.append(True, context[1:] != context[:-1])) if len(leader) else np.zeros(0, dtype=np.int64)
        times = np.diff(np.append(first, len(leader)))
        own, parts = self.contexts[context[first]], np.ceil(self.often[context[first]] / self.most).astype(np.uint64)
        to, dealt = np.repeat(own % np.uint64(self.buckets), times), parts > 1
        if dealt.any():
            at, own, parts_of = (np.repeat(x, times[dealt]) for x in (first[dealt] - np.cumsum(times[dealt]) + times[dealt], own[dealt], parts[dealt]))
            at += np.arange(len(at))
            to[at] = (own + _mixed(own, self.keys[symbol[at]]) % parts_of) % np.uint64(self.buckets)
        order = np.argsort(to.astype(np.uint16) if self.buckets < 1 << 16 else to, kind="stable")
        rank = np.empty(len(order), dtype=np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        self.inverse, self.to, context, self.symbol = rank[inverse], to[order], context[order], self.keys[symbol[order]]
        self.first = np.flatnonzero(np.append(True, (context[1:] != context[:-1]) | (self.to[1:] != self.to[:-1]))) if len(order) else first
        self.times = np.diff(np.append(self.first, len(order)))
        self.cells, self.split = self.contexts[context[self.first]], np.repeat(dealt, times)[order[self.first]]  # a cell: runs of a context that go to one bucket
        self.below = self.value[self.at][leader[order]]  # probability of the next symbol in the longest retained suffix, the same wherever a run stands

    def sent(self) -> dict[str, list]:
        """Columns of a row for every bucket: its contexts with the bits that their next symbols cost in the suffix, and their runs."""
        n = np.bincount(self.inverse, weights=self.train[self.at], minlength=len(self.symbol)).astype(np.int64)
        cost = np.add.reduceat(n * np.log2(self.below), self.first).astype(np.float32) if len(n) else np.zeros(0, dtype=np.float32)
        at = np.flatnonzero(np.append(True, self.to[1:] != self.to[:-1])) if len(self.to) else np.zeros(0, dtype=np.int64)
        buckets, runs, cells = self.to[at].astype(np.int64), np.append(at, len(self.to)).tolist(), np.append(np.searchsorted(self.first, at), len(self.first)).tolist()
        parts = {"contexts": (self.cells, cells), "times": (self.times, cells), "split": (self.split, cells), "cost": (cost, cells), "symbols": (self.symbol, runs), "n": (n, runs)}
        return {"bucket": buckets.tolist(), **{c: [pack(values[a:b]) for a, b in zip(cuts, cuts[1:])] for c, (values, cuts) in parts.items()}}

    def received(self, answers: dict[int, tuple[bytes, bytes, bytes]], split: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        """Take the counts of all chunks, and totals and distinct next symbols of the retained contexts.

        Those of contexts that are split over buckets are in `split`: sorted hashes, totals, next symbols.
        """
        buckets = self.to[np.append(True, self.to[1:] != self.to[:-1])].tolist() if len(self.to) else []
        often, total, kinds = (np.concatenate([unpack(answers[k][i], "<i8") for k in buckets] or [np.zeros(0, dtype=np.int64)]) for i in range(3))
        if len(split[0]):
            at = np.minimum(np.searchsorted(split[0], self.cells), len(split[0]) - 1)
            found = self.split & (split[0][at] == self.cells)
            total, kinds = np.where(found, split[1][at], total), np.where(found, split[2][at], kinds)
        total, kinds = np.repeat(total, self.times), np.repeat(kinds, self.times)
        value = np.where(total > 0, (often + kinds * self.below) / np.maximum(total + kinds, 1), self.below)
        self.value[self.at] = value[self.inverse]
        self.contexts, self.often = _mixed(np.repeat(self.cells, self.times), self.symbol), often

    def scores(self) -> np.ndarray:
        """log10 probability of every text: of all its symbols after the first."""
        logs = np.where(self.place > 0, np.log10(self.value), 0.0)
        return np.add.reduceat(logs, np.cumsum(self.lengths) - self.lengths) if len(self.lengths) else np.zeros(0)


PARTS = ("contexts", "times", "split", "cost", "symbols", "n")
SENT = "chunk bigint, bucket bigint, " + ", ".join(f"{c} binary" for c in PARTS)
COUNTED = "chunk bigint, bucket bigint, counts binary, totals binary, kinds_of binary, context bigint, total bigint, kinds bigint, bits double"


def _counted(group: pa.Table, bits: float) -> pa.Table:
    """A bucket: for every chunk the counts of its runs over all chunks and the sums of its retained contexts; sums of contexts that are split."""
    own = {c: [unpack(x, kind) for x in group.column(c).to_pylist()] for c, kind in zip(PARTS, ("<u8", "<i8", "?", "<f4", "<u8", "<i8"))}
    cells, runs = (np.cumsum([len(x) for x in own[c]])[:-1] for c in ("contexts", "n"))
    own = {c: np.concatenate(x) for c, x in own.items()}
    contexts, cell, of_cell = unique(own["contexts"])
    every, first, place = unique(_mixed(np.repeat(own["contexts"], own["times"]), own["symbols"]))
    n = np.bincount(place, weights=own["n"], minlength=len(every)).astype(np.int64)
    at, seen = np.repeat(of_cell, own["times"])[first], n > 0
    at, known = at[seen], n[seen]
    total, kinds, told = (np.bincount(at, weights=w, minlength=len(contexts)) for w in (known, np.ones(len(at)), known * np.log2(known)))
    gain, split = told - np.bincount(of_cell, weights=own["cost"], minlength=len(contexts)), own["split"][cell]
    kept = ~split & (gain - total * np.log2(np.maximum(total, 1)) >= bits)

    def back(values: np.ndarray, cuts: np.ndarray) -> list[bytes]:
        return [pack(x.astype(np.int64)) for x in np.split(values, cuts)]

    a, b = group.num_rows, int(split.sum())

    def filled(kind: pa.DataType, *own) -> pa.Array:
        """A column of the two kinds of rows; a kind without it has nulls."""
        return pa.concat_arrays([pa.nulls(x, kind) if isinstance(x, int) else pa.array(x, kind) for x in own])

    return pa.table({
        "chunk": filled(pa.int64(), group.column("chunk").to_pylist(), b), "bucket": filled(pa.int64(), group.column("bucket").to_pylist(), b),
        "counts": filled(pa.binary(), back(n[place], runs), b), "totals": filled(pa.binary(), back((total * kept)[of_cell], cells), b),
        "kinds_of": filled(pa.binary(), back((kinds * kept)[of_cell], cells), b), "context": filled(pa.int64(), a, contexts[split].view(np.int64)),
        "total": filled(pa.int64(), a, total[split].astype(np.int64)), "kinds": filled(pa.int64(), a, kinds[split].astype(np.int64)),
        "bits": filled(pa.float64(), a, gain[split])})


def score_documents(docs: DataFrame, held_out: Column, *, doc_id: str = "doc_id", text: str = "text", least: float | None = LEAST,
                    depth: int = DEPTH, bits: float = BITS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every whole text.

    Words are runs of bytes other than ASCII white space, ASCII-lower-cased; the end of a text is one more
    token.  Rows with `held_out` are scored only, all others are learned from.  A null text counts as
    empty: its only token is the end.  Repeated rows are learned from and returned as often as they stand
    there; other columns are ignored; an empty table gives no rows.  Without any training text the scores
    are those of a uniform model.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), F.col(text).cast("string").alias("text"))
    both = stage(rows.mapInArrow(_chunks, (
        f"chunk bigint, doc_id array<{kind}>, held_out array<boolean>, n_words array<bigint>, ids binary, words binary, lengths binary, n binary, ends bigint, taught bigint")))
    all_of = both.agg(F.count("*").alias("chunks"), F.sum("ends").alias("ends"), F.sum("taught").alias("taught")).first()
    ends, buckets = all_of.ends or 0, max(1, all_of.chunks)
    total = ends + (all_of.taught or 0)
    least = max(1.0, total**0.5 if least is None else least)

    dealt = both.select("chunk", "words", "lengths", "n").mapInArrow(
        lambda batches: _dealt(batches, buckets), "chunk bigint, bucket bigint, words binary, lengths binary, ids binary, n binary")
    words = stage(dealt.groupBy("bucket").applyInArrow(
        lambda group: _numbered(group, least), "chunk bigint, ids binary, c binary, symbol binary, class bigint, tokens bigint, words bigint"))
    rare = words.where("class is not null").groupBy("class").agg(F.sum("tokens").alias("c"), F.sum("words").alias("v")).collect()
    frequent, rare = sum(r.v for r in rare if not r["class"]), [r for r in rare if r["class"]]
    distinct = frequent + sum(r.v for r in rare) + (1 if ends else 0)
    kinds, size = frequent + len(rare) + (1 if ends else 0), frequent + CLASSES
    inside = np.zeros((CLASSES, 2))  # per rare symbol: training tokens and distinct words; one more slot is for the unknown
    for r in rare:
        inside[r["class"]] = r.c, r.v
    base = np.log10(total + 0.5 * (distinct + 1))

    def encode(key, left: pa.Table, right: pa.Table) -> pa.Table:
        """All texts of a chunk as one row of symbols, with what the counts of its words give."""
        ids, n = unpack(left.column("ids")[0].as_py(), "<i4"), left.column("n_words").combine_chunks().flatten().to_numpy()
        counts, words_of = np.zeros(ids.max() + 1 if len(ids) else 0), np.zeros(ids.max() + 1 if len(ids) else 0, dtype=np.int64)
        for own in zip(*(right.column(c).to_pylist() for c in ("ids", "c", "symbol"))):
            at, counts_at, symbols = (unpack(x, "<i8") for x in own)
            at = np.cumsum(at)
            counts[at], words_of[at] = counts_at, symbols
        rest = words_of < CLASSES
        of_class = inside[np.where(rest, words_of, 0)]
        logs = np.log10(counts + 0.5) - base
        part = np.where(rest, np.log10(counts + 0.5) - np.log10(of_class[:, 0] + 0.5 * (of_class[:, 1] + 1)), 0.0)
        keys, first, code = unique(words_of)
        often = np.where(rest, of_class[:, 0], counts)[first]
        of_text = np.repeat(np.arange(len(n)), n)

        def summed(values: np.ndarray) -> np.ndarray:
            return np.bincount(of_text, weights=values[ids], minlength=len(n)).astype(np.float64)  # without any word it counts in integers

        known, scores, parts = summed(counts > 0).astype(np.int64) + (1 if ends else 0), summed(logs) + (np.log10(ends + 0.5) - base), summed(part)
        codes = np.zeros(len(ids) + 2 * len(n), dtype="<i4")
        codes[np.arange(len(ids)) + 2 * of_text + 1] = code[ids] + 1
        order = np.append(0, 1 + np.argsort(-np.bincount(codes, minlength=len(keys) + 1)[1:], kind="stable"))  # frequent symbols get small codes
        renamed = np.empty(len(order), dtype="<i4")
        renamed[order] = np.arange(len(order))

        return pa.table({
            "chunk": pa.array([key[0].as_py()], pa.int64()), "doc_id": left.column("doc_id"), "held_out": left.column("held_out"),
            "n_tokens": _one(pa.array(n + 1, pa.int64())), "n_known": _one(pa.array(known)), "base_score": _one(pa.array(scores)),
            "inside": _one(pa.array(parts)), "codes": pa.array([pack(renamed[codes])], pa.binary()),
            "keys": pa.array([pack(np.append(0, keys)[order].astype("<i8"))], pa.binary()),
            "counts": pa.array([pack(np.append(ends, often)[order].astype("<f8"))], pa.binary())})

    per_text = {"doc_id": kind, "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "base_score": "double", "inside": "double"}
    texts, words_of_chunks = both.select("chunk", "doc_id", "held_out", "n_words", "ids"), words.where("chunk is not null").select("chunk", "ids", "c", "symbol")
    coded = stage(texts.groupBy("chunk").cogroup(words_of_chunks.groupBy("chunk")).applyInArrow(
        encode, "chunk bigint, " + ", ".join(f"{c} array<{t}>" for c, t in per_text.items()) + ", codes binary, keys binary, counts binary"))
    unstage(both)
    unstage(words)
    most = SPLIT

    def runs(chunk: pa.Table | pa.RecordBatch, at: int = 0) -> Runs:
        own = {c: chunk.column(c)[at].as_py() for c in ("codes", "keys", "counts", "n_tokens", "held_out")}
        return Runs(unpack(own["codes"], "<i4"), np.array(own["n_tokens"], dtype=np.int64) + 1, ~np.array(own["held_out"], dtype=bool),
                    unpack(own["keys"], "<i8"), unpack(own["counts"], "<f8"), total, kinds, size, least, buckets, most)

    def sent(chunk: int, own: Runs) -> pa.RecordBatch:
        own.next_level()
        rows = own.sent()
        return pa.record_batch({"chunk": pa.array([chunk] * len(rows["bucket"]), pa.int64()), "bucket": pa.array(rows["bucket"], pa.int64()),
                                **{c: pa.array(rows[c], pa.binary()) for c in PARTS}})

    def first_level(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield sent(batch.column("chunk")[k].as_py(), runs(batch, k))
                pa.default_memory_pool().release_unused()

    def answered(chunk: pa.Table, answers: pa.Table) -> Runs:
        """Runs of a chunk with all levels that have answers taken in."""
        own, levels = runs(chunk), answers.column("level").to_numpy()
        for level in range(1, levels.max() + 1 if len(levels) else 1):
            part = answers.filter(pa.array(levels == level))
            own.next_level()
            own.received(dict(zip(part.column("bucket").to_pylist(), zip(*(part.column(c).to_pylist() for c in ("counts", "totals", "kinds_of"))))), split[level - 1])
        return own

    def further_level(key, chunk: pa.Table, answers: pa.Table) -> pa.Table:
        return pa.Table.from_batches([sent(key[0].as_py(), answered(chunk, answers))])

    def scored(key, chunk: pa.Table, answers: pa.Table) -> pa.Table:
        own = {c: chunk.column(c).combine_chunks().flatten() for c in per_text}
        score = pa.array(answered(chunk, answers).scores() + own.pop("inside").to_numpy())
        return pa.table({**own, "train_tokens": pa.array([total] * len(score), pa.int64()), "score": score})

    needed = coded.select("chunk", "n_tokens", "held_out", "codes", "keys", "counts")
    answers, split = None, []  # of every level: the retained among the contexts that are split, of which there are at most total / SPLIT
    for level in range(1, depth + 1):
        own = needed.mapInArrow(first_level, SENT) if answers is None else (
            needed.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(further_level, SENT))
        counted = stage(own.groupBy("bucket").applyInArrow(lambda group: _counted(group, bits), COUNTED))
        found = counted.where("context is not null").groupBy("context").agg(*[F.sum(c).alias(c) for c in ("total", "kinds", "bits")])
        found = found.where((F.col("total") > 0) & (F.col("bits") - F.col("total") * F.log2("total") >= bits)).collect()
        found = np.array([(r.context, r.total, r.kinds) for r in found], dtype=np.int64).reshape(-1, 3)
        found = found[np.argsort(found[:, 0].view(np.uint64))]
        split = [*split, (np.ascontiguousarray(found[:, 0]).view(np.uint64), found[:, 1], found[:, 2])]
        back = counted.where("chunk is not null").select("chunk", "bucket", "counts", "totals", "kinds_of", F.lit(level).alias("level"))
        answers = back if answers is None else answers.unionByName(back)

    return coded.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(scored, (
        f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, train_tokens bigint, score double")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
