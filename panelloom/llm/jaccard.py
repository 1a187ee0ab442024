"""Grouped prefix join: documents whose sets of word n-grams have a Jaccard similarity of at least a threshold.

Texts with the same set are one class from the start.  All sets are ordered alike; two similar sets then share one of
the first few n-grams of either (the prefix).  Classes with the same prefix and size are one group, and only groups
stand in the lists of documents per n-gram.  Pairs of groups of a list are filtered by their sizes, by the places of the
n-gram, and by parity bits of their sets, which bound how much they differ.  What passes is expanded into members, which
are verified on their whole sets.

The order is by hash, but n-grams found in many prefixes come last, the most frequent at the end: a passage that many
documents share leaves their prefixes.  The order decides how much work there is, not what is found.

Members of a dense group of near-copies are not verified pair by pair: a first round verifies for every entry of a list
those before and after it whose parity bits differ least.  In the second round every member of a group stands in its lists,
and all pairs are verified that pass the filters and that links of the first round do not connect.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm.common import by_slice, rows_at, staged_in_python, utf8
from panelloom.llm.components import components
from panelloom.sources.sinks import stage

WORDS = 4  # 64-bit words of parity bits in a list
FREQUENT = 64  # prefixes that an n-gram is in before it counts as frequent
MOST_FREQUENT = 1 << 18  # bound of the n-grams that one round finds frequent: a larger corpus raises the number above
ROUNDS = 2  # of looking for frequent n-grams
BLOCK = 2048  # groups of one list that are compared in one part; longer lists are cut into pairs of blocks
PIECE = 1 << 20  # bytes whose hashes are held at once

SPACES = bytes(b in b" \t\n\x0b\x0c\r" for b in range(256))


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers stirred (a bijection)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


NEAR = mixed(mixed(np.arange(1 << 14, dtype=np.uint64) + np.uint64(1)))  # numbers for (place below 64 in a word, byte)


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the ASCII-lower-cased words of all texts, and the number of words before each text and in all.

    A hash is the sum of one number for each byte and its place in the word.
    """
    whole = b"\n".join([*texts, b""]).lower()
    space = np.frombuffer(whole.translate(SPACES), dtype=np.bool_)
    edges = np.diff(space.astype(np.int8), prepend=1)
    starts = np.flatnonzero(edges == -1)
    lengths = np.flatnonzero(edges == 1) - starts
    codes, hashes = np.frombuffer(whole, dtype=np.uint8), np.empty(len(starts), dtype=np.uint64)
    part = (np.cumsum(lengths) - lengths) // PIECE
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(starts)]
    for a, b in zip(cuts, cuts[1:]):
        if a == b:
            continue
        size = lengths[a:b]
        first = np.cumsum(size) - size
        place = np.arange(size.sum()) - np.repeat(first, size)
        key = (place << 8) + codes[place + np.repeat(starts[a:b], size)]
        value = NEAR[np.minimum(key, len(NEAR) - 1)]
        far = np.flatnonzero(key >= len(NEAR))
        value[far] = mixed(mixed(key[far].astype(np.uint64) + np.uint64(1)))
        hashes[a:b] = np.add.reduceat(value, first)
    sizes = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return hashes, np.searchsorted(starts, sizes)


def hashed_sets(texts: list[bytes], shingle: int) -> list[np.ndarray]:
    """For every text the distinct n-grams of its words as sorted 64-bit hashes.

    Fewer words than an n-gram has are one n-gram; without words the set is empty.
    """
    words, at = hashed_words(texts)
    odd, grams = np.uint64(0x9E3779B97F4A7C15), mixed(words)
    short = np.diff(at)
    fewer = {}
    for i in range(1, shingle):
        for k in np.flatnonzero(short == i):
            fewer[k] = mixed(grams[at[k] : at[k] + 1] + odd * np.uint64(i))
        grams = mixed(grams[: max(0, len(words) - i)] * odd + words[i:])
    return [fewer[k] if k in fewer else np.unique(grams[a : max(a, b - shingle + 1)]) for k, (a, b) in enumerate(zip(at, at[1:]))]


def prefix(tokens: np.ndarray, percent: int, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first n-grams of a set, so many that every similar set holds one of them; `frequent` (sorted) come last, by their counts."""
    n = len(tokens)
    many = n + (-percent * n // 100) + 1 if n else 0
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        late = np.where(frequent[at] == tokens, counts[at], 0)
        tokens = tokens[np.lexsort((tokens, late))]
    return tokens[:many]


def parity(tokens: np.ndarray, words: int = WORDS) -> np.ndarray:
    """Bit b is the parity of the n-grams that fall on it; sets that differ in d n-grams differ in at most d bits.

    The number of words is a power of two; the two halves of a parity together give that of half as many words.
    """
    odd = np.bincount((mixed(tokens) & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def wide(n: int) -> int:
    """Words of parity bits, at least a bit for two n-grams, that tell large sets apart."""
    return max(WORDS, 1 << max(0, (n - 1) // 128).bit_length())


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])])
    flat = np.concatenate([np.zeros(0, dtype=np.uint64), *arrays])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), _signed(flat))


def summaries(placed: DataFrame, shingle: int, percent: int, late=None) -> DataFrame:
    """(place, n, key, same, prefix, bits, wide) of every row of `placed` (place, text).

    `key` stands for the set, `same` for the prefix.  The order of n-grams is by hash; those of `late` (a broadcast of
    sorted hashes and counts) come last.
    """
    none = np.zeros(0, dtype=np.uint64)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = hashed_sets(utf8(batch.column(1)), shingle)
        first = [prefix(s, percent, *(late.value if late else (none, none))) for s in sets]
        keys, same = (np.array([xxhash.xxh64_intdigest(s.tobytes(), 13) for s in x], dtype=np.uint64) for x in (sets, first))
        return pa.record_batch([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), _signed(keys), _signed(same), _lists(first),
                                _lists([parity(s) for s in sets]), _lists([parity(s, wide(len(s))) for s in sets])],
                               names=["place", "n", "key", "same", "prefix", "bits", "wide"])

    return placed.select("place", "text").mapInArrow(
        by_slice(run), "place bigint, n bigint, key bigint, same bigint, prefix array<bigint>, bits array<bigint>, wide array<bigint>")


def _sets(placed: DataFrame, places: DataFrame, shingle: int) -> DataFrame:
    """(place, tokens) with the whole set of the rows at `places`."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([batch.column(0), _lists(hashed_sets(utf8(batch.column(1)), shingle))], names=["place", "tokens"])

    return rows_at(placed, places).select("place", "text").mapInArrow(by_slice(run), "place bigint, tokens array<bigint>")


CLASS = "place bigint, n bigint, same bigint, prefix array<bigint>, bits array<bigint>"


def _holding(classes: DataFrame, late, holds: bool) -> DataFrame:
    """The classes whose prefix holds an n-gram of `late`, or the others."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat = pc.list_flatten(batch.column(3)).to_numpy().view(np.uint64)
        own = pc.list_parent_indices(batch.column(3)).to_numpy()
        has = np.bincount(own[np.isin(flat, late.value[0])], minlength=batch.num_rows) > 0
        return batch.filter(pa.array(has == holds))

    return classes.mapInArrow(by_slice(run), CLASS)


def ordered_classes(placed: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """`classes` with prefixes by the order that has frequent n-grams last.

    N-grams that take the place of frequent ones may be frequent too, so there are some rounds; what is left after the last
    costs work and loses nothing.  A prefix without an n-gram that was found frequent since stays as it is.
    """
    late: dict[int, int] = {}
    for _ in range(ROUNDS):
        total = classes.agg(F.coalesce(F.sum(F.size("prefix")), F.lit(0))).first()[0]
        least = max(FREQUENT, -(-total // MOST_FREQUENT))
        many = classes.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count("*").alias("c")).where(F.col("c") >= least)
        more = {r.token: r.c for r in many.collect() if r.token not in late}
        if not more:
            break
        late |= more
        tokens = np.array(list(late), dtype=np.int64).view(np.uint64)
        by = np.argsort(tokens)
        shared = placed.sparkSession.sparkContext.broadcast((tokens[by], np.array(list(late.values()), dtype=np.int64)[by]))
        fresh = placed.sparkSession.sparkContext.broadcast((np.sort(np.array(list(more), dtype=np.int64).view(np.uint64)),))
        hit = _holding(classes, fresh, True).select("place")
        moved = staged_in_python(summaries(rows_at(placed, hit), shingle, percent, shared).select("place", "n", "same", "prefix", "bits"))
        classes = stage(_holding(classes, fresh, False).unionByName(moved))
    return classes


def _entries(classes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lists (token, node, pos, span), facts (node, span, n, bits, radius) and members (node, place).

    A list per n-gram holds groups, by the first place of their members; a list per group of several holds its members.  `radius`
    is the largest number of bits in which a member differs from the first; `span` is 1 for groups and 0 for members.
    """
    narrow = classes.select("place", "n", "same")
    groups = narrow.groupBy("n", "same").agg(F.min("place").alias("node"), F.count("*").alias("many")).where("many > 1")
    several = stage(narrow.join(groups, ["n", "same"]).select("place", "node"))
    inner = stage(rows_at(classes.select("place", "n", "bits"), several.select("place")).join(several, "place"))
    apart = F.aggregate(F.zip_with("bits", "own", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, x: s + x)
    radius = inner.join(inner.where("place = node").select("node", F.col("bits").alias("own")), "node").groupBy("node").agg(F.max(apart).alias("radius"))
    heads = rows_at(classes, several.where("place <> node").select("place"), others=True).withColumnRenamed("place", "node")

    lists = heads.select("node", F.posexplode("prefix").alias("pos", "token")).select("token", "node", "pos")
    some = _without_singles(lists)
    within = several.select(F.xxhash64("node").alias("token"), F.col("place").alias("node"), F.lit(0).alias("pos"), F.lit(0).alias("span"))
    facts = heads.select("node", "n", "bits").join(radius, "node", "left").select(
        "node", F.lit(1).alias("span"), "n", "bits", F.coalesce("radius", F.lit(0)).cast("int").alias("radius"))
    facts = facts.unionByName(inner.select(F.col("place").alias("node"), F.lit(0).alias("span"), "n", "bits", F.lit(0).alias("radius")))
    alone = rows_at(classes.select("place"), several.select("place"), others=True).select(F.col("place").alias("node"), "place")
    return stage(some.withColumn("span", F.lit(1)).unionByName(within)), facts, alone.unionByName(several.select("node", "place"))


def _without_singles(lists: DataFrame) -> DataFrame:
    """Rows (token, node, pos) whose token has another row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wait, before = None, None  # the last row so far, and the token of the row before it
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if wait is None else pa.concat_batches([wait, batch])
            token = rows.column(0).to_numpy()
            same = np.concatenate([[token[0] == before if before is not None else False], token[1:] == token[:-1]])
            keep = same[:-1] | same[1:]
            yield rows.slice(0, len(token) - 1).filter(pa.array(keep))
            wait = rows.slice(len(token) - 1)
            before = token[-2] if len(token) > 1 else before
        if wait is not None and before is not None and wait.column(0)[0].as_py() == before:
            yield wait

    return lists.repartition("token").sortWithinPartitions("token").mapInArrow(run, "token bigint, node bigint, pos int")


def passing(entries: dict[str, np.ndarray], run_end: np.ndarray, percent: int, nearest: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of entries of one run, sorted by size in it, that pass the filters and differ in `label`.

    With `nearest` at most two pairs for every entry: with those before it and after it whose parity bits differ least.
    Where links are as near as the bits are, every entry but the first is then connected with one before it.
    """
    n, pos, bits, radius, label = (entries[k] for k in ("n", "pos", "bits", "radius", "label"))
    later, d, left, right = np.arange(len(n)), 0, [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    start = np.zeros(len(n), dtype=np.int64)
    least, partner = np.full((2, len(n)), np.iinfo(np.int64).max), np.full((2, len(n)), -1)
    if len(n):
        head = np.concatenate([[True], run_end[1:] != run_end[:-1]])
        start = np.flatnonzero(head)[np.cumsum(head) - 1]
    while True:
        d += 1
        later = later[later - d >= start[later]]
        later = later[100 * n[later - d] >= percent * n[later]]
        if not len(later):
            break
        a, b = later - d, later
        need = -(-percent * (n[a] + n[b]) // (100 + percent))
        ok = (np.minimum(n[a] - pos[a], n[b] - pos[b]) >= need) & ((label[a] != label[b]) | (label[a] < 0))
        a, b, need = a[ok], b[ok], need[ok]
        differ = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64)
        close = differ - radius[a] - radius[b] <= n[a] + n[b] - 2 * need
        a, b, differ = a[close], b[close], differ[close]
        if not nearest:
            left.append(a)
            right.append(b)
            continue
        for side, own, other in ((0, b, a), (1, a, b)):
            better = differ < least[side, own]
            least[side, own[better]], partner[side, own[better]] = differ[better], other[better]
    for own in partner:
        left.append(np.flatnonzero(own >= 0))
        right.append(own[own >= 0])
    return np.concatenate(left), np.concatenate(right)


def _pairs(entries: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """(a, b): pairs of nodes of any list that pass the filters and differ in `label`.

    `entries` has (token, node, pos, span, n, bits, radius, label).
    """
    large = stage(entries.groupBy("token", "span").count().where(F.col("count") > BLOCK)
                  .select("token", "span", F.ceil(F.col("count") / BLOCK).cast("bigint").alias("blocks")))
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    both = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1), lambda j: F.shiftleft(F.least(own, j), 31) + F.greatest(own, j))
    part = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(both)).alias("part")
    cut = entries.join(large, ["token", "span"], "left").select("token", "span", part, "n", "node", "pos", "bits", "radius", "label")
    runs = cut.repartition("token", "part").sortWithinPartitions("token", "span", "part", "n", "node")
    names = ["token", "span", "part", "n", "node", "pos", "radius", "label"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def out(e: dict[str, np.ndarray]) -> pa.RecordBatch:
            a, b = passing(e, e["end"], percent, nearest)
            pairs = np.unique(np.stack([np.minimum(e["node"][a], e["node"][b]), np.maximum(e["node"][a], e["node"][b])]), axis=1)
            return pa.record_batch([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            new = {k: batch.column(k).to_numpy().astype(np.int64) for k in names}
            new["bits"] = batch.column("bits").flatten().to_numpy().view(np.uint64).reshape(-1, WORDS)
            held = new if held is None else {k: np.concatenate([held[k], new[k]]) for k in new}
            change = np.flatnonzero((np.diff(held["token"]) != 0) | (np.diff(held["part"]) != 0) | (np.diff(held["span"]) != 0)) + 1
            if len(change):  # the last run may go on in the next batch
                done = {k: v[: change[-1]] for k, v in held.items()}
                done["end"] = np.repeat(change, np.diff(np.concatenate([[0], change])))
                held = {k: v[change[-1]:] for k, v in held.items()}
                yield out(done)
        if held is not None:
            held["end"] = np.full(len(held["n"]), len(held["n"]))
            yield out(held)

    return runs.select(*names, "bits").mapInArrow(run, "a bigint, b bigint").distinct()


def verified(placed: DataFrame, facts: DataFrame, pairs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) of places whose whole sets are similar enough.

    Sets are compared where the parity bits of `facts` (place, n, wide) allow for so many common n-grams.
    """

    def both(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
        for end in ("a", "b"):
            pairs = pairs.join(table.select(F.col("place").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns]), end)
        return pairs.select("a", "b", *[f"{c}_{end}" for c in columns for end in ("a", "b")])

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select("a").unionAll(pairs.select("b")).distinct()

    def near(batch: pa.RecordBatch) -> pa.RecordBatch:
        good = []
        for n, m, x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4), batch.column(5)):
            x, y = x.values.to_numpy().view(np.uint64), y.values.to_numpy().view(np.uint64)
            while len(x) != len(y):
                x, y = (x[: len(x) // 2] ^ x[len(x) // 2 :], y) if len(x) > len(y) else (x, y[: len(y) // 2] ^ y[len(y) // 2 :])
            good.append(int(np.bitwise_count(x ^ y).sum(dtype=np.int64)) <= n + m - 2 * -(-percent * (n + m) // (100 + percent)))
        return batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    def similar(batch: pa.RecordBatch) -> pa.RecordBatch:
        good = []
        for x, y in zip(batch.column(2), batch.column(3)):
            x, y = x.values.to_numpy(), y.values.to_numpy()
            size = len(x) + len(y)
            common = size - len(np.unique(np.concatenate([x, y])))
            good.append((100 + percent) * common >= percent * size)
        return batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    pairs = stage(pairs)
    some = stage(both(pairs, rows_at(facts, ends(pairs)), "n", "wide").mapInArrow(by_slice(near), "a bigint, b bigint"))
    sets = staged_in_python(_sets(placed, ends(some), shingle))
    return stage(both(some, sets, "tokens").mapInArrow(by_slice(similar), "a bigint, b bigint"))


def similar_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id): the smallest id reachable by links between similar sets of word n-grams, itself included.

    Words are stretches without ASCII white space, A-Z lower-cased.  Sets link when their intersection has at least
    `percent` per cent of their union.  A text of fewer words than `shingle` has one n-gram, all its words; null and empty
    texts have none and link with nothing, not even each other.  One row per row of `docs`: repeated rows are copies and link.  A null
    id takes part but is never a component id, unless a component has no other (then null).  Other columns of `docs` are
    ignored; an empty table gives no rows.  N-grams count as equal if 64-bit hashes are.
    """
    if not 0 < percent <= 100 or shingle < 1:
        raise ValueError("a threshold between 1 and 100 per cent and at least one word are needed")
    placed = stage(docs.select(F.monotonically_increasing_id().alias("place"), F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")))
    rows = staged_in_python(summaries(placed, shingle, percent))
    sets = stage(rows.where("n > 0").groupBy("key", "n").agg(F.min("place").alias("place")))
    classes = rows_at(rows.select("place", "n", "same", "prefix", "bits"), sets.select("place"))
    lists, facts, members = _entries(ordered_classes(placed, classes, shingle, percent))
    whole = rows.select("place", "n", "wide")

    # Nodes of a pair of groups are places of their first members, so they can be verified as they are.
    first = _pairs(lists.join(facts, ["node", "span"]).withColumn("label", F.lit(-1).cast("bigint")), percent, True)
    links = verified(placed, whole, first, shingle, percent)
    known = components(links)
    labelled = stage(members.join(known.withColumnRenamed("node", "place"), "place", "left").select("node", "place", F.coalesce("component", "place").alias("label")))
    between = lists.where("span = 1").join(labelled.select("node", "place"), "node").select("token", F.col("place").alias("node"), "pos", "span")
    own = rows_at(rows.select("place", "n", "bits"), labelled.select("place")).join(labelled.select("place", "label"), "place").withColumnRenamed("place", "node")
    expanded = between.unionByName(lists.where("span = 0")).join(own.withColumn("radius", F.lit(0)), "node")
    more = _pairs(expanded, percent, False)
    groups = components(links.unionByName(verified(placed, whole, more, shingle, percent)))

    named = sets.join(groups.withColumnRenamed("node", "place"), "place", "left").select("key", "n", F.coalesce("component", "place").alias("component"))
    ids = placed.select("place", "doc_id").join(rows.select("place", "n", "key"), "place").join(named, ["key", "n"], "left").select("doc_id", "n", "component")
    ids = stage(ids)
    least = ids.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    out = ids.join(least, "component", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
