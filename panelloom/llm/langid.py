"""Language identification by prediction by partial matching.

For every language a tree of byte contexts of up to three bytes is counted and then frozen.  A byte costs
-log2 of its probability in the longest context that the tree has; a byte that this context has never seen
first costs an escape, with the probability d / (n + d) of a context with n bytes of d kinds, and goes on in
the context that is one byte shorter, down to the uniform distribution over all 256 bytes.  The sum is the
exact code length of a text under the language; the shortest wins.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.llm.common import by_batch, rows_at, short_batches, staged_in_python, utf8, with_place

DEPTH = 3  # longest context in bytes
MAX_TEXTS = 1500  # texts per language that a tree is counted from, in expectation
PIECE = 1 << 20  # bytes of a text that are counted or scored at once
SEEN = 3  # a byte that fewer texts hold is outside the alphabet

DEVIATIONS = 8.0  # a text that costs so many standard deviations more than texts of its language is in none of them

SIGNS = re.compile(r"[^\W\d_]+")  # letters, and numbers like fractions


def has_letter(text: str) -> bool:
    """Is there a character of the Unicode category L?"""
    return any(c.isalpha() for m in SIGNS.finditer(text) for c in m.group())


@dataclass
class Trees:
    """Costs in bits as lookup tables over an alphabet of byte classes; class 0 is any byte never seen."""

    languages: list[str]
    classes: np.ndarray  # byte -> class
    size: int
    contexts: np.ndarray  # three classes -> row of `deep`, 0 where no tree has that context
    deep: np.ndarray  # (row, class) -> cost per language
    shallow: list[np.ndarray]  # for contexts of 0, 1 and 2 classes: cost per language

    def code_lengths(self, text: bytes) -> np.ndarray:
        """Bits per language for the whole text; the first bytes have the shorter contexts that exist."""
        total = np.zeros(len(self.languages))
        codes = self.classes[np.frombuffer(text, dtype=np.uint8)]
        a = self.size
        for at in range(0, len(codes), PIECE):
            c = codes[max(0, at - DEPTH) : at + PIECE].astype(np.int64)
            if at == 0:
                total += self.shallow[0][c[0]]
                if len(c) > 1:
                    total += self.shallow[1][c[0] * a + c[1]]
                if len(c) > 2:
                    total += self.shallow[2][(c[0] * a + c[1]) * a + c[2]]
            if len(c) > DEPTH:
                pairs = c[:-1] * a + c[1:]
                triples = pairs[:-1] * a + c[2:]
                row = self.contexts[triples[:-1]].astype(np.int64)
                known = row > 0
                total += self.deep[row[known] * a + c[3:][known]].sum(axis=0, dtype=np.float64)
                rest = ~known
                if rest.any():
                    total += self.shallow[2][triples[1:][rest]].sum(axis=0, dtype=np.float64)
        return total

    def predict(self, text: bytes) -> tuple[str, float]:
        """Language with the shortest code and its posterior probability; ("und", 0) without a letter."""
        return self.told(text)[:2]

    def told(self, text: bytes) -> tuple[str, float, float]:
        """As `predict`, and the bits a byte of the shortest code."""
        if not self.languages or not has_letter(text.decode("utf-8", "replace")):
            return "und", 0.0, 0.0
        bits = self.code_lengths(text)
        best = int(bits.argmin())
        return self.languages[best], float(1 / np.exp2(-np.minimum(bits - bits[best], 1000)).sum()), float(bits[best]) / len(text)


def counted(texts: DataFrame) -> DataFrame:
    """(lang, gram, n): strings of DEPTH + 1 bytes, and the shorter ones that begin a text, with their counts.

    Counts of a batch are summed before they are shuffled, a language as soon as it has more than PIECE grams, so
    that a text of any length takes bounded memory.  A gram is a long: its bytes, below a leading 1.
    """

    def summed(own: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        grams, place = np.unique(np.concatenate([g for g, _ in own]), return_inverse=True)
        return grams, np.bincount(place, weights=np.concatenate([n for _, n in own]), minlength=len(grams)).astype(np.int64)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        waiting: dict[str, int] = {}

        def add(lang: str, grams: np.ndarray) -> None:
            own = found.setdefault(lang, [])
            own.append((grams, np.ones(len(grams), dtype=np.int64)))
            waiting[lang] = waiting.get(lang, 0) + len(grams)
            if waiting[lang] > PIECE:
                found[lang], waiting[lang] = [summed(own)], 0

        for lang, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
            whole = np.frombuffer(text, dtype=np.uint8)
            starts = [sum(int(x) << 8 * (k - i) for i, x in enumerate(whole[: k + 1])) | 1 << 8 * (k + 1) for k in range(min(DEPTH, len(whole)))]
            add(lang, np.array(starts, dtype=np.int64))
            for at in range(0, len(whole), PIECE):
                codes = whole[max(0, at - DEPTH) : at + PIECE].astype(np.int64)
                grams = np.ones(max(0, len(codes) - DEPTH), dtype=np.int64)
                for k in range(DEPTH + 1):
                    grams = grams << 8 | codes[k : k + len(grams)]
                add(lang, grams)
        out = [(lang, *summed(own)) for lang, own in found.items()]
        return pa.record_batch({
            "lang": pa.array([lang for lang, grams, _ in out for _ in range(len(grams))], pa.string()),
            "gram": pa.array(np.concatenate([g for _, g, _ in out])), "n": pa.array(np.concatenate([n for _, _, n in out]))})

    return texts.mapInArrow(by_batch(run), "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _costs(grams: np.ndarray, counts: np.ndarray, size: int) -> list[np.ndarray]:
    """Per context length k: costs of every (context, class); unseen contexts have the costs of their suffix.

    `grams` hold DEPTH + 1 classes in base `size`; shorter contexts are counted from their tails.
    """
    table = np.full(size, np.log2(256.0))  # the uniform distribution over bytes
    out = []
    for k in range(DEPTH):
        tail = np.bincount(grams % size ** (k + 1), weights=counts, minlength=size ** (k + 1)).reshape(-1, size)
        total, kinds = tail.sum(axis=1, keepdims=True), np.count_nonzero(tail, axis=1)[:, None]
        shorter = np.tile(table.reshape(-1, size), (tail.shape[0] // (table.size // size), 1))
        with np.errstate(divide="ignore", invalid="ignore"):
            seen = np.log2(total + kinds) - np.log2(tail)
            escape = np.where(total > 0, np.log2(total + kinds) - np.log2(np.maximum(kinds, 1)), 0.0)
        table = np.where(tail > 0, seen, escape + shorter)
        out.append(table.reshape(-1))
    return out


def _deep(grams: np.ndarray, counts: np.ndarray, rows: np.ndarray, shallow: np.ndarray, size: int) -> np.ndarray:
    """Costs of every class in the contexts `rows` of DEPTH classes."""
    context, symbol = grams // size, grams % size
    at = np.searchsorted(rows, context)
    own = np.zeros((len(rows), size))
    np.add.at(own, (at, symbol), counts)
    total, kinds = own.sum(axis=1, keepdims=True), np.count_nonzero(own, axis=1)[:, None]
    shorter = shallow.reshape(-1, size)[rows % size ** (DEPTH - 1)]
    with np.errstate(divide="ignore", invalid="ignore"):
        seen = np.log2(total + kinds) - np.log2(own)
        escape = np.where(total > 0, np.log2(total + kinds) - np.log2(np.maximum(kinds, 1)), 0.0)
    return np.where(own > 0, seen, escape + shorter)


def build(langs: list[str], grams: np.ndarray, counts: np.ndarray) -> Trees:
    """Freeze the trees; `langs`, `grams` and `counts` are parallel."""
    length = np.zeros(len(grams), dtype=np.int64)
    for k in range(1, DEPTH + 2):
        length[grams >> 8 * k == 1] = k
    seen = np.zeros(256, dtype=np.int64)
    for k in range(DEPTH + 1):
        own = length > k
        np.add.at(seen, grams[own] >> 8 * k & 255, counts[own])
    alphabet = np.flatnonzero(seen >= SEEN)
    classes = np.zeros(256, dtype=np.uint8)
    classes[alphabet] = np.arange(1, len(alphabet) + 1)
    size = len(alphabet) + 1
    coded = np.zeros(len(grams), dtype=np.int64)
    for k in range(DEPTH, -1, -1):
        coded = coded * size + np.where(length > k, classes[grams >> 8 * k & 255], 0)
    names = sorted(set(langs))
    lang = np.searchsorted(names, langs)
    full = (length == DEPTH + 1)
    whole = full & (coded >= 0)
    rows = np.unique(np.concatenate([[0], coded[whole] // size]))
    contexts = np.zeros(size**DEPTH, dtype=np.int32)
    contexts[rows] = np.arange(len(rows))
    shallow, deep = [], []
    for k in range(len(names)):
        own = whole & (lang == k)
        low = _costs(coded[own], counts[own], size)
        shallow.append(low)
        deep.append(_deep(coded[own], counts[own], rows, low[DEPTH - 1], size).reshape(-1))
    return Trees(names, classes, size, contexts, np.stack(deep, axis=1).astype(np.float32),
                 [np.stack([s[k] for s in shallow], axis=1).astype(np.float32) for k in range(DEPTH)])


def fit(docs: DataFrame, train: Column, *, text: str = "text", lang: str = "lang", max_texts: int = MAX_TEXTS, seed: int = 11) -> Trees | None:
    """Trees of the languages that the rows of `docs` with `train` name; None without such rows.

    About `max_texts` texts per language are learned from, drawn row by row, so that copies of a text
    are not drawn together.
    """
    texts = docs.where(train).select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    texts = texts.where("lang is not null and text is not null")
    share = {r.lang: min(1.0, max_texts / r.n) for r in texts.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not share:
        return None
    chosen = texts.where(F.rand(seed) < F.coalesce(*[F.when(F.col("lang") == k, F.lit(v)) for k, v in share.items()]))
    with short_batches(docs.sparkSession):
        got = counted(chosen).where("n > 0").toPandas()
    return build(got["lang"].tolist(), got["gram"].to_numpy(), got["n"].to_numpy()) if len(got) else None


def _predictor(docs: DataFrame, trees: Trees | None) -> Callable[[list[bytes]], list[tuple[str, float]]]:
    """Predictions of a list of texts, with the trees broadcast as plain arrays (bounded by the sample)."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(trees) if trees else None)

    def predict(texts: list[bytes]) -> list[tuple[str, float]]:
        if not shared.value:
            return [("und", 0.0)] * len(texts)
        own = Trees(**shared.value)
        return [own.predict(t) for t in texts]

    return predict


def identify(docs: DataFrame, held_out: Column, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", **options) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row; learned from rows that are not held out.

    A null text, one without a letter, or a table without any language gives "und" with score 0.  The
    score is the posterior probability of the language under the code lengths.  Repeated rows give
    repeated rows; ties go to the language first by name; other columns are ignored.
    """
    predict = _predictor(docs, fit(docs, ~held_out, text=text, lang=lang, **options))
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = predict(utf8(batch.column(2)))
        return pa.record_batch([batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()),
                                pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(by_batch(run), f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def _limits(docs: DataFrame, train: Column, *, text: str = "text", lang: str = "lang", **options) -> dict[str, tuple[float, float, float]]:
    """Per language: bits a byte of its texts, and their variance per text of a byte and between texts.

    Texts cost less under trees that have learned them.  So trees of one half of the training texts (copies
    of a text stand in the same half) measure all rows of the other half that they tell right.  Texts vary
    by chance, which evens out over their bytes, and by kind, which does not.  A language without rows in
    both halves has no entry.
    """
    half = F.pmod(F.xxhash64(F.col(text).cast("string")), F.lit(2)) == 0
    trees = fit(docs, train & half, text=text, lang=lang, **options)
    rows = docs.where(train & ~half).select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    rows = rows.where("lang is not null and text is not null")
    if not trees:
        return {}
    shared = docs.sparkSession.sparkContext.broadcast(vars(trees))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = Trees(**shared.value)
        sums: dict[str, np.ndarray] = {}
        for name, source in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
            best, _, rate = own.told(source)
            if best == name:
                n = len(source)
                sums[name] = sums.get(name, 0.0) + np.array([1.0, n, rate * n, rate * rate * n])
        columns = np.array(list(sums.values())).reshape(-1, 4).T
        return pa.record_batch([pa.array(list(sums), pa.string()), *map(pa.array, columns)], names=["lang", "texts", "n", "bits", "squares"])

    sums = rows.mapInArrow(by_batch(run), "lang string, texts double, n double, bits double, squares double").groupBy("lang").agg(
        *[F.sum(c).alias(c) for c in ("texts", "n", "bits", "squares")])
    with short_batches(docs.sparkSession):
        found = sums.collect()
    limits = {}
    for r in found:
        spread = max(0.0, r.squares - r.bits**2 / r.n)
        limits[r.lang] = r.bits / r.n, spread / r.texts, spread / r.n
    return limits


def identified(docs: DataFrame, held_out: Column, least: float = 0.5, deviations: float = DEVIATIONS, **options) -> DataFrame:
    """Rows of `docs` whose language is told with a score of at least `least`; all columns stay.

    A text that costs more bits a byte than `deviations` standard deviations above the training texts of the
    language is in no learned language and goes.  Null texts and those without a letter go; repeated rows stay or go
    together.  Where no row names a language none is learned, and every row goes.  Extra columns stay whatever their
    names; an empty table gives no rows.  Texts are sent to Python alone; rows are chosen by their place.
    """
    trees, limits = fit(docs, ~held_out, **options), _limits(docs, ~held_out, **options)
    shared = docs.sparkSession.sparkContext.broadcast(vars(trees) if trees else None)

    def fits(text: bytes, own: Trees | None) -> bool:
        name, p, rate = own.told(text) if own else ("und", 0.0, 0.0)
        if name == "und" or p < least:
            return False
        mean, chance, kind = limits.get(name, (np.inf, 0.0, 0.0))
        return rate <= mean + deviations * np.sqrt(chance / len(text) + kind)

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = Trees(**shared.value) if shared.value else None
        return batch.select([0]).filter(pa.array([fits(t, own) for t in utf8(batch.column(1))], pa.bool_()))

    placed, place = with_place(docs)
    kept = staged_in_python(placed.select(place, F.col("text").cast("string").alias("text")).mapInArrow(by_batch(keep), f"`{place}` bigint"))
    return rows_at(placed, kept, place).select(*[f"`{c}`" for c in docs.columns])
