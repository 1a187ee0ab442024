"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration.

Statistics of a text (bytes, words, lines) are standardised and sent through cos(Wx + b) with Gaussian W,
whose inner products approximate a Gaussian kernel.  Each partition of labelled rows sums its part of the
normal equations; the sums give the ridge weights.  A monotone step function, fitted to scores of the
labelled rows by pooling neighbours that violate the order, turns the score into the share of label 1.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.llm.common import by_batch, rows_at, staged_in_python, utf8, with_place
from panelloom.sources.sinks import stage

MAX_ROWS = 200_000  # bound of the labelled rows that a model is fitted on, in expectation
GROUPS = 8  # partitions of the labelled rows: so many partial sums reach the driver
CLASSES = 2048  # classes of scores that calibration starts from


def statistics(text: bytes) -> list[float]:
    """Statistics of a whole text; an empty text has zeros."""
    n = len(text)
    if not n:
        return [0.0] * len(statistics(b"a"))
    codes = np.frombuffer(text, dtype=np.uint8)
    count = np.bincount(codes, minlength=256)
    lower, upper, digits, spaces = count[97:123].sum(), count[65:91].sum(), count[48:58].sum(), count[[9, 10, 11, 12, 13, 32]].sum()
    high, ends = count[128:].sum(), count[[33, 46, 63]].sum()
    commas, bars = count[[44, 59, 58]].sum(), count[[124, 95, 61, 43]].sum()
    marks = n - lower - upper - digits - spaces - high
    symbols = marks - ends - commas
    punct = (codes < 48) & (codes > 32)
    repeated = np.count_nonzero((codes[1:] == codes[:-1]) & punct[1:])
    words = text.split()
    m = max(1, len(words))
    tally = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    k = max(1, len(lines))
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=len(words)) if words else np.zeros(1)
    share = np.bincount(codes, minlength=256)[count > 0] / n
    return [
        np.log1p(n), np.log1p(len(words)), lengths.mean(), lengths.std(), np.log1p(lengths.max()),
        lower / n, upper / n, digits / n, spaces / n, high / n, ends / m, commas / m, bars / m, symbols / n, np.sqrt(symbols / m),
        np.sqrt(count[33] / m), np.sqrt(count[124] / m), np.sqrt(repeated / m), len(tally) / m, max(tally.values(), default=0) / m,
        np.log(m / max(1, len(tally))), np.count_nonzero(lengths <= 3) / m, len(set(lines)) / k, np.log1p(k), np.log1p(m / k),
        float(-(share * np.log2(share)).sum()), len(zlib.compress(text, 1)) / n,
    ]


WIDTH = len(statistics(b"a"))


@dataclass
class Model:
    """Everything that a score needs: a few hundred numbers times the width of the statistics."""

    centre: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    shares: np.ndarray

    def features(self, rows: np.ndarray) -> np.ndarray:
        x = np.clip((rows - self.centre) / self.scale, -8, 8)
        z = np.cos(x @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([z, x, np.ones((len(x), 1))])

    def ridge(self, rows: np.ndarray) -> np.ndarray:
        return self.features(rows) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Calibrated scores between 0 and 1."""
        return np.clip(np.interp(self.ridge(rows), self.steps, self.shares), 0.0, 1.0)


def isotonic(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Non-decreasing weighted least-squares fit: neighbours that violate the order are pooled."""
    pools: list[list[float]] = []
    for v, w in zip(value, weight):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v2, w2, n2 = pools.pop()
            v1, w1, n1 = pools.pop()
            pools.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.repeat([p[0] for p in pools], [int(p[2]) for p in pools])


def with_statistics(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """The named columns and `stats`, statistics of the whole text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.array([statistics(t) for t in utf8(batch.column(len(keep)))], dtype=np.float32)
        stats = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), WIDTH).cast(pa.list_(pa.float32()))
        return pa.record_batch([*batch.columns[: len(keep)], stats], names=[*keep, "stats"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*[f"`{c}`" for c in keep], F.col(text).cast("string").alias("_text")).mapInArrow(
        by_batch(run), f"{fields}{', ' if keep else ''}stats array<float>")


def _matrix(batch: pa.RecordBatch, name: str = "stats") -> np.ndarray:
    flat = batch.column(batch.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, WIDTH).astype(np.float64)


def _summed(rows: DataFrame, part) -> list[np.ndarray]:
    """Sum over partitions of the arrays that `part(stats, label)` gives; at most GROUPS of them reach the driver."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = part(_matrix(batch), batch.column(batch.schema.get_field_index("label")).to_numpy().astype(np.float64))
                total = own if total is None else [x + y for x, y in zip(total, own)]
        if total is not None:
            yield pa.record_batch({"sums": pa.array([x.astype(np.float64).tobytes() for x in total], pa.binary()),
                                   "k": pa.array(range(len(total)), pa.int32())})

    got = rows.mapInArrow(run, "sums binary, k int").collect()
    out: dict[int, np.ndarray] = {}
    for r in sorted(got, key=lambda r: (r.k, bytes(r.sums))):
        out[r.k] = out.get(r.k, 0) + np.frombuffer(bytes(r.sums))
    return [out[k] for k in sorted(out)]


def fit(stats: DataFrame, labels: DataFrame, train: Column, *, doc_id: str = "doc_id", label: str = "quality",
        width: int = 256, spread: float = 1.0, ridge: float = 1e-2, max_rows: int = MAX_ROWS, seed: int = 7) -> Model | None:
    """Fit on the rows of `stats` (doc_id, stats) that `labels` marks 0 or 1 and for which `train` holds.

    About `max_rows` rows are used, drawn row by row, where there are more; a label given twice counts
    twice.  None where no row is labelled.
    """
    marked = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("label")).where("label in (0, 1)")
    chosen = stats.where(train).select(F.col(doc_id).alias("_id"), "stats").join(marked, "_id").select("_id", "label", "stats")
    found = marked.count()
    if found > max_rows:
        chosen = chosen.where(F.rand(seed) < max_rows / found)
    rows = stage(chosen.select("label", "stats").repartition(GROUPS))
    sums = _summed(rows, lambda x, y: [np.array([float(len(y)), y.sum()]), x.sum(axis=0), (x * x).sum(axis=0)])
    if not sums:
        return None
    n = sums[0][0]
    centre = sums[1] / n
    scale = np.sqrt(np.maximum(sums[2] / n - centre**2, 0)) + 1e-6
    rng = np.random.default_rng(seed)
    directions = rng.normal(0, spread / np.sqrt(WIDTH), (WIDTH, width))
    model = Model(centre, scale, directions, rng.uniform(0, 2 * np.pi, width), np.zeros(width + WIDTH + 1), np.zeros(1), np.zeros(1))

    def normal_equations(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        z = model.features(x)
        return [(z.T @ z).ravel(), z.T @ y]

    gram, right = _summed(rows, normal_equations)
    size = len(right)
    model.weights = np.linalg.solve(gram.reshape(size, size) + ridge * n * np.eye(size) / 100, right)

    def classes(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        k = np.clip(((model.ridge(x) + 1) / 3 * CLASSES).astype(int), 0, CLASSES - 1)
        return [np.bincount(k, minlength=CLASSES).astype(float), np.bincount(k, weights=y, minlength=CLASSES)]

    rows_in, ones = _summed(rows, classes)
    used = np.flatnonzero(rows_in)
    model.steps = (used + 0.5) / CLASSES * 3 - 1
    model.shares = isotonic(ones[used] / rows_in[used], rows_in[used])
    return model


def score(stats: DataFrame, model: Model | None) -> DataFrame:
    """`stats` with `score` in place of the statistics; without a model every score is 0.5."""
    keep = [c for c in stats.columns if c != "stats"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = model.score(_matrix(batch)) if model else np.full(batch.num_rows, 0.5)
        return pa.record_batch([*[batch.column(batch.schema.get_field_index(c)) for c in keep], pa.array(scores)], names=[*keep, "score"])

    fields = ", ".join(f"`{c}` {stats.schema[c].dataType.simpleString()}" for c in keep)
    return stats.mapInArrow(by_batch(run), f"{fields}{', ' if keep else ''}score double")


def score_documents(docs: DataFrame, labels: DataFrame, held_out: Column, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs`, null and empty texts included.

    `held_out` is a column over doc_id; labels of held-out rows are not learned from.  Repeated rows give
    repeated rows; a null id is scored but never labelled.
    """
    stats = stage(with_statistics(docs, "doc_id"))
    model = fit(stats, labels, ~held_out, **options)
    return score(stats.withColumn("held_out", held_out), model).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, held_out: Column, **options) -> DataFrame:
    """Rows of `docs` with a score of at least 0.5; all columns stay.

    Null and empty texts are scored like others; repeated rows stay or go together; without a labelled row nothing is
    learned and every row stays; extra columns stay whatever their names; an empty table gives no rows.  Texts are sent to
    Python once and do not come back; rows are chosen by their place.
    """
    placed, place = with_place(docs)
    stats = staged_in_python(with_statistics(placed, place, "doc_id"))
    model = fit(stats, labels, ~held_out, **options)
    kept = stage(score(stats.drop("doc_id"), model).where("score >= 0.5").select(place))
    return rows_at(placed, kept, place).select(*[f"`{c}`" for c in docs.columns])
