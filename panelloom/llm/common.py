"""Small helpers of the operators in this package."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.sources.sinks import stage

SLICE = 2 << 20  # bytes of text that a worker handles at once
ROWS = 1000  # rows that a worker gets at once where they hold texts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(id_column: Column, modulus: int) -> Column:
    """crc32 of an id as text, mod `modulus`; null for a null id."""
    return F.crc32(id_column.cast("string").cast("binary")) % modulus


def held_out(id_column: Column, modulus: int, fold: int) -> Column:
    """True where the remainder is `fold`; a null id is never held out."""
    return F.coalesce(remainder(id_column, modulus) == fold, F.lit(False))


def utf8(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch that hold about `most` bytes of text each; a longer text stands in a part of its own."""
    sizes = np.zeros(batch.num_rows, dtype=np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(sizes) - sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


@contextmanager
def short_batches(spark: SparkSession, rows: int = ROWS) -> Iterator[None]:
    """Plans that are run inside send at most `rows` rows to Python at once, so that workers on whole texts hold little."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def staged_in_python(df: DataFrame) -> DataFrame:
    """`stage` for a plan that sends whole texts to Python."""
    with short_batches(df.sparkSession):
        return stage(df)


def with_place(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` written once with a column that numbers the rows, and its name; a later scan may split files in another way."""
    place = free_name("_place", docs.columns)
    return stage(docs.withColumn(place, F.monotonically_increasing_id())), place


def free_name(name: str, taken: Iterable[str]) -> str:
    """`name` with as many underscores as no name in `taken` has; names differ in more than case."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def rows_at(placed: DataFrame, places: DataFrame, place: str = "place", *, others: bool = False) -> DataFrame:
    """Rows of `placed` whose number `place` is among those in the one column of `places`; the `others` on request.

    A bit for each row: the table that the rows are joined with is small, and where it is not, both sides are shuffled.
    """
    word, bits = free_name("_word", placed.columns), free_name("_bits", placed.columns)
    at = F.col(places.columns[0])
    marks = stage(places.groupBy(F.shiftright(at, 6).alias(word)).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(`{places.columns[0]}` & 63 as int))")).alias(bits)))
    at = F.col(place)
    marked = F.getbit(F.coalesce(F.col(bits), F.lit(0).cast("bigint")), at.bitwiseAND(63)) == F.lit(0 if others else 1)
    return placed.withColumn(word, F.shiftright(at, 6)).join(marks, word, "left" if others else "inner").where(marked).select(*[f"`{c}`" for c in placed.columns])


def by_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow from one that handles a single batch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None:
                yield out

    return run


def by_slice(fn: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """As `by_batch`, by parts of bounded bytes, for functions that hold much more than the texts they get."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch) if batch.num_rows else ():
                yield fn(part)
        pa.default_memory_pool().release_unused()

    return run


def once_per_worker(key: str, make: Callable):
    """What `make` gives, kept for all tasks of this Python worker; only the last key is kept.

    Functions travel to the workers by value, so a global of this module would be new in every task.
    """
    held = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker")).__dict__.setdefault("held", {})
    if key not in held:
        held.clear()
        held[key] = make()
    return held[key]
