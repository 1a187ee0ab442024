"""Column profiles and cleaning (P*, A1, A5, A6, A10).

Which columns to keep depends on the data: one aggregate job brings back a row of profile
numbers (a few per column), then the result is a plain lazy `select`.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

AGG_CHUNK = 100


def _chunks(items: Sequence, size: int = AGG_CHUNK) -> Iterable[Sequence]:
    for i in range(0, len(items), size):
        yield items[i:i + size]


def profile_row(df: DataFrame, aggs: dict[str, Column]) -> dict:
    """Evaluate named aggregates, at most `AGG_CHUNK` per job to keep generated code small."""
    out: dict = {}
    for part in _chunks(list(aggs.items())):
        row: Row = df.agg(*[a.alias(n) for n, a in part]).first()
        out.update(row.asDict())
    return out


def numeric_columns(df: DataFrame) -> list[str]:
    """P9."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def value_columns(df: DataFrame, protected: Sequence[str]) -> list[str]:
    """P8."""
    return [c for c in df.columns if c not in protected]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing floats as null, so that aggregates skip them."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[
        F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns
    ])


def time_between(df: DataFrame, lo: str, hi: str, *, ts: str = "ts") -> DataFrame:
    """Strictly between two literals; reaches the scan as a pushed filter."""
    low, high = F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz")
    return df.filter((F.col(ts) > low) & (F.col(ts) < high))


def leading(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """P5: named columns first, the others in their order."""
    return df.select(*first, *[c for c in df.columns if c not in first])


def constant_columns(df: DataFrame, protected: Sequence[str] = ()) -> list[str]:
    """Columns with exactly one distinct non-null value; min = max needs no distinct count."""
    cols = value_columns(df, protected)
    found = profile_row(df, {c: F.min(c) == F.max(c) for c in cols})
    return [c for c in cols if found[c]]


def drop_constant(df: DataFrame, protected: Sequence[str] = ()) -> DataFrame:
    return df.drop(*constant_columns(df, protected))


def classify_columns(df: DataFrame, *, target: str, series: str = "series", ts: str = "ts",
                     scope: str = "global") -> tuple[list[str], list[str]]:
    """(value columns, static columns).

    Scope "global": static means one distinct value in the whole panel.  Scope "series": static
    means at most one value within each series.
    """
    cols = value_columns(df, [series, ts])
    if scope == "global":
        static = set(constant_columns(df, [series, ts]))
    else:
        ranges = df.groupBy(series).agg(
            *[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols]
        )
        same = profile_row(ranges, {c: F.every(F.col(f"lo_{c}").eqNullSafe(F.col(f"hi_{c}"))) for c in cols})
        static = {c for c in cols if same[c]}
    values = [c for c in cols if c not in static]
    if target not in values:
        raise ValueError(f"target column {target!r} is not a value column")
    return values, [c for c in cols if c in static]


def column_kinds(df: DataFrame, *, series: str = "series", ts: str = "ts", approx: bool = False) -> DataFrame:
    """P7/A5 as a table: distinct count and whether a column is constant globally and per series.

    Exact distinct counts shuffle every distinct value of every column; `approx` replaces them by
    sketches.  Whether a column is constant stays exact either way.
    """
    cols = value_columns(df, [series, ts])
    per_series = df.groupBy(series).agg(*[(F.min(c).eqNullSafe(F.max(c))).alias(c) for c in cols])
    kinds = per_series.agg(*[F.every(c).alias(c) for c in cols])
    distinct = F.approx_count_distinct if approx else F.count_distinct
    counts = df.agg(*[distinct(c).alias(c) for c in cols])
    constant = df.agg(*[(F.min(c) == F.max(c)).alias(c) for c in cols])
    as_rows = "stack({n}, {pairs}) as (column, {name})"

    def rows(one: DataFrame, name: str) -> DataFrame:
        return one.selectExpr(as_rows.format(n=len(cols), pairs=", ".join(f"'{c}', `{c}`" for c in cols), name=name))

    both = rows(counts, "n_distinct").join(rows(kinds, "static_in_series"), "column")
    return both.join(rows(constant, "static_global"), "column")


def series_dimension(df: DataFrame, static: Sequence[str], *, series: str = "series", ts: str = "ts") -> DataFrame:
    """One row per series with length, range, key check and static covariates."""
    return df.groupBy(series).agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
        *[F.min(c).alias(c) for c in static],
    )


def duplicate_columns(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """P10: columns equal by content to an earlier one.

    One aggregate gives an order-independent fingerprint per column; only columns with equal
    fingerprints are compared row by row, in a second aggregate.
    """
    cols = value_columns(df, keys)
    numeric = set(numeric_columns(df))

    def content(c: str) -> Column:
        return F.col(c).cast("double") if c in numeric else F.col(c).cast("string")

    prints = profile_row(
        df, {c: F.bit_xor(F.xxhash64(*keys, content(c))) for c in cols}
    )
    # only columns of one kind can be equal: a numeric and a string fingerprint never compare
    first: dict = {}
    pairs = []
    for c in cols:
        mark = (c in numeric, prints[c])
        if mark in first:
            pairs.append((first[mark], c))
        else:
            first[mark] = c
    if not pairs:
        return []
    same = profile_row(df, {b: F.count_if(~content(a).eqNullSafe(content(b))) == 0 for a, b in pairs})
    return [b for _, b in pairs if same[b]]


def drop_duplicate_columns(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.drop(*duplicate_columns(df, keys))


def replace_sentinels(df: DataFrame, protected: Sequence[str] = ()) -> DataFrame:
    """Null, NaN, "None" and "" become 0 (as text in text columns)."""
    def clean(f: T.StructField) -> Column:
        c = F.col(f.name)
        if f.name in protected:
            return c
        if isinstance(f.dataType, T.StringType):
            return F.when(c.isNull() | c.isin("None", ""), "0").otherwise(c).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return F.when(c.isNull() | F.isnan(c), 0).otherwise(c).cast(f.dataType).alias(f.name)
        if isinstance(f.dataType, T.NumericType):
            return F.coalesce(c, F.lit(0)).cast(f.dataType).alias(f.name)
        return c

    return df.select(*[clean(f) for f in df.schema])


def rows_after_last(new: DataFrame, history: DataFrame, *, series: str = "series", ts: str = "ts") -> DataFrame:
    """Rows later than the last one known of their series; rows of unknown series stay."""
    from panelloom.operators.blocks import lookup

    last = history.groupBy(series).agg(F.max(ts).alias("_last"))
    late = F.col("_last").isNull() | (F.col(ts) > F.col("_last"))
    return lookup(new, last, [series], how="left").filter(late).drop("_last")


def parse_time(df: DataFrame, col: str, *, strict: bool = False) -> DataFrame:
    """F2 + P12: parse text to timestamps; unparsable rows are dropped, or fail when strict."""
    if strict:
        return df.withColumn(col, F.col(col).cast("timestamp_ntz"))
    return df.withColumn(col, F.col(col).try_cast("timestamp_ntz")).dropna(subset=[col])


def to_number(c: Column) -> Column:
    """numbers, null where the text is none."""
    return c.try_cast("double")


# Integer types from narrow to wide with their ranges.  Unsigned types of the data
# model have no Spark type of their own and take the next wider signed one.
_INTS = [
    ("byte", -128, 127), ("short", -32768, 32767), ("int", -2**31, 2**31 - 1), ("bigint", -2**63, 2**63 - 1),
    ("decimal(20,0)", 0, 2**64 - 1),
]
_UNSIGNED = [("short", 255), ("int", 65535), ("bigint", 2**32 - 1), ("decimal(20,0)", 2**64 - 1)]


def smallest_type(lo: float | None, hi: float | None, whole: bool | None, current: str) -> str:
    """Narrowest type for a value range; never narrower than float for fractions."""
    if lo is None or hi is None:
        return current
    if whole:
        if lo >= 0:
            return next((t for t, top in _UNSIGNED if hi <= top), current)
        return next((t for t, a, b in _INTS if a <= lo and hi <= b), current)
    return "float" if current == "float" else "double"


def type_profile(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, str]:
    """Suggested type per column.

    Numeric-looking strings are included when every non-null value converts.
    """
    cols = list(cols or df.columns)
    types = {f.name: f.dataType for f in df.schema}
    aggs: dict[str, Column] = {}
    wanted = []
    for i, c in enumerate(cols):
        t = types[c]
        if isinstance(t, T.NumericType):
            v = F.col(c) if not isinstance(t, (T.DoubleType, T.FloatType)) else F.when(~F.isnan(c), F.col(c))
        elif isinstance(t, T.StringType):
            v = to_number(F.col(c))
            aggs[f"{i}_lost"] = F.count_if(F.col(c).isNotNull() & v.isNull())
        else:
            continue
        wanted.append((i, c))
        aggs[f"{i}_lo"], aggs[f"{i}_hi"] = F.min(v), F.max(v)
        aggs[f"{i}_whole"] = F.every(v == F.rint(v))
    got = profile_row(df, aggs)
    out = {}
    for i, c in wanted:
        if got.get(f"{i}_lost"):
            continue
        out[c] = smallest_type(got[f"{i}_lo"], got[f"{i}_hi"], got[f"{i}_whole"], types[c].simpleString())
    return {c: t for c, t in out.items() if t != types[c].simpleString() and t != "string"}


def narrow_types(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Cast every column to its smallest type."""
    new = type_profile(df, cols)
    return df.select(*[F.col(c).cast(new[c]).alias(c) if c in new else F.col(c) for c in df.columns])


def column_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A5/A6 as a table: distinct count, range, nulls and whether all values are whole."""
    aggs = []
    for c in cols:
        v = F.col(c).cast("double")
        aggs.append(F.struct(
            F.lit(c).alias("column"), F.count_distinct(c).alias("n_distinct"), F.min(v).alias("lo"),
            F.max(v).alias("hi"), F.count_if(v.isNull()).alias("n_null"), F.every(v == F.rint(v)).alias("whole"),
        ))
    return df.agg(F.array(*aggs).alias("p")).select(F.inline("p"))


def shape(df: DataFrame) -> DataFrame:
    """A10: row and column count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))
