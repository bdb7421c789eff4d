"""Filters, data-quality checks and profiling.

Checks that the reference ran as one job per column run here as a single
aggregate over all columns, followed by an ``unpivot`` into a long report.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwood.functions.text import is_non_numeric


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def valid_range(df: DataFrame, ranges: dict) -> DataFrame:
    """Keep rows where every column lies in its closed range.

    Rows with a null in any checked column are dropped, as ``between`` is
    null there.  The predicate pushes down to the parquet scan.
    """
    conds = [F.col(_q(c)).between(lo, hi) for c, (lo, hi) in ranges.items()]
    return df.filter(reduce(lambda a, b: a & b, conds))


def non_numeric(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text column holds characters besides digits and '.' (C6)."""
    return df.filter(is_non_numeric(_q(column)))


def determines(df: DataFrame, a: str, b: str) -> DataFrame:
    """Functional dependency test between two columns.

    One aggregate with three distinct counts (null values are not counted);
    ``a`` determines ``b`` when every ``a`` has one ``b``.
    """
    out = df.agg(
        F.count_distinct(F.col(_q(a))).alias("n_a"),
        F.count_distinct(F.col(_q(b))).alias("n_b"),
        F.count_distinct(F.col(_q(a)), F.col(_q(b))).alias("n_ab"))
    return out.select(
        F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), "n_a", "n_b", "n_ab",
        (F.col("n_ab") == F.col("n_a")).alias("a_determines_b"),
        (F.col("n_ab") == F.col("n_b")).alias("b_determines_a"))


def null_counts(df: DataFrame, columns=None) -> DataFrame:
    """Null count per column in one pass, as rows ``(column_name, n_null)``."""
    columns = list(columns or df.columns)
    wide = df.agg(*[F.count_if(F.col(_q(c)).isNull()).alias(f"c{i}")
                    for i, c in enumerate(columns)])
    return _to_long(wide, columns, "n_null")


def _to_long(wide: DataFrame, columns: list[str], value_name: str) -> DataFrame:
    """Turn a one-row frame ``c0..cN`` into rows ``(column_name, value)``."""
    pieces = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', `c{i}`"
                       for i, c in enumerate(columns))
    return wide.selectExpr(f"stack({len(columns)}, {pieces}) AS (column_name, {value_name})")


def unmatched_values(df: DataFrame, column: str, lookup: DataFrame,
                     lookup_columns) -> DataFrame:
    """Distinct values of ``column`` found in none of the lookup columns.

    The lookup columns are stacked into one column and anti-joined, so no
    value set is collected on the driver.
    """
    values = df.select(F.col(_q(column)).alias("value")).where(F.col("value").isNotNull()).distinct()
    known = reduce(lambda x, y: x.unionByName(y), [
        lookup.select(F.col(_q(c)).cast(values.schema["value"].dataType).alias("value"))
        for c in lookup_columns])
    return values.join(known.where(F.col("value").isNotNull()).distinct(), "value", "left_anti") \
        .withColumnRenamed("value", column)


def check_pk(df: DataFrame, keys) -> DataFrame:
    """Key values that occur more than once, with their row count (C11).

    Partial aggregation before the shuffle keeps a hot key cheap.
    """
    keys = list(keys)
    return (df.groupBy(*[F.col(_q(k)) for k in keys]).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def check_not_null(df: DataFrame, columns) -> DataFrame:
    """Rows with a null in any of the columns (C11)."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(_q(c)).isNull() for c in columns]))


def check_fk(df: DataFrame, fk, parent: DataFrame, pk) -> DataFrame:
    """Rows whose non-null foreign key has no parent row (C11)."""
    fk, pk = list(fk), list(pk)
    parent_keys = parent.select(*[F.col(_q(p)).alias(f) for p, f in zip(pk, fk)]).distinct()
    present = reduce(lambda a, b: a & b, [F.col(_q(f)).isNotNull() for f in fk])
    return df.filter(present).join(parent_keys, fk, "left_anti")


def drop_constant(df: DataFrame, columns) -> DataFrame:
    """Drop the given columns that hold at most one distinct non-null value.

    ``count(distinct c) <= 1`` is the same as ``min(c) = max(c)`` or all
    null, which aggregates partially and needs no distinct shuffle.
    """
    columns = list(columns)
    if not columns:
        return df
    row = df.agg(*[(F.min(F.col(_q(c))).eqNullSafe(F.max(F.col(_q(c))))).alias(f"c{i}")
                   for i, c in enumerate(columns)]).first()
    constant = {c for i, c in enumerate(columns) if row[f"c{i}"]}
    return df.select(*[F.col(_q(c)) for c in df.columns if c not in constant])


def histogram(df: DataFrame, columns, bins: int = 50) -> DataFrame:
    """Equal-width histogram per column as rows ``(column_name, bin, n)``.

    Min and max come from one aggregate (scalars); bins are counted in one
    scan and one partial aggregation for all columns.  The maximum falls in
    the last bin; null, NaN and infinite values are in no bin.
    """
    columns = list(columns)

    def finite(c: str):
        v = F.col(_q(c)).cast("double")
        return F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)

    ext = df.agg(*[F.min(finite(c)).alias(f"lo{i}") for i, c in enumerate(columns)],
                 *[F.max(finite(c)).alias(f"hi{i}") for i, c in enumerate(columns)]).first()
    entries = []
    for i, c in enumerate(columns):
        lo, hi = ext[f"lo{i}"], ext[f"hi{i}"]
        v = finite(c)
        if lo is None:
            continue
        width = (hi - lo) if hi != lo else 1.0
        b = F.least(F.floor((v - F.lit(lo)) / F.lit(width) * F.lit(bins)), F.lit(bins - 1)).cast("int")
        entries.append(F.when(v.isNotNull(), F.struct(F.lit(c).alias("column_name"), b.alias("bin"))))
    if not entries:
        return df.sparkSession.createDataFrame([], "column_name string, bin int, n long")
    exploded = df.select(F.explode(F.array_compact(F.array(*entries))).alias("e"))
    return exploded.groupBy("e.column_name", "e.bin").agg(F.count(F.lit(1)).alias("n"))


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in set(exclude)]
