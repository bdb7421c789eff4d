"""Continuous-column detection and IQR outlier audit / removal.

Every statistic over many columns is one aggregate (one Spark job), not one
job per column.  Quantiles are approximate by default (Greenwald–Khanna with
relative error 0.01, mergeable per partition); ``exact=True`` finds the
``percentile_disc`` value (equal to SQL ``quantile_disc``) by histogram
narrowing, so no task ever holds all distinct values of a column.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwood.operators.quality import _to_long, numeric_columns
from driftwood.session import cut_lineage

DEFAULT_FACTOR = 1.5
DEFAULT_RELATIVE_ERROR = 0.01
DEFAULT_DISTINCT_THRESHOLD = 10


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _is_fractional(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))


@dataclass(frozen=True)
class Bounds:
    q1: float | None
    q3: float | None
    factor: float

    @property
    def iqr(self):
        return None if self.q1 is None else self.q3 - self.q1

    @property
    def lower(self):
        return None if self.q1 is None else self.q1 - self.factor * (self.q3 - self.q1)

    @property
    def upper(self):
        return None if self.q1 is None else self.q3 + self.factor * (self.q3 - self.q1)


# ------------------------------------------------------------------ E4 --

def continuous_profile(df: DataFrame, exclude=()) -> DataFrame:
    """Approximate distinct count of every numeric column, one aggregate."""
    cols = numeric_columns(df, exclude)
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, approx_distinct long")
    wide = df.agg(*[F.approx_count_distinct(F.col(_q(c))).alias(f"c{i}") for i, c in enumerate(cols)])
    return _to_long(wide, cols, "approx_distinct")


def continuous_columns(df: DataFrame, threshold: int = DEFAULT_DISTINCT_THRESHOLD,
                       exclude=()) -> list[str]:
    """Numeric columns with more than ``threshold`` approximate distinct values."""
    cols = numeric_columns(df, exclude)
    if not cols:
        return []
    row = df.agg(*[F.approx_count_distinct(F.col(_q(c))).alias(f"c{i}")
                   for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if row[f"c{i}"] > threshold]


# ------------------------------------------------------------------ E5 --

# Rows that the last step of an exact quantile search gathers per quantile.
EXACT_FINAL_ROWS = 10_000
# Accuracy (1 / rank error) of the sketches that bracket a quantile.
EXACT_ACCURACY = 10_000


def _ranked(df: DataFrame, c: str):
    """The value to rank; null for null and NaN."""
    v = F.col(_q(c))
    return F.when(~F.isnan(v), v) if _is_fractional(df, c) else v


class _Search:
    """The open interval (lo, hi) that holds the ``k``-th smallest value, with
    the number of values below and in it."""

    def __init__(self, column: str, k: int, n: int):
        self.column, self.k, self.lo, self.hi, self.below, self.inside = column, k, None, None, 0, n
        self.value, self.found = None, False

    def within(self, v):
        """Whether a value is in the interval (null for a null value)."""
        out = v.isNotNull()
        if self.lo is not None:
            out = out & (v > F.lit(self.lo))
        if self.hi is not None:
            out = out & (v < F.lit(self.hi))
        return out

    def narrow(self, x, y, lt: int, eq_x: int, mid: int, eq_y: int) -> None:
        """Given the counts (over the interval) below ``x``, at ``x``, between, and at ``y``."""
        r = self.k - self.below
        if r <= lt:
            self.hi, self.inside = x, lt
        elif r <= lt + eq_x:
            self.value, self.found = x, True
        elif r <= lt + eq_x + mid:
            self.lo, self.hi, self.below, self.inside = x, y, self.below + lt + eq_x, mid
        elif r <= lt + eq_x + mid + eq_y:
            self.value, self.found = y, True
        else:
            gone = lt + eq_x + mid + eq_y
            self.lo, self.below, self.inside = y, self.below + gone, self.inside - gone


def exact_quantiles(df: DataFrame, columns, probs, final_rows: int = EXACT_FINAL_ROWS,
                    accuracy: int = EXACT_ACCURACY) -> dict:
    """Exact discrete quantiles (the ``percentile_disc`` value) without ever
    holding a column's values in one task.

    The value of quantile ``p`` is the ``k = max(1, ceil(p·n))``-th smallest
    non-null, non-NaN value.  A sketch brackets every rank of every column in
    one job; the next job counts around all brackets, which either hits the
    value or leaves an open interval holding a few ten-thousandths of the
    rows; this repeats until every interval holds at most ``final_rows``
    values, and one last job picks them.  Each pass excludes the bracket's
    ends and shrinks by rank, so infinities, wide ranges and heavy ties end
    as well.  Returns ``{column: [value per p]}``; ``None`` for empty columns.
    """
    columns, probs = list(columns), list(probs)
    if not columns or not probs:
        return {c: [] for c in columns}

    def sketch(values, shares):
        return F.percentile_approx(values, shares, accuracy)

    delta = 2.0 / accuracy
    around = [min(1.0, max(0.0, q)) for p in probs for q in (p - delta, p + delta)]
    first = df.agg(*[F.count(_ranked(df, c)).alias(f"n{i}") for i, c in enumerate(columns)],
                   *[sketch(_ranked(df, c), around).alias(f"b{i}") for i, c in enumerate(columns)]).first()
    searches, brackets = [], {}
    for i, c in enumerate(columns):
        for j, p in enumerate(probs):
            n = first[f"n{i}"]
            s = _Search(c, max(1, math.ceil(p * n)), n)
            s.found = not n
            searches.append(s)
            if n:
                brackets[s] = tuple(first[f"b{i}"][2 * j:2 * j + 2])

    while brackets:
        active = list(brackets)
        exprs = []
        for i, s in enumerate(active):
            v, (x, y) = _ranked(df, s.column), map(F.lit, brackets[s])
            here = s.within(v)
            exprs += [F.count_if(here & (v < x)).alias(f"a{i}"), F.count_if(here & (v == x)).alias(f"b{i}"),
                      F.count_if(here & (v > x) & (v < y)).alias(f"c{i}"),
                      F.count_if(here & (v == y) & (y > x)).alias(f"d{i}")]
        row = df.agg(*exprs).first()
        for i, s in enumerate(active):
            s.narrow(*brackets[s], *(row[f"{k}{i}"] for k in "abcd"))
        wide = [s for s in active if not s.found and s.inside > final_rows]
        brackets = {}
        if wide:
            exprs = []
            for i, s in enumerate(wide):
                q, v = (s.k - s.below) / s.inside, _ranked(df, s.column)
                exprs.append(sketch(F.when(s.within(v), v),
                                    [max(0.0, q - delta), min(1.0, q + delta)]).alias(f"b{i}"))
            row = df.agg(*exprs).first()
            brackets = {s: tuple(row[f"b{i}"]) for i, s in enumerate(wide)}

    last = [s for s in searches if not s.found]
    if last:
        exprs = []
        for i, s in enumerate(last):
            v = _ranked(df, s.column)
            # at most ``final_rows`` values each
            exprs.append(F.get(F.sort_array(F.collect_list(F.when(s.within(v), v))), F.lit(s.k - s.below - 1)).alias(f"v{i}"))
        row = df.agg(*exprs).first()
        for i, s in enumerate(last):
            s.value = row[f"v{i}"]
    return {c: [s.value for s in searches[i * len(probs):(i + 1) * len(probs)]] for i, c in enumerate(columns)}


def iqr_bounds(df: DataFrame, columns, factor: float = DEFAULT_FACTOR,
               relative_error: float = DEFAULT_RELATIVE_ERROR,
               exact: bool = False) -> dict[str, Bounds]:
    """Quartiles and IQR bounds of all columns (E5).

    Approximate: one Greenwald–Khanna job for all columns (bounded sketch
    per task).  Exact: :func:`exact_quantiles`.  Empty or all-null columns
    get null bounds (and no outliers).
    """
    columns = list(columns)
    if not columns:
        return {}
    if exact:
        qs = exact_quantiles(df, columns, [0.25, 0.75])
        return {c: Bounds(None if q[0] is None else float(q[0]),
                          None if q[1] is None else float(q[1]), factor) for c, q in qs.items()}
    qs = df.approxQuantile(columns, [0.25, 0.75], relative_error)
    return {c: (Bounds(q[0], q[1], factor) if q else Bounds(None, None, factor))
            for c, q in zip(columns, qs)}


def iqr_bounds_frame(df: DataFrame, columns, factor: float = DEFAULT_FACTOR,
                     exact: bool = True, relative_error: float = DEFAULT_RELATIVE_ERROR) -> DataFrame:
    """IQR bounds as rows ``column_name, q1, q3, iqr, lower_bound, upper_bound`` (E5)."""
    bounds = iqr_bounds(df, columns, factor, relative_error, exact)
    rows = [(c, b.q1, b.q3, b.iqr, b.lower, b.upper) for c, b in bounds.items()]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, q1 double, q3 double, iqr double, lower_bound double, upper_bound double")


# ------------------------------------------------------------- E5, E7 --

def outside(c: str, b: Bounds, nan_is_outlier: bool = True, fractional: bool = True) -> Column:
    """Outlier predicate: below the lower or above the upper bound (C4).

    Spark orders NaN above every number, so NaN counts as an upper outlier
    unless ``nan_is_outlier`` is False.  Null is never an outlier.
    """
    if b.q1 is None:
        return F.lit(False)
    v = F.col(_q(c))
    cond = (v < F.lit(b.lower)) | (v > F.lit(b.upper))
    if fractional and not nan_is_outlier:
        cond = cond & ~F.isnan(v)
    return F.coalesce(cond, F.lit(False))


def inside(c: str, b: Bounds) -> Column:
    """Keep predicate of deletion: inside both bounds; drops null and NaN (C4)."""
    if b.q1 is None:
        return F.lit(True)
    v = F.col(_q(c))
    return (v >= F.lit(b.lower)) & (v <= F.lit(b.upper))


def outlier_report(df: DataFrame, bounds: dict[str, Bounds], nan_is_outlier: bool = True) -> DataFrame:
    """Outlier count per column in one aggregate.

    Rows ``column_name, n_outliers, lower_bound, upper_bound``; the bounds
    are literals, so the report is the single aggregate and nothing else.
    """
    cols = list(bounds)
    if not cols:
        return _empty_report(df)
    wide = df.agg(*[F.count_if(outside(c, bounds[c], nan_is_outlier, _is_fractional(df, c))).alias(f"c{i}")
                    for i, c in enumerate(cols)])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("n_outliers"),
                     F.lit(bounds[c].lower).cast("double").alias("lower_bound"),
                     F.lit(bounds[c].upper).cast("double").alias("upper_bound"))
            for i, c in enumerate(cols)]
    return wide.select(F.inline(F.array(*rows)))


def _empty_report(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [], "column_name string, n_outliers long, lower_bound double, upper_bound double")


def outlier_rows(df: DataFrame, bounds: dict[str, Bounds], nan_is_outlier: bool = True,
                 column_name: str = "outlier_column") -> DataFrame:
    """All outlier rows of all columns in one scan, tagged with the column (E5).

    A row that is an outlier in k columns appears k times.
    """
    tags = [F.when(outside(c, b, nan_is_outlier, _is_fractional(df, c)), F.lit(c))
            for c, b in bounds.items()]
    if not tags:
        return df.withColumn(column_name, F.lit(None).cast("string")).limit(0)
    return df.withColumn(column_name, F.explode(F.array_compact(F.array(*tags))))


# ------------------------------------------------------------------ E6 --

def iqr_delete(df: DataFrame, columns, factor: float = DEFAULT_FACTOR,
               relative_error: float = DEFAULT_RELATIVE_ERROR, exact: bool = False,
               checkpoint_each: bool = False, factors: dict | None = None):
    """Sequential IQR deletion.

    Each column's bounds are computed on the rows that survived the previous
    columns, so k columns need k quantile jobs.  The bounds become literal
    filters that push down into the scan; ``checkpoint_each`` cuts the
    lineage after every pass (into the shared checkpoint folder) when the
    input plan is expensive to recompute.  Returns ``(frame, bounds)``.
    """
    applied: dict[str, Bounds] = {}
    current = df
    for c in columns:
        f = (factors or {}).get(c, factor)
        b = iqr_bounds(current, [c], f, relative_error, exact)[c]
        applied[c] = b
        current = current.filter(inside(c, b))
        if checkpoint_each:
            current = cut_lineage(current)
    return current, applied


def treat_outliers(df: DataFrame, columns, factor: float = DEFAULT_FACTOR,
                   delete: bool = False, relative_error: float = DEFAULT_RELATIVE_ERROR,
                   exact: bool = False):
    """Audit (default) or delete outliers; returns ``(frame, bounds, report)``."""
    if delete:
        kept, bounds = iqr_delete(df, columns, factor, relative_error, exact)
        return kept, bounds, sequential_report(df, bounds)
    bounds = iqr_bounds(df, columns, factor, relative_error, exact)
    return df, bounds, outlier_report(df, bounds)


def sequential_report(df: DataFrame, bounds: dict[str, Bounds]) -> DataFrame:
    """Outlier counts of a sequential deletion, in one pass over the input.

    Column i counts its outliers among the rows kept by columns 1..i-1,
    which is what each deletion pass saw.
    """
    cols = list(bounds)
    if not cols:
        return _empty_report(df).select("column_name", "n_outliers")
    exprs, kept = [], F.lit(True)
    for i, c in enumerate(cols):
        exprs.append(F.count_if(kept & outside(c, bounds[c], True, _is_fractional(df, c))).alias(f"c{i}"))
        kept = kept & inside(c, bounds[c])
    return _to_long(df.agg(*exprs), cols, "n_outliers")


# names of the operator inventory
iqr_outliers = outlier_rows       # E5: the outlier rows of every column, tagged
