"""Star schema: dimensions, facts, star and drill-across queries, KPIs
(F1–F6, D8, D9, B17, E11–E14).

Dimension members are collected with distributed set unions (no driver
collect).  Dimensions are joined with a broadcast only after a bounded row
count proves them small; facts of different grain are aggregated to the
shared dimension grain *before* they meet, so the join never fans out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwood.functions.keys import key_part, key_to_date, month_of_day
from driftwood.operators.frames import union_frames
from driftwood.operators.matching import bounded_broadcast, lookup_fallback


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# ---------------------------------------------------------- F1 .. F4 --

def dim_year(*year_columns: DataFrame) -> DataFrame:
    """Distinct non-null years of several sources, as text.

    Each input is a one-column frame; years are cast to string first so an
    integer year and a year split from a text key are the same member.
    """
    parts = [df.select(F.col(_q(df.columns[0])).cast("string").alias("year")) for df in year_columns]
    return union_frames(parts).where(F.col("year").isNotNull()).distinct()


def dim_month(days: DataFrame, months: DataFrame, day_col: str = "day",
              month_col: str = "month") -> DataFrame:
    """Months of a daily source ∪ months of a monthly source, with parent year (F2)."""
    from_days = days.select(month_of_day(_q(day_col)).alias("month"))
    from_months = months.select(F.col(_q(month_col)).alias("month"))
    members = union_frames([from_days, from_months]).where(F.col("month").isNotNull()).distinct()
    return members.select("month", key_part("month", 0).alias("year"))


def dim_day(days: DataFrame, day_col: str = "day") -> DataFrame:
    """Distinct days with parent month."""
    return (days.select(F.col(_q(day_col)).alias("day")).where(F.col("day").isNotNull()).distinct()
            .select("day", month_of_day("day").alias("month")))


def dim_location(lookup: DataFrame, drop=()) -> DataFrame:
    """Location dimension: the lookup minus technical columns."""
    return lookup.drop(*drop)


# -------------------------------------------------------------- F5, F6 --

def fact_from_lookup(df: DataFrame, lookup: DataFrame, on: str, lookup_key: str,
                     columns: dict, drop_unresolved: str | None = None) -> DataFrame:
    """Left lookup → project/rename → distinct.

    ``columns`` maps source column → fact column.  ``drop_unresolved`` names
    a fact column whose null rows are removed (T10: optional in both facts).
    """
    lk = bounded_broadcast(lookup)
    joined = df.join(lk, F.col(_q(on)) == lk[_q(lookup_key)], "left")
    fact = joined.select(*[F.col(_q(s)).alias(d) for s, d in columns.items()]).distinct()
    if drop_unresolved:
        fact = fact.where(F.col(_q(drop_unresolved)).isNotNull())
    return fact


def fact_with_fallback(df: DataFrame, on: str, lookups, id_col: str, columns: dict,
                       row_filter: Column | None = None, drop_unresolved: bool = True) -> DataFrame:
    """Filter → lookup → fallback lookup → project → distinct → drop unresolved."""
    src = df.where(row_filter) if row_filter is not None else df
    resolved = lookup_fallback(src, on, lookups, id_col)
    fact = resolved.select(*[F.col(_q(s)).alias(d) for s, d in columns.items()]).distinct()
    if drop_unresolved:
        fact = fact.where(F.col(_q(id_col)).isNotNull())
    return fact


# ------------------------------------------------------------- D8, D9 --

def star_join(fact: DataFrame, dims) -> DataFrame:
    """Inner joins of a fact with dimensions on unique keys.

    ``dims`` is a list of ``(dim_df, fact_key, dim_key)``; a dimension may
    join a column brought in by an earlier dimension (day → month → year).
    Dimension attributes whose name is already taken get a ``_<dim_key>``
    suffix.  Nothing runs while the plan is built: a dimension that is a
    small scan is broadcast, and of a derived one adaptive execution sees the
    size once it is computed.
    """
    out = fact
    for dim, fk, dk in (entry[:3] for entry in dims):
        taken = set(out.columns)
        d = dim.select(F.col(_q(dk)).alias("_dim_key"),
                       *[F.col(_q(c)).alias(f"{c}_{dk}" if c in taken else c)
                         for c in dim.columns if c != dk])
        out = out.join(bounded_broadcast(d), F.col(_q(fk)) == F.col("_dim_key"), "inner").drop("_dim_key")
    return out


def drill_across(f1: DataFrame, f2: DataFrame, keys, aggs1, aggs2, how: str = "full") -> DataFrame:
    """Two facts of different grain meeting at a shared dimension.

    Each fact is aggregated to the dimension grain first, then the two
    aggregates are joined on the dimension keys.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    a = f1.groupBy(*keys).agg(*aggs1)
    b = f2.groupBy(*keys).agg(*aggs2)
    return a.join(b, keys, how)


# ------------------------------------------------------------ E11–E14 --

def kpi_per_row(fact: DataFrame, row_id: Column, avgs, sums) -> DataFrame:
    """Averages and sums per row identifier."""
    return fact.groupBy(row_id.alias("row_id")).agg(
        *[F.avg(_q(c)).alias(f"avg_{c}") for c in avgs],
        *[F.sum(_q(c)).alias(f"sum_{c}") for c in sums])


def kpi_rows_per_day(fact: DataFrame, day_col: str = "day", fmt: str = "yyyy_MM_dd") -> DataFrame:
    """Fact rows per calendar day of a text day key."""
    return fact.groupBy(key_to_date(_q(day_col), fmt).alias("date")).agg(
        F.count(F.lit(1)).alias("n_rows"))


def kpi_by_dimension(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                     group_by, avgs) -> DataFrame:
    """Averages of fact measures per dimension attributes."""
    joined = star_join(fact, [(dim, fact_key, dim_key)])
    return joined.groupBy(*group_by).agg(*[F.avg(_q(c)).alias(f"avg_{c}") for c in avgs])
