"""Column profiles that grow with the batches.

:func:`driftwood.operators.outliers.continuous_columns` and ``iqr_bounds``
read all rows.  Here the distinct counts and quartiles of every period are
kept as mergeable sketches (HyperLogLog and KLL), a few kilobytes per period
and column: a daily batch reads its own rows only, and the profile of the
whole table is a merge of the stored sketches.

Stated errors: distinct counts of more than a few values are within 5 %
(three deviations of 2 ** ``LG_K`` registers), quartiles are values whose rank
is within ``RANK_ERROR`` of the wanted one.  Null, NaN and infinite values
are in no quantile; null is no distinct value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwood.operators.outliers import DEFAULT_FACTOR, Bounds
from driftwood.sources.sinks import read_stored, replace_periods, table_exists

LG_K = 12
DISTINCT_ERROR = 0.05
KLL_K = 400
RANK_ERROR = 0.02


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _finite(c: str) -> Column:
    v = F.col(_q(c)).cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)


def column_sketches(df: DataFrame, period: str, columns) -> DataFrame:
    """One row per period and column: ``n_rows``, ``n_null``, ``n_values``
    (finite ones) and the two sketches.  One aggregate over the batch."""
    columns = list(columns)
    per = df.groupBy(F.col(_q(period)).alias(period)).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.struct(F.count_if(F.col(_q(c)).isNull()).alias("n_null"), F.count(_finite(c)).alias("n_values"),
                   F.hll_sketch_agg(F.when(F.col(_q(c)).isNotNull(), F.xxhash64(F.col(_q(c)))), F.lit(LG_K)).alias("distinct_sketch"),
                   F.kll_sketch_agg_double(_finite(c), F.lit(KLL_K)).alias("quantile_sketch")).alias(f"c{i}")
          for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}.n_null").alias("n_null"),
                              F.col(f"c{i}.n_values").alias("n_values"), F.col(f"c{i}.distinct_sketch").alias("distinct_sketch"),
                              F.col(f"c{i}.quantile_sketch").alias("quantile_sketch")) for i, c in enumerate(columns)])
    return per.select(F.col(_q(period)), "n_rows", F.explode(rows).alias("r")).select(F.col(_q(period)), "n_rows", "r.*")


def _merge(profile: DataFrame, by) -> DataFrame:
    return profile.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"), F.sum("n_values").alias("n_values"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"))


def update_profile(spark: SparkSession, path: str, batch: DataFrame, period: str, columns) -> str:
    """Add a batch to the stored profile: its own rows are read once, and of
    the profile only the periods it touches."""
    fresh = column_sketches(batch, period, columns)
    kind = batch.schema[period].dataType
    if table_exists(spark, path):
        touched = batch.select(F.col(_q(period)).alias("_dw_period")).distinct()        # bounded by the periods of a batch
        old = read_stored(spark, path, "parquet", period, kind) \
            .join(touched, F.col(_q(period)).eqNullSafe(F.col("_dw_period")), "left_semi")
        fresh = _merge(old.unionByName(fresh), [period, "column_name"])
    return replace_periods(spark, path, fresh, period)


def stored_profile(spark: SparkSession, path: str, period: str, period_type=None) -> DataFrame:
    return read_stored(spark, path, "parquet", period, period_type or T.StringType())


def merged_profile(profile: DataFrame) -> DataFrame:
    """Per column over all periods: ``n_rows``, ``n_null``, ``n_distinct``
    (estimate), ``q1`` and ``q3`` (null without finite values)."""
    merged = _merge(profile, ["column_name"])

    def quantile(p: float) -> Column:
        return F.when(F.col("n_values") > 0, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(p)))

    return merged.select("column_name", "n_rows", "n_null", F.hll_sketch_estimate("distinct_sketch").alias("n_distinct"),
                         quantile(0.25).alias("q1"), quantile(0.75).alias("q3"))


def profile_bounds(profile: DataFrame, factor: float = DEFAULT_FACTOR, distinct_threshold: int = 10) -> dict[str, Bounds]:
    """IQR bounds (E5) of the columns that are continuous (E4: more distinct
    values than the threshold), from the merged sketches; a row per column."""
    rows = merged_profile(profile).where(F.col("n_distinct") > distinct_threshold).collect()
    return {r["column_name"]: Bounds(r["q1"], r["q3"], factor) for r in sorted(rows, key=lambda r: r["column_name"])}
