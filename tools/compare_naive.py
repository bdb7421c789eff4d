"""Naive (reference-shaped) against single-pass forms of the same operators.

Usage: python tools/compare_naive.py [sf_dir]
Prints one JSON line of timings.  The naive forms repeat the reference's
structure with native expressions: one job per column for detection,
quartiles and counts, and a sorted window for keyed dedupe.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from driftwood.operators import dedupe as dd  # noqa: E402
from driftwood.operators import outliers as ol  # noqa: E402
from driftwood.session import get_spark  # noqa: E402


def timed(fn):
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 3)


def naive_audit(df, cols, factor):
    kept = [c for c in cols if df.select(F.approx_count_distinct(c)).first()[0] > 10]
    for c in kept:
        q1, q3 = df.approxQuantile(c, [0.25, 0.75], 0.01)
        lo, hi = q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)
        df.filter((F.col(c) < lo) | (F.col(c) > hi)).count()


def single_audit(df, cols, factor):
    kept = ol.continuous_columns(df, 10)
    ol.outlier_report(df, ol.iqr_bounds(df, kept, factor)).collect()


def naive_dedupe(df, keys):
    rest = [c for c in df.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*rest)
    df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn") \
        .write.format("noop").mode("overwrite").save()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", shuffle_partitions=16, conf={"spark.driver.memory": "16g"})
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    cols = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    keys = ["l_orderkey", "l_linenumber"]
    num = li.select(*cols)
    # a hot key: a third of all rows share one order key
    hot = li.withColumn("l_orderkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey")))
    runs = {
        "audit_naive_per_column": lambda: naive_audit(num, cols, 3.0),
        "audit_single_pass": lambda: single_audit(num, cols, 3.0),
        "dedupe_window": lambda: naive_dedupe(li, keys),
        "dedupe_partial_min_struct": lambda: dd.dedupe(li, keys).write.format("noop").mode("overwrite").save(),
        "dedupe_hot_key_window": lambda: naive_dedupe(hot, keys),
        "dedupe_hot_key_partial_min_struct":
            lambda: dd.dedupe(hot, keys).write.format("noop").mode("overwrite").save(),
    }
    for fn in runs.values():  # warm-up: JIT and codegen caches for every form
        fn()
    # best of three, alternating the forms
    best = {name: min(timed(fn) for _ in range(3)) for name, fn in runs.items()}
    out = best
    print(json.dumps({"sf": sf, **out}))
    spark.stop()


if __name__ == "__main__":
    main()
