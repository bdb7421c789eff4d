"""Measure how a hot key spreads over reduce tasks.

Usage: python tools/skew_check.py [sf_dir]
Runs each operator form on lineitem where a third of all rows share one key
and reads Spark's event log (written to a fresh scratch folder) to report,
per form, the largest number of shuffle records a single task read.  A
skew-safe form keeps that number near (rows / tasks); a form that sends a
whole key to one task shows the hot key's row count.  (Spark 3.5+ rewrites
``row_number() ... = 1`` with a map-side window group limit, so that form
is pre-reduced too; a window without such a filter is not.)
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from driftwood.operators import dedupe as dd  # noqa: E402
from driftwood.operators import quality as qa  # noqa: E402
from driftwood.session import get_spark  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-skew-")
    spark = get_spark("local[8]", shuffle_partitions=16,
                      conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                            "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false",
                            "spark.sql.adaptive.enabled": "false", "spark.driver.memory": "8g",
                            # large inputs: candidate joins are shuffle joins, as on a cluster
                            "spark.sql.autoBroadcastJoinThreshold": "-1"})
    sc = spark.sparkContext
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    hot = li.withColumn("l_orderkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey"))) \
        .withColumn("l_linenumber", F.when(F.col("l_orderkey") == 0, F.lit(1)).otherwise(F.col("l_linenumber")))
    keys = ["l_orderkey", "l_linenumber"]
    rest = [c for c in li.columns if c not in keys]
    forms = {
        "window_without_group_limit": lambda: hot.withColumn(
            "_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*rest))),
        "dedupe_window_row_number": lambda: hot.withColumn(
            "_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*rest))).where("_rn = 1"),
        "dedupe_here": lambda: dd.dedupe(hot, keys),
        "pk_check_groupby_count": lambda: qa.check_pk(hot, keys),
    }
    # fuzzy join where every name shares one token ("de"): all pairs qualify
    from driftwood.operators import matching as mt
    names = (li.where(F.col("l_orderkey") % 100 == 0)
             .select(F.concat(F.lit("de "), F.col("l_orderkey").cast("string")).alias("n"))
             .distinct().repartition(16))
    lnames = names.select(F.col("n").alias("l_name"))
    rnames = names.select(F.concat(F.col("n"), F.lit("x")).alias("r_name"))
    forms["fuzzy_hot_token_unsalted"] = lambda: mt.fuzzy_name_pairs(lnames, rnames, 0.3, hot_token_rows=10 ** 12)
    forms["fuzzy_hot_token_salted"] = lambda: mt.fuzzy_name_pairs(lnames, rnames, 0.3, hot_token_rows=100)
    n_hot = hot.where("l_orderkey = 0").count()
    for name, fn in forms.items():
        sc.setJobGroup(name, name)
        fn().write.format("noop").mode("overwrite").save()
    sc.setLocalProperty("spark.jobGroup.id", None)
    spark.stop()
    stage_group, reads = {}, {}
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    r = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    info = ev.get("Task Info") or {}
                    ms = info.get("Finish Time", 0) - info.get("Launch Time", 0)
                    reads.setdefault(ev["Stage ID"], []).append((r, ms))
    result = {"hot_key_rows": n_hot}
    for name in forms:
        per_task = [r for sid, rs in reads.items() if stage_group.get(sid) == name for r in rs]
        result[name] = {"max_shuffle_records_per_task": max([r for r, _ in per_task] or [0]),
                        "total_shuffle_records": sum(r for r, _ in per_task),
                        "max_task_ms": max([t for _, t in per_task] or [0]),
                        "total_task_ms": sum(t for _, t in per_task)}
    print(json.dumps(result))


if __name__ == "__main__":
    main()
