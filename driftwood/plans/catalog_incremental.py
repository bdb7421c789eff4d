"""Registered queries of what grows with its batches: profiles, indexes, the
schema ledger, reconciliation; and of trained values against closed forms.

Like those of :mod:`driftwood.plans.catalog`, each reads whole driver tables
and has a SQL twin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwood.operators import matching as mt
from driftwood.operators import quality as qa
from driftwood.operators import star as st
from driftwood.plans.catalog import (DIM_LOCATION_SQL, FACT_INCOME_SQL, FUZZY_SQL, ORACLE, RECONCILE_OVERRIDES, T,
                                     _bounds_sql, _station_drops, _year_range, _years, dim_location_frame,
                                     fact_income_frame, part_names, query)
from driftwood.session import scratch_path

# ------------------------------------------------------------------------
# Profiles from merged sketches
# ------------------------------------------------------------------------

PROFILED = ["value", "user_id", "event_id"]


@query("profile_incremental", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, count(DISTINCT {c}) > 10 AS continuous, "
    f"true AS distinct_within, true AS q1_within, true AS q3_within FROM events" for c in PROFILED))
def q_profile_incremental(spark, sf):
    """Events profiled by day in two batches: the merged sketches against the
    exact distinct counts and ranks of all rows, within their stated errors."""
    from driftwood.operators import profile as pr
    ev = T(spark, sf, "events").withColumn("day", F.date_format("ts", "yyyy_MM_dd"))
    path = scratch_path(spark, "profile")
    days = sorted(r[0] for r in ev.select("day").distinct().collect())       # bounded by the calendar
    last = days[len(days) * 2 // 3]
    for batch in (ev.where(F.col("day") <= last), ev.where(F.col("day") > last)):
        pr.update_profile(spark, path, batch, "day", PROFILED)
    merged = {r["column_name"]: r for r in pr.merged_profile(pr.stored_profile(spark, path, "day")).collect()}    # a row per column
    exact = ev.agg(*[F.struct(F.count_distinct(c).alias("distinct"),
                              *[F.struct(F.count_if(F.col(c) < merged[c][q]).alias("below"), F.count_if(F.col(c) <= merged[c][q]).alias("upto"))
                                .alias(q) for q in ("q1", "q3")], F.count(c).alias("n")).alias(c) for c in PROFILED])

    def within(c: str, q: str, p: float):
        e = F.col(f"{c}.{q}")
        n = F.col(f"{c}.n")
        return (e["below"] <= (p + pr.RANK_ERROR) * n) & (e["upto"] >= (p - pr.RANK_ERROR) * n)

    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(m["n_rows"]).alias("n_rows"), F.lit(m["n_null"]).alias("n_null"),
                     F.lit(m["n_distinct"] > 10).alias("continuous"),
                     (F.abs(F.col(f"{c}.distinct") - m["n_distinct"]) <= pr.DISTINCT_ERROR * F.col(f"{c}.distinct")).alias("distinct_within"),
                     within(c, "q1", 0.25).alias("q1_within"), within(c, "q3", 0.75).alias("q3_within"))
            for c, m in sorted(merged.items())]
    return exact.select(F.inline(F.array(*rows)))


# ------------------------------------------------------------------------
# M5, M6: string index as a table
# ------------------------------------------------------------------------

@query("string_index_ranked", """
WITH k AS (SELECT CAST(l_partkey AS VARCHAR) AS value, count(*) AS n FROM lineitem WHERE l_linenumber <> 2 GROUP BY 1),
i AS (SELECT value, CAST(row_number() OVER (ORDER BY n DESC, value) - 1 AS DOUBLE) AS part_index FROM k)
SELECT l_orderkey, l_linenumber, part_index FROM lineitem JOIN i ON value = CAST(l_partkey AS VARCHAR)""")
def q_string_index_ranked(spark, sf):
    """Part keys indexed by their frequency on some rows, joined to all rows;
    keys that those rows lack are skipped."""
    from driftwood.operators.indexing import frequency_index, index_column
    li = T(spark, sf, "lineitem")
    index = frequency_index(li.where("l_linenumber <> 2"), "l_partkey")
    return index_column(li.select("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey", index, "part_index") \
        .select("l_orderkey", "l_linenumber", "part_index")


# ------------------------------------------------------------------------
# D3: length and positional filters
# ------------------------------------------------------------------------

@query("fuzzy_bounds", f"""
WITH f AS ({FUZZY_SQL})
SELECT count(*) AS n_pairs, true AS complete, true AS fewer FROM (SELECT DISTINCT p_name, candidate FROM f)""")
def q_fuzzy_bounds(spark, sf):
    """Pairs that are looked at with the bounds on sizes and positions: all
    similar pairs are among them, and there are fewer than by prefixes alone."""
    left, right = part_names(spark, sf)
    left, right = left.select(F.col("p_name").alias("l_name")), right.select(F.col("candidate").alias("r_name"))
    similar = mt.fuzzy_name_pairs(left, right, 0.3).select("l_name", "r_name")
    bounded, prefix = (mt.fuzzy_candidates(left, right, 0.3, bounds=b) for b in (True, False))
    sides = similar.withColumn("kind", F.lit(0)).unionByName(bounded.withColumn("kind", F.lit(1))) \
        .unionByName(prefix.withColumn("kind", F.lit(2)))
    per = sides.groupBy("l_name", "r_name").agg(F.collect_set("kind").alias("kinds"))
    has = [F.array_contains("kinds", F.lit(k)) for k in range(3)]
    return per.agg(F.count_if(has[0]).alias("n_pairs"), (F.count_if(has[0] & ~has[1]) == 0).alias("complete"),
                   (F.count_if(has[1]) < F.count_if(has[2])).alias("fewer"))


# ------------------------------------------------------------------------
# Schema ledger
# ------------------------------------------------------------------------

@query("ledger_reports", """
WITH y AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders), m AS (SELECT max(y) AS last FROM y)
SELECT 'missing' AS report, 'o_orderpriority' AS column_name, CAST(y AS VARCHAR) AS detail, 1 AS n FROM y WHERE y % 2 = 1
UNION ALL SELECT 'type', 'o_totalprice', 'double', count(*) FROM y WHERE y <> 1996 HAVING (SELECT count(*) FROM y WHERE y = 1996) > 0
UNION ALL SELECT 'type', 'o_totalprice', 'string', count(*) FROM y WHERE y = 1996 HAVING count(*) > 0
UNION ALL SELECT 'opened', '-', CAST(last AS VARCHAR), 1 FROM m""")
def q_ledger_reports(spark, sf):
    """Yearly drops, the last one arriving later: the second run opens that drop
    only, and the reports come from the ledger."""
    from driftwood.plans.jobs import list_files
    from driftwood.sources.files import key_of_name
    from driftwood.sources.ledger import ledger_missing_columns, ledger_type_conflicts, update_ledger
    from driftwood.sources.sinks import read_stored, write_table
    orders = T(spark, sf, "orders")
    root, ledger = scratch_path(spark, "ledger-drops"), scratch_path(spark, "ledger")
    years, opened = _years(orders, "o_orderdate"), []
    for wave in (years[:-1], years[-1:]):
        for y in wave:
            f = orders.where(_year_range("o_orderdate", y))
            f = f.drop("o_orderpriority") if y % 2 else f
            f = f.withColumn("o_totalprice", F.col("o_totalprice").cast("string")) if y == 1996 else f
            write_table(f.toDF(*[c.upper() for c in f.columns]), f"{root}/{y}_orders.parquet")
        opened = update_ledger(spark, ledger, list_files(spark, root, 4), 4)["opened"]
    table = read_stored(spark, ledger)
    one = F.lit(1).cast("long").alias("n")
    missing = ledger_missing_columns(table).select(F.lit("missing").alias("report"), "column_name", F.col("frame_key").alias("detail"), one)
    types = ledger_type_conflicts(table).select(F.lit("type").alias("report"), "column_name", F.col("data_type").alias("detail"),
                                                F.col("n_frames").alias("n"))
    read = spark.createDataFrame([("opened", "-", key_of_name(p, 4), 1) for p in opened], "report string, column_name string, detail string, n long")
    return missing.unionByName(types).unionByName(read)


# ------------------------------------------------------------------------
# J6 in batches
# ------------------------------------------------------------------------

@query("job_reconcile_incremental", ORACLE["job_reconcile"])
def q_job_reconcile_incremental(spark, sf):
    """J6 in three batches, new names first and new lookup rows after: equal to
    one run over everything."""
    from driftwood.plans.jobs import ReconcileConfig, reconcile_incremental
    part = T(spark, sf, "part")
    words = F.split("p_name", " ")
    lookup = part.where(F.col("p_type") == "SMALL").select(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_size") <= 25, F.col("p_name"))
         .otherwise(F.concat(F.get(words, 1), F.lit(" "), F.get(words, 0))).alias("reconciled_name"))
    overrides = spark.createDataFrame(RECONCILE_OVERRIDES, "p_name string, id long, reconciled_name string, similarity double")
    cfg = ReconcileConfig(name_col="p_name", lookup_name_col="reconciled_name", lookup_id_col="id",
                          row_filter="p_type = 'ECONOMY'", threshold=0.3, overrides=overrides)
    state, odd = scratch_path(spark, "reconcile-state"), F.col("p_partkey") % 2 == 1
    early = F.col("id") % 3 > 0
    reconcile_incremental(spark, state, part.where(odd), lookup.where(early), cfg)
    reconcile_incremental(spark, state, part.where(~odd), lookup.limit(0), cfg)
    return reconcile_incremental(spark, state, part.limit(0), lookup.where(~early), cfg)[0]


# ------------------------------------------------------------------------
# Values against closed forms
# ------------------------------------------------------------------------

REG, MIX = 5000.0, 0.8


def _closed_form_sql(mean_of: str) -> str:
    """Elastic net of one feature: the slope of standardized values is the
    correlation, soft-thresholded and shrunk."""
    return f"""
h AS (SELECT *, md5(CAST(l_orderkey AS VARCHAR) || chr(1) || CAST(l_linenumber AS VARCHAR)) AS h,
             CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS x0 FROM lineitem),
s AS (SELECT *, CASE WHEN (instr('0123456789abcdef', substr(h, 1, 1)) - 1) * 16
                        + (instr('0123456789abcdef', substr(h, 2, 1)) - 1) < 205 THEN 'train' ELSE 'test' END AS split FROM h),
m AS (SELECT avg(x0) AS mean FROM s WHERE {mean_of}),
d AS (SELECT l_orderkey, l_linenumber, split, coalesce(x0, mean) AS x, l_extendedprice AS y FROM s, m),
t AS (SELECT corr(x, y) AS r, stddev_pop(x) AS sx, stddev_pop(y) AS sy, avg(x) AS mx, avg(y) AS my FROM d WHERE split = 'train'),
c AS (SELECT sign(r) * greatest(abs(r) - {MIX} * {REG} / sy, 0) / (1 + (1 - {MIX}) * {REG} / sy) * sy / sx AS w, mx, my FROM t),
p AS (SELECT d.*, my + w * (x - mx) AS prediction FROM d, c)"""


def _one_feature(spark, sf) -> DataFrame:
    x = F.when(F.col("l_linenumber") != 3, F.col("l_quantity"))
    return T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", x.alias("x"), F.col("l_extendedprice").alias("y"))


KEYS = ["l_orderkey", "l_linenumber"]


@query("elastic_net_closed_form", f"""
WITH {_closed_form_sql("split = 'train'")}
SELECT l_orderkey, l_linenumber, round(prediction, 1) AS prediction FROM p""")
def q_elastic_net_closed_form(spark, sf):
    """One feature with nulls, imputed and fitted on the training
    rows; stored, loaded and scored."""
    from driftwood.plans.jobs import predict_job, train_job
    data, models = _one_feature(spark, sf), scratch_path(spark, "closed-form")
    train_job(data, "y", models, "price", 1, exclude=KEYS, split_keys=KEYS, passthrough=KEYS, reg_param=REG, elastic_net=MIX,
              max_iter=100, tol=1e-12)
    return predict_job(data, models, "price", 1).select(*KEYS, F.round("prediction", 1).alias("prediction"))


@query("train_metrics_closed_form", f"""
WITH {_closed_form_sql("true")}
SELECT split, count(*) AS n, round(sqrt(avg((y - prediction) ^ 2)), 3) AS rmse,
       round(1 - sum((y - prediction) ^ 2) / (var_pop(y) * count(*)), 6) AS r2 FROM p GROUP BY split""")
def q_train_metrics_closed_form(spark, sf):
    """M8 in the old order: features fitted on all rows, the regression on the
    training rows; M11 on both splits."""
    from driftwood.operators.features import train
    _, _, metrics = train(_one_feature(spark, sf), "y", exclude=KEYS, split_keys=KEYS, passthrough=KEYS, fit_on_all=True,
                          reg_param=REG, elastic_net=MIX, max_iter=100, tol=1e-12)
    return metrics.select("split", "n", F.round("rmse", 3).alias("rmse"), F.round("r2", 6).alias("r2"))


# ------------------------------------------------------------------------
# Products that other queries leave out
# ------------------------------------------------------------------------

@query("stored_table", "SELECT n_nationkey, n_name, (SELECT least(count(*), 20) FROM nation) AS n_preview FROM nation")
def q_stored_table(spark, sf):
    """A stored table by its path, and how many rows a preview shows."""
    from driftwood.sources.files import preview, read_table
    from driftwood.sources.sinks import write_table
    stored = read_table(spark, write_table(T(spark, sf, "nation"), scratch_path(spark, "nation")))
    return stored.select("n_nationkey", "n_name", F.lit(preview(stored).count()).cast("long").alias("n_preview"))


@query("histogram_special", """
WITH v AS (SELECT CASE WHEN event_id % 7 = 0 THEN 'nan'::DOUBLE WHEN event_id % 11 = 0 THEN 'inf'::DOUBLE
                       WHEN event_id % 13 = 0 THEN '-inf'::DOUBLE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS value FROM events),
f AS (SELECT value FROM v WHERE value IS NOT NULL AND NOT isnan(value) AND NOT isinf(value)),
e AS (SELECT min(value) AS lo, max(value) AS hi FROM f)
SELECT 'value' AS column_name, CAST(least(floor((value - lo) / (CASE WHEN hi = lo THEN 1.0 ELSE hi - lo END) * 20), 19) AS INTEGER) AS bin,
       count(*) AS n FROM f, e GROUP BY ALL""")
def q_histogram_special(spark, sf):
    """E10 on a column with NaN, both infinities and nulls: they are in no bin."""
    k = F.col("event_id")
    value = F.when(k % 7 == 0, float("nan")).when(k % 11 == 0, float("inf")).when(k % 13 == 0, float("-inf")) \
        .when(k % 17 != 0, F.col("value"))
    return qa.histogram(T(spark, sf, "events").select(value.alias("value")), ["value"], 20)


@query("kpi_balance_by_region", f"""
SELECT r_name, round(avg(balance), 6) AS avg_balance
FROM ({FACT_INCOME_SQL}) i JOIN ({DIM_LOCATION_SQL}) l ON i.location_id = l.n_name GROUP BY r_name""")
def q_kpi_balance_by_region(spark, sf):
    """E14 by its own operator."""
    out = st.kpi_by_dimension(fact_income_frame(spark, sf), dim_location_frame(spark, sf), "location_id", "n_name", ["r_name"], ["balance"])
    return out.select("r_name", F.round("avg_balance", 6).alias("avg_balance"))


@query("job_year_separate", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 2018 AS year FROM supplier WHERE s_nationkey < 5")
def q_job_year_separate(spark, sf):
    """The table that the 2018 drop is loaded to."""
    from driftwood.plans.jobs import SourceConfig, format_and_load
    target = scratch_path(spark, "stations")
    done = format_and_load(spark, SourceConfig(root=_station_drops(spark, sf), target=target, keys=["s_suppkey", "year"], key_len=4,
                                               key_col="year", key_type="int", separate_keys=["2018"]))
    return spark.read.parquet(done["2018"]["target"])


_ORDER_BOUNDS = _bounds_sql("orders", "o_totalprice", 0.2)


@query("job_outlier_products", f"""
WITH b AS ({_ORDER_BOUNDS})
SELECT 'report' AS product, 'o_totalprice' AS column_name, count(*) AS n FROM orders, b
WHERE o_totalprice < b.lower_bound OR o_totalprice > b.upper_bound
UNION ALL SELECT 'csv', 'o_totalprice', count(*) FROM orders, b WHERE o_totalprice < b.lower_bound OR o_totalprice > b.upper_bound
UNION ALL SELECT 'missing', 'o_orderpriority', count(DISTINCT year(o_orderdate)) FROM orders WHERE year(o_orderdate) % 2 = 1""")
def q_job_outlier_products(spark, sf):
    """The outlier report, the CSV rows and the missing-column report of a load."""
    from driftwood.plans.jobs import SourceConfig, format_and_load
    from driftwood.sources.sinks import write_table
    orders = T(spark, sf, "orders")
    root, csv = scratch_path(spark, "audited-drops"), scratch_path(spark, "audited-rows")
    for y in _years(orders, "o_orderdate"):
        f = orders.where(_year_range("o_orderdate", y))
        write_table(f.drop("o_orderpriority") if y % 2 else f, f"{root}/{y}_orders.parquet")
    done = format_and_load(spark, SourceConfig(
        root=root, target=scratch_path(spark, "audited"), keys=["o_orderkey", "year"], key_len=4, key_col="year", outliers=True,
        outlier_exclude=["o_orderkey", "o_custkey"], factor=0.2, relative_error=0.0, report_dir=csv, partition_by="year",
        ledger=scratch_path(spark, "audited-ledger")))
    report = done["main"]["report"].select(F.lit("report").alias("product"), "column_name", F.col("n_outliers").alias("n"))
    rows = spark.read.option("header", "true").csv(csv).groupBy(F.col("outlier_column").alias("column_name")) \
        .agg(F.count(F.lit(1)).alias("n")).select(F.lit("csv").alias("product"), "column_name", "n")
    missing = done["missing_columns"].groupBy("column_name").agg(F.count(F.lit(1)).alias("n")) \
        .select(F.lit("missing").alias("product"), "column_name", "n")
    return report.unionByName(rows).unionByName(missing)
