"""Registered queries of partitioned, counted and checked loads.

Like those of :mod:`driftwood.plans.catalog`, each reads whole driver tables
and has a SQL twin.
"""

from __future__ import annotations

from collections import OrderedDict

from pyspark.sql import functions as F

from driftwood.operators import star as st
from driftwood.plans.catalog import (DIM_DAY_SQL, DIM_LOCATION_SQL, FACT_LISTING_SQL, T, _station_drops,
                                     days_frame, dim_location_frame, fact_listing_frame, query)
from driftwood.session import scratch_path

# ------------------------------------------------------------------------
# A4, A5: clustered writes
# ------------------------------------------------------------------------

# rows per file of the stored table: small, so that the hot month is split at
# every scale of the test tables
FILE_ROWS = 500


@query("partition_files", f"""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '01' ELSE strftime(o_orderdate, '%m') END AS month FROM orders),
n AS (SELECT month, count(*) AS n_rows FROM o GROUP BY month)
SELECT month, n_rows, n_rows > {FILE_ROWS} AS split, true AS bounded FROM n""")
def q_partition_files(spark, sf):
    """Orders by month, a third of them in one, loaded and upserted twice: files
    per month stay within 2 ceil(rows / FILE_ROWS), a hot month has several."""
    from driftwood.sources.sinks import files_per_period, upsert_table
    month = F.when(F.col("o_orderkey") % 3 == 0, "01").otherwise(F.date_format("o_orderdate", "MM"))
    o = T(spark, sf, "orders").select("o_orderkey", month.alias("month"), "o_totalprice")
    path, keys = scratch_path(spark, "clustered"), ["o_orderkey", "month"]
    for batch in (o, o.where(F.col("o_orderkey") % 5 == 0).withColumn("o_totalprice", -F.col("o_totalprice")), o.where("month > '10'")):
        # few rows a task: without clustering every task would leave a file in every month
        upsert_table(spark, path, batch.repartition(16), keys, partition_by="month", rows_per_file=FILE_ROWS)
    files = files_per_period(spark, path, "month", period_type=o.schema["month"].dataType)
    return files.select("month", "n_rows", (F.col("n_files") > 1).alias("split"),
                        (F.col("n_files") <= 2 * F.ceil(F.col("n_rows") / F.lit(FILE_ROWS))).alias("bounded"))


# ------------------------------------------------------------------------
# E1 inside J1–J5
# ------------------------------------------------------------------------

@query("job_load_counts", """
WITH d AS (
  SELECT s_suppkey, s_nationkey, CASE WHEN s_nationkey < 5 THEN '2018' WHEN s_nationkey < 15 THEN '2019' ELSE '2020' END AS y
  FROM supplier),
per AS (SELECT CASE WHEN y = '2018' THEN '2018' ELSE 'main' END AS target, count(*) AS n FROM d GROUP BY 1),
twice AS (SELECT 'main' AS target, count(*) AS n FROM d WHERE s_nationkey >= 10 AND y <> '2018')
SELECT p.target, s.stage, CASE WHEN s.stage IN ('read', 'united') THEN p.n + coalesce(t.n, 0) ELSE p.n END AS n_rows
FROM per p LEFT JOIN twice t ON p.target = t.target,
  (VALUES ('read'), ('united'), ('unique'), ('written')) s(stage)""")
def q_job_load_counts(spark, sf):
    """The counts that a load's own writes observe: yearly drops, some rows
    dropped twice, 2018 to its own table."""
    from driftwood.plans.jobs import SourceConfig, format_and_load, load_counts
    from driftwood.sources.sinks import write_table
    root = _station_drops(spark, sf)
    again = T(spark, sf, "supplier").where(F.col("s_nationkey") >= 10)
    for year, cond in ((2019, F.col("s_nationkey") < 15), (2020, F.col("s_nationkey") >= 15)):
        write_table(again.where(cond), f"{root}/{year}_stations_again.parquet")
    cfg = SourceConfig(root=root, target=scratch_path(spark, "stations"), keys=["s_suppkey", "year"], key_len=4,
                       key_col="year", key_type="int", separate_keys=["2018"], outliers=True,
                       outlier_exclude=["s_suppkey", "s_nationkey"], partition_by="year")
    return load_counts(spark, format_and_load(spark, cfg))


# ------------------------------------------------------------------------
# Write, audit, publish; F6, D8: partitioned facts
# ------------------------------------------------------------------------

def _checked_star(spark, sf, base, fact):
    from driftwood.plans.jobs import build_checked_star
    dims = OrderedDict([("dim_day", st.dim_day(days_frame(spark, sf))), ("dim_location", dim_location_frame(spark, sf))])
    return build_checked_star(
        spark, dims, OrderedDict([("fact_listing", fact)]), base,
        pks={"dim_day": ["day"], "dim_location": ["n_name"], "fact_listing": ["o_orderkey", "day", "location_id"]},
        not_null={"fact_listing": ["location_id"]},
        fks=[("fact_listing", ["day"], "dim_day", ["day"]), ("fact_listing", ["location_id"], "dim_location", ["n_name"])])


@query("star_publish", f"""
WITH f AS ({FACT_LISTING_SQL}), n AS (SELECT count(*) AS n FROM f),
broken AS (SELECT count(*) AS n FROM f WHERE o_orderkey % 10 = 0),
checks(check_name, table_name) AS (VALUES ('pk', 'dim_day'), ('pk', 'dim_location'), ('pk', 'fact_listing'),
  ('not_null', 'fact_listing'), ('fk:dim_day', 'fact_listing'), ('fk:dim_location', 'fact_listing'))
SELECT attempt, attempt <> 2 AS published, check_name, table_name,
       CASE WHEN attempt = 2 AND check_name = 'fk:dim_location' THEN broken.n ELSE 0 END AS n_violations, n.n AS live_rows
FROM checks, n, broken, (VALUES (1), (2)) a(attempt)""")
def q_star_publish(spark, sf):
    """A good star is published; a second one, whose facts name unknown
    locations, is refused with a report, and the first stays in place."""
    base = scratch_path(spark, "checked-star")
    fact = fact_listing_frame(spark, sf)
    unknown = F.when(F.col("o_orderkey") % 10 == 0, F.lit("NOWHERE")).otherwise(F.col("location_id"))
    out = None
    for attempt, rows in ((1, fact), (2, fact.withColumn("location_id", unknown))):
        published, report = _checked_star(spark, sf, base, rows)
        live = spark.read.parquet(f"{base}/fact_listing").count()
        part = report.select(F.lit(attempt).alias("attempt"), F.lit(published).alias("published"), "check_name", "table_name",
                             "n_violations", F.lit(live).cast("long").alias("live_rows"))
        out = part if out is None else out.unionByName(part)
    return out


def _monthly_fact(spark, sf):
    return fact_listing_frame(spark, sf).withColumn("month", F.substring("day", 1, 7))


def pruned_star(spark, fact, days):
    """The fact joined with the days of one year: only their months are read.

    The join with the filtered dimension carries the period, so Spark prunes
    the fact's partitions when the dimension is known (dynamic pruning).
    """
    months = days.where(F.col("month").startswith("1995")).select("month").distinct()
    return fact.join(F.broadcast(months), "month")            # 12 rows


@query("star_pruned", f"""
WITH f AS ({FACT_LISTING_SQL})
SELECT o_orderkey, day, location_id, o_totalprice, substr(day, 1, 7) AS month FROM f WHERE day LIKE '1995%'""")
def q_star_pruned(spark, sf):
    """A fact stored by month, joined with a filtered day dimension."""
    from driftwood.plans.jobs import build_star
    from driftwood.sources.sinks import read_stored
    base = scratch_path(spark, "monthly-star")
    fact, days = _monthly_fact(spark, sf), st.dim_day(days_frame(spark, sf))
    paths = build_star(spark, OrderedDict([("dim_day", days)]), OrderedDict([("fact_listing", fact)]), base,
                       partition_by={"fact_listing": "month"})
    stored = read_stored(spark, paths["fact_listing"], "parquet", "month", fact.schema["month"].dataType)
    return pruned_star(spark, stored, spark.read.parquet(paths["dim_day"])) \
        .select("o_orderkey", "day", "location_id", "o_totalprice", "month")


@query("fact_period_refresh", f"""
WITH f AS ({FACT_LISTING_SQL})
SELECT o_orderkey, day, location_id, substr(day, 1, 7) AS month,
       CASE WHEN substr(day, 1, 7) IN ('1995_01', '1996_02') THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
FROM f WHERE NOT (substr(day, 1, 7) = '1996_02' AND o_orderkey % 2 = 0)""")
def q_fact_period_refresh(spark, sf):
    """Two months of a stored fact come anew, one of them with fewer rows: they
    are replaced, no other month is read or written."""
    from driftwood.sources.sinks import read_stored, replace_periods
    fact = _monthly_fact(spark, sf)
    path = scratch_path(spark, "monthly-fact")
    replace_periods(spark, path, fact, "month")
    again = fact.where(F.col("month").isin("1995_01", "1996_02") & ~((F.col("month") == "1996_02") & (F.col("o_orderkey") % 2 == 0)))
    replace_periods(spark, path, again.withColumn("o_totalprice", F.col("o_totalprice") + 1), "month")
    return read_stored(spark, path, "parquet", "month", fact.schema["month"].dataType) \
        .select("o_orderkey", "day", "location_id", "month", "o_totalprice")
