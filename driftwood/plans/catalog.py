"""Registered queries on the driver tables, each with an independent SQL oracle.

Every query reads whole tables of ``sf_dir`` and builds on them the situation
its operator is for (drifting frames, damaged text, duplicate keys, names to
reconcile, …); the matching ``ORACLE`` entry computes the expected result in
plain SQL (DuckDB dialect) from the same tables.  Computed columns carry the
same alias on both sides.  Averages of doubles are rounded to 6 decimals on
both sides, as summation order differs between engines.
"""

from __future__ import annotations

import datetime as dt
from collections import OrderedDict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from driftwood.functions.keys import composite_key, key_part, period_key
from driftwood.functions.text import (damage_as_cp1252, damage_as_latin1, is_non_numeric, parse_double,
                                      repair_mojibake, repair_segments)
from driftwood.operators import dedupe as dd
from driftwood.operators import frames as fr
from driftwood.operators import matching as mt
from driftwood.operators import outliers as ol
from driftwood.operators import quality as qa
from driftwood.operators import star as st
from driftwood.session import cut_lineage, read_test_table, scratch_path

QUERIES: dict = OrderedDict()
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return register


def T(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_test_table(spark, sf, name)


def _ntz(d: dt.datetime):
    """A wall-clock timestamp literal, independent of any time zone setting."""
    return F.lit(d.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def _year_range(col: str, y: int):
    return (F.col(col) >= _ntz(dt.datetime(y, 1, 1))) & (F.col(col) < _ntz(dt.datetime(y + 1, 1, 1)))


def _years(df: DataFrame, col: str) -> list[int]:
    # distinct years: bounded by the calendar, one small aggregate
    return sorted(r[0] for r in df.select(F.year(col).alias("y")).distinct().collect() if r[0] is not None)


# ------------------------------------------------------------------------
# B1, B2
# ------------------------------------------------------------------------

@query("lowercase_columns", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def q_lowercase_columns(spark, sf):
    nation = T(spark, sf, "nation")
    return fr.lowercase_columns(nation.toDF(*[c.upper() for c in nation.columns]))


@query("flatten_structs", """
SELECT event_id, event_type AS info_event_type,
       CAST(json_extract(props, '$.k') AS BIGINT) AS info_props_k, value
FROM events""")
def q_flatten_structs(spark, sf):
    ev = T(spark, sf, "events")
    nested = ev.select(
        "event_id",
        F.struct(F.col("event_type"), F.from_json("props", "k BIGINT").alias("props")).alias("info"),
        "value")
    return fr.flatten_structs(nested)


# ------------------------------------------------------------------------
# Yearly order frames with drift
# ------------------------------------------------------------------------

def order_frames(spark, sf) -> "OrderedDict[str, DataFrame]":
    """Orders split by year; odd years lack the priority, 1996 carries the
    price as text, 1998 has a void status column."""
    orders = T(spark, sf, "orders")
    frames = OrderedDict()
    for y in _years(orders, "o_orderdate"):
        f = orders.where(_year_range("o_orderdate", y))
        if y % 2 == 1:
            f = f.drop("o_orderpriority")
        if y == 1996:
            f = f.withColumn("o_totalprice", F.col("o_totalprice").cast("string"))
        if y == 1998:
            f = f.withColumn("o_orderstatus", F.lit(None))
        frames[str(y)] = f
    return frames


def aligned_orders(spark, sf) -> DataFrame:
    frames = fr.align(order_frames(spark, sf), key_col="year", overrides={"o_totalprice": "double"})
    return fr.union_frames(frames)


ALIGNED_ORDERS_SQL = """
SELECT o_custkey, o_orderdate, o_orderkey,
       CASE WHEN year(o_orderdate) % 2 = 1 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
       CASE WHEN year(o_orderdate) = 1998 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice, CAST(year(o_orderdate) AS VARCHAR) AS year
FROM orders"""


@query("align_union", ALIGNED_ORDERS_SQL)
def q_align_union(spark, sf):
    return aligned_orders(spark, sf)


@query("missing_columns", """
SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) AS frame_key, 'o_orderpriority' AS column_name
FROM orders WHERE year(o_orderdate) % 2 = 1""")
def q_missing_columns(spark, sf):
    return fr.missing_columns_report(spark, order_frames(spark, sf))


@query("type_conflicts", """
WITH y AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders),
n AS (SELECT count(*) AS n FROM y),
c AS (
  SELECT 'o_orderpriority' AS column_name, 'string' AS data_type, count(*) AS n_frames FROM y WHERE y % 2 = 0
  UNION ALL SELECT 'o_orderstatus', 'string', count(*) FROM y WHERE y <> 1998
  UNION ALL SELECT 'o_orderstatus', 'void', count(*) FROM y WHERE y = 1998
  UNION ALL SELECT 'o_totalprice', 'double', count(*) FROM y WHERE y <> 1996
  UNION ALL SELECT 'o_totalprice', 'string', count(*) FROM y WHERE y = 1996)
SELECT column_name, data_type, n_frames FROM c, n WHERE n_frames > 0 AND n_frames <> n""")
def q_type_conflicts(spark, sf):
    return fr.type_conflicts_report(spark, order_frames(spark, sf))


@query("schema_diff", """
WITH y AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders),
p AS (SELECT y AS a, lead(y) OVER (ORDER BY y) AS b FROM y),
t AS (
  SELECT a, b, 'o_orderpriority' AS column_name,
         CASE WHEN a % 2 = 1 THEN 'missing' ELSE 'string' END AS va,
         CASE WHEN b % 2 = 1 THEN 'missing' ELSE 'string' END AS vb FROM p WHERE b IS NOT NULL
  UNION ALL SELECT a, b, 'o_orderstatus',
         CASE WHEN a = 1998 THEN 'void' ELSE 'string' END,
         CASE WHEN b = 1998 THEN 'void' ELSE 'string' END FROM p WHERE b IS NOT NULL
  UNION ALL SELECT a, b, 'o_totalprice',
         CASE WHEN a = 1996 THEN 'string' ELSE 'double' END,
         CASE WHEN b = 1996 THEN 'string' ELSE 'double' END FROM p WHERE b IS NOT NULL)
SELECT CAST(a AS VARCHAR) AS frame_a, CAST(b AS VARCHAR) AS frame_b, column_name,
       'type' AS attribute, va AS value_a, vb AS value_b
FROM t WHERE va <> vb""")
def q_schema_diff(spark, sf):
    return fr.schema_diff_report(spark, order_frames(spark, sf))


@query("null_counts", f"""
WITH a AS ({ALIGNED_ORDERS_SQL})
SELECT 'o_custkey' AS column_name, count(*) - count(o_custkey) AS n_null FROM a
UNION ALL SELECT 'o_orderdate', count(*) - count(o_orderdate) FROM a
UNION ALL SELECT 'o_orderkey', count(*) - count(o_orderkey) FROM a
UNION ALL SELECT 'o_orderpriority', count(*) - count(o_orderpriority) FROM a
UNION ALL SELECT 'o_orderstatus', count(*) - count(o_orderstatus) FROM a
UNION ALL SELECT 'o_totalprice', count(*) - count(o_totalprice) FROM a
UNION ALL SELECT 'year', count(*) - count(year) FROM a""")
def q_null_counts(spark, sf):
    return qa.null_counts(aligned_orders(spark, sf))


@query("constraints_not_null", f"""
WITH a AS ({ALIGNED_ORDERS_SQL})
SELECT * FROM a WHERE o_orderpriority IS NULL OR o_orderstatus IS NULL""")
def q_constraints_not_null(spark, sf):
    return qa.check_not_null(aligned_orders(spark, sf), ["o_orderpriority", "o_orderstatus"])


@query("drop_constant", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def q_drop_constant(spark, sf):
    orders = T(spark, sf, "orders").withColumn(
        "era", F.when(F.col("o_orderdate") >= F.lit("1900-01-01").cast("timestamp_ntz"), "modern"))
    return qa.drop_constant(orders, ["era", "o_orderstatus", "o_orderpriority"])


# ------------------------------------------------------------------------
# Monthly lineitem frames, degenerate frames, split at a key bound
# ------------------------------------------------------------------------

@query("drop_and_split_frames", """
SELECT *, strftime(l_shipdate, '%Y_%m') AS month FROM lineitem
WHERE strftime(l_shipdate, '%Y_%m') > '1998_03' AND month(l_shipdate) <> 1""")
def q_drop_and_split_frames(spark, sf):
    """Monthly lineitem drops as a keyed family: one scan per schema group.
    January drops arrive broken (a single column) and are dropped; only
    months after the bound are kept."""
    li = T(spark, sf, "lineitem").withColumn("month", period_key("l_shipdate", "yyyy_MM"))
    january = F.month("l_shipdate") == 1
    family = OrderedDict([("full", li.where(~january)),
                          ("broken", li.where(january).select("l_orderkey", "month"))])
    family = fr.drop_degenerate(family, key_col="month")
    _, new = fr.split_frames(family, "1998_03", key_col="month")
    return fr.union_frames(new)


# ------------------------------------------------------------------------
# C1, C6, X1, C7, C8
# ------------------------------------------------------------------------

@query("valid_range", """
SELECT * FROM part WHERE p_size BETWEEN 5 AND 40 AND p_retailprice BETWEEN 920 AND 980""")
def q_valid_range(spark, sf):
    return qa.valid_range(T(spark, sf, "part"), {"p_size": (5, 40), "p_retailprice": (920, 980)})


NUMBER_TEXT_SQL = """
SELECT o_orderkey,
  CASE substr(o_orderpriority, 1, 1)
    WHEN '1' THEN o_orderpriority
    WHEN '2' THEN CAST(o_totalprice AS VARCHAR)
    WHEN '3' THEN ' ' || CAST(o_totalprice AS VARCHAR) || ' '
    WHEN '4' THEN replace(CAST(o_totalprice AS VARCHAR), '.', ',')
    ELSE CAST(o_custkey AS VARCHAR) || 'd' END AS txt
FROM orders"""


def number_text(spark, sf) -> DataFrame:
    o = T(spark, sf, "orders")
    lead = F.substring("o_orderpriority", 1, 1)
    price = F.col("o_totalprice").cast("string")
    txt = (F.when(lead == "1", F.col("o_orderpriority"))
           .when(lead == "2", price)
           .when(lead == "3", F.concat(F.lit(" "), price, F.lit(" ")))
           .when(lead == "4", F.regexp_replace(price, r"\.", ","))
           .otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit("d"))))
    return o.select("o_orderkey", txt.alias("txt"))


@query("parse_double", rf"""
WITH t AS ({NUMBER_TEXT_SQL})
SELECT o_orderkey,
  CASE WHEN regexp_matches(txt, '^\s*[-+]?((\d+(\.\d*)?|\.\d+)([eE][-+]?\d+)?|nan|inf|infinity)\s*$', 'i')
       THEN TRY_CAST(trim(txt) AS DOUBLE) END AS value,
  regexp_matches(txt, '[^0-9.]') AS non_numeric
FROM t""")
def q_parse_double(spark, sf):
    t = number_text(spark, sf)
    return t.select("o_orderkey", parse_double("txt").alias("value"),
                    is_non_numeric("txt").alias("non_numeric"))


@query("non_numeric", f"""
WITH t AS ({NUMBER_TEXT_SQL})
SELECT o_orderkey, txt FROM t WHERE regexp_matches(txt, '[^0-9.]')""")
def q_non_numeric(spark, sf):
    return qa.non_numeric(number_text(spark, sf), "txt")


@query("key_matches", """
SELECT o_orderkey, strftime(o_orderdate, '%Y') AS order_year, strftime(o_orderdate, '%Y') AS frame_key
FROM orders""")
def q_key_matches(spark, sf):
    orders = T(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate", "o_orderpriority",
        period_key("o_orderdate", "yyyy").alias("order_year"))
    frames = OrderedDict()
    for y in _years(orders, "o_orderdate"):
        # each yearly drop also carries some misfiled rows of the next year
        misfiled = _year_range("o_orderdate", y + 1) & (F.col("o_orderpriority") == "5-LOW")
        f = orders.where(_year_range("o_orderdate", y) | misfiled)
        frames[str(y)] = fr.with_key(fr.key_matches(f, "order_year", str(y)), "frame_key", str(y))
    return fr.union_frames(frames).select("o_orderkey", "order_year", "frame_key")


@query("functional_dependency", """
SELECT 'n_nationkey' AS column_a, 'n_name' AS column_b,
       count(DISTINCT n_nationkey) AS n_a, count(DISTINCT n_name) AS n_b,
       count(DISTINCT CAST(n_nationkey AS VARCHAR) || '|' || n_name) AS n_ab,
       count(DISTINCT CAST(n_nationkey AS VARCHAR) || '|' || n_name) = count(DISTINCT n_nationkey) AS a_determines_b,
       count(DISTINCT CAST(n_nationkey AS VARCHAR) || '|' || n_name) = count(DISTINCT n_name) AS b_determines_a
FROM nation
UNION ALL
SELECT 'n_regionkey', 'n_name', count(DISTINCT n_regionkey), count(DISTINCT n_name),
       count(DISTINCT CAST(n_regionkey AS VARCHAR) || '|' || n_name),
       count(DISTINCT CAST(n_regionkey AS VARCHAR) || '|' || n_name) = count(DISTINCT n_regionkey),
       count(DISTINCT CAST(n_regionkey AS VARCHAR) || '|' || n_name) = count(DISTINCT n_name)
FROM nation""")
def q_functional_dependency(spark, sf):
    nation = T(spark, sf, "nation")
    return qa.determines(nation, "n_nationkey", "n_name").unionByName(
        qa.determines(nation, "n_regionkey", "n_name"))


# ------------------------------------------------------------------------
# C10, U3, D6; C11
# ------------------------------------------------------------------------

@query("unmatched_values", """
SELECT DISTINCT c_nationkey FROM customer
WHERE c_nationkey IS NOT NULL AND c_nationkey NOT IN (
  SELECT n_nationkey FROM nation WHERE n_regionkey <> 3 AND n_nationkey IS NOT NULL
  UNION SELECT n_regionkey FROM nation WHERE n_regionkey <> 3 AND n_regionkey IS NOT NULL)""")
def q_unmatched_values(spark, sf):
    lookup = T(spark, sf, "nation").where(F.col("n_regionkey") != 3)
    return qa.unmatched_values(T(spark, sf, "customer"), "c_nationkey", lookup,
                               ["n_nationkey", "n_regionkey"])


@query("constraints_pk", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_constraints_pk(spark, sf):
    return qa.check_pk(T(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("constraints_fk", """
SELECT * FROM lineitem l
WHERE l_partkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_size <= 40 AND p.p_partkey = l.l_partkey)""")
def q_constraints_fk(spark, sf):
    parent = T(spark, sf, "part").where(F.col("p_size") <= 40)
    return qa.check_fk(T(spark, sf, "lineitem"), ["l_partkey"], parent, ["p_partkey"])


# ------------------------------------------------------------------------
# D1, D7, D2
# ------------------------------------------------------------------------

@query("lookup_left_join", """
SELECT s_suppkey, s_name, n_name FROM supplier
LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 4) n ON s_nationkey = n.n_nationkey""")
def q_lookup_left_join(spark, sf):
    lk = T(spark, sf, "nation").where(F.col("n_regionkey") != 4)
    return mt.lookup_join(T(spark, sf, "supplier"), lk, "s_nationkey", "n_nationkey") \
        .select("s_suppkey", "s_name", "n_name")


@query("map_lookup", """
SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def q_map_lookup(spark, sf):
    return mt.lookup_join(T(spark, sf, "orders"), T(spark, sf, "customer"), "o_custkey", "c_custkey") \
        .select("o_orderkey", "c_name")


def nation_lookups(spark, sf):
    nation = T(spark, sf, "nation")
    first = nation.where(F.col("n_regionkey").isin(0, 1))
    second = nation.where(F.col("n_regionkey").isin(1, 2, 3))
    return [(first, "n_nationkey", "n_name"), (second, "n_nationkey", "n_name")]


@query("lookup_fallback", """
SELECT c_custkey, coalesce(a.n_name, b.n_name) AS location_id FROM customer
LEFT JOIN (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey IN (0, 1)) a ON c_nationkey = a.n_nationkey
LEFT JOIN (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey IN (1, 2, 3)) b ON c_nationkey = b.n_nationkey""")
def q_lookup_fallback(spark, sf):
    return mt.lookup_fallback(T(spark, sf, "customer"), "c_nationkey", nation_lookups(spark, sf),
                              "location_id").select("c_custkey", "location_id")


# ------------------------------------------------------------------------
# Fuzzy reconciliation of part names
# ------------------------------------------------------------------------

TOKENS_SQL = "list_distinct(list_filter(regexp_split_to_array(lower({x}), '\\s+'), lambda t: t <> ''))"

FUZZY_SQL = f"""
WITH l AS (SELECT DISTINCT p_name || ' ' || p_type AS p_name FROM part WHERE p_name IS NOT NULL AND p_type IS NOT NULL),
r AS (SELECT p_partkey, p_brand || ' ' || p_name AS candidate FROM part),
s AS (SELECT l.p_name, r.p_partkey, r.candidate,
             {TOKENS_SQL.format(x='l.p_name')} AS a, {TOKENS_SQL.format(x='r.candidate')} AS b
      FROM l CROSS JOIN r),
j AS (SELECT p_name, p_partkey, candidate,
             CASE WHEN len(list_distinct(list_concat(a, b))) = 0 THEN 0.0
                  ELSE len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) END AS jaccard_similarity
      FROM s)
SELECT * FROM j WHERE jaccard_similarity >= 0.3"""

BEST_SQL = f"""
WITH f AS ({FUZZY_SQL}),
o AS (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY jaccard_similarity DESC, p_partkey ASC) AS rn FROM f)
SELECT p_name, p_partkey, candidate, jaccard_similarity FROM o WHERE rn = 1"""


def part_names(spark, sf):
    part = T(spark, sf, "part")
    # two spellings of every part: the name with its type against the brand with the name
    left = part.select(F.concat("p_name", F.lit(" "), "p_type").alias("p_name"))
    right = part.select("p_partkey", F.concat("p_brand", F.lit(" "), "p_name").alias("candidate"))
    return left, right


def fuzzy_parts(spark, sf):
    left, right = part_names(spark, sf)
    return mt.fuzzy_join(left, right, "p_name", "candidate", 0.3)


def best_parts(spark, sf):
    return mt.best_match(fuzzy_parts(spark, sf), "p_name", "jaccard_similarity", ["p_partkey"])


@query("fuzzy_join", FUZZY_SQL)
def q_fuzzy_join(spark, sf):
    return fuzzy_parts(spark, sf)


@query("best_match", BEST_SQL)
def q_best_match(spark, sf):
    return best_parts(spark, sf)


# Manual corrections of the reconciliation (one id override of a
# matched name, one extra name that no rule finds).
OVERRIDE_ROWS = [("blue bolt ECONOMY", -1, None, None), ("rusty sprocket", -2, "rusty sprocket", 1.0)]

OVERRIDES_SQL = """
SELECT * FROM (VALUES ('blue bolt ECONOMY', -1, NULL, NULL), ('rusty sprocket', -2, 'rusty sprocket', 1.0))
  v(p_name, p_partkey, candidate, jaccard_similarity)"""


@query("apply_overrides", f"""
WITH b AS ({BEST_SQL}), o AS ({OVERRIDES_SQL})
SELECT b.p_name, coalesce(o.p_partkey, b.p_partkey) AS p_partkey,
       coalesce(o.candidate, b.candidate) AS candidate,
       coalesce(o.jaccard_similarity, b.jaccard_similarity) AS jaccard_similarity
FROM b LEFT JOIN o ON b.p_name = o.p_name
UNION ALL
SELECT p_name, p_partkey, candidate, jaccard_similarity FROM o WHERE p_name NOT IN (SELECT p_name FROM b)""")
def q_apply_overrides(spark, sf):
    overrides = spark.createDataFrame(
        OVERRIDE_ROWS, "p_name string, p_partkey long, candidate string, jaccard_similarity double")
    return mt.apply_overrides(best_parts(spark, sf), "p_name", overrides)


@query("unresolved_names", """
SELECT DISTINCT p_name || ' ' || p_brand AS name FROM part WHERE p_name || ' ' || p_brand NOT IN (
  SELECT p_name || ' ' || p_brand FROM part WHERE p_size > 12 AND p_name IS NOT NULL AND p_brand IS NOT NULL)""")
def q_unresolved_names(spark, sf):
    """Every name with its brand; those are resolved that come in a size above 12."""
    named = T(spark, sf, "part").select(F.concat("p_name", F.lit(" "), "p_brand").alias("name"), "p_size")
    return mt.unresolved(named.select("name").where("name is not null").distinct(),
                         named.where("p_size > 12").select("name"), "name")


# ------------------------------------------------------------------------
# E1, E2, E3
# ------------------------------------------------------------------------

LINEITEM_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                 "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
DEDUPE_KEYED_SQL = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY {', '.join(c + ' ASC NULLS FIRST' for c in LINEITEM_REST)}) AS rn FROM lineitem)
WHERE rn = 1"""


@query("dedupe_rows", "SELECT DISTINCT * FROM lineitem")
def q_dedupe_rows(spark, sf):
    return dd.dedupe(T(spark, sf, "lineitem"))


@query("dedupe_keyed", DEDUPE_KEYED_SQL)
def q_dedupe_keyed(spark, sf):
    return dd.dedupe(T(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("row_audit", f"""
SELECT 'before' AS stage, count(*) AS n_rows FROM lineitem
UNION ALL SELECT 'after', count(*) FROM ({DEDUPE_KEYED_SQL})""")
def q_row_audit(spark, sf):
    li = T(spark, sf, "lineitem")
    return dd.row_counts({"before": li, "after": dd.dedupe(li, ["l_orderkey", "l_linenumber"])})


# ------------------------------------------------------------------------
# E4, E5, E6, E7, E10
# ------------------------------------------------------------------------

@query("continuous_columns", """
SELECT column_name FROM (
  SELECT 'l_partkey' AS column_name, count(DISTINCT l_partkey) AS n FROM lineitem
  UNION ALL SELECT 'l_suppkey', count(DISTINCT l_suppkey) FROM lineitem
  UNION ALL SELECT 'l_quantity', count(DISTINCT l_quantity) FROM lineitem
  UNION ALL SELECT 'l_extendedprice', count(DISTINCT l_extendedprice) FROM lineitem
  UNION ALL SELECT 'l_discount', count(DISTINCT l_discount) FROM lineitem
  UNION ALL SELECT 'l_tax', count(DISTINCT l_tax) FROM lineitem) WHERE n > 10""")
def q_continuous_columns(spark, sf):
    prof = ol.continuous_profile(T(spark, sf, "lineitem"), exclude=["l_orderkey", "l_linenumber"])
    return prof.where(F.col("approx_distinct") > 10).select("column_name")


def _bounds_sql(table: str, column: str, factor: float) -> str:
    return f"""
SELECT '{column}' AS column_name, q1, q3, q3 - q1 AS iqr,
       q1 - {factor} * (q3 - q1) AS lower_bound, q3 + {factor} * (q3 - q1) AS upper_bound
FROM (SELECT CAST(quantile_disc({column}, 0.25) AS DOUBLE) AS q1,
             CAST(quantile_disc({column}, 0.75) AS DOUBLE) AS q3 FROM {table})"""


@query("iqr_bounds", _bounds_sql("events", "value", 1.5) + " UNION ALL "
       + _bounds_sql("events", "user_id", 1.5))
def q_iqr_bounds(spark, sf):
    return ol.iqr_bounds_frame(T(spark, sf, "events"), ["value", "user_id"], 1.5)


@query("iqr_outliers", f"""
WITH b AS ({_bounds_sql('events', 'value', 1.5)})
SELECT e.*, 'value' AS outlier_column FROM events e, b
WHERE e.value < b.lower_bound OR e.value > b.upper_bound""")
def q_iqr_outliers(spark, sf):
    ev = T(spark, sf, "events")
    bounds = ol.iqr_bounds(ev, ["value"], 1.5, exact=True)
    return ol.outlier_rows(ev, bounds)


def _report_sql(table: str, columns, factor: float) -> str:
    parts = []
    for c in columns:
        parts.append(f"""
SELECT b.column_name, b.lower_bound, b.upper_bound,
       count(*) FILTER (WHERE t.{c} < b.lower_bound OR t.{c} > b.upper_bound) AS n_outliers
FROM {table} t, ({_bounds_sql(table, c, factor)}) b GROUP BY ALL""")
    return " UNION ALL ".join(parts)


@query("outlier_report", _report_sql("events", ["value", "user_id"], 3.0) + " UNION ALL "
       + _report_sql("orders", ["o_totalprice"], 3.0))
def q_outlier_report(spark, sf):
    ev = T(spark, sf, "events")
    rep = ol.outlier_report(ev, ol.iqr_bounds(ev, ["value", "user_id"], 3.0, exact=True))
    orders = T(spark, sf, "orders")
    rep2 = ol.outlier_report(orders, ol.iqr_bounds(orders, ["o_totalprice"], 3.0, exact=True))
    return rep.unionByName(rep2)


@query("iqr_delete", """
WITH e AS (SELECT event_id, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
b1 AS (SELECT CAST(quantile_disc(value, 0.25) AS DOUBLE) AS q1, CAST(quantile_disc(value, 0.75) AS DOUBLE) AS q3 FROM e),
s1 AS (SELECT e.* FROM e, b1 WHERE value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1)),
b2 AS (SELECT CAST(quantile_disc(k, 0.25) AS DOUBLE) AS q1, CAST(quantile_disc(k, 0.75) AS DOUBLE) AS q3 FROM s1)
SELECT s1.* FROM s1, b2 WHERE k >= q1 - 0.25 * (q3 - q1) AND k <= q3 + 0.25 * (q3 - q1)""")
def q_iqr_delete(spark, sf):
    ev = T(spark, sf, "events").select(
        "event_id", "value", F.from_json("props", "k BIGINT")["k"].alias("k"))
    kept, _ = ol.iqr_delete(ev, ["value", "k"], exact=True, factors={"value": 1.5, "k": 0.25})
    return kept


@query("histogram", """
WITH e AS (SELECT min(o_totalprice) AS lo1, max(o_totalprice) AS hi1,
                  CAST(min(o_custkey) AS DOUBLE) AS lo2, CAST(max(o_custkey) AS DOUBLE) AS hi2 FROM orders)
SELECT 'o_totalprice' AS column_name,
       CAST(least(floor((o_totalprice - lo1) / (CASE WHEN hi1 = lo1 THEN 1.0 ELSE hi1 - lo1 END) * 50), 49) AS INTEGER) AS bin,
       count(*) AS n
FROM orders, e WHERE o_totalprice IS NOT NULL GROUP BY ALL
UNION ALL
SELECT 'o_custkey',
       CAST(least(floor((CAST(o_custkey AS DOUBLE) - lo2) / (CASE WHEN hi2 = lo2 THEN 1.0 ELSE hi2 - lo2 END) * 50), 49) AS INTEGER),
       count(*)
FROM orders, e WHERE o_custkey IS NOT NULL GROUP BY ALL""")
def q_histogram(spark, sf):
    return qa.histogram(T(spark, sf, "orders"), ["o_totalprice", "o_custkey"], 50)


# ------------------------------------------------------------------------
# E8, S1, S2, C2–C5, B14, X6, X7
# ------------------------------------------------------------------------

@query("group_count", "SELECT o_orderpriority, count(*) AS n_orders FROM orders GROUP BY o_orderpriority")
def q_group_count(spark, sf):
    return T(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders"))


@query("top_k", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT 10""")
def q_top_k(spark, sf):
    return (T(spark, sf, "orders").select("o_orderkey", "o_totalprice")
            .orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey").asc()).limit(10))


@query("filters", """
SELECT c_custkey, c_name AS customer_name,
       CASE WHEN c_acctbal < 0 THEN 'debt' ELSE 'credit' END AS balance_kind,
       CAST(c_nationkey AS VARCHAR) AS nation_code
FROM customer
WHERE c_mktsegment = 'BUILDING' AND c_acctbal IS NOT NULL AND c_name IS NOT NULL
  AND (c_acctbal < 0 OR c_acctbal > 9000) AND abs(c_acctbal) >= 0.3""")
def q_filters(spark, sf):
    c = T(spark, sf, "customer")
    out = (c.filter("c_mktsegment = 'BUILDING'")
           .where(F.col("c_acctbal").isNotNull() & F.col("c_name").isNotNull())
           .where((F.col("c_acctbal") < 0) | (F.col("c_acctbal") > 9000))
           .where(F.abs("c_acctbal") >= 0.3))
    return out.select(
        "c_custkey", F.col("c_name").alias("customer_name"),
        F.when(F.col("c_acctbal") < 0, "debt").otherwise("credit").alias("balance_kind"),
        F.col("c_nationkey").cast("string").alias("nation_code"))


# ------------------------------------------------------------------------
# Encoding repair over whole documents
# ------------------------------------------------------------------------

@query("mojibake_repair", "SELECT doc_id, text FROM documents")
def q_mojibake_repair(spark, sf):
    docs = T(spark, sf, "documents")
    return docs.select("doc_id", repair_mojibake(damage_as_latin1("text")).alias("text"))


@query("mojibake_clean_unchanged", "SELECT doc_id, text FROM documents")
def q_mojibake_clean_unchanged(spark, sf):
    docs = T(spark, sf, "documents")
    return docs.select("doc_id", repair_mojibake("text").alias("text"))


@query("mojibake_cp1252", "SELECT doc_id, text || ' “it’s 5€”' AS text FROM documents")
def q_mojibake_cp1252(spark, sf):
    """Clean, Latin-1-damaged and Windows-1252-damaged texts in one column."""
    docs = T(spark, sf, "documents").select("doc_id", F.concat("text", F.lit(" “it’s 5€”")).alias("text"))
    damaged = F.when(F.col("doc_id") % 3 == 0, damage_as_cp1252("text")) \
        .when(F.col("doc_id") % 3 == 1, damage_as_latin1("text")).otherwise(F.col("text"))
    return docs.select("doc_id", repair_mojibake(damaged).alias("text"))


@query("text_cleanup", """
SELECT doc_id, text || chr(10) || '"plain" ' || chr(39) || 'quotes' || chr(39) || chr(10) || 'end' || chr(9) || '.' AS text FROM documents""")
def q_text_cleanup(spark, sf):
    """Typographic quotes, line breaks of other systems and control characters
    around every text, as the optional cleaning of a load removes them."""
    from driftwood.plans.jobs import clean_strings
    noisy = F.concat(F.lit("\x01"), F.col("text"), F.lit("\r\n\u201cplain\u201d \u2018quotes\u2019\u2028\x07end\t."))
    return clean_strings(T(spark, sf, "documents").select("doc_id", noisy.alias("text")))


# Clean text that a single-byte reading could take for damage.
CLEAN_MARKS = " « LIBERTÉ\u00a0! », là\u00a0», Á\u2019, 日本語 Ωé"


@query("mojibake_segments", f"""
SELECT doc_id, md5(a || ' – 日本 ' || b || ' | ' || a || ' | ' || c || '{CLEAN_MARKS}') AS repaired,
       md5(text || '{CLEAN_MARKS}') AS clean
FROM (SELECT doc_id, text, substr(text, 1, 300) AS a, substr(text, 301, 300) AS b, substr(text, 601) AS c FROM documents)""")
def q_mojibake_segments(spark, sf):
    """Texts of a stretch damaged as Latin-1, a clean one, one damaged twice and
    one damaged as Windows-1252, between clean words outside either code page;
    and clean texts that look damaged at single places."""
    docs = T(spark, sf, "documents").select("doc_id", "text", F.substring("text", 1, 300).alias("a"),
                                            F.substring("text", 301, 300).alias("b"),
                                            F.expr("substring(text, 601)").alias("c"))
    mixed = F.concat(damage_as_latin1("a"), F.lit(" – 日本 "), F.col("b"), F.lit(" | "),
                     damage_as_cp1252(damage_as_cp1252("a")), F.lit(" | "), damage_as_cp1252("c"), F.lit(CLEAN_MARKS))
    return docs.select("doc_id", F.md5(repair_segments(mixed)).alias("repaired"),
                       F.md5(repair_segments(F.concat("text", F.lit(CLEAN_MARKS)))).alias("clean"))


# ------------------------------------------------------------------------
# A4: keyed upsert
# ------------------------------------------------------------------------

@query("upsert_partitioned", """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE strftime(o_orderdate, '%m') END AS month,
                  o_totalprice, o_orderstatus FROM orders),
stored AS (SELECT o_orderkey, month, o_totalprice FROM o),
batch AS (SELECT o_orderkey, month, -o_totalprice AS o_totalprice, o_orderstatus AS extra FROM o
          WHERE o_orderkey % 5 = 0 AND (month IS NULL OR month <= '03')
          UNION ALL SELECT -o_orderkey, month, o_totalprice, 'new' FROM o WHERE o_orderkey % 7 = 0 AND month = '01')
SELECT coalesce(b.o_orderkey, s.o_orderkey) AS o_orderkey, coalesce(b.month, s.month) AS month,
       CASE WHEN b.o_orderkey IS NULL THEN s.o_totalprice ELSE b.o_totalprice END AS o_totalprice, b.extra
FROM stored s FULL JOIN batch b ON s.o_orderkey = b.o_orderkey AND s.month IS NOT DISTINCT FROM b.month""")
def q_upsert_partitioned(spark, sf):
    """Orders stored by month (text keys ``01`` … ``12`` and null); a batch that
    touches three months and the null one, with a new column, applied twice."""
    from driftwood.sources.sinks import read_stored, upsert_table
    month = F.when(F.col("o_orderkey") % 11 != 0, F.date_format("o_orderdate", "MM"))
    o = T(spark, sf, "orders").select("o_orderkey", month.alias("month"), "o_totalprice", "o_orderstatus")
    changed = o.where((F.col("o_orderkey") % 5 == 0) & (F.col("month").isNull() | (F.col("month") <= "03"))) \
        .select("o_orderkey", "month", (-F.col("o_totalprice")).alias("o_totalprice"), F.col("o_orderstatus").alias("extra"))
    new = o.where((F.col("o_orderkey") % 7 == 0) & (F.col("month") == "01")) \
        .select((-F.col("o_orderkey")).alias("o_orderkey"), "month", "o_totalprice", F.lit("new").alias("extra"))
    batch = changed.unionByName(new)
    path = scratch_path(spark, "by-month")
    keys = ["o_orderkey", "month"]
    upsert_table(spark, path, o.drop("o_orderstatus"), keys, partition_by="month")
    for _ in range(2):
        upsert_table(spark, path, batch, keys, partition_by="month")
    return read_stored(spark, path, "parquet", "month", batch.schema["month"].dataType) \
        .select("o_orderkey", "month", "o_totalprice", "extra")


@query("upsert", """
WITH t AS (SELECT *, CASE WHEN c_acctbal > 5000 THEN 'gold' ELSE 'std' END AS c_tier FROM customer),
b AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal + 100 END AS c_acctbal, c_mktsegment
      FROM customer WHERE c_mktsegment = 'BUILDING'
      UNION ALL SELECT c_custkey + 1000000, c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment = 'MACHINERY')
SELECT coalesce(b.c_custkey, t.c_custkey) AS c_custkey, t.c_name, t.c_nationkey,
       CASE WHEN b.c_custkey IS NOT NULL THEN b.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
       CASE WHEN b.c_custkey IS NOT NULL THEN b.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment,
       t.c_tier
FROM t FULL OUTER JOIN b ON t.c_custkey = b.c_custkey""")
def q_upsert(spark, sf):
    from driftwood.sources.sinks import merge_upsert
    c = T(spark, sf, "customer")
    stored = c.withColumn("c_tier", F.when(F.col("c_acctbal") > 5000, "gold").otherwise("std"))
    changed = c.where(F.col("c_mktsegment") == "BUILDING").select(
        "c_custkey", F.when(F.col("c_acctbal") < 0, None).otherwise(F.col("c_acctbal") + 100).alias("c_acctbal"),
        "c_mktsegment")
    new = c.where(F.col("c_mktsegment") == "MACHINERY").select(
        (F.col("c_custkey") + 1000000).alias("c_custkey"), "c_acctbal", "c_mktsegment")
    return merge_upsert(stored, changed.unionByName(new), ["c_custkey"])


# ------------------------------------------------------------------------
# Flagship: the core of the formatted-zone jobs on drifting yearly drops
# ------------------------------------------------------------------------

def flagship(spark, sf):
    """align → union → keyed dedupe → continuous columns → IQR (exact) → report."""
    # three actions follow: materialize the united, de-duplicated frame once
    merged = cut_lineage(dd.dedupe(aligned_orders(spark, sf), ["o_orderkey"]))
    cols = ol.continuous_columns(merged, 10, exclude=["o_orderkey", "o_custkey"])
    return ol.outlier_report(merged, ol.iqr_bounds(merged, cols, 3.0, exact=True))


query("flagship_outlier_audit", _report_sql("orders", ["o_totalprice"], 3.0))(flagship)


# ------------------------------------------------------------------------
# Star schema on the driver tables.
# Days come from orders, months from events, years from lineitem; locations
# are nations with their region; the listing fact is orders resolved to a
# location through two partial lookups, the income fact is customers.
# ------------------------------------------------------------------------

DAYS_SQL = "SELECT strftime(o_orderdate, '%Y_%m_%d') AS day FROM orders"
DIM_YEAR_SQL = """
SELECT DISTINCT year FROM (
  SELECT CAST(year(l_shipdate) AS VARCHAR) AS year FROM lineitem
  UNION ALL SELECT split_part(strftime(o_orderdate, '%Y_%m_%d'), '_', 1) FROM orders
  UNION ALL SELECT split_part(strftime(ts, '%Y_%m'), '_', 1) FROM events) WHERE year IS NOT NULL"""
DIM_MONTH_SQL = f"""
SELECT DISTINCT month, split_part(month, '_', 1) AS year FROM (
  SELECT split_part(day, '_', 1) || '_' || split_part(day, '_', 2) AS month FROM ({DAYS_SQL})
  UNION ALL SELECT strftime(ts, '%Y_%m') FROM events) WHERE month IS NOT NULL"""
DIM_DAY_SQL = f"""
SELECT DISTINCT day, split_part(day, '_', 1) || '_' || split_part(day, '_', 2) AS month
FROM ({DAYS_SQL}) WHERE day IS NOT NULL"""
DIM_LOCATION_SQL = "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey"
FACT_LISTING_SQL = """
SELECT DISTINCT o_orderkey, strftime(o_orderdate, '%Y_%m_%d') AS day,
       coalesce(a.n_name, b.n_name) AS location_id, o_totalprice
FROM orders JOIN customer ON o_custkey = c_custkey
LEFT JOIN (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey IN (0, 1)) a ON c_nationkey = a.n_nationkey
LEFT JOIN (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey IN (1, 2, 3)) b ON c_nationkey = b.n_nationkey
WHERE o_orderstatus = 'F' AND coalesce(a.n_name, b.n_name) IS NOT NULL"""
FACT_INCOME_SQL = """
SELECT DISTINCT c_mktsegment AS segment, n_name AS location_id, c_acctbal AS balance
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""


def days_frame(spark, sf):
    return T(spark, sf, "orders").select(period_key("o_orderdate", "yyyy_MM_dd").alias("day"))


def months_frame(spark, sf):
    return T(spark, sf, "events").select(period_key("ts", "yyyy_MM").alias("month"))


def dim_year_frame(spark, sf):
    years = T(spark, sf, "lineitem").select(F.year("l_shipdate"))
    return st.dim_year(years, days_frame(spark, sf).select(key_part("day", 0)),
                       months_frame(spark, sf).select(key_part("month", 0)))


def location_lookup(spark, sf):
    return mt.lookup_join(T(spark, sf, "nation"), T(spark, sf, "region"),
                          "n_regionkey", "r_regionkey", "inner")


def dim_location_frame(spark, sf):
    return st.dim_location(location_lookup(spark, sf), drop=["n_regionkey", "r_regionkey"])


def fact_listing_frame(spark, sf):
    orders = T(spark, sf, "orders")
    cust = T(spark, sf, "customer").select("c_custkey", "c_nationkey")
    src = orders.join(cust, orders["o_custkey"] == cust["c_custkey"])
    src = src.withColumn("day", period_key("o_orderdate", "yyyy_MM_dd"))
    return st.fact_with_fallback(
        src, "c_nationkey", nation_lookups(spark, sf), "location_id",
        {"o_orderkey": "o_orderkey", "day": "day", "location_id": "location_id",
         "o_totalprice": "o_totalprice"},
        row_filter=F.col("o_orderstatus") == "F")


def fact_income_frame(spark, sf):
    return st.fact_from_lookup(
        T(spark, sf, "customer"), T(spark, sf, "nation"), "c_nationkey", "n_nationkey",
        {"c_mktsegment": "segment", "n_name": "location_id", "c_acctbal": "balance"})


@query("dim_year", DIM_YEAR_SQL)
def q_dim_year(spark, sf):
    return dim_year_frame(spark, sf)


@query("dim_month", DIM_MONTH_SQL)
def q_dim_month(spark, sf):
    return st.dim_month(days_frame(spark, sf), months_frame(spark, sf))


@query("dim_day", DIM_DAY_SQL)
def q_dim_day(spark, sf):
    return st.dim_day(days_frame(spark, sf))


@query("dim_location", DIM_LOCATION_SQL)
def q_dim_location(spark, sf):
    return dim_location_frame(spark, sf)


@query("fact_listing", FACT_LISTING_SQL)
def q_fact_listing(spark, sf):
    return fact_listing_frame(spark, sf)


@query("fact_income", FACT_INCOME_SQL)
def q_fact_income(spark, sf):
    return fact_income_frame(spark, sf)


@query("star_join", f"""
WITH f AS ({FACT_LISTING_SQL}), dd AS ({DIM_DAY_SQL}), dm AS ({DIM_MONTH_SQL}),
dy AS ({DIM_YEAR_SQL}), dl AS ({DIM_LOCATION_SQL})
SELECT f.o_orderkey, f.day, dd.month, dm.year, f.location_id, dl.r_name, f.o_totalprice
FROM f JOIN dd ON f.day = dd.day JOIN dm ON dd.month = dm.month JOIN dy ON dm.year = dy.year
JOIN dl ON f.location_id = dl.n_name""")
def q_star_join(spark, sf):
    joined = st.star_join(fact_listing_frame(spark, sf), [
        (st.dim_day(days_frame(spark, sf)), "day", "day"),
        (st.dim_month(days_frame(spark, sf), months_frame(spark, sf)), "month", "month"),
        (dim_year_frame(spark, sf), "year", "year"),
        (dim_location_frame(spark, sf).select("n_name", "r_name"), "location_id", "n_name", False)])
    return joined.select("o_orderkey", "day", "month", "year", "location_id", "r_name", "o_totalprice")


@query("kpi_price_size", """
SELECT CAST(l_orderkey AS VARCHAR) || '_' || strftime(l_shipdate, '%Y_%m_%d') AS row_id,
       round(avg(l_extendedprice), 6) AS avg_l_extendedprice, round(avg(l_quantity), 6) AS avg_l_quantity,
       CAST(sum(l_linenumber) AS BIGINT) AS sum_l_linenumber
FROM lineitem GROUP BY 1""")
def q_kpi_price_size(spark, sf):
    li = T(spark, sf, "lineitem")
    row_id = composite_key([F.col("l_orderkey"), period_key("l_shipdate", "yyyy_MM_dd")])
    k = st.kpi_per_row(li, row_id, ["l_extendedprice", "l_quantity"], ["l_linenumber"])
    return k.select("row_id", F.round("avg_l_extendedprice", 6).alias("avg_l_extendedprice"),
                    F.round("avg_l_quantity", 6).alias("avg_l_quantity"), "sum_l_linenumber")


@query("kpi_price_income", f"""
WITH f AS ({FACT_LISTING_SQL}), i AS ({FACT_INCOME_SQL}),
a AS (SELECT location_id, avg(o_totalprice) AS avg_price, avg(o_orderkey % 100) AS avg_size FROM f GROUP BY 1),
b AS (SELECT location_id, avg(balance) AS avg_balance FROM i GROUP BY 1)
SELECT coalesce(a.location_id, b.location_id) AS location_id, round(a.avg_price, 6) AS avg_price,
       round(a.avg_size, 6) AS avg_size, round(b.avg_balance, 6) AS avg_balance
FROM a FULL OUTER JOIN b ON a.location_id = b.location_id WHERE a.avg_price IS NOT NULL""")
def q_kpi_price_income(spark, sf):
    d = st.drill_across(fact_listing_frame(spark, sf), fact_income_frame(spark, sf), "location_id",
                        [F.avg("o_totalprice").alias("avg_price"), F.avg(F.col("o_orderkey") % 100).alias("avg_size")],
                        [F.avg("balance").alias("avg_balance")])
    return d.where(F.col("avg_price").isNotNull()).select(
        "location_id", *[F.round(c, 6).alias(c) for c in ("avg_price", "avg_size", "avg_balance")])


@query("kpi_rows_per_day", f"""
SELECT CAST(strptime(day, '%Y_%m_%d') AS DATE) AS date, count(*) AS n_rows
FROM ({FACT_LISTING_SQL}) GROUP BY 1""")
def q_kpi_rows_per_day(spark, sf):
    return st.kpi_rows_per_day(fact_listing_frame(spark, sf))


@query("kpi_income_population", f"""
SELECT r_name, n_name, round(avg(balance), 6) AS avg_balance, count(*) AS n_rows
FROM ({FACT_INCOME_SQL}) i JOIN ({DIM_LOCATION_SQL}) l ON i.location_id = l.n_name GROUP BY ALL""")
def q_kpi_income_population(spark, sf):
    joined = st.star_join(fact_income_frame(spark, sf),
                          [(dim_location_frame(spark, sf), "location_id", "n_name")])
    # the join key is dropped; the dimension name equals the fact's location id
    return joined.groupBy("r_name", F.col("location_id").alias("n_name")).agg(
        F.round(F.avg("balance"), 6).alias("avg_balance"), F.count(F.lit(1)).alias("n_rows"))


# ------------------------------------------------------------------------
# Features and regression on lineitem and events
# ------------------------------------------------------------------------

# roles from the column types as the oracle sees them in the table itself
FEATURE_ROLES_SQL = """
SELECT column_name,
       CASE WHEN t IN ('DOUBLE', 'INTEGER') THEN 'numeric'
            WHEN t = 'BOOLEAN' THEN 'boolean' ELSE 'categorical' END AS role
FROM (SELECT 'l_orderkey' AS column_name, typeof(any_value(l_orderkey)) AS t FROM lineitem UNION ALL SELECT 'l_partkey' AS column_name, typeof(any_value(l_partkey)) AS t FROM lineitem UNION ALL SELECT 'l_suppkey' AS column_name, typeof(any_value(l_suppkey)) AS t FROM lineitem UNION ALL SELECT 'l_linenumber' AS column_name, typeof(any_value(l_linenumber)) AS t FROM lineitem UNION ALL SELECT 'l_quantity' AS column_name, typeof(any_value(l_quantity)) AS t FROM lineitem UNION ALL SELECT 'l_discount' AS column_name, typeof(any_value(l_discount)) AS t FROM lineitem UNION ALL SELECT 'l_tax' AS column_name, typeof(any_value(l_tax)) AS t FROM lineitem UNION ALL SELECT 'l_returnflag' AS column_name, typeof(any_value(l_returnflag)) AS t FROM lineitem UNION ALL SELECT 'l_linestatus' AS column_name, typeof(any_value(l_linestatus)) AS t FROM lineitem UNION ALL SELECT 'l_shipdate' AS column_name, typeof(any_value(l_shipdate)) AS t FROM lineitem)
WHERE t IN ('DOUBLE', 'INTEGER', 'BOOLEAN', 'VARCHAR')"""


@query("feature_roles", FEATURE_ROLES_SQL)
def q_feature_roles(spark, sf):
    from driftwood.operators.features import feature_roles_report
    return feature_roles_report(T(spark, sf, "lineitem"), "l_extendedprice")


@query("sql_stage", """
SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber, l_quantity,
       l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem""")
def q_sql_stage(spark, sf):
    from driftwood.operators.features import cast_stage, feature_roles
    li = T(spark, sf, "lineitem")
    return cast_stage(li.columns, feature_roles(li, "l_extendedprice")["numeric"]).transform(li)


IMPUTE_SQL = """
WITH e AS (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
                  CASE WHEN value > 100 THEN NULL ELSE event_type END AS event_type FROM events)
SELECT event_id, round(coalesce(value, avg(value) OVER ()), 6) AS value,
       coalesce(event_type, 'UNKNOWN') AS event_type FROM e"""


@query("impute_fill", IMPUTE_SQL)
def q_impute_fill(spark, sf):
    from pyspark.ml.feature import Imputer

    from driftwood.operators.features import unknown_stage
    ev = T(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", None).otherwise(F.col("value")).alias("value"),
        F.when(F.col("value") > 100, None).otherwise(F.col("event_type")).alias("event_type"))
    imputed = Imputer(inputCols=["value"], outputCols=["value"], strategy="mean").fit(ev).transform(ev)
    filled = unknown_stage(imputed.columns, ["event_type"]).transform(imputed)
    return filled.select("event_id", F.round("value", 6).alias("value"), "event_type")


STRING_INDEX_SQL = """
SELECT event_type, CAST(row_number() OVER (ORDER BY n DESC, event_type ASC) - 1 AS DOUBLE) AS event_type_index
FROM (SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1)"""


def indexed_events(spark, sf):
    from pyspark.ml.feature import StringIndexer
    ev = T(spark, sf, "events")
    model = StringIndexer(inputCols=["event_type"], outputCols=["event_type_index"],
                          handleInvalid="skip", stringOrderType="frequencyDesc").fit(ev)
    return model.transform(ev)


@query("string_index", STRING_INDEX_SQL)
def q_string_index(spark, sf):
    return indexed_events(spark, sf).select("event_type", "event_type_index").distinct()


ONE_HOT_SQL = f"""
WITH idx AS ({STRING_INDEX_SQL}), k AS (SELECT count(*) AS k FROM idx)
SELECT event_id, value, user_id,
       list_transform(range(k.k - 1), lambda i: CASE WHEN i = idx.event_type_index THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS event_type_vec
FROM events JOIN idx USING (event_type), k"""


def one_hot_events(spark, sf):
    from pyspark.ml.feature import OneHotEncoder
    idx = indexed_events(spark, sf)
    enc = OneHotEncoder(inputCols=["event_type_index"], outputCols=["event_type_encoded"], dropLast=True)
    return enc.fit(idx).transform(idx)


@query("one_hot", f"SELECT event_id, event_type_vec FROM ({ONE_HOT_SQL})")
def q_one_hot(spark, sf):
    from pyspark.ml.functions import vector_to_array
    return one_hot_events(spark, sf).select("event_id", vector_to_array("event_type_encoded").alias("event_type_vec"))


@query("feature_vector", f"""
SELECT event_id, list_concat(event_type_vec, [value, CAST(user_id AS DOUBLE)]) AS features
FROM ({ONE_HOT_SQL})""")
def q_feature_vector(spark, sf):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    enc = one_hot_events(spark, sf).withColumn("user_id", F.col("user_id").cast("double"))
    vec = VectorAssembler(inputCols=["event_type_encoded", "value", "user_id"], outputCol="features").transform(enc)
    return vec.select("event_id", vector_to_array("features").alias("features"))


@query("ols_fit", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem""")
def q_ols_fit(spark, sf):
    from pyspark.ml.feature import VectorAssembler
    from driftwood.operators.features import linear_regression
    li = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(T(spark, sf, "lineitem"))
    model = linear_regression("l_extendedprice", reg_param=0.0, elastic_net=0.0, max_iter=100,
                              solver="normal").fit(li)
    # model coefficients are driver-side scalars; the result frame derives from the fit
    return li.agg(F.count(F.lit(1)).alias("n")).select(
        F.round(F.lit(float(model.coefficients[0])), 4).alias("slope"),
        F.round(F.lit(float(model.intercept)), 4).alias("intercept"))


@query("regression_metrics", """
SELECT count(*) AS n, round(sqrt(avg((l_extendedprice - l_quantity * 1000) ^ 2)), 6) AS rmse,
       round(1 - sum((l_extendedprice - l_quantity * 1000) ^ 2) / (var_pop(l_extendedprice) * count(*)), 6) AS r2
FROM lineitem""")
def q_regression_metrics(spark, sf):
    from driftwood.operators.features import regression_metrics
    li = T(spark, sf, "lineitem").withColumn("prediction", F.col("l_quantity") * 1000)
    m = regression_metrics(li, "l_extendedprice")
    return m.select("n", F.round("rmse", 6).alias("rmse"), F.round("r2", 6).alias("r2"))


@query("hash_split", """
WITH h AS (SELECT l_orderkey, l_linenumber,
                  md5(CAST(l_orderkey AS VARCHAR) || chr(1) || CAST(l_linenumber AS VARCHAR)) AS h FROM lineitem)
SELECT l_orderkey, l_linenumber,
       CASE WHEN (instr('0123456789abcdef', substr(h, 1, 1)) - 1) * 16
                 + (instr('0123456789abcdef', substr(h, 2, 1)) - 1) < 205 THEN 'train' ELSE 'test' END AS split
FROM h""")
def q_hash_split(spark, sf):
    from driftwood.operators.features import hash_split
    return hash_split(T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"),
                      ["l_orderkey", "l_linenumber"])


def _lineitem_training(spark, sf):
    li = T(spark, sf, "lineitem")
    return li.drop("l_shipdate")


@query("elastic_net_score")
def q_elastic_net_score(spark, sf):
    from driftwood.operators.features import score, train
    data = _lineitem_training(spark, sf)
    pm, lr, _ = train(data, "l_extendedprice", exclude=["l_orderkey", "l_partkey", "l_suppkey"],
                      split_keys=["l_orderkey", "l_linenumber"],
                      passthrough=["l_orderkey", "l_linenumber"])
    return score(data, pm, lr).select("l_orderkey", "l_linenumber", "prediction")


def _differences(one: DataFrame, other: DataFrame) -> DataFrame:
    """``n_rows`` of the first frame and ``n_different``, the rows (with
    repetitions) that only one of the two holds."""
    both = one.withColumn("side", F.lit(1)).unionByName(other.withColumn("side", F.lit(-1)))
    per_row = both.groupBy(*one.columns).agg(F.sum("side").alias("d"), F.count_if(F.col("side") == 1).alias("n"))
    return per_row.agg(F.sum("n").alias("n_rows"), F.sum(F.abs("d")).alias("n_different"))


@query("model_roundtrip", "SELECT count(*) AS n_rows, 0 AS n_different FROM lineitem")
def q_model_roundtrip(spark, sf):
    """Predictions of the stored and reloaded model against those of the model in memory."""
    from driftwood.operators.features import (load_pipeline, load_regression, save_model,
                                              score, train)
    data = _lineitem_training(spark, sf)
    pm, lr, _ = train(data, "l_extendedprice", exclude=["l_orderkey", "l_partkey", "l_suppkey"],
                      split_keys=["l_orderkey", "l_linenumber"],
                      passthrough=["l_orderkey", "l_linenumber"])
    base = scratch_path(spark, "models")
    save_model(pm, base, "features", 1)
    save_model(lr, base, "price", 1)
    columns = ["l_orderkey", "l_linenumber", "prediction"]
    return _differences(score(data, pm, lr).select(columns),
                        score(data, load_pipeline(base, "features", 1), load_regression(base, "price", 1)).select(columns))


@query("train_metrics", """
WITH h AS (SELECT md5(CAST(l_orderkey AS VARCHAR) || chr(1) || CAST(l_linenumber AS VARCHAR)) AS h FROM lineitem),
s AS (SELECT CASE WHEN (instr('0123456789abcdef', substr(h, 1, 1)) - 1) * 16
                    + (instr('0123456789abcdef', substr(h, 2, 1)) - 1) < 205 THEN 'train' ELSE 'test' END AS split FROM h)
SELECT split, count(*) AS n, true AS consistent FROM s GROUP BY split""")
def q_train_metrics(spark, sf):
    """Rows per split, and whether the reported errors are those of the scored rows."""
    from driftwood.operators.features import hash_split, regression_metrics, score, train
    data = _lineitem_training(spark, sf)
    keys = ["l_orderkey", "l_linenumber"]
    pm, lr, metrics = train(data, "l_extendedprice", exclude=["l_orderkey", "l_partkey", "l_suppkey"],
                            split_keys=keys, passthrough=keys)
    scored = hash_split(score(data, pm, lr), keys)
    again = None
    for split in ("train", "test"):
        m = regression_metrics(scored.where(F.col("split") == split), "l_extendedprice") \
            .select(F.lit(split).alias("split"), F.col("rmse").alias("rmse2"), F.col("r2").alias("r22"))
        again = m if again is None else again.unionByName(m)
    same = (F.abs(F.col("rmse") / F.col("rmse2") - 1) < 1e-9) & (F.abs(F.col("r2") - F.col("r22")) < 1e-9)
    return metrics.join(again, "split").select("split", "n", same.alias("consistent"))


# ------------------------------------------------------------------------
# Files in a drop folder, refresh, CSV
# ------------------------------------------------------------------------

@query("read_with_key", "SELECT *, strftime(o_orderdate, '%Y') AS file_key FROM orders")
def q_read_with_key(spark, sf):
    from driftwood.sources.files import read_keyed
    from driftwood.sources.sinks import write_table
    orders = T(spark, sf, "orders")
    root = scratch_path(spark, "drops")
    for y in _years(orders, "o_orderdate"):
        write_table(orders.where(_year_range("o_orderdate", y)), f"{root}/{y}_orders.parquet")
    return read_keyed(spark, root, 4, key_col="file_key")


@query("partition_refresh", FACT_LISTING_SQL)
def q_partition_refresh(spark, sf):
    from driftwood.sources.sinks import refresh_star
    base = scratch_path(spark, "star")
    tables = OrderedDict([
        ("dim_year", dim_year_frame(spark, sf)),
        ("dim_day", st.dim_day(days_frame(spark, sf))),
        ("fact_listing", fact_listing_frame(spark, sf))])
    refresh_star(spark, tables, base)
    paths = refresh_star(spark, tables, base)  # a second full refresh replaces, never appends
    return spark.read.parquet(paths["fact_listing"])


@query("outlier_csv", f"""
WITH b AS ({_bounds_sql('events', 'value', 1.5)})
SELECT e.*, 'value' AS outlier_column FROM events e, b
WHERE e.value < b.lower_bound OR e.value > b.upper_bound""")
def q_outlier_csv(spark, sf):
    from driftwood.sources.sinks import write_csv
    ev = T(spark, sf, "events")
    rows = ol.outlier_rows(ev, ol.iqr_bounds(ev, ["value"], 1.5, exact=True))
    path = write_csv(rows, scratch_path(spark, "outliers"), header=True)
    from driftwood.sources.files import read_csv
    return read_csv(spark, path, rows.schema, header=True)


# ------------------------------------------------------------------------
# The jobs end to end on the driver tables
# ------------------------------------------------------------------------

def _stored_by(spark, path: str, period: str) -> DataFrame:
    """A table stored by a text period; its columns in the order of their names."""
    from driftwood.sources.sinks import read_stored
    df = read_stored(spark, path, "parquet", period, StringType())
    return df.select(*sorted(df.columns))


@query("job_formatted_orders", """
SELECT o_custkey, o_orderdate, o_orderkey,
       CASE WHEN year(o_orderdate) % 2 = 1 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
       o_orderstatus, o_totalprice, CAST(year(o_orderdate) AS VARCHAR) AS year
FROM orders""")
def q_job_formatted_orders(spark, sf):
    """Yearly drops with drift (upper-case names, a missing column, price as
    text) → J3/J4-style load into a stored table, read back."""
    from driftwood.plans.jobs import SourceConfig, format_and_load
    from driftwood.sources.sinks import write_table
    orders = T(spark, sf, "orders")
    root = scratch_path(spark, "order-drops")
    for y in _years(orders, "o_orderdate"):
        f = orders.where(_year_range("o_orderdate", y))
        if y % 2 == 1:
            f = f.drop("o_orderpriority")
        if y == 1996:
            f = f.withColumn("o_totalprice", F.col("o_totalprice").cast("string"))
        write_table(f.toDF(*[c.upper() for c in f.columns]), f"{root}/{y}_orders.parquet")
    target = scratch_path(spark, "formatted-orders")
    cfg = SourceConfig(root=root, target=target, keys=["o_orderkey", "year"], key_len=4, key_col="year",
                       overrides={"o_totalprice": "double"}, outliers=True,
                       outlier_exclude=["o_orderkey", "o_custkey"], factor=3.0,
                       report_dir=scratch_path(spark, "order-outliers"), partition_by="year")
    format_and_load(spark, cfg)
    return _stored_by(spark, target, "year")


RECONCILE_LOOKUP_SQL = """
SELECT p_partkey AS id,
       CASE WHEN p_size <= 25 THEN p_name
            ELSE split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1) END AS reconciled_name
FROM part WHERE p_type = 'SMALL'"""

# Manual corrections applied by the reconciliation job.
RECONCILE_OVERRIDES = [("blue bolt", -1, None, None), ("rusty sprocket", -2, "rusty sprocket", 1.0)]


@query("job_reconcile", f"""
WITH lk AS ({RECONCILE_LOOKUP_SQL}),
names AS (SELECT DISTINCT p_name FROM part p WHERE p_type = 'ECONOMY'
          AND NOT EXISTS (SELECT 1 FROM lk WHERE lk.reconciled_name = p.p_name)),
s AS (SELECT n.p_name, lk.id, lk.reconciled_name,
             {TOKENS_SQL.format(x='n.p_name')} AS a, {TOKENS_SQL.format(x='lk.reconciled_name')} AS b
      FROM names n CROSS JOIN lk WHERE n.p_name IS NOT NULL AND lk.reconciled_name IS NOT NULL),
j AS (SELECT p_name, id, reconciled_name,
             CASE WHEN len(list_distinct(list_concat(a, b))) = 0 THEN 0.0
                  ELSE len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) END AS similarity FROM s),
f AS (SELECT * FROM j WHERE similarity >= 0.3),
b AS (SELECT p_name, id, reconciled_name, similarity FROM (
        SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY similarity DESC, id ASC, reconciled_name ASC) AS rn
        FROM f) WHERE rn = 1),
o AS (SELECT * FROM (VALUES ('blue bolt', -1, NULL, NULL), ('rusty sprocket', -2, 'rusty sprocket', 1.0))
        v(p_name, id, reconciled_name, similarity))
SELECT b.p_name, coalesce(o.id, b.id) AS id, coalesce(o.reconciled_name, b.reconciled_name) AS reconciled_name,
       coalesce(o.similarity, b.similarity) AS similarity
FROM b LEFT JOIN o ON b.p_name = o.p_name
UNION ALL SELECT p_name, id, reconciled_name, similarity FROM o WHERE p_name NOT IN (SELECT p_name FROM b)""")
def q_job_reconcile(spark, sf):
    """J6 on part names: the lookup spells some names with their words swapped."""
    from driftwood.plans.jobs import ReconcileConfig, reconcile
    part = T(spark, sf, "part")
    words = F.split("p_name", " ")
    lookup = part.where(F.col("p_type") == "SMALL").select(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_size") <= 25, F.col("p_name"))
         .otherwise(F.concat(F.get(words, 1), F.lit(" "), F.get(words, 0))).alias("reconciled_name"))
    overrides = spark.createDataFrame(RECONCILE_OVERRIDES,
                                      "p_name string, id long, reconciled_name string, similarity double")
    cfg = ReconcileConfig(name_col="p_name", lookup_name_col="reconciled_name", lookup_id_col="id",
                          row_filter="p_type = 'ECONOMY'", threshold=0.3, overrides=overrides,
                          target=scratch_path(spark, "resolved-names"))
    resolved, _ = reconcile(part, lookup, cfg)
    return spark.read.parquet(cfg.target)


def _pk_sql(name, sql, keys):
    return (f"SELECT 'pk' AS check_name, '{name}' AS table_name, (SELECT count(*) FROM "
            f"(SELECT {keys} FROM ({sql}) GROUP BY {keys} HAVING count(*) > 1)) AS n_violations")


def _fk_sql(child, csql, fk, parent, psql, pk):
    return (f"SELECT 'fk:{parent}' AS check_name, '{child}' AS table_name, (SELECT count(*) FROM ({csql}) c "
            f"WHERE c.{fk} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM ({psql}) p WHERE p.{pk} = c.{fk})) AS n_violations")


@query("job_star", " UNION ALL ".join([
    _pk_sql("dim_year", DIM_YEAR_SQL, "year"),
    _pk_sql("dim_month", DIM_MONTH_SQL, "month"),
    _pk_sql("dim_day", DIM_DAY_SQL, "day"),
    _pk_sql("dim_location", DIM_LOCATION_SQL, "n_name"),
    _pk_sql("fact_listing", FACT_LISTING_SQL, "o_orderkey, day, location_id"),
    _pk_sql("fact_income", FACT_INCOME_SQL, "segment, location_id"),
    f"SELECT 'not_null' AS check_name, 'fact_listing' AS table_name, (SELECT count(*) FROM ({FACT_LISTING_SQL}) "
    f"WHERE location_id IS NULL) AS n_violations",
    f"SELECT 'not_null' AS check_name, 'fact_income' AS table_name, (SELECT count(*) FROM ({FACT_INCOME_SQL}) "
    f"WHERE location_id IS NULL) AS n_violations",
    _fk_sql("fact_listing", FACT_LISTING_SQL, "day", "dim_day", DIM_DAY_SQL, "day"),
    _fk_sql("dim_day", DIM_DAY_SQL, "month", "dim_month", DIM_MONTH_SQL, "month"),
    _fk_sql("dim_month", DIM_MONTH_SQL, "year", "dim_year", DIM_YEAR_SQL, "year"),
    _fk_sql("fact_listing", FACT_LISTING_SQL, "location_id", "dim_location", DIM_LOCATION_SQL, "n_name"),
    _fk_sql("fact_income", FACT_INCOME_SQL, "location_id", "dim_location", DIM_LOCATION_SQL, "n_name"),
]))
def q_job_star(spark, sf):
    """Refresh the star (dimensions, then facts) and check its constraints (C11)."""
    from driftwood.plans.jobs import build_star, star_constraints
    dims = OrderedDict([
        ("dim_year", dim_year_frame(spark, sf)),
        ("dim_month", st.dim_month(days_frame(spark, sf), months_frame(spark, sf))),
        ("dim_day", st.dim_day(days_frame(spark, sf))),
        ("dim_location", dim_location_frame(spark, sf))])
    facts = OrderedDict([("fact_listing", fact_listing_frame(spark, sf)),
                         ("fact_income", fact_income_frame(spark, sf))])
    paths = build_star(spark, dims, facts, scratch_path(spark, "star-job"))
    tables = {n: spark.read.parquet(p) for n, p in paths.items()}
    report = star_constraints(
        tables,
        pks={"dim_year": ["year"], "dim_month": ["month"], "dim_day": ["day"], "dim_location": ["n_name"],
             "fact_listing": ["o_orderkey", "day", "location_id"], "fact_income": ["segment", "location_id"]},
        not_null={"fact_listing": ["location_id"], "fact_income": ["location_id"]},
        fks=[("fact_listing", ["day"], "dim_day", ["day"]), ("dim_day", ["month"], "dim_month", ["month"]),
             ("dim_month", ["year"], "dim_year", ["year"]),
             ("fact_listing", ["location_id"], "dim_location", ["n_name"]),
             ("fact_income", ["location_id"], "dim_location", ["n_name"])])
    return report


@query("job_train_predict", "SELECT count(*) AS n_rows, 0 AS n_different FROM lineitem")
def q_job_train_predict(spark, sf):
    """J8 then J9: train, store version 1, score the table with the stored
    version; against a model trained the same way that was never stored."""
    from driftwood.operators.features import score, train
    from driftwood.plans.jobs import predict_job, train_job
    data = _lineitem_training(spark, sf)
    model_dir = scratch_path(spark, "registry")
    keys = ["l_orderkey", "l_linenumber"]
    options = {"exclude": ["l_orderkey", "l_partkey", "l_suppkey"], "split_keys": keys, "passthrough": keys}
    train_job(data, "l_extendedprice", model_dir, "price", 1, **options).collect()
    pm, lr, _ = train(data, "l_extendedprice", **options)
    # two fits may differ in the last bits of a sum
    columns = [*keys, F.round("prediction", 4).alias("prediction")]
    return _differences(predict_job(data, model_dir, "price", 1).select(columns), score(data, pm, lr).select(columns))


@query("notebook_features", """
WITH e AS (SELECT event_id, event_type, value, CASE WHEN value > 100 THEN 'true' ELSE 'false' END AS hv FROM events),
i1 AS (SELECT event_type, row_number() OVER (ORDER BY n DESC, event_type) - 1 AS idx
       FROM (SELECT event_type, count(*) AS n FROM e GROUP BY 1)),
i2 AS (SELECT hv, row_number() OVER (ORDER BY n DESC, hv) - 1 AS idx FROM (SELECT hv, count(*) AS n FROM e GROUP BY 1)),
k1 AS (SELECT count(*) AS k FROM i1), k2 AS (SELECT count(*) AS k FROM i2)
SELECT event_id,
       list_concat(
         list_transform(range(k1.k - 1), lambda j: CASE WHEN j = i1.idx THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END),
         list_transform(range(k2.k - 1), lambda j: CASE WHEN j = i2.idx THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END),
         [value]) AS features
FROM e JOIN i1 USING (event_type) JOIN i2 USING (hv), k1, k2""")
def q_notebook_features(spark, sf):
    """Booleans become categories, constant categories are dropped (E9),
    one pipeline from projection to assembled vector."""
    from pyspark.ml.functions import vector_to_array

    from driftwood.operators.features import feature_pipeline
    ev = T(spark, sf, "events").select(
        "event_id", "event_type", "value", (F.col("value") > 100).alias("high_value"),
        F.when(F.col("event_id").isNotNull(), F.lit("web")).alias("channel"))
    ev = qa.drop_constant(ev, ["event_type", "channel"])
    model = feature_pipeline(ev, "target_none", exclude=["event_id"], categorical_booleans=True,
                             passthrough=["event_id"]).fit(ev)
    return model.transform(ev).select("event_id", vector_to_array("features").alias("features"))


@query("job_lookup_load", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def q_job_lookup_load(spark, sf):
    """Two lookup drops selected by name prefix (overlapping rows, columns
    in another order) → united by name → one row per key → repaired → upsert."""
    from driftwood.plans.jobs import SourceConfig, format_and_load
    from driftwood.sources.sinks import write_table
    nation = T(spark, sf, "nation")
    root = scratch_path(spark, "lookup-drops")
    write_table(nation.where(F.col("n_regionkey") <= 2), f"{root}/lookup_a.parquet")
    write_table(nation.where(F.col("n_regionkey") >= 2).select("n_regionkey", "n_name", "n_nationkey"),
                f"{root}/lookup_b.parquet")
    write_table(nation, f"{root}/other.parquet")  # not a lookup drop: not selected
    target = scratch_path(spark, "lookup-table")
    format_and_load(spark, SourceConfig(root=root, target=target, keys=["n_nationkey"], prefix="lookup",
                                        align=False, lowercase=False))
    return spark.read.parquet(target)


def _station_drops(spark, sf):
    """Suppliers as yearly station drops with upper-case names: nations 0–4
    in 2018, 5–14 in 2019, 15 and above in 2020."""
    from driftwood.sources.sinks import write_table
    sup = T(spark, sf, "supplier")
    root = scratch_path(spark, "station-drops")
    for year, cond in ((2018, F.col("s_nationkey") < 5),
                       (2019, (F.col("s_nationkey") >= 5) & (F.col("s_nationkey") < 15)),
                       (2020, F.col("s_nationkey") >= 15)):
        part = sup.where(cond)
        write_table(part.toDF(*[c.upper() for c in part.columns]), f"{root}/{year}_stations.parquet")
    return root


@query("job_year_lookup", """
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, CASE WHEN s_nationkey < 15 THEN 2019 ELSE 2020 END AS year
FROM supplier WHERE s_nationkey >= 5""")
def q_job_year_lookup(spark, sf):
    """Yearly drops, integer year key, the 2018 drop loaded to its own table."""
    from driftwood.plans.jobs import SourceConfig, format_and_load
    root = _station_drops(spark, sf)
    target = scratch_path(spark, "stations")
    format_and_load(spark, SourceConfig(root=root, target=target, keys=["s_suppkey", "year"], key_len=4,
                                        key_col="year", key_type="int", separate_keys=["2018"]))
    return spark.read.parquet(target)


@query("job_monthly_drops", """
SELECT o_custkey, o_orderdate, o_orderkey, o_orderpriority, o_orderstatus, o_totalprice, month FROM (
  SELECT *, strftime(o_orderdate, '%Y') || '_' ||
            lpad(CAST(((month(o_orderdate) - 1) // 3) * 3 + 1 AS VARCHAR), 2, '0') AS month FROM orders)
WHERE month(o_orderdate) >= 4 AND month > '1998_03'""")
def q_job_monthly_drops(spark, sf):
    """Quarterly drops keyed ``YYYY_MM``; the January drops are broken
    (one column), 1999 carries prices as text; only keys after ``1998_03``
    are loaded, every column cast to the family's type."""
    from driftwood.plans.jobs import SourceConfig, format_and_load
    from driftwood.sources.sinks import write_table
    orders = T(spark, sf, "orders")
    root = scratch_path(spark, "monthly-drops")
    for y in _years(orders, "o_orderdate"):
        for m in (1, 4, 7, 10):
            lo = _ntz(dt.datetime(y, m, 1))
            hi = _ntz(dt.datetime(y + (m == 10), 1 if m == 10 else m + 3, 1))
            part = orders.where((F.col("o_orderdate") >= lo) & (F.col("o_orderdate") < hi))
            if m == 1:
                part = part.select("o_orderkey")
            elif y == 1999:
                part = part.withColumn("o_totalprice", F.col("o_totalprice").cast("string"))
            write_table(part, f"{root}/{y}_{m:02d}_orders.parquet")
    target = scratch_path(spark, "monthly-table")
    format_and_load(spark, SourceConfig(root=root, target=target, keys=["o_orderkey", "month"], key_len=7,
                                        key_col="month", min_columns=2, split_bound="1998_03",
                                        cast_all=True, outliers=True,
                                        outlier_exclude=["o_orderkey", "o_custkey"], partition_by="month"))
    return _stored_by(spark, target, "month")


@query("stream_drop_load", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       strftime(o_orderdate, '%Y') AS year FROM orders""")
def q_stream_drop_load(spark, sf):
    """Yearly order drops arriving in two waves, loaded incrementally with
    Structured Streaming (each run picks up only the new drops) → stored table."""
    from driftwood.sources.sinks import write_table
    from driftwood.streaming.drops import load_new_drops
    orders = T(spark, sf, "orders")
    root = scratch_path(spark, "stream-drops")
    target = scratch_path(spark, "stream-table")
    years = _years(orders, "o_orderdate")
    half = len(years) // 2
    checkpoint = None
    for wave in (years[:half], years[half:]):
        for y in wave:
            write_table(orders.where(_year_range("o_orderdate", y)), f"{root}/{y}_orders.parquet")
        checkpoint = load_new_drops(spark, root, orders.schema, 4, "year", target,
                                    ["o_orderkey", "year"], checkpoint=checkpoint, partition_by="year")
    return _stored_by(spark, target, "year")
