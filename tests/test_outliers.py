
from pyspark.sql import functions as F

from driftwood.operators import outliers as ol


def outlier_fixture(spark):
    vals = [float(x) for x in range(1, 21)] + [100.0, -50.0, None, float("nan")]
    rows = [(i, v, None, (i % 5) * 1.0) for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "id int, v double, empty double, w double")


def test_continuous_columns(spark):
    df = outlier_fixture(spark)
    assert ol.continuous_columns(df, 10, exclude=["id"]) == ["v"]


def test_bounds_exact_and_report(spark):
    df = outlier_fixture(spark)
    b = ol.iqr_bounds(df, ["v", "empty"], 1.5, exact=True)
    assert b["empty"].q1 is None and b["empty"].lower is None
    q = ol.iqr_bounds(df, ["v"], 1.5, relative_error=0.0)["v"]
    assert (b["v"].q1, b["v"].q3) == (q.q1, q.q3)
    rep = {r.column_name: r.n_outliers for r in ol.outlier_report(df, b).collect()}
    # 100, -50 and NaN (ordered above every number) are outliers; null is not
    assert rep == {"v": 3, "empty": 0}
    rep2 = {r.column_name: r.n_outliers for r in ol.outlier_report(df, b, nan_is_outlier=False).collect()}
    assert rep2["v"] == 2


def test_outlier_rows_one_scan(spark):
    df = outlier_fixture(spark)
    b = ol.iqr_bounds(df, ["v", "w"], 1.5, exact=True)
    rows = ol.outlier_rows(df, b).collect()
    assert sorted(r.id for r in rows if r.outlier_column == "v") == [20, 21, 23]


def test_sequential_delete_order_matters(spark):
    rows = [(float(i), float(i % 7)) for i in range(40)] + [(1000.0, 3.0), (5.0, 500.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    kept, bounds = ol.iqr_delete(df, ["a", "b"], 1.5, exact=True)
    for c, bd in bounds.items():
        bad = kept.where((F.col(c) < bd.lower) | (F.col(c) > bd.upper)).count()
        assert bad == 0
    kept2, _ = ol.iqr_delete(df, ["b", "a"], 1.5, exact=True)
    assert kept.count() == 40 and kept2.count() == 40
    _, _, report = ol.treat_outliers(df, ["a", "b"], 1.5, delete=True, exact=True)
    assert {r.column_name: r.n_outliers for r in report.collect()} == {"a": 1, "b": 1}


def test_bounds_frame_matches_driver_bounds(spark):
    df = outlier_fixture(spark)
    b = ol.iqr_bounds(df, ["v"], 3.0, exact=True)["v"]
    r = ol.iqr_bounds_frame(df, ["v"], 3.0).first()
    assert (r.lower_bound, r.upper_bound) == (b.lower, b.upper)


def test_exact_quantiles_match_percentile_disc_with_narrowing(spark):
    import random
    rnd = random.Random(3)
    vals = [rnd.choice([rnd.gauss(0, 1), rnd.expovariate(0.01), 5.0]) for _ in range(5000)] + [float("nan"), None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    # a tiny final set and a coarse sketch force several narrowing passes
    got = ol.exact_quantiles(df, ["x"], probs, final_rows=7, accuracy=20)["x"]
    want = [df.where("NOT isnan(x)").selectExpr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY x)").first()[0]
            for p in probs]
    assert got == want
    assert ol.exact_quantiles(df.where("x IS NULL"), ["x"], [0.5]) == {"x": [None]}


def test_one_job_per_statistic(spark):
    from tests.conftest import SF_SMALL
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    sc = spark.sparkContext
    tracker = sc.statusTracker()

    import itertools
    counter = itertools.count()

    def jobs(fn):
        group = f"one-job-test-{next(counter)}"
        sc.setJobGroup(group, group)
        try:
            fn()
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(group))

    from pyspark.sql import functions as F
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey", "l_suppkey"]
    # a statistic over six columns costs what one aggregate over one column costs
    one = jobs(lambda: li.agg(F.approx_count_distinct("l_quantity")).first())
    assert jobs(lambda: ol.continuous_columns(li.select(*cols), 10)) == one
    bounds = {}
    assert jobs(lambda: bounds.update(ol.iqr_bounds(li, cols, 3.0))) <= one
    assert jobs(lambda: ol.outlier_report(li, bounds).collect()) == one


def test_no_continuous_columns_gives_empty_report(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 2.0)], "k int, v double")
    kept, bounds, report = ol.treat_outliers(df, [], 3.0)
    assert bounds == {} and report.count() == 0 and kept.count() == 2
    kept, bounds, report = ol.treat_outliers(df, [], 3.0, delete=True)
    assert report.count() == 0 and kept.count() == 2
    assert ol.outlier_rows(df, {}).count() == 0


def test_approximate_quartiles_within_rank_error(spark):
    from tests.conftest import SF_SMALL
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    n = li.count()
    err = 0.01
    b = ol.iqr_bounds(li, ["l_extendedprice"], 1.5, relative_error=err)["l_extendedprice"]
    for p, v in ((0.25, b.q1), (0.75, b.q3)):
        below = li.where(f"l_extendedprice < {v!r}").count()
        at_most = li.where(f"l_extendedprice <= {v!r}").count()
        # the value's rank range must meet the target rank p·n within err·n
        assert below - err * n <= p * n <= at_most + err * n


def test_exact_quantiles_end_with_infinities_ties_and_many_columns(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(float(i % 9), 3 if i % 4 else i, None if i % 3 else nan, 1e300 if i == 5 else float(i), -inf if i % 2 else inf, i)
            for i in range(400)] + [(inf, 3, -inf, nan, None, -7)]
    df = spark.createDataFrame(rows, "a double, b int, c double, d double, e double, f long")
    probs = [0.25, 0.5, 0.75, 1.0]
    for final_rows in (5, 10_000):
        got = ol.exact_quantiles(df, df.columns, probs, final_rows=final_rows, accuracy=30)
        for c, t in df.dtypes:
            ok = f"NOT isnan({c})" if t == "double" else "true"
            want = [df.where(ok).selectExpr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {c})").first()[0] for p in probs]
            assert got[c] == want, c


def test_exact_quantiles_take_few_jobs(spark):
    sc, group = spark.sparkContext, "exact-quantile-jobs"
    df = spark.range(300_000, numPartitions=4).selectExpr(*[f"hash(id, {i}) AS c{i}" for i in range(6)])
    sc.setJobGroup(group, group)
    got = ol.exact_quantiles(df, df.columns, [0.25, 0.75])
    # adaptive execution runs a map and a result job per aggregate
    assert len(sc.statusTracker().getJobIdsForGroup(group)) <= 2 * 3
    want = df.selectExpr(*[f"percentile_disc({p}) WITHIN GROUP (ORDER BY {c})" for c in df.columns for p in (0.25, 0.75)]).first()
    assert [v for c in df.columns for v in got[c]] == list(want)


def test_histogram_leaves_out_what_is_not_finite(spark):
    from driftwood.operators.quality import histogram
    df = spark.createDataFrame([(float(x),) for x in range(11)] + [(float("nan"),), (float("inf"),), (None,)], "x double")
    assert sorted((r.bin, r.n) for r in histogram(df, ["x"], 5).collect()) == [(0, 2), (1, 2), (2, 2), (3, 2), (4, 3)]
