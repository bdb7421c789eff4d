
from pyspark.sql import functions as F

from driftwood.operators import features as ft
from driftwood.operators import star as st
from driftwood.session import scratch_path


def star_fixture(spark):
    days = spark.createDataFrame([("2020_01_05",), ("2020_01_06",), ("2021_03_01",), (None,)], "day string")
    months = spark.createDataFrame([("2020_02",), ("2022_07",)], "month string")
    years = spark.createDataFrame([(2019,), (2020,)], "any int")
    loc = spark.createDataFrame([("Q1", "Gràcia", "D1"), ("Q2", "Sants", "D2")], "id string, name string, district string")
    listings = spark.createDataFrame([("p1", "2020_01_05", "Q1", 100.0), ("p2", "2020_01_05", "Q1", 300.0),
                                      ("p3", "2021_03_01", "Q2", 50.0)],
                                     "code string, day string, id string, price double")
    income = spark.createDataFrame([("2020", "Q1", 90.0), ("2021", "Q1", 110.0), ("2020", "Q2", 70.0)],
                                   "year string, id string, rfd double")
    return days, months, years, loc, listings, income


def test_dimensions(spark):
    days, months, years, *_ = star_fixture(spark)
    dy = st.dim_year(years, days.select(F.split("day", "_")[0]), months.select(F.split("month", "_")[0]))
    assert sorted(r.year for r in dy.collect()) == ["2019", "2020", "2021", "2022"]
    dm = {r.month: r.year for r in st.dim_month(days, months).collect()}
    assert dm == {"2020_01": "2020", "2021_03": "2021", "2020_02": "2020", "2022_07": "2022"}
    dd = {r.day: r.month for r in st.dim_day(days).collect()}
    assert dd["2021_03_01"] == "2021_03" and len(dd) == 3


def test_star_join_and_drill_across_do_not_fan_out(spark):
    days, months, years, loc, listings, income = star_fixture(spark)
    joined = st.star_join(listings, [(st.dim_day(days), "day", "day"),
                                     (st.dim_month(days, months), "month", "month"),
                                     (loc, "id", "id")])
    assert joined.count() == 3 and {"month", "year", "name", "district"} <= set(joined.columns)
    d = st.drill_across(listings, income, "id", [F.avg("price").alias("avg_price"), F.count("*").alias("n")],
                        [F.avg("rfd").alias("avg_rfd")])
    got = {r.id: (r.avg_price, r.n, r.avg_rfd) for r in d.collect()}
    assert got == {"Q1": (200.0, 2, 100.0), "Q2": (50.0, 1, 70.0)}


def test_kpis(spark):
    days, months, years, loc, listings, income = star_fixture(spark)
    per_day = {str(r.date): r.n_rows for r in st.kpi_rows_per_day(listings).collect()}
    assert per_day == {"2020-01-05": 2, "2021-03-01": 1}
    by_dim = st.kpi_by_dimension(income, loc, "id", "id", ["district", "name"], ["rfd"])
    assert {r.name: r.avg_rfd for r in by_dim.collect()} == {"Gràcia": 100.0, "Sants": 70.0}


def features_fixture(spark):
    rows = [(i, i * 2, float(i) if i % 4 else None, i % 2 == 0, ["x", "y", None][i % 3], 1000.0 * i + 5)
            for i in range(1, 41)]
    return spark.createDataFrame(rows, "k long, rooms int, size double, lift boolean, kind string, price double")


def test_feature_roles_and_pipeline(spark):
    df = features_fixture(spark)
    roles = ft.feature_roles(df, "price", exclude=["k"])
    assert roles == {"numeric": ["rooms", "size"], "boolean": ["lift"], "categorical": ["kind"]}
    model = ft.feature_pipeline(df, "price", exclude=["k"]).fit(df)
    out = model.transform(df)
    # kind: x, y, UNKNOWN -> 3 categories, one dropped; then 2 numerics; booleans not assembled
    assert out.first().features.size == 4
    assert out.where(F.col("size").isNull()).count() == 0
    unseen = df.limit(1).withColumn("kind", F.lit("never-seen"))
    assert model.transform(unseen).count() == 0  # unseen categories are skipped


def test_train_save_load_score(spark):
    df = features_fixture(spark)
    pm, lr, metrics = ft.train(df, "price", exclude=["k"], split_keys=["k"], passthrough=["k"])
    assert {r.split for r in metrics.collect()} == {"train", "test"}
    base = scratch_path(spark, "model-test")
    ft.save_model(pm, base, "features", 1)
    ft.save_model(lr, base, "price", 1)
    a = ft.score(df, pm, lr).select("k", "prediction").collect()
    b = ft.score(df, ft.load_pipeline(base, "features", 1), ft.load_regression(base, "price", 1)) \
        .select("k", "prediction").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_hash_split_is_stable(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a = ft.hash_split(df, ["k"]).where("split = 'train'").count()
    b = ft.hash_split(df.repartition(7), ["k"]).where("split = 'train'").count()
    assert a == b and 1400 < a < 1800


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 3.0)], "y double, prediction double")
    r = ft.regression_metrics(df, "y").first()
    assert abs(r.rmse - (1 / 3) ** 0.5) < 1e-12 and abs(r.r2 - 0.5) < 1e-12
