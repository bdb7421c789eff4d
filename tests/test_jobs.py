from pyspark.sql import functions as F

from driftwood.plans.jobs import ReconcileConfig, SourceConfig, format_and_load, list_files, reconcile
from driftwood.session import scratch_path


def write_drops(spark):
    root = scratch_path(spark, "job-drops")
    good = "CODI_DISTRICTE int, Codi_Barri int, nom string, Valor string"
    spark.createDataFrame([(1, 1, "Gràcia", "60.3"), (1, 1, "Gràcia", "60.3"), (2, 80, "x", "1")], good) \
        .write.parquet(f"{root}/2018_a.parquet")
    spark.createDataFrame([(1, 2, "GrÃ\xa0cia", " 61.5 "), (3, 5, "Sants", "-")], good) \
        .write.parquet(f"{root}/2019_b.parquet")
    spark.createDataFrame([(4, 6, "Horta", 70.0)], "codi_districte int, codi_barri int, nom string, valor double") \
        .write.parquet(f"{root}/2020_c.parquet")
    spark.createDataFrame([(9,)], "only int").write.parquet(f"{root}/2021_broken.parquet")
    spark.createDataFrame([(9,)], "only int").write.parquet(f"{root}/notes.parquet")
    return root


def test_format_and_load_paths(spark):
    root = write_drops(spark)
    assert len(list_files(spark, root, key_len=4)) == 4
    target = scratch_path(spark, "job-target")
    cfg = SourceConfig(root=root, target=target, keys=["codi_districte", "codi_barri", "year"], key_len=4,
                       key_col="year", key_type="int", min_columns=2,
                       separate_keys=["2018"], ranges={"codi_districte": (1, 10), "codi_barri": (1, 73)},
                       parse_double_cols=["valor"])
    res = format_and_load(spark, cfg)
    main = {(r.codi_districte, r.year): (r.nom, r.valor) for r in spark.read.parquet(target).collect()}
    # the broken 2021 drop is dropped, 2018 goes to its own table, mojibake is repaired
    assert main == {(1, 2019): ("Gràcia", 61.5), (3, 2019): ("Sants", None), (4, 2020): ("Horta", 70.0)}
    sep = spark.read.parquet(f"{target}_2018").collect()
    assert [(r.codi_districte, r.codi_barri, r.valor) for r in sep] == [(1, 1, 60.3)]
    assert set(res) == {"2018", "main", "missing_columns", "type_conflicts"}
    conflicts = {(r.column_name, r.data_type) for r in res["type_conflicts"].collect()}
    assert ("valor", "string") in conflicts and ("valor", "double") in conflicts


def test_format_and_load_split_bound_and_outliers(spark):
    root = scratch_path(spark, "job-months")
    for m, rows in {"2019_02": [(1, 1.0)], "2019_03": [(2, 2.0)], "2019_04": [(i, float(i)) for i in range(3, 40)],
                    "2019_05": [(40, 1000.0), (41, 41.0)]}.items():
        spark.createDataFrame(rows, "id int, h01 double").write.parquet(f"{root}/{m}_aq.parquet")
    target = scratch_path(spark, "job-aq")
    cfg = SourceConfig(root=root, target=target, keys=["id"], key_len=7, key_col="month", cast_all=True,
                       split_bound="2019_03", outliers=True, outlier_exclude=["id"], factor=3.0,
                       delete_outliers=True, relative_error=0.0,
                       report_dir=scratch_path(spark, "job-aq-report"))
    res = format_and_load(spark, cfg)
    out = spark.read.parquet(target)
    assert out.where(F.col("month") <= "2019_03").count() == 0
    assert out.where(F.col("h01") == 1000.0).count() == 0 and out.count() == 38
    report = {r.column_name: r.n_outliers for r in res["main"]["report"].collect()}
    assert report == {"h01": 1}


def test_reconcile(spark):
    listings = spark.createDataFrame(
        [("Barcelona", "el Poble Sec"), ("Barcelona", "Vila de Gràcia"), ("Barcelona", "Sant Andreu"),
         ("Girona", "Sants"), ("Barcelona", None)], "municipality string, neighborhood string")
    lookup = spark.createDataFrame([("Q1", "el Poble Sec"), ("Q2", "Sant Andreu de Palomar"),
                                    ("Q3", "la Vila de Gràcia")], "id string, name string")
    cfg = ReconcileConfig("neighborhood", "name", "id", row_filter="municipality = 'Barcelona'")
    best, left = reconcile(listings, lookup, cfg)
    got = {r.neighborhood: r.id for r in best.collect()}
    assert got == {"Vila de Gràcia": "Q3", "Sant Andreu": "Q2"}
    assert [r.neighborhood for r in left.collect()] == [None]


def test_read_keyed_and_read_frames(spark):
    from driftwood.sources.files import read_frames, read_keyed
    root = scratch_path(spark, "keyed-read")
    spark.createDataFrame([(1, "a")], "id int, v string").write.parquet(f"{root}/2019_01_01_x.parquet")
    spark.createDataFrame([(2, "b")], "id int, v string").write.parquet(f"{root}/2019_01_01_y.parquet")
    spark.createDataFrame([(3, "c", 1.5)], "id int, v string, w double").write.parquet(f"{root}/2019_01_02_x.parquet")
    spark.createDataFrame([(9, "z")], "id int, v string").write.parquet(f"{root}/readme.parquet")
    one_scan = read_keyed(spark, root, 10, key_col="day")
    got = sorted((r.id, r.day, r.w) for r in one_scan.collect())
    assert got == [(1, "2019_01_01", None), (2, "2019_01_01", None), (3, "2019_01_02", 1.5)]
    frames = read_frames(spark, list_files(spark, root, key_len=10), key_len=10)
    # two files of the same key are united, not overwritten
    assert list(frames) == ["2019_01_01", "2019_01_02"] and frames["2019_01_01"].count() == 2
