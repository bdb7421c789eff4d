"""The reference pipeline end to end on invented drops in its data model."""

from pyspark.sql import functions as F

from driftwood.plans import configs as cf
from driftwood.plans.jobs import build_star, format_and_load, predict_job, star_constraints
from driftwood.session import scratch_path

INCOME_A = ("Any int, Codi_Districte int, Nom_Districte string, Codi_Barri int, Nom_Barri string, "
            "`Població` int, `Índex RFD Barcelona = 100` string")
INCOME_B = INCOME_A.replace("`Índex RFD Barcelona = 100` string", "`Índex RFD Barcelona = 100` double")
LISTING = ("propertyCode string, price double, size double, rooms int, bathrooms int, distance string, "
           "municipality string, neighborhood string, district string, province string, hasLift boolean, "
           "parkingSpace struct<hasParkingSpace:boolean,isParkingSpaceIncludedInPrice:boolean,"
           "parkingSpacePrice:double>")
AIR = "codi_provincia int, codi_municipi int, estacio int, codi_contaminant int, mes int, dia int, h01 double, h02 double"
LOOKUP = "neighborhood_id string, district string, neighborhood string, neighborhood_n_reconciled string"


def write_drops(spark):
    root = scratch_path(spark, "reference-model")
    inc = f"{root}/income"
    spark.createDataFrame([(2017, 1, "Ciutat Vella", 1, "el Raval", 47000, "101.5"),
                           (2017, 6, "Gràcia", 31, "la Vila de Gràcia", 51000, "-"),
                           (2017, 1, "Ciutat Vella", 80, "nowhere", 1, "99.0")], INCOME_A) \
        .write.parquet(f"{inc}/2017_renda.parquet")
    spark.createDataFrame([(2018, 1, "Ciutat Vella", 1, "el Raval", 47500, 103.0),
                           (2018, 6, "Gràcia", 31, "la Vila de Gràcia", 51500, 120.25),
                           (2018, 6, "Gràcia", 31, "la Vila de Gràcia", 51500, 120.25)], INCOME_B) \
        .write.parquet(f"{inc}/2018_renda.parquet")
    lst = f"{root}/listings"
    hoods = ["el Raval", "Vila de GrÃ\xa0cia", "El Gòtic", "Horta", "Sant Antoni"]
    day1 = [(f"p{i}", 200000.0 + 1000 * i, 50.0 + i, 1 + i % 4, 1 + i % 2, str(100 * i), "Barcelona",
             hoods[i % 5], "d", "Barcelona", None, (i % 2 == 0, True, None)) for i in range(30)]
    spark.createDataFrame(day1, LISTING).write.parquet(f"{lst}/2020_01_05_idealista.parquet")
    day2 = [(f"p{i}", 210000.0 + 900 * i, 52.0 + i, 1 + i % 3, 1, str(90 * i), "Barcelona" if i % 7 else "Girona",
             hoods[(i + 1) % 5], "Barcelona", None, (False, False, 10.0)) for i in range(25)]
    schema2 = LISTING.replace("district string, ", "")
    spark.createDataFrame(day2, schema2).write.parquet(f"{lst}/2020_01_06_idealista.parquet")
    aq = f"{root}/air"
    for month, rows in {"2019_02": [(8, 19, 4, 7, 2, 1, 10.0, 11.0)],
                        "2019_04": [(8, 19, 4, 7, 4, d, 10.0 + d, 20.0 + d) for d in range(1, 20)],
                        "2019_05": [(8, 19, 4, 7, 5, d, 12.0 + d, 500.0 if d == 3 else 21.0 + d) for d in range(1, 20)]}.items():
        spark.createDataFrame(rows, AIR).write.parquet(f"{aq}/{month}_qualitat_aire.parquet")
    spark.createDataFrame([(1,)], "codi_eoi int").write.parquet(f"{aq}/2019_06_qualitat_aire.parquet")
    lookup = spark.createDataFrame([("Q1", "Ciutat Vella", "el Raval", "el Raval"),
                                    ("Q2", "Gràcia", "la Vila de Gràcia", "la Vila de Gràcia"),
                                    ("Q3", "Ciutat Vella", "el Barri Gòtic", "el Barri Gòtic"),
                                    ("Q4", "Eixample", "Sant Antoni", "Sant Antoni")], LOOKUP)
    return root, inc, lst, aq, lookup


def test_reference_pipeline_end_to_end(spark):
    root, inc, lst, aq, lookup = write_drops(spark)
    # Invalid codes dropped, index as number, one row per key, audited
    income_t = f"{root}/t_income"
    format_and_load(spark, cf.income_job(inc, income_t, ["any", "codi_districte", "codi_barri"]))
    income = spark.read.parquet(income_t)
    got = {(r["any"], r["codi_barri"]): r[cf.INCOME_INDEX] for r in income.collect()}
    assert got == {(2017, 1): 101.5, (2017, 31): None, (2018, 1): 103.0, (2018, 31): 120.25}
    # Flattened, aligned (missing column added), distance as int, repaired text
    listings_t = f"{root}/t_listings"
    res = format_and_load(spark, cf.listings_job(lst, listings_t, ["propertycode", "day"]))
    listings = spark.read.parquet(listings_t)
    assert {"parkingspace_hasParkingSpace", "district", "day"} <= set(listings.columns)
    assert dict(listings.dtypes)["distance"] == "int" and listings.count() == 55
    assert listings.where(F.col("neighborhood") == "Vila de Gràcia").count() > 0
    assert res["main"]["report"] is not None
    # per-file reports like the reference's log: the second day lacks "district"
    assert [tuple(r) for r in res["missing_columns"].collect()] == [("2020_01_06", "district")]
    # a column one file lacks is a (column, type) pair not shared by every file
    assert [(r.column_name, r.data_type, r.n_frames) for r in res["type_conflicts"].collect()] == \
        [("district", "string", 1)]
    # Only months after the bound, the broken drop dropped
    air_t = f"{root}/t_air"
    format_and_load(spark, cf.air_quality_job(aq, air_t, ["estacio", "codi_contaminant", "month", "dia"]))
    air = spark.read.parquet(air_t)
    assert sorted(r.month for r in air.select("month").distinct().collect()) == ["2019_04", "2019_05"]
    # Unknown names matched by similarity, corrected, names added
    resolved, left = cf.reconcile_listings(spark, listings, lookup)
    res_map = {r.neighborhood_: r.neighborhood_id_ for r in resolved.collect()}
    assert res_map["Vila de Gràcia"] == "Q2"
    assert res_map["El Gòtic"] == "Q17154"
    assert res_map["Horta"] == "Q15225338"
    assert "Sant Antoni" not in res_map  # known to the lookup directly
    # Star refreshed, keys and references hold
    dims, facts = cf.star_tables(listings, lookup, income, air, resolved)
    paths = build_star(spark, dims, facts, f"{root}/star")
    tables = {n: spark.read.parquet(p) for n, p in paths.items()}
    report = star_constraints(
        tables, pks={"dim_year": ["year"], "dim_month": ["month"], "dim_day": ["day"],
                     "fact_idealista": ["propertycode", "day", "neighborhood_id"]},
        not_null={"fact_idealista": ["neighborhood_id"]},
        fks=[("fact_idealista", ["day"], "dim_day", ["day"]), ("dim_day", ["month"], "dim_month", ["month"]),
             ("dim_month", ["year"], "dim_year", ["year"])])
    assert {r.n_violations for r in report.collect()} == {0}
    assert sorted(r.year for r in tables["dim_year"].collect()) == ["2017", "2018", "2019", "2020"]
    # Horta resolves only through the added name; Girona rows are filtered out
    fact = tables["fact_idealista"]
    assert fact.where(F.col("neighborhood_id") == "Q15225338").count() > 0
    assert fact.count() == listings.where("municipality = 'Barcelona'").count()
    # workbook sheets on the star
    k11 = {r.row_id: r.avg_price for r in cf.kpi_price_size(fact).collect()}
    assert len(k11) == fact.count() and all(v is not None for v in k11.values())
    k12 = {r.neighborhood: (r.avg_price is not None, r.avg_rfd_index) for r in
           cf.kpi_price_income(fact, tables["fact_income"], tables["dim_location"]).collect()}
    assert k12["el Raval"] == (True, 102.25)
    k13 = {str(r.date): r.n_rows for r in cf.kpi_rows_per_day(fact).collect()}
    assert set(k13) == {"2020-01-05", "2020-01-06"} and sum(k13.values()) == fact.count()
    k14 = {(r.district, r.neighborhood): r.avg_population for r in
           cf.kpi_income_population(tables["fact_income"], tables["dim_location"]).collect()}
    assert k14[("Ciutat Vella", "el Raval")] == 47250.0
    # Train, store, predict with the stored version
    metrics = cf.train_listings(listings, f"{root}/models", 1)
    assert {r.split for r in metrics.collect()} <= {"train", "test"}
    scored = predict_job(listings, f"{root}/models", "price", 1)
    assert scored.where(F.col("prediction").isNull()).count() == 0
