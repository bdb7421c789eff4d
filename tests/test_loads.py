"""Partitioned, counted and checked loads; repair of partly damaged text."""

import os
from collections import OrderedDict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from driftwood.functions.text import repair_segments, repair_text
from driftwood.operators import dedupe as dd
from driftwood.plans import catalog_loads
from driftwood.plans.jobs import SourceConfig, build_checked_star, format_and_load, load_counts
from driftwood.sources import sinks
from tests.conftest import SF_SMALL


# --- X2 ---------------------------------------------------------------------

def damaged(text, code="cp1252"):
    """UTF-8 bytes read in a single-byte code page."""
    undefined = (0x81, 0x8D, 0x8F, 0x90, 0x9D)
    return "".join(bytes([b]).decode("cp1252") if code == "cp1252" and b not in undefined else chr(b) for b in text.encode())


CASES = [
    ("Gràcia – " + damaged("été") + " 日本", "Gràcia – été 日本"),
    (damaged("café") + " et thé", "café et thé"),
    (damaged(damaged("é")), "é"),
    (damaged(damaged(damaged("déjà vu"))) + " là »", "déjà vu là »"),
    ("LIBERTÉ !", "LIBERTÉ !"),
    ("« là » CITÉ»", "« là » CITÉ»"),
    ("x " + damaged("日本語 привет š") + " é", "x 日本語 привет š é"),
    (damaged("It’s “ok” … – €5", "latin1") + " Ωé", "It’s “ok” … – €5 Ωé"),
    ("é" * 5 + damaged("é" * 3000) + "日", "é" * 3005 + "日"),
    (damaged("😀") + "日", "😀日"),
    ("\x00\r\n" + damaged("ß"), "\x00\r\nß"),
    (None, None), ("", ""),
]


def test_partly_damaged_text_is_repaired(spark):
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(CASES)], "i int, a string")
    got = [r[0] for r in df.select("i", repair_segments("a").alias("r")).orderBy("i").select("r").collect()]
    assert got == [b for _, b in CASES]


def test_whole_texts_are_repaired_first(spark):
    df = spark.createDataFrame([(damaged("Ænder"), damaged("ö") + " 日 " + damaged("ö"))], "a string, b string")
    assert tuple(df.select(repair_text("a"), repair_text("b")).first()) == ("Ænder", "ö 日 ö")


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(bad=hs.lists(hs.text(alphabet="aéñß ö日ž", min_size=1, max_size=12).map(lambda x: x + " – €5"), min_size=1, max_size=4),
       clean=hs.text(alphabet="aéñß öЖž日", max_size=12), code=hs.sampled_from(["cp1252", "latin1"]))
def test_damaged_words_between_clean_ones(spark, bad, clean, code):
    want = " | ".join("é" + p + " | 日" + clean for p in bad)
    mixed = " | ".join(damaged("é" + p, code) + " | 日" + clean for p in bad)
    got = spark.createDataFrame([(mixed, want.replace("€", "").replace("–", ""))], "a string, b string") \
        .select(repair_segments("a"), "b", repair_segments("b")).first()
    assert got[0] == want and got[1] == got[2]


# --- A4, A5 -----------------------------------------------------------------

def orders(spark, n):
    return spark.range(n).select(F.col("id"), F.when(F.col("id") % 3 > 0, "01").otherwise(F.concat(F.lit("m"), (F.col("id") % 5).cast("string")))
                                 .alias("m"), (F.col("id") * 2).alias("v"))


def test_files_per_period_are_bounded_and_a_hot_period_is_split(spark, tmp_path):
    path = str(tmp_path / "t")
    df = orders(spark, 3000).unionByName(spark.range(3000, 3007).select("id", F.lit(None).cast("string").alias("m"), F.col("id").alias("v")))
    done = sinks.upsert_table(spark, path, df.repartition(20), ["id", "m"], partition_by="m", rows_per_file=400)
    assert done == {"path": path, "written": 3007}
    files = {r["m"]: (r["n_files"], r["n_rows"]) for r in sinks.files_per_period(spark, path, "m", period_type=df.schema["m"].dataType).collect()}
    assert set(files) == {"01", "m0", "m1", "m2", "m3", "m4", None} and files["01"][1] == 2000
    for n_files, n_rows in files.values():
        assert n_files <= 2 * -(-n_rows // 400)
    assert files["01"][0] >= 5 and files["m1"][0] == 1
    done = sinks.upsert_table(spark, path, df.where("m = 'm1'").withColumn("v", F.lit(0).cast("long")), ["id", "m"], partition_by="m",
                              rows_per_file=400)
    assert done["written"] == files["m1"][1] and sorted(os.listdir(tmp_path)) == ["t"]
    back = sinks.read_stored(spark, path, "parquet", "m", df.schema["m"].dataType)
    assert back.count() == 3007 and back.where("v = 0 and m = 'm1'").count() == files["m1"][1]


def test_a_hot_period_is_dealt_to_several_tasks(spark):
    df = orders(spark, 3000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = sinks.cluster_by_period(df, "m", {"01": 2000, "m1": 200}, ["id"], 200)
        parts = out.select("m", F.spark_partition_id().alias("p")).distinct().groupBy("m").count()
        tasks = {r["m"]: r["count"] for r in parts.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks["01"] > 3 and tasks["m1"] == 1 and out.columns == df.columns and out.count() == 3000


def test_the_batch_is_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    rdd = spark.sparkContext.parallelize(range(100), 2).map(lambda i: (seen.add(1), (i, f"p{i % 3}"))[1])
    batch = spark.createDataFrame(rdd, "id long, m string")
    sinks.upsert_table(spark, str(tmp_path / "t"), batch, ["id", "m"], partition_by="m")
    assert seen.value == 100


# --- E1 ---------------------------------------------------------------------

def _jobs(spark, run):
    group = f"jobs-{os.urandom(4).hex()}"
    spark.sparkContext.setJobGroup(group, group)
    run()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_counts_come_without_a_job(spark, tmp_path, monkeypatch):
    def load(n):
        root = tmp_path / f"drops{n}"
        rows = spark.createDataFrame([(i, f"x{i % 7}") for i in range(50)], "id long, v string")
        sinks.write_table(rows, str(root / "2020_a.parquet"))
        sinks.write_table(rows.where("id < 20").unionByName(rows.where("id > 45")), str(root / "2020_b.parquet"))
        cfg = SourceConfig(root=str(root), target=str(tmp_path / f"t{n}"), keys=["id"], key_len=4, key_col="year")
        out = {}
        return _jobs(spark, lambda: out.update(format_and_load(spark, cfg))), out

    with_counts, out = load(1)
    assert out["main"]["counts"] == {"read": 74, "united": 74, "unique": 50, "written": 50}
    assert sorted(tuple(r) for r in load_counts(spark, out).collect()) == \
        [("main", "read", 74), ("main", "unique", 50), ("main", "united", 74), ("main", "written", 50)]

    for module in (dd, sinks):
        monkeypatch.setattr(module, "observed", lambda df, name: (df, None))
        monkeypatch.setattr(module, "counted", lambda observation: 0)
    assert load(2)[0] == with_counts


def test_an_empty_batch_counts_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "id long, m string")
    assert sinks.upsert_table(spark, str(tmp_path / "a"), empty, ["id"])["written"] == 0
    assert sinks.upsert_table(spark, str(tmp_path / "b"), empty, ["id", "m"], partition_by="m")["written"] == 0


# --- C11, A7, F6 ------------------------------------------------------------

@pytest.mark.parametrize("fault, check", [("fk", "fk:d"), ("pk", "pk"), ("null", "not_null")])
def test_a_broken_star_leaves_the_old_one(spark, tmp_path, fault, check):
    base = str(tmp_path / "star")
    dims = OrderedDict([("d", spark.createDataFrame([(1, "a"), (2, "b")], "k int, n string"))])
    rows = [(10, 1, "2020"), (11, 2, "2020"), (12, 1, "2021")]
    bad = rows + {"fk": [(13, 9, "2021")], "pk": [(12, 1, "2021")], "null": [(13, None, "2021")]}[fault]

    def publish(rows):
        facts = OrderedDict([("f", spark.createDataFrame(rows, "id int, k int, y string"))])
        return build_checked_star(spark, dims, facts, base, {"d": ["k"], "f": ["id"]}, {"f": ["k"]}, [("f", ["k"], "d", ["k"])],
                                  partition_by={"f": "y"})

    good, report = publish(rows)
    assert good and {r["n_violations"] for r in report.collect()} == {0}
    good, report = publish(bad)
    assert not good and [(r["check_name"], r["table_name"]) for r in report.where("n_violations > 0").collect()] == [(check, "f")]
    assert spark.read.parquet(f"{base}/f").count() == 3 and sorted(os.listdir(base)) == ["d", "f"]
    good, _ = publish(rows[:2])
    assert good and spark.read.parquet(f"{base}/f").count() == 2


def test_only_the_months_of_the_dimension_are_read(spark):
    plan = catalog_loads.q_star_pruned(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_replaced_periods_leave_the_others_alone(spark, tmp_path):
    path = str(tmp_path / "f")
    sinks.replace_periods(spark, path, orders(spark, 300), "m")
    before = {p: sorted(os.listdir(f"{path}/{p}")) for p in os.listdir(path) if "=" in p}
    sinks.replace_periods(spark, path, orders(spark, 300).where("m = 'm0' and id < 100"), "m")
    after = {p: sorted(os.listdir(f"{path}/{p}")) for p in os.listdir(path) if "=" in p}
    assert {p for p in before if before[p] != after[p]} == {"m=m0"}
