"""Profiles, indexes, the schema ledger, fuzzy bounds and reconciliation in batches."""

import random
from collections import Counter, OrderedDict

import pytest
from pyspark.sql import functions as F

from driftwood.operators import matching as mt
from driftwood.operators import profile as pr
from driftwood.operators.indexing import frequency_index, index_column, one_hot_positions
from driftwood.plans.jobs import ReconcileConfig, SourceConfig, format_and_load, list_files, reconcile, reconcile_incremental
from driftwood.sources import ledger as lg
from driftwood.sources import sinks


# --- E4, E5 -----------------------------------------------------------------

def test_profiles_of_batches_merge_to_that_of_all_rows(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"d{i % 6}", rng.gauss(0, 1) if i % 9 else None, rng.randrange(4)) for i in range(3000)]
    rows += [("d0", float("nan"), 1), ("d1", float("inf"), None), (None, 0.5, 2)]
    df = spark.createDataFrame(rows, "day string, v double, k int")
    path = str(tmp_path / "profile")
    pr.update_profile(spark, path, df.where("day < 'd4'"), "day", ["v", "k"])
    pr.update_profile(spark, path, df.where("day >= 'd4' or day is null"), "day", ["v", "k"])
    merged = {r["column_name"]: r for r in pr.merged_profile(pr.stored_profile(spark, path, "day")).collect()}
    finite = sorted(v for _, v, _ in rows if v is not None and v == v and abs(v) != float("inf"))
    for q, p in (("q1", 0.25), ("q3", 0.75)):
        below = sum(v <= merged["v"][q] for v in finite) / len(finite)
        assert abs(below - p) <= pr.RANK_ERROR
    assert merged["v"]["n_rows"] == 3003 and merged["v"]["n_null"] == sum(v is None for _, v, _ in rows)
    assert merged["k"]["n_distinct"] == 4 and abs(merged["v"]["n_distinct"] / 2669 - 1) < pr.DISTINCT_ERROR
    assert set(pr.profile_bounds(pr.stored_profile(spark, path, "day"))) == {"v"}


def test_a_later_batch_leaves_old_periods_alone(spark, tmp_path):
    import os
    path = str(tmp_path / "profile")
    df = spark.range(100).select(F.concat(F.lit("d"), (F.col("id") % 3).cast("string")).alias("day"), F.col("id").cast("double").alias("v"))
    pr.update_profile(spark, path, df, "day", ["v"])
    before = {d: os.listdir(f"{path}/{d}") for d in os.listdir(path) if "=" in d}
    pr.update_profile(spark, path, df.where("day = 'd1'"), "day", ["v"])            # more rows of a known period
    after = {d: os.listdir(f"{path}/{d}") for d in os.listdir(path) if "=" in d}
    assert {d for d in before if before[d] != after[d]} == {"day=d1"}
    assert pr.merged_profile(pr.stored_profile(spark, path, "day")).first()["n_rows"] == 133


def test_a_column_without_values_has_no_quartiles(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("b", float("nan"))], "day string, v double")
    path = str(tmp_path / "p")
    pr.update_profile(spark, path, df, "day", ["v"])
    r = pr.merged_profile(pr.stored_profile(spark, path, "day")).first()
    assert (r["n_rows"], r["n_null"], r["q1"], r["q3"]) == (2, 1, None, None)


# --- M5, M6 -----------------------------------------------------------------

def test_index_equals_the_ml_stage(spark):
    from pyspark.ml.feature import StringIndexer
    rng = random.Random(4)
    rows = [(i, rng.choice(["b", "a", "ä", "", "B", None]) or (None if i % 2 else "")) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, c string")
    index = frequency_index(df, "c")
    model = StringIndexer(inputCol="c", outputCol="c_index", handleInvalid="skip").fit(df)
    want = sorted((r["id"], r["c_index"]) for r in model.transform(df).collect())
    assert sorted((r["id"], r["c_index"]) for r in index_column(df, "c", index, "c_index").collect()) == want
    kept = {r["id"]: r["c_index"] for r in index_column(df, "c", index, "c_index", unseen="keep").collect()}
    assert len(kept) == 400 and {kept[i] for i, c in rows if c is None} <= {float(index.count())}
    hot = one_hot_positions(index_column(df, "c", index, "i"), "i", index.count(), "v").collect()
    assert all([(e["position"], e["value"]) for e in r["v"]] == ([(int(r["i"]), 1.0)] if r["i"] < index.count() - 1 else []) for r in hot)


def test_a_hundred_thousand_categories(spark):
    df = spark.range(100_000).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("c")) \
        .unionByName(spark.createDataFrame([("v77",)] * 3 + [("v5",)] * 2, "c string"))
    index = frequency_index(df, "c")
    assert [tuple(r) for r in index.orderBy("index").limit(3).collect()] == [("v77", 4, 0), ("v5", 3, 1), ("v0", 1, 2)]
    stats = index.agg(F.count(F.lit(1)), F.count_distinct("index"), F.min("index"), F.max("index")).first()
    assert tuple(stats) == (100_000, 100_000, 0, 99_999)
    assert frequency_index(df.limit(0), "c").count() == 0


# --- D3 ---------------------------------------------------------------------

@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.8, 1.0])
def test_bounds_refuse_candidates_and_lose_none(spark, threshold):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(14)]

    def names(n):
        return sorted({" ".join(rng.sample(words, rng.randrange(1, 7))) for _ in range(n)})

    left, right = names(60), names(60)
    ldf, rdf = (spark.createDataFrame([(x,) for x in ns], f"{c} string") for ns, c in ((left, "l_name"), (right, "r_name")))

    def score(a, b):
        a, b = set(a.split()), set(b.split())
        return len(a & b) / len(a | b)

    want = {(a, b) for a in left for b in right if score(a, b) >= threshold}
    got = {(r["l_name"], r["r_name"]) for r in mt.fuzzy_name_pairs(ldf, rdf, threshold, hot_token_rows=10).collect()}
    assert got == want
    bounded, prefix = ({tuple(r) for r in mt.fuzzy_candidates(ldf, rdf, threshold, bounds=b).collect()} for b in (True, False))
    assert want <= bounded <= prefix and (len(bounded) < len(prefix) or threshold == 1.0)


# --- A1, B5, B7 -------------------------------------------------------------

def _drop(spark, root, name, ddl, rows):
    sinks.write_table(spark.createDataFrame(rows, ddl), f"{root}/{name}.parquet")


def test_only_new_or_changed_drops_are_opened(spark, tmp_path):
    root, ledger = str(tmp_path / "drops"), str(tmp_path / "ledger")
    _drop(spark, root, "2020_a", "ID int, A string", [(1, "x")])
    _drop(spark, root, "2021_a", "ID int, B struct<c:int,d:string>", [(1, (2, "y"))])

    def run():
        return lg.update_ledger(spark, ledger, list_files(spark, root, 4), 4, flatten=True)

    def names(paths):
        return [p.rsplit("/", 1)[1] for p in paths]

    assert names(run()["opened"]) == ["2020_a.parquet", "2021_a.parquet"] and run()["opened"] == []
    _drop(spark, root, "2022_a", "ID long, A string", [(1, "x")])
    out = run()
    assert names(out["opened"]) == ["2022_a.parquet"]
    assert [s.fieldNames() for s in out["schemas"].values()] == [["ID", "A"], ["ID", "B"], ["ID", "A"]]
    table = sinks.read_stored(spark, ledger)
    assert sorted(tuple(r) for r in lg.ledger_missing_columns(table).collect()) == \
        [("2020", "b_c"), ("2020", "b_d"), ("2021", "a"), ("2022", "b_c"), ("2022", "b_d")]
    assert sorted(tuple(r) for r in lg.ledger_type_conflicts(table).collect()) == [("id", "bigint", 1), ("id", "int", 2)]
    _drop(spark, root, "2021_a", "ID int, A string, E double", [(1, "x", 1.0)])          # written anew
    assert names(run()["opened"]) == ["2021_a.parquet"]
    assert sorted(tuple(r) for r in lg.ledger_missing_columns(sinks.read_stored(spark, ledger)).collect()) == [("2020", "e"), ("2022", "e")]


def test_a_load_takes_schemas_from_the_ledger(spark, tmp_path, monkeypatch):
    from driftwood.plans import jobs
    root = str(tmp_path / "drops")
    _drop(spark, root, "2020_a", "id int, a string", [(1, "x"), (2, "y")])
    cfg = SourceConfig(root=root, target=str(tmp_path / "t"), keys=["id", "year"], key_len=4, key_col="year", ledger=str(tmp_path / "ledger"),
                       partition_by="year")
    format_and_load(spark, cfg)
    _drop(spark, root, "2021_a", "id int, b string", [(1, "z")])
    opened, real = [], jobs.file_schemas
    monkeypatch.setattr(jobs, "file_schemas", lambda spark, paths, *a, **k: (opened.extend(paths), real(spark, paths, *a, **k))[1])
    out = format_and_load(spark, cfg)
    assert [p.rsplit("/", 1)[1] for p in opened] == ["2021_a.parquet"]
    assert sorted(tuple(r) for r in out["missing_columns"].collect()) == [("2020", "b"), ("2021", "a")]
    got = sinks.read_stored(spark, cfg.target).select("id", "year", "a", "b").collect()
    assert sorted((r["id"], str(r["year"]), r["a"], r["b"]) for r in got) == [(1, "2020", "x", None), (1, "2021", None, "z"), (2, "2020", "y", None)]


# --- J6 ---------------------------------------------------------------------

def test_reconciling_in_batches_equals_one_run(spark, tmp_path):
    rng = random.Random(6)
    words = ["gran", "via", "sant", "marti", "les", "corts", "el", "raval"]

    def some(n):
        return [" ".join(rng.sample(words, rng.randrange(1, 4))) for _ in range(n)]

    names = [(x,) for x in some(40)] + [(None,), ("nothing like it",)]
    lookup = [(x, i) for i, x in enumerate(some(25))] + [("raval el", None), (None, 99)]
    overrides = spark.createDataFrame([("gran via", 7, "Gran Via", 1.0)], "name string, id long, reconciled_name string, similarity double")
    cfg = ReconcileConfig(name_col="name", lookup_name_col="known", lookup_id_col="lid", threshold=0.4, overrides=overrides)
    ndf, ldf = spark.createDataFrame(names, "name string"), spark.createDataFrame(lookup, "known string, lid long")

    def rows(pair):
        return [sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=repr) for df in pair]

    want = rows(reconcile(ndf, ldf, cfg))
    state = str(tmp_path / "state")
    waves = [(names[:10], lookup[:8]), (names[5:30], []), ([], lookup[6:20]), (names[25:], lookup[15:])]
    for n, k in waves:
        got = reconcile_incremental(spark, state, spark.createDataFrame(n, "name string"), spark.createDataFrame(k, "known string, lid long"), cfg)
    assert rows(got) == want
