from pyspark.sql import functions as F
from collections import OrderedDict

import pytest
from pyspark.sql import types as T

from driftwood.operators import frames as fr


def drift_frames(spark):
    full = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id int, name string, qty int")
    missing = spark.createDataFrame([(3, "c")], "id int, name string")
    void = spark.createDataFrame([(4, None, 40)], "id int, name void, qty int")
    as_text = spark.createDataFrame([(5, "e", "50"), (6, "f", "x")], "id int, name string, qty string")
    reordered = spark.createDataFrame([(70, "g", 7)], "qty int, name string, id int")
    return OrderedDict([("2019_01", full), ("2019_02", missing), ("2019_03", void),
                        ("2019_04", as_text), ("2019_05", reordered)])


def test_lowercase_and_collision(spark):
    df = spark.createDataFrame([(1, 2)], "A int, b int")
    assert fr.lowercase_columns(df).columns == ["a", "b"]
    clash = spark.createDataFrame([(1, 2)], "A int, b int").toDF("A", "a")
    with pytest.raises(ValueError):
        fr.lowercase_columns(clash)


def test_flatten_nested_keeps_order_and_arrays(spark):
    schema = "x int, s struct<a:int,b:struct<C:string,d:double>>, arr array<int>"
    df = spark.createDataFrame([(1, (2, ("u", 3.5)), [1, 2])], schema)
    out = fr.flatten_structs(df)
    assert out.columns == ["x", "s_a", "s_b_C", "s_b_d", "arr"]
    assert out.first().asDict() == {"x": 1, "s_a": 2, "s_b_C": "u", "s_b_d": 3.5, "arr": [1, 2]}


def test_flatten_name_collision_raises(spark):
    df = spark.createDataFrame([(1, (2,))], "s_a int, s struct<a:int>")
    with pytest.raises(ValueError):
        fr.flatten_structs(df)


def test_align_drift(spark):
    frames = drift_frames(spark)
    assert fr.missing_columns(frames) == {"2019_02": ["qty"]}
    conflicts = fr.type_conflicts(frames)
    assert ("qty", "string") in conflicts and ("name", "void") in conflicts
    aligned = fr.align(frames, key_col="day", overrides={"qty": "int"})
    out = fr.union_frames(aligned)
    assert out.columns == ["id", "name", "qty", "day"]
    got = {r["id"]: (r["name"], r["qty"], r["day"]) for r in out.collect()}
    assert got[3] == ("c", None, "2019_02")
    assert got[4] == (None, 40, "2019_03")
    assert got[5] == ("e", 50, "2019_04") and got[6] == ("f", None, "2019_04")
    assert got[7] == ("g", 70, "2019_05")  # positional union would have mixed this up


def test_align_is_idempotent(spark):
    aligned = fr.align(drift_frames(spark), overrides={"qty": "int"})
    again = fr.align(aligned, overrides={"qty": "int"})
    assert [df.schema for df in aligned.values()] == [df.schema for df in again.values()]


def test_align_raises_when_types_still_differ(spark):
    with pytest.raises(ValueError):
        fr.align(drift_frames(spark))  # qty string vs int and no override


def test_all_void_column_defaults_to_string(spark):
    a = spark.createDataFrame([(1, None)], "id int, v void")
    b = spark.createDataFrame([(2, None)], "id int, v void")
    out = fr.union_frames(fr.align(OrderedDict([("1", a), ("2", b)])))
    assert out.schema["v"].dataType == T.StringType()


def test_degenerate_and_split(spark):
    one = spark.createDataFrame([(1,)], "a int")
    zero = spark.range(1).select()
    two = spark.createDataFrame([(1, 2)], "a int, b int")
    frames = OrderedDict([("2019_02", two), ("2019_03", one), ("2019_04", two), ("2019_05", zero)])
    kept = fr.drop_degenerate(frames)
    assert list(kept) == ["2019_02", "2019_04"]
    old, new = fr.split_frames(kept, "2019_03")
    assert list(old) == ["2019_02"] and list(new) == ["2019_04"]


def test_union_count_is_sum(spark):
    frames = fr.align(drift_frames(spark), overrides={"qty": "int"})
    assert fr.union_frames(frames).count() == sum(df.count() for df in frames.values())


def test_schema_diff_by_name(spark):
    diff = fr.schema_diff(drift_frames(spark))
    assert ("2019_01", "2019_02", "qty", "type", "int", "missing") in diff
    assert not [d for d in diff if d[0] == "2019_04" and d[2] == "id"]


def test_key_matches_drops_nulls(spark):
    df = spark.createDataFrame([("2019", 1), ("2020", 2), (None, 3)], "any string, v int")
    assert [r.v for r in fr.key_matches(df, "any", "2019").collect()] == [1]


def test_distinct_values_mixed_types(spark):
    ints = spark.createDataFrame([(2019,), (2020,), (None,)], "y int")
    text = spark.createDataFrame([("2020",), ("2021",)], "y string")
    assert sorted(r.value for r in fr.distinct_values(ints, text).collect()) == ["2019", "2020", "2021"]


def test_override_of_an_absent_column_adds_nothing(spark):
    frames = {"a": spark.createDataFrame([("1",)], "x string"), "b": spark.createDataFrame([(2,)], "x int")}
    out = fr.align(frames, overrides={"x": "int", "distance": "int"})
    assert all(df.columns == ["x"] for df in out.values())


def test_schema_diff_reports_every_difference(spark):
    a = T.StructType([T.StructField("x", T.IntegerType(), True, {"u": 1}), T.StructField("y", T.StringType(), True)])
    b = T.StructType([T.StructField("x", T.LongType(), False), T.StructField("y", T.StringType(), True)])
    frames = {k: spark.createDataFrame([], s) for k, s in (("a", a), ("b", b), ("c", a))}
    assert [r[2:4] for r in fr.schema_diff({k: frames[k] for k in "ab"})] == [("x", "type"), ("x", "nullable"), ("x", "metadata")]
    assert {r[:2] for r in fr.schema_diff(frames, all_pairs=True)} == {("a", "b"), ("b", "c")}


def test_period_key_comes_from_the_file_not_from_folders_above(spark):
    from driftwood.sources.files import key_from_path, key_of_name
    paths = {"/lake/2024_landing/2019_05_air.parquet": "2019_05", "/lake/2024_landing/2019_05_air.parquet/part-0.parquet": "2019_05",
             "/lake/2024_landing/air.parquet": "2024_la", "/lake/2024_landing/x/air.parquet": None, "/2019_05/y/z": None}
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert {r.p: r.k for r in df.select("p", key_from_path(F.col("p"), 7).alias("k")).collect()} == paths
    assert key_of_name("/lake/2024_landing/2019_05_air.parquet", 7) == "2019_05"


def test_key_from_path_takes_time_in_proportion_to_the_path(spark):
    import re
    import time

    from driftwood.sources.files import key_from_path
    forms = ["2020_01_x.parquet", "/2020.parquet", "a/2020_02.parquet/part-0", "a/2020_03//part-0//", "2020/x/part-0",
             "//2021//p", "x", "", "/", "//", "/2020/", "2020/", "202/p", "a/é2020/p", "é/2020_04é/p", None]

    def expected(p):
        for pattern in (r"([^/]+)/*$", r"([^/]+)/+[^/]+/*$"):
            got = re.search(pattern, p or "")
            if got and re.match(r"\d{4}", got[1]):
                return got[1][:7]

    df = spark.createDataFrame([(p,) for p in forms], "p string")
    assert [r.k for r in df.select(key_from_path(F.col("p"), 7).alias("k")).collect()] == [expected(p) for p in forms]
    long = spark.createDataFrame([("/" + "a" * 20_000 + "/2020_05_x/" + "b" * 20_000,)] * 40, "p string")
    began = time.time()
    assert {r.k for r in long.select(key_from_path(F.col("p"), 7).alias("k")).collect()} == {"2020_05"}
    assert time.time() - began < 20
