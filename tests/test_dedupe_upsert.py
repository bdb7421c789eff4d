import pytest

from driftwood.operators.dedupe import dedupe, row_counts
from driftwood.session import scratch_path
from driftwood.sources.sinks import merge_upsert, read_stored, swap_in, upsert_table


def keys_fixture(spark):
    return spark.createDataFrame([(1, "b", 2.0), (1, "a", 9.0), (1, "a", 1.0), (2, None, 5.0), (2, "z", 5.0),
                                  (3, "q", 0.0), (3, "q", 0.0)], "k int, s string, v double")


def test_dedupe_keyed_is_deterministic(spark):
    df = keys_fixture(spark)
    out = {r.k: (r.s, r.v) for r in dedupe(df, ["k"]).collect()}
    assert out == {1: ("a", 1.0), 2: (None, 5.0), 3: ("q", 0.0)}
    assert dedupe(df).count() == 6
    by_v = {r.k: (r.s, r.v) for r in dedupe(df, ["k"], order_by=["v"]).collect()}
    assert by_v[1] == ("a", 1.0)


def test_dedupe_keys_unique_on_real_table(spark):
    from tests.conftest import SF_SMALL
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    out = dedupe(li, ["l_orderkey", "l_linenumber"])
    assert out.count() == li.select("l_orderkey", "l_linenumber").distinct().count()
    assert out.columns == li.columns


def test_row_counts(spark):
    df = keys_fixture(spark)
    got = {r.stage: r.n_rows for r in row_counts({"in": df, "out": dedupe(df, ["k"])}).collect()}
    assert got == {"in": 7, "out": 3}


def upsert_fixture(spark):
    stored = spark.createDataFrame([(1, "a", 10.0, "keep1"), (2, "b", 20.0, "keep2"), (3, "c", 30.0, "keep3")],
                                   "id int, name string, price double, extra string")
    batch = spark.createDataFrame([(2, "B", None), (4, "d", 40.0)], "id int, name string, price double")
    return stored, batch


def test_merge_upsert_semantics(spark):
    stored, batch = upsert_fixture(spark)
    got = {r.id: tuple(r) for r in merge_upsert(stored, batch, ["id"]).collect()}
    assert got == {1: (1, "a", 10.0, "keep1"), 2: (2, "B", None, "keep2"),
                   3: (3, "c", 30.0, "keep3"), 4: (4, "d", 40.0, None)}


def test_upsert_twice_equals_once(spark):
    stored, batch = upsert_fixture(spark)
    path = scratch_path(spark, "upsert-test")
    stored.write.parquet(path)
    upsert_table(spark, path, batch, ["id"])
    once = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    upsert_table(spark, path, batch, ["id"])
    twice = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    assert once == twice and len(once) == 4


def test_partitioned_upsert_touches_only_batch_partitions(spark):
    stored = spark.createDataFrame([(1, "2020_01", 1.0), (2, "2020_01", 2.0), (1, "2020_02", 3.0), (5, "2020_03", 5.0)],
                                   "id int, month string, v double")
    batch = spark.createDataFrame([(2, "2020_01", 20.0), (9, "2020_02", 9.0)], "id int, month string, v double")
    part = scratch_path(spark, "upsert-part")
    flat = scratch_path(spark, "upsert-flat")
    stored.write.partitionBy("month").parquet(part)
    stored.write.parquet(flat)
    # a marker file in an untouched partition must survive
    untouched = spark.read.parquet(f"{part}/month=2020_03").inputFiles()
    for _ in range(2):
        upsert_table(spark, part, batch, ["id", "month"], partition_by="month")
        upsert_table(spark, flat, batch, ["id", "month"])
    a = sorted(tuple(r) for r in spark.read.parquet(part).select("id", "month", "v").collect())
    b = sorted(tuple(r) for r in spark.read.parquet(flat).select("id", "month", "v").collect())
    assert a == b and len(a) == 5
    assert spark.read.parquet(f"{part}/month=2020_03").inputFiles() == untouched


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

ROWS = st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.sampled_from(["a", "b", "c"])),
                          st.one_of(st.none(), st.integers(-2, 2))), max_size=25)


def _py_key(t):
    # ascending, nulls first
    return tuple((x is not None, x) for x in t)


@settings(max_examples=20, deadline=None)
@given(ROWS)
def test_dedupe_property_matches_python(spark, rows):
    df = spark.createDataFrame(rows, "k int, s string, v int")
    got = sorted(tuple(r) for r in dedupe(df, ["k"]).collect())
    want = {}
    for k, s, v in rows:
        if k not in want or _py_key((s, v)) < _py_key(want[k]):
            want[k] = (s, v)
    assert got == sorted((k, s, v) for k, (s, v) in want.items())


@settings(max_examples=15, deadline=None)
@given(ROWS, ROWS)
def test_upsert_property_twice_equals_once(spark, stored_rows, batch_rows):
    stored = dedupe(spark.createDataFrame(stored_rows, "k int, s string, v int"), ["k"])
    batch = spark.createDataFrame([(k, s) for k, s, _ in batch_rows], "k int, s string")
    once = merge_upsert(stored, batch, ["k"])
    twice = merge_upsert(once, batch, ["k"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    keys = [r.k for r in once.collect()]
    assert len(keys) == len(set(keys))


def test_upsert_into_folder_left_by_an_empty_write(spark):
    path = scratch_path(spark, "upsert-empty")
    spark.createDataFrame([], "id int, month string, v double").write.partitionBy("month").parquet(path)
    batch = spark.createDataFrame([(1, "2020_01", 1.0)], "id int, month string, v double")
    upsert_table(spark, path, batch, ["id", "month"], partition_by="month")
    assert [tuple(r) for r in spark.read.parquet(path).select("id", "month", "v").collect()] == [(1, "2020_01", 1.0)]


def test_null_keys_match_and_upsert_is_idempotent(spark, tmp_path):
    stored = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    batch = spark.createDataFrame([(None, "x"), (2, "y")], "k int, v string")
    once = merge_upsert(stored, batch, ["k"])
    twice = merge_upsert(once, batch, ["k"])
    want = [(None, "x"), (1, "b"), (2, "y")]
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(want, key=repr)
    assert sorted(map(tuple, twice.collect()), key=repr) == sorted(want, key=repr)


def test_partitioned_upsert_keeps_null_periods_new_columns_and_leading_zeros(spark):
    path, keys = scratch_path(spark, "periods"), ["k", "m"]
    upsert_table(spark, path, spark.createDataFrame([(1, "01", "a"), (2, None, "b"), (3, None, "c"), (4, "12", "d")],
                                                    "k int, m string, v string"), keys, partition_by="m")
    batch = spark.createDataFrame([(1, "01", "A", 7), (2, None, "B", 8), (5, "", "E", 9)], "k int, m string, v string, extra int")
    for _ in range(2):
        upsert_table(spark, path, batch, keys, partition_by="m")
    out = read_stored(spark, path, "parquet", "m", batch.schema["m"].dataType).select("k", "m", "v", "extra")
    assert sorted(map(tuple, out.collect())) == [(1, "01", "A", 7), (2, None, "B", 8), (3, None, "c", None),
                                                 (4, "12", "d", None), (5, None, "E", 9)]


def test_a_failed_swap_puts_the_old_table_back(spark):
    path = scratch_path(spark, "swap")
    upsert_table(spark, path, spark.createDataFrame([(1, "a")], "k int, v string"), ["k"])
    with pytest.raises(Exception):
        swap_in(spark, path + "_not_there", path)
    assert spark.read.parquet(path).count() == 1


def test_star_refresh_replaces_and_restores(spark, monkeypatch):
    from collections import OrderedDict

    from driftwood.sources import sinks
    base = scratch_path(spark, "star")
    frame = lambda n: spark.range(n)
    sinks.refresh_star(spark, OrderedDict(dim=frame(2), fact=frame(5)), base)
    sinks.refresh_star(spark, OrderedDict(dim=frame(3), fact=frame(6)), base)
    sizes = lambda: [spark.read.parquet(f"{base}/{t}").count() for t in ("dim", "fact")]
    assert sizes() == [3, 6]
    move, calls = sinks._move, []

    def failing(fs, a, b):
        calls.append(b)
        if len(calls) == 4:
            raise IOError("no")
        move(fs, a, b)

    monkeypatch.setattr(sinks, "_move", failing)
    with pytest.raises(IOError):
        sinks.refresh_star(spark, OrderedDict(dim=frame(4), fact=frame(7)), base)
    assert sizes() == [3, 6]
