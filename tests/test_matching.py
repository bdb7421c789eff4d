import random

from hypothesis import given, settings
from hypothesis import strategies as st

from driftwood.operators import matching as mt
from tests.test_text import py_jaccard

VOCAB = ["de", "el", "la", "sant", "gràcia", "vila", "nova", "poble", "sec", "parc", "horta", "les", "corts"]


def brute_force(left, right, t):
    out = set()
    for a in set(x for x in left if x is not None):
        for b in set(y for y in right if y is not None):
            s = py_jaccard(a, b)
            if s >= t:
                out.add((a, b, s))
    return out


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from(VOCAB), min_size=0, max_size=6).map(" ".join), min_size=1, max_size=12),
       st.lists(st.lists(st.sampled_from(VOCAB), min_size=1, max_size=6).map(" ".join), min_size=1, max_size=12),
       st.sampled_from([0.1, 0.3, 0.5, 0.8, 1.0]))
def test_fuzzy_pairs_equal_cross_join(spark, left, right, t):
    l = spark.createDataFrame([(x,) for x in left], "l_name string")
    r = spark.createDataFrame([(x,) for x in right], "r_name string")
    got = {(a, b, s) for a, b, s in mt.fuzzy_name_pairs(l, r, t).collect()}
    assert got == brute_force(left, right, t)


def test_fuzzy_salted_hot_tokens_equal_cross_join(spark):
    rnd = random.Random(7)
    left = [" ".join(rnd.sample(VOCAB, rnd.randint(1, 4))) + " de" for _ in range(60)]
    right = [" ".join(rnd.sample(VOCAB, rnd.randint(1, 4))) for _ in range(80)]
    l = spark.createDataFrame([(x,) for x in left], "l_name string")
    r = spark.createDataFrame([(x,) for x in right], "r_name string")
    got = {(a, b, s) for a, b, s in mt.fuzzy_name_pairs(l, r, 0.3, hot_token_rows=2).collect()}
    assert got == brute_force(left, right, 0.3)


def test_fuzzy_plan_has_no_cartesian_product(spark):
    l = spark.createDataFrame([("sant andreu",)], "l_name string")
    r = spark.createDataFrame([("sant andreu de palomar",)], "r_name string")
    plan = mt.fuzzy_name_pairs(l, r, 0.3)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def names_fixture(spark):
    lookup = spark.createDataFrame(
        [("Q1", "el Poble Sec"), ("Q2", "Sant Andreu"), ("Q3", "la Vila de Gràcia"),
         ("Q4", "Gràcia Nova"), ("Q5", "Horta")], "id string, name string")
    unmatched = spark.createDataFrame(
        [("El Poble-sec",), ("Vila de Gràcia",), ("Sant\u00a0Andreu",), (None,), ("",), ("Les Corts",)],
        "name string")
    return lookup, unmatched


def test_fuzzy_join_best_match_overrides_unresolved(spark):
    lookup, unmatched = names_fixture(spark)
    pairs = mt.fuzzy_join(unmatched, lookup, "name", "name", 0.3, score_col="score")
    # a no-break space separates tokens, as in Python's split()
    assert ("Sant\u00a0Andreu", "Q2", 1.0) in {(r.name, r.id, r.score) for r in pairs.collect()}
    best = mt.best_match(pairs, "name", "score", "id")
    got = {r.name: (r.id, r.score) for r in best.collect()}
    assert got["Vila de Gràcia"] == ("Q3", 0.75)
    overrides = spark.createDataFrame([("Vila de Gràcia", "Q9", None), ("Les Corts", "Q7", 1.0)],
                                      "name string, id string, score double")
    fixed = {r.name: (r.id, r.score) for r in mt.apply_overrides(best, "name", overrides).collect()}
    assert fixed["Vila de Gràcia"] == ("Q9", 0.75)
    assert fixed["Les Corts"] == ("Q7", 1.0)
    assert len(fixed) == mt.apply_overrides(best, "name", overrides).count()
    left = mt.unresolved(unmatched, mt.apply_overrides(best, "name", overrides), "name")
    assert sorted([r.name for r in left.collect()], key=str) == sorted(["El Poble-sec", None, ""], key=str)


def test_best_match_ties_break_by_candidate(spark):
    pairs = spark.createDataFrame([("a", "Q2", 0.5), ("a", "Q1", 0.5), ("a", "Q3", 0.4)],
                                  "name string, id string, score double")
    assert mt.best_match(pairs, "name", "score", "id").first().id == "Q1"


def test_lookup_fallback_never_fans_out(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k int, name string")
    lk1 = spark.createDataFrame([("x", "A"), ("x", "B")], "name string, id string")
    lk2 = spark.createDataFrame([("y", "C"), ("x", "D")], "name string, id string")
    out = mt.lookup_fallback(df, "name", [(lk1, "name", "id"), (lk2, "name", "id")], "loc")
    assert sorted((r.k, r.loc) for r in out.collect()) == [(1, "A"), (2, "C"), (3, None)]


def test_bounded_broadcast_goes_by_known_size_and_runs_nothing(spark):
    plan = lambda d: d._jdf.queryExecution().analyzed().toString().lower()
    small = spark.range(100)
    assert "broadcast" in plan(small.join(mt.bounded_broadcast(small, 1000), "id"))
    assert "broadcast" not in plan(small.join(mt.bounded_broadcast(small, 100), "id"))
    # no bound is known for what an explode or a join makes
    grown = small.selectExpr("id", "explode(sequence(1, 1000)) AS n")
    assert "broadcast" not in plan(small.join(mt.bounded_broadcast(grown), "id"))
    tracker, group = spark.sparkContext.statusTracker(), "bounded-broadcast"
    spark.sparkContext.setJobGroup(group, group)
    mt.bounded_broadcast(small.groupBy("id").count())
    assert not tracker.getJobIdsForGroup(group)


def test_best_match_cuts_repeated_names_without_a_sort(spark):
    rows = [("a", 3, "x", 0.5), ("a", 2, "x", 0.5), ("a", 2, "w", 0.5), ("a", 1, "x", 0.4), ("b", 5, "y", 0.9), ("b", None, "z", 0.9),
            ("b", None, "y", 0.9), ("c", 7, None, None), ("c", 8, None, 0.1), (None, 4, "q", 0.3), (None, 3, "q", 0.3)] * 2
    pairs = spark.createDataFrame(rows, "name string, id long, candidate string, score double")
    best = mt.best_match(pairs, "name", "score", "id")
    order = lambda r: tuple((x is not None, x) for x in (None if r[3] is None else -r[3], r[1], r[2]))
    want = {k: min((r for r in rows if r[0] == k), key=order) for k in ("a", "b", "c", None)}
    assert best.columns == pairs.columns and {r[0]: tuple(r) for r in best.collect()} == want
    # what is sorted for the aggregate with text in it has been through a hash table first
    plan = best._jdf.queryExecution().sparkPlan().toString()
    assert "HashAggregate" in plan[plan.index("SortAggregate"):]


def test_fuzzy_join_never_broadcasts_or_sorts_the_rows_of_a_name(spark, tmp_path):
    left = spark.createDataFrame([("red bolt m5",), ("red bolt m6",), ("blue ring",), (None,)], "name string")
    rows = [(i, ["red bolt m5", "blue ring x", None, "nut"][i % 4]) for i in range(400)]
    spark.createDataFrame(rows, "id long, cand string").write.parquet(str(tmp_path / "rows"))
    joined = mt.fuzzy_join(left, spark.read.parquet(str(tmp_path / "rows")), "name", "cand", 0.3)
    want = {("red bolt m5", i, "red bolt m5", 1.0) for i, c in rows if c == "red bolt m5"} | \
        {("red bolt m6", i, "red bolt m5", 0.5) for i, c in rows if c == "red bolt m5"} | \
        {("blue ring", i, "blue ring x", 2 / 3) for i, c in rows if c == "blue ring x"}
    got = [tuple(r) for r in joined.collect()]
    assert len(got) == len(want) and {(a, b, c, round(d, 9)) for a, b, c, d in got} == {(a, b, c, round(d, 9)) for a, b, c, d in want}
    # the few rows would be broadcast by the size of their file; the pairs are the side that is held
    plan = joined._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan and "BuildLeft" in plan[plan.index("ShuffledHashJoin"):].split("\n")[0]
