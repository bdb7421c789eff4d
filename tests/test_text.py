import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from driftwood.functions.keys import composite_key, key_part, key_to_date, month_of_day
from driftwood.functions.text import (damage_as_latin1, is_non_numeric, parse_double,
                                      repair_mojibake, token_jaccard)


def py_float(x):
    if x is None or "_" in x:
        return None
    try:
        return float(x)
    except ValueError:
        return None


NUMBERS = ["60.3", " 60.3 ", "-", "60,3", "1_000", "1d", "nan", "inf", None, "-1e3", ".5", "7.",
           "Infinity", "abc", ""]


def test_parse_double_matches_python(spark):
    df = spark.createDataFrame([(x,) for x in NUMBERS], "t string")
    got = [r.v for r in df.select(parse_double("t").alias("v")).collect()]
    for x, v in zip(NUMBERS, got):
        want = py_float(x)
        if want is None:
            assert v is None, x
        elif math.isnan(want):
            assert math.isnan(v), x
        else:
            assert v == want, x


def test_non_numeric(spark):
    df = spark.createDataFrame([("60.3",), ("60,3",), ("1-",), ("12",)], "t string")
    assert [r.n for r in df.select(is_non_numeric("t").alias("n")).collect()] == [False, True, True, False]


ENCODING = ["Gràcia", "Sant Martí", "plain ascii", "price 5 €", "", None, "Ã©", "naïve café"]


def test_mojibake_round_trip_and_clean_text(spark):
    df = spark.createDataFrame([(x,) for x in ENCODING], "t string")
    out = df.select("t", damage_as_latin1("t").alias("bad")) \
        .select("t", "bad", repair_mojibake("bad").alias("fixed"), repair_mojibake("t").alias("clean"))
    for r in out.collect():
        assert r.fixed == r.t
        if r.t is not None and r.t != "Ã©":  # "Ã©" is itself valid mojibake of "é"
            assert r.clean == r.t
    damaged = spark.createDataFrame([("GrÃ\xa0cia",)], "t string")
    assert damaged.select(repair_mojibake("t")).first()[0] == "Gràcia"


def py_jaccard(a, b):
    if a is None or b is None:
        return 0.0
    s1, s2 = set(a.lower().split()), set(b.lower().split())
    u = len(s1 | s2)
    return 0.0 if u == 0 else len(s1 & s2) / u


WORDS = st.sampled_from(["de", "el", "la", "Sant", "sant", "Gràcia", "vila", "nova", " ", " ", "x"])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.lists(WORDS, max_size=5).map("".join)),
                          st.one_of(st.none(), st.lists(WORDS, max_size=5).map(" ".join))),
                min_size=1, max_size=8))
def test_token_jaccard_matches_python(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r.j for r in df.select(token_jaccard("a", "b").alias("j")).collect()]
    assert got == [py_jaccard(a, b) for a, b in pairs]


def test_keys(spark):
    df = spark.createDataFrame([("2019_03_07", 5)], "day string, id int")
    r = df.select(key_part("day", 0).alias("y"), key_part("day", 9).alias("none"),
                  month_of_day("day").alias("m"), key_to_date("day").alias("d"),
                  composite_key(["id", "day"]).alias("k"),
                  composite_key([F.lit(None), "day"]).alias("nk")).first()
    assert (r.y, r.none, r.m, str(r.d), r.k, r.nk) == ("2019", None, "2019_03", "2019-03-07", "5_2019_03_07", None)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40)), min_size=1, max_size=20))
def test_mojibake_round_trip_property(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = df.select("i", "t", repair_mojibake(damage_as_latin1("t")).alias("r")).collect()
    assert all(r.r == r.t for r in out)


def test_cp1252_damage_is_repaired_next_to_clean_text(spark):
    from driftwood.functions.text import damage_as_cp1252, damage_as_latin1, plain_quotes, repair_mojibake, unix_lines, without_controls
    clean = ["it\u2019s \u20ac5", "caf\u00e9", "\u201cquoted\u201d", "plain", "\u4e2d\u6587 \u00c1\u00dd", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(clean)], "i int, t string")
    for damaged in (damage_as_cp1252("t"), damage_as_latin1("t"), df["t"]):
        got = [r[0] for r in df.orderBy("i").select(repair_mojibake(damaged)).collect()]
        assert got == clean
    known = "it\u00e2\u20ac\u2122s"
    row = spark.createDataFrame([(known, "\u201ca\u2019\r\nb\rc\x07\t")], "a string, b string").select(
        repair_mojibake("a"), without_controls(unix_lines(plain_quotes("b")))).first()
    assert tuple(row) == ("it\u2019s", '"a\'\nb\nc\t')


def test_segment_repair_ends_when_no_damage_is_left(spark, monkeypatch):
    from driftwood.functions import text as tx
    # a repair that could go on for ever: every round adds a mark
    monkeypatch.setattr(tx, "_repair_once", lambda c: F.concat(F.lit("x"), F.translate(c, "Ã", "")))
    df = spark.createDataFrame([("Ã©",), ("é",), ("plain",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(tx.repair_segments("t")).collect()] == ["x©", "é", "plain", "", None]


def test_segment_repair_of_mixed_text(spark):
    from driftwood.functions.text import damage_as_cp1252, repair_segments
    clean = "x " * 300 + "« LIBERTÉ\u00a0! », là\u00a0», Á\u2019, 日本語 Ωé 😀 Gràcia"
    df = spark.createDataFrame([(clean,)], "t string")
    bad = F.concat(damage_as_cp1252(damage_as_cp1252("t")), F.lit(" – 日本 "), F.col("t"), F.lit(" | "), damage_as_latin1("t"))
    assert df.select(repair_segments(bad)).first()[0] == f"{clean} – 日本 {clean} | {clean}"


def test_ascii_text_is_not_searched_for_damage(spark):
    from driftwood.functions.text import repair_text
    df = spark.createDataFrame([("abc",), ("a\u00c3\u00a9",), (None,)], "t string")
    plan = df.select(repair_text("t").alias("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("octet_length") < plan.index("RLIKE")
    assert [r.t for r in df.select(repair_text("t").alias("t")).collect()] == ["abc", "a\u00e9", None]
