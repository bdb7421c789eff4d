"""Hard negatives, license templates and collocations against plain versions."""

import random
import re
from collections import Counter, defaultdict
from math import floor, isfinite

import pytest
from pyspark.sql import functions as F

from driftwood.llm import collocations as co
from driftwood.llm import hard_negatives as hn
from driftwood.llm import license_templates as lt
from driftwood.llm import queries
from tests.conftest import SF_SMALL
from tests.llm import brute


# --- hard negatives ---------------------------------------------------------

def brute_negatives(rows, is_anchor, positives=5, negatives=3, low=50, high=95, scale=256):
    """rows (id, vector, label), with repeats, as the operator defines it."""
    good = [(i, [floor(scale * x) for x in v], k) for i, v, k in rows
            if i is not None and k is not None and v and all(x is not None and isfinite(x) for x in v)]
    good = [r for r in good if len(r[1]) * max(abs(x) for x in r[1]) ** 2 < 2 ** 54]
    out = []
    for n, (a, q, k) in enumerate(good):
        if not is_anchor(a):
            continue
        score = [(-sum(x * y for x, y in zip(q, v)), i, m == k) for j, (i, v, m) in enumerate(good)
                 if j != n and len(v) == len(q)]
        for p, pid, _ in sorted(s for s in score if s[2])[:positives]:
            fits = sorted(s for s in score if not s[2] and low * -p <= 100 * -s[0] <= high * -p)[:negatives]
            out += [(a, pid, rank, i, -p, -s) for rank, (s, i, _) in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    out = hn.hard_negatives(df, F.col("vec_id") % 5 == 0, **kw)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def random_vectors(seed, n, dim=8, labels=3, groups=6):
    rng = random.Random(seed)
    centers = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(groups)]
    out = []
    for i in range(n):
        c = rng.choice(centers)
        size = rng.choice([0.1, 1.0, 1.0, 3.0])
        out.append((i, [size * (x + rng.gauss(0, 0.2)) for x in c], rng.randrange(labels)))
    return out


def as_floats(rows):
    import numpy as np
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], k) for i, v, k in rows]


def test_hard_negatives_equal_brute_force(spark):
    rows = as_floats(random_vectors(1, 300))
    want = brute_negatives(rows, lambda a: a % 5 == 0)
    assert len(want) > 300 and mined(spark, rows) == want


def test_hard_negatives_over_many_tiles_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(hn, "TILE", 40)
    monkeypatch.setattr(hn, "BLOCK", 15)
    rows = as_floats(random_vectors(2, 260, dim=3))
    assert mined(spark, rows) == brute_negatives(rows, lambda a: a % 5 == 0)


def test_hard_negatives_with_copies_ties_nulls_and_repeats(spark):
    rows = as_floats(random_vectors(3, 60, dim=2, groups=2))
    rows = [(i, [round(x) for x in v], k) for i, v, k in rows]                    # many ties
    rows += [(100 + i, [1.0, 1.0], i % 2) for i in range(40)]                     # copies, in two labels
    rows += [(100, [1.0, 1.0], 0), (105, [2.0, 0.0], 1), (105, [2.0, 0.0], 1)]    # repeated ids
    rows += [(None, [1.0, 1.0], 0), (200, None, 1), (205, [1.0, 1.0], None), (210, [None, 1.0], 0),
             (215, [float("nan"), 1.0], 0), (220, [float("inf"), 0.0], 1), (225, [], 1), (230, [0.0, 0.0], 0),
             (235, [1.0, 1.0, 1.0], 0), (240, [1.0, 2.0, 1.0], 0), (241, [1.0, 1.0, 0.5], 1),
             (245, [3e30, 0.0], 0)]
    rows = [(i, v if v is None else [x if x is None else float(x) for x in v], k) for i, v, k in rows]
    assert mined(spark, rows) == brute_negatives(rows, lambda a: a % 5 == 0)
    assert mined(spark, rows, positives=2, negatives=1, low_percent=10, high_percent=100) == \
        brute_negatives(rows, lambda a: a % 5 == 0, 2, 1, 10, 100)


def test_hard_negatives_empty_single_and_clashing_names(spark):
    assert mined(spark, []) == [] and mined(spark, [(0, [1.0], 1)]) == []
    df = spark.createDataFrame([(0, [1.0], 1, 3, "x"), (1, [1.0], 1, 4, "y"), (2, [0.9], 2, 5, "z")],
                               "vec_id long, embedding array<float>, label int, cid int, tile string")
    got = [tuple(r) for r in hn.hard_negatives(df, F.col("cid") == 3).collect()]
    assert got == [(0, 1, 1, 2, 256 * 256, 256 * 230)]


def test_coordinate_ranges_prune(spark):
    """Far fewer rows are verified than there are, and none is lost."""
    import numpy as np
    rng = np.random.default_rng(5)
    x = rng.standard_normal((1024, 16)) * 50
    length = np.linalg.norm(x, axis=1)
    order = np.argsort(-length)
    bucket = hn._Bucket(x[order], length[order], True)
    q = x[order][7] / length[order][7]
    focus = np.argsort(-np.abs(q))[:hn.FOCUS]
    cosine = 0.95
    found = bucket.candidates(q, focus, cosine)
    must = np.flatnonzero(bucket.unit @ q >= cosine)
    assert found is not None and len(found) < 200 and set(must) <= set(found)


# --- license templates ------------------------------------------------------

def regex_of(markup):
    """A template as a regular expression over space-separated words."""
    out = []
    for item in lt._parse(markup):
        out.append(_regex_item(item))
    return "".join(out)


def _regex_item(item):
    if isinstance(item, bytes):
        return " " + re.escape(item.decode())
    if isinstance(item, int):
        return "(?: [^ ]+){0,%d}" % item
    return "(?:" + "".join(_regex_item(x) for x in item) + ")?"


def brute_matches(text, templates):
    words = [w for w in brute.ITEM_WORD.findall((text or "").translate(brute.LOWER))]
    out = []
    for label, markup, base in templates:
        pattern = regex_of(markup)
        for i in range(len(words)):
            rest = "".join(" " + w for w in words[i:])
            ends = [m for n in range(len(words) - i, 0, -1)
                    if (m := re.fullmatch(pattern, "".join(" " + w for w in words[i:i + n])))] if rest.startswith(" " + words[i]) else []
            if ends:
                out.append((label, base, i, i + len(ends[0][0].split())))
    return len(words), sorted(out, key=lambda m: (m[2], m[0], m[1], m[3]))


SMALL = [("a", "alpha beta", True), ("b", "alpha [[beta]] gamma", False), ("c", "alpha {{2}} [[x [[y]]]] omega", False),
         ("d", "beta {{1}} {{1}} beta", False), ("e", "gamma [[{{3}}]] gamma", False)]


def test_templates_equal_regular_expressions(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["Alpha", "beta", "GAMMA", "omega", "x", "y", "é"]) for _ in range(rng.randrange(1, 14)))
             for _ in range(300)]
    compiled = [lt.compile_template(label, markup, base) for label, markup, base in SMALL]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], sorted((tuple(m) for m in r["matches"]), key=lambda m: (m[2], m[0], m[1], m[3])), r["score"])
           for r in lt.scan(docs, templates=compiled).collect()}
    some = 0
    for i, t in enumerate(texts):
        n, want = brute_matches(t, SMALL)
        covered = len({w for m in want for w in range(m[2], m[3])})
        assert got[i] == (n, want, covered / n if n else 0.0), t
        some += bool(want)
    assert some > 100


def test_standard_wording(spark):
    mit = next(markup for label, markup in lt.TEMPLATES if label == "mit")
    whole = re.sub(r"\[\[|\]\]", "", mit).replace("{{8}}", "")
    rows = [(1, "Released under the MIT License."), (2, "x\nLicensed under CC BY-NC 4.0."),
            (3, "This work is licensed under the GNU General Public License, version 3."),
            (4, "licensed under the APACHE license; Version 2.0"), (5, whole), (6, whole.replace("free of charge", "for a fee")),
            (7, None), (8, ""), (9, "Under the MIT-license " * 3), (10, "licensed " * 5000 + "under the MIT License")]
    docs = spark.createDataFrame([(i, t, i, "k") for i, t in rows], "doc_id long, text string, n_words long, matches string")
    out = {r["doc_id"]: r for r in lt.scan(docs).withColumn("labels", lt.labels_of(F.col("matches"))).collect()}
    assert [out[i]["labels"] for i in range(1, 11)] == \
        ["mit", "cc-by-nc", "gpl-3", "apache-2", "mit", "", "", "", "mit", "mit"]
    assert out[7]["n_words"] == out[8]["n_words"] == 0 and out[7]["score"] == 0.0
    assert out[5]["score"] == 1.0 and [m["start"] for m in out[9]["matches"]] == [0, 4, 8]
    assert set(out[1].asDict()) == {"doc_id", "text", "n_words", "matches", "score", "labels"}
    assert lt.scan(docs.limit(0)).collect() == []


@pytest.mark.parametrize("markup", ["[[a]] b", "{{3}} a", "", "a [[b", "a b]]"])
def test_bad_templates_are_refused(markup):
    with pytest.raises(ValueError):
        lt.compile_template("x", markup)


def test_license_query_base_columns(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    seen = 0
    for r in queries.op12_license_templates(spark, SF_SMALL).collect():
        words = brute.ITEM_WORD.findall((texts[r["doc_id"]] or "").translate(brute.LOWER))
        places = [(i, label) for label, phrase in lt.BASE for i in range(len(words))
                  if words[i:i + len(phrase.split())] == phrase.split()]
        at = [i for i, _ in places]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == \
            (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])
        seen += bool(at)
    assert seen


# --- collocations -----------------------------------------------------------

def brute_collocations(docs, least, longest=4, top=2000, closed=80):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(brute.LOWER)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[(lang, *w[i:i + k])] += 1
    cand = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    longer = defaultdict(int)
    for p, a in cand.items():
        for size in range(2, len(p) - 1):
            for i in range(1, len(p) - size + 1):
                inner = (p[0], *p[i:i + size])
                longer[inner] = max(longer[inner], a)
    per = defaultdict(list)
    for p, a in cand.items():
        if longer[p] and 100 * longer[p] >= closed * a:
            continue
        cuts = [(2000000 * a // (f[p[:1 + k]] + f[(p[0], *p[1 + k:])]), k, f[p[:1 + k]], f[(p[0], *p[1 + k:])])
                for k in range(1, len(p) - 1)]
        s, _, left, right = min(cuts)
        per[p[0]].append((-s, -a, " ".join(p[1:]).encode(), left, right))
    return sorted((lang, i, phrase.decode(), -a, left, right, n[lang], -s) for lang, rows in per.items()
                  for i, (s, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1))


def phrases(spark, docs, **kw):
    df = spark.createDataFrame([(i, t, lang, 7, "x") for i, (lang, t) in enumerate(docs)],
                               "doc_id long, text string, lang string, n int, phrase string")
    return sorted(tuple(r) for r in co.collocations(df, **kw).collect())


def random_texts(seed, n, words=12):
    rng = random.Random(seed)
    vocabulary = [rng.choice(["a", "É", "bb", "Ccc", "d\x00d", "ö"]) + str(i) for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    out = []
    for _ in range(n):
        text = "".join(rng.choices(vocabulary, weights)[0] + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r"])
                       for _ in range(rng.randrange(60)))
        out.append((rng.choice(["en", "en", "de", None, "und"]), text))
    return out


def test_collocations_equal_brute_force(spark):
    docs = random_texts(6, 400) + [(None, None), ("en", ""), ("fr", " \t.,"), ("en", "x " * 5000), ("de", "No.Break")]
    want = brute_collocations(docs, 30)
    assert len(want) > 50 and phrases(spark, docs) == want
    assert phrases(spark, docs, top=3) == brute_collocations(docs, 30, top=3)
    assert phrases(spark, docs, least=8, longest=3, closed_percent=30) == brute_collocations(docs, 8, 3, closed=30)


def test_collocations_missed_by_the_sample_are_found(spark, monkeypatch):
    """A sample that proposes next to nothing: the border finds every phrase."""
    monkeypatch.setattr(co, "SAMPLE_LEAST", 10 ** 6)
    docs = random_texts(7, 300)
    assert phrases(spark, docs) == brute_collocations(docs, 30)


def test_collocations_with_a_full_bitmap(spark, monkeypatch):
    """Accidental members of the proposed set lose nothing."""
    monkeypatch.setattr(co, "LEAST_BITS", 64)
    monkeypatch.setattr(co, "MOST_BITS", 64)
    docs = random_texts(8, 200)
    assert phrases(spark, docs) == brute_collocations(docs, 30)


def test_collocations_of_nothing(spark):
    assert phrases(spark, []) == [] and phrases(spark, [("en", None), (None, "a b")]) == []


def test_scores_beyond_64_bits(spark):
    row = spark.sql("select (cast(2000000 as decimal(38, 0)) * cast(a as decimal(20, 0))) div cast(l + r as decimal(38, 0)) s "
                    "from values (9000000000000000000, 9100000000000000, 17) t(a, l, r)").first()[0]
    assert row == 2000000 * 9000000000000000000 // 9100000000000017
