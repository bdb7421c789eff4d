import random

import pytest
from pyspark.sql import functions as F

from driftwood.llm import embedding_dedup, line_dedup, linking, near_dedup, substring_dedup, url_cascade
from driftwood.llm.components import connected_components
from tests.llm import brute


def test_components_of_random_links(spark):
    r = random.Random(4)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(links, "a long, b long")).collect()))
    nodes = sorted({x for a, b in links if a != b for x in (a, b)})
    at = {x: i for i, x in enumerate(nodes)}
    want = brute.components(len(nodes), [(at[a], at[b]) for a, b in links if a != b])
    assert got == {x: nodes[want[i]] for x, i in at.items()}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# ------------------------------------------------------------- op 3 --

def _repeats_match(spark, texts, **kw):
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    out = substring_dedup.remove_repeats(docs, keep=["doc_id", "spans"], **kw)
    assert out.columns == ["doc_id", "n_bytes", "spans", "kept"]
    got = {r["doc_id"]: (r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in out.collect()}
    for i, want in enumerate(brute.repeats(texts, kw["length"])):
        assert got[i] == want, i
    assert len(got) == len(texts)


def _repetitive(seed):
    r = random.Random(seed)

    def words(n):
        return "".join(r.choice("abcdeé \n") for _ in range(n))

    passages = [words(r.randint(30, 150)) for _ in range(6)]
    texts = []
    for _ in range(40):
        parts = [r.choice(passages) if r.random() < 0.5 else words(r.randint(0, 80)) for _ in range(r.randint(1, 5))]
        t = "".join(parts)
        if t and r.random() < 0.4:
            i = r.randrange(len(t))
            t = t[:i] + "#" + t[i + 1:]
        texts.append(t)
    return texts + [None, "", "a" * 300, "xyz" * 90, "é" * 100, texts[0], texts[0], passages[1] + passages[1]]


@pytest.mark.parametrize("seed", [1, 2])
def test_substrings_equal_brute_force(spark, seed):
    _repeats_match(spark, _repetitive(seed), length=40, gram=12)


def test_substrings_of_hot_blocks(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT", 1)
    _repeats_match(spark, _repetitive(3), length=40, gram=16)


def test_substrings_of_equal_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "q" * 5 + "abcdefgh" * 60)] * 2 + [(None, "abcdefgh" * 60)], "doc_id long, text string")
    rows = substring_dedup.remove_repeats(docs, length=100, gram=30).collect()
    assert len(rows) == 3 and all(bytes(r["kept"]) == b"" for r in rows)
    assert substring_dedup.remove_repeats(docs.limit(0)).count() == 0


# ------------------------------------------------------------- op 5 --

URLS = ["http://a.org/x", "https://Example.ORG/es/1", "http://x.example.org/en/12?q#f", "http://x.example.org/en/2", "http://b.com/fr/",
        "http://b.com/de/", "http://b.com/en/", "http://c.com", "http://org", "http://notorg/x", None, "", "no scheme", "x://",
        "http://d.net?x=/de/", "http://e.com#/de/", "http://u@f.com:80/de/", "http://b.com/en/://g.org/", "http://b.com/de/", "ftp://g.org\n/x"]
WANT = {  # url: host, path, rule, verdict
    "http://a.org/x": ("a.org", "/x", "org/", "allow"),
    "https://Example.ORG/es/1": ("example.org", "/es/1", "example.org/es/", "block"),
    "http://x.example.org/en/12?q#f": ("x.example.org", "/en/12", "example.org/en/1", "block"),
    "http://x.example.org/en/2": ("x.example.org", "/en/2", "org/", "allow"),
    "http://b.com/en/": ("b.com", "/en/", None, "block"),          # its host is listed
    "http://c.com": ("c.com", "", None, "allow"),
    "http://org": ("org", "", None, "allow"),
    "http://d.net?x=/de/": ("d.net", "", None, "allow"),
    None: ("", "", None, "allow"), "no scheme": ("", "", None, "allow"), "x://": ("", "", None, "allow"),
    "http://b.com/en/://g.org/": ("b.com", "/en/://g.org/", None, "block"),
}


@pytest.mark.parametrize("words", [url_cascade.LITERAL_WORDS, 0])
def test_urls(spark, words):
    pages = spark.createDataFrame([(i, u, "c", "d") for i, u in enumerate(URLS)], "page_id long, url string, host string, rule string")
    out = url_cascade.judge(pages, ["page_id", "host"], literal_words=words)
    assert out.columns == ["page_id", "host", "path", "rule", "verdict"]
    got = {r["page_id"]: tuple(r)[1:] for r in out.collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        if u in WANT:
            assert got[i] == WANT[u], u
    assert url_cascade.judge(pages.limit(0), ["page_id"]).count() == 0


@pytest.mark.parametrize("words", [url_cascade.LITERAL_WORDS, 2])
def test_cascade_is_exact(spark, monkeypatch, words):
    monkeypatch.setattr(url_cascade, "BITS_PER_KEY", 3)              # many false positives, many levels
    keys = spark.range(6000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    levels = url_cascade.build_cascade(keys, literal_words=words)
    assert len(levels) > 2
    out = url_cascade.is_listed(keys, "key", levels, "answer")
    assert out.where("answer <> listed").count() == 0 and out.count() == 6000
    assert not url_cascade.build_cascade(keys.where("not listed"), literal_words=words)


# ------------------------------------------------------------- op 6 --

def _family(seed, n=70):
    r = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    bases = [[r.choice(vocabulary) for _ in range(r.choice([3, 8, 30, 120]))] for _ in range(8)]
    docs = []
    for i in range(n):
        words = list(r.choice(bases))
        for _ in range(r.choice([0, 0, 1, 2, 3, 6])):
            words[r.randrange(len(words))] = r.choice(vocabulary)
        docs.append((i, " ".join(words).upper() if i % 5 == 0 else "\t".join(words)))
    return docs + [(n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "one"), (n + 4, "One"), (n + 5, "a\u00a0b")]


@pytest.mark.parametrize("shingle", [4, 5])
def test_near_duplicates_equal_brute_force(spark, shingle):
    docs = _family(shingle)
    got = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), shingle=shingle)
    assert sorted(tuple(r)[:4] for r in got.collect()) == brute.near_duplicates(docs, shingle)


def test_near_duplicates_in_a_group_that_straddles_the_threshold(spark, monkeypatch):
    """Members link in chains, not all with the first; tiles are forced."""
    monkeypatch.setattr(linking, "TILE", 8)
    monkeypatch.setattr(linking, "TILE_ITEMS", 300)
    r = random.Random(9)
    words = [f"w{i}" for i in range(100)]
    docs = []
    for i in range(60):
        if i % 3 == 0:
            words = list(words)
            words[r.randrange(100)] = f"x{i}"
        own = list(words)
        for _ in range(i % 4):
            own[r.randrange(100)] = f"y{i}"
        docs.append((i, " ".join(own)))
    got = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(tuple(x)[:4] for x in got.collect()) == brute.near_duplicates(docs, 5)


def test_near_duplicates_of_repeated_ids_and_clashing_columns(spark):
    long = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame([(1, "a b c d e f", "x", 1), (1, "a b c d e f", "x", 1), (1, long, "x", 1), (0, long + " z", "x", 2),
                                  (None, long, "x", 3), (7, None, "x", 4)], "doc_id long, text string, r string, kept int")
    rows = [tuple(x)[:4] for x in near_dedup.near_duplicates(docs).collect()]
    assert sorted(rows, key=repr) == sorted([(1, 2, 1, True), (1, 2, 1, True), (1, 46, 0, False), (0, 47, 0, True),
                                             (None, 46, None, True), (7, 0, 7, True)], key=repr)
    left = near_dedup.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    # rows without an id take part: theirs repeats document 0
    assert sorted(((x["doc_id"], x["text"]) for x in left.collect()), key=repr) == \
        sorted([(1, "a b c d e f"), (0, long + " z"), (7, None)], key=repr)
    none = spark.createDataFrame([(None, long), (None, long + " z"), (None, long), (None, "a b"), (None, None)], "doc_id long, text string")
    kept = [x["text"] for x in near_dedup.drop_near_duplicates(none).collect()]
    assert len(kept) == 3 and {"a b", None} < set(kept)
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


# ------------------------------------------------------------- op 8 --

def _vectors(seed, n=120, dim=16):
    import numpy as np
    g = np.random.default_rng(seed)
    base = g.standard_normal((12, dim))
    rows = []
    for i in range(n):
        v = base[g.integers(12)] + g.standard_normal(dim) * g.choice([0.0, 0.05, 0.15, 1.0])
        rows.append((i, [float(np.float32(x)) for x in v], int(g.integers(3))))
    rows += [(n, rows[3][1], rows[3][2]), (n + 1, rows[3][1], rows[3][2]), (n + 2, rows[3][1], None), (n + 3, None, 1),
             (n + 4, [0.0] * dim, 1), (n + 5, [float("nan")] * dim, 1), (n + 6, [None] + [1.0] * (dim - 1), 1),
             (n + 7, [float("inf")] + [1.0] * (dim - 1), 1), (n + 8, [], 1), (n + 9, [2 * x for x in rows[3][1]], rows[3][2]),
             (n + 10, rows[3][1][:5], rows[3][2])]
    return rows


@pytest.mark.parametrize("bucket,tile", [(1024, 2048), (4, 2048), (1024, 7)])
def test_embeddings_equal_brute_force(spark, monkeypatch, bucket, tile):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    plan = embedding_dedup.plan
    monkeypatch.setattr(embedding_dedup, "plan", lambda n, cosine=0.98: plan(n, cosine, bucket))
    rows = _vectors(tile)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(df).collect()}
    assert got == brute.cosine_links(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in embedding_dedup.near_duplicates(df).collect())


def test_embeddings_without_rows_or_ids(spark):
    df = spark.createDataFrame([(None, [1.0, 2.0], 1, 5), (4, [1.0, 2.0], 1, 5), (4, [1.0, 2.0], 1, 5)],
                               "vec_id long, embedding array<float>, label int, cid int")
    rows = sorted(map(tuple, embedding_dedup.near_duplicates(df).collect()), key=repr)
    assert rows == sorted([(None, 0, None, True), (4, 1, 4, True), (4, 1, 4, True)], key=repr)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_calibration():
    assert embedding_dedup.plan(1) == (0, 1)
    bits, tables = embedding_dedup.plan(1 << 20)
    assert bits == 10 and tables > 5
    assert 10 < embedding_dedup.least_collisions() < embedding_dedup.DIRECTIONS


# ------------------------------------------------------------- op 9 --

def _lined(seed):
    r = random.Random(seed)
    lines = ["".join(r.choice("abcdefghij ") for _ in range(r.choice([5, 12, 60, 120]))) for _ in range(25)]
    docs = []
    for i in range(40):
        own = []
        for _ in range(r.randint(0, 6)):
            line = r.choice(lines)
            if r.random() < 0.4:
                at = r.randrange(len(line))
                line = line[:at] + "é" + line[at + 1:]
            own.append(line if r.random() < 0.5 else "  " + line + " ")
        docs.append((i, "\n".join(own)))
    return docs + [(50, None), (51, ""), (52, "\n\n"), (53, "short"), (54, "short"), (55, "x" * 4000), (56, "x" * 3000)]


def test_lines_equal_brute_force(spark):
    docs = _lined(6)
    df = spark.createDataFrame([(*d, "s", 3) for d in docs], "doc_id long, text string, gone string, n_lines int")
    out = line_dedup.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "gone", "n_lines", "n_removed"]
    got = sorted((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in out.collect())
    assert got == brute.lines(docs)


def test_lines_of_repeated_and_no_rows(spark):
    line = "the very same line of text"
    df = spark.createDataFrame([(1, line), (1, line), (None, line), (2, line + "\n" + line)], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n_removed"]) for r in line_dedup.dedup_lines(df).collect()), key=repr)
    assert got == sorted([(1, 1), (1, 1), (None, 0), (2, 2)], key=repr)
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_spanning_links_join_what_the_similarity_joins():
    """Whole groups and two halves, against all pairs."""
    import random

    import numpy as np

    rng = random.Random(9)
    for trial in range(30):
        base = [frozenset(rng.sample(range(60), 30)) for _ in range(3)]
        sets = [frozenset((set(b) - set(rng.sample(sorted(b), k))) | {rng.randrange(60) for _ in range(k)})
                for b in base for k in (0, 1, 2, 3, 3, 4, 5)]
        n = len(sets)
        label = [rng.randrange(6) for _ in range(n)] if trial % 2 else list(range(n))
        half = [rng.randrange(2) for _ in range(n)] if trial % 3 else [0] * n
        pairs = [(i, j) for i in range(n) for j in range(i) if label[i] != label[j] and brute.near(sets[i], sets[j])
                 and (len(set(half)) == 1 or half[i] != half[j])]
        same = [(i, j) for i in range(n) for j in range(i) if label[i] == label[j]]
        items = np.concatenate([sorted(s) for s in sets])
        sketch = None if trial % 5 else np.zeros((n, 1), np.uint64)
        links = linking._spanning(np.arange(n), np.array(half), np.array(label), np.array([len(s) for s in sets]),
                                  sketch, items, 64, 80)
        assert set(map(tuple, map(sorted, links))) <= set(map(tuple, map(sorted, pairs)))
        assert len(links) < len(set(label))
        assert brute.components(n, same + links) == brute.components(n, same + pairs)
