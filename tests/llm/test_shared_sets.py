"""Small buckets that hold the same classes, digests of lines."""

import random

import numpy as np

from driftwood.llm import line_dedup, linking
from driftwood.llm import minhash as mh


def _sets_of_tiles(r, tiles=8):
    """Sets with a label each, and tiles that share them."""
    base = [sorted(r.sample(range(10_000), 60)) for _ in range(3)]
    sets = [np.array(sorted({x if r.random() < 0.94 else r.randrange(10_000) for x in r.choice(base)}), np.uint64) for _ in range(25)]
    label = np.array([r.randrange(12) for _ in sets])
    rows = sorted((t, s) for t in range(tiles) for s in r.sample(range(len(sets)), 9))
    return sets, label, np.array([t for t, _ in rows]), np.array([s for _, s in rows])


def _classes(labels, pairs):
    group = {x: x for x in labels}
    for x, y in pairs:
        a, b = group[x], group[y]
        group = {k: a if v == b else v for k, v in group.items()}
    return {frozenset(k for k in group if group[k] == v) for v in group.values()}


def test_pairs_of_several_tiles_are_looked_at_once(monkeypatch):
    r = random.Random(3)
    for _ in range(20):
        sets, label, tile, of = _sets_of_tiles(r)
        looked, was = [], linking._allowed
        monkeypatch.setattr(linking, "_allowed", lambda v, m, n, a, b, p: looked.extend(zip(a.tolist(), b.tolist())) or was(v, m, n, a, b, p))
        n = np.array([len(s) for s in sets])
        links = linking._few_links(tile, np.zeros(len(tile), int), label[of], n, np.concatenate(sets), n, 80, of)
        monkeypatch.undo()
        assert len(looked) == len({frozenset(p) for p in looked})
        similar = {(i, j) for t in set(tile.tolist()) for i in of[tile == t].tolist() for j in of[tile == t].tolist()
                   if label[i] != label[j] and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
        mine = [(int(of[i]), int(of[j])) for i, j in links]
        assert set(mine) <= similar and len(mine) < len(set(label.tolist()))
        assert _classes(label.tolist(), [(label[i], label[j]) for i, j in mine]) == \
            _classes(label.tolist(), [(label[i], label[j]) for i, j in similar])


def test_buckets_of_the_same_classes_become_one_tile(spark, monkeypatch):
    """Every three of the classes 0 to 5 share six keys; the sets of 1 and 2 are similar, no others."""
    own = {c: list(range(1000 * c, 1000 * c + 100)) for c in range(6)}
    own[2] = own[1][:95] + [7]
    keys = {}
    for group in ((0, 1, 2), (3, 4, 5)):
        for k in range(6):
            for c in group:
                keys.setdefault(c, []).append(100 * group[0] + k << 40)
    classes = spark.createDataFrame(sorted(keys.items()), "cid long, bands array<long>") \
        .mapInArrow(linking.key_packer(spark), linking.PACKED)
    table = spark.createDataFrame([(c, len(s), ",".join(map(str, s))) for c, s in own.items()], "cid long, n long, payload string")

    def unpack(payload):
        sets = [[int(x) for x in p.split(",")] for p in payload.to_pylist()]
        return mh.mix(np.array([x for s in sets for x in s], np.uint64)), np.array([len(s) for s in sets])

    rows, was = {}, linking.stored
    monkeypatch.setattr(linking, "stored", lambda df, name: rows.__setitem__(name, (out := was(df, name)).count()) or out)
    got = linking.near_components(classes, lambda cids: table.join(cids, "cid"), unpack, 80).collect()
    assert sorted(map(tuple, got)) == [(1, 1), (2, 1)]
    assert rows["open"] == 6 and rows["members"] == 36


def test_digests_of_lines_need_no_python(spark):
    texts = ["a\n b \r\n\t\n\n", "", " ", "ä \t\nzwei  Wörter \r", "\x0bx\n\r\n", "😀 \n😀", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = line_dedup.line_digests(docs, "doc_id", "text")
    assert {r["id"]: r["digests"] for r in out.collect()} == {
        i: [line_dedup._digest(x) if x else None for x in line_dedup._plain(t)] for i, t in enumerate(texts) if t is not None}
    assert "MapInArrow" not in out._jdf.queryExecution().toString()


def test_counts_of_distinct_values():
    r = np.random.default_rng(5)
    counts = r.integers(0, 40, 60)
    values = r.integers(0, 30, int(counts.sum())).astype(np.uint64)
    assert mh.distinct_counts(values, counts).tolist() == mh.distinct_sets(values, counts)[1].tolist()
