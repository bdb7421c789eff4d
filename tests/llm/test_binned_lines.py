"""Lines are banded by binned samples, and keys meet packed: nothing similar is lost."""

import random

import numpy as np

from driftwood.llm import line_dedup, linking
from driftwood.llm import minhash as mh
from tests.llm import brute


def _keys(sets: np.ndarray):
    values, counts = np.ascontiguousarray(sets).reshape(-1), np.full(len(sets), sets.shape[1])
    filled = (mh.binned_signatures(values, counts, line_dedup.BANDS, line_dedup.ROWS) != 0xFFFFFFFF).sum(axis=1)
    wide = mh.band_keys(mh.binned_signatures(values, counts, line_dedup.BANDS, line_dedup.ROWS), line_dedup.BANDS, line_dedup.ROWS, seed=33)
    small = mh.band_keys(mh.signatures(values, counts, line_dedup.BANDS * line_dedup.ROWS), line_dedup.BANDS, line_dedup.ROWS)
    return filled, wide, small


def test_binned_samples_keep_pairs_at_the_threshold():
    """10,000 pairs of each size at a similarity of 0.8, on both sides of the bounds."""
    rng, missed = np.random.default_rng(5), 0
    for n, shared, more in ((27, 24, 3), (45, 40, 5), (63, 56, 7), (90, 80, 10), (180, 160, 20), (40, 40, 10), (72, 72, 18)):
        v = rng.integers(0, 1 << 64, (10_000, n + more), dtype=np.uint64)
        (fa, wa, sa), (fb, wb, sb) = _keys(v[:, :n]), _keys(np.hstack([v[:, :shared], v[:, n:]]))
        wide = (np.minimum(fa, fb) >= line_dedup.FILLED) & (wa == wb).any(axis=1)
        small = (np.maximum(fa, fb) < line_dedup.FULL) & (sa == sb).any(axis=1)
        missed += int((~(wide | small)).sum())
    assert missed <= 7, missed


def test_every_line_has_keys_by_its_set():
    r = random.Random(4)
    lines = ["-" * 500, "=" * 500] + ["".join(r.choices("abcdefgh", k=k)) for k in (8, 20, 45, 70, 90, 150, 4000)]
    seen = {}
    for at, keys in line_dedup._bands(lines):
        for i, row in zip(at.tolist(), keys.tolist()):
            seen.setdefault(i, []).extend(row)
    assert sorted(seen) == list(range(len(lines)))
    assert not set(seen[0]) & set(seen[1])                      # one shingle each, whatever the length
    assert {len(k) for k in seen.values()} == {line_dedup.BANDS, 2 * line_dedup.BANDS}


def test_packed_keys_meet(spark):
    r = random.Random(8)
    rows = [(cid, [r.randrange(-1 << 63, 1 << 63) >> 52 for _ in range(5)]) for cid in range(-40, 400)]
    rows += rows[:50] + [(1000, [])]
    classes = spark.createDataFrame(rows, "cid long, bands array<long>").repartition(5)
    packed = classes.mapInArrow(linking.key_packer(spark), linking.PACKED)
    got = packed.repartition("part").sortWithinPartitions("part").mapInArrow(linking._shared_keys, "key long, cid long, first long").collect()
    held = {}
    for cid, keys in rows:
        for k in keys:
            held.setdefault(k, set()).add(cid)
    assert sorted(map(tuple, got)) == sorted((k, c, min(cids)) for k, cids in held.items() if len(cids) > 1 for c in cids)


def test_links_of_small_tiles_join_what_the_similarity_joins():
    r, percent = random.Random(2), 80
    for _ in range(40):
        tile = np.sort(np.array([r.randrange(6) for _ in range(40)]))
        base = [sorted(r.sample(range(10_000), 60)) for _ in range(3)]
        sets = [np.array(sorted({x if r.random() < 0.93 else r.randrange(10_000) for x in r.choice(base)}), np.uint64) for _ in tile]
        label, half = np.array([r.randrange(12) for _ in tile]), np.array([r.randrange(2) if t < 3 else 0 for t in tile])
        items, m = np.concatenate([np.append(s, s[:3]) for s in sets]), np.array([len(s) + 3 for s in sets])
        links = linking._few_links(tile, half, label, np.array([len(s) for s in sets]), items, m, percent)
        for t in set(tile.tolist()):
            own = np.flatnonzero(tile == t).tolist()
            two = len({half[i] for i in own}) > 1
            pairs = [(i, j) for i in own for j in own if i < j and label[i] != label[j] and (not two or half[i] != half[j])
                     and 100 * len(np.intersect1d(sets[i], sets[j])) >= percent * len(np.union1d(sets[i], sets[j]))]

            def classes(some):
                group = {label[i]: label[i] for i in own}
                for i, j in some:
                    a, b = group[label[i]], group[label[j]]
                    group = {k: a if v == b else v for k, v in group.items()}
                return {frozenset(k for k in group if group[k] == v) for v in group.values()}

            mine = [x for x in links if x[0] in own]
            assert classes(mine) == classes(pairs) and set(mine) <= set(pairs) and len(mine) < max(1, len(own) + 1)


def test_lines_of_all_lengths(spark):
    r, docs = random.Random(6), []
    for d in range(60):
        lines = []
        for _ in range(5):
            k = r.choice((10, 40, 60, 90, 200, 900))
            x = list(("".join(random.Random(k).choices("abcdefghij ", k=k))))
            for _ in range(r.randrange(k // 60 + 2)):
                x[r.randrange(k)] = r.choice("xyz")
            lines.append("".join(x))
        docs.append((d, "\n".join(lines)))
    out = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted((x["doc_id"], x["text"], x["n_lines"], x["n_removed"]) for x in out.collect()) == brute.lines(docs)
