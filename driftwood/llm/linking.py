"""Components of near-duplicate sets: banding, sketch filter, exact check.

Input is one row per *class* (sets that are equal are one class), so copies
never meet in pairs.  Classes that share a band key are candidates.  They
are not paired off within a bucket:

1. every class is checked against the first class of each of its buckets;
   most groups become one component this way;
2. buckets that still hold several components go, with the full sets of their
   classes, to tasks that look across components only: where sizes (and odd
   sketches) allow the similarity, the sets are intersected at once, and what links is
   one component from there on.  A task returns at most one link fewer than
   it has components, never the pairs it looked at.

So a bucket of m classes costs about m checks unless its classes really are
dissimilar, and its links are fewer than its classes.  A bucket of more than
``TILE`` classes or ``TILE_ITEMS`` items is dealt out into parts, and every
two parts meet in a task of their own.  Nothing is capped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwood.llm import minhash as mh
from driftwood.llm.arrowtext import binaries, group_bounds, longs, longs_of, text_lengths, whole_groups
from driftwood.llm.components import connected_components, discard, stored

TILE = 2048
TILE_ITEMS = 400_000
ITEMS_AT_A_TIME = 256                # of a row that is held against all others
KEYS_AT_A_TIME = 1 << 18
BYTES_AT_A_TIME = 400_000            # of payloads that are unpacked together
FEW = 64                             # rows of a tile whose pairs are listed
COUNTERS = 1024                      # per set, for a bound of what two sets share
PAIRS_AT_A_TIME = 1024               # of sets whose bounds are taken together

# band keys on their way to the task where equal ones meet: keys of one part
# (their upper bits) side by side, and the classes they belong to
PACKED = "part int, keys binary, cids binary"


def key_packer(spark: SparkSession) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows ``cid, bands`` → rows of ``PACKED``.  The parts grow with the
    partitions of a shuffle."""
    bits = max(1024, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))).bit_length()

    def packed(keys: np.ndarray, cids: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(keys)
        keys, cids = keys[order], cids[order]
        bounds = group_bounds(keys >> np.uint64(64 - bits))
        return pa.RecordBatch.from_arrays(
            [pa.array((keys[bounds[:-1]] >> np.uint64(64 - bits)).astype(np.int32)), binaries(keys, bounds), binaries(cids, bounds)],
            names=["part", "keys", "cids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            bands = batch.column(1)
            keys = bands.flatten().to_numpy().view(np.uint64)
            held.append((keys, np.repeat(batch.column(0).to_numpy(), bands.value_lengths().fill_null(0).to_numpy())))
            n += len(keys)
            if n >= KEYS_AT_A_TIME:
                yield packed(*map(np.concatenate, zip(*held)))
                held, n = [], 0
        if n:
            yield packed(*map(np.concatenate, zip(*held)))

    return run


def _shared_keys(batches: Iterator[pa.RecordBatch], sized: bool = False) -> Iterator[pa.RecordBatch]:
    """Whole parts → ``key, cid, first`` for the keys of several classes, and how many those are if ``sized``."""
    for table in whole_groups(batches):
        bounds = group_bounds(table.column(0).to_numpy())
        for s, e in zip(bounds[:-1], bounds[1:]):
            part = table.slice(s, e - s)
            keys, cids = longs_of(part.column(1)), longs_of(part.column(2))
            order = np.argsort(keys)
            again = np.zeros(len(keys) + 1, bool)
            again[1:-1] = keys[order[1:]] == keys[order[:-1]]
            order = order[again[1:] | again[:-1]]                 # keys that occur once end here
            keys, cids = keys[order], cids[order]
            order = np.lexsort((cids, keys))
            keys, cids = keys[order], cids[order]
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (cids[1:] != cids[:-1])
            keys, cids = keys[new], cids[new]
            runs = group_bounds(keys)
            sizes = np.diff(runs)
            several = np.repeat(sizes > 1, sizes)
            if several.any():
                first, m = np.repeat(cids[runs[:-1]], sizes), np.repeat(sizes, sizes)
                columns = [longs(keys[several]), pa.array(cids[several]), pa.array(first[several]), pa.array(m[several])]
                yield pa.RecordBatch.from_arrays(columns[:3 + sized], names=["key", "cid", "first", "m"][:3 + sized])


def _runs(bounds: np.ndarray, payload: pa.ChunkedArray) -> Iterator[np.ndarray]:
    """Cut the tiles of a table into runs of about ``BYTES_AT_A_TIME`` bytes of payload and counters."""
    ends = np.cumsum(text_lengths(payload) + COUNTERS)[bounds[1:] - 1]
    start = 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + BYTES_AT_A_TIME, side="right")))
        yield bounds[start:stop + 1]
        start = stop


def _differing(x: Column, y: Column, words: int) -> Column:
    return sum((F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))) for i in range(1, words)),
               F.bit_count(F.get(x, F.lit(0)).bitwiseXOR(F.get(y, F.lit(0)))))


def _near_pairs(pairs: DataFrame, info: DataFrame, most_odd: int, words: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sizes, and sketches if there are any, allow the
    similarity, with the size of ``b``."""
    def side(name, n, sketch):
        return info.select(F.col("cid").alias(name), F.col("n").alias(n), *([F.col("sketch").alias(sketch)] if words else []))

    sized = pairs.join(side("a", "na", "sa"), "a").join(side("b", "nb", "sb"), "b")
    near = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    if words:
        near = near & (_differing(F.col("sa"), F.col("sb"), words) <= most_odd)
    return sized.where(near).select("a", "b", "nb")


def _tiles(m: Column, total: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(m / F.lit(TILE)), F.ceil(total / F.lit(TILE_ITEMS))).cast("int")


def _allowed(values: np.ndarray, m: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sets may be similar: by how many values of each set have
    the same lower bits, two sets share at most the sum of the smaller counts.
    ``m``: values per set, of which ``n`` are distinct."""
    at = np.repeat(np.arange(len(m)) * COUNTERS, m) + (values & np.uint64(COUNTERS - 1)).astype(np.int64)
    counts = np.bincount(at, minlength=len(m) * COUNTERS).astype(np.uint32 if m.max(initial=0) >= 1 << 16 else np.uint16) \
        .reshape(len(m), COUNTERS)
    out = np.zeros(len(a), bool)
    for c in range(0, len(a), PAIRS_AT_A_TIME):
        x, y = a[c:c + PAIRS_AT_A_TIME], b[c:c + PAIRS_AT_A_TIME]
        most = np.minimum(np.minimum(counts[x], counts[y]).sum(axis=1, dtype=np.int64), np.minimum(n[x], n[y]))
        out[c:c + PAIRS_AT_A_TIME] = 100 * most >= percent * (n[x] + n[y] - most)
    return out


def _linked(values: np.ndarray, m: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sets are similar."""
    ends = np.cumsum(m)
    out, own, last = np.zeros(len(a), bool), np.zeros(0, np.uint64), -1
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        if x != last:
            own, last = _distinct(values[ends[x] - m[x]:ends[x]]), x
        out[i] = _similar(own, _distinct(values[ends[y] - m[y]:ends[y]]), percent)
    return out


def _similar(own: np.ndarray, other: np.ndarray, percent: int) -> bool:
    """Whether two sets (distinct values) are similar."""
    every = np.concatenate([own, other])
    every.sort()
    both = np.count_nonzero(every[1:] == every[:-1])
    return 100 * both >= percent * (len(every) - both)


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    new = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return values[new]


def _first_links(unpack: Callable, percent: int):
    """For rows ``tile, member, cid, n, payload`` sorted by tile and member, of
    which the first of a tile is the class that the others are held against:
    the pairs ``a, b`` that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            for bounds in _runs(group_bounds(table.column(0).to_numpy()), table.column(4)):
                part = table.slice(bounds[0], bounds[-1] - bounds[0])
                cid, n = part.column(2).to_numpy(), part.column(3).to_numpy()
                values, m = unpack(part.column(4).combine_chunks())
                first = np.repeat(bounds[:-1] - bounds[0], np.diff(bounds))
                a, b = first, np.arange(len(cid))
                near = np.flatnonzero(_allowed(values, m, n, a, b, percent) & (a != b))
                good = near[_linked(values, m, a[near], b[near], percent)]
                if len(good):
                    yield pa.RecordBatch.from_arrays([pa.array(cid[a[good]]), pa.array(cid[b[good]])], names=["a", "b"])

    return run


def _root(root: list[int], x: int) -> int:
    while root[x] != x:
        root[x] = x = root[root[x]]
    return x


def _spanning(cid: np.ndarray, half: np.ndarray, label: np.ndarray, n: np.ndarray, sketch: np.ndarray | None,
              items: np.ndarray, most_odd: int, percent: int) -> list[tuple[int, int]]:
    """Links across labels (as row numbers) that join what the similarity
    joins; rows of different halves are compared, or all if there is one.
    ``items``: the sets, ``n`` values each, one after the other.

    With sketches a row is held against the rows that they allow; without,
    the rows that hold its items are counted.
    """
    _, ids = np.unique(label, return_inverse=True)
    root = list(range(int(ids.max()) + 1))
    # every item as a small number, so that a row is marked and all others are counted against it
    item = np.unique(items, return_inverse=True)[1].astype(np.int32)
    ends = np.cumsum(n)
    begins = ends - n
    mark = np.zeros(int(item.max(initial=-1)) + 1, bool)
    if sketch is None:
        holders = np.repeat(np.arange(len(n), dtype=np.int32), n)[np.argsort(item, kind="stable")]
        upto = np.cumsum(np.bincount(item)).astype(np.int32)
    links, across = [], bool((half != half[0]).any())
    seekers = np.flatnonzero(half == half.min()) if across else np.arange(len(cid))
    if not across:                                # rows of the largest component are found by the others
        seekers = np.flatnonzero(ids != np.argmax(np.bincount(ids)))
    now = ids.copy()
    for i in seekers:
        small, large = np.minimum(n, n[i]), np.maximum(n, n[i])
        near = (now != now[i]) & (100 * small >= percent * large)
        if across:
            near &= half != half[i]
        near = np.flatnonzero(near)
        if not len(near):
            continue
        if sketch is None:
            own = item[begins[i]:ends[i]]
            sizes = upto[own] - np.where(own > 0, upto[own - 1], 0)
            both = np.zeros(len(n), np.int64)
            for c in range(0, len(own), ITEMS_AT_A_TIME):
                some = sizes[c:c + ITEMS_AT_A_TIME]
                at = np.repeat(upto[own[c:c + ITEMS_AT_A_TIME]] - np.cumsum(some, dtype=np.int32), some) + \
                    np.arange(int(some.sum()), dtype=np.int32)
                both += np.bincount(holders[at], minlength=len(n))
            both = both[near]
        else:
            near = near[np.bitwise_count(sketch[near] ^ sketch[i]).sum(axis=1, dtype=np.int64) <= most_odd]
            if not len(near):
                continue
            mark[item[begins[i]:ends[i]]] = True
            sizes = n[near]
            at = np.repeat(begins[near] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
            both = np.add.reduceat(mark[item[at]].astype(np.int64), np.cumsum(sizes) - sizes)
            mark[item[begins[i]:ends[i]]] = False
        linked = False
        for j in near[100 * both >= percent * (n[near] + n[i] - both)]:
            a, b = _root(root, int(ids[i])), _root(root, int(ids[j]))
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((int(i), int(j)))
                linked = True
        if linked:
            now = np.array([_root(root, x) for x in range(len(root))])[ids]
    return links


def _few_links(tile: np.ndarray, half: np.ndarray, label: np.ndarray, n: np.ndarray, items: np.ndarray, m: np.ndarray,
               percent: int, of: np.ndarray | None = None) -> list[tuple[int, int]]:
    """As :func:`_spanning`, for the rows of several small tiles: their pairs
    across labels are listed, and thinned out by :func:`_allowed`.  ``items``
    may repeat: ``m`` of a row, ``n`` of them distinct.

    With ``of``, the number of each row's set, rows of several tiles share the
    sets ``n``, ``items`` and ``m`` (and a set has one label): a pair that
    several tiles hold is looked at once, and links span the labels of all.
    """
    bounds = group_bounds(tile)
    sizes = np.diff(bounds)
    after = np.repeat(bounds[1:], sizes) - np.arange(len(tile)) - 1           # rows of the tile behind each
    a = np.repeat(np.arange(len(tile)), after)
    b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(after) - after, after)
    across = np.repeat(np.minimum.reduceat(half, bounds[:-1]) != np.maximum.reduceat(half, bounds[:-1]), sizes)
    alone = of is None
    of = np.arange(len(tile)) if alone else of
    near = (label[a] != label[b]) & (~across[a] | (half[a] != half[b])) & \
        (100 * np.minimum(n[of[a]], n[of[b]]) >= percent * np.maximum(n[of[a]], n[of[b]]))
    a, b = a[near], b[near]
    if not alone:
        once = np.unique(np.minimum(of[a], of[b]) * len(m) + np.maximum(of[a], of[b]), return_index=True)[1]
        a, b = a[once], b[once]
    near = _allowed(items, m, n, of[a], of[b], percent)
    root: dict = {}

    def top(x):
        while (up := root.get(x, x)) != x:
            x = up
        return x

    ends, sets = np.cumsum(m), {}

    def of_row(i):
        if (k := of[i]) not in sets:
            sets[k] = _distinct(items[ends[k] - m[k]:ends[k]])
        return sets[k]

    links = []
    for i, j in zip(a[near].tolist(), b[near].tolist()):
        x, y = (top((tile[k] if alone else 0, label[k])) for k in (i, j))
        if x != y and _similar(of_row(i), of_row(j), percent):
            root[x] = y
            links.append((i, j))
    return links


def _cross_links(unpack: Callable, most_odd: int, words: int, percent: int):
    """For rows ``tile, cid, half, label, n, payload, s0…`` sorted by tile: the
    labels ``a, b`` that spanning links join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            tile = table.column(0).to_numpy()
            bounds = group_bounds(tile)
            few = np.zeros(len(tile), bool)
            if not words:
                few = np.repeat(np.diff(bounds) <= FEW, np.diff(bounds))
                small = table.filter(pa.array(few))
                for own in _runs(group_bounds(tile[few]), small.column(5)) if few.any() else ():
                    part = small.slice(own[0], own[-1] - own[0])
                    tiles, cid, half, label, n = (part.column(i).to_numpy() for i in range(5))
                    _, one, of = np.unique(cid, return_index=True, return_inverse=True)
                    links = _few_links(tiles, half, label, n[one], *unpack(part.column(5).combine_chunks().take(pa.array(one))), percent, of)
                    if links:
                        a, b = np.array(links).T
                        yield pa.RecordBatch.from_arrays([pa.array(label[a]), pa.array(label[b])], names=["a", "b"])
            for s, e in zip(bounds[:-1], bounds[1:]):
                if few[s]:
                    continue
                part = table.slice(s, e - s)
                cid, half, label = (part.column(i).to_numpy() for i in range(1, 4))
                if (label == label[0]).all():
                    continue
                sketch = np.stack([part.column(6 + w).to_numpy() for w in range(words)], axis=1).astype(np.uint64) if words else None
                values, n = mh.distinct_sets(*unpack(part.column(5).combine_chunks()))
                links = _spanning(cid, half, label, n, sketch, values, most_odd, percent)
                if links:
                    a, b = np.array(links).T
                    yield pa.RecordBatch.from_arrays([pa.array(label[a]), pa.array(label[b])], names=["a", "b"])

    return run


def near_components(classes: DataFrame, sets_for: Callable[[DataFrame], DataFrame], unpack: Callable, percent: int,
                    most_odd: int = 0, words: int = 0) -> DataFrame:
    """``id, component`` for all classes that link with another one.

    ``classes``: ``cid`` (long; repeated rows do no harm) and ``bands`` (array
    of long), packed by a :func:`key_packer`; it is read once.  ``sets_for`` gives ``cid``, ``n`` and
    ``payload`` (and ``sketch``, if it has ``words`` of 64 bits) once for each
    cid of a table; only classes that share a band key are asked for.
    ``unpack`` makes the sets out of an Arrow array of payloads: their values
    one after the other, repeated or not, and how many each has; ``n`` is the
    number of distinct ones.
    """
    # one exchange: the rows of a key meet, and keys of one class end there
    members = stored(classes.repartition("part").sortWithinPartitions("part")
                     .mapInArrow(lambda batches: _shared_keys(batches, True), "key long, cid long, first long, m long"), "members")
    items = stored(sets_for(members.select("cid").distinct()), "items")
    info = items.drop("payload")

    # every class against the first of its buckets: that one is sent once to each part of its partners
    tested = members.where("first <> cid").select(F.col("first").alias("a"), F.col("cid").alias("b")).distinct()
    near = stored(_near_pairs(tested, info, most_odd, words, percent), "near")
    firsts = near.groupBy("a").agg(_tiles(F.count(F.lit(1)), F.sum("nb")).alias("parts"))
    payloads = items.select("cid", "n", "payload")
    seconds = near.join(firsts, "a").select(F.xxhash64("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")).alias("tile"),
                                            F.lit(1).alias("member"), F.col("b").alias("cid"))
    firsts = firsts.select(F.col("a").alias("cid"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")) \
        .select(F.xxhash64("cid", "part").alias("tile"), F.lit(0).alias("member"), "cid")
    held = firsts.unionByName(seconds).join(payloads, "cid").select("tile", "member", "cid", "n", "payload")
    links = stored(held.repartition("tile").sortWithinPartitions("tile", "member")
                   .mapInArrow(_first_links(unpack, percent), "a long, b long"), "links")
    labels = connected_components(links)
    # buckets that are not one component yet, and were not two classes only; of those with the same classes, one
    named = members.where("m > 2").select("key", "cid", "first").join(info.select("cid", "n"), "cid") \
        .join(labels, F.col("cid") == F.col("id"), "left") \
        .select("key", "cid", "first", "n", F.coalesce("component", "cid").alias("label"))
    open_keys = named.groupBy("key") \
        .agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("m"), F.sum("n").alias("total"),
             F.bit_xor(F.xxhash64("cid")).alias("x"), F.bit_xor(F.xxhash64("cid", F.lit(7))).alias("y")) \
        .where("lo < hi").groupBy("m", "total", "x", "y").agg(F.min("key").alias("k")).select("k", "m", "total")
    tiles = _tiles(F.col("m"), F.col("total"))
    mine, other = F.pmod(F.xxhash64("cid"), tiles).cast("int"), F.explode(F.sequence(F.lit(0), tiles - 1))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    dealt = stored(named.join(open_keys, F.col("key") == F.col("k"))
                   .withColumn("mine", mine).withColumn("other", other)
                   .withColumn("tile", F.xxhash64("key", low, high))
                   # small buckets of one first class, which share others, too, go to one task
                   .select(F.when(F.col("m") <= FEW, F.xxhash64("first")).otherwise(F.col("tile")).alias("task"), "tile", "cid", "label",
                           F.when(F.col("mine") > F.col("other"), 1).otherwise(0).alias("half")), "open")
    rows = dealt.join(items, "cid") \
        .select("task", "tile", "cid", "half", "label", "n", "payload", *[F.get("sketch", F.lit(w)).alias(f"s{w}") for w in range(words)])
    found = stored(rows.repartition("task").sortWithinPartitions("task", "tile").drop("task")
                   .mapInArrow(_cross_links(unpack, most_odd, words, percent), "a long, b long"), "cross")
    if not found.isEmpty():
        # a component is named by its smallest id, and so is one of components
        first, joined = labels, connected_components(found)
        labels = stored(first.join(joined.select(F.col("id").alias("was"), F.col("component").alias("now")), F.col("component") == F.col("was"), "full")
                        .select(F.coalesce("id", "was").alias("id"), F.coalesce("now", "component").alias("component")), "joined")
        discard(first, joined)
    discard(members, items, near, links, dealt, found)
    return labels


# bits of the filter that spares a join the rows that cannot match: 4 MB
FILTER_BITS = 1 << 25
_CHUNK = 32768


def maybe_in(df: DataFrame, value: Column, ids: DataFrame, column: str, name: str = "_dw_hit",
             bits: int = FILTER_BITS) -> DataFrame:
    """``df`` with a boolean ``name``: true for every ``value`` that ``ids``
    holds, and for few others.

    The test is a bitmap of ``bits`` bits, a table of at most ``bits`` / 32768
    rows of 4 kB whatever the size of ``ids``: that bound is why it is
    broadcast.  It only thins out the large side before a join; a bitmap too
    full for its table admits more, and loses nothing.
    """
    def place(x: Column) -> Column:
        return F.pmod(F.xxhash64(x, F.lit(7)), F.lit(bits))

    bitmap = stored(ids.select(place(F.col(column)).alias("p")).groupBy(F.floor(F.col("p") / _CHUNK).alias("_dw_c"))
                    .agg(F.bitmap_construct_agg((F.col("p") % _CHUNK).cast("int")).alias("_dw_b")), "filter")
    at = F.col("_dw_p") % _CHUNK
    byte = F.conv(F.hex(F.substring(F.col("_dw_b"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (at % 8).cast("int"))) != 0
    return df.withColumn("_dw_p", place(value)) \
        .join(F.broadcast(bitmap), F.floor(F.col("_dw_p") / _CHUNK) == F.col("_dw_c"), "left") \
        .withColumn(name, F.coalesce(bit, F.lit(False))).drop("_dw_p", "_dw_c", "_dw_b")
