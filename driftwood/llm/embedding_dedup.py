"""Near-duplicate embeddings by collision counting on projections.

Vectors of one label are projected onto many random directions and sorted
along each.  Around every query value lies a window as wide as the projected
difference of a pair at the wanted cosine may be; a pair collides once per
direction whose window holds it.  Pairs with at least ``least_collisions``
collisions are verified by their cosine in double precision.  Window and
count are calibrated: a pair at the cosine has fewer collisions than that
with a probability below ``MISS``.

So that no window runs over all vectors of a label, vectors are first dealt
into buckets by the signs of some projections, in several tables; how many
signs and tables follows from the label's size, and a pair at the cosine
shares no bucket with a probability below ``MISS``.  A bucket larger than
``TILE`` is split into tiles, which go to different tasks.  A pair counts in
the first table that brings it together, and tasks return sums and spanning
links, never the pairs.

Equal vectors of one label are one class from the start: each copy counts as
a link of the others, and no pair of copies is formed.

Linked with nothing: a null label, a null id, a vector that is null, empty
or zero or holds null, NaN or infinite components; vectors of different
lengths do not link.  Such a row is its own component and is kept (with a
null id the component is null).  Rows that repeat id, vector and label count
each.  Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import acos, ceil, comb, erf, log, log2, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwood.llm.arrowtext import group_bounds, whole_groups
from driftwood.llm.components import connected_components, stored

COSINE = 0.98
MISS = 1e-5
DIRECTIONS = 24
WINDOW_SIGMAS = 2.0
BUCKET = 1024            # vectors per bucket aimed at
TILE = 2048


def least_collisions(directions: int = DIRECTIONS, sigmas: float = WINDOW_SIGMAS, miss: float = MISS) -> int:
    """The count that a pair at the cosine falls short of with probability below ``miss``."""
    p = erf(sigmas / sqrt(2))
    below = 0.0
    for count in range(directions + 1):
        below += comb(directions, count) * p ** count * (1 - p) ** (directions - count)
        if below >= miss:
            return count
    return directions


def plan(n: int, cosine: float = COSINE, bucket: int = BUCKET, miss: float = MISS) -> tuple[int, int]:
    """Sign bits per table and number of tables for ``n`` vectors."""
    bits = max(0, ceil(log2(max(n, 1) / bucket)))
    if not bits:
        return 0, 1
    together = (1 - acos(cosine) / pi) ** bits
    return bits, ceil(log(miss) / log(1 - together))


@lru_cache(maxsize=32)
def _directions(dim: int, n: int, seed: int) -> np.ndarray:
    out = np.random.default_rng((seed, dim)).standard_normal((dim, n))
    return out / np.linalg.norm(out, axis=0)


def _matrix(column) -> np.ndarray:
    """Rows of equal length as a matrix of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _dealt(cosine: float):
    """Rows ``cid, dim, n, embedding`` → one row per table, with its bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, sizes = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for dim, n in {(int(d), int(s)) for d, s in zip(dims, sizes)}:
                rows = np.flatnonzero((dims == dim) & (sizes == n))
                part = batch.take(pa.array(rows))
                x = _matrix(part.column(3))
                bits, tables = plan(n, cosine)
                keys = np.empty((len(rows), tables), np.int64)
                for t in range(tables):
                    signs = (x @ _directions(dim, bits, 100 + t) > 0) if bits else np.zeros((len(rows), 0), bool)
                    number = signs @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(len(rows), np.int64)
                    keys[:, t] = number
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays([
                        part.column(0), part.column(4), pa.array(np.full(len(rows), t, np.int32)),
                        pa.array(keys[:, t]),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * (t + 1)),
                                                 pa.array(np.ascontiguousarray(keys[:, :t + 1]).reshape(-1))),
                        part.column(3), part.column(5)],
                        names=["cid", "grp", "t", "bucket", "earlier", "embedding", "weight"])

    return run


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable for each of ``n`` nodes linked by ``a``–``b``."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _linked(cosine: float, least: int):
    """Rows of one tile (``tile, side, cid, earlier, embedding, weight``) →
    per class the linked weight and a spanning link."""
    slack = 1e-6

    def pairs_of(x: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Linked pairs (row, column) with row < column where the sides are the same."""
        dim, n = x.shape[1], len(cols)
        norm = np.linalg.norm(x, axis=1)
        unit = x / norm[:, None]
        width = WINDOW_SIGMAS * sqrt(2 - 2 * cosine) / sqrt(dim) + slack
        spots = unit @ _directions(dim, DIRECTIONS, 7)
        # a pair that collides often enough misses fewer windows than this, so it
        # collides along one of the first directions at least
        first = DIRECTIONS - least + 1
        orders = [np.argsort(spots[cols, d], kind="stable") for d in range(first)]
        out_a, out_b = [], []
        same = rows is cols
        for s in range(0, len(rows), 256):                   # queries in blocks
            q = rows[s:s + 256]
            count = np.zeros(len(q) * n, np.uint8)
            for d in range(first):                            # only what lies in a window is touched
                along = spots[cols, d][orders[d]]
                lo = np.searchsorted(along, spots[q, d] - width, "left")
                inside = np.searchsorted(along, spots[q, d] + width, "right") - lo
                at = np.arange(int(inside.sum())) + np.repeat(lo - (np.cumsum(inside) - inside), inside)
                count[orders[d][at] + np.repeat(np.arange(len(q)) * n, inside)] += 1
            pairs = np.flatnonzero(count)
            count = count[pairs]
            i, j = q[pairs // n], cols[pairs % n]
            if same:
                keep = i < j
                i, j, count = i[keep], j[keep], count[keep]
            for d in range(first, DIRECTIONS):                # what can still collide often enough
                count = count + (np.abs(spots[i, d] - spots[j, d]) <= width)
                keep = count >= least - (DIRECTIONS - 1 - d)
                i, j, count = i[keep], j[keep], count[keep]
            for c in range(0, len(i), 200_000):
                ii, jj = i[c:c + 200_000], j[c:c + 200_000]
                close = np.einsum("ij,ij->i", x[ii], x[jj]) / (norm[ii] * norm[jj]) >= cosine
                out_a.append(ii[close])
                out_b.append(jj[close])
        none = np.zeros(0, np.int64)
        return np.concatenate(out_a or [none]), np.concatenate(out_b or [none])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            tile, side = table.column(0).to_numpy(), table.column(1).to_numpy()
            cid, weight = table.column(2).to_numpy(), table.column(5).to_numpy()
            bounds = group_bounds(tile)
            for s, e in zip(bounds[:-1], bounds[1:]):
                if e - s < 2:
                    continue
                part = table.slice(s, e - s)
                x = _matrix(part.column(4))
                earlier = _matrix(part.column(3))
                sides = side[s:e]
                if (sides == 0).all():
                    every = np.arange(e - s)
                    a, b = pairs_of(x, every, every)
                else:
                    a, b = pairs_of(x, np.flatnonzero(sides == 1), np.flatnonzero(sides == 2))
                if not len(a):
                    continue
                root = _roots(a, b, e - s)
                add = np.zeros(e - s, np.int64)
                w, ids = weight[s:e], cid[s:e]
                # a pair that an earlier table brings together is counted there
                for c in range(0, len(a), 200_000):
                    aa, bb = a[c:c + 200_000], b[c:c + 200_000]
                    first = ~(earlier[aa, :-1] == earlier[bb, :-1]).any(axis=1)
                    np.add.at(add, aa[first], w[bb[first]])
                    np.add.at(add, bb[first], w[aa[first]])
                rows = np.unique(np.concatenate([a, b]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[rows]), pa.array(add[rows]), pa.array(ids[root[rows]])], names=["cid", "added", "root"])

    return run


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                    label: str = "label", cosine: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row."""
    e = F.col(f"`{embedding}`").cast("array<double>")
    usable = F.col(f"`{label}`").isNotNull() & F.col(f"`{vec_id}`").isNotNull() & e.isNotNull() & \
        ~F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(e, lambda x: x != 0)
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), e.alias("embedding"),
                          F.struct(F.col(f"`{label}`").alias("label"), F.size(e).alias("dim")).alias("g"),
                          F.coalesce(usable, F.lit(False)).alias("usable")) \
        .withColumn("grp", F.when(F.col("usable"), F.xxhash64("g"))) \
        .withColumn("cid", F.when(F.col("usable"), F.xxhash64("g", "embedding")))
    members = rows.select("id", "cid")
    classes = rows.where("usable").groupBy("cid", "grp").agg(F.count(F.lit(1)).alias("weight"), F.min("id").alias("first"))
    classes = stored(classes, "vector-classes")
    sizes = classes.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    one = rows.where("usable").select("cid", "id", "embedding") \
        .join(classes.select("cid", F.col("first").alias("id")), ["cid", "id"], "left_semi").dropDuplicates(["cid"])
    full = one.join(classes, "cid").join(sizes, "grp") \
        .select("cid", F.size("embedding").cast("long").alias("dim"), "n", "embedding", "grp", "weight")
    dealt = stored(full.mapInArrow(_dealt(cosine), "cid long, grp long, t int, bucket long, earlier array<long>, "
                                                   "embedding array<double>, weight long"), "vector-buckets")
    size = dealt.groupBy("grp", "t", "bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    tiles = F.ceil(F.col("m") / F.lit(TILE)).cast("int")
    mine, other = F.pmod(F.xxhash64("cid"), tiles).cast("int").alias("mine"), F.explode(F.sequence(F.lit(0), tiles - 1))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    tiled = dealt.join(size, ["grp", "t", "bucket"]).select("*", mine).select("*", other.alias("other")) \
        .select(F.xxhash64("grp", "t", "bucket", low, high).alias("tile"),
                F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2).alias("side"),
                "cid", "earlier", "embedding", "weight")
    found = stored(tiled.repartition("tile").sortWithinPartitions("tile")
                   .mapInArrow(_linked(cosine, least_collisions()), "cid long, added long, root long"), "vector-links")
    counts = found.groupBy("cid").agg(F.sum("added").alias("added"))
    labels = connected_components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    linked = classes.join(labels, F.col("cid") == F.col("id")).select("cid", "component", "first")
    smallest = linked.groupBy("component").agg(F.min("first").alias("component_id"))
    per = classes.join(counts, "cid", "left") \
        .join(linked.select("cid", "component").join(smallest, "component").select("cid", "component_id"), "cid", "left") \
        .select("cid", (F.col("weight") - 1 + F.coalesce("added", F.lit(0))).alias("n_links"),
                F.coalesce("component_id", "first").alias("component_id"))
    out = members.join(per, "cid", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(vec_id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
