"""Hard-negative mining by inner products, with LEMP-style pruning.

For every anchor its positives are the best-scoring other rows of its label,
and for every positive the negatives are the best-scoring rows of other
labels within a band of the positive's score.  Scores are inner products of
integer vectors, so they are exact and ties are real.

Both are searches of a stated set of anchors against all rows.  Rows are
dealt into tiles of at most about ``TILE`` and anchors into blocks of about
``BLOCK``; every block meets every tile in one task, in which

- the rows are cut into *length buckets*, longest first.  A bucket whose
  longest vector cannot reach what an anchor still asks for is skipped, and
  so are all after it;
- a bucket holds a *sorted list per coordinate* of its directions.  For the
  ``FOCUS`` largest coordinates of an anchor, the angle it still allows gives
  a *feasible range* of values; the candidates are the rows inside all of
  these ranges.  Where even the narrowest range holds most of the bucket, the
  ranges say nothing and the whole bucket is taken;
- candidates are *verified* by their exact inner product.  What an anchor
  asks for rises with the best scores found so far.

A task returns at most as many rows per anchor and band as the result can
hold, and Spark ranks those of all tasks.

Equal vectors of one label are one class from the start: a class carries its
smallest ids only, since no more of them can appear in a result, so a vector
that a third of all rows share is one row of the search.

No part take rows with a null id, label or vector, an empty vector, or one
with a null, NaN or infinite component, or whose scores might not fit:
``length * (largest component) ** 2`` of at least 2**55 after scaling.
Vectors of different lengths are not compared.  Rows that repeat an id count each: a repeated
anchor is answered each time, and its copies are rows like others.  Ties go
to the smaller id.  A positive whose band is empty (its score is negative)
gets no negatives.  An empty table gives an empty result.  Columns other than
id, vector and label are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwood.llm.arrowtext import group_bounds, whole_groups
from driftwood.llm.components import stored

POSITIVES = 5
NEGATIVES = 3
LOW_PERCENT, HIGH_PERCENT = 50, 95
SCALE = 256

TILE, BLOCK = 8192, 4096
BUCKET = 1024
FOCUS = 5
# the narrowest range must hold less than this part of a bucket to be used
NARROW = 0.5
_SLACK = 1e-9
_LOWEST, _HIGHEST = -(1 << 62), 1 << 62


def _matrix(column, rows: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(rows, -1) if rows else flat.reshape(0, 1)


class _Bucket:
    """Rows of similar length with a sorted list per coordinate."""

    def __init__(self, x: np.ndarray, length: np.ndarray, exact: bool):
        self.x = x.astype(np.float64) if exact else x
        self.longest = float(length[0])
        safe = np.where(length > 0, length, 1.0)
        self.unit = x / safe[:, None]
        self.order = np.argsort(self.unit, axis=0, kind="stable")
        self.values = np.take_along_axis(self.unit, self.order, axis=0)

    def candidates(self, unit: np.ndarray, focus: np.ndarray, cosine: float):
        """Rows whose focus coordinates allow the cosine; None for all rows."""
        n = len(self.unit)
        wide = np.arccos(min(1.0, cosine))
        own = np.arccos(np.clip(unit[focus], -1.0, 1.0))
        low = np.cos(np.minimum(np.pi, own + wide)) - _SLACK
        high = np.cos(np.maximum(0.0, own - wide)) + _SLACK
        spans = [(np.searchsorted(self.values[:, f], lo, "left"), np.searchsorted(self.values[:, f], hi, "right"))
                 for f, lo, hi in zip(focus, low, high)]
        best = min(range(len(spans)), key=lambda i: spans[i][1] - spans[i][0])
        lo, hi = spans[best]
        if hi - lo > NARROW * n:
            return None
        rows = self.order[lo:hi, focus[best]]
        for i, f in enumerate(focus):
            if i != best and len(rows):
                value = self.unit[rows, f]
                rows = rows[(value >= low[i]) & (value <= high[i])]
        return rows


class _Band:
    """The best rows so far whose scores lie in a band."""

    __slots__ = ("low", "high", "need", "scores", "rows")

    def __init__(self, low: int, high: int):
        self.low = self.need = low
        self.high = high
        self.scores = np.zeros(0, np.int64)
        self.rows = np.zeros(0, np.int64)

    def offer(self, scores: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> None:
        good = np.flatnonzero((scores >= self.need) & (scores <= self.high))
        if not len(good):
            return
        if len(good) > 4 * k:                     # only what can be among the best, ties included
            least = np.partition(scores[good], len(good) - k)[len(good) - k]
            good = good[scores[good] >= least]
        s, r = np.concatenate([self.scores, scores[good]]), np.concatenate([self.rows, rows[good]])
        order = np.lexsort((ids[r], -s))[:k]
        self.scores, self.rows = s[order], r[order]
        if len(s) >= k:
            self.need = max(self.low, int(self.scores[-1]))


def _search(k: int, other_labels: bool):
    """Rows ``tile, anchor, cid, grp, q, ids, lows, highs`` of which those with
    ``anchor`` ask and the others are searched → ``cid`` of the anchor, the
    band, and the best ``k`` classes in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            tile = table.column(0).to_numpy()
            bounds = group_bounds(tile)
            for s, e in zip(bounds[:-1], bounds[1:]):
                part = table.slice(s, e - s)
                dims = pc.list_value_length(part.column(4)).to_numpy()
                asks = part.column(1).to_numpy()
                for dim in np.unique(dims[asks]):
                    found = _answer(part.filter(pa.array(asks & (dims == dim))), part.filter(pa.array(~asks & (dims == dim))),
                                    k, other_labels)
                    if found is not None:
                        yield found

    return run


def _answer(anchors: pa.Table, rows: pa.Table, k: int, other_labels: bool) -> pa.RecordBatch | None:
    if not anchors.num_rows or not rows.num_rows:
        return None
    x, q = _matrix(rows.column(4), rows.num_rows), _matrix(anchors.column(4), anchors.num_rows)
    cid, grp = rows.column(2).to_numpy(), rows.column(3).to_numpy()
    ids = rows.column(5).combine_chunks()
    smallest = ids.flatten().to_numpy()[ids.offsets.to_numpy()[:-1] - ids.offsets[0].as_py()]
    mine = anchors.column(3).to_numpy()
    # sums of doubles are exact up to 2**53
    dim = max(1, x.shape[1])
    exact = dim * float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) < 2.0 ** 53
    length = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
    by_length = np.argsort(-length, kind="stable")
    x, cid, grp, smallest, length = x[by_length], cid[by_length], grp[by_length], smallest[by_length], length[by_length]
    sought = q.astype(np.float64) if exact else q
    own = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
    unit = q / np.where(own > 0, own, 1.0)[:, None]
    focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
    lows, highs = anchors.column(6).to_pylist(), anchors.column(7).to_pylist()
    bands = [[_Band(a, b) for a, b in zip(lo, hi)] for lo, hi in zip(lows, highs)]

    for start in range(0, len(x), BUCKET):
        here = slice(start, start + BUCKET)
        bucket, places = _Bucket(x[here], length[here], exact), np.arange(start, min(start + BUCKET, len(x)))
        whole = []
        for a, asked in enumerate(bands):
            need = min(b.need for b in asked)
            reach = own[a] * bucket.longest
            if need <= 0:
                whole.append(a)
                continue
            if need > reach * (1 + _SLACK):
                continue
            found = bucket.candidates(unit[a], focus[a], need / reach - _SLACK)
            if found is None:
                whole.append(a)
            elif len(found):
                scores = (bucket.x[found] @ sought[a]).astype(np.int64)
                _offer(asked, scores, places[found], grp, smallest, mine[a], k, other_labels)
        for block in range(0, len(whole), 512):
            some = whole[block:block + 512]
            scores = (bucket.x @ sought[some].T).astype(np.int64)
            for i, a in enumerate(some):
                _offer(bands[a], scores[:, i], places, grp, smallest, mine[a], k, other_labels)

    which = [(a, b) for a, asked in enumerate(bands) for b in asked if len(b.rows)]
    if not which:
        return None
    sizes = np.array([len(b.rows) for _, b in which])
    took = np.concatenate([b.rows for _, b in which])
    return pa.RecordBatch.from_arrays([
        pa.array(np.repeat(anchors.column(2).to_numpy()[[a for a, _ in which]], sizes)),
        pa.array(np.repeat(np.array([b.low for _, b in which], np.int64), sizes)),
        pa.array(np.repeat(np.array([b.high for _, b in which], np.int64), sizes)),
        pa.array(np.concatenate([b.scores for _, b in which])),
        pa.array(cid[took]), ids.take(pa.array(by_length[took]))], names=["asked", "low", "high", "score", "cid", "ids"])


def _offer(asked: list[_Band], scores, places, grp, smallest, own_group, k: int, other_labels: bool) -> None:
    need = min(b.need for b in asked)
    good = scores >= need
    if other_labels:
        good &= grp[places] != own_group
    good = np.flatnonzero(good)
    if len(good):
        for band in asked:
            band.offer(scores[good], places[good], smallest, k)


_FOUND = "asked long, low long, high long, score long, cid long, ids array<long>"


def _tiles(n: Column, size: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(n / F.lit(size))).cast("int")


def _met(anchors: DataFrame, rows: DataFrame, by: str | None) -> DataFrame:
    """Every block of anchors together with every tile of rows (per value of
    ``by``, or of all), as rows of one sorted partition per such pair."""
    if by is None:
        n, n_asked = F.lit(rows.count()), F.lit(anchors.count())
        searched, asking, group = rows, anchors, F.lit(0)
    else:
        sizes = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n")) \
            .join(anchors.groupBy(by).agg(F.count(F.lit(1)).alias("n_asked")), by)
        searched, asking, group = rows.join(sizes, by), anchors.join(sizes, by), F.col(by)
        n, n_asked = F.col("n"), F.col("n_asked")
    tiles, blocks = (F.greatest(F.lit(1), F.ceil(m / F.lit(size))).cast("int") for m, size in ((n, TILE), (n_asked, BLOCK)))
    tile, block = F.pmod(F.xxhash64("cid", F.lit(3)), tiles), F.pmod(F.xxhash64("cid", F.lit(5)), blocks)
    none = F.array().cast("array<long>")
    columns = ["cid", "grp", "q"]
    searched = searched.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))) \
        .select(F.xxhash64(group, tile.cast("long"), F.col("other")).alias("tile"), F.lit(False).alias("anchor"), *columns, "ids",
                none.alias("lows"), none.alias("highs"))
    asks = asking.withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1))) \
        .select(F.xxhash64(group, F.col("other").cast("long"), block.cast("int")).alias("tile"), F.lit(True).alias("anchor"),
                *columns, none.alias("ids"), "lows", "highs")
    return searched.unionByName(asks).repartition("tile").sortWithinPartitions("tile")


def _best(found: DataFrame, k: int) -> DataFrame:
    """Per anchor class and band the first ``k`` rows: ``asked, low, high, best``
    (sorted structs of negated score, id, cid)."""
    order = Window.partitionBy("asked", "low", "high").orderBy(F.col("score").desc(), "id", "cid")
    return found.withColumn("id", F.explode("ids")).withColumn("place", F.row_number().over(order)) \
        .where(F.col("place") <= k).groupBy("asked", "low", "high") \
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("down"), "id", "cid"))).alias("best"))


def hard_negatives(vectors: DataFrame, anchor: Column, vec_id: str = "vec_id", embedding: str = "embedding",
                   label: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low_percent: int = LOW_PERCENT, high_percent: int = HIGH_PERCENT, scale: int = SCALE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``: for each row for which ``anchor`` holds, and each of its
    ``positives``, the first ``negatives`` rows of other labels with
    ``low_percent * positive <= 100 * negative <= high_percent * positive``.
    Components are scaled by ``scale`` and rounded down.
    """
    e = F.col(f"`{embedding}`").cast("array<double>")
    scaled = F.transform(e, lambda x: F.floor(x * scale))
    largest = F.coalesce(F.array_max(F.transform(e, lambda x: F.abs(x))) * scale + 1, F.lit(0.0))
    usable = F.col(f"`{label}`").isNotNull() & F.col(f"`{vec_id}`").isNotNull() & e.isNotNull() & \
        ~F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & \
        (F.size(e) > 0) & (F.size(e) * largest * largest < 2.0 ** 55)
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.coalesce(anchor, F.lit(False)).alias("asks"),
                          F.when(usable, scaled).alias("q"),
                          F.xxhash64(F.col(f"`{label}`").cast("string"), F.size(e)).alias("grp"),
                          F.size(e).cast("long").alias("dim")).where("q is not null")
    # a class: equal vectors of one label, with the smallest ids that a result may hold
    most = max(positives + 1, negatives)
    cls = ["grp", "dim", "q"]
    order = Window.partitionBy(*cls).orderBy("id")
    classes = rows.withColumn("no", F.row_number().over(order)).where(F.col("no") <= most) \
        .groupBy(*cls).agg(F.sort_array(F.collect_list("id")).alias("ids")) \
        .withColumn("cid", F.monotonically_increasing_id())
    classes = stored(classes, "negative-classes")            # written, so that its numbers stay
    asking = stored(rows.where("asks").select("id", *cls).join(classes.select("cid", *cls), cls)
                    .select("id", "cid"), "negative-anchors")
    asked = classes.join(asking.select("cid").distinct(), "cid", "left_semi")

    everything = [F.array(F.lit(_LOWEST)).alias("lows"), F.array(F.lit(_HIGHEST)).alias("highs")]
    same = _met(asked.select("cid", "grp", "q", *everything), classes, "grp") \
        .mapInArrow(_search(positives + 1, other_labels=False), _FOUND)
    nearest = _best(same, positives + 1)
    # an anchor is not its own positive: one row of its id and class is left out
    norm = F.aggregate("q", F.lit(0).cast("long"), lambda n, v: n + v * v)
    itself = F.array_position("best", F.struct((-F.col("self")).alias("down"), "id", "cid"))
    others = asking.join(asked.select("cid", norm.alias("self")), "cid") \
        .join(nearest.select(F.col("asked").alias("cid"), "best"), "cid").withColumn("at", itself) \
        .withColumn("best", F.slice(F.filter("best", lambda _, i: i + 1 != F.col("at")), 1, positives)) \
        .select(F.col("id").alias("anchor_id"), F.col("cid").alias("asked"), F.explode("best").alias("p")) \
        .select("anchor_id", "asked", F.col("p.id").alias("positive_id"), (-F.col("p.down")).alias("positive_score"))
    low, high = F.lit(low_percent) * -F.col("positive_score"), F.lit(high_percent) * F.col("positive_score")
    others = stored(others.withColumn("x", low).withColumn("y", high)
                    .withColumn("low", F.expr("-((x - pmod(x, 100)) div 100)"))
                    .withColumn("high", F.expr("(y - pmod(y, 100)) div 100")).drop("x", "y"), "negative-positives")
    bands = others.where("low <= high").groupBy("asked") \
        .agg(F.collect_set(F.struct("low", "high")).alias("b")) \
        .select(F.col("asked").alias("cid"), F.col("b.low").alias("lows"), F.col("b.high").alias("highs"))
    different = _met(asked.join(bands, "cid").select("cid", "grp", "q", "lows", "highs"), classes, None) \
        .mapInArrow(_search(negatives, other_labels=True), _FOUND)
    return others.join(_best(different, negatives), ["asked", "low", "high"]) \
        .select("anchor_id", "positive_id", "positive_score", F.posexplode("best").alias("rank", "x")) \
        .select("anchor_id", "positive_id", (F.col("rank") + 1).cast("int").alias("rank"),
                F.col("x.id").alias("negative_id"), "positive_score", (-F.col("x.down")).alias("negative_score"))
