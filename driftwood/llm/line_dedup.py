"""Fuzzy line de-duplication by MinHash.

Lines (cut at line feeds, trimmed) are sets of character shingles.  Equal
lines are one class by their digest; distinct lines get MinHash band keys
with high recall, lines that share a key are confirmed by the exact Jaccard
similarity of their shingle sets, and distributed union-find makes
components.  Of each component the first line in the order of document id
and line number stays; the others are removed from their documents.

Trimming removes spaces, tabs and carriage returns; a line of nothing else is
blank and always kept.  A line of fewer than ``SHINGLE`` characters has one
shingle, its whole text, so it repeats only lines equal to it: its class
needs no band keys.  With ``BANDS`` of ``ROWS`` samples a pair at the
similarity of 0.8 is missed with a probability of 1e-5, one at 0.85 with 9e-8.

The samples of a line are the smallest hashes of ``ROWS`` passes that each
deal its shingles out to ``BANDS`` bins.  A set too small for that many bins
has samples over all of it instead.  Which of the two is told by the bins that
the set fills: below ``FULL`` of them it gets samples over all of it, from
``FILLED`` on those of its bins, in between both.  Similar sets fill nearly
the same bins: one below ``FILLED`` cannot well be similar to one from ``FULL``
on (at about 38 shingles, 15 bins would have to be filled by 10 more shingles,
which fill 6 on average).

Line digests have 64 bits, like shingle hashes.  Null text has no lines;
empty text has one empty line.  Rows that repeat both id and text count as
one row, in both places; null ids come first in the order.  Empty tables
give empty results.  The columns of the input are kept, the text without
the removed lines, and ``n_lines`` and ``n_removed`` are added (replacing
columns of these names).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from driftwood.llm import minhash as mh
from driftwood.llm.arrowtext import lists, slices_by_chars
from driftwood.llm.bitmaps import broadcast_bitmap, has
from driftwood.llm.components import stored
from driftwood.llm.linking import PACKED, key_packer, maybe_in, near_components

SHINGLE = 8
PERCENT = 80
BANDS, ROWS = 22, 4
FILLED, FULL = 72, 86                 # of BANDS * ROWS bins
TRIMMED = " \t\r"
_SIGN = 1 << 63
CHARS_AT_A_TIME = 125_000


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _plain(text: str) -> list[str]:
    """The trimmed lines of a text."""
    return [line.strip(TRIMMED) for line in text.split("\n")]


def _digest(line: str) -> int:
    """Signed 64-bit digest of a trimmed line, as Spark's ``xxhash64`` has it."""
    return (xxh64_intdigest(line.encode("utf-8", "surrogatepass"), 42) ^ _SIGN) - _SIGN


def line_digests(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``id, row, digests`` of every text: the digests of its lines, null for
    blank ones (``row``: digest of the text)."""
    def digest(line: Column) -> Column:
        ends = [test(line, F.lit(c)) for c in TRIMMED for test in (F.startswith, F.endswith)]
        plain = F.when(reduce(Column.__or__, ends), F.btrim(line, F.lit(TRIMMED))).otherwise(line)
        return F.when(plain != "", F.xxhash64(plain))

    t = F.col(f"`{text}`")
    return docs.where(t.isNotNull()) \
        .select(F.col(f"`{doc_id}`").alias("id"), F.xxhash64(t).alias("row"), F.transform(_lines(t), digest).alias("digests"))


def _bands(lines: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of ``lines`` and their band keys; together every line once or twice."""
    values, counts = mh.char_shingles(lines, SHINGLE)
    sig = mh.binned_signatures(values, counts, BANDS, ROWS)
    filled = (sig != 0xFFFFFFFF).sum(axis=1)
    wide = np.flatnonzero(filled >= FILLED)
    yield wide, mh.band_keys(sig[wide], BANDS, ROWS, seed=33)
    small = filled < FULL
    yield np.flatnonzero(small), mh.band_keys(mh.signatures(values[np.repeat(small, counts)], counts[small], BANDS * ROWS), BANDS, ROWS)


def _banded(texts: DataFrame, pack=None) -> DataFrame:
    """``cid, bands`` for the lines of rows ``text``, as ``pack`` packs them;
    lines a task has just seen are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in slices_by_chars(batch, 0, CHARS_AT_A_TIME):
                if len(seen) > 200_000:
                    seen.clear()
                lines = {}
                for t in part.column(0).to_pylist():
                    for x in _plain(t):
                        if len(x) >= SHINGLE and (cid := _digest(x)) not in seen:
                            seen.add(cid)
                            lines[cid] = x
                if lines:
                    cids = pa.array(list(lines), pa.int64())
                    for at, keys in _bands(list(lines.values())):
                        if len(at):
                            yield pa.RecordBatch.from_arrays([cids.take(pa.array(at)), lists(keys)], names=["cid", "bands"])

    if pack is None:
        return texts.mapInArrow(run, "cid long, bands array<long>")
    return texts.mapInArrow(lambda batches: pack(run(batches)), PACKED)


def _wanted_lines(texts: DataFrame, wanted) -> DataFrame:
    """``cid, line`` for the lines of rows ``text`` that the bitmap holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(wanted.value, np.uint8)
        for batch in batches:
            for part in slices_by_chars(batch, 0, CHARS_AT_A_TIME):
                lines = {_digest(x): x for t in part.column(0).to_pylist() for x in _plain(t) if len(x) >= SHINGLE}
                if lines:
                    cids = np.array(list(lines), np.int64)
                    held = pa.array(has(bitmap, cids.view(np.uint64)))
                    yield pa.RecordBatch.from_arrays([pa.array(cids).filter(held), pa.array(list(lines.values()), pa.string()).filter(held)],
                                                     names=["cid", "line"])

    return texts.mapInArrow(run, "cid long, line string")


def _unpack(payload: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sets that are kept as their lines, which take an eighth of the shingles' space."""
    return mh.char_shingles(payload.to_pylist(), SHINGLE)


def _sets(lines: DataFrame) -> DataFrame:
    """``cid, n, payload`` for rows ``cid, line``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices_by_chars(batch, 1, CHARS_AT_A_TIME):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(mh.distinct_counts(*_unpack(part.column(1)))), part.column(1)],
                                                 names=["cid", "n", "payload"])

    return lines.mapInArrow(run, "cid long, n long, payload string")


def line_components(docs: DataFrame, text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``id, component`` over the digests of lines that link with another line."""
    texts = docs.select(F.col(f"`{text}`").alias("text")).where(F.col("text").isNotNull())

    def sets_for(cids: DataFrame) -> DataFrame:
        want = stored(cids, "line-wanted")
        mine = _wanted_lines(texts, broadcast_bitmap(want, "cid")).groupBy("cid").agg(F.first("line").alias("line"))
        return _sets(mine.join(want, "cid", "left_semi").select("cid", "line"))

    return near_components(_banded(texts, key_packer(docs.sparkSession)), sets_for, _unpack, percent)


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The documents without the lines that repeat an earlier line."""
    t = F.col(f"`{text}`")
    places = stored(line_digests(docs, doc_id, text), "line-places") \
        .select("id", "row", F.posexplode("digests").alias("no", "cid")).where("cid is not null")
    labels = stored(line_components(docs, text, percent), "line-labels")
    # lines that repeat, or link with another one, and their places
    concerned = stored(places.groupBy("cid").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("cid")
                       .unionByName(labels.select(F.col("id").alias("cid"))).distinct(), "line-concerned")
    hits = stored(maybe_in(places, F.col("cid"), concerned, "cid").where("_dw_hit").drop("_dw_hit").join(concerned, "cid"), "line-hits")
    # the place that stays: per linked component, and per line that only repeats itself
    first = hits.groupBy("cid").agg(F.min(F.struct("id", "no", "row")).alias("first"))
    named = stored(first.join(labels, F.col("cid") == F.col("id"), "left")
                   .select("cid", F.coalesce("component", "cid").alias("component"), "first"), "line-named")
    keeper = named.groupBy("component").agg(F.min("first").alias("keep"))
    keep = named.select("cid", "component").join(keeper, "component").select("cid", "keep")
    gone = stored(hits.join(keep, "cid")
                  .where(~F.struct("id", "no", "row").eqNullSafe(F.col("keep")))
                  .groupBy("id", "row").agg(F.collect_set("no").alias("gone")), "line-gone")
    keyed = docs.withColumn("_dw_row", F.xxhash64(t))
    keyed = maybe_in(keyed, F.col("_dw_row"), gone, "row")
    # the numbers of a partition are looked up, so that whole texts need no sort
    changed = keyed.where("_dw_hit").join(gone.select(F.col("id").alias("_dw_id"), F.col("row").alias("_dw_r"), F.col("gone").alias("_dw_gone")).hint("shuffle_hash"),
                                    F.col(f"`{doc_id}`").eqNullSafe(F.col("_dw_id")) & (F.col("_dw_row") == F.col("_dw_r")), "left")
    lines = F.when(t.isNull(), F.lit(0)).otherwise(F.size(_lines(t))).cast("long")
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    kept = keyed.where("not _dw_hit").select(*[F.col(f"`{c}`") for c in columns], lines.alias("n_lines"),
                                             F.lit(0).cast("long").alias("n_removed"))
    cut = changed.select(*[F.col(f"`{c}`") for c in columns], lines.alias("n_lines"), "_dw_gone")
    schema = T.StructType([*cut.schema.fields[:-1], T.StructField("n_removed", T.LongType())])
    return kept.unionByName(cut.mapInArrow(_without(columns.index(text)), schema))


def _without(at: int):
    """Rows whose last column lists the numbers of the lines to remove from
    the text in column ``at`` → the rows, with the number removed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices_by_chars(batch, at, CHARS_AT_A_TIME):
                texts, removed = part.column(at).to_pylist(), []
                for i, numbers in enumerate(part.column(part.num_columns - 1).to_pylist()):
                    gone = set(numbers or ())
                    if gone:
                        texts[i] = "\n".join([x for no, x in enumerate(texts[i].split("\n")) if no not in gone])
                    removed.append(len(gone))
                columns = list(part.columns)
                columns[at], columns[-1] = pa.array(texts, pa.string()), pa.array(removed, pa.int64())
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names[:-1], "n_removed"])

    return run
