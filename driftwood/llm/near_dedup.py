"""Near-duplicate documents by MinHash with odd sketches.

A document is the set of its distinct word shingles.  MinHash samples of the
set make band keys (candidates share one) and are folded into an *odd
sketch*: each sample flips one bit, so equal samples cancel in the XOR of two
sketches and its population count tells how many samples differ.  Candidates
whose count allows the similarity are confirmed on the full sets; the links
make components, and the smallest id of each stays.

Documents with equal sets are one class from the start, however many there
are, and the work within a bucket is bounded as described in
:mod:`driftwood.llm.linking`.  With the default ``BANDS`` of ``ROWS``
samples a pair at the similarity of 0.8 is missed with a probability of
7e-6, a closer one more rarely.

Null text and text without words have an empty set: size 0, linked with
nothing, own component, kept.  In the digest a row with a null id is linked
with nothing, has a null component and is kept (dropping takes it into the
groups).  Rows that repeat an id are each judged by
their own text.  An empty table gives an empty result.  Further columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwood.llm import minhash as mh
from driftwood.llm.arrowtext import lists, longs, slices_by_chars, text_bytes
from driftwood.llm.components import stored
from driftwood.llm.linking import PACKED, key_packer, maybe_in, near_components

SHINGLE = 5
PERCENT = 80
BANDS, ROWS = 30, 5
# samples folded into the sketch of a candidate, and its 64-bit words: precise
# enough to refuse most pairs below 0.74 without their sets
SKETCH_SAMPLES, SKETCH_WORDS = 2048, 32
BYTES_AT_A_TIME = 1_500_000


def _shingles(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    raw, offsets = text_bytes(column)
    words, counts = mh.word_hashes(raw, offsets)
    return mh.sequence_hashes(words, counts, k)


def _shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    return mh.distinct_sets(*_shingles(column, k))


def describe(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """``id, row, n, h1, h2, bands`` per document (``row``: digest of the text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices_by_chars(batch, 2, BYTES_AT_A_TIME):
                values, counts = _shingle_sets(part.column(2), shingle)
                h1, h2 = mh.set_digests(values, counts)
                sig = mh.signatures(values, counts, BANDS * ROWS)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(counts), longs(h1), longs(h2),
                     lists(mh.band_keys(sig, BANDS, ROWS))], names=["id", "row", "n", "h1", "h2", "bands"])

    t = F.col(f"`{text}`")
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.xxhash64(t).alias("row"), t.alias("text")) \
        .mapInArrow(run, "id long, row long, n long, h1 long, h2 long, bands array<long>")


def _unpack(shingle: int):
    """Sets that are kept as their texts, which shuffle as a third of the hashes' bytes."""

    def sets(payload: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return _shingles(payload, shingle)

    return sets


def _sets(docs: DataFrame, shingle: int) -> DataFrame:
    """``id, n, h1, h2, sketch, payload`` for rows ``id, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices_by_chars(batch, 1, BYTES_AT_A_TIME):
                values, counts = _shingle_sets(part.column(1), shingle)
                h1, h2 = mh.set_digests(values, counts)
                sketch = mh.odd_sketches(mh.signatures(values, counts, SKETCH_SAMPLES), SKETCH_WORDS)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts), longs(h1), longs(h2), lists(sketch), part.column(1)],
                    names=["id", "n", "h1", "h2", "sketch", "payload"])

    return docs.mapInArrow(run, "id long, n long, h1 long, h2 long, sketch array<long>, payload string")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``,
    and ``row``, the ``xxhash64`` of its text (which tells repeated ids apart)."""
    rows = stored(describe(docs, doc_id, text, shingle), "near-docs")
    # a class is known by its digests (ids may be repeated with other texts)
    node = F.xxhash64("h1", "h2", "n")
    named = rows.where("n > 0 and id is not null").withColumn("cid", node)
    classes = stored(named.groupBy("cid").agg(F.min("id").alias("id")), "near-classes")
    first = named.join(classes, ["cid", "id"], "left_semi") \
        .select("cid", "bands").mapInArrow(key_packer(docs.sparkSession), PACKED)

    def sets_for(cids: DataFrame) -> DataFrame:
        want = stored(classes.join(cids, "cid", "left_semi"), "near-wanted")
        mine = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
        mine = maybe_in(mine, F.col("id"), want, "id").where("_dw_hit").join(want.select("id"), "id", "left_semi") \
            .select("id", "text")
        return _sets(mine, shingle).withColumn("cid", node).join(want, ["cid", "id"], "left_semi") \
            .dropDuplicates(["cid"]).select("cid", "n", "sketch", "payload")

    labels = near_components(first, sets_for, _unpack(shingle), percent, mh.most_odd_bits(SKETCH_SAMPLES, SKETCH_WORDS, percent / 100),
                             SKETCH_WORDS)
    linked = classes.join(labels.withColumnRenamed("id", "node"), F.col("cid") == F.col("node"))
    smallest = linked.groupBy("component").agg(F.min("id").alias("component_id"))
    grouped = linked.select("cid", "component").join(smallest, "component").select("cid", "component_id")
    alone = classes.join(grouped.select("cid"), "cid", "left_anti").select("cid", F.col("id").alias("component_id"))
    out = rows.select("id", "row", "n", node.alias("cid")) \
        .join(grouped.unionByName(alone), "cid", "left")
    mine = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), mine.alias("component_id"),
                      F.coalesce(F.col("id") == mine, F.lit(True)).alias("kept"), "row")


# ids of rows without one, while groups are sought: beyond these
_NO_ID = 1 << 62


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                         percent: int = PERCENT) -> DataFrame:
    """The documents (all columns) of which one of each group is left: the one
    with the smallest id, one without an id only if none has one.  Of rows that
    repeat id and text one stays.  Ids are below 2**62."""
    digest = F.xxhash64(F.col(f"`{text}`"))
    key = F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_NO_ID) + F.pmod(digest, F.lit(_NO_ID - 1)))
    keyed = docs.withColumn("_dw_id", key).withColumn("_dw_row", digest)
    judged = near_duplicates(keyed, "_dw_id", text, shingle, percent)
    gone = stored(judged.groupBy(F.col("_dw_id").alias("_dw_i"), F.col("row").alias("_dw_r"))
                  .agg(F.min("kept").alias("_dw_kept"), F.count(F.lit(1)).alias("m"))
                  .where("not _dw_kept or m > 1").drop("m"), "near-gone")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = maybe_in(keyed, F.col("_dw_row"), gone, "_dw_r")
    left = keyed.where("_dw_hit").join(gone, (F.col("_dw_id") == F.col("_dw_i")) & (F.col("_dw_row") == F.col("_dw_r")), "left")
    rest = left.where("_dw_kept is null").select(*columns)
    once = left.where("_dw_kept").dropDuplicates(["_dw_i", "_dw_r"]).select(*columns)
    return keyed.where("not _dw_hit").select(*columns).unionByName(rest).unionByName(once)
