"""Phrase collocations by Toivonen's sampling algorithm.

Per language, the phrases of 2 to ``LONGEST`` words that occur often enough
are scored by how much of their parts' occurrences they account for.  Their
counts come from few passes over the texts:

1. a sample of the pieces of all texts *proposes* phrases: those that reach
   a lowered count there.  The sample decides nothing, it only proposes;
2. one pass over all texts counts every proposed phrase and the *negative
   border*: phrases that were not proposed though both phrases that lack
   their last or first word were.  Border phrases are taken as they occur, so
   the border is never written out (among words, it is all words that were
   not proposed).  Most of the border is rare, so this pass shuffles a hash
   for a phrase.  Phrases of one hash are counted together, which can only add
   to a count: no frequent phrase is missed;
3. a border phrase that turns out frequent is a failure: longer phrases that
   hold it may be frequent, too, and were not counted.  The expansion pass
   counts, by their words, the phrases whose hash was frequent, and every
   phrase that was not counted before and of which both such parts are
   frequent or not counted before either.  A phrase is never more frequent
   than a part of it, so this one pass closes the border on all lengths, and
   its counts are the result.

Sets of phrases reach the tasks as bitmaps of their hashes, at most
``MOST_BITS`` bits whatever the size of the corpus.  A phrase that a bitmap
admits by accident counts as a member: more is counted then, and nothing is
lost.

Within a task words are numbered, phrases are pairs of numbers, and each
slice of texts gives one row per distinct phrase; Spark sums them before and
after the shuffle, so a very frequent phrase is one row per task.

Null text has no words; a null language counts as ``und``.  Rows are not
compared with each other: repeated rows count each.  Ties in the result end
with the phrase itself, so the order is complete.  An empty table gives an
empty result.  Columns other than text and language are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwood.llm import minhash as mh
from driftwood.llm.arrowtext import longs, slices_by_chars, text_bytes
from driftwood.llm.bitmaps import LEAST_BITS, MOST_BITS, broadcast_bitmap, has
from driftwood.llm.components import stored

LONGEST = 4
LEAST = 30
TOP = 2000
CLOSED_PERCENT = 80
NO_LANGUAGE = "und"

# the sample: one piece in SAMPLE_ONE_IN; a phrase that occurs LEAST times in
# as many pieces reaches SAMPLE_LEAST there with a probability of 0.9
SAMPLE_ONE_IN = 8
SAMPLE_LEAST = 2
# text that a task numbers at a time; more where few phrases come out of it
BYTES_AT_A_TIME, FREQUENT_BYTES_AT_A_TIME = 3_000_000, 10_000_000

_BLANK, _BREAK = 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = _BREAK


def _words(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of all texts, the text of each, and the piece of each."""
    raw, offsets = text_bytes(column)
    low = mh._LOWER[raw]
    kind = _KIND[low]
    inside = kind == 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at = offsets[:-1][np.diff(offsets) > 0]
    first[at] = inside[at]
    begin = np.flatnonzero(first)
    text = np.searchsorted(offsets, begin, side="right") - 1
    piece = np.cumsum(kind == _BREAK)[begin] + text
    letters = low[inside]
    cuts = np.append(np.flatnonzero(first[inside]), len(letters)).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(cuts), pa.py_buffer(letters)])
    return words, text, piece


def _hashes(words: pa.Array) -> np.ndarray:
    """64-bit hash of each string."""
    words = words.cast(pa.large_binary())
    n = len(words)
    _, cuts, letters = words.buffers()
    cuts = np.frombuffer(cuts, np.int64)[words.offset:words.offset + n + 1]
    lengths = np.diff(cuts)
    out = np.zeros(n, np.uint64)
    some = lengths > 0
    if some.any():
        raw = np.frombuffer(letters, np.uint8)[cuts[0]:cuts[-1]].astype(np.uint64) + np.uint64(1)
        powers = np.full(int(lengths.max()), mh._WORD_BASE, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        raw *= powers[np.arange(len(raw)) - np.repeat(cuts[:-1] - cuts[0], lengths)]
        out[some] = np.add.reduceat(raw, (cuts[:-1] - cuts[0])[some])
    return mh.mix(out + lengths.astype(np.uint64) * mh._PLACE[63])


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number per value, and a place and the count of each number."""
    ids, values = pd.factorize(codes)
    first = np.empty(len(values), np.int64)
    first[ids[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return ids, first, np.bincount(ids, minlength=len(values))


def _tagged(hashes: np.ndarray, k: int) -> np.ndarray:
    """The low bits of a phrase's hash tell its length."""
    return (hashes & np.uint64(0xFFFFFFFFFFFFFFF8)) | np.uint64(k)


class _Level:
    """The distinct phrases of one length in a slice of texts."""

    def __init__(self, ids: np.ndarray, first: np.ndarray, counts: np.ndarray, hashes: np.ndarray):
        self.ids = ids                    # per place: phrase number, -1 for none
        self.first = first                # per phrase: a place
        self.counts = counts
        self.hashes = hashes
        self.proposed = self.counted = self.open = np.ones(len(first), bool)

    def judge(self, counted: np.ndarray, proposed: np.ndarray | None, frequent: np.ndarray | None) -> None:
        """``counted``: by the first pass; ``open``: longer phrases may follow."""
        self.counted = counted
        if proposed is not None:
            self.open = self.proposed = has(proposed, self.hashes)
        if frequent is not None:
            self.open = has(frequent, self.hashes) | ~counted


def _levels(words: pa.DictionaryArray, piece: np.ndarray, lang: np.ndarray, lang_hash: np.ndarray, longest: int,
            proposed: np.ndarray | None = None, frequent: np.ndarray | None = None) -> Iterator[_Level]:
    """Phrases of one word, two words … of which both parts are ``open``."""
    n = len(words)
    number = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = len(words.dictionary)
    ids, first, counts = _distinct(lang * size + number)
    level = _Level(ids, first, counts, _tagged(mh.mix(_hashes(words.dictionary)[number[first]] + lang_hash[lang[first]]), 1))
    level.judge(np.ones(len(first), bool), proposed, frequent)
    word_ids, word_hashes, distinct = ids, level.hashes, len(first)
    yield level
    for k in range(2, longest + 1):
        if n < k:
            return
        places = np.flatnonzero(piece[:n - k + 1] == piece[k - 1:])
        places = places[(level.ids[places] >= 0) & (level.ids[places + 1] >= 0)]
        places = places[level.open[level.ids[places]] & level.open[level.ids[places + 1]]]
        inverse, first, counts = _distinct(level.ids[places] * distinct + word_ids[places + k - 1])
        ids = np.full(n, -1, np.int64)
        ids[places] = inverse
        first = places[first]
        left, right = level.ids[first], level.ids[first + 1]
        hashes = _tagged(mh.mix(level.hashes[left] * mh._PLACE[k] + word_hashes[word_ids[first + k - 1]]), k)
        both = level.counted & level.proposed
        level = _Level(ids, first, counts, hashes)
        level.judge(both[left] & both[right], proposed, frequent)
        yield level


def _slices(batches: Iterator[pa.RecordBatch], most: int = BYTES_AT_A_TIME):
    """For rows ``text, lang``: numbered words, pieces, languages."""
    for batch in batches:
        for part in slices_by_chars(batch, 0, most):
            words, text, piece = _words(part.column(0))
            if not len(words):
                continue
            langs = part.column(1).dictionary_encode()
            lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[text]
            yield words.dictionary_encode(), piece, lang, langs.dictionary


def _proposals(longest: int):
    """Hashes of all phrases of up to ``longest`` words of the sampled pieces,
    with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, piece, lang, names in _slices(batches):
            seed = mh.mix(np.array([len(words)], np.uint64))
            drawn = mh.mix(piece.astype(np.uint64) + seed) % np.uint64(SAMPLE_ONE_IN) == 0
            if not drawn.any():
                continue
            words, piece, lang = words.filter(pa.array(drawn)), piece[drawn], lang[drawn]
            for level in _levels(words, piece, lang, _hashes(names), longest):
                yield pa.RecordBatch.from_arrays([longs(level.hashes), pa.array(level.counts.astype(np.int64))], names=["h", "n"])

    return run


def _first_counts(proposed, longest: int):
    """Hashes and counts of the proposed phrases and their border."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(proposed.value, np.uint8)
        for words, piece, lang, names in _slices(batches):
            for level in _levels(words, piece, lang, _hashes(names), longest, bitmap):
                yield pa.RecordBatch.from_arrays([longs(level.hashes), pa.array(level.counts.astype(np.int64))], names=["h", "n"])

    return run


def _last_counts(proposed, frequent, longest: int):
    """Counts, by their words, of the phrases whose hash is frequent or was
    not counted before; the number of words has ``k`` = 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps = [np.frombuffer(b.value, np.uint8) for b in (proposed, frequent)]
        columns = ["lang", "phrase", "k", "n"]
        for words, piece, lang, names in _slices(batches, FREQUENT_BYTES_AT_A_TIME):
            spelled = words.dictionary.cast(pa.binary()).cast(pa.string())
            number = words.indices.to_numpy(zero_copy_only=False)
            names_of = names.cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [names_of, pa.array([""] * len(names)), pa.array(np.zeros(len(names), np.int32)),
                 pa.array(np.bincount(lang, minlength=len(names)).astype(np.int64))], names=columns)
            for k, level in enumerate(_levels(words, piece, lang, _hashes(names), longest, *bitmaps), 1):
                at = level.first[level.open]
                if not len(at):
                    continue
                parts = [spelled.take(pa.array(number[at + j])) for j in range(k)]
                yield pa.RecordBatch.from_arrays(
                    [names_of.take(pa.array(lang[at])), parts[0] if k == 1 else pc.binary_join_element_wise(*parts, " "),
                     pa.array(np.full(len(at), k, np.int32)), pa.array(level.counts[level.open].astype(np.int64))], names=columns)

    return run


def _bitmap(phrases: DataFrame):
    return broadcast_bitmap(phrases, "h", LEAST_BITS, MOST_BITS)


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang",
                  least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to ``longest`` words with at least ``least``
    occurrences (``lang, phrase, k, n``), and the words per language
    (``lang, n``)."""
    if not 2 <= longest <= 7:
        raise ValueError("phrases have 2 to 7 words at most")
    rows = docs.select(F.col(f"`{text}`").alias("text"),
                       F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"))
    proposed = stored(rows.mapInArrow(_proposals(longest - 1), "h long, n long")
                      .groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= SAMPLE_LEAST).select("h"), "proposed")
    proposed = _bitmap(proposed)
    # most hashes come once or twice, so they are dealt out without a sum before
    frequent = stored(rows.mapInArrow(_first_counts(proposed, longest), "h long, n long").repartition("h")
                      .groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("h"), "frequent")
    counts = stored(rows.mapInArrow(_last_counts(proposed, _bitmap(frequent), longest), "lang string, phrase string, k int, n long")
                    .groupBy("lang", "phrase").agg(F.max("k").alias("k"), F.sum("n").alias("n"))
                    .where((F.col("n") >= least) | (F.col("k") == 0)), "phrases")
    return counts.where("k > 0").select("lang", "phrase", "k", "n"), counts.where("k = 0").select("lang", "n")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST,
                 longest: int = LONGEST, top: int = TOP, closed_percent: int = CLOSED_PERCENT) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best ``top`` phrases per
    language.

    ``a`` is a phrase's count, ``l`` and ``r`` those of the two parts of its
    lowest-scoring cut (the earliest of equal ones), ``n`` the words of the
    language, ``score`` floor(2,000,000 a / (l + r)).  Left out are phrases
    inside a longer one that has at least ``closed_percent`` % of their count.
    """
    counts, totals = phrase_counts(docs, text, lang, least, longest)
    words = F.split("phrase", " ")
    candidates = counts.where("k >= 2").select("lang", "phrase", "k", F.col("n").alias("a"))
    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))) \
        .withColumn("first", F.array_join(F.slice(words, F.lit(1), F.col("cut")), " ")) \
        .withColumn("rest", F.array_join(F.slice(words, F.col("cut") + 1, F.col("k")), " "))
    part = counts.select(F.col("lang").alias("lang"), F.col("phrase").alias("part"), "n")
    cut = cuts.join(part.withColumnRenamed("part", "first").withColumnRenamed("n", "l"), ["lang", "first"]) \
        .join(part.withColumnRenamed("part", "rest").withColumnRenamed("n", "r"), ["lang", "rest"]) \
        .withColumn("score", F.expr("(cast(2000000 as decimal(38, 0)) * cast(a as decimal(20, 0))) div cast(l + r as decimal(38, 0))"))
    scored = cut.groupBy("lang", "phrase").agg(F.max("k").alias("k"), F.max("a").alias("a"),
                                               F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    # the highest count of a longer candidate around each phrase
    around = candidates.where("k > 2") \
        .withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1))) \
        .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1))) \
        .groupBy("lang", F.array_join(F.slice(words, F.col("at"), F.col("size")), " ").alias("phrase")) \
        .agg(F.max("a").alias("longer"))
    kept = scored.join(around, ["lang", "phrase"], "left") \
        .where(F.col("longer").isNull() | (100 * F.col("longer") < closed_percent * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.col("best.score").desc(), F.col("a").desc(), F.col("phrase").asc())
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    sums = totals.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(sums, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("best.l").alias("l"),
        F.col("best.r").alias("r"), "n", F.col("best.score").cast("long").alias("score"))
