"""Benchmark decontamination by winnowing.

A benchmark item's *window* is a run of ``WINDOW`` consecutive words (the
whole item, if it is shorter).  A document word inside any occurrence of any
window is *hit*.

Finding the occurrences does not compare every document window: both sides
keep only *fingerprints*, the smallest hash of every ``WINDOW - GRAM + 1``
consecutive word ``GRAM``-grams.  Equal windows have equal hashes, so they
keep the same smallest one: every shared window shares a fingerprint.
Fingerprints are joined; around each joined document position the windows
that contain it are formed and joined with the benchmark's windows as text,
which extends the hit and makes it exact.  Items shorter than ``WINDOW``
words take part with their own length as both gram and window, one length at
a time (at most ``WINDOW - 1`` lengths, only those that occur).

Everything is DataFrame functions.  Hot passages cost what they cover: the
benchmark's windows are distinct before the join, documents are keyed by id
and content, and no pair of documents is ever formed.

Null text has no words; such a document, and one with only empty text, has
no hits.  Null or wordless items have no windows.  Repeated rows (also of
one id) are judged each by its own text.  Item ids are compared as strings;
an item without an id hits like any other, only its id is not in ``items``.
Empty tables give empty or unhit results.  Columns other than id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwood.llm.components import stored
from driftwood.llm.linking import maybe_in

# Words per window, the two cases of A-Z, the ASCII characters
# that separate words (all but digits and letters).
WINDOW = 13
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = "".join(chr(c) for c in range(0x80) if not chr(c).isalnum())

GRAM = 5
# benchmark words up to which its fingerprints and windows are broadcast
# (about 100 bytes per window: 50 MB)
BROADCAST_WORDS = 500_000


def words_of(text: Column) -> Column:
    """Lower-cased words; null has none.  One ``translate`` lowers A-Z and
    turns separators into spaces (no regular expression on the hot path)."""
    spaced = F.translate(F.coalesce(text, F.lit("")), UPPER + SEPARATORS, LOWER + " " * len(SEPARATORS))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    Inside a lambda an expression is evaluated per element; bound to the
    variable of a one-element transform it is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _upto(n: Column) -> Column:
    """0 … n - 1 as an array (empty for n <= 0)."""
    return F.when(n > 0, F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1)).otherwise(F.array().cast("array<int>"))


def gram_hashes(words: Column, k: int) -> Column:
    """Hash of the ``k`` words from each position on (fewer at the end)."""
    return F.transform(words, lambda _, i: F.xxhash64(F.slice(words, i + 1, k)))


def winnow(hashes: Column, w: int) -> Column:
    """The distinct smallest hashes of every ``w`` consecutive ones.

    At the end the windows run short, which adds fingerprints but loses none.
    """
    if w == 1:
        return F.array_distinct(hashes)
    return F.array_distinct(F.transform(hashes, lambda _, i: F.array_min(F.slice(hashes, i + 1, w))))


def fingerprints(text: Column, k: int, w: int) -> Column:
    """Winnowed gram hashes of a text."""
    return let(words_of(text), lambda words: let(gram_hashes(words, k), lambda hashes: winnow(hashes, w)))


def _windows(words: Column, length: int) -> Column:
    return F.transform(_upto(F.size(words) - (length - 1)),
                       lambda i: F.array_join(F.slice(words, i + 1, length), " "))


def covered(spans: Column) -> Column:
    """Positions covered by sorted ``struct(s, e)`` spans (end exclusive)."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    return F.aggregate(
        spans, zero,
        lambda a, x: F.struct(
            (a["n"] + F.greatest(F.lit(0).cast("long"), x["e"] - F.greatest(x["s"], a["upto"]))).alias("n"),
            F.greatest(a["upto"], x["e"]).alias("upto")),
        lambda a: a["n"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  gram: int = GRAM, keep=()) -> DataFrame:
    """Per document: id, ``n_words``, ``n_hit``, ``items`` (sorted strings),
    ``n_items``, ``contaminated`` and the further input columns ``keep``."""
    items = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("item"), F.col(f"`{item_text}`").alias("text")) \
        .withColumn("n", F.size(words_of(F.col("text")))).where("n > 0")
    # one small job over the benchmark: which window lengths occur, and how large it is
    sizes = {r["len"]: r["n"] for r in items.groupBy(F.least("n", F.lit(window)).alias("len"))
             .agg(F.sum("n").alias("n")).collect()}                       # at most ``window`` rows
    small = sum(sizes.values()) <= BROADCAST_WORDS

    def sized(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df

    # identity of a row: its id and its content
    base = docs.select(F.col(f"`{doc_id}`").alias("id"), F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("md"),
                       F.col(f"`{text}`").alias("text"))
    hits = None
    for length in sorted(sizes):
        k, w = (length, 1) if length < window else (min(gram, window), window - min(gram, window) + 1)
        mine = items.where((F.col("n") >= window) if length == window else (F.col("n") == length))
        prints = mine.select(F.explode(fingerprints(F.col("text"), k, w)).alias("print")).distinct()
        texts = mine.select("item", F.explode(let(words_of(F.col("text")), lambda words: F.array_distinct(
            _windows(words, length)))).alias("window"))
        # documents that share a fingerprint, with the shared ones
        shared = stored(base.select("id", "md", F.explode(fingerprints(F.col("text"), k, w)).alias("print"))
                        .join(sized(prints), "print").groupBy("id", "md").agg(F.collect_set("print").alias("prints"))
                        .select(F.col("id").alias("i"), F.col("md").alias("m"), "prints"), "shared-prints")
        # only their texts are shuffled
        found = maybe_in(base, F.col("md"), shared, "m").where("_dw_hit") \
            .join(shared, F.col("id").eqNullSafe(F.col("i")) & (F.col("md") == F.col("m")))
        # windows around every shared fingerprint

        def windows(words: Column) -> Column:
            at = F.filter(_upto(F.size(words) - (k - 1)),
                          lambda i: F.array_contains(F.col("prints"), F.xxhash64(F.slice(words, i + 1, k))))
            starts = F.array_distinct(F.flatten(F.transform(at, lambda p: F.filter(
                F.sequence(p - (length - k), p), lambda s: (s >= 0) & (s <= F.size(words) - length)))))
            return F.transform(starts, lambda s: F.struct(
                s.alias("s"), F.array_join(F.slice(words, s + 1, length), " ").alias("window")))

        around = found.select("id", "md", F.explode(let(words_of(F.col("text")), windows)).alias("w")) \
            .select("id", "md", F.col("w.s").alias("s"), F.col("w.window").alias("window"))
        # a window may be in many items: they are gathered once, not per document (null ids are left out)
        groups = texts.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))
        exact = around.join(sized(groups), "window").select(
            "id", "md", F.struct(F.col("s").cast("long").alias("s"), (F.col("s") + length).cast("long").alias("e")).alias("span"),
            "items")
        hits = exact if hits is None else hits.unionByName(exact)

    added = ("n_words", "n_hit", "n_items", "items", "contaminated")
    outs = [c for c in dict.fromkeys([doc_id, *keep]) if c not in added]
    rows = docs.select(*[F.col(f"`{c}`") for c in outs],
                       F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("_dw_md"),
                       F.size(words_of(F.col(f"`{text}`"))).cast("long").alias("n_words"))
    if hits is None:
        out = rows.withColumn("n_hit", F.lit(0).cast("long")).withColumn("items", F.array().cast("array<string>"))
    else:
        per = hits.groupBy("id", "md").agg(
            covered(F.sort_array(F.collect_set("span"))).alias("n_hit"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")) \
            .select(F.col("id").alias("_dw_i"), F.col("md").alias("_dw_m"), "n_hit", "items")
        out = rows.join(per, F.col(f"`{doc_id}`").eqNullSafe(F.col("_dw_i")) & (F.col("_dw_md") == F.col("_dw_m")), "left") \
            .withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long"))) \
            .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    return out.select(*[F.col(f"`{c}`") for c in outs], "n_words", "n_hit",
                      F.size("items").cast("long").alias("n_items"), "items",
                      ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """The documents (all columns) that are not contaminated."""
    keyed = docs.withColumn("_dw_row", F.xxhash64(F.col(f"`{text}`")))
    gone = stored(decontaminate(keyed, benchmark, doc_id, text, keep=("_dw_row",), **kw).where("contaminated")
                  .select(F.col(f"`{doc_id}`").alias("_dw_i"), F.col("_dw_row").alias("_dw_r")).distinct(), "contaminated")
    keyed = maybe_in(keyed, F.col("_dw_row"), gone, "_dw_r")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    checked = keyed.where("_dw_hit").join(gone, F.col(f"`{doc_id}`").eqNullSafe(F.col("_dw_i")) & (F.col("_dw_row") == F.col("_dw_r")), "left_anti")
    return keyed.where("not _dw_hit").select(*columns).unionByName(checked.select(*columns))
