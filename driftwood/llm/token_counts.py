"""Token counts of a corpus from one exact length histogram.

Every text is encoded once; documents are then aggregated by encoded length.
The histogram has one row per distinct length, so it is far smaller than the
corpus, and its suffix sums answer totals, quantiles and truncated totals
for every context limit without another pass over the texts.

Null text counts as an empty text of 0 tokens; repeated rows count each; an
empty table gives an empty histogram.  Only the text column is read, other
columns are ignored whatever their names are.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from driftwood.llm.arrowtext import slices_by_chars
from driftwood.llm.bpe import CHARS_AT_A_TIME, tokenizer
from driftwood.llm.components import stored

# lengths per block of the two-level suffix sum
BLOCK = 256


def encoded_lengths(docs: DataFrame, rank_path: str, pattern: str, text: str = "text") -> DataFrame:
    """One row ``n_tokens`` per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(rank_path, pattern, "count")
        for batch in batches:
            for part in slices_by_chars(batch, 0, CHARS_AT_A_TIME):
                n = tok.count_tokens([t or "" for t in part.column(0).to_pylist()])
                yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64())], names=["n_tokens"])

    return docs.select(docs[f"`{text}`"].alias("_text")) \
        .mapInArrow(run, T.StructType([T.StructField("n_tokens", T.LongType())]))


def length_histogram(lengths: DataFrame) -> DataFrame:
    """Per distinct ``n_tokens`` the number of documents, with suffix sums.

    ``docs_at_least`` and ``tokens_at_least`` count the documents of that
    length or longer and their tokens; ``truncated_total`` is what remains
    of the corpus when every document is cut after ``n_tokens`` tokens.

    The suffix sums go in two levels: within blocks of ``BLOCK`` lengths,
    and over the block totals.  No task sees the whole histogram.
    """
    # written once: both levels read it, and the texts are encoded once only
    hist = stored(lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))
                  .withColumn("block", F.floor(F.col("n_tokens") / F.lit(BLOCK))), "length-histogram")
    totals = hist.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("t"))
    # one row per block of lengths: at most the longest document / BLOCK
    beyond = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    later = totals.select("block", F.coalesce(F.sum("d").over(beyond), F.lit(0)).alias("d_later"),
                          F.coalesce(F.sum("t").over(beyond), F.lit(0)).alias("t_later"),
                          F.sum("t").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)).alias("t_before"))
    down = Window.partitionBy("block").orderBy(F.col("n_tokens").desc())
    up = Window.partitionBy("block").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    tokens = F.col("n_docs") * F.col("n_tokens")
    return hist.join(later, "block").select(
        "n_tokens", "n_docs",
        (F.sum("n_docs").over(down) + F.col("d_later")).alias("docs_at_least"),
        (F.sum(tokens).over(down) + F.col("t_later")).alias("tokens_at_least"),
        (F.coalesce(F.sum(tokens).over(up), F.lit(0)) + F.coalesce("t_before", F.lit(0))).alias("tokens_below"),
    ).select("n_tokens", "n_docs", "docs_at_least", "tokens_at_least",
             (F.col("tokens_below") + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_total"))


def truncated_totals(hist: DataFrame, limits) -> DataFrame:
    """For each context limit: documents cut, and tokens left of the corpus."""
    out = []
    for limit in limits:
        over = F.col("n_tokens") > F.lit(int(limit))
        out.append(F.struct(
            F.lit(int(limit)).cast("long").alias("context_limit"),
            F.coalesce(F.sum(F.when(over, F.col("n_docs"))), F.lit(0)).alias("docs_cut"),
            F.coalesce(F.sum(F.col("n_docs") * F.least(F.col("n_tokens"), F.lit(int(limit)))), F.lit(0)).alias("tokens_left")))
    return hist.agg(F.array(*out).alias("a")).select(F.inline("a"))


def quantile(hist: DataFrame, q: float) -> DataFrame:
    """The smallest length that at least the share ``q`` of documents does not
    exceed (one row; null for an empty corpus)."""
    n = hist.agg(F.sum("n_docs").alias("n"))
    at_most = F.col("n") - F.col("docs_at_least") + F.col("n_docs")
    return hist.join(F.broadcast(n), F.lit(True)).where(at_most >= F.lit(q) * F.col("n")) \
        .agg(F.min("n_tokens").alias("n_tokens"))
