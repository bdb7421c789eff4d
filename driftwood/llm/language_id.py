"""Language identification by compression.

Each language has a dictionary: the letters of a bounded sample of its
labelled texts.  A text is compressed once per language with that
dictionary as raw-content zstandard dictionary; the language whose
dictionary makes the text smallest wins, and a narrow margin rejects it.

Only letters are compared (lower case, everything else is one space), so
markup, numbers and secrets do not decide.  Long texts are compressed in
blocks, all of them, so that the dictionary and not the text's own
repetition decides, at the same cost per byte for any length.

Null text, and text without any letter, is ``und`` with score 0 and is
rejected.  Ties go to the first language in alphabetical order and are
rejected.  Repeated rows give repeated results; an empty table gives an
empty result; columns of the input that clash with an output name are
replaced.  Without any labelled row every text is ``und``.
At most ``MOST_LANGUAGES`` labels are learned, those of most rows (ties in
alphabetical order), and all dictionaries together take ``ALL_BYTES`` at most,
so a label column of free text bounds no task's memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from driftwood.llm.arrowtext import slices_by_chars

UNDETERMINED = "und"

# bound of the labelled sample: rows per language, letters taken of each row
SAMPLE_ROWS = 400
SAMPLE_CHARS = 1_000
DICTIONARY_BYTES = 128 << 10
# the dictionaries go to every task: languages learned, and bytes of all together
MOST_LANGUAGES = 500
ALL_BYTES = 16 << 20

# one setting for texts of every length
BLOCK_BYTES = 4096
LEVEL, MIN_MATCH = 6, 3

# a margin below this many bytes, or below this share of the runner-up's size, is narrow
MARGIN_BYTES = 1
MARGIN_SHARE = 0.005

CHARS_AT_A_TIME = 1_000_000

# marks belong to letters: some scripts write vowels with them
_NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")


def letters(text: str) -> str:
    """Lower-cased text in which everything but letters and their marks is one space."""
    return _NOT_LETTERS.sub(" ", text.lower()).strip()


def learn(docs: DataFrame, where: Column, key: Column, text: str = "text", lang: str = "lang",
          rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS, size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Dictionaries per language from the labelled rows that ``where`` admits.

    The sample is the ``rows`` rows per language with the smallest hash of
    ``key``: the same rows however the table is partitioned.  At most
    ``rows * chars`` characters per language reach the driver.
    """
    labelled = docs.where(where & F.col(lang).isNotNull() & F.col(text).isNotNull()) \
        .select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(key).alias("h"))
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.col("n").desc(), "lang").limit(MOST_LANGUAGES).collect()}
    if not counts:
        return {}
    labelled = labelled.where(F.col("lang").isin(list(counts)))
    size = min(size, ALL_BYTES // len(counts))
    # first thin out to about twice the sample by the hash, then rank what is left
    span = 1 << 30
    share = F.create_map(*[F.lit(x) for l, n in counts.items()
                           for x in (l, min(span, int(span * 2 * rows / n) + 1 if n > 4 * rows else span))])
    thin = labelled.where(F.pmod("h", F.lit(span)) < F.element_at(share, F.col("lang")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(span)), "h", "text"))
    sample = thin.withColumn("text", F.substring("text", 1, 2 * chars)) \
        .withColumn("r", rank).where(F.col("r") <= rows).select("lang", "r", "text").collect()
    out: dict[str, bytes] = {}
    for language in sorted(counts):
        got = [letters(r["text"])[:chars] for r in sorted((r for r in sample if r["lang"] == language),
                                                         key=lambda r: r["r"])]
        out[language] = " ".join(g for g in got if g).encode("utf-8", "replace")[:size]
    return {l: d for l, d in out.items() if d}


class Classifier:
    """Compresses a text once per language."""

    def __init__(self, dictionaries: tuple[tuple[str, bytes], ...]):
        def compressor(data: bytes) -> zstandard.ZstdCompressor:
            params = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, min_match=MIN_MATCH, dict_size=len(data), source_size=BLOCK_BYTES, write_content_size=0,
                write_checksum=0, write_dict_id=0)
            own = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            own.precompute_compress(compression_params=params)
            return zstandard.ZstdCompressor(dict_data=own, compression_params=params)

        self.languages = [l for l, _ in dictionaries]
        self.compress = [compressor(d).compress for _, d in dictionaries]

    def classify(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score between 0 and 1, and whether the margin is narrow."""
        plain = letters(text) if text else ""
        if not self.languages or not any(map(str.isalpha, plain)):
            return UNDETERMINED, 0.0, True
        data = plain.encode("utf-8", "replace")
        blocks = [data[i:i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
        sizes = [sum([len(c(b)) for b in blocks]) for c in self.compress]
        best = min(sizes)
        at = sizes.index(best)
        others = sizes[:at] + sizes[at + 1:]
        if not others:
            return self.languages[at], 1.0, False
        margin = min(others) - best
        # how much likelier the winner is if two bytes less are twice as likely
        score = 1.0 / (1.0 + sum(2.0 ** (-min(s - best, 200) / 2) for s in others))
        return self.languages[at], score, margin < MARGIN_BYTES or margin < MARGIN_SHARE * min(others)


@lru_cache(maxsize=2)
def _classifier(dictionaries: tuple[tuple[str, bytes], ...]) -> Classifier:
    return Classifier(dictionaries)


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", keep=None) -> DataFrame:
    """Columns ``keep`` (default: all) plus ``lang_pred``, ``score`` and ``rejected``."""
    added = ["lang_pred", "score", "rejected"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    at = keep.index(text) if text in keep else len(keep)      # a text that is kept anyway travels once
    model = tuple(sorted(dictionaries.items()))
    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("rejected", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = _classifier(model).classify
        for batch in batches:
            for part in slices_by_chars(batch, at, CHARS_AT_A_TIME):
                got = [classify(t) for t in part.column(at).to_pylist()]
                cols = [part.column(i) for i in range(len(keep))] + [
                    pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()),
                    pa.array([g[2] for g in got], pa.bool_())]
                yield pa.RecordBatch.from_arrays(cols, names=keep + added)

    extra = [] if at < len(keep) else [docs[f"`{text}`"].alias("_dw_text")]
    return docs.select(*[docs[f"`{c}`"] for c in keep], *extra).mapInArrow(run, schema)
