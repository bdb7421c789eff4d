"""Secret scanning with an incremental blob ledger.

Every version of every text is addressed by the SHA-256 of its content (its
*blob*).  The ledger is an append-only Parquet table: one row per blob and
run, with the rule versions that were applied and the spans they found.  A
run scans only blob and rule-version pairs the ledger lacks, so a text that
appears under many paths or in many snapshots is scanned once, and a new
version of one rule rescans for that rule alone.  Findings are then joined
back to all rows that hold the blob.

A run appends with one Parquet write, which is committed as a whole; a run
that dies leaves nothing behind that readers take for a finished scan, and
two runs that scan the same pair at the same time do no harm (findings of a
pair are taken from one row).

Null text is scanned as empty text.  Repeated rows share their blob and each
get its findings.  An empty table gives an empty result.  Input columns pass
through; those named like an output are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwood.llm.arrowtext import slices_by_chars
from driftwood.sources.sinks import table_exists

CHARS_AT_A_TIME = 8_000_000


@dataclass(frozen=True)
class Rule:
    """One kind of secret.  ``group`` is the part whose length must reach
    ``least``; shorter matches are dropped after matching."""

    kind: str
    version: int
    pattern: str
    ignore_case: bool = False
    group: int = 0
    least: int = 0

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The rules, in the order in which kinds are listed.
BASE_RULES = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         True, 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]+", False, 0, 16),
    Rule("hex", 1, r"[0-9a-f]+", False, 0, 32),
)
MORE_RULES = (
    Rule("private_key", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", False, 0, 40),
    Rule("vendor", 1, r"(?:gh[pousr]_|xox[abprs]-|sk_live_|glpat-)[A-Za-z0-9_-]+", False, 0, 20),
    Rule("url_login", 1, r"[a-z][a-z0-9+.-]*://[^\s/:@]+:[^\s/:@]+@", False, 0, 10),
)
RULES = BASE_RULES + MORE_RULES

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                     T.StructField("end", T.IntegerType())])
SCAN = T.StructType([T.StructField("blob", T.StringType()), T.StructField("rule", T.StringType()),
                     T.StructField("spans", T.ArrayType(SPAN))])


def compile_rule(rule: Rule) -> re.Pattern:
    # ASCII: only A-Z and a-z count as two cases of a letter
    pattern = rule.pattern
    if rule.kind == "hex" and rule.pattern == r"[0-9a-f]+" and rule.group == 0:
        # a match is a whole run, so asking for its length at once finds the same runs
        pattern = r"[0-9a-f]{%d,}" % rule.least
    return re.compile(pattern, re.ASCII | (re.IGNORECASE if rule.ignore_case else 0))


def find(text: str, rule: Rule, compiled: re.Pattern) -> list[tuple[int, int]]:
    """Spans (code points, end exclusive), leftmost and non-overlapping."""
    return [m.span() for m in compiled.finditer(text)
            if m.end(rule.group) - m.start(rule.group) >= rule.least]


def _scan(todo: DataFrame, rules) -> DataFrame:
    """Rows ``blob``, ``rules`` (keys to apply), ``text`` → rows of the ledger."""
    by_key = {r.key: r for r in rules}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = {k: compile_rule(r) for k, r in by_key.items()}
        span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        seen = set()             # rows that repeat key and text come to one task
        for batch in batches:
            for part in slices_by_chars(batch, 2, CHARS_AT_A_TIME):
                blobs, names, spans = [], [], []
                for blob, keys, text in zip(*(c.to_pylist() for c in part.columns)):
                    if blob in seen:
                        continue
                    seen.add(blob)
                    for key in keys:
                        rule = by_key[key]
                        blobs.append(blob)
                        names.append(key)
                        spans.append([{"kind": rule.kind, "start": s, "end": e}
                                      for s, e in find(text, rule, compiled[key])])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blobs, pa.string()), pa.array(names, pa.string()), pa.array(spans, pa.list_(span))],
                    names=["blob", "rule", "spans"])

    return todo.select("blob", "rules", "text").mapInArrow(run, SCAN)


def blob_of(text: Column) -> Column:
    """The content address of a text."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """One row ``blob, rule, spans`` per scanned pair (empty when there is no ledger yet)."""
    if not table_exists(spark, ledger):
        return spark.createDataFrame([], SCAN)
    return spark.read.schema(SCAN).parquet(ledger)


def update_ledger(versions: DataFrame, ledger: str, key: str, text: str = "text", rules=RULES) -> None:
    """Scan every blob and rule-version pair of ``versions`` the ledger lacks.

    The text of one row per blob is scanned, the one with the smallest
    ``key``: which row that is follows from a count-sized aggregate over the
    digests, so a blob that a third of all rows share costs one partial row
    per task and no text but the chosen one is read twice.
    """
    spark = versions.sparkSession
    t = F.col(f"`{text}`")
    rows = versions.select(blob_of(t).alias("blob"), F.col(f"`{key}`").alias("k"), F.coalesce(t, F.lit("")).alias("text"))
    wanted = F.array(*[F.lit(r.key) for r in rules])
    known = read_ledger(spark, ledger).groupBy("blob").agg(F.collect_set("rule").alias("done"))
    chosen = rows.groupBy("blob").agg(F.min(F.struct("k")).alias("s")).join(known, "blob", "left") \
        .select(F.col("blob").alias("b"), F.col("s.k").alias("bk"),
                F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>"))).alias("rules")) \
        .where(F.size("rules") > 0)
    todo = rows.join(chosen.hint("shuffle_hash"), (F.col("blob") == F.col("b")) & F.col("k").eqNullSafe(F.col("bk")))
    _scan(todo, rules).write.mode("append").parquet(ledger)


def findings(versions: DataFrame, ledger: str, keep, text: str = "text", rules=RULES) -> DataFrame:
    """The columns ``keep`` of every row plus its ``spans`` (array of kind,
    start, end, by start and then by the order of ``rules``)."""
    spark = versions.sparkSession
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    found = read_ledger(spark, ledger).where(F.col("rule").isin([r.key for r in rules]) & (F.size("spans") > 0)) \
        .groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans")) \
        .select(F.col("blob").alias("_dw_b"), F.transform(
            F.array_sort(F.transform("spans", lambda s: F.struct(
                s["start"].alias("start"), F.element_at(order, s["kind"]).alias("o"),
                s["end"].alias("end"), s["kind"].alias("kind")))),
            lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))
    keep = [c for c in keep if c != "spans"]
    rows = versions.select(*[F.col(f"`{c}`") for c in keep],
                           blob_of(F.col(f"`{text}`")).alias("_dw_blob"))
    return rows.join(found, F.col("_dw_blob") == F.col("_dw_b"), "left").select(
        *[F.col(f"`{c}`") for c in keep], F.coalesce("spans", F.array().cast(T.ArrayType(SPAN))).alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(versions: DataFrame, ledger: str, key: str, keep, text: str = "text", rules=RULES) -> DataFrame:
    """Bring the ledger up to date, then the findings of every row."""
    update_ledger(versions, ledger, key, text, rules)
    return findings(versions, ledger, keep, text, rules)
