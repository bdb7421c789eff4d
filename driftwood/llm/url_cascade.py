"""URL filtering: rules first, then exact list membership by a filter cascade.

**Rules** are (host, path prefix) pairs.  A rule fits its host and all its
subdomains when the url's path starts with the rule's path; the longest
fitting rule decides.

**Cascade**: for keys that no rule decides, membership in a list is asked
from a cascade of Bloom filters.  Level 1 encodes the listed keys; the keys
of the corpus that it wrongly admits are encoded by level 2, the listed keys
that level 2 wrongly admits by level 3, and so on until a level admits
nothing wrongly.  Because the false positives are taken over the complete
universe of keys, the answer is exact for every key of it, without a join on
keys.  Each key sets a few bits of a single 64-bit word, so a level is one
grouped ``bit_or``.

A level of up to ``LITERAL_WORDS`` words travels as a binary literal in the
plan (a proven bound, 8 bytes a word); a larger one stays a table of words
that is joined by word number.

All steps are DataFrame functions.  Null keys are never listed.  Null urls,
and urls without ``://``, have empty host and path and fit no rule.
Repeated rows get the same answer; empty tables give empty results; input
columns named like an output are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwood.session import scratch_path

# Verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

LITERAL_WORDS = 1 << 17          # 1 MB
BITS_PER_KEY = 12
BITS_SET = 4

# The two cases of A-Z.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as ``struct(rule, verdict)``, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1], r[2])):
        fits = ((host == F.lit(h)) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


@dataclass
class Level:
    """One Bloom filter: ``words`` 64-bit words, as a literal or as a table."""

    number: int
    words: int
    literal: bytes | None
    table: DataFrame | None


def _hash(key: Column, level: int) -> Column:
    return F.xxhash64(key, F.lit(level))


def _word(key: Column, level: int, words: int) -> Column:
    return F.pmod(_hash(key, level), F.lit(words))


def _mask(key: Column, level: int) -> Column:
    h = F.xxhash64(key, F.lit(level), F.lit("mask"))
    out = None
    for i in range(BITS_SET):
        bit = F.call_function("shiftleft", F.lit(1).cast("long"),
                              F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
        out = bit if out is None else out.bitwiseOR(bit)
    return out


def _build(keys: DataFrame, level: int, n: int, literal_words: int) -> Level:
    words = max(1, -(-n * BITS_PER_KEY // 64))
    table = keys.groupBy(_word(F.col("key"), level, words).alias("word")) \
        .agg(F.bit_or(_mask(F.col("key"), level)).alias("bits"))
    if words > literal_words:
        path = scratch_path(keys.sparkSession, f"cascade-{level}")
        table.write.parquet(path)
        return Level(level, words, None, keys.sparkSession.read.parquet(path))
    data = bytearray(8 * words)
    for r in table.collect():                          # at most literal_words rows
        data[8 * r["word"]:8 * r["word"] + 8] = (r["bits"] & (1 << 64) - 1).to_bytes(8, "big")
    return Level(level, words, bytes(data), None)


def _admits(df: DataFrame, key: str, level: Level, out: str) -> DataFrame:
    """``out``: whether the level admits the key."""
    k, mask = F.col(key), _mask(F.col(key), level.number)
    if level.literal is not None:
        at = (_word(k, level.number, level.words) * 8 + 1).cast("int")
        bits = F.conv(F.hex(F.substring(F.lit(bytearray(level.literal)), at, F.lit(8))), 16, -10).cast("long")
        return df.withColumn(out, bits.bitwiseAND(mask) == mask)
    words = level.table.select(F.col("word").alias("_dw_w"), F.col("bits").alias("_dw_b"))
    return df.join(words, _word(k, level.number, level.words) == F.col("_dw_w"), "left") \
        .withColumn(out, F.coalesce(F.col("_dw_b").bitwiseAND(mask) == mask, F.lit(False))).drop("_dw_w", "_dw_b")


def build_cascade(universe: DataFrame, literal_words: int = LITERAL_WORDS) -> list[Level]:
    """Filters for ``universe``: one row ``key`` (not null), ``listed`` per distinct key."""
    path = scratch_path(universe.sparkSession, "cascade-keys")
    universe.select("key", "listed").write.parquet(path)
    keys = universe.sparkSession.read.parquet(path)
    inside, outside = keys.where("listed").select("key"), keys.where("not listed").select("key")
    levels: list[Level] = []
    n = inside.count()
    while n:
        level = _build(inside, len(levels) + 1, n, literal_words)
        levels.append(level)
        # what the other side gets admitted wrongly is what the next level encodes
        inside, outside = _admits(outside, "key", level, "_in").where("_in").select("key"), inside
        if level.number % 3 == 0:
            path = scratch_path(universe.sparkSession, "cascade-rest")
            inside.write.parquet(path)
            inside = universe.sparkSession.read.parquet(path)
        n = inside.count()
    return levels


def is_listed(df: DataFrame, key: str, levels: list[Level], out: str) -> DataFrame:
    """Add ``out``: exact membership for keys of the universe (null: false).

    The first level that does not admit the key tells: an odd level means
    not listed, an even one listed.  A key all levels admit is listed when
    the number of levels is odd.
    """
    names = [f"_dw_in{level.number}" for level in levels]
    for level, name in zip(levels, names):
        df = _admits(df, key, level, name)
    answer = F.lit(len(levels) % 2 == 1)
    for level, name in reversed(list(zip(levels, names))):
        answer = F.when(F.col(name), answer).otherwise(F.lit(level.number % 2 == 0))
    return df.withColumn(out, F.coalesce(F.when(F.col(key).isNotNull(), answer), F.lit(False))).drop(*names)


def judge(pages: DataFrame, keep, url: str = "url", rules=RULES, literal_words: int = LITERAL_WORDS) -> DataFrame:
    """``keep`` plus ``host``, ``path``, ``rule`` and ``verdict`` of every page.

    Urls that no rule decides are blocked when their host is on the block
    list, and allowed otherwise.  The list holds every host of which a rule
    blocks some page; the cascade is built over all hosts of the pages.
    """
    keep = [c for c in keep if c not in ("host", "path", "rule", "verdict")]
    u = F.col(f"`{url}`")
    parsed = pages.select(*[F.col(f"`{c}`") for c in keep], host_of(u).alias("host"), path_of(u).alias("path")) \
        .withColumn("_dw_rule", rule_of(F.col("host"), F.col("path"), rules))
    universe = pages.select(host_of(u).alias("key"), path_of(u).alias("path")) \
        .withColumn("r", rule_of(F.col("key"), F.col("path"), rules)) \
        .groupBy("key").agg(F.max(F.coalesce(F.col("r.verdict") == "block", F.lit(False))).alias("listed"))
    levels = build_cascade(universe, literal_words)
    return is_listed(parsed, "host", levels, "_dw_listed").select(
        *[F.col(f"`{c}`") for c in keep], "host", "path", F.col("_dw_rule.rule").alias("rule"),
        F.coalesce(F.col("_dw_rule.verdict"), F.when(F.col("_dw_listed"), "block").otherwise("allow")).alias("verdict"))
