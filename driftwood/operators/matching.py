"""Lookup joins and fuzzy reconciliation of names.

The fuzzy join never forms a cross product.  Names become token sets; two
names with Jaccard similarity ``>= t > 0`` must share a token, and — under
one global token order (rarest first) — they even share a token inside the
first ``|x| - ceil(t·|x|) + 1`` tokens of each set (the prefix filter of
set-similarity joins).  Candidates are produced by an equi-join on prefix
tokens only; frequent tokens (stop words) sort last and so rarely reach a
prefix, and the few that do are salted across tasks.  Two more bounds refuse
candidates before any token set is looked at: the sizes of two similar sets
are close (length filter), and what can still be common behind the last
common prefix token must be enough (positional filter).  Only names, sizes
and positions travel with candidates; token sets are joined to what is left,
and the exact similarity is checked there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwood.functions.text import jaccard_of_sets, tokens

# Largest lookup that is broadcast, in bytes by Spark's own statistics; files
# are compressed, so that is up to 80 MB in memory.  Larger ones are shuffled.
DEFAULT_BROADCAST_BYTES = 8 << 20
# Token frequency above which the candidate join salts the token.
DEFAULT_HOT_TOKEN_ROWS = 10_000


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# operators whose size Spark can put no upper bound to
_UNBOUNDED = ("Generate", "Join", "Expand", "Arrow", "Pandas", "Python")


def bounded_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only for a side that is small by what Spark already
    knows of it: the optimized plan's size, for plans that cannot grow beyond
    their inputs (scans, filters, projections, aggregates).

    No job runs.  Every other side is returned without a hint: adaptive
    execution measures its finished shuffle and broadcasts it if it is small.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    text = plan.toString()
    if any(name in text for name in _UNBOUNDED):
        return df
    small = int(str(plan.stats().sizeInBytes())) <= max_bytes
    return F.broadcast(df) if small else df


# ---------------------------------------------------------- D1, D2, D7 --

def lookup_join(df: DataFrame, lookup: DataFrame, left_on: str, right_on: str,
                how: str = "left") -> DataFrame:
    """Left equi-join to a lookup table (D1); also the dictionary lookup."""
    lk = bounded_broadcast(lookup)
    return df.join(lk, F.col(_q(left_on)) == lk[_q(right_on)], how)


def lookup_fallback(df: DataFrame, on: str, lookups, out_col: str) -> DataFrame:
    """Resolve ``out_col`` through a list of lookups, first non-null wins.

    ``lookups`` is a list of ``(lookup_df, key_column, id_column)``.  Each
    lookup is made unique per key first, so a lookup can never fan out rows.
    """
    result = df
    ids = []
    for i, (lk, key, id_col) in enumerate(lookups):
        small = (lk.select(F.col(_q(key)).alias(f"_k{i}"), F.col(_q(id_col)).alias(f"_id{i}"))
                 .where(F.col(f"_k{i}").isNotNull())
                 .groupBy(f"_k{i}").agg(F.min(f"_id{i}").alias(f"_id{i}")))
        small = bounded_broadcast(small)
        result = result.join(small, F.col(_q(on)) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
        ids.append(F.col(f"_id{i}"))
    return result.withColumn(out_col, F.coalesce(*ids)).drop(*[f"_id{i}" for i in range(len(lookups))])


# ------------------------------------------------------------------ D3 --

def _prefix_length(n: Column, threshold: float) -> Column:
    # a tiny slack keeps ceil() from rounding up on products like 0.3 * 10
    return n - F.ceil(n * F.lit(threshold) - F.lit(1e-9)) + F.lit(1)


def _token_sets(names: DataFrame, name_col: str, freq: DataFrame) -> DataFrame:
    """Per name its tokens as ``struct(freq, token)``, rarest first."""
    exploded = names.select(F.col(name_col), F.explode(tokens(name_col)).alias("token"))
    ranked = exploded.join(freq, "token")
    return ranked.groupBy(name_col).agg(F.sort_array(F.collect_list(F.struct("freq", "token"))).alias("ordered"))


def _fits(size: Column, other: Column, threshold: float) -> Column:
    """Length filter: the smaller set is at least ``threshold`` of the larger."""
    return F.least(size, other) >= F.greatest(size, other) * F.lit(threshold) - F.lit(1e-9)


def _least_common(size: Column, other: Column, threshold: float) -> Column:
    """Common tokens that sets of these sizes need for the threshold."""
    return F.ceil((size + other) * F.lit(threshold / (1 + threshold)) - F.lit(1e-9))


def _sets_and_candidates(left_names: DataFrame, right_names: DataFrame, threshold: float, hot_token_rows: int,
                         bounds: bool = True):
    if threshold <= 0:
        raise ValueError("threshold must be > 0: at 0 every pair matches, "
                         "which is a cross product by definition")
    left = left_names.where(F.col("l_name").isNotNull()).distinct()
    right = right_names.where(F.col("r_name").isNotNull()).distinct()
    # global token order: document frequency over both name sets
    freq = (left.select(F.explode(tokens("l_name")).alias("token"))
            .unionByName(right.select(F.explode(tokens("r_name")).alias("token")))
            .groupBy("token").agg(F.count(F.lit(1)).alias("freq")))
    lsets, rsets = _token_sets(left, "l_name", freq), _token_sets(right, "r_name", freq)

    # salt hot prefix tokens: a left row goes to one salt, a right row to all;
    # one salt per ``hot_token_rows`` names holding the token
    def salt_count(p: Column) -> Column:
        return F.ceil(p["freq"] / F.lit(hot_token_rows)).cast("int")

    def prefixes(sets: DataFrame, name: str, size: str, place: str) -> DataFrame:
        n = F.size("ordered")
        return sets.select(name, n.alias(size), F.posexplode(F.slice("ordered", 1, _prefix_length(n, threshold))).alias(place, "p"))

    lp = prefixes(lsets, "l_name", "l_size", "l_at") \
        .withColumn("salt", F.pmod(F.xxhash64("l_name"), salt_count(F.col("p"))))
    rp = prefixes(rsets, "r_name", "r_size", "r_at") \
        .withColumn("salt", F.explode(F.sequence(F.lit(0), salt_count(F.col("p")) - 1)))
    met = lp.join(rp, ["p", "salt"])
    l_size, r_size = F.col("l_size"), F.col("r_size")
    if bounds:
        met = met.where(_fits(l_size, r_size, threshold))
    # a row per pair: the prefix tokens it shares, and the last of them
    pairs = met.groupBy("l_name", "r_name").agg(F.max("l_size").alias("l_size"), F.max("r_size").alias("r_size"),
                                                F.count(F.lit(1)).alias("common"), F.max("l_at").alias("l_at"), F.max("r_at").alias("r_at"))
    if bounds:
        # every other common token comes after the last common prefix token, in both
        behind = F.least(l_size - F.col("l_at"), r_size - F.col("r_at")) - 1
        pairs = pairs.where(F.col("common") + behind >= _least_common(l_size, r_size, threshold))
    return lsets, rsets, pairs.select("l_name", "r_name")


def fuzzy_candidates(left_names: DataFrame, right_names: DataFrame, threshold: float,
                     hot_token_rows: int = DEFAULT_HOT_TOKEN_ROWS, bounds: bool = True) -> DataFrame:
    """The pairs ``l_name, r_name`` whose similarity is looked at; without
    ``bounds``, those of the prefix filter alone."""
    return _sets_and_candidates(left_names, right_names, threshold, hot_token_rows, bounds)[2]


def fuzzy_name_pairs(left_names: DataFrame, right_names: DataFrame, threshold: float,
                     hot_token_rows: int = DEFAULT_HOT_TOKEN_ROWS) -> DataFrame:
    """All pairs of distinct names with token Jaccard ``>= threshold``.

    Inputs have one column each, ``l_name`` and ``r_name``.  Output columns
    ``l_name, r_name, score``.  Equal to the cross join filtered by score.
    """
    lsets, rsets, cand = _sets_and_candidates(left_names, right_names, threshold, hot_token_rows)
    full = cand.join(lsets.select("l_name", F.col("ordered.token").alias("l_tokens")), "l_name") \
        .join(rsets.select("r_name", F.col("ordered.token").alias("r_tokens")), "r_name")
    score = jaccard_of_sets(F.col("l_tokens"), F.col("r_tokens"))
    return full.select("l_name", "r_name", score.alias("score")).where(F.col("score") >= F.lit(threshold))


def fuzzy_join(left: DataFrame, right: DataFrame, left_col: str, right_col: str,
               threshold: float = 0.3, score_col: str = "jaccard_similarity", **kw) -> DataFrame:
    """Distinct left names × right rows whose names score ``>= threshold`` (D3).

    Output: the left name (as ``left_col``), every right column, the score.
    """
    lnames = left.select(F.col(_q(left_col)).cast("string").alias("l_name"))
    rnames = right.select(F.col(_q(right_col)).cast("string").alias("r_name"))
    pairs = fuzzy_name_pairs(lnames, rnames, threshold, **kw)
    # fresh names on the right side: both inputs may come from one table
    right_cols = [c for c in right.columns if c != left_col]
    r = right.select(*[F.col(_q(c)).alias(f"_r{i}") for i, c in enumerate(right.columns)])
    rkey = f"_r{right.columns.index(right_col)}"
    # rows are streamed past the pairs of their names: files of repeated names are small, so that
    # Spark would broadcast their rows, or put very many of them into one task to sort
    joined = pairs.hint("shuffle_hash").join(r, F.col("r_name") == F.col(rkey).cast("string"))
    return joined.select(F.col("l_name").alias(left_col),
                         *[F.col(f"_r{right.columns.index(c)}").alias(c) for c in right_cols],
                         F.col("score").alias(score_col))


# ------------------------------------------------------------------ D4 --

# types whose minimum Spark keeps in place in a hash table
_COUNTABLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.TimestampType, T.TimestampNTZType)


def best_match(pairs: DataFrame, key: str, score: str, tie_break) -> DataFrame:
    """One row per key: highest score, ties broken by ``tie_break`` ascending.

    ``max_by``-style aggregate over ``struct(-score, tie_break..., rest)``:
    partial aggregation before the shuffle, no sort of a whole key group.

    Buffers that hold text make Spark sort the rows before it aggregates them.
    So rows that differ in the first tie break only, as those of one name do,
    are first cut to the smallest: a number is kept in a hash table.
    """
    tie_break = [tie_break] if isinstance(tie_break, str) else list(tie_break)
    rest = [c for c in pairs.columns if c not in [key, score] + tie_break]
    if tie_break and tie_break[0] not in (key, score) and isinstance(pairs.schema[tie_break[0]].dataType, _COUNTABLE):
        columns, first = pairs.columns, F.col(_q(tie_break[0]))
        smallest = F.when(F.bool_or(first.isNull()), F.lit(None)).otherwise(F.min(first))     # null comes first
        pairs = pairs.groupBy(*[F.col(_q(c)) for c in columns if c != tie_break[0]]) \
            .agg(smallest.alias(tie_break[0])).select(*[F.col(_q(c)) for c in columns])
    order = [(-F.col(_q(score))).alias("f0")] + \
        [F.col(_q(c)).alias(f"t{i}") for i, c in enumerate(tie_break)] + \
        [F.col(_q(c)).alias(f"r{i}") for i, c in enumerate(rest)] + \
        [F.col(_q(score)).alias("s")]
    best = pairs.groupBy(F.col(_q(key))).agg(F.min(F.struct(*order)).alias("_b"))
    names = {**{c: f"t{i}" for i, c in enumerate(tie_break)},
             **{c: f"r{i}" for i, c in enumerate(rest)}, score: "s"}
    return best.select(*[F.col(_q(c)) if c == key else F.col(f"_b.{names[c]}").alias(c)
                         for c in pairs.columns])


# ------------------------------------------------------------------ D5 --

def apply_overrides(matches: DataFrame, key: str, overrides: DataFrame, append: bool = True) -> DataFrame:
    """Manual corrections (D5): override values win, new keys are appended.

    ``overrides`` holds ``key`` and any subset of the other columns; a
    non-null override value replaces the matched one.  The result keeps one
    row per key (an override of an already matched key does not duplicate it).
    With ``append=False`` overrides only correct keys that are present.
    """
    ocols = [c for c in overrides.columns if c != key]
    o = overrides.select(F.col(_q(key)), *[F.col(_q(c)).alias(f"_o_{c}") for c in ocols])
    o = bounded_broadcast(o)
    fixed = matches.join(o, key, "left").select(
        *[F.coalesce(F.col(f"_o_{c}"), F.col(_q(c))).alias(c) if c in ocols else F.col(_q(c))
          for c in matches.columns])
    if not append:
        return fixed
    added = overrides.join(matches.select(key), key, "left_anti")
    return fixed.unionByName(added, allowMissingColumns=True)


# ------------------------------------------------------------------ D6 --

def unresolved(keys: DataFrame, resolved: DataFrame, key: str, resolved_key: str | None = None) -> DataFrame:
    """Keys without a resolution (D6): anti join, null keys included."""
    rk = resolved_key or key
    r = resolved.select(F.col(_q(rk)).alias("_rk")).distinct()
    return keys.join(r, F.col(_q(key)) == F.col("_rk"), "left_anti")


# names of the operator inventory
map_lookup = lookup_join          # D7: dictionary lookup as a (broadcast) left join
