"""Registered queries of the training-data operators, with oracle SQL where
SQL can say it.  Each reads its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwood.llm import (bpe, collocations, decontamination, embedding_dedup, hard_negatives, language_id,
                           license_templates, line_dedup, near_dedup,
                           secret_ledger, substring_dedup, token_counts, url_cascade)
from driftwood.session import read_test_table as table
from driftwood.session import scratch_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = language_id.learn(docs, ~held_out() & F.col("doc_id").isNotNull(), F.col("doc_id"))
    out = language_id.identify(docs.withColumn("held_out", held_out()), learned, keep=["doc_id", "held_out"])
    return out.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"),
                      # what is left, as text (a cut inside a character leaves a replacement character)
                      F.make_valid_utf8(F.col("kept").cast("string")).alias("kept"))


def op4_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = secret_ledger.scan(docs, scratch_path(spark, "secret-ledger"), "doc_id", ["doc_id"])
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in secret_ledger.BASE_RULES]))
    return out.select(
        "doc_id",
        *[F.size(F.filter("spans", lambda s: s["kind"] == F.lit(r.kind))).cast("long").alias(f"n_{r.kind}")
          for r in secret_ledger.BASE_RULES],
        F.sha2(secret_ledger.span_text(base), 256).alias("base_sha256"),
        secret_ledger.span_text(F.col("spans")).alias("spans"))


def op5_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_cascade.judge(table(spark, sf_dir, "pages"), ["page_id"])


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=4) \
        .select("doc_id", "n_shingles", "component_id", "kept")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN, with_ids=False)


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = token_counts.encoded_lengths(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)
    return token_counts.length_histogram(lengths)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 50 == 0)


def op12_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_templates.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    base = F.filter("matches", lambda m: m["base"])
    starts = F.transform(base, lambda m: m["start"])
    return out.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
                      F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                      license_templates.labels_of(base).alias("base_labels"),
                      license_templates.labels_of(F.col("matches")).alias("labels"), "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_language_id": op2_language_id,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_secret_ledger": op4_secret_ledger,
    "op5_url_cascade": op5_url_cascade,
    "op6_near_dedup": op6_near_dedup,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_line_dedup": op9_line_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_license_templates": op12_license_templates,
    "op13_collocations": op13_collocations,
}

ORACLE = {
    "op11_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
pos AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INT AS rank,
  other AS negative_id, positive_score, score AS negative_score
FROM pos JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
""",
    "op13_collocations": """
WITH d AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT d, lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4])::INT AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
cuts AS (
  SELECT c.lang, c.k, c.phrase, c.a, cut, x.f AS l, y.f AS r,
    (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
  FROM c, (SELECT unnest([1, 2, 3])::INT AS cut) g, f x, f y
  WHERE cut < c.k AND x.lang = c.lang AND x.phrase = array_to_string(c.w[1:cut], ' ')
    AND y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1:c.k], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_phrases AS (
  SELECT lang, a, unnest(list_transform(range(1, k - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
  FROM c, (SELECT unnest([2, 3])::INT AS size) WHERE size < k),
longer AS (SELECT lang, phrase, max(a) AS longer FROM inner_phrases GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN longer USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN n USING (lang)
QUALIFY rank <= 2000
""",
    "op5_url_cascade": """
WITH p AS (
  SELECT page_id,
    CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN ''
         ELSE translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS host,
    CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN ''
         ELSE regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) END AS path
  FROM pages),
rules(verdict, h, pre) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
r AS (
  SELECT p.*,
    (SELECT arg_max(h || pre, length(h || pre)) FROM rules
      WHERE (p.host = h OR ends_with(p.host, '.' || h)) AND starts_with(p.path, pre)) AS rule
  FROM p),
v AS (SELECT r.*, rules.verdict AS given FROM r LEFT JOIN rules ON r.rule = rules.h || rules.pre)
SELECT page_id, host, path, rule,
  coalesce(given, CASE WHEN host IN (SELECT host FROM v WHERE given = 'block') THEN 'block' ELSE 'allow' END) AS verdict
FROM v
""",
}
