import importlib

import public_tokenizers
import tiktoken

import corpus_pipeline
from driftwood.llm import bpe, language_id
from driftwood.llm.components import stored
from driftwood.llm.queries import ORACLE, QUERIES, RANKS
from driftwood.session import read_test_table
from tests.conftest import SF_SMALL
from tests.llm import brute


def test_stages_equal_brute_force(spark):
    """Every stage on what its predecessor kept."""
    docs = stored(read_test_table(spark, SF_SMALL, "documents"), "t")
    columns = docs.columns
    items = [tuple(r) for r in read_test_table(spark, SF_SMALL, "benchmark").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = sorted((r["doc_id"], r["text"]) for r in docs.collect())
        out = stored(stage(spark, docs, SF_SMALL), "t")
        rows = out.collect()
        if name == "language":
            from pyspark.sql import functions as F
            from driftwood.llm.queries import held_out
            learned = language_id.learn(docs, ~held_out() & F.col("doc_id").isNotNull(), F.col("doc_id"))
            judge = language_id.Classifier(tuple(sorted(learned.items()))).classify
            want = [(d, t) for d, t in before if not judge(t)[2]]
            assert len(want) >= 0.97 * len(before)
        elif name == "lines":
            want = [(d, t) for d, t, _, gone in brute.lines(before) if not gone or t.strip("\t\r\n ")]
        elif name == "near_duplicates":
            want = [b for b, n in zip(before, brute.near_duplicates(before, 5)) if n[3]]
        elif name == "decontaminate":
            want = [b for b, n in zip(before, brute.decontamination(before, items)) if not n[5]]
        else:
            enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                                    mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})
            assert sorted((r["doc_id"], r["ids"]) for r in rows) == [(d, enc.encode_ordinary(t)) for d, t in before]
            continue
        assert out.columns == columns
        assert sorted((r["doc_id"], r["text"]) for r in rows) == want, name
        assert all(r["n_chars"] == len(r["text"]) for r in rows)
        docs = out


def test_stages_on_odd_rows(spark):
    docs = read_test_table(spark, SF_SMALL, "documents").limit(0)
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0),
                                 (2, "x" * 50_000, None, None, None)], docs.schema)
    for d in (docs, odd):
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, d, SF_SMALL).collect()


def test_registration():
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert set(ORACLE) <= set(entry.oracle_sql())
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
