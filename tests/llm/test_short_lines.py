"""Lines of fewer characters than a shingle take part in the line de-duplication."""

import corpus_pipeline
from driftwood.llm import line_dedup
from driftwood.session import read_test_table
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.test_dedup_operators import _lined


def _same(spark, docs):
    out = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"))
    got = sorted((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in out.collect())
    want = brute.lines(docs)
    assert got == want
    return want


def test_short_lines_repeat(spark):
    _same(spark, _lined(6))
    want = _same(spark, [(1, "Les.\n\n- a"), (2, " Les. \n\t\n\r\nLes"), (3, "- a\n\n\t\n\r"), (4, "Les."), (5, "é" * 7),
                         (6, "é" * 7 + "\n" + "é" * 8 + "\n" + "é" * 9), (7, "\u00a0x\n  \n\u00a0x")])
    assert [w[3] for w in want] == [0, 1, 1, 1, 0, 2, 1]


def test_short_lines_of_the_pipeline(spark):
    docs = read_test_table(spark, SF_SMALL, "documents")
    before = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    got = sorted((r["doc_id"], r["text"]) for r in corpus_pipeline.lines(spark, docs, SF_SMALL).collect())
    assert got == [(d, t) for d, t, _, gone in brute.lines(before) if not gone or t.strip("\t\r\n ")]
