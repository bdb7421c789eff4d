import random
import tracemalloc

import pyarrow as pa

from driftwood.llm import language_id as li
from driftwood.llm import line_dedup


class Task:
    """Keeps the function that tasks run."""

    def mapInArrow(self, function, schema):
        return function


def test_banding_holds_little_of_a_batch():
    r = random.Random(3)
    texts = ["\n".join("".join(r.choices("abcdefgh ", k=300)) for _ in range(20)) for _ in range(400)]      # 2.4 million characters
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    task = line_dedup._banded(Task())
    tracemalloc.start()
    try:
        n = sum(out.num_rows for out in task(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == len({x.strip(line_dedup.TRIMMED) for t in texts for x in t.split("\n")})
    assert peak < 40 << 20, peak


def test_a_kept_text_goes_to_the_workers_once(spark):
    learned = {"en": b"the quick brown fox jumps over the lazy dog " * 20, "de": b"der schnelle braune fuchs springt ueber den hund " * 20}
    docs = spark.createDataFrame([(1, "the lazy dog", "x"), (2, "der braune fuchs", None), (3, None, "y"), (4, "42", "z")],
                                 "id long, text string, more string")
    whole, bare = li.identify(docs, learned), li.identify(docs, learned, keep=["id"])
    assert [c for c in whole.columns] == ["id", "text", "more", "lang_pred", "score", "rejected"]
    assert "_dw_text" not in whole._jdf.queryExecution().analyzed().toString()
    assert {tuple(r) for r in whole.select(*bare.columns).collect()} == {tuple(r) for r in bare.collect()}
    assert {(r["id"], r["text"], r["more"]) for r in whole.collect()} == {tuple(r) for r in docs.collect()}
