"""Planted passages of 400 bytes are removed, shorter ones are not."""

import random

from driftwood.llm.substring_dedup import remove_repeats


def test_planted_passages_of_400_bytes_are_caught(spark):
    """Passages of over 50 words: those of 400 bytes go from every document, shorter ones and clean documents stay."""
    r = random.Random(11)

    def words(n, k):
        return " ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=k)) for _ in range(n))

    long, short = words(60, 7), words(60, 4)
    texts = [f"{words(80, 6)} {p} {words(80, 6)}" for p in [long] * 10 + [short] * 10 + [words(60, 7) for _ in range(10)]]
    got = remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    removed = {r["doc_id"]: r["n_bytes"] - len(r["kept"]) for r in got.collect()}
    assert len(long) >= 400 > len(short) + 2
    assert all(removed[i] >= len(long) for i in range(10)) and not any(removed[i] for i in range(10, 30))
