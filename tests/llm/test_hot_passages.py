"""Blocks of op3 with many different surroundings never go to one task whole."""

import random

import pytest

from driftwood.llm import substring_dedup
from tests.llm.test_dedup_operators import _repeats_match, _repetitive

MOST = 6


def _bounded(monkeypatch):
    repeats = substring_dedup._repeats

    def checked(length, gram, most=MOST):
        run = repeats(length, gram)

        def look(batches):
            seen = {}

            def counted():
                for batch in batches:
                    for key in batch.column(0).to_pylist():
                        seen[key] = seen.get(key, 0) + 1
                    if max(seen.values(), default=0) > most:
                        raise ValueError(f"{max(seen.values())} rows of one key in a task")
                    yield batch

            yield from run(counted())

        return look

    monkeypatch.setattr(substring_dedup, "HOT", MOST)
    monkeypatch.setattr(substring_dedup, "_repeats", checked)


@pytest.mark.parametrize("passage", [38, 40, 55, 130])
def test_one_passage_in_many_contexts(spark, monkeypatch, passage):
    _bounded(monkeypatch)
    r = random.Random(passage)

    def words(n):
        return "".join(r.choice("abcdefgh ") for _ in range(n))

    same, tails = words(passage), [words(9) for _ in range(3)]
    texts = [words(r.randint(0, 60)) + same + (tails[i % 4] if i % 4 < 3 else "") + words(r.randint(0, 60)) for i in range(60)]
    _repeats_match(spark, texts + [same, same[:-1], texts[7], "é" + same], length=40, gram=12)


def test_repetitive_texts_in_bounded_groups(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT", 2)
    _repeats_match(spark, _repetitive(5), length=40, gram=16)
