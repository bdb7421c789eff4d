"""Pre-tokens are merged a bounded number of bytes at a time."""

import random

import public_tokenizers

from driftwood.llm import bpe
from driftwood.llm.queries import RANKS


def test_pre_tokens_are_merged_in_runs(monkeypatch):
    r = random.Random(9)
    pieces = ["".join(r.choices("aeinrst", k=r.randrange(1, 30))).encode() for _ in range(400)] + [b"x" * 500]
    queue = bpe.tokenizer(RANKS, public_tokenizers.PATTERN).queue
    whole, seen, was = queue.encode(pieces), [], bpe.RankQueueEncoder._merge
    monkeypatch.setattr(bpe.RankQueueEncoder, "BYTES", 300)
    monkeypatch.setattr(bpe.RankQueueEncoder, "_merge", lambda self, some: seen.append(some) or was(self, some))
    assert queue.encode(pieces) == whole
    assert len(seen) > 5 and all(sum(map(len, s)) <= 300 or len(s) == 1 for s in seen)
