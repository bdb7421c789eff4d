import gc

import numpy as np
import public_tokenizers
import pytest

from driftwood.llm import bpe


@pytest.mark.parametrize("method", ["encode_joined", "count_tokens"])
def test_collector_rests_while_texts_are_encoded(method):
    """A collection walks all remembered stretches; new ones set off hundreds of them."""
    tok = bpe.Tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = [" ".join(f"w{i}x{j}y" for j in range(200)) for i in range(50)]
    runs = []
    count = lambda phase, info: runs.append(phase)
    gc.callbacks.append(count)
    try:
        got = getattr(tok, method)(texts)
    finally:
        gc.callbacks.remove(count)
    assert not runs and gc.isenabled()
    if method == "encode_joined":
        assert [raw.decode() for _, raw in got] == texts
    with pytest.raises((AttributeError, TypeError)):
        getattr(tok, method)([None])
    assert gc.isenabled()                        # after a failure, too


def test_sorted_distinct():
    for x in ([], [3], [5, 1, 5, 1, 1], [2, 2]):
        assert bpe._sorted_distinct(np.array(x, np.int64)).tolist() == sorted(set(x))
