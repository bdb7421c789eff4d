"""Workers give back what they hold of batches that are gone."""

import pyarrow as pa

from driftwood.llm import arrowtext


def test_memory_of_gone_batches_is_given_back(monkeypatch):
    calls = []
    monkeypatch.setattr(arrowtext, "give_back", lambda: calls.append(1))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 1, 2]), pa.array(["a", "b", "c"])], names=["k", "t"])
    assert sum(x.num_rows for x in arrowtext.slices_by_chars(batch, 1, 2)) == 3 and len(calls) == 1
    assert sum(x.num_rows for x in arrowtext.whole_groups(iter([batch]))) == 3 and len(calls) == 2
