"""What tasks of one step leave in a Python worker for the next."""
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from marketmill.llm import quality, sentencepiece, shared


@pytest.fixture
def task_of(make_docs, monkeypatch):
    def task(step):
        """The function that a step hands to its tasks."""
        docs = make_docs([(1, "a b c")])
        found = []
        plain = type(docs).mapInArrow
        monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, *a, **k: found.append(run) or plain(self, run, *a, **k))
        step(docs)
        monkeypatch.undo()
        return found[-1]
    return task


def test_pieces_are_made_of_a_few_rows_at_once_and_go_with_the_next_step(task_of):
    encode = task_of(lambda d: sentencepiece.encode_checked(d.select("doc_id", "text")))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(3000)), "text": [f"text {k % 7}" for k in range(3000)]})
    out = list(encode(iter([batch])))
    assert [i for b in out for i in b.column(0).to_pylist()] == list(range(3000))
    assert max(b.num_rows for b in out) <= 512
    assert list(shared.TABLES) == [sentencepiece.public_model()]

    stats = task_of(lambda d: quality.text_stats(d, "doc_id", "text", "source"))
    rows = pa.RecordBatch.from_pydict({"id": [1], "text": [b"a b"], "host": ["h"]})
    assert sum(b.num_rows for b in stats(iter([rows]))) == 1
    assert not shared.TABLES


def test_freed_memory_goes_back_at_the_end_of_a_task():
    def held():
        return int(re.search(r"\nAnonymous:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024

    def run(batches):
        for _ in batches:
            # Small blocks below one that stays: the C library keeps them for itself.
            parts = [np.ones(12_000) for _ in range(2000)]
            yield parts[-1].copy()

    shared.give_back()
    before = held()
    kept = list(shared.lean(run)(range(1)))
    assert held() - before < 60 and len(kept) == 1
