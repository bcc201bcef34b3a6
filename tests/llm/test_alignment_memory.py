"""What a worker holds while it aligns a block of texts."""

import random
import tracemalloc

import pyarrow as pa

from tidemark.llm import alignment
from tidemark.llm.queries import ALIGNED_VOCABULARIES


def test_a_block_takes_few_times_its_text(monkeypatch):
    r = random.Random(1)
    words = ["".join(r.choices("etaoinshrdlu", k=r.randint(2, 9))) for _ in range(3000)]
    texts = [" ".join(r.choices(words, k=800)) for _ in range(1400)]
    size = sum(map(len, texts))
    found = []
    monkeypatch.setattr(alignment, "map_batches", lambda d, run, fields: found.append(run))
    monkeypatch.setattr(alignment, "TaskContext", type("Task", (), {"get": classmethod(lambda c: c), "partitionId": staticmethod(lambda: 0)}))
    alignment._measured(None, ALIGNED_VOCABULARIES, alignment.PART, alignment.BLOCK)
    alignment.aligner(*ALIGNED_VOCABULARIES)
    batches = [pa.RecordBatch.from_arrays([pa.array(range(k, k + 200), pa.int64()), pa.array(texts[k : k + 200])], names=["doc_id", "text"]) for k in range(0, len(texts), 200)]
    tracemalloc.start()
    rows = sum(b.num_rows for b in found[0](iter(batches)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert size > alignment.PART and rows == len(texts) + 1  # one dictionary
    assert peak < 20 * size, peak / size
