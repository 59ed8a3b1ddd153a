import numpy as np
import pyarrow as pa

from tidemark.llm.workers import release, releasing


def _resident() -> int:
    with open("/proc/self/statm") as file:
        return int(file.read().split()[1]) * 4096


def test_batches_pass_and_tasks_without_any_end(spark):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(batch.column(0).to_numpy() + 1)], names=["id"])

    rows = spark.range(1000, numPartitions=3).mapInArrow(releasing(run), "id long")
    assert sorted(r["id"] for r in rows.collect()) == list(range(1, 1001))
    assert spark.range(0).mapInArrow(releasing(run), "id long").count() == 0
    assert list(releasing(lambda batches: iter(()))(iter(()))) == []


def test_free_memory_goes_back():
    """Small pieces in the middle of the heap: without a trim the C library keeps the pages between them."""
    pieces = [np.ones(12_000, np.uint8) for _ in range(20_000)]
    kept = pieces[::1000]
    del pieces
    before = _resident()
    release()
    assert len(kept) == 20 and _resident() <= before
