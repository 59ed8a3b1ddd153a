"""Runs of sequences merged micro-batch by micro-batch against plain counts."""

import random
from collections import Counter

import pandas as pd
import pyarrow as pa

from tidemark.streaming.summaries import RunCounter, merge_runs


def test_equals_plain_counts():
    random.seed(3)
    open_ = RunCounter(1000, pa.string()).schema.empty_table().to_pandas()
    counts, times = Counter(), {}
    for step in range(15):
        rows = [(random.choice(["a", "b", None]), random.choice([0, 1000]), 0, random.randint(-20, 40), 10 * step + i) for i in range(30)]
        open_ = merge_runs(open_, pd.DataFrame(rows, columns=["group_key", "window_millis", "block", "sequence", "at"]))
        for key, window, _, sequence, at in rows:
            counts[key, window, sequence] += 1
            times.setdefault((key, window), []).append(at)
    found = Counter()
    for r in open_.itertuples():
        assert (r.first_us, r.last_us) == (min(times[r.group_key, r.window_millis]), max(times[r.group_key, r.window_millis]))
        for sequence in range(r.low, r.high + 1):
            assert (r.group_key, r.window_millis, sequence) not in found
            found[r.group_key, r.window_millis, sequence] = r.n
    assert found == counts


def test_state_follows_the_number_of_runs():
    sequences = [n for n in range(30_000) if n % 1000]
    random.seed(1)
    random.shuffle(sequences)
    open_ = RunCounter(1000, pa.string()).schema.empty_table().to_pandas()
    for first in range(0, len(sequences), 7000):
        part = sequences[first : first + 7000]
        rows = pd.DataFrame({"group_key": "a", "window_millis": 0, "block": 0, "sequence": part, "at": part})
        open_ = merge_runs(open_, rows)
    assert len(open_) == 30 and set(open_["n"]) == {1}
