import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tests.llm import plain
from tidemark.llm import near_copies


def shingles(text, words=5):
    found = plain.words(plain.folded(text))
    return {b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def groups(rows):
    """The smallest id of every row's component, all pairs compared."""
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, one in enumerate(sets):
        for j in range(i):
            if 10 * len(one & sets[j]) >= 8 * len(one | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (id_, _) in enumerate(rows):
        least.setdefault(find(i), []).append(id_)
    return [min((x for x in least[find(i)] if x is not None), default=None) for i in range(len(rows))]


@pytest.fixture
def edited():
    """Texts with copies that have more and more words changed, over and under the limit, and a line that most texts have."""
    random.seed(12)
    line = " ".join(f"common{i}" for i in range(12))
    rows = []
    for i in range(40):
        base = [f"w{random.randint(0, 3000)}" for _ in range(random.choice([6, 20, 60, 200, 600]))]
        for edits in range(6):
            words = list(base)
            for _ in range(edits * max(1, len(base) // 100)):
                words[random.randrange(len(words))] = f"new{random.randint(0, 9999)}"
            rows.append((10 * i + edits, " ".join(words) + (" " + line if i % 3 else "")))
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize("often", [2, 20])
def test_equals_all_pairs(spark, edited, often, monkeypatch):
    monkeypatch.setattr(near_copies, "FREQUENT", often)
    found = near_copies.near_copies(spark.createDataFrame(edited, "doc_id long, text string")).collect()
    assert sorted(map(tuple, found)) == sorted(zip([r[0] for r in edited], groups(edited), strict=True))


def test_pipeline_drops_edited_copies(spark):
    random.seed(3)
    base = [f"w{random.randint(0, 3000)}" for _ in range(300)]
    copies = []
    for i in range(5):
        words = list(base)
        words[20 + 50 * i] = "edited"
        words[40 + 50 * i] = "again"
        copies.append((i, " ".join(words)))
    docs = spark.createDataFrame([*copies, (9, " ".join(reversed(base)))], "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()) == [0, 9]


def test_odd_rows(spark):
    found = near_copies.near_copies(plain.odd(spark)).collect()
    rows = [r[:2] for r in plain.ODD]
    assert sorted(map(tuple, found), key=str) == sorted(zip([r[0] for r in rows], groups(rows), strict=True), key=str)
    kept = near_copies.survivors(plain.odd(spark))
    assert kept.columns == plain.odd(spark).columns
    assert {r.doc_id for r in kept.collect()} == set(groups(rows))
    assert near_copies.survivors(plain.none(spark)).collect() == []


def test_bitmaps_lose_no_pair():
    random.seed(9)
    base = random.sample(range(1 << 40), 150)
    sets = [np.unique(np.array(base[random.randint(0, 40) :] + random.sample(range(1 << 40), random.randint(0, 60)), np.uint64)) for _ in range(60)]
    columns = {
        "size": np.array([len(one) for one in sets]),
        "bits": near_copies._bitmaps(pa.chunked_array([[near_copies._bitmap(one) for one in sets]])),
    }
    a, b = np.triu_indices(len(sets), 1)
    same = np.array([len(np.intersect1d(sets[i], sets[j])) for i, j in zip(a, b, strict=True)])
    similar = 100 * same >= 80 * (columns["size"][a] + columns["size"][b] - same)
    kept = near_copies._may_reach(columns, a, b, 80)
    assert similar.any() and not (similar & ~kept).any()
    assert kept.sum() < 1.3 * similar.sum() + 5


def test_fingerprints_link_by_themselves(spark, monkeypatch):
    """Near copies whose fingerprints are close are found by SimHash alone, and confirmed on their sets."""
    random.seed(4)
    base = [f"w{random.randint(0, 3000)}" for _ in range(900)]
    other = [f"v{random.randint(0, 3000)}" for _ in range(300)]
    rows = [(3, " ".join(base)), (1, " ".join([*base, "end"])), (2, " ".join(other)), (5, " ".join(base[:700]))]
    monkeypatch.setattr(near_copies, "_prefixes", lambda docs, *_: docs.sparkSession.createDataFrame([], near_copies.SCHEMA))
    found = near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert dict(map(tuple, found)) == {1: 1, 2: 2, 3: 1, 5: 5}
