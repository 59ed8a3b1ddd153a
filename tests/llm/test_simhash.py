from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import plain
from tidemark.llm import components, simhash, spans


def test_fingerprints_of_odd_rows(spark):
    found = simhash.near_duplicates(plain.odd(spark)).collect()
    prints = [plain.simhash(r[1]) for r in plain.ODD]
    least = plain.least_linked(prints, [r[0] for r in plain.ODD])
    expected = Counter((r[0], f"{p:016x}", c) for r, p, c in zip(plain.ODD, prints, least, strict=True))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in found) == expected


def test_one_document_of_a_group_stays(spark):
    docs = plain.odd(spark)
    kept = simhash.survivors(docs)
    assert kept.columns == docs.columns
    groups = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert {r.doc_id for r in kept.collect()} == groups
    assert simhash.survivors(plain.none(spark)).collect() == []


@pytest.fixture
def clustered():
    random = np.random.default_rng(6)
    points = []
    for centre in random.integers(0, 1 << 63, 250, dtype=np.uint64):
        point = int(centre)
        for _ in range(random.integers(1, 12)):
            for _ in range(random.integers(0, 4)):
                point ^= 1 << int(random.integers(0, 64))
            points.append(point)
    return np.unique(np.array(points, np.uint64))


def brute_roots(points):
    a, b = np.nonzero(np.triu(np.bitwise_count(points[:, None] ^ points[None, :]) <= 2, 1))
    return components.local_roots(len(points), a, b)


def test_tree_finds_all_links(clustered, monkeypatch):
    monkeypatch.setattr(simhash, "LEAF_ROWS", 32)
    a, b = simhash.linked_roots(clustered, 2)
    assert (components.local_roots(len(clustered), a, b) == brute_roots(clustered)).all()


def test_shards_lose_no_link(spark, clustered, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_ROWS", 100)
    signed = clustered.view(np.int64)
    classes = spark.createDataFrame([(int(x), i) for i, x in enumerate(signed)], "fp long, least long")
    links = simhash.links(classes)
    found = {r.node: r.root for r in components.components(links).collect()}
    root = brute_roots(clustered)
    groups, expected = {}, {}
    for i, x in enumerate(signed.tolist()):
        groups.setdefault(found.get(x, x), set()).add(x)
        expected.setdefault(int(root[i]), set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_tree_sends_few_copies_and_loses_no_pair(clustered):
    """Small shards of fingerprints far apart, of which a cut through all sides would send some hundred copies."""
    points = np.unique(np.concatenate([clustered, np.random.default_rng(2).integers(0, 1 << 63, 6000, dtype=np.uint64)]))
    nodes = simhash.vantage_tree(points, 1 / 200, 3)
    shards, sent = simhash.shards_of(points, nodes, 3)
    assert len(set(shards.tolist())) > 50
    assert len(sent) <= (simhash.MAX_COPIES + 1) * len(points)
    together = set()
    for shard in set(shards.tolist()):
        members = np.sort(sent[shards == shard])
        a, b = np.nonzero(np.triu(np.bitwise_count(members[:, None] ^ members[None, :]) <= 3, 1))
        together |= set(zip(members[a].tolist(), members[b].tolist(), strict=True))
    a, b = np.nonzero(np.triu(np.bitwise_count(points[:, None] ^ points[None, :]) <= 3, 1))
    assert len(a) and together == set(zip(points[a].tolist(), points[b].tolist(), strict=True))


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (300, 200), (None, 5)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 61)} | {100 + i: 100 for i in range(1, 50)} | {300: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_hashes_equal_the_library():
    import random

    import xxhash

    random.seed(1)
    data = np.frombuffer(random.randbytes(4000), np.uint8)
    starts = np.array([random.randint(0, 3800) for _ in range(800)])
    ends = starts + np.array([random.randint(0, 150) for _ in range(800)])
    expected = [xxhash.xxh64_intdigest(data[a:b].tobytes(), 42) for a, b in zip(starts, ends, strict=True)]
    assert spans.xxh64(data, starts, ends).tolist() == expected


def test_blocks_and_words_of_a_sliced_column():
    texts = ["", None, "a b", "ä\tb ", "long " * 50, "x"]
    column = pa.array(["skip", *texts]).slice(1)
    found = []
    for _, data, offsets in spans.blocks(column, 20):
        starts, ends = spans.words(data, offsets)
        found += [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
    assert found == [word for text in texts for word in plain.words(text)]
