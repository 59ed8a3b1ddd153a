from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_queries import FOLDER
from tidemark.llm import embedding_cells, queries
from tidemark.llm.tables import table

SCHEMA = "vec_id long, embedding array<float>, label int, n long, cell string, node string, unit string"


def brute(rows, limit=0.93):
    """(id, links, component, kept) of every row, comparing all with all."""
    def direction(vector):
        if not vector or any(x is None or not np.isfinite(x) for x in vector) or not any(vector):
            return None
        scaled = np.array(vector, float) / max(map(abs, vector))
        return scaled / np.linalg.norm(scaled)

    units = [direction(vector) if label is not None else None for _, vector, label in rows]
    link = np.zeros((len(rows), len(rows)), bool)
    for i, a in enumerate(units):
        for j in range(i):
            b = units[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b):
                link[i, j] = link[j, i] = a @ b >= limit
    root = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            least = min([root[i], *(root[j] for j in np.flatnonzero(link[i]))])
            changed |= least != root[i]
            root[i] = least
    result = Counter()
    for i, (id_, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        component = min(ids, default=None)
        result[(id_, int(link[i].sum()), component, id_ == component)] += 1
    return result


def shown(frame):
    return Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in frame.collect())


def frame_of(spark, rows):
    return spark.createDataFrame([(*row, 1, "x", "y", "z") for row in rows], SCHEMA)


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_query_equals_brute_force(spark, folder):
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, folder, "embeddings").collect()]
    assert shown(queries.op12_embedding_near_dedup(spark, folder)) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.1], 1), (2, [2.0, 0.0, 0.2], 1), (3, [1.0, 0.0, 0.1], 2), (4, [1.0, 0.0, 0.1], None),
        (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1), (8, [nan, 1.0, 0.0], 1), (9, [inf, 1.0, 0.0], 1),
        (10, [None, 1.0, 0.0], 1), (11, [1.0, 0.0], 1), (None, [1.0, 0.0, 0.1], 1), (None, [0.0, 1.0, 0.0], 3),
        (None, None, None), (12, [1.0, -0.0, 0.1], 1), (13, [1e-30, 0.0, 1e-31], 1), (13, [1e30, 0.0, 1e29], 1),
        (14, [0.0, 1.0, 0.0], 1), (14, [0.0, 1.0, 0.0], 1), (15, [0.0, 0.0, 0.0], 1), (16, [-1.0, 0.0, -0.1], 1),
    ]
    assert shown(embedding_cells.near_duplicates(frame_of(spark, rows))) == brute(rows)
    assert embedding_cells.near_duplicates(frame_of(spark, [])).collect() == []


def clustered(count, dimensions, seed=3):
    """Groups of near copies, copies of them, and vectors alone."""
    random = np.random.default_rng(seed)
    rows = []
    while len(rows) < count:
        centre = random.normal(size=dimensions)
        for _ in range(random.choice([1, 1, 1, 2, 3, 8])):
            rows.append(centre + random.normal(size=dimensions) * random.choice([0.0, 0.05, 0.15, 0.25]))
    dense = random.normal(size=dimensions)
    rows += [dense + 0.02 * random.normal(size=dimensions) for _ in range(count // 4)]
    return [(i, [float(x) for x in np.float32(row)], i % 2) for i, row in enumerate(rows)]


@pytest.mark.parametrize("dimensions", [3, 9])
def test_split_cells_lose_no_link_in_few_dimensions(spark, dimensions):
    rows = clustered(400, dimensions)
    found = embedding_cells.near_duplicates(frame_of(spark, rows), cell_rows=40, block_rows=32)
    assert shown(found) == brute(rows)


def test_recall_at_the_limit_in_many_dimensions(spark):
    """Pairs just above the limit, each with nothing else near: the hardest ones."""
    random = np.random.default_rng(5)
    rows = []
    for i in range(1500):
        a = random.normal(size=64)
        a /= np.linalg.norm(a)
        side = random.normal(size=64)
        side -= side @ a * a
        side /= np.linalg.norm(side)
        rows += [(2 * i, a.tolist(), 1), (2 * i + 1, (0.932 * a + np.sqrt(1 - 0.932**2) * side).tolist(), 1)]
    nodes = embedding_cells.distinct_vectors(frame_of(spark, rows), "vec_id", "embedding", "label")
    placed = embedding_cells.cells(nodes, cell_rows=200)
    assert placed.select("cell").distinct().count() > 10
    assert placed.filter("home").count() == 3000
    found = embedding_cells.near_duplicates(frame_of(spark, rows), cell_rows=200)
    assert found.filter(F.col("n_links") == 1).count() >= 0.995 * 3000
    assert found.filter(F.col("n_links") > 1).count() == 0


def test_margin_is_a_chord_in_few_dimensions():
    assert embedding_cells.margin(0.93, 9) > np.sqrt(0.14)
    assert embedding_cells.margin(0.93, 64) < 0.17
