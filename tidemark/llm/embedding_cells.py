"""Near-duplicate vectors: cells by spherical k-means, blocked cosine products in a cell, one representative of each group.

Equal vectors of one label are combined first, with their number. The distinct vectors of a label (and of one length) are a cell. A cell that is home to
more than ``CELL_ROWS`` vectors is split: centres are fitted by spherical k-means to a sample of ``SAMPLE_PER_CENTRE`` vectors per centre, at most ``FANOUT`` centres, and
all its vectors are assigned, in chunks of ``CHUNK_ROWS`` that any task can take. The split goes on until cells are small or a split no longer parts its
cell. A vector's home is the cell of its nearest centre; it also visits each cell whose border is not farther than ``margin``. Home vectors are
compared with all vectors of their cell, in blocks of ``BLOCK_ROWS`` squared, each a task's group of its own: a cell that can't be split is spread like all others.
A block reports each home vector's number of links and a forest of its links, never all pairs.

How much is found: two vectors at the limit are a chord apart, so a margin of a chord finds every pair. It is used in up to ``SPREAD ** 2`` dimensions. With
more, the difference of two vectors has a standard deviation of chord / sqrt(dimensions) across a border, if it has no preferred direction,
and the margin is ``SPREAD`` of these (in 64 dimensions all but about 1 in 1000 of the pairs at the limit, and nearly all closer ones); pairs are lost where the
difference points straight at a border. Pairs that are compared are decided
by their cosine in double precision, so no link is below the limit.

Defined cases: a null label, a null or empty vector, zero vectors and those with null or non-finite components link with nothing (0 links, their own
component); vectors of different lengths never link; equal vectors link like near ones; a null id is never the smallest unless all are null; rows with one
id are vectors of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from tidemark.llm.components import components, local_roots
from tidemark.llm.tables import written

LIMIT = 0.93
CELL_ROWS = 512
FANOUT = 128
SAMPLE_PER_CENTRE = 64
ROUNDS = 10
SPREAD = 3.0
CHUNK_ROWS = 16_384
BLOCK_ROWS = 1024
#: A cell that holds more of the cell it was split from than this is not split again.
STUCK = 0.75

_ROWS = "cell string, above bigint, node bigint, n bigint, unit array<double>, home boolean"


def margin(limit: float, dimensions: int) -> float:
    """How far from a cell's border a vector still visits it."""
    chord = math.sqrt(2 - 2 * limit)
    return chord * min(1.0, SPREAD / math.sqrt(dimensions)) + 1e-9


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = pc.list_flatten(column)
    return flat.to_numpy().reshape(len(column), -1)


def _lists(matrix: np.ndarray) -> pa.ListArray:
    rows, width = matrix.shape
    return pa.ListArray.from_arrays(np.arange(rows + 1, dtype=np.int32) * width, matrix.ravel())


def _usable(batches, column: str):
    """The rows whose vector has only finite components, not all zero, with its direction as ``unit``."""
    for batch in batches:
        lists = batch[column]
        lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        if not len(lengths):
            continue
        starts = np.cumsum(lengths) - lengths
        values = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
        size = np.maximum.reduceat(np.abs(values), starts)  # nan if one is nan or null
        good = np.isfinite(size) & (size > 0)
        scaled = values / np.repeat(np.where(good, size, 1), lengths)
        norm = np.sqrt(np.add.reduceat(scaled * scaled, starts))
        scaled /= np.repeat(np.where(good, norm, 1), lengths)
        unit = pa.ListArray.from_arrays(np.concatenate([starts, [len(values)]]).astype(np.int32), scaled)
        columns = [*batch.columns, unit]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "unit"]).filter(pa.array(good))


def distinct_vectors(vectors: DataFrame, ident: str, vector: str, label: str) -> DataFrame:
    """One row per label and usable vector: ``node``, ``label``, ``vector``, ``least`` (smallest id), ``n`` (rows) and ``unit``; written."""
    rows = vectors.select(vectors[ident].alias("ident"), vectors[label].alias("label"), vectors[vector].alias("vector"))
    known = rows.filter(F.col("label").isNotNull() & (F.size("vector") > 0))
    combined = known.groupBy("label", "vector").agg(F.min("ident").alias("least"), F.count(F.lit(1)).alias("n"))
    schema = StructType([*combined.schema.fields, StructField("unit", ArrayType(DoubleType()))])
    usable = combined.mapInArrow(partial(_usable, column="vector"), schema)
    return written(usable.withColumn("node", F.monotonically_increasing_id()), "vectors")


def fit(unit: np.ndarray, count: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centres of a spherical k-means: seeds far apart, then means of the nearest vectors, scaled to length 1."""
    random = np.random.default_rng(7)
    centres = unit[:1]
    nearest = unit @ unit[0]
    while len(centres) < min(count, len(unit)):
        far = np.maximum(1 - nearest, 0) + 1e-12
        chosen = unit[random.choice(len(unit), p=far / far.sum())]
        centres = np.vstack([centres, chosen])
        nearest = np.maximum(nearest, unit @ chosen)
    for _ in range(rounds):
        home = (unit @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, unit)
        length = np.linalg.norm(sums, axis=1)
        moved = length > 1e-9
        centres = np.where(moved[:, None], sums / np.where(moved, length, 1)[:, None], centres)
    return centres


def _fitter(cell_rows: int) -> Callable:
    def fit_cell(key: tuple, table: pa.Table) -> pa.Table:
        count = min(FANOUT, max(2, -(-2 * table["homes"][0].as_py() // cell_rows)))
        centres = fit(_matrix(table["unit"]), count)
        return pa.table({"cell": [key[0].as_py()], "chunks": [table["chunks"][0].as_py()], "centres": _lists(centres.reshape(1, -1))})

    return fit_cell


def _assign(rows: pa.Table, fitted: pa.Table, limit: float) -> pa.Table:
    """The rows of a chunk in the cells of its centres, at home or as visitors."""
    schema = rows.select(["cell", "above", "node", "n", "unit", "home"]).schema
    if not len(rows) or not len(fitted):
        return schema.empty_table()
    unit = _matrix(rows["unit"])
    centres = fitted["centres"][0].values.to_numpy().reshape(-1, unit.shape[1])
    near = unit @ centres.T
    best = near.argmax(1)
    apart = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))
    visits = near[np.arange(len(near)), best][:, None] - near <= margin(limit, unit.shape[1]) * apart[best]
    row, child = np.nonzero(visits)
    taken = rows.take(pa.array(row))
    cells = pc.binary_join_element_wise(taken["cell"].cast(pa.string()), pa.array(child.astype(str)), "/")
    home = np.asarray(rows["home"])[row] & (best[row] == child)
    return pa.table([cells, taken["homes"], taken["node"], taken["n"], taken["unit"], pa.array(home)], schema=schema)


def cells(vectors: DataFrame, limit: float = LIMIT, cell_rows: int = CELL_ROWS) -> DataFrame:
    """The vectors in their last cells, at home in one and as visitors in others, with the numbers of ``rows`` and ``homes`` of the cell."""
    root = F.concat_ws("|", F.col("label").cast("string"), F.size("unit").cast("string"))
    current = vectors.select(root.alias("cell"), F.lit((1 << 62)).alias("above"), "node", "n", "unit", F.lit(True).alias("home"))
    finished = []
    while True:
        sizes = current.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), F.count_if("home").alias("homes"))
        sized = current.join(sizes.filter("homes > 0"), "cell")  # in others nothing is compared
        is_open = (F.col("homes") > cell_rows) & (F.col("homes") <= STUCK * F.col("above"))
        finished.append(sized.filter(~is_open))
        chunks = F.ceil(F.col("rows") / CHUNK_ROWS)
        to_split = sized.filter(is_open).withColumns({"chunks": chunks, "chunk": F.pmod(F.xxhash64("node"), chunks)})
        # A hash lets through about as many home vectors as wanted: all of a cell that has no more, and never none.
        wanted = F.least(F.lit(FANOUT), F.ceil(2 * F.col("homes") / cell_rows)) * SAMPLE_PER_CENTRE
        sample = to_split.filter("home").filter(F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1 << 30)) < wanted / F.col("homes") * (1 << 30))
        fitted = sample.groupBy("cell").applyInArrow(_fitter(cell_rows), "cell string, chunks bigint, centres array<double>")
        fitted = written(fitted, "centres")
        if fitted.isEmpty():
            return _union(finished)
        dealt = fitted.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1))).drop("chunks")
        grouped = to_split.groupBy("cell", "chunk").cogroup(dealt.groupBy("cell", "chunk"))
        current = written(grouped.applyInArrow(partial(_assign, limit=limit), _ROWS), "cells")


def _union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def _comparer(limit: float) -> Callable:
    """Links of the home vectors of block ``a`` with block ``b``, and a forest of these links."""

    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        _, a, b = (one.as_py() for one in key)
        unit = _matrix(rows["unit"])
        node, weight = rows["node"].to_numpy(), rows["n"].to_numpy()
        left, right = (np.flatnonzero(pc.equal(rows[name], one).fill_null(False)) for name, one in (("own_a", a), ("own_b", b)))
        linked = unit[left] @ unit[right].T >= limit
        links = np.zeros(len(node), np.int64)
        links[left] = linked @ weight[right]
        x, y = np.nonzero(linked)
        root = local_roots(len(node), left[x], right[y])
        told = (links > 0) | (root != np.arange(len(node)))
        return pa.table({"node": node[told], "links": links[told], "root": node[root[told]]})

    return compare


def compared(placed: DataFrame, limit: float = LIMIT, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``node``, ``links`` and ``root`` of every block of every cell; written."""
    def numbers(count: str) -> Column:
        return F.sequence(F.lit(0).cast("bigint"), F.col(count) - 1)

    # Home vectors are in one block of those compared; each block of those is compared with every block of the cell.
    homes, blocks = F.ceil(F.col("homes") / block_rows), F.ceil(F.col("rows") / block_rows)
    number = F.xxhash64("node", F.lit(2))
    placed = placed.withColumns({"n_a": homes, "n_b": blocks})
    placed = placed.withColumns({"own_a": F.when(F.col("home"), F.pmod(number, F.col("n_a"))), "own_b": F.pmod(number, F.col("n_b"))})
    as_other = F.transform(numbers("n_a"), lambda one: F.struct(one.alias("a"), F.col("own_b").alias("b")))
    as_home = F.transform(numbers("n_b"), lambda one: F.struct(F.col("own_a").alias("a"), one.alias("b")))
    ways = F.when(F.col("home"), F.array_union(as_home, as_other)).otherwise(as_other)
    dealt = placed.withColumn("way", F.explode(ways))
    dealt = dealt.select("cell", "way.a", "way.b", "own_a", "own_b", "node", "n", "unit")
    found = dealt.groupBy("cell", "a", "b").applyInArrow(_comparer(limit), "node bigint, links bigint, root bigint")
    return written(found, "compared")


def near_duplicates(
    vectors: DataFrame,
    ident: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    limit: float = LIMIT,
    cell_rows: int = CELL_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Every row with its id, ``n_links``, ``component_id`` and ``kept``."""
    nodes = distinct_vectors(vectors, ident, vector, label)
    found = compared(cells(nodes, limit, cell_rows), limit, block_rows)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    rooted = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).filter("a <> b"))
    grouped = nodes.select("node", "least").join(rooted, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    told = (
        nodes.select("node", "label", "vector")
        .join(links, "node", "left")
        .join(grouped.select("node", "root"), "node")
        .join(least, "root")
        .select(F.col("label").alias("_label"), F.col("vector").alias("_vector"), (F.col("links") - 1).alias("n_links"), "component_id", F.lit(True).alias("known"))
    )
    rows = vectors.select(vectors[ident].alias(ident), vectors[label].alias("_label"), vectors[vector].alias("_vector"))
    component = F.when(F.col("known"), F.col("component_id")).otherwise(F.col(ident))
    return rows.join(told, ["_label", "_vector"], "left").select(
        ident,
        F.coalesce("n_links", F.lit(0)).cast(LongType()).alias("n_links"),
        component.alias("component_id"),
        F.col(ident).eqNullSafe(component).alias("kept"),
    )
