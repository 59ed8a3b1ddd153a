"""K-d tree sharding: shards of near equal bytes that are boxes of the documents' metadata.

The documents are split again and again. A split takes the dimension that is widest among the node's documents, in
shares of its width over all documents, orders the documents by it, and cuts where the bytes before reach the share of
the leaves on the left. Order and running bytes are found over ranges of documents, so no node is gathered in one task.
Documents equal in the dimension are ordered by a hash of their text, then by id: equal texts are neighbours. They
go to one side together while their bytes are at most ``TOGETHER`` of a leaf; heavier groups are cut by rows.

Defined cases: a null text has size 1 and checksum 0, as an empty one; null metadata comes before all values and has
no width; ids may be null or repeat, each row has its own slot; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import written
from tidemark.operators import ranges

TOGETHER = 0.02
PREFIX_BYTES = 7


def text_place(value: Column) -> Column:
    """An integer in the order of the first bytes of a string."""
    digits = F.rpad(F.hex(F.substring(value.cast("binary"), 1, PREFIX_BYTES)), 2 * PREFIX_BYTES, "0")
    return F.conv(digits, 16, 10).cast("bigint")


def kd_shards(
    docs: DataFrame,
    dimensions: Mapping[str, Column],
    target_bytes: int | None = None,
    shards: int | None = None,
    ident: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every row's ``doc_id``, ``size``, ``text_crc32``, ``shard`` and ``slot`` in it.

    There are as many leaves as documents of ``target_bytes`` would need, or ``shards``. ``dimensions`` are whole number columns of
    ``docs``, first ones first where widths are equal.
    """
    body = F.coalesce(docs[text], F.lit("")).cast("binary")
    axes = [f"x{i}" for i in range(len(dimensions))]
    rows = written(
        docs.select(
            docs[ident].alias("doc_id"),
            (F.octet_length(body) + 1).cast("bigint").alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.xxhash64(body).alias("tie"),
            *[column.cast("bigint").alias(axis) for axis, column in zip(axes, dimensions.values(), strict=True)],
        ),
        "kd-rows",
    )
    limits = [F.max(axis).cast("double") - F.min(axis) for axis in axes]
    total, *widths = rows.agg(F.sum("size"), *limits).first()
    leaves = shards or max(1, -(-(total or 0) // target_bytes))
    rows = rows.select("*", F.lit(0).alias("node"), F.lit(leaves).alias("leaves"))
    while leaves > 1:
        rows = _split(rows, axes, widths)
        leaves = -(-leaves // 2)
    numbered = ranges.number_rows(rows, ["node"], ["tie", "doc_id"], "slot")
    return numbered.select("doc_id", "size", "text_crc32", F.col("node").cast("int").alias("shard"), "slot")


def _split(rows: DataFrame, axes: list[str], widths: list[float | None]) -> DataFrame:
    """Every node with more than one leaf cut in two, the left with the smaller half of its leaves."""
    shares = [
        F.coalesce((F.max(axis).cast("double") - F.min(axis)) / F.lit(width or 1.0), F.lit(0.0))
        for axis, width in zip(axes, widths, strict=True)
    ]
    share = F.array(*shares)
    nodes = rows.groupBy("node").agg(
        F.sum("size").alias("node_bytes"), F.array_position(share, F.array_max(share)).cast("int").alias("axis")
    )
    # One row per node, at most as many as there are shards, hence the broadcast.
    placed = rows.join(F.broadcast(nodes), "node").withColumn("x", F.element_at(F.array(*axes), F.col("axis"))).drop("axis")
    left = F.floor(F.col("leaves") / 2)
    cut = F.col("node_bytes") * left / F.col("leaves")
    placed = written(ranges.running(placed, ["node"], ["x", "tie", "doc_id"], {"upto": F.col("size")}), "kd-level")
    # One row per node again: the group of equal texts that the cut falls into, and where it begins and ends.
    met = placed.filter(F.col("upto") >= cut).groupBy("node").agg(F.min(F.struct("upto", "x", "tie")).alias("met"))
    met = met.select("node", F.col("met.x").alias("met_x"), F.col("met.tie").alias("met_tie"))
    placed = placed.join(F.broadcast(met), "node", "left")
    in_group = F.col("x").eqNullSafe(F.col("met_x")) & (F.col("tie") == F.col("met_tie"))
    group = placed.filter(in_group).groupBy("node").agg(
        F.sum("size").alias("group_bytes"), F.min(F.col("upto") - F.col("size")).alias("group_start")
    )
    placed = placed.join(F.broadcast(group), "node", "left")
    light = in_group & (F.col("group_bytes") <= F.col("node_bytes") / F.col("leaves") * TOGETHER)
    middle = F.when(light, F.col("group_start") + F.col("group_bytes") / 2).otherwise(F.col("upto") - F.col("size") / 2)
    goes_left = (F.col("leaves") > 1) & (middle <= cut)
    goes_right = (F.col("leaves") > 1) & ~goes_left
    return placed.select(
        "doc_id", "size", "text_crc32", "tie", *axes,
        F.when(goes_right, F.col("node") + left).otherwise(F.col("node")).cast("int").alias("node"),
        F.when(goes_left, left).when(goes_right, F.col("leaves") - left).otherwise(F.col("leaves")).cast("int").alias("leaves"),
    )
