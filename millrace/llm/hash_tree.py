"""Sharding by a hierarchical weighted hash tree.

A row descends from the root through region and rack to a shard. At each level every child draws a
number from a hash of the row and the child, scaled by the child's weight, and the smallest draw
wins, so a child gets rows in proportion to its weight. A draw hangs on nothing but the row, the
child and the child's weight: a changed weight moves rows only into or out of the subtrees that hold
the change.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import constant, settle, unit_draw

PER_RACK = 4
RACKS_PER_REGION = 2
#: Bytes that a record takes besides its text.
RECORD_BYTES = 16
#: Rows of a shard that one task numbers.
SLOT_ROWS = 50_000


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def layout(shards: int, planned: int) -> list[Leaf]:
    """The tree of ``shards`` shards of which ``planned`` stood when it was laid out.

    Planned shards stand four to a rack and two racks to a region. Each shard added since is a region
    of its own, so it draws against whole regions and no other subtree's weight changes.
    """
    if not 0 < planned <= shards:
        raise ValueError("the planned shards are at least one and at most all")
    leaves = []
    for s in range(planned):
        rack = s // PER_RACK
        leaves.append(Leaf(rack // RACKS_PER_REGION, rack, s))
    regions, racks = leaves[-1].region + 1, leaves[-1].rack + 1
    return leaves + [Leaf(regions + i, racks + i, planned + i) for i in range(shards - planned)]


def _draw(key: Column, level: str, node: Column, weight: Column) -> Column:
    return -F.log(unit_draw(level, node.cast("string"), key)) / weight


def _choose(key: Column, level: str, children: Column) -> Column:
    """The child with the smallest draw; children with no weight never win against others."""
    draws = F.transform(
        children,
        lambda c: F.struct(
            F.when(c["weight"] > 0, _draw(key, level, c["node"], c["weight"])).otherwise(float("inf")).alias("draw"),
            c["node"].alias("node"),
        ),
    )
    return F.array_min(draws)["node"]


def _weights(leaves: list[Leaf], of, among) -> dict[int, float]:
    total: dict[int, float] = {}
    for leaf in leaves:
        if among(leaf):
            total[of(leaf)] = total.get(of(leaf), 0.0) + leaf.weight
    return total


def assign(key: Column, leaves: list[Leaf]) -> Column:
    """The shard of a key (text; NULL counts as a key of its own, the empty text).

    Region, rack and shard numbers of the tree are 0, 1, 2 ... and each is used once.
    """
    key = F.coalesce(key, F.lit(""))
    node_type = "array<struct<node:int,weight:double>>"

    def nodes(weights: dict[int, float]) -> list[dict]:
        return [{"node": n, "weight": w} for n, w in sorted(weights.items())]

    regions = _weights(leaves, lambda x: x.region, lambda x: True)
    racks = [nodes(_weights(leaves, lambda x: x.rack, lambda x, r=r: x.region == r)) for r in sorted(regions)]
    number = sorted({x.rack for x in leaves})
    shards = [nodes(_weights(leaves, lambda x: x.shard, lambda x, k=k: x.rack == k)) for k in number]
    region = _choose(key, "region", constant(nodes(regions), node_type))
    rack = _choose(key, "rack", F.get(constant(racks, f"array<{node_type}>"), region))
    return _choose(key, "shard", F.get(constant(shards, f"array<{node_type}>"), rack))


def shard_documents(docs: DataFrame, shards: int = 40, planned: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document.

    ``size`` is the UTF-8 bytes of the text (none for NULL) and 16; ``text_crc32`` is NULL for a NULL
    text. The law is ``key``: shard and ``grown_shard``, the shard with one more, hang on doc_id and
    the number of shards only, and the one more takes rows only into itself. ``slot`` numbers the rows of
    a shard from 0 without gaps, in the order of a hash of the row; equal rows take neighbouring
    slots. An empty table gives no rows; other columns are not looked at.

    Rows are written once without their texts, counted by shard and beginning of the hash, and
    numbered within those pieces, so no task holds a shard.
    """
    planned = planned or shards
    key = F.col("doc_id").cast("string")
    rows = settle(
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + RECORD_BYTES).cast("long").alias("size"),
            F.crc32("text").alias("text_crc32"),
            assign(key, layout(shards, planned)).alias("shard"),
            assign(key, layout(shards + 1, planned)).alias("grown_shard"),
        ),
        "sharded",
    )
    order = F.md5(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("doc_id", "text_crc32", "size")]))
    per_shard = rows.groupBy("shard").count().agg(F.max("count")).first()[0] or 1
    digits = 1
    while per_shard / 16**digits > SLOT_ROWS / 8:
        digits += 1
    rows = rows.withColumn("_order", order).withColumn("_piece", F.substring("_order", 1, digits))
    before = Window.partitionBy("shard").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("shard", "_piece").agg(F.count("*").alias("_n"))
    starts = counts.select("shard", "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("shard", "_piece").orderBy("_order")
    return rows.withColumn("_rank", F.row_number().over(within)).join(starts, ["shard", "_piece"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("_start") + F.col("_rank") - 1).alias("slot"), "grown_shard",
    )
