"""Sharding by a hierarchical weighted hash tree.

Shards hang in racks and racks in regions. Every node has a weight, the sum of its shards'
weights, and an exponential draw ``-ln(u) / weight`` from a hash of (key, level, node). A key
descends: the least draw among the regions, then among the racks of that region alone, then
among the shards of that rack alone; nothing below another node is drawn. A changed weight
changes the draws of the nodes above that shard and of no others, so rows move only into or
out of those subtrees, level by level; elsewhere no draw changes.

A shard that is added to a standing tree opens a region of its own (``grow``), so it alone
takes rows. The regular tree of 25 shards is that of 24 after such a growth.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SHARDS_PER_RACK, RACKS_PER_REGION = 4, 2
#: Rows of one bucket within a shard, within which slots are counted by a sort.
ROWS_PER_BUCKET = 4096
REGION, RACK, SHARD = range(3)

Tree = list[list[list[int]]]


def tree(n_shards: int, per_rack: int = SHARDS_PER_RACK, per_region: int = RACKS_PER_REGION) -> Tree:
    """The regular tree: regions of racks of shards, filled in order."""
    if n_shards < 1:
        raise ValueError("at least one shard is needed")
    racks = [list(range(i, min(i + per_rack, n_shards))) for i in range(0, n_shards, per_rack)]
    return [racks[i : i + per_region] for i in range(0, len(racks), per_region)]


def grow(nodes: Tree) -> Tree:
    """The tree with one shard more, in a rack and a region of its own."""
    return [*nodes, [[1 + max(s for region in nodes for rack in region for s in rack)]]]


def weights_of(nodes: Tree, weights: dict[int, float] | None) -> dict[int, float]:
    """The weight of every shard, 1 where none is given."""
    full = {s: float((weights or {}).get(s, 1.0)) for region in nodes for rack in region for s in rack}
    if any(not math.isfinite(w) or w < 0 for w in full.values()) or not any(full.values()):
        raise ValueError("weights must be finite, not negative, and not all zero")
    return full


def descend(key: Column, nodes: Tree, weights: dict[int, float] | None = None, seed: int = 7) -> Column:
    """The shard of each key: one weighted draw among siblings at each level, below the chosen node only.

    A node is named by its level and its number, counted over the whole tree in order, so a
    tree that grows renames none. Nodes without weight are never drawn.
    """
    w = weights_of(nodes, weights)
    racks = [rack for region in nodes for rack in region]
    first_rack = [sum(map(len, nodes[:r])) for r in range(len(nodes))]

    def least(level: int, siblings: Column) -> Column:
        def draw(c: Column) -> Column:
            bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(level), c["node"], F.lit(seed)), 11).cast("double")
            return F.struct((-F.log((bits + 0.5) / float(1 << 53)) / c["weight"]).alias("draw"), c["node"].alias("node"))

        return F.array_min(F.transform(siblings, draw))["node"]

    def family(members: list[tuple[int, float]]) -> Column:
        some = [F.struct(F.lit(n).alias("node"), F.lit(x).alias("weight")) for n, x in members if x]
        return F.array(*some) if some else F.lit(None).cast("array<struct<node:int,weight:double>>")

    def total(rack: list[int]) -> float:
        return math.fsum(w[s] for s in rack)

    regions = family([(r, math.fsum(total(rack) for rack in region)) for r, region in enumerate(nodes)])
    racks_of = F.array(*(family([(first_rack[r] + k, total(rack)) for k, rack in enumerate(region)]) for r, region in enumerate(nodes)))
    shards_of = F.array(*(family([(s, w[s]) for s in rack]) for rack in racks))
    return least(SHARD, F.get(shards_of, least(RACK, F.get(racks_of, least(REGION, regions)))))


def with_shards(rows: DataFrame, key: Column, n_shards: int, weights: dict[int, float] | None = None, seed: int = 7, nodes: Tree | None = None) -> DataFrame:
    """``rows`` with ``shard`` and, with one shard more (of weight 1 if none is given), ``grown_shard``.

    ``nodes`` is the tree that stands; the regular one of ``n_shards`` if none is given.
    """
    standing = nodes or tree(n_shards)
    return rows.withColumns({"shard": descend(key, standing, weights, seed).cast("int"), "grown_shard": descend(key, grow(standing), weights, seed).cast("int")})


def assign(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", weights: dict[int, float] | None = None, seed: int = 7) -> DataFrame:
    """Each row's shard, its gapless slot there and its shard with one shard more.

    Every row of ``docs`` gives one row: (id, size, text_crc32, law, shard, slot, grown_shard).
    A null text counts as empty; a null id hashes as the empty string. Repeated rows share a
    shard and take neighbouring slots. An empty table gives none. Other columns are dropped,
    so their names can't clash.

    Slots: rows fall into hash buckets within a shard, small enough to be sorted each by one
    task; a bucket begins where the counts of those before it end. Only counts, never rows,
    are gathered by shard.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(text).alias("text_crc32"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    n_buckets = max(16, math.ceil(docs.count() / n_shards / ROWS_PER_BUCKET))
    rows = with_shards(rows, key, n_shards, weights, seed).withColumn("bucket", F.pmod(F.xxhash64(key, F.col("text_crc32"), F.lit("bucket")), F.lit(n_buckets)).cast("int"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n")).select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("rank", F.row_number().over(within) - 1)
        .join(begins, ["shard", "bucket"])
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("begin") + F.col("rank")).cast("long").alias("slot"), "grown_shard")
    )
