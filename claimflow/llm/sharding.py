"""Sharding by a hierarchical weighted hash tree (DataFrame functions only).

A row descends region, rack and shard levels. At each node every child draws
``-ln(u) / weight`` with ``u`` from an MD5 digest of the row's key and the child's path;
the smallest draw wins, so a child is taken in proportion to its weight and a
change of one child's weight changes no other child's draw. Movement is
confined to the subtrees whose weights change: a new region takes rows only
into itself, and changing a shard's weight leaves all draws between other
regions, racks and shards as they were.

Rows are placed by their id alone; nothing is shuffled to place them. Slots
(gapless numbers inside a shard) come from hashed sub-buckets: rows are
numbered inside a sub-bucket, and the counts of the sub-buckets, a table of
``shards x SUB_BUCKETS`` rows at most, give each one its offset. So no task
holds a whole shard.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sub-buckets of a shard for numbering rows.
SUB_BUCKETS = 1024


@dataclass(frozen=True)
class Node:
    """A node of the tree: a shard (with a number) or a region/rack with children."""

    name: str
    weight: float
    shard: int | None = None
    children: tuple["Node", ...] = field(default=())


def inner(name: str, children: list[Node]) -> Node:
    """A region or rack; its weight is the sum of its children's."""
    return Node(name, sum(c.weight for c in children), None, tuple(children))


def default_tree(shards: int, racks: int = 2, per_rack: int = 2, base: int = 8) -> Node:
    """``base`` shards as regions of ``racks`` racks of ``per_rack`` shards; every later shard opens a region.

    Opening a region is what keeps growth local: no existing subtree changes
    its weight, so rows move only into the new shard.
    """
    regions: list[Node] = []
    first = min(shards, base)
    for r in range(0, first, racks * per_rack):
        rows = []
        for k in range(r, min(r + racks * per_rack, first), per_rack):
            leaves = [Node(f"s{s}", 1.0, s) for s in range(k, min(k + per_rack, first))]
            rows.append(inner(f"k{k // per_rack}", leaves))
        regions.append(inner(f"r{r // (racks * per_rack)}", rows))
    for s in range(base, shards):
        regions.append(inner(f"r+{s}", [inner(f"k+{s}", [Node(f"s{s}", 1.0, s)])]))
    return inner("root", regions)


def draw(key: Column, path: str, weight: float) -> Column:
    """An exponential draw of rate ``weight`` from the first 52 bits of MD5 over path and key (never 0)."""
    bits = F.conv(F.left(F.md5(F.concat(F.lit(f"{path}:"), key).cast("binary")), F.lit(13)), 16, 10).cast("double")
    return -F.log((bits + 0.5) / float(1 << 52)) / F.lit(weight)


def descend(key: Column, node: Node, path: str = "") -> Column:
    """The shard number reached from ``node``. Children of weight 0 are never taken; ties go to the first child."""
    live = [c for c in node.children if c.weight > 0]
    if node.shard is not None:
        return F.lit(node.shard)
    if not live:
        raise ValueError(f"no child of {path or 'the root'} has a weight above 0")
    if len(live) == 1:
        return descend(key, live[0], f"{path}/{live[0].name}")
    draws = [draw(key, f"{path}/{c.name}", c.weight) for c in live]
    best = F.least(*draws)
    below = [descend(key, c, f"{path}/{c.name}") for c in live]
    out = F.when(draws[0] == best, below[0])
    for d, shard in zip(draws[1:], below[1:]):
        out = out.when(d == best, shard)
    return out


def shard_of(id_col: str, tree: Node) -> Column:
    """The shard of a row by its id (null ids share one key of their own)."""
    return descend(F.coalesce(F.col(id_col).cast("string"), F.lit("\x00null")), tree).cast("int")


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text (none for null) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def sub_bucket(order: list[str], buckets: int) -> Column:
    """A row's sub-bucket, from an MD5 digest of the columns as text (nulls left out)."""
    text = F.concat_ws(":", *[F.col(c).cast("string") for c in order])
    return F.pmod(F.conv(F.left(F.md5(text.cast("binary")), F.lit(8)), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def with_slots(placed: DataFrame, order: list[str], buckets: int = SUB_BUCKETS) -> DataFrame:
    """Add ``slot``: gapless from 0 inside each ``shard``, in order of sub-bucket, then ``order``."""
    b = placed.withColumn("_b", sub_bucket(order, buckets))
    counts = b.groupBy("shard", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from"))
    inside = F.row_number().over(Window.partitionBy("shard", "_b").orderBy(*order))
    # offsets: at most shards x buckets rows, whatever the input
    return (
        b.withColumn("_i", inside)
        .join(F.broadcast(offsets), ["shard", "_b"])
        .withColumn("slot", (F.col("_from") + F.col("_i") - 1).cast("long"))
        .drop("_b", "_i", "_from")
    )


def place(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per input row: id, size, text_crc32, shard, grown_shard, slot.

    The law is ``key``: id and shard count alone decide. Rows with equal ids
    share a shard and get slots of their own; null texts have size 1 and the
    checksum of the empty text. Other columns are ignored.
    """
    placed = docs.select(
        F.col(id_col),
        text_size(F.col(text_col)).alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
        shard_of(id_col, default_tree(shards)).alias("shard"),
        shard_of(id_col, default_tree(shards + 1)).alias("grown_shard"),
    )
    return with_slots(placed, [id_col, "size", "text_crc32"])
