"""Placing rows in shards with a hierarchical weighted hash tree.

Shards hang below racks and racks below regions. A row descends from the root and at each level
takes the child with the smallest draw ``-ln(u) / weight``, where ``u`` is a hash of the row's key and
the child's name and ``weight`` is the total weight below that child. A child is thus taken in
proportion to its weight, and a draw depends on nothing but the key and that child. If a weight
changes, the draws of one child per level change, so rows move only into (or only out of) the
subtrees whose weights grew (or shrank); all others keep their place. A shard that is added as a
region of its own takes rows only into itself.

The tree is a small driver-side description that is compiled to one SQL expression per level. Rows
are numbered within their shard without gathering a shard in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_PARTITION_SHIFT = 33


@dataclass(frozen=True)
class Leaf:
    """One shard, its place in the tree and its weight, which must be positive."""

    region: str
    rack: str
    shard: int
    weight: float = 1.0


def regular_tree(shards: int, regions: int = 2, racks: int = 2) -> list[Leaf]:
    """Shards 0 to ``shards - 1`` of equal weight, in order, spread evenly over racks of regions."""
    per_region = -(-shards // regions)
    per_rack = -(-per_region // racks)
    return [Leaf(f"region{s // per_region}", f"rack{s % per_region // per_rack}", s) for s in range(shards)]


def grow(tree: Sequence[Leaf], weight: float | None = None) -> list[Leaf]:
    """The tree with one more shard, in a region of its own, by default of average weight."""
    shard = max(leaf.shard for leaf in tree) + 1
    mean = sum(leaf.weight for leaf in tree) / len(tree)
    return [*tree, Leaf(f"region+{shard}", "rack0", shard, weight or mean)]


def _draw(key: Column, name: str, weight: float) -> Column:
    # The upper 53 bits of a 64-bit hash of key and name, moved to the middle of their step: 0 < u < 1.
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 11)
    return -F.ln((bits.cast("double") + 0.5) / float(1 << 53)) / F.lit(weight)


def _descend(key: Column, path: str, nodes: list[tuple[Sequence[str], Leaf]]) -> Column:
    """The shard below one node. ``nodes``: what is left of each leaf's path, with the leaf."""
    if len(nodes) == 1:
        return F.lit(nodes[0][1].shard)
    children: dict[str, list[tuple[Sequence[str], Leaf]]] = {}
    for steps, leaf in nodes:
        children.setdefault(steps[0], []).append((steps[1:], leaf))
    names = sorted(children)
    below = [_descend(key, f"{path}/{n}", children[n]) for n in names]
    if len(names) == 1:
        return below[0]
    draws = [_draw(key, f"{path}/{n}", sum(leaf.weight for _, leaf in children[n])) for n in names]
    # Equal draws fall to the first child by name.
    least = F.least(*draws)
    taken = F.when(draws[0] == least, below[0])
    for draw, shard in zip(draws[1:], below[1:], strict=True):
        taken = taken.when(draw == least, shard)
    return taken


def shard_of(key: Column, tree: Sequence[Leaf]) -> Column:
    """The shard a key falls to. A null key is a key like any other."""
    key = F.coalesce(key.cast("string"), F.lit("\0null"))
    return _descend(key, "", [((leaf.region, leaf.rack, str(leaf.shard)), leaf) for leaf in tree])


def place(df: DataFrame, tree: Sequence[Leaf], key_col: str) -> DataFrame:
    """All rows with ``shard`` (int) and ``slot`` (long), which counts a shard's rows from 0 without gaps.

    Rows with equal keys, repeated rows among them, go to one shard and get a slot each. Columns called
    ``shard`` or ``slot`` are replaced. The placement is written once, so that slots stay as they are if
    a task runs again; slots are counted per written partition, and each partition's count is added.
    """
    kept = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    # The caller's columns travel in one struct, so none of their names can clash.
    row = F.struct(F.lit(True).alias("kept"), *kept).alias("row")
    placed = materialize(df.select(row, shard_of(df[key_col], tree).alias("shard"), F.monotonically_increasing_id().alias("at")), "shards")
    part = F.shiftright("at", _PARTITION_SHIFT)
    counts = placed.groupBy("shard", part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("part", "shard").orderBy("at")
    numbered = placed.withColumn("part", part).withColumn("in_part", F.row_number().over(within) - 1)
    slot = (F.col("in_part") + F.col("before")).cast("long")
    return numbered.join(offsets, ["part", "shard"]).select(*[F.col("row")[c].alias(c) for c in kept], "shard", slot.alias("slot"))


def digest(df: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents in ``shards`` shards by the law ``key``: the id and the tree alone decide.

    ``size`` is one more than the text's UTF-8 bytes; a null text counts as an empty one, and its
    ``text_crc32`` is 0 like that of an empty text. ``grown_shard`` is the shard after adding one more.
    """
    tree = regular_tree(shards)
    content = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = df.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col(id_col), grow(tree)).alias("grown_shard"),
    )
    return place(rows, tree, "doc_id").select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
