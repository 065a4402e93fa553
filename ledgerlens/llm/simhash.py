"""SimHash near-duplicates with bit-sliced comparison.

Two 64-bit fingerprints that differ in at most r bits agree on at least one of r + 1 blocks of bits,
so fingerprints are dealt to one bucket per block value. A bucket is compared bit-sliced: its
fingerprints are stored as 64 vertical bit planes, 64 fingerprints to a machine word, and one
fingerprint is compared with a whole word at a time. Differing planes are added into three counter
planes by carry-save addition, with a fourth for "more than r"; a word whose 64 distances all exceed
the radius is abandoned, and most are after a few planes.

Only distinct fingerprints are compared, so any number of equal texts is one entry. More blocks than
r + 1 are used as the table grows (two fingerprints then agree on several blocks at once), which keeps
buckets small without losing a pair; a bucket that is still large is cut into tiles, each compared
with each other tile in a task of its own. A task returns a spanning forest of what it linked,
never all pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import id_and_text, lower_words_of, map_text
from .components import components

RADIUS = 3
SHINGLE = 3
SEED = 42
TILE = 16_384
# Tables up to this many fingerprints use radius + 1 blocks, then one more block for each such factor.
ROWS_PER_BLOCK_STEP = 1 << 24


def shingle_hashes(words: list[bytes], size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Hash of each run of ``size`` words, or of all words if there are fewer; none without words."""
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.append(0, ends[:-1])[: len(words) - size + 1].tolist()
    stops = (ends[size - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts, stops, strict=True)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit by bit, whether more than half of the hashes have it set."""
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)].astype(">u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes))
    return int.from_bytes(bits.tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, fingerprint)`` of every row, as a bigint with the same bits.

    A null, empty or blank text has fingerprint zero. Repeated rows get a row each; other columns are
    ignored.
    """

    def rows(texts):
        made = [fingerprint(shingle_hashes(lower_words_of(t))) for t in texts]
        return [pa.array(np.array(made, np.uint64).view(np.int64))]

    fields = [("fingerprint", T.LongType(), pa.int64())]
    return map_text(id_and_text(df, id_col, text_col), fields, rows).withColumnRenamed("id", id_col)


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """64 planes of packed bits: bit j of word w of plane p is bit p of fingerprint 64 w + j."""
    padded = np.zeros(-(-len(prints) // 64) * 64, np.uint64)
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def near_pairs(left: np.ndarray, right: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of fingerprints that differ in at most ``radius`` (3 at most) bits, by bit-sliced counting."""
    if radius > 3:
        raise ValueError("two counter planes hold distances of up to 3")
    planes = bit_planes(right)
    n_words = planes.shape[1]
    whole = np.uint64(0xFFFFFFFFFFFFFFFF)
    last = np.full(n_words, whole)
    if len(right) % 64:
        last[-1] = np.uint64((1 << (len(right) % 64)) - 1)
    found_left, found_right = [], []
    step = max(1, (1 << 16) // max(n_words, 1))
    for start in range(0, len(left), step):
        own = left[start : start + step]
        # Every (left fingerprint, word of 64 right ones) that is not abandoned yet.
        i = np.repeat(np.arange(len(own)), n_words)
        w = np.tile(np.arange(n_words), len(own))
        ones, twos = np.zeros(len(i), np.uint64), np.zeros(len(i), np.uint64)
        over = ~last[w]
        for p in range(64):
            spread = np.uint64(0) - ((own >> np.uint64(p)) & np.uint64(1))
            differs = planes[p][w] ^ spread[i]
            carry = ones & differs
            ones ^= differs
            over |= twos & carry
            twos ^= carry
            if p % 8 == 7 and p < 63:
                live = over != whole
                if not live.all():
                    i, w, ones, twos, over = i[live], w[live], ones[live], twos[live], over[live]
                    if not len(i):
                        break
        if radius < 3:
            distance_over = {2: ones & twos, 1: twos, 0: ones | twos}[radius]
            over |= distance_over
        hit = np.flatnonzero(over != whole)
        if len(hit):
            bits = np.unpackbits((~over[hit]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, bit = np.nonzero(bits)
            found_left.append(start + i[hit[row]])
            found_right.append(w[hit[row]] * 64 + bit)
    none = np.empty(0, np.int64)
    return (np.concatenate(found_left), np.concatenate(found_right)) if found_left else (none, none)


def _forest(left: np.ndarray, right: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Least member of the component of each of ``n`` entries that is linked to a smaller one."""
    root = np.arange(n)
    while True:
        a, b = root[left], root[right]
        least = np.minimum(a, b)
        before = root.copy()
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        while True:
            jumped = root[root]
            if (jumped == root).all():
                break
            root = jumped
        if (root == before).all():
            break
    members = np.flatnonzero(root != np.arange(n))
    return members, root[members]


def _blocks(rows: int, radius: int) -> tuple[list[int], int]:
    """Bit positions at which blocks begin, and how many blocks a pair within the radius shares at least."""
    count = radius + 1
    while rows > ROWS_PER_BLOCK_STEP << (8 * (count - radius - 1)) and count < 16:
        count += 1
    return [64 * k // count for k in range(count + 1)], count - radius


def link(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges ``(a, b)`` that connect every two of the distinct ``fingerprint`` values within the radius.

    Within a bucket a spanning forest is returned; together with other buckets it connects the same
    fingerprints as all pairs would.
    """
    prints = prints.select("fingerprint").filter("fingerprint IS NOT NULL").distinct()
    prints = materialize(prints, "fingerprints")
    edges, shared = _blocks(prints.count(), radius)
    masks = [sum(((1 << (edges[k + 1] - edges[k])) - 1) << edges[k] for k in own) for own in combinations(range(len(edges) - 1), shared)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    dealt = prints.select(
        "fingerprint", F.explode(F.array(*[F.struct(F.lit(k).alias("t"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("v")) for k, m in enumerate(signed)])).alias("k")
    ).select("fingerprint", "k.t", "k.v")
    sizes = dealt.groupBy("t", "v").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    own = F.pmod(F.xxhash64("fingerprint"), tiles).cast("int")
    tiled = dealt.join(sizes, ["t", "v"]).withColumns({"tiles": tiles, "own": own})
    # A tile takes part in one comparison with each tile, itself included.
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1),
        lambda other: F.struct(F.least("own", other).alias("i"), F.greatest("own", other).alias("j")),
    )
    tiled = tiled.select("fingerprint", "t", "v", "own", F.explode(pairs).alias("ij")).select("fingerprint", "t", "v", "own", "ij.i", "ij.j")

    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def compare(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        prints = group.column("fingerprint").to_numpy()
        own, i = group.column("own").to_numpy(), group.column("i").to_numpy()
        order = np.argsort(prints)
        prints, second = prints[order], (own != i)[order]
        bits = prints.view(np.uint64)
        if second.any():
            one, two = np.flatnonzero(~second), np.flatnonzero(second)
            a, b = near_pairs(bits[one], bits[two], radius)
            a, b = one[a], two[b]
        else:
            a, b = near_pairs(bits, bits, radius)
        members, roots = _forest(a, b, len(prints))
        return prints[members], prints[roots]

    # One call for each tile pair would be slow; a task goes through many of them, sorted.
    packed = tiled.repartition(F.col("t"), F.col("v"), F.col("i"), F.col("j")).sortWithinPartitions("t", "v", "i", "j")

    def batches(stream):
        held: list[pa.RecordBatch] = []

        def cut(table: pa.Table, last: bool):
            """Complete groups of the table, and what may go on in the next batch."""
            keys = np.stack([table.column(c).to_numpy() for c in ("t", "v", "i", "j")])
            change = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            bounds = [0, *change.tolist(), table.num_rows]
            groups = list(zip(bounds[:-1], bounds[1:], strict=True))
            rest = None if last else groups.pop()
            return groups, rest

        def compared(table, groups):
            out_a, out_b = [], []
            for a, b in groups:
                members, roots = compare(table.slice(a, b - a))
                out_a.append(members)
                out_b.append(roots)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], schema.names)

        for batch in stream:
            held.append(batch)
            table = pa.Table.from_batches(held).combine_chunks()
            if not table.num_rows:
                held = []
                continue
            groups, rest = cut(table, last=False)
            if groups:
                yield compared(table, groups)
            held = table.slice(rest[0]).to_batches()
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            if table.num_rows:
                yield compared(table, cut(table, last=True)[0])

    return packed.select("fingerprint", "t", "v", "own", "i", "j").mapInArrow(batches, schema)


def near_duplicates(df: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, fingerprint, component_id)`` of every row.

    ``fingerprint`` is 16 lowercase hex digits; ``component_id`` is the smallest id that can be reached
    over links of at most ``radius`` differing bits. Rows without words all have fingerprint zero and
    are linked like any others; so are repeated rows. A null id takes part in links but names no
    component unless it is alone.
    """
    prints = materialize(fingerprints(df, id_col, text_col).toDF("id", "fingerprint"), "simhash")
    found = components(link(prints, radius))
    grouped = prints.join(found, prints["fingerprint"] == found["vertex"], "left").select(
        "id", "fingerprint", F.coalesce("component", "fingerprint").alias("component")
    )
    least = grouped.groupBy("component").agg(F.min("id").alias("component_id"))
    return grouped.join(least, "component").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def representatives(df: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row, with all columns, of each group of ``near_duplicates``: the one with the smallest id.

    Rows with one id are documents of their own; of those the one with the smallest hash of its text
    stands first, and exact repeats of it are dropped.
    """
    key = F.struct(df[id_col].alias("id"), F.xxhash64(df[text_col]).alias("h"))
    keyed = df.select(key.alias("id"), df[text_col].alias("text"))
    prints = materialize(fingerprints(keyed, "id", "text").toDF("id", "fingerprint"), "simhash")
    return first_of_groups(df, prints, components(link(prints, radius)), id_col, text_col)


def first_of_groups(df: DataFrame, prints: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The first row of each component, given the ``fingerprint`` of each ``id``, a struct of id and hash of the text."""
    grouped = prints.join(found, prints["fingerprint"] == found["vertex"], "left").select("id", F.coalesce("component", "fingerprint").alias("component"))
    # Structs compare by their fields in order, and a null id before all others.
    kept = grouped.groupBy("component").agg(F.min("id").alias("id")).select(F.col("id.id").alias("k"), F.col("id.h").alias("h"))
    # The caller's columns travel in one struct, so none of their names can clash.
    rows = df.select(df[id_col].alias("k"), F.xxhash64(df[text_col]).alias("h"), F.struct(*[df[c] for c in df.columns]).alias("row"))
    same = rows["k"].eqNullSafe(kept["k"]) & (rows["h"] == kept["h"])
    return rows.join(kept, same, "left_semi").dropDuplicates(["k", "h"]).select("row.*")
