"""MinHash near-duplicates with circulant permutations.

All coordinates of a signature come from two permutations of the universe of 32-bit numbers: the first deals
shingles to places, the second is applied after shifting the places round by k for coordinate k. Coordinates
are cut into bands, and documents that agree on a band share a bucket.

Links are confirmed on the whole sets. In every round each document is compared with one leader of its buckets
that is not yet in its component, the one it shares most buckets with, so a round compares as many pairs
as there are documents. Buckets whose members are then still apart are compared whole: cut into
tiles of bounded size, each pair of documents in the first bucket they share, by products of
incidence matrices inside a task. A task returns a spanning forest of what it confirmed, never all pairs.

Documents with equal sets are one vertex, named by a 128-bit digest of the set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import lower_words_of, slices_by_bytes
from .components import components

SHINGLE = 4
PERCENT = 80
# A pair at 0.8 shares no band with a probability below 4e-6.
BANDS = 24
PER_BAND = 4
ROUNDS = 2
# Documents compared with one copy of a leader, and weight of a tile: its documents plus a thousandth of their shingles.
PIECE = 4_096
TILE = 256
SHINGLES_AT_ONCE = 1 << 15
COLUMNS_AT_ONCE = 1 << 13
HELD_WORDS = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C13)


class _WordHashes(dict):
    """Hash of each word met, forgotten when there are very many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= HELD_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_sets(texts: list[str | None], size: int = SHINGLE, known: _WordHashes | None = None) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles; of the whole sequence if it has fewer words."""
    known = _WordHashes() if known is None else known
    sets = []
    for text in texts:
        words = lower_words_of(text)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(size, len(h))
        if width:
            rolled = h[: len(h) - width + 1].copy()
            for k in range(1, width):
                rolled *= _BASE
                rolled += h[k : len(h) - width + 1 + k]
            h = np.unique(_mixed(rolled))
        sets.append(h)
    return sets


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """One row of circulant minima for each set that is not empty."""
    out = np.empty((len(sets), coordinates), np.uint32)
    start = 0
    while start < len(sets):
        stop, held = start, 0
        while stop < len(sets) and (stop == start or held + len(sets[stop]) <= SHINGLES_AT_ONCE):
            held += len(sets[stop])
            stop += 1
        # The first permutation: the upper half of a mixed hash is the place of a shingle.
        places = (np.concatenate(sets[start:stop]) >> np.uint64(32)).astype(np.uint32)
        firsts = np.cumsum([0, *map(len, sets[start : stop - 1])])
        for k in range(coordinates):
            # The second one, of the places shifted round by k.
            z = places - np.uint32(k)
            z ^= z >> np.uint32(16)
            z *= np.uint32(0x7FEB352D)
            z ^= z >> np.uint32(15)
            z *= np.uint32(0x846CA68B)
            out[start:stop, k] = np.minimum.reduceat(z, firsts)
        start = stop
    return out


def buckets_of(signature: np.ndarray, bands: int = BANDS, per_band: int = PER_BAND) -> np.ndarray:
    """One key per band; equal keys of different bands do not occur but by chance, which adds a candidate at most."""
    keys = np.empty((len(signature), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(signature), band + 1, np.uint64)
        for c in range(band * per_band, (band + 1) * per_band):
            key = _mixed(key * _BASE + signature[:, c].astype(np.uint64))
        keys[:, band] = key
    return keys.view(np.int64)


def _digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def described(df: DataFrame, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, row, digest, n, buckets)`` of every row; texts without words have neither digest nor buckets.

    ``row`` is a hash of id and text, by which the text is found again.
    """
    rows = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text"))
    rows = rows.select("id", F.xxhash64("id", "text").alias("row"), "text")
    schema = T.StructType(
        [
            rows.schema["id"],
            T.StructField("row", T.LongType()),
            T.StructField("digest", T.BinaryType()),
            T.StructField("n", T.LongType()),
            T.StructField("buckets", T.ArrayType(T.LongType())),
        ]
    )

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in stream:
            for begin, end in slices_by_bytes(batch.column("text")):
                part = batch.slice(begin, end - begin)
                sets = shingle_sets(part.column("text").to_pylist(), size, known)
                some = [i for i, s in enumerate(sets) if len(s)]
                digests, keys = [None] * len(sets), [None] * len(sets)
                made = buckets_of(signatures([sets[i] for i in some], BANDS * PER_BAND))
                for i, row in zip(some, made, strict=True):
                    digests[i], keys[i] = _digest(sets[i]), row
                columns = [
                    part.column("id"),
                    part.column("row"),
                    pa.array(digests, pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(batches, schema)


def similar(both: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Whether an intersection is at least ``percent`` of the union of sets of these sizes, in whole numbers."""
    return 100 * both >= percent * (left + right - both)


def _texts(df: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(digest, text)``: one text for each ``(digest, row)`` that is wanted."""
    rows = df.select(F.xxhash64(df[id_col], df[text_col].cast("string")).alias("row"), df[text_col].cast("string").alias("text"))
    return rows.join(wanted, "row").dropDuplicates(["row"]).select("digest", "text")


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """Those of the pairs ``(a, b)`` that are similar; every document is read once per pair it is ``a`` of."""
    sizes = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / PIECE).cast("int").alias("pieces")).filter("pieces > 1")
    large = materialize(sizes, "large-leaders")
    pieces = F.coalesce("pieces", F.lit(1))
    sent = pairs.join(large, "b", "left").select(
        F.col("a").alias("digest"), F.col("b").alias("leader"), F.pmod(F.xxhash64("a"), pieces).cast("int").alias("piece"), F.lit(True).alias("follows")
    )
    leaders = pairs.select("b").distinct().join(large, "b", "left")
    leaders = leaders.select(F.col("b").alias("digest"), F.col("b").alias("leader"), F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"), F.lit(False).alias("follows"))
    met = sent.unionByName(leaders).join(texts, "digest").repartition("leader", "piece").sortWithinPartitions("leader", "piece", "follows")

    def compared(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, group, own = _WordHashes(), None, None
        for batch in stream:
            for begin, end in slices_by_bytes(batch.column("text")):
                part = batch.slice(begin, end - begin)
                left, right = [], []
                columns = [part.column(c).to_pylist() for c in ("digest", "leader", "piece", "follows")]
                sets = shingle_sets(part.column("text").to_pylist(), size, known)
                for digest, leader, piece, follows, shingles in zip(*columns, sets, strict=True):
                    if (leader, piece) != group:
                        group, own = (leader, piece), None
                    # A text that is not the one described, by a collision of row hashes, is passed over.
                    if _digest(shingles) != digest:
                        continue
                    if not follows:
                        own = shingles
                    elif own is not None:
                        at = np.minimum(np.searchsorted(own, shingles), len(own) - 1)
                        both = int((own[at] == shingles).sum())
                        if similar(both, len(own), len(shingles)):
                            left.append(digest)
                            right.append(leader)
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], ["a", "b"])

    return met.mapInArrow(compared, "a binary, b binary")


def _labelled(members: DataFrame, edges: DataFrame) -> DataFrame:
    """Members of buckets with the component they are in so far; buckets that are within one are left out."""
    found = components(edges)
    # Bucket rows are joined with the vertices that have links only.
    labelled = members.join(found.withColumnRenamed("vertex", "digest"), "digest", "left")
    labelled = materialize(labelled.select("bucket", "digest", F.coalesce("component", "digest").alias("component")), "members")
    apart = labelled.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    return labelled.join(apart.filter("least <> most"), "bucket").select("bucket", "digest", "component", "least")


def _next_pairs(apart: DataFrame) -> DataFrame:
    """For each document, of the leaders of its buckets in another component, the one it shares most buckets with."""
    leads = apart.filter("component = least").groupBy("bucket").agg(F.min("digest").alias("leader"))
    shared = apart.filter("component <> least").join(leads, "bucket").groupBy("digest", "leader").agg(F.count(F.lit(1)).alias("n"))
    best = shared.groupBy("digest").agg(F.max(F.struct("n", "leader")).alias("best"))
    return best.select(F.col("digest").alias("a"), F.col("best.leader").alias("b"))


def _forest(left: list[int], right: list[int], n: int) -> list[tuple[int, int]]:
    """Pairs that join something, in the given order."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    kept = []
    for i, j in zip(left, right, strict=True):
        a, b = find(i), find(j)
        if a != b:
            root[b] = a
            kept.append((i, j))
    return kept


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each left set with each right one, by products of incidence matrices."""
    flat = np.concatenate([*left, *right])
    values, column, counts = np.unique(flat, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    # A shingle of one set only is in no intersection.
    shared = counts > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(left), len(right)), np.float64)
    for start in range(0, int(shared.sum()), COLUMNS_AT_ONCE):
        a, b = np.searchsorted(column, [start, start + COLUMNS_AT_ONCE])
        block = np.zeros((len(left) + len(right), COLUMNS_AT_ONCE), np.float32)
        block[row[a:b], column[a:b] - start] = 1
        both += block[: len(left)] @ block[len(left) :].T
    return both


def _within_buckets(apart: DataFrame, described_sets: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """Confirmed links that connect what is similar within the buckets and not in one component yet."""
    rows = apart.select("bucket", "digest", "component").join(described_sets.select("digest", "n", "buckets"), "digest")
    weight = F.sum(1 + F.col("n") / 1000)
    large = rows.groupBy("bucket").agg(F.ceil(weight / TILE).cast("int").alias("tiles")).filter("tiles > 1")
    large = materialize(large, "large-buckets")
    tiles = F.coalesce("tiles", F.lit(1))
    own = F.pmod(F.xxhash64("digest"), tiles).cast("int")
    goes = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(F.least("own", t).alias("i"), F.greatest("own", t).alias("j")))
    dealt = rows.join(large, "bucket", "left").withColumns({"tiles": tiles, "own": own}).select("*", F.explode(goes).alias("to"))
    dealt = dealt.select("bucket", "to.i", "to.j", "digest", (F.col("own") != F.col("to.i")).alias("second"), "component", "buckets")
    met = dealt.join(texts, "digest").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    def links(group: list[tuple], known: _WordHashes) -> list[tuple[bytes, bytes]]:
        sets = shingle_sets([g[4] for g in group], size, known)
        fit = [k for k, s in enumerate(sets) if _digest(s) == group[k][0]]
        if len(fit) < 2:
            return []
        group, sets = [group[k] for k in fit], [sets[k] for k in fit]
        bucket = group[0][5]
        second = np.array([g[1] for g in group])
        one = np.flatnonzero(~second)
        two = np.flatnonzero(second) if second.any() else one
        both = intersections([sets[k] for k in one], [sets[k] for k in two])
        lengths = np.array([len(s) for s in sets])
        i, j = np.nonzero(similar(both, lengths[one][:, None], lengths[two][None, :]))
        i, j = one[i], two[j]
        keys = np.array([g[3] for g in group])
        fresh = [
            k
            for k in range(len(i))
            if group[i[k]][2] != group[j[k]][2] and keys[i[k]][np.flatnonzero(keys[i[k]] == keys[j[k]])[0]] == bucket
        ]
        return [(group[a][0], group[b][0]) for a, b in _forest(i[fresh].tolist(), j[fresh].tolist(), len(group))]

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, key, held, found = _WordHashes(), None, [], []
        names = ("bucket", "i", "j", "digest", "second", "component", "buckets", "text")
        for batch in stream:
            for bucket, a, b, *rest in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if (bucket, a, b) != key:
                    if len(held) > 1:
                        found += links(held, known)
                    key, held = (bucket, a, b), []
                held.append((*rest, bucket))
        if len(held) > 1:
            found += links(held, known)
        left, right = zip(*found, strict=True) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], ["a", "b"])

    return met.select("bucket", "i", "j", "digest", "second", "component", "buckets", "text").mapInArrow(batches, "a binary, b binary")


def links(df: DataFrame, sets: DataFrame, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Confirmed pairs ``(a, b)`` of digests that connect every two similar sets; ``sets`` is what ``described`` gave."""
    # One vertex for each set, with a row that holds it.
    vertices = sets.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("row").alias("row"), F.first("n").alias("n"), F.first("buckets").alias("buckets"))
    vertices = materialize(vertices, "sets")
    exploded = vertices.select("digest", F.explode("buckets").alias("bucket"))
    shared = exploded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket")
    members = materialize(exploded.join(shared, "bucket"), "bucket-members")
    wanted = members.select("digest").distinct().join(vertices.select("digest", "row"), "digest")
    texts = materialize(_texts(df, wanted, id_col, text_col), "texts")
    edges = members.select(F.col("digest").alias("a"), F.col("digest").alias("b")).limit(0)
    for _ in range(ROUNDS):
        pairs = materialize(_next_pairs(_labelled(members, edges)), "pairs")
        edges = materialize(edges.unionByName(_confirmed(pairs, texts, size)), "links")
    rest = materialize(_within_buckets(_labelled(members, edges), vertices, texts, size), "rest")
    return edges.unionByName(rest)


def near_duplicates(df: DataFrame, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_shingles, component_id, kept)`` of every row.

    Two texts are linked if the intersection of their sets of shingles is at least ``PERCENT`` of the union;
    ``component_id`` is the smallest id that can be reached, its own included, and ``kept`` marks the row that
    names its component. Null, empty and blank texts have no shingles and are linked with nothing; a text of fewer
    than ``size`` words has one. Very long texts are compared whole. Repeated rows are copies of each other; a
    null id names no component unless it is alone. An empty table gives no rows; other columns are ignored.
    """
    sets = materialize(described(df, size, id_col, text_col), "described")
    found = components(links(df, sets, size, id_col, text_col))
    grouped = sets.join(found.withColumnRenamed("vertex", "digest"), "digest", "left")
    grouped = grouped.select("id", "n", F.coalesce("component", "digest").alias("component"))
    least = grouped.filter("component IS NOT NULL").groupBy("component").agg(F.min("id").alias("least"))
    named = grouped.join(least, "component", "left").withColumn("component_id", F.coalesce("least", "id"))
    return named.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
