"""Spelling variants by blocked Gram matrices of letter counts.

One inserted, deleted or replaced letter moves a word's vector of letter counts by a squared distance of
one or two. Words are therefore dealt to blocks by their counts of a few classes of letters, whose sum is
the length; a near word can only lie in the block itself or in one that differs by one letter of one class
or by one letter moved between two classes. Adjacent blocks meet in one task, where a matrix product
of their letter counts gives all squared distances at once; the pairs at the right distance are verified
letter by letter.

A block travels as packs of a bounded number of words. Every pack is at home in a group of its own, which the
packs of adjacent blocks pass through one after another, so memory does not depend on a block's size,
and the work on a block with very many words is spread over as many groups as it has packs. More
classes are used as the vocabulary grows, which keeps blocks small and loses no pair.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import id_and_text, slices_by_bytes

LEAST_LETTERS = 7
LEAST_COUNT = 2
FORM_FACTOR = 10
# One run in so many loses a letter.
DROP_EVERY = 31

# A-Z lowered, letters kept, all other bytes of Latin-1 blanked.
_LETTERS = bytes(b | 0x20 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 0x20 for b in range(256))
# Letters counted one by one are a-z; the 64 code points from U+00C0 share six counts. Sharing counts only
# lowers distances, so it loses no pair.
DIMS = 32
_DIM = np.array([b - 97 if 97 <= b <= 122 else 26 + b % 6 for b in range(256)], np.int64)

# A pack holds words until their number plus a sixteenth of their letters reaches this.
PACK = 2_048
# Entries of one matrix of distances.
CELLS = 1 << 22
HELD_WORDS = 200_000
# Vocabularies up to this many words use four classes of letters, then one more for each factor of three.
FEW_WORDS = 1 << 14


def letter_runs(text: str | None) -> list[bytes]:
    """Maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` in Latin-1, A-Z lowered; a null text has none."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split() if text else []


def thinned(run: bytes, start: int) -> bytes:
    """The run, less one letter if its checksum, continued from ``start``, is a multiple of ``DROP_EVERY``."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
    if h % DROP_EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(
    df: DataFrame, least: int = LEAST_LETTERS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(word, n)`` of every word of at least ``least`` letters that occurs at least ``LEAST_COUNT`` times.

    Null, empty and letterless texts have no words; a very long text is read like any other; repeated rows
    count each time; a null id is the empty text in a checksum; an empty table gives no rows. Other columns
    are ignored.
    """
    rows = id_and_text(df, id_col, text_col).select(F.col("id").cast("string").alias("id"), "text")

    def packed(counts: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in counts], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in stream:
            for begin, end in slices_by_bytes(batch.column("text")):
                part = batch.slice(begin, end - begin)
                for key, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    start = zlib.crc32(f"{'' if key is None else key}:".encode())
                    for run, n in Counter(letter_runs(text)).items():
                        if len(run) >= least:
                            word = thinned(run, start)
                            if len(word) >= least:
                                held[word] += n
                    if len(held) > HELD_WORDS:
                        yield packed(held)
                        held.clear()
        if held:
            yield packed(held)

    counted = rows.mapInArrow(batches, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


def _classes(words: int) -> int:
    return 4 + max(0, math.floor(math.log(max(words, 1) / FEW_WORDS, 3)) if words > FEW_WORDS else 0)


def _counts(words: list[bytes], slot: np.ndarray, width: int) -> np.ndarray:
    """Row by row, how many letters of each slot a word has."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    row = np.repeat(np.arange(len(words)), lengths)
    at = row * width + slot[np.frombuffer(b"".join(words), np.uint8)]
    return np.bincount(at, minlength=len(words) * width).reshape(len(words), width)


def _key(counts: np.ndarray) -> bytes:
    """A block's name; its form follows from the length of the words in it."""
    return counts.astype(np.uint8 if counts.sum() < 255 else np.uint32).tobytes()


def _moves(classes: int) -> list[np.ndarray]:
    """Steps to adjacent blocks, one of each two opposite ones: a letter more, or one in another class."""
    one = np.eye(classes, dtype=np.int64)
    return [*one, *(one[i] - one[j] for i in range(classes) for j in range(i + 1, classes))]


class _Words:
    """Words of one group with their letter counts and letters."""

    def __init__(self, words: list[bytes], n: np.ndarray):
        self.words, self.n = words, n
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.letters = np.frombuffer(b"".join(words), np.uint8)
        self.counts = _counts(words, _DIM, DIMS)

    def rows(self, at: np.ndarray, length: int) -> np.ndarray:
        return self.letters[self.starts[at][:, None] + np.arange(length)]


def _one_edit(home: _Words, other: _Words, i: np.ndarray, j: np.ndarray, length: int) -> np.ndarray:
    """Whether words ``i`` of the home pack, all of one length, and ``j``, as long or one shorter, are one edit apart."""
    near = np.zeros(len(i), bool)
    step = max(1, CELLS // (4 * length))
    for begin in range(0, len(i), step):
        at = slice(begin, begin + step)
        for short in (0, 1):
            own = np.flatnonzero(length - other.lengths[j[at]] == short)
            if not len(own):
                continue
            a, b = home.rows(i[at][own], length), other.rows(j[at][own], length - short)
            if short:
                front = np.logical_and.accumulate(a[:, :-1] == b, axis=1).sum(axis=1)
                back = np.logical_and.accumulate((a[:, 1:] == b)[:, ::-1], axis=1).sum(axis=1)
                near[begin + own] = front + back >= length - 1
            else:
                near[begin + own] = (a != b).sum(axis=1) == 1
    return near


def near_in_blocks(home: _Words, other: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the near pairs of a home pack, whose words have one length, and words as long or one shorter."""
    length = int(home.lengths[0])
    # Single precision is exact for whole numbers below 2^24.
    kind = np.float32 if length < 1_000 else np.float64
    x = home.counts.astype(kind)
    left = np.column_stack([-2 * x, (x * x).sum(axis=1), np.ones(len(x), kind)]).astype(kind)
    found_i, found_j = [], []
    step = max(1, CELLS // len(x))
    for begin in range(0, len(other.words), step):
        y = other.counts[begin : begin + step].astype(kind)
        shorter = (length - other.lengths[begin : begin + step]).astype(kind)
        right = np.column_stack([y, np.ones(len(y), kind), (y * y).sum(axis=1) + shorter]).astype(kind)
        # Squared distance, plus one where the other word is shorter: one edit makes two at most.
        i, j = np.divmod(np.flatnonzero(left @ right.T <= 2), len(y))
        if home is other:
            i, j = i[i < j + begin], j[i < j + begin]
        j = j + begin
        near = _one_edit(home, other, i, j, length)
        found_i.append(i[near])
        found_j.append(j[near])
    none = np.empty(0, np.int64)
    return np.concatenate([none, *found_i]), np.concatenate([none, *found_j])


def _unpacked(blobs: list[tuple[bytes, bytes]]) -> _Words:
    words = [w for packed, _ in blobs for w in packed.split(b" ")]
    return _Words(words, np.concatenate([np.frombuffer(n, np.int64) for _, n in blobs]))


def near_words(words: DataFrame) -> DataFrame:
    """``(word, other, other_n)`` for every two words that are one inserted, deleted or replaced letter apart.

    ``words`` holds ``(word, n)``, each word once, of letters as ``letter_runs`` gives them. Pairs come in both
    directions.
    """
    words = materialize(words.select("word", "n"), "vocabulary")
    classes = _classes(words.count())
    slot = np.arange(256) % classes
    moves = _moves(classes)

    def keyed(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            listed = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            if listed:
                keys = [_key(c) for c in _counts(listed, slot, classes)]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *batch.columns], ["key", "word", "n"])

    rows = words.mapInArrow(keyed, "key binary, word string, n bigint")
    rows = materialize(rows, "blocks")
    weight = F.sum(1 + F.length("word") / 16)
    large = rows.groupBy("key").agg(F.ceil(weight / PACK).cast("int").alias("salts")).filter("salts > 1")
    large = materialize(large, "large-blocks")
    salt = F.pmod(F.xxhash64("word"), F.coalesce("salts", F.lit(1))).cast("int")
    dealt = rows.join(large, "key", "left").select("key", salt.alias("salt"), "word", "n")

    def packs(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "salt", "pack", "words", "ns"]
        key, salt, number, held, ns, size = None, 0, 0, [], [], 0
        out: list[tuple] = []

        def close():
            if held:
                out.append((key, salt, number, b" ".join(held), np.array(ns, np.int64).tobytes()))

        def batch_of() -> pa.RecordBatch:
            kinds = [pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

        for batch in stream:
            columns = (batch.column(c).to_pylist() for c in ("key", "salt", "word", "n"))
            for k, s, word, n in zip(*columns, strict=True):
                if (k, s) != (key, salt) or size >= PACK:
                    close()
                    number = number + 1 if (k, s) == (key, salt) else 0
                    key, salt, held, ns, size = k, s, [], [], 0
                held.append(word.encode("latin-1"))
                ns.append(n)
                size += 1 + len(word) / 16
            if len(out) > 256:
                yield batch_of()
                out.clear()
        close()
        if out:
            yield batch_of()

    sorted_rows = dealt.repartition("key", "salt").sortWithinPartitions("key", "salt")
    stored = materialize(sorted_rows.mapInArrow(packs, "key binary, salt int, pack int, words binary, ns binary"), "packs")
    # Homes of a block are numbered salt by salt; only blocks of several packs need the numbers.
    homes = stored.groupBy("key").agg(F.max("salt").alias("salts"), F.max("pack").alias("packs")).filter("salts + packs > 0")
    homes = materialize(homes, "homes")

    def visits(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "away", "salt", "pack", "words", "ns"]
        for batch in stream:
            for row in batch.to_pylist():
                own = row["key"]
                counts = np.frombuffer(own, np.uint8 if len(own) == classes else np.uint32).astype(np.int64)
                to = [counts + m for m in moves]
                keys = [own, *(_key(c) for c in to if (c >= 0).all())]
                rest = [[row[c]] * len(keys) for c in ("salt", "pack", "words", "ns")]
                columns = [keys, [False] + [True] * (len(keys) - 1), *rest]
                kinds = [pa.binary(), pa.bool_(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    sent = stored.mapInArrow(visits, "key binary, away boolean, salt int, pack int, words binary, ns binary")
    sent = sent.join(homes, "key", "left")
    salts, most = F.coalesce("salts", F.lit(0)), F.coalesce("packs", F.lit(0))
    every = F.sequence(F.lit(0), (salts + 1) * (most + 1) - 1)
    own = F.col("salt") * (most + 1) + F.col("pack")
    # A pack is at home in its own group and passes through those of all adjacent blocks and later packs.
    goes = F.transform(F.filter(every, lambda g: F.col("away") | (g >= own)), lambda g: F.struct(g.alias("home"), (F.col("away") | (g != own)).alias("guest")))
    sent = sent.select("key", F.explode(goes).alias("to"), "words", "ns").select("key", "to.home", "to.guest", "words", "ns")

    def compared(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home, group, guests, held = None, None, [], 0

        def pairs(a: _Words, b: _Words) -> pa.RecordBatch:
            i, j = near_in_blocks(a, b)
            left, right = [a.words[x].decode("latin-1") for x in i], [b.words[x].decode("latin-1") for x in j]
            columns = [pa.array(left + right, pa.string()), pa.array(right + left, pa.string()), pa.array(np.concatenate([b.n[j], a.n[i]]))]
            return pa.RecordBatch.from_arrays(columns, ["word", "other", "other_n"])

        for batch in stream:
            columns = (batch.column(c).to_pylist() for c in ("key", "home", "guest", "words", "ns"))
            for key, part, guest, packed, n in zip(*columns, strict=True):
                if (key, part) != group:
                    if guests:
                        yield pairs(home, _unpacked(guests))
                    home, group, guests, held = None, (key, part), [], 0
                if not guest:
                    home = _unpacked([(packed, n)])
                    yield pairs(home, home)
                elif home is not None:
                    guests.append((packed, n))
                    held += len(n)
                    if held > 8 * PACK * 8:
                        yield pairs(home, _unpacked(guests))
                        guests, held = [], 0
        if guests:
            yield pairs(home, _unpacked(guests))

    met = sent.repartition("key", "home").sortWithinPartitions("key", "home", "guest")
    return met.mapInArrow(compared, "word string, other string, other_n bigint")


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """``(word, root)``: the end of each word's chain of forms. Counts grow ten times with each step of a chain."""
    forms = materialize(forms, "forms")
    longest = 0
    while LEAST_COUNT * FORM_FACTOR ** (longest + 1) <= most:
        longest += 1
    roots = forms.select("word", F.col("form").alias("root"))
    reached = 1
    while reached < longest:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        roots = roots.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"))
        roots = materialize(roots, "roots")
        reached *= 2
    return roots


def variants(df: DataFrame, least: int = LEAST_LETTERS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word of the ``vocabulary`` of the texts.

    ``form`` is the near word that occurs most often, of equals the first in code-point order, if it occurs at least
    ``FORM_FACTOR`` times as often as the word; else null. ``root`` is where forms lead in the end, the word itself if
    it has none. What nulls, repeats and long or missing texts give is as in ``vocabulary``.
    """
    words = materialize(vocabulary(df, least, id_col, text_col), "words")
    most = words.agg(F.max("n")).first()[0] or 0
    near = near_words(words).select("word", F.lit(None).cast("bigint").alias("n"), F.struct((-F.col("other_n")).alias("less"), "other").alias("best"))
    own = words.select("word", "n", F.lit(None).cast(near.schema["best"].dataType).alias("best"))
    # Words and what is near them meet in one aggregation.
    found = own.unionByName(near).groupBy("word").agg(F.max("n").alias("n"), F.count("best").alias("n_near"), F.min("best").alias("best"))
    is_form = -F.col("best.less") >= FORM_FACTOR * F.col("n")
    found = found.select(
        "word", F.when(is_form, F.col("best.other")).alias("form"), "n", "n_near", F.when(is_form, -F.col("best.less")).alias("form_n")
    )
    found = materialize(found, "variants")
    roots = _roots(found.filter("form IS NOT NULL").select("word", "form"), most)
    joined = found.join(roots, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
