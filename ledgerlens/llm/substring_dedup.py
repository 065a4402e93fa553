"""Repeated passages with prefix-partitioned suffix trees.

Every word starts a suffix. Suffixes are dealt to groups by a prefix of variable length, as many words
as it takes to be selective, so that the suffixes of a group lie below one another in the suffix
tree and each group's subtree is built apart, in a size that fits a task. The inner nodes of a subtree
at a depth of at least ``depth`` words are the repeats; where such nodes lie behind each other in a text
they make up its maximal repeated passages. Only the part of the tree down to that depth matters here, so
a subtree is built by sorting suffixes by their label to that depth: 32 bits for the prefix and 64 for all.

A suffix that stands nowhere else can have no inner node. So the labels of all suffixes are first
compared in short form: a block of documents sends its sorted labels, cut to some 20 bits each beyond what
their order tells, and gets back one bit each. Only suffixes that may repeat go to the subtrees, each
label once per block with its smallest document, so that a passage that very many documents share costs a
row per block. The answer is one bit again: does a smaller document elsewhere have it.
"""

from __future__ import annotations

import hashlib
import math
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .common import blocks, words_of

DEPTH = 13
PREFIX_BYTES = 24
# Suffixes in a group, in expectation, if all of them may repeat.
GROUP_SUFFIXES = 2_000_000
WORD_BYTES = 6
_STEPS = (1, 2, 4, 8)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


def _joined(left: np.ndarray, right: np.ndarray, salt: int) -> np.ndarray:
    """Hash of a run of words from those of its two parts."""
    mixed = left * _A + (right ^ np.uint64(salt)) * _B
    mixed ^= mixed >> np.uint64(32)
    mixed *= _C
    mixed ^= mixed >> np.uint64(29)
    return mixed


def labels(words: np.ndarray, sizes: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """64-bit label and 32-bit prefix of the run of ``depth`` words from each position on that has one.

    ``words`` are word hashes, ``sizes`` their bytes. The prefix is the first 1, 2, 4, 8 or all words,
    the fewest that have ``PREFIX_BYTES`` bytes.
    """
    n = len(words) - depth + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.uint32)
    runs, length = {1: words}, 1
    while length * 2 <= depth:
        runs[length * 2] = _joined(runs[length][: len(words) - 2 * length + 1], runs[length][length : len(words) - length + 1], length)
        length *= 2
    whole, taken = runs[length], length
    while taken < depth:
        length = max(step for step in runs if step <= depth - taken)
        count = len(words) - taken - length + 1
        whole = _joined(whole[:count], runs[length][taken : taken + count], taken)
        taken += length
    upto = np.append(0, np.cumsum(sizes))
    prefix = whole[:n]
    for step in sorted((s for s in runs if s in _STEPS and s < depth), reverse=True):
        enough = upto[step : step + n] - upto[:n] >= PREFIX_BYTES
        prefix = np.where(enough, runs[step][:n], prefix)
    return whole[:n], ((prefix * _C) >> np.uint64(32)).astype(np.uint32)


class _Numbers(dict):
    """Words by the order in which they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Block:
    """The suffixes of a block of documents, sorted by label; equal labels are one entry with the smallest id."""

    def __init__(self, ids: list[int | None], texts: list[str], depth: int = DEPTH):
        self.depth, self.words = depth, [words_of(t) for t in texts]
        counts = np.fromiter(map(len, self.words), np.int64, len(self.words))
        known = _Numbers()
        number = np.fromiter(map(known.__getitem__, chain.from_iterable(self.words)), np.int64, int(counts.sum()))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, known), np.uint64, len(known))
        sizes = np.fromiter(map(len, known), np.int64, len(known))
        # All documents in one run of words; labels that reach over a border are left out again.
        label, prefix = labels(hashes[number], sizes[number], depth)
        owner = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        place = (np.arange(len(number)) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.int32)
        # A document without id neither removes nor loses anything.
        last = np.where([i is not None for i in ids], counts - depth, -1) if len(ids) else counts
        at = np.flatnonzero(place[: len(label)] <= last[owner[: len(label)]])
        at = at[np.argsort(label[at])]
        self.label, self.prefix, self.owner, self.place = label[at], prefix[at], owner[at], place[at]
        self.id = np.array([0 if i is None else i for i in ids], np.int64)[self.owner]
        same = (self.label[1:] == self.label[:-1]) & (self.prefix[1:] == self.prefix[:-1])
        opens = np.append(True, ~same)[: len(at)]
        self.first = np.flatnonzero(opens)
        self.entry = np.cumsum(opens) - 1
        self.least = np.minimum.reduceat(self.id, self.first) if len(at) else self.id

    def short(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct labels cut to ``bits`` bits, and which of them is each entry's."""
        cut = self.label[self.first] >> np.uint64(64 - bits)
        opens = np.append(True, cut[1:] != cut[:-1])[: len(cut)]
        return cut[opens], np.cumsum(opens) - 1

    def repeated(self, answer: np.ndarray) -> np.ndarray:
        """Entries that may be in another document, here or, as ``answer`` has it for each, elsewhere."""
        greatest = np.maximum.reduceat(self.id, self.first) if len(self.first) else self.id
        return answer | (greatest > self.least)

    def removed(self, elsewhere: np.ndarray) -> list[np.ndarray | None]:
        """For each document which words go; ``elsewhere`` tells of each entry whether a smaller document elsewhere has it."""
        gone = elsewhere[self.entry] | (self.id > self.least[self.entry]) if len(self.entry) else np.empty(0, bool)
        cover: list[np.ndarray | None] = [None] * len(self.words)
        at = np.flatnonzero(gone)
        for d, own in _by(self.owner[at], self.place[at]):
            ends = np.zeros(len(self.words[d]) + 1, np.int64)
            np.add.at(ends, own, 1)
            np.add.at(ends, own + self.depth, -1)
            cover[d] = np.cumsum(ends[:-1]) > 0
        return cover


def _by(keys: np.ndarray, values: np.ndarray):
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    cuts = np.flatnonzero(np.diff(keys)) + 1
    for part in np.split(np.arange(len(keys)), cuts):
        if len(part):
            yield int(keys[part[0]]), values[part]


def packed(numbers: np.ndarray) -> bytes:
    """Sorted numbers as differences of as many bytes as the largest takes."""
    steps = np.diff(numbers.astype(np.uint64), prepend=np.uint64(0))
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    return bytes([width]) + np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    width = data[0]
    body = np.frombuffer(data, np.uint8, offset=1).reshape(-1, width)
    steps = np.zeros((len(body), 8), np.uint8)
    steps[:, :width] = body
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def _flags(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


class Plan:
    """Sizes that all steps agree on."""

    def __init__(self, n_blocks: int, block_bytes: int, depth: int):
        suffixes = n_blocks * block_bytes / WORD_BYTES
        self.depth = depth
        self.bits = min(63, 13 + math.ceil(math.log2(suffixes)))
        self.group_bits = max(0, math.ceil(math.log2(suffixes / GROUP_SUFFIXES)))

    def ranges(self, short: np.ndarray) -> list[tuple[int, int, int]]:
        """Each range of short labels: its number, begin and end."""
        borders = np.searchsorted(short, np.arange((1 << self.group_bits) + 1, dtype=np.uint64) << np.uint64(self.bits - self.group_bits))
        return [(r, int(a), int(b)) for r, (a, b) in enumerate(zip(borders[:-1], borders[1:], strict=True)) if b > a]

    def groups(self, block: Block, entries: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """Each group of prefixes with the entries that go to its subtree."""
        group = block.prefix[block.first[entries]] & np.uint32((1 << self.group_bits) - 1)
        return list(_by(group, entries))

    def answers(self, block: Block, found: pa.Table) -> tuple[np.ndarray, list[tuple[int, np.ndarray]], np.ndarray]:
        """What the answers to a block say: entries that may repeat, dealt to groups, and those of a smaller document elsewhere."""
        given = {(k, p): v for k, p, v in zip(*(found.column(c).to_pylist() for c in ("kind", "part", "data")), strict=True)}
        short, own_short = block.short(self.bits)
        answer = np.zeros(len(short), bool)
        for r, a, b in self.ranges(short):
            if (0, r) in given:
                answer[a:b] = _flags(given[0, r], b - a)
        entries = np.flatnonzero(block.repeated(answer[own_short]))
        groups = self.groups(block, entries)
        elsewhere = np.zeros(len(block.first), bool)
        for g, own in groups:
            if (1, g) in given:
                elsewhere[own] = _flags(given[1, g], len(own))
        return entries, groups, elsewhere


_SENT = T.StructType([T.StructField("part", T.LongType()), T.StructField("block", T.LongType()), T.StructField("data", T.BinaryType())])
_ANSWER = T.StructType([T.StructField("block", T.LongType()), T.StructField("kind", T.IntegerType()), T.StructField("part", T.LongType()), T.StructField("data", T.BinaryType())])


def _opened(texts: pa.Table, depth: int) -> Block:
    return Block(texts.column("id").to_pylist(), texts.column("text").to_pylist(), depth)


def _sent(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    part, block, data = (list(c) for c in zip(*rows, strict=True)) if rows else ([], [], [])
    return pa.table({"part": pa.array(part, pa.int64()), "block": pa.array(block, pa.int64()), "data": pa.array(data, pa.binary())})


def _answered(kind: int, rows: list[tuple[int, int, bytes]]) -> pa.Table:
    sent = _sent(rows)
    return pa.table({"block": sent.column("block"), "kind": pa.array([kind] * len(rows), pa.int32()), "part": sent.column("part"), "data": sent.column("data")})


_ENTRY = np.dtype([("prefix", "<u4"), ("label", "<u8"), ("id", "<i8")])


def _removals(dealt: DataFrame, plan: Plan) -> DataFrame:
    """Answers to all blocks: kind 0 for short labels, kind 1 for the subtrees."""

    def send_short(texts: pa.Table) -> pa.Table:
        block, name = _opened(texts, plan.depth), texts.column("block")[0].as_py()
        short, _ = block.short(plan.bits)
        return _sent([(r, name, packed(short[a:b])) for r, a, b in plan.ranges(short)])

    def compare_short(sent: pa.Table) -> pa.Table:
        part = sent.column("part")[0].as_py()
        names = sent.column("block").to_pylist()
        own = [unpacked(d) for d in sent.column("data").to_pylist()]
        every = np.sort(np.concatenate(own))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        rows = []
        for name, short in zip(names, own, strict=True):
            at = np.minimum(np.searchsorted(twice, short), max(len(twice) - 1, 0))
            hit = twice[at] == short if len(twice) else np.zeros(len(short), bool)
            if hit.any():
                rows.append((part, name, np.packbits(hit).tobytes()))
        return _answered(0, rows)

    def send_suffixes(texts: pa.Table, found: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _sent([])
        block, name = _opened(texts, plan.depth), texts.column("block")[0].as_py()
        rows = []
        for g, own in plan.answers(block, found)[1]:
            entries = np.empty(len(own), _ENTRY)
            entries["prefix"], entries["label"], entries["id"] = block.prefix[block.first[own]], block.label[block.first[own]], block.least[own]
            rows.append((g, name, _columns(entries)))
        return _sent(rows)

    def build_subtrees(sent: pa.Table) -> pa.Table:
        part = sent.column("part")[0].as_py()
        names = sent.column("block").to_pylist()
        own = [_entries(d) for d in sent.column("data").to_pylist()]
        leaves = np.concatenate(own)
        # Sorted by prefix and label, the leaves of an inner node at full depth stand together.
        order = np.lexsort((leaves["label"], leaves["prefix"]))
        prefix, label, number = leaves["prefix"][order], leaves["label"][order], leaves["id"][order]
        first = np.flatnonzero(np.append(True, (prefix[1:] != prefix[:-1]) | (label[1:] != label[:-1])))
        least = np.repeat(np.minimum.reduceat(number, first), np.diff(np.append(first, len(number))))
        smaller = np.empty(len(leaves), bool)
        smaller[order] = least < number
        rows, at = [], 0
        for name, mine in zip(names, own, strict=True):
            hit = smaller[at : at + len(mine)]
            at += len(mine)
            if hit.any():
                rows.append((part, name, np.packbits(hit).tobytes()))
        return _answered(1, rows)

    short = dealt.groupBy("block").applyInArrow(send_short, _SENT).groupBy("part").applyInArrow(compare_short, _ANSWER)
    suffixes = dealt.groupBy("block").cogroup(short.groupBy("block")).applyInArrow(send_suffixes, _SENT)
    return short.unionByName(suffixes.groupBy("part").applyInArrow(build_subtrees, _ANSWER))


def _columns(entries: np.ndarray) -> bytes:
    """Entries column by column, ids in half their size where they allow it."""
    small = len(entries) and entries["id"].min() >= 0 and entries["id"].max() < 1 << 32
    ids = entries["id"].astype("<u4" if small else "<i8")
    return bytes([4 if small else 8]) + entries["prefix"].tobytes() + entries["label"].tobytes() + ids.tobytes()


def _entries(data: bytes) -> np.ndarray:
    width = data[0]
    n = (len(data) - 1) // (12 + width)
    entries = np.empty(n, _ENTRY)
    entries["prefix"] = np.frombuffer(data, "<u4", n, 1)
    entries["label"] = np.frombuffer(data, "<u8", n, 1 + 4 * n)
    entries["id"] = np.frombuffer(data, "<u4" if width == 4 else "<i8", n, 1 + 12 * n)
    return entries


def _applied(
    df: DataFrame, fields: list[tuple[str, T.DataType, pa.DataType]], made, id_col: str, text_col: str, depth: int, rest: bool = False
) -> DataFrame:
    """Columns that ``made(words, which go, text)`` gives for each document, next to its id."""
    dealt, n_blocks = blocks(df, id_col, text_col, rest=rest)
    plan = Plan(n_blocks, common.BLOCK_BYTES, depth)
    answers = _removals(dealt, plan)
    carried = ["id", *(["rest"] if rest else [])]
    schema = T.StructType([*[dealt.schema[c] for c in carried], *[T.StructField(n, k) for n, k, _ in fields]])

    def apply(texts: pa.Table, found: pa.Table) -> pa.Table:
        block = _opened(texts, plan.depth)
        cover = block.removed(plan.answers(block, found)[2])
        rows = [made(own, gone, text) for own, gone, text in zip(block.words, cover, texts.column("text").to_pylist(), strict=True)]
        columns = [pa.array([r[i] for r in rows], kind) for i, (_, _, kind) in enumerate(fields)]
        return pa.Table.from_arrays([*[texts.column(c) for c in carried], *columns], schema.names)

    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(apply, schema)


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """``(id_col, n_words, n_removed, text)``: each row's text without the words of passages that a smaller id has.

    A passage is a run of ``depth`` words; each word that it covers goes if the same run starts in a
    document with a smaller id, as the texts were given. What is left is joined by single spaces. Rows
    with one id do not remove each other's; null ids remove and lose nothing; null, empty and shorter
    texts lose nothing. Ids must be whole numbers. Other columns are ignored.
    """

    def made(words, gone, text):
        kept = words if gone is None else list(compress(words, ~gone))
        return len(words), len(words) - len(kept), b" ".join(kept).decode()

    fields = [("n_words", T.LongType(), pa.int64()), ("n_removed", T.LongType(), pa.int64()), ("text", T.StringType(), pa.string())]
    return _applied(df, fields, made, id_col, text_col, depth).withColumnRenamed("id", id_col)


def rewrite(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """The rows of ``df``, all columns, with texts as ``deduplicate`` leaves them; a text that loses nothing stays as it is."""

    def made(words, gone, text):
        return (text if gone is None else b" ".join(compress(words, ~gone)).decode(),)

    rows = _applied(df, [("kept", T.StringType(), pa.string())], made, id_col, text_col, depth, rest=True)
    column = {id_col: F.col("id"), text_col: F.col("kept").cast(df.schema[text_col].dataType)}
    return rows.select(*[column.get(c, F.col("rest")[c]).alias(c) for c in df.columns])


def repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """``(id_col, first_word, end_word)``: the maximal passages of each row that consist of runs a smaller id has."""

    def made(words, gone, text):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))).reshape(-1, 2) if gone is not None else np.empty((0, 2), int)
        return ([{"first_word": int(a), "end_word": int(b)} for a, b in edge],)

    span = T.StructType([T.StructField("first_word", T.LongType()), T.StructField("end_word", T.LongType())])
    arrow = pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64())]))
    found = _applied(df, [("spans", T.ArrayType(span), arrow)], made, id_col, text_col, depth).withColumnRenamed("id", id_col)
    return found.select(id_col, F.explode("spans").alias("s")).select(id_col, "s.*")


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``deduplicate`` with a hash in place of the text, taken where the text is made."""

    def made(words, gone, text):
        kept = words if gone is None else list(compress(words, ~gone))
        return len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()

    fields = [("n_words", T.LongType(), pa.int64()), ("n_removed", T.LongType(), pa.int64()), ("kept_sha256", T.StringType(), pa.string())]
    return _applied(df, fields, made, id_col, text_col, DEPTH).withColumnRenamed("id", id_col)
