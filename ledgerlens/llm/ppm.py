"""Prediction by partial matching over the bytes of words.

A text is its words in order, each ended by a space, and an end: the space where a word would begin.
The longest context of a byte is everything read of its word so far, a path in a trie of the training
words. If that context has been seen with the byte, its count gives the probability; else the model
escapes, once, to the last ``ORDER`` bytes, from there to fewer, to none and at last to all bytes alike,
each time leaving out the bytes that the longer context had (symbol exclusion). How likely an escape is
follows from how often contexts with as many counts and as many different bytes would have escaped on
a training word that is left out (secondary escape estimation).

A word's code length does not depend on what stands around it, so the distinct words of the corpus are
scored once. They are range-partitioned, so a partition holds one stretch of the sorted trie, whatever
words begin alike; only the nodes above its first and last word reach into other partitions, and their
counts are added up beforehand. Counts after the last bytes stay a table as well: a partition gets those of
the contexts that its words may ask for after an escape, so none is left out whatever the corpus. Documents are
dealt to blocks, a block looks up each of its words once, and neither texts nor occurrences of words are joined.

On top of the pretrained trie a document adapts: after t words, a share ``ADAPT * t / (t + WARM_UP)`` of
the probability goes to the words it has had so far, in proportion to how often.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import blocks, lower_words_of, share_of, slices_by_bytes

WORDS_PER_PART = 150_000
DEPTH = 24
ADAPT, WARM_UP = 0.3, 20
ORDER = 3
# Bytes of blocks' word lists that are answered in one task, in expectation.
ANSWER_BYTES = 64 << 20
# States of a context in escape estimation: its depth, binary length of its count and of its kinds.
DEPTHS, COUNTS, KINDS = 16, 40, 9


class Stretch:
    """The trie of consecutive sorted distinct words, as runs of words with a common beginning at each depth."""

    def __init__(self, words: list[bytes], counts: np.ndarray):
        self.size = len(words)
        self.counts = counts
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.marked = np.minimum(lengths + 1, DEPTH)
        flat = b"".join(w[:DEPTH].ljust(DEPTH, b" ") for w in words)
        self.bytes = np.frombuffer(flat, np.uint8).reshape(len(words), DEPTH)

    def runs(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the words with at least ``depth`` marked bytes: the first of each run that agrees on them, and each word's run."""
        reach = self.marked >= depth
        opens = np.zeros(self.size, bool)
        opens[self._first_of_run(depth)] = True
        opens &= reach
        run = np.cumsum(opens) - 1
        return np.flatnonzero(opens), np.where(reach, run, -1)

    def _first_of_run(self, depth: int) -> np.ndarray:
        rows = np.flatnonzero(self.marked >= depth)
        if not len(rows):
            return rows
        head = self.bytes[rows, :depth]
        return rows[np.append(True, (head[1:] != head[:-1]).any(axis=1))]

    def level(self, depth: int):
        """For the words that go on from ``depth`` bytes: rows, their run, the runs' totals, the child's run and its total."""
        rows = np.flatnonzero(self.marked > depth)
        first, run = self.runs(depth)
        child_first, child = self.runs(depth + 1)
        total = np.bincount(run[rows], self.counts[rows], minlength=len(first)).astype(np.int64)
        below = np.bincount(child[rows], self.counts[rows], minlength=len(child_first)).astype(np.int64)
        return rows, run[rows], total, child[rows], below, child_first


def _bits(n: np.ndarray, most: int) -> np.ndarray:
    """Binary length, 0 for 0, at most ``most``."""
    return np.minimum(np.frexp(np.maximum(n, 0).astype(float))[1], most)


def state(depth: int, total: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    return (min(depth, DEPTHS - 1) * COUNTS + _bits(total, COUNTS - 1)) * KINDS + _bits(kinds, KINDS - 1)


def left_out(depth: int, total: np.ndarray, kinds: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For edges of count ``own`` below contexts: states with one training word left out, visits, and escapes then."""
    single = own == 1
    keep = (own > 0) & (total > 1)
    return state(depth, (total - 1)[keep], (kinds - single)[keep]), own[keep], single[keep].astype(np.int64)


class Lower:
    """Contexts of the last ``ORDER`` bytes down to none, with what followed them and how often.

    A context that is asked for must be there with all that followed it; others may be missing.
    """

    def __init__(self, orders: list[tuple[np.ndarray, np.ndarray]]):
        """For 0, 1, ... bytes of context: sorted ``context * 256 + byte`` and counts."""
        self.orders = orders

    def probability(self, context: np.ndarray, byte: np.ndarray, excluded: np.ndarray | None = None) -> np.ndarray:
        """Of each byte after the bytes of a context, where ``excluded`` marks bytes it cannot be."""
        n = len(byte)
        gone = np.zeros((n, 256), bool) if excluded is None else excluded.copy()
        result, open_ = np.ones(n), np.ones(n, bool)
        for order in range(len(self.orders) - 1, -1, -1):
            keys, counts = self.orders[order]
            own = (context & ((1 << (8 * order)) - 1)) << 8
            begin, stop = np.searchsorted(keys, own), np.searchsorted(keys, own + 256)
            sizes = np.where(open_, stop - begin, 0)
            at = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            row, following = np.repeat(np.arange(n), sizes), keys[at] & 255
            alive = ~gone[row, following]
            row, following, count = row[alive], following[alive], counts[at[alive]]
            total, kinds = np.bincount(row, count, minlength=n), np.bincount(row, minlength=n)
            found = following == byte[row]
            hit, missed = row[found], open_ & (total > 0)
            result[hit] *= count[found] / (total + kinds)[hit]
            missed[hit] = False
            result[missed] *= (kinds[missed] / (total + kinds)[missed])
            open_[hit] = False
            gone[row, following] = True
        left = np.maximum(256 - gone.sum(axis=1), 1)
        result[open_] /= left[open_]
        return result

    def log(self, context: np.ndarray, byte: np.ndarray) -> np.ndarray:
        pairs, where = np.unique(context * 256 + byte, return_inverse=True)
        parts = [np.log10(self.probability(pairs[i : i + 4096] >> 8, pairs[i : i + 4096] & 255)) for i in range(0, len(pairs), 4096)]
        return np.concatenate(parts)[where] if parts else np.empty(0)


def sequences(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of all marked bytes of all words: the ``ORDER`` bytes before (spaces before a word) and the byte, and the word's number."""
    flat = np.frombuffer(b"".join(b" " * ORDER + w + b" " for w in words), np.uint8).astype(np.int64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + ORDER + 1
    begin = np.cumsum(sizes) - sizes
    keys = np.zeros(max(len(flat) - ORDER, 0), np.int64)
    for i in range(ORDER + 1):
        keys = keys * 256 + flat[i : len(flat) - ORDER + i]
    # A position of ``keys`` is that of the first byte of its context.
    place = np.arange(len(keys)) - np.repeat(begin, sizes)[: len(keys)]
    inner = place < np.repeat(sizes, sizes)[: len(keys)] - ORDER
    return keys[inner], np.repeat(np.arange(len(words)), sizes)[: len(keys)][inner]


def escape_table(states: np.ndarray, visits: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """Escape probability of each state; a state without visits falls back to kinds / (count + kinds), which weighs as two."""
    shape = DEPTHS * COUNTS * KINDS
    seen = np.bincount(states, visits, minlength=shape)
    left = np.bincount(states, escapes, minlength=shape)
    index = np.arange(shape)
    kinds, total = 2.0 ** np.maximum(index % KINDS - 1, 0), 2.0 ** np.maximum(index // KINDS % COUNTS - 1, 0)
    return np.clip((left + 2 * kinds / (total + kinds)) / (seen + 2), 1e-6, 1 - 1e-6)


def score_words(words: list[bytes], counts: np.ndarray, outer: dict[bytes, dict[int, int]], escape: np.ndarray, lower: Lower) -> np.ndarray:
    """Log10 probability of each of consecutive sorted words. ``outer``: byte counts of contexts that reach beyond them."""
    trie = Stretch(words, counts)
    score = np.zeros(len(words))
    # Words still on the trie; of those that left it, the depth at which they did and the bytes excluded there.
    on_trie = np.ones(len(words), bool)
    left_at = np.full(len(words), -1)
    sets: list[tuple[np.ndarray, np.ndarray]] = []
    for depth in range(DEPTH):
        rows, run, total, child, below, child_first = trie.level(depth)
        if not len(rows):
            break
        kinds = np.bincount(run[np.searchsorted(rows, child_first)], below > 0, minlength=len(total)).astype(np.int64)
        child_run, child_byte = run[np.searchsorted(rows, child_first)], trie.bytes[child_first, depth]
        had = below > 0
        edges = [np.stack([child_run[had], child_byte[had]])]
        for number in {int(run[0]), int(run[-1])}:
            first_row = rows[np.flatnonzero(run == number)[0]]
            context = (words[first_row] + b" ")[:depth]
            known = outer.get(context)
            if known is not None:
                total[number], kinds[number] = sum(known.values()), sum(n > 0 for n in known.values())
                for c in np.flatnonzero(child_run == number):
                    below[c] = known.get(int(child_byte[c]), below[c])
                edges.append(np.array([[number] * len(known), list(known)])[:, [n > 0 for n in known.values()]])
        edges = np.concatenate(edges, axis=1)
        live = on_trie[rows]
        rows, run, child = rows[live], run[live], child[live]
        n, d, own = total[run], kinds[run], below[child]
        e = escape[state(depth, n, d)]
        hit = own > 0
        score[rows[hit]] += np.log10((1 - e[hit]) * own[hit] / n[hit])
        gone = rows[~hit]
        on_trie[gone] = False
        left_at[gone] = depth
        fell = n[~hit] > 0
        score[gone[fell]] += np.log10(e[~hit][fell])
        if fell.any():
            sets.append((gone[fell], run[~hit][fell]))
            leavers, own_run = sets[-1]
            _score_leavers(words, score, leavers, own_run, depth, edges, lower)
            left_at[leavers] = depth + 1
    # What is left of each word is read with two bytes of context; the byte just after an escape is scored above.
    left_at[on_trie] = DEPTH
    rest = np.flatnonzero(left_at < np.fromiter(map(len, words), np.int64, len(words)) + 1)
    if len(rest):
        keys, word = sequences([words[i] for i in rest])
        first = np.append(0, np.flatnonzero(np.diff(word)) + 1)
        place = np.arange(len(word)) - np.repeat(first, np.diff(np.append(first, len(word))))
        later = place >= left_at[rest][word]
        score[rest] += np.bincount(word[later], lower.log(keys[later] >> 8, keys[later] & 255), minlength=len(rest))
    return score


def _score_leavers(words, score, leavers, run, depth, edges, lower) -> None:
    """Add the byte at which each word left the trie, which cannot be one that its context had."""
    order = np.argsort(edges[0], kind="stable")
    owner, byte_of = edges[0][order], edges[1][order]
    for lo in range(0, len(leavers), 4096):
        part, own = leavers[lo : lo + 4096], run[lo : lo + 4096]
        excluded = np.zeros((len(part), 256), bool)
        begin, stop = np.searchsorted(owner, own), np.searchsorted(owner, own, side="right")
        sizes = stop - begin
        at = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        excluded[np.repeat(np.arange(len(part)), sizes), byte_of[at]] = True
        read = [(b" " * ORDER + words[i] + b" ")[depth : depth + ORDER + 1] for i in part]
        context = np.array([int.from_bytes(r[:-1], "big") for r in read])
        byte = np.array([r[-1] for r in read])
        score[part] += np.log10(lower.probability(context, byte, excluded))


def seen_before(numbers: np.ndarray) -> np.ndarray:
    """How often each entry has occurred before."""
    order = np.argsort(numbers, kind="stable")
    first = np.append(True, np.diff(numbers[order]) != 0)[: len(numbers)]
    result = np.empty(len(numbers), np.int64)
    at = np.arange(len(numbers))
    result[order] = at - np.maximum.accumulate(np.where(first, at, 0))
    return result


def held_out(id_column: Column) -> Column:
    """Rows that nothing is learned from."""
    return F.coalesce(share_of(id_column, 7) == 2, F.lit(False))


def _word_counts(rows: DataFrame) -> DataFrame:
    """``(word, n)`` of the distinct words of ``(text, held_out)`` rows, the end as the empty word; ``n`` counts training rows."""

    def count(stream):
        for batch in stream:
            for start, stop in slices_by_bytes(batch.column("text")):
                part = batch.slice(start, stop - start)
                every: set[bytes] = {b""}
                trained: Counter[bytes] = Counter()
                for text, out in zip(part.column("text").to_pylist(), part.column("held_out").to_pylist(), strict=True):
                    if out:
                        every.update(lower_words_of(text))
                    else:
                        trained.update(lower_words_of(text))
                        trained[b""] += 1
                words = list(every | trained.keys())
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([trained[w] for w in words], pa.int64())], ["word", "n"])

    return rows.mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def escaping(words: list[bytes], counts: np.ndarray) -> list[bytes]:
    """The words that may leave the trie: those that training lacks, and those that are longer than it is deep."""
    return [w for w, n in zip(words, counts.tolist(), strict=True) if not n or len(w) >= DEPTH]


# What one pass over the placed words finds, told apart by ``kind``: sequences of bytes, byte counts of
# contexts that reach into other parts, left-out visits by state of those that do not, and the ``ORDER``
# bytes before each byte of words that may leave the trie.
SEQUENCE, OUTER, STATE, ASKED = range(4)
_SURVEY = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("number", pa.int64()), ("context", pa.binary()), ("byte", pa.int32()), ("n", pa.int64()), ("escapes", pa.int64())])


def _found(part: int, kind: int, n, number=None, context=None, byte=None, escapes=None) -> pa.Table:
    size = len(n)
    given = {"part": [part] * size, "kind": [kind] * size, "number": number, "context": context, "byte": byte, "n": n, "escapes": escapes}
    return pa.table([pa.nulls(size, f.type) if given[f.name] is None else pa.array(given[f.name], f.type) for f in _SURVEY], schema=_SURVEY)


def _survey(group: pa.Table) -> pa.Table:
    part = group.column("part")[0].as_py()
    words, counts = _sorted(group)
    keys, word = sequences(words)
    kept, where = np.unique(keys, return_inverse=True)
    sums = np.bincount(where, counts[word], len(kept)).astype(np.int64)
    marked = [w + b" " for w in words]
    outer = {m[:d] for m in (marked[0], marked[-1]) for d in range(min(len(m), DEPTH))}
    contexts, following, numbers = [], [], []
    for context in outer:
        own: Counter[int] = Counter()
        # The words that go on from a context stand together.
        begin = bisect_left(marked, context)
        stop = bisect_left(marked, True, begin, key=lambda m, c=context: not m.startswith(c))
        for m, n in zip(marked[begin:stop], counts[begin:stop].tolist(), strict=True):
            own[m[len(context)]] += n
        contexts += [context] * len(own)
        following += list(own)
        numbers += list(own.values())
    trie, states = Stretch(words, counts), []
    for depth in range(DEPTH):
        rows, run, total, child, below, child_first = trie.level(depth)
        if not len(rows):
            break
        child_run = run[np.searchsorted(rows, child_first)]
        kinds = np.bincount(child_run, below > 0, minlength=len(total)).astype(np.int64)
        edges = [int(r) for r in {run[0], run[-1]} if marked[rows[np.searchsorted(run, r)]][:depth] in outer]
        inside = ~np.isin(child_run, edges)
        states.append(left_out(depth, total[child_run[inside]], kinds[child_run[inside]], below[inside]))
    state_, visits, escapes = _by_state(*(np.concatenate(c) for c in zip(*states, strict=True)))
    asked = np.unique(sequences(escaping(words, counts))[0] >> 8)
    return pa.concat_tables([
        _found(part, SEQUENCE, sums[sums > 0], number=kept[sums > 0]),
        _found(part, OUTER, numbers, context=contexts, byte=following),
        _found(part, STATE, visits, number=state_, escapes=escapes),
        _found(part, ASKED, np.ones(len(asked), np.int64), number=asked),
    ])


def _by_state(states: np.ndarray, visits: np.ndarray, escapes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kept, where = np.unique(states, return_inverse=True)
    return kept.astype(np.int64), np.bincount(where, visits, len(kept)).astype(np.int64), np.bincount(where, escapes, len(kept)).astype(np.int64)


def _sorted(group: pa.Table) -> tuple[list[bytes], np.ndarray]:
    words, counts = group.column("word").to_pylist(), group.column("n").to_numpy()
    order = sorted(range(len(words)), key=lambda i: words[i] + b" ")
    return [words[i] for i in order], counts[order]


def _by_order(numbers: DataFrame, n_bytes: int) -> DataFrame:
    """Each row once for each order, with ``last``: the order's last bytes of ``number`` and ``n_bytes`` more."""
    orders = numbers.withColumn("order", F.explode(F.array(*map(F.lit, range(ORDER + 1)))))
    return orders.withColumn("last", F.expr(f"number & (shiftleft(1L, 8 * (order + {n_bytes})) - 1)")).drop("number")


def _lower(survey: DataFrame) -> DataFrame:
    """``(part, order, followers)``: for each part, how often each byte followed the contexts that its words may ask for.

    A context is one row, with at most 256 followers as ``(context * 256 + byte, n)``. A part asks for at most as
    many contexts as its words have bytes.
    """
    whole = survey.filter(F.col("kind") == SEQUENCE).groupBy("number").agg(F.sum("n").alias("n"))
    counts = _by_order(whole, 1).groupBy("order", "last").agg(F.sum("n").alias("n"))
    followed = counts.groupBy("order", F.shiftright("last", 8).alias("context")).agg(F.collect_list(F.struct("last", "n")).alias("followers"))
    asked = _by_order(survey.filter(F.col("kind") == ASKED).select("part", "number"), 0).withColumnRenamed("last", "context").distinct()
    return asked.join(followed, ["order", "context"]).select("part", "order", "followers")


def _lower_of(rows: pa.Table) -> Lower:
    """The contexts of one part, in any order."""
    lists = rows.column("followers").combine_chunks()
    orders = np.repeat(rows.column("order").to_numpy(), lists.value_lengths().to_numpy())
    keys, counts = (lists.flatten().field(name).to_numpy() for name in ("last", "n"))
    made = []
    for order in range(ORDER + 1):
        own = np.flatnonzero(orders == order)
        own = own[np.argsort(keys[own])]
        made.append((keys[own], counts[own]))
    return Lower(made)


def _escapes(survey: DataFrame, totals: DataFrame) -> np.ndarray:
    def outer_states(stream):
        for batch in stream:
            for context, own in zip(batch.column("context").to_pylist(), batch.column("own").to_pylist(), strict=True):
                own = np.array(own, np.int64)
                kinds, total = np.full(len(own), (own > 0).sum()), np.full(len(own), own.sum())
                made = _by_state(*left_out(len(context), total, kinds, own))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in made], ["number", "n", "escapes"])

    lists = totals.groupBy("context").agg(F.collect_list("n").alias("own"))  # at most 256 each
    inner = survey.filter(F.col("kind") == STATE).select("number", "n", "escapes")
    states = inner.unionByName(lists.mapInArrow(outer_states, "number bigint, n bigint, escapes bigint"))
    # At most DEPTHS * COUNTS * KINDS rows.
    table = states.groupBy("number").agg(F.sum("n").alias("n"), F.sum("escapes").alias("escapes")).toArrow()
    return escape_table(*(table.column(c).to_numpy() for c in ("number", "n", "escapes")))


def word_scores(counts: DataFrame) -> DataFrame:
    """``(part, word, n, log_p)`` of distinct ``(word, n)`` rows: the model that the counts give, applied to every word.

    Parts are consecutive stretches of the words in the order of their bytes with an end mark; the result is stored.
    """
    counts = counts.select("word", "n")
    parts = max(1, math.ceil(counts.count() / WORDS_PER_PART))
    placed = counts.repartitionByRange(parts, F.concat("word", F.lit(b" "))).withColumn("part", F.spark_partition_id())
    placed = materialize(placed, "placed")
    schema = "part int, kind int, number bigint, context binary, byte int, n bigint, escapes bigint"
    survey = materialize(placed.groupBy("part").applyInArrow(_survey, schema), "survey")
    outer = survey.filter(F.col("kind") == OUTER)
    totals = outer.groupBy("context", "byte").agg(F.sum("n").alias("n"))
    edges = outer.select("part", "context").distinct().join(totals, "context").select("part", F.lit(-1).alias("order"), "context", F.col("byte").cast("long").alias("last"), "n")
    needed = edges.unionByName(_lower(survey), allowMissingColumns=True)
    shipped = counts.sparkSession.sparkContext.broadcast(_escapes(survey, totals))

    def score(group: pa.Table, given: pa.Table) -> pa.Table:
        orders = given.column("order").to_numpy()
        edges, lower = given.filter(pa.array(orders < 0)), given.filter(pa.array(orders >= 0))
        known: dict[bytes, dict[int, int]] = {}
        for context, byte, n in zip(*(edges.column(c).to_pylist() for c in ("context", "last", "n")), strict=True):
            known.setdefault(context, {})[byte] = n
        words, own = _sorted(group) if group.num_rows else ([], np.empty(0, np.int64))
        made = score_words(words, own, known, shipped.value, _lower_of(lower)) if words else []
        part = group.column("part").to_pylist()[:1] * len(words)
        return pa.table({"part": pa.array(part, pa.int32()), "word": pa.array(words, pa.binary()), "n": own, "log_p": pa.array(made, pa.float64())})

    scored = placed.groupBy("part").cogroup(needed.groupBy("part")).applyInArrow(score, "part int, word binary, n bigint, log_p double")
    return materialize(scored, "scored")


_ASKED = "part int, salt int, block bigint, words binary"
_TOLD = "block bigint, part int, data binary"


def _block_words(texts: pa.Table) -> list[bytes]:
    every: set[bytes] = {b""}
    for text in texts.column("text").to_pylist():
        every.update(lower_words_of(text))
    return sorted(w + b" " for w in every)


def _look_up(dealt: DataFrame, n_blocks: int, scored: DataFrame) -> DataFrame:
    """For each block and part, count and score of the block's words there, in order.

    Blocks that ask a part are dealt to as many tasks as their lists need, each with the part's words.
    """
    # A word is asked for by no more blocks than it occurs in; of rows held out the counts know nothing but one.
    lists = F.sum(F.least(F.col("n") + 1, F.lit(n_blocks)) * (F.octet_length("word") + 1))
    salts = F.ceil(lists / F.lit(ANSWER_BYTES)).cast("int").alias("salts")
    plan = materialize(scored.groupBy("part").agg(F.min(F.concat("word", F.lit(b" "))).alias("first"), salts), "parts")
    # One row for WORDS_PER_PART distinct words.
    shipped = dealt.sparkSession.sparkContext.broadcast([(bytes(r["first"]), r["part"], r["salts"]) for r in plan.orderBy("part").collect()])

    def ask(texts: pa.Table) -> pa.Table:
        marked, block = _block_words(texts), texts.column("block")[0].as_py()
        cuts = [bisect_left(marked, first) for first, _, _ in shipped.value[1:]]
        rows = [
            (p, block % salts, block, zlib.compress(b"".join(marked[a:b]), 1))
            for (_, p, salts), a, b in zip(shipped.value, [0, *cuts], [*cuts, len(marked)], strict=True)
            if a < b
        ]
        return pa.table([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), asked_schema, strict=True)], schema=asked_schema)

    def tell(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return told_schema.empty_table()
        number = {w: i for i, w in enumerate(held.column("word").to_pylist())}
        n, log_p = held.column("n").to_numpy(), held.column("log_p").to_numpy()
        data = []
        for words in asked.column("words").to_pylist():
            at = np.fromiter(map(number.__getitem__, zlib.decompress(words).split(b" ")[:-1]), np.int64)
            data.append(zlib.compress(n[at].tobytes(), 1) + log_p[at].astype(np.float32).tobytes())
        return pa.table({"block": asked.column("block"), "part": asked.column("part"), "data": pa.array(data, pa.binary())})

    told_schema = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("data", pa.binary())])
    asked_schema = pa.schema([("part", pa.int32()), ("salt", pa.int32()), ("block", pa.int64()), ("words", pa.binary())])
    asked = dealt.groupBy("block").applyInArrow(ask, _ASKED)
    held = scored.join(plan.select("part", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")), "part")
    return asked.groupBy("part", "salt").cogroup(held.groupBy("part", "salt")).applyInArrow(tell, _TOLD)


def _told(found: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Counts and scores of a block's words, all parts in order."""
    counts, scores_ = [np.empty(0, np.int64)], [np.empty(0, np.float32)]
    for _, data in sorted(zip(found.column("part").to_pylist(), found.column("data").to_pylist(), strict=True)):
        unpack = zlib.decompressobj()
        counts.append(np.frombuffer(unpack.decompress(data), np.int64))
        scores_.append(np.frombuffer(unpack.unused_data, np.float32))
    return np.concatenate(counts), np.concatenate(scores_)


def scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of every row under the model of the rows that are not held out.

    ``(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score)``. Tokens are the words of a
    text, A-Z lowered, and one end; a null or blank text is an end alone. ``base_score`` is that of
    add-one smoothed token counts, ``score`` the adaptive model's log10 probability. Repeated rows count
    and are scored each; a null id is not held out. Other columns are ignored.
    """
    dealt, n_blocks = blocks(df, id_col, text_col)
    dealt = dealt.withColumn("held_out", held_out(F.col("id")))
    counts = materialize(_word_counts(dealt.select("text", "held_out")), "words")
    n_train, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()
    known = _look_up(dealt, n_blocks, word_scores(counts))
    id_type = dealt.schema["id"]
    schema = T.StructType([
        id_type, T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
        T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
    ])

    def score(texts: pa.Table, found: pa.Table) -> pa.Table:
        number = {w[:-1]: i for i, w in enumerate(_block_words(texts))}
        n, log_p = _told(found)
        base, p = np.log10((n + 1) / (n_train + kinds + 1)), 10.0 ** log_p.astype(float)
        rows = []
        for text in texts.column("text").to_pylist():
            own = np.fromiter(map(number.__getitem__, [*lower_words_of(text), b""]), np.int64)
            t = np.arange(len(own))
            adapted = ADAPT * t / (t + WARM_UP)
            blended = (1 - adapted) * p[own] + adapted * seen_before(own) / np.maximum(t, 1)
            rows.append((len(own), int((n[own] > 0).sum()), float(base[own].sum()), float(np.log10(blended).sum())))
        columns = [list(c) for c in zip(*rows, strict=True)] or [[], [], [], []]
        kinds_ = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
        made = [pa.array(c, k) for c, k in zip(columns, kinds_, strict=True)]
        return pa.Table.from_arrays([texts.column("id"), texts.column("held_out"), *made], schema.names)

    scored = dealt.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(score, schema)
    return scored.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), "base_score", "score")
