"""Benchmark decontamination with CGK random walks over words.

A CGK embedding walks over a text: step j writes down the word it stands on, and a coin that follows from
that word and j decides whether it moves on. Two texts that agree where a walk starts give the same
coordinates until it comes to an edit, so edit distance becomes Hamming distance. Each repetition has
coins and sampled steps of its own; the words that a window has at the sampled steps are its key.

One walk from the start of an item-sized window loses step at the first few edits and seldom finds it
again, so its windows are entered at several anchors. An item that may have k edits is cut into k + 1
stretches; wherever the edits fall, they leave one untouched. A walk starts at the anchor of each, and
samples count up to the stretch's end, so one of them agrees: the target recall is 1, for any placement.
Of the repetitions, a stretch takes the one that samples most of its words. Words that many items have in
common are left out of the stretches where enough others are left.

All places of the documents are walked at once; a place is left as soon as no key goes on like it, which
for nearly all is the first or second sample. Candidates that hold too few of the item's words are left
out, which loses none, and the others are verified: the least number of word edits that turn the item
into some stretch of the document there, by dynamic programming.

Items are taken in slices of bounded size, each sent to the executors; documents are not shuffled.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import filter_rows, id_and_text, lower_words_of, slices_by_bytes

SIMILARITY = 0.8
LEAST_WORDS = 5
# Share of the places within the similarity that are found.
RECALL = 1.0
SLICE_WORDS = 2_000_000
# Repetitions, each with coins and sampled steps of its own, and the share of steps that are sampled.
WALKS = 2
SAMPLED = 0.75
# A walk ends after this many words of a stretch, or three times as many steps.
SEED_WORDS = 8
STEPS = 3 * SEED_WORDS
# Three words in a row that more items have are avoided as anchors; candidates are verified in pieces of so many.
MANY_ITEMS = 16
PIECE = 1 << 18
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def allowed_edits(n_words: int, similarity: float = SIMILARITY) -> int:
    return int((1 - similarity) * n_words + 1e-9)


def _mix(key: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    key = (key ^ symbol.astype(np.uint64)) * _MULTIPLIER
    return key ^ (key >> np.uint64(29))


def _coins(symbols: np.ndarray, walk: int, step: int) -> np.ndarray:
    """Whether a walk moves on from each symbol at a step: one fair coin per walk, step and symbol."""
    return (_mix(_mix(np.uint64(STEPS * walk + step + 1), symbols), symbols) >> np.uint64(40)).astype(np.int64) & 1


def _samples(walk: int) -> list[bool]:
    """Which steps a walk samples. The first one is, so that places can be told apart at once."""
    return [True, *(np.random.default_rng(walk).random(STEPS - 1) < SAMPLED).tolist()]


@dataclass
class Walk:
    """The keys of one repetition: for each sampled step those that go on and those that end there, with owners."""

    number: int
    first: np.ndarray
    sampled: list[bool]
    prefixes: list[np.ndarray]
    ends: list[np.ndarray]
    # Owners of key ``ends[step][n]`` are those from ``bounds[step][n]`` to ``bounds[step][n + 1]``.
    bounds: list[np.ndarray]
    item: np.ndarray
    offset: np.ndarray


@dataclass
class Items:
    # Ids of each distinct sequence of words.
    ids: list[list]
    words: list[np.ndarray]
    vocabulary: dict[bytes, int]
    walks: list[Walk]
    similarity: float


def prepare(items: list[tuple], similarity: float = SIMILARITY) -> Items:
    """Index ``(id, text)`` rows. Items of fewer than ``LEAST_WORDS`` words, null ones among them, are left out."""
    vocabulary: dict[bytes, int] = {}
    by_words: dict[tuple, list] = defaultdict(list)
    for item, text in items:
        own = lower_words_of(text)
        if len(own) >= LEAST_WORDS:
            # 0 is any word that no item has, 1 the space after a text.
            by_words[tuple(vocabulary.setdefault(w, len(vocabulary) + 2) for w in own)].append(item)
    words = [np.array(own, np.int64) for own in by_words]
    owners = []
    for i, (own, rare) in enumerate(zip(words, _rare_triples(words), strict=True)):
        owners += [(i, a, b) for a, b in stretches(len(own), allowed_edits(len(own), similarity) + 1, rare)]
    walks = _walks(words, np.array(owners, np.int64).reshape(-1, 3), len(vocabulary) + 2)
    return Items(list(by_words.values()), words, vocabulary, walks, similarity)


def _rare_triples(words: list[np.ndarray]) -> list[np.ndarray]:
    """For each item and place, whether at most ``MANY_ITEMS`` items have the three words from there on."""
    keys = [_mix(_mix(_mix(np.zeros(len(own) - 2, np.uint64), own[:-2]), own[1:-1]), own[2:]) for own in words]
    seen, counts = np.unique(np.concatenate([np.unique(k) for k in keys]) if keys else np.empty(0, np.uint64), return_counts=True)
    return [counts[np.searchsorted(seen, k)] <= MANY_ITEMS for k in keys]


def stretches(n_words: int, parts: int, rare: np.ndarray) -> list[tuple[int, int]]:
    """``parts`` stretches of an item that do not overlap, each with rare words if there are as many such."""
    cuts = [n_words * j // parts for j in range(parts + 1)]
    even = [(a, min(b, a + SEED_WORDS)) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b]
    if all(b - a < 3 or rare[a : b - 2].any() for a, b in even):
        return even
    for length in range(min(n_words // parts, SEED_WORDS), 2, -1):
        chosen, at = [], 0
        while at + length <= n_words and len(chosen) < parts:
            if rare[at : at + length - 2].all():
                chosen.append((at, at + length))
                at += length
            else:
                at += 1
        if len(chosen) == parts:
            return chosen
    return even


def _walks(words: list[np.ndarray], owners: np.ndarray, n_symbols: int) -> list[Walk]:
    """Walk over all stretches (item, begin, end) in each repetition; give each to the one that samples most of its words."""
    flat = np.concatenate([*words, np.ones(1, np.int64)])
    base = np.cumsum([0, *map(len, words)])[owners[:, 0]]
    begin, end = base + owners[:, 1], base + owners[:, 2]
    runs = []
    for walk in range(WALKS):
        at, key = begin.copy(), np.zeros(len(owners), np.uint64)
        last, distinct, place = np.zeros(len(owners), np.int64), np.zeros(len(owners), np.int64), np.full(len(owners), -1)
        keys = []
        for step, sampled in enumerate(_samples(walk)):
            inside = at < end
            symbol = flat[np.minimum(at, len(flat) - 1)]
            if sampled:
                key = np.where(inside, _mix(key, symbol), key)
                distinct += inside & (at != place)
                place, last = np.where(inside, at, place), np.where(inside, step, last)
            keys.append(key)
            at = at + _coins(symbol, walk, step)
        runs.append((distinct, last, keys))
    chosen = np.argmax([distinct for distinct, _, _ in runs], axis=0)
    found = []
    for walk, (_, last, keys) in enumerate(runs):
        own = np.flatnonzero(chosen == walk)
        first = np.zeros(n_symbols, bool)
        first[flat[begin[own]]] = True
        prefixes, ends, bounds, order, held = [], [], [], [np.empty(0, np.int64)], 0
        for step in range(STEPS):
            ended = own[last[own] == step]
            ended = ended[np.argsort(keys[step][ended], kind="stable")]
            prefixes.append(np.unique(keys[step][own[last[own] > step]]))
            ends.append(np.unique(keys[step][ended]))
            bounds.append(held + np.append(np.searchsorted(keys[step][ended], ends[-1]), len(ended)))
            order.append(ended)
            held += len(ended)
        entries = np.concatenate(order)
        found.append(Walk(walk, first, _samples(walk), prefixes, ends, bounds, owners[entries, 0], owners[entries, 1]))
    return found


def _member(keys: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are among the known ones, and where."""
    if not len(known):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return known[place] == keys, place


def candidates(symbols: np.ndarray, items: Items) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of all places where a walk agrees: the item, where it would begin without edits, and the place, in pieces sorted by item.

    Of symbols the last ``STEPS`` are spaces after a text.
    """
    for walk in items.walks:
        hits = []
        start = np.flatnonzero(walk.first[symbols])
        at, key = start, np.zeros(len(start), np.uint64)
        for step, sampled in enumerate(walk.sampled):
            if not len(at):
                break
            symbol = symbols[at]
            if sampled:
                key = _mix(key, symbol)
                ended, place = _member(key, walk.ends[step])
                ended = np.flatnonzero(ended)
                hits.append((start[ended], walk.bounds[step][place[ended]], walk.bounds[step][place[ended] + 1]))
                live = _member(key, walk.prefixes[step])[0]
                start, at, key, symbol = start[live], at[live], key[live], symbol[live]
            at = at + _coins(symbol, walk.number, step)
        if not hits:
            continue
        place, low, high = (np.concatenate(c) for c in zip(*hits, strict=True))
        order = np.argsort(place, kind="stable")
        place, low, lengths = place[order], low[order], (high - low)[order]
        # A key that many items have is cut by places, so that no more than a piece and one key's items are held.
        piece = np.cumsum(lengths) // PIECE
        cuts = np.append(np.flatnonzero(np.diff(piece, prepend=-1)), len(piece))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            n = lengths[a:b]
            entry = np.repeat(low[a:b] - np.cumsum(n) + n, n) + np.arange(n.sum())
            where = np.repeat(place[a:b], n)
            item, begin = walk.item[entry], where - walk.offset[entry]
            by_item = np.lexsort((begin, item))
            yield item[by_item], begin[by_item], where[by_item]


def verify(item: np.ndarray, stretches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of an item against any part of each stretch (a row each), and where the first such part ends."""
    width = stretches.shape[1]
    columns = np.arange(width + 1)
    row = np.zeros((len(stretches), width + 1), np.int64)
    for i, word in enumerate(item, 1):
        new = np.empty_like(row)
        new[:, 0] = i
        new[:, 1:] = np.minimum(row[:, :-1] + (stretches != word), row[:, 1:] + 1)
        row = np.minimum.accumulate(new - columns, axis=1) + columns
    return row.min(axis=1), row.argmin(axis=1)


def _verified(
    piece: tuple[np.ndarray, np.ndarray, np.ndarray], symbols: np.ndarray, begins: np.ndarray, lengths: np.ndarray,
    items: Items, own_words: np.ndarray, best: dict[tuple[int, int], tuple[int, int, int]],
) -> None:
    """Verify a piece of candidates; keep in ``best`` the best place of each document and item."""
    owners, all_places, at = piece
    # A beginning may lie before the document's own; the place of the seed tells which document it is.
    all_owners = np.searchsorted(begins, at, side="right") - 1
    bounds = np.append(np.flatnonzero(np.diff(owners, prepend=-1)), len(owners))
    for start, stop_at in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        i = int(owners[start])
        item = items.words[i]
        k = allowed_edits(len(item), items.similarity)
        # Two seeds of one place are one candidate.
        places, owner = all_places[start:stop_at], all_owners[start:stop_at]
        new = np.append(True, (np.diff(places) != 0) | (np.diff(owner) != 0))
        places, owner = places[new], owner[new]
        own_words[item] = True
        ends = begins[owner] + lengths[owner]
        step = max(1, min(4096, (1 << 20) // len(item)))
        for lo in range(0, len(places), step):
            part, low, high = places[lo : lo + step], begins[owner[lo : lo + step]], ends[lo : lo + step]
            index = part[:, None] + np.arange(-k, len(item) + k)
            inside = (index >= low[:, None]) & (index < high[:, None])
            stretch = np.where(inside, symbols[np.clip(index, 0, len(symbols) - 1)], -1)
            # Words that are not edited away have their like in the stretch.
            enough = np.flatnonzero((own_words[stretch] & inside).sum(axis=1) >= len(item) - k)
            if not len(enough):
                continue
            part, low, stretch = part[enough], low[enough], stretch[enough]
            edits, stop = verify(item, stretch)
            for n in np.flatnonzero(edits <= k).tolist():
                back_edits, back = verify(item[::-1], stretch[n : n + 1, : stop[n]][:, ::-1])
                first = int(part[n] - k + stop[n] - back[0] - low[n])
                found = (int(edits[n]), first, int(part[n] - k + stop[n] - low[n]))
                where = int(owner[lo + enough[n]]), i
                if where not in best or found < best[where]:
                    best[where] = found
        own_words[item] = False


def leaks_of(documents: list[list[bytes]], items: Items) -> list[list[tuple[int, int, int, int]]]:
    """For each document its ``(item, edits, first word, word after the last)``: the best place of each item it holds."""
    gap = np.ones(STEPS, np.int64)
    known = items.vocabulary
    pieces, starts, at = [], [], 0
    for words in documents:
        starts.append(at)
        pieces += [np.fromiter(map(known.get, words, repeat(0)), np.int64, len(words)), gap]
        at += len(words) + len(gap)
    result: list[list[tuple[int, int, int, int]]] = [[] for _ in documents]
    if not pieces or not items.words:
        return result
    symbols, begins = np.concatenate(pieces), np.array(starts)
    lengths = np.array([len(words) for words in documents])
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    own_words = np.zeros(len(known) + 2, bool)
    for piece in candidates(symbols, items):
        _verified(piece, symbols, begins, lengths, items, own_words, best)
    for (d, i), found in sorted(best.items()):
        result[d].append((i, *found))
    return result


def _slices(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """The items in slices of about ``SLICE_WORDS`` words; one slice is on the driver at a time."""
    items = id_and_text(benchmark, id_col, text_col).dropna()
    total = items.agg(F.sum(F.size(F.split(F.trim("text"), r"[ \t\n\x0B\f\r]+")))).first()[0] or 0
    count = max(1, math.ceil(total / SLICE_WORDS))
    for s in range(count):
        own = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == s)
        yield sorted({(r.id, r.text) for r in own.toLocalIterator()})


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", similarity: float = SIMILARITY,
) -> DataFrame:
    """``(id_col, item_col, edits, similarity, first_word, end_word)``, one row for each document and item in it.

    A document holds an item if some stretch of it differs from the item's words, lowered, in at most
    a share of ``1 - similarity`` of them; of several places the one with fewest edits is returned, then
    the first. Null, empty and shorter texts hold nothing, items of fewer than five words or without id
    are in nothing. A repeated document row has its rows again; an item id with several texts has rows
    for each, and of several ids with one text each has its rows. A very long text is searched whole, in a
    batch of its own; without documents or items there are no rows. Other columns are ignored.
    """
    rows = id_and_text(docs, id_col, text_col)
    schema = T.StructType([
        rows.schema["id"], T.StructField("item", benchmark.schema[item_col].dataType), T.StructField("edits", T.IntegerType()),
        T.StructField("similarity", T.DoubleType()), T.StructField("first_word", T.LongType()), T.StructField("end_word", T.LongType()),
    ])

    def searched(part: list[tuple]) -> DataFrame:
        shipped = docs.sparkSession.sparkContext.broadcast(prepare(part, similarity))

        def batches(stream):
            items = shipped.value
            for batch in stream:
                for start, stop in slices_by_bytes(batch.column("text"), 4 << 20):
                    texts = batch.column("text").slice(start, stop - start).to_pylist()
                    owners, found = [], []
                    for d, own in enumerate(leaks_of([lower_words_of(t) for t in texts], items)):
                        for i, *place in own:
                            owners += [start + d] * len(items.ids[i])
                            found += [(i, name, *place) for name in items.ids[i]]
                    if found:
                        item, names, edits, first, end = (list(c) for c in zip(*found, strict=True))
                        score = [1 - e / len(items.words[i]) for i, e in zip(item, edits, strict=True)]
                        columns = [batch.column("id").take(pa.array(owners)), pa.array(names), pa.array(edits, pa.int32()), score, pa.array(first), pa.array(end)]
                        yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], schema.names)

        return rows.mapInArrow(batches, schema)

    parts = [searched(part) for part in _slices(benchmark, id_col=item_col, text_col=item_text_col)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.withColumnsRenamed({"id": id_col, "item": item_col})


def clean(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", similarity: float = SIMILARITY,
) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no item, as ``leaks`` finds them."""
    for part in _slices(benchmark, id_col=item_col, text_col=item_text_col):
        shipped = docs.sparkSession.sparkContext.broadcast(prepare(part, similarity))

        def free(texts, shipped=shipped):
            return [not own for own in leaks_of([lower_words_of(t) for t in texts], shipped.value)]

        docs = filter_rows(docs, text_col, free)
    return docs
