"""BPE encoding and decoding in batched numpy merge rounds.

All pre-tokens of a batch that are not known yet lie side by side in one flat symbol array. A round
looks up every neighbouring pair by binary search over the sorted pair keys, finds the lowest rank of
each pre-token with one segmented minimum, and merges that pair wherever it stands in that
pre-token, from the left. Pre-tokens without a pair left leave the array, so later rounds are small.

The vocabulary ends words with a mark, lowers case and drops white space, so a decoded text is its
tokens joined by one space, not the text that was encoded. A bounded dictionary per worker keeps the
tokens of words; emptying it costs time only.
"""

from __future__ import annotations

import functools
import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import NON_SPACE, WHITE_SPACE, id_and_text, map_text
from .token_counts import byte_characters

KEPT_WORDS = 250_000
BATCH_BYTES = 2 << 20
NO_RANK = np.iinfo(np.int64).max
# Letters and numbers of newer Unicode versions, which are neither to the tokenizers library (fixed values).
NEWER = (
    "\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c-\uab6d\U000107bb-\U000107bf"
    "\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1"
    "\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6"
    "\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2"
    "\U0001b123-\U0001b128\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff"
    "\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff"
    "\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
_NEWER = regex.compile(f"[{NEWER}]")
# Pre-token pattern of the vocabulary (fixed value).
_PIECE_OR_BORDER = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE_SPACE}\p{{L}}\p{{N}}]+|\n")
# The same for texts with any of the newer ones.
_PIECE_AMONG_NEWER = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|(?:(?![{NEWER}])\p{{L}})+|(?![{NEWER}])\p{{N}}|(?:[{NEWER}]|[^{WHITE_SPACE}\p{{L}}\p{{N}}])+|\n"
)
# Marks that the library's normal form takes for letters, as they are newer than its tables (fixed values).
_LETTER_LIKE_MARKS = regex.compile(
    "([\u07fd\u0898-\u089f\u08ca-\u08d3\u09fe\u0c3c\u0d3b-\u0d3c\u0eba\u1715\u1abf-\u1ace\u1df6-\u1dfa\ua82c\U00010d24-\U00010d27"
    "\U00010eab-\U00010eac\U00010efd-\U00010eff\U00010f46-\U00010f50\U00010f82-\U00010f85\U00011070\U0001133b\U0001145e"
    "\U00011839-\U0001183a\U0001193d-\U0001193e\U00011943\U000119e0\U00011a34\U00011a47\U00011a99\U00011d42\U00011d44-\U00011d45"
    "\U00011d97\U00011f41-\U00011f42\U00016ff0-\U00016ff1\U0001e08f\U0001e130-\U0001e136\U0001e2ae\U0001e2ec-\U0001e2ef\U0001e4ec-\U0001e4ef]+)"
)
# Lower case of letters that Python may not know yet (fixed values). Capital sigma is lowered by itself, whatever stands next to it.
_LOWER = str.maketrans({
    "Σ": "σ", "\u1c89": "\u1c8a", "\ua7cb": "\u0264", "\ua7cc": "\ua7cd", "\ua7ce": "\ua7cf", "\ua7d2": "\ua7d3", "\ua7d4": "\ua7d5",
    "\ua7da": "\ua7db", "\ua7dc": "\u019b",
    **{chr(c): chr(c + 0x20) for c in range(0x10D50, 0x10D66)}, **{chr(c): chr(c + 0x1B) for c in range(0x16EA0, 0x16EB9)},
})


def normal_form(text: str) -> str:
    """Composed and lowered, as the vocabulary's normalizer does it."""
    if text.isascii():
        return text.lower()
    # What stands on either side of a letter that nothing composes with does so by itself.
    composed = "".join(unicodedata.normalize("NFC", part) for part in _LETTER_LIKE_MARKS.split(text))
    return composed.translate(_LOWER).lower()


class MergeTable:
    """Pairs as sorted integer keys, with the rank and the product of each."""

    def __init__(self, pairs: np.ndarray, made: np.ndarray, n_symbols: int):
        self.n_symbols = n_symbols
        keys = pairs[:, 0] * n_symbols + pairs[:, 1]
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order, made[order]

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge each of the consecutive pre-tokens of the given lengths as far as it goes; their symbols and lengths then."""
        names = np.flatnonzero(lengths)
        lengths = lengths[names]
        ended: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        n_pieces = int(names[-1]) + 1 if len(names) else 0
        while len(names):
            starts = np.cumsum(lengths) - lengths
            keys = symbols[:-1] * self.n_symbols + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            ranks = np.full(len(symbols), NO_RANK)
            ranks[:-1] = np.where(self.keys[at] == keys, self.ranks[at], NO_RANK)
            ranks[starts + lengths - 1] = NO_RANK
            best = np.minimum.reduceat(ranks, starts)
            over = best == NO_RANK
            piece = np.repeat(np.arange(len(names)), lengths)
            if over.any():
                ended.append((names[over], lengths[over], symbols[over[piece]]))
            # In a run such as "aaaa" every position hits; only each second one is merged.
            where = np.flatnonzero((ranks == best[piece]) & (ranks != NO_RANK))
            first = np.flatnonzero(np.diff(where, prepend=-2) != 1)
            run = np.repeat(first, np.diff(np.append(first, len(where))))
            where = where[(np.arange(len(where)) - run) % 2 == 0]
            symbols[where] = self.made[at[where]]
            keep = ~over[piece]
            keep[where + 1] = False
            merged = np.bincount(piece[where], minlength=len(names))
            symbols, names, lengths = symbols[keep], names[~over], (lengths - merged)[~over]
        # Put the pre-tokens, which ended in different rounds, back in order.
        if not ended:
            return symbols[:0], np.zeros(n_pieces, np.int64)
        names, lengths, symbols = (np.concatenate(part) for part in zip(*ended, strict=True))
        order = np.argsort(names)
        full = np.zeros(n_pieces, np.int64)
        full[names] = lengths
        return symbols[spans((np.cumsum(lengths) - lengths)[order], lengths[order])], full


def spans(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indexes of consecutive runs, given by where each begins and its length."""
    stops = np.cumsum(lengths)
    return np.repeat(begins - (stops - lengths), lengths) + np.arange(stops[-1] if len(stops) else 0)


class WordBpe:
    """A BPE with end-of-word marks, read from a tokenizers file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, self.suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        vocab = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {number: token for token, number in (vocab | self.special).items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        pairs = np.array([(vocab[a], vocab[b]) for a, b in merges], np.int64)
        self.table = MergeTable(pairs, np.array([vocab[a + b] for a, b in merges], np.int64), max(self.tokens) + 1)
        self.names = np.array([self.tokens.get(i, "") for i in range(max(self.tokens) + 1)], object)
        characters = {b: c for c, b in byte_characters().items()}
        self.inner = np.array([vocab[characters[b]] for b in range(256)], np.int64)
        self.final = np.array([vocab[characters[b] + self.suffix] for b in range(256)], np.int64)
        self._special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self._forget()

    def _forget(self) -> None:
        """Start over with the special strings only."""
        self._words = {s: i for i, s in enumerate(self.special)}
        self._store = np.array(list(self.special.values()), np.int64)
        self._begins, self._lengths = np.arange(len(self.special)), np.ones(len(self.special), np.int64)

    def _learn(self, words: list[str]) -> None:
        if not words:
            return
        lowered = normal_form("\n".join(words))
        pattern = _PIECE_AMONG_NEWER if not lowered.isascii() and _NEWER.search(lowered) else _PIECE_OR_BORDER
        pieces = [p.encode() for p in pattern.findall(lowered)]
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        joined = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum(sizes) - 1
        border = joined[ends] == ord("\n")
        symbols = self.inner[joined]
        symbols[ends] = self.final[joined[ends]]
        made, counts = self.table.merge(symbols[np.repeat(~border, sizes)], sizes[~border])
        own = np.bincount(np.cumsum(border)[~border], counts, minlength=len(words)).astype(np.int64)
        for word in words:
            self._words[word] = len(self._words)
        self._begins = np.append(self._begins, len(self._store) + np.cumsum(own) - own)
        self._lengths = np.append(self._lengths, own)
        self._store = np.append(self._store, made)

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Flat token ids of all texts, and the number of tokens of each."""
        if len(self._words) > KEPT_WORDS:
            self._forget()
        words: list[str] = []
        sizes = []
        for text in texts:
            before = len(words)
            if text:
                if any(s in text for s in self.special):
                    marks = [*self._special.findall(text), None]
                    for part, mark in zip(self._special.split(text), marks, strict=True):
                        words += NON_SPACE.findall(part)
                        words += [mark] if mark else []
                else:
                    words += NON_SPACE.findall(text)
            sizes.append(len(words) - before)
        self._learn([w for w in dict.fromkeys(words) if w not in self._words])
        rows = np.fromiter(map(self._words.__getitem__, words), np.int64, len(words))
        flat = self._store[spans(self._begins[rows], self._lengths[rows])]
        upto = np.append(0, np.cumsum(self._lengths[rows]))[np.cumsum(np.array(sizes, np.int64))]
        return flat, np.diff(upto, prepend=0)

    def decode(self, ids) -> str:
        """What the vocabulary file's decoder, which has no rule of its own, gives: tokens joined by a space."""
        return " ".join(map(self.tokens.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``(id_col, token_ids)``: the ids of every whole text, without special tokens around it.

    With ``decoded`` the ids are decoded again in the same pass, and that text is added. Special strings
    inside a text become their own ids. A null or empty text has no ids. Repeated rows are encoded each;
    other columns of ``df`` are ignored. ``path`` names the file on the executors. A very long text is
    encoded whole, in a batch of its own; an empty table gives no rows.
    """

    def rows(texts):
        bpe = word_bpe(path)
        flat, counts = bpe.encode_batch(texts)
        ends = np.append(0, np.cumsum(counts))
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
        if not decoded:
            return [ids]
        return [ids, [" ".join(bpe.names[flat[a:b]]) for a, b in zip(ends[:-1], ends[1:], strict=True)]]

    fields = [("token_ids", T.ArrayType(T.IntegerType()), pa.list_(pa.int32()))]
    if decoded:
        fields.append(("decoded", T.StringType(), pa.string()))
    return map_text(id_and_text(df, id_col, text_col), fields, rows, BATCH_BYTES).withColumnRenamed("id", id_col)


def decode(df: DataFrame, path: str, ids_col: str = "token_ids") -> DataFrame:
    """Add ``decoded`` to the rows of ``encode``; null where the ids are null."""
    schema = T.StructType([*[f for f in df.schema if f.name != "decoded"], T.StructField("decoded", T.StringType())])

    def batches(stream):
        bpe = word_bpe(path)
        for batch in stream:
            ids = batch.column(ids_col)
            made = []
            for own in ids:
                flat = own.values.to_numpy(zero_copy_only=False) if own.is_valid else None
                made.append(None if flat is None else " ".join(bpe.names[flat]))
            kept = [batch.column(f.name) for f in schema if f.name != "decoded"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(made, pa.string())], schema.names)

    return df.drop("decoded").mapInArrow(batches, schema)


def digests(tokens: DataFrame, ids_col: str = "token_ids") -> DataFrame:
    """Count and hashes of the rows of ``decode``; a null list counts as an empty one."""
    ids = F.coalesce(F.array_join(F.col(ids_col).cast("array<string>"), " "), F.lit(""))
    return tokens.withColumns(
        {
            "n_tokens": F.greatest(F.size(ids_col), F.lit(0)).cast("long"),
            "ids_sha256": F.sha2(F.encode(ids, "UTF-8"), 256),
            "decoded_sha256": F.sha2(F.encode(F.coalesce("decoded", F.lit("")), "UTF-8"), 256),
        }
    ).drop(ids_col, "decoded")
