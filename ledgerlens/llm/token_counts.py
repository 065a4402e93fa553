"""Exact token counts by dynamic programming over prefixes.

A byte-level BPE encoding is right exactly if each two neighbouring tokens are what BPE makes of
their own bytes. So the encoding of a prefix ends with the one vocabulary entry that is a suffix of
the prefix and a valid neighbour of the last token of what comes before it, and its length is one more
than that shorter prefix's. Filling this table once gives the exact number of tokens of *every*
prefix, so that "how many tokens are in the first n characters" and "where does a budget of k tokens
end" are look-ups and nothing is encoded again.

Texts are cut where white space begins, since no pre-token reaches from a non-space into a space.
The tables of such stretches are kept in a bounded dictionary per worker; emptying it costs time only.
"""

from __future__ import annotations

import functools
import json
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import NON_SPACE, SPACED_WORD, WHITE_SPACE, id_and_text, map_text

KEPT_STRETCHES = 400_000
# Pre-token pattern of the vocabulary (fixed value).
_PIECE = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE_SPACE}\p{{L}}\p{{N}}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+"
)
_LONG_CONTRACTIONS = ("'re", "'ve", "'ll")


def byte_characters() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if visible, else 256 and up."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PrefixCounter:
    """Token counts of all prefixes of a text under one byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        to_byte = byte_characters()
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        raw = lambda token: bytes(to_byte[c] for c in token)
        # Tokens are numbered by the time BPE makes them: bytes first, then merge by merge.
        self.token = {bytes([b]): b for b in range(256)}
        self.parts: list[tuple[int, int]] = [(b, b) for b in range(256)]
        self.made: dict[tuple[int, int], int] = {}
        for left, right in merges:
            a, b = self.token[raw(left)], self.token[raw(right)]
            number = len(self.parts)
            self.parts.append((a, b))
            self.made[a, b] = number
            self.token.setdefault(raw(left) + raw(right), number)
        self.endings = {t[i:] for t in self.token for i in range(len(t))}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self._special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self._fits: dict[tuple[int, int], bool] = {}
        self._totals: dict[str, int] = {}

    def fits(self, left: int, right: int) -> bool:
        """Whether BPE leaves these two tokens side by side: no merge across their border comes early enough."""
        known = self._fits.get((left, right))
        if known is None:
            if len(self._fits) > KEPT_STRETCHES:
                self._fits.clear()
            known = self._fits[left, right] = self._stays_apart(left, right)
        return known

    def _stays_apart(self, a: int, b: int) -> bool:
        # Undo merges at the border, latest first. A merge across it was possible as long as both
        # sides existed, and would have been taken if it is older than the merge that ended that.
        ended = len(self.parts)
        while True:
            crossing = self.made.get((a, b))
            if crossing is not None and crossing < ended:
                return False
            if a >= 256 and (a > b or b < 256):
                # Of two equal merges the left one is made first, so at that time b was whole only if b < a.
                ended, a = a, self.parts[a][1]
            elif b >= 256:
                ended, b = b + 1, self.parts[b][0]
            else:
                return True

    def piece(self, piece: bytes) -> list[int]:
        """Tokens of each prefix of one pre-token, from the empty one on."""
        token, endings, fits = self.token, self.endings, self.fits
        counts, last = [0], [-1]
        for end in range(1, len(piece) + 1):
            for start in range(end - 1, -1, -1):
                ending = piece[start:end]
                if ending not in endings:
                    break
                t = token.get(ending)
                if t is not None and (start == 0 or fits(last[start], t)):
                    last.append(t)
                    counts.append(counts[start] + 1)
                    break
        return counts

    def _total(self, stretch: str) -> int:
        return sum(self.piece(p.encode())[-1] for p in _PIECE.findall(stretch))

    def total(self, text: str | None) -> int:
        """Tokens of the whole text."""
        if not text:
            return 0
        if any(s in text for s in self.special):
            marks = self._special.findall(text)
            return len(marks) + sum(self.total(part) for part in self._special.split(text))
        totals = self._totals
        if len(totals) > KEPT_STRETCHES:
            totals.clear()
        count = 0
        for stretch in SPACED_WORD.findall(text):
            known = totals.get(stretch)
            if known is None:
                known = self._total(stretch)
                if len(stretch) <= 64:
                    totals[stretch] = known
            count += known
        return count

    def _stretch_prefixes(self, stretch: str) -> list[int]:
        """Tokens of each prefix, in characters, of white space with the non-space run after it."""
        match = NON_SPACE.search(stretch)
        blank = stretch[: match.start()] if match else stretch
        counts = self._by_character(blank)
        base = 0
        for piece in _PIECE.findall(stretch):
            inner = self._by_character(piece)
            if piece in _LONG_CONTRACTIONS:
                inner[2] = 2  # a lone apostrophe and one letter
            for j in range(1, len(inner)):
                if NON_SPACE.search(piece, 0, j):
                    counts.append(base + inner[j])
            base += inner[-1]
        return counts

    def _by_character(self, piece: str) -> list[int]:
        by_byte = self.piece(piece.encode())
        return [by_byte[i] for i in accumulate((len(c.encode()) for c in piece), initial=0)]

    def prefixes(self, text: str | None) -> list[int]:
        """Tokens of the first 0, 1, ... characters of the text, each as if that prefix were the text."""
        counts, base, at = [0], 0, 0
        text = text or ""
        for mark in [*self._special.finditer(text), None]:
            stop = mark.start() if mark else len(text)
            stretches = SPACED_WORD.findall(text[at:stop])
            for i, stretch in enumerate(stretches):
                # A special string that is not complete is ordinary text and belongs to what it follows.
                tail = stretch + mark.group() if mark and i == len(stretches) - 1 else stretch
                table = self._stretch_prefixes(tail)
                counts += [base + n for n in table[1 : len(stretch) + 1]]
                if tail is not stretch:
                    partial = [base + n for n in table[len(stretch) + 1 : -1]]
                base += table[len(stretch)]
            if mark:
                if not stretches:
                    partial = [base + n for n in self._stretch_prefixes(mark.group())[1:-1]]
                base += 1
                counts += [*partial, base]
                at = mark.end()
        return counts


@functools.lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def token_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_bytes, n_tokens)`` of every row.

    ``path`` names the vocabulary file on the executors. A null text has no bytes and no tokens, as has
    an empty one. Repeated rows are counted each; other columns of ``df`` are ignored.
    """

    def rows(texts):
        c = counter(path)
        return [[len(t.encode()) if t else 0 for t in texts], [c.total(t) for t in texts]]

    fields = [("n_bytes", T.LongType(), pa.int64()), ("n_tokens", T.LongType(), pa.int64())]
    return map_text(id_and_text(df, id_col, text_col), fields, rows).withColumnRenamed("id", id_col)


def prefix_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, prefix_tokens)``: the token counts of the first 0, 1, ... characters; ``[0]`` if there is no text."""

    def rows(texts):
        c = counter(path)
        return [[c.prefixes(t) for t in texts]]

    fields = [("prefix_tokens", T.ArrayType(T.IntegerType()), pa.list_(pa.int32()))]
    return map_text(id_and_text(df, id_col, text_col), fields, rows).withColumnRenamed("id", id_col)


def truncate(df: DataFrame, path: str, budget: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, text, n_tokens)``: the longest prefix of each text that takes at most ``budget`` tokens."""

    def rows(texts):
        c = counter(path)
        kept, counts = [], []
        for t in texts:
            table = c.prefixes(t)
            n = max(i for i, count in enumerate(table) if count <= budget)
            kept.append((t or "")[:n])
            counts.append(table[n])
        return [kept, counts]

    fields = [("text", T.StringType(), pa.string()), ("n_tokens", T.LongType(), pa.int64())]
    return map_text(id_and_text(df, id_col, text_col), fields, rows).withColumnRenamed("id", id_col)


def fits_budget(counts: DataFrame, budget: int) -> DataFrame:
    """Add ``over_limit``: whether a row of ``token_counts`` takes more than ``budget`` tokens."""
    return counts.withColumn("over_limit", F.col("n_tokens") > budget)
