"""Token counts, BPE, SimHash, sharding and substring dedup against brute force."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm import bpe, common, sharding, simhash, substring_dedup, token_counts

from .conftest import TEXTS

BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = st.lists(st.sampled_from(["a", "the", "'re", "'r", "'LL", " ", "  ", "\n", "é", "é", "日", "12", "!?", "<|endoftext|>", "<|endo", "\xa0", "\x1c", "😀", "Σ", "İ", "aaaa"]), max_size=14).map("".join)


def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


BYTES, WORDS = library(BYTE_BPE), library(WORD_BPE)


@settings(max_examples=150, deadline=None)
@given(ODD)
def test_prefix_counts_are_those_of_each_prefix(text):
    expected = [len(BYTES.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
    assert token_counts.counter(BYTE_BPE).prefixes(text) == expected
    assert token_counts.counter(BYTE_BPE).total(text) == expected[-1]


@settings(max_examples=150, deadline=None)
@given(ODD)
def test_merge_rounds_give_the_library_ids(text):
    ids = WORDS.encode(text, add_special_tokens=False).ids
    assert bpe.word_bpe(WORD_BPE).encode_batch([text])[0].tolist() == ids
    assert bpe.word_bpe(WORD_BPE).decode(ids) == WORDS.decode(ids, skip_special_tokens=False)


def test_every_code_point_is_encoded_as_by_the_library():
    points = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    texts = [f"Ax{c}{c}y1{c} Z{c}\u0301 a\u0316{c}\u0301 e{c}\u0334\u0301" for c in points]
    for start in range(0, len(texts), 20_000):
        part = texts[start : start + 20_000]
        flat, counts = bpe.word_bpe(WORD_BPE).encode_batch(part)
        own = np.split(flat, np.cumsum(counts)[:-1])
        expected = WORDS.encode_batch(part, add_special_tokens=False)
        assert [t for t, a, b in zip(part, own, expected, strict=True) if a.tolist() != b.ids] == []


def test_token_counts(docs, empty):
    got = sorted(tuple(r) for r in token_counts.token_counts(docs, BYTE_BPE).collect())
    assert got == sorted((i, len((t or "").encode()), len(BYTES.encode(t or "", add_special_tokens=False).ids)) for i, t in TEXTS)
    assert token_counts.token_counts(empty, BYTE_BPE).collect() == []


def test_truncation_and_prefixes(docs):
    short = docs.filter("doc_id IN (1, 2, 3, 7)")
    for r in token_counts.truncate(short, BYTE_BPE, 7).collect():
        whole = dict(TEXTS)[r.doc_id] or ""
        assert whole.startswith(r.text) and r.n_tokens == len(BYTES.encode(r.text, add_special_tokens=False).ids) <= 7
    assert {r.doc_id: r.prefix_tokens for r in token_counts.prefix_counts(short, BYTE_BPE).collect()}[2] == [0]


def test_encode_and_decode(docs, empty):
    tokens = bpe.encode(docs, WORD_BPE, decoded=True)
    for r in tokens.collect():
        texts = [t or "" for i, t in TEXTS if i == r.doc_id]
        assert r.token_ids == WORDS.encode(texts[0], add_special_tokens=False).ids
        assert r.decoded == WORDS.decode(r.token_ids, skip_special_tokens=False)
    again = bpe.decode(tokens.drop("decoded"), WORD_BPE)
    assert Counter((r.doc_id, r.decoded) for r in again.collect()) == Counter((r.doc_id, r.decoded) for r in tokens.collect())
    digest = {r.doc_id: r for r in bpe.digests(tokens).collect()}
    assert digest[2].n_tokens == 0 and digest[2].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert bpe.encode(empty, WORD_BPE).collect() == []


def print_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints, radius=3):
    """Component of each of a list of (id, fingerprint), by comparing all pairs."""
    group = list(range(len(prints)))
    for i, (_, a) in enumerate(prints):
        for j, (_, b) in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= radius:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for (d, _), g in zip(prints, group, strict=True):
        least[g] = min(d, least.get(g, d))
    return [(d, f"{p:016x}", least[g]) for (d, p), g in zip(prints, group, strict=True)]


def test_near_duplicates(docs, empty):
    got = sorted(tuple(r) for r in simhash.near_duplicates(docs).collect())
    assert got == sorted(linked([(i, print_of(t)) for i, t in TEXTS]))
    assert simhash.near_duplicates(empty).collect() == []
    kept = sorted(r.doc_id for r in simhash.representatives(docs).collect())
    assert kept == sorted({c for _, _, c in got})
    assert simhash.representatives(docs).columns == docs.columns


def test_links_over_chains_and_large_buckets(spark, monkeypatch):
    random = np.random.default_rng(1)
    base = random.integers(0, 2**63, 12, dtype=np.uint64)
    prints = set(base.tolist())
    for b in base[:4].tolist():
        for _ in range(40):  # chains of small steps, which reach far from where they began
            for bit in random.integers(0, 64, random.integers(1, 4)).tolist():
                b ^= 1 << bit
            prints.add(b)
    prints = sorted(prints)
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    expected = {d: c for d, _, c in linked(list(enumerate(prints)))}
    from ledgerlens.llm.components import components

    for tile, step in ((simhash.TILE, simhash.ROWS_PER_BLOCK_STEP), (5, 1 << 24), (1 << 14, 1 << 4)):
        monkeypatch.setattr(simhash, "TILE", tile)
        monkeypatch.setattr(simhash, "ROWS_PER_BLOCK_STEP", step)
        df = spark.createDataFrame(rows, "id bigint, fingerprint bigint")
        found = {r.vertex: r.component for r in components(simhash.link(df)).collect()}
        number = {p: i for i, p in rows}
        least = {}
        for i, p in rows:
            c = found.get(p, p)
            least[c] = min(i, least.get(c, i))
        assert {number[p]: least[found.get(p, p)] for p in number} == expected


def test_bit_sliced_distances():
    random = np.random.default_rng(2)
    left = random.integers(0, 2**63, 70, dtype=np.uint64)
    right = np.concatenate([left[:30] ^ np.uint64(0b1011), left[30:60] ^ np.uint64(1 << 63 | 1 << 5 | 1 << 9 | 1), random.integers(0, 2**63, 69, dtype=np.uint64)])
    for radius in range(4):
        pairs = {(i, j) for i, a in enumerate(left.tolist()) for j, b in enumerate(right.tolist()) if (a ^ b).bit_count() <= radius}
        assert set(zip(*(x.tolist() for x in simhash.near_pairs(left, right, radius)), strict=True)) == pairs


def test_sharding(docs, empty):
    rows = sharding.digest(docs).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        texts = [(t or "").encode() for i, t in TEXTS if i == r.doc_id]
        assert any(r.size == len(t) + 1 and r.text_crc32 == zlib.crc32(t) for t in texts)
        assert r.grown_shard in (r.shard, 8)
    for shard in range(8):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert sharding.digest(empty).collect() == []
    assert sharding.place(docs, sharding.regular_tree(4), "doc_id").columns == ["doc_id", "text", "block", "n_tokens", "shard", "slot"]


def test_movement_stays_in_subtrees_whose_weights_change(spark):
    tree = sharding.regular_tree(8)
    heavier = [sharding.Leaf(x.region, x.rack, x.shard, 2.0 if x.shard == 5 else 1.0) for x in tree]
    keys = spark.range(20_000).select(F.col("id"), sharding.shard_of(F.col("id"), tree).alias("a"), sharding.shard_of(F.col("id"), heavier).alias("b"), sharding.shard_of(F.col("id"), sharding.grow(tree)).alias("c"))
    rows = keys.collect()
    where = {x.shard: x for x in tree}
    for r in rows:
        if r.a != r.b:  # into region and rack of shard 5, or within them towards it
            assert where[r.b].region == where[5].region
            if where[r.a].region == where[5].region:
                assert where[r.b].rack == where[5].rack
            if (where[r.a].region, where[r.a].rack) == (where[5].region, where[5].rack):
                assert r.b == 5
        assert r.c in (r.a, 8)
    counts = Counter(r.a for r in rows)
    assert all(abs(counts[s] - 2500) < 250 for s in range(8))
    assert abs(sum(r.c == 8 for r in rows) - 20_000 / 9) < 250


def deduplicated(texts, depth=13):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in texts]
    first = {}
    for i, own in words:
        for k in range(len(own) - depth + 1):
            run = tuple(own[k : k + depth])
            first[run] = min(i, first.get(run, i))
    result = []
    for i, own in words:
        gone = [False] * len(own)
        for k in range(len(own) - depth + 1):
            if first[tuple(own[k : k + depth])] < i:
                gone[k : k + depth] = [True] * depth
        result.append((i, len(own), sum(gone), " ".join(w for w, g in zip(own, gone, strict=True) if not g)))
    return sorted(result)


@pytest.mark.parametrize("block_bytes", [1 << 23, 300])
def test_substring_dedup(docs, empty, monkeypatch, block_bytes):
    monkeypatch.setattr(common, "BLOCK_BYTES", block_bytes)
    assert sorted(tuple(r) for r in substring_dedup.deduplicate(docs).collect()) == deduplicated(TEXTS)
    assert substring_dedup.deduplicate(empty).collect() == []


def test_substring_dedup_over_many_blocks_and_groups(spark, monkeypatch):
    monkeypatch.setattr(common, "BLOCK_BYTES", 900)
    monkeypatch.setattr(substring_dedup, "GROUP_SUFFIXES", 300)
    random = np.random.default_rng(3)
    passages = [" ".join(f"w{x}" for x in random.integers(0, 40, random.integers(12, 40))) for _ in range(6)]
    texts = [(i, " ".join([*(f"w{x}" for x in random.integers(0, 40, 9)), passages[i % 6], *(f"v{x}" for x in random.integers(0, 3, 20))])) for i in range(90)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert sorted(tuple(r) for r in substring_dedup.deduplicate(df).collect()) == deduplicated(texts)
    spans = Counter()
    for r in substring_dedup.repeats(df).collect():
        assert r.end_word - r.first_word >= 13
        spans[r.doc_id] += r.end_word - r.first_word
    assert spans == Counter({i: n for i, _, n, _ in deduplicated(texts) if n})


def test_rewrite_keeps_columns_and_untouched_texts(docs):
    rows = substring_dedup.rewrite(docs)
    assert rows.columns == docs.columns and rows.dtypes == docs.dtypes
    kept = {r.doc_id: r.text for r in rows.collect()}
    assert kept[4] == " \t\n " and kept[5] == "" and kept[10].split() == ["intro", "the", "outro"]
