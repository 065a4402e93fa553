"""Spelling variants, MinHash near-duplicates and whitening against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import minhash, sharding, simhash, spelling, whitening

from .conftest import TEXTS

ALPHABET = "abcdeéöÉ"


def brute_variants(rows, least=7):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least and n >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    found = {}
    for w, n in words.items():
        others = [o for o in words if near(w, o)]
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form = best if best is not None and words[best] >= 10 * n else None
        found[w] = [form, w, n, len(others), words[form] if form else None]
    for w in found:
        while found[found[w][1]][0]:
            found[w][1] = found[found[w][1]][0]
    return {(w, *v) for w, v in found.items()}


def misspelt_texts():
    """Words in chains of forms, with edits at every place, ties and letters that only Latin-1 has."""
    rng = random.Random(5)
    rows, words = [], []
    for _ in range(30):
        base = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(6, 12)))
        words += [base] * rng.choice([30, 300])
        for _ in range(12):
            edited = list(base)
            at = rng.randrange(len(edited))
            kind = rng.randrange(3)
            if kind == 0:
                edited[at] = rng.choice(ALPHABET)
            elif kind == 1:
                del edited[at]
            else:
                edited.insert(at, rng.choice(ALPHABET))
            words += ["".join(edited)] * rng.choice([1, 2, 3, 30])
    rng.shuffle(words)
    for i in range(0, len(words), 40):
        rows.append((i, " ".join(words[i : i + 40])))
    return rows + [(None, "Strasse Strasse STRASSE strassen strassen"), (7, None), (8, ""), (9, "12 中文 -"), (10, "q" * 70_000 + " " + "q" * 70_000), (10, "q" * 69_999 + "é " + "q" * 69_999 + "é")]


def test_variants_are_those_of_all_pairs(spark):
    rows = misspelt_texts()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id int, text string, word string, n int").repartition(5)
    got = {tuple(r) for r in spelling.variants(df).collect()}
    want = brute_variants(rows)
    assert got == want
    # The fixture has chains of two forms, so that a root differs from a form, and long words one edit apart.
    assert any(form and root != form for _, form, root, *_ in want)
    assert any(len(w) > 60_000 and near for w, _, _, _, near, _ in want)


def test_variants_do_not_depend_on_packs_or_classes(spark, monkeypatch):
    rows = misspelt_texts()
    df = spark.createDataFrame(rows, "doc_id int, text string").repartition(3)
    want = {tuple(r) for r in spelling.variants(df).collect()}
    # Many packs a block, all blocks hot, few cells at once, more classes.
    for name, value in {"PACK": 3, "CELLS": 64, "FEW_WORDS": 2}.items():
        monkeypatch.setattr(spelling, name, value)
    assert {tuple(r) for r in spelling.variants(df).collect()} == want


def test_variants_of_repeated_and_missing_rows(spark, docs, empty):
    assert spelling.variants(empty).collect() == []
    assert {tuple(r) for r in spelling.variants(docs, least=3).collect()} == brute_variants(TEXTS, 3)


def shingles(text, size):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute_groups(rows, size=4):
    sets = [(i, shingles(t, size)) for i, t in rows]
    group = list(range(len(sets)))

    def find(a):
        while group[a] != a:
            a = group[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                group[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, len(s), least.get(find(k)), i == least.get(find(k))) for k, (i, s) in enumerate(sets)), key=str)


def copies():
    """Families around the threshold: chains of small edits, a family whose members are only alike in part, exact copies."""
    rng = np.random.default_rng(3)
    rows = []
    for base in range(10):
        own = [f"w{x}" for x in rng.integers(0, 4000, 120)]
        for copy in range(9):
            edited = list(own) if copy % 3 else own
            for at in rng.integers(0, 120, 1 + base // 2).tolist():
                edited[at] = f"x{rng.integers(0, 4000)}"
            rows.append((base * 9 + copy, " ".join(edited)))
    rows += [(200 + k, rows[k][1].upper() + " ") for k in range(0, 90, 7)]
    return rows + [(300, None), (301, ""), (302, " \n"), (303, "two words"), (304, "Two\tWORDS"), (305, "two words more"), (306, "z " * 40_000), (307, "z " * 50_000), (303, "two words"), (None, "nothing like it"), (None, "two words")]


def test_minhash_groups_are_those_of_all_pairs(spark):
    rows = copies()
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id int, text string, digest string, n int").repartition(4)
    got = sorted(map(tuple, minhash.near_duplicates(df).collect()), key=str)
    assert got == brute_groups(rows)


def test_minhash_groups_do_not_depend_on_tiles_or_rounds(spark, monkeypatch):
    rows = copies()
    df = spark.createDataFrame(rows, "doc_id int, text string").repartition(4)
    for name, value in {"TILE": 3, "PIECE": 2, "ROUNDS": 0, "COLUMNS_AT_ONCE": 16}.items():
        monkeypatch.setattr(minhash, name, value)
    assert sorted(map(tuple, minhash.near_duplicates(df).collect()), key=str) == brute_groups(rows)
    monkeypatch.setattr(minhash, "ROUNDS", 3)
    assert sorted(map(tuple, minhash.near_duplicates(df).collect()), key=str) == brute_groups(rows)


def test_minhash_of_repeated_and_missing_rows(docs, empty):
    assert minhash.near_duplicates(empty).collect() == []
    assert sorted(map(tuple, minhash.near_duplicates(docs).collect()), key=str) == brute_groups(TEXTS)


def test_circulant_signatures_agree_as_often_as_sets_do():
    rng = np.random.default_rng(1)
    for alike in (0.2, 0.5, 0.8):
        shared = int(600 * 2 * alike / (1 + alike))
        base = rng.integers(0, 1 << 63, 1200, dtype=np.uint64)
        sets = [np.sort(base[:600]), np.sort(np.concatenate([base[:shared], base[600 : 1200 - shared]]))]
        made = minhash.signatures(sets, 4000)
        assert abs((made[0] == made[1]).mean() - alike) < 0.03


def brute_whitened(rows, components=16):
    x = [tuple(math.floor(64 * c) + 1_000_000 for c in v) for _, v in rows]
    fit = sorted(set(x))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    data = np.array(fit, float) - np.array(sums) / n
    covariance = data.T @ data / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:components]
    out = {}
    for (i, _), row in zip(rows, x):
        deviation = sum((n * c - s) ** 2 for c, s in zip(row, sums))
        whitened = ((np.array(row) - np.array(sums) / n) @ vectors[:, order]) / np.sqrt(values[order])
        out[i] = (n, deviation, whitened, values[order] / np.trace(covariance))
    return out


def vectors(n, dims, seed=2):
    rng = np.random.default_rng(seed)
    scales = np.geomspace(1, 4, dims)
    return [(i, [float(np.float32(c)) for c in row]) for i, row in enumerate(rng.normal(size=(n, dims)) * scales)]


@pytest.mark.parametrize("dims", [3, 20])
def test_whitening_equals_plain_covariances(spark, dims):
    good = vectors(400, dims)
    rows = [*good, (500, good[7][1]), (501, good[7][1])]
    odd = [(600, None), (601, [None, *good[0][1][1:]]), (602, [math.nan] * dims), (603, [math.inf] * dims), (604, []), (605, [1.0])]
    df = spark.createDataFrame([(i, v, "x", 0.0) for i, v in rows + odd], "vec_id bigint, embedding array<float>, x string, n double")
    got = whitening.whiten(df.repartition(6)).toPandas()
    want = brute_whitened(rows)
    assert set(got.vec_id) == set(want) and len(got) == len(want) * min(dims, 16)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9
    signs = None
    for i, own in got.groupby("vec_id"):
        own = own.sort_values("component")
        n, deviation, whitened, explained = want[i]
        assert own.component.tolist() == list(range(1, min(dims, 16) + 1))
        assert set(own.n) == {n} and set(own.deviation) == {deviation}
        assert np.allclose(own.explained, explained, rtol=1e-9)
        # Either sign of a component, but the same for all rows.
        signs = np.sign(own.whitened.to_numpy() * whitened) if signs is None else signs
        assert np.allclose(own.whitened.to_numpy() * signs, whitened, atol=1e-9)


def test_whitening_without_variance_and_of_huge_entries(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id int, embedding array<double>")
    assert whitening.whiten(make([])).collect() == []
    assert whitening.whiten(make([(1, None)])).collect() == []
    one = whitening.whiten(make([(1, [0.5, 2.0]), (2, [0.5, 2.0])])).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained) for r in one] == [(1, 0, None, None)] * 4
    flat = whitening.whiten(make([(i, [float(i), 3.0]) for i in range(4)])).collect()
    assert {(r.component, r.whitened is None) for r in flat} == {(1, False), (2, True)}
    huge = whitening.whiten(make([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [5e9, 2.0])])).collect()
    assert len(huge) == 6 and all(r.deviation is None for r in huge) and all(r.identity_error < 1e-4 for r in huge)


def test_sums_of_squares_are_exact_beyond_a_long():
    rng = np.random.default_rng(4)
    for scale in (10, 1 << 50):
        y = rng.integers(-scale, scale, (50, 4))
        plain = [[sum((int(r[i]) + int(r[j])) ** 2 if i != j else int(r[i]) ** 2 for r in y) for j in range(i, 4)] for i in range(4)]
        assert whitening.squared_sums(y) == plain


CLASHES = ("_hash", "_part", "_at", "_", "_id", "_h", "row", "k", "h", "at", "part", "rows", "before")


def test_columns_of_any_name_come_back_as_they_were(spark):
    rows = [(i, f"text {i // 2}", *[f"{c}{i}" for c in CLASHES]) for i in range(8)]
    df = spark.createDataFrame(rows, ["doc_id", "text", *CLASHES])
    kept = simhash.representatives(df)
    assert kept.columns == df.columns and {tuple(r) for r in kept.collect()} == {r for r in rows if r[0] % 2 == 0}
    placed = sharding.place(df, sharding.regular_tree(4), "doc_id")
    assert {tuple(r) for r in placed.drop("shard", "slot").collect()} == set(rows)
    for own in (r.asDict() for r in placed.groupBy("shard").agg(F.sort_array(F.collect_list("slot")).alias("slots")).collect()):
        assert own["slots"] == list(range(len(own["slots"])))
