"""Decontamination, nearest neighbours, PPM, HTML, toxicity and the pipeline against brute force."""

import html
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlens.llm import common, decontamination, html_text, multi_index, ppm, toxicity

from .conftest import TEXTS

SF = "/root/testdata/sf0.001"


def edit_distance(item, words):
    """Least edits of the item against any stretch of the words, one cell at a time."""
    row = [0] * (len(words) + 1)
    for i, w in enumerate(item, 1):
        before, row = row, [i]
        for j, v in enumerate(words, 1):
            row.append(min(before[j - 1] + (w != v), before[j] + 1, row[j - 1] + 1))
    return min(row)


def test_leaks_are_found_and_clean_texts_left(spark, empty):
    random = np.random.default_rng(5)
    word = lambda n: [f"w{x}" for x in random.integers(0, 3000, n)]
    items = [(i, " ".join(word(int(n)))) for i, n in enumerate([5, 9, 15, 30, 45, 60, 80])] + [(90, "too short"), (91, None), (None, "w1 w2 w3 w4 w5 w6"), (92, "")]
    texts = []
    for d in range(120):
        i = d % 7
        own = items[i][1].split()
        for _ in range(decontamination.allowed_edits(len(own)) * (d % 3) // 3):
            at = int(random.integers(0, len(own)))
            own = own[:at] + (word(1) if d % 2 else []) + own[at + 1 :]
        texts.append((d, " ".join(word(30) + ([] if d % 4 == 3 else own) + word(30)).upper()))
    texts += [(500, None), (501, ""), (502, items[3][1])]
    docs, bench = spark.createDataFrame(texts, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r for r in decontamination.leaks(docs, bench).collect()}
    expected = {}
    for d, t in texts:
        for i, item in items:
            own = (item or "").lower().split()
            if i is not None and len(own) >= 5:
                edits = edit_distance(own, (t or "").lower().split())
                if edits <= decontamination.allowed_edits(len(own)):
                    expected[d, i] = edits
    assert set(got) <= set(expected) and all(got[k].edits == expected[k] for k in got)
    assert len(got) >= decontamination.RECALL * len(expected)
    for (d, i), r in got.items():
        stretch = dict(texts)[d].lower().split()[r.first_word : r.end_word]
        assert edit_distance(dict(items)[i].lower().split(), stretch) == r.edits
    assert {d for d, _ in expected} - {d for d, _ in got} == set()
    clean = {r.doc_id for r in decontamination.clean(docs, bench).collect()}
    assert clean == {d for d, _ in texts} - {d for d, _ in got}
    assert decontamination.leaks(docs.filter("false"), bench).collect() == []
    assert decontamination.leaks(docs, bench.filter("false")).collect() == []


def test_items_in_slices(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "SLICE_WORDS", 200)
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    sliced = sorted(tuple(r) for r in decontamination.leaks(docs, bench).collect())
    monkeypatch.setattr(decontamination, "SLICE_WORDS", 10**9)
    assert sorted(tuple(r) for r in decontamination.leaks(docs, bench).collect())[:5] == sliced[:5] and sliced


@pytest.mark.parametrize("n_words", [7, 15, 30, 38, 47, 58, 90])
def test_leaks_are_found_wherever_the_edits_lie(n_words):
    random = np.random.default_rng(n_words)
    word = lambda n: [f"w{x}" for x in random.integers(0, 3000, n)]
    k = decontamination.allowed_edits(n_words)
    items = [(i, " ".join(word(n_words))) for i in range(20)]
    index = decontamination.prepare(items)
    even = [n_words * j // k for j in range(k)]
    for i, text in items:
        own = text.split()
        cut, replaced, tail = own[k:], word(k) + own[k:], own[:-k] + word(k)
        spread = [w if p not in even else "other" for p, w in enumerate(own)]
        more = [w for p, v in enumerate(own) for w in ([v, "more"] if p in even else [v])]
        less = [w for p, w in enumerate(own) if p not in even]
        edited = [cut, replaced, tail, spread, more, less]
        texts = [[*word(20), *e, *word(20)] for e in edited] + edited
        for text_words, found in zip(texts, decontamination.leaks_of([[w.encode() for w in t] for t in texts], index), strict=True):
            held = [f for f in found if f[0] == i]
            assert len(held) == 1 and held[0][1] == edit_distance(own, text_words) <= k


@pytest.mark.parametrize("opening", [6, 12])
def test_items_with_one_opening_meet_few_places(opening, monkeypatch):
    random = np.random.default_rng(opening)
    items = [(i, " ".join([f"o{x}" for x in range(opening)] + [f"w{x}" for x in random.integers(0, 30_000, 32)])) for i in range(2_000)]
    index = decontamination.prepare(items)
    documents = [[*["before"] * 9, *t.split(), *["after"] * 9] for _, t in items]
    met = []
    real = decontamination.candidates
    monkeypatch.setattr(decontamination, "candidates", lambda *a: (met.append(len(p[0])) or p for p in real(*a)))
    found = decontamination.leaks_of([[w.encode() for w in d] for d in documents], index)
    assert [[f[:2] for f in own] for own in found] == [[(i, 0)] for i in range(2_000)]
    assert sum(met) < 100 * len(items)


def test_a_key_of_many_items_is_cut(monkeypatch):
    monkeypatch.setattr(decontamination, "PIECE", 50)
    items = [(i, " ".join([f"o{x}" for x in range(19)] + [f"w{i}"])) for i in range(60)]
    index = decontamination.prepare([*items, (100, items[7][1])])
    assert [100 in own for own in index.ids].count(True) == 1
    found = decontamination.leaks_of([t.encode().split() for _, t in items], index)
    assert all({(f[0], f[1]) for f in own} == {(j, int(j != i)) for j in range(60)} for i, own in enumerate(found))


def test_leaks_of_repeated_rows_odd_names_and_very_long_texts(spark):
    item = " ".join(f"w{x}" for x in range(20))
    texts = [(1, item, 1, "a"), (1, item, 1, "a"), (2, "x " * 200_000 + item, 2, "b"), (3, None, 3, "c")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, item_id int, edits string")
    bench = spark.createDataFrame([(5, item, 0), (6, item.upper(), 0), (5, item, 0)], "item_id bigint, text string, doc_id int")
    got = sorted(tuple(r) for r in decontamination.leaks(docs, bench).collect())
    places = [(1, 0, 20), (1, 0, 20), (2, 200_000, 200_020)]
    assert got == sorted((d, i, 0, 1.0, a, b) for d, a, b in places for i in (5, 6))
    assert [tuple(r) for r in decontamination.clean(docs, bench).collect()] == [texts[3]]


def nearest(vectors, queries, n):
    rows = []
    for q, x in queries:
        ranked = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(x, y, strict=True))), v) for v, y in vectors if v != q)
        rows += [(q, k + 1, v) for k, (_, v) in enumerate(ranked[:n])]
    return sorted(rows)


def test_search_with_few_entries_is_exact(spark):
    random = np.random.default_rng(6)
    vectors = [(i, random.integers(-3, 4, 4).astype(float).tolist()) for i in range(120)] + [(200 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(40)]
    odd = [(300, None), (301, []), (302, [0.0] * 4), (303, [1.0, None, 2.0, 3.0]), (304, [math.nan, 1.0, 1.0, 1.0]), (305, [math.inf, 1.0, 1.0, 1.0]), (None, [1.0] * 4)]
    df = spark.createDataFrame(vectors + odd + vectors[:3], "vec_id bigint, embedding array<float>")
    usable = [(i, x) for i, x in vectors if any(x)]
    queries = df.filter("vec_id % 10 = 0")
    got = sorted((r.query_id, r.rank, r.vec_id) for r in multi_index.search(multi_index.build(df), queries).collect())
    assert got == nearest(usable, [(i, x) for i, x in usable if i % 10 == 0], 10)
    none = df.filter("false")
    assert multi_index.search(multi_index.build(none), none).collect() == []
    assert multi_index.search(multi_index.build(df.filter("vec_id = 1")), df.filter("vec_id = 1")).collect() == []


def test_recall(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "LEAST_ENTRIES", 1)
    monkeypatch.setattr(multi_index, "PART", 100)
    random = np.random.default_rng(7)
    x = random.normal(size=(3000, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = multi_index.search(multi_index.build(df), df.filter("vec_id % 100 = 0")).collect()
    hits = 0
    for q in range(0, 3000, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        mine = {r.vec_id: r.score for r in got if r.query_id == q}
        assert all(abs(s - d[v]) < 1e-12 for v, s in mine.items())
        hits += len(set(mine) & set(np.argsort(d)[:10].tolist()))
    assert hits / 300 >= 0.9


def out(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


@pytest.mark.parametrize("small", [False, True])
def test_language_model_counts(docs, empty, monkeypatch, small):
    if small:  # many blocks and parts
        monkeypatch.setattr(common, "BLOCK_BYTES", 200)
        monkeypatch.setattr(ppm, "WORDS_PER_PART", 10)
        monkeypatch.setattr(ppm, "ANSWER_BYTES", 40)
    counts = Counter()
    words = lambda t: [*(t or "").encode().lower().split(), b""]
    for i, t in TEXTS:
        if not out(i):
            counts.update(words(t))
    total, kinds = sum(counts.values()), len(counts)
    model = word_model(counts, {w for _, t in TEXTS for w in words(t)})
    rows = ppm.scores(docs).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        texts = [words(t) for i, t in TEXTS if i == r.doc_id]
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in texts[0])
        assert (r.held_out, r.n_tokens, r.train_tokens) == (out(r.doc_id), len(texts[0]), total)
        assert r.n_known == sum(counts[w] > 0 for w in texts[0]) and r.base_score == pytest.approx(base)
        had, score = Counter(), 0.0
        for t, w in enumerate(texts[0]):
            share = ppm.ADAPT * t / (t + ppm.WARM_UP)
            score += math.log10((1 - share) * 10 ** model[w] + share * had[w] / max(t, 1))
            had[w] += 1
        assert r.score == pytest.approx(score, rel=1e-5)
    assert ppm.scores(empty).collect() == []


def word_model(counts, words):
    """Log10 probability of each word, by walking plain dictionaries one byte at a time."""
    after, lower = defaultdict(Counter), defaultdict(Counter)
    for w, n in counts.items():
        marked = w + b" "
        for d in range(min(len(marked), ppm.DEPTH) if n else 0):
            after[marked[:d]][marked[d]] += n
        for i, byte in enumerate(marked if n else b""):
            read = b" " * ppm.ORDER + marked[:i]
            for order in range(ppm.ORDER + 1):
                lower[read[len(read) - order :]][byte] += n
    state = lambda d, total, kinds: (min(d, ppm.DEPTHS - 1), total.bit_length(), kinds.bit_length())
    seen, left = Counter(), Counter()
    for context, own in after.items():
        total = sum(own.values())
        for n in own.values() if total > 1 else ():
            at = state(len(context), total - 1, len(own) - (n == 1))
            seen[at] += n
            left[at] += n == 1

    def escape(at):
        total, kinds = 2 ** max(at[1] - 1, 0), 2 ** max(at[2] - 1, 0)
        return min(max((left[at] + 2 * kinds / (total + kinds)) / (seen[at] + 2), 1e-6), 1 - 1e-6)

    def shorter(read, byte, gone):
        p, gone = 1.0, set(gone)
        for order in range(ppm.ORDER, -1, -1):
            own = {b: n for b, n in lower[read[len(read) - order :]].items() if b not in gone}
            total = sum(own.values())
            if byte in own:
                return p * own[byte] / (total + len(own))
            p *= len(own) / (total + len(own)) if own else 1
            gone |= own.keys()
        return p / (256 - len(gone))

    scores = {}
    for w in words:
        marked, p, on_trie = w + b" ", 0.0, True
        for i, byte in enumerate(marked):
            own, read = after[marked[:i]] if on_trie and i < ppm.DEPTH else {}, b" " * ppm.ORDER + marked[:i]
            if byte in own:
                total = sum(own.values())
                p += math.log10((1 - escape(state(i, total, len(own)))) * own[byte] / total)
            else:
                e = escape(state(i, sum(own.values()), len(own))) if own else 1
                p += math.log10(e * shorter(read, byte, own))
                on_trie = False
        scores[w] = p
    return scores


def test_every_context_is_counted(spark):
    """Against plain dictionaries, in many parts: rare contexts among very frequent words, words beyond the trie's depth."""
    random = np.random.default_rng(11)
    frequent = [bytes(random.integers(97, 103, 4).astype(np.uint8)) for _ in range(40)]
    counts = {w: 5_000_000 for w in frequent} | {b"": 9, b"q\xc3\xa9z\xc3\xa9w": 1, b"x" * 40: 3, b"y" * 23: 2, b"z" * 24: 1}
    asked = {bytes(random.integers(97, 123, n).astype(np.uint8)): 0 for n in random.integers(1, 30, 300)}
    words = {**asked, b"vq\xc3\xa9z": 0, b"x" * 39: 0, b"x" * 30 + b"q": 0, b"z" * 25: 0, b"y" * 22: 0, **counts}
    df = spark.createDataFrame([(bytearray(w), n) for w, n in words.items()], "word binary, n bigint")
    expected = word_model(counts, words)
    with pytest.MonkeyPatch.context() as patch:
        for size in (1000, 50):
            patch.setattr(ppm, "WORDS_PER_PART", size)
            got = {bytes(r.word): r.log_p for r in ppm.word_scores(df).collect()}
            assert got.keys() == expected.keys()
            assert max(abs(got[w] - expected[w]) for w in got) < 1e-9


def test_parts_do_not_change_the_model(spark, monkeypatch):
    counts = Counter()
    for (t,) in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet'").fetchall():
        counts.update([*t.encode().lower().split(), b""])
    df = spark.createDataFrame([(bytearray(w), n * (i % 9 > 0)) for i, (w, n) in enumerate(sorted(counts.items()))], "word binary, n bigint")
    one = {bytes(r.word): r.log_p for r in ppm.word_scores(df).collect()}
    monkeypatch.setattr(ppm, "WORDS_PER_PART", 700)
    many = {bytes(r.word): r.log_p for r in ppm.word_scores(df).collect()}
    assert one.keys() == many.keys() and max(abs(one[w] - many[w]) for w in one) < 1e-9
    assert sum(10**p for p in one.values()) <= 1 + 1e-9
    mean = lambda p: sum(p[w] * n for w, n in counts.items()) / sum(counts.values())
    uniform = {w: -(len(w) + 1) * math.log10(256) for w in counts}
    assert mean(one) > mean(uniform)


def test_lower_contexts_are_probabilities():
    keys, word = ppm.sequences([b"abba", b"ab", b"", b"abc"])
    orders = []
    for k in range(ppm.ORDER + 1):
        kept, n = np.unique(keys & ((1 << 8 * (k + 1)) - 1), return_counts=True)
        orders.append((kept, n))
    lower, every = ppm.Lower(orders), np.arange(256)
    for context in (b"  a", b" ab", b"zzz", b"zab"):
        excluded = np.zeros((256, 256), bool)
        excluded[:, [97, 98]] = True
        number = np.full(256, int.from_bytes(context, "big"))
        assert lower.probability(number, every).sum() == pytest.approx(1)
        allowed = np.setdiff1d(every, [97, 98])
        assert lower.probability(number, every, excluded)[allowed].sum() == pytest.approx(1)


def test_pages_give_their_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").withColumn("text", F.lit("clash"))
    got = {r.page_id: r for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        inner = r.html[r.html.index("<article>") : r.html.index("</article>")]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inner)]
        assert got[r.page_id].text == "\n".join(b for b in blocks if b)
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


PAGE = """<html><body><header><h1>Site</h1></header><div id="sidebar"><p>Long sidebar text, with commas, and more. Yes.</p></div>
<div class="cookie-notice">We use cookies. Accept, please.</div><div class="content"><h2>Title</h2><p>First <b>bold</b>
paragraph with <a href=x>a link</a>, and more.</p><ul><li>one<li>two, three</ul><blockquote>Quote&nbsp;me &amp; you.</blockquote><p>Short.</p></div>
<div class="comments"><p>I think, this is a very long comment. With lots of punctuation, really; more than others!</p></div>
<form><p>Subscribe, now.</p></form><script>if (a < b) { "<p>no</p>" }</script><footer>foot</footer></body></html>"""


@pytest.mark.parametrize(
    ("source", "expected"),
    [
        (PAGE, "Title\nFirst bold paragraph with a link, and more.\none\ntwo, three\nQuote me & you.\nShort."),
        (None, ""), ("", ""), ("<", "<"), ("plain", "plain"), ("<!-- open", ""), ("<div>" * 20_000 + "x", "x"), ("<p>a<br>b", "a\nb"),
        ("<p>1 < 2 &lt;b&gt; &#233; &bogus;</p><script>never closed", "1 < 2 <b> é &bogus;"), ("<nav>menu</nav>", ""),
    ],
)
def test_page_cases(source, expected):
    assert html_text.main_text(source) == expected


LINES = ["It was a bright cold day, and the clocks were striking thirteen.", "Nobody in the town had heard of it, or so they said; not one."]
TEXT = "".join(f"<p>{x}</p>" for x in LINES)
MENU = '<nav><a href="/">Home</a></nav><div class="ad">Buy this now, it is cheap.</div><div class="comments"><p>I think so too, and I do say it.</p></div>'


@pytest.mark.parametrize(
    "source",
    [
        f'<body class="no-sidebar">{MENU}{TEXT}', f'<html class="skin-vector-search-vue"><body class="content-sidebar header-full-width has-comments">{MENU}{TEXT}',
        f'{MENU}<div class="article-notice-free">{TEXT}</div>', f'{MENU}<article class="related-none">{TEXT}</article>', f'{MENU}<main class="search">{TEXT}</main>',
        f"<body><form action=x>{MENU}{TEXT}</form>", f'<body><div class="widget">{MENU}<div>{TEXT}</div></div>', f'{MENU}<article><header class="entry-header">{TEXT}</header></article>',
        f'<div class="promo-box"><p>Buy now.</p></div>{MENU}<article>{TEXT}<div class="social-share">Share it</div></article>',
    ],
)
def test_names_of_layouts_do_not_hide_articles(source):
    assert html_text.main_text(source) == "\n".join(LINES)


LONG = "".join(f"<p>{x}</p>" for x in LINES * 4)


@pytest.mark.parametrize(
    ("source", "expected"),
    [
        (f'{MENU}<article><h1>Title</h1><div class="lead"><p>Short lead.</p></div><div class="entry">{LONG}</div></article>', ["Title", "Short lead.", *LINES * 4]),
        (f'{MENU}<div id="post"><h1>Title</h1><div class="lead"><p>Short lead.</p></div><div class="entry">{LONG}</div><ul><li><a href=x>More</a></ul></div>', ["Title", "Short lead.", *LINES * 4]),
        (f'{MENU}<main><section class="a">{TEXT}</section><section class="b">{LONG}</section><section class="c"><p>The end.</p></section></main>', [*LINES * 5, "The end."]),
        (f'{MENU}<div><h1>Title</h1></div><div class="a">{TEXT}</div><div class="b">{LONG}</div><div class="list"><h3>More</h3><a href=x>Some other page of it</a></div>', ["Title", *LINES * 5]),
        (f'{MENU}<div><article class="a">{LONG}</article><article class="b">{TEXT}</article><div class="c"><p>All rights are kept.</p></div></div>', LINES * 5),
    ],
)
def test_titles_and_sections_beside_the_longest_text_are_kept(source, expected):
    assert html_text.main_text(source) == "\n".join(expected)


LONG = ["The first paragraph runs on for a while, with commas, so that it is the text of this page.", "The second one does so as well, and it ends the article, as far as anyone can tell."]


@pytest.mark.parametrize(
    ("part", "kept"),
    [
        ('<h2><a href="/x">A linked headline</a></h2>', ["A linked headline"]),
        ('<ul><li><a href="/1">Reference one</a></li><li><a href="/2">Reference two</a></li></ul>', ["Reference one", "Reference two"]),
        ("<aside>A quote that is set apart, in large type.</aside>", ["A quote that is set apart, in large type."]),
        ('<aside><h3>More</h3><ul><li><a href="/1">Another story</a></li></ul></aside>', []),
        ('<aside class="sidebar"><p>Buy this now, it is cheap.</p></aside>', []),
        ('<p class="skip">Hello there, reader.</p>', ["Hello there, reader."]),
        ('<p class="skip">Skip to content</p>', []),
        ('<p class="social-history">A short note.</p>', ["A short note."]),
        ('<div class="social"><p>Share this, please.</p></div>', []),
        ('<p class="advert">Buy this now, please.</p>', []),
        ('<ul><li><a href="/1">Home</a></li><li><a href="/2">Contact</a></li></ul>', []),
    ],
)
def test_parts_of_an_article(part, kept):
    page = f"<body><article><p>{LONG[0]}</p>{part}<p>{LONG[1]}</p></article></body>"
    assert html_text.main_text(page) == "\n".join([LONG[0], *kept, LONG[1]])


def test_a_soft_name_outside_of_articles():
    page = f'<div id="main"><p>{LONG[0]}</p><p class="reply">He gave a reply, they say.</p><p>{LONG[1]}</p></div>'
    assert html_text.main_text(page) == "\n".join([LONG[0], "He gave a reply, they say.", LONG[1]])


def test_pages_of_odd_tables(spark):
    page = f"<article><p>{LONG[0]}</p></article>"
    rows = [(1, "u", page, "x", 5), (1, "u", page, "x", 5), (2, None, None, None, None), (3, "v", "", "y", 1), (4, "w", f"<article>{f'<p>{LONG[0]}</p>' * 5_000}</article>", "z", 2)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, n_chars int")
    got = sorted((r.page_id, r.url or "", r.text, r.n_chars) for r in html_text.extract(pages).collect())
    texts = [(1, "u", LONG[0]), (1, "u", LONG[0]), (2, "", ""), (3, "v", ""), (4, "w", "\n".join(LONG[:1] * 5_000))]
    assert got == [(*t, len(t[2])) for t in texts]
    assert html_text.extract(pages.filter("false")).collect() == []


def test_formulas_are_text():
    assert html_text.main_text("<p>So <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math>, as said.</p>") == "So x=1, as said."


@pytest.fixture(scope="module")
def labelled(spark):
    random = np.random.default_rng(8)
    bad = ["vile", "awful", "nasty"]
    rows, labels = [], []
    for i in range(900):
        toxic = int(i % 4 == 0)
        own = [f"w{int(x)}" for x in random.zipf(1.3, 40) % 400]
        rows.append((i, " ".join(own + [bad[int(x)] for x in random.integers(0, 3, 4)] * toxic)))
        labels.append((i, toxic))
    odd = [(1000, None), (1001, ""), (1002, "vile awful nasty vile awful nasty"), (None, "w1 w2")]
    return (
        spark.createDataFrame(rows + odd, "doc_id bigint, text string"),
        spark.createDataFrame(labels + [(1003, 1), (None, 1), (5, None), (7, 3)], "doc_id bigint, toxic int"),
    )


def test_toxicity_on_held_out_rows(labelled):
    docs, labels = labelled
    got = {r.doc_id: r for r in toxicity.predictions(docs, labels).collect()}
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (i in set(held)) for i in range(900))
    assert sum(got[i].predicted == int(i % 4 == 0) for i in held) >= 0.97 * len(held)
    assert got[1002].predicted == 1 and got[1000].score == got[1001].score < 0.5
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    left = toxicity.reject(docs, toxicity.learned(docs, labels))
    assert {r.doc_id for r in left.collect()} == {i for i, r in got.items() if r.predicted == 0}


def _counted(rows):
    """Beginnings of each document's distinct words, by class."""
    counts = {}
    for text, label in rows:
        for word in set(text.encode().lower().split()):
            for beginning in toxicity.beginnings(word):
                own = counts.setdefault(beginning, [0, 0])
                own[label] += 1
    return {b: tuple(n) for b, n in counts.items()}


def _plain_evidence(counts, word):
    """Log ratio of the two Kneser-Ney likelihoods, byte by byte, from all counts."""
    totals = [sum(n[k] for b, n in counts.items() if len(b) == 1) for k in (0, 1)]
    discounts = [toxicity.DISCOUNT * max(n, 1) / max(min(totals), 1) for n in totals]
    evidence, context = 0.0, b""
    for beginning in toxicity.beginnings(word):
        children = [n for b, n in counts.items() if len(b) == len(context) + 1 and b.startswith(context)]
        if not children:
            break
        both = sum(a + b for a, b in children)
        own = counts.get(beginning)
        # The backoff of what was never seen is some probability, the same in both classes.
        shared = sum(own) / both if own else 1 / (both + 1)
        for k, sign in ((0, -1), (1, 1)):
            n = sum(c[k] for c in children)
            if n:
                freed = sum(min(c[k], discounts[k]) for c in children)
                kept = max(own[k] - discounts[k], 0.0) if own else 0.0
                evidence += sign * np.log((kept + freed * shared) / n / shared)
        if own is None:
            break
        context = beginning
    return evidence


def test_evidence_is_that_of_all_counts(labelled):
    docs, labels = labelled
    known = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [(r.text, known[r.doc_id]) for r in docs.collect() if r.text and known.get(r.doc_id) in (0, 1)][:150]
    counts = _counted(rows)
    whole = toxicity.Model(dict(counts)).prepare()
    cut = toxicity.Model({b: n for b, n in counts.items() if sum(n) > toxicity.DISCOUNT or len(b) == 1}).prepare()
    words = sorted({w for t, _ in rows for w in t.encode().lower().split()})[::7] + [b"never", b"zzz", b"", b"\xc3\xa9"]
    assert len(cut.counts) < len(whole.counts)
    for word in words:
        assert whole.word(word) == pytest.approx(_plain_evidence(counts, word), abs=1e-9)
        assert cut.word(word) == pytest.approx(whole.word(word), abs=1e-9)


def test_held_out_labels_do_not_matter(labelled):
    docs, labels = labelled
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    score = lambda known: {r.doc_id: r.score for r in toxicity.predictions(docs, known).collect()}
    assert score(labels) == score(flipped)


def test_no_labels(labelled):
    docs, labels = labelled
    assert {r.score for r in toxicity.predictions(docs, labels.filter("false")).collect()} == {0.5}
    assert toxicity.predictions(docs.filter("false"), labels).collect() == []


def test_pipeline(spark):
    from .test_text_operators import deduplicated, linked, print_of

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, frame = frame, stage(spark, frame, SF)
        assert frame.columns == docs.columns, name
        was, now = ({r.doc_id: r.text for r in f.collect()} for f in (before, frame))
        if name == "near_duplicates":
            groups = linked([(i, print_of(t)) for i, t in was.items()])
            assert set(now) == {c for _, _, c in groups}
        if name == "repeated_passages":
            gone = {i: n for i, _, n, _ in deduplicated(was.items())}
            assert {i: now[i] if not gone[i] else " ".join(now[i].split()) for i in now} == {i: was[i] if not gone[i] else t for i, _, _, t in deduplicated(was.items())}
        if name == "benchmark_leaks":
            held = {r.doc_id for r in decontamination.leaks(before, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
            assert set(now) == set(was) - held
    result = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in result.collect()} == {r.doc_id for r in frame.collect()}
