"""Main text of web pages by tag-path ratios.

Text nodes that play the same part on a page hang on the same path of tags from the root. For each such
path, down to the block element, the page's text length and punctuation are added up and divided by the
number of nodes on it: running text has long, punctuated nodes, menus and notices short ones without
punctuation. Both ratios are smoothed along the page with their neighbouring paths, fused into one score
and compared with a threshold that follows from the spread of the page's scores. The paths above it show
where the content is: their common container, widened to the article or main element it is in. Outside
one, and between articles, neighbours of the container that are content by their paths (headings,
sentences, running text) for the larger part of their text belong to it too, level by level. Blocks of
all these are the text, short ones and headings among them, but for paths that are links in the main.

Menus, headers of the page, footers, sidebars, dialogs, scripts and styles take no part by their tag. An
element is suspected if it is a form or has a class, id or role that as a whole names a part that is not
content; it is left out unless it holds most of the page's text and little running text and no article is elsewhere. A
name that only has such a word in it is evidence: it lowers the score, and text there has to be running
text. The elements html, body, main and article are never judged by their names. On a paragraph or heading a
name that may as well tell of its style (``SOFT_NAMES``) only asks for a sentence. Inside an article a
linked heading, a list of links that read like references, and an aside of one or two blocks without links or
headings (a pull quote) are content.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices_by_bytes

# Fixed values of the HTML standard and names in common use for parts that are not content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg select button annotation annotation-xml".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike"
    " strong sub sup time tt u var wbr math semantics maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts"
    " mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr li main menu nav ol p pre section summary table tbody td th thead tr ul".split()
)
# A start tag ends an open element of these, unless one of the others lies between.
CLOSES_OWN = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
NOT_CONTENT = frozenset("head nav header footer aside menu dialog".split()) | RAW
FORMS = frozenset(("form", "fieldset"))
LANDMARKS = frozenset(("html", "body", "main", "article"))
NOT_CONTENT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar aside menu nav navbar"
    " navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice notification popup modal overlay"
    " newsletter subscribe signup login search share sharing social related recommended widget comment comments commentlist reply"
    " replies disqus pager pagination skip toolbar copyright complementary contentinfo search".split()
)
SOFT_NAMES = frozenset("skip social reply header search".split())
PUNCTUATION = re.compile(r"[.,;:!?…、。！？؟।]")
WEIGHTS = (0.25, 0.5, 0.25)
SPREAD = 0.5
NAME_WEIGHT = 0.25
RUNNING_CHARS = 40
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TEXT_TAGS = frozenset("p blockquote pre li dd".split())
MOSTLY_LINKS = 0.6
REFERENCE_CHARS = 12
QUOTE_BLOCKS = 2

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>?|[^<]+|<", re.S)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME_PARTS = re.compile(r"[^a-z]+")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in RAW}


class Page:
    """Tag paths of a page and the blocks of text on them, in page order."""

    def __init__(self, source: str):
        # For each path: the path above it, its tag, whether its tags can be content, whether its own element is suspected or has a telling name.
        self.parent, self.tag, self.content, self.suspected, self.named = [-1], [""], [True], [False], [False]
        # Whether it is a text element with a soft name, is in an article, and is an aside there.
        self.soft, self.in_article, self.aside = [False], [False], [False]
        self._known: dict[tuple[int, str], int] = {}
        self.blocks: list[tuple[int, str, int]] = []
        self._words: list[str] = []
        self._link_chars = 0
        self._stack: list[tuple[str, int]] = [("", 0)]
        self._open: Counter[str] = Counter()
        self._read(source)

    def _path(self, above: int, tag: str, attributes: str) -> int:
        tokens = [t for m in _NAMES.finditer(attributes) for t in (m[1] or m[2] or m[3] or "").lower().split()]
        names = [p for t in tokens for p in _NAME_PARTS.split(t) if p]
        key = above, f"{tag}.{'.'.join(names)}.{any(t in NOT_CONTENT_NAMES for t in tokens)}"
        if key not in self._known:
            path = self._known[key] = len(self.parent)
            judged = tag not in LANDMARKS
            telling = NOT_CONTENT_NAMES.intersection(names)
            soft = bool(telling) and telling <= SOFT_NAMES and (tag in TEXT_TAGS or tag in HEADINGS)
            suspected = tag in FORMS or (judged and not soft and not NOT_CONTENT_NAMES.isdisjoint(tokens))
            # The header of an article has its title, an aside of it may be a quote.
            barred = tag in NOT_CONTENT and not (tag in ("header", "aside") and self.in_article[above])
            self.parent.append(above)
            self.tag.append(tag)
            self.content.append(self.content[above] and not barred and not (suspected and tag in INLINE))
            self.suspected.append(suspected and tag not in INLINE)
            self.named.append(judged and not soft and bool(telling))
            self.soft.append(soft)
            self.in_article.append(self.in_article[above] or tag == "article")
            self.aside.append(tag == "aside" and self.content[path])
        return self._known[key]

    def _flush(self) -> None:
        if self._words:
            text = " ".join("".join(self._words).split())
            if text:
                self.blocks.append((self._stack[-1][1], text, self._link_chars))
            self._words, self._link_chars = [], 0

    def _close(self, tags: set[str], until: set[str] = frozenset()) -> None:
        """Close the innermost open element among ``tags`` with all inside it, if none of ``until`` is in between."""
        if not any(self._open[t] for t in tags):
            return
        for i in range(len(self._stack) - 1, 0, -1):
            tag = self._stack[i][0]
            if tag in tags:
                if not all(t in INLINE for t, _ in self._stack[i:]):
                    self._flush()
                self._open.subtract(t for t, _ in self._stack[i:])
                del self._stack[i:]
                return
            if tag in until:
                return

    def _read(self, source: str) -> None:
        at = 0
        while match := _TOKEN.match(source, at):
            at = match.end()
            tag = match[2]
            if tag is None:
                token = match[0]
                if token[0] != "<" or token == "<":
                    self._text(token)
                continue
            tag = tag.lower()
            if match[1]:
                if tag == "br":
                    self._flush()
                else:
                    self._close({tag}, {"table", "td", "th"} - {tag} if tag in INLINE or tag == "p" else frozenset())
                continue
            if tag in RAW:
                end = _RAW_END[tag].search(source, at)
                at = end.start() if end else len(source)
                if tag not in INLINE and tag not in ("button", "select", "svg", "annotation", "annotation-xml"):
                    self._flush()
                continue
            if tag not in INLINE:
                self._flush()
            if tag in CLOSES_P:
                self._close({"p"}, {"table", "td", "th", "button"})
            if tag in CLOSES_OWN:
                own, until = CLOSES_OWN[tag]
                while (before := len(self._stack)) and (self._close(own, until) or True) and len(self._stack) < before:
                    pass
            if tag not in VOID:
                above = self._stack[-1][1]
                # Paths end at the block element, so that emphasis does not split a paragraph; what hides its text still counts.
                path = self._path(above, tag, match[3])
                if tag in INLINE and self.content[path] == self.content[above]:
                    path = above
                self._stack.append((tag, path))
                self._open[tag] += 1
        self._flush()

    def _text(self, token: str) -> None:
        tag, path = self._stack[-1]
        if not self.content[path]:
            return
        text = entities.unescape(token) if "&" in token else token
        self._words.append(text)
        if self._open["a"]:
            self._link_chars += len(text.strip())

    def _ancestors(self, path: int) -> Iterator[int]:
        while path >= 0:
            yield path
            path = self.parent[path]

    def _judge(self) -> None:
        """Sum up the paths; find which are left out and which have a telling name; leave out blocks accordingly."""
        n = len(self.parent)
        self.chars, self.links, self.marks, self.nodes = [0] * n, [0] * n, [0] * n, [0] * n
        for path, text, links in self.blocks:
            self.chars[path] += len(text)
            self.links[path] += min(links, len(text))
            self.marks[path] += len(PUNCTUATION.findall(text))
            self.nodes[path] += 1
        below = self._summed([c - k for c, k in zip(self.chars, self.links, strict=True)])
        most = [2 * b > below[0] for b in below]
        # What a quote has none of, and how many blocks it is.
        unlike_quote = self._summed([k if self.tag[p] not in HEADINGS else k + m for p, (k, m) in enumerate(zip(self.links, self.nodes, strict=True))])
        n_blocks = self._summed(self.nodes)
        nearest, running = [0] * n, [0] * n
        for path in range(1, n):
            nearest[path] = path if self.suspected[path] else nearest[self.parent[path]]
        for path in range(n):
            if self._running(path):
                running[nearest[path]] += self.chars[path]
        elsewhere = running[0]
        landmarks = [p for p in range(n) if self.tag[p] in ("article", "main") and below[p] and not nearest[p]]
        out, self.hinted = [False] * n, [False] * n
        for path in range(1, n):
            above = self.parent[path]
            out[path] = out[above] or (self.aside[path] and (unlike_quote[path] > 0 or n_blocks[path] > QUOTE_BLOCKS))
            if self.suspected[path] and not out[path]:
                if most[path] and 4 * elsewhere <= below[path] and set(landmarks) <= set(self._ancestors(path)):
                    elsewhere += running[path]
                else:
                    out[path] = True
            self.hinted[path] = self.hinted[above] or (self.named[path] and not most[path])
        self.blocks = [b for b in self.blocks if not out[b[0]]]
        for path in range(n):
            if out[path]:
                self.chars[path] = self.links[path] = self.marks[path] = self.nodes[path] = 0

    def _widened(self, container: int) -> list[bool]:
        """Which paths are inside the container, the article it is in, or neighbours that are content."""
        n = len(self.parent)
        at = next((p for p in self._ancestors(container) if self.tag[p] in ("article", "main")), container)
        inside = self._below({at})
        landmark = [p for p in self._ancestors(at) if self.tag[p] == "main"]
        top = landmark[-1] if landmark else 0
        content = self._summed([self.chars[p] if self._content_like(p) else 0 for p in range(n)])
        text = self._summed(self.chars)
        bare = self.tag[at] in ("article", "main") and not landmark
        children = defaultdict(list)
        for path in range(1, n):
            children[self.parent[path]].append(path)
        added = {at}
        while at != top:
            above = self.parent[at]
            for path in children[above]:
                # Next to an article outside of any main element only other articles go on with it.
                if path != at and 2 * content[path] > text[path] and (not bare or self.tag[path] == "article"):
                    added.add(path)
            if self._content_like(above) and not bare:
                inside[above] = True
            at = above
        return [i or j for i, j in zip(inside, self._below(added), strict=True)]

    def _below(self, roots: set[int]) -> list[bool]:
        """Whether a path is one of the given or below one."""
        inside = [False] * len(self.parent)
        for path, above in enumerate(self.parent):
            inside[path] = path in roots or (above >= 0 and inside[above])
        return inside

    def _summed(self, values: list[int]) -> list[int]:
        """Of each path, the sum over it and all paths below."""
        total = list(values)
        for path in range(len(total) - 1, 0, -1):
            total[self.parent[path]] += total[path]
        return total

    def _running(self, path: int) -> bool:
        return self.marks[path] >= self.nodes[path] > 0 and self.chars[path] - self.links[path] >= RUNNING_CHARS * self.nodes[path]

    def _content_like(self, path: int) -> bool:
        """Whether text on the path counts as content outside the container: a heading, sentences or running text."""
        if not self.nodes[path] or self.hinted[path] or self.links[path] > MOSTLY_LINKS * self.chars[path]:
            return False
        return self.tag[path] in HEADINGS or (self.tag[path] in TEXT_TAGS and self.marks[path] >= self.nodes[path]) or self._running(path)

    def _sentences(self, path: int) -> bool:
        return self.tag[path] in HEADINGS or self.marks[path] >= self.nodes[path]

    def _only_links(self, path: int) -> bool:
        """Whether the path is a menu: links in the main, and no heading or list of references of an article."""
        if self.links[path] <= MOSTLY_LINKS * self.chars[path] or self.tag[path] in HEADINGS:
            return False
        reference = self.marks[path] >= self.nodes[path] or self.chars[path] >= REFERENCE_CHARS * self.nodes[path]
        return not (self.in_article[path] and reference)

    def scores(self) -> dict[int, float]:
        """Fused and smoothed ratio of each path, in the order in which the page has them."""
        order = list(dict.fromkeys(path for path, _, _ in self.blocks))
        length = {p: self.chars[p] - self.links[p] for p in order}
        ratios = [(length[p] / self.nodes[p], (1 + self.marks[p]) / self.nodes[p]) for p in order]
        fused = {}
        for i, path in enumerate(order):
            near = [(w, ratios[j]) for w, j in zip(WEIGHTS, (i - 1, i, i + 1), strict=True) if 0 <= j < len(order)]
            total = sum(w for w, _ in near)
            by_text, by_mark = (sum(w * r[k] for w, r in near) / total for k in (0, 1))
            # Smoothing must not lift a path without text of its own, so its share of the page's text counts too.
            fused[path] = (by_text * by_mark) ** 0.5 * length[path] * (NAME_WEIGHT if self.hinted[path] else 1)
        return fused

    def main_text(self) -> str:
        """The content blocks joined by line ends; empty if there are none."""
        self._judge()
        if not self.blocks:
            return ""
        fused = self.scores()
        values = list(fused.values())
        mean = sum(values) / len(values)
        spread = (sum((v - mean) ** 2 for v in values) / len(values)) ** 0.5
        threshold = min(mean + SPREAD * spread, max(values))
        chosen = {p for p in fused if fused[p] >= threshold}
        # The deepest path above all chosen ones, a block's own element left out.
        first, *others = chosen
        common = list(self._ancestors(self.parent[first]))
        for path in others:
            other = set(self._ancestors(self.parent[path]))
            common = [p for p in common if p in other]
        container = common[0] if common else 0
        inside = self._widened(container)
        kept = {p for p in fused if inside[p] and (p in chosen or self._running(p) or not (self.hinted[p] or self.soft[p]) or (self.soft[p] and self._sentences(p)))}
        return "\n".join(t for p, t, _ in self.blocks if p in kept and not self._only_links(p))


def main_text(source: str | None) -> str:
    return Page(source).main_text() if source else ""


def extract(df: DataFrame, keep: Sequence[str] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """The columns ``keep`` of every row, with the page's main ``text`` and its length ``n_chars`` in code points.

    A null or empty page has an empty text, as has one without content. A very long page is read whole.
    Repeated rows are extracted each, an empty table gives no rows; columns not in ``keep`` are ignored.
    """
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("text", T.StringType())])
    source = "_source"

    def batches(stream):
        for batch in stream:
            for start, stop in slices_by_bytes(batch.column(source)):
                part = batch.slice(start, stop - start)
                texts = pa.array([main_text(h) for h in part.column(source).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], texts], schema.names)

    rows = df.select(*keep, df[html_col].cast("string").alias(source)).mapInArrow(batches, schema)
    return rows.withColumn("n_chars", F.length("text").cast("long"))
