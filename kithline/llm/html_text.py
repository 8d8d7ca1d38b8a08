"""Main text of web pages by tree scoring.

A page is read leniently into a tree. Every block of text is worth points for its length and its commas, discounted by the
share of its text that is links; it passes them to its ancestors, half as many with each level. The best container is
kept, widened to the article or main element around it; without one, siblings that score well, or are headings and
paragraphs with few links, are kept too. Articles beside the best one that score well are kept with it.

What lies in navigation, page headers and footers, sidebars, notices, adverts, forms, scripts, styles or reader comments has no
text. Elements, roles and hidden parts say so for certain. Names (class, id) and headings such as "Comments" are hints:
outside articles every part of a name counts; inside them only names that as a whole tell a box, so that sections
called "related-work" or "article-header" stay. A hint is not followed where the element holds the article's main heading,
or an article, or most of the article's points (of the page's, where it has no article). Outside articles, neighbouring blocks that are mostly links have no text either.

Reading and scoring take time in proportion to the page, however its elements are nested or left open.

Defined results: a null or empty page, or one without text outside such parts, gives the empty string; unclosed and
misnested elements are closed where the next block begins; a tag without its end is text; a missing end of a comment
or script runs to the page's end. Each page is a result row, also when urls or ids repeat; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|"""
    r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul".split())
DROPPED = frozenset("aside button datalist dialog footer form frameset head input label menu nav object option select svg".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LEAVES = HEADINGS | frozenset("p pre blockquote td li dd dt".split())
#: Opening one of these ends an open one of the listed kinds (up to the enclosing container).
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}}
SCOPE = frozenset("html body table ul ol dl div section article main aside nav td th blockquote form".split())

# Names that page makers give to what is not the article, and to what is; fixed values, compared word by word.
ROLES_OUT = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
NAMES_OUT = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted "
    "sidebar aside rail comment comments commentlist discussion disqus replies respond cookie cookies consent gdpr notice "
    "notices notification alert popup modal overlay newsletter subscribe subscription signup login paywall share sharing social "
    "related recommended recommendations breadcrumb breadcrumbs menu navbar nav navigation pagination pager footer masthead "
    "header topbar toolbar widget widgets skip search outbrain taboola feedback".split())
#: Words of an article's own parts, which inside it are no hint; and words that go with a box's name.
NAMES_OWN = frozenset("header discussion search skip feedback replies promotion promoted".split())
NAMES_BESIDE = frozenset(
    "box list area section container wrapper wrap block slot button buttons bar posts post articles article stories links link form "
    "thread icon icons inner item items panel unit group media row col column top bottom left right".split())
NAMES_COMMENTS = frozenset("comment comments commentlist disqus respond".split())
NAMES_IN = frozenset(
    "content main article post entry story main-content maincontent article-body articlebody post-body post-content "
    "entry-content article-content story-body page-content body-content text".split())
HEADING_OUT = re.compile(
    r"(?:\d+\s+)?(?:reader\s+)?(?:comments?|leave a (?:reply|comment)|related (?:articles|posts|stories)|"
    r"kommentare?|commentaires?|comentarios?)(?:\s*\(?\d+\)?)?:?\Z", re.I)

_CERTAIN, _HINT, _COMMENTS = 3, 1, 2


def _told_out(tag: str, attributes: str, in_article: bool) -> int:
    """How surely an element's start tells that it is not the article: 0 not at all, a hint, comments, or for certain."""
    if tag in DROPPED or (tag == "header" and not in_article):
        return _CERTAIN
    if not attributes or tag in ("html", "body"):
        return 0
    names, told = [], 0
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return _CERTAIN
        if name == "role" and value.lower() in ROLES_OUT:
            return _CERTAIN
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return _CERTAIN
        if name in ("class", "id"):
            names += value.split()
    for name in names:
        if name.lower() in NAMES_IN:
            return 0
        parts = [part.lower() for part in _NAME_PART.findall(name)]
        out = [part for part in parts if part in NAMES_OUT]
        if in_article:
            out = [part for part in out if part not in NAMES_OWN]
            if not all(part in NAMES_OUT or part in NAMES_BESIDE or part.isdigit() for part in parts):
                out = []
        if out:
            told = max(told, _COMMENTS if NAMES_COMMENTS.intersection(out) else _HINT)
    return told


class _Page:
    """The tree of a page: per node its tag, parent (always an earlier node) and sums; per block of text its node."""

    def __init__(self, source: str):
        self.tag, self.parent, self.told, self.out, self.home = ["root"], [-1], [0], [False], [False]
        self.blocks: list[tuple[int, str, int]] = []
        self._stack, self._buffer, self._link = [0], [], 0
        self._open_at: dict[str, list[int]] = {}  # per tag its places on the stack
        self._scopes: list[int] = []
        self._read(source)

    def _flush(self) -> None:
        if not self._buffer:
            return
        pieces, self._buffer = self._buffer, []
        node = self._stack[-1]
        if not self.out[node]:
            text = " ".join(html.unescape("".join(p for p, _ in pieces)).split())
            if text:
                linked = sum(len(p.strip()) for p, link in pieces if link)
                self.blocks.append((node, text, min(linked, len(text))))

    def _cut(self, place: int) -> None:
        """Closes all elements from a place of the stack on."""
        for node in reversed(self._stack[place:]):
            self._open_at[self.tag[node]].pop()
            if self.tag[node] in SCOPE:
                self._scopes.pop()
        del self._stack[place:]

    def _open(self, tag: str, attributes: str) -> None:
        stack = self._stack
        if self.tag[stack[-1]] == "p":
            self._cut(len(stack) - 1)
        if tag in ENDS:
            last = max((self._open_at[t][-1] for t in ENDS[tag] if self._open_at.get(t)), default=0)
            if last and last >= (self._scopes[-1] if self._scopes else 0):
                self._cut(last)
        above = stack[-1]
        inside = self.home[above]
        told = _told_out(tag, attributes, inside)
        self.tag.append(tag)
        self.parent.append(above)
        self.told.append(told)
        self.out.append(self.out[above] or told == _CERTAIN)
        self.home.append(inside or tag in ("article", "main") or "articleBody" in attributes)
        self._open_at.setdefault(tag, []).append(len(stack))
        if tag in SCOPE:
            self._scopes.append(len(stack))
        stack.append(len(self.tag) - 1)

    def _read(self, source: str) -> None:
        at, last = 0, source.rfind(">")
        hidden, depth = None, 0  # the inline element that is out, and how many of its tag are open in it
        while True:
            m = _TOKEN.search(source, at) if at <= last else None
            if m is None:  # behind the last tag only a comment without end can follow
                end = source.find("<!--", at)
                rest = source[at:] if end < 0 else source[at:end]
                if rest and hidden is None:
                    self._buffer.append((rest, self._link > 0))
                break
            piece = source[at:m.start()]
            if piece and hidden is None:
                self._buffer.append((piece, self._link > 0))
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
            if tag in RAW and not closing and not attributes.endswith("/"):
                end = re.compile(rf"</{tag}\s*>?", re.I).search(source, at)
                at = end.end() if end else len(source)
            elif tag in BLOCK:
                self._flush()
                self._link, hidden = 0, None
                if not closing:
                    if tag not in VOID:
                        self._open(tag, attributes)
                elif self._open_at.get(tag):
                    self._cut(self._open_at[tag][-1])
            elif hidden is not None:
                if tag == hidden:
                    depth += -1 if closing else not attributes.endswith("/")
                    if not depth:
                        hidden = None
            elif tag == "br":
                self._buffer.append((" ", False))
            elif tag == "a":
                self._link = 0 if closing else 1
            elif not closing and tag not in VOID and not attributes.endswith("/") and _told_out(tag, attributes, True):
                hidden, depth = tag, 1
        self._flush()

    def _sums(self) -> tuple[list[int], list[int], list[float]]:
        """Length, length of links, and points of all nodes, from the last node to the first: children come before parents."""
        n = len(self.tag)
        length, linked, own, points = [0] * n, [0] * n, [0.0] * n, [0.0] * n
        for node, text, links in self.blocks:
            size = len(text)
            worth = (1.0 if size >= 25 else 0.2) + text.count(",") + text.count("、") + text.count("，") + min(size / 100, 3.0)
            worth *= (0.2 if self.tag[node] in HEADINGS else 1.0) * (1 - links / size)
            length[node] += size
            linked[node] += links
            # A paragraph's points count for its parent as they are.
            up = self.parent[node] if self.tag[node] in LEAVES and node else node
            own[up] += worth
        for node in range(n - 1, -1, -1):
            points[node] += own[node]
            up = self.parent[node]
            if up >= 0:
                length[up] += length[node]
                linked[up] += linked[node]
                points[up] += points[node] / 2
        return length, linked, points

    def _follow_hints(self) -> None:
        """Leaves out what names and headings tell, where the article is left without it."""
        n = len(self.tag)
        told = list(self.told)
        begun: set[int] = set()
        for k, (node, text, _) in enumerate(self.blocks):
            section = self.parent[node]
            if section > 0 and section not in begun:
                begun.add(section)
                if k and self.tag[section] in ("section", "div") and self.tag[node] in HEADINGS and HEADING_OUT.match(text):
                    told[section] = max(told[section], _COMMENTS)
        if not any(0 < t < _CERTAIN for t in told):
            return
        worth, holds = [0.0] * n, [False] * n
        for node, text, links in self.blocks:
            worth[node] += (len(text) + 25 * text.count(",")) * (1 - links / len(text))
        for node in range(n - 1, 0, -1):
            worth[self.parent[node]] += worth[node]
            if not self.out[node] and (self.tag[node] in ("article", "main") or (self.tag[node] == "h1" and self.home[node])):
                holds[node] = True
            holds[self.parent[node]] |= holds[node]
        whole = list(worth)  # per node the worth of the outermost article around it, or of the page
        for node in range(1, n):
            if self.home[node]:
                whole[node] = whole[self.parent[node]] if self.home[self.parent[node]] else worth[node]
            else:
                whole[node] = worth[0]
        has_home = any(self.home[node] for node, _, _ in self.blocks)
        for node in range(1, n):
            most = worth[node] > 0.5 * whole[node] and (self.home[node] or not has_home)
            hint = told[node] == _HINT and not most or told[node] == _COMMENTS and not (most and self.tag[node] in ("article", "main", "body"))
            self.out[node] = self.out[node] or self.out[self.parent[node]] or (hint and not holds[node])
        self.blocks = [b for b in self.blocks if not self.out[b[0]]]

    def _tops(self, length: list[int], linked: list[int], points: list[float]) -> set[int]:
        """The best container, widened to its article, or with its good siblings."""
        n = len(self.tag)
        inside = [k for k in range(n) if self.home[k] and length[k]]
        # Articles come first, unless they hold little of the page's text.
        held = sum(length[k] for k in inside if not self.home[self.parent[k]])
        best = max(inside if held >= 0.25 * length[0] else range(n), key=lambda k: points[k] * (1 - linked[k] / max(length[k], 1)))
        home, article, node = 0, 0, best
        while node > 0:
            home = node if self.home[node] else home
            article = node if self.tag[node] == "article" else article
            node = self.parent[node]
        if home:
            if article and article != home:
                # A main element with several articles is kept whole, else its one article.
                inner = [k for k in range(home + 1, n) if self.tag[k] == "article" and not self.out[k] and length[k]]
                return {home} if any(not self._inside(k, article) and not self._inside(article, k) for k in inner) else {article}
            beside = [k for k in range(1, n) if self.parent[k] == self.parent[home] and self.tag[k] == "article" and self.tag[home] == "article"]
            return {home, *(k for k in beside if points[k] >= 0.2 * points[home] and not self.out[k])}
        if best <= 0 or self.tag[best] in ("body", "html"):
            return {best}
        tops, least = {best}, 0.2 * points[best]
        for k in range(1, n):
            if self.parent[k] == self.parent[best] and length[k]:
                few = linked[k] <= 0.25 * length[k]
                if few and (points[k] >= least or self.tag[k] in HEADINGS or self.tag[k] in ("p", "pre", "blockquote", "figure")):
                    tops.add(k)
        return tops

    def _inside(self, node: int, above: int) -> bool:
        while node > above:
            node = self.parent[node]
        return node == above

    def text(self) -> str:
        self._follow_hints()
        if not self.blocks:
            return ""
        tops = self._tops(*self._sums())
        inside = [False] * len(self.tag)
        for node in range(len(self.tag)):
            inside[node] = node in tops or (node > 0 and inside[self.parent[node]])
        loose = ("li", "div", "td", "th", "ul", "ol", "section", "table")
        kept = [(node, text, linked) for node, text, linked in self.blocks if inside[node]]
        # Outside an article or main element, neighbouring blocks of links are a menu; inside it they are its own lists.
        dense = [False, *(self.tag[node] in loose and linked >= 0.6 * len(text) and not self.home[node] for node, text, linked in kept), False]
        return "\n\n".join(
            text for k, (_, text, _) in enumerate(kept, 1) if not (dense[k] and (dense[k - 1] or dense[k + 1])))


def main_text(source: str | None) -> str:
    return _Page(source).text() if source else ""


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py()) for page in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages(page_id, url, html)``."""
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long")
