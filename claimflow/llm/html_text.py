"""Main text of web pages by two passes of block rules.

A page is read once, tag by tag. Text between block-level tags is a block;
blocks of containers that never hold the article (menus, headers, footers,
sidebars, notices, adverts, forms, comments; by tag, role, class or id) are
left out. The rest is classified:

1. by length, stop-word density and link density a block is good, bad, or
   undecided (short blocks, and long ones without listed stop words, as in
   other languages);
2. an undecided block takes the label of the nearest decided blocks before
   and after it in its section. If they differ, the nearer one counts, and of
   two equally near ones the good one inside an article, the bad one outside.
   Without any, it is good.

A section is an ``article``, a ``main``, or what lies outside both; the lists
and tables of an article are a section of their own, so that a menu among its
paragraphs takes none of them along. Once a page has an article with text,
text outside articles isn't the article (but for a top heading of ``main``);
likewise for ``main``.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Frequent function words, by which running text is told from lists of names and labels.
STOP_WORDS = frozenset(
    # English
    "a an and are as at be been but by for from had has have he her his i in is it its my not of on or our she so that the "
    "their there they this to was we were what which who will with you your "
    # French
    "au aux avec ce cette ces dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas pour qu que qui sa se "
    "ses son sont sur un une vous "
    # German
    "aber als am auch auf aus bei das dem den der des die durch ein eine einen einer er es für hat ich im in ist mit nach nicht "
    "noch nur oder sein sich sie sind so über um und von vor war wie wir wird zu zum zur "
    # Spanish
    "al como con cuando del el ella era esta este fue ha hay lo los las más mi muy no nos o para pero por porque se ser si sin "
    "sobre son su sus también todo una uno y ya".split()
)
#: A block of at least this many characters is long enough to be judged by its words.
LONG_CHARS = 70
#: Share of stop words from which on a long block is good.
STOP_SHARE = 0.2
#: Share of characters in links up to which a block can be good, and above which it is a block of links.
LINKS_LOW, LINKS_HIGH = 0.3, 0.6

#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is text up to their end tag, none of it shown as text of the page.
RAW = frozenset("script style title textarea iframe noembed noframes noscript xmp".split())
#: Elements inside a line.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
#: Elements that never hold text of the article.
DROPPED = frozenset("aside audio button canvas datalist dialog footer head map menu nav object select svg template video".split())
#: Elements that end an open paragraph of their own kind.
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: Elements that bound the search for what ``CLOSES`` names.
SCOPES = frozenset("article aside blockquote body div dl footer form header html main nav ol section table td th ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words of a class, id or role that mark what isn't the article, wherever it stands.
MARKED = frozenset(
    "ad ads advert adverts advertisement advertising adsense breadcrumb breadcrumbs captcha comment comments commentlist consent "
    "cookie cookies copyright disclaimer disqus gdpr login menubar modal newsletter notice notices outbrain pager pagination paywall "
    "popup promo promos promoted promotion recommended register related replies respond search share sharing shares signup social "
    "sponsor sponsored sponsors subscribe subscription taboola toolbar".split()
)
#: Words that mark parts of the layout; an article inside is an article all the same.
LAYOUT = frozenset("banner complementary contentinfo footer header masthead menu nav navbar navigation sidebar sidebars widget widgets".split())

_ATTRS = r"""((?:[\s/]++|=?+[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+))?+)*+)"""
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)" + _ATTRS + ">")
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTR = re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']*)))?""")
_HINT = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_WORD = re.compile(r"[^\W\d_]+")
_RIGHTS = re.compile(r"©|\(c\)\s*\d{4}|copyright|all rights reserved", re.I)

_CLEAR, _LAYOUT, _MARKED = 0, 1, 2


@lru_cache(4096)
def _hints(attrs: str) -> tuple[int, bool, bool]:
    """(mark, article, link) of an element by its attributes."""
    mark, article, link = _CLEAR, False, False
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "")
        if name in ("class", "id", "role"):
            words = {w.lower() for w in _HINT.findall(value)}
            if words & MARKED:
                mark = _MARKED
            elif words & LAYOUT:
                mark = max(mark, _LAYOUT)
            article |= name == "role" and "article" in words
        elif name == "itemprop":
            article |= value.lower() == "articlebody"
            mark = _MARKED if value.lower() == "comment" else mark
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            mark = _MARKED
        elif name == "style" and "display:none" in value.replace(" ", "").lower():
            mark = _MARKED
        elif name == "href":
            link = True
    return mark, article, link


@dataclass(slots=True)
class Block:
    text: str
    tag: str
    links: float
    section: int
    kind: int  # of its section: 2 article, 1 main, 0 neither
    listed: bool  # in a list or a table

    @property
    def scope(self) -> tuple[int, bool]:
        """What it shares with the blocks that may lend it their label."""
        return self.section, self.kind == 2 and self.listed


@dataclass(slots=True)
class _Open:
    tag: str
    mark: int
    section: int
    kind: int
    listed: bool


class _Reader:
    """Reads one page into blocks."""

    def __init__(self) -> None:
        self.stack = [_Open("#page", _CLEAR, 0, 0, False)]
        self.counts: dict[str, int] = {}
        self.sections = 0
        self.blocks: list[Block] = []
        self.text: list[str] = []
        self.tag = "#page"
        self.linked = self.size = 0
        self.link_at = 0  # depth of the stack at which a link is open

    def read(self, page: str) -> list[Block]:
        i, n = 0, len(page)
        while i < n:
            j = page.find("<", i)
            if j < 0:
                self.add(page[i:])
                break
            if j > i:
                self.add(page[i:j])
            m = _TAG.match(page, j)
            if m:
                i = m.end()
                name = m[2].lower()
                if m[1]:
                    self.end(name)
                elif name in RAW:
                    i = self._after_raw(page, i, name)
                else:
                    self.start(name, m[3])
            elif page.startswith("<!--", j):
                k = page.find("-->", j + 2)
                i = n if k < 0 else k + 3
            elif page.startswith(("<!", "<?", "</"), j) or _NAME.match(page, j):
                k = page.find(">", j)
                i = n if k < 0 else k + 1
            else:
                self.add("<")
                i = j + 1
        self.flush()
        return self.blocks

    @staticmethod
    def _after_raw(page: str, i: int, name: str) -> int:
        end = re.compile(rf"</{name}[\s/>]", re.I).search(page, i)
        if not end:
            return len(page)
        k = page.find(">", end.start())
        return len(page) if k < 0 else k + 1

    def add(self, raw: str) -> None:
        if self.stack[-1].mark:
            return
        text = html.unescape(raw) if "&" in raw else raw
        self.text.append(text)
        n = len("".join(text.split()))
        self.size += n
        if self.link_at:
            self.linked += n

    def flush(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                top = self.stack[-1]
                share = self.linked / self.size if self.size else 0.0
                self.blocks.append(Block(text, self.tag, share, top.section, top.kind, top.listed))
            self.text = []
        self.linked = self.size = 0

    def _pop(self, depth: int) -> None:
        """Close all elements from ``depth`` on."""
        for e in self.stack[depth:]:
            self.counts[e.tag] -= 1
        del self.stack[depth:]
        if self.link_at > len(self.stack):
            self.link_at = 0

    def start(self, name: str, attrs: str) -> None:
        if name not in INLINE:
            self.flush()
            self.tag = name
            self._close_implied(name)
        elif name == "br":
            self.text.append(" ")
        if name in VOID:
            if name not in INLINE:
                self.tag = self.stack[-1].tag
            return
        up = self.stack[-1]
        mark, article, link = _hints(attrs) if attrs else (_CLEAR, False, False)
        if name in ("html", "body"):
            mark = _CLEAR
        elif name in DROPPED:
            mark = _MARKED
        elif name == "form" or name == "header" and not up.kind:
            mark = max(mark, _LAYOUT)
        elif name == "header":
            mark = _CLEAR if mark == _LAYOUT else mark
        kind = 2 if name == "article" or article else 1 if name == "main" else 0
        listed = up.listed or name in ("li", "table", "dl")
        section = up.section
        if mark < _MARKED and kind > up.kind or kind == 2 and name == "article":
            self.sections += 1
            section, listed = self.sections, False
            mark = max(mark, up.mark) if _MARKED in (mark, up.mark) else _CLEAR
        else:
            mark, kind = max(mark, up.mark), up.kind
        self.stack.append(_Open(name, mark, section, kind, listed))
        self.counts[name] = self.counts.get(name, 0) + 1
        if name == "a":
            self.link_at = len(self.stack) if link else 0

    def _close_implied(self, name: str) -> None:
        for tag in CLOSES.get(name, ("p",)):
            if self.counts.get(tag):
                for d in range(len(self.stack) - 1, 0, -1):
                    if self.stack[d].tag == tag:
                        self._pop(d)
                        break
                    if self.stack[d].tag in SCOPES:
                        break

    def end(self, name: str) -> None:
        inline = name in INLINE
        if not inline:
            self.flush()
        if name == "a":
            self.link_at = 0
        if not self.counts.get(name):
            return
        for d in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[d].tag
            if tag == name:
                self._pop(d)
                break
            if inline and tag not in INLINE:
                break  # it is closed with the block that holds it
        if not inline:
            self.tag = self.stack[-1].tag


def blocks_of(page: str | None) -> list[Block]:
    """The blocks of a page in order, without those of marked containers."""
    return _Reader().read(page) if page else []


def stop_share(text: str) -> float:
    """Share of listed stop words among the words of a text."""
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0


def first_pass(blocks: list[Block]) -> list[bool | None]:
    """Good (True), bad (False) or undecided (None) by each block's own features.

    Blocks of links are bad in lists and beside another block of links; a
    single one may be a paragraph. Short rights lines outside articles are bad.
    """
    links = [b.links > LINKS_HIGH for b in blocks]
    out: list[bool | None] = []
    for i, b in enumerate(blocks):
        beside = (i > 0 and links[i - 1]) or (i + 1 < len(blocks) and links[i + 1])
        if links[i] and beside and (b.listed or b.kind < 2):
            out.append(False)
        elif len(b.text) < LONG_CHARS or b.links > LINKS_LOW:
            out.append(False if b.kind < 2 and _RIGHTS.search(b.text) and b.tag not in HEADINGS else None)
        else:
            out.append(True if stop_share(b.text) >= STOP_SHARE else None)
    return out


def second_pass(blocks: list[Block], decided: list[bool | None]) -> list[bool]:
    """Undecided blocks take the label of their nearest decided neighbours in the section."""
    n = len(blocks)
    before: list[tuple[int, bool] | None] = [None] * n
    after: list[tuple[int, bool] | None] = [None] * n
    for out, indexes in ((before, range(n)), (after, range(n - 1, -1, -1))):
        last: dict[tuple[int, bool], tuple[int, bool]] = {}
        for i in indexes:
            out[i] = last.get(blocks[i].scope)
            if decided[i] is not None:
                last[blocks[i].scope] = (i, decided[i])
    labels = []
    for i, b in enumerate(blocks):
        x, y = before[i], after[i]
        if decided[i] is not None:
            labels.append(decided[i])
        elif x is None or y is None:
            labels.append((x or y or (i, True))[1])
        elif x[1] == y[1] or i - x[0] < y[0] - i:
            labels.append(x[1])
        elif i - x[0] > y[0] - i:
            labels.append(y[1])
        else:
            labels.append(b.kind == 2 or (b.tag in HEADINGS and y[1]))
    return labels


def main_text(page: str | None) -> str:
    """The article's blocks in page order, joined by an empty line."""
    blocks = blocks_of(page)
    best = max((b.kind for b in blocks), default=0)
    inside = [b for b in blocks if b.kind == best or (b.kind == 1 and b.tag == "h1")]
    labels = second_pass(inside, first_pass(inside))
    return "\n\n".join(b.text for b, good in zip(inside, labels) if good)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 64):  # a few pages at a time
            part = batch.slice(start, 64)
            texts = [main_text(raw.decode("utf-8", "replace") if raw else None) for raw in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["row", "text", "n_chars"],
            )


def extract_text(pages: DataFrame, carry: list[str], html_col: str = "html") -> DataFrame:
    """One row per page: ``row`` (a struct of the ``carry`` columns), ``text``, ``n_chars`` (code points).

    A null or empty page has an empty text. Pages are read whole; bytes that
    are no UTF-8 become replacement characters. Repeated rows are extracted
    each. Other columns are ignored, whatever their names. An empty table gives
    an empty result. A map-only pass: nothing is shuffled.
    """
    rows = pages.select(F.struct(*carry).alias("row"), F.col(html_col).cast("binary").alias("html"))
    schema = T.StructType([rows.schema["row"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return rows.mapInArrow(_extract, schema)
