"""Main text of web pages by composite text density.

A page becomes a small tree of elements. For every element the characters and
tags below it, and those inside links, give its composite text density: the
characters per tag, lowered where much of the text is links. An element's
density sum is the sum over its children. The element with the largest sum
leads; the smallest density on its way up to ``body`` is the threshold, and
each element at or above it gives its descendant (or itself) with the largest
sum to the content. The leading element widens to the article or main around it
or, without one, to the widest run of headings and unlinked neighbours, and is
kept whole. Elements that markup names as something else than the
article (menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles, reader comments) are taken out before densities are computed.

Text comes in page order: character references decoded, white space inside a
block turned into one space, blocks joined by one newline.

Defined cases: null and empty html give an empty text; html without any tag is
one block; unclosed, stray and overlapping tags are read as browsers roughly
do; repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panel_edit.llm.common import ship

OUT = "page_id bigint, url string, text string, n_chars bigint"

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody tfoot thead title tr ul".split())
#: Elements that close an open element of the named kinds, up to the limits.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
#: Elements that never hold article text.
DROPPED = frozenset(
    "annotation annotation-xml aside audio button canvas datalist dialog embed footer form frame frameset head header iframe input menu nav "
    "noembed noframes noscript object script select style svg template textarea title video xmp".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form toolbar tablist".split())
#: Words of a class or id that name something else than the article.
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion banner banners "
    "sidebar sidebars aside nav navbar navigation menu menus breadcrumb breadcrumbs footer header masthead topbar "
    "comment comments disqus reply replies respond cookie cookies consent gdpr notice notices notification alert popup "
    "modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
    "recommendations widget widgets toolbar pagination pager skip tracking".split())
#: Words that name reader comments wherever they stand in a token, unless the element holds the article.
COMMENT_WORDS = frozenset("comment comments disqus".split())
#: What :class:`Page` remembers of an element that is dropped for being a form, or for a comment word among others.
_FORM, _COMMENTS = "(form)", "(comments)"
#: On ``article`` and ``main`` only these count.
DROPPED_ARTICLES = frozenset("comment comments reply replies ad ads advert sponsored promo related".split())
#: These are something else however much text they hold.
NEVER_SPARED = DROPPED_ARTICLES | frozenset("adv adverts advertisement advertising disqus cookie cookies consent gdpr".split())
#: Words that may stand beside the dropped ones in a class: ``site-footer`` is a footer, ``layout-sidebar`` may hold anything.
NEUTRAL_WORDS = frozenset(
    "area bar block body bottom box button buttons card cell center column container desktop fixed floating form global group holder "
    "inner item items left link links list main mobile module outer panel placeholder post posts primary right row secondary "
    "section site slot sticky strip thread title top unit view wrap wrapper zone".split())
#: A class with one of these says something about the element, not what it is.
MODIFIERS = frozenset("has no not non with without is".split())

HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Share of the leading element's density from which a neighbour is of its kind, and the characters of one without any link.
LIKE, PLAIN = 0.2, 40

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"  # a comment
    r"|<[!?][^>]*(?:>|\Z)"  # doctype, CDATA, instruction
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(?:>|\Z)",
    re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def named(tokens: str, vocabulary: frozenset[str]) -> set[str]:
    """Words of the vocabulary that whole class tokens consist of, neutral words aside."""
    out: set[str] = set()
    for token in tokens.split():
        parts = {w.lower() for w in _NAME.findall(token)}
        if not parts & MODIFIERS and parts <= vocabulary | NEUTRAL_WORDS:
            out |= parts & vocabulary
    return out


class Page:
    """The elements of a page: parents come before children; text lies in runs of (element, block, text)."""

    def __init__(self, source: str):
        self.tag, self.parent, self.dropped = ["#root"], [-1], [False]
        self.runs: list[tuple[int, int, str]] = []
        self._by_words: dict[int, set[str]] = {}  # dropped by class or id alone
        self._read(source)
        self._spare()

    def _read(self, source: str) -> None:
        stack, open_, block, at, n = [0], {}, 0, 0, len(source)

        def text(a: int, b: int) -> None:
            if a < b:
                self.runs.append((stack[-1], block, source[a:b]))

        def pop() -> None:
            open_[self.tag[stack.pop()]] -= 1

        while at < n:
            m = _TOKEN.search(source, at)
            if not m:
                break
            text(at, m.start())
            at = m.end()
            name = m[2]
            if name is None:
                continue
            name = name.lower()
            if name in BLOCK:
                block += 1
            if m[1]:
                if open_.get(name) and name not in VOID:
                    if name not in BLOCK:  # an inline end tag doesn't close blocks
                        k = len(stack) - 1
                        while self.tag[stack[k]] != name and self.tag[stack[k]] not in BLOCK:
                            k -= 1
                        if self.tag[stack[k]] != name:
                            continue
                    while self.tag[stack[-1]] != name:
                        pop()
                    pop()
                continue
            if name in BLOCK and open_.get("p"):
                self._close(stack, open_, ("p",), ("td", "th", "li", "button", "table"))
            if name in CLOSES:
                self._close(stack, open_, *CLOSES[name])
            node = len(self.tag)
            self.tag.append(name)
            self.parent.append(stack[-1])
            self.dropped.append(self._is_dropped(node, name, m[3]))
            if name in ("br", "td", "th"):
                self.runs.append((stack[-1], block, " "))
            if name in VOID:
                continue
            if name in RAW:
                end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                at = end.end() if end else n
                continue
            stack.append(node)
            open_[name] = open_.get(name, 0) + 1
        text(at, n)

    def _close(self, stack: list[int], open_: dict[str, int], kinds: tuple, limits: tuple) -> None:
        if not any(open_.get(k) for k in kinds):
            return
        k = len(stack) - 1
        while k > 0 and self.tag[stack[k]] not in kinds:
            if self.tag[stack[k]] in limits:
                return
            k -= 1
        while k > 0 and len(stack) > k:
            open_[self.tag[stack.pop()]] -= 1

    def _is_dropped(self, node: int, name: str, attributes: str) -> bool:
        if name == "header" and self._in_article(node):
            pass  # the article's own, with its title
        elif name == "form":  # a form round a whole page is spared
            self._by_words[node] = {_FORM}
        elif name in DROPPED:
            return True
        if not attributes or name in ("html", "body"):
            return name == "form"
        a = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)}
        if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(a.get("style", "")):
            return True
        if a.get("role", "").lower() in DROPPED_ROLES:
            return True
        tokens = a.get("class", "") + " " + a.get("id", "")
        if name in ("article", "main"):
            return bool(named(tokens, DROPPED_ARTICLES))
        words = named(tokens, DROPPED_WORDS)
        if not words and any(parts & COMMENT_WORDS and not parts & MODIFIERS for parts in ({w.lower() for w in _NAME.findall(t)} for t in tokens.split())):
            words = {_COMMENTS}
        if words:
            self._by_words[node] = self._by_words.get(node, set()) | words
        return node in self._by_words

    def _in_article(self, node: int) -> bool:
        while node > 0:
            node = self.parent[node]
            if self.tag[node] == "article":
                return True
        return False

    def _spare(self) -> None:
        """An element dropped by its class alone stays if it holds an article, or most of the unlinked text.

        That is most of the text of the article or main around it, or of a page
        that has neither. Where nothing would be left, all such elements stay.
        Comments, adverts and consent notices never do; a form does, and what has a
        comment word among others in its class unless it lies in an article.
        """
        if not self._by_words:
            return
        for node, tag in enumerate(self.tag):
            if tag in ("article", "main") and not self.dropped[node]:
                up = self.parent[node]
                while up > 0:
                    if not self._by_words.get(up, DROPPED_ARTICLES) & DROPPED_ARTICLES:
                        self.dropped[up] = False
                    up = self.parent[up]
        n = len(self.tag)
        sparable = [i for i, words in self._by_words.items() if self.dropped[i] and not words & NEVER_SPARED]
        if not sparable:
            return
        gone, in_link, scope = [False] * n, [False] * n, [0] * n  # gone: whatever is spared
        for i in range(1, n):
            p = self.parent[i]
            gone[i] = gone[p] or (self.dropped[i] and (i not in self._by_words or bool(self._by_words[i] & NEVER_SPARED)))
            in_link[i] = in_link[p] or self.tag[i] == "a"
            scope[i] = i if self.tag[i] in ("article", "main") else scope[p]
        chars, articles = [0] * n, 0
        for node, _, text in self.runs:
            if not gone[node] and not in_link[node]:
                chars[node] += len(text.strip())
                articles += len(text.strip()) if scope[node] else 0
        for i in range(n - 1, 0, -1):
            chars[self.parent[i]] += chars[i]
        for i in sparable:
            if _COMMENTS in self._by_words[i] and scope[i]:
                continue  # however many there are
            if (scope[i] or not articles) and 2 * chars[i] > chars[scope[i]]:
                self.dropped[i] = False
        out = [False] * n
        for i in range(1, n):
            out[i] = out[self.parent[i]] or self.dropped[i]
        if not any(text.strip() and not out[node] for node, _, text in self.runs):
            for i in sparable:
                self.dropped[i] = False

    def inherit(self) -> None:
        for node in range(1, len(self.tag)):
            self.dropped[node] = self.dropped[node] or self.dropped[self.parent[node]]


def densities(page: Page) -> tuple[list[float], list[float], list[int], list[int]]:
    """(composite density, density sum, characters, characters in links) of every element that isn't dropped."""
    n = len(page.tag)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = in_link[page.parent[i]] or page.tag[i] == "a"
    for node, _, text in page.runs:
        if not page.dropped[node]:
            k = len(text.strip())
            chars[node] += k
            if in_link[node]:
                link_chars[node] += k
    for i in range(n - 1, 0, -1):
        if page.dropped[i]:
            continue
        p = page.parent[i]
        chars[p] += chars[i]
        link_chars[p] += link_chars[i]
        tags[p] += tags[i] + 1
        link_tags[p] += link_tags[i] + (page.tag[i] == "a")
    body = next((i for i in range(n) if page.tag[i] == "body"), 0)
    ratio = link_chars[body] / max(chars[body], 1)
    density, sums = [0.0] * n, [0.0] * n
    for i in range(n):
        if page.dropped[i] or not chars[i]:
            continue
        c, t = chars[i], max(tags[i], 1)
        spread = c / max(link_chars[i], 1) * t / max(link_tags[i], 1)
        links = c / max(c - link_chars[i], 1) * link_chars[i] + ratio * c
        density[i] = c / t * math.log(1 + spread) / math.log(math.e + links)
        if i and page.tag[i] in BLOCK:  # formatting inside a block makes no density of its own
            sums[page.parent[i]] += density[i]
    return density, sums, chars, link_chars


def widened(page: Page, top: int, density: list[float], chars: list[int], link_chars: list[int]) -> list[int]:
    """The elements around ``top`` that are kept whole with it.

    The nearest article or main; without one, the widest run of neighbours that
    begins and ends with a heading or with little linked text of like density (or
    text without any link), short blocks between them included and linked ones
    not; and the parent once all its elements are kept.
    """
    up = top
    while up > 0:
        if page.tag[up] in ("article", "main"):
            return [up]
        up = page.parent[up]
    children: dict[int, list[int]] = {}
    for i in range(1, len(page.tag)):
        if not page.dropped[i] and chars[i]:
            children.setdefault(page.parent[i], []).append(i)

    def unlinked(i: int) -> bool:
        return 2 * link_chars[i] <= chars[i]

    def alike(i: int) -> bool:
        return unlinked(i) and (page.tag[i] in HEADINGS or density[i] >= LIKE * density[top] or not link_chars[i] and chars[i] >= PLAIN)

    found = [top]
    while top > 0 and page.tag[top] != "body":
        row = children.get(page.parent[top], [])
        same = [k for k, i in enumerate(row) if i == top or alike(i)]
        kept = [i for i in row[same[0]:same[-1] + 1] if i == top or unlinked(i)] if same else []
        found += kept
        if len(kept) < len(row):
            break
        top = page.parent[top]
        found.append(top)
    return found


def content(page: Page) -> list[bool]:
    """Whether an element lies in the content."""
    n = len(page.tag)
    density, sums, chars, link_chars = densities(page)
    top = max(range(n), key=lambda i: (sums[i], -i))
    threshold, up = density[top], top
    while up > 0 and page.tag[up] != "body":
        up = page.parent[up]
        if up > 0:
            threshold = min(threshold, density[up])
    best = list(range(n))  # the element with the largest sum in each subtree
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        if not page.dropped[i] and sums[best[i]] > sums[best[p]]:
            best[p] = best[i]
    marked = [False] * n
    for i in range(n):
        if density[i] > 0 and density[i] >= threshold:
            marked[best[i]] = True
    for i in widened(page, top, density, chars, link_chars):
        marked[i] = True
    for i in range(1, n):
        marked[i] = marked[i] or marked[page.parent[i]]
    return marked


def main_text(source: str | None) -> str:
    """The article of one page, blocks joined by newlines."""
    page = Page(source or "")
    page.inherit()
    marked = content(page)
    blocks: list[str] = []
    last, parts = None, []
    for node, block, text in [*page.runs, (0, None, "")]:
        if block != last:
            line = " ".join(html.unescape("".join(parts)).split())
            if line:
                blocks.append(line)
            last, parts = block, []
        if not page.dropped[node] and marked[node]:
            parts.append(text)
    return "\n".join(blocks)


def _rows(batches):
    for batch in batches:
        texts = [main_text(h) for h in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars (code points)."""
    ship(pages.sparkSession)
    slim = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return slim.mapInArrow(_rows, OUT)
