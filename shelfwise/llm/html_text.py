"""Main text of web pages by composite text density.

The page is read into a small DOM (unclosed and stray tags as browsers take
them). Subtrees that never hold article text (menus, forms, scripts, adverts,
comments of readers, ...) are cut off; a class name, id, role or form doesn't cut
what holds the page's main element, largest article, heading or most of its
unlinked text. Each node's density is its characters
per tag, adjusted for link text: dividing by links raises nodes with few of
them. The subtree whose children have the largest sum of densities holds the
article. The smallest density on its path from the body is the threshold: the
siblings along that path that reach it belong to the article too, and link
lists inside that stay below it don't. Only whole lists and boxes of links are
such; a linked heading, paragraph, table cell or word in a sentence stays.

Defined results: NULL, empty and tag-only pages give the empty text; plain text
without tags is one block; repeated rows and NULL ids get their own rows; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html
import math
import re
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import clean_text, small_batches

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)", re.S)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea title iframe svg math object canvas audio video".split())
_CUT = frozenset("nav footer aside form menu button select dialog fieldset datalist head".split()) | _RAW
_BLOCK = frozenset(
    "address article blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul aside menu dialog".split())
_CLOSES_P = _BLOCK - frozenset("td th tr tbody thead tfoot body html".split())
#: An opening tag that ends an open one of these, up to the nearest of the limits.
_IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "option": ({"option"}, {"select"})}
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What may be a list of links, its items, and what belongs to the article even if all of it is linked.
_BOXES = frozenset("ul ol dl menu div section center details".split())
_ITEMS = frozenset("li dt dd".split())
_WHOLE = _HEADINGS | frozenset("td th caption blockquote pre figure figcaption address".split())
_ATTR = re.compile(r"""(?i)(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: Words of class, id and role that mark what surrounds an article.
_NOISE = frozenset(
    "ad ads advert adverts advertisement advertising adbox adsense banner sponsor sponsored promo promotion popup modal overlay cookie"
    " cookies consent gdpr notice notices alert disclaimer sidebar rail widget nav navbar navigation menu breadcrumb breadcrumbs pagination pager"
    " comment comments commentlist disqus respond replies share sharing social related recommended recommendations newsletter subscribe"
    " subscription signup login search toolbar footer masthead complementary contentinfo dialog skip tags toc".split())
#: First words of class names that tell of the page's state or subject ("has-sidebar", "tag-search"), not of the node.
_STATE = frozenset("has have no not with without is tag category cat topic format layout".split())
#: Readers' comments may be longer than the article.
_REPLIES = frozenset("comment comments commentlist disqus respond replies".split())
_HIDDEN = re.compile(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden")


def _marks(attrs: str) -> tuple[set[str], bool]:
    """The words of ``_NOISE`` that a class name, id or role begins or ends with; and whether the node is hidden."""
    words, hidden = set(), False
    for key, a, b, c in _ATTR.findall(attrs):
        key, value = key.lower(), (a or b or c)
        if key in ("class", "id", "role"):
            for name in value.split():
                parts = [x for x in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) if x]
                if parts and parts[0] not in _STATE:
                    words.update(_NOISE.intersection((parts[0], parts[-1])))
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and _HIDDEN.search(value):
            hidden = True
    return words, hidden


class _Page:
    """Nodes in page order: parent, tag, and the text pieces between tags."""

    def __init__(self, source: str):
        self.parent, self.tag, self.cut = [-1], ["body"], [False]
        self.pieces: list[tuple[int, str | None]] = []  # (node, text), or (node, None): a block boundary
        self.named: dict[int, set[str]] = {}  # nodes that their name or form marks, unless they hold the article
        replies = set()  # articles that are readers' comments and the like
        stack, at = [0], 0
        opened: dict[str, list[int]] = {"body": [0]}  # places in the stack, by tag
        endless: set[str] = set()  # tags that no end tag follows any more

        def close(n):
            while len(stack) > n:
                gone = self.tag[stack.pop()]
                opened[gone].pop()
                if gone in _BLOCK:
                    self.pieces.append((stack[-1], None))

        def nearest(names):
            return max((opened[x][-1] for x in names if opened.get(x)), default=0)

        def close_nearest(names, limits):
            place = nearest(names)
            if place and place >= nearest(limits):
                close(place)

        while at < len(source):
            m = _TOKEN.search(source, at)
            if m is None or m.start() > at:
                self.pieces.append((stack[-1], source[at:m.start() if m else len(source)]))
            if m is None:
                break
            at = m.end()
            name = m["name"] or m["name2"]
            if not name:
                continue
            name, attrs = name.lower(), m["attrs"] or m["attrs2"] or ""
            if m["end"] or m["end2"]:
                if name not in ("body", "html") and opened.get(name):
                    close_nearest({name}, ())
                continue
            if name in ("body", "html"):
                continue
            if name in _CLOSES_P and opened.get("p"):
                close_nearest({"p"}, {"table", "td", "th", "button"})
            if name in _IMPLIED:
                close_nearest(*_IMPLIED[name])
            if name in _BLOCK:
                self.pieces.append((stack[-1], None))
            if name in _VOID:
                if name in ("br", "wbr", "img"):
                    self.pieces.append((stack[-1], " " if name == "br" else ""))
                elif name == "hr":
                    self.pieces.append((stack[-1], None))
                continue
            node = len(self.tag)
            self.parent.append(stack[-1])
            self.tag.append(name)
            marks, hidden = _marks(attrs) if attrs and name not in ("a", "main") else (set(), False)
            if name == "article":
                if marks:
                    replies.add(node)
                marks, hidden = set(), False
            if marks or name in ("form", "fieldset"):
                self.named[node] = marks
            self.cut.append(self.cut[stack[-1]] or hidden or name in _CUT and name not in ("form", "fieldset"))
            if name in _RAW:  # their content isn't markup
                end = None if name in endless else re.compile(rf"(?i)</{re.escape(name)}(?=[\s/>])[^>]*+>?").search(source, at)
                if not end:
                    endless.add(name)
                if end or name not in ("svg", "math", "object", "noscript", "template"):
                    at = end.end() if end else len(source)
                continue
            if not attrs.rstrip().endswith("/") or name in _BLOCK or name == "a":
                opened.setdefault(name, []).append(len(stack))
                stack.append(node)
        self._cut_named(replies)
        self._headers()

    def _cut_named(self, replies: set[int]):
        """Cut what ``named`` marks, except where the article would go with it."""
        if not self.named:
            return
        n = len(self.tag)
        in_link, chars = [False] * n, [0] * n
        for i in range(1, n):
            in_link[i] = in_link[self.parent[i]] or self.tag[i] == "a"
        for node, text in self.pieces:
            if text and not self.cut[node] and not in_link[node]:
                chars[node] += len("".join(text.split()))
        last = list(range(n))  # the last node below
        for i in range(n - 1, 0, -1):
            chars[self.parent[i]] += chars[i]
            last[self.parent[i]] = max(last[self.parent[i]], last[i])
        live = [i for i in range(1, n) if not self.cut[i]]
        articles = [i for i in live if self.tag[i] == "article" and i not in replies and chars[i]]
        strong, titles = [False] * n, [False] * n
        if articles:
            strong[max(articles, key=lambda i: (chars[i], -i))] = True
        banner = [False] * n  # in a page header
        for i in range(1, n):
            banner[i] = self.tag[i] not in ("article", "main") and (banner[self.parent[i]] or self.tag[i] == "header")
        for i in live:
            strong[i] |= self.tag[i] == "main" and chars[i] > 0
            titles[i] = self.tag[i] == "h1" and not banner[i]
        strong_before, titles_before = [0, *accumulate(strong)], [0, *accumulate(titles)]
        above = [0] * n  # strong nodes that hold this one
        for i in range(1, n):
            above[i] = above[self.parent[i]] + strong[self.parent[i]]
        for i, marks in self.named.items():
            inside = strong_before[last[i] + 1] - strong_before[i]
            elsewhere = strong_before[n] - inside - above[i]
            title = titles_before[last[i] + 1] - titles_before[i]
            most = 2 * chars[i] > chars[0]
            if not _REPLIES.isdisjoint(marks):
                most = most and not (strong_before[n] or titles_before[n])
            self.cut[i] = self.cut[i] or not (inside or (title or most) and not elsewhere)
        for i in range(1, n):
            self.cut[i] = self.cut[i] or self.cut[self.parent[i]]

    def _headers(self):
        """A header keeps its headings if it stands inside an article, else it goes wholly."""
        inside = [False] * len(self.tag)
        head = [False] * len(self.tag)  # in a header, not in one of its headings
        for n in range(1, len(self.tag)):
            p, t = self.parent[n], self.tag[n]
            inside[n] = inside[p] or t in ("article", "main")
            head[n] = (head[p] or t == "header") and t not in _HEADINGS
            if t == "header" and not inside[n] or self.cut[p]:
                self.cut[n] = True
        self.head = head


def _link_lists(page: _Page, in_link: list[bool], chars: list[int], link: list[int], link_tags: list[int]) -> list[bool]:
    """Which nodes are lists or boxes of nothing but links, two at least: no heading, cell or sentence in them."""
    whole, loose = [False] * len(page.tag), [False] * len(page.tag)
    for node, text in page.pieces:
        if text and not in_link[node] and not loose[node]:
            loose[node] = any(map(str.isalnum, text))
    for i in range(len(page.tag) - 1, 0, -1):
        if not page.cut[i] and chars[i]:
            p, t = page.parent[i], page.tag[i]
            whole[i] |= t in _WHOLE
            loose[i] &= t not in _ITEMS or 2 * link[i] <= chars[i]  # a link and some words are an item of a link list too
            whole[p] |= whole[i]
            loose[p] |= loose[i]
    return [t in _BOXES and not w and not x and k > 1 and 2 * l > c
            for t, w, x, k, l, c in zip(page.tag, whole, loose, link_tags, link, chars)]


def _density(chars: int, tags: int, link_chars: int, link_tags: int, body_ratio: float) -> float:
    """Composite text density: characters per tag, times a logarithm that falls as links take over."""
    if not chars:
        return 0.0
    tags = max(tags, 1)
    value = chars / max(link_chars, 1) * tags / max(link_tags, 1)
    base = math.log(chars / max(chars - link_chars, 1) * link_chars + body_ratio * chars + math.e)
    return chars / tags * math.log(max(value, 1.0)) / max(math.log(base), 1.0)


def extract(source: str) -> str:
    """The article's blocks, joined by blank lines."""
    page = _Page(source)
    n = len(page.tag)
    chars, link, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = in_link[page.parent[i]] or page.tag[i] == "a"
    for node, text in page.pieces:
        if text and not page.cut[node] and not page.head[node]:
            size = len("".join(text.split()))
            chars[node] += size
            link[node] += size * in_link[node]
    for i in range(n - 1, 0, -1):
        if not page.cut[i]:
            p = page.parent[i]
            chars[p] += chars[i]
            link[p] += link[i]
            tags[p] += tags[i] + 1
            link_tags[p] += link_tags[i] + (page.tag[i] == "a")
    ratio = link[0] / max(chars[0], 1)
    density = [_density(chars[i], tags[i], link[i], link_tags[i], ratio) for i in range(n)]
    total = [0.0] * n
    for i in range(1, n):
        if not page.cut[i]:
            total[page.parent[i]] += density[i]
    best = max(range(n), key=lambda i: (total[i] * (not page.cut[i]), -i))
    path = [best]
    while path[-1]:
        path.append(page.parent[path[-1]])
    threshold = min(density[i] for i in path)
    for k, i in reversed(list(enumerate(path))):  # the outermost article or main on the path takes over
        if page.tag[i] in ("article", "main"):
            path = path[k:]
            break
    keep = [False] * n
    keep[path[0]] = True
    on_path, top, listed = set(path), path[0], _link_lists(page, in_link, chars, link, link_tags)
    marked_up = page.tag[top] in ("article", "main")
    for i in range(1, n):
        p = page.parent[i]
        if keep[p]:
            keep[i] = not (density[i] < threshold and listed[i])
        elif not marked_up and p in on_path and i not in on_path:
            keep[i] = density[i] >= threshold and 2 * link[i] <= chars[i] and chars[i] > 0
        elif marked_up and page.tag[i] == "article" and p in on_path:
            keep[i] = density[i] >= threshold  # a page in several articles
    blocks, current = [], []
    for node, text in [*page.pieces, (0, None)]:
        if text is None:
            block = " ".join("".join(current).split()) if current else ""
            if block:
                blocks.append(" ".join(html.unescape(block).split()) if "&" in block else block)
            current = []
        elif keep[node] and not page.cut[node] and not page.head[node]:
            current.append(text)
    return "\n\n".join(b for b in blocks if b)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    def run(batches):
        for b in small_batches(batches):
            out = [extract(s) for s in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"),
                        clean_text(pages[html_col]).alias("text")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
