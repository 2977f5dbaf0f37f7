"""Main-text extraction by consensus of a host's pages.

First pass: every page scores its containers (text of the blocks inside, less
link text, fading with nesting depth), goes from the best one out to the
ancestor that adds text (to a main, else an article, at most; to the body only if
that has text of its own) and names its path, tags
and classes from the root with digits generalised. Spark counts these votes per
host and path. Second pass: a page takes the elements on the host's winning
path of most votes that it has; a page without any takes its own best container.
Both passes run page by page in tasks; only (host, path, votes) are shuffled,
pre-aggregated, and joined back by host.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, slices

#: A path wins on a host with at least this share of the votes.
WINNING_SHARE = 0.2
DEPTH_FADE = 0.9

_DROPPED = "script style noscript template textarea select option button iframe object svg canvas math head title"
_RAW = "script|style|noscript|template|textarea|iframe|svg|title"
_BOILER_TAGS = frozenset("nav footer aside form dialog menu".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
                    "samp small span strike strong sub sup time tt u var".split())
_TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th tr caption figcaption ul ol dl table "
                         "tbody thead tfoot figure address hr details summary".split())
_DROP = frozenset(_DROPPED.split())
#: Words of a class or id that name boilerplate whatever stands beside them.
_ALWAYS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsbygoogle adsense adslot sponsor sponsored promo "
    "promoted comment comments commentlist commentform disqus reply replies respond cookie cookies gdpr newsletter".split())
#: Words that do so unless the name says it is about content (content-sidebar-wrap).
_MOSTLY = frozenset(
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs masthead topbar footer share sharing sharebar social related "
    "recommended subscribe signup popup toolbar pagination pager".split())
#: Words that do so only if all words of the name are listed here or say where it is (post-header is none).
_ALONE = frozenset("banner header consent notice notices modal overlay subscription login widget skip hidden alert".split())
_BOILER_WORDS = _ALWAYS | _MOSTLY | _ALONE
#: The name says what an element has, not what it is (has-sidebar, content-with-ads, comments-open).
_STATES = frozenset("has no not with without is open closed enabled disabled".split())
#: The name is of something else (related-work).
_ELSE = frozenset("work works research study studies literature history theory law laws art policy costs terms concepts".split())
_CONTENT = frozenset("content contents layout article body text".split())
#: Say where or how in a name of several words.
_PLACES = frozenset("site page main global top bottom left right primary secondary inner outer box bar block area wrap "
                    "wrapper container list item items links link form".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
_STOP = re.compile(r"[>\"']")
_ATTR = re.compile(r"([^\s=/>\"']+)\s*(?:=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]*)))?")
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in _RAW.split("|")}
#: Elements nested deeper lie flat in the last one, as in browsers; quoted values that a tag may hold.
_DEEPEST, _QUOTES = 512, 1000
_DIGITS = re.compile(r"\d+")
_WORD = re.compile(r"[a-z]+")
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}}


def _tag_end(source: str, at: int, trusted: int) -> tuple[int, int]:
    """(where the tag whose attributes begin at ``at`` has its ``>``, from where on quotes
    are trusted): the first outside quotes; if quotes don't match up, the first of
    all, for this tag and those that begin in what was read in vain; -1 without any."""
    first = source.find(">", at)
    if first < 0 or at < trusted:
        return first, trusted
    for _ in range(_QUOTES):
        m = _STOP.search(source, at)
        if not m:
            break
        if m[0] == ">":
            return m.start(), trusted
        close = source.find(m[0], m.end())
        if close < 0:
            return first, len(source)
        at = close + 1
    return first, at


def _tokens(source: str) -> Iterator[tuple[str, bool, str, str]]:
    """(text before, closing or not, tag or "", attributes); comments, declarations and
    raw elements have no tag. One pass: each character is looked at a bounded number of times."""
    at = begin = trusted = 0  # begin: of text not handed out yet
    while (lt := source.find("<", at)) >= 0:
        at = lt + 1
        if source.startswith("!--", at):
            end = source.find("-->", at + 3)
            yield source[begin:lt], False, "", ""
            at = begin = end + 3 if end >= 0 else len(source)
            continue
        closing = source.startswith("/", at)
        name = _NAME.match(source, at + closing)
        if not name:
            if closing or source.startswith(("!", "?"), at):
                end = source.find(">", at)
                if end < 0:
                    break
                yield source[begin:lt], False, "", ""
                at = begin = end + 1
            continue
        end, trusted = _tag_end(source, name.end(), trusted)
        if end < 0:
            break  # no tag ends any more: all text
        tag = name[0].lower()
        if tag in _RAW_END and not closing:
            close = _RAW_END[tag].search(source, end + 1)
            yield source[begin:lt], False, "", ""
            at = begin = close.end() if close else len(source)
            continue
        yield source[begin:lt], closing, tag, source[name.end():end]
        at = begin = end + 1
    yield source[begin:], False, "", ""


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in _ATTR.findall(text):
        out.setdefault(name.lower(), a or b or c)
    return out


class Page:
    """Containers and text blocks of one page, read in one pass."""

    def __init__(self, source: str):
        self.parent, self.tag, self.node = [-1], ["html"], [0]
        self.names: list[tuple[int, str]] = [(-1, "html")]  # path nodes: (parent node, name)
        self.nodes: dict[tuple[int, str], int] = {self.names[0]: 0}
        self.blocks: list[tuple[int, str, int]] = []  # container, text, characters in links
        self._read(source)

    def _read(self, source: str) -> None:
        # Open elements: (tag, container, boilerplate or not, link or not)
        stack = [("html", 0, False, False)]
        held: list[str] = []
        links = 0

        def flush() -> None:
            nonlocal links
            if held:
                text = " ".join("".join(held).split())
                if text:
                    self.blocks.append((stack[-1][1], text, links))
                held.clear()
            links = 0

        def say(raw: str) -> None:
            nonlocal links
            if raw and not stack[-1][2]:
                text = html.unescape(raw)
                held.append(text)
                if stack[-1][3]:
                    links += len(text)

        flat: Counter = Counter()  # open elements beyond the deepest
        opened: Counter = Counter()  # those on the stack

        def push(tag: str, *entry) -> None:
            opened[tag] += 1
            stack.append((tag, *entry))

        def close(depth: int) -> None:
            opened.subtract(x[0] for x in stack[depth:])
            del stack[depth:]

        for before, closing, tag, attrs in _tokens(source):
            say(before)
            if not tag:
                continue
            if tag in _VOID:
                if tag == "hr":
                    flush()
                elif tag in ("br", "wbr", "img") and not stack[-1][2]:
                    held.append(" " if tag == "br" else "")
                continue
            if flat[tag] and closing or len(stack) >= _DEEPEST and not closing:
                flat[tag] += -1 if closing else 1
                if tag not in _INLINE:
                    flush()
                continue
            if closing:
                depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0) if opened[tag] > 0 else 0
                if depth and not (tag in _INLINE and any(x[0] not in _INLINE for x in stack[depth + 1:])):
                    if tag not in _INLINE:
                        flush()
                    close(depth)
                elif tag == "p":
                    flush()
                continue
            if tag == "html" or tag == "body" and opened[tag] > 0:
                continue
            if tag in _INLINE:
                boiler = stack[-1][2] or (bool(attrs.strip()) and _is_boiler(tag, attrs, opened["article"] > 0 or opened["main"] > 0))
                push(tag, stack[-1][1], boiler, stack[-1][3] or tag == "a")
                continue
            flush()
            # A block ends an open paragraph and the inline elements left open in it.
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == "p" or stack[i][0] in _CLOSES.get(tag, ()):
                    close(i)
                    break
                if stack[i][0] not in _INLINE:
                    break
            if "table" not in (tag, stack[-1][0]) and tag not in ("td", "th"):
                while len(stack) > 1 and stack[-1][0] in _INLINE and stack[-1][0] != "a":
                    close(len(stack) - 1)
            boiler = stack[-1][2] or tag in _DROP or tag in _BOILER_TAGS or _is_boiler(tag, attrs, opened["article"] > 0 or opened["main"] > 0)
            box = stack[-1][1]
            if tag not in _TEXT_BLOCKS and not boiler:
                box = self._container(box, tag, attrs)
            push(tag, box, boiler, stack[-1][3])
        flush()

    def _container(self, parent: int, tag: str, attrs: str) -> int:
        classes = _attributes(attrs).get("class", "") if attrs else ""
        name = ".".join([tag, *sorted({_DIGITS.sub("#", c.lower()).replace("/", "|") for c in classes.split()})])
        key = self.node[parent], name
        if key not in self.nodes:
            self.nodes[key] = len(self.names)
            self.names.append(key)
        self.parent.append(parent)
        self.tag.append(tag)
        self.node.append(self.nodes[key])
        return len(self.parent) - 1

    def path(self, box: int) -> str:
        """Tags and classes from the root."""
        parts, node = [], self.node[box]
        while node >= 0:
            node, name = self.names[node]
            parts.append(name)
        return "/".join(reversed(parts))

    def on(self, path: str) -> set[int]:
        """Containers on a path."""
        node = -1
        for name in path.split("/"):
            node = self.nodes.get((node, name), -2)
        return {i for i, n in enumerate(self.node) if n == node}

    def _own(self) -> list[float]:
        own = [0.0] * len(self.parent)
        for box, text, links in self.blocks:
            own[box] += max(0.0, len(text) - 3.0 * links)
        return own

    def scores(self) -> list[float]:
        out = self._own()
        for i in range(len(out) - 1, 0, -1):  # children come after their parents
            out[self.parent[i]] += out[i] * DEPTH_FADE
        return [x * (1.5 if t in ("article", "main") else 1.0) for x, t in zip(out, self.tag)]

    def best(self) -> int:
        scores, own = self.scores(), self._own()
        best = at = max(range(len(scores)), key=lambda i: (scores[i], i))
        held = list(own)
        for i in range(len(held) - 1, 0, -1):
            held[self.parent[i]] += held[i]
        # Fading only finds where the text is: an ancestor with more of it has what stands beside,
        # up to the main around, without one up to the article.
        around, last = at, None
        while around >= 0:
            if self.tag[around] == "main" or self.tag[around] == "article" and last is None:
                last = around
            if self.tag[around] == "main":
                break
            around = self.parent[around]
        while at != last and self.parent[at] >= 0:
            at = self.parent[at]
            if held[at] > held[best] and (own[at] or self.tag[at] not in ("html", "body")):
                best = at
        return best

    def text(self, paths: list[str]) -> str:
        """Text on the first of the paths that the page has, else in its best container."""
        for chosen in filter(None, map(self.on, paths)):
            found = self._inside(chosen)
            if found:
                return "\n".join(found)
            break
        return "\n".join(self._inside({self.best()}))

    def _inside(self, chosen: set[int]) -> list[str]:
        inside = []
        for i, parent in enumerate(self.parent):
            inside.append(i in chosen or parent >= 0 and inside[parent])
        return [t for b, t, _ in self.blocks if inside[b]]


def _names_boiler(token: str, strict: bool) -> bool:
    """Whether a class or id token names boilerplate; ``strict``: all its words must."""
    words = set(_WORD.findall(token))
    if words & _STATES or not words & _BOILER_WORDS:
        return False
    if words <= _BOILER_WORDS | _PLACES:
        return True
    return not strict and not words & _ELSE and bool(words & _ALWAYS or words & _MOSTLY and not words & _CONTENT)


def _is_boiler(tag: str, attrs: str, within: bool) -> bool:
    """Whether an element is boilerplate; ``within``: it stands in an article or main."""
    if tag in ("html", "body"):
        return False
    if tag == "header":  # a page's header goes, an article's own heading stays
        if not within:
            return True
    if not attrs.strip():
        return False
    found = _attributes(attrs)
    if tag in ("article", "main"):
        return any("comment" in t and _names_boiler(t, True) for t in found.get("class", "").lower().split())
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or found.get("role", "").lower() in _ROLES:
        return True
    tokens = found.get("class", "").lower().split()
    if tag not in _HEADINGS:
        tokens += found.get("id", "").lower().split()
    return any(_names_boiler(t, False) for t in tokens)


def host_of(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, n): pages of the host whose best container lies on the path."""

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in slices(batches, "html"):
            named = []
            for source in pdf.html:
                page = Page(source)
                named.append(page.path(page.best()) if page.blocks else None)
            yield pd.DataFrame({"host": pdf.host, "path": named}).dropna()

    return (pages.select("host", "html").mapInPandas(vote, "host string, path string")
            .groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")))


def winners(pages: DataFrame) -> DataFrame:
    """(host, paths): at most 1/WINNING_SHARE winning paths, most votes first."""
    v = votes(pages)
    share = v.join(v.groupBy("host").agg(F.sum("n").alias("all")), "host").where(F.col("n") >= WINNING_SHARE * F.col("all"))
    best = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "path")))
    return share.groupBy("host").agg(best.alias("b")).select("host", F.col("b.path").alias("paths"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars (code points).

    Null html is empty and gives ""; a null or odd url belongs to the host "";
    repeated rows vote and are extracted each; pages of any length are read
    whole, in time and memory that grow with their length (elements nested more than
    512 deep lie flat in the last one); an empty table gives no rows; other columns are ignored.
    """
    p = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].alias("url"),
                     F.coalesce(pages[html_col], F.lit("")).alias("html"), host_of(pages[url_col]).alias("host"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in slices(batches, "html"):
            found = [Page(h).text([] if w is None else list(w)) for h, w in zip(pdf.html, pdf.paths)]
            yield pd.DataFrame({"page_id": pdf.page_id.astype("Int64"), "url": pdf.url, "text": found,
                                "n_chars": [len(t) for t in found]})

    # Written: the few winners' size is known, so pages are shuffled only if they are many.
    return (p.join(cut(winners(p), "html-winners"), "host", "left").select("page_id", "url", "html", "paths")
            .mapInPandas(read, "page_id long, url string, text string, n_chars long"))
