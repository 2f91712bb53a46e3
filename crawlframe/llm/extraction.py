"""Main text of web pages: the best-scoring contiguous run of words and tags.

A page is a sequence of words and tags. Words score positive, tags negative; the weights are log odds of
standing inside the main text, counted over the labelled pages: those of the table that mark their text
themselves, by exactly one ``article`` or ``main`` element (whose own tag is no feature). Kinds that the
labelled pages do not have keep a prior weight. One linear scan finds the contiguous region of the largest
sum. Blocks that the region touches are taken whole, with the paragraphs, headings and lists right before
and after it in the same element (a list's tags weigh more than its few words). If the region lies in an
element that marks content (``article``, ``main``, a class such as ``post-content``), all of it is taken.

Parts that are no main text by what they are (menus, page headers and footers, side bars, notices, adverts,
forms, reader comments, hidden parts: by element, role, class or id) cost a fixed amount each in the scan,
so that a region may run over an advert, and are left out of the text. Such a part that holds an ``article``
or ``main``, or the top heading with most of the words, is a wrapper and counts as nothing.

Character references are decoded, white space inside a block becomes one space, and blocks are joined by
two line feeds. Cells of a table row make one block, parted by spaces; ``br`` is white space.
"""

from __future__ import annotations

import html as html_module
import math
import re
from bisect import bisect_right
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlframe.llm.common import map_arrow

# Elements by their role in a page.
RAW = "script style textarea title xmp iframe noembed noframes noscript template".split()
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody"
    " tfoot thead title tr ul".split()
)
#: What the blocks next to the region may consist of to be taken with it.
FLOW = set("p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption ul ol li dl dt dd hr".split())
CELLS = set("br td th".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: An element ends when one of these begins inside it.
ENDED_BY = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option", "optgroup"}}
ENDS = {name: {k for k, by in ENDED_BY.items() if name in by} for name in set().union(*ENDED_BY.values())}
#: What an element is looked for in, when it is ended by another one.
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
NOISE_TAGS = set("nav aside footer form header dialog menu search select button svg math object canvas audio video head".split())
NOISE_ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
NOISE_WORDS = set(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adbox adslot banner sponsor sponsored sponsors promo promos promotion"
    " sidebar sidebars nav navbar navigation menu menus breadcrumb breadcrumbs footer masthead topbar toolbar cookie cookies consent gdpr notice"
    " notices alert popup modal overlay newsletter newsletters subscribe subscription signup login comment comments commentlist disqus respond reply"
    " replies related recommended recommendations share sharing social widget widgets pagination pager search copyright hidden".split()
)
NOISE_NAMES = set("header site-header page-header top-header global-header side-bar left-rail right-rail rail sign-up log-in skip-link skip-links read-more also-read".split())
NOT_WORDS = set("has no with without not non is".split())
CONTENT_NAMES = set(
    "article article-body article-content article-text articlebody content main main-content maincontent page-content post post-body post-content"
    " post-text entry entry-content entry-text story story-body story-content story-text body-text text-body body-content".split()
)

_RAW = "|".join(RAW)
# Repeats are possessive: no page makes the scan go back over what it has read.
_ATTRIBUTES = r"""(?:[\s/]++|=?+[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+)*+"""
TOKEN = re.compile(
    rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<(?:{_RAW})(?=[\s/>]){_ATTRIBUTES}[^>]*+(?:>|\Z)"
    rf"|<(/?+)([a-zA-Z][^\s/>]*+)({_ATTRIBUTES})[^>]*+(?:>|\Z)|<[!?][^>]*+(?:>|\Z)|</[^>]*+(?:>|\Z)|<\Z", re.S | re.I
)
RAW_NAME = re.compile(rf"<({_RAW})(?=[\s/>])", re.I)
RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+(?:>|\Z)", re.I) for name in RAW}
ATTRIBUTE = re.compile(r"""([^\s/>=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+""")
TELLING = re.compile(r"class|id|role|hidden|style|itemprop", re.I)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
COMMENTS = re.compile(r"\W*(?:\d+\s+)?(?:reader'?s?'?\s+|leser)?(?:comments?|kommentare?|commentaires?|comentarios?)\W*(?:\d+\W*)?\Z", re.I)

#: Weights of kinds before the labelled pages count for ``TRUST`` occurrences: words, linked words, tags.
WORD, LINKED, LIGHT, HEAVY = 1.0, 0.2, -0.1, -1.0
LIGHT_TAGS = BLOCKS & set("p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption".split()) | set("b i em strong u s small sub sup span br code q cite mark time abbr".split())
TRUST = 50
#: Bounds of a word's and of a tag's weight, and what a part that is left out costs.
WORD_RANGE, TAG_RANGE, PART = (0.1, 1.5), (-3.0, -0.05), -8.0
TAG_NAMES = BLOCKS | CELLS | VOID | NOISE_TAGS | set("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark picture q rp rt ruby s samp small span strike strong sub sup time tt u var".split())


def _attributes(said: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(said):
        value = m[2] or ""
        out.setdefault(m[1].lower(), html_module.unescape(value[1:-1] if value[:1] in "\"'" else value))
    return out


class Element:
    __slots__ = ("closed", "content", "end", "name", "noise", "parent", "start", "within")

    def __init__(self, name: str, start: int, parent: Element | None) -> None:
        self.name, self.start, self.end, self.parent, self.closed = name, start, -1, parent, False
        self.noise = self.content = False
        # Whether it stands in an element that marks content.
        self.within = parent is not None and (parent.within or parent.content and not parent.noise)


def _marks(element: Element, said: str) -> None:
    """What an element's name, role, class and id say about it."""
    name = element.name
    element.noise = name in NOISE_TAGS
    element.content = name in ("article", "main")
    if not TELLING.search(said):
        return
    attributes = _attributes(said)
    role = attributes.get("role", "").lower()
    if role in ("main", "article") or attributes.get("itemprop", "").lower() == "articlebody":
        element.content = True
    if name in ("html", "body", "main"):
        return
    if "hidden" in attributes or UNSEEN.search(attributes.get("style", "")) or role in NOISE_ROLES:
        element.noise = True
    for value in (attributes.get("class", ""), attributes.get("id", "")):
        for one in CAMEL.sub("-", value).lower().replace("_", "-").split():
            parts = re.split(r"[^a-z]+", one)
            if one in CONTENT_NAMES:
                element.content = True
            elif one in NOISE_NAMES or parts[0] not in NOT_WORDS and not NOISE_WORDS.isdisjoint(parts):
                element.noise = True


class Page:
    """Tokens of a page: a tag's name or a text, with what surrounds them."""

    def __init__(self, html: str) -> None:
        self.names: list[str | None] = []  # of tags; None for texts
        self.texts: list[str] = []
        self.blocks: list[int] = []
        self.linked: list[bool] = []
        self.elements: list[Element] = []
        self._read(html)
        self._leave_out()

    def _text(self, text: str, block: int, linked: bool) -> None:
        if text:
            self.names.append(None)
            self.texts.append(text)
            self.blocks.append(block)
            self.linked.append(linked)

    def _read(self, html: str) -> None:
        stack: list[Element] = []
        opened: Counter = Counter()
        at, block, links, size = 0, 0, 0, len(html)

        def close(depth: int, explicit: bool) -> None:
            nonlocal links
            while len(stack) > depth:
                element = stack.pop()
                opened[element.name] -= 1
                element.end, element.closed = len(self.names), explicit and len(stack) == depth
                links -= element.name == "a"

        while at < size:
            m = TOKEN.search(html, at)
            if m is None:
                break
            self._text(html[at : m.start()], block, links > 0)
            at = m.end()
            if m[2] is None:
                raw = RAW_NAME.match(m[0])
                if raw:
                    # Its content is no markup and no text of the page.
                    over = RAW_ENDS[raw[1].lower()].search(html, at)
                    at = over.end() if over else size
                continue
            name, ends = m[2].lower(), bool(m[1])
            if name in BLOCKS:
                block += 1
            if ends:
                # Looked for only where there is one, so that a long page of open tags takes linear time.
                for depth in range(len(stack) - 1, -1, -1) if opened[name] else ():
                    if stack[depth].name == name:
                        close(depth, True)
                        break
                    if name not in BLOCKS and stack[depth].name in BLOCKS:
                        break
            else:
                for depth in range(len(stack) - 1, -1, -1) if any(opened[k] for k in ENDS.get(name, ())) else ():
                    open_name = stack[depth].name
                    if name in ENDED_BY.get(open_name, ()):
                        close(depth, True)
                        break
                    if open_name in BLOCKS and (open_name not in ENDED_BY or open_name in SCOPES.get(name, ())):
                        break
                if name == "a" and links:
                    for depth in range(len(stack) - 1, -1, -1):
                        if stack[depth].name == "a":
                            close(depth, True)
                            break
            self.names.append(name)
            self.texts.append("")
            self.blocks.append(block)
            self.linked.append(links > 0)
            if not ends and name not in VOID:
                element = Element(name, len(self.names) - 1, stack[-1] if stack else None)
                _marks(element, m[3])
                self.elements.append(element)
                stack.append(element)
                opened[name] += 1
                links += name == "a"
        self._text(html[at:], block, links > 0)
        close(0, False)

    def _leave_out(self) -> None:
        """Find the parts that are left out."""
        n = len(self.names)
        self.words = [0 if name is not None else len(text.split()) for name, text in zip(self.names, self.texts, strict=True)]
        before = [0]
        for w in self.words:
            before.append(before[-1] + w)
        tops = [e.start for e in self.elements if e.name == "h1"]
        mains = [e.start for e in self.elements if e.name in ("article", "main") and not e.noise]

        def within(starts: list[int], start: int, end: int) -> bool:
            k = bisect_right(starts, start)
            return k < len(starts) and starts[k] < end

        self.out = bytearray(n)
        self.parts: list[int] = []
        for e in self.elements:
            if e.name in HEADINGS and e.name != "h1" and e.parent is not None and e.parent.name in ("div", "section", "ol", "ul"):
                said = "".join(self.texts[e.start : e.end]) if e.end - e.start < 20 else ""
                inside = within(tops, e.parent.start, e.parent.end) or within(mains, e.parent.start, e.parent.end)
                if len(said) < 80 and not inside and COMMENTS.match(html_module.unescape(said)):
                    e.parent.noise = True
        for e in self.elements:
            if not e.noise or self.out[e.start]:
                continue
            if e.name == "header" and e.within:
                continue
            end = e.end
            if not e.closed:
                end = min([end, *(starts[k] for starts in (mains, tops) if (k := bisect_right(starts, e.start)) < len(starts))])
            elif e.name not in ("nav", "footer", "aside", "head"):
                most = before[end] - before[e.start] > 0.5 * before[n] and within(tops, e.start, end)
                if most or within(mains, e.start, end):
                    continue
            if e.closed and end < n and self.names[end] == e.name:
                end += 1  # its end tag
            self.out[e.start : end] = b"\1" * (end - e.start)
            self.parts.append(e.start)

    def kind(self, k: int) -> str:
        if self.names[k] is None:
            return "linked word" if self.linked[k] else "word"
        name = self.names[k]
        if name in ("article", "main"):
            return "<div>"
        return f"<{name}>" if name in TAG_NAMES else "<other>"

    def labelled(self) -> Element | None:
        """The only element that marks the main text, if there is just one."""
        found = [e for e in self.elements if e.name in ("article", "main") and not self.out[e.start]]
        outer = [e for k, e in enumerate(found) if not k or e.start >= found[0].end]
        return outer[0] if len(outer) == 1 else None

    def region(self, weights: dict[str, float]) -> tuple[int, int] | None:
        """First and last token of the contiguous region of the largest sum; None if no word scores."""
        parts = set(self.parts)
        best, found, total, start = 0.0, None, 0.0, 0
        for k, out in enumerate(self.out):
            if out:
                if k not in parts:
                    continue
                score = PART
            else:
                kind = self.kind(k)
                score = weights.get(kind) if kind in weights else prior(kind)
                score *= self.words[k] if self.names[k] is None else 1
            if total <= 0:
                total, start = 0.0, k
            total += score
            if total > best:
                best, found = total, (start, k)
        return found

    def _flow(self, end: int, way: range) -> int:
        """The region's end after the paragraphs, headings and lists that follow it on the way, up to a block begun by a link."""
        for k in way:
            name = self.names[k]
            if self.out[k] or name in BLOCKS and name not in FLOW:
                break
            if name is None and self.words[k]:
                if self.linked[k] and self.blocks[k] != self.blocks[end]:
                    break
                end = k
        return end

    def text(self, weights: dict[str, float]) -> str:
        found = self.region(weights)
        if found is None:
            return ""
        first, last = found
        holding = [e for e in self.elements if e.content and not self.out[e.start] and e.start <= first and last <= e.end]
        if holding:
            inner = holding[-1]
            first, last = inner.start, inner.end - 1
        else:
            around = [e for e in self.elements if e.start <= first and last < e.end]
            low, high = (around[-1].start, around[-1].end) if around else (0, len(self.names))
            first, last = self._flow(first, range(first - 1, low - 1, -1)), self._flow(last, range(last + 1, high))
        taken = {self.blocks[k] for k in range(first, last + 1) if self.names[k] is None and self.words[k] and not self.out[k]}
        said: dict[int, list[str]] = {}
        for k, name in enumerate(self.names):
            if self.blocks[k] in taken and not self.out[k]:
                said.setdefault(self.blocks[k], []).append(html_module.unescape(self.texts[k]) if name is None else " " if name in CELLS else "")
        blocks = (" ".join("".join(parts).split()) for _, parts in sorted(said.items()))
        return "\n\n".join(b for b in blocks if b)


def prior(kind: str) -> float:
    if not kind.startswith("<"):
        return WORD if kind == "word" else LINKED
    return LIGHT if kind[1:-1] in LIGHT_TAGS else HEAVY


def weights_of(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Weights from how often each kind stands inside and outside the main text of labelled pages."""
    inside, outside = (sum(n for (_, where), n in counts.items() if where is side) for side in (True, False))
    out = {}
    for kind in {k for k, _ in counts}:
        a, b = counts.get((kind, True), 0), counts.get((kind, False), 0)
        odds = math.log((a + 1) / (inside + 2)) - math.log((b + 1) / (outside + 2))
        own = (TRUST * prior(kind) + (a + b) * odds) / (TRUST + a + b)
        low, high = TAG_RANGE if kind.startswith("<") else WORD_RANGE
        out[kind] = min(high, max(low, own))
    return out


def train(pages: DataFrame) -> dict[str, float]:
    """Weights from all labelled pages of ``pages`` (html).

    Counted in tasks; what reaches the driver is two numbers for each kind of word and tag, under 300. No
    labelled page: the prior weights.
    """

    def count(rows: dict) -> dict | None:
        seen: Counter = Counter()
        for text in rows["html"]:
            page = Page(text) if text else None
            own = page.labelled() if page else None
            if own is not None:
                for k in range(len(page.names)):
                    if not page.out[k]:
                        seen[page.kind(k), own.start < k < own.end] += 1 if page.names[k] is not None else page.words[k]
        return {"kind": [k for k, _ in seen], "inside": [i for _, i in seen], "n": list(seen.values())} if seen else None

    columns = {"kind": pa.string(), "inside": pa.bool_(), "n": pa.int64()}
    rows = map_arrow(pages.select("html"), count, "kind string, inside boolean, n long", columns)
    return weights_of({(r["kind"], r["inside"]): r["n"] for r in rows.groupBy("kind", "inside").agg(F.sum("n").alias("n")).collect()})


def main_text(html: str | None, weights: dict[str, float]) -> str:
    return Page(html).text(weights) if html else ""


def extract(pages: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``page_id, url, text, n_chars`` (code points), a row for each row of ``pages``.

    Null and empty pages, and pages without a word of main text, give an empty text. Repeated rows each
    count; an empty table gives no rows. Other columns are not read.
    """

    def read(rows: dict) -> dict:
        texts = [main_text(h, weights) for h in rows["html"]]
        return {"page_id": rows["page_id"], "url": rows["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    columns = {"page_id": pa.int64(), "url": pa.string(), "text": pa.string(), "n_chars": pa.int64()}
    return map_arrow(pages.select("page_id", "url", "html"), read, "page_id long, url string, text string, n_chars long", columns)
