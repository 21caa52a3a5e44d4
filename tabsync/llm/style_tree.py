"""Main text of web pages by a site style tree.

Pages of a host are merged into one tree: an element is known by the tags and classes on the way to it. Over
all pages of the host, an element's presentation importance is the entropy of its sequences of children, and its content
importance falls with the share of pages on which the same text stands in it (an entropy too: text that is on all m pages
has importance 0, text of one page 1). Both are weighed together, and branches of low importance are taken out of every
page. Where there is an article (or main) element, only what stands inside counts, and there elements go one by one by their own importance:
the article itself stays, its headings stay, and so does all of it where nothing else would be left of it. An element of low importance loses
only texts of low importance of their own, so what one page alone says there stays. What is noise by its nature (scripts, forms,
menus, headers, and elements that call themselves adverts, notices, sidebars or comments) goes. A name says so if it is made of such words and words
of place, shape or size only (``cookie-bar``, ``ad-300x250``, not ``has-sidebar`` or ``social-policy``), and it does not speak against the text: where no
text of an article is left, or no text at all, the wrapper around most of it is none.

A page is read once from left to right, in time in proportion to its length: a tag ends at the first ``>`` outside quotes; one that has
more than ``QUOTES`` quoted parts, or never ends so, at the first ``>`` at all; where none follows, the rest is text.

Exact copies of a page on a host count once. Statistics are counted by element and text hash before anything meets by host; what goes back to the pages is one
list of hashes per host: its elements of low importance, and their texts that go. Pages without host form no tree. A null page gives an empty text, every
row gives one row (repeated ones too), an empty table an empty one. A column of the caller named as the new text gives way to it; no other name matters.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from html import unescape
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsync.llm.common import slices, small_batches
from tabsync.storage import materialise

#: Share of content in the importance of an element, the importance below which it goes, and the pages needed to tell.
CONTENT, LOW, PAGES = 0.9, 0.3, 3
#: Most quoted parts of a tag.
QUOTES = 32
_START = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|(!--)|[!?])")
_STOP = re.compile(r"[>\"']")
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg".split())
NOISE = RAW | frozenset("head header nav aside footer form button select dialog menu".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
#: An open element of these that a start tag of the key closes.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
NOISY_NAMES = frozenset("""ad ads adv advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr
masthead menu modal nav navbar navigation newsletter notice notices popup promo related respond share sharing sidebar social sponsor sponsored subscribe
widget widgets""".split())
#: Words that may stand beside them in a name.
BESIDE = frozenset("""above area areas bar bars block blocks body bottom box boxes btn btns button buttons col column container desktop entry footer floating form group header
holder icon icons inline inner item items left link links list lists message mobile module outer overlay panel post posts primary reader readers right row secondary section
sections site slot slots sticky strip thread top unit user users visitor visitors wrap wrapper""".split())
HOLDS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def _parts(name: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9]+", name.lower()) if w and not re.fullmatch(r"\d+(?:x\d+)?", w)]


def noisy(names: list[str]) -> bool:
    """Whether one of the names (class, id or role, each whole) says that an element is noise."""
    return any(NOISY_NAMES & set(own) and set(own) <= NOISY_NAMES | BESIDE for own in map(_parts, names))


class _Scanner:
    """Tags of a page from a place on. Places asked for never go back, so every character is looked for a bounded number of times."""

    def __init__(self, html: str):
        self.html, self.last, self.found = html, html.rfind(">"), {}

    def _after(self, what: str, at: int) -> int:
        """First place of a character from ``at`` on; the answer is kept until it lies behind."""
        start, place = self.found.get(what, (0, -1))
        if not start <= at <= place:
            place = self.html.find(what, at)
            place = len(self.html) if place < 0 else place
            self.found[what] = at, place
        return place

    def _end(self, at: int) -> int:
        first = self._after(">", at)
        for _ in range(QUOTES):
            double, single = self._after('"', at), self._after("'", at)
            close = self._after(">", at)
            quote = min(double, single)
            if close < quote:
                return close + 1
            if quote == len(self.html):
                break
            at = self._after('"' if quote == double else "'", quote + 1) + 1
        return first + 1

    def next(self, at: int) -> tuple[int, int, str, str | None, str] | None:
        """Start, end, slash, name (None: comment or declaration) and attributes of the next tag."""
        found = _START.search(self.html, at)
        if not found:
            return None
        if found[3]:
            end = self.html.find("-->", found.end())
            return found.start(), end + 3 if end >= 0 else len(self.html), "", None, ""
        if found.start() > self.last:  # nothing ends any more, but for a comment, which may stay open
            start = self.html.find("<!--", found.start())
            return (start, len(self.html), "", None, "") if start >= 0 else None
        if not found[2]:
            return found.start(), self._after(">", found.end()) + 1, "", None, ""
        end = self._end(found.end())
        return found.start(), end, found[1], found[2].lower(), self.html[found.end():end - 1]


class Text(NamedTuple):
    node: int  # element of its block
    text: str
    noise: bool
    block: int
    mark: int  # innermost element around it that is noise by name, or -1


class Tree(NamedTuple):
    """Elements of a page in order. ``key`` is a hash of the names on the way to an element, ``outer`` its outermost article or -1."""

    key: list[int]
    parent: list[int]
    outer: list[int]
    heading: list[bool]  # a heading right in the article or in parts of it without a name
    children: list[list[str]]


def _signed(text: str, seed: int = 0) -> int:
    return xxhash.xxh3_64_intdigest(text.encode(), seed) - (1 << 63)


def _chained(text: str, key: int) -> int:
    return _signed(text, key & ((1 << 64) - 1))


def walk(html: str) -> tuple[list[Text], Tree]:
    """Texts of a page in order and its elements."""
    tree = Tree([0], [-1], [-1], [False], [[]])
    # Open elements: tag, node, noise, mark, place in the stack of the nearest block from here up, whether a bare part of an article.
    stack: list[tuple] = [("", 0, False, -1, 0, False)]
    texts, marks, block, opened = [], [], 0, {}
    scanner, at, size = _Scanner(html), 0, len(html)

    def shut(n: int) -> None:
        while len(stack) > n:
            opened[stack.pop()[0]] -= 1

    def say(text: str) -> None:
        if text:
            top = stack[-1]
            texts.append(Text(stack[top[4]][1] if top[4] else top[1], unescape(text), top[2], block, top[3]))

    while at < size:
        tag_at = scanner.next(at)
        if tag_at is None:
            break
        start, end, slash, tag, given = tag_at
        say(html[at:start])
        at = end
        if tag is None:
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in BLOCKS:
            block += 1
        if slash:
            if opened.get(tag):
                shut(next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag))
            continue
        if tag in BLOCKS and tag not in ("html", "body"):
            inner = stack[-1][4]
            if inner and stack[inner][0] == "p":
                shut(inner)
        if tag in CLOSES and any(map(opened.get, CLOSES[tag])):
            inner = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] in CLOSES[tag] | {"ul", "ol", "dl", "table"}), 0)
            if inner and stack[inner][0] in CLOSES[tag]:
                shut(inner)
        names_given = [x for v in _NAMED.findall(given) for x in v.strip("\"'").split()]
        names = sorted({w for v in names_given for w in _parts(v)})
        up_tag, up, noise, mark, near, bare = stack[-1]
        tree.children[up].append(tag)
        if tag in VOID or given.rstrip().endswith("/") and tag not in BLOCKS:
            continue
        node, outer = len(tree.key), tree.outer[up]
        tree.key.append(_chained(".".join([tag, *names]), tree.key[up]))
        tree.parent.append(up)
        tree.children.append([])
        tree.outer.append(outer if outer >= 0 else node if tag in HOLDS else -1)
        in_article = tree.outer[node] == node or bare and tag in ("section", "div") and not names_given
        tree.heading.append(bare and tag in HEADINGS)
        if NOISY_NAMES.intersection(names) and tag not in ("html", "body", "article", "main") and noisy(names_given):
            marks.append((mark, node))
            mark = len(marks) - 1
        stack.append((tag, node, noise or tag in NOISE, mark, len(stack) if tag in BLOCKS else near, in_article))
        opened[tag] = opened.get(tag, 0) + 1
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = close.start() if close else size
    say(html[at:])
    return _by_name(texts, marks, tree), tree


def _by_name(texts: list[Text], marks: list[tuple[int, int]], tree: Tree) -> list[Text]:
    """Texts inside elements that are noise by name become noise, but for wrappers around all that matters: the largest of these are cleared.

    ``marks``: (mark around it or -1, element). While every text that matters stands in an outermost mark, the key of those that hold most is
    cleared, and the marks right below take their place; so each mark is looked at once.
    """
    if not marks:
        return texts
    own = [x for x in texts if not x.noise and not x.text.isspace()]
    own = [x for x in own if tree.outer[x.node] >= 0] or own
    cleared: set[int] = set()
    if own and all(x.mark >= 0 for x in own):
        at_node, direct = {node: m for m, (_, node) in enumerate(marks)}, {x.mark for x in own}
        total, alone, below = [0] * len(marks), [0] * len(marks), [[] for _ in marks]
        for x in own:
            total[x.mark] += len(x.text)
            if x.node in at_node:  # an element with nothing but its own words wraps nothing
                alone[at_node[x.node]] += len(x.text)
        for m in range(len(marks) - 1, -1, -1):
            around = marks[m][0]
            if around >= 0:
                total[around] += total[m]
                below[around].append(m)
        held: dict[int, int] = {}
        waiting: dict[int, list[int]] = {}
        order: list[tuple[int, int, int]] = []
        free, new = False, [m for m, (around, _) in enumerate(marks) if around < 0]
        while not free:
            while new:
                m = new.pop()
                key = tree.key[marks[m][1]]
                if key in cleared:
                    free = free or m in direct
                    new += below[m]
                elif total[m]:
                    waiting.setdefault(key, []).append(m)
                    held[key] = held.get(key, 0) + total[m] - alone[m]
                    heapq.heappush(order, (-held[key], marks[m][1], key))
            while order and (order[0][2] in cleared or -order[0][0] != held[order[0][2]]):
                heapq.heappop(order)
            if free or not order or not order[0][0]:
                break
            key = heapq.heappop(order)[2]
            cleared.add(key)
            new = waiting.pop(key)
    noisy_mark: list[bool] = []
    for around, node in marks:
        noisy_mark.append(around >= 0 and noisy_mark[around] or tree.key[node] not in cleared)
    return [x._replace(noise=x.noise or x.mark >= 0 and noisy_mark[x.mark]) for x in texts]


def blocks(texts: list[Text]) -> Iterator[tuple[int, str, bool]]:
    """Whole blocks (element, text, noise), white space turned into single spaces; empty ones dropped."""
    at = 0
    while at < len(texts):
        first, end = texts[at], at + 1
        while end < len(texts) and texts[end].block == first.block and texts[end].noise == first.noise:
            end += 1
        text = " ".join("".join(x.text for x in texts[at:end]).split())
        if text:
            yield first.node, text, first.noise
        at = end


def main_text(html: str, low: set[int]) -> str:
    """Text of a page without noise and without what the tree of its host finds unimportant (hashes of elements, and of texts in them)."""
    texts, tree = walk(html)
    found = [(node, text) for node, text, noise in blocks(texts) if not noise]
    inside = [(node, text) for node, text in found if tree.outer[node] >= 0]
    dull = lambda node, text: tree.key[node] in low and _chained(text, tree.key[node]) in low
    if inside:
        found = [(n, t) for n, t in inside if n == tree.outer[n] or tree.heading[n] or not dull(n, t)] or inside
    elif low:
        below: list[bool] = []
        for parent in tree.parent:
            below.append(parent >= 0 and (below[parent] or tree.key[parent] in low))
        found = [(n, t) for n, t in found if not below[n] and not dull(n, t)]
    return "\n\n".join(t for _, t in found)


def _features(html: str) -> list[tuple[int, str, int]]:
    """(element, kind, hash): that the page has the element, its sequence of children, the texts in it; each once a page."""
    texts, tree = walk(html)
    out = {(k, "page", 0) for k in tree.key[1:]} | {(k, "style", _signed(" ".join(c))) for k, c in zip(tree.key[1:], tree.children[1:], strict=True)}
    return sorted(out | {(tree.key[n], "text", _chained(t, tree.key[n])) for n, t, _ in blocks(texts)})


HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def features(pages: DataFrame) -> DataFrame:
    """``host, element, kind, h, n``: on how many different pages of the host something is found; ``pages``: host, html."""
    out = T.StructType.fromDDL("host string, page bigint, found array<struct<element: bigint, kind: string, h: bigint>>")

    def run(batches):
        for batch in batches:
            for part in slices(batch, 2):
                each = [_features(html) for html in part.column(2).to_pylist()]
                flat = [f for fs in each for f in fs]
                found = pa.StructArray.from_arrays([pa.array([f[i] for f in flat], k) for i, k in enumerate((pa.int64(), pa.string(), pa.int64()))],
                                                   names=["element", "kind", "h"])
                ends = pa.array(list(accumulate(map(len, each), initial=0)), pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.ListArray.from_arrays(ends, found)], names=out.names)
    known = pages.where("host IS NOT NULL AND html IS NOT NULL").select("host", F.xxhash64("html").alias("page"), "html")
    once = known.mapInArrow(run, out).groupBy("host", "page").agg(F.first("found").alias("found"))
    return once.select("host", F.explode("found").alias("f")).groupBy("host", "f.element", "f.kind", "f.h").agg(F.count(F.lit(1)).cast("double").alias("n"))


def importance(counted: DataFrame) -> DataFrame:
    """``host, element, pages, importance`` of every element of the trees, of :func:`features`."""
    of = lambda kind, value: F.sum(F.when(F.col("kind") == kind, value))
    n = F.col("n")
    sums = counted.groupBy("host", "element").agg(of("page", n).alias("pages"), *[f for k in ("style", "text") for f in (
        of(k, n).alias(f"{k}_n"), of(k, n * F.log(n)).alias(f"{k}_nlogn"))])
    many = F.log("pages")
    # Entropies to the base of the number of pages: sum of p log p for styles; for texts, the mean of log(pages that have it).
    style = (F.log("style_n") - F.col("style_nlogn") / F.col("style_n")) / many
    content = 1 - F.col("text_nlogn") / F.col("text_n") / many
    both = F.when(F.col("pages") <= 1, 1.0).otherwise((1 - CONTENT) * style + CONTENT * F.coalesce(content, F.lit(1.0)))
    return sums.select("host", "element", "pages", both.alias("importance"))


def unimportant(pages: DataFrame) -> DataFrame:
    """``host, low``: hashes of the elements of low importance and of the texts in them that stand on too many pages; ``pages``: host, html."""
    counted = materialise(features(pages), "style-counts")
    low = materialise(importance(counted).where((F.col("pages") >= PAGES) & (F.col("importance") < LOW)), "style-low")
    texts = (counted.where("kind = 'text'").join(low, ["host", "element"]).where(1 - F.log("n") / F.log("pages") < LOW)
             .select("host", F.col("h").alias("hash")))
    return low.select("host", F.col("element").alias("hash")).unionByName(texts).groupBy("host").agg(F.collect_list("hash").alias("low"))


def extract(df: DataFrame, url_col: str = "url", html_col: str = "html", out: str = "text") -> DataFrame:
    """``df`` with the main text of every page in place of its html."""
    small_batches(df.sparkSession)
    host = F.lower(F.nullif(F.regexp_extract(url_col, HOST, 1), F.lit("")))
    fields = [f for f in df.schema.fields if f.name not in (html_col, out)]
    keyed = df.select(F.struct(*[F.col(f"`{f.name}`") for f in fields], F.lit(0).alias("_")).alias("row"), F.col(f"`{html_col}`").alias("html"), host.alias("host"))
    joined = keyed.join(materialise(unimportant(keyed.select("host", "html")), "style-trees"), "host", "left").select("row", "html", "low")

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1):
                texts = [main_text(h, set(b or ())) if h else "" for h, b in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays(part.column(0).flatten()[:-1] + [pa.array(texts, pa.string())], names=[f.name for f in fields] + [out])
    return joined.mapInArrow(run, T.StructType([*fields, T.StructField(out, T.StringType())]))
