"""Main text of a web page by scoring its element tree.

Every paragraph passes points, one plus its commas plus a point per hundred
characters, to its ancestors: all to the parent, half to the grandparent, then a
third of the remaining distance's inverse. Inside an element whose class or id only
names page furniture they count a fifth. A container's points are discounted by the
share of its characters that lie in links. The container with most is kept, with those
siblings that look like part of the same text and what stands between them. Elements
that are furniture by themselves (menus, footers, forms and the like) have no text;
those that are by class or id are left out of what is kept, unless it lies in them.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.frames import col

# Element groups of HTML, and words that name page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
# an opening tag ends an open one of these, unless an element of the last group lies between
ENDS = {
    "li": ("li", "ul ol menu"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "tbody": ("thead tbody tr td th", "table"),
    "option": ("option", "select"),
}
ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS.items()}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p pre blockquote li td th dd dt figcaption".split()) | HEADINGS
FURNITURE = frozenset("head nav footer aside form button select menu dialog object svg canvas audio video datalist".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices popup modal overlay menu menus nav navbar navigation breadcrumb breadcrumbs footer "
    "header masthead sidebar sidebars aside comment comments commentlist respond disqus replies share sharing social "
    "related newsletter subscribe subscription signup widget widgets toolbar pagination pager".split()
)
# words that say where or how, and leave a name of furniture one
PLACES = frozenset(
    "site page post article blog story entry global primary secondary main content body left right top bottom upper "
    "lower box block bar list item items wrapper wrap container area section inner outer panel slot unit zone link "
    "links button buttons icon icons group row col column module component form fixed sticky mobile desktop small "
    "large thread text card cards tags meta info".split()
)
NOT_FURNITURE = frozenset("html body main article".split())
NEGATING = frozenset("no has with without".split())
COMMAS = re.compile("[,،、，]")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
# a tag whose quotes are all closed values; other tags take the slow path
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"'=]|="[^"]*"|='[^']*'|=(?!["']))*+)>""")
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}
QUOTE_OR_END = re.compile("[>\"']")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
TOKEN = re.compile(r"[a-z]+|[A-Z][a-z]+|[A-Z]+|\d+")
SIBLING_SHARE = 0.2
SIBLING_CHARS = 80
SIBLING_LINKS = 0.25
LEVELS = 12  # ancestors a paragraph passes points to
SOFT = 0.2  # share of the points that counts inside furniture by name


class _Tree:
    """Elements in page order; the subtree of ``i`` is ``i`` to ``last[i]``."""

    def __init__(self) -> None:
        self.tag, self.parent, self.last, self.out, self.link = ["#"], [-1], [0], [False], [False]
        self.block = [0]  # the innermost element around that is no inline one
        self.soft = [-1]  # the innermost one around that is furniture by its name
        self.items: list[tuple[int, str]] = []  # element, text; an empty text is a break
        self.stack = [0]
        self.open: dict[str, int] = {}

    def push(self, tag: str, out: bool, soft: bool = False) -> None:
        up, i = self.stack[-1], len(self.tag)
        self.block.append(self.block[up] if tag in INLINE else i)
        self.soft.append(i if soft else self.soft[up])
        self.tag.append(tag)
        self.parent.append(up)
        self.last.append(len(self.tag) - 1)
        self.out.append(out or self.out[up])
        self.link.append(tag == "a" or self.link[up])
        self.stack.append(len(self.tag) - 1)
        self.open[tag] = self.open.get(tag, 0) + 1
        if tag not in INLINE:
            self.items.append((up, ""))

    def pop(self) -> None:
        i = self.stack.pop()
        self.open[self.tag[i]] -= 1
        self.last[i] = len(self.tag) - 1
        if self.tag[i] not in INLINE:
            self.items.append((self.parent[i], ""))

    def close(self, names: frozenset[str], stop: frozenset[str]) -> None:
        """End the innermost open element of ``names`` above an element of ``stop``."""
        if not any(self.open.get(n) for n in names):
            return
        for k in range(len(self.stack) - 1, 0, -1):
            tag = self.tag[self.stack[k]]
            if tag in names:
                while len(self.stack) > k:
                    self.pop()
                return
            if tag in stop:
                return


P, P_STOP = frozenset({"p"}), frozenset("button caption html marquee object table td th template".split())


def _named(name: str, tag: str) -> bool:
    """Whether a class or id names furniture: it holds a word for some, that is not
    negated, and otherwise only words for places."""
    words, some = [w.lower() for w in TOKEN.findall(name)], False
    for k, w in enumerate(words):
        if w in WORDS:
            if (k and words[k - 1] in NEGATING) or (tag in HEADINGS and w in ("header", "banner")):
                return False
            some = True
        elif w not in PLACES and not w.isdigit() and w not in NEGATING:
            return False
    return some


def _furniture(tag: str, attributes: str, inside: bool) -> tuple[bool, bool]:
    """Whether an element is furniture by itself, and whether by its name."""
    if tag in FURNITURE or (tag == "header" and not inside):
        return True, False
    if not attributes or tag in NOT_FURNITURE:
        return False, False
    soft = False
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m.group(1).lower(), (m.group(2) or "").strip("\"'")
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True, False
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, False
        if key == "role" and value.lower() in ROLES:
            return True, False
        if key in ("class", "id") and not soft:
            soft = any(_named(name, tag) for name in value.split())
    return False, soft


def _odd_tag(page: str, lt: int, unclosed: set[str]) -> tuple[bool, str, str, int] | int:
    """What stands at ``lt`` if it is no plain tag: a tag with stray quotes, or
    where to go on after a comment, a declaration or a lone bracket (minus one)."""
    size, at = len(page), lt + 1
    if page.startswith("!--", at):
        end = page.find("-->", at + 3)
        return size if end < 0 else end + 3
    closing = page.startswith("/", at)
    name = NAME.match(page, at + closing)
    if name is None:
        if not closing and page[at : at + 1] not in ("!", "?"):
            return -1
        end = page.find(">", at)
        return size if end < 0 else end + 1
    end = name.end()
    while True:
        m = QUOTE_OR_END.search(page, end)
        if m is None:
            end = size
            break
        if m.group() == ">":
            end = m.start()
            break
        end = m.end()
        if m.group() not in unclosed and page[name.end() : m.start()].rstrip()[-1:] == "=":
            shut = page.find(m.group(), end)
            if shut < 0:
                unclosed.add(m.group())
            else:
                end = shut + 1
    return closing, name.group(), page[name.end() : end], end + 1


def parse(page: str) -> _Tree:
    """The element tree of a page; broken markup is mended, never refused."""
    tree, at, size = _Tree(), 0, len(page)
    unclosed: set[str] = set()
    opened, stack = tree.open, tree.stack
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            lt = size
        if lt > at:
            _text(tree, page[at:lt])
        if lt >= size:
            break
        m = TAG.match(page, lt)
        if m is not None:
            closing, tag, attributes = m.groups()
            at = m.end()
        else:
            odd = _odd_tag(page, lt, unclosed)
            if isinstance(odd, int):
                if odd < 0:
                    _text(tree, "<")
                at = lt + 1 if odd < 0 else odd
                continue
            closing, tag, attributes, at = odd
        tag = tag.lower()
        if closing:
            if opened.get(tag):
                while tree.tag[stack[-1]] != tag:
                    tree.pop()
                tree.pop()
            continue
        if tag in VOID:
            if tag == "br" or tag == "hr":
                tree.items.append((stack[-1], ""))
            continue
        if tag in RAW:
            m = RAW_END[tag].search(page, at) if tag not in unclosed else None
            if m is None:
                unclosed.add(tag)
                at = size if tag not in ("noscript", "template") else at
            else:
                end = page.find(">", m.end())
                at = size if end < 0 else end + 1
            continue
        if tag in CLOSES_P and opened.get("p"):
            tree.close(P, P_STOP)
        if tag in ENDS:
            tree.close(*ENDS[tag])
        out, soft = tree.out[stack[-1]], False
        if not out and (attributes or tag in FURNITURE or tag == "header" or opened.get("header")):
            inside = bool(opened.get("article") or opened.get("main"))
            out, soft = _furniture(tag, attributes, inside)
            if not out and inside and opened.get("header"):
                # a heading of the article stays, the rest of its header goes
                out = tag not in HEADINGS and tag not in ("hgroup", "div") and tag not in INLINE
        tree.push(tag, out, soft)
    while len(stack) > 1:
        tree.pop()
    tree.last[0] = len(tree.tag) - 1
    return tree


def _text(tree: _Tree, text: str) -> None:
    i = tree.stack[-1]
    if tree.out[i]:
        return
    if tree.open.get("header"):
        # inside an article's header only headings count
        if not any(tree.open.get(h) for h in HEADINGS):
            return
    tree.items.append((i, entities.unescape(text) if "&" in text else text))


def score(tree: _Tree) -> tuple[list[float], list[int], list[int]]:
    """Points of every element after the discount for links, and how many characters
    it holds, in all and in links."""
    n = len(tree.tag)
    own, linked, commas = [0] * n, [0] * n, [0] * n
    for i, text in tree.items:
        size = len(text.strip()) if text else 0
        if size:
            block = tree.block[i]
            own[block] += size
            linked[block] += size if tree.link[i] else 0
            commas[block] += len(COMMAS.findall(text))
    points_of = [0.0] * n
    for i in range(n):
        if not own[i]:
            continue
        points = 1 + commas[i] + own[i] / 100
        if tree.soft[i] >= 0:
            points *= SOFT
        up = tree.parent[i] if tree.tag[i] in PARAGRAPHS and tree.parent[i] >= 0 else i
        for level in range(1, LEVELS + 1):
            if up < 0:
                break
            points_of[up] += points if level == 1 else points / 2 if level == 2 else points / (3 * (level - 1))
            up = tree.parent[up]
    chars, links = own, linked
    for i in range(n - 1, 0, -1):
        chars[tree.parent[i]] += chars[i]
        links[tree.parent[i]] += links[i]
    return [p * (1 - links[i] / chars[i]) if chars[i] else 0.0 for i, p in enumerate(points_of)], chars, links


def _siblings(tree: _Tree, best: int, peaks: list[float], chars: list[int], links: list[int]) -> list[int]:
    """The best container and the siblings kept with it, in page order.

    Kept are those with a share of its points, or that hold such, and longer paragraphs, all with few
    links, and first headings; then what stands between two kept ones, and the
    paragraphs and headings that follow or precede one directly.
    """
    around, i = [], tree.parent[best] + 1
    while i <= tree.last[tree.parent[best]]:
        # empty elements stand between nothing
        if not tree.out[i] and chars[i]:
            around.append(i)
        i = tree.last[i] + 1
    plain = [links[i] < SIBLING_LINKS * chars[i] and tree.soft[i] == tree.soft[best] for i in around]
    text = [ok and (tree.tag[i] in PARAGRAPHS or tree.tag[i] in INLINE) for ok, i in zip(plain, around)]
    kept = [
        i == best
        or (ok and peaks[i] >= max(1.0, SIBLING_SHARE * peaks[best]))
        or (par and (tree.tag[i] == "h1" or chars[i] >= SIBLING_CHARS))
        for i, ok, par in zip(around, plain, text)
    ]
    first, last = kept.index(True), len(kept) - 1 - kept[::-1].index(True)
    while first > 0 and text[first - 1]:
        first -= 1
    while last < len(kept) - 1 and text[last + 1]:
        last += 1
    return [i for k, i in enumerate(around) if kept[k] or (first <= k <= last and plain[k])]


def main_text(page: str | None) -> str:
    """The article of a page as one line; empty if there is none."""
    if not page:
        return ""
    tree = parse(page)
    points, chars, links = score(tree)
    if not chars[0]:
        return ""
    n = len(tree.tag)
    best = max(range(n), key=lambda i: (points[i], i))
    # an element that holds nothing else is the same container
    while (up := tree.parent[best]) >= 0 and chars[up] == chars[best] and tree.soft[up] == tree.soft[best]:
        best = up
    peaks = points[:]  # the most any element inside has
    for i in range(n - 1, 0, -1):
        peaks[tree.parent[i]] = max(peaks[tree.parent[i]], peaks[i])
    keep = _siblings(tree, best, peaks, chars, links) if tree.parent[best] >= 0 else [best]
    kept = [False] * n
    for i in keep:
        kept[i : tree.last[i] + 1] = [True] * (tree.last[i] + 1 - i)
    soft, around = tree.soft[best], tree.parent[best]
    words = [text if text and kept[i] and tree.soft[i] == soft else " " for i, text in tree.items]
    if len(keep) > 1:
        # text between kept siblings that is in no element of its own
        held = [k for k, (i, text) in enumerate(tree.items) if text and kept[i]]
        for k in range(held[0], held[-1]):
            i, text = tree.items[k]
            if text and not kept[i] and i == around:
                words[k] = text
    return " ".join("".join(words).split())


def _main_texts(pages: pa.Array) -> pa.Array:
    return pa.array([main_text(p.as_py()) for p in pages], pa.string())


def extract_main_text(df: DataFrame, html: str = "html", out: str = "main_text") -> DataFrame:
    """Add ``out``: the main text of each page.

    White space inside a block is one space, blocks are joined by one space in
    page order, character references are decoded. A null or empty page, or one
    without text, gives an empty string. Repeated rows stay, an empty table
    stays empty, a column already called ``out`` is replaced. One pass over the
    table, no shuffle; time and memory follow the length of a page.
    """
    text = F.arrow_udf(_main_texts, T.StringType())
    return df.withColumn(out, text(col(html)))
