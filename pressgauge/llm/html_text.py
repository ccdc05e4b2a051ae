"""Main text of web pages by tag-path ratios.

A page is read into blocks of text, each at the path of block elements from the root (names with
classes). Per path the text and punctuation of all its blocks are added up and divided by their number;
both ratios are smoothed over the blocks in page order by a Gaussian, fused by multiplication, averaged per path
again, and paths at or above ``LAMBDA`` standard deviations are content. Elements that are menus, footers, forms
and the like by their tag or role are left out before that, and so are those that a class or id names as
menu, header, sidebar, notice, advert or comments; but a name never takes the page's prose away: if no article is
found, and one such element, comments apart, holds ``RESCUE`` times as much prose as all that is kept, its name does
not count. The result is what stands in the articles, or else in the parents, that hold content paths, whichever the parent or article with
the largest sum of ratios is: headings and short lines stay, whatever their ratio, and so do lists, tables and quotes inside.

Every page is handled whole in the task that reads it. Edge cases: null or empty html, and pages
without content, give an empty text; unclosed elements end with their parents or the page; repeated
rows are extracted one by one; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from pressgauge.llm.common import byte_slices

LAMBDA = 0.8
RESCUE = 4
KERNEL = np.exp(-0.5 * np.arange(-2, 3) ** 2)
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？،؛؟]")
RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILER_TAGS = frozenset("nav footer aside form head button select dialog menu svg canvas object audio video map fieldset".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
BOILER_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner cookie cookies consent gdpr "
    "notice notices notification alert sidebar menu menus nav navbar navigation breadcrumb breadcrumbs header masthead topbar footer foot "
    "comment comments commentlist disqus reply replies respond response responses share sharing social related recommended recommendations newsletter "
    "subscribe subscription popup modal overlay login signup toolbar pagination pager widget widgets form search".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies respond response responses".split())
ADVERT_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo".split())
STATE_WORDS = frozenset("has with no not without is show open".split())
CLOSES = {
    "p": frozenset(["p"]), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]), "optgroup": frozenset(["option", "optgroup"]),
    "thead": frozenset(["tr", "td", "th"]), "tbody": frozenset(["thead", "tbody", "tr", "td", "th"]), "tfoot": frozenset(["tbody", "tr", "td", "th"]),
    "body": frozenset(["head"]),
}
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
SCOPES = frozenset("html body table td th caption article aside section main div nav header footer form ul ol dl blockquote figure button".split())
TOKENS = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S
)
ATTRIBUTES = re.compile(r"""(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|\Z)""", re.I)


class Page:
    """Blocks of a page and the elements that hold them.

    ``boiler`` says whether an element, or one around it, is boilerplate by tag or role; ``named`` is the
    nearest one that a class or id names as such, itself included, and ``names`` are its words.
    """

    def __init__(self) -> None:
        self.parent, self.tag, self.path, self.boiler = [-1], [""], [0], [False]
        self.article, self.named, self.names = [-1], [0], {}
        self.paths: dict[tuple[int, str], int] = {}
        self.blocks: list[tuple[int, str]] = []

    def add(self, parent: int, tag: str, label: str, boiler: bool, words: frozenset) -> int:
        at = len(self.tag)
        self.parent.append(parent)
        self.tag.append(tag)
        self.path.append(self.paths.setdefault((self.path[parent], label), len(self.paths) + 1))
        self.boiler.append(boiler or self.boiler[parent])
        # The outermost article around the element.
        self.article.append(self.article[parent] if self.article[parent] > 0 or tag not in ARTICLE else at)
        self.named.append(at if words else self.named[parent])
        if words:
            self.names[at] = words
        return at

    def charges(self, element: int) -> Iterator[int]:
        """The elements named as boilerplate around ``element``, from inside out."""
        at = self.named[element]
        while at > 0:
            yield at
            at = self.named[self.parent[at]]


ARTICLE = frozenset(["article", "main"])
NESTED = frozenset("ul ol li dl dt dd table caption thead tbody tfoot tr td th blockquote figure figcaption pre details summary".split())
NO_WORDS: frozenset = frozenset()
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6", "hgroup"])


def _is_boiler(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Boilerplate by tag, role or state."""
    if tag in BOILER_TAGS or "hidden" in attributes or attributes.get("aria-hidden") == "true" or attributes.get("role") in BOILER_ROLES:
        return True
    return tag == "header" and not in_article


def _boiler_words(tag: str, attributes: dict[str, str], in_article: bool) -> frozenset:
    """The first or last words of class and id names that tell of boilerplate."""
    if tag in ("html", "body", "main", "header"):
        return NO_WORDS
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
        words = [w for w in re.split(r"[^a-z]+", name) if w]
        if words and words[0] not in STATE_WORDS and (words[-1] in BOILER_WORDS or words[0] in BOILER_WORDS):
            if tag in HEADINGS or (in_article and words[-1] == "header"):
                return NO_WORDS
            return frozenset((words[0], words[-1])) & BOILER_WORDS
    return NO_WORDS


def _attributes(rest: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for key, a, b, c in ATTRIBUTES.findall(rest):
        found.setdefault(key.lower(), a or b or c)
    return found


def parse(source: str) -> Page:
    """Read a page leniently: optional end tags are implied, stray ones ignored."""
    page = Page()
    stack, parts, at = [0], [], 0
    advert: list | None = None  # an inline advert: its name, how many such are open, and where its text begins

    def flush() -> None:
        nonlocal advert
        advert = None
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                page.blocks.append((stack[-1], text))
            parts.clear()

    def close(names: frozenset) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            tag = page.tag[stack[depth]]
            if tag in names:
                del stack[depth:]
                return
            if tag in SCOPES:
                return

    position = 0
    while (found := TOKENS.search(source, position)) is not None:
        if found.start() > at:
            text = source[at: found.start()]
            parts.append(html.unescape(text) if "&" in text else text)
        at = position = found.end()
        if not found["name"]:
            continue
        name = found["name"].lower()
        if found["end"]:
            if name == "br":
                parts.append(" ")
            elif advert and name == advert[0]:
                advert[1] -= 1
                if not advert[1]:
                    del parts[advert[2]:]
                    advert = None
            elif name not in INLINE and name not in RAW:
                flush()
                for depth in range(len(stack) - 1, 0, -1):
                    if page.tag[stack[depth]] == name:
                        del stack[depth:]
                        break
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, position)
            at = position = end.end() if end else len(source)
            if name not in ("title",):
                parts.append(" " if parts else "")
            continue
        if name in INLINE:
            if advert and name == advert[0]:
                advert[1] += 1
            elif not advert and name not in VOID and "d" in found["rest"].lower() and _boiler_words(name, _attributes(found["rest"]), True) & ADVERT_WORDS:
                advert = [name, 1, len(parts)]
            continue
        if name == "br":
            parts.append(" ")
            continue
        flush()
        if name in VOID:
            continue
        if name in ENDS_PARAGRAPH:
            close(CLOSES["p"])
        for _ in range(3 if name in CLOSES and name != "p" else 0):
            close(CLOSES[name])
        rest = found["rest"]
        attributes = _attributes(rest) if rest else {}
        in_article = page.article[stack[-1]] > 0
        label = name + "".join("." + c for c in sorted(attributes.get("class", "").split()))
        words = _boiler_words(name, attributes, in_article) if attributes else NO_WORDS
        stack.append(page.add(stack[-1], name, label, _is_boiler(name, attributes, in_article), words))
        if rest.endswith("/") and name in ("svg", "path", "g", "use"):
            stack.pop()
    if at < len(source):
        text = source[at:]
        parts.append(html.unescape(text) if "&" in text else text)
    flush()
    return page


def content_paths(page: Page, blocks: list[int]) -> dict[int, float]:
    """The fused ratio of each content path among the given blocks."""
    path = np.array([page.path[page.blocks[i][0]] for i in blocks])
    size = np.array([len(page.blocks[i][1]) for i in blocks], float)
    marks = np.array([len(PUNCTUATION.findall(page.blocks[i][1])) for i in blocks], float)
    which, back, count = np.unique(path, return_inverse=True, return_counts=True)
    text = (np.bincount(back, size) / count)[back]
    points = (np.bincount(back, marks) / count)[back]

    def smooth(x: np.ndarray) -> np.ndarray:
        weight = np.convolve(np.ones(len(x) + 4), KERNEL, "same")[2:-2]
        return np.convolve(np.pad(x, 2, "edge"), KERNEL, "same")[2:-2] / weight

    fused = smooth(text) * (1 + smooth(points))
    ratio = np.bincount(back, fused) / count
    threshold = min(LAMBDA * fused.std(), ratio.max())
    return {int(p): float(r) for p, r in zip(which, ratio) if r >= threshold}


def _prose(text: str) -> int:
    """The length of a block that reads like sentences."""
    return len(text) if len(text) >= 60 and len(PUNCTUATION.findall(text)) >= 2 else 0


def main_text(source: str) -> str:
    """The article of one page: its blocks, joined by an empty line."""
    page = parse(source)
    open_blocks = [i for i, (element, _) in enumerate(page.blocks) if not page.boiler[element]]
    pardoned: set[int] = set()
    while True:
        found = _chosen(page, [i for i in open_blocks if all(n in pardoned for n in page.charges(page.blocks[i][0]))])
        if any(page.article[page.blocks[i][0]] > 0 for i in found):
            return "\n\n".join(page.blocks[i][1] for i in found)
        held: dict[int, int] = {}
        for i in open_blocks:
            element, text = page.blocks[i]
            charges = [n for n in page.charges(element) if n not in pardoned]
            if charges and not any(page.names[n] & COMMENT_WORDS for n in charges):
                held[charges[-1]] = held.get(charges[-1], 0) + _prose(text)
        most = max(held, key=held.__getitem__, default=0)
        if not most or held[most] <= RESCUE * sum(_prose(page.blocks[i][1]) for i in found):
            return "\n\n".join(page.blocks[i][1] for i in found)
        pardoned.add(most)


def _chosen(page: Page, blocks: list[int]) -> list[int]:
    """The blocks that hold the article, among the given ones."""
    if not blocks:
        return []
    content = content_paths(page, blocks)
    weight: dict[int, float] = {}
    holders = []
    for i in blocks:
        element, _ = page.blocks[i]
        holder = page.article[element]
        if holder < 0:
            holder = page.parent[element] if page.tag[element] not in ("div", "section", "td", "body") else element
        holders.append(holder)
        if page.path[element] in content:
            weight[holder] = weight.get(holder, 0) + content[page.path[element]]
    in_article = page.tag[max(weight, key=weight.__getitem__)] in ARTICLE
    kept = {h for h in weight if (page.tag[h] in ARTICLE) == in_article}

    def holds(holder: int) -> bool:
        while holder not in kept and page.tag[holder] in NESTED:
            holder = page.parent[holder]
        return holder in kept

    return [i for i, holder in zip(blocks, holders) if holds(holder)]


def extract(pages: DataFrame, html_col: str = "html", name: str = "text") -> DataFrame:
    """The other columns and ``name``, the main text of ``html_col``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sources in byte_slices(batches, html_col):
            found = [main_text(s.decode("utf-8", "replace")) for s in sources]
            kept = [c for c in part.schema.names if c != html_col]
            yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in kept), pa.array(found, pa.string())], [*kept, name])

    frame = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c.lower() != name.lower() or c == html_col])
    others = [f for f in frame.schema.fields if f.name != html_col]
    return frame.mapInArrow(run, T.StructType([*others, T.StructField(name, T.StringType())]))
