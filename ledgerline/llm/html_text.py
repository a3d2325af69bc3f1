"""Main text of web pages (operator 9): two-pass block rules.

The page is read into text blocks.  Blocks in elements that never hold main text (menus, page
headers and footers, sidebars, notices, adverts, forms, comments; by element, role, or a whole class
or id) are out, unless they turn out to hold the article or most of the text.  First pass: length, link density and stop-word density make every other block good,
bad, short or nearly good.  Second pass: short and nearly good blocks take the label of the
nearest decided blocks on either side.  The page's marked article is a prior: what density does
not find good in it is nearly good unless it is a list of links, and the article's ends count as good
neighbours (headings, short paragraphs and prose without stop words belong to it).  A list of links is
items, or two or more blocks in a row, that are nothing but links; a sentence with a long link or a
linked table cell is text.  Outside the article the good blocks stand, and undecided ones need good ones on
both sides.

Defined cases.  A null or empty html, and a page without a good block, give an empty text.  Markup
that ends within a tag, a comment or a script loses that rest only.  Very long pages are read whole.
Repeated rows, null ids and null urls pass through; an empty table gives no rows; extra columns are
not looked at.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .kernel import slices
from .tables import table

SHORT_CHARS = 70
LONG_CHARS = 200
MAX_LINKS = 0.2
#: Share of a block's characters in links from which on it is nothing but links.
ALL_LINKS = 0.99
LOW_STOPS = 0.30
HIGH_STOPS = 0.32

# Frequent function words of the corpus languages.
STOP_WORDS = frozenset(
    """a about all also an and any are as at be been but by can could did do for from had has have he her his how i if
    in into is it its more my no not of on one only or our out she so some than that the their them then there these
    they this to up was we were what when which who will with would you your
    au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas plus
    pour qu que qui sa se ses son sont sur un une vous
    als am auch auf aus bei bin bis das dass dem den der des die ein eine einem einen einer er es für hat ich im ist
    kann mit nach nicht noch nur oder sein sich sie sind so über um und uns von vor war wenn wie wird wir zu zum zur
    al como con del el ella ellos era esta este esto lo los las más muy no para pero por porque ser si sin sobre su sus
    también todo una uno y ya""".split()
)
# Elements by their part in a page.
_RAW = ("script", "style", "noscript", "template", "textarea", "title", "svg", "math", "iframe", "object", "xmp")
_OUT = frozenset("nav footer aside form header menu dialog button select fieldset figcaption head map label".split())
_MAIN = frozenset(("article", "main"))
_BLOCKS = frozenset(
    """address article aside blockquote body center dd details dialog dir div dl dt fieldset figure figcaption footer form
    h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td
    tfoot th thead tr ul caption""".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
# Elements of these kinds may also wrap a page or its article by mistake of a name: see _released.
_ALWAYS_OUT = frozenset("nav footer menu dialog button select head map".split())
#: Names that say little about what else an element holds, and names of what is never main text.
_LAYOUT_NAMES = r"banner|sidebar|navbar|nav|navigation|menu|breadcrumbs?|footer|masthead|popup|modal|overlay|share|sharing|social|widgets?|toolbar"
_FOREIGN_NAMES = (
    r"ads?|advert\w*|sponsor\w*|promo\w*|cookies?|consent|notice|comments?|disqus|respond|replies|related|recommended|"
    r"newsletter|subscribe|signup|login|pagination|pager|skip-link|copyright"
)
# What may stand beside a name in one class or id; any other part (has-, no-, -content) makes it another name.
_BESIDE_NAMES = (
    r"site|page|post|posts|entry|article|global|main|primary|secondary|top|bottom|left|right|list|box|block|slot|unit|links?|"
    r"buttons?|bar|area|section|wrap|wrapper|container|inner|items?|icons|form|thread|\d+(?:x\d+)?"
)
_OUT_NAME = re.compile(
    rf"(?:(?:{_BESIDE_NAMES})[_-]+)*(?:(?P<foreign>{_FOREIGN_NAMES})|{_LAYOUT_NAMES})"
    rf"(?:[_-]+(?:{_LAYOUT_NAMES}|{_FOREIGN_NAMES}|{_BESIDE_NAMES}))*",
    re.I,
)
_ATTRIBUTES = r"""(?:[^'">=/]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?|"[^"]*+"|'[^']*+'|/(?!>))*+"""
_RAW_END = r"(?:.*?(?:</(?P=raw)\s*+>|\Z))"
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    # A raw element ends with its end tag, or with its own tag if that closes itself.
    rf"|<(?P<raw>{'|'.join(_RAW)})(?=[\s/>])(?:{_ATTRIBUTES}(?:/>|>{_RAW_END})|[^>]*+(?:>{_RAW_END}|\Z))"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*+)(?P<rest>(?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))",
    re.I | re.S,
)
#: One attribute after another: its name, then its quoted or bare value.
_ATTRIBUTE = re.compile(r"([^\s=/>\"'][^\s=/>]*+)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]++)))?")
_WORD = re.compile(r"[^\W\d_]+")


def _part(name: str, rest: str, in_main: bool) -> str:
    """What an element holds: ``never`` main text, text that is ``foreign`` or ``out`` unless the
    page's text is in it, ``main`` or nothing said."""
    role, names = "", ""
    if len(rest) > 2:
        for key, *values in _ATTRIBUTE.findall(rest):
            value, key = next((v for v in values if v), ""), key.lower()
            if key == "role":
                role = value.lower() if role != "hidden" else role
            elif key == "hidden":
                role = "hidden"
            elif key == "itemprop":
                role = "main" if value.lower() == "articlebody" and role != "hidden" else role
            elif key in ("class", "id"):
                names += f" {value}"
    if role == "hidden":
        return "never"
    if names and name not in ("body", "html", "main"):
        found = [m for m in map(_OUT_NAME.fullmatch, names.split()) if m]
        if found:
            return "foreign" if any(m["foreign"] for m in found) else "out"
    if role in _OUT_ROLES:
        return "out"
    if name in _OUT and not (in_main and name in ("header", "figcaption")):
        return "never" if name in _ALWAYS_OUT else "out"
    return "main" if name in _MAIN or role == "main" else ""


Block = tuple[str, float, bool, int, bool]


class _Page:
    """A page's blocks in pieces of text, each with the innermost open element that is out."""

    def __init__(self, page: str):
        #: (pieces, in a heading, number of the marked article or 0, in a list's item); a piece is (text, in a link,
        #: element that is out or 0).
        self.raw: list[tuple[list[tuple[str, bool, int]], bool, int, bool]] = []
        #: By an out element's number: the one around it, and whether it is foreign or in the marked article.
        self.around, self.strict = [0], [False]
        self._read(page)

    def _read(self, page: str) -> None:
        pieces: list[tuple[str, bool, int]] = []
        stack: list[tuple[str, str]] = []
        never = main = links = items = inside = article = 0
        heading = False

        def close_block():
            nonlocal pieces
            if pieces:
                self.raw.append((pieces, heading, article if main else 0, items > 0))
                pieces = []

        def leave(name: str, part: str) -> None:
            nonlocal never, main, links, items, inside
            never -= part == "never"
            main -= part == "main"
            links -= name == "a"
            items -= name == "li"
            if part in ("out", "foreign"):
                inside = self.around[inside]

        at = 0
        for m in _MARKUP.finditer(page):
            if m.start() > at and not never:
                pieces.append((page[at : m.start()], links > 0, inside))
            at = m.end()
            name = m["name"]
            if name is None:
                continue
            name = name.lower()
            if name == "br":
                if not never:
                    pieces.append(("\n", False, inside))
                continue
            if name in _BLOCKS:
                close_block()
            if m["close"]:
                # Ends the nearest open element of that name, and what is still open inside it.
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        for gone, part in reversed(stack[k:]):
                            leave(gone, part)
                        del stack[k:]
                        break
                    if stack[k][0] in _MAIN and name not in _MAIN and name not in ("body", "html"):
                        break  # a stray end tag does not end the article
            elif name not in _VOID and not m["rest"].endswith("/>"):
                if name == "p" and stack and stack[-1][0] == "p":
                    leave(*stack.pop())
                part = _part(name, m["rest"], main > 0)
                if name != "p" or part:
                    stack.append((name, part))
                    never += part == "never"
                    links += name == "a"
                    items += name == "li"
                    if part in ("out", "foreign"):
                        self.around.append(inside)
                        self.strict.append(part == "foreign" or main > 0)
                        inside = len(self.around) - 1
                    article += part == "main" and not main
                    main += part == "main"
            if name in _BLOCKS:
                heading = not m["close"] and len(name) == 2 and name[0] == "h" and name[1].isdigit()
        if not never:
            pieces.append((page[at:], links > 0, inside))
        close_block()

    def _block(self, pieces: list[tuple[str, bool, int]], heading: bool, article: int, item: bool) -> Block | None:
        joined = " ".join(entities.unescape("".join([p[0] for p in pieces])).split())
        linked = sum(len(p[0]) for p in pieces if p[1])
        return (joined, min(1.0, linked / len(joined)), heading, article, item) if joined else None

    def _released(self) -> list[bool]:
        """Which out elements are read after all: those that hold the marked article, or most of the
        page's text that could be main text.  Foreign ones and those within the marked article are
        read only where no such text is left without them."""
        n = len(self.around)
        seen = [True] + [False] * (n - 1)
        if n == 1:
            return seen
        text, marked = [0] * n, [0] * n
        for pieces, heading, mark, item in self.raw:
            by: dict[int, list[tuple[str, bool, int]]] = {}
            for piece in pieces:
                by.setdefault(piece[2], []).append(piece)
            for k, own in by.items():
                block = self._block(own, heading, mark, item)
                label = first_pass(block[0], block[1]) if block else "bad"
                if label in ("good", "near") or (block and mark and block[1] < ALL_LINKS):
                    text[k] += len(block[0])
                    marked[k] += len(block[0]) if mark else 0
        shown, shown_marked = text[0], marked[0]
        own_text, own_marked = list(text), list(marked)
        for k in range(n - 1, 0, -1):
            text[self.around[k]] += text[k]
            marked[self.around[k]] += marked[k]
        for k in range(1, n):
            article = not shown_marked and 2 * marked[k] > marked[0]
            most = 2 * text[k] > text[0]
            if seen[self.around[k]] and (not shown if self.strict[k] else True) and (article or most):
                seen[k] = True
                shown += own_text[k]
                shown_marked += own_marked[k]
        return seen

    def blocks(self) -> list[Block]:
        seen = self._released()
        found = [self._block([p for p in pieces if seen[p[2]]], *rest) for pieces, *rest in self.raw]
        return [b for b in found if b]


def blocks(page: str) -> list[Block]:
    """(text, share of it in links, in a heading, number of the marked article or 0, in a list's item) of
    every block that is not in an element that is out."""
    return _Page(page).blocks()


def first_pass(text: str, links: float) -> str:
    """Label of a block by its length and the densities of links and stop words."""
    if links > MAX_LINKS:
        return "bad"
    if len(text) < SHORT_CHARS:
        return "bad" if links else "short"
    found = _WORD.findall(text.lower())
    stops = sum(w in STOP_WORDS for w in found) / max(1, len(found))
    if stops >= HIGH_STOPS:
        return "good" if len(text) > LONG_CHARS else "near"
    return "near" if stops >= LOW_STOPS else "bad"


def link_lists(found: list[Block]) -> list[bool]:
    """Whether each block is in a list of links: it is nothing but links, and so is a neighbour, or it is
    a list's item."""
    full = [False, *(b[1] >= ALL_LINKS for b in found), False]
    return [full[k + 1] and (b[4] or full[k] or full[k + 2]) for k, b in enumerate(found)]


def _last_decided(labels: list[str], marks: list[int]) -> list[str]:
    """The label of the nearest good or bad block before each block.  Within a marked article only
    its own blocks count, and it begins as good; the page begins as bad."""
    found, page, own, mark = [], "bad", "good", 0
    for label, m in zip(labels, marks, strict=True):
        if m != mark:
            own, mark = "good", m
        found.append(own if m else page)
        if label in ("good", "bad"):
            own = page = label
    return found


def second_pass(labels: list[str], headings: list[bool], marks: list[int]) -> list[bool]:
    """Whether each block is kept: undecided ones look to the nearest good or bad block on either
    side; both good keeps, both bad drops, one of each keeps what was nearly good.  A heading
    needs a kept block after it."""
    before = _last_decided(labels, marks)
    after = _last_decided(labels[::-1], marks[::-1])[::-1]
    keep = [False] * len(labels)
    for k in reversed(range(len(labels))):
        if labels[k] in ("good", "bad"):
            keep[k] = labels[k] == "good"
        elif headings[k]:
            last = k + 1 == len(labels) or marks[k + 1] != marks[k]
            keep[k] = after[k] == "good" and (last or keep[k + 1])
        elif before[k] == after[k]:
            keep[k] = before[k] == "good"
        else:
            keep[k] = labels[k] == "near"
    return keep


def _labels(found: list[Block]) -> tuple[list[str], list[int]]:
    """Labels of the first pass, and the marked articles that count as such: one without a good
    block (a card, a short comment) does not where the good text outside of all is longer than
    the text in them."""
    plain = [first_pass(b[0], b[1]) for b in found]
    if not any(b[3] for b in found):
        return plain, [0] * len(found)
    listed = link_lists(found)
    good = {b[3] for b, label in zip(found, plain, strict=True) if label == "good"}
    outside = sum(len(b[0]) for b, label in zip(found, plain, strict=True) if not b[3] and label == "good")
    inside = sum(len(b[0]) for b, in_list in zip(found, listed, strict=True) if b[3] and not in_list)
    marks = [b[3] if b[3] in good or inside >= outside else 0 for b in found]
    if not any(marks):
        return plain, marks
    labels = []
    for label, mark, in_list in zip(plain, marks, listed, strict=True):
        if mark and label != "good":
            # Density decides what is good; the mark makes nearly good of the rest but lists of links.
            label = "bad" if in_list else "near"
        elif not mark and label == "near":
            label = "short"  # outside the article only what density decides well stands
        labels.append(label)
    return labels, marks


def main_text(page: str) -> str:
    found = blocks(page)
    labels, marks = _labels(found)
    keep = second_pass(labels, [b[2] for b in found], marks)
    return "\n\n".join(b[0] for b, k in zip(found, keep, strict=True) if k)


def _extract(batches):
    for batch in slices(batches):
        texts = [main_text(h) if h else "" for h in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
        )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html)."""
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    out = rows.mapInArrow(_extract, "page_id bigint, url string, text string")
    return out.withColumn("n_chars", F.char_length("text").cast("bigint"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
