"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level elements. First pass: stop-word
density, length and link density decide a block good or bad; what stands in a
menu, header, footer, sidebar, notice, advert, form or reader comment is bad.
Second pass: the ambiguous blocks, mostly short ones, take the label of the
nearest decided block of the same container. Omitted end tags end where the next
element implies it. If nothing is left of a page, forms and named wrappers that hold
most of its prose (a page that is one form) no longer count as bad, those of reader
comments still do.

Null, empty and tag-only pages give an empty text. Pages are independent: ties
and repeated rows give equal results. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Frequent words of four languages.
STOP_WORDS = frozenset(
    """
    the of and to in is it that for was on are as with be by at this have from or an not but which he his they a
    der die das und ist ein eine zu den von mit auf für im dem nicht des als auch sich wie aus bei
    le la les de des et en un une du est que pour dans sur par plus pas au qui avec ce il
    el los las y una por con no se su para es del lo como más al sus o
    """.split()
)

# Element names of HTML.
SKIPPED = frozenset("script style noscript template head title svg math iframe object canvas select textarea button audio video".split())
BLOCKS = frozenset(
    """address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr
    ul""".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
#: Words in class and id names that mark what is not the article.
BOILERPLATE_NAMES = frozenset(
    """ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion banner
    banners sidebar sidebars aside nav navbar navigation menu menus breadcrumb breadcrumbs topbar toolbar masthead
    footer footers cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe
    subscription signup login register paywall comment comments disqus reply replies respond discussion feedback share
    sharing social related recommended recommendations widget widgets pagination pager copyright legal disclaimer
    search form tags skip""".split()
)
COMMENT_NAMES = frozenset("comment comments disqus reply replies respond discussion".split())
CONTAINERS = frozenset(["article", "main"])
HEAD_ONLY = frozenset("title style script noscript template meta link base".split())
#: Elements that a start tag ends, and elements it does not look beyond.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
}

LONG = 70
STOP_DENSITY = 0.15
LOW_STOP_DENSITY = 0.05
LINK_DENSITY = 0.5

GOOD, BAD, OPEN = 1, 0, -1


def name_words(value: str) -> set[str]:
    """``"top-Menu sideBar"`` as single lower-case words and whole names."""
    spread = re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", value)
    return {w for w in re.split(r"[^a-z]+", spread.lower()) if w} | set(value.lower().split())


class Block:
    """``marks`` are the forms and named wrappers around a block, ``hard`` whether something else makes it boilerplate."""

    __slots__ = ("boilerplate", "container", "hard", "heading", "linked", "marks", "parts", "text")

    def __init__(self, hard: bool, marks: tuple[int, ...], container: int, heading: bool):
        self.hard, self.marks, self.container, self.heading = hard, marks, container, heading
        self.boilerplate = hard or bool(marks)
        self.parts: list[str] = []
        self.linked = 0
        self.text = ""


class BlockReader(HTMLParser):
    """Blocks of a page in page order; open elements are kept on a stack."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        # Tag, skipped, hard, marks, container, link.
        self.stack: list[tuple[str, bool, bool, tuple[int, ...], int, bool]] = []
        self.block: Block | None = None
        self.containers: dict[int, str] = {0: ""}
        self.lasting: list[bool] = []  # per mark, whether it stays in any case

    def state(self) -> tuple[bool, bool, tuple[int, ...], int, bool]:
        return self.stack[-1][1:] if self.stack else (False, False, (), 0, False)

    def flush(self) -> None:
        if self.block is not None:
            self.block.text = " ".join("".join(self.block.parts).split())
            self.block.parts = []
            if self.block.text:
                self.blocks.append(self.block)
        self.block = None

    def hard(self, tag: str, attrs: dict, container: int) -> bool:
        if tag in BOILERPLATE_TAGS and tag != "form" or (tag == "header" and not container):
            return True
        return attrs.get("role", "").lower() in BOILERPLATE_ROLES or attrs.get("aria-hidden") == "true" or "hidden" in attrs

    def mark(self, tag: str, attrs: dict, container: int) -> int | None:
        """Number of a new mark if the element is a form or its names tell it is not the article."""
        names = BOILERPLATE_NAMES & name_words(f"{attrs.get('class', '')} {attrs.get('id', '')}")
        if tag in ("html", "body", "a") or tag in CONTAINERS and container == 0 and "comment" not in attrs.get("class", ""):
            names = frozenset()
        if tag != "form" and not names:
            return None
        self.lasting.append(bool(names & COMMENT_NAMES))
        return len(self.lasting) - 1

    def end_implied(self, tag: str) -> None:
        """Pop what a start tag ends without an end tag."""
        if tag not in HEAD_ONLY and tag != "head" and any(e[0] == "head" for e in self.stack):
            del self.stack[next(k for k, e in enumerate(self.stack) if e[0] == "head") :]
        if tag == "a":
            self.pop_to("a", lambda name: name in BLOCKS)
        if tag in BLOCKS:
            self.pop_to("p", lambda name: name in BLOCKS)
        for name in ENDS.get(tag, ((), ()))[0]:
            self.pop_to(name, lambda other: other in ENDS[tag][1])

    def pop_to(self, name: str, stops) -> None:
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == name:
                del self.stack[k:]
                return
            if stops(self.stack[k][0]):
                return

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.flush()
        self.end_implied(tag)
        if tag in VOID:
            self.data(" ")
            return
        if tag not in BLOCKS and tag not in SKIPPED and tag not in ("span", "section", "a"):
            return
        attrs = {k: v or "" for k, v in attrs}
        skipped, hard, marks, container, link = self.state()
        skipped = skipped or tag in SKIPPED
        hard = hard or self.hard(tag, attrs, container)
        if not hard and (mark := self.mark(tag, attrs, container)) is not None:
            marks = (*marks, mark)
        if (tag in CONTAINERS or attrs.get("role") == "main") and not hard and not marks:
            container = len(self.containers)
            self.containers[container] = "article" if tag == "article" else "main"
        # An anchor that leads nowhere is no link.
        self.stack.append((tag, skipped, hard, marks, container, link or tag == "a" and "href" in attrs))

    def handle_startendtag(self, tag, attrs):
        if tag in BLOCKS:
            self.flush()
        else:
            self.data(" ")

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.flush()
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                del self.stack[k:]
                break
            if tag not in BLOCKS and self.stack[k][0] in BLOCKS:
                break

    def handle_data(self, data):
        if data:
            self.data(data)

    def data(self, data: str) -> None:
        skipped, hard, marks, container, link = self.state()
        if skipped:
            return
        if self.block is not None and self.block.boilerplate != (hard or bool(marks)):
            self.flush()
        if self.block is None:
            if not data.strip():
                return
            heading = any(e[0] in HEADINGS for e in self.stack[-3:])
            self.block = Block(hard, marks, container, heading)
        self.block.parts.append(data)
        if link:
            self.block.linked += len("".join(data.split()))


def stop_density(text: str) -> float:
    found = re.findall(r"[^\W\d_]+", text.lower())
    return sum(w in STOP_WORDS for w in found) / max(1, len(found))


def first_pass(block: Block, inside: bool) -> int:
    """Good, bad or open by the block's own text and place."""
    if block.boilerplate:
        return BAD
    solid = len(block.text.replace(" ", ""))
    if block.linked > LINK_DENSITY * solid and not (inside and block.heading):
        return BAD
    if len(block.text) < LONG:
        return OPEN
    density = stop_density(block.text)
    if density >= STOP_DENSITY:
        return GOOD
    return BAD if density < LOW_STOP_DENSITY and not inside else OPEN


def second_pass(labels: list[int], blocks: list[Block], inside: bool) -> list[int]:
    """Open blocks take the label of the nearest decided one; the next one on a tie.

    Boilerplate never speaks for an open block inside an article. Without any
    decided block, text in an article or main element is kept.
    """
    n = len(labels)
    speaks = [labels[i] != OPEN and not (inside and labels[i] == BAD) for i in range(n)]
    before, after, last = [None] * n, [None] * n, None
    for i in range(n):
        before[i] = last
        last = i if speaks[i] else last
    last = None
    for i in range(n - 1, -1, -1):
        after[i] = last
        last = i if speaks[i] else last
    out = list(labels)
    for i in range(n):
        if labels[i] != OPEN:
            continue
        a, b = before[i], after[i]
        if a is None and b is None:
            # No context at all: prose of a page that marks no article is kept too.
            out[i] = GOOD
        elif b is None or (a is not None and i - a < b - i and not blocks[i].heading):
            out[i] = labels[a]
        else:
            out[i] = labels[b]
    return out


def main_text(html: str | None) -> str:
    """The article of one page, its blocks joined by an empty line."""
    if not html:
        return ""
    reader = BlockReader()
    reader.feed(html)
    reader.close()
    reader.flush()
    text = chosen_text(reader)
    if not text and lift_marks(reader):
        text = chosen_text(reader)
    return text


def chosen_text(reader: BlockReader) -> str:
    kinds = reader.containers
    for kind in ("article", "main", ""):
        chosen = [b for b in reader.blocks if kind in ("", kinds[b.container]) and not b.boilerplate]
        if chosen:
            break
    inside = kind != ""
    blocks = [b for b in reader.blocks if kind in ("", kinds[b.container])]
    labels = second_pass([first_pass(b, inside) for b in blocks], blocks, inside)
    return "\n\n".join(b.text for b, label in zip(blocks, labels) if label == GOOD)


def lift_marks(reader: BlockReader) -> bool:
    """Take the marks away that hold more than half of the page's prose; whether there were any."""
    prose = [b for b in reader.blocks if not b.hard and len(b.text) >= LONG and stop_density(b.text) >= STOP_DENSITY]
    held = [0] * len(reader.lasting)
    for b in prose:
        for mark in b.marks:
            held[mark] += len(b.text)
    half = sum(len(b.text) for b in prose) / 2
    lifted = {k for k, n in enumerate(held) if n > half and not reader.lasting[k]}
    for b in reader.blocks:
        b.boilerplate = b.hard or any(m not in lifted for m in b.marks)
    return bool(lifted)


def extract_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """``page_id, url, text`` for every page."""
    columns = pages.select("page_id", "url", F.col(html).alias("html"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pa.array([main_text(x) for x in batch.column(2).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), text], ["page_id", "url", "text"])

    kinds = dict(columns.dtypes)
    return columns.mapInArrow(extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
