"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import map_arrow

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea noscript template iframe svg object canvas title select".split())
#: Elements that are blocks of their own; all others, unknown ones too, are part of the text around them.
BLOCKS = frozenset(
    "html head body address article aside blockquote button caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: A start tag of these ends an open paragraph.
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul figure".split())
#: Elements that an implied end does not reach beyond.
SCOPE = frozenset("html body article section main div aside nav header footer table ul ol dl form blockquote td th li".split())
MAIN = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are by their tag no article.
BESIDE = frozenset("nav footer aside form dialog menu fieldset header button".split())
#: Of these, and of elements so marked, an article inside is none of the page's own.
BARS = frozenset("aside nav footer dialog menu".split())
BAR_MARKS = frozenset("comment comments respond reply replies disqus related recommended teaser teasers promo promotion sponsor sponsored ad ads advert advertisement advertising".split())
#: What follows "comment" in the mark of a single comment, and what says only whether there are some.
ONE_COMMENT = frozenset("body item content text entry card inner wrap wrapper".split())
STATES = frozenset("open closed enabled disabled count link".split())
#: Words that mark by an id inside an article; others there may name a section.
ID_MARKS = frozenset("ad ads advert advertisement comment comments respond disqus sidebar newsletter related recommended cookie cookies breadcrumb breadcrumbs pagination pager".split())
#: First words of a heading over what readers wrote.
COMMENT_HEADINGS = re.compile(r"(?:\d+ )?comments?\b.{0,12}$|leave a (?:reply|comment)", re.I)
#: Words of a class, id or role that mark what is not the article.
BOILERPLATE = frozenset(
    "ad ads adv advert advertisement advertising sponsor sponsored banner promo promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar side footer header masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login search share sharing social related recommended comment comments respond reply replies disqus pagination pager widget toolbar copyright legal teaser teasers".split()
)
#: Elements that hold others; a part of a word on a paragraph of its own says little.
HOLDERS = frozenset("div section ul ol dl table tr td".split())
#: Before a word these say that there is such a thing beside the text, or none.
ABOUT = frozenset("has no with without hide show".split())

ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
MARKING = frozenset(("class", "id", "role"))
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
STOPS = re.compile(r"[\"'>]")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
PUNCTUATION = re.compile(r"[.,;:!?。，、；：！？…]")
SPACE = re.compile(r"\s+")

SMOOTH = 2  # blocks to either side that a block's ratios are smoothed with
SPREAD = 1.0  # of the Gaussian that does so
THRESHOLD = 0.5  # times the standard deviation of the fused ratios
#: What the ratios of a path count times for each element that is by its tag, by a whole word of its marks, or by a part of one beside the article.
TAG_PRIOR, MARK_PRIOR, PART_PRIOR = 0.05, 0.05, 0.5
#: What they count times inside an element marked as the article.
MAIN_PRIOR = 4.0


class Element:
    """An open element: the number of its path of tags from the root, and what tags and marks along it say beforehand."""

    __slots__ = ("barred", "block", "children", "depth", "home", "main", "parent", "path", "prior", "tag")

    def __init__(self, parent: Element | None, tag: str, path: int, prior: float, main: bool, barred: bool = False):
        self.parent, self.tag, self.path, self.prior, self.main, self.barred = parent, tag, path, prior, main, barred
        self.depth = 0 if parent is None else parent.depth + 1
        inline = parent is not None and tag not in BLOCKS
        self.block: str = parent.block if inline else tag  # the tag of the block that its text is in
        self.home: Element = self if parent is None else parent.home if inline else parent  # what that block is in
        self.children: list[Element] = []

    def down(self, tag: str, factor: float, bars: bool, paths: dict) -> Element:
        # an article is one inside of any layout, but not among comments, teasers or adverts, nor if it is one of these
        barred = self.barred or bars
        opens = tag in MAIN and not self.main and not barred
        path = paths.setdefault((self.path, tag, factor), len(paths) + 1)
        found = Element(self, tag, path, MAIN_PRIOR if opens else self.prior * factor, opens or self.main, barred)
        self.children.append(found)
        return found

    def unmarked(self) -> set[Element]:
        """This element, and those in it that nothing marks as something else."""
        found, left = {self}, [self]
        while left:
            more = [e for e in left.pop().children if e.prior >= self.prior]
            found.update(more)
            left += more
        return found


def common_home(elements: list[Element]) -> Element:
    """The least element that all these blocks are in; the article where that is in one."""
    found = elements[0].home
    below = {found}  # elements in the found one, itself included
    for element in elements[1:]:
        other = element.home
        while other not in below and other.depth > found.depth:
            below.add(other)
            other = other.parent
        while other not in below:
            if found.depth == other.depth:
                below.add(other)
                other = other.parent
            found = found.parent
            below.add(found)
    while found.parent is not None and found.main and found.parent.main:
        found = found.parent
    return found


class Block:
    __slots__ = ("element", "linked", "parts")

    def __init__(self, element: Element):
        self.element, self.parts, self.linked = element, [], True

    def text(self) -> str:
        return SPACE.sub(" ", entities.unescape("".join(self.parts))).strip()


def marks_of(attributes: str) -> Iterator[tuple[str, str]]:
    """(attribute, word) of the class, id and role of a tag."""
    for found in ATTRIBUTE.finditer(attributes):
        name = found[1].lower()
        if name in MARKING:
            for word in (found[2] or found[3] or found[4] or "").split():
                yield name, word


def factor_of(tag: str, attributes: str, inside_main: bool) -> tuple[float, bool]:
    """What an element's tag and marks count beforehand, and whether an article inside is none. A header inside an article is its own."""
    if tag in BESIDE and not (inside_main and tag == "header"):
        return TAG_PRIOR, tag in BARS
    if tag in ("html", "body") or not attributes:
        return 1.0, False
    out, bars = 1.0, False
    for name, word in marks_of(attributes):
        parts = [w.lower() for w in WORDS.findall(word)]
        if not parts or parts[0] in ABOUT or inside_main and "header" in parts:
            continue
        if tag in MAIN:  # what is said of an article: only that it is itself something else
            if len(parts) == 1 and parts[0] in BAR_MARKS or len(parts) == 2 and parts[0] == "comment" and parts[1] in ONE_COMMENT:
                out, bars = MARK_PRIOR, True
            continue
        if inside_main and name == "id" and not any(w in ID_MARKS for w in parts):
            continue
        if len(parts) == 1 and parts[0] in BOILERPLATE:
            out = min(out, MARK_PRIOR)
            bars = bars or parts[0] in BAR_MARKS
        elif tag in HOLDERS and any(w in BOILERPLATE for w in parts):
            out = min(out, PART_PRIOR)
            bars = bars or any(w in BAR_MARKS for w in parts) and not any(w in STATES for w in parts)
    return out, bars


def tag_end(page: str, at: int) -> int:
    """Where the tag whose name ends at `at` ends, past its '>'; the end of the page if it does not.

    A quoted value can hold '>'. A quote that no other one closes, or only one after another tag, is none.
    """
    while True:
        stop = STOPS.search(page, at)
        if not stop:
            return len(page)
        if stop[0] == ">":
            return stop.end()
        close = page.find(stop[0], stop.end())
        within = page.find("<", stop.end(), close if close >= 0 else None)
        if close < 0 or within >= 0 and page.find(">", stop.end(), within) >= 0:
            end = page.find(">", stop.end())
            return end + 1 if end >= 0 else len(page)
        at = close + 1


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order, each with its element. Linear in the page, however broken it is."""
    stack, paths = [Element(None, "", 0, 1.0, False)], {}
    depth: dict[str, int] = {}  # open elements by tag
    blocks: list[Block] = []
    block: Block | None = None
    at, n = 0, len(page)
    missing: set[str] = set()  # closing tags of raw elements that the rest of the page has not

    def close_to(i: int) -> None:
        nonlocal block
        for element in stack[i:]:
            depth[element.tag] -= 1
            if element.tag in BLOCKS:
                block = None
        del stack[i:]

    def close(tags: tuple, scoped: bool) -> None:
        if not any(depth.get(t) for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                close_to(i)
                return
            if scoped and stack[i].tag in SCOPE:
                return

    while at < n:
        begin = page.find("<", at)
        while begin >= 0 and begin + 1 < n and not (page[begin + 1] in "!?/" or page[begin + 1].isascii() and page[begin + 1].isalpha()):
            begin = page.find("<", begin + 1)
        begin = begin if 0 <= begin < n - 1 else n
        raw = page[at:begin]
        if raw:
            if block is None and not raw.isspace():
                block = Block(stack[-1])
                blocks.append(block)
            if block is not None:
                block.parts.append(raw)
                block.linked = block.linked and (bool(depth.get("a")) or raw.isspace())
        if begin == n:
            break
        if page[begin + 1] in "!?":
            close_mark = "-->" if page.startswith("<!--", begin) else ">"
            end = page.find(close_mark, begin + 2)
            at = end + len(close_mark) if end >= 0 else n
            continue
        ending = page[begin + 1] == "/"
        name = NAME.match(page, begin + 1 + ending)
        if not name:
            end = page.find(">", begin)
            at = end + 1 if end >= 0 else n
            continue
        tag, at = name[0].lower(), tag_end(page, name.end())
        if ending:
            if depth.get(tag):
                close((tag,), False)
            elif tag == "p":
                block = None
            continue
        attributes = page[name.end() : at - 1]
        if tag in RAW and not attributes.rstrip().endswith("/"):
            end = None if tag in missing else re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            if end is None:
                missing.add(tag)
            at = end.end() if end else n
            block = None if tag in BLOCKS else block
            continue
        if tag == "br":
            if block is not None:
                block.parts.append(" ")
            continue
        if tag in VOID:
            block = None if tag in BLOCKS else block
            continue
        implied = CLOSES.get(tag, ()) + (("p",) if tag in ENDS_P else ())
        if implied:
            close(implied, True)
        if tag in BLOCKS:
            block = None
        stack.append(stack[-1].down(tag, *factor_of(tag, attributes, stack[-1].main), paths))
        depth[tag] = depth.get(tag, 0) + 1
    return blocks


def content_scores(blocks: list[Block], texts: list[str]) -> list[float]:
    """Tag-path ratios: text length and punctuation for each block of a path, smoothed over the page, then fused."""
    chars, marks, count = {}, {}, {}
    paths = [b.element.path for b in blocks]
    for p, t in zip(paths, texts, strict=True):
        chars[p] = chars.get(p, 0) + len(t)
        marks[p] = marks.get(p, 0) + len(PUNCTUATION.findall(t))
        count[p] = count.get(p, 0) + 1
    weights = [math.exp(-(i * i) / (2 * SPREAD * SPREAD)) for i in range(-SMOOTH, SMOOTH + 1)]

    def smooth(values: list[float]) -> list[float]:
        out = []
        for i in range(len(values)):
            near = [(weights[j - i + SMOOTH], values[j]) for j in range(max(0, i - SMOOTH), min(len(values), i + SMOOTH + 1))]
            out.append(sum(w * v for w, v in near) / sum(w for w, _ in near))
        return out

    by_text = [chars[p] / count[p] for p in paths]
    by_marks = [marks[p] / count[p] for p in paths]
    # the geometric mean of a path's ratio and the smoothed one: neither a block alone nor its place alone makes a text
    both = lambda ratios: [math.sqrt(r * s) for r, s in zip(ratios, smooth(ratios), strict=True)]
    return [t * (1 + p) for t, p in zip(both(by_text), both(by_marks), strict=True)]


def drop_comments(blocks: list[Block], texts: list[str], keep: list[bool]) -> None:
    """What follows a heading over readers' comments, in the element that it is in, up to another heading of its rank."""
    over: Element | None = None
    rank = ""
    for i, (block, text) in enumerate(zip(blocks, texts, strict=True)):
        tag = block.element.block
        if over is not None:
            home: Element | None = block.element.home
            while home is not None and home is not over and home.depth > over.depth:
                home = home.parent
            if home is not over or tag in HEADINGS and tag <= rank:
                over = None
        if over is None and tag in HEADINGS and COMMENT_HEADINGS.match(text):
            over, rank = block.element.home, tag
        keep[i] = keep[i] and over is None


def main_text(page: str | None) -> str:
    """The main text of a page, one line for each block; empty if there is none.

    Blocks are scored by the ratios of their tag paths, times what tags and marks say beforehand. Paths of a mean score
    of at least the threshold hold the text. A block on another path, such as a title or a short section, belongs to it if it
    is inside the article, or inside the least element that all chosen blocks are in, and nothing there marks it as something
    else.
    """
    found = [(b, t) for b in blocks_of(page or "") if (t := b.text())]
    if not found:
        return ""
    blocks, texts = [b for b, _ in found], [t for _, t in found]
    scores = [s * b.element.prior for s, b in zip(content_scores(blocks, texts), blocks, strict=True)]
    mean = sum(scores) / len(scores)
    least = min(mean, THRESHOLD * math.sqrt(sum((s - mean) ** 2 for s in scores) / len(scores)))
    of_path: dict[int, list[float]] = {}
    for b, s in zip(blocks, scores, strict=True):
        of_path.setdefault(b.element.path, []).append(s)
    chosen = {p for p, found in of_path.items() if sum(found) / len(found) >= least}
    region = common_home([b.element for b in blocks if b.element.path in chosen])
    inside = region.unmarked()
    # without an article, blocks that are links only are no text but for their ratios
    keep = [b.element.path in chosen or b.element in inside and (region.main or not b.linked) for b in blocks]
    if not region.main:
        drop_comments(blocks, texts, keep)
    for i in range(len(blocks) - 2, -1, -1):  # the heading of what is kept
        keep[i] = keep[i] or keep[i + 1] and blocks[i].element.block in HEADINGS and blocks[i].element.prior >= region.prior
    return "\n".join(t for t, k in zip(texts, keep, strict=True) if k)


def extract_main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Main text of every page.

    Null, empty and text-free pages give an empty text. Pages are read whole, however long or broken: an unclosed tag
    or comment runs to the end. Repeated rows are each a row. An empty table gives no rows. Extra columns are not read.
    Columns: page_id, url, text, n_chars (code points).
    """

    def extract(batch: pa.RecordBatch) -> dict:
        texts = [main_text(h) for h in batch.column("html").to_pylist()]
        return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts, "n_chars": [len(t) for t in texts]}

    source = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return map_arrow(source, extract, "page_id long, url string, text string, n_chars long", text="html")
