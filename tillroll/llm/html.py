"""Main text of web pages by tag-path ratios.

A page is read, in one forward scan, as blocks of text with the tag path of their
block element.  Per path the text outside links and its punctuation are summed;
their ratios to the number of the path's blocks are smoothed over neighbouring
paths, fused with the path's share of the text, and thresholded.  An article or main element around a block adds to
its score; a class word that names other parts (inside such an element, where it
removes nothing by itself) takes from it.  The main text is, in page order, the
blocks above the threshold, and the headings and short blocks between them.
Menus, headers, footers, sidebars, notices, adverts, forms and reader comments
around the content are left out before.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import free_prefix, with_columns

_NAME = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_TAG_END = re.compile(r"[>\"']")
_ATTR = re.compile(r"""(?<![a-zA-Z-])([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[a-z0-9]+")

#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is raw text up to their end tag.
RAW = frozenset("script style textarea title noscript iframe template svg math object select".split())
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
#: Elements that begin and end a block of text.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead tr ul".split())
#: Elements that are not the article's text.
OUTSIDE = frozenset("nav footer aside form head button dialog menu".split())
#: Words in class, id or role that mark such parts.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsored sponsor promo banner sidebar sidebars menu menus nav navbar "
    "navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent notice notices popup modal newsletter "
    "subscribe share sharing social related recommended comment comments respond disqus login signup search pagination "
    "pager toolbar widget contentinfo complementary alert".split())
#: Those of them that mark reader comments, which may be longer than the article.
COMMENTS = frozenset("comment comments respond disqus".split())
#: Those that name what is never the article's text; they weigh most there.
ADVERTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsored sponsor promo banner cookie cookies consent newsletter subscribe "
    "share sharing popup modal login signup breadcrumb breadcrumbs pagination pager".split())
#: First words of names that describe a layout.
LAYOUT = frozenset("has no with without".split())
#: Containers that name the content themselves.
MAIN = frozenset("article main".split())
#: Elements of other languages, which may close themselves.
FOREIGN = frozenset("svg math".split())
_HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Mean characters and punctuation of a path's blocks from which on they count as full text.
FULL_TEXT, FULL_POINTS = 200.0, 4.0
#: Characters of a path from which on it has its full share of the page's text.
FULL_MASS = 1000.0
#: What an article or main element around a block adds to its score, and what marks take.
MAIN_WEIGHT, MARK_WEIGHT, ADVERT_WEIGHT = 0.5, 0.1, 1.5
PUNCTUATION = re.compile(r"[.,;:!?…。，！？、]")


def _closes(open_tag: str, new: str) -> bool:
    """Whether a start tag ends an open element that has an optional end tag."""
    if open_tag == "p":
        return new in BLOCK
    if open_tag == "head":
        return new == "body"
    return (open_tag, new) in {("li", "li"), ("dt", "dd"), ("dd", "dt"), ("dt", "dt"), ("dd", "dd"), ("tr", "tr"),
                               ("td", "td"), ("td", "th"), ("th", "td"), ("th", "th"), ("td", "tr"), ("th", "tr"),
                               ("option", "option")}


# ---- markup ----------------------------------------------------------------------

def tags(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, is an end tag, attributes) of each tag, comment and
    declaration (those two without a name), in one forward scan.

    A tag ends at the first ``>`` outside quotes.  Once a quote turns out to be
    open to the end of the page, quotes count no more from there on; without a
    ``>`` further on there is no tag further on either.  So no character is
    looked at more than a few times, whatever the page looks like."""
    last, at, quotes = page.rfind(">"), 0, True
    while True:
        start = page.find("<", at)
        if start < 0:
            return
        at = start + 1
        for opens, closes in (("<!--", "-->"), ("<![CDATA[", "]]>")):
            if page.startswith(opens, start):
                stop = page.find(closes, start + len(opens))
                at = len(page) if stop < 0 else stop + len(closes)
                yield start, at, "", False, ""
                break
        else:
            if start > last:
                continue
            if page[start + 1:start + 2] in ("!", "?"):
                at = page.find(">", start) + 1
                yield start, at, "", False, ""
                continue
            name = _NAME.match(page, start + 1)
            if not name:
                continue
            stop = name.end()
            while quotes:
                end = _TAG_END.search(page, stop)
                if end is None:
                    stop = -1
                elif end[0] == ">":
                    stop = end.start()
                    break
                else:
                    stop = page.find(end[0], end.end()) + 1 or -1
                if stop < 0:
                    quotes = False
            if not quotes:
                stop = page.find(">", name.end())
            at = stop + 1
            yield start, at, name[2].lower(), bool(name[1]), page[name.end():stop]


def _attributes(attrs: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)}


def _names(named: dict[str, str]) -> list[list[str]]:
    """The words of each name in class, id and role; names such as has-sidebar
    tell the layout of what is around the part, not what it is."""
    names = (_WORD.findall(name) for k in ("class", "id", "role") for name in named.get(k, "").lower().split())
    return [words for words in names if words and words[0] not in LAYOUT]


def _mark_words(named: dict[str, str]) -> set[str]:
    return {w for words in _names(named) for w in words if w in MARKS}


class Path:
    """A tag path, one object each: parent, last tag, depth, what is on the way."""

    __slots__ = ("parent", "tag", "depth", "first", "others", "blocks", "in_link", "in_main", "is_heading", "is_title", "number", "last")

    def __init__(self, parent: Path | None, tag: str):
        self.parent, self.tag, self.first, self.others = parent, tag, None, None
        self.depth = parent.depth + 1 if parent else 0
        self.in_link = tag == "a" or bool(parent and parent.in_link)
        self.in_main = tag in MAIN or bool(parent and parent.in_main)
        self.is_heading = tag in HEADINGS or bool(parent and parent.is_heading)
        self.is_title = tag == "h1" or bool(parent and parent.is_title)
        #: The path of the block elements on the way.
        self.blocks: Path = self if parent is None or tag in BLOCK and parent.blocks is parent else (
            parent.blocks.child(tag) if tag in BLOCK else parent.blocks)
        self.number = self.last = 0

    def child(self, tag: str) -> Path:
        first = self.first           # most paths have one child
        if first is None:
            first = self.first = Path(self, tag)
        if first.tag == tag:
            return first
        if self.others is None:
            self.others = {}
        found = self.others.get(tag)
        if found is None:
            found = self.others[tag] = Path(self, tag)
        return found

    def holds(self, other: Path) -> bool:
        """Whether ``other`` is this path or begins with it (after ``numbered``)."""
        return self.number <= other.number <= self.last


def numbered(root: Path) -> None:
    """Numbers all paths so that those which begin with a path follow it."""
    n, todo = 0, [(root, False)]
    while todo:
        path, done = todo.pop()
        if done:
            path.last = n - 1
        else:
            path.number, n = n, n + 1
            todo.append((path, True))
            if path.first:
                todo.append((path.first, False))
            if path.others:
                todo.extend((c, False) for c in path.others.values())


def common(one: Path, two: Path) -> Path:
    """The longest path that both begin with."""
    while one is not two:
        if one.depth >= two.depth:
            one = one.parent
        else:
            two = two.parent
    return one


class Node(NamedTuple):
    path: Path
    block: int
    text: str
    mark: int                  # innermost marked element, -1 if none
    weight: float              # of the marks inside an article or main element


class Marked:
    """Marked elements: kind, the next one around each, and what they hold."""

    def __init__(self):
        self.kind, self.around, self.main = [], [], []

    def add(self, kind: str, around: int) -> int:
        self.kind.append(kind)
        self.around.append(around)
        self.main.append(False)
        return len(self.kind) - 1

    def up(self, values: list) -> list:
        """Sums over each element and those inside it (which have larger numbers)."""
        out = list(values)
        for k in range(len(out) - 1, -1, -1):
            if self.around[k] >= 0:
                out[self.around[k]] += out[k]
        return out

    def down(self, values: list[bool]) -> list[bool]:
        """Whether an element or one around it is flagged."""
        out = list(values)
        for k, a in enumerate(self.around):
            out[k] = out[k] or (a >= 0 and out[a])
        return out


def _mark(tag: str, attrs: str, in_main: bool) -> tuple[str, float]:
    """(kind, weight) of a start tag.  Kind: "" (no mark), "loose" (by a word or a
    form, which also stand on wrappers) or "strict".  Inside an article or main
    element a word removes nothing (but reader comments): it weighs on the score."""
    if tag in MAIN or tag in ("html", "body"):
        return "", 0.0
    if tag in OUTSIDE or (tag == "header" and not in_main):
        return ("loose" if tag == "form" else "strict"), 0.0
    if "=" not in attrs:
        return "", 0.0
    named = _attributes(attrs)
    if _HIDDEN.search(named.get("style", "")) or named.get("aria-hidden") == "true":
        return "strict", 0.0
    words = _mark_words(named)
    if not words:
        return "", 0.0
    if words & COMMENTS:
        return "strict", 0.0
    if not in_main:
        return "loose", 0.0
    return "", ADVERT_WEIGHT if any(w[0] in ADVERTS for w in _names(named)) else MARK_WEIGHT


def text_nodes(page: str) -> tuple[list[Node], Marked]:
    """The text nodes in page order, and the marked elements."""
    nodes: list[Node] = []
    marked, root = Marked(), Path(None, "")
    # open elements: (tag, path, mark, weight, index of the nearest open block element)
    stack: list[tuple] = [("", root, -1, 0.0, 0)]
    open_tags: Counter = Counter()
    block, at = 0, 0

    def text(a: int, b: int) -> None:
        if a < b:
            _, path, mark, weight, _ = stack[-1]
            nodes.append(Node(path, block, page[a:b], mark, weight))

    def close(k: int) -> None:
        for s in stack[k:]:
            open_tags[s[0]] -= 1
        del stack[k:]

    skip_to = 0
    for start, stop, tag, ends, attrs in tags(page):
        if start < skip_to:
            continue
        text(at, start)
        at = stop
        if not tag:
            continue
        if tag in BLOCK:
            block += 1
        if ends:
            if open_tags[tag]:
                k = len(stack) - 1
                while stack[k][0] != tag:
                    k -= 1
                close(k)
            continue
        if tag in VOID:
            if tag == "br":
                _, path, mark, weight, _ = stack[-1]
                nodes.append(Node(path, block, "\n", mark, weight))
            continue
        if tag in FOREIGN and attrs.endswith("/"):
            continue
        if tag in RAW:
            stop = _RAW_END[tag].search(page, at)
            at = skip_to = stop.end() if stop else len(page)
            continue
        if attrs.endswith("/"):
            continue
        # a block ends an open paragraph, with what is open inside it
        if tag in BLOCK and _closes(stack[stack[-1][4]][0], tag):
            close(stack[-1][4])
        _, path, mark, weight, nearest = stack[-1]
        kind, more = _mark(tag, attrs, open_tags["article"] + open_tags["main"] > 0)
        if kind:
            mark = marked.add(kind, mark)
        elif tag in MAIN and mark >= 0 and not _mark_words(_attributes(attrs)) & COMMENTS:
            marked.main[mark] = True
        new = path.child(tag)
        stack.append((tag, new, mark, max(weight, more), len(stack) if tag in BLOCK else nearest))
        open_tags[tag] += 1
    text(max(at, skip_to), len(page))
    return nodes, marked


def outside(nodes: list[Node], marked: Marked) -> list[bool]:
    """Which marked elements are not the article's text.

    Not so are wrappers of the content: elements that hold the page's only
    article or main elements, or ones with most of its text; and, on pages
    without such an element, loosely marked ones with more than three quarters
    of the text outside strict marks.  Link text does not count."""
    if not marked.kind:
        return []
    strict = marked.down([k == "strict" for k in marked.kind])
    free, total, named = 0, 0, 0
    within, named_within = [0] * len(strict), [0] * len(strict)
    for path, _, text, mark, _ in nodes:
        if path.in_link:
            continue
        n = len(_SPACE.sub("", text))
        total += n
        if mark < 0:
            free += n
            named += n if path.in_main else 0
            continue
        if not strict[mark]:
            free += n
            within[mark] += n
        named_within[mark] += n if path.in_main else 0
    within, named_within, main = marked.up(within), marked.up(named_within), marked.up(marked.main)
    right = [bool(m) and n > 0 and (not named or 2 * n > total) for m, n in zip(main, named_within)]
    if not named and not any(right):
        right = [kind == "loose" and 4 * n > 3 * free for kind, n in zip(marked.kind, within)]
    return marked.down([not r for r in right])


# ---- blocks ----------------------------------------------------------------------

class Block:
    """Text nodes of one block: path of its block elements, characters, those of
    them in links, punctuation outside links, and the weight of its marks."""

    __slots__ = ("path", "parts", "chars", "linked", "points", "weight")

    def __init__(self, path: Path, weight: float):
        self.path, self.parts, self.chars, self.linked, self.points, self.weight = path, [], 0, 0, 0, weight

    @property
    def is_links(self) -> bool:
        return 2 * self.linked > self.chars

    @property
    def key(self) -> tuple:
        """Marked blocks are scored apart from others of their path."""
        return self.path, self.weight


def text_blocks(page: str) -> list[Block]:
    """The blocks with text, in page order, that are not in an outside part."""
    nodes, marked = text_nodes(page)
    gone = outside(nodes, marked)
    blocks: dict[int, Block] = {}
    for path, number, text, mark, weight in nodes:
        if mark >= 0 and gone[mark]:
            continue
        block = blocks.get(number)
        if block is None:
            block = blocks[number] = Block(path.blocks, weight)
        block.parts.append(text)
        n = len(_SPACE.sub("", text))
        block.chars += n
        if path.in_link:
            block.linked += n
        else:
            block.points += len(PUNCTUATION.findall(text))
    return [b for b in blocks.values() if b.chars]


def _smooth(x: np.ndarray) -> np.ndarray:
    """Gaussian smoothing over the paths in page order."""
    if len(x) < 2:
        return x
    kernel = np.exp(-0.5 * (np.arange(-1, 2) / 0.5) ** 2)
    total = np.convolve(np.ones(len(x)), kernel, "full")[1:-1]
    return np.convolve(x, kernel, "full")[1:-1] / total


def path_scores(blocks: list[Block]) -> dict[tuple, float]:
    """Fused, smoothed ratios of every path with text, less for paths with little
    of the page's text; headings have none of their own unless the page has
    nothing else."""
    blocks = [b for b in blocks if not b.path.is_heading] or blocks
    all_links = all(b.chars == b.linked for b in blocks)
    sums: dict[tuple, list[int]] = {}
    for b in blocks:
        s = sums.setdefault(b.key, [0, 0, 0])
        s[0] += b.chars if all_links else b.chars - b.linked
        s[1] += b.points
        s[2] += 1
    length, points, count = np.array(list(sums.values()), float).T
    texts = np.minimum(length / count, FULL_TEXT)
    marks = np.minimum((points + 1) / count, FULL_POINTS)
    mass = np.minimum(length, FULL_MASS)
    mass = np.sqrt(np.sqrt(mass / mass.max()))
    fused = np.sqrt(_smooth(texts / texts.max()) * _smooth(marks / marks.max())) * mass
    return dict(zip(sums, fused.tolist()))


def block_scores(blocks: list[Block]) -> tuple[list[float], float]:
    """(score of each block, threshold): its path's ratio, more inside an article
    or main element unless it is mostly links, less by its marks; a heading outside
    has no score.  The threshold is the deviation of the paths' ratios, half of
    the largest at least."""
    scores = path_scores(blocks)
    values = np.array(list(scores.values()))
    limit = min(max(values.std(), values.max() / 2), values.max())
    none = -np.inf if limit <= 0 else 0.0
    return [scores.get(b.key, 0.0 if b.path.in_main else none) + (MAIN_WEIGHT if b.path.in_main and not b.is_links else 0.0)
            - b.weight for b in blocks], limit


def content_blocks(blocks: list[Block]) -> list[Block]:
    """The blocks of the main text."""
    scores, limit = block_scores(blocks)
    kept = [s >= limit for s in scores]
    at = [k for k, x in enumerate(kept) if x]
    if not at:
        return []
    # a first-level heading before the content begins it
    titles = [k for k in range(at[0]) if blocks[k].path.is_title]
    spans = [(titles[-1], at[0])] if titles else []
    for i, j in spans + list(zip(at, at[1:])):
        one, two = blocks[i], blocks[j]
        if j - i < 2:
            continue
        around = common(one.path.parent or one.path, two.path.parent or two.path)
        for k in range(i + 1, j):
            b = blocks[k]
            between = one.path.in_main and two.path.in_main and b.path.in_main or not b.is_links and around.holds(b.path)
            kept[k] = not b.path.is_heading and not b.weight and between
    for k in range(len(blocks) - 2, -1, -1):     # a heading belongs to what follows it
        kept[k] = kept[k] or blocks[k].path.is_heading and kept[k + 1]
    return [b for b, x in zip(blocks, kept) if x]


def main_text(page: str | None) -> str:
    """The article's blocks, one per line; empty if there is none."""
    if not page:
        return ""
    blocks = text_blocks(page)
    if not blocks:
        return ""
    root = blocks[0].path
    while root.parent:
        root = root.parent
    numbered(root)
    lines = (_SPACE.sub(" ", html.unescape("".join(b.parts))).strip() for b in content_blocks(blocks))
    return "\n".join(x for x in lines if x)


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per page row: id, the ``keep`` columns, text and n_chars.

    NULL and empty pages, and pages without content, have an empty text; broken
    and unclosed markup is read as browsers do where that matters for blocks;
    equal rows stay separate.  Pages of any length and nesting take time and memory
    in proportion; an empty table gives no rows; other columns are ignored.  One
    pass, no shuffle.
    """
    inner = free_prefix(pages) + "html"
    src = pages.select(F.col(id_col).alias("id"), *[c for c in keep], F.col(html_col).alias(inner))
    names = ["id", *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                b = batch.slice(k, 500)
                texts = [main_text(x) for x in b.column(inner).to_pylist()]
                yield with_columns(b, names, text=pa.array(texts, pa.string()),
                                   n_chars=pa.array([len(t) for t in texts], pa.int64()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields if f.name != inner)
    return src.mapInArrow(run, f"{fields}, text string, n_chars long")
