"""Main text of web pages by tag-path ratios.

A page is read once into blocks of text, each under the path of its block
elements from the root. Text length (without links) and punctuation are summed
by path and divided by the path's blocks; both ratios are smoothed over the
blocks in page order and fused into one score a path, with the path's share of
the page's text and what article elements hold as further terms; paths above a
share of the page's greatest score are content. What a path's elements say of
themselves (navigation, advert, form ...) takes part in the score as a weight:
0.3 on pages with text enough for ratios to tell, less on short ones, and none
where it holds most of the page's text. Reader comments are prose as the article
is, which no ratio tells apart, so their names weigh more. Headings, captions,
list items and short paragraphs that are not so marked join the content that
they stand with.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

from pyspark.sql import DataFrame

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|title|select|svg|iframe|object)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|\Z)|<[!?/][^>]*>", re.S | re.I)
ATTRIBUTE = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a following one of the listed kinds closes; `p` is closed by every block element.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: An open element of these bounds what an implied end closes.
BOUNDS = frozenset("article aside body blockquote div dl footer form header html li main nav ol section table td ul".split())
#: Elements of text: what they stand in is their container, by which short ones are judged.
TEXTUAL = frozenset("blockquote dd dl dt figcaption figure h1 h2 h3 h4 h5 h6 header hgroup li ol p pre ul".split())
LISTS = frozenset("dl ol table ul".split())
ITEMS = frozenset("dd dt li td th".split())
#: Elements that are hardly ever content, and those that may yet hold most of a page.
SELDOM = frozenset("head nav menu dialog button".split())
MARKED = frozenset("header footer aside form".split())
#: Short blocks of these join content in their container.
JOINING = frozenset("p blockquote pre figcaption".split())
ARTICLE = frozenset(("article", "main"))
#: Words of class, id or role that mark an element; `has-sidebar` and `entry-header` say other things.
OTHER = re.compile(
    r"(?:^|[\s_-])(?<!has[_-])(?<!with[_-])(?<!no[_-])(?:ads?|adverts?|advertisement|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|(?<!entry[_-])(?<!post[_-])(?<!article[_-])(?<!story[_-])(?<!content[_-])header|masthead|menu|nav|navbar|navigation|newsletter|notices?|pagination|popup|promo|replies|reply|respond|share|sharing|sidebar|social|sponsor(?:ed)?|subscribe|toolbar|widget)(?:$|[\s_-])", re.I)
#: Words of class, id or role that may name other pages' teasers or a part of the article.
MILD = re.compile(r"(?:^|[\s_-])related(?:$|[\s_-])", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…。、，；：！？]")
#: Of these, the words that mark what readers wrote.
READERS = re.compile(r"(?:^|[\s_-])(?:comments?|disqus|replies|reply|respond)(?:$|[\s_-])", re.I)
#: Neighbours on either side that smooth a block's ratios, and the share of the best score that content needs.
REACH, NEEDED = 2, 0.12
#: What being marked makes of a score: as a reader's comment, otherwise, and mildly.
FAINT, MARKED_SCORE, MILDER = 0.02, 0.3, 0.35
#: With so many characters of unmarked text a page's ratios are trusted by half: marks weigh twice as much there.
TRUST = 500
#: A marked element that holds r times the text of the rest of the page weighs this times r squared, at most 1, if that is above FAINT.
MARKED_WEIGHT = 0.002
#: What an article element that holds all text adds to the score of its paths.
ARTICLE_GAIN = 1


class Path(NamedTuple):
    """The elements of one label under one parent path; `mark` is what their names make of their score (1: nothing)."""

    mark: float
    inside: bool
    label: str
    parent: int


class Element(NamedTuple):
    """An open element: its path, and the serial numbers of its container, outermost list, the container of that, and outermost article (0: none)."""

    tag: str
    path: int
    serial: int
    container: int
    group: int
    home: int
    article: int


class Block(NamedTuple):
    """A run of text; `linked` of its characters stand in links."""

    path: int
    text: str
    linked: int
    element: Element


def blocks(page: str) -> tuple[list[Block], list[Path], list[tuple[str, int, int]]]:
    """The blocks in page order, the paths, and of each element its tag and the blocks it spans."""
    paths = [Path(1.0, False, "", 0)]
    root = Element("", 0, 0, 0, 0, 0, 0)
    known: dict[tuple[int, str], int] = {}
    stack: list[Element] = []
    # Places in the stack of each open element by its tag, and of those that bound an implied end.
    open_at: dict[str, list[int]] = {}
    bounds: list[int] = []
    found: list[Block] = []
    spans: list[tuple[str, int, int]] = [("", 0, 0)]
    run: list[str] = []
    linked, link_at = 0, -1

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join(unescape("".join(run)).split())
            run.clear()
            if text:
                here = stack[-1] if stack else root
                found.append(Block(here.path, text, min(linked, len(text)), here))
            linked = 0

    def close(tag: str) -> None:
        nonlocal link_at
        while stack:
            top = stack.pop()
            open_at[top.tag].pop()
            if top.tag in BOUNDS:
                bounds.pop()
            spans[top.serial] = (top.tag, spans[top.serial][1], len(found))
            if len(stack) < link_at:
                link_at = -1
            if top.tag == tag:
                return

    def implied(tags: set[str]) -> None:
        at = max((open_at[t][-1] for t in tags if open_at.get(t)), default=-1)
        if at >= 0 and (not bounds or at >= bounds[-1]):
            close(stack[at].tag)

    def add(text: str) -> None:
        nonlocal linked
        run.append(text)
        if link_at >= 0:
            linked += len(" ".join(unescape(text).split()))

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                link_at = len(stack) if not m[2] and "href" in m[4].lower() else -1
            continue
        flush()
        if m[2]:
            if open_at.get(tag):
                close(tag)
        elif tag not in VOID:
            implied({"p"})
            if tag in CLOSES:
                implied(CLOSES[tag])
            words = " ".join(x for a in ATTRIBUTE.findall(m[4]) for x in a if x) if m[4] else ""
            up = stack[-1] if stack else root
            label = f"{tag}.{words}"
            if (up.path, label) not in known:
                above = paths[up.path]
                frame = tag in ("html", "body") or tag == "header" and above.inside
                marked = not frame and (tag in MARKED or tag in SELDOM or OTHER.search(words))
                known[up.path, label] = len(paths)
                mark = FAINT if marked and READERS.search(words) else MARKED_SCORE if marked else MILDER if MILD.search(words) and not frame else 1.0
                paths.append(Path(mark, above.inside or tag in ARTICLE, label, up.path))
            if not m[4].rstrip().endswith("/"):
                serial = len(spans)
                spans.append((tag, len(found), -1))
                stack.append(Element(
                    tag, known[up.path, label], serial, up.container if tag in TEXTUAL else serial, up.group or (serial if tag in LISTS else 0), up.home if up.group else up.container, up.article or (serial if tag in ARTICLE else 0)))
                open_at.setdefault(tag, []).append(len(stack) - 1)
                if tag in BOUNDS:
                    bounds.append(len(stack) - 1)
    add(page[at:])
    flush()
    spans[0] = ("", 0, len(found))
    return found, paths, [(tag, a, len(found) if b < 0 else b) for tag, a, b in spans]


def weights(found: list[Block], paths: list[Path]) -> tuple[list[float], list[bool]]:
    """What the marks of a path's elements make of its score, and whether it is unmarked.

    The weight is the product of the marks, each nearer to 1 the more of the
    page's text its element holds, and smaller the less unmarked text there is.
    """
    own = [0] * len(paths)
    for b in found:
        own[b.path] += len(b.text) - b.linked
    held = list(own)
    for i in range(len(paths) - 1, 0, -1):
        held[paths[i].parent] += held[i]
    much, plain = [0.0], [True]
    for i, p in enumerate(paths[1:], 1):
        rest = held[0] - held[i]
        most = MARKED_WEIGHT * (held[i] / rest) ** 2 if rest else 1.0
        much.append(most if held[i] > rest and most > FAINT else 0.0)
        plain.append(plain[p.parent] and (p.mark > MARKED_SCORE or much[i] > 0))
    sure = sum(n for n, ok in zip(own, plain, strict=True) if ok) ** 2
    trust = sure / (sure + TRUST**2)
    out = [1.0]
    for i, p in enumerate(paths[1:], 1):
        mark = p.mark if p.mark > MARKED_SCORE else p.mark * trust
        out.append(out[p.parent] * (min(1.0, max(mark, much[i])) if p.mark < 1 else 1.0))
    return out, plain


def smoothed(values: list[float]) -> list[float]:
    """Means over REACH neighbours on either side, the nearer ones weighing more."""
    out = []
    for i in range(len(values)):
        near = range(max(0, i - REACH), min(len(values), i + REACH + 1))
        weights = [1 / (1 + abs(i - j)) for j in near]
        out.append(sum(w * values[j] for w, j in zip(weights, near, strict=True)) / sum(weights))
    return out


def level(block: Block) -> int:
    """1 to 6 of a heading, else 0."""
    tag = block.element.tag
    return int(tag[1]) if len(tag) == 2 and tag[0] == "h" and tag[1] in "123456" else 0


def with_short(found: list[Block], fit: list[bool], core: list[bool], spans: list[tuple[str, int, int]]) -> list[bool]:
    """`core` and the short blocks that belong to it by their place.

    A heading belongs if its section has content, within its container or at
    once. Paragraphs belong to content in their container, items to content
    before them in their container or on both sides of their list. What is
    mostly links does not belong.
    """
    chosen = list(core)
    direct = {b.element.container for b, ok in zip(found, core, strict=True) if ok}
    for i, b in enumerate(found):
        if chosen[i] or not fit[i] or not level(b):
            continue
        frame = spans[b.element.container][0] in ("", "html", "body")
        end, first = spans[b.element.container][2], True
        for j in range(i + 1, len(found)):
            if level(found[j]):
                if level(found[j]) <= level(b):
                    break
            elif fit[j]:
                chosen[i] = core[j] and (first or j < end and (not frame or found[j].element.container == b.element.container))
                first = False
                if chosen[i]:
                    break
    before, sides = {}, {}
    for i, b in enumerate(found):
        e = b.element
        home = e.home if e.group else e.container
        if fit[i] and not chosen[i] and 2 * b.linked < len(b.text) and (e.tag in ITEMS or e.tag in JOINING):
            if not e.group:
                chosen[i] = e.container in direct
            else:
                if e.group not in sides:
                    _, start, end = spans[e.group]
                    ahead = next((j for j in range(end, len(found)) if fit[j]), -1)
                    behind = next((j for j in range(start - 1, -1, -1) if fit[j]), -1)
                    sides[e.group] = ahead >= 0 and behind >= 0 and chosen[ahead] and chosen[behind]
                chosen[i] = sides[e.group] or e.group != before.get(home, e.group)
        if chosen[i] and before.get(home) in (None, e.group):
            before[home] = e.group or -1
    return chosen


def scores(found: list[Block], weight: list[float]) -> dict[int, float]:
    """Of each path that has blocks, its fused score."""
    sums: dict[int, list[int]] = {}
    for b in found:
        x = sums.setdefault(b.path, [0, 0, 0])
        x[0] += len(b.text) - b.linked
        x[1] += len(PUNCTUATION.findall(b.text))
        x[2] += 1
    whole = sum(n_chars for n_chars, _, _ in sums.values()) or 1
    by_length = smoothed([sums[b.path][0] / sums[b.path][2] for b in found])
    by_marks = smoothed([sums[b.path][1] / sums[b.path][2] for b in found])
    near: dict[int, float] = {}
    for b, x, y in zip(found, by_length, by_marks, strict=True):
        near[b.path] = near.get(b.path, 0.0) + x * (1 + y) / sums[b.path][2]
    of_article = article_terms(found)
    # A path's own ratios and its smoothed ones weigh the same.
    return {p: weight[p] * of_article[p] * n_chars / whole * (near[p] * n_chars / n * (1 + marks / n)) ** 0.5 for p, (n_chars, marks, n) in sums.items()}


def article_terms(found: list[Block]) -> dict[int, float]:
    """Of each path, 1 and ARTICLE_GAIN times the mean share of the text that its blocks' article elements hold."""
    held: dict[int, int] = {}
    for b in found:
        held[b.element.article] = held.get(b.element.article, 0) + len(b.text)
    whole = sum(held.values()) or 1
    sums: dict[int, list[float]] = {}
    for b in found:
        x = sums.setdefault(b.path, [0.0, 0])
        x[0] += held[b.element.article] / whole if b.element.article else 0.0
        x[1] += 1
    return {p: 1 + ARTICLE_GAIN * x / n for p, (x, n) in sums.items()}


def content_paths(found: list[Block], weight: list[float]) -> set[int]:
    """The paths whose score is a share of NEEDED of the greatest, or more."""
    best = scores(found, weight)
    top = max(best.values())
    return {p for p, score in best.items() if 0 < score >= NEEDED * top}


def main_text(page: str | None) -> str:
    """The article's text; empty for null or empty pages and those without content."""
    found, paths, spans = blocks(page or "")
    if not found:
        return ""
    weight, plain = weights(found, paths)
    chosen = content_paths(found, weight)
    core = [b.path in chosen for b in found]
    # Short blocks join by their place unless they are marked.
    fit = [plain[b.path] or ok for b, ok in zip(found, core, strict=True)]
    return " ".join(b.text for b, ok in zip(found, with_short(found, fit, core, spans), strict=True) if ok)


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of each row's html.

    Null html counts as empty and gives an empty text; null ids and urls stay
    null; repeated rows stay rows; no rows give no rows.
    """
    def extract(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [main_text(h) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.selectExpr("cast(page_id as long) page_id", "cast(url as string) url", "cast(html as string) html").mapInArrow(extract, "page_id long, url string, text string, n_chars long")
