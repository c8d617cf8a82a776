"""Main text of web pages by consensus host paths.

Each page votes: its containers are scored by the words of their own blocks, and the path of
generalised tag.class steps to the best one (to the article around it, if any) gets its vote. Votes
are counted in Spark per host; the path with most votes wins its host. Then every page is
extracted again from the containers on its host's winning path. Where these hold less than half of the words of
the page's own best container, or there are none, that one is taken as well, so no article is lost. Votes are pre-aggregated before their shuffle, so a host that
holds a third of all pages is a few rows.

A block is a run of text between block-level tags. Blocks inside menus, headers, footers,
sidebars, notices, adverts, forms and reader comments are left out wherever they stand, within
the winning container too. A class, id or role only marks such a part: it does not take out an
element that holds the article, or most of the words of a page without one.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import in_slices, sized_broadcast, stored

#: Fixed values of HTML: elements without an end tag, with raw content, and at block level.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre "
    "search section summary table tbody td tfoot th thead tr ul".split()
)
#: An open p ends before these.
ENDS_P = BLOCK - frozenset("body caption head html legend tbody td tfoot th thead tr".split())
#: An open element of the key's kind ends before the values, up to the nearest of the bounds.
ENDS_SAME = {
    "li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
    "option": ("option", ("select",)),
}
#: Elements that never hold main text.
LEFT_OUT = frozenset(
    "aside button canvas datalist dialog embed footer form head header iframe input label menu nav noembed "
    "noframes noscript object script select style svg template textarea title audio video math".split()
)
#: Words of class, id or role that mark such parts.
LEFT_OUT_NAMES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside rail widget "
    "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup "
    "login comment comments commentlist discussion disqus replies reply respond related recommended "
    "recommendations share sharing social toolbar pagination pager form search complementary contentinfo "
    "dialog skip hidden".split()
)
#: Marks that may hold most of a page's words and are left out all the same.
READERS = frozenset("comment comments commentlist discussion disqus replies reply respond".split())
#: Words that make a class tell of such a part rather than be one.
ABOUT = frozenset("has have no not non with without is overflow show shows hide hides enable disable".split())
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>|"
    # quotes count only behind an equals sign; what was taken is never given back
    r"<([a-zA-Z][^\s/>]*)((?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+)>|"
    # a tag that the page ends in
    r"<[a-zA-Z/!?][^>]*\Z",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'>][^\s>]*)))?")
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[a-z]+")


@dataclass
class Node:
    tag: str
    path: str
    out: bool
    #: how much of its class, id or role is a mark: 0 nothing, 1 a part, 2 a whole word, 3 reader comments
    mark: int = 0
    parent: int = -1
    #: score: words of its own blocks twice, and once those of the containers it holds
    words: int = 0


@dataclass
class Page:
    """Blocks in page order with the containers around them, and all containers with their scores."""

    blocks: list[tuple[str, tuple[int, ...]]] = field(default_factory=list)
    nodes: list[Node] = field(default_factory=list)
    #: whether each block has words outside links
    plain: list[bool] = field(default_factory=list)


def _names(attributes: str) -> tuple[list[str], bool]:
    """Words of class, id and role; whether the element is hidden."""
    words, hidden = [], False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name == "hidden" or (name == "aria-hidden" and (a or b or c).lower() == "true"):
            hidden = True
        elif name in ("class", "id", "role"):
            words += (a or b or c).lower().split()
    return words, hidden


def _marked(words: list[str]) -> int:
    """A whole word, or its first or last part, marks a part to leave out; see ``Node.mark``."""
    mark = 0
    for word in words:
        parts = _NAME.findall(word)
        if not parts or not ABOUT.isdisjoint(parts):
            continue
        ends = {parts[0], parts[-1]}
        if not READERS.isdisjoint(ends):
            mark = 3
        elif len(parts) == 1 and parts[0] in LEFT_OUT_NAMES:
            mark = max(mark, 2)
        elif not (LEFT_OUT_NAMES - {"hidden"}).isdisjoint(ends):
            mark = max(mark, 1)
    return mark


def _step(tag: str, words: list[str]) -> str:
    """A generalised step: the tag and its first class, digits and numbering taken out."""
    name = next((re.sub(r"[-_]*\d+", "", w) for w in words if re.sub(r"[-_]*\d+", "", w)), "")
    return f"{tag}.{name}" if name else tag


def parse(text: str | None) -> Page:
    """One pass over the tags. Unclosed and stray tags are mended as browsers do in simple cases."""
    page = Page()
    stack: list[int] = []
    run: list[str] = []
    text = text or ""
    plain = False
    root = Node("", "", False)
    page.nodes.append(root)
    stack.append(0)

    def flush() -> None:
        nonlocal plain
        if run:
            joined = _SPACE.sub(" ", html.unescape("".join(run))).strip()
            run.clear()
            if joined and not page.nodes[stack[-1]].out:
                page.blocks.append((joined, tuple(stack)))
                page.plain.append(plain)
        plain = False

    def take(piece: str) -> None:
        nonlocal plain
        run.append(piece)
        plain = plain or bool(piece.strip() and not any(page.nodes[k].tag == "a" for k in stack))

    def close(upto: int) -> None:
        flush()
        del stack[upto:]

    def open_(tag: str, attributes: str) -> None:
        parent = page.nodes[stack[-1]]
        words, hidden = _names(attributes) if attributes else ([], False)
        out = parent.out or hidden or tag in LEFT_OUT
        mark = 0 if tag in ("html", "body", "article", "main") else _marked(words)
        if out != parent.out or mark:
            flush()
        page.nodes.append(Node(tag, f"{parent.path}/{_step(tag, words)}", out, mark, stack[-1]))
        stack.append(len(page.nodes) - 1)

    at = 0
    while at < len(text):
        m = _TAG.search(text, at)
        if m is None:
            take(text[at:])
            break
        if m.start() > at:
            take(text[at : m.start()])
        at = m.end()
        end, tag = m[1], m[2]
        if tag:
            tag = tag.lower()
            if tag in BLOCK:
                flush()
            if tag in ENDS_P:
                k = _find(page, stack, {"p"}, {"table", "td", "th", "button", "div", "article", "section", "li"})
                if k:
                    close(k)
            if tag in ENDS_SAME:
                kinds, bounds = ENDS_SAME[tag]
                while k := _find(page, stack, set(kinds.split()), set(bounds)):
                    close(k)
            if tag == "br":
                run.append(" ")
            if tag in VOID or m[3].endswith("/"):
                continue
            if tag in RAW:
                stop = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(text, at)
                at = stop.end() if stop else len(text)
                continue
            open_(tag, m[3])
        elif end:
            end = end.lower()
            if end in BLOCK:
                flush()
            k = _find(page, stack, {end}, set() if end in BLOCK else BLOCK)
            if k:
                if end in BLOCK or page.nodes[stack[k]].out or any(page.nodes[j].mark for j in stack[k:]):
                    close(k)
                else:
                    del stack[k:]
    flush()
    _leave_out(page)
    return page


def _below(page: Page) -> list[int]:
    """Words below each node."""
    words = [0] * len(page.nodes)
    for text, above in page.blocks:
        words[above[-1]] += len(text.split())
    for k in range(len(words) - 1, 0, -1):
        words[page.nodes[k].parent] += words[k]
    return words


def _leave_out(page: Page) -> None:
    """Take out what marked elements hold, but for those that hold the text; score the containers."""
    nodes = page.nodes
    if any(n.mark for n in nodes):
        words = _below(page)
        article = [n.tag in ("article", "main") and not n.out and words[k] > 0 for k, n in enumerate(nodes)]
        for k in range(len(nodes) - 1, 0, -1):
            article[nodes[k].parent] |= article[k]
        for k, n in enumerate(nodes[1:], 1):
            if n.mark and not article[k]:
                most = {1: 2 * words[k] > words[0], 2: 5 * words[k] >= 4 * words[0], 3: False}[n.mark]
                n.out |= article[0] or not most
            n.out |= nodes[n.parent].out
        kept = [not nodes[above[-1]].out for _, above in page.blocks]
        page.plain = [p for p, keep in zip(page.plain, kept, strict=True) if keep]
        page.blocks = [b for b, keep in zip(page.blocks, kept, strict=True) if keep]
    for text, above in page.blocks:
        n = len(text.split())
        # a paragraph counts for what holds it and, by half, for the next container
        for weight, at in zip((2, 1), [k for k in reversed(above) if nodes[k].tag not in _LEAVES][:2], strict=False):
            nodes[at].words += weight * n


#: Blocks that are leaves of a container rather than containers.
_LEAVES = frozenset(
    "p h1 h2 h3 h4 h5 h6 pre blockquote li dt dd td th a b i em strong span u small sub sup code q cite "
    "figcaption caption summary font mark time abbr s del ins tr tbody thead ul ol dl table".split()
)


def _find(page: Page, stack: list[int], tags: set[str], bounds) -> int:
    """Place in the stack of the innermost open element of ``tags`` within ``bounds``, or 0."""
    for k in range(len(stack) - 1, 0, -1):
        tag = page.nodes[stack[k]].tag
        if tag in tags:
            return k
        if tag in bounds:
            return 0
    return 0


def best_path(page: Page) -> str:
    """Path of the page's best container; '' without any text."""
    at = max(range(len(page.nodes)), key=lambda k: page.nodes[k].words)
    best = page.nodes[at]
    if not best.words:
        return ""
    # the whole article, if the text's container is a part of one
    steps = best.path.split("/")
    for tag in ("article", "main"):
        for k, step in enumerate(steps):
            if step.split(".")[0] == tag:
                return "/".join(steps[: k + 1])
    # an article may be split over siblings: up to what holds all real text around, below the body
    texts = [0] * len(page.nodes)
    for plain, (_, above) in zip(page.plain, page.blocks, strict=True):
        texts[above[-1]] += plain
    for k in range(len(texts) - 1, 0, -1):
        texts[page.nodes[k].parent] += texts[k]
    up = page.nodes[at].parent
    while up > 0 and page.nodes[up].tag not in ("html", "body"):
        if texts[up] > texts[at]:
            at = up
        up = page.nodes[up].parent
    return page.nodes[at].path


#: The host's containers are enough if they hold this share of the words that the page's own best one holds.
ENOUGH = 0.5


def main_text(page: Page, path: str) -> str:
    """Blocks below the containers on ``path``, and those of the page's own best one if ``path`` lacks most.

    A host's path may hold a few words of a page whose article stands elsewhere; then the blocks of both
    are the text, in page order.
    """

    def below(wanted: str) -> dict[int, int]:
        on = {k for k, n in enumerate(page.nodes) if n.path == wanted and not n.out}
        return {i: len(text.split()) for i, (text, above) in enumerate(page.blocks) if on.intersection(above)}

    kept, own = below(path), below(best_path(page))
    if not kept or sum(kept.values()) < ENOUGH * sum(own.values()):
        kept |= own
    return "\n\n".join(page.blocks[i][0] for i in sorted(kept))


def host_of(url) -> F.Column:
    """Host in lower case without port and user; '' for a null or odd address."""
    rest = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(rest)


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` less ``html``, with text and n_chars; one row for each input row.

    Null or empty html and pages of nothing but left-out parts give the empty text. Pages without
    a host vote together under ''. Ties of votes go to the longer, then the first path. Repeated
    pages vote as often as they occur. Columns named text, n_chars are replaced.
    """
    base = pages.drop("text", "n_chars", "_host", "_path").withColumn("_host", host_of(F.col("url")))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 256):
            paths = [best_path(parse(h)) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_host"), pa.array(paths, pa.string())], names=["_host", "_path"])

    votes = (
        base.select("_host", F.col("html").cast("string").alias("html"))
        .mapInArrow(vote, "_host string, _path string")
        .where("_path <> ''")
        .groupBy("_host", "_path")
        .agg(F.count(F.lit(1)).alias("votes"))
    )
    order = Window.partitionBy("_host").orderBy(F.desc("votes"), F.desc(F.length("_path")), "_path")
    winners = votes.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").select("_host", "_path")
    winners = stored(winners, "host-paths")
    names = [c for c in base.columns if c not in ("html", "_host")]
    kept = base.join(sized_broadcast(winners, 256, winners.count()), "_host", "left").select(*[F.col(f"`{c}`") for c in names], "_path", F.col("html").cast("string").alias("html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 256):
            found = [
                main_text(parse(h), path or "")
                for h, path in zip(batch.column("html").to_pylist(), batch.column("_path").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                names=[*names, "text", "n_chars"],
            )

    return kept.mapInArrow(run, f"{schema}, text string, n_chars long")
