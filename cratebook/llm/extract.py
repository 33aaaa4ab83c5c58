"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks, the runs of text between block-level tags. Two classifiers give each
block a log-odds of being content: one over what the block looks like (length, links, closing
punctuation, kind of element), learned by counting on a bounded sample of pages whose markup is
explicit, and the markup itself (``main``, ``article``, ``nav``, ``aside``, telling class names).
The log-odds are the block's terminal capacity: to the source for content, to the sink for
boilerplate. Smoothness edges join blocks that follow each other, stronger the closer they lie
in the document tree, and blocks of one parent. The minimum cut labels the blocks; explicit
markup outweighs all edges of a block, so that the cut decides the others.
"""

from __future__ import annotations

import html as markup
import re
from collections import Counter, deque
from collections.abc import Iterator, Mapping, Sequence
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratebook.llm.common import col, slices

#: Pages that the looks of blocks are learned from, in the mean of a hash.
SAMPLE = 2000
#: Greatest log-odds by looks, and those of explicit markup.
LOOKS, EXPLICIT = 2.0, 6.0
#: Smoothness between neighbours in the page, and between blocks of one parent.
NEXT, SIBLING = 0.6, 0.4
#: Capacities are whole numbers of such parts.
UNIT = 1024

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_NAMED = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden|aria-hidden|style|href)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]*))?(?=[\s/>"']|$)""", re.I)
# Elements of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe noembed noframes object svg canvas audio video textarea select button".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
_CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_SCOPE = frozenset("ul ol dl table menu".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_KINDS = {**dict.fromkeys(("p", "blockquote", "pre", "figcaption", "dd"), 1), **dict.fromkeys(_HEADINGS, 2), **dict.fromkeys(("li", "td", "th", "dt"), 3)}
_OUTSIDE = frozenset("nav footer aside form dialog menu head title search".split())
_ROLES = {**dict.fromkeys("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split(), False), "main": True, "article": True}
_COMMENTS = re.compile(r"(?<![a-z])(?:comment|repl(?:y|ies)|respond|disqus|discussion|ads?(?![a-z])|advert|sponsor|promo|related|teaser|recommend)")
_BOILERPLATE = re.compile(
    _COMMENTS.pattern + r"|(?<![a-z])(?:banner|cookie|consent|gdpr|notices?(?![a-z])|notification|popup|modal|overlay|newsletter|subscri|signup|login|shar(?:e|ing)(?![a-z])"
    r"|social|side(?:bar)?(?![a-z])|widget|menu|nav(?![a-z])|navbar|navigation|breadcrumb|footer|copyright|legal|disclaimer|captcha"
    r"|trending|popular|tags(?![a-z])|pag(?:er|ination)(?![a-z])|toolbar|search|form(?![a-z])|alert|skip(?![a-z]))"
)
# A header is boilerplate unless it is the article's own.
_HEADER = re.compile(r"(?<![a-z])(?:header(?![a-z])|masthead|topbar)")
# What an element has beside itself, or lacks, says nothing of it.
_BESIDE = re.compile(r"(?<![a-z])(?:has|with|without|no)[-_ ]\S+")
_CONTENT = re.compile(r"(?<![a-z])(?:article|content|post|entry|story|main|body|text|prose)(?![a-z])")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_ENDS = tuple(".!?…:;。！？\"”»'’)")

#: (text, characters of it inside links, kind of element, parent, depth of the parent, evidence)
Block = tuple[str, int, int, int, int, float]


def _attributes(text: str) -> dict[str, str]:
    return {name.lower(): value.strip("\"'") for name, value in _NAMED.findall(text)}


def _evidence(tag: str, attributes: Mapping[str, str], above: tuple[float, bool]) -> tuple[float, bool]:
    """(log-odds, whether only ``main`` may lift them) inside an element, given those outside."""
    odds, firm = above
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(attributes.get("style", "")):
        return -EXPLICIT, True
    role = _ROLES.get(attributes.get("role", "").lower())
    names = _BESIDE.sub("", _CAMEL.sub(" ", f"{attributes.get('class', '')} {attributes.get('id', '')}").lower())
    if tag == "main" or role is True and tag != "article":
        return EXPLICIT, False
    if tag == "article":
        return (-EXPLICIT, True) if firm or _COMMENTS.search(names) else (EXPLICIT, False)
    if tag in _OUTSIDE or role is False or tag == "header" and odds <= 0:
        return -EXPLICIT, firm or tag != "form"
    if tag not in ("html", "body") and names.strip():
        if _BOILERPLATE.search(names) or odds <= 0 and _HEADER.search(names):
            return -EXPLICIT, firm or bool(_COMMENTS.search(names))
        if odds >= 0 and _CONTENT.search(names):
            return max(odds, EXPLICIT / 2), False
    return odds, firm


def _tags(page: str) -> Iterator[tuple[str, str, str, str]]:
    """(text before, "/" of an end tag, name, attributes); the last one has no name."""
    at = done = 0
    held: list[str] = []
    while (i := page.find("<", at)) >= 0:
        mark = page[i + 1 : i + 2]
        if page.startswith("<!--", i):
            end = page.find("-->", i + 4)
            end = len(page) if end < 0 else end + 3
        elif mark in ("!", "?") or mark == "/" and not page[i + 2 : i + 3].isalpha():
            end = page.find(">", i) + 1 or len(page)
        elif mark == "/" or mark.isascii() and mark.isalpha():
            tag = _TAG.match(page, i) or _PLAIN_TAG.match(page, i)
            if tag is None:  # cut off within its last tag
                held.append(page[done:i])
                done = len(page)
                break
            held.append(page[done:i])
            yield "".join(held), tag[1], tag[2].lower(), tag[3]
            held, at = [], tag.end()
            name = tag[2].lower()
            if not tag[1] and name in _RAW and not tag[3].endswith("/"):
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
                at = close.start() if close else len(page)
            done = at
            continue
        else:  # a lone sign is text
            at = i + 1
            continue
        held.append(page[done:i])
        at = done = end
    yield "".join([*held, page[done:]]), "", "", ""


def blocks_of(page: str) -> list[Block]:
    """The page's blocks in order, without those that are white space."""
    blocks: list[Block] = []
    # Open block-level elements: (tag, number, evidence). Inline elements end with their block.
    stack: list[tuple[str, int, tuple[float, bool]]] = [("", 0, (0.0, False))]
    open_tags: Counter[str] = Counter()
    parts: list[str] = []
    linked, in_link, number = 0, False, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                tag, _, (odds, _) = stack[-1]
                own = 2 if tag in _KINDS and len(stack) > 1 else 1
                blocks.append((text, linked, _KINDS.get(tag, 0), stack[-own][1], len(stack) - own, odds))
            parts.clear()
        linked = 0

    def pop(upto: int) -> None:
        for tag, _, _ in stack[upto:]:
            open_tags[tag] -= 1
        del stack[upto:]

    def close(names: set[str], stop: frozenset[str]) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in names:
                pop(k)
                return
            if stack[k][0] in stop:
                return

    for text, end, name, rest in _tags(page):
        if text:
            text = markup.unescape(text)
            parts.append(text)
            linked += len(text) if in_link else 0
        if name == "br":
            parts.append(" ")
        elif name == "a":
            in_link = not end
        elif name in _BLOCK:
            flush()
            in_link = False
            if end:
                if open_tags[name]:
                    close({name}, frozenset())
            elif name != "hr":
                if open_tags["p"]:
                    close({"p"}, frozenset())
                if name in _CLOSES and any(open_tags[t] for t in _CLOSES[name]):
                    close(_CLOSES[name], _SCOPE)
                number += 1
                stack.append((name, number, _evidence(name, _attributes(rest) if rest.strip() else {}, stack[-1][2])))
                open_tags[name] += 1
    flush()
    return blocks


def look(block: Block) -> int:
    """A number below 256 for what a block looks like."""
    text, linked, kind, *_ = block
    words = min(7, (text.count(" ") + 1).bit_length())
    links = min(3, int(4 * linked / max(1, len(text))))
    return words + 8 * links + 32 * text.endswith(_ENDS) + 64 * kind


def min_cut(odds: Sequence[int], edges: Mapping[tuple[int, int], int]) -> list[bool]:
    """Whether each node lies on the source's side of a minimum cut (of several the largest).

    A positive number is the capacity from the source, a negative one to the sink; ``edges``
    hold both ways. A node whose own capacity is no less than all its edges together lies on
    its terminal's side in some minimum cut, and is merged with it; max-flow does the rest.
    """
    n = len(odds)
    own = list(odds)
    around: list[dict[int, int]] = [{} for _ in range(n)]
    for (a, b), c in edges.items():
        around[a][b] = around[a].get(b, 0) + c
        around[b][a] = around[b].get(a, 0) + c
    total = [sum(x.values()) for x in around]
    side: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:
        v = todo.popleft()
        # On the sink's side only what gains by it: equal cuts leave nodes with the source.
        if side[v] is None and (own[v] >= total[v] or -own[v] > total[v]):
            side[v] = own[v] >= total[v]
            for w, c in around[v].items():
                if side[w] is None:
                    own[w] += c if side[v] else -c
                    total[w] -= c
                    todo.append(w)
    rest = [v for v in range(n) if side[v] is None]
    if rest:
        sink = _flow(rest, own, around, side)
        for v in rest:
            side[v] = v not in sink
    return [bool(s) for s in side]


def _flow(nodes: list[int], own: list[int], around: list[dict[int, int]], side: list[bool | None]) -> set[int]:
    """Nodes that still reach the sink when the flow is largest (blocking flows by distance)."""
    residual = {v: {w: c for w, c in around[v].items() if side[w] is None} for v in nodes}
    source = {v: own[v] for v in nodes if own[v] > 0}
    sink = {v: -own[v] for v in nodes if own[v] < 0}
    while True:
        # Distance to the sink, over edges that have capacity left.
        far = {v: 1 for v, c in sink.items() if c > 0}
        queue = deque(far)
        while queue:
            v = queue.popleft()
            for w in residual[v]:
                if w not in far and residual[w][v] > 0:
                    far[w] = far[v] + 1
                    queue.append(w)
        starts = [v for v, c in source.items() if c > 0 and v in far]
        if not starts:
            return set(far)
        ways = {v: iter(residual[v]) for v in far}
        for start in starts:
            while source[start] > 0:
                path = [start]
                while path:
                    v = path[-1]
                    if far[v] == 1 and sink.get(v, 0) > 0:
                        break
                    step = next((w for w in ways[v] if residual[v][w] > 0 and far.get(w, 0) == far[v] - 1 and far[v] > 1), None)
                    if step is None:
                        path.pop()
                    else:
                        path.append(step)
                if not path:
                    break
                hops = list(zip(path, path[1:], strict=False))
                sent = min([source[start], sink[path[-1]], *(residual[v][w] for v, w in hops)])
                source[start] -= sent
                sink[path[-1]] -= sent
                for v, w in hops:
                    residual[v][w] -= sent
                    residual[w][v] += sent
                    ways[v] = iter(residual[v])


def _edges(blocks: Sequence[Block]) -> dict[tuple[int, int], int]:
    """Smoothness: from block to block, halved for every two levels between their parents at
    least, and from a block to the one before of the same parent."""
    edges: dict[tuple[int, int], int] = {}
    last: dict[int, int] = {}
    for k, (_, _, _, parent, depth, _) in enumerate(blocks):
        if k:
            apart = 0 if blocks[k - 1][3] == parent else 1 + abs(blocks[k - 1][4] - depth)
            edges[k - 1, k] = int(UNIT * NEXT / 2 ** (apart / 2))
        if last.get(parent, k) < k - 1:
            edges[last[parent], k] = int(UNIT * SIBLING)
        last[parent] = k
    return edges


def main_text(page: str, odds: Sequence[float]) -> str:
    """The page's content blocks, joined by empty lines. ``odds``: log-odds by look."""
    blocks = blocks_of(page)
    own = [int(UNIT * (b[5] + odds[look(b)])) for b in blocks]
    kept = min_cut(own, _edges(blocks))
    return "\n\n".join(b[0] for b, k in zip(blocks, kept, strict=True) if k)


def fit(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE) -> list[float]:
    """Log-odds of content by look: blocks of about ``sample`` pages (chosen by a hash of their
    html) whose markup is explicit are counted in Spark; 256 counts of two kinds come back.

    What was never seen has the log-odds 0. Null pages count for nothing.
    """
    rows = pages.select(col(html_col).cast("string").alias("html")).where("html IS NOT NULL")
    n = rows.count()
    if n > sample:
        rows = rows.where(F.pmod(F.xxhash64("html"), F.lit(1 << 20)) < int((1 << 20) * sample / n))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[tuple[int, bool]] = Counter()
        for batch in batches:
            for page in batch.column(0):
                seen.update((look(b), b[5] > 0) for b in blocks_of(page.as_py()) if abs(b[5]) == EXPLICIT)
        keys = list(seen)
        yield pa.record_batch(
            [pa.array([k for k, _ in keys], pa.int32()), pa.array([c for _, c in keys], pa.bool_()), pa.array([seen[k] for k in keys], pa.int64())],
            ["look", "content", "n"],
        )

    found = rows.mapInArrow(count, "look int, content boolean, n long").groupBy("look", "content").agg(F.sum("n").alias("n"))
    counts = {(r["look"], r["content"]): r["n"] for r in found.collect()}
    ratio = [log((counts.get((k, True), 0) + 1) / (counts.get((k, False), 0) + 1)) for k in range(256)]
    return [max(-LOOKS, min(LOOKS, r)) for r in ratio]


def main_texts(
    pages: DataFrame, odds: Sequence[float], id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(<id_col>, <url_col>, text, n_chars): one row per row.

    Character references are decoded, white space inside a block becomes one space, blocks are
    joined by an empty line. Scripts, styles, comments of the markup, forms and hidden elements
    never count; tags that are cut off or not closed end with the page. A null or empty page, or
    one without content, has an empty text; one without any markup is content as a whole. A null
    id or url stays. Other columns are ignored, repeated rows answered each, an empty table
    gives none. ``odds`` come from ``fit``.
    """
    odds = list(odds)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "html"):
                texts = [main_text(page, odds) for page in batch.column(2).to_pylist()]
                yield pa.record_batch(
                    [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"]
                )

    rows = pages.select(
        col(id_col).cast("long").alias("id"), col(url_col).cast("string").alias("url"), F.coalesce(col(html_col).cast("string"), F.lit("")).alias("html")
    )
    return rows.mapInArrow(extract, "id long, url string, text string, n_chars long").withColumnsRenamed({"id": id_col, "url": url_col})
