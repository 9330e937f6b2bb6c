"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks of text. A linear classifier over a block's place in the
document, its link density, length and names of its containers gives the cost of calling
it content or boilerplate; these are the capacities to the two terminals. Neighbouring
blocks, and blocks that follow each other under one parent, are tied by smoothness
edges. The maximum flow separates content from boilerplate at the least total cost.
"""

from __future__ import annotations

import html
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame

# Names of elements and of containers, as web pages use them.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Up to the end tag their content is text, whatever stands in it.
RAW_TAGS = frozenset("script style textarea title iframe".split())
#: Elements that show no text of the page; they end with their end tag or their parent.
DROPPED_TAGS = frozenset("template noscript object svg select button canvas audio video".split())
_NESTED = frozenset("template object svg".split())  # may stand inside their own kind
BOILERPLATE_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
CONTENT_TAGS = frozenset("article main".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs byline comment comments cookie cookies consent disqus footer "
    "header masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo related respond replies reply "
    "share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
CONTENT_NAMES = frozenset("article content entry main post story text".split())

# A quote opens a value only after an equals sign; a value without quotes ends at white space.
_VALUE = r"=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+)"
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:{_VALUE}|[^>=])*+)(?:>|\Z)", re.S)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_SPACE = re.compile(r"\s+")
_UNIT = 100  # capacities are whole numbers
#: Containers of the page or its article: their names tell of the layout, not of a block.
_WHOLE_TAGS = frozenset("html body main article".split())
_NEAREST = 2  # containers with names that speak against a block


# Parts of compound names that tell of form, of what a page has, or of a whole layout.
_FORM_NAMES = frozenset(
    "area articles bar block body bottom box col column container group inner item items left links list outer panel posts primary right row secondary "
    "section thread top tree wrap wrapper".split()
)
_STATE_NAMES = frozenset("has with without no is show hide open closed enabled disabled count off on free".split())
_LAYOUT_NAMES = frozenset("container layout wrap wrapper".split())
_READER_NAMES = frozenset("comment comments disqus replies reply respond".split())
_OWN_NAMES = frozenset("header footer banner byline masthead".split())  # an article may have its own


def _name_against(name: str) -> float:
    """How much one name speaks for boilerplate: by what it names last, apart from words of form."""
    parts = [part for part in _SPLIT.split(name) if part]
    if not parts or parts[0] in _STATE_NAMES:
        return 0.0
    content = bool(CONTENT_NAMES.intersection(parts))
    if parts[-1] in _LAYOUT_NAMES and content:
        return 0.0
    if _READER_NAMES.intersection(parts) and parts[-1] not in _STATE_NAMES:
        return 3.5
    head = next((part for part in reversed(parts) if part not in _FORM_NAMES), parts[-1])
    if head in BOILERPLATE_NAMES:
        return 0.0 if content and head in _OWN_NAMES else 3.5
    return 0.3 if BOILERPLATE_NAMES.intersection(parts) and not content else 0.0


def _against(names: frozenset) -> float:
    """How much a container's names speak for boilerplate; a name of content beside them outweighs all but readers' comments."""
    most = max(map(_name_against, names), default=0.0)
    readers = any(_READER_NAMES.intersection(_SPLIT.split(name)) for name in names)
    return 0.0 if names & CONTENT_NAMES and not readers else most


class _Block:
    __slots__ = ("text", "linked", "path", "names", "against", "parent", "tag")

    def __init__(self, text: str, linked: int, stack: list[tuple[str, frozenset, int]]):
        self.text, self.linked = text, linked
        self.path = {s[0] for s in stack}
        self.names = frozenset(part for s in stack for name in s[1] for part in _SPLIT.split(name))
        kept = [s for s in stack if s[0] in BLOCK_TAGS]
        named = [s[1] for s in kept if s[1] and s[0] not in _WHOLE_TAGS]
        self.against = max((_against(names) for names in named[-_NEAREST:]), default=0.0)
        self.tag = kept[-1][0] if kept else ""
        self.parent = kept[-2][2] if len(kept) > 1 else 0


def blocks(page: str) -> list[_Block]:
    """Blocks of a page in order; broken and cut-off markup is read as far as it goes."""
    out: list[_Block] = []
    stack: list[tuple[str, frozenset, int]] = []
    parts: list[tuple[str, bool]] = []
    at, number, links, hidden = 0, 0, 0, 0
    last_end: dict[str, int] = {}

    def pop() -> str:
        nonlocal links, hidden
        tag = stack.pop()[0]
        links = max(0, links - (tag == "a"))
        hidden -= tag in DROPPED_TAGS
        return tag

    def open_ended(tag: str) -> bool:
        """Whether no end tag of an open dropped element is ahead: a block then ends it."""
        if tag not in last_end:
            last_end[tag] = max((m.start() for m in re.finditer(rf"</{tag}\b", page, re.I)), default=-1)
        if last_end[tag] < at or tag in _NESTED:
            return last_end[tag] < at
        return re.compile(rf"<(/?){tag}\b", re.I).search(page, at)[1] == ""

    def flush() -> None:
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(p for p, _ in parts))).strip()
            if text:
                out.append(_Block(text, sum(len(p) for p, linked in parts if linked), stack))
            parts.clear()

    while True:
        found = _TOKEN.search(page, at)
        plain = page[at : found.start()] if found else page[at:]
        if plain and not hidden:
            parts.append((plain, links > 0))
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue
        closing, tag = found[1], found[2].lower()
        if tag in RAW_TAGS and not closing:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag == "br":
            if not hidden:
                parts.append((" ", False))
            continue
        if found[3].endswith("/") and (hidden or tag in DROPPED_TAGS or any(t[0] == "math" for t in stack)):
            continue
        if tag in BLOCK_TAGS and tag != "option" and not closing:
            while hidden and open_ended(inner := next(t[0] for t in reversed(stack) if t[0] in DROPPED_TAGS)):
                while pop() != inner:
                    pass
        if closing and hidden:  # the end of a parent ends what is dropped
            first = next(k for k, t in enumerate(stack) if t[0] in DROPPED_TAGS)
            if any(t[0] == tag for t in stack[:first]) and not any(t[0] == tag for t in stack[first:]):
                while hidden:
                    pop()
        if tag in BLOCK_TAGS and not hidden:
            flush()
        if closing:
            if any(t[0] == tag for t in stack):
                while pop() != tag:
                    pass
        elif tag not in VOID_TAGS:
            if tag in BLOCK_TAGS and not hidden and any(t[0] == "p" for t in stack):  # a block closes an open paragraph
                while pop() != "p":
                    pass
            number += 1
            names = [w for m in _NAMES.finditer(found[3]) for w in (m[1] or m[2] or m[3] or "").lower().split()]
            stack.append((tag, frozenset(names), number))
            links += tag == "a"
            hidden += tag in DROPPED_TAGS
    flush()
    return out


def content_score(block: _Block) -> int:
    """Cost of calling the block boilerplate (positive) or content (negative)."""
    words = block.text.count(" ") + 1
    inside = bool(block.path & CONTENT_TAGS)
    score = 2.0 if inside else -0.5
    score -= 8.0 * bool(block.path & BOILERPLATE_TAGS)
    score -= 8.0 * bool("header" in block.path and not inside)
    score -= block.against
    score += 1.0 * bool(block.names & CONTENT_NAMES)
    score += {"p": 0.5, "li": -0.2, "blockquote": 0.5, "pre": 0.5, "td": -0.2}.get(block.tag, 0.5 if block.tag[:1] == "h" and inside else 0.0)
    score -= 3.0 * min(1.0, block.linked / max(len(block.text), 1))
    score += min(words, 40) / 40
    score -= 3.0 * block.text.startswith("©")
    return int(score * _UNIT)


def minimum_cut(scores: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay with the content terminal when the graph is cut at the least cost."""
    n = len(scores)
    source, sink = n, n + 1
    heads: list[list[int]] = [[] for _ in range(n + 2)]
    to, room = [], []

    def edge(a: int, b: int, forward: int, backward: int) -> None:
        heads[a].append(len(to))
        heads[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((forward, backward))

    for k, score in enumerate(scores):
        if score > 0:
            edge(source, k, score, 0)
        elif score < 0:
            edge(k, sink, -score, 0)
    for a, b, weight in edges:
        edge(a, b, weight, weight)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in heads[a]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[k] >= 0 for k in range(n)]
        following, path, a = [0] * (n + 2), [], source
        while True:  # augment along levels
            if a == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                cut = next(k for k, e in enumerate(path) if not room[e])
                a = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while following[a] < len(heads[a]):
                e = heads[a][following[a]]
                if room[e] and level[to[e]] == level[a] + 1:
                    break
                following[a] += 1
            if following[a] < len(heads[a]):
                path.append(heads[a][following[a]])
                a = to[path[-1]]
            elif path:
                a = to[path.pop() ^ 1]
                following[a] += 1
            else:
                break


def main_text(page: str | None) -> str:
    """The content blocks of a page, one a line."""
    found = blocks(page or "")
    if not any(b.path for b in found):  # no markup: all of it is text
        return "\n".join(b.text for b in found)
    edges, last = [], {}
    for k, block in enumerate(found):
        if k:
            edges.append((k - 1, k, 15))
        if (before := last.get(block.parent)) is not None:
            edges.append((before, k, 30))
        last[block.parent] = k
    kept = minimum_cut([content_score(b) for b in found], edges)
    return "\n".join(b.text for b, keep in zip(found, kept, strict=True) if keep)


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages``.

    The whole ``html`` counts; null counts as empty and gives an empty text. Other nulls
    pass through, repeated rows repeat, an empty table gives no rows, and other columns
    are ignored. A tie in the cut calls a block boilerplate.
    """
    source = pages.select("page_id", "url", "html")

    def run(batches):
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    return source.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
