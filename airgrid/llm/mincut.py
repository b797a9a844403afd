"""Main text of web pages by minimum-cut labelling.

A page is read into blocks: runs of text between block-level tags. A linear classifier gives each block a score (above 0:
content). Its size becomes the block's capacity to the source (content) or to the sink (boilerplate); edges between
blocks that stand next to each other, and between neighbours under the same parent element, make it cost something to
label them differently. The maximum flow's minimum cut is the cheapest labelling; its source side is the text.

What an element's name, class or role says against its text is a finite weight that fades with each level below it. A
wrapper says nothing where it holds most of the page's prose, and an article inside it lifts half of what it says. Links
weigh less inside an article than elsewhere, and text beside an article weighs less than text of a page without one.
"""

import html
import math
import re
from collections import deque
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.llm.common import steps, to_batch

# Element names by role, and words of class, id and role attributes that mark boilerplate.
RAW = {"script", "style", "noscript", "template", "iframe", "title", "textarea"}
#: Of these, what takes the rest of the page if it never ends; the others are tags to skip then.
SWALLOW = {"script", "style"}
#: Elements inside running text whose own text is no part of it.
DROPPED = {"svg", "object", "canvas", "audio", "video", "select", "button", "datalist", "annotation", "annotation-xml"}
MATH = {
    "math", "maction", "menclose", "merror", "mfrac", "mi", "mmultiscripts", "mn", "mo", "mover", "mpadded", "mphantom", "mprescripts",
    "mroot", "mrow", "ms", "mspace", "msqrt", "mstyle", "msub", "msubsup", "msup", "mtable", "mtd", "mtext", "mtr", "munder", "munderover",
    "semantics",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label",
    "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
} | DROPPED | MATH
#: What does not end a dropped element that has no end tag.
WITHIN = INLINE | VOID | {"option", "optgroup"}
CONTENT = {"article", "main"}
CONTENT_HINTS = {"article", "articlebody", "content", "entry", "main", "maincontent", "post", "story"}
ENDS_ITSELF = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HINTS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo", "promotion", "banner",
    "cookie", "cookies", "consent", "gdpr", "notice", "notices", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription",
    "signup", "login", "paywall", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "footer",
    "header", "masthead", "topbar", "sidebar", "aside", "widget", "share", "sharing", "social", "related", "recommended", "trending",
    "comment", "comments", "reply", "replies", "respond", "disqus", "discussion", "contentinfo", "complementary", "search", "toolbar",
    "copyright", "disclaimer", "skip", "feedback", "guestbook",
}
#: Of these, what readers wrote: no wrapper of an article, however much of the page it holds.
READERS = {"comment", "comments", "reply", "replies", "respond", "disqus", "discussion", "feedback", "guestbook"}
#: Inside content these are as often topics: a section called discussion, a box called notice.
TOPICS = {
    "notice", "notices", "search", "header", "discussion", "copyright", "disclaimer", "consent", "navigation", "promotion", "skip",
    "sharing", "trending", "social", "related", "recommended", "reply", "respond",
}
#: What a hint takes from a block's score: outside content, inside it, and inside it where the word may be a topic.
HINT, INNER_HINT, TOPIC_HINT = 4.0, 6.0, 2.0
#: The same for elements by their name, and for text that isn't shown; a form inside content.
ROLES = {"nav": 6.0, "footer": 5.0, "aside": 5.0, "menu": 5.0, "dialog": 5.0, "head": 9.0, "header": 5.0, "form": 4.0}
INNER_FORM, HIDDEN = 6.0, 30.0
#: Elements that can be the wrapper of a whole page.
WRAPPERS = {"form", "header"}
#: What is left of a weight one level below, and of a wrapper's weight inside an article.
FADE, LIFTED = 0.9, 0.5
#: Shares of the page's prose from which on a wrapper says nothing: with an article inside, and without.
MOST, NEARLY_ALL = 0.5, 0.8
#: What text beside an article of so many words loses.
BESIDE, ARTICLE_WORDS = 4.0, 40
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ARTICLE_HINTS = {"comment", "comments", "reply", "replies", "ad", "ads", "advert", "sponsored", "promo", "related", "teaser"}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>\"']*+(?:\"[^\"]*+\"[^>\"']*+|'[^']*+'[^>\"']*+)*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
_MARKS = re.compile(r"(?<![\w-])(class|id|role|itemprop|style|hidden|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")


@dataclass(slots=True)
class Element:
    tag: str
    number: int
    up: "Element | None" = None
    content: bool = False
    link: bool = False
    weight: float = 0.0  # what it says against its text by itself
    wrapper: bool = False  # whether that is void if it holds most of the page
    dropped: int = 0  # 1: its text goes; 2: until the next block-level tag only, as it has no end tag
    article: bool = False  # an article or main part, with nothing said against it
    kept_out: bool = False  # no wrapper of an article, or in one
    holds: bool = False  # an article inside
    words: int = 0  # outside links


@dataclass(slots=True)
class Block:
    text: str
    parent: int  # number of the element around the one that holds it
    holder: Element
    inner: Element  # the innermost element at its end
    linked: int  # characters inside links
    against: float = 0.0  # what the elements around it take from its score
    beside: bool = False  # an article, which this is no part of

    @property
    def words(self) -> int:
        return self.text.count(" ") + 1

    @property
    def link_share(self) -> float:
        return min(1.0, self.linked / max(1, len(self.text)))


def _ended(page: str, tag: str) -> set[int]:
    """Where the start tags of `tag` begin that an end tag belongs to; nested ones are told apart."""
    found, held = set(), []
    for match in _TAG.finditer(page):
        if (match[2] or match[5] or "").lower() != tag:
            continue
        if not (match[1] or match[4]):
            held.append(match.start())
        elif held:
            found.add(held.pop())
    return found


def _hints(value: str) -> set[str]:
    """Lower-case words of a class, id or role; what a name denies or only mentions ("no-", "has-", "with-") says nothing."""
    found = set()
    for name in value.split():
        words = [w.lower() for w in _WORDS.findall(name)]
        if words and words[0] not in ("no", "has", "with", "without", "is"):
            found.update(words)
    return found


def _role(tag: str, attributes: str, content: bool) -> tuple[bool, float, bool]:
    """What the element itself says: whether it is content (inside content it need not say so again), the weight against
    its text, and whether a wrapper may say that. Ids of headings and paragraphs are slugs of their text and say nothing."""
    weight = 0.0 if tag == "header" and content else INNER_FORM if tag == "form" and content else ROLES.get(tag, 0.0)
    role, hint, wrapper = tag in CONTENT, 0.0, weight == 0 or tag in WRAPPERS
    if not attributes or tag in ("html", "body", "main"):
        return role and not weight, weight, wrapper
    for name, value in _MARKS.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return False, HIDDEN, False
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return False, HIDDEN, False
        elif name != "aria-hidden" and not (name == "id" and (tag == "p" or tag in HEADINGS)):
            words = _hints(value)
            found = words & (ARTICLE_HINTS if tag == "article" else HINTS)
            if found:
                topic = found <= TOPICS or tag == "p" or tag in HEADINGS
                hint = max(hint, HINT if not content else TOPIC_HINT if topic else INNER_HINT)
                wrapper = wrapper and not found & READERS
            elif words & CONTENT_HINTS and tag not in INLINE:
                role = True
    return role and not hint and not weight, max(weight, hint), wrapper


def blocks(page: str) -> list[Block]:
    """The page's blocks with text, in order. Markup that is cut off or wrongly nested is read as browsers would, nearly."""
    root = Element("", 0)
    stack, opened, out, elements = [root], {}, [], [root]
    parts: list[str] = []
    linked = number = at = 0
    ended: dict[str, set[int]] = {}

    def end_block() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                place = next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag not in INLINE)
                holder, above = stack[place], stack[max(0, place - 1)]
                out.append(Block(text, above.number, holder, stack[-1], linked))
            parts.clear()
        linked = 0

    def close(tags: set[str], inside: int = 0) -> None:
        while len(stack) > 1 + inside:
            gone = stack.pop()
            opened[gone.tag] -= 1
            if gone.tag in tags:
                return

    def add(text: str) -> None:
        nonlocal linked
        if text and not stack[-1].dropped:
            text = html.unescape(text)
            parts.append(text)
            if stack[-1].link:
                linked += len(text.strip())

    for match in _TAG.finditer(page):
        if match.start() < at:
            continue
        add(page[at : match.start()])
        at = match.end()
        tag = (match[2] or match[5] or "").lower()
        if not tag:
            if match[0].startswith("<![CDATA[") and not stack[-1].dropped:
                parts.append(match[0][9:].removesuffix("]]>"))
            continue
        closing, attributes = match[1] or match[4], match[3] or match[6] or ""
        if tag in RAW:
            if not closing and not attributes.endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                if end or tag in SWALLOW:
                    at = end.end() if end else len(page)
            continue
        while tag not in WITHIN and stack[-1].dropped == 2:
            close({stack[-1].tag})
        if stack[-1].dropped:
            if closing:
                first = next(i for i, e in enumerate(stack) if e.dropped)
                if any(e.tag == tag for e in stack[first:]):
                    close({tag})
                    continue
            elif tag not in VOID and not attributes.endswith("/"):
                stack.append(replace(stack[-1], tag=tag))
                opened[tag] = opened.get(tag, 0) + 1
                continue
            else:
                continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in INLINE:
            end_block()
        if closing:
            if opened.get(tag):
                close({tag})
            continue
        if tag in VOID:
            continue
        if tag not in INLINE and opened.get("p") and tag not in ("html", "body"):
            close({"p"})
        for same in ENDS_ITSELF.get(tag, ()):
            if opened.get(same):
                depth = max((i for i, e in enumerate(stack) if e.tag in ("ul", "ol", "dl", "table")), default=0)
                if any(e.tag == same for e in stack[depth + 1 :]):
                    close({same}, depth)
        top, number = stack[-1], number + 1
        content, weight, wrapper = _role(tag, attributes, top.content)
        dropped = 0
        if tag in DROPPED:
            if tag not in ended:
                ended[tag] = _ended(page, tag)
            dropped = 1 if match.start() in ended[tag] else 2
        content = content and not top.kept_out
        article, kept_out = content and tag in CONTENT, top.kept_out or weight > 0 and not wrapper
        stack.append(Element(tag, number, top, top.content or content, top.link or tag == "a", weight, wrapper, dropped, article, kept_out))
        elements.append(stack[-1])
        opened[tag] = opened.get(tag, 0) + 1
        if attributes.endswith("/"):
            close({tag})
    add(page[at:])
    end_block()
    weigh(out, elements)
    return out


def weigh(found: list[Block], elements: list[Element]) -> None:
    """Set what the elements around each block say against it, once all of the page is known. `elements` ascend by their
    number, the root first, so each stands behind the one it is in."""
    for block in found:
        block.holder.words += round(block.words * (1 - block.link_share))
    for element in reversed(elements[1:]):
        element.up.words += element.words
        element.up.holds = element.up.holds or element.holds or element.article
    total = max(1, elements[0].words)
    weights, articles = {0: 0.0}, {0: 0}  # by number
    for element in elements[1:]:
        n, up = element.number, element.up.number
        inherited = FADE * weights[up] * (LIFTED if element.article else 1.0)
        void = element.wrapper and element.words >= (MOST if element.holds else NEARLY_ALL) * total
        weights[n] = max(0.0 if void else element.weight, inherited)
        articles[n] = element.words if element.article else articles[up]
    for block in found:
        block.against = max(weights[block.holder.number], weights[block.inner.number])
    largest = max((articles[b.holder.number] for b in found if b.holder.content and not b.against), default=0)
    for block in found:
        block.beside = largest >= ARTICLE_WORDS and not block.holder.content and block.holder.tag != "h1"


def score(block: Block) -> float:
    """Linear classifier. Its weights are set, not learnt: pages have no labels."""
    found = min(3.5, 0.8 * math.log1p(block.words)) - 1.6 - (1.5 if block.holder.content else 4.0) * block.link_share
    found += (3.0 if block.holder.content else 0.0) - block.against - (BESIDE if block.beside else 0.0)
    found += 0.8 if block.text[-1] in ".!?:;\"'”»…" else 0.0
    found += 0.5 if block.holder.tag == "p" else 0.0
    return found + (1.0 if block.holder.tag in ("h1", "h2", "h3", "h4") else 0.0)


def edges(found: list[Block]) -> dict[tuple[int, int], float]:
    """Smoothness between a block and the next one, and the next one under the same parent."""
    out: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, block in enumerate(found):
        if i:
            out[i - 1, i] = 0.4 if found[i - 1].holder.content == block.holder.content else 0.1
        if block.parent in last:
            pair = last[block.parent], i
            out[pair] = out.get(pair, 0.0) + 0.6
        last[block.parent] = i
    return out


def min_cut(scores: list[float], smooth: dict[tuple[int, int], float]) -> list[bool]:
    """Which nodes are on the source side of a minimum cut.

    A node whose own capacity is above all its edges' together is on its own side in every minimum cut; it is set
    at once, and its edges become capacities of its neighbours. The flow is needed for the others only.
    """
    n = len(scores)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (i, j), w in smooth.items():
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    capacity, label = list(scores), [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] is None and abs(capacity[i]) > sum(near[i].values()):
            label[i] = capacity[i] > 0
            for j, w in near[i].items():
                capacity[j] += w if label[i] else -w
                del near[j][i]
                if label[j] is None:
                    queue.append(j)
            near[i] = {}
    free = [i for i in range(n) if label[i] is None]
    if free:
        reached = _source_side(free, capacity, near)
        for i in free:
            label[i] = i in reached
    return label


def _source_side(nodes: list[int], capacity: list[float], near: list[dict[int, float]]) -> set[int]:
    """Maximum flow by shortest augmenting paths; then what the source still reaches."""
    source, sink = -1, -2
    rest: dict[int, dict[int, float]] = {source: {}, sink: {}} | {i: dict(near[i]) for i in nodes}
    for i in nodes:
        rest[source][i], rest[i][source] = max(0.0, capacity[i]), 0.0
        rest[i][sink], rest[sink][i] = max(0.0, -capacity[i]), 0.0
    while True:
        came, queue = {source: source}, deque([source])
        while queue and sink not in came:
            i = queue.popleft()
            for j, w in rest[i].items():
                if w > 1e-9 and j not in came:
                    came[j] = i
                    queue.append(j)
        if sink not in came:
            return set(came) - {source}
        path, j = [], sink
        while j != source:
            path.append((came[j], j))
            j = came[j]
        flow = min(rest[i][j] for i, j in path)
        for i, j in path:
            rest[i][j] -= flow
            rest[j][i] += flow


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    keep = min_cut([score(b) for b in found], edges(found))
    return " ".join(b.text for b, kept in zip(found, keep, strict=True) if kept)


OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract(pages: DataFrame) -> DataFrame:
    """Per row of `pages` (page_id, url, html): page_id, url, text, n_chars. A null or empty page has an empty text.
    Repeated rows stay; other columns are not read."""

    def run(batches):
        for batch in steps(batches, "html"):
            texts = [main_text(page) for page in batch.column("html").to_pylist()]
            texts = [t.encode("utf-8", "replace").decode() for t in texts]  # a reference may name half a surrogate pair
            yield to_batch(
                {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts, "n_chars": [len(t) for t in texts]}, OUT
            )

    read = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return read.mapInArrow(run, "page_id long, url string, text string, n_chars long")
