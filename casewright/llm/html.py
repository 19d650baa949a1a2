"""Main text of HTML pages by two-pass block rules.

A page becomes blocks at block-level tags, all of them, menus and comments included. Pass one calls each block good,
bad or open by its length, link density and stop-word density; the containers around it shift that call, as a hint
whose weight the page itself decides (``_hints``): a name such as ``sidebar`` on a wrapper that holds the article is
overruled, and an ``article`` element counts only if a fair share of the page's running text lies in it. Pass two gives
an open block the label of its nearest decided neighbour; headings look ahead first, since they head what follows.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Frequent function words of the languages served.
STOP_WORDS = {
    "en": "a about after all an and are as at be been but by can for from had has have he her his if in into is it its more not of on one or our out she so than that the their there they this to up was we were what when which who will with would you",
    "de": "aber als am an auch auf aus bei bis das dass dem den der des die durch ein eine einem einen einer er es für hat ich im in ist mit nach nicht noch nur oder sein sich sie sind so über um und von vor war was wie wird zu zum zur",
    "fr": "à au aux avec ce ces cette comme dans de des du elle en est et il ils je la le les leur mais ne nous on ou où par pas plus pour qu que qui sa se ses si son sont sur un une vous",
    "es": "a al como con de del desde donde el ella en entre era es esta este fue ha hasta la las le lo los más me muy no o para pero por que se ser si sin sobre son su sus también un una y ya",
}
STOPS = frozenset(w for words in STOP_WORDS.values() for w in words.split())
#: Tags whose contents are no text of the page at all.
RAW = "script|style|noscript|template|iframe|object|svg|math|textarea|select|title|canvas|audio|video"
#: Tags that end a block.
BLOCK = frozenset("address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Containers that are not part of an article, whatever they hold.
OUTSIDE = frozenset(("nav", "footer", "aside", "menu", "dialog", "button", "label"))
#: Containers that keep a stack, so that their end tags count.
HELD = frozenset("address article aside blockquote body button details dialog div dl figure footer form head header label main menu nav ol section table td tr ul li span p".split())
VOID_ENDS = frozenset(("li", "p", "tr", "td"))
#: Words that, as a class, id or role or as its first or last part, hint that a container is no article.
_NAMES = re.compile(
    r"(?<![\w-])(?!(?:has|no|with|without|hide|is|not)[_-])(?:[^\s]*[_-])?(?:ads?|advert\w*|adsense|banner|promo\w*|sponsor\w*|cookies?|consent|gdpr|notice|notification|alert|popup|modal|overlay|newsletter|subscribe\w*|signup|login|sidebars?|side|widget\w*|related|recommend\w*|share|sharing|social|menus?|nav\w*|breadcrumbs?|footer\w*|masthead|topbar|pagination|pager|toolbar|complementary|contentinfo|search)(?![\w-])"
    r"|(?<![\w-])(?:ads?|advert\w*|adsense|banner|promo\w*|sponsor\w*|cookies?|consent|gdpr|notice|notification|alert|popup|modal|overlay|newsletter|subscribe\w*|signup|login|sidebars?|side|widgets?|related|recommend\w*|share|sharing|social|menus?|nav|navbar|navigation|breadcrumbs?|footer|masthead|topbar|pagination|pager|toolbar|search)[_-]",
    re.I,
)
#: Names of what readers write; running text by any measure, so that only the name tells it from an article.
_TALK = re.compile(r"(?<![^\s])(?!(?:has|no|with|without|hide|is|not)[_-])(?:[^\s]*[_-])?(?:comments?|commentlist|respond|replies|disqus|discussion)(?:[_-][^\s]*)?(?![^\s])", re.I)
_TOKEN = re.compile(
    rf"<!--(?:.*?--!?>|.*\Z)|<(?P<raw>{RAW})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+(?:/>|>(?:.*?</(?P=raw)\s*+[^>]*+>|.*\Z))|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<more>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[/a-zA-Z][^>]*+>|<[!?][^>]*+>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|$)", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORD = re.compile(r"\w+")


class Block(NamedTuple):
    text: str
    links: int  # characters in links
    heading: bool
    article: bool  # inside an article or main element
    box: int  # the innermost container that may be no article, or -1


class Page(NamedTuple):
    """A page's blocks, and of each container that may be no article the next one around it and what speaks against it:
    ``never`` (it is none, whatever it holds), ``talk`` (readers' comments) or ``name`` (a hint)."""

    blocks: list[Block]
    parents: list[int]
    kinds: list[str]


def _against(tag: str, more: str, in_article: bool) -> str | None:
    """What speaks against a container with these attributes, if anything."""
    if tag in OUTSIDE:
        return "never"
    kind = "name" if tag == "form" or tag == "header" and not in_article else None
    if tag in ("body", "html", "main") or not more:
        return kind
    for name, *values in _ATTRIBUTE.findall(more):
        name, value = name.lower(), next((v for v in values if v), "")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDDEN.search(value):
            return "never"
        if name in ("class", "id", "role"):
            if _TALK.search(value):
                kind = "talk"
            elif kind is None and _NAMES.search(value):
                kind = "name"
    return kind


def blocks(html: str) -> Page:
    """All blocks with text, in page order. Every tag is looked at once, so broken markup takes no longer than other."""
    out: list[Block] = []
    parents: list[int] = []
    kinds: list[str] = []
    stack: list[tuple[str, int, bool]] = []  # tag, the box around it, article
    open_: Counter[str] = Counter()
    parts: list[str] = []
    links, in_link, heading, inside, box = 0, False, False, 0, -1

    def end_block() -> None:
        nonlocal links
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, links, heading, inside > 0, box))
            parts.clear()
            links = 0

    def text_of(piece: str) -> None:
        nonlocal links
        piece = unescape(piece) if "&" in piece else piece
        parts.append(piece)
        if in_link:
            links += len("".join(piece.split()))

    def pop() -> None:
        nonlocal inside, box
        tag, box, was_article = stack.pop()
        open_[tag] -= 1
        inside -= was_article

    at, last = 0, html.rfind(">") + 1  # what follows the last > holds no tag
    for m in _TOKEN.finditer(html, 0, last):
        if m.start() > at:
            text_of(html[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            if m["raw"] is not None and m["raw"].lower() not in ("svg", "math"):
                parts.append(" ")
            continue
        tag = tag.lower()
        if tag == "a":
            in_link = not m["end"]
        elif tag in ("br", "img", "input"):
            parts.append(" ")
        if tag in BLOCK:
            end_block()
            in_link = False
            heading = tag in HEADINGS and not m["end"]
        if tag in HELD:
            if m["end"]:
                if open_[tag]:
                    end_block()
                    while stack[-1][0] != tag:
                        pop()
                    pop()
            elif not m["more"].endswith("/"):
                if tag in VOID_ENDS and stack and stack[-1][0] == tag:
                    pop()
                against, article = _against(tag, m["more"], inside > 0), tag in ("article", "main")
                if against:
                    end_block()
                stack.append((tag, box, article))
                open_[tag] += 1
                inside += article
                if against:
                    parents.append(box)
                    kinds.append(against)
                    box = len(kinds) - 1
    if at < len(html):
        rest = html[at:]
        cut = rest.find("<!--", last - at if last > at else 0)  # a comment that never ends
        text_of(rest if cut < 0 else rest[:cut])
    end_block()
    return Page(out, parents, kinds)


def classify(text: str, links: int, heading: bool, hint: int, short: int = 70, low: float = 0.06, high: float = 0.2, density: float = 0.4) -> str:
    """Pass one: good, bad or open. ``hint`` is what the containers say: 1 for an article, -1 against one, else 0."""
    if hint < 0:
        return "bad"
    letters = len(text) - text.count(" ")
    if letters and links / letters > density:
        return "open" if heading and hint > 0 else "bad"
    if len(text) < short:
        return "open"
    words = _WORD.findall(text.lower())
    stops = sum(w in STOPS for w in words) / max(1, len(words))
    if stops >= high or hint > 0 and stops >= low:
        return "good"
    return "bad" if stops < low and hint == 0 else "open"


def _hints(page: Page) -> list[int]:
    """What the containers say of each block, weighed by where the page's running text lies.

    Running text is what pass one calls good without any hint. A container with a name against it keeps its say unless
    it holds over two thirds of the running text outside comments and ``never`` containers, and there is no article
    element outside; if neither running text nor an article element is left outside such containers, none of them has
    a say, and after that comments have none either. An article element
    speaks for its blocks, and against those outside, if it has a quarter or more of the running text that is left (or
    of all text left, where none is running).
    """
    own, parents, kinds = page.blocks, page.parents, page.kinds
    running = [len(b.text) * (classify(b.text, b.links, b.heading, 0) == "good") for b in own]
    never, talk = [False] * len(kinds), [False] * len(kinds)
    for k, kind in enumerate(kinds):  # a container comes after the one around it
        up = parents[k]
        never[k] = kind == "never" or up >= 0 and never[up]
        talk[k] = kind == "talk" or up >= 0 and talk[up]
    held = [0] * len(kinds)
    for b, n in zip(own, running, strict=True):
        if b.box >= 0 and not never[b.box] and not talk[b.box]:
            held[b.box] += n
    for k in range(len(kinds) - 1, -1, -1):
        if parents[k] >= 0:
            held[parents[k]] += held[k]
    total = sum(n for b, n in zip(own, running, strict=True) if b.box < 0 or not never[b.box] and not talk[b.box])
    free = any(b.article and b.box < 0 for b in own)

    def out(weak: bool, chat: bool) -> list[bool]:
        """Of each container, whether its text is out; ``weak``: names count, ``chat``: comments count."""
        gone = [False] * len(kinds)
        for k, kind in enumerate(kinds):
            up = parents[k]
            own_say = kind == "never" or kind == "talk" and chat or kind == "name" and weak and (free or 3 * held[k] <= 2 * total)
            gone[k] = own_say or up >= 0 and gone[up]
        return gone

    for weak, chat in ((True, True), (False, True), (False, False), (True, True)):
        gone = out(weak, chat)
        left = [b.box < 0 or not gone[b.box] for b in own]
        if any(x and (n or b.article) for b, n, x in zip(own, running, left, strict=True)):
            break
    weight = running if any(n and x for n, x in zip(running, left, strict=True)) else [len(b.text) for b in own]
    share = sum(n for b, n, x in zip(own, weight, left, strict=True) if x and b.article)
    trusted = share > 0 and 4 * share >= sum(n for n, x in zip(weight, left, strict=True) if x)
    return [-1 if not x or trusted and not b.article else int(trusted) for b, x in zip(own, left, strict=True)]


def main_text(html: str | None) -> str:
    """The text of the page's article: its good blocks in page order, a blank between them."""
    if not html:
        return ""
    page = blocks(html)
    hints = _hints(page)
    labels = [classify(b.text, b.links, b.heading, hint) for b, hint in zip(page.blocks, hints, strict=True)]
    # pass two: what containers rule out is no neighbour
    near = [k for k, hint in enumerate(hints) if hint >= 0 or labels[k] != "bad"]
    n = len(near)
    before, after = [(n + 1, "")] * n, [(n + 1, "")] * n
    for order, to in ((range(n), before), (range(n - 1, -1, -1), after)):
        far, label = n + 1, ""
        for k in order:
            own = labels[near[k]]
            far, label = (0, own) if own != "open" else (far + 1, label)
            to[k] = (far, label)
    kept = []
    for k, at in enumerate(near):
        block, label = page.blocks[at], labels[at]
        if label == "open":
            ahead, back = after[k], before[k]
            chosen = ahead if ahead[1] and (block.heading or ahead[0] <= back[0]) else back
            chosen = ahead if not chosen[1] else chosen
            tied = back[1] and ahead[1] and back[0] == ahead[0]
            alone = hints[at] > 0 or len(block.text) >= 25
            label = "good" if tied and "good" in (back[1], ahead[1]) else chosen[1] or ("good" if alone else "bad")
        if label == "good":
            kept.append(block.text)
    return " ".join(kept)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id_col, url_col, text, n_chars) for every row of ``pages``, from the whole html.

    Null and empty html, and pages without an article, give an empty text. An open block between a good and a bad
    neighbour that are equally near is good. Ids and URLs may be null or repeat and come back as they are; repeated
    rows give repeated rows. Other columns are not read; an empty table gives an empty result.
    """

    def each(batches):
        for batch in batches:
            texts = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["id", "url", "text", "n_chars"])

    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    got = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).mapInArrow(each, f"id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
    return got.withColumnsRenamed({"id": id_col, "url": url_col})
