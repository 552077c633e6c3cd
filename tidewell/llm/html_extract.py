"""Main text of web pages by two-pass block rules.

Markup is read once into blocks: runs of text between block-level tags, with the share of
characters inside links and the containers they lie in.  Pass one classifies a block by
itself, inside an article element and outside: boilerplate containers are bad; link-dense blocks
are bad, or ambiguous amid an article; long blocks with enough stop words are good; the rest is
ambiguous.  Pass two gives each ambiguous block the label of the nearest decided blocks around it.
Where a page marks an article, short blocks outside it are not taken for parts of it.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

LONG_CHARS = 70             # shorter blocks are ambiguous whatever their words
LINK_DENSITY = 0.4
STOP_DENSITY = 0.15

# HTML element names and common function words of four languages.
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noframes
ol option optgroup p pre section select summary table tbody td textarea tfoot th thead title tr ul""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title noscript template svg iframe noframes object xmp".split())
BAD_TAGS = frozenset("nav footer aside form head button select dialog menu".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
BAD_NAMES = frozenset("""ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist
consent cookie cookies copyright disclaimer discussion disqus foot footer gdpr header masthead menu modal nav navbar navigation
newsletter notice notices notification pager pagination popup promo promoted promotion related recommended replies respond
share sharing sidebar signup skip social sponsor sponsored subscribe tags teaser toolbar widget""".split())
STOP_WORDS = frozenset("""a an and are as at be but by for from had has have he her his i if in into is it its not of on or she
so that the their them there they this to was we were which will with you
der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird
bei einer um am sind noch wie einem über so zum war haben nur oder aber vor zur bis mehr durch
de la le et les des en un une du que est pour qui dans par plus pas au sur ne se ce il sont avec son sa ou mais nous vous ses
el que y los del las por con no su para al lo como más pero sus le ya o este sí porque esta entre cuando muy sin sobre""".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:\-]*)((?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:\-]*)([^>]*)(?:>|\Z)""",
                    re.DOTALL)
_ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_NAME_PART = re.compile(r"[^a-z0-9]+")
_ABOUT_OTHERS = frozenset("has with no without is not js".split())     # "has-sidebar" is not a sidebar
# a paragraph ends where one of these begins
_ENDS_ITSELF = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"),
                "tr": ("tr", "td", "th"), "option": ("option",)}


@dataclass
class BlockText:
    text: str
    chars: int
    linked: int
    bad: bool
    article: int       # number of the enclosing article or main element, 0 for none
    tag: str           # of the innermost open element


# elements that hold a text rather than parts of the page: only a whole class name tells them apart
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption caption td th dd dt".split())
# inside an article these name its own head, not the page's
OWN_NAMES = frozenset("header head masthead copyright tags".split())


def _is_bad(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is boilerplate by its kind or its names."""
    if tag in BAD_TAGS or (tag == "header" and not in_article):
        return True
    if not attributes or tag in ("body", "html", "article", "main"):
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value in BAD_ROLES:
            return True
        if name == "style" and _HIDDEN_STYLE.search(value):
            return True
        if name in ("class", "id"):
            for word in value.split():
                if tag in TEXT_TAGS and in_article:
                    if word in BAD_NAMES and word not in OWN_NAMES:
                        return True
                    continue
                parts = set(_NAME_PART.split(word))
                if in_article:
                    parts -= OWN_NAMES
                if _NAME_PART.split(word)[0] not in _ABOUT_OTHERS and not BAD_NAMES.isdisjoint(parts):
                    return True
    return False


def read_blocks(page: str) -> list[BlockText]:
    """Blocks of a page in order, each with its decoded text in single spaces."""
    blocks: list[BlockText] = []
    stack: list[tuple[str, bool, int]] = []       # open elements: tag, bad, article
    open_tags: Counter[str] = Counter()

    def pop() -> str:
        tag = stack.pop()[0]
        open_tags[tag] -= 1
        return tag

    parts: list[str] = []
    linked_parts: list[str] = []
    in_link, articles, at, size = False, 0, 0, len(page)

    def end_block() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                linked = sum(len("".join(html.unescape(x).split())) for x in linked_parts)
                tag, bad, article = stack[-1] if stack else ("", False, 0)
                blocks.append(BlockText(text, len(text.replace(" ", "")), linked, bad, article, tag))
            parts.clear()
        linked_parts.clear()

    def add(text: str) -> None:
        if text:
            parts.append(text)
            if in_link:
                linked_parts.append(text)

    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag, closing, attributes = tag.lower(), m[1] or m[4], m[3] if m[2] else m[6]
        if tag == "a":
            in_link = not closing
            continue
        if tag == "br":
            add(" ")
            continue
        block = tag in BLOCK_TAGS
        if block:
            end_block()
            in_link = False
        if closing:
            if open_tags[tag]:
                while pop() != tag:
                    pass
                if not block and tag not in ("span", "b", "i", "em", "strong"):
                    end_block()
            continue
        if tag in RAW_TAGS and not (tag == "svg" and attributes.endswith("/")):
            end = re.compile(f"</{tag}(?=[\\s/>])[^>]*(?:>|\\Z)", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag in VOID_TAGS or attributes.endswith("/"):
            continue
        if tag in ("body", "article", "main") and open_tags["head"]:
            stack.clear()       # the head was never closed
            open_tags.clear()
        if block:
            # an open paragraph ends at the next block, items at the next item
            if stack and stack[-1][0] == "p":
                pop()
            if stack and stack[-1][0] in _ENDS_ITSELF.get(tag, ()):
                pop()
        _, bad, article = stack[-1] if stack else ("", False, 0)
        own_bad = _is_bad(tag, attributes, article > 0)
        if tag in ("article", "main") and not article:
            articles += 1
            article = articles
        if block or own_bad:
            if own_bad and not block:
                end_block()
            stack.append((tag, bad or own_bad, article))
            open_tags[tag] += 1
    end_block()
    return blocks


def classify(b: BlockText) -> bool | None:
    """Pass one: good, bad, or None for ambiguous."""
    if b.bad:
        return False
    if b.linked > LINK_DENSITY * b.chars:
        return None if b.article and b.tag not in ("li", "td", "th", "dd", "dt") else False
    if b.chars < LONG_CHARS:
        return False if "©" in b.text and not b.article else None
    words = b.text.lower().split()
    return True if sum(w in STOP_WORDS for w in words) >= STOP_DENSITY * len(words) else None


def nearest_labels(labels: list[bool | None]) -> list[bool | None]:
    """For each block the label of the nearest decided one, the good one when equally near; None if there is
    none.  Two passes over the blocks, one from either side."""
    n = len(labels)
    before: list[int | None] = [None] * n
    last = None
    for i in range(n):
        last = i if labels[i] is not None else last
        before[i] = last
    out: list[bool | None] = [None] * n
    following = None
    for i in reversed(range(n)):
        following = i if labels[i] is not None else following
        found = [(abs(j - i), not labels[j]) for j in (before[i], following) if j is not None]
        out[i] = not min(found)[1] if found else None
    return out


def main_blocks(page: str) -> list[str]:
    """Pass two: ambiguous blocks take the label of the nearest decided ones.

    Inside an article only its own blocks count, boilerplate containers aside.  Elsewhere
    containers, which may stand amid the text, count only where no other block is decided.  A
    block without any decided neighbour is good; but on a page with an article, what is
    ambiguous outside it is bad, as it has a place for the text and did not use it.
    """
    blocks = read_blocks(page)
    labels = [classify(b) for b in blocks]
    # an article counts if it holds any text that is no boilerplate
    has_article = any(b.article and not b.bad for b in blocks)
    scopes: dict[int, list[int]] = {}
    for i, b in enumerate(blocks):
        if not b.bad:
            scopes.setdefault(b.article if has_article else 0, []).append(i)
    final = list(labels)
    for article, own in scopes.items():
        near = nearest_labels([labels[i] for i in own])
        for i, label in zip(own, near):
            if labels[i] is None:
                final[i] = False if has_article and not article else label
    if not has_article and None in final:       # nothing but containers is decided
        final = [a if a is not None else b for a, b in zip(final, nearest_labels(labels))]
    return [b.text for b, label in zip(blocks, final) if label is None or label]


def extract_main_text(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with the main text in ``out_col`` (replacing a column of that name).

    The text is the kept blocks in page order, joined by one line feed; character references are
    decoded and white space inside a block is one space.  A null or empty page, or one
    without main text, gives an empty string; broken or cut-off markup is read as far as it
    goes; every row is treated alone; an empty table gives an empty table.
    """
    @F.arrow_udf("string")
    def extract(column: pa.Array) -> pa.Array:
        return pa.array(["\n".join(main_blocks(x.as_py())) if x.is_valid else "" for x in column], pa.string())

    return pages.withColumn(out_col, extract(F.col(html_col)))
