"""Main text of web pages by the distribution of text over blocks of lines.

Markup is stripped: each block element is a line, inline elements vanish, and what markup itself
names as no article (menus, footers, forms, scripts and the like, by element, role, class or id)
goes and leaves a gap, except between two pieces of body text of one parent. Over the lines, text lengths are summed in sliding windows of ``BLOCK``
lines; link text does not count. The text surges where a window's sum reaches the threshold, and
dives where a window has no text. What stands between is the core. Where the page has article
elements, or else main elements, or else containers named as content, surges are sought in these,
and a core takes in all lines of its element, so short first and last paragraphs stay.

Defined cases. A null or empty page has the empty text. The threshold is ``SURGE`` characters, or
the largest window of the page if that is less, so a short article is found too. An element that
is never closed ends with the element around it. Comments, doctypes and attributes have no text;
unknown character references stay as written. Repeated pages each get their row.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.registry import query, table

BLOCK = 3
SURGE = 86

# Names in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr nobr".split())
NO_ARTICLE = frozenset(
    "script style textarea title noscript template iframe xmp noembed noframes head nav footer aside form button "
    "select option menu dialog object svg canvas audio video map datalist".split())
HOLDERS = ("article", "main")
NO_ARTICLE_ROLES = frozenset(
    "navigation banner contentinfo complementary search menu menubar dialog alert alertdialog form".split())
# Words in a class or id that name something else than the article.
NO_ARTICLE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner "
    "nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager sidebar sidebars aside widget widgets "
    "footer foot header masthead topbar toolbar notice notices cookie cookies consent gdpr alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations "
    "comment comments commentlist notification notifications announcement disclaimer disqus reply replies respond discussion form search copyright".split())
# Words in a class or id that name a container of the article.
CONTENT_NAMES = frozenset("article content post entry main story".split())
CONTAINERS = frozenset("div section td".split())
# What carries the text of an article itself is not told apart by names.
CARRIERS = frozenset("table caption thead tbody tfoot tr td th pre blockquote figure figcaption dl".split())
# Words after a name that only say what kind of box it is, or what it lists.
BOXES = frozenset(
    "area bar block blocks body bottom box button buttons col column container content copy description group heading icon icons "
    "inline inner item items label left link links list module outer panel right row section slot space text title "
    "toggle top unit wrap wrapper zone article articles news page pages post posts product products site stories story tags "
    "topics".split())
# Names like with-sidebar tell about the layout, not what the element is.
ABOUT = frozenset("with has no without".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|$)|<(?:!|\?)[^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)  # the last for a quote that is not closed
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S)
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\s*(?:!|;|$)", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HEADING = re.compile(r"h[1-6]")


def attributes_of(text: str) -> dict[str, str]:
    """Names in lower case with their values; the first of a repeated name counts."""
    named: dict[str, str] = {}
    for key, a, b, c in _ATTRIBUTE.findall(text):
        named.setdefault(key.lower(), a or b or c)
    return named


def _named_aside(words: list[str]) -> bool:
    """Whether the words of one class or id name something else than the article: the last of them
    does, or the first and what follows only says what kind of box it is."""
    if not words or words[0] in ABOUT:
        return False
    return words[-1] in NO_ARTICLE_NAMES or words[0] in NO_ARTICLE_NAMES and all(
        word in BOXES or word in NO_ARTICLE_NAMES for word in words[1:])


def _aside(name: str, named: dict[str, str], inside: bool) -> bool:
    """Whether an element is no part of an article, by itself."""
    if name in NO_ARTICLE or (name == "header" and not inside):
        return True
    if not named:
        return False
    if named.get("role", "").strip().lower() in NO_ARTICLE_ROLES or named.get("aria-hidden", "").lower() == "true":
        return True
    if "hidden" in named or _UNSEEN.search(html.unescape(named.get("style", ""))):
        return True
    if name in HOLDERS and "comment" not in named.get("class", "").lower():
        return False
    if name in ("html", "body") or _HEADING.fullmatch(name) or inside and name in CARRIERS:
        return False
    return any(_named_aside([word.lower() for word in _WORD.findall(token)])
               for token in f"{named.get('class', '')} {named.get('id', '')}".split())


def _holder(name: str, named: dict[str, str]) -> int:
    """What an element holds, if it is not aside: 0 an article, 1 the main part, 2 what is named
    content, 3 nothing of these."""
    if name in HOLDERS:
        return HOLDERS.index(name)
    if name not in CONTAINERS or not named:
        return 3
    if named.get("role", "").strip().lower() == "main":
        return 1
    words = [word.lower() for token in (named.get("class", ""), named.get("id", ""), named.get("itemprop", ""))
             for word in _WORD.findall(token)]
    return 2 if CONTENT_NAMES.intersection(words) else 3


# Elements that are lines of text by themselves.
PIECES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote figcaption".split())
NOWHERE = (0, 0, 0)
GAP = ("", 0, NOWHERE)


def lines_of(page: str) -> list[tuple[str, int, tuple[int, int, int]]]:
    """(text, characters of link text, numbers of the article, main part and content around it, or
    0) of each line. Gaps are empty lines. Of nested elements of one kind the outer one counts."""
    lines: list[tuple[str, int, tuple[int, int, int]]] = []
    open_: list[tuple[str, bool, int]] = []  # elements around, whether each is no article, what it holds
    inside: tuple[list[int], ...] = ([], [], [], [])
    numbers: list[int] = []  # of the elements around
    homes: list[int] = []  # the parent of each line's text; of a gap -1
    opened = 0
    hidden, holders, links, text, linked = 0, 0, 0, [], 0
    at, end, raw = 0, len(page), None

    def home() -> int:
        blocks = [at for at in range(len(open_) - 1, -1, -1) if open_[at][0] not in INLINE][:2]
        if blocks and open_[blocks[0]][0] in PIECES:
            del blocks[0]
        return numbers[blocks[0]] if blocks else 0

    def leave(gap: int) -> None:
        lines.extend([GAP] * gap)
        homes.extend([-1] * gap)

    def flush(gap: int = 0) -> None:
        nonlocal text, linked
        line = " ".join("".join(text).split())
        if line:
            lines.append((line, min(linked, len(line)), tuple(kind[0] if kind else 0 for kind in inside[:3])))
            homes.append(home())
        leave(gap)
        text, linked = [], 0

    while at < end:
        if raw is not None:
            close = re.compile(rf"</{re.escape(raw)}\s*>?", re.I).search(page, at)
            at, raw = (close.start() if close else end), None
            continue
        tag = _TAG.search(page, at)
        upto = tag.start() if tag else end
        if upto > at and not hidden:
            piece = html.unescape(page[at:upto])
            text.append(piece)
            if links:
                linked += len(piece.strip())
        if not tag:
            break
        at = tag.end()
        ending, name, attributes = tag.group(1, 2, 3) if tag.group(2) else tag.group(4, 5, 6)
        name = (name or "").lower()
        if not name:
            continue
        if ending:
            depth = next((depth for depth in range(len(open_) - 1, -1, -1) if open_[depth][0] == name), None)
            if depth is None:
                if name == "p" and not hidden:
                    flush()
                continue
            if name in INLINE and any(other not in INLINE for other, _, _ in open_[depth + 1:]):
                continue  # an inline end does not close blocks opened since
            if name not in INLINE and not hidden:
                flush()
            for other, gone, kind in open_[depth:]:
                if gone:
                    hidden -= 1
                    if not hidden:
                        leave(BLOCK)
                elif kind < 3:
                    inside[kind].pop()
                links -= other == "a"
            del open_[depth:], numbers[depth:]
            continue
        if name not in INLINE and not hidden:
            flush()
        if name in VOID or attributes.endswith("/") and name not in RAW and name not in HOLDERS and name != "div":
            continue
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
            _close_open(open_, name)
            del numbers[len(open_):]
        named = attributes_of(attributes)
        gone = (not hidden and _aside(name, named, bool(inside[0] or inside[1]))
                or bool(hidden) and name in NO_ARTICLE)
        if gone:
            if not hidden:
                flush(BLOCK)
            hidden += 1
        kind = 3 if gone else _holder(name, named)
        if kind < 3:
            holders += 1
            inside[kind].append(holders)
        links += name == "a"
        opened += 1
        open_.append((name, gone, kind))
        numbers.append(opened)
        if name in RAW:
            raw = name
    flush()
    return _closed(lines, homes)


def _closed(lines: list[tuple[str, int, tuple[int, int, int]]], homes: list[int]) -> list:
    """The lines without the gaps that have body text of one parent on both sides."""
    out, last = [], -1
    for line, home in zip(lines, homes):
        if home < 0:
            out.append(line)
            continue
        body = home if len(line[0]) > line[1] else -1
        if body >= 0 and body == last:
            while out[-1] is GAP:
                out.pop()
        out.append(line)
        last = body
    return out


def _close_open(open_: list[tuple[str, bool, int]], name: str) -> None:
    """A paragraph, item or cell ends the one before it, unless that hides or holds something."""
    if open_ and open_[-1] == (name, False, 3):
        open_.pop()


def core(lengths: list[int]) -> list[tuple[int, int]]:
    """Stretches of lines from a surge's first text to the dive after it."""
    sums = [sum(lengths[at:at + BLOCK]) for at in range(len(lengths))]
    threshold = min(SURGE, max(sums, default=0))
    if not threshold:
        return []
    found, begin, surged = [], None, False
    for at, total in enumerate([*sums, 0]):
        if total:
            begin = at if begin is None else begin
            surged = surged or total >= threshold
            continue
        if begin is not None and surged:
            found.append((begin, at))
        begin, surged = None, False
    return found


def main_text(page: str | None) -> str:
    lines = lines_of(page or "")
    lengths = [max(0, len(text) - linked) for text, linked, _ in lines]
    if not any(lengths):  # nothing but links
        lengths = [len(text) for text, _, _ in lines]
    keep = [False] * len(lines)
    # The most telling kind of element that has text on the page.
    kind = next((kind for kind in range(3) if any(
        length for length, (_, _, around) in zip(lengths, lines) if around[kind])), None)
    if kind is None:
        for low, high in core(lengths):
            keep[low:high] = [True] * (high - low)
    else:
        taken = {lines[at][2][kind] for low, high in core(
            [length if around[kind] else 0 for length, (_, _, around) in zip(lengths, lines)])
            for at in range(low, high)} - {0}
        keep = [around[kind] in taken for _, _, around in lines]
    return " ".join(text for (text, _, _), kept in zip(lines, keep) if kept and text)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per page: page_id, url, text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(value.as_py()) for value in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                ["page_id", "url", "text"])

    kind = pages.schema[page_id].dataType.simpleString()
    return pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"),
                        F.col(page).alias("html")).mapInArrow(run, f"page_id {kind}, url string, text string")


@query("op10_html_extraction")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))
