"""Main text of web pages by two passes of block rules.

A page is cut into blocks: the text between two block-level tags. Blocks keep where they stand (inside an
article or main element, inside boilerplate such as navigation, footers, asides, forms or adverts) and how many of their
characters are link text. Boilerplate is never text, and no evidence for what stands beside it in an article.

Where blocks stand inside an article or main element, those outside go and both passes run over the ones inside; on other pages they
run over all blocks.

First pass, each block by itself: link text alone, in several links or in a list item, decides against it, on pages without article also
a link density above ``MOST_LINKS``. A stop-word density of ``MANY_STOPS`` with ``SHORT`` characters or more, or of ``SOME_STOPS`` with
``LONG`` characters (inside an article ``SHORT``; there ``LONG`` characters decide in any language), decides for it. Headings and all
else stay undecided. Where less than half of the remaining text is in blocks with ``SOME_STOPS`` (the page's
language isn't listed) or no block is decided for, length decides without them: ``LONG`` characters, or ``SHORT`` if no block is that long.
Wide characters (Chinese, Japanese, Korean) count as two there.

Second pass: an undecided block takes the label of the nearest decided block in page order, of the text side where both are as near; a
heading takes the label of the next decided block, if there is one. In an article where nothing is decided for, undecided blocks are text.

Defined results: a null or empty page gives an empty text, as does a page without blocks; a page that occurs twice gives its text twice;
columns of the input named text or n_chars are replaced. Unclosed elements end with their parent; scripts, styles,
templates and comments are never text, nor is a tag that never ends. A quoted value that isn't closed, or only by the quote that
opens the next one, ends with its tag at the next ``>``. All of it is linear in the length of the page.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from recurra.llm.shared import widened
from recurra.llm.stopwords import ALL_STOP_WORDS
from recurra.llm.words import chunks

MOST_LINKS = 0.5
MANY_STOPS = 0.2
SOME_STOPS = 0.1
SHORT = 40
LONG = 140

# Element names by their role.
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select "
    "summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style template noscript iframe object svg canvas textarea title head math audio video".split())
BOILERPLATE = frozenset("nav footer aside form menu button select dialog fieldset".split())
MAIN = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that the start of the named element ends, if they are open.
ENDS = {
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr", "td", "th")),
    "td": frozenset(("td", "th")),
    "th": frozenset(("td", "th")),
    "option": frozenset(("option",)),
}
# Words that mark a boilerplate container in a class, id or role, and words that may stand beside them in such a name.
MARKS = re.compile(
    r"ads?|advert\w*|banner|breadcrumbs?|comments?|complementary|contentinfo|cookies?|consent|disclaimer|footer|gdpr|login|menu|modal|"
    r"nav(?:bar|igation)?|newsletter|notices?|pager|pagination|popup|promo\w*|related|replies|share|sharing|sidebar|social|sponsor\w*|"
    r"subscribe|toolbar|widget"
)
BESIDE = frozenset(
    "area article articles author bar block blog body bottom box btn button buttons column container content desktop entry fixed form "
    "global group header icon icons inner item items left link links list main mobile outer overlay page pages panel post posts primary "
    "right row secondary section signup site slot sticky story text thread title top unit view wrap wrapper".split()
)
# Words that mark an article element as a reader's comment or a pointer to another page.
NOT_ARTICLE = frozenset("comment comments reply replies related teaser".split())
HEAD = frozenset("script style title meta link base template noscript".split())
INLINE = frozenset("p a b i em strong span".split())

_name = re.compile(r"/?[a-zA-Z][^\s/>]*")
_rest = re.compile(r"(?:[^>=]++|=\s*+(?:\"[^\">]*+\"|\"[^\"]*+(?<!=)\"|'[^'>]*+'|'[^']*+(?<!=)')|=)*+")
_raw_ends = {
    name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE)
    for name in ("script", "style", "textarea", "title", "noscript", "iframe")
}
_marks = re.compile(r"(?<![\w-])(?:class|id|role)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_parts = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*|\d+")
_closed_alone = re.compile(r"(?:^|[\s\"'])/$")
_blank = re.compile(r"\s+")
_words = re.compile(r"[^\W\d_]+")
_zeros = re.compile(r"(&#[xX]?)0+(?=[0-9a-fA-F])")
_too_large = re.compile(r"&#(?:[0-9]{8,}|[xX][0-9a-fA-F]{7,});?")


def decoded(text: str) -> str:
    """The text with its character references resolved; numbers of any length are taken."""
    if "&" not in text:
        return text
    return html.unescape(_too_large.sub("\ufffd", _zeros.sub(r"\1", text)))


def is_mark(name: str) -> bool:
    """Whether a class, id or role names boilerplate: a marking word, with nothing beside it but words of layout."""
    return _is_mark(name) if len(name) <= 100 else _is_mark.__wrapped__(name)


@lru_cache(maxsize=4096)
def _is_mark(name: str) -> bool:
    words = [word.lower() for word in _parts.findall(name)]
    marked = [bool(MARKS.fullmatch(word)) for word in words]
    return any(marked) and all(
        mark or word in BESIDE or word.isdigit() or len(word) < 3 for mark, word in zip(marked, words)
    )


def tags(page: str) -> Iterator[tuple[int, int, str, str, bool]]:
    """(start, end, lower-case name, attributes, whether it ends an element) of everything that is no text; '' names no element."""
    at, size = 0, len(page)
    while (start := page.find("<", at)) >= 0:
        name = _name.match(page, start + 1)
        if name:
            rest = _rest.match(page, name.end())
            if rest.end() == size:
                yield start, size, "", "", False
                return
            tag, end = name[0].lower(), rest.end() + 1
            ends = tag[0] == "/"
            yield start, end, tag.lstrip("/"), rest[0], ends
            if not ends and tag in _raw_ends:
                closing = _raw_ends[tag].search(page, end)
                yield end, closing.start() if closing else size, "", "", False
                end = closing.start() if closing else size
            at = end
            continue
        for opening, closing in (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<!", ">"), ("<?", ">"), ("</", ">")):
            if page.startswith(opening, start):
                stop = page.find(closing, start + (2 if opening == "<!--" else len(opening)))
                at = size if stop < 0 else stop + len(closing)
                yield start, at, "", "", False
                break
        else:
            at = start + 1


class Block:
    """A run of text between block-level tags."""

    __slots__ = ("text", "linked", "main", "boilerplate", "heading", "bare")

    def __init__(self, text: str, linked: int, main: bool, boilerplate: bool, heading: bool, bare: bool):
        self.text, self.linked, self.main, self.boilerplate, self.heading = text, linked, main, boilerplate, heading
        self.bare = bare

    def excluded(self) -> bool:
        """Whether the block is boilerplate by its container or by its links."""
        return self.boilerplate or self.bare or not self.main and self.linked > MOST_LINKS * len(self.text)

    def stops(self) -> tuple[int, int]:
        """The number of stop words and of words."""
        words = _words.findall(self.text.lower())
        return sum(word in ALL_STOP_WORDS for word in words), len(words)

    def width(self) -> int:
        """The number of characters, wide ones twice."""
        if self.text.isascii():
            return len(self.text)
        return len(self.text) + sum(unicodedata.east_asian_width(char) in "WF" for char in self.text)


def first_pass(found: list[Block]) -> list[bool | None]:
    """Whether each block is main text by itself, None if that is undecided."""
    labels: list[bool | None] = []
    known = total = 0
    for block in found:
        if block.excluded():
            labels.append(False)
            continue
        stops, words = block.stops()
        share, size, width = stops / max(1, words), len(block.text), block.width()
        known, total = known + width * (share >= SOME_STOPS), total + width
        sure = size >= SHORT and share >= MANY_STOPS or size >= (SHORT if block.main else LONG) and share >= SOME_STOPS
        sure |= block.main and width >= LONG
        labels.append(True if sure and not block.heading else None)
    if True not in labels or 2 * known < total:
        open_blocks = [(k, found[k].width()) for k, label in enumerate(labels) if label is None and not found[k].heading]
        for least in (LONG, SHORT):
            for k, width in open_blocks:
                if width >= least:
                    labels[k] = True
            if True in labels:
                break
    return labels


def second_pass(found: list[Block], labels: list[bool | None]) -> list[bool]:
    """The labels with those of the nearest decided blocks where there was none; where no block is text, True inside an article."""
    if True not in labels:
        return [block.main if label is None else label for block, label in zip(found, labels)]
    before: list[int | None] = []
    for k, label in enumerate(labels):
        before.append(k if label is not None else before[-1] if before else None)
    after: list[int | None] = []
    for k in range(len(labels) - 1, -1, -1):
        after.append(k if labels[k] is not None else after[-1] if after else None)
    after.reverse()
    decided = []
    for k, (block, left, right) in enumerate(zip(found, before, after)):
        if left is None or right is None:
            near = right if left is None else left
            decided.append(near is not None and bool(labels[near]))
        elif block.heading or right - k < k - left:
            decided.append(bool(labels[right]))
        elif k - left < right - k:
            decided.append(bool(labels[left]))
        else:
            decided.append(bool(labels[left] or labels[right]))
    return decided


def blocks(page: str) -> Iterator[Block]:
    """The blocks of a page that hold any text, in page order."""
    open_tags: list[tuple[str, bool, bool]] = []
    places: dict[str, list[int]] = {}
    levels: list[int] = []
    parts: list[tuple[str, int]] = []
    held = dict.fromkeys(("main", "boilerplate", "heading", "a", "silent", "li"), 0)
    at = link = 0

    def closed() -> Iterator[Block]:
        if parts:
            text = _blank.sub(" ", "".join(part for part, _ in parts)).strip()
            if text:
                links = {number for part, number in parts if number and not part.isspace()}
                linked = sum(len(_blank.sub(" ", part).strip()) for part, number in parts if number)
                bare = (len(links) > 1 or bool(links) and held["li"] > 0) and not any(
                    char.isalnum() for part, number in parts if not number for char in part
                )
                yield Block(text, linked, held["main"] > 0, held["boilerplate"] > 0, held["heading"] > 0, bare)
            parts.clear()

    def count(name: str, marked: bool, main: bool, step: int) -> None:
        held["main"] += step * main
        held["boilerplate"] += step * marked
        held["heading"] += step * (name in HEADINGS)
        held["silent"] += step * (name in SILENT)
        for key in ("a", "li"):
            held[key] += step * (name == key)

    def close_last() -> str:
        name, marked, main = open_tags.pop()
        places[name].pop()
        if name in BLOCKS:
            levels.pop()
        count(name, marked, main, -1)
        return name

    for start, end, name, rest, ends in tags(page):
        if start > at and not held["silent"]:
            parts.append((decoded(page[at:start]), link if held["a"] else 0))
        at = end
        if not name:
            continue
        if name in BLOCKS:
            yield from closed()
        if ends:
            # The end of an inline element never ends the blocks around it.
            if places.get(name) and (name in BLOCKS or name in SILENT or places[name][-1] > (levels[-1] if levels else -1)):
                while close_last() != name:
                    pass
        elif name not in VOID and not _closed_alone.search(rest):
            ended = ENDS.get(name, frozenset((name,)) if name in ("p", "a") else frozenset())
            while open_tags and (
                open_tags[-1][0] in ended
                or name in BLOCKS and name != "a" and open_tags[-1][0] in INLINE
                or open_tags[-1][0] == "head" and name not in HEAD
            ):
                close_last()
            names = " ".join(next(filter(None, group), "") for group in _marks.findall(rest)).split()
            main = name in MAIN and NOT_ARTICLE.isdisjoint(part.lower() for part in names)
            if name in MAIN:
                marked = not main
            else:
                marked = name not in ("html", "body") and any(map(is_mark, names))
            marked |= name in BOILERPLATE or name == "header" and not held["main"]
            link += name == "a"
            places.setdefault(name, []).append(len(open_tags))
            if name in BLOCKS:
                levels.append(len(open_tags))
            open_tags.append((name, marked, main))
            count(name, marked, main, 1)
    if at < len(page) and not held["silent"]:
        parts.append((decoded(page[at:]), link if held["a"] else 0))
    yield from closed()


def main_text(page: str | None) -> str:
    """The blocks of main text, joined by line breaks."""
    found = list(blocks(page or ""))
    inside = [block for block in found if block.main and not block.boilerplate]
    found = inside or found
    kept = second_pass(found, first_pass(found))
    return "\n".join(block.text for block, keep in zip(found, kept) if keep)


def extracted(pages: DataFrame) -> DataFrame:
    """``pages`` with text (the main text of html) and n_chars (its code points)."""
    rest = pages.drop("text", "n_chars")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "html"):
            texts = [main_text(value.as_py()) for value in batch.column("html")]
            columns = [pa.array(texts, pa.string()), pa.array([len(text) for text in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "text", "n_chars"])

    return rest.mapInArrow(extract, widened(rest, "text string, n_chars long"))
