"""Operator 4: main text of HTML pages by the distribution of line blocks.

Markup is stripped to lines, one for each block of text. Parts that are marked
as something else (scripts, styles, forms, menus, page headers and footers,
sidebars, notices, adverts, reader comments) leave no line. A line's length is
its text outside links. Lines of links alone have none, but for a paragraph that
is one link, and take no room among the others; they stay where they stand
between lines of the main text. Blocks of text within one container (paragraphs, headings,
lists, tables) follow each other; each border of a container (`CONTAINERS`)
between two lines counts as `BORDER` empty lines, unless both lines are the
direct text of like containers side by side, as where every paragraph is a div.

On a page that names its article, all lines inside it that are not marked are
the main text. Else the sums of `WINDOW` lines decide. Where a sum rises from
nothing a stretch of lines begins, where it falls back to nothing it ends. A
stretch surges if from one of its lines on a window holds `SURGE` characters or
more and the lines after that one hold text, too; so a long line that stands
alone does not. The main text goes from the first surging stretch to the dive
at the end of the last one, with all lines between, and begins at the last `h1`
before the surge. Where no stretch surges, those of the highest sum stand in.

A form that holds more text than the rest of the page is the page, not a form.
A class, id or role marks a part if it is a word of `APART_WORDS`, or made of
such words and words for places on a page (`PLACES`) alone: `cookie-notice` and
`site-footer` do, `hidden-gem` and `search-results` do not.

Character references are decoded, white space within a line becomes one space,
and lines are joined by a line feed. Defined results: null html is the empty
page; a page without text, or of nothing but lists of links, gives the empty
text; unclosed and stray tags are taken as browsers do, as far as blocks go:
paragraphs, list items, terms and table parts end where the next begins, a head
holds no text of its own, an end tag ends what stands open in its element, but
a named article ends only by its own; rows that repeat and null ids are
extracted like any other; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_batches, small_batches, texts

WINDOW = 3
SURGE = 80   # characters of a window that make a surge
BORDER = 2   # empty lines that a container's border counts as

# Elements whose text is never shown as text, or never part of an article.
UNSEEN = frozenset("script style noscript template svg math title iframe object audio video canvas select datalist".split())
APART = frozenset("nav footer aside menu dialog button fieldset textarea figure-tools".split())
CONTAINERS = frozenset("article center details div fieldset header main section".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre search section summary
    table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NAMED = frozenset(("article", "main"))
# Never apart as a whole, and open to the end of the page: a head's own text ends it, as do its elements that show text.
PAGE = frozenset("html head body".split())
# Where end tags are left out: start tags that end an open paragraph, and the open parts that another part ends.
ENDS_P = BLOCKS - PAGE - frozenset("caption legend optgroup option tbody td tfoot th thead tr".split())
_CELLS, _ROWS = ("td", "th", "caption"), ("tbody", "thead", "tfoot")
ENDS = ({"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": _CELLS, "th": _CELLS, "tr": (*_CELLS, "tr")}
        | dict.fromkeys(_ROWS, (*_CELLS, "tr", *_ROWS)))
TABLE_PARTS = frozenset((*_CELLS, "tr", *_ROWS))
LISTS = ("ul", "ol", "menu", "dir")
# Blocks through which an item or term still ends the one before.
PASSED = frozenset("address div p li dt dd".split())
# Words of class, id and role that mark a part as something else than the article.
APART_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising alert alerts banner breadcrumb breadcrumbs
    captcha comment comments commentlist complementary consent contentinfo cookie cookies copyright disclaimer disqus footer form
    gdpr header hidden login masthead menu modal nav navbar navbox navigation newsletter notice notices notification outbrain overlay
    pager pagination paywall popup promo promoted promotion recommended related reply replies respond search share sharing
    sidebar signup skip social sponsor sponsored subscribe subscription taboola tagcloud tags teaser toc toolbar topbar widget""".split())
# Words that only say where or what kind of part it is.
PLACES = frozenset("""area article articles bar block blog body bottom box button buttons center col column container content
    entry global holder icons inner item items label left line link links list lower main middle outer page panel post posts
    primary right row secondary section side site slot space story strip sub tertiary thread top unit upper web wrap wrapper
    zone""".split())

RAW = frozenset("script style textarea title noscript template svg math iframe".split())

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"                                 # comment
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/<>]*+)(?P<bare>>)?"  # a tag up to its attributes
    r"|<[!?/][^<>]*+>?"                                    # declarations and bogus comments
    r"|(?P<text>[^<]+|<)",
    re.S)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I) for tag in RAW}
# The end of a tag, or its next attribute: a name with an opening quote, a value without quotes or none.
_ATTRIBUTE = re.compile(r"""[\s/]*+(?:(?P<close>>)|(?P<name>[^\s/<>][^\s/<>=]*+)(?:\s*+=\s*+(?:(?P<quote>["'])|(?P<value>[^\s<>]*+)))?)""")
_GAP = re.compile(r"[\s/]*+")
_REST = re.compile(r"[^<>]*+>?")
# The attributes that say what an element is.
TELLING = frozenset("class id role hidden aria-hidden style".split())
_WORD = re.compile(r"[^\W_]")
# What a part of the article may be named beside the word for the article itself.
OF_ARTICLE = frozenset(("article", "entry", "post", "story", "content", "main"))
OF_ARTICLE_KEPT = frozenset(("header", "form", "reply", "share"))


def _apart_name(name: str) -> bool:
    parts = re.findall("[a-z]+", name)
    if not parts or parts[0] in OF_ARTICLE and parts[-1] in OF_ARTICLE_KEPT:
        return False
    return any(p in APART_WORDS for p in parts) and all(p in APART_WORDS or p in PLACES for p in parts)


def marked_apart(attrs: dict[str, str]) -> bool:
    """Whether an element's attributes mark it as something else than the article."""
    for name, value in attrs.items():
        value = html.unescape(value).lower()
        if name == "hidden" or name == "aria-hidden" and value.strip() == "true":
            return True
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return True
        elif name in ("class", "id", "role") and any(map(_apart_name, value.split())):
            return True
    return False


class Tokens:
    """Text, tags and their telling attributes of a page, in time linear in its length.

    Attributes are taken one by one as browsers do; quoted values may hold
    anything and have any length. Where a tag is left open, it ends before the
    next tag; where a quote is, with the first `<` or `>` after it.
    """

    def __init__(self, page: str):
        self.page = page
        self._left = {'"': True, "'": True}  # whether the quote may still occur

    def _attributes(self, at: int) -> tuple[int, bool, dict[str, str]]:
        """(end of the tag, whether it closes itself, its attributes) of a tag whose name ends at `at`."""
        page, found = self.page, {}
        while token := _ATTRIBUTE.match(page, at):
            at = token.end()
            if token["close"]:
                return at, page[at - 2] == "/" and token.end() - token.start() > 1, found
            name, value, quote = token["name"].lower(), token["value"] or "", token["quote"]
            if quote:
                end = page.find(quote, at) if self._left[quote] else -1
                if end < 0:
                    self._left[quote] = False
                    rest = _REST.match(page, at)
                    value, at = rest[0].rstrip(">"), rest.end()
                else:
                    value, at = page[at:end], end + 1
            if name in TELLING:
                found.setdefault(name, value)
            if quote and end < 0:
                return at, False, found
        return _GAP.match(page, at).end(), False, found

    def __iter__(self) -> Iterator[tuple[str | None, str, bool, bool, dict[str, str]]]:
        """(text, or None and a tag's name, whether it is an end tag, whether it closes itself, attributes)."""
        page, at = self.page, 0
        while token := _TOKEN.match(page, at):
            at = token.end()
            if token["text"]:
                yield token["text"], "", False, False, {}
            elif token["tag"]:
                tag, closing, alone, attrs = token["tag"].lower(), token["end"] == "/", False, {}
                if not token["bare"]:
                    at, alone, attrs = self._attributes(at)
                if tag in RAW and not closing and not (alone and tag in ("svg", "math")):
                    end = _RAW_END[tag].search(page, at)
                    at = end.end() if end else len(page)
                else:
                    yield None, tag, closing, alone, attrs


class Open:
    """The open elements of a page, and how many of them are apart, a form or a named article."""

    def __init__(self):
        self.apart = self.forms = self.named = 0
        self._stack: list[tuple[str, bool, bool, bool]] = []  # (tag, apart, form, named)
        self._at = defaultdict(list)                     # places of each tag on it
        self._blocks: list[int] = []                     # places of blocks that shut in items and terms
        self._articles: list[int] = []                   # places of named articles
        self._shown: list[tuple[int, str, str, int]] = [(-1, "", "", 0)]  # (place, tag, class, number) of every block
        self._number = 0

    def holds(self, tag: str) -> bool:
        return bool(self._at[tag])

    def innermost(self) -> tuple[str, str, int]:
        """(tag, class, number of the block around it) of the innermost open block."""
        _, tag, name, _ = self._shown[-1]
        return tag, name, self._shown[-2][3] if len(self._shown) > 1 else -1

    def push(self, tag: str, apart: bool, form: bool, named: bool, name: str = "") -> None:
        place = len(self._stack)
        self._at[tag].append(place)
        if tag in BLOCKS:
            self._number += 1
            self._shown.append((place, tag, name, self._number))
            if tag not in PASSED:
                self._blocks.append(place)
        if named:
            self._articles.append(place)
        self._stack.append((tag, apart, form, named))
        self.apart += apart
        self.forms += form
        self.named += named

    def _last(self, *tags: str) -> int:
        return max((self._at[t][-1] for t in tags if self._at[t]), default=-1)

    def _cut(self, size: int) -> None:
        while len(self._stack) > size:
            tag, apart, form, named = self._stack.pop()
            self._at[tag].pop()
            self.apart -= apart
            self.forms -= form
            self.named -= named
        for places in (self._blocks, self._articles):
            while places and places[-1] >= size:
                places.pop()
        while self._shown[-1][0] >= size:
            self._shown.pop()

    def start(self, tag: str) -> None:
        """Ends the elements whose end tags were left out before this start tag."""
        if tag in ENDS:
            shut = self._last("table") if tag in TABLE_PARTS else self._blocks[-1] if self._blocks else -1
            ended = [place for t in ENDS[tag] if (place := self._last(t)) > shut]
            if ended:
                self._cut(min(ended))
        if tag in ENDS_P and (place := self._last("p")) > self._last("button", "object", "table", *_CELLS):
            self._cut(place)

    def end(self, tag: str) -> None:
        place = self._last(tag)
        shut = self._last(*(("table",) if tag in TABLE_PARTS else () if tag == "table" else _CELLS), *(LISTS if tag == "li" else ()))
        if tag not in NAMED and self._articles:
            shut = max(shut, self._articles[-1])
        if place > shut:
            self._cut(place)


class Lines:
    """Lines of a page that are not apart: text, length, whether a title, in a named article or in a form.

    `gap` has the empty lines before each line, `gap_outside` those that borders
    outside forms make between lines outside forms.
    """

    def __init__(self, page: str, by_class: bool = True):
        self.text: list[str] = []
        self.length: list[int] = []
        self.title: list[bool] = []
        self.named: list[bool] = []
        self.form: list[bool] = []
        self.gap: list[int] = []
        self.gap_outside: list[int] = []
        self._held: list[str] = []
        self._plain = False                       # whether a held letter or digit lies outside links
        self._links = 0                           # links begun in the held text
        self._mark: int | None = None             # where a part within the held line began that is apart
        self._empty = self._empty_outside = 0
        self._before: tuple | None = None
        linked, opened = 0, Open()
        for part, tag, closing, alone, attrs in Tokens(page):
            if part is not None:
                self._held.append(part)
                if not linked and not self._plain and not opened.apart:
                    self._plain = _WORD.search(html.unescape(part)) is not None
                continue
            if tag in BLOCKS:
                self._close(opened)
                linked = 0 if closing else linked  # a link left open ends with its block
            elif tag == "br":
                self._held.append(" ")
            if tag == "a":
                linked = 0 if closing else 1
                self._links += linked
            if closing:
                self._border(tag, opened)
                opened.end(tag)
                self._resume(opened)
                continue
            opened.start(tag)
            self._resume(opened)
            if tag in VOID or tag in PAGE or alone and tag not in BLOCKS:
                continue
            is_apart = (tag in UNSEEN or tag in APART or tag == "header" and not opened.named
                        or by_class and bool(attrs) and marked_apart(attrs))
            is_form = tag == "form"
            is_named = tag in NAMED and not opened.apart and not is_apart
            # Of the elements within lines only those that carry a meaning or may hold one of the same tag matter.
            if is_apart or is_named or tag in BLOCKS or opened.holds(tag):
                if is_apart and not opened.apart and tag not in BLOCKS:
                    self._mark = len(self._held)
                if not is_apart:
                    self._border(tag, opened)
                opened.push(tag, is_apart, is_form, is_named, attrs.get("class", ""))
        self._close(opened)

    def _border(self, tag: str, opened: Open) -> None:
        if tag in CONTAINERS and not opened.apart:
            self._empty += BORDER
            self._empty_outside += 0 if opened.forms else BORDER

    def _resume(self, opened: Open) -> None:
        """Forgets the text of a part within the line that was apart, once it has ended."""
        if self._mark is not None and not opened.apart:
            del self._held[self._mark:]
            self._mark = None

    def _close(self, opened: Open) -> None:
        if not self._held:
            return
        if opened.apart:
            del self._held[self._mark or 0:]
            self._mark = 0  # what follows is apart, until the part ends
        text = " ".join(html.unescape("".join(self._held)).split())
        if text:
            tag, name, around = block = opened.innermost()
            own = self._plain or opened.named > 0 or tag == "p" and self._links == 1
            self.text.append(text)
            self.length.append(len(text) - text.count(" ") if own else 0)
            self.title.append(tag == "h1")
            self.named.append(opened.named > 0)
            self.form.append(opened.forms > 0)
            # Direct text of like containers side by side runs on.
            alike = tag in CONTAINERS and block == self._before
            self.gap.append(0 if alike else self._empty)
            self.gap_outside.append(0 if alike or opened.forms else self._empty_outside)
            self._before, self._empty = block, 0
            self._empty_outside = self._empty_outside if opened.forms else 0
        self._held, self._plain, self._links = [], False, 0


def stretches(length: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, int]]:
    """(surge, dive, highest window sum) of every stretch of lines whose window sums stay above nothing."""
    sums = np.convolve(length, np.ones(window, dtype=np.int64))[window - 1:]  # of the line and those after it
    edges = np.flatnonzero(np.diff(np.concatenate([[False], sums > 0, [False]]).astype(np.int8)))
    return [(int(a), int(b), int(sums[a:b].max())) for a, b in zip(edges[0::2], edges[1::2], strict=True)]


def surging(length: np.ndarray, window: int = WINDOW, surge: int = SURGE) -> tuple[int, int] | None:
    """(first, after the last) of the lines from the first surging stretch to the last dive; None without text.

    Where no stretch surges, the stretches of the highest sum are taken for it.
    """
    found = stretches(length, window)
    if not found:
        return None
    sums = np.convolve(length, np.ones(window, dtype=np.int64))[window - 1:]
    after = np.concatenate([sums[1:], [0]])  # of the lines after each
    rising = (length > 0) & (sums >= surge) & (after > 0)
    chosen = [(a, b) for a, b, _ in found if rising[a:b].any()]
    if not chosen:
        top = max(s for _, _, s in found)
        chosen = [(a, b) for a, b, s in found if s == top]
    first, last = chosen[0][0], chosen[-1][1]
    return first + int(np.flatnonzero(length[first:])[0]), last


def main_text(page: str) -> str:
    """The article of an HTML page, a line for each block.

    Where all text lies in parts that a class or id sets apart, such a name must
    stand for the page as a whole, and names are not heeded.
    """
    return _main_text(Lines(page)) or _main_text(Lines(page, by_class=False))


def _main_text(lines: Lines) -> str:
    length, form = np.array(lines.length, dtype=np.int64), np.array(lines.form, dtype=bool)
    if not len(length):
        return ""
    apart = length[form].sum() <= length[~form].sum()
    shown = ~form if apart else np.ones(len(form), dtype=bool)
    named = np.array(lines.named, dtype=bool) & shown
    if (length[named] > 0).any():
        return "\n".join(t for t, inside in zip(lines.text, named, strict=True) if inside)
    told = np.flatnonzero(shown & (length > 0))
    if not len(told):
        return ""
    # Lines of text with the empty lines before them; those before lines left out count, too.
    before = np.cumsum(lines.gap_outside if apart else lines.gap)[told]
    place = np.cumsum(np.minimum(np.diff(before, prepend=before[0]), WINDOW) + 1) - 1
    spaced = np.zeros(place[-1] + 1, dtype=np.int64)
    spaced[place] = length[told]
    first, last = surging(spaced, WINDOW, SURGE)
    first, last = told[np.searchsorted(place, first)], told[np.searchsorted(place, last) - 1]
    titles = np.flatnonzero(np.array(lines.title[:first], dtype=bool) & shown[:first])
    return "\n".join(lines.text[k] for k in range(titles[-1] if len(titles) else first, last + 1) if shown[k])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars): main text of every page."""
    small_batches(pages.sparkSession)
    schema = T.StructType([pages.schema[id_col], pages.schema[url_col], T.StructField("text", T.StringType(), False),
                           T.StructField("n_chars", T.LongType(), False)])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [main_text(t) for t in texts(batch.column(2))]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(list(map(len, found)), pa.int64())],
            names=schema.names)

    return map_batches(pages.select(id_col, url_col, html_col), run, schema)
