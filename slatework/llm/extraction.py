"""Main text of HTML pages by a maximum-scoring run of blocks.

A page becomes a sequence of text blocks and tags. Marked boilerplate
(navigation, adverts, forms, scripts, comments of readers ...) is taken out by
element name, role, class and id. In what remains words score positive, tags
negative, linked words as the labelled pages show, and one linear scan finds the
contiguous run of blocks with the highest total. Where the author marked the
content with ``article`` or ``main``, its tags cost nothing and its linked words
are words, so no block of it is cut off; blocks outside it are left out, also
between two such elements that one run spans.

Marks: outside marked content any part of a class or id counts (``cookie-notice``).
Inside it inline elements carry no marks; of headings, paragraphs and other
prose only whole class names count, and no ids; of sections also any part of a
class, and ids that name comments of readers; of other elements (``div``,
lists, ...) any part of a class and whole ids.

The weights are log-odds of being content, counted over labelled pages, removed
regions included: at most about ``FIT_PAGES`` pages, chosen by hash, whose
authors marked the content. Without any such page fixed weights apply.

Text rules: character references are decoded, white space inside a block is one
space, a line break element is white space, blocks are joined by a newline.

Defined results: null html is empty and gives an empty text; a page without
words gives an empty text; of equal runs the first is taken; a tag that never
closes ends with its parent; an unfinished tag at the end is dropped; very long
pages are read whole, in one pass; repeated rows are returned each; an empty
table gives no rows; only the ``keep`` columns are read beside the html, so
other columns cannot clash.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatework.llm.sampling import below, rank_hash, thresholds

FIT_PAGES = 4000

# HTML element groups and the words that mark boilerplate in
# class, id and role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol"
    " option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
UNWANTED = frozenset(
    "head nav footer aside form script style noscript template svg math iframe object embed applet canvas"
    " audio video map button select datalist textarea input dialog menu title xmp noembed noframes".split()
)
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments"
    " consent cookie cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice"
    " notices notification pager pagination popup promo promotion recommended related reply replies respond"
    " search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget widgets".split()
)
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
NEGATIONS = frozenset("no not without has with hide".split())
CONTENT = frozenset(["article", "main"])
PROSE = frozenset(
    "blockquote caption dd dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr li p pre section table tbody td tfoot th thead tr".split()
)
READERS = frozenset("comment comments disqus replies reply respond".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_PART = re.compile(r"[a-zA-Z]+|\d+")

WORD, LINKED, OUTSIDE = "word", "linked word", "word outside"
_KNOWN = BLOCK | INLINE | UNWANTED
DEFAULT_WEIGHTS = {WORD: 1.0, LINKED: -1.0, OUTSIDE: -1.0}


def _unwanted(name: str, attributes: str, in_content: bool) -> bool:
    if name in UNWANTED or name == "header" and not in_content:
        return True
    if not attributes or name in ("html", "body"):
        return False
    if _HIDDEN.search(attributes):
        return True
    for kind, *values in _ATTRIBUTE.findall(attributes):
        value, kind = "".join(values).lower(), kind.lower()
        if kind == "role":
            if value in ROLES:
                return True
        elif any(_marked(name, kind, single, in_content) for single in value.split()):
            return True
    return False


def _marked(name: str, kind: str, single: str, in_content: bool) -> bool:
    """Whether one class name or id marks an element as boilerplate."""
    if in_content:
        if name in INLINE:
            return False
        if kind == "id":
            return single in (READERS if name == "section" else () if name in PROSE else MARKS)
        if name in PROSE and name != "section":
            return single in MARKS
    parts = _PART.findall(single)
    if parts == ["header"] and not in_content and name not in CONTENT:
        return True
    named = [p for k, p in enumerate(parts) if p in MARKS and not (k and parts[k - 1] in NEGATIONS)]
    return any(name not in CONTENT or p in READERS for p in named)


class Page:
    """Blocks and tags of one page in order.

    ``sequence`` holds tag names and blocks; a block is a list of (text, token
    class) pieces and the inline tags it contains. ``wanted`` tells, per entry,
    whether it lies in an element that marks content. With ``whole`` the entries
    of boilerplate are listed too, as not wanted.
    """

    def __init__(self, source: str, whole: bool = False):
        self.whole = whole
        self.sequence: list = []
        self.wanted: list[bool] = []
        self.has_content = False
        self._pieces: list[tuple[str, bool]] = []
        self._inline: list[str] = []
        self._read(source)

    def _close_block(self, inside: bool) -> None:
        if self._pieces or self._inline:
            self.sequence.append((self._pieces, self._inline))
            self.wanted.append(inside)
            self._pieces, self._inline = [], []

    def _read(self, source: str) -> None:
        stack: list[tuple[str, bool, bool, bool]] = []  # name, unwanted, in content, in a link
        open_names: Counter = Counter()
        at = 0
        unwanted = inside = linked = False
        length = len(source)
        while at < length:
            found = _TOKEN.search(source, at)
            if found is None:
                if self.whole or not unwanted:
                    self._text(source[at:], linked)
                break
            start = found.start()
            if start > at and (self.whole or not unwanted):
                self._text(source[at:start], linked)
            at = found.end()
            name = found[2] or found[5]
            if name is None:
                if (self.whole or not unwanted) and found[0].startswith("<![CDATA["):
                    self._text(references.unescape(found[0][9:].removesuffix("]]>")).replace("&", "&amp;"), linked)
                continue
            if found[5] is not None and not found[0].endswith(">"):
                break  # an unfinished tag at the end
            name = name.lower()
            closing = bool(found[1] or found[4])
            if closing:
                if not open_names[name]:
                    continue
                before = unwanted
                while True:
                    popped = stack.pop()
                    open_names[popped[0]] -= 1
                    if popped[0] == name:
                        break
                outer = stack[-1] if stack else ("", False, False, False)
                if name in BLOCK or name in CONTENT:
                    self._close_block(inside and not before)
                _, unwanted, inside, linked = outer
                if self.whole or not before:
                    self._tag(name, inside and not (self.whole and before))
                continue
            attributes = found[3] if found[2] is not None else found[6]
            drop = unwanted or _unwanted(name, attributes or "", inside)
            if name in BLOCK:
                self._close_block(inside and not unwanted)
            if self.whole or not unwanted and (not drop or name not in VOID):
                self._tag(name, inside and not (self.whole and drop))
            if name in VOID:
                continue
            if name in RAW and not (attributes or "").rstrip().endswith("/"):
                end = re.compile(f"</{re.escape(name)}(?=[\\s/>]|\\Z)", re.I).search(source, at)
                if end is None:
                    at = length
                    break
                if name in UNWANTED:
                    close = source.find(">", end.end())
                    at = length if close < 0 else close + 1
                    continue
            content = inside or (name in CONTENT and not drop)
            self.has_content |= content
            stack.append((name, drop, content, linked or name == "a"))
            open_names[name] += 1
            unwanted, inside, linked = drop, content, linked or name == "a"
        self._close_block(inside and not unwanted)

    def _tag(self, name: str, inside: bool) -> None:
        if name == "br":
            self._pieces.append((" ", False))
        if name in BLOCK or name in UNWANTED:
            self.sequence.append(name)
            self.wanted.append(inside)
        else:
            self._inline.append(name if name in _KNOWN else "other")

    def _text(self, text: str, linked: bool) -> None:
        self._pieces.append((references.unescape(text) if "&" in text else text, linked))

    def tokens(self) -> Iterator[tuple[int, str, int]]:
        """(entry, token class, how many) of every entry."""
        for k, entry in enumerate(self.sequence):
            if isinstance(entry, str):
                yield k, entry, 1
                continue
            pieces, inline = entry
            for text, linked in pieces:
                count = len(text.split())
                if count:
                    yield k, LINKED if linked else WORD, count
            for name in inline:
                yield k, name, 1

    def best_text(self, weights: dict[str, float]) -> str:
        """Blocks of the run with the highest total, joined by newlines."""
        totals = [0.0] * len(self.sequence)
        tag = weights.get("other", -0.5)
        for k, kind, count in self.tokens():
            if self.has_content and kind in (WORD, LINKED):
                totals[k] += count * weights[WORD if self.wanted[k] else OUTSIDE]
            elif not self.wanted[k]:
                totals[k] += count * weights.get(kind, tag)
        best, best_range, total, start = 0.0, (0, 0), 0.0, 0
        for k, value in enumerate(totals):
            total += value
            if total <= 0:
                total, start = 0.0, k + 1
            elif total > best:
                best, best_range = total, (start, k + 1)
        blocks = []
        for k in range(*best_range):
            entry = self.sequence[k]
            if not isinstance(entry, str) and (self.wanted[k] or not self.has_content):
                text = " ".join("".join(text for text, _ in entry[0]).split())
                if text:
                    blocks.append(text)
        return "\n".join(blocks)


def fit_weights(pages: DataFrame, id_column: str, html_column: str, fit_pages: int = FIT_PAGES) -> dict[str, float]:
    """Log-odds of content per token class, over pages that mark their content."""
    marked = pages.where(F.col(html_column).rlike("(?i)<(article|main)[\\s>]"))
    rank = rank_hash(F.col(id_column), "pages")
    limits = thresholds(marked.select(F.lit(1).alias("one")), "one", fit_pages)
    chosen = marked.where(below(F.lit(1), rank, limits)).select(F.col(html_column).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for source in batch.column(0).to_pylist():
                page = Page(source, whole=True)
                for k, kind, count in page.tokens():
                    counts[kind, page.wanted[k]] += count
        kinds = list(counts)
        columns = [[k for k, _ in kinds], [w for _, w in kinds], [counts[k] for k in kinds]]
        types = [pa.string(), pa.bool_(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["kind", "wanted", "n"])

    counted = chosen.mapInArrow(run, "kind string, wanted boolean, n bigint")
    # One row per token class: element names are a closed set.
    found = {(r["kind"], r["wanted"]): r["n"] for r in counted.groupBy("kind", "wanted").agg(F.sum("n").alias("n")).collect()}
    if not found:
        return dict(DEFAULT_WEIGHTS)
    kinds = sorted({k for k, _ in found})
    totals = {w: sum(n for (_, x), n in found.items() if x == w) + len(kinds) for w in (True, False)}
    weights = dict(DEFAULT_WEIGHTS)
    for kind in kinds:
        odds = math.log((found.get((kind, True), 0) + 1) / totals[True])
        odds -= math.log((found.get((kind, False), 0) + 1) / totals[False])
        if kind == WORD:
            weights[kind] = min(max(odds, 0.5), 3.0)
        else:
            weights[kind] = min(max(odds, -4.0), 3.0 if kind == LINKED else -0.05)
    return weights


def extract(
    pages: DataFrame,
    id_column: str = "page_id",
    html_column: str = "html",
    keep: tuple[str, ...] = ("page_id", "url"),
    weights: dict[str, float] | None = None,
) -> DataFrame:
    """The ``keep`` columns, text and n_chars per input row."""
    own = fit_weights(pages, id_column, html_column) if weights is None else weights
    fields = [pages.schema[name] for name in keep]
    schema = T.StructType([*fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Page(s).best_text(own) if s else "" for s in batch.column(len(keep)).to_pylist()]
            columns = [batch.column(k) for k in range(len(keep))]
            columns += [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return pages.select(*keep, F.col(html_column).alias("_html")).mapInArrow(run, schema)
