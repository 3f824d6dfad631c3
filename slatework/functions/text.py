"""Name keys and text shapes.

Accent folding needs Unicode compatibility decomposition, which Spark lacks.
It works one code point at a time, so it is a lookup: the tables below are
derived from the Unicode data at import, and applied with ``translate`` (one
character results) plus a map for the rare results of several characters.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from slatework.functions.coerce import literal_map

# Generation suffixes dropped from a name.
FOREIGN = r"[^\x00-\x7F]"
SUFFIX = r"(?U)\b(jr|sr|ii|iii|iv|v)\b\.?"


@lru_cache(maxsize=None)
def _fold_tables() -> tuple[str, str, str, tuple[tuple[str, str], ...]]:
    """(single sources, single targets, deleted marks, multi-character pairs)."""
    single_from, single_to, marks, multi = [], [], [], []
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        if unicodedata.combining(char):
            marks.append(char)
            continue
        folded = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        # Only ASCII results matter: whatever else is left is dropped or blanked later.
        if not any(c.isascii() for c in folded):
            continue
        if len(folded) == 1:
            single_from.append(char)
            single_to.append(folded)
        else:
            multi.append((char, folded))
    return "".join(single_from), "".join(single_to), "".join(marks), tuple(multi)


def fold_accents(value: Column) -> Column:
    single_from, single_to, marks, multi = _fold_tables()
    # Characters past the end of the replacement text are deleted.
    folded = F.translate(value, single_from + marks, single_to)
    lookup = literal_map(dict(multi))
    expand = F.concat_ws(
        "", F.transform(F.split(folded, ""), lambda c: F.coalesce(F.try_element_at(lookup, c), c))
    )
    # Cheap tests first: most text is ASCII, and most of the rest is after folding.
    has_multi = folded.rlike("[" + "".join(c for c, _ in multi) + "]")
    return (
        F.when(~value.rlike(FOREIGN), value)
        .when(~folded.rlike(FOREIGN), folded)
        .when(has_multi, expand)
        .otherwise(folded)
    )


def name_key(value: Column) -> Column:
    """Lower case, no accents, no generation suffix, no punctuation; empty is null."""
    lowered = fold_accents(F.lower(F.trim(value)))
    # Punctuation and white space alike become one space per run.
    bare = F.trim(F.regexp_replace(F.regexp_replace(lowered, SUFFIX, ""), r"[^a-z0-9]+", " "))
    return F.nullif(bare, F.lit(""))


def name_key_keep_suffix(value: Column) -> Column:
    """As ``name_key`` but keeps suffixes and drops (not blanks) foreign letters."""
    ascii_only = F.regexp_replace(fold_accents(F.trim(value)), r"[^\x00-\x7F]", "")
    return F.nullif(F.trim(F.regexp_replace(F.lower(ascii_only), r"[^\w]+", " ")), F.lit(""))


def last_name_of(key: Column) -> Column:
    """Last word of an already normalised name."""
    return F.element_at(F.split(key, " "), -1)


def initial_last_of(key: Column) -> Column:
    """First initial and last word, null for a single word."""
    parts = F.split(key, " ")
    return F.when(
        F.size(parts) >= 2, F.concat(F.substring(key, 1, 1), F.lit(" "), F.element_at(parts, -1))
    )


def snake(value: Column) -> Column:
    split_case = F.regexp_replace(F.trim(value), r"([a-z0-9])([A-Z])", "$1_$2")
    joined = F.regexp_replace(split_case, r"[^A-Za-z0-9]+", "_")
    return F.lower(F.trim(joined, F.lit("_")))


def half_inning(value: Column) -> Column:
    token = F.upper(F.trim(value))
    return F.when(token == "BOTTOM", "BOT").otherwise(token)


def degrees_text(value: Column) -> Column:
    return F.concat(value.cast("int").cast("string"), F.lit("°"))


def page_title_date(text: Column, pattern: str) -> Column:
    """Date written out as ``April 3, 2026`` in the first group of ``pattern``."""
    found = F.regexp_extract(text, pattern, 1)
    return F.try_to_date(F.when(found != "", found), "MMMM d, yyyy")
