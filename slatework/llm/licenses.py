"""License scan by patience alignment.

A notice is found by aligning its words with a stretch of the text: words that
occur once in both are anchors, the longest increasing run of anchors is kept,
and the gaps between them are aligned again in the same way. A gap without
anchors gives its common prefix and suffix, and what remains is aligned by
longest common subsequence. Coverage is the share of template words aligned; a
match needs ``COVERAGE``.

Only stretches that can reach the coverage are aligned: a stretch of ``STRETCH``
times the template's length must hold enough words of the template. That test
runs over the whole text as array arithmetic on word hashes and drops nothing
that could match.

Matches of one template do not overlap: after a match the scan goes on behind
it. Several templates may match in one place.

Defined results: null and wordless texts have no matches; repeated rows are
scanned each; a null ``doc_id`` is kept; a template without words is an error;
an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatework.llm.bytesio import LOWER, blocks, hash_spans, text_bytes, word_spans

COVERAGE = 0.8
STRETCH = 2

# Short notices and the opening of well-known license texts.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        ' associated documentation files (the "Software"), to deal in the Software without restriction,'
        " including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,"
        " and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,"
        " subject to the following conditions:"
    ),
    "BSD text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met:"
    ),
    "ISC text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
}

_SEPARATOR = np.ones(256, bool)
_SEPARATOR[48:58] = _SEPARATOR[65:91] = _SEPARATOR[97:123] = _SEPARATOR[128:] = False
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def _longest_increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of (i, j) with both rising; ``pairs`` are ordered by i."""
    tails, ends, before = [], [], []
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tails, j)
        before.append(ends[at - 1] if at else -1)
        if at == len(tails):
            tails.append(j)
            ends.append(k)
        else:
            tails[at], ends[at] = j, k
    chain, k = [], ends[-1] if ends else -1
    while k >= 0:
        chain.append(pairs[k])
        k = before[k]
    return chain[::-1]


def _subsequence(a: list, b: list) -> list[tuple[int, int]]:
    """Longest common subsequence of two short lists."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    pairs, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Patience alignment: rising pairs (position in a, position in b) of equal items."""
    pairs: list[tuple[int, int]] = []
    waiting = [(0, len(a), 0, len(b))]
    while waiting:
        a0, a1, b0, b1 = waiting.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {x: j for j, x in enumerate(b[b0:b1], b0) if in_b[x] == 1}
        unique = [(i, place[x]) for i, x in enumerate(a[a0:a1], a0) if in_a[x] == 1 and x in place]
        anchors = _longest_increasing(unique)
        if not anchors:
            pairs += [(a0 + i, b0 + j) for i, j in _subsequence(a[a0:a1], b[b0:b1])]
            continue
        pairs += anchors
        for (i, j), (u, v) in zip([(a0 - 1, b0 - 1), *anchors], [*anchors, (a1, b1)]):
            waiting.append((i + 1, u, j + 1, v))
    return sorted(pairs)


def _commonest(marks: np.ndarray, template: list[int], need: int) -> tuple[list[int], int]:
    """(template words most frequent in the text, how many words besides them a match needs).

    As many are taken as leave half of the needed words, two at least.
    """
    times, rest, common = Counter(template), need, []
    found = np.bincount(marks, minlength=max(template) + 1)
    for word in sorted(times, key=lambda x: (-found[x], x)):
        if rest - times[word] < max(2, need // 2):
            break
        common.append(word)
        rest -= times[word]
    return common, rest


class Scanner:
    """Templates prepared for scanning."""

    def __init__(self, templates: dict[str, str], coverage: float, stretch: int):
        self.names = list(templates)
        self.coverage, self.stretch = coverage, stretch
        lists = [[w.lower() for w in _WORD.findall(t.encode())] for t in templates.values()]
        if not all(lists):
            raise ValueError("a template has no words")
        vocabulary = sorted({w for words in lists for w in words})
        joined = np.frombuffer(b" ".join(vocabulary), np.uint8)
        hashes = hash_spans(joined, *word_spans(joined, np.zeros(0, np.int64)))
        self._order = np.argsort(hashes)
        self._hashes = hashes[self._order]
        number = {w: k for k, w in enumerate(vocabulary)}
        self.templates = [[number[w] for w in words] for words in lists]

    def marked(self, column: pa.Array):
        """(row, ordinal in its text, vocabulary number, start, end) of every word of any template."""
        data, offsets = text_bytes(column)
        seen = np.zeros(len(column), np.int64)
        parts = []
        for at, end in blocks(data, offsets, _SEPARATOR):
            part = LOWER[data[at:end]]
            starts, ends = word_spans(part, offsets - at, _SEPARATOR)
            if not len(starts):
                continue
            row = np.searchsorted(offsets, starts + at, "right") - 1
            first = np.searchsorted(row, row, "left")
            ordinal = np.arange(len(row)) - first + seen[row]
            seen += np.bincount(row, minlength=len(seen))
            hashes = hash_spans(part, starts, ends)
            place = np.minimum(np.searchsorted(self._hashes, hashes), len(self._hashes) - 1)
            known = np.flatnonzero(self._hashes[place] == hashes)
            base = at - offsets[row[known]]
            parts.append((row[known], ordinal[known], self._order[place[known]], starts[known] + base, ends[known] + base))
        if not parts:
            return [np.zeros(0, np.int64)] * 5
        return [np.concatenate(c) for c in zip(*parts)]

    def matches(self, column: pa.Array) -> Iterator[tuple[int, int, int, int, float]]:
        """(row, template, first byte, last byte, coverage) of every match."""
        row, ordinal, word, start, end = self.marked(column)
        for t, template in enumerate(self.templates):
            need = int(np.ceil(self.coverage * len(template) - 1e-9))
            reach = self.stretch * len(template)
            own = np.flatnonzero(np.isin(word, template))
            if len(own) < need:
                continue
            r, o, w = row[own], ordinal[own], word[own]
            # Words of the stretch that starts at each mark, all and without the commonest:
            # those can be aligned no more often than the template holds them.
            key = (r << 40) + o
            stop = np.searchsorted(key, key + reach)
            common, rest = _commonest(w, template, need)
            rare = np.r_[0, np.cumsum(~np.isin(w, common))]
            here = np.arange(len(own))
            fits = (stop - here >= need) & (rare[stop] - rare[here] >= rest)
            after = -1
            for k in np.flatnonzero(fits):
                if k <= after:
                    continue
                pairs = align(template, w[k : stop[k]].tolist())
                # The stretch begins with an aligned word, or a later stretch has the match.
                if len(pairs) >= need and pairs[0][1] == 0:
                    after = k + pairs[-1][1]
                    yield int(r[k]), t, int(start[own[k]]), int(end[own[after]]), len(pairs) / len(template)


def scan(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    coverage: float = COVERAGE,
    stretch: int = STRETCH,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, license, start, end, coverage) per match; code points, end exclusive."""
    scanner = Scanner(templates or TEMPLATES, coverage, stretch)
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_column].dataType),
            T.StructField("license", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("coverage", T.DoubleType()),
        ]
    )
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            found = sorted(scanner.matches(column))
            starts, ends, held, body, points = [], [], -1, b"", None
            for row, _, first, last, _ in found:
                if row != held:
                    held, body = row, column[row].as_py().encode()
                    points = np.r_[0, np.cumsum((np.frombuffer(body, np.uint8) & 0xC0) != 0x80)]
                starts.append(int(points[first]))
                ends.append(int(points[last]))
            columns = [
                batch.column(0).take(pa.array([m[0] for m in found], pa.int64())),
                pa.array([scanner.names[m[1]] for m in found], pa.string()),
                pa.array(starts, pa.int64()),
                pa.array(ends, pa.int64()),
                pa.array([m[4] for m in found], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    chosen = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return chosen.mapInArrow(run, schema)
