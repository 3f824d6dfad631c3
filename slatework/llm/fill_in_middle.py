"""Fill-in-middle examples, cut by an indexable skip list.

A document is a list of units: a word of ASCII letters, or one other code
point. Its skip list has the units on the lowest lane; every express lane above
links a part of the nodes below and carries, per link, the units and the code
points it spans. Descending by accumulated unit widths reaches any rank and
yields the code points before it, exactly and without walking the units.

Which units rise to a lane is drawn from a hash of their rank, so a document
always gets the same list. Lanes are built by sums over the lane below.

Defined results: a null or empty text is plain and has no units; a null id is
hashed as empty digits; repeated rows give repeated rows; equal cut ranks give
an empty middle; very long texts are indexed whole; extra columns stay out
unless named in ``keep``; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatework.llm.bytesio import mix

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of the documents that stay plain, and of the others that start with the suffix.
PLAIN_PERCENT = 10
SPM_PERCENT = 20
#: A node rises to the next lane with a chance of one in this.
RISE = 4


def unit_widths(points: np.ndarray) -> np.ndarray:
    """Code points of each unit of a text given as its code points."""
    lower = points | 32
    letter = (lower >= 97) & (lower <= 122)
    first = np.ones(len(points), bool)
    first[1:] = ~(letter[1:] & letter[:-1])
    return np.diff(np.append(np.flatnonzero(first), len(points)))


class SkipList:
    """Lanes from the lowest up: per link, the units and the code points it spans.

    ``down[k]`` gives, for each node of lane k + 1, the place of the same node on lane k.
    A link starts at its node; every lane starts at unit 0 and its last link runs to the end.
    """

    def __init__(self, widths: np.ndarray):
        self.units = [np.ones(len(widths), np.int64)]
        self.points = [widths.astype(np.int64)]
        self.down: list[np.ndarray] = []
        rank = np.arange(len(widths), dtype=np.uint64)
        lane = 0
        while len(rank) > 2 * RISE:
            lane += 1
            risen = mix(rank * np.uint64(2) + (np.uint64(lane) << np.uint64(40))) % np.uint64(RISE) == 0
            risen[0] = True
            place = np.flatnonzero(risen)
            self.units.append(np.add.reduceat(self.units[-1], place))
            self.points.append(np.add.reduceat(self.points[-1], place))
            self.down.append(place)
            rank = rank[place]

    def __len__(self) -> int:
        return int(self.units[-1].sum())

    def reach(self, rank: int) -> int:
        """Code points before the unit of this rank (all of them for the rank behind the last)."""
        if not 0 <= rank <= len(self):
            raise IndexError(rank)
        passed = points = at = 0
        for lane in range(len(self.units) - 1, -1, -1):
            units, widths = self.units[lane], self.points[lane]
            while at < len(units) and passed + units[at] <= rank:
                passed += int(units[at])
                points += int(widths[at])
                at += 1
            if at == len(units) or passed == rank:
                break
            if lane:
                at = int(self.down[lane - 1][at])
        return points


def _word(digest: Column, number: int) -> Column:
    """The ``number``-th group of eight hex digits, as an unsigned integer."""
    return F.conv(F.substring(digest, 8 * number + 1, 8), 16, 10).cast("long")


def transform(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", seed: str = "1", keep: Sequence[str] = ()
) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output, and the columns ``keep``; one row per row.

    Form ``plain`` is the text itself; ``psm`` is prefix, suffix, middle and
    ``spm`` suffix, prefix, middle, each behind its marker. A text that holds a marker stays plain.
    """
    clash = {"doc_id", "n", "form", "prefix_chars", "middle_chars", "output"} & {c.lower() for c in keep}
    if clash:
        raise ValueError(f"kept columns clash with results: {sorted(clash)}")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 256)
    text = F.coalesce(F.col(text_column), F.lit(""))
    marked = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(text, F.lit(marker))
    form = (
        F.when((text == "") | marked | (_word(digest, 2) % 100 >= 100 - PLAIN_PERCENT), "plain")
        .when(_word(digest, 3) % 100 < SPM_PERCENT, "spm")
        .otherwise("psm")
    )
    chosen = docs.select(
        F.struct(F.col(id_column).alias("doc_id"), *[F.col(c) for c in keep]).alias("row"),
        text.alias("text"),
        form.alias("form"),
        _word(digest, 0).alias("h1"),
        _word(digest, 1).alias("h2"),
    )
    schema = chosen.select("row", "text", "form").schema
    for name in ("n", "first", "second"):
        schema = schema.add(name, T.LongType())
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = batch.column("form").to_pylist()
            h1, h2 = batch.column("h1").to_pylist(), batch.column("h2").to_pylist()
            counts, firsts, seconds = [], [], []
            for k, text in enumerate(batch.column("text")):
                widths = unit_widths(np.frombuffer(text.as_py().encode("utf-32-le"), "<u4"))
                n = len(widths)
                counts.append(n)
                if forms[k] == "plain":
                    firsts.append(None)
                    seconds.append(None)
                    continue
                index = SkipList(widths)
                low, high = sorted((h1[k] % (n + 1), h2[k] % (n + 1)))
                firsts.append(index.reach(low))
                seconds.append(index.reach(high))
            columns = [batch.column(c) for c in ("row", "text", "form")]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(x, pa.int64()) for x in (counts, firsts, seconds))], names)

    cut = chosen.mapInArrow(run, schema)

    def part(start, stop):
        return F.substr("text", (start + 1).cast("int"), (stop - start).cast("int"))

    end = F.length("text").cast("long")
    prefix, middle = part(F.lit(0), F.col("first")), part(F.col("first"), F.col("second"))
    suffix = part(F.col("second"), end)
    output = (
        F.when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .otherwise(F.col("text"))
    )
    return cut.select(
        "row.doc_id",
        "n",
        "form",
        F.col("first").alias("prefix_chars"),
        (F.col("second") - F.col("first")).alias("middle_chars"),
        output.alias("output"),
        *[F.col("row")[c].alias(c) for c in keep],
    )


def restored(output: Column, form: Column) -> Column:
    """The text of which ``output`` was made, from it and its form alone."""

    def piece(value, marker, number):
        return F.split_part(value, F.lit(marker), F.lit(number))

    body = F.substr(output, F.lit(len(PREFIX) + 1))
    behind = piece(body, SUFFIX, 2)
    psm = F.concat(piece(body, SUFFIX, 1), piece(behind, MIDDLE, 2), piece(behind, MIDDLE, 1))
    behind = piece(body, PREFIX, 2)
    spm = F.concat(piece(behind, MIDDLE, 1), piece(behind, MIDDLE, 2), piece(body, PREFIX, 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    made = transform(docs, **options)
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
