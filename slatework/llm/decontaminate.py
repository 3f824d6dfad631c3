"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

Every item is cut into windows of 13 words (a shorter item is one window), and
every window into word shingles. A document can contain a window only if it
contains all of the window's shingles, so one of them, the necessary prefix,
finds every candidate: the shingle that is rarest in the whole corpus. Its
offset in the window fixes where the window would start in the document; the
start must not lie before the document and the end not beyond it. Words of the
remaining candidates are compared one by one.

Document shingles are tested against a bitmap of fixed size (``BITMAP_BITS``)
before anything is shuffled. The bitmap only saves work: what passes by chance
is removed by the join.

Defined results: null text has no words; repeated rows are judged each for
itself; items without words or with a null id are ignored; an empty benchmark
leaves every document clean; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slatework.session import stage

WINDOW = 13
SHINGLE = 5
BITMAP_BITS = 1 << 22
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _CAPITALS, _CAPITALS.lower()))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(_WORD), F.lit(0))


def item_windows(benchmark: DataFrame, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """(item_id, wid, words, len) per window of each item; ``wid`` addresses the window's words."""
    items = benchmark.select(F.col(id_column).alias("item_id"), words_of(F.col(text_column)).alias("w"))
    items = items.where(F.col("item_id").isNotNull() & (F.size("w") > 0))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - F.lit(WINDOW - 1), F.lit(1)))
    windows = items.select("item_id", "w", F.explode(starts).alias("s")).select(
        "item_id", F.slice("w", F.col("s"), WINDOW).alias("words")
    )
    return windows.select(
        "item_id",
        F.unhex(F.sha2(F.encode(F.array_join("words", " "), "UTF-8"), 256)).alias("wid"),
        "words",
        F.size("words").alias("len"),
    ).distinct()


def _shingle(words: Column, at: Column, width: int) -> Column:
    return F.xxhash64(*[F.get(words, at + F.lit(k)) for k in range(width)])


def window_shingles(windows: DataFrame, widths: list[int]) -> DataFrame:
    """(wid, words, len, width, off, h): all shingles of the distinct windows."""
    distinct = windows.select("wid", "words", "len").dropDuplicates(["wid"])
    parts = None
    for width in widths:
        own = distinct.where(F.least("len", F.lit(SHINGLE)) == width)
        part = own.select("*", F.explode(F.sequence(F.lit(0), F.col("len") - width)).alias("off")).select(
            "wid", "words", "len", F.lit(width).alias("width"), "off", _shingle(F.col("words"), F.col("off"), width).alias("h")
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


def _slot(h: Column) -> Column:
    return F.shiftright(F.pmod(h, F.lit(BITMAP_BITS).cast("long")), 6).cast("int")


def _bit(h: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(h, F.lit(64).cast("long")).cast("int"))


def bitmap(shingles: DataFrame) -> Column:
    """Scalar subquery: BITMAP_BITS bits as an array of longs, set for every shingle."""
    slots = BITMAP_BITS // 64
    filled = shingles.groupBy(_slot(F.col("h")).alias("slot")).agg(F.bit_or(_bit(F.col("h"))).alias("bits"))
    every = shingles.sparkSession.range(slots).select(F.col("id").cast("int").alias("slot"))
    row = every.join(filled, "slot", "left").agg(
        F.sort_array(F.collect_list(F.struct("slot", F.coalesce("bits", F.lit(0)).alias("bits")))).alias("x")
    )
    return row.select(F.transform("x", lambda x: x["bits"]).alias("bitmap")).scalar()


def marks(docs: DataFrame, bits: Column | None, widths: list[int], id_column: str, text_column: str) -> DataFrame:
    """Per document one row with ``pos`` -1, and one per shingle that the bitmap lets pass.

    Passing rows carry the words around them, from which a window can be
    verified: ``ctx`` begins at word ``greatest(0, pos - WINDOW + 1)``.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(id_column).alias("doc_id"),
        words_of(F.col(text_column)).alias("w"),
    ).withColumn("n_words", F.size("w"))
    nothing = [
        F.lit(None).cast("int").alias("width"),
        F.lit(None).cast("long").alias("h"),
        F.lit(None).cast("array<string>").alias("ctx"),
    ]
    if not widths:
        return rows.select("uid", "doc_id", "n_words", F.lit(-1).alias("pos"), *nothing)
    spread = rows.select("*", F.explode(F.sequence(F.lit(-1), F.col("n_words") - 1)).alias("pos"))
    pos, words = F.col("pos"), F.col("w")

    def passes(width: int) -> Column:
        h = _shingle(words, pos, width)
        set_bit = F.get(bits, _slot(h)).bitwiseAND(_bit(h)) != 0
        return (pos >= 0) & (pos <= F.col("n_words") - width) & set_bit

    some = pos == -1
    for width in widths:
        some = some | passes(width)
    kept = spread.where(some)
    if len(widths) == 1:
        width = widths[0]
        of = F.when(pos >= 0, F.array(F.lit(width)))
    else:
        of = F.when(pos >= 0, F.array_compact(F.array(*[F.when(passes(k), F.lit(k)) for k in widths])))
    kept = kept.withColumn("width", F.explode_outer(of))
    h = F.coalesce(*[F.when(F.col("width") == k, _shingle(words, pos, k)) for k in widths])
    first = F.greatest(pos - (WINDOW - 1), F.lit(0))
    ctx = F.when(pos >= 0, F.slice(words, first + 1, 2 * WINDOW - 1))
    return kept.select(
        "uid", F.when(pos == -1, F.col("doc_id")).alias("doc_id"), "n_words", "pos", "width", h.alias("h"), ctx.alias("ctx")
    )


def find_windows(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text"):
    """(documents, hits, windows).

    ``documents``: uid, doc_id, n_words of every row. ``hits``: uid, start,
    len, wid of every occurrence of a window. ``windows``: item_id, wid.
    """
    windows = stage(item_windows(benchmark), "item-windows")
    # At most SHINGLE numbers: shingles are shorter only for items of fewer words.
    widths = sorted(r[0] for r in windows.select(F.least("len", F.lit(SHINGLE))).distinct().collect())
    shingles = stage(window_shingles(windows, widths), "window-shingles") if widths else None
    bits = bitmap(shingles) if widths else None
    marked = stage(marks(docs, bits, widths, id_column, text_column), "shingle-marks")
    documents = marked.where("pos = -1").select("uid", "doc_id", "n_words")
    if not widths:
        hits = marked.select("uid", F.col("pos").alias("start"), F.col("n_words").alias("len")).where("false")
        return documents, hits.withColumn("wid", F.lit(None).cast("binary")), windows
    marked = marked.where("pos >= 0")
    rarity = marked.groupBy("h").agg(F.count(F.lit(1)).alias("df"))
    # The necessary prefix of a window to be contained whole is one shingle: its rarest.
    # A shingle that occurs nowhere comes first and finds nothing, as it should.
    ordered = shingles.join(rarity, "h", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    prefix = ordered.groupBy("wid").agg(
        F.min(F.struct("df", "off", "h", "width", "len", "words")).alias("p")
    ).where("p.df > 0").select("wid", "p.h", "p.width", "p.off", F.col("p.len").alias("len"), F.col("p.words").alias("words"))
    start = F.col("pos") - F.col("off")
    fits = (start >= 0) & (start + F.col("len") <= F.col("n_words"))
    first = F.greatest(F.col("pos") - (WINDOW - 1), F.lit(0))
    candidates = marked.join(prefix, ["h", "width"]).where(fits)
    equal = F.slice("ctx", start - first + 1, F.col("len")) == F.col("words")
    hits = candidates.where(equal).select("uid", start.alias("start"), "len", "wid")
    return documents, stage(hits, "window-hits"), windows


def contamination(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per input row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    documents, hits, windows = find_windows(docs, benchmark, id_column, text_column)
    order = Window.partitionBy("uid").orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    covered = hits.select("uid", "start", (F.col("start") + F.col("len")).alias("end")).distinct()
    covered = covered.withColumn("reached", F.coalesce(reached, F.lit(0)))
    counts = covered.groupBy("uid").agg(
        F.sum(F.greatest(F.col("end") - F.greatest("start", "reached"), F.lit(0))).alias("n_hit")
    )
    found = hits.select("uid", "wid").distinct().join(windows.select("item_id", "wid").distinct(), "wid")
    items = found.select("uid", F.col("item_id").cast("string").alias("item")).distinct()
    items = items.groupBy("uid").agg(
        F.count(F.lit(1)).alias("n_items"), F.array_join(F.sort_array(F.collect_list("item")), ",").alias("items")
    )
    joined = documents.join(counts, "uid", "left").join(items, "uid", "left")
    n_hit, n_words = F.coalesce("n_hit", F.lit(0)).cast("long"), F.col("n_words").cast("long")
    return joined.select(
        "doc_id",
        n_words.alias("n_words"),
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * 20 >= n_words)).alias("contaminated"),
    )
