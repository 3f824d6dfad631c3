"""Secret scan over an incremental blob ledger.

Texts are content-addressed: a blob is the SHA-256 of its bytes, however many
paths (documents, versions) hold it. The ledger lists the pairs of blob and
rule version that were scanned before. Only unseen pairs are scanned, each blob
once, and findings are joined back to every path. DataFrame functions only.

Spans are code-point offsets of whole matches, end exclusive. A match position
is the length of everything before it: the text is split by the rule, gaps and
matches alternate, and a running sum over one blob's gaps and matches gives the
offsets.

Defined results: null text is empty; repeated rows are returned each; rows with
null ``doc_id`` are kept; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slatework.llm.sampling import free_name
from slatework.session import stage


@dataclass(frozen=True)
class Rule:
    """One kind of secret. ``pattern`` has the checked value as group ``group``."""

    name: str
    version: int
    pattern: str
    group: int
    least: int

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


# The three base rules, in the order in which kinds are listed.
# A run of hexadecimal digits, or of capitals after AKIA, is matched whole or
# not at all, so its least length can stand in the pattern.
RULES = (
    Rule(
        "assign",
        1,
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        1,
        8,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}", 0, 16),
    Rule("hex", 1, r"[0-9a-f]{32,}", 0, 32),
)


def content_address(text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256))


def _hits(text: Column, rule: Rule, number: int) -> Column:
    pattern = F.lit(rule.pattern)
    zipped = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("value"),
    )
    return F.transform(
        zipped,
        lambda x, i: F.struct(
            F.lit(number).alias("rule"),
            i.alias("i"),
            F.char_length(x["gap"]).alias("gap"),
            F.char_length(x["hit"]).alias("len"),
            F.char_length(x["value"]).alias("value_len"),
        ),
    )


def versions(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, blob) per input row."""
    return docs.select(F.col(id_column).alias("doc_id"), content_address(F.col(text_column)).alias("blob"))


def unseen_blobs(docs: DataFrame, ledger: DataFrame | None, rules=RULES, text_column: str = "text") -> DataFrame:
    """(blob, text, todo): each blob once, with the numbers of the rules not yet run on it."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    blobs = (
        docs.select(content_address(F.col(text_column)).alias("blob"), text.alias("text"))
        .groupBy("blob")
        .agg(F.first("text").alias("text"))
    )
    every = F.array(*[F.lit(k) for k in range(len(rules))])
    if ledger is None:
        return blobs.withColumn("todo", every)
    numbers = {rule.key: k for k, rule in enumerate(rules)}
    number = F.coalesce(*[F.when(F.col("rule_version") == key, F.lit(k)) for key, k in numbers.items()])
    seen = ledger.select("blob", number.alias("k")).where("k is not null")
    seen = seen.groupBy("blob").agg(F.collect_set("k").alias("seen"))
    todo = F.array_except(every, F.coalesce("seen", F.array().cast("array<int>")))
    return blobs.join(seen, "blob", "left").withColumn("todo", todo).drop("seen").where(F.size("todo") > 0)


def scan_blobs(blobs: DataFrame, rules=RULES) -> DataFrame:
    """Findings (blob, rule, start, end), ``rule`` being the rule's number."""
    text = F.col("text")
    empty = F.expr("cast(array() as array<struct<rule:int,i:int,gap:int,len:int,value_len:int>>)")
    hits = [
        F.when(F.array_contains("todo", k) & text.rlike(rule.pattern), _hits(text, rule, k)).otherwise(empty)
        for k, rule in enumerate(rules)
    ]
    rows = blobs.select("blob", F.inline(F.concat(*hits)))
    order = Window.partitionBy("blob", "rule").orderBy("i")
    through = F.sum(F.col("gap").cast("long") + F.coalesce("len", F.lit(0))).over(
        order.rowsBetween(Window.unboundedPreceding, 0)
    )
    least = F.element_at(F.array(*[F.lit(rule.least) for rule in rules]), F.col("rule") + 1)
    return (
        rows.withColumn("end", through)
        .where(F.col("len").isNotNull() & (F.col("value_len") >= least))
        .select("blob", "rule", (F.col("end") - F.col("len")).alias("start"), "end")
    )


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules=RULES, text_column: str = "text"):
    """(findings, ledger rows) of what was not scanned before; both are written tables.

    Append both to the tables of earlier runs: findings of a pair that the
    ledger already holds are in the earlier findings.
    """
    keys = F.array(*[F.lit(rule.key) for rule in rules])
    blobs = unseen_blobs(docs, ledger, rules, text_column)
    names = F.element_at(F.array(*[F.lit(rule.name) for rule in rules]), F.col("rule") + 1)
    found = scan_blobs(blobs, rules).withColumn("rule_name", names)
    done = unseen_blobs(docs, ledger, rules, text_column).select(
        "blob", F.explode(F.transform("todo", lambda k: F.element_at(keys, k + 1))).alias("rule_version")
    )
    return found, done


def per_blob(findings: DataFrame, rules=RULES) -> DataFrame:
    """One row per blob with findings: n_<rule> for each rule and ``spans``, joined text."""
    span = F.struct("start", "rule", "end")
    names = F.array(*[F.lit(rule.name) for rule in rules])
    spans = F.transform(
        F.sort_array(F.collect_list(span)),
        lambda s: F.concat_ws(
            ":", F.element_at(names, s["rule"] + 1), s["start"].cast("string"), s["end"].cast("string")
        ),
    )
    counts = [
        F.count(F.when(F.col("rule") == k, 1)).alias(f"n_{rule.name}") for k, rule in enumerate(rules)
    ]
    return findings.groupBy("blob").agg(*counts, F.array_join(spans, ",").alias("spans"))


def path_findings(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rules=RULES) -> DataFrame:
    """Per input row: doc_id, n_<rule> and spans (empty text if none)."""
    found, _ = scan(docs, None, rules, text_column)
    digest = stage(per_blob(found, rules), "secret-findings")
    joined = versions(docs, id_column, text_column).join(digest, "blob", "left")
    counts = [F.coalesce(f"n_{rule.name}", F.lit(0)).cast("long").alias(f"n_{rule.name}") for rule in rules]
    return joined.select("doc_id", *counts, F.coalesce("spans", F.lit("")).alias("spans"))


def digest(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans. The rules are the base rules alone."""
    found = path_findings(docs, id_column, text_column)
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("spans"), 256).alias("base_sha256"), "spans"
    )


def redact(docs: DataFrame, marker: str = "[secret]", text_column: str = "text", rules=RULES) -> DataFrame:
    """``docs`` with every found span replaced by ``marker``; overlapping spans become one marker.

    Texts without findings stay as they are; each blob is cut once. Rows that no
    rule's pattern matches pass by, so that only texts with a match are moved.
    """
    matched = F.lit(False)
    for rule in rules:
        matched = matched | F.coalesce(F.col(text_column).rlike(rule.pattern), F.lit(False))
    clean, every = docs.where(~matched), docs.columns
    docs = docs.where(matched)
    blobs = unseen_blobs(docs, None, rules, text_column)
    found = scan_blobs(blobs, rules)
    before = Window.partitionBy("blob").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.withColumn("reached", F.coalesce(F.max("end").over(before), F.lit(0)))
    spans = spans.where(F.col("end") > F.col("reached"))
    blob, cuts = free_name("_blob", docs.columns), free_name("_spans", docs.columns)
    listed = F.sort_array(F.collect_list(F.struct("start", "end", "reached")))
    spans = stage(spans.groupBy(F.col("blob").alias(blob)).agg(listed.alias(cuts)), "secret-spans")
    joined = docs.withColumn(blob, content_address(F.col(text_column))).join(spans, blob, "left")
    text = F.col(text_column)
    # Text before each span (none where it overlaps the one before), the markers, and the rest.
    pieces = F.transform(
        cuts,
        lambda s: F.when(
            (s["start"] >= s["reached"]),
            F.concat(
                F.substring(text, (s["reached"] + 1).cast("int"), (s["start"] - s["reached"]).cast("int")),
                F.lit(marker),
            ),
        ).otherwise(F.lit("")),
    )
    last = F.element_at(cuts, -1)["end"]
    rest = F.substring(text, (last + 1).cast("int"), F.char_length(text))
    cut = F.when(F.col(cuts).isNull(), text).otherwise(F.concat(F.array_join(pieces, ""), rest))
    redacted = joined.select(*[cut.alias(c) if c == text_column else F.col(f"`{c}`") for c in every])
    return clean.union(redacted)
