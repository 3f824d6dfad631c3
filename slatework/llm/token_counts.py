"""Token counts by distinct pre-tokens.

Byte-level vocabularies never merge across pre-tokens, so a document's number
of tokens is the sum, over its distinct pre-tokens, of frequency times pieces.
Pieces are counted once per distinct pre-token of the corpus and joined to the
per-document frequencies; no token id of a document is ever made.

The join has two ways, which together cover every pre-token:

* the ``listed`` commonest pre-tokens of a sample of documents go, with their
  pieces, to all executors (at most ``listed`` rows of at most ``LONGEST_LISTED``
  characters) and are summed while a document is read;
* all others leave as rows (document, pre-token, frequency), are made distinct,
  counted, and joined by shuffle.

The sample only decides which way a pre-token takes, never what is counted.

Defined results: a null or empty text has no bytes and no tokens; repeated rows
and repeated or null ids are counted each for itself; ties in the sample are
broken by the pre-token; very long texts are cut whole, their rows leave in
parts of bounded size; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import compress

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatework.llm.pretokens import PreTokens, default_vocabulary
from slatework.llm.sampling import rank_hash
from slatework.session import stage

#: Pre-tokens that travel to the executors, and the most characters of one.
LISTED = 100_000
LONGEST_LISTED = 64
#: About so many documents are read to choose them.
SAMPLE = 20_000
#: Rows of one Arrow batch that leaves a task.
_BATCH = 100_000


def _counted(words: DataFrame, vocabulary: str) -> DataFrame:
    """(word, pieces) of a column of distinct pre-tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = None
        for batch in batches:
            cut = cut or PreTokens(vocabulary)
            pieces = pa.array(cut.pieces(batch.column(0).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pieces], ["word", "pieces"])

    return words.select("word").mapInArrow(run, "word string, pieces bigint")


def listed_pieces(docs: DataFrame, vocabulary: str, listed: int = LISTED, sample: int = SAMPLE) -> dict[str, int]:
    """Pieces of the commonest pre-tokens of about ``sample`` documents; at most ``listed`` entries."""
    rows = docs.count()
    if not rows or not listed:
        return {}
    limit = min(1 << 31, (sample << 31) // rows + 1)
    # Texts, not ids, decide: ids may be null or repeated.
    chosen = docs.where(F.col("text").isNotNull() & (rank_hash(F.col("text"), "token-counts") < limit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, seen = PreTokens(vocabulary), Counter()

        def flush():
            short = [w for w in seen if len(w) <= LONGEST_LISTED]
            columns = [pa.array(short, pa.string()), pa.array([seen[w] for w in short], pa.int64())]
            seen.clear()
            return pa.RecordBatch.from_arrays(columns, ["word", "times"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(cut(text))
                if len(seen) > _BATCH:
                    yield flush()
        yield flush()

    counts = chosen.select("text").mapInArrow(run, "word string, times bigint").groupBy("word").agg(F.sum("times").alias("times"))
    common = counts.orderBy(F.desc("times"), "word").limit(listed)
    return {r["word"]: r["pieces"] for r in _counted(common, vocabulary).collect()}


def frequencies(docs: DataFrame, vocabulary: str, pieces: dict[str, int]) -> DataFrame:
    """(row, doc_id, n_bytes, tokens, word, times): a row per document with the tokens of listed
    pre-tokens and a null ``word``, and a row per document and other distinct pre-token."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    names = ["row", "doc_id", "n_bytes", "tokens", "word", "times"]
    kinds = [T.LongType(), docs.schema["doc_id"].dataType, T.LongType(), T.LongType(), T.StringType(), T.LongType()]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])
    long = pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, known = PreTokens(vocabulary), shared.value.get
        for batch in batches:
            row, ids, sizes = batch.column(0), batch.column(1), batch.column(2)
            tokens, at, words, times = [], [], [], []

            def flush():
                nothing = pa.nulls(len(at), long)
                columns = [row.take(pa.array(at, long)), pa.nulls(len(at), ids.type), nothing, nothing, pa.array(words, pa.string()), pa.array(times, long)]
                for gathered in (at, words, times):
                    gathered.clear()
                return pa.RecordBatch.from_arrays(columns, names)

            for k, text in enumerate(batch.column(3).to_pylist()):
                found = cut(text) if text else []
                counted = list(map(known, found))
                tokens.append(sum(filter(None, counted)))
                others = Counter(compress(found, [n is None for n in counted]))
                del found, counted
                for start in range(0, len(others), _BATCH):
                    part = list(others.items())[start : start + _BATCH]
                    at.extend([k] * len(part))
                    words.extend(w for w, _ in part)
                    times.extend(n for _, n in part)
                    if len(at) >= _BATCH:
                        yield flush()
            if at:
                yield flush()
            nothing = pa.nulls(len(tokens), long)
            yield pa.RecordBatch.from_arrays([row, ids, sizes, pa.array(tokens, long), pa.nulls(len(tokens), pa.string()), nothing], names)

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", size.alias("n_bytes"), "text")
    return numbered.mapInArrow(run, schema)


def token_counts(
    docs: DataFrame,
    vocabulary: str | None = None,
    limit: int = 512,
    id_column: str = "doc_id",
    text_column: str = "text",
    listed: int = LISTED,
    sample: int = SAMPLE,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens); one row per input row."""
    path = vocabulary or default_vocabulary()
    docs = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    # Written, so that the numbers of the rows are given once.
    found = stage(frequencies(docs, path, listed_pieces(docs, path, listed, sample)), "pre-tokens")
    others = found.where("word is not null").select("row", "word", "times")
    pieces = _counted(others.select("word").distinct(), path)
    joined = others.join(pieces, "word").select("row", (F.col("times") * F.col("pieces")).alias("tokens"))
    own = found.where("word is null").select("row", F.struct("doc_id", "n_bytes").alias("document"), "tokens")
    every = own.unionByName(joined.groupBy("row").agg(F.sum("tokens").alias("tokens")), allowMissingColumns=True)
    counts = every.groupBy("row").agg(F.first("document", ignorenulls=True).alias("document"), F.sum("tokens").alias("n_tokens"))
    return counts.select("document.doc_id", "document.n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
