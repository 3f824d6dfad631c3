from slatework.llm import token_counts
from slatework.llm.pretokens import default_vocabulary
from tests.llm import cases


def brute(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_vocabulary())
    out = []
    for doc_id, text in rows:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        out.append((doc_id, len((text or "").encode()), n, n > 512))
    return sorted(out, key=repr)


def check(docs, **options):
    assert cases.result(token_counts.token_counts(docs, **options)) == brute(cases.pairs(docs))


def odd(spark):
    rows = cases.odd_texts() + [(70, "<|endoftext|>"), (71, "a<|endoftext|><|endoftext|> b"), (72, "x" * 600), (73, "the " * 512), (74, "the " * 511)]
    return cases.frame(spark, rows).repartition(3)


def test_odd_rows(spark):
    check(odd(spark))


def test_all_by_the_join(spark):
    """Without listed pre-tokens, and with a few, every count comes by the join: same results."""
    check(odd(spark), listed=0)
    check(odd(spark), listed=3, sample=1)


def test_documents(spark):
    check(cases.table(spark, "documents"))
    check(cases.table(spark, "documents"), listed=50)


def test_long_rows_leave_in_parts(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "_BATCH", 100)
    check(odd(spark), listed=0)


def test_empty_table(spark):
    assert token_counts.token_counts(cases.frame(spark, [])).count() == 0


def test_listed_pre_tokens_are_bounded_and_common(spark):
    docs = cases.frame(spark, [(1, "b b b c c c a"), (2, "b c" + "z" * 100)])
    found = token_counts.listed_pieces(docs, default_vocabulary(), listed=2)
    assert found == {" b": 1, " c": 1}  # " c" twice and then, of equally common ones, the first by name


def test_other_columns_are_free(spark):
    docs = cases.frame(spark, [(1, "some text")]).withColumnsRenamed({"uid": "row", "fp": "word", "pos": "tokens", "h": "times"})
    check(docs)
