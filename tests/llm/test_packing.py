from collections import Counter

from slatework.llm import packing
from tests.llm import brute, cases


def check(docs):
    out = packing.digest(docs).collect()
    mine = sorted(((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out), key=repr)
    assert mine == brute.pack(cases.pairs(docs))
    assert len({r.sequence_id for r in out}) == len(out)
    assert all(r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= 1024 for r in out)


def test_odd_rows(spark):
    check(cases.frame(spark, cases.odd_texts()).repartition(3))


def test_documents(spark):
    check(cases.table(spark, "documents"))


def test_empty_table(spark):
    assert packing.digest(cases.frame(spark, [])).count() == 0


def test_ids_restore_the_text(spark):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = cases.frame(spark, [(1, "Some text, twice. " * 500), (2, "<|endoftext|> is text")])
    rows = packing.pack(docs).orderBy("doc_id", "start").collect()
    for doc_id, text in cases.pairs(docs):
        ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in rows if r.doc_id == doc_id])
        assert ids[-1] == 0 and tokenizer.decode(ids[:-1].tolist(), skip_special_tokens=False) == text


def test_every_code_point_splits_like_the_tokenizer():
    """The pre-tokenisation rule agrees with the tokenizer's own on every character."""
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    encoder = packing.Encoder(path)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    # Also without the characters that send a text to the general rule.
    points = [c for c in points if c < 0x80 or encoder._cut._only_latin(chr(c))] + points
    texts = ["".join(f"a{chr(c)}b {chr(c)}1{chr(c)} {chr(c)}  x" for c in points[k : k + 500]) for k in range(0, len(points), 500)]
    for text, mine in zip(texts, encoder(texts)):
        theirs = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.array_equal(np.frombuffer(mine, "<u4"), theirs)


def test_piece_lengths():
    assert packing.piece_lengths(1) == [1]
    assert packing.piece_lengths(1023) == [512, 256, 128, 64, 32, 16, 8, 4, 2, 1]
    assert packing.piece_lengths(2048 + 6) == [1024, 1024, 4, 2]
    assert Counter(packing.piece_lengths(10 * 1024)) == {1024: 10}


def test_added_tokens_keep_their_ids():
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    mark = "<|endoftext|>"
    texts = [
        mark, mark * 3, f"a {mark} b", f" a  {mark}\n\nx  y", f"it{mark}'s", f"<|{mark}|>", mark.upper(), mark[:-1], f"é{mark}日本{mark}",
        f"<|endof{mark}text|>", "", "no marker  at all",
    ]
    for text, mine in zip(texts, packing.Encoder(path)(texts)):
        assert np.frombuffer(mine, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(next(packing.Encoder(path)([mark])), "<u4").tolist() == [50256]
