from slatework.llm import decontaminate
from tests.llm import brute, cases

PASSAGE = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"


def check(docs, items):
    mine = cases.result(decontaminate.contamination(docs, items))
    assert mine == brute.contamination(cases.pairs(docs), cases.pairs(items, "item_id"))
    return mine


def test_odd_rows(spark):
    items = [(1, PASSAGE), (2, PASSAGE), (3, "one"), (4, None), (5, ""), (6, "école É"), (7, "x x x x x x"), (None, "nul")]
    mine = check(
        cases.frame(spark, cases.odd_texts(PASSAGE)).repartition(3),
        cases.frame(spark, items, ("item_id", "text")),
    )
    assert sum(r[-1] for r in mine) > 3


def test_documents(spark):
    data = "/root/testdata/sf0.01"
    mine = check(cases.table(spark, "documents", data), cases.table(spark, "benchmark", data))
    assert any(r[-1] for r in mine)


def test_empty_tables(spark):
    docs, none = cases.frame(spark, [(1, "a b c")]), cases.frame(spark, [], ("item_id", "text"))
    assert check(docs, none)[0][-1] is False
    assert decontaminate.contamination(docs.where("false"), none).count() == 0
