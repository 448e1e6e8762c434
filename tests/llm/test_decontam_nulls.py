"""Benchmark items without id, and documents with columns named as results are."""

import pandas as pd

from eventide.llm import decontam
from eventide.llm.common import importable

DOCS = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "alpha beta"), (3, None),
        (4, "x alpha beta one two three four five six seven eight nine ten y"), (5, "nothing here")]
ITEMS = [(None, "one two three four five six seven eight nine ten"), (7, "alpha beta"), (None, "Alpha, beta!"), (8, None)]


def tables(spark):
    importable(spark)
    return spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")


def test_items_without_id_as_in_sql(spark):
    import duckdb

    docs, bench = tables(spark)
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(DOCS, columns=["doc_id", "text"]))
    con.register("benchmark", pd.DataFrame(ITEMS, columns=["item_id", "text"]).astype({"item_id": "Int64"}))
    want = sorted(con.execute(decontam.SQL).fetchall())
    assert [w[5] for w in want] == [True, True, False, True, False]
    for words in (decontam.BLOCK_WORDS, 5):
        assert sorted(map(tuple, decontam.decontaminate(docs, bench, block_words=words).collect())) == want


def test_columns_named_as_results(spark):
    docs, bench = tables(spark)
    more = docs.selectExpr("*", "1 n_words", "'h' hits", "'i' items")
    kept = decontam.drop_contaminated(more, bench)
    assert kept.columns == more.columns and sorted(r.doc_id for r in kept.collect()) == [3, 5]
    cut = {r.doc_id: r.text for r in decontam.cut_spans(more, bench).collect()}
    assert {k: t and t.split() for k, t in cut.items()} == {
        1: ["eleven", "twelve"], 2: "", 3: None, 4: ["x", "y"], 5: ["nothing", "here"]}
