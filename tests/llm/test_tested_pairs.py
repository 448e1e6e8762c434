"""Pairs are decided by Spark's own array functions, and what gives the edges runs once."""

from eventide.llm import minhash as M


def test_pairs_are_decided_without_python(spark, monkeypatch):
    plans = []

    def kept(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(M, "written", kept)
    sets = spark.createDataFrame(
        [(1, list(range(10))), (2, list(range(8))), (3, list(range(3, 13))), (4, list(range(1, 10)) + [99])],
        "node long, elements array<long>")
    pairs = spark.createDataFrame([(2, 1), (3, 1), (4, 1)], "node long, leader long")
    found = {(r["node"], r["leader"]): r["near"] for r in M.tested_pairs(pairs, sets, 0.8).collect()}
    assert found == {(2, 1): True, (3, 1): False, (4, 1): True}  # 8 of 10 (the threshold), 7 of 13, 9 of 11
    assert "MapInArrow" not in plans[0]


def test_components_run_their_edges_once(spark):
    ran = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            ran.add(batch.num_rows)
            yield batch

    edges = spark.createDataFrame([(2, 1), (3, 2), (5, 4)], "node long, leader long").mapInArrow(
        counted, "node long, leader long")
    assert {(r["node"], r["root"]) for r in M.components(edges).collect()} == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)}
    assert ran.value == 3
