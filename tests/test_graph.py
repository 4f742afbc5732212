"""Connected components."""

from quire.operators import graph
from quire.operators.graph import connected_components


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 101), (101, 102), (102, 100), (7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected_components(df, "a", "b").collect()}
    assert got == {i: 0 for i in range(21)} | {100: 100, 101: 100, 102: 100}
    assert connected_components(df.limit(0), "a", "b").count() == 0


def test_components_within_keys(spark, monkeypatch):
    monkeypatch.setattr(graph, "PORTION", 7)
    edges = [("x", f"n{i:02}", f"n{i + 1:02}") for i in range(30)] + [("y", f"m{i}", "m0") for i in range(9)] + [("z", "c", "b"), ("z", "b", "a"), ("z", "e", "d"), (None, "q", "p")]
    df = spark.createDataFrame(edges, "k string, a string, b string")
    got = {r.node: r.component for r in connected_components(df, "a", "b", within="k").collect()}
    plain = {r.node: r.component for r in connected_components(df, "a", "b").collect()}
    assert got == plain and len(set(got.values())) == 5
