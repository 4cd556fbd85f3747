"""Connected components by repeated contraction towards the smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable


def connected_components(edges: DataFrame, by: list[str]) -> DataFrame:
    """``edges(by.., a, b)`` -> ``(by.., node, root)``; root = smallest node of the component.

    Each round every node points at its smallest neighbour, pointers are followed four steps, and the
    graph shrinks to the targets. The per-round maps are kept and composed backwards, so labels of the
    full node set are touched once. Nodes without an edge do not appear in the result.
    """
    both = edges.select(*by, "a", "b").unionByName(
        edges.select(*by, F.col("b").alias("a"), F.col("a").alias("b")))
    graph = durable(both.where("a <> b").distinct())
    rounds: list[DataFrame] = []
    while not graph.isEmpty():
        hop = graph.groupBy(*by, F.col("a").alias("node")).agg(
            F.least(F.col("node"), F.min("b")).alias("to"))
        near = _follow(hop, hop, by)
        hop = durable(_follow(near, near, by))
        rounds.append(hop)
        ends = hop.select(*by, F.col("node").alias("a"), F.col("to").alias("ta"))
        oths = hop.select(*by, F.col("node").alias("b"), F.col("to").alias("tb"))
        graph = durable(graph.join(ends, [*by, "a"]).join(oths, [*by, "b"])
                        .where("ta <> tb")
                        .select(*by, F.col("ta").alias("a"), F.col("tb").alias("b")).distinct())
    if not rounds:
        return graph.select(*by, F.col("a").alias("node"), F.col("b").alias("root"))
    labels = rounds.pop()
    while rounds:
        labels = durable(_follow(rounds.pop(), labels, by))
    return labels.select(*by, "node", F.col("to").alias("root"))


def _follow(first: DataFrame, then: DataFrame, by: list[str]) -> DataFrame:
    nxt = then.select(*by, F.col("node").alias("to"), F.col("to").alias("_far"))
    return (first.join(nxt, [*by, "to"], "left")
            .select(*by, "node", F.coalesce("_far", "to").alias("to")))
