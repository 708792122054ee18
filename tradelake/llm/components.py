"""Connected components of an undirected graph, in Spark jobs.

Alternating rounds: the large-star round hangs a node's larger neighbours on
its smallest neighbour, the small-star round does the same for its smaller
ones. Trees shrink to stars in a number of rounds that grows with the
logarithm of a component's diameter. Every round is an aggregate (combined
before the shuffle) and a join whose hot keys Spark can split, and is written
to the shared folder, so no component is ever gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradelake.llm.common import staged


def _star(edges: DataFrame, name: str) -> DataFrame:
    """Hang every neighbour of ``u`` on the smallest of ``u`` and its neighbours."""
    least = staged(edges.groupBy("u").agg(F.min("v").alias("m")), name + "-least")
    return (edges.join(least, "u").withColumn("m", F.least("m", "u"))
            .select("u", "v", "m"))


def connected_components(edges: DataFrame, name: str = "cc", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a and b, same type); root is the smallest node reached."""
    def clean(df):
        return df.where("u > v").distinct()

    def state(df):
        s = df.agg(F.count("*").alias("n"), F.expr("coalesce(bit_xor(xxhash64(u, v)), 0L)").alias("x")).first()
        return s["n"], s["x"]

    cur = staged(clean(edges.selectExpr("greatest(a, b) as u", "least(a, b) as v")), f"{name}-0")
    last = state(cur)
    for k in range(1, max_rounds + 1):
        both = cur.union(cur.selectExpr("v as u", "u as v"))
        large = staged(clean(_star(both, f"{name}-l{k}").where("v > u").selectExpr("v as u", "m as v")), f"{name}-large{k}")
        small = _star(large, f"{name}-s{k}")
        cur = staged(clean(small.selectExpr("v as u", "m as v").union(small.selectExpr("u", "m as v"))), f"{name}-{k}")
        now = state(cur)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("connected components did not settle")
    return cur.selectExpr("u as node", "v as root").union(cur.selectExpr("v as node", "v as root").distinct())
