import random

from tradelake.llm.components import connected_components


def test_long_chain_and_random_graph(spark):
    rng = random.Random(1)
    chain = list(range(300))
    rng.shuffle(chain)
    edges = list(zip(chain, chain[1:])) + [(1000 + rng.randrange(80), 1000 + rng.randrange(80)) for _ in range(60)] + [(7, 7)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got.get(x, x) == find(x) for x in root)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
