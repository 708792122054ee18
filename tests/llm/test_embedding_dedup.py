"""Embedding classes against all pairs; recall of the graph against brute force."""
import numpy as np
import pytest

from tradelake.llm.embedding_dedup import embedding_classes, linked_pairs
from tradelake.llm.hnsw import Graph
from tradelake.llm.queries import op10_embedding_dedup


def brute(rows, least=0.98):
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    ok = []
    for i, v, l in rows:
        good = l is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        u = np.array(v, np.float64) if good else None
        ok.append(u / np.linalg.norm(u) if good else None)
    for a in range(n):
        for b in range(a + 1, n):
            if ok[a] is not None and ok[b] is not None and rows[a][2] == rows[b][2] and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= least:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    best = {}
    for k, (i, _, _) in enumerate(rows):
        r = find(k)
        best[r] = min(x for x in (best.get(r), i) if x is not None) if (best.get(r) is not None or i is not None) else None
    return sorted(((i, links[k], best[find(k)], i == best[find(k)]) for k, (i, _, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


def _rows(seed=0, n=500, dim=16):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim))
    v[n // 2:] = v[rng.integers(0, 12, n - n // 2)] + rng.normal(scale=0.06, size=(n - n // 2, dim))
    v = v.astype(np.float32).astype(float)
    rows = [(i, v[i].tolist(), int(rng.integers(0, 2))) for i in range(n)]
    return rows + [(n + k, rows[k * 40][1], rows[k * 40][2]) for k in range(8)]


def _frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id bigint, embedding array<float>, label int, node int, shard int")


def test_matches_all_pairs_in_one_and_in_many_shards(spark):
    rows = _rows()
    df = _frame(spark, rows)
    want = brute(rows)
    assert got(embedding_classes(df)) == want
    assert got(embedding_classes(df, shard_rows=60)) == want


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1),
            (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [], 1), (11, [1.0, 0.0, 0.0], 1),
            (2, [2.0, 0.0], 1), (12, [1e-30, 0.0], 1), (13, [0.0, 1.0], 1), (None, [0.0, 1.0], 1)]
    assert got(embedding_classes(_frame(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert embedding_classes(_frame(spark, [])).count() == 0


def test_query_matches_all_pairs(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert got(op10_embedding_dedup(spark, sf)) == brute(rows)


def test_recall_of_the_graph():
    rng = np.random.default_rng(5)
    v = rng.normal(size=(3000, 24))
    v[1000:2000] = v[:1000] + rng.normal(scale=0.03, size=(1000, 24))
    v[2000:] = v[7] + rng.normal(scale=0.02, size=(1000, 24))  # one large family
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    near = v @ v.T >= 0.98
    q, n = linked_pairs(Graph(v), v, v, 0.98, 0.995)
    assert near[q, n].all() and len(set(zip(q.tolist(), n.tolist()))) >= 0.99 * near.sum()


def _unit(v):
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _lost(n, family, groups, seed=9, dim=24):
    """Vectors, queries and a graph that cannot reach the nodes of small groups; ``family`` of the vectors are near copies."""
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim))
    v[:family] = v[0] + rng.normal(scale=0.02, size=(family, dim))
    other = rng.normal(size=(n, dim))
    other[:family] = v[0] + rng.normal(scale=0.02, size=(family, dim))
    at = np.arange(n - groups, n)
    other[rng.permutation(np.arange(family, n))[:groups]] = v[at] + rng.normal(scale=0.01, size=(groups, dim))
    v, other = _unit(v), _unit(other)
    g = Graph(v)
    assert g.entry not in at
    for links in g.links:
        links[np.isin(links, at)] = -1
    return v, other, g


@pytest.mark.parametrize("n,family,groups", [
    (40, 0, 5),        # a shard no larger than the first beam
    (1500, 0, 15),     # 1 % of the vectors link
    (2000, 0, 600),    # no beam reaches the lost nodes
    (2000, 1000, 150)  # nearly all links are those of one family
])
def test_lost_links_are_found(n, family, groups):
    v, other, g = _lost(n, family, groups)
    near = other @ v.T >= 0.98
    q, k = linked_pairs(g, v, other, 0.98, 0.995)
    got = set(zip(q.tolist(), k.tolist()))
    small = set(zip(*(x.tolist() for x in np.nonzero(near)))) if not family else {
        (a, b) for a, b in zip(*(x.tolist() for x in np.nonzero(near))) if b >= n - groups}
    assert near[q, k].all() and len(q) == len(got) and len(small) >= groups
    assert small <= got
