"""Mixing: targets by repeated resharing, totals near them, reruns agree."""
import random

from tradelake.llm.mixing import mix, mix_plan


def reshare(sizes, weights=(3, 1, 2), budget=1.5, most=2):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    left, open_, target = budget * sum(sizes.values()), set(names), {}
    while True:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            open_.remove(s)


def corpus(seed):
    rng = random.Random(seed)
    return [(i, " ".join(["w"] * rng.randint(0, 40)), rng.choice(["hot"] * 6 + ["a", "b", "é", "Z", None])) for i in range(600)]


def test_targets_and_totals(make_docs):
    rows = corpus(1)
    plan = mix_plan(make_docs(rows)).collect()
    source = {i: s for i, _, s in rows}
    sizes = {}
    for i, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want = reshare(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in plan:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6
        assert r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 40
    assert 0 <= sum(taken.values()) - sum(want.values()) <= 40 + 1e-6


def test_reruns_agree_whatever_the_partitioning(make_docs):
    docs = make_docs(corpus(2))
    one = sorted((r.doc_id, r.taken) for r in mix_plan(docs).collect())
    two = sorted((r.doc_id, r.taken) for r in mix_plan(docs.repartition(7)).collect())
    assert one == two


def test_mixed_rows_follow_the_plan(make_docs):
    docs = make_docs(corpus(3), clash=("rid", "copies", "size", "__rid", "rank"))
    plan = {r.doc_id: r.copies for r in mix_plan(docs).collect()}
    out = mix(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == {i: c for i, c in plan.items() if c}


def test_defined_cases(make_docs):
    plan = mix_plan(make_docs([(1, None), (2, "", None), (None, "a b", "x"), (None, "a b", "x"), (3, "w " * 50_000, "y")])).collect()
    assert sorted(r.size for r in plan) == [0, 0, 2, 2, 50_000]
    assert all(r.taken <= 2 * r.size for r in plan)
    assert all(r.taken == 0 and r.target == 0 for r in mix_plan(make_docs([(1, None), (2, " ")])).collect())
    assert mix_plan(make_docs([])).count() == 0 and mix(make_docs([])).count() == 0
