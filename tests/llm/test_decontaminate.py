"""Occurrences of benchmark windows against plain loops, whole and in blocks; removal of spans and documents."""
import hashlib
import random
import re

import pytest

from tradelake.llm.decontaminate import benchmark_windows, contamination, decontaminate, find_hits
from tradelake.llm.queries import op12_decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(text, items, window=10):
    w, hit, ids = WORD.findall(lowered(text)), set(), set()
    for item, t in items:
        b = WORD.findall(lowered(t))
        k = min(window, len(b))
        wins = {tuple(b[i:i + k]) for i in range(len(b) - k + 1)} if b else set()
        for i in range(len(w) - k + 1):
            if wins and tuple(w[i:i + k]) in wins:
                hit.update(range(i, i + k))
                ids.add(item)
    named = sorted(str(i) for i in ids if i is not None)
    return len(w), len(hit), len(ids), named, hit


def bench(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


ITEMS = [(1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "short item"), (10, "ÉTÉ à l'école"),
         (3, None), (4, ""), (5, " .,; "), (6, "x"), (1, "another part of item one"), (7, "short item"), (None, "nameless thing")]
LONG = ITEMS[0][1]
TEXTS = [None, "", " ,;", LONG, f"before {LONG.upper()}! after", LONG.replace(" ", "-\n"), "alpha beta gamma delta", "SHORT item, short ITEM",
         "ÉTÉ À l école", "ÉTÉ à l école", "x", "xx x", "another part of item one two", "a nameless thing", f"{LONG} {LONG}",
         "beta gamma delta epsilon zeta eta theta iota kappa lambda", "beta gamma delta epsilon zeta eta theta iota kappa lambd",
         "word " * 30000 + "short item"]


@pytest.mark.parametrize("window,max_windows", [(10, 250_000), (10, 3), (3, 250_000), (1, 250_000)])
def test_hits_match_brute_force(spark, make_docs, window, max_windows):
    rng = random.Random(window)
    texts = TEXTS + [" ".join(rng.choice("short item x alpha beta part of".split()) for _ in range(rng.randint(1, 30))) for _ in range(40)]
    docs = make_docs([(k, t) for k, t in enumerate(texts)] + [(3, LONG), (None, LONG)],
                     clash=("n_hit", "Spans", "key", "r", "f", "__ws", "hash"))
    got = contamination(docs, bench(spark, ITEMS), window=window, max_windows=max_windows).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        t = LONG if r["doc_id"] is None else texts[r["doc_id"]]
        n, hit, items, ids, places = brute(t, ITEMS, window)
        assert (r["n_words"], r["n_hit"], r["n_items"], r["item_ids"], r["contaminated"]) == (n, hit, items, ids, hit > 0), t
        assert {k for s in r["spans"] for k in range(s["first"], s["last"] + 1)} == places
        assert all(a["last"] + 1 < b["first"] for a, b in zip(r["spans"], r["spans"][1:]))
        assert r["key"] == 7 and r["hash"] == 7


def test_an_equal_hash_is_not_a_hit(spark, make_docs):
    windows, _ = benchmark_windows(bench(spark, [(1, "one two three")]))
    forged = windows.selectExpr("hash", "len", "'one two four' as words")
    docs = make_docs([(1, "one two three")])
    assert find_hits(docs, windows).count() == 1 and find_hits(docs, forged).count() == 0


def test_removal(spark, make_docs):
    docs = make_docs([(1, f"Keep this, {LONG}; and that."), (2, "clean\n text"), (3, None), (4, "Short item"), (5, "x, y")], clash=("n_words",))
    b = bench(spark, ITEMS)
    whole = {r["doc_id"]: r["text"] for r in decontaminate(docs, b, "documents").collect()}
    assert whole == {2: "clean\n text", 3: None}
    spans = decontaminate(docs, b)
    assert spans.columns == [c for c in docs.columns if c != "n_words"]
    assert {r["doc_id"]: r["text"] for r in spans.collect()} == {1: "Keep this; and that.", 2: "clean\n text", 3: None, 4: "", 5: ", y"}
    with pytest.raises(ValueError):
        decontaminate(docs, b, "lines")


def test_empty_tables(spark, make_docs):
    docs = make_docs([(1, LONG)])
    for empty in ([], [(1, None)], [(1, " , ")]):
        r = contamination(docs, bench(spark, empty)).first()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["item_ids"], r["spans"], r["contaminated"]) == (12, 0, 0, [], [], False)
    assert contamination(make_docs([]), bench(spark, ITEMS)).count() == 0


def test_no_python_on_the_main_path(spark, make_docs, tmp_path):
    make_docs([(1, LONG), (2, "x"), (3, "clean")]).write.parquet(str(tmp_path / "documents.parquet"))
    bench(spark, ITEMS).write.parquet(str(tmp_path / "benchmark.parquet"))
    df = op12_decontaminate(spark, str(tmp_path))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
    got = {r["doc_id"]: r["items_sha256"] for r in df.collect()}
    assert got == {i: hashlib.sha256(s.encode()).hexdigest() for i, s in ((1, "1"), (2, "6"), (3, ""))}
