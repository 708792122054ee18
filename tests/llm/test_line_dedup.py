"""Line dedup against a quadratic word edit distance."""
import random

import pytest

from tradelake.llm import line_dedup as L
from tradelake.llm.line_dedup import line_dedup


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows, least=8):
    seen, out = [], {}
    lines = sorted(((i is None, i or 0, k), l.split()) for i, t in rows if t is not None
                   for k, l in enumerate(t.split("\n")) if len(l.split()) >= least)
    gone = set()
    for at, w in lines:
        if any(distance(v, w) <= 1 for v in seen):
            gone.add(at)
        seen.append(w)
    for i, t in rows:
        out[i] = t if t is None else "\n".join(l for k, l in enumerate(t.split("\n"))
                                               if ((i is None), i or 0, k) not in gone)
    return out


def test_matches_brute_force(make_docs):
    rng = random.Random(3)
    vocab = [f"w{k}" for k in range(30)]
    pool = [[rng.choice(vocab) for _ in range(rng.randint(7, 14))] for _ in range(25)]

    def line():
        w = list(rng.choice(pool))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            k = rng.randrange(len(w))
            w[k:k + rng.randint(0, 1)] = [rng.choice(vocab)] * rng.randint(0, 1)
        return " ".join(w)

    rows = [(i, "\n".join(line() for _ in range(rng.randint(1, 5)))) for i in range(60)]
    got = {r.doc_id: r.text for r in line_dedup(make_docs(rows), counts=True).collect()}
    assert got == brute(rows)


def test_defined_cases(make_docs):
    long = "one two three four five six seven eight"
    rows = [(1, long + "\nshort line"), (2, long), (3, None), (4, ""), (5, "short line"), (None, long + " nine"),
            (6, "x\n" + long.replace("four", "FOUR")), (7, " ".join(f"v{k}" for k in range(30_000))), (8, "  \n \n")]
    out = line_dedup(make_docs(rows, clash=("n_lines", "id", "th", "gone", "no", "line")))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_lines", "id", "th", "gone", "no", "line"]
    got = {r.doc_id: r.text for r in out.collect()}
    # document 2 and the one without id hold nothing but copies; texts without words pass
    assert got == {1: rows[0][1], 3: None, 4: "", 5: "short line", 6: "x", 7: rows[7][1], 8: "  \n \n"}
    counted = line_dedup(make_docs(rows, clash=("n_lines",)), counts=True)
    assert {r.doc_id: r.n_removed for r in counted.collect()} == {1: 0, 2: 1, 3: 0, 4: 0, 5: 0, None: 1, 6: 1, 7: 0, 8: 0}


def test_repeated_rows_are_treated_alike(make_docs):
    long = "one two three four five six seven eight"
    got = line_dedup(make_docs([(2, long + "\na"), (2, long + "\na"), (1, long)])).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(1, long), (2, "a"), (2, "a")]


def test_empty_table(make_docs):
    assert line_dedup(make_docs([])).count() == 0


def test_large_family_makes_no_pairs(make_docs):
    base = [f"b{k}" for k in range(12)]
    rows = [(i, " ".join(base[:5] + [f"x{i}"] + base[6:])) for i in range(400)]
    got = line_dedup(make_docs(rows)).collect()
    assert [r.doc_id for r in got] == [0]


def test_rejects_a_bound_without_halves(make_docs):
    with pytest.raises(ValueError):
        line_dedup(make_docs([]), min_words=1)


def test_short_lines_lose_exact_copies_only(make_docs):
    rng = random.Random(11)
    vocab = [f"w{k}" for k in range(4)]
    rows = [(i, "\n".join(" ".join(rng.choice(vocab) for _ in range(rng.randint(0, 3))) for _ in range(4))) for i in range(40)]
    seen, want = set(), {}
    for i, t in rows:
        kept = [l for l in t.split("\n") if not l.split() or (tuple(l.split()) not in seen and not seen.add(tuple(l.split())))]
        want[i] = "\n".join(kept)
    got = {r.doc_id: r.text for r in line_dedup(make_docs(rows), counts=True, short=True).collect()}
    assert got == want and got != dict(rows)


def test_lines_without_spaces(make_docs):
    zh, th, url = "这是一个没有空格的长句子用来测试", "นี่คือประโยคยาวที่ไม่มีช่องว่าง", "https://example.org/" + "a" * 80
    rows = [(1, "\n".join([zh, th, url])), (2, zh + "\nx"), (3, th + "\n" + url + "\ny"), (4, zh.replace("长", "短") + "\nz"),
            (5, url + "b")]
    got = {r.doc_id: r.text for r in line_dedup(make_docs(rows), short=True).collect()}
    assert got == {1: rows[0][1], 2: "x", 3: "y", 4: "z", 5: url + "b"}


def test_query_and_pipeline_remove_short_copies(spark, make_docs, monkeypatch):
    import corpus_pipeline
    from tradelake.llm import queries
    docs = make_docs([(1, "one two\nthree"), (2, "one two\nfour"), (3, "three")])
    monkeypatch.setattr(queries, "_table", lambda *a: docs)
    assert {r.doc_id: (r.text, r.n_removed) for r in queries.op1_line_dedup(spark, "").collect()} == {
        1: ("one two\nthree", 0), 2: ("four", 1), 3: ("", 1)}
    assert {r.doc_id: r.text for r in corpus_pipeline.dedup_lines(spark, docs, "").collect()} == {1: "one two\nthree", 2: "four"}


def test_words_of_a_line_are_made_once(spark):
    # a filter on the joined words would make them once more for every use in it
    chars = " \t\n\x0b\x0c\r"
    texts = [None, "", f"{chars}\n \n a\tb  c \r\n\x0b\x0c\n", "é é “x” — y", "日本 x\n“日”", "ก\u0e00 \u07ff ｦ\U00020000 z", "\xa0\n\u2003"]
    docs = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "id long, th long, text string")
    lines = L._lines(docs, "id", "th")
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_join") == 1
    got = {(r.id, r.no): (r.l, r.n) for r in lines.collect()}
    assert got == {(2, 3): ("a b c", 3), (3, 0): ("é é “x” — y", 5), (4, 0): ("日 本 x", 3), (4, 1): ("“ 日 ”", 3),
                   (5, 0): ("ก \u0e00 \u07ff ｦ \U00020000 z", 6), (6, 0): ("\xa0", 1), (6, 1): ("\u2003", 1)}
