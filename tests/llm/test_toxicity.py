"""Held-out accuracy, the grammar's clauses, and what fitting may see."""
import random
import zlib

from pyspark.sql import functions as F

from tradelake.llm import toxicity as X
from tradelake.llm.queries import op2_toxicity


def test_clauses_not_words():
    g = X.Grammar(X.Model({"idiot": 3.0, "scum": 3.0, "vequ*": 5.0}))
    s = lambda t: g.text(t)[0]
    assert s("a plain text about the river") == 0
    assert s("you are an idiot") > s("what an idiot")          # a target raises it
    assert s("not an idiot") < s("an idiot")                   # negation lowers it
    assert s('he said an idiot') < s("an idiot man")           # reported speech lowers it
    assert s("an “idiot” of note") < s("an idiot of note")     # so does a quotation
    assert s("I will kill you") > 0 and s("it can kill time") == 0  # a threat needs an agent
    assert s("idiotic idiots") == 0 and s("vequaire") > 0      # whole words, learned beginnings
    assert g.text("an idiot. scum! fine.")[1] == 2
    assert s("not here. an idiot") == s("an idiot")            # patterns end with their clause


def _corpus(n=1200):
    rng = random.Random(4)
    vocab = ["".join(rng.choice("bdgklmnrst") + rng.choice("aeiou") for _ in range(rng.randint(1, 3))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(vocab) for _ in range(rng.randint(5, 60))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), "xuzq" + rng.choice(vocab))
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_learns_beginnings_and_holds_out(spark, make_docs):
    rows, labels = _corpus()
    lab = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    train = X.training_labels(lab)
    assert {r.doc_id for r in train.collect()} == {i for i, _ in labels if zlib.crc32(str(i).encode()) % 4 != 2}
    model = X.fit(make_docs(rows), train)
    assert "xuzq*" in model.terms
    got = {r.doc_id: r.predicted for r in X.score(make_docs(rows), model).collect()}
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i] == y for i, y in held) >= 0.99 * len(held)


def test_copies_do_not_make_terms(spark, make_docs):
    rows, labels = _corpus(600)
    words = " ".join(f"copied{k}" for k in range(40))
    rows += [(10_000 + k, words) for k in range(200)]
    labels += [(10_000 + k, 1) for k in range(200)]
    lab = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = X.fit(make_docs(rows), X.training_labels(lab))
    assert not any(t.startswith("copied") for t in model.terms if not t.endswith("*"))


def test_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    r = op2_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    c = r.where("held_out").groupBy("toxic", "predicted").count().collect()
    n = {(x.toxic, x.predicted): x["count"] for x in c}
    assert n.get((1, 1), 0) >= 0.95 * (n.get((1, 1), 0) + n.get((1, 0), 0))
    assert n.get((0, 1), 0) <= 0.02 * (n.get((0, 0), 0) + n.get((0, 1), 0))


def test_defined_cases(make_docs):
    model = X.Model({"idiot": 3.0})
    docs = make_docs([(1, None), (2, ""), (None, "an idiot"), (3, "x " * 100_000 + "you idiot"), (3, "x " * 100_000 + "you idiot")],
                     clash=("raw", "score", "matched", "__m"))
    out = X.score(docs, model)
    assert sorted(out.columns) == sorted(set(docs.columns) | {"raw", "matched", "score", "predicted"})
    got = out.collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    assert [r.predicted for r in got if r.doc_id in (None, 3)] == [1, 1, 1]
    kept = X.drop_toxic(docs, model)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert X.score(make_docs([]), model).count() == 0


def test_fit_without_positive_labels(spark, make_docs):
    lab = spark.createDataFrame([(1, 0), (2, None)], "doc_id bigint, toxic int")
    model = X.fit(make_docs([(1, "a b c"), (2, "d e f")]), X.training_labels(lab))
    assert set(model.terms) == set(X.INSULTS)
    assert X.fit(make_docs([]), X.training_labels(lab.where(F.lit(False)))).terms
