"""The pipeline: each stage keeps the columns, acts on its own input, and what is planted is caught."""
import pytest

import __spark_entry__ as E
import corpus_pipeline as cp
from tradelake.llm.common import staged

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in cp.STAGES:
        out.append((name, staged(stage(spark, out[-1][1], SF), f"test-{name}")))
    return out


def test_registered():
    assert [n for n, _ in cp.STAGES] == ["toxicity", "line_dedup", "simhash_dedup", "mixing", "packing"]
    names = [q for q in E.queries() if q.startswith("op") and q[2].isdigit()]
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 14)] and "pipeline" in E.queries()


def test_columns_and_shrinking(steps):
    columns = steps[0][1].columns
    counts = [df.count() for _, df in steps]
    assert all(df.columns == columns for _, df in steps[:-1])
    assert counts[0] > counts[1] >= counts[2] >= counts[3] > 0


def test_toxic_documents_go_and_clean_ones_stay(spark, steps):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    before = steps[0][1].join(labels, "doc_id").where("toxic = 0").count()
    after = steps[1][1].join(labels, "doc_id").where("toxic = 0").count()
    assert after >= 0.97 * before
    assert steps[1][1].join(labels, "doc_id").where("toxic = 1").count() <= 0.3 * labels.where("toxic = 1").count()


def test_one_document_of_each_group_stays(steps):
    from tradelake.llm.simhash import simhash_classes
    classes = simhash_classes(steps[2][1]).collect()
    kept = {r.doc_id for r in steps[3][1].select("doc_id").collect()}
    assert kept == {r.component_id for r in classes}


def test_packing_holds_the_mixed_documents(steps):
    mixed = steps[4][1].groupBy("doc_id").count().collect()
    pieces = {r.doc_id: r.n for r in steps[5][1].selectExpr("doc_id", "length / doc_tokens as share")
              .groupBy("doc_id").agg({"share": "sum"}).toDF("doc_id", "n").collect()}
    assert {r.doc_id for r in mixed} == set(pieces)
    assert all(abs(pieces[r.doc_id] - r["count"]) < 1e-6 for r in mixed)


def _folder(spark, tmp_path, docs, labels):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_empty_tables_go_through(spark, make_docs, tmp_path):
    assert cp.run(spark, _folder(spark, tmp_path, make_docs([]), [])).count() == 0


def test_nulls_ties_and_clashing_columns_go_through(spark, make_docs, tmp_path):
    words = " ".join(f"w{k}" for k in range(40))
    rows = [(1, words, "a"), (1, words, "a"), (2, words + " more", None), (None, "no id here " + words[::-1], "b"),
            (None, "no id here " + words[::-1], "b"), (3, None, "a"), (4, "", None), (5, " \n\t", "b"), (6, "line one\nline two", "c"),
            (7, "long " * 50_000, "c")]
    clash = ("id", "th", "gone", "fp", "root", "size", "target", "raw", "score", "n_words", "ids", "sequence_id", "__rid")
    docs = make_docs(rows, clash=clash)
    df = cp.run(spark, _folder(spark, tmp_path, docs, [(1, None, None), (None, 1, 1), (2, 0, 0)]))
    out = df.collect()
    assert df.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert {r.doc_id for r in out} <= {1, 2, 3, 4, 5, 6, 7, None} and {6, 7, None} <= {r.doc_id for r in out}
    by_sequence = {}
    for r in out:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    # of the rows without an id that are copies of each other, one stays
    stage = dict(cp.STAGES)["simhash_dedup"]
    kept = stage(spark, docs, str(tmp_path)).where("doc_id is null and text like 'no id%'").count()
    assert kept == 1


def test_run_is_its_stages_and_keeps_no_intermediates(spark, steps):
    from tradelake.session import scratch_mark
    before = scratch_mark()
    out = cp.run(spark, SF)
    assert scratch_mark() == before + len(cp.STAGES)
    key = lambda df: sorted(map(str, df.select("doc_id", "start", "length", "ids_crc32").collect()))
    assert key(out) == key(steps[-1][1])
