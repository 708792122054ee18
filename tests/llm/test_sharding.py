from collections import Counter

import pytest

from tradelake.llm.queries import N_SHARDS, op6_sharding
from tradelake.llm.sharding import _number, assign_shards, fill_table, write_shards


def brute_table(shards, m):
    """Preference lists written out, then claimed in turns."""
    prefs = [[(_number(s, "offset") % m + j * (_number(s, "step") % (m - 1) + 1)) % m for j in range(m)] for s in shards]
    owner, at, left = [None] * m, [0] * len(shards), m
    while left:
        for k, p in enumerate(prefs):
            if not left:
                break
            while owner[p[at[k]]] is not None:
                at[k] += 1
            owner[p[at[k]]] = k
            left -= 1
    return owner


def test_table_matches_written_out_preferences():
    names = [f"s{k}" for k in range(7)]
    assert fill_table(names, 251) == brute_table(names, 251)


def test_shares_are_even_and_few_slots_move():
    names = [f"s{k}" for k in range(20)]
    table = fill_table(names, 65537)
    counts = Counter(table).values()
    assert max(counts) - min(counts) <= 1
    fewer = fill_table(names[:-1], 65537)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 19)
    assert moved < 0.1 * 65537
    weighted = Counter(fill_table(["a", "b"], 251, {"b": 3}))
    assert 2.8 < weighted[1] / weighted[0] < 3.2


def test_bad_tables():
    for args in ((["a"], 10), ([], 7), (["a", "a"], 7), ([str(k) for k in range(8)], 7)):
        with pytest.raises(ValueError):
            fill_table(*args)


def test_query_places_every_row(spark):
    sf = "/root/testdata/sf0.01"
    rows = op6_sharding(spark, sf).collect()
    names = [f"shard-{k:03d}" for k in range(N_SHARDS)]
    owner = brute_table(names, 65537)
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    hashes = {r.doc_id: r.h for r in spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id", "xxhash64(doc_id) h").collect()}
    assert all(r.slot == hashes[r.doc_id] % 65537 and r.shard == names[owner[r.slot]] for r in rows)


def test_defined_cases(make_docs):
    names = ["a", "b", "c"]
    docs = make_docs([(None, f"text {k}") for k in range(300)] + [(1, None), (1, "x")], clash=("slot", "shard", "__slot"))
    out = assign_shards(docs, ["doc_id"], names, 251)
    rows = out.collect()
    assert len({r.shard for r in rows if r.doc_id is None}) == 3  # rows without a key spread
    assert len({r.shard for r in rows if r.doc_id == 1}) == 1
    assert out.columns.count("slot") == 1 and assign_shards(make_docs([]), ["doc_id"], names, 251).count() == 0


def test_written_shards_hold_what_was_assigned(spark, make_docs, tmp_path):
    names = ["a", "b", "c"]
    docs = make_docs([(k, f"text {k}") for k in range(200)])
    placed = assign_shards(docs, ["doc_id"], names, 251)
    write_shards(placed, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    key = lambda df: sorted(tuple(r) for r in df.select("doc_id", "text", "slot", "shard").collect())
    assert key(back) == key(placed) and {p.name for p in (tmp_path / "shards").glob("shard=*")} == {f"shard={n}" for n in names}
