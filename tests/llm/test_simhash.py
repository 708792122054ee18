"""Fingerprints bit by bit, components against all pairs, forests inside tiles."""
import random
import re

import xxhash

from tradelake.llm.queries import op7_simhash
from tradelake.llm.simhash import fingerprint, link_fingerprints, parts_for, simhash_classes, simhash_dedup


def slow(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    parts = [" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    hs = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if hs and 2 * sum(h >> b & 1 for h in hs) > len(hs))


def roots(fps, radius):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def test_fingerprint_is_the_majority_of_bits():
    texts = [None, "", " \t\n", "One", "one TWO", "a b c", "a b c d", "É è Ça va très bien", "x\x0by\x0cz w\x1cv",
             " ".join(str(k * k) for k in range(500)), "the the the the the"]
    assert [fingerprint(t) for t in texts] == [slow(t) for t in texts]


def test_components_match_all_pairs(spark):
    rng = random.Random(5)
    fps = [rng.getrandbits(64) for _ in range(40)] + [0, (1 << 64) - 1]
    for _ in range(160):
        f = rng.choice(fps)
        for _ in range(rng.randint(1, 3)):
            f ^= 1 << rng.randrange(64)
        fps.append(f)
    fps = sorted(set(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    for block_rows in (4096, 2):  # whole tiles, and tiles cut into many blocks
        links = link_fingerprints(df, block_rows=block_rows).collect()
        unsigned = lambda x: x % (1 << 64)
        assert all((unsigned(a) ^ unsigned(b)).bit_count() <= 2 * len(fps) for a, b in links)
        root = {f: f for f in fps}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in links:
            x, y = find(unsigned(a)), find(unsigned(b))
            root[max(x, y)] = min(x, y)
        assert {f: find(f) for f in fps} == roots(fps, 2)


def test_finer_tiles_find_the_same_links(spark):
    rng = random.Random(6)
    fps = [rng.getrandbits(64) for _ in range(30)]
    for _ in range(120):
        f = rng.choice(fps)
        for _ in range(rng.randint(1, 2)):
            f ^= 1 << rng.randrange(64)
        fps.append(f)
    fps = sorted(set(fps))
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp bigint")
    want = roots(fps, 2)
    for parts, block_rows in ((8, 4096), (8, 3), (4, 5)):
        root = {f: f for f in fps}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in link_fingerprints(df, parts=parts, block_rows=block_rows).collect():
            x, y = find(a % (1 << 64)), find(b % (1 << 64))
            root[max(x, y)] = min(x, y)
        assert {f: find(f) for f in fps} == want
    assert [parts_for(n) for n in (0, 10 ** 6, 10 ** 7, 10 ** 12)] == [4, 4, 8, 8]


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op7_simhash(spark, sf).collect()}
    fp = {d.doc_id: slow(d.text) for d in docs}
    root = roots(sorted(set(fp.values())), 2)
    least = {}
    for i, f in fp.items():
        least[root[f]] = min(i, least.get(root[f], i))
    assert got == {i: (f"{f:016x}", least[root[f]]) for i, f in fp.items()}


def test_defined_cases(make_docs):
    rows = [(5, None), (3, ""), (4, " \n"), (9, "alpha beta gamma delta"), (9, "alpha beta gamma delta"),
            (None, "alpha beta gamma delta"), (None, "only here no id"), (8, "word " * 50_000)]
    docs = make_docs(rows, clash=("fp", "component_id", "root", "least", "tile", "__rid"))
    got = sorted(((r.doc_id, r.component_id) for r in simhash_classes(docs).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (4, 3), (9, 9), (9, 9), (None, 9), (None, None), (8, 8)], key=str)
    kept = simhash_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted(
        [("3", ""), ("9", "alpha beta gamma delta"), ("None", "only here no id"), ("8", "word " * 50_000)])


def test_empty_table(make_docs):
    assert simhash_dedup(make_docs([])).count() == 0
    assert simhash_classes(make_docs([])).count() == 0
