"""Runs against all pairs of equal words; planted tails; defined cases."""
import hashlib
import random
import re
import zlib

import pytest

from tradelake.llm.queries import op11_periodic_runs
from tradelake.llm.runs import LastOccurrence, SuffixAutomaton, _stretch_runs, collapse, find_runs, word_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w, least=6, repeats=4):
    n, out = len(w), []
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if size >= max(least, repeats * q) and not any(
                    all(w[i + k] == w[i + k + d] for k in range(size - d)) for d in range(1, q)):
                out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def sequences(seed, count):
    rng = random.Random(seed)
    for _ in range(count):
        n, k = rng.randint(0, 60), rng.choice([1, 2, 2, 3, 6])
        w = [rng.randrange(k) for _ in range(n)]
        for _ in range(rng.randint(0, 3)):
            if n > 8:
                a, p = rng.randrange(n), rng.randint(1, 6)
                for i in range(a, min(n, a + rng.randint(1, 40))):
                    w[i] = w[a + (i - a) % p]
        yield w


@pytest.mark.parametrize("least,repeats", [(6, 4), (6, 3), (4, 2), (9, 5), (1, 2)])
def test_runs_match_brute_force(least, repeats):
    for w in sequences(least + repeats, 700):
        assert word_runs(w, least, repeats) == brute(w, least, repeats), w
        # the automaton over the whole sequence finds the same as over the places that the triples leave
        whole = _stretch_runs(w, least, repeats)
        assert sorted(whole, key=lambda r: (r[0], r[2])) == brute(w, least, repeats), w


def test_segments_are_the_last_occurrences():
    for w in sequences(3, 150):
        sam = SuffixAutomaton(w)
        last = LastOccurrence(sam.link)
        for i, node in enumerate(sam.prefix):
            got = {e: sam.length[u] for u, e in last.access(node, i) if sam.length[u]}
            want = {}
            for size in range(1, i + 2):
                ends = [e for e in range(size - 1, i) if w[e - size + 1:e + 1] == w[i - size + 1:i + 1]]
                if ends:
                    want[max(ends)] = size
            assert got == want


def test_long_sequences_stay_fast():
    rng = random.Random(2)
    for p in (1, 2, 997, 5000):
        w = [rng.randrange(1 << 30) for _ in range(p)] * (60000 // p + 1)
        assert word_runs(w[:60000]) == [(0, 60000, p)]
    assert word_runs([rng.randrange(3000) for _ in range(60000)]) == []


def test_collapse_keeps_the_first_period():
    w = list("xababababy")
    assert word_runs(w) == [(1, 8, 2)] and collapse(w, word_runs(w)) == list("xaby")
    assert collapse(list("aaa"), word_runs(list("aaa"))) == list("aaa")


def test_defined_cases(make_docs, spark):
    rep = "one two " * 6
    texts = [None, "", " \t\n\x0b", rep, rep, "a\x1cb c", "x " * 5, "x " * 6, "é😀 " * 9 + "end", "w " * 30000]
    docs = make_docs([(k, t) for k, t in enumerate(texts)], clash=("runs", "Collapsed", "r", "f"))
    got = {r["doc_id"]: r for r in find_runs(docs).collect()}
    for k, t in enumerate(texts):
        w = WORD.findall(t or "")
        r = brute(w) if len(w) < 1000 else [(0, 30000, 1)]
        assert [tuple(x) for x in got[k]["runs"]] == r
        assert got[k]["collapsed"] == " ".join(collapse(w, r))
    assert got[3]["r"] == 7 and got[3]["f"] == 7
    assert find_runs(make_docs([])).count() == 0


def test_query_against_brute_force(spark, tmp_path, make_docs):
    rng = random.Random(11)
    rows = [(k, None if k % 17 == 0 else "" if k % 19 == 0 else " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 60))))
            for k in range(300)]
    rows += [(None, "lo " * 9), (7, rows[7][1])]
    make_docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, op11_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    want, planted = [], 0
    for i, t in rows:
        w = WORD.findall(t or "")
        n = len(w)
        if i is not None and n:
            h = zlib.crc32(str(i).encode())
            g = h // 10
            if h % 10 == 0:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
                planted += 1
        r = brute(w)
        best = min(r, key=lambda x: (-x[1], x[0], x[2])) if r else (None,) * 3
        listed = "".join(f"{a},{b},{c}\n" for a, b, c in r)
        want.append((i, len(r), *best, 1000 * best[1] // best[2] if r else None,
                     hashlib.sha256(listed.encode()).hexdigest(),
                     hashlib.sha256(" ".join(collapse(w, r)).encode()).hexdigest()))
    assert got == sorted(want, key=str) and planted > 15
