"""Cheapest audits against an exhaustive search; pieces of a conversation against the whole; defined cases."""
import hashlib
import heapq
import random
import re
import zlib

import pytest

from tradelake.llm.conversations import Audits, damage, repair_conversations, repaired, solve
from tradelake.llm.queries import op13_conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
NAMES = {"u": "user", "a": "assistant"}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = WORD.findall(text)
        out.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1][-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def search(rows, marks):
    """Least (cost, audit) by Dijkstra over whole strings."""
    queue, done = [(0, "", 0, 0, ())], set()
    while True:
        cost, s, i, q, out = heapq.heappop(queue)
        if (i, q) in done:
            continue
        done.add((i, q))
        if i == len(rows) and q in (0, 3):
            return cost, s, out
        w = "a" if q == 2 else "u"
        heapq.heappush(queue, (cost + 5, s + "I", i, AFTER[q, w], out + ((NAMES[w], ""),)))
        if i < len(rows):
            _, role, text = rows[i]
            extra = 5 if marks[i] == "t" else 0
            heapq.heappush(queue, (cost + 2, s + "D", i + 1, q, out))
            if marks[i] not in ("b", "d"):
                if (q, role[:1]) in AFTER:
                    heapq.heappush(queue, (cost + extra, s + "K", i + 1, AFTER[q, role[:1]], out + ((role, text),)))
                heapq.heappush(queue, (cost + extra + 1, s + "R", i + 1, AFTER[q, w], out + ((NAMES[w], text),)))


def brute(rows):
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    marks = faults(rows)
    cost, audit, out = search(rows, marks)
    turns = [t for t, _, _ in rows if t is not None]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(marks.count(m) for m in "bdt"),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest()), out


def conversation(rng, n):
    """Rows without two of one turn and role, whose order would be open."""
    out, t = [], 0
    for _ in range(n):
        t += rng.choice([0, 1, 1, 1, 2])
        role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "agent"])
        if any(a == t and b == role for a, b, _ in out):
            t += 1
        out.append((t, role, rng.choice([None, "", " \n", "Yes.", "Yes.", "no", f"Line {rng.random()}.", f"cut {rng.random()}", "ends! \t"])))
    return out


def test_solver_matches_exhaustive_search():
    rng = random.Random(1)
    for _ in range(1500):
        rows = [(k, rng.choice(["user", "assistant", "system", "tool", ""]), "x") for k in range(rng.randint(0, 9))]
        marks = [rng.choice(["", "", "", "b", "d", "t"]) for _ in rows]
        cost, audit, out = search(rows, marks)
        given = [(r, x, m == "b", m == "d", m == "t") for (_, r, x), m in zip(rows, marks)]
        audits, best = solve(given)
        ends = []
        for state, (c, node) in best.items():
            tail, s = "", state
            while s not in (0, 3):
                s, c, tail = AFTER[s, "a" if s == 2 else "u"], c + 5, tail + "I"
            ends.append((c, audits.text(node) + tail))
        assert min(ends) == (cost, audit)
        assert [(r, x) for _, r, x in repaired(given, audit)] == list(out)


def test_order_of_persistent_strings():
    rng = random.Random(4)
    for base in (Audits.BASE, 0):  # with base 0 hashes collide all the time
        a = Audits()
        a.BASE = base
        nodes = [0]
        for _ in range(300):
            nodes.append(a.add(rng.choice(nodes[-12:]), rng.choice("DIKR")))
        for _ in range(3000):
            x, y = rng.choice(nodes), rng.choice(nodes)
            assert a.less(x, y) == (a.text(x) < a.text(y))


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_conversations_match_brute_force(spark, partitions):
    rng = random.Random(partitions)
    convs = {k: conversation(rng, rng.choice([1, 2, 5, 9, 30])) for k in range(60)}
    convs[None] = conversation(rng, 12)
    convs[100] = conversation(rng, 400)  # over many partitions
    rows = [(k, *r) for k, c in convs.items() for r in c]
    rng.shuffle(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", key int")
        got = {r[0]: tuple(r)[1:] for r in repair_conversations(df).collect()}
        lines = repair_conversations(df, lines=True).orderBy("conv_id", "position").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    assert set(got) == set(convs)
    for k, c in convs.items():
        want, out = brute(c)
        assert got[k] == want, (k, c)
        assert [(r["role"], r["text"]) for r in lines if r["conv_id"] == k] == list(out)


def test_defined_cases(spark):
    rows = [(1, None, "user", "First."), (1, 3, "assistant", None), (1, 3, "assistant", " "), (1, None, None, None),
            (2, None, "user", "A."), (2, None, "user", "A."), (2, None, "user", "A."), (3, 1, "user", "B " * 100000 + "end.")]
    got = {r["conv_id"]: r for r in repair_conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got[1]["gaps"], got[1]["blank"], got[1]["audit"], got[1]["cost"]) == (0, 3, "DDDD", 8)
    assert (got[2]["gaps"], got[2]["duplicate"], got[2]["audit"]) == (0, 2, "DDD")
    assert got[3]["audit"] == "D"
    assert repair_conversations(spark.createDataFrame([], SCHEMA)).count() == 0
    named = spark.createDataFrame([("x", 1, "user", "Q."), ("x", 2, "assistant", "A.")], SCHEMA.replace("conv_id bigint", "c string"))
    assert repair_conversations(named, conv_col="c").first()["audit"] == "KK"


def test_query_plants_the_faults(spark, tmp_path):
    rng = random.Random(8)
    rows = [(c, *r) for c in range(80) for r in conversation(rng, rng.randint(1, 9))]
    rows += [(None, None, "user", "No id. No turn."), (None, 2, "assistant", "Yes.")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r[0]: tuple(r)[1:] for r in op13_conversations(spark, str(tmp_path)).collect()}
    left, seen = {}, set()
    for c, t, role, text in rows:
        left.setdefault(c, [])
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        seen.add(k)
        text = "" if k == 1 else re.sub("[.!?]", "", text or " ") if k == 2 else text
        left[c] += [] if k == 0 else [(t, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    assert {0, 1, 2, 3, 4} <= seen and set(got) == set(left)
    for c, r in left.items():
        if len({(t, x) for t, x, _ in r}) == len(set(r)):  # else the order within a turn is open
            assert got[c] == (brute(r)[0] if r else (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())), c


def test_damage_keeps_other_rows(spark):
    rows = [(c, t, "assistant", "A. B? C!") for c in range(30) for t in range(4)]
    out = damage(spark.createDataFrame(rows, SCHEMA)).collect()
    kinds = {(c, t): zlib.crc32(f"{c}:{t}".encode()) % 20 for c, t, _, _ in rows}
    assert sum(1 for r in out if kinds[r["conv_id"], r["turn"]] > 4) == sum(k > 4 for k in kinds.values())
    assert {r["text"] for r in out if kinds[r["conv_id"], r["turn"]] == 2} <= {"A B C"}
