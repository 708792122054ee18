"""Conversation structure repair: the cheapest edits, as a persistent audit.

A conversation's rows, in order of turn (NULL first; ties by role, then a hash of the text), are
repaired to the role pattern ``(s?(ua)+)?`` by Keep, Rerole, Delete and
Insert; of the cheapest edits the one whose initials are least in ASCII is
the audit. A dynamic program runs over rows and pattern states; the best
audit of every state is a node that shares its prefix with the others (a
character, the node before, ancestors at powers of two, and a rolling hash).
Two audits of equal cost are compared at the end of their longest common
prefix, found by lifting both nodes while their hashes differ; the common
prefix is then checked node by node, so a collision of hashes can't decide.

The rows are range-partitioned by conversation and turn, so a conversation of
any size is spread over tasks. Only a partition's first and last conversation can
reach beyond it; all others are finished where they lie. Those at the edges
are cut into pieces, one per partition: a piece is solved from each of the four
pattern states, the small tables of costs and orders are folded in the order
of the pieces (one row per partition at most), and every piece then writes
the edits between the states that were chosen. An audit before a piece ends
with an edit of a row, so of two such audits none is a prefix of the other,
and their order decides every later tie.

Defined cases: a NULL role or text is one space; rows with a NULL turn come
first and don't count for gaps; rows equal in conversation, turn, role and text
are duplicates of the first; rows without a conv_id are one conversation; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tradelake.llm.common import staged

# Costs of the edits and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SPACES = " \t\n\x0b\x0c\r"
STOPS = ".!?"
LEGAL = ("su", "ua", "au")

# States of the pattern: nothing yet, after s, after u, after a.
STATES = range(4)
ACCEPTED = (0, 3)
_AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
_WANTED = ("user", "user", "assistant", "user")   # role that Rerole and Insert give in a state

METRICS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class Audits:
    """Strings that share prefixes: node 0 is empty, every other node adds one character to its parent."""

    BASE, MOD = 1_000_003, (1 << 61) - 1

    def __init__(self):
        self.char, self.depth, self.hash, self.up = [""], [0], [0], [()]

    def add(self, parent: int, char: str) -> int:
        node = len(self.char)
        ups, a = [parent], parent
        while len(self.up[a]) >= len(ups):
            a = self.up[a][len(ups) - 1]
            ups.append(a)
        self.char.append(char)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * self.BASE + ord(char)) % self.MOD)
        self.up.append(tuple(ups))
        return node

    def _lift(self, node: int, depth: int) -> int:
        drop = self.depth[node] - depth
        k = 0
        while drop:
            if drop & 1:
                node = self.up[node][k]
            drop >>= 1
            k += 1
        return node

    def less(self, a: int, b: int) -> bool:
        """Whether the string of ``a`` comes before that of ``b``."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self._lift(a, depth), self._lift(b, depth)
        if self.hash[x] != self.hash[y]:
            # lift to the first characters that differ: the longest common prefix ends at their parents
            for k in reversed(range(len(self.up[x]))):
                if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                    x, y = self.up[x][k], self.up[y][k]
            if self._equal(self.up[x][0], self.up[y][0]) and self.char[x] != self.char[y]:
                return self.char[x] < self.char[y]
        elif self._equal(x, y):
            return self.depth[a] < self.depth[b]
        return self.text(a) < self.text(b)  # equal hashes of different strings

    def _equal(self, x: int, y: int) -> bool:
        while x != y:
            if self.char[x] != self.char[y]:
                return False
            x, y = self.up[x][0], self.up[y][0]
        return True

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.char[node])
            node = self.up[node][0]
        return "".join(reversed(out))


class _Front:
    """Best (cost, audit) per state."""

    def __init__(self, audits: Audits, best: dict | None = None):
        self.audits, self.best = audits, best or {}

    def offer(self, state: int, cost: int, parent: int, char: str) -> None:
        old = self.best.get(state)
        if old is None or cost < old[0]:
            self.best[state] = (cost, self.audits.add(parent, char))
        elif cost == old[0]:
            node = self.audits.add(parent, char)
            if self.audits.less(node, old[1]):
                self.best[state] = (cost, node)

    def insert(self) -> None:
        """Inserts before the next row: more than one of each role never pays."""
        for state in (0, 1, 3, 2):
            if state in self.best:
                cost, node = self.best[state]
                self.offer(_AFTER[state, _WANTED[state][0]], cost + INSERT, node, "I")


def solve(rows: list[tuple], start: int = 0) -> tuple[Audits, dict]:
    """(audits, {state: (cost, audit node)}) after all rows, without inserts behind the last.

    A row is (role, text, blank, duplicate, truncated).
    """
    audits = Audits()
    front = _Front(audits, {start: (0, 0)})
    for role, _, blank, duplicate, truncated in rows:
        front.insert()
        new = _Front(audits)
        initial, extra = role[:1], TRUNCATED if truncated else 0
        for state, (cost, node) in front.best.items():
            new.offer(state, cost + DELETE, node, "D")
            if not (blank or duplicate):
                after = _AFTER.get((state, initial))
                wanted = _WANTED[state][0]
                if after is not None:
                    new.offer(after, cost + extra, node, "K")
                if initial != wanted:
                    new.offer(_AFTER[state, wanted], cost + REROLE + extra, node, "R")
        front = new
    return audits, front.best


def endings(best: dict) -> list[tuple[int, int, str]]:
    """(state, cost, inserts) that end a conversation in the pattern, for every state reached."""
    out = []
    for state, value in best.items():
        cost, tail, s = value[0], "", state
        while s not in ACCEPTED:
            s, cost, tail = _AFTER[s, _WANTED[s][0]], cost + INSERT, tail + "I"
        out.append((state, cost, tail))
    return out


def repaired(rows: list[tuple], audit: str, state: int = 0) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the rows that an audit leaves or adds, starting in ``state``."""
    source = iter(rows)
    for c in audit:
        role, text = _WANTED[state], ""
        if c != "I":
            own, text = next(source)[:2]
            if c == "D":
                continue
            role = own if c == "K" else role
        yield c, role, text
        state = _AFTER[state, role[0]]


def marked(pairs: list[tuple[str, str]], repeats: list[bool] | None = None) -> list[tuple]:
    """Rows (role, text) with their first fault; ``repeats`` where earlier rows are elsewhere."""
    out, seen = [], set()
    for k, (role, text) in enumerate(pairs):
        body = text.strip(SPACES)
        blank = not body
        again = repeats[k] if repeats is not None else (role, text) in seen
        seen.add((role, text))
        out.append((role, text, blank, again and not blank, bool(body) and not again and body[-1] not in STOPS))
    return out


def counts(turns: list, rows: list[tuple]) -> dict:
    """What a stretch of rows adds to the counts; ``_joined`` puts two stretches together."""
    known = [t for t in turns if t is not None]
    initials = [r[0][:1] for r in rows]
    return {"least": known[0] if known else None, "most": known[-1] if known else None,
            "turns": sum(1 for k, t in enumerate(known) if k == 0 or known[k - 1] != t),
            "blank": sum(r[2] for r in rows), "duplicate": sum(r[3] for r in rows), "truncated": sum(r[4] for r in rows),
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
            "head": initials[0], "tail": initials[-1]}


def _joined(a: dict, b: dict) -> dict:
    out = {k: a[k] + b[k] for k in ("turns", "blank", "duplicate", "truncated", "illegal")}
    out["turns"] -= a["most"] is not None and a["most"] == b["least"]
    out["illegal"] += a["tail"] + b["head"] not in LEGAL
    out["least"] = b["least"] if a["least"] is None else a["least"]
    out["most"] = a["most"] if b["most"] is None else b["most"]
    return out | {"head": a["head"], "tail": b["tail"]}


def _metrics(c: dict) -> list[int]:
    gaps = c["most"] - c["least"] + 1 - c["turns"] if c["turns"] else 0
    return [gaps, c["blank"], c["duplicate"], c["truncated"], c["illegal"]]


def _line(role: str, text: str) -> bytes:
    return f"{role}:{text}".encode("utf-8", "surrogatepass")


def _finished(turns: list, pairs: list[tuple[str, str]]) -> tuple:
    """Counts, cost, audit and digest of a conversation that lies in one task."""
    rows = marked(pairs)
    audits, best = solve(rows)
    # least cost; of equal ones the least audit, which inserts at the end don't change
    state, cost, tail = None, None, ""
    for s, c, t in endings(best):
        if state is None or c < cost or c == cost and audits.less(best[s][1], best[state][1]):
            state, cost, tail = s, c, t
    audit = audits.text(best[state][1]) + tail
    digest = hashlib.sha256(b"\n".join(_line(r, t) for _, r, t in repaired(rows, audit))).hexdigest()
    return (*_metrics(counts(turns, rows)), cost, audit, digest)


_ROW = "key string, has_turn boolean, turn bigint, role string, text string"
_DONE = ", ".join(f"{m} bigint" for m in METRICS) + ", audit string, repaired_sha256 string"
_SETTLED = f"edge boolean, pid int, place bigint, {_ROW}, {_DONE}"
_NO_RESULT = (0,) * len(METRICS) + ("", "")


def _conversations(batches: Iterator[pd.DataFrame], key: str = "key") -> Iterator[tuple]:
    """(key, pid, list of (has_turn, turn, role, text)) of each conversation of a sorted partition."""
    now, pid, rows = None, 0, []
    for part in batches:
        for k, p, h, t, r, x in zip(*(part[c].tolist() for c in (key, "pid", "has_turn", "turn", "role", "text"))):
            if k != now:
                if rows:
                    yield now, pid, rows
                now, pid, rows = k, p, []
            rows.append((h, t, r, x))
    if rows:
        yield now, pid, rows


def _turns(rows: list[tuple]) -> list:
    return [t if h else None for h, t, *_ in rows]


def _settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Finish the conversations inside a partition, pass on the rows of its first and last one."""
    names = [c.split()[0] for c in _SETTLED.split(", ")]
    out = []

    def edge(key, pid, rows):
        for k in range(0, len(rows), 4096):
            yield pd.DataFrame([(True, pid, k + j, key, *r, *_NO_RESULT) for j, r in enumerate(rows[k:k + 4096])], columns=names)

    first, held = True, None
    for conv in _conversations(batches):
        if held is not None:
            key, pid, rows = held
            out.append((False, pid, 0, key, False, 0, "", "", *_finished(_turns(rows), [r[2:] for r in rows])))
        if first:
            yield from edge(*conv)
            first = False
        else:
            held = conv
        if len(out) >= 4096:
            yield pd.DataFrame(out, columns=names)
            out = []
    if held is not None:
        yield from edge(*held)
    if out:
        yield pd.DataFrame(out, columns=names)


_PIECE = ("key string, pid int, origin int, state int, cost bigint, place int, least bigint, most bigint, turns bigint, "
          "blank bigint, duplicate bigint, truncated bigint, illegal bigint, head string, tail string")


def _rows_of(piece: pd.DataFrame) -> tuple[list, list[tuple]]:
    piece = piece.sort_values("place", kind="stable")
    turns = [t if h else None for h, t in zip(piece["has_turn"].tolist(), piece["turn"].tolist())]
    return turns, marked(list(zip(piece["role"].tolist(), piece["text"].tolist())), piece["again"].tolist())


def _piece_table(piece: pd.DataFrame) -> pd.DataFrame:
    """Costs and order of the audits of one piece, from every state to every state."""
    turns, rows = _rows_of(piece)
    c = counts(turns, rows)
    key, pid = piece["key"].iloc[0], int(piece["pid"].iloc[0])
    out = []
    for origin in STATES:
        audits, best = solve(rows, origin)
        order = sorted(best, key=lambda s: audits.text(best[s][1]))
        out += [(key, pid, origin, s, best[s][0], k, c["least"] or 0, c["most"] or 0, c["turns"], c["blank"],
                 c["duplicate"], c["truncated"], c["illegal"], c["head"], c["tail"]) for k, s in enumerate(order)]
    return pd.DataFrame(out, columns=[x.split()[0] for x in _PIECE.split(", ")])


_PATH = "key string, pid int, origin int, state int, ending string, " + ", ".join(f"{m} bigint" for m in METRICS)


def _fold(tables: pd.DataFrame) -> pd.DataFrame:
    """The states between which each piece of a conversation is edited, and the counts of the whole."""
    best, rank, back, total = {0: 0}, {0: 0}, [], None
    for pid, t in tables.sort_values(["pid", "origin", "place"]).groupby("pid", sort=True):
        new, order = {}, {}
        for r in t.itertuples():
            if r.origin in best:
                offer = (best[r.origin] + r.cost, rank[r.origin], r.place, r.origin)
                if r.state not in new or offer < new[r.state]:
                    new[r.state] = offer
        # audits from different origins keep their order, those from one origin have the piece's
        for k, s in enumerate(sorted(new, key=lambda s: new[s][1:3])):
            order[s] = k
        best, rank = {s: v[0] for s, v in new.items()}, order
        back.append((int(pid), {s: v[3] for s, v in new.items()}))
        c = t.iloc[0].to_dict()
        if not c["turns"]:
            c["least"] = c["most"] = None
        total = c if total is None else _joined(total, c)
    cost, _, state, ending = min((c, rank[s], s, tail) for s, c, tail in endings({s: (v,) for s, v in best.items()}))
    metrics = [*_metrics(total), cost]
    out = []
    for pid, origins in reversed(back):
        out.append((tables["key"].iloc[0], pid, origins[state], state, ending, *metrics))
        state, ending, metrics = origins[state], "", [0] * len(METRICS)
    return pd.DataFrame(out, columns=[x.split()[0] for x in _PATH.split(", ")])


_LINE = "key string, pid int, place bigint, edit string, role string, text string, audit string"


def _piece_lines(piece: pd.DataFrame) -> pd.DataFrame:
    """Repaired rows of one piece, and its audit (on a line of its own, without an edit)."""
    _, rows = _rows_of(piece)
    first = piece.iloc[0]
    audits, best = solve(rows, int(first["origin"]))
    audit = audits.text(best[int(first["state"])][1]) + first["ending"]
    key, pid = first["key"], int(first["pid"])
    lines = [(key, pid, k + 1, e, r, t, "") for k, (e, r, t) in enumerate(repaired(rows, audit, int(first["origin"])))]
    return pd.DataFrame([(key, pid, 0, "", "", "", audit), *lines], columns=[x.split()[0] for x in _LINE.split(", ")])


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One running digest per conversation over its lines in order; nothing but the digest is held."""
    now, state, any_line = None, None, False
    for part in batches:
        done = []
        for key, role, text in zip(part["key"].tolist(), part["role"].tolist(), part["text"].tolist()):
            if key != now:
                if now is not None:
                    done.append((now, state.hexdigest()))
                now, state, any_line = key, hashlib.sha256(), False
            state.update((b"\n" if any_line else b"") + _line(role, text))
            any_line = True
        if done:
            yield pd.DataFrame(done, columns=["key", "digest"])
    if now is not None:
        yield pd.DataFrame([(now, state.hexdigest())], columns=["key", "digest"])


def _prepared(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    col = lambda c: F.col(f"`{c}`")
    key = F.coalesce(F.concat(F.lit("="), col(conv_col).cast("string")), F.lit(""))
    turn = col(turn_col).cast("bigint")
    space = lambda c: F.coalesce(col(c).cast("string"), F.lit(" "))
    return rows.select(key.alias("key"), turn.isNotNull().alias("has_turn"), F.coalesce(turn, F.lit(0)).alias("turn"),
                       space(role_col).alias("role"), space(text_col).alias("text"))


def _pieces(settled: DataFrame) -> DataFrame:
    """Rows of the conversations at partition edges, with whether role and text came earlier."""
    edge = settled.where("edge").select("pid", "place", *[c.split()[0] for c in _ROW.split(", ")])
    same = ["key", "role", F.md5("text").alias("digest")]
    first = edge.select(*same, "pid", "place").groupBy("key", "role", "digest").agg(
        F.min(F.struct("pid", "place")).alias("first"))
    edge = edge.withColumn("digest", F.md5("text")).join(first, ["key", "role", "digest"])
    return staged(edge.withColumn("again", F.struct("pid", "place") > F.col("first")).drop("digest", "first"), "conv-pieces")


def _conv_id(key: str, schema, conv_col: str) -> Column:
    return F.expr(f"case when {key} <> '' then substr({key}, 2) end").cast(schema[conv_col].dataType)


def repair_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", lines: bool = False) -> DataFrame:
    """One row per conversation: counts of its faults, cost, audit and digest of the repaired rows.

    With ``lines`` the repaired rows themselves instead: conversation, position, edit, role and text.
    """
    order = [F.col("key"), F.col("has_turn"), F.col("turn"), F.col("role"), F.xxhash64("text")]
    ranged = (_prepared(rows, conv_col, turn_col, role_col, text_col).repartitionByRange(*order)
              .sortWithinPartitions(*order, F.col("text")).withColumn("pid", F.spark_partition_id()))
    settled = staged(ranged.mapInPandas(_settle, _SETTLED), "conv-settled")
    pieces = _pieces(settled)
    tables = staged(pieces.groupBy("key", "pid").applyInPandas(_piece_table, _PIECE), "conv-tables")
    paths = staged(tables.groupBy("key").applyInPandas(_fold, _PATH), "conv-paths")
    # a path has at most one row per partition and conversation at its edges
    chosen = pieces.join(paths.select("key", "pid", "origin", "state", "ending"), ["key", "pid"])
    written = staged(chosen.groupBy("key", "pid").applyInPandas(_piece_lines, _LINE), "conv-lines")
    if lines:
        inner = ranged.select("key", "pid", "has_turn", "turn", "role", "text").mapInPandas(_inner_lines, _LINE)
        every = inner.union(written.where("edit <> ''"))
        place = F.row_number().over(_by_key()).cast("bigint")
        return every.select(_conv_id("key", rows.schema, conv_col).alias(conv_col), place.alias("position"), "edit",
                            F.col("role").alias(role_col), F.col("text").alias(text_col))
    digests = (written.where("edit <> ''").repartition("key").sortWithinPartitions("key", "pid", "place")
               .select("key", "role", "text").mapInPandas(_digest, "key string, digest string"))
    audits = written.where("edit = ''").groupBy("key").agg(F.expr(
        "array_join(transform(array_sort(collect_list(struct(pid, audit))), x -> x.audit), '')").alias("audit"))
    whole = paths.groupBy("key").agg(*[F.sum(m).alias(m) for m in METRICS])
    nothing = hashlib.sha256(b"").hexdigest()
    at_edges = (whole.join(audits, "key").join(digests, "key", "left")
                .withColumn("repaired_sha256", F.coalesce("digest", F.lit(nothing))))
    columns = ["key", *METRICS, "audit", "repaired_sha256"]
    done = settled.where("not edge").select(*columns).union(at_edges.select(*columns))
    return done.select(_conv_id("key", rows.schema, conv_col).alias(conv_col), *columns[1:])


def _by_key():
    from pyspark.sql import Window
    return Window.partitionBy("key").orderBy("pid", "place")


def _inner_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Repaired rows of the conversations inside a partition."""
    names = [x.split()[0] for x in _LINE.split(", ")]
    first, held = True, None
    for conv in _conversations(batches):
        if held is not None:
            key, pid, rows = held
            faulty = marked([r[2:] for r in rows])
            audit = _finished(_turns(rows), [r[2:] for r in rows])[-2]
            yield pd.DataFrame([(key, pid, k + 1, e, r, t, "") for k, (e, r, t) in enumerate(repaired(faulty, audit))],
                               columns=names)
        held, first = (None, False) if first else (conv, False)


def damage(rows: DataFrame) -> DataFrame:
    """The contract's faults, planted by crc32(conv_id:turn) mod 20; NULLs count as one space."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat(part("conv_id"), F.lit(":"), part("turn")), "utf-8")) % 20
    rows = rows.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), kind.alias("kind"))
    rows = rows.where("kind <> 0").withColumn("text", F.expr(
        "case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '') else text end"))
    rows = rows.withColumn("role", F.expr("case kind when 4 then 'user' else role end"))
    return rows.withColumn("copy", F.explode(F.expr("case when kind = 3 then array(0, 1) else array(0) end"))).select(
        "conv_id", "turn", "role", "text")
