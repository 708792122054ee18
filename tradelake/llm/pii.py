"""Personal data: generated candidates, gradient-boosted trees, calibrated thresholds.

Base spans follow fixed rules (email, ip, card, phone) and always stay. Generators with high
recall propose further, overlapping spans. Each candidate is described by small integer
features of its format and its context; boosted trees score it, and a candidate is
redacted if its score reaches the threshold.

There are no labels of personal data, so weak labellers vote on the added candidates: a cue
word or an assignment before it, clean edges, and a check of its content that the trees are
not shown (checksum, impossible numbers, variety of characters). Three votes of the four
make a positive. The trees see format and context, also what the labellers don't look at (length,
alphabet, the company of other candidates in the text), and have to infer the hidden check from it. All
rows take part: the training table is the count of candidates by feature values, whose size is
bounded by the feature grid, not by the data. Every kind has its own threshold, the lowest one that
reaches ``PRECISION`` on the fold of documents the trees did not see; a kind that never
does adds nothing. What a base rule rejected never comes back as a span of its kind.

Only DataFrame and SQL operations on the data; positions are code points.

Defined cases: a NULL or empty text has no spans; texts of any length are read
whole; repeated rows get equal spans; with no candidates there is no model and base
spans alone; an empty table gives an empty result; clashing columns of the
input are replaced by the result's.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tradelake.llm.common import staged

KINDS = ("email", "ip", "card", "phone", "id", "iban", "secret")
PRECISION = 0.9
ROUNDS, DEPTH, RATE = 30, 3, 0.3

# Each pattern starts a run of its characters at the run's first character or right
# after the match before (\G): no start inside a run can match where the run's
# start fails, so this finds the same matches in one pass over long runs.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    # base: (kind, pattern, what a text must hold to be searched, rule that a match must pass)
    "email": ("email", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", "true"),
    "ip": ("ip", r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]",
           "forall(split(x, '[.]'), p -> length(trim(leading '0' from p)) <= 3 "
           "and coalesce(try_cast(trim(leading '0' from p) as int), 0) <= 255)"),
    "card": ("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9]", "{digits} between 16 and 19 and {luhn}"),
    "phone": ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", "{digits} between 8 and 15"),
    # further generators
    "phone_local": ("phone", r"(?<![0-9])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])", r"[0-9]{3}[\x20.-][0-9]{4}", None),
    "national_id": ("id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]-[0-9]{2}-[0-9]", None),
    "email_spelled": ("email", r"(?i)[a-z0-9._%+-]{1,64}\x20?[\[(]at[\])]\x20?[a-z0-9-]{1,64}(?:\x20?(?:[\[(]dot[\])]|\.)\x20?[a-z0-9-]{1,64}){1,8}",
                      r"(?i)[\[(]at[\])]", None),
    "ip6": ("ip", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])", ":[0-9A-Fa-f]{1,4}:[0-9A-Fa-f]{1,4}:", None),
    "iban": ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}\x20?[A-Z0-9]{1,4}(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}", None),
    "secret": ("secret", r"(?:(?<![A-Za-z0-9_+/=-])|\G)[A-Za-z0-9_+/=-]{16,}+", "[A-Za-z0-9_+/=-]{16}", None),
}
BASE = ("email", "ip", "card", "phone")
CUES = ("(?i)tel|phone|fon|call|fax|mobil|mail|contact|correo|courriel",
        "(?i)token|key|secret|passw|pwd|auth|bearer|credential|api",
        "(?i)card|visa|iban|account|konto|compte|cuenta|ssn|social|carte|tarjeta|host|server|addr")

#: (feature, SQL over x (match), g (text before it), r (character after it), number of values, split by "=" or "<=")
FEATURES = (
    ("length", "least(9, length(x) div 5)", 10, "<="),
    ("digits", "cast(floor(4 * length(translate(x, translate(x, '0123456789', ''), '')) / length(x)) as int)", 5, "<="),
    # separators, and how many different characters there are
    ("shape", "least(2, length(x) - length(translate(x, ' .-():/', ''))) * 4 + least(3, size(array_distinct(split(x, ''))) div 6)",
     12, "="),
    ("alphabet", "case when x rlike '^[0-9a-f]+$' or x rlike '^[0-9A-F]+$' then 1 when x rlike '[a-z]' and x rlike '[A-Z]' "
                 "and x rlike '[0-9]' then 2 when x rlike '[0-9]' then 3 else 0 end", 4, "="),
    ("cue", "case " + " ".join(f"when c rlike r'{p}' then {k + 1}" for k, p in enumerate(CUES)) + " else 0 end", 4, "="),
    # behind an assignment, and how many other candidates the text has
    ("place", """cast(c rlike r'[:=]\\s*["\\x27]?$' as int) * 3 + least(2, company)""", 6, "="),
    ("glued", "cast(c rlike '[A-Za-z0-9]$' as int) + cast(r rlike '^[A-Za-z0-9]' as int)", 3, "<="),
)
#: Check of a candidate's content by generator, for the labellers only.
CHECKS = {
    "phone_local": r"x rlike r'^\(?[2-9][0-9]{2}\)?[ .-][2-9]'",
    "national_id": "not x rlike '^(000|666|9)' and not x rlike '-00-' and not x rlike '-0000$'",
    "email_spelled": r"x rlike r'(?i)([\[(]dot[\])]|\.)\x20?[a-z]{2,}$'",
    "ip6": "size(array_distinct(split(x, ':'))) > 2",
    "iban": "aggregate(split(concat(substr(replace(x, ' ', ''), 5), left(x, 4)), ''), 0, (acc, v) -> case when v = '' then acc "
            "when v between '0' and '9' then (acc * 10 + cast(v as int)) % 97 else (acc * 100 + ascii(v) - 55) % 97 end) = 1",
    "secret": "x rlike '[0-9]' and x rlike '[A-Za-z]' and size(array_distinct(split(x, ''))) >= 8",
}
VOTES = 3
GENERATORS = tuple(PATTERNS)


def _raw(s: str) -> str:
    return "r'" + s.replace("'", r"\x27") + "'"


def _bind(value: str, name: str, body: str) -> str:
    """SQL that evaluates ``value`` once and uses it as ``name`` in ``body``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _prefix(arr: str) -> str:
    """Sums of the elements before each one (one more than there are), short arrays."""
    return f"aggregate({arr}, array(0), (acc, v) -> concat(acc, array(element_at(acc, -1) + v)))"


def _starts(arr: str) -> str:
    """Sums before each element in blocks of 256, so long arrays aren't copied for each element."""
    blocks = f"transform(sequence(0, greatest(0, (size({arr}) - 1) div 256)), b -> slice({arr}, b * 256 + 1, 256))"
    sums = "transform(bl, b -> aggregate(b, 0, (acc, v) -> acc + v))"
    return _bind(blocks, "bl", _bind(_prefix(sums), "off",
                 f"flatten(transform(bl, (b, i) -> transform(slice({_prefix('b')}, 1, size(b)), v -> v + off[i])))"))


def _matches(generator: str, text: str = "__t") -> str:
    """SQL array of structs (s, e, x, c, r): span, match, up to 24 characters before it, the one after."""
    _, pattern, needs, _ = PATTERNS[generator]
    none = "cast(array() as array<struct<s:int,e:int,x:string,c:string,r:string>>)"
    steps = "transform(m, (x, i) -> length(x) + length(gaps[i]))"
    made = (f"transform(m, (x, i) -> struct(at[i] + length(gaps[i]) as s, at[i] + length(gaps[i]) + length(x) as e, x as x, "
            "right(gaps[i], 24) as c, left(gaps[i + 1], 1) as r))")
    body = _bind(f"regexp_extract_all({text}, {_raw(pattern)}, 0)", "m",
                 f"case when size(m) = 0 then {none} else " +
                 _bind(f"split({text}, {_raw(pattern)}, -1)", "gaps", _bind(_bind(steps, "d", _starts("d")), "at", made)) + " end")
    return f"case when {text} rlike {_raw(needs)} then {body} else {none} end"


def _rule(generator: str) -> str:
    digits = "length(translate(x, ' ().+-', ''))"
    luhn = ("aggregate(sequence(1, length(translate(x, ' -', ''))), 0, (acc, i) -> acc + "
            "transform(array(cast(substr(reverse(translate(x, ' -', '')), i, 1) as int)), v -> "
            "case when i % 2 = 1 then v when v > 4 then 2 * v - 9 else 2 * v end)[0]) % 10 = 0")
    return PATTERNS[generator][3].replace("{digits}", digits).replace("{luhn}", f"case when {digits} <= 19 then {luhn} else false end")


def candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``row`` (the other columns of ``docs``), ``unseen`` (the text is in the calibration fold), ``base`` spans and ``cand``:
    all candidates with features and the labellers' verdict."""
    # the input's columns travel in one struct, so that no name of theirs meets a helper's
    own = [f"`{c}`" for c in docs.columns if c != text_col]
    d = docs.selectExpr(f"struct({', '.join(own)}) as row" if own else "named_struct('none', null) as row",
                        f"coalesce(`{text_col}`, '') as __t")
    # copies of a text fall into one fold
    d = d.selectExpr("row", "pmod(xxhash64(__t), 4) = 0 as unseen", *[f"{_matches(g)} as m_{g}" for g in GENERATORS])
    base, cand = [], []
    for k, g in enumerate(GENERATORS):
        kind = KINDS.index(PATTERNS[g][0])
        accepted = f"transform(array(z.x), x -> {_rule(g)})[0]" if g in BASE else "false"
        if g in BASE:
            base.append(f"transform(filter(m_{g}, z -> {accepted}), z -> struct({kind} as k, z.s as s, z.e as e))")
        def of_match(sql):
            return ("transform(array(z), z -> transform(array(z.x), x -> transform(array(z.c), c -> "
                    f"transform(array(z.r), r -> {sql})[0])[0])[0])[0]")
        company = " + ".join(f"size(m_{o})" for o in GENERATORS) + " - 1"
        feats = ", ".join(f"{of_match(sql.replace('company', company))} as {name}" for name, sql, _, _ in FEATURES)
        votes = [f"cast({of_match(sql)} as int)" for sql in (
            f"{FEATURES[4][1]} > 0", f"{FEATURES[5][1].replace('company', '0')} >= 3", f"{FEATURES[6][1]} = 0", CHECKS.get(g, "false"))]
        teacher = accepted if g in BASE else f"{' + '.join(votes)} >= {VOTES}"
        cand.append(f"transform(m_{g}, z -> struct({kind} as k, z.s as s, z.e as e, {k} as gen, {feats}, {teacher} as label))")
    return d.selectExpr("row", "unseen", f"concat({', '.join(base)}) as base", f"concat({', '.join(cand)}) as cand")


# --- boosted trees on the table of feature counts ---------------------------------

COLUMNS = (("gen", len(GENERATORS), "="),) + tuple((n, size, op) for n, _, size, op in FEATURES)


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int):
    """Regression tree for gradients ``g`` and curvatures ``h``: nested (column, op, value, yes, no) or a leaf."""
    leaf = float(-g.sum() / (h.sum() + 1.0))
    if depth == 0 or len(x) < 2:
        return leaf
    best, gain = None, 1e-6
    whole = g.sum() ** 2 / (h.sum() + 1.0)
    for c, (_, size, op) in enumerate(COLUMNS):
        for v in range(size):
            yes = x[:, c] == v if op == "=" else x[:, c] <= v
            if yes.all() or not yes.any():
                continue
            got = sum(g[m].sum() ** 2 / (h[m].sum() + 1.0) for m in (yes, ~yes)) - whole
            if got > gain:
                best, gain = (c, op, v, yes), got
    if best is None:
        return leaf
    c, op, v, yes = best
    return c, op, v, _grow(x[yes], g[yes], h[yes], depth - 1), _grow(x[~yes], g[~yes], h[~yes], depth - 1)


def _value(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    c, op, v, a, b = tree
    yes = x[:, c] == v if op == "=" else x[:, c] <= v
    return np.where(yes, _value(a, x), _value(b, x))


def _tree_sql(tree) -> str:
    if isinstance(tree, float):
        return f"{tree!r}D"
    c, op, v, a, b = tree
    return f"case when z.{COLUMNS[c][0]} {op} {v} then {_tree_sql(a)} else {_tree_sql(b)} end"


class Model:
    """Boosted trees, compiled to SQL, and the threshold on their summed score: one, or one per kind."""

    def __init__(self, start: float, trees: list, threshold: float | dict[str, float], precision: dict[str, float] | None = None):
        self.start, self.trees, self.precision = start, trees, precision or {}
        self.thresholds = threshold if isinstance(threshold, dict) else dict.fromkeys(KINDS, threshold)

    def sql(self) -> str:
        return f"({self.start!r}D + " + " + ".join(f"({_tree_sql(t)})" for t in self.trees or [0.0]) + ")"

    def accepts(self) -> str:
        """SQL condition on a candidate z: one of an added generator whose score reaches its kind's threshold."""
        cuts = " ".join(f"when z.k = {KINDS.index(k)} then {t!r}D" for k, t in self.thresholds.items() if np.isfinite(t))
        return f"(z.gen >= {len(BASE)} and coalesce({self.sql()} >= case {cuts} end, false))" if cuts else "false"


def boost(x: np.ndarray, n: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, depth: int = DEPTH, rate: float = RATE):
    """(start, trees) for rows of feature values with ``n`` candidates, ``y`` of them positive."""
    p = (y.sum() + 0.5) / (n.sum() + 1.0)
    start = float(np.log(p / (1 - p)))
    f, trees = np.full(len(x), start), []
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-f))
        tree = _scaled(_grow(x, n * q - y, n * q * (1 - q), depth), rate)
        f = f + _value(tree, x)
        trees.append(tree)
    return start, trees


def _scaled(tree, rate: float):
    if isinstance(tree, float):
        return tree * rate
    c, op, v, a, b = tree
    return c, op, v, _scaled(a, rate), _scaled(b, rate)


def fit(found: DataFrame, precision: float = PRECISION) -> Model | None:
    """Fit trees and thresholds on the added candidates of ``candidates()``; the fold of unseen documents
    (a quarter, by hash of the text) calibrates a threshold per kind and measures its precision."""
    names = [c for c, _, _ in COLUMNS]
    table = (found.select("unseen", F.explode("cand").alias("z")).where(F.col("z.gen") >= len(BASE))
             .groupBy("unseen", F.col("z.k").alias("kind"), *[F.col(f"z.{c}").alias(c) for c in names])
             .agg(F.count("*").alias("n"), F.sum(F.col("z.label").cast("long")).alias("y"))).toPandas()
    train, test = table[~table["unseen"]], table[table["unseen"]]
    if not len(train):
        return None
    x, n, y = train[names].to_numpy(), train["n"].to_numpy(float), train["y"].to_numpy(float)
    start, trees = boost(x, n, y)
    cuts, reached = {}, {}
    for k, kind in enumerate(KINDS):
        judged = test[test["kind"] == k]
        judged = judged if len(judged) else train[train["kind"] == k]
        if not len(judged):
            continue
        score = start + sum(_value(t, judged[names].to_numpy()) for t in trees)
        order = np.argsort(-score, kind="stable")
        hits, size, s = np.cumsum(judged["y"].to_numpy()[order]), np.cumsum(judged["n"].to_numpy()[order]), score[order]
        good = [j for j in range(len(s)) if hits[j] >= precision * size[j] and (j + 1 == len(s) or s[j + 1] < s[j])]
        cuts[kind] = float(s[good[-1]]) - 1e-9 if good else float("inf")
        if good:
            reached[kind] = float(hits[good[-1]] / size[good[-1]])
    return Model(start, trees, cuts, reached)


def find_pii(docs: DataFrame, text_col: str = "text", precision: float = PRECISION) -> DataFrame:
    """``docs`` (without the text) with ``base`` and ``spans`` (base and added): arrays of (k, s, e), sorted; k indexes KINDS."""
    found = staged(candidates(docs, text_col), "pii-candidates")
    model = fit(found, precision)
    keep = [f"row.`{c}` as `{c}`" for c in docs.columns if c != text_col and c.lower() not in ("base", "spans")]
    ordered = "array_sort(base)"
    if model is None or model.accepts() == "false":
        return found.selectExpr(*keep, f"{ordered} as base", f"{ordered} as spans")
    likely = f"filter(cand, z -> not exists(base, b -> b.s < z.e and z.s < b.e) and {model.accepts()})"
    # of overlapping additions the one that starts first stays, the longer of two that start together
    first = (f"aggregate(array_sort(transform({likely}, z -> struct(z.s as s, -z.e as o, z.k as k))), "
             "cast(array() as array<struct<k:int,s:int,e:int>>), (acc, z) -> case when size(acc) > 0 and element_at(acc, -1).e > z.s "
             "then acc else concat(acc, array(named_struct('k', z.k, 's', z.s, 'e', -z.o))) end)")
    return found.selectExpr(*keep, f"{ordered} as base", f"array_sort(concat(base, {first})) as spans")


def spans_text(spans: str) -> Column:
    """kind:start:end of each span, joined with commas."""
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform({spans}, z -> concat_ws(':', {names}[z.k], z.s, z.e)), ',')")


def redact(text: str, spans: str) -> Column:
    """The text with each span replaced by its kind in brackets; of overlapping spans the one that starts first counts."""
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    by_start = f"array_sort(transform({spans}, z -> struct(z.s as s, z.e as e, z.k as k)))"
    return F.expr(
        f"transform(array(aggregate({by_start}, named_struct('at', 0, 'out', cast(array() as array<string>)), (acc, z) -> "
        f"case when z.s < acc.at then acc else named_struct('at', z.e, 'out', concat(acc.out, array("
        f"substr({text}, acc.at + 1, z.s - acc.at), concat('[', {names}[z.k], ']')))) end)), "
        f"a -> concat(array_join(a.out, ''), substr({text}, a.at + 1)))[0]")
