"""Toxicity: a weighted finite-state pattern grammar over clauses.

The tokens of a clause are read as symbols (term, verb of harm, agent, target,
negation, verb of saying, quotation mark, other) by small transducers, each a
table of states:

* threat: how far the last first person or modal reaches; a verb of harm within it is a threat;
* target: how far the last second or third person reaches, read from the left and from the
  right; the subject of a verb of saying is no target;
* negation: how far the last negation reaches;
* reported speech: whether a verb of saying came, and whether a quotation is open;
* insult: a lexicon term, with its weight.

The tables are composed into one, whose states carry the outputs of all; a
clause is run through it once per direction. What scores is a composed
pattern: a threat, a term with a target, or several terms in a clause. Negation
and reported speech scale it down. A term by itself is evidence, but no insult
to anybody: it counts ``BARE`` of its weight. A document's raw score is the sum over its
matched clauses, calibrated to a probability.

The lexicon is the fixed seed list plus terms learned from labelled rows: words
and word beginnings that follow many different words in toxic documents and
hardly any in clean ones. Counting different left neighbours, not occurrences,
keeps a copied document from turning its own words into terms. Labels are
only used in fit(); score() sees the text alone.

Fitting uses ``TRAIN_ROWS`` labelled rows, the first by a hash of their id;
all terms that they support are gathered. Everything else runs over all rows.

Defined cases: NULL, empty and blank texts match nothing and get the score of
a text without matches; NULL labels are not used, of several labels for one
id the largest counts; without any toxic label the seed list alone scores;
repeated rows get equal scores; an empty table gives an empty result; clashing
columns of the input are replaced by the result's.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tradelake.llm.common import free_name, staged

TRAIN_ROWS = 5000
MIN_NEIGHBOURS = 4    # different left neighbours in toxic texts that a term needs
MIN_LOG_ODDS = 3.0
PREFIXES = (4, 5, 6)  # lengths of word beginnings that can become terms
CUT = 0.3             # score from which a document counts as toxic

# Fixed values of the grammar.
INSULTS = ("idiot moron imbecile loser scum trash garbage vermin clown stupid dumb pathetic worthless disgusting "
           "filthy bastard bitch asshole dumbass retard whore slut pig scumbag idiota imbécil estúpido basura "
           "idiotin dummkopf abschaum arschloch widerlich imbécile crétin connard ordure minable").split()
HARM = "kill murder hurt stab shoot beat burn destroy crush töten umbringen schlagen tuer frapper matar golpear".split()
AGENTS = "i we i'll we'll gonna will shall must should ich wir werde werden je nous vais allons yo voy vamos".split()
TARGETS = ("you your u he she they them him her his their this that these those people du dich euch sie ihr "
           "tu te toi vous ils elle eux tú ti usted ellos ellas").split()
NEGATIONS = "not no never isn't aren't don't nicht kein keine nie jamais pas nunca jamás".split()
REPORTING = ("said says say claimed claims wrote reported called quoted sagte schrieb behauptet dit écrit "
             "affirme dijo escribió afirma").split()

SEED_WEIGHT = 3.0
THREAT_WEIGHT = 4.0
TARGET_GAIN = 1.25
BARE = 0.5
NEGATED = 0.5
REPORTED = 0.5
NEGATION_REACH = 3
TARGET_REACH = 4

_TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[\"“”«»]")
_CLAUSE_END = re.compile(r"[.!?;\n]")


# Symbols that the transducers read.
OTHER, TERM, HARM_VERB, AGENT, TARGET, NEGATION, REPORT, QUOTE = range(8)
Table = list[list[int]]  # next state by state and symbol; state 0 is the start


def reaching(symbol: int, reach: int, stop: int | None = None) -> Table:
    """State k: a ``symbol`` was read and reaches k tokens more (0: none); ``stop`` ends it, quotation marks don't count."""
    def step(state: int, read: int) -> int:
        if read == symbol:
            return reach
        return 0 if read == stop else state if read == QUOTE else max(0, state - 1)
    return [[step(k, s) for s in range(8)] for k in range(reach + 1)]


def staying(symbol: int) -> Table:
    """State 1 from the first ``symbol`` on."""
    return [[int(s == symbol) for s in range(8)], [1] * 8]


def switching(symbol: int) -> Table:
    """Every ``symbol`` changes between the states 0 and 1."""
    return [[int(s == symbol) for s in range(8)], [int(s != symbol) for s in range(8)]]


def compose(*tables: Table) -> tuple[Table, list[tuple[bool, ...]]]:
    """The product of the tables: (its table, per state whether each component is away from its start)."""
    states, table = [(0,) * len(tables)], []
    number = {states[0]: 0}
    for state in states:  # grows while new states are met
        row = []
        for s in range(8):
            then = tuple(t[k][s] for t, k in zip(tables, state))
            if then not in number:
                number[then] = len(states)
                states.append(then)
            row.append(number[then])
        table.append(row)
    return table, [tuple(k > 0 for k in state) for state in states]


# outputs: negated, agent before, target before, reported, quoted; and from the right: target behind
FORWARD = compose(reaching(NEGATION, NEGATION_REACH), reaching(AGENT, TARGET_REACH),
                  reaching(TARGET, TARGET_REACH, stop=REPORT), staying(REPORT), switching(QUOTE))
BACKWARD = compose(reaching(TARGET, TARGET_REACH))


def outputs(machine: tuple[Table, list[tuple[bool, ...]]], symbols: list[int]) -> list[tuple[bool, ...]]:
    """The machine's outputs before each symbol."""
    (table, flags), state, out = machine, 0, []
    for s in symbols:
        out.append(flags[state])
        state = table[state][s]
    return out


@dataclass(frozen=True)
class Model:
    """Term weights (a term that ends in ``*`` is a word beginning) and the calibration."""
    terms: dict[str, float] = field(default_factory=dict)
    offset: float = -3.0
    slope: float = 3.0
    bare: float = BARE

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-(self.offset + self.slope * np.log1p(raw))))


class Grammar:
    """The composed transducers for one model."""

    def __init__(self, model: Model):
        self.bare = model.bare
        self.exact = {t: w for t, w in model.terms.items() if not t.endswith("*")}
        self.starts = {t[:-1]: w for t, w in model.terms.items() if t.endswith("*")}
        self.lengths = sorted({len(t) for t in self.starts}, reverse=True)
        self.find = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for t in [*self.exact, *self.starts, *HARM]:
            self.find.add_word(t)
        self.find.make_automaton()

    def weight(self, token: str) -> float:
        if token in self.exact:
            return self.exact[token]
        return next((self.starts[token[:n]] for n in self.lengths if token[:n] in self.starts and len(token) >= n), 0.0)

    def clause(self, tokens: list[str]) -> float:
        """Weight of the patterns that one clause matches."""
        weights = [self.weight(t) for t in tokens]
        symbols = [TERM if w else _SYMBOLS.get(t, OTHER) for t, w in zip(tokens, weights)]
        before = outputs(FORWARD, symbols)
        behind = outputs(BACKWARD, symbols[::-1])[::-1]
        hits = [k for k, s in enumerate(symbols) if s == TERM or s == HARM_VERB and before[k][1]]
        total = 0.0
        for k in hits:
            negated, _, target, reported, quoted = before[k]
            target = target or behind[k][0]
            w = weights[k] if symbols[k] == TERM else THREAT_WEIGHT
            w *= TARGET_GAIN if target else self.bare if symbols[k] == TERM and len(hits) == 1 else 1.0
            w *= NEGATED if negated else 1.0
            w *= REPORTED if reported or quoted else 1.0
            total += w
        return total

    def text(self, text: str) -> tuple[float, int]:
        """Sum of clause weights and number of matched clauses; only clauses that hold a lexicon string are read."""
        low = text.lower()
        total, matched, done = 0.0, 0, -1
        for end, n in self.find.iter(low):
            start = end - n + 1
            if start < done or (start and low[start - 1].isalpha()):
                continue
            left = max(low.rfind(c, 0, start) for c in ".!?;\n") + 1
            m = _CLAUSE_END.search(low, end)
            done = m.start() if m else len(low)
            w = self.clause(_TOKEN.findall(low, left, done))
            total += w
            matched += w > 0
        return total, matched


_SYMBOLS = {t: s for s, tokens in ((REPORT, REPORTING), (NEGATION, NEGATIONS), (TARGET, TARGETS), (AGENT, AGENTS),
                                   (HARM_VERB, HARM), (QUOTE, '"“”«»')) for t in tokens}


def training_labels(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, toxic) of the rows that may be learned from: crc32 of the id as text, mod 4, is not 2."""
    crc = F.crc32(F.encode(F.col(id_col).cast("string"), "utf-8"))
    return (labels.where(F.col("toxic").isNotNull() & (F.pmod(crc, F.lit(4)) != 2))
            .groupBy(F.col(id_col).alias("doc_id")).agg(F.max("toxic").alias("toxic")))


def _training_texts(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    picked = labels.orderBy(F.xxhash64(F.lit("train"), "doc_id"), "doc_id").limit(rows)
    picked = staged(picked, "toxic-labels")  # at most ``rows`` rows: safe to broadcast
    return staged(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
                  .where(F.col("text").isNotNull()), "toxic-train")


def learn_terms(train: DataFrame, min_neighbours: int = MIN_NEIGHBOURS,
                min_log_odds: float = MIN_LOG_ODDS) -> dict[str, float]:
    """Terms and weights (log odds of their left neighbours in toxic against clean texts)."""
    pairs = (train.select("toxic", F.expr(r"regexp_extract_all(lower(text), '[\\p{L}\']+', 0)").alias("w"))
             .select("toxic", F.expr("explode(zip_with(w, array_insert(w, 1, ''), (b, a) -> "
                                     "struct(a as before, b as word)))").alias("p"))
             .select("toxic", "p.before", "p.word").where("word is not null").distinct())
    words = staged(pairs.groupBy("word").agg(F.sum(F.col("toxic").cast("long")).alias("pos"),
                                             F.count("*").alias("n")), "toxic-words")
    cuts = ", ".join(f"case when length(word) > {k} then concat(left(word, {k}), '*') end" for k in PREFIXES)
    counts = staged(words.select("pos", "n", F.explode(F.expr(f"array_compact(array(word, {cuts}))")).alias("term"))
                    .groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n")), "toxic-terms")
    total = words.agg(F.sum("pos").alias("pos"), F.sum("n").alias("n")).first()
    pos, neg = total["pos"] or 0, (total["n"] or 0) - (total["pos"] or 0)
    if not pos or not neg:
        return {}
    # evidence: the log-likelihood gain over the overall share of toxic neighbours must outweigh
    # the number of terms that were tried, or chance would supply some
    share, terms_tried = pos / (pos + neg), max(1, counts.count())
    hits, n = F.col("pos"), F.col("n")
    gain = (hits * F.log(hits / n / share)
            + F.when(n > hits, (n - hits) * F.log((n - hits) / n / (1.0 - share))).otherwise(0.0))
    odds = (F.log((F.col("pos") + 0.5) / (pos + 1.0)) - F.log((F.col("n") - F.col("pos") + 0.5) / (neg + 1.0)))
    # terms of at most train_rows texts that are significant among all that were tried
    top = (counts.withColumn("odds", odds)
           .where((hits >= min_neighbours) & (F.col("odds") >= min_log_odds) & (gain >= F.lit(np.log(100.0 * terms_tried))))
           .collect())
    found = {r["term"]: (r["pos"], r["n"], float(r["odds"])) for r in top}
    return _choose(found, pos, neg, min_neighbours, min_log_odds)


def _choose(found: dict[str, tuple[int, int, float]], pos: int, neg: int, min_neighbours: int,
            min_log_odds: float) -> dict[str, float]:
    """Terms that don't repeat each other: a beginning is kept if what its clearly more
    telling extensions leave over still qualifies, and an extension only if it is clearly more telling."""
    chosen: dict[str, float] = {}
    for term in sorted(found, key=lambda t: (-len(t.rstrip("*")), t.endswith("*"), t)):
        hits, n, odds = found[term]
        if term.endswith("*"):
            below = [t for t in chosen if t.startswith(term[:-1]) and chosen[t] > odds + 0.5]
            below = [t for t in below if not any(o != t and o.endswith("*") and t.startswith(o[:-1]) for o in below)]
            hits, n = hits - sum(found[t][0] for t in below), n - sum(found[t][1] for t in below)
            odds = float(np.log((hits + 0.5) / (pos + 1.0)) - np.log((n - hits + 0.5) / (neg + 1.0)))
            if hits < min_neighbours or odds < min_log_odds:
                continue
            chosen = {t: w for t, w in chosen.items() if not t.startswith(term[:-1]) or w > odds + 0.5}
        chosen[term] = odds
    return chosen


def _calibrate(raw: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on log(1 + raw), lightly penalised, by Newton steps."""
    x = np.column_stack([np.ones(len(raw)), np.log1p(raw)])
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ b))
        g = x.T @ (toxic - p) - 0.1 * b
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        step = np.linalg.solve(h, g)
        b += step
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0]), float(b[1])


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, bare: float = BARE) -> Model:
    """Learn the lexicon and the calibration from labelled rows (columns doc_id and toxic)."""
    train = _training_texts(docs, labels, train_rows)
    terms = {t: SEED_WEIGHT for t in INSULTS} | learn_terms(train)
    model = Model(terms, bare=bare)
    seen = score(train, model).select("raw", "toxic").toPandas()  # at most train_rows rows
    toxic = (seen["toxic"].to_numpy() > 0).astype(float)
    if 0 < toxic.sum() < len(toxic):
        offset, slope = _calibrate(seen["raw"].to_numpy(), toxic)
        if slope > 0:
            return Model(terms, offset, slope, bare)
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """``docs`` with raw (sum of clause weights), matched (clauses), score (0 to 1) and predicted (0 or 1)."""
    @F.pandas_udf("raw double, matched long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        grammar = Grammar(model)
        for t in texts:
            yield pd.DataFrame([grammar.text(x) if x else (0.0, 0) for x in t], columns=["raw", "matched"])

    new = ("raw", "matched", "score", "predicted")
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in new]
    m = free_name(docs, "__m")
    out = docs.select(*keep, of(F.col(f"`{text_col}`")).alias(m)).select(*keep, f"{m}.raw", f"{m}.matched")
    p = 1.0 / (1.0 + F.exp(-(F.lit(model.offset) + F.lit(model.slope) * F.log1p("raw"))))
    return out.withColumn("score", p).withColumn("predicted", (F.col("score") >= cut).cast("int"))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that the grammar does not reject, columns unchanged."""
    @F.pandas_udf("boolean")
    def toxic(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        grammar = Grammar(model)
        for t in texts:
            raw = np.array([grammar.text(x)[0] if x else 0.0 for x in t])
            yield pd.Series(model.probability(raw) >= cut)
    return docs.where(~toxic(F.col(f"`{text_col}`")))
