"""Quality rules: a threshold table compiled into one projection.

Every rule is a ratio with a lower and an upper bound; the table becomes SQL
text in a single ``selectExpr``, so a document is judged where it is read,
without a shuffle or a user function.

Defined cases: a NULL, empty or blank text has no words, every count is 0 and
it fails the base rule; a rule whose ratio has a zero divisor does not apply;
repeated rows are judged alike; an empty table gives an empty result; columns
of the input that clash with a result column are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradelake.llm.common import SPACE_CHARS, SPACE_CLASS, words

# Symbols counted, window length, base limits.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Frequent words of the corpus languages.
STOP_WORDS = (
    "a and are as at be by for from in is it of on or that the this to was with "
    "auf das dem den der des die ein eine für im ist mit nicht und von zu "
    "au avec de des du elle en et la le les ou par pas pour que qui sur un une "
    "con del el en las los no para por que se su una y"
).split()

#: (rule, ratio in SQL, least, most); NULL: no bound on that side.
RULES = (
    ("mean_word_chars", "word_chars / nullif(n_words, 0)", 2.0, 14.0),
    ("symbols_per_word", "n_symbols / nullif(n_words, 0)", None, 0.25),
    ("stop_word_share", "n_stop_words / nullif(n_words, 0)", 0.02, None),
    ("repeated_line_share", "n_dup_lines / nullif(n_lines, 0)", None, 0.7),
    ("bullet_line_share", "n_bullet_lines / nullif(n_lines, 0)", None, 0.9),
    ("ellipsis_line_share", "n_ellipsis_lines / nullif(n_lines, 0)", None, 0.3),
)


def _literal(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


# words covered by windows found at least twice: the window hashes are sorted with
# their positions, equal neighbours mark the repeated windows, and the starts of
# those, in order, cover min(8, gap to the next start) words each
_REPEATS = f"""
case when size(win) = size(array_distinct(win)) then 0L else
 transform(array(array_sort(transform(win, (h, i) -> struct(h as h, i as i)))), s ->
  transform(array(array_sort(transform(
    filter(sequence(0, size(s) - 1), j ->
       (j > 0 and s[greatest(j - 1, 0)].h = s[j].h)
       or (j < size(s) - 1 and s[least(j + 1, size(s) - 1)].h = s[j].h)),
    j -> s[j].i))), t ->
   aggregate(zip_with(slice(t, 2, size(t)), slice(t, 1, size(t) - 1), (b, a) -> least({WINDOW}, b - a)),
             {WINDOW}L, (acc, x) -> acc + x))[0])[0]
end"""


def text_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the counts that the rules use: n_words, word_chars, n_symbols, n_lines,
    n_dup_lines, n_bullet_lines, n_ellipsis_lines, n_stop_words, n_repeat_words."""
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_bullet_lines",
             "n_ellipsis_lines", "n_stop_words", "n_repeat_words"]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    spaces, symbols, symbol_class = _literal(SPACE_CHARS), _literal(SYMBOLS), _literal(f"[{SYMBOLS}]")
    stops = ", ".join(_literal(w) for w in sorted(set(STOP_WORDS)))
    # the input's columns travel in one struct, so that no name of theirs meets a helper's
    d = docs.select(F.struct("*").alias("__row"), text.alias("__t"), words(text).alias("__w"),
                    F.expr(r"filter(split(coalesce(`" + text_col + r"`, ''), '\n', -1), "
                           f"l -> length(btrim(l, {spaces})) > 0)").alias("__l"))
    # hashes of 2, 4 and 8 consecutive words, each from two of half the length
    for have, out, source in ((1, "h2", "__w"), (2, "h4", "h2"), (4, "win", "h4")):
        pair = f"zip_with({source}, slice({source}, {have + 1}, size({source})), (a, b) -> xxhash64(a, b))"
        d = d.selectExpr("*", f"case when size(__w) < {WINDOW} then cast(array() as array<bigint>) "
                              f"else slice({pair}, 1, size({source}) - {have}) end as {out}")
    return d.selectExpr(
        *[f"__row.`{c}` as `{c}`" for c in docs.columns if c.lower() not in names],
        "cast(size(__w) as bigint) as n_words",
        "cast(length(array_join(__w, '')) as bigint) as word_chars",
        f"case when __t rlike {symbol_class} then cast(length(__t) - length(translate(__t, {symbols}, '')) as bigint) "
        "else 0L end as n_symbols",
        "cast(size(__l) as bigint) as n_lines",
        "cast(size(__l) - size(array_distinct(__l)) as bigint) as n_dup_lines",
        "cast(size(filter(__l, l -> left(ltrim(l), 1) in ('-', '*', '•'))) as bigint) as n_bullet_lines",
        "cast(size(filter(__l, l -> endswith(rtrim(l), '...') or endswith(rtrim(l), '…'))) as bigint) as n_ellipsis_lines",
        f"cast(size(filter(__w, w -> w in ({stops}))) as bigint) as n_stop_words",
        f"{_REPEATS} as n_repeat_words",
    )


def quality_rules(docs: DataFrame, text_col: str = "text", rules=RULES, min_words: int = MIN_WORDS,
                  max_repeat_percent: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """Counts, base verdict, the first rule a document breaks, and ``kept``."""
    d = text_counts(docs, text_col)
    drop = {"base_failed", "failed_rule", "kept"}
    keep = [f"`{c}`" for c in d.columns if c.lower() not in drop]
    base = f"(n_words < {min_words} or 100 * n_repeat_words > {max_repeat_percent} * n_words)"
    checks = []
    for name, ratio, least, most in rules:
        bounds = [f"({ratio}) < {least}D"] * (least is not None) + [f"({ratio}) > {most}D"] * (most is not None)
        checks.append(f"when coalesce({' or '.join(bounds)}, false) then '{name}'")
    failed = f"case {' '.join(checks)} end" if checks else "cast(null as string)"
    d = d.selectExpr(*keep, f"{base} as base_failed", f"{failed} as failed_rule")
    return d.withColumn("kept", ~F.col("base_failed") & F.col("failed_rule").isNull())


def quality_sql(table: str = "documents", rules=RULES) -> str:
    """The same verdicts as SQL for an independent engine (windows by grouping, not by sorted hashes)."""
    stops = ", ".join("'" + w + "'" for w in sorted(set(STOP_WORDS)))
    checks = " ".join(
        "when coalesce(" + " or ".join([f"({r}) < {lo}"] * (lo is not None) + [f"({r}) > {hi}"] * (hi is not None))
        + f", false) then '{n}'" for n, r, lo, hi in rules)
    ws = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return rf"""
with d as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: length(trim(x, {ws})) > 0) as l
  from {table}),
starts as (
  select rid, unnest(range(1, len(w) - {WINDOW} + 2)) as i, w from d where len(w) >= {WINDOW}),
wins as (select rid, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') as win from starts),
rep as (select rid, i, lead(i) over (partition by rid order by i) as nxt
        from (select rid, i, count(*) over (partition by rid, win) as n from wins) where n > 1),
cover as (select rid, sum(case when nxt is null then {WINDOW} else least({WINDOW}, nxt - i) end) as n from rep group by rid),
c as (
  select doc_id, cast(len(w) as bigint) as n_words,
         cast(length(translate(t, {ws}, '')) as bigint) as word_chars,
         cast(length(t) - length(translate(t, '{SYMBOLS}', '')) as bigint) as n_symbols,
         cast(len(l) as bigint) as n_lines,
         cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
         cast(len(list_filter(l, lambda x: regexp_matches(ltrim(x), '^[-*•]'))) as bigint) as n_bullet_lines,
         cast(len(list_filter(l, lambda x: regexp_matches(rtrim(x), '(\.\.\.|…)$'))) as bigint) as n_ellipsis_lines,
         cast(len(list_filter(w, lambda x: x in ({stops}))) as bigint) as n_stop_words,
         cast(coalesce(cover.n, 0) as bigint) as n_repeat_words
  from d left join cover using (rid)),
v as (
  select *, (n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) as base_failed,
         case {checks} end as failed_rule
  from c)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (not base_failed and failed_rule is null) as kept, failed_rule
from v"""
