"""Benchmark decontamination: hash set of benchmark n-grams, scanned over training windows.

The benchmark's windows (``window`` consecutive normalised words of an item;
an item with fewer words is one window) form a set of 64-bit hashes that is
broadcast. Every document's windows are hashed from its word hashes, joined
against the set where they are read, and a hit is verified on the words
themselves before it counts; no window of a document is ever shuffled. Only
verified hits leave the scan, keyed by a digest of the text, so a group of
copies is combined in every task before anything moves.

The broadcast has a bound: a set beyond ``MAX_WINDOWS`` windows is cut into
blocks of at most that many, and the documents are scanned once per block.

Defined cases: NULL, empty and wordless texts have no words and no hit; a
NULL or wordless item has no window; items with one id are one item; items
with a NULL id hit and count as one item, but have no id to list; repeated
rows get equal results; an empty benchmark leaves every document clean;
result columns replace input columns of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tradelake.llm.common import free_name, staged

WINDOW = 10
MAX_WINDOWS = 250_000   # windows in one broadcast, about 150 bytes each

# What stands between normalised words (letters A-Z are lower-cased).
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
INSIDE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RESULTS = ("n_words", "n_hit", "n_items", "item_ids", "spans", "contaminated")


def raw_words(text: Column) -> Column:
    """Words of a text in their own case."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP, -1), "")


def _lowered(word: str) -> str:
    # lower() is only right for A-Z where the word has nothing but ASCII
    return (f"case when octet_length({word}) = char_length({word}) then lower({word}) "
            f"else translate({word}, '{_UPPER}', '{_LOWER}') end")


def _window_hashes(df: DataFrame, words: str, lengths: list[int]) -> DataFrame:
    """Add one array of hashes per window length (``__w<length>``), each built from two shorter windows.

    A column without a window of that length holds an empty array.
    """
    df = df.selectExpr("*", f"transform({words}, w -> xxhash64({_lowered('w')})) as __w1")
    done = {1}

    def build(df, n):
        if n in done:
            return df
        half = 1 << (n.bit_length() - 1)
        left, right = (half, n - half) if n != half else (half // 2, half // 2)
        df = build(build(df, left), right)
        done.add(n)
        # window n at i = window `left` at i and window `right` at i + left
        return df.selectExpr("*", f"""case when size({words}) < {n} then cast(array() as array<bigint>)
            else zip_with(slice(__w{left}, 1, size({words}) - {n - 1}),
                          slice(__w{right}, {left + 1}, size({words}) - {n - 1}), (a, b) -> xxhash64(a, b)) end as __w{n}""")

    for n in lengths:
        df = build(df, n)
    return df


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id",
                      text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(windows: hash, length, words; window items: words, item id), both without repeats, staged."""
    items = benchmark.select(F.col(f"`{id_col}`").cast("string").alias("item"), raw_words(F.col(f"`{text_col}`")).alias("ws"))
    items = items.where("size(ws) > 0").selectExpr("item", f"transform(ws, w -> {_lowered('w')}) as ws")
    items = items.selectExpr("item", f"least(size(ws), {window}) as len", "ws")
    pairs = staged(items.select("item", "len", F.expr(
        "explode(transform(sequence(1, size(ws) - len + 1), i -> array_join(slice(ws, i, len), ' ')))").alias("words"))
        .distinct(), "decon-items")
    windows = pairs.select("len", "words").distinct().withColumn("ws", F.split("words", " "))
    lengths = sorted(r[0] for r in windows.select("len").distinct().collect())  # at most `window` values
    hashed = _window_hashes(windows, "ws", lengths)
    pick = " ".join(f"when {n} then __w{n}[0]" for n in lengths) or "when 0 then 0L"
    return staged(hashed.selectExpr(f"case len {pick} end as hash", "len", "words"), "decon-windows"), pairs


def _text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def find_hits(docs: DataFrame, windows: DataFrame, text_col: str = "text", max_windows: int = MAX_WINDOWS) -> DataFrame:
    """(key, pos, len, words) of every verified occurrence of a window, once per distinct text; staged."""
    stats = windows.groupBy("len").count().collect()  # at most `window` rows
    lengths = sorted(r["len"] for r in stats)
    if not lengths:
        return windows.selectExpr("words as key", "len as pos", "len", "words").where("false")
    blocks = math.ceil(sum(r["count"] for r in stats) / max_windows)
    text = F.col(f"`{text_col}`")
    texts = docs.select(_text_key(text).alias("key"), raw_words(text).alias("__ws"))
    hashed = _window_hashes(texts, "__ws", lengths)
    sides = ", ".join(f"named_struct('n', {n}, 'hs', __w{n})" for n in lengths)
    if len(lengths) == 1:
        scan = hashed.selectExpr("key", "__ws", f"{lengths[0]} as n", f"posexplode_outer(__w{lengths[0]}) as (pos, hash)")
    else:
        scan = (hashed.selectExpr("key", "__ws", f"inline(array({sides})) as (n, hs)")
                .selectExpr("key", "__ws", "n", "posexplode_outer(hs) as (pos, hash)"))
    # outer explodes, as inner ones would be preceded by a filter that computes the arrays once more; and a word test
    # that can't serve as a join key, so that it is made for windows with an equal hash only, and that has no lambda,
    # so that explode and join are one compiled loop in which a window's row never holds a copy of the words
    same = f"array_contains(array(words), {_lowered("array_join(slice(__ws, pos + 1, n), ' ')")})"
    found = None
    for b in range(blocks):
        block = windows if blocks == 1 else windows.where(f"pmod(xxhash64(words), {blocks}) = {b}")
        hit = (scan.join(F.broadcast(block.withColumnRenamed("hash", "__hash")), F.col("hash") == F.col("__hash"))
               .where(f"n <=> len and {same}")
               .select("key", "pos", "len", "words"))
        found = hit if found is None else found.union(hit)
    return staged(found.distinct(), "decon-hits")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text",
                  id_col: str = "item_id", benchmark_text: str = "text", max_windows: int = MAX_WINDOWS) -> DataFrame:
    """Add n_words, n_hit (words inside an occurrence), n_items, item_ids (as sorted strings),
    spans (first and last hit word of each stretch) and contaminated."""
    windows, owners = benchmark_windows(benchmark, window, id_col, benchmark_text)
    hits = find_hits(docs, windows, text_col, max_windows)
    covered = "array_sort(array_distinct(flatten(collect_set(sequence(pos, pos + len - 1)))))"
    cover = hits.select("key", "pos", "len").distinct().groupBy("key").agg(F.expr(covered).alias("hit"))
    # stretches of consecutive hit words, in time linear in their number
    edges = lambda step, last: f"filter(h, (p, i) -> i = {last} or h[i + {step}] <> p + {step})"
    cover = cover.selectExpr("key", "cast(size(hit) as bigint) as n_hit", f"""transform(array(hit), h -> zip_with(
        {edges(-1, '0')}, {edges(1, 'size(h) - 1')}, (a, b) -> struct(a as first, b as last)))[0] as spans""")
    items = (hits.select("key", "words").distinct().join(owners.select("words", "item"), "words")
             .select("key", "item").distinct().groupBy("key")
             .agg(F.count("*").alias("n_items"), F.array_sort(F.collect_list("item")).alias("item_ids")))
    found = cover.join(items, "key").select("key", F.struct("n_hit", "n_items", "item_ids", "spans").alias("f"))
    text = F.col(f"`{text_col}`")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in RESULTS])
    rows = docs.select(row.alias("r"), _text_key(text).alias("key"),
                       F.size(raw_words(text)).cast("bigint").alias("n_words"))
    out = rows.join(found.hint("merge"), "key", "left")
    return out.selectExpr("r.*", "n_words", "coalesce(f.n_hit, 0L) as n_hit", "coalesce(f.n_items, 0L) as n_items",
                          "coalesce(f.item_ids, cast(array() as array<string>)) as item_ids",
                          "coalesce(f.spans, cast(array() as array<struct<first:int,last:int>>)) as spans",
                          "f.n_hit is not null as contaminated")


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", text_col: str = "text",
                  **options) -> DataFrame:
    """Documents without benchmark passages: whole documents go, or only the hit words with the gap before them."""
    if remove not in ("spans", "documents"):
        raise ValueError("remove must be 'spans' or 'documents'")
    judged = contamination(docs, benchmark, text_col=text_col, **options)
    names = [c for c in docs.columns if c.lower() not in RESULTS]
    if remove == "documents":
        return judged.where("not contaminated").select(*[f"`{c}`" for c in names])
    t, ws, gaps = free_name(docs, "__t"), free_name(docs, "__ws"), free_name(docs, "__gaps")
    text = f"`{text_col}`"
    parts = judged.selectExpr("*", f"case when contaminated then array_remove(split({text}, '{_sql(GAP)}', -1), '') end as {ws}",
                              f"case when contaminated then split({text}, '{_sql(INSIDE)}', -1) end as {gaps}")
    kept = f"""concat(array_join(zip_with(slice({gaps}, 1, size({ws})), transform({ws}, (w, i) -> if(
        exists(spans, s -> i between s.first and s.last), null, w)), (g, w) -> g || w), ''), {gaps}[size({ws})])"""
    parts = parts.selectExpr("*", f"case when contaminated then {kept} else {text} end as {t}")
    return parts.select(*[F.col(t).alias(c) if c == text_col else F.col(f"`{c}`") for c in names])


def _sql(pattern: str) -> str:
    return pattern.replace("\\", "\\\\")


def contamination_sql(window: int = WINDOW) -> str:
    """The query's columns in SQL for an independent engine: windows compared as lists of words."""
    words = (f"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
             r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")
    return rf"""
with d as (select row_number() over () as rid, doc_id, {words} as w from documents),
b as (select cast(item_id as varchar) as item, {words} as w from benchmark),
bl as (select item, w, least(len(w), {window}) as k from b where len(w) > 0),
bw as (select distinct item, k, array_to_string(w[i:i + k - 1], ' ') as win
       from (select item, w, k, unnest(range(1, len(w) - k + 2)) as i from bl)),
ks as (select distinct k from bw),
dw as (select rid, k, i, array_to_string(w[i:i + k - 1], ' ') as win
       from (select rid, w, k, unnest(range(1, len(w) - k + 2)) as i from d cross join ks where len(w) >= k)),
hit as (select rid, dw.k, i, item from dw join bw on dw.k = bw.k and dw.win = bw.win),
cover as (select rid, count(distinct p) as n from (
            select rid, unnest(range(i, i + k)) as p from (select distinct rid, k, i from hit)) group by rid),
its as (select rid, count(*) as n, coalesce(string_agg(item, ',' order by item), '') as ids
        from (select distinct rid, item from hit) group by rid)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(cover.n, 0) as bigint) as n_hit,
       cast(coalesce(its.n, 0) as bigint) as n_items, sha256(coalesce(its.ids, '')) as items_sha256,
       coalesce(cover.n, 0) > 0 as contaminated
from d left join cover using (rid) left join its using (rid)"""
