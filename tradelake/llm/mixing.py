"""Mixing sources to target weights by weighted fair queueing.

The documents of a source are shuffled by a hash of their id. A document's
virtual finish time is the number of its source's words up to and including
it, divided by the source's target; a second pass over the source goes on
where the first ends. All documents are range-sorted by virtual finish time
and the order is cut where the total budget is reached, so each source gives
its target to within about one document.

Only DataFrame operations. A source that holds most rows is no special case:
running sums are taken over a global range partitioning, never per source.

Defined cases: NULL texts have size 0; the NULL source is a source of its own,
last in the order; with no words at all every target and ``taken`` is 0;
repeated rows count each; an empty table gives an empty result. Reruns agree,
because the order depends on doc_id, size and the seed alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tradelake.llm.common import free_name, running_total, staged, words

WEIGHTS = (3, 1, 2)  # by source in code-point order, repeating
BUDGET = 1.5         # of all sizes
MAX_REPEATS = 2      # of a source's size


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: rank, source_size, base (words of the sources before it), target, total target.

    The shares of the budget that exceed a source's cap are reshared by weight
    until none is above: sources fill up in the order of cap / weight, so the
    level reached is read off running sums in that order. The windows run over
    the list of sources, one row each.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("rank", F.row_number().over(by_name))
    per = per.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(repeats)))
    fill = Window.orderBy(F.col("cap") / F.col("w"), "rank")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("level", (F.sum("source_size").over(whole) * F.lit(budget)
                                   - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(rest))
    # the first source, in filling order, that the level does not fill sets the level
    per = per.withColumn("level", F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(
        (F.col("cap") / F.col("w")).alias("at"), F.col("rank").alias("r"), F.col("level").alias("level")))).over(whole)["level"])
    per = per.withColumn("target", F.least("cap", F.coalesce(F.col("level") * F.col("w"), F.col("cap"))))
    name_before = by_name.rowsBetween(Window.unboundedPreceding, -1)
    return per.select("source", "rank", "source_size", "target",
                      F.coalesce(F.sum("source_size").over(name_before), F.lit(0)).alias("base"),
                      F.sum("target").over(whole).alias("total"))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
             weights=WEIGHTS, budget: float = BUDGET, repeats: int = MAX_REPEATS, seed: str = "mix",
             rid_col: str | None = None) -> DataFrame:
    """Per row of ``docs``: rid, doc_id, size, source_size, target, copies and taken (words of the copies taken).

    ``rid_col`` names a column that is unique per row; without it the rows are numbered.
    """
    i, s, t = (F.col(f"`{c}`") for c in (id_col, source_col, text_col))
    rid = F.col(f"`{rid_col}`") if rid_col else F.monotonically_increasing_id()
    order = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(i.cast("string"), F.lit("null")))), 1, 15), 16, 10)
    sizes = staged(docs.select(rid.alias("rid"), i.alias("doc_id"), s.cast("string").alias("source"),
                               F.size(words(t)).cast("long").alias("size"), order.cast("long").alias("ord")), "mix-sizes")
    targets = staged(source_targets(sizes, weights, budget, repeats), "mix-targets")
    known = (sizes.withColumn("__s", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
             .join(targets.withColumn("__s", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))).drop("source"), "__s")
             .drop("__s", "source"))
    by_source = [F.col("rank"), F.col("ord"), F.col("size")]
    queued = running_total(known, by_source, "size", "cum", "mix-queues").withColumn("cum", F.col("cum") - F.col("base"))
    copies = (queued.withColumn("pass", F.explode(F.expr(f"sequence(0, {repeats - 1})")))
              .withColumn("finish", (F.col("pass") * F.col("source_size") + F.col("cum")) / F.nullif("target", F.lit(0.0))))
    order = [F.col("finish").asc_nulls_last(), F.col("rank"), F.col("ord"), F.col("size"), F.col("pass")]
    mixed = running_total(copies, order, "size", "spent", "mix-order")
    mixed = mixed.withColumn("take", (F.col("size") > 0) & F.col("finish").isNotNull()
                             & (F.col("spent") - F.col("size") < F.col("total")))
    return mixed.groupBy("rid").agg(
        F.first("doc_id").alias("doc_id"), F.first("size").alias("size"),
        F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.sum(F.col("take").cast("int")).alias("copies"),
        F.sum(F.when(F.col("take"), F.col("size")).otherwise(F.lit(0))).alias("taken"),
        F.min(F.when(F.col("take"), F.col("finish"))).alias("first_finish"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the mix takes it, columns unchanged."""
    rid = free_name(docs, "__rid")
    numbered = staged(docs.withColumn(rid, F.monotonically_increasing_id()), "mix-docs")
    plan = mix_plan(numbered, rid_col=rid, **options)
    copies = F.explode(F.expr("sequence(1, copies)"))
    plan = staged(plan.where("copies > 0").select(F.col("rid").alias(rid), copies.alias(f"{rid}_copy")), "mix-plan")
    # texts are joined by sorting at every size alike: the plan grows with the corpus
    return numbered.hint("merge").join(plan, rid).select(*[F.col(f"`{c}`") for c in docs.columns])


def mixing_sql(table: str = "documents", seed: str = "mix") -> str:
    w1, w2, w3 = (float(x) for x in WEIGHTS)
    return rf"""
with d as (
  select row_number() over () as rid, doc_id, source,
         cast(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) as bigint) as size,
         cast('0x' || substr(md5('{seed}:' || coalesce(cast(doc_id as varchar), 'null')), 1, 15) as bigint) as ord
  from {table}),
s as (select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) as rank from d group by source),
c as (select *, case rank % 3 when 1 then {w1} when 2 then {w2} else {w3} end as w, source_size * {float(MAX_REPEATS)} as cap from s),
f as (select *, (sum(source_size) over () * cast({BUDGET} as double)
             - coalesce(sum(cap) over (order by cap / w, rank rows between unbounded preceding and 1 preceding), 0.0))
             / sum(w) over (order by cap / w, rank rows between current row and unbounded following) as lev from c),
g as (select *, (select lev from f where lev * w <= cap order by cap / w, rank limit 1) as level from f),
t as (select source, rank, source_size, least(cap, coalesce(level * w, cap)) as target from g),
tt as (select *, sum(target) over () as total from t),
q as (select d.rid, d.doc_id, d.size, d.ord, tt.rank, tt.source_size, tt.target, tt.total,
             sum(d.size) over (partition by tt.rank order by d.ord, d.size rows between unbounded preceding and current row) as cum
      from d join tt on d.source is not distinct from tt.source),
p as (select q.*, e.pass, cast(e.pass * source_size + cum as double) / nullif(target, 0.0) as finish
      from q, (select unnest(range(0, {MAX_REPEATS})) as pass) e),
m as (select *, sum(size) over (order by finish nulls last, rank, ord, size, pass rows between unbounded preceding and current row) as spent from p)
select doc_id, size, source_size, target,
       cast(sum(case when size > 0 and finish is not null and spent - size < total then size else 0 end) as bigint) as taken
from m group by rid, doc_id, size, source_size, target"""
