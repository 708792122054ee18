"""One registered query per corpus operator, with SQL where SQL can express it.

A query reads the operator's whole table, applies the operator with production
parameters and derives the columns that are compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradelake.llm import (conversations, decontaminate, embedding_dedup, line_dedup, mixing, packing, pii, quality, runs,
                           sharding, simhash, toxicity, warc)
from tradelake.llm.common import words

N_SHARDS = 64


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def op1_line_dedup(spark, d):
    out = line_dedup.line_dedup(_table(spark, d, "documents").select("doc_id", "text"), counts=True, short=True)
    return out.select("doc_id", "text", "n_lines", "n_removed")


def op2_toxicity(spark, d):
    docs = _table(spark, d, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, toxicity.training_labels(_table(spark, d, "labels")))
    held_out = F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")), F.lit(4)) == 2
    return toxicity.score(docs, model).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                                              "predicted", "matched")


def op3_warc(spark, d):
    archives = warc.write_archives(_table(spark, d, "pages"))
    return (warc.read_archives(spark, archives, with_payload=False)
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op4_quality_rules(spark, d):
    out = quality.quality_rules(_table(spark, d, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "failed_rule")


def op5_pii(spark, d):
    found = pii.find_pii(_table(spark, d, "documents").select("doc_id", "text"))
    counts = [F.expr(f"cast(size(filter(base, z -> z.k = {k})) as bigint)").alias(f"n_{kind}")
              for k, kind in enumerate(pii.BASE)]
    return found.select("doc_id", *counts, F.sha2(pii.spans_text("base"), 256).alias("base_sha256"),
                        pii.spans_text("spans").alias("spans"))


def op6_sharding(spark, d):
    docs = _table(spark, d, "documents")
    shards = [f"shard-{k:03d}" for k in range(N_SHARDS)]
    return sharding.assign_shards(docs.select("doc_id", "source"), ["doc_id"], shards)


def op7_simhash(spark, d):
    out = simhash.simhash_classes(_table(spark, d, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_packing(spark, d):
    import public_tokenizers

    out = packing.pack(_table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                       public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_mixing(spark, d):
    plan = mixing.mix_plan(_table(spark, d, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op10_embedding_dedup(spark, d):
    return embedding_dedup.embedding_classes(_table(spark, d, "embeddings"))


def op11_periodic_runs(spark, d):
    # a periodic tail is planted in every tenth document (by the checksum of its id)
    planted = """case when h % 10 = 0 then transform(array(w), v -> transform(v, (x, i) -> if(i < g % size(v), x,
        v[cast(g % size(v) + (i - g % size(v)) % (1 + (size(v) - g % size(v)) div (3 + g % 8)) as int)])))[0] end"""
    docs = _table(spark, d, "documents").select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    docs = docs.withColumn("g", F.expr("h div 10")).withColumn("w", F.when(F.expr("h % 10 = 0"), words(F.col("text"))))
    docs = docs.withColumn("w", F.expr(planted))
    docs = docs.selectExpr("doc_id", "coalesce(array_join(w, ' '), text) as text")
    found = runs.find_runs(docs)
    # the longest run; of equal ones the first, then the least period
    best = """array_min(transform(runs, r -> struct(-r.length as n, r.start as start, r.period as period)))"""
    listed = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, chr(10))), '')"
    found = found.select("doc_id", F.expr("cast(size(runs) as bigint)").alias("n_runs"), F.expr(best).alias("b"),
                         F.sha2(F.expr(listed), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return found.selectExpr("doc_id", "n_runs", "b.start as start", "-b.n as length", "b.period as period",
                            "cast(-1000 * b.n div b.period as bigint) as exponent_milli", "runs_sha256", "collapsed_sha256")


def op12_decontaminate(spark, d):
    found = decontaminate.contamination(_table(spark, d, "documents").select("doc_id", "text"), _table(spark, d, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op13_conversations(spark, d):
    rows = _table(spark, d, "conversations")
    found = conversations.repair_conversations(conversations.damage(rows)).withColumnRenamed("conv_id", "cid")
    every = rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("cid")), "left")
    return every.select("conv_id", *[F.coalesce(m, F.lit(0)).alias(m) for m in conversations.METRICS],
                        F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_warc": op3_warc,
    "op4_quality_rules": op4_quality_rules,
    "op5_pii": op5_pii,
    "op6_sharding": op6_sharding,
    "op7_simhash": op7_simhash,
    "op8_packing": op8_packing,
    "op9_mixing": op9_mixing,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_decontaminate": op12_decontaminate,
    "op13_conversations": op13_conversations,
}

ORACLE_SQL = {
    "op4_quality_rules": quality.quality_sql(),
    "op9_mixing": mixing.mixing_sql(),
    "op12_decontaminate": decontaminate.contamination_sql(),
}
