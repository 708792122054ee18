"""The corpus pipeline: stages that each apply one corpus operator.

Each stage gets (spark, docs, sf_dir) and returns a DataFrame; run() writes a
stage's result as Parquet in the shared folder and reads it back as the next
stage's documents. All stages but the last return the columns of documents.
Once a stage's result is written, the copies that the stage made on its way go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradelake.llm import line_dedup as lines, mixing, packing, simhash, toxicity
from tradelake.session import release_scratch, scratch_mark, scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar, fitted on labelled rows, rejects go."""
    labels = toxicity.training_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copied lines go, and documents of which nothing is left."""
    return lines.line_dedup(docs, short=True)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash.simhash_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to target weights takes them."""
    return mixing.mix(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents packed into windows."""
    import public_tokenizers

    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_documents),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: Grammar scores, fingerprints and token ids are beyond SQL: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        made = scratch_mark()
        out = stage(spark, docs, sf_dir)
        out.write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        release_scratch(made)
    return docs
