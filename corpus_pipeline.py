"""Corpus pipeline: language ID, near-dedup, decontamination, mixing, token output.

Every stage works on all that its predecessor kept, and its decisions take effect. Stages return the columns of documents; the last
returns the index of the token store that it wrote: (doc_id, start, n_tokens, ids_crc32), one row a repetition of a document.

Defined cases: documents with a null or letterless text go in the first stage; without labels, or with labels that can't be learned,
nothing else goes there; an empty table passes through as one; extra columns are carried along whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bag_minhash, decontaminate, language_id, mixing, token_output
from tidemark.llm.common import documents, materialise, packed, unpacked
from tidemark.llm.queries import tokenizer_path
from tidemark.session import work_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what has a language: not ``und``, and scored 0.25 and 1.2 times an even split over the languages or more."""
    return language_id.accept(docs, language_id.train(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of least id of each near-duplicate class."""
    return bag_minhash.drop_near_duplicates(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents as often as the mix takes them."""
    whole = docs.select("doc_id", "text", "source", packed(docs).alias("row"))
    mixed = mixing.mix(whole, weights=[3, 1, 2], total_share=1.5, max_epochs=2, partial=False, keep=["row"])
    times = F.explode(F.sequence(F.lit(1), F.col("epochs").cast("int"))).alias("time")
    return unpacked(mixed.filter("epochs > 0").select("row", times))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token store and read its index back."""
    path = work_dir(spark, "token-store")
    token_output.write_store(docs, path, tokenizer_path(), end_id=0)
    return token_output.read_store(spark, path)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate_benchmark),
    ("mix", mix_sources),
    ("token_output", write_tokens),
]

#: Learned languages, signatures and tokenizer ids have no SQL form; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
