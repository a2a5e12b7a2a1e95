"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's documents. The first four return the columns they were given.

1. quality: documents that importance resampling does not draw are dropped.
2. near duplicates: of each component of similar rows one stays, the least by id, text and the other
   columns; rows without id come after all others. Rows without words all stay.
3. decontamination: documents that hold a window of a benchmark item are dropped.
4. secrets: every secret gives way to its kind in brackets, and `n_chars` is counted again.
5. encoding: token ids of every text.

An empty table passes through as an empty table. Null texts are kept as null and encode to no tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, decontam, ngram_join, quality, secrets
from millrace.session import cut_lineage
from millrace.sources.tables import load

#: Quality resampling, similar documents and encoding run in Python within tasks: no SQL twin.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.resample(docs, quality.fit(docs, load(spark, sf_dir, "labels"))).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.without_contaminated(docs, load(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    changed = F.coalesce(F.length("text"), F.lit(0)).cast(kind)
    return masked.withColumn("n_chars", changed).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, columns=("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut_lineage(docs)
    return docs
