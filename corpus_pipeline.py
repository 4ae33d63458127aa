"""The corpus pipeline: quality rules, n-gram Jaccard join, benchmark decontamination, PII, byte-level BPE.

Each stage takes (spark, docs, sf_dir), works on all documents that its predecessor kept, and returns a
DataFrame that is written as Parquet and reread as the next stage's docs. All but the last return the
columns of documents, whatever further ones there are. Very long texts are whole rows' work in every stage, and an
empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberflux.llm import bpe, common, decontaminate, jaccard_join, pii, quality_rules


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source.

    Null and empty texts fail the base rules. Rows that repeat a doc_id are judged each by its own text,
    lang and source; rows without doc_id go.
    """
    row = common.free_name(docs.columns, "row")
    kept = quality_rules.quality_rules(docs).where("kept").select("doc_id", F.col("row_key").alias(row)).distinct()
    return docs.withColumn(row, quality_rules.row_key()).join(kept, ["doc_id", row], "left_semi").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id; of rows equal in doc_id and text one.

    Texts without words are linked with nothing and stay. Rows that repeat a doc_id with different texts
    are rows of their own: each stays or goes by its own text.
    """
    row = common.free_name(docs.columns, "row")
    first = jaccard_join.jaccard_join(docs).groupBy("root").agg(F.min(F.struct("doc_id", "row_key")).alias("x")).select("x.doc_id", F.col("x.row_key").alias("only"))
    rows = docs.withColumn(row, F.xxhash64(F.col("text").cast("string")))
    stays = (rows["doc_id"] == first["doc_id"]) & (first["only"].isNull() | (first["only"] == rows[row]))
    return rows.join(first, stays, "left_semi").dropDuplicates(["doc_id", row]).select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that is a test item but for a few edits; each row by its own text, null ones stay."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced in their texts; a null text stays null, each row by its own text."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    kept = F.struct(*others) if others else F.lit(None).cast("struct<none:int>")
    found = pii.find_private(docs.select("doc_id", "text", kept.alias("kept")), "kept").select("doc_id", pii.sanitized().alias("text"), "kept")
    out = found.select("doc_id", "text", *(F.col("kept")[c].alias(c) for c in others))
    if "n_chars" in others:
        out = out.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of what they decode to."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", benchmark), ("PII", private), ("byte-level BPE", tokens)]

#: Robust estimates and set links are beyond SQL; the tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = common.materialize(docs, f"stage{k + 1}")
    return docs
