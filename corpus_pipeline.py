"""From raw documents to token ids: rules, near copies, benchmark passages, secrets, encoding.

Every stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a DataFrame; ``run`` writes each stage's rows to the shared folder and reads
them again for the next one, so a lost executor costs no more than the stage that runs. All stages but the last return the columns of ``docs`` as they
came, extra ones included. Stages with Python workers take texts in batches of bounded bytes, so an executor's memory does not grow with the documents' length.

Rows with a NULL doc_id are judged by the rules, searched for benchmark items, scanned and encoded like others; as near copies they are kept. NULL and empty texts go with the
rules; very long ones are handled whole. Of equal rows all stay or all go, near copies but for the smallest doc_id. An empty table of documents gives no rows, an empty benchmark takes
none away.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.llm import bpe_duckdb, ngram_join, quality_cascade, secret_scan, template_decontam
from tickerlake.llm.common import small_batches, table
from tickerlake.session import materialise

#: Near copies: shingles of five words and a Jaccard similarity of 0.8.
SHINGLE, NUM, DEN = 5, 80, 100


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    small_batches(spark)
    return quality_cascade.kept_rows(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group linked by similarity."""
    small_batches(spark)
    found = ngram_join.similar_sets(docs.select("doc_id", "text"), SHINGLE, NUM, DEN, sparing=True)
    copies = found.where("component_id < doc_id").select(F.col("doc_id").alias("#copy")).distinct()
    copies = materialise(copies, "near-copies")
    return docs.join(copies, docs["doc_id"] == copies["#copy"], "left_anti")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return template_decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced."""
    small_batches(spark)
    return secret_scan.redacted(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and the digest of the decoded bytes, which is that of the text."""
    small_batches(spark)
    coded = bpe_duckdb.encode_decode(docs, sparing=True)
    return coded.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("byte-level BPE encoding and decoding", byte_bpe),
]
#: DuckDB has neither the tokenizer's pattern nor its merges; tests/llm compares the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
