"""The stages in order, their decisions against brute force, and odd rows."""

import hashlib
import importlib
import sys

import corpus_pipeline
import tiktoken
from test_ngram_join import brute

from tickerlake.llm import bpe_duckdb, secret_scan, template_decontam

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "byte-level BPE encoding and decoding",
    ]
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.materialise(stage(spark, out[-1], SF), "stage"))
    assert all(d.schema == docs.schema for d in out[:-1])
    given, good, single, clean, plain = ({r["doc_id"]: r["text"] for r in d.collect()} for d in out[:-1])
    linked = brute(list(good.items()), 5, 80, 100)
    assert set(single) == {d for d, _, root in linked if d == root}
    bad = {r["doc_id"] for r in template_decontam.contaminated(out[2], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert {d for d, t in single.items() if any(i in t for i in items)} <= bad
    assert set(clean) == set(single) - bad
    assert plain == {d: secret_scan.redact(t, secret_scan.secret_spans(t)) for d, t in clean.items()}
    coder = bpe_duckdb.tokenizer(bpe_duckdb.default_path(), bpe_duckdb.default_pattern())
    library = tiktoken.Encoding("own", pat_str=bpe_duckdb.default_pattern(), mergeable_ranks=coder.ranks, special_tokens={})
    rows = out[-1].collect()
    assert {r["doc_id"]: list(r["ids"]) for r in rows} == {d: library.encode_ordinary(t) for d, t in plain.items()}
    assert all(r["decoded_sha256"] == hashlib.sha256(plain[r["doc_id"]].encode()).hexdigest() for r in rows)


def test_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert {r["doc_id"] for r in docs.collect()} == {1, None}
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []


def test_entry_lists_the_queries():
    sys.modules.pop("__spark_entry__", None)
    entry = importlib.import_module("__spark_entry__")
    assert "pipeline" in entry.queries() and "op9_quality_rules" in entry.oracle_sql()
