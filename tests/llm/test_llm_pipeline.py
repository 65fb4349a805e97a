"""The registered queries and the pipeline."""

from __future__ import annotations

import re

import corpus_pipeline
import llm_brute as brute
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from riskloom.llm import queries


def test_every_operator_has_one_query():
    numbers = [int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(__spark_entry__.queries())


def contract(name):
    return {
        1: "doc_id held_out n_tokens n_known train_tokens base_score score",
        2: "doc_id n_email n_ip n_card n_phone base_sha256 spans",
        3: "doc_id n_words n_hit n_items items_sha256 contaminated",
        4: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        5: "doc_id piece start length ids_crc32 sequence_id offset",
        6: "page_id record_type record_id refers_to",
        7: "doc_id held_out lang_pred score",
        8: "doc_id n_bytes n_removed n_spans kept_sha256",
        9: "doc_id fingerprint component_id",
        10: "page_id host path rule verdict",
        11: "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
        12: "query_id rank vec_id score",
        13: "anchor_id positive_id rank negative_id positive_score negative_score",
    }[int(re.match(r"op(\d+)_", name)[1])].split()


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_queries_return_every_row(spark, tables, name):
    df = queries.QUERIES[name](spark, tables)
    wanted = contract(name)
    assert df.columns[: len(wanted)] == wanted
    if wanted[0] in ("query_id", "anchor_id"):  # searches, compared with SQL
        return
    of = "pages" if wanted[0] == "page_id" else "documents"
    key = wanted[0]
    ids = spark.read.parquet(f"{tables}/{of}.parquet").select(F.col(of[:-1].replace("document", "doc") + "_id").alias(key))
    assert df.select(key).distinct().exceptAll(ids.distinct()).isEmpty()
    assert ids.exceptAll(df.select(key).distinct()).isEmpty()


def test_pipeline_stages(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    columns = docs.columns
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, tables).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    texts = {r["doc_id"]: r["text"] for r in rows}
    assert kept["language_id"] >= {i for i, t in texts.items() if len(t or "") > 100}
    found = sorted(kept["language_id"])
    roots = brute.components([brute.simhash(texts[i]) for i in found], 2)
    assert kept["simhash_near_dedup"] == {i for i, r in zip(found, roots) if found[r] == i}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    left = sorted(kept["simhash_near_dedup"])
    clean = {i for i, (_, hit, _) in zip(left, brute.contamination([(i, texts[i]) for i in left], items)) if not hit}
    assert kept["decontamination"] == kept["pii"] == kept["packing"] == clean
    redacted = {r["doc_id"]: r for r in spark.read.parquet(f"{tmp_path}/3").collect()}
    assert all(brute.pii_base(r["text"]) == [] and r["n_chars"] == len(r["text"]) for r in redacted.values())


def test_pipeline_of_awkward_documents(spark, edge, tables, tmp_path):
    rows, _ = edge
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for given in (docs, docs.limit(0)):
        part = given
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            path = f"{tmp_path}/{given is docs}-{k}"
            stage(spark, part, tables).write.parquet(path)
            part = spark.read.parquet(path)
        assert (part.count() > 0) == (given is docs)


def test_run_equals_the_stages(spark, tables):
    docs = corpus_pipeline.run(spark, tables)
    assert docs.columns[:2] == ["doc_id", "piece"] and docs.count() > 0
