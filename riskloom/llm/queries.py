"""The operators on the driver's tables, whole. Each query takes (spark, folder of the tables)."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import riskloom
from riskloom.llm import (
    decontaminate,
    hard_negatives,
    language_id,
    ngram_trie,
    packing,
    pii_crf,
    pivot_index,
    quality_rules,
    simhash,
    suffix_dedup,
    token_alignment,
    url_filter,
    warc,
)

URL_RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def ship(spark: SparkSession) -> SparkSession:
    """Sends the package to the executors, once for each application."""
    context = spark.sparkContext
    if not getattr(context, "_riskloom_shipped", False):
        root = os.path.dirname(os.path.abspath(riskloom.__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="riskloom-"), "riskloom.zip")
        with zipfile.ZipFile(path, "w") as archive:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        archive.write(full, os.path.relpath(full, os.path.dirname(root)))
        context.addPyFile(path)
        context._riskloom_shipped = True
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def remainder_of_id(doc_id: str = "doc_id"):
    """crc32 of the ID as text, modulo 5; of a row without ID that of the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(5))


def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    scored = ngram_trie.score(table(spark, folder, "documents"), remainder_of_id() != 1)
    return scored.withColumn("trained", ~F.col("trained")).withColumnRenamed("trained", "held_out")


def op2_pii_crf(spark: SparkSession, folder: str) -> DataFrame:
    return pii_crf.find(table(spark, folder, "documents"), pii_crf.fitted())


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(table(spark, folder, "documents"))


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_path())


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Both derivatives of each page, with the digest of each record as text."""
    made = warc.derivatives(warc.responses(table(spark, folder, "pages")))
    return made.select(
        F.col("id").alias("page_id"), "record_type", "record_id", "refers_to", "target_uri", "date",
        "payload_digest", "block_digest", "content_length", F.sha2("record", 256).alias("record_sha256"),
    )


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    remainder = remainder_of_id()
    models = language_id.fit(docs, remainder != 0)
    judged = language_id.predict(docs.select("doc_id", "text"), models)
    return judged.select(
        "doc_id",
        (remainder == 0).alias("held_out"),
        F.col("language.name").alias("lang_pred"),
        F.col("language.score").alias("score"),
        F.col("language.rejected").alias("rejected"),
    )


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, folder, "documents"))


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """A page is made of a document, whose number stands in the URL's path; the labels of that
    document, low quality or toxic, are the URL's."""
    pages = table(spark, folder, "pages")
    labels = table(spark, folder, "labels")
    _, path = url_filter.host_and_path(F.col("url"))
    number = F.regexp_extract(path, "^/[^/]+/([0-9]{1,18})", 1)
    numbered = pages.select("url", number.try_cast("long").alias("doc_id"))
    blocked = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labelled = numbered.join(labels.select("doc_id", blocked.alias("blocked")), "doc_id")
    return url_filter.judge(pages, labelled.where("blocked is not null"), URL_RULES)


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return token_alignment.align(docs, tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


def op12_pivot_topk(spark: SparkSession, folder: str) -> DataFrame:
    return pivot_index.top_k(table(spark, folder, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0)


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """The label of every seventh row is first moved to the next class."""
    moved = F.when(F.pmod("vec_id", F.lit(7)) == 0, (F.col("label").cast("long") + 1) % 10)
    label = F.when(F.col("label").isNotNull(), F.coalesce(moved, F.col("label").cast("long")))
    return hard_negatives.mine(table(spark, folder, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0, label)


QUERIES: dict[str, Query] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_pii_crf": op2_pii_crf,
    "op3_decontaminate": op3_decontaminate,
    "op4_quality_rules": op4_quality_rules,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_warc": op6_warc,
    "op7_language_id": op7_language_id,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_simhash": op9_simhash,
    "op10_url_filter": op10_url_filter,
    "op11_token_alignment": op11_token_alignment,
    "op12_pivot_topk": op12_pivot_topk,
    "op13_hard_negatives": op13_hard_negatives,
}
