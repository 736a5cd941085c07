"""Registered queries of the operators, with production parameters and over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from ..sources.adapter import table
from . import alignment, binary, divergence, langid, licenses, mixing, ominhash, packing, quality, secrets, substring, topk, urls
from .words import n_words

URL_RULES: list[urls.Rule] = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(secrets.spans_text(F.col("base")), 256).alias("base_sha256"), secrets.spans_text(F.col("spans")).alias("spans"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs).select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", topk.to_integers(F.col("embedding")).alias("vector"))
    return topk.top_k(rows, F.col("vec_id") % 50 == 0)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeats(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), n_words(F.col("text")))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return binary.encode_and_read(spark, table(spark, sf_dir, "documents"), shared_dir(spark, "token-ids"), str(path))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.judge(docs, quality.references(docs))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ominhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    a, b = (str(public_tokenizers.path(f)) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    found = alignment.align(table(spark, sf_dir, "documents"), a, b, digest=True)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan(docs, licenses.rarity(docs))
    start = F.transform("places", lambda p: p["start"].cast("long"))
    return found.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(start).alias("first_word"), F.array_max(start).alias("last_word"),
                        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_secret_scan, op2_language_id, op3_top_k, op4_substring_dedup, op5_packing, op6_mixing,
                                    op7_url_filter, op8_token_ids, op9_quality, op10_near_duplicates, op11_source_divergence,
                                    op12_token_alignment, op13_license_scan, pipeline)}


def oracle_sql() -> dict[str, str]:
    from .oracles import ORACLES

    return dict(ORACLES)
