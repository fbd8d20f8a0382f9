"""Queries of the training-data operators: thin functions that derive the
contract's columns from what the operators return."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_codec, cap_filters, common, language_id, license_scan, line_dedup, packing, pii, quality_classifier, quality_rules, simhash

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("word_bpe_49k.json")


def _remainder(n: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.train(docs, labels, "quality", _remainder(5) != 0)
    return quality_classifier.score(docs, model).select("doc_id", F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(common.documents(spark, sf_dir), near=True, short=True).select("doc_id", "n_lines", "n_dropped", "text")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.encode_documents(common.documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN, ids=False, digests=True)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.encode_pieces(common.documents(spark, sf_dir), PIECES)
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack_pieces(digests)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(common.documents(spark, sf_dir))
    labels = F.transform("bases", lambda b: b["label"])
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["label"], s["first"].cast("string"), s["last"].cast("string"))), ",")
    share = F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0))
    return found.select(
        "doc_id", "n_words", F.size("bases").cast("long").alias("n_base"), F.array_min(F.transform("bases", lambda b: b["word"])).alias("first_word"),
        F.array_max(F.transform("bases", lambda b: b["word"])).alias("last_word"), joined(labels).alias("base_labels"),
        joined(F.concat(labels, F.transform("spans", lambda s: s["label"]))).alias("labels"), F.when(F.size("bases") > 0, 1.0).otherwise(share).alias("score"), spans.alias("spans"),
    )


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(common.documents(spark, sf_dir))
    names = F.array(*map(F.lit, pii.KINDS))
    joined = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = {k})) as long)").alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op7_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score_rules(common.documents(spark, sf_dir))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    model = language_id.train(docs, _remainder(3) != 1)
    return language_id.predict(docs, model).select("doc_id", F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(common.documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_line_dedup, op3_byte_bpe, op4_best_fit_packing, op5_license_scan,
        op6_pii, op7_cap_filters, op8_quality_rules, op9_language_id, op10_simhash, pipeline,
    )
}

ORACLE_SQL: dict[str, str] = {}
