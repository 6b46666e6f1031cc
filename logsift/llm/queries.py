"""The registered queries of the training-data operators: thin wrappers that
apply an operator with its production parameters to whole tables and derive
the result columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsift.llm import (bpe, decontaminate, jaccard_join, langid, licences, packing, quality_model, quality_rules, spelling, style_tree,
                         substring_dedup, toxicity, whitening)
from logsift.llm.common import fold, table
from logsift.llm.oracle import ORACLE_SQL  # noqa: F401  (the queries' SQL, for the entry module)

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}


def query(fn: Builder) -> Builder:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style_tree.extract(table(spark, sf_dir, "pages"))


@query
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), decontaminate.contaminated().alias("contaminated"))


@query
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licences.scan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.size("sentence_ids").cast("long").alias("n_recognised"), F.array_join("licences", ",").alias("licences"), "n_unmatched")


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return toxicity.score(docs, model).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.transform("offending", lambda s: s["index"]).alias("offending_sentences"))


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return quality_model.score(docs, model).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer())


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = langid.train(docs, fold("doc_id", 3) != 1)
    return langid.predict(docs, profiles).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@query
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN), ranks)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(table(spark, sf_dir, "documents"))


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
