"""The ``opN_*`` queries: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from featurejudge.llm import (collocations, decontamination, extraction, language, mixing, quality_classifier, quality_rules, simhash,
                             tokens, toxicity, url_filter, warc, whitening)
from featurejudge.llm.common import held_out, load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(load(spark, sf_dir, "pages", "page_id", "url", "html"))


@query
def op4_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.main_text(load(spark, sf_dir, "pages", "page_id", "url", "html"))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(load(spark, sf_dir, "documents", "doc_id", "source", "text"))


@query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(load(spark, sf_dir, "pages", "page_id", "url"))


@query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    out = held_out(F.col("doc_id"), 4, 2)
    return (quality_classifier.score(docs, load(spark, sf_dir, "labels", "doc_id", "quality"), ~out)
            .select("doc_id", out.alias("held_out"), "score", "predicted"))


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(load(spark, sf_dir, "documents", "doc_id", "text"),
                                 load(spark, sf_dir, "benchmark", "item_id", "text"))


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", "doc_id", "text", "lang")
    out = held_out(F.col("doc_id"), 5, 0)
    return (language.identify(docs, ~out)
            .select("doc_id", out.alias("held_out"), "lang_pred", "score", "ambiguous"))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    out = held_out(F.col("doc_id"), 3, 1)
    return (toxicity.score(docs, load(spark, sf_dir, "labels", "doc_id", "toxic"), ~out)
            .select("doc_id", out.alias("held_out"), "score", "predicted"))


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(load(spark, sf_dir, "documents", "doc_id", "text", "source"))


@query
def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokens.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    return (tokens.encode(load(spark, sf_dir, "documents", "doc_id", "text"), model)
            .select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                    F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                    F.sha2(tokens.decode(F.col("ids"), model), 256).alias("decoded_sha256")))


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(load(spark, sf_dir, "embeddings", "vec_id", "embedding"))


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.phrases(load(spark, sf_dir, "documents", "text", "lang"))


ORACLE.update(op13_collocations=collocations.ORACLE)
ORACLE.update(op1_warc=warc.ORACLE, op7_quality_rules=quality_rules.ORACLE)
