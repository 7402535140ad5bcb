"""Corpus pipeline: language ID, toxicity, near duplicates, benchmark
decontamination, mixing.  Each stage reads the table that the one before wrote.

All stages read whole texts of any length.  A null text is an empty one, an
empty table gives an empty one, repeated rows are judged alike, and columns
beside ``doc_id``, ``text``, ``lang`` and ``source`` pass unread under any name
(the last stage returns columns of its own).  Nothing depends on the order of
rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurejudge.llm import decontamination, language, mixing, simhash, toxicity
from featurejudge.llm.common import cut_lineage, labelled_rows, load

TOXIC = 0.7


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go: null, empty and letterless
    texts, and those whose two best codewords are too close.  Rows without a
    language or an id are judged like any other (and not learned from without
    a language); of equally close codewords the first language counts."""
    model = language.fit(docs)
    pred = language.predict_column(spark, model)(F.col("text"))
    return docs.where((pred["lang"] != language.UNKNOWN) & ~pred["ambiguous"])


def toxic_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score ``TOXIC`` or more go.  Null and empty texts score 0
    and stay; rows without an id are judged like any other and not learned
    from; a score of just ``TOXIC`` goes."""
    labels = load(spark, sf_dir, "labels", "doc_id", "toxic")
    model = toxicity.fit(docs, labelled_rows(docs, labels, "toxic"))
    return docs.where(toxicity.score_column(spark, model)(F.col("text")) < TOXIC)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays
    (rows without an id stay; of rows that repeat an id, one).  Null, empty and
    wordless texts are near duplicates of each other."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item is found go.  Null and empty texts
    hold none and stay, as do rows without an id; items without an id or text,
    and those of a few characters, are not looked for."""
    return decontamination.decontaminate(docs, load(spark, sf_dir, "benchmark", "item_id", "text"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each use of a document in the mixture.  A null source is a
    source of its own; null and empty texts have no token and come with whole
    passes; rows without an id are dealt like any other; ties are told apart
    by id, then by row."""
    return mixing.mix(docs)


STAGES = [("language_id", language_id), ("toxicity", toxic_filter), ("simhash_dedup", simhash_dedup),
          ("decontamination", decontaminate), ("mixing", mix)]

#: Models and hash trees are not SQL: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply ``STAGES`` to documents; every stage's result is written and read again."""
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
