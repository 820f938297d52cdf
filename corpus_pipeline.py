"""The corpus pipeline: raw documents to token ids, one Parquet table per stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferryline.llm.bpe import bpe_encode
from ferryline.llm.decontaminate import remove_contaminated
from ferryline.llm.jaccard import keep_one_of_each
from ferryline.llm.lines import remove_repeated_lines
from ferryline.llm.shared import stage, table
from ferryline.llm.toxicity import held_out, remove_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the learnable labels, does not reject.
    Null and empty texts score as the model's base rate and stay unless that is
    rejected; whole texts of any length are scored; repeated rows fare alike. Without
    labels of both kinds nothing is rejected."""
    return remove_toxic(docs, table(spark, sf_dir, "labels"), ~held_out())


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line equals within one edit, or,
    under 20 characters, exactly. Null and empty texts stay as they are; a document
    whose last line with a word goes is dropped; rows that repeat id and text count
    as one document and all stay; texts of any length are compared whole."""
    return remove_repeated_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of similar texts, the one with the smallest id.
    Equal texts are similar, empty ones and null, which counts as empty, too; other
    texts without a word are similar to none. Rows that repeat an id stay together."""
    return keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too little of any benchmark item to be contaminated.
    Texts without a word are clean, null ones too; without items all documents are."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the decoded text.
    Null is the empty text, which has no ids; repeated rows each get their row."""
    found = bpe_encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"), "ids")


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines),
          ("jaccard_join", drop_near_copies), ("decontamination", drop_contaminated),
          ("bpe", encode)]

#: A trained classifier is not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over all that the stage before it kept."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
