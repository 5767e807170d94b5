"""Prepares a training corpus from the documents table, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps, with the columns of the table; the last
one returns the pieces of each document instead of its text. ``run`` writes each stage's rows and reads them again, so
that a lost executor costs no earlier stage.

1. quality: the factorisation machine, fitted on the labels of the documents at hand; what it rejects goes.
2. exact copies: of texts that are equal but for white space, the longest stays.
3. near copies: of texts linked by five-word shingles at 0.8 or more, directly or through others, the one with the
   smallest id stays.
4. mix: sources by weight 5, 2, 1, repeating, as many words as there are; a document comes once for each time that it is
   taken, at most three times, in order of its finish time.
5. pieces: a sampled segmentation of every document, with a check that decoding gives the text back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.llm import fair_mix, fm_quality, fuse_dedup, piece_sampling, signature_join
from starloom.llm.common import table
from starloom.llm.queries import WEIGHTS, later_half
from starloom.workspace import Workspace


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return fm_quality.keep_good(docs, fm_quality.train(docs, table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return fuse_dedup.drop_copies(docs, Workspace(spark), later_half())


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return signature_join.keep_one(docs, Workspace(spark), words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return fair_mix.mixed(docs, Workspace(spark), WEIGHTS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    told = docs.withColumn("told", F.sha2("text", 256))
    coded = piece_sampling.encode(told, keep=["doc_id", "lang", "source", "n_chars", "told"])
    # Written in between, so that a task never holds workers of both steps.
    return piece_sampling.decode(Workspace(spark).save(coded, "coded")).select(
        "row.doc_id",
        "row.lang",
        "row.source",
        "row.n_chars",
        "pieces",
        F.size("pieces").cast("long").alias("n_pieces"),
        F.sha2("decoded", 256).eqNullSafe(F.col("row.told")).alias("lossless"),
    )


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", without_copies),
    ("n-gram Jaccard join", without_near_copies),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", pieces),
]

#: The classifier and the sampled pieces are no SQL; tests/llm holds the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = table(spark, sf_dir, "documents"), Workspace(spark)
    for number, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
