"""The registered query of each operator: it applies the operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.llm import (
    arc_convert,
    chat_hmm,
    edit_embedding,
    fair_mix,
    fm_quality,
    fuse_dedup,
    importance_resample,
    piece_sampling,
    pivot_topk,
    residue_negatives,
    secret_index,
    signature_join,
    token_attribution,
)
from starloom.llm.common import table
from starloom.workspace import Workspace

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)


def later_half(id_col: str = "doc_id"):
    """Half of the rows, by a digest of the id, come as a new batch to a snapshot of the others."""
    return F.expr(f"pmod(xxhash64({id_col}), 2) = 1")


def op1_chat_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as transcripts that lack a quarter of their markers, parsed and rendered.

    Roles are learned where crc32(conv_id) mod 3 is not 1.
    """
    scratch = Workspace(spark)
    turns = chat_hmm.as_transcript(table(spark, sf_dir, "conversations"))
    found = scratch.save(chat_hmm.segments(turns, "conv_id", "turn", "text", "role"), "segments")
    learned = found.where(~fm_quality.is_held_out("id"))
    parsed = chat_hmm.parse(found, chat_hmm.train(learned), scratch)
    return parsed.select(
        F.col("id").alias("conv_id"),
        F.col("pos").alias("turn"),
        fm_quality.is_held_out("id").alias("held_out"),
        F.get("roles", 0).alias("role"),
        F.get("begins", 0).alias("begins"),
        F.size("roles").cast("long").alias("n_lines"),
        "rendered",
    )


def op2_arc_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as ARC volumes of both versions, converted to WARC and read back."""
    scratch = Workspace(spark)
    arc, warc = f"{scratch.root}/arc", f"{scratch.root}/warc"
    pages = table(spark, sf_dir, "pages")
    arc_convert.write_arc(pages, arc, id_col="page_id", url_col="url", text_col="html", date="20000101000000")
    arc_convert.convert(spark, arc, warc, scratch, least=0)
    return arc_convert.read_warc(spark, warc, scratch).select(
        F.col("number").alias("page_id"),
        F.col("size").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op3_signature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three words and 90 of 100, as this query's contract has them."""
    rows = signature_join.components(table(spark, sf_dir, "documents"), Workspace(spark), words=3, percent=90)
    return rows.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


def op4_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return pivot_topk.top_k(vectors, Workspace(spark), F.col("vec_id") % 100 == 0, 10)


def op5_fm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fm_quality.train(docs, table(spark, sf_dir, "labels"))
    scored = fm_quality.score(docs, model)
    return scored.select(F.col("id").alias("doc_id"), fm_quality.is_held_out("id").alias("held_out"), "score", "predicted")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = fuse_dedup.exact_groups(docs, Workspace(spark), later_half())
    return rows.select(
        F.col("id").alias("doc_id"),
        F.col("keep.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op7_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each field, and of each paragraph of the text."""
    docs = table(spark, sf_dir, "documents")
    counts = token_attribution.section_tokens(docs, ["source", "lang", "text"], sectioned=["text"])
    return counts.withColumnRenamed("id", "doc_id")


def op8_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = fair_mix.fair_mix(table(spark, sf_dir, "documents"), Workspace(spark), WEIGHTS)
    return mix.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op9_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text cut into sampled pieces, and whether decoding them gives it back."""
    docs = table(spark, sf_dir, "documents").withColumn("told", F.sha2("text", 256))
    # Written in between, so that a task never holds workers of both steps.
    coded = Workspace(spark).save(piece_sampling.encode(docs, keep=["doc_id", "told"]), "coded")
    return piece_sampling.decode(coded).select(
        "row.doc_id",
        "pieces",
        F.size("pieces").cast("long").alias("n_pieces"),
        F.sha2("decoded", 256).eqNullSafe(F.col("row.told")).alias("lossless"),
    )


def op10_secret_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_index.find_secrets(table(spark, sf_dir, "documents"), Workspace(spark))
    spans = secret_index.as_text(F.col("found"))
    counts = [
        F.expr(f"cast(size(filter(found, x -> x.kind = {n})) AS bigint) AS n_{rule.kind}")
        for n, rule in enumerate(secret_index.RULES)
    ]
    return found.select(
        F.col("id").alias("doc_id"),
        *counts,
        F.sha2(spans, 256).alias("base_sha256"),
        spans.alias("spans"),
    )


def op11_residue_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are every hundredth id; every seventh id's label is the next one."""
    next_label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", next_label)
    return residue_negatives.hard_negatives(vectors, Workspace(spark), F.col("vec_id") % 100 == 0)


def op12_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents with 20 words or more, drawn towards the benchmark's words and word pairs."""
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    drawn = importance_resample.resample(docs, target, Workspace(spark))
    return drawn.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def op13_edit_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and near_id, the smallest id of a text found to be like it."""
    scratch = Workspace(spark)
    prints = edit_embedding.edited_fingerprints(table(spark, sf_dir, "documents"), scratch)
    return edit_embedding.near_documents(prints, scratch).withColumnRenamed("id", "doc_id")


QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_hmm,
        op2_arc_convert,
        op3_signature_join,
        op4_pivot_topk,
        op5_fm_quality,
        op6_exact_dedup,
        op7_token_attribution,
        op8_fair_mix,
        op9_piece_sampling,
        op10_secret_index,
        op11_residue_negatives,
        op12_importance_resample,
        op13_edit_embedding,
    )
}
