"""The corpus operators as registered queries over the test tables."""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm import (
    align, arrow_ids, bpe, embeddings, fingerprints, lines, packing, quality, search, simhash, suffix, toxicity, warc,
)
from matchloom.llm.common import table
from matchloom.llm.queries_sql import ORACLES


def tokenizer_file(name: str) -> str:
    """A vocabulary file, from the folder in $MATCHLOOM_TOKENIZERS or the installed package."""
    folder = os.environ.get("MATCHLOOM_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digest_removed(suffix.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text")))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "n_chars")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    machine = quality.fit(docs, labels.filter(~quality.in_fold("doc_id", 5, 0)))
    return quality.score(docs, machine).select(
        "doc_id", quality.in_fold("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    model = toxicity.fit(docs, labels.filter(~quality.in_fold("doc_id", 3, 1)))
    return toxicity.score(docs, model).select(
        "doc_id", quality.in_fold("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    def digest(ids, decoded: bytes) -> tuple:
        decimal = b" ".join(map(_decimal.__getitem__, ids.tolist()))
        return len(ids), hashlib.sha256(decimal).hexdigest(), hashlib.sha256(decoded).hexdigest()

    _decimal = [str(i).encode() for i in range(1 << 16)]
    return bpe.encode_documents(
        table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
        finish=digest, schema="doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )


def op9_arrow_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrow_ids.round_trip(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_file("word_bpe_49k.json"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return align.align(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return search.search(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_lines(table(spark, sf_dir, "documents", "doc_id", "text"), digest=True)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_embedding_near_dedup, op2_fingerprints, op3_suffix_dedup, op4_simhash_near_dedup, op5_quality, op6_toxicity,
        op7_packing, op8_byte_bpe, op9_arrow_ids, op10_warc, op11_alignment, op12_lexical_search, op13_line_dedup, pipeline,
    )
}

__all__ = ["ORACLES", "QUERIES"]
