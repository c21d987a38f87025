"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm import packing, quality, simhash, suffix, toxicity
from matchloom.llm.common import table
from matchloom.llm.queries import tokenizer_file
from matchloom.session import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
QUALITY_LEAST = 0.3
TOXIC_MOST = 0.7
SIMILAR = 0.8  # Jaccard similarity of the five-word shingles
NAMES = 1 << 62  # names of rows without an id start here
REPEAT_BYTES = 200  # about fifty short words


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.3 go. One document in five is held out of the learning.

    NULL and empty texts are scored by their statistics like any other text, whole texts of any length are read, repeated
    rows and rows without an id are judged each. Without labels of both kinds nothing goes; without documents nothing comes.
    """
    labels = table(spark, sf_dir, "labels", "doc_id", "quality").filter(~quality.in_fold("doc_id", 5, 0))
    machine = quality.fit(docs, labels)
    return quality.score(docs, machine, keep=COLUMNS).filter(F.col("score") >= QUALITY_LEAST).select(*COLUMNS)


def toxicity_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.7 or more go. One document in three is held out of the learning.

    NULL and empty texts have the score of a text without known features and stay. All words of a text of any length
    count, repeated rows and rows without an id are judged each. Without toxic labels nothing goes.
    """
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic").filter(~quality.in_fold("doc_id", 3, 1))
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs, model, keep=COLUMNS).filter(F.col("score") < TOXIC_MOST).select(*COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the document with the smallest id stays; documents without words are one component.

    Copies that share 0.8 of their five-word shingles differ in 7 to 10 of 64 bits, and up to a third of such pairs lacks two equal
    bytes. So candidates have two shared bytes and at most 16 different bits, or share a band of minimum hashes; whole shingle
    sets decide.
    """
    # Rows without an id are named by their text, above all ids, so that their copies meet and a document with an id stays.
    by_text = F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(NAMES - 1).bitwiseOR(NAMES)
    docs = docs.select(*COLUMNS, F.coalesce(F.col("doc_id").cast("long"), by_text).alias("name"))
    found = simhash.near_duplicates(docs, "name", most=16, alike=2, similar=SIMILAR)
    kept = found.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("name")).distinct()
    # A row repeated with its id is a copy like any other.
    rows = docs.join(kept, "name", "left_semi").withColumn("known", F.coalesce("text", F.lit("")))
    return rows.dropDuplicates(["name", "known"]).select(*COLUMNS)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that occur twice go, at every place; a character cut in half goes whole.

    NULL texts come back empty; every row stays, if with an empty text. Repeated rows are copies of each other. Texts of any
    length are read whole.
    """
    removed = suffix.remove_repeats(docs, REPEAT_BYTES, keep=["lang", "source"], as_text=True)
    return removed.select(
        "doc_id", F.col("kept").alias("text"), "lang", "source", F.char_length("kept").cast("long").alias("n_chars")
    )


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens of what is left.

    One row per piece; NULL and empty texts are the end token alone, repeated rows are packed each, long texts are cut.
    """
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("toxicity", toxicity_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("suffix-array dedup", suffix_dedup),
    ("best-fit packing", best_fit_packing),
]
# No SQL: classifiers are trained, tokens are a library's, and repeats need suffixes. Tests hold
# near copies and repeats against brute force, and the other stages on planted rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents", *COLUMNS)
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), "corpus")
    return docs
