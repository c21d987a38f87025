"""Ranked lexical search: documents that are one bag of an item block's terms are scored once."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchloom.llm.common import small_batches, text_bytes
from matchloom.session import stage

TOP = 10
BLOCK_TERMS = 100_000  # terms of the items that are searched for in one pass, repeats within an item left out
CELLS = 4_000_000  # of one matrix of contributions
# Bytes below 0x80 that are no digit or letter part terms; A-Z are lowered.
_PARTED = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """The terms of a text: runs of digits, letters and all characters from U+0080 on."""
    return text.translate(_PARTED).split()


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item_id`` and ``terms`` (each once) of the different rows of ``items`` that have terms."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms(t.as_buffer().to_pybytes()))) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary()))], ["item_id", "terms"])

    rows = small_batches(items).select(F.col(id_col).cast("long").alias("item_id"), text_bytes(text_col).alias("text")).distinct()
    return rows.mapInArrow(split, "item_id long, terms array<binary>").filter(F.size("terms") > 0)


def bags(docs: DataFrame, vocabulary: list[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n`` (terms with repeats), and ``bag`` and ``tf``: which terms of the vocabulary a document holds, how often."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {term: i for i, term in enumerate(vocabulary)}
        for batch in batches:
            sizes, held, times = [], [], []
            for text in batch.column(1):
                words = terms(text.as_buffer().to_pybytes())
                counts = Counter(words)
                known = sorted((number[t], counts[t]) for t in number.keys() & counts.keys())
                sizes.append(len(words))
                held.append([t for t, _ in known])
                times.append([c for _, c in known])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(sizes, pa.int64()), pa.array(held, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64())),
            ], ["doc_id", "n", "bag", "tf"])

    rows = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    return rows.mapInArrow(count, "doc_id long, n long, bag array<int>, tf array<bigint>")


def _ragged(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of the lists, and the row each stands in."""
    sizes = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)


def _score(items: list[np.ndarray], weight: np.ndarray, top: int):
    """Score every class against every item; a task gives the best classes of each item it has seen.

    Within a batch the contributions are a matrix with a row per term, so an item's scores are the sum of its rows. An item keeps
    ``top`` classes by score and smallest document: no document of another class can be among its best ``top``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros((0, 3), dtype=np.int64)
        best = [none] * len(items)  # score, first document, class
        used = np.unique(np.concatenate(items))
        place = np.full(len(weight), -1)
        place[used] = np.arange(len(used))
        rows = [place[x] for x in items]
        for whole in batches:
            step = max(1, CELLS // len(used))
            for begin in range(0, whole.num_rows, step):
                batch = whole.slice(begin, step)
                m = batch.column("m").to_numpy()
                bag, row = _ragged(batch.column("bag"))
                tf, _ = _ragged(batch.column("tf"))
                given = np.zeros((len(used), batch.num_rows), dtype=np.int64)
                given[place[bag], row] = weight[bag] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
                label = np.stack([batch.column("first").fill_null(np.iinfo(np.int64).max).to_numpy(), batch.column("class").to_numpy()], 1)
                for i, mine in enumerate(rows):
                    score = given[mine].sum(axis=0)
                    least = max(1, int(best[i][-1, 0])) if len(best[i]) == top else 1
                    at = np.flatnonzero(score >= least)
                    if len(at) > top:  # all that reach the score of the last place, ties included
                        at = at[score[at] >= np.partition(score[at], -top)[-top]]
                    if len(at):
                        found = np.concatenate([best[i], np.concatenate([score[at, None], label[at]], axis=1)])
                        best[i] = found[np.lexsort((found[:, 1], -found[:, 0]))[:top]]
        number = np.repeat(np.arange(len(items), dtype=np.int32), [len(x) for x in best])
        every = np.concatenate(best)
        if len(every):
            yield pa.RecordBatch.from_arrays(
                [pa.array(number), *(pa.array(every[:, c].copy()) for c in range(3))], ["item", "score", "first", "class"]
            )

    return run


def _first(df: DataFrame, by: str, order: list[Column], most: int, name: str) -> DataFrame:
    """The first rows of each key; Spark keeps no more of them before the shuffle either."""
    return df.withColumn(name, F.row_number().over(W.partitionBy(by).orderBy(*order))).filter(F.col(name) <= most)


def _search_block(docs: DataFrame, block: list[tuple[int, list[bytes]]], top: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = sorted({t for _, held in block for t in held})
    number = {t: i for i, t in enumerate(vocabulary)}
    held = stage(bags(docs, vocabulary, id_col, text_col), "bags")
    total = held.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).head()
    n_docs, n_terms = total.documents, max(1, total.terms)

    df = np.zeros(len(vocabulary), dtype=np.int64)
    for row in held.select(F.explode("bag").alias("term")).groupBy("term").count().collect():  # one row per term of the block
        df[row.term] = row["count"]
    weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)

    # Bags are grouped by their hash and by all they consist of, so that only equal ones are one class.
    m = F.expr(f"100 - 90 + ((90 * n * {n_docs}L) div {n_terms}L)")
    held = held.filter(F.size("bag") > 0).withColumn("m", m)
    held = held.withColumn("hash", F.xxhash64("bag", "tf", "m"))
    equal = ["hash", "m", "bag", "tf"]
    classes = held.groupBy(*equal).agg(F.min("doc_id").alias("first"))
    classes = stage(classes.withColumn("class", F.monotonically_increasing_id()), "bag-classes")

    items = [np.array([number[t] for t in held_terms]) for _, held_terms in block]
    scored = classes.select("m", "bag", "tf", "first", "class").mapInArrow(
        _score(items, weight, top), "item int, score long, first long, class long"
    )
    order = [F.desc("score"), F.asc("first"), F.asc("class")]
    best = stage(_first(scored, "item", order, top, "place").select("item", "score", "class"), "bag-scores")
    # At most `top` classes an item; each gives its first `top` documents.
    chosen = classes.join(best.select("class").distinct(), "class").select("class", *equal)
    members = held.select("doc_id", *equal).join(chosen, equal).select("class", "doc_id")
    members = _first(members, "class", [F.asc_nulls_last("doc_id")], top, "nth").drop("nth")
    ranked = _first(best.join(members, "class"), "item", [F.desc("score"), F.asc_nulls_last("doc_id")], top, "rank")
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], "item int, item_id long")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS, id_col: str = "doc_id",
           text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` of the ``top`` best documents of each item.

    Terms are runs of letters, digits and characters from U+0080 on, A-Z lowered. A term's weight is
    floor(1000 ln((2N + 2) / (2 df + 1))), a document's m is 10 + (90 n N) div L, and it scores the sum of
    w ((10^9 tf) div (1000 tf + 8 m)) over an item's different terms; N documents have terms, L in all, n of them in the document. Only
    scores above 0 count; equal scores go by ascending doc_id.

    Items are dealt into blocks of about ``block_terms`` terms by a hash. For each block a pass over the documents keeps
    their bags of the block's vocabulary, which alone is sent to the tasks (with one row per term and item to the driver). Documents with
    the same bag and m are one class, scored once; the best classes give their first documents.

    NULL and empty texts have no terms: such items give no row, such documents are never found. A repeated row of ``items``
    counts once; different texts under one item id are items of their own. A repeated row of ``docs`` is a document of its own;
    one without an id comes after all others of its score. Without documents or items the result is empty. Other
    columns are ignored.
    """
    spark = docs.sparkSession
    split = stage(_item_terms(items, item_id_col, item_text_col), "item-terms")
    size = split.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).head()[0]
    blocks = max(1, -(-size // block_terms))
    dealt = split.withColumn("block", F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)))
    result = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for b in range(blocks):
        block = [(r.item_id, [bytes(t) for t in r.terms]) for r in dealt.filter(F.col("block") == b).collect()]
        if block:
            result = result.unionByName(_search_block(docs, block, top, id_col, text_col))
    return result
