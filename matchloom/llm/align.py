"""Cross-tokenizer alignment: the tokens of two tokenizers meet where both end at one byte; all documents advance together."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import small_batches
from matchloom.llm.tokens import byte_characters, text_encoder
from matchloom.session import stage

BATCH_BYTES = 8_000_000  # of the texts that advance together
HOT_PAIRS = 1 << 20  # id pairs whose counts are broadcast at once


class Tokens:
    """Tokens of several texts, end to end: ``ids``, and ``ends`` (the byte of its text where each token ends).

    ``first`` has the place of each text's first token, and one place more. Texts whose tokens do not give back ``wanted`` have none.
    """

    def __init__(self, ids: list[np.ndarray], spelled: list[bytes], size: np.ndarray, wanted: list[bytes]):
        right = [b"".join(map(spelled.__getitem__, x.tolist())) == w for x, w in zip(ids, wanted)]
        self.right = np.array(right, dtype=bool)
        self.parts, self.size = ids, size

    def join(self, chosen: np.ndarray) -> Tokens:
        """Lay the texts that are ``chosen`` end to end."""
        parts = [x if keep else x[:0] for x, keep in zip(self.parts, chosen)]
        self.first = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
        self.ids = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
        running = np.concatenate([[0], np.cumsum(self.size[self.ids])])
        text = np.repeat(np.arange(len(parts)), np.diff(self.first))
        self.ends = running[1:] - running[self.first[:-1]][text]
        return self


@dataclass(frozen=True)
class Tokenizers:
    """Tokenizer A (byte-level, of the tokenizers library) and B (of the sentencepiece library, which puts a space before a text)."""

    a_path: str
    b_path: str

    def encode(self, texts: list[str]) -> tuple[Tokens, Tokens]:
        spaced = [" " + t for t in texts]
        wanted = [t.encode() for t in spaced]
        encoder, a_spelled, a_size = _byte_level(self.a_path)
        pieces, b_spelled, b_size = _pieces(self.b_path)
        a = [np.frombuffer(x, "<u4").astype(np.int64) for x in encoder.ids(spaced)]
        b = [np.array(x, dtype=np.int64) for x in pieces.encode(texts, num_threads=1)]
        a, b = Tokens(a, a_spelled, a_size, wanted), Tokens(b, b_spelled, b_size, wanted)
        both = a.right & b.right & np.array([bool(t) for t in texts], dtype=bool)
        return a.join(both), b.join(both)


def _sizes(spelled: list[bytes]) -> np.ndarray:
    return np.array([len(x) for x in spelled], dtype=np.int64)


@lru_cache(maxsize=2)
def _byte_level(path: str):
    """Encoder, bytes of each id, and their number; one per file and Python worker."""
    encoder = text_encoder(path, keep_space=True, plain=True)
    byte = {c: b for b, c in byte_characters().items()}
    vocabulary = encoder.pieces.encode.tokenizer.get_vocab(with_added_tokens=True)
    spelled = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        spelled[i] = bytes(map(byte.__getitem__, token)) if all(c in byte for c in token) else token.encode()
    return encoder, spelled, _sizes(spelled)


@lru_cache(maxsize=2)
def _pieces(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    spelled = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        spelled.append(bytes([int(piece[1:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return model, spelled, _sizes(spelled)


def lockstep(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of A and of B end a group, as one flag per token.

    The state has a pointer into A and one into B for every text under way. In each step all texts compare the ends under
    their pointers; the token that ends first is passed, and where both end together the two are linked, the texts
    cut behind them and both passed. Texts that are through are taken out of the state.
    """
    cut_a, cut_b = np.zeros(len(a.ids), dtype=bool), np.zeros(len(b.ids), dtype=bool)
    live = np.flatnonzero(np.diff(a.first))
    i, j, stop = a.first[:-1][live], b.first[:-1][live], a.first[1:][live]
    while len(i):
        end_a, end_b = a.ends[i], b.ends[j]
        linked = end_a == end_b
        cut_a[i[linked]] = True
        cut_b[j[linked]] = True
        i = i + (end_a <= end_b)
        j = j + (end_b <= end_a)
        on = i < stop  # the last tokens of a text end together, so B is through as well
        if not on.all():
            i, j, stop = i[on], j[on], stop[on]
    return cut_a, cut_b


@dataclass
class Alignment:
    """Groups and links of some texts. The last tokens of a group are the pair that ends together, so groups are links."""

    a: Tokens
    b: Tokens

    def __post_init__(self):
        cut_a, cut_b = lockstep(self.a, self.b)
        self.cut_a, self.cut_b = cut_a, cut_b
        self.link_a, self.link_b = np.flatnonzero(cut_a), np.flatnonzero(cut_b)  # places of the linked tokens
        self.first = np.searchsorted(self.link_a, self.a.first)  # of each text's links

    def groups(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each text: decimal ids of A, then of B, by group."""
        a, b = self.a, self.b
        group_a, group_b = np.cumsum(self.cut_a) - self.cut_a, np.cumsum(self.cut_b) - self.cut_b
        before_b = np.concatenate([[0], self.link_b + 1])[group_a]  # tokens of B in earlier groups
        upto_a = (self.link_a + 1)[group_b]
        width = int(max(a.ids.max(initial=0), b.ids.max(initial=0))) + 1
        keys = np.empty(len(a.ids) + len(b.ids), dtype=np.int64)
        keys[np.arange(len(a.ids)) + before_b] = a.ids + width * self.cut_a
        keys[np.arange(len(b.ids)) + upto_a] = b.ids + 2 * width * self.cut_b
        written = _written(width)
        places = a.first + b.first
        return [
            b"".join(map(written.__getitem__, keys[x:y].tolist()))[:-1] for x, y in zip(places[:-1].tolist(), places[1:].tolist())
        ]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Linked id pairs of the texts, each once a text with how often it is linked; and each text's first pair."""
        text = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        width = int(self.b.ids.max(initial=0)) + 1
        span = width * (int(self.a.ids.max(initial=0)) + 1)
        found, times = np.unique(
            text * span + self.a.ids[self.link_a] * width + self.b.ids[self.link_b], return_counts=True
        )
        text, pair = found // span, found % span
        return pair // width << 32 | pair % width, times, np.searchsorted(text, np.arange(len(self.first)))


@lru_cache(maxsize=2)
def _written(width: int) -> list[bytes]:
    decimal = [str(i).encode() for i in range(width)]
    return [d + mark for mark in (b",", b"|", b";") for d in decimal]


def _lists(first: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, kind))


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
            digest: bool = False) -> DataFrame:
    """The alignment of every whole text, one row per row of ``docs``.

    ``doc_id``, ``n_a`` and ``n_b`` (tokens), ``groups`` (see ``Alignment.groups``; with ``digest`` its SHA-256 as hex),
    ``n_groups``, the linked id pairs ``pairs`` (A's id in the upper 32 bits, B's in the lower) with ``times``, and without
    ``digest`` the bytes where groups end in the text with a space before it, ``cuts``.

    Texts are encoded without special tokens. NULL and empty texts, and texts that one tokenizer does not give back whole (with
    the space before), have no tokens and an empty ``groups``. Other columns are ignored; an empty table gives
    an empty result. Texts advance together by about 8 MB; a longer one advances alone.
    """
    tokenizers = Tokenizers(a_path, b_path)
    schema = "doc_id long, n_a long, n_b long, n_groups long, groups string, pairs array<bigint>, times array<bigint>"
    names = [x.split()[0] for x in schema.split(", ")]

    def write(ids: list, texts: list[str]) -> pa.RecordBatch:
        found = Alignment(*tokenizers.encode(texts))
        pairs, times, first = found.pairs()
        sizes = [np.diff(x) for x in (found.a.first, found.b.first, found.first)]
        groups = [
            (hashlib.sha256(g).hexdigest() if digest else g.decode()) if n else "" for g, n in zip(found.groups(), sizes[2])
        ]
        columns = [
            pa.array(ids, pa.int64()), *(pa.array(x, pa.int64()) for x in sizes), pa.array(groups, pa.string()),
            _lists(first, pairs, pa.int64()), _lists(first, times, pa.int64()),
        ]
        if not digest:
            columns.append(_lists(found.first, found.a.ends[found.link_a], pa.int64()))
        return pa.RecordBatch.from_arrays(columns, names if digest else [*names, "cuts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(doc)
                texts.append(text)
                size += len(text)
                if size >= BATCH_BYTES:
                    yield write(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield write(ids, texts)

    rows = small_batches(docs).select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    return rows.mapInArrow(run, schema if digest else schema + ", cuts array<bigint>")


def pair_counts(links: DataFrame) -> DataFrame:
    """``pair``, ``count`` (links of the whole corpus) and ``best``: whether no pair of its B id is linked more often.

    ``links`` has ``pair`` and ``times``. Links are summed within tasks first; one row per B id is broadcast, at most as many as the
    vocabulary has ids.
    """
    counts = stage(links.groupBy("pair").agg(F.sum("times").alias("count")), "pair-counts")
    b_id = F.col("pair").bitwiseAND(0xFFFFFFFF)
    most = counts.groupBy(b_id.alias("b")).agg(F.max("count").alias("most"))
    return counts.withColumn("b", b_id).join(F.broadcast(most), "b").select(
        "pair", "count", (F.col("count") == F.col("most")).alias("best")
    )


def _summed(links: DataFrame, counts: DataFrame) -> DataFrame:
    return links.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    )


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256`` of every row.

    An id pair's count is the number of links in the corpus; ``n_best`` are a text's links whose pair has the highest count of
    its B id, ties included, and ``count_sum`` is the sum of the counts of its links. See ``aligned`` for odd rows.

    Counts reach the texts' pairs in two ways: those of the most frequent pairs, at most ``hot_pairs`` of them, are broadcast, and
    summed per text within the task; rarer pairs, which no longer make a hot key, are joined by a shuffle.
    """
    found = aligned(docs, a_path, b_path, id_col, text_col, digest=True)
    found = stage(found.withColumn("row", F.monotonically_increasing_id()), "alignment")
    links = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", "x.pairs", "x.times")
    links = links.withColumnRenamed("pairs", "pair")
    counts = stage(pair_counts(links), "pair-counts-best")

    # Pairs by powers of two of their count: at most 63 rows.
    power = F.floor(F.log2("count")).cast("int")
    sizes = {r.power: r.pairs for r in counts.groupBy(power.alias("power")).agg(F.count("*").alias("pairs")).collect()}
    least, total = 64, 0
    for p in sorted(sizes, reverse=True):
        total += sizes[p]
        if total > hot_pairs:
            break
        least = p
    hot, rare = F.broadcast(counts.filter(power >= least)), counts.filter(power < least)
    sums = _summed(links, hot)
    if any(p < least for p in sizes):
        sums = sums.unionByName(_summed(links.join(hot.select("pair"), "pair", "left_anti"), rare))
    sums = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return found.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), F.col("groups").alias("groups_sha256"),
    )
