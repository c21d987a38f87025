"""Byte-level BPE in numpy: rows of padded byte matrices merge together, one pair a round."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import small_batches
from matchloom.llm.tokens import PieceCache, forget

NONE = np.int64(1) << 40  # above every rank
CELLS = 1_000_000  # of one matrix
WIDEST = 4096  # longer pre-tokens are merged one by one, by a heap


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


class PairTable:
    """Rank of the token that two adjacent tokens make, by a hash table with open addressing."""

    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.bits = max(4, (2 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, NONE, dtype=np.int64)
        keys = np.fromiter(pairs.keys(), dtype=np.int64, count=len(pairs))
        values = np.fromiter(pairs.values(), dtype=np.int64, count=len(pairs))
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[free]  # of several for one slot the last stays
            mine = self.keys[slot] == keys
            self.values[slot[mine]] = values[mine]
            keys, values, slot = keys[~mine], values[~mine], (slot[~mine] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * self.FACTOR) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, NONE where there is none or one side is padding (-1)."""
        out = np.full(left.shape, NONE, dtype=np.int64)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = left.ravel()[todo].astype(np.int64) << 32 | right.ravel()[todo].astype(np.int64)
        slot, flat = self._slot(keys), out.ravel()
        while len(todo):
            held = self.keys[slot]
            hit = held == keys
            flat[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (held != -1)
            todo, keys, slot = todo[on], keys[on], (slot[on] + 1) & (len(self.keys) - 1)
        return flat.reshape(left.shape)


class Bpe:
    """Encoder and decoder of one rank file and one split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, limit: int = 300_000):
        self.known: dict[str, np.ndarray] = {}
        self.limit = limit
        self.pattern = regex.compile(pattern)
        self.pairs = PairTable(ranks)
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.token = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.token[rank] = token

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; every different pre-token is merged once while it is remembered."""
        split = [self.pattern.findall(x) for x in texts]
        if len(self.known) > self.limit:
            forget(self.known, self.limit)
        known = self.known
        known.update(self.merge(list(set(chain.from_iterable(split)).difference(known))))
        none = np.zeros(0, dtype=np.int64)
        return [np.concatenate([known[w] for w in words]) if words else none for words in split]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.token.__getitem__, ids.tolist()))

    def merge(self, words: list[str]) -> dict[str, np.ndarray]:
        """Ids of pre-tokens, by matrices of words of about one length."""
        out: dict[str, np.ndarray] = {}
        raw = [w.encode() for w in words]
        size = np.array([len(r) for r in raw], dtype=np.int64)
        bucket = np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64)
        for b in np.unique(bucket):
            members = np.flatnonzero(bucket == b)
            if (1 << b) > WIDEST:
                for i in members:
                    out[words[i]] = self._one(raw[i])
                continue
            step = max(1, CELLS >> int(b))
            for first in range(0, len(members), step):
                some = members[first:first + step]
                for i, ids in zip(some, self._matrix([raw[i] for i in some], size[some])):
                    out[words[i]] = ids
        return out

    def _matrix(self, raw: list[bytes], size: np.ndarray) -> list[np.ndarray]:
        width = int(size.max())
        filled = np.arange(width) < size[:, None]
        cells = np.full((len(raw), width), -1, dtype=np.int64)
        cells[filled] = self.byte[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        result: list[np.ndarray] = [np.zeros(0, np.int64)] * len(raw)
        row = np.arange(len(raw))
        rank = self.pairs.ranks(cells[:, :-1], cells[:, 1:])
        while len(row):
            here = np.arange(len(row))
            at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(row), dtype=np.int64)
            best = rank[here, at] if rank.shape[1] else np.full(len(row), NONE)
            over = best == NONE
            if over.any():
                length = (cells[over] >= 0).sum(axis=1)
                for i, ids, n in zip(row[over], cells[over], length):
                    result[i] = ids[:n].copy()
                row, cells, rank, at, best = row[~over], cells[~over], rank[~over], at[~over], best[~over]
                if not len(row):
                    break
                here = np.arange(len(row))
            # Compaction: the merged token takes the left place, everything to the right moves up by one.
            cells[here, at] = best
            moved = np.arange(cells.shape[1] - 1)
            cells = np.take_along_axis(cells, moved + (moved > at[:, None]), axis=1)
            moved = moved[:-1]
            rank = np.take_along_axis(rank, moved + (moved >= at[:, None]), axis=1)
            for side in (at - 1, at):
                ok = np.flatnonzero((side >= 0) & (side < cells.shape[1] - 1))
                if len(ok):
                    rank[ok, side[ok]] = self.pairs.ranks(cells[ok, side[ok]], cells[ok, side[ok] + 1])
        return result

    def _one(self, raw: bytes) -> np.ndarray:
        """The same merges for one very long pre-token, in n log n."""
        ids = self.byte[np.frombuffer(raw, dtype=np.uint8)].tolist()
        n = len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        first = self.pairs.ranks(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(r, i, i + 1) for i, r in enumerate(first) if r < NONE]
        heapq.heapify(heap)
        alive, live_rank = [True] * n, dict(enumerate(first))
        while heap:
            r, i, j = heapq.heappop(heap)
            if not alive[i] or after[i] != j or live_rank.get(i) != r:
                continue
            ids[i], alive[j], after[i] = r, False, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0:
                    live_rank[k] = int(NONE)
                    if after[k] >= 0:
                        new = int(self.pairs.ranks(np.array([ids[k]]), np.array([ids[after[k]]]))[0])
                        live_rank[k] = new
                        if new < NONE:
                            heapq.heappush(heap, (new, k, after[k]))
        return np.array([x for x, a in zip(ids, alive) if a], dtype=np.int64)


@lru_cache(maxsize=2)
def encoder(ranks_path: str, pattern: str) -> tuple[Bpe, PieceCache]:
    """One encoder per file and Python worker, so that its pieces are remembered from task to task."""
    bpe = Bpe(read_ranks(ranks_path), pattern)
    return bpe, PieceCache(bpe.encode, keep_space=True)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     finish=None, schema: str = "doc_id long, ids array<int>, decoded binary") -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded`` (the bytes of the ids), one row per row of ``docs``.

    Ids equal those of encoding each match of ``pattern`` by itself, without special tokens. NULL and empty texts
    have no ids. ``finish(ids, decoded)`` may replace the last two columns by those that ``schema`` names, in the
    same task. Other columns are ignored; an empty table gives an empty result.
    """
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, cache = encoder(ranks_path, pattern)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                rows = []
                for raw in cache.ids(part.column(1).to_pylist()):
                    ids = np.frombuffer(raw, dtype="<u4")
                    decoded = bpe.decode(ids)
                    rows.append(finish(ids, decoded) if finish else (ids.astype(np.int32), decoded))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c) for c in zip(*rows))], names)

    return small_batches(docs).select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).mapInArrow(run, schema)
