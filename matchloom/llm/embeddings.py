"""Near-duplicate vectors by randomised-rotation binary codes with stored correction factors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import blocked, close_rows, complete_groups, components, smallest_linked
from matchloom.session import stage

LEVELS = 15  # a query component is rounded to four bits
BOUND = 4.0  # standard errors of the confidence bound
SHORT = 128  # signs that travel through the tables
SHORT_BOUND = 6.0  # standard errors of the number of signs in which a pair at the threshold differs


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same on every machine for one seed."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def tables_for(rows: int, threshold: float, miss: float = 0.001, per_bucket: int = 64) -> tuple[int, int]:
    """Bits per table key and number of tables.

    Unrelated vectors share a key of ``bits`` signs with chance 2**-bits, so the buckets of a table hold about
    ``per_bucket`` vectors at every size. A pair at the threshold shares one sign with chance 1 - angle / pi; with
    this many tables it meets in none with at most the chance ``miss``, and closer pairs with less.
    """
    bits = max(8, math.ceil(math.log2(max(rows, 1) / per_bucket))) if rows else 8
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - meet))


def turns_for(dim: int, bits: int, tables: int) -> int:
    return max(2, math.ceil(bits * tables / dim))


def most_different(dim: int, bits: int, tables: int, threshold: float) -> int:
    """So many of the short code's signs can differ at the threshold: their expectation and SHORT_BOUND standard errors."""
    n = min(SHORT, dim * turns_for(dim, bits, tables))
    p = math.acos(threshold) / math.pi
    return math.floor(n * p + SHORT_BOUND * math.sqrt(n * p * (1 - p)))


class Coder:
    """Codes, correction factors and rounded queries of unit vectors of one dimension."""

    def __init__(self, dim: int, bits: int, tables: int, seed: int = 7):
        self.dim, self.bits, self.tables = dim, bits, tables
        turns = turns_for(dim, bits, tables)
        self.matrix = np.concatenate([rotation(dim, seed + i) for i in range(turns)]) if dim else np.zeros((0, 0))
        self.width = len(self.matrix)
        self.turns = turns

    def encode(self, unit: np.ndarray) -> dict[str, np.ndarray]:
        turned = unit @ self.matrix.T
        signs = turned > 0
        factor = np.abs(turned).reshape(len(unit), self.turns, self.dim).sum(axis=2).mean(axis=1) / math.sqrt(self.dim)
        low = turned.min(axis=1, keepdims=True)
        step = np.maximum((turned.max(axis=1, keepdims=True) - low) / LEVELS, 1e-12)
        dither = np.random.default_rng(11).random(self.width)
        levels = np.clip(np.floor((turned - low) / step + dither), 0, LEVELS).astype(np.uint8)
        return {
            "code": _words(signs), "factor": factor, "low": low[:, 0], "step": step[:, 0],
            "planes": np.stack([_words((levels >> k) & 1 == 1) for k in range(4)], axis=1),
            "total": levels.sum(axis=1, dtype=np.int64), "ones": signs.sum(axis=1, dtype=np.int64), "keys": self._keys(signs),
        }

    def _keys(self, signs: np.ndarray) -> np.ndarray:
        keyed = signs[:, : self.bits * self.tables].reshape(len(signs), self.tables, self.bits)
        keys = np.zeros((len(signs), self.tables), dtype=np.int64)
        for bit in range(self.bits):
            keys |= keyed[:, :, bit].astype(np.int64) << bit
        return keys

    def pack(self, x: dict[str, np.ndarray]) -> list[bytes]:
        """Code, rounded query and correction factors of each row as bytes."""
        n = len(x["code"])
        whole = np.concatenate([
            x["code"], x["planes"].reshape(n, -1), *(x[c].view(np.uint64)[:, None] for c in ("factor", "low", "step", "total", "ones")),
        ], axis=1)
        return [row.tobytes() for row in whole]

    def unpack(self, packed: list[bytes]) -> dict[str, np.ndarray]:
        whole = np.frombuffer(b"".join(packed), np.uint64).reshape(len(packed), -1)
        words = (whole.shape[1] - 5) // 5
        code = np.ascontiguousarray(whole[:, :words])
        numbers = np.ascontiguousarray(whole[:, -5:])
        real = numbers.view(np.float64)
        signs = np.unpackbits(code.view(np.uint8), axis=1)[:, :self.width]
        return {
            "code": code, "planes": whole[:, words:5 * words].reshape(len(packed), 4, words), "factor": real[:, 0], "low": real[:, 1],
            "step": real[:, 2], "total": numbers[:, 3].view(np.int64), "ones": numbers[:, 4].view(np.int64), "keys": self._keys(signs),
        }

    def short(self, x: dict[str, np.ndarray]) -> np.ndarray:
        """The first signs of each row, as 64-bit words."""
        return np.ascontiguousarray(x["code"][:, :SHORT // 64])

    def estimate(self, x: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products of rows i (as codes) and j (as rounded queries), and their error bounds."""
        inner = np.zeros(len(i), dtype=np.int64)
        for k in range(4):
            inner += np.bitwise_count(x["code"][i] & x["planes"][j, k]).sum(axis=1, dtype=np.int64) << k
        signed = x["step"][j] * (2 * inner - x["total"][j]) + x["low"][j] * (2 * x["ones"][i] - self.width)
        factor = np.maximum(x["factor"][i], 1e-6)
        value = signed / (self.turns * math.sqrt(self.dim)) / factor
        spread = np.sqrt(np.maximum(1 - factor**2, 0)) / factor / math.sqrt(max(self.dim - 1, 1) * self.turns)
        rounding = x["step"][j] / (2 * math.sqrt(self.turns)) / factor
        return value, BOUND * (spread + rounding)


_GROUP = ["slot", "bucket", "lo", "hi"]


def _aligned(short: list[bytes]) -> np.ndarray:
    """Short codes as rows of words; those of vectors of few dimensions are shorter and filled up."""
    width = max(map(len, short))
    return np.frombuffer(b"".join(x.ljust(width, b"\0") for x in short), np.uint64).reshape(len(short), -1)


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    packed = np.packbits(bits, axis=1)
    packed = np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))
    return np.ascontiguousarray(packed).view(np.uint64)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = 0.95, block: int = 512) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept``, one row per row of ``vectors``.

    Vectors link if their cosine, in double precision, reaches ``threshold``. The signs of randomly rotated unit
    vectors are the code, which is stored once with its correction factors. Runs of the code key hash tables, through which only the
    first 128 signs travel. Vectors that meet another one so alike that it may reach the threshold get their codes and
    vectors: the code gives an unbiased estimate of the cosine with a bound, and only pairs whose bound reaches the
    threshold are computed exactly. A pair counts in the first table it meets in. Equal vectors are one node. Only counts and
    spanning edges leave a bucket, and buckets over ``block`` are worked in block pairs.

    NULL, empty and zero vectors and vectors with NULL or non-finite components link with nothing. Vectors of different length
    never link. Repeated rows count as other vectors; rows without an id link with nothing and are kept. Other columns are
    ignored. An empty table gives an empty result.
    """
    v = F.col(vector_col)
    good = (
        v.isNotNull() & (F.size(v) > 0) & F.col(id_col).isNotNull()
        & ~F.coalesce(F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))
        & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    )
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("vector"),
        F.coalesce(good, F.lit(False)).alias("good"),
    ).withColumn("print", F.when(F.col("good"), F.struct(F.xxhash64("vector"), F.xxhash64(F.lit(1), "vector"))))
    nodes = stage(
        rows.filter("good").groupBy("print").agg(
            F.min_by("vector", "vec_id").alias("vector"), F.min("vec_id").alias("id"), F.count("*").alias("copies")
        ),
        "vectors",
    )
    bits, tables = tables_for(nodes.count(), threshold)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders: dict[int, Coder] = {}
        for batch in batches:
            sizes = np.diff(batch.column(1).offsets.to_numpy())
            for dim in np.unique(sizes):
                part = batch.filter(pa.array(sizes == dim))
                coder = coders.setdefault(int(dim), Coder(int(dim), bits, tables))
                x = _matrix(part.column(1))
                found = coder.encode(x / _norms(x))
                offsets = pa.array(np.arange(0, found["keys"].size + 1, tables, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(np.full(part.num_rows, dim, dtype=np.int32)),
                    pa.ListArray.from_arrays(offsets, pa.array(found["keys"].ravel())),
                    pa.array([row.tobytes() for row in coder.short(found)], pa.binary()), pa.array(coder.pack(found), pa.binary()),
                ], ["id", "dim", "keys", "short", "code"])

    codes = stage(
        nodes.select("id", "vector").mapInArrow(encode, "id long, dim int, keys array<long>, short binary, code binary"), "vector-codes"
    )
    dealt = codes.select("id", "dim", "short", F.posexplode("keys").alias("slot", "key")).select(
        "slot", (F.col("key") * 65536 + F.col("dim")).alias("bucket"), "id", "dim", "short"
    )
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, group in complete_groups(batches, _GROUP):
            lo, hi, own, dim = (rows.column(c).to_numpy() for c in ("lo", "hi", "own", "dim"))
            short = _aligned(rows.column("short").to_pylist())
            most = {d: most_different(d, bits, tables, threshold) for d in np.unique(dim).tolist()}
            limit, used = np.array([most[d] for d in dim.tolist()]), np.zeros(rows.num_rows, dtype=bool)
            for left, right in close_rows(group, lo, hi, own):
                near = np.bitwise_count(short[left] ^ short[right]).sum(axis=1, dtype=np.int64) <= limit[left]
                used[left[near]] = used[right[near]] = True
            if used.any():
                yield from rows.filter(pa.array(used)).select([*_GROUP, "own", "id"]).to_batches()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders: dict[int, Coder] = {}
        for rows, group in complete_groups(batches, _GROUP):
            dims = np.diff(rows.column("vector").combine_chunks().offsets.to_numpy())
            for dim in np.unique(dims):
                here = dims == dim
                part = rows.filter(pa.array(here)) if not here.all() else rows
                coder = coders.setdefault(int(dim), Coder(int(dim), bits, tables))
                yield from _compare(part, group[here], coder, threshold)

    members = stage(blocked(dealt, block).mapInArrow(meet, "slot int, bucket long, lo int, hi int, own int, id long"), "vector-meetings")
    whole = members.join(codes.select("id", "code"), "id").join(nodes.select("id", "copies", "vector"), "id")
    whole = whole.repartition(*_GROUP).sortWithinPartitions(*_GROUP)
    found = stage(whole.mapInArrow(compare, "id long, links long, root long"), "vector-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("root").alias("a"), F.col("id").alias("b")))
    named = (
        nodes.select("print", "id", "copies").join(links, "id", "left").join(roots, "id", "left")
        .select("print", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
                F.coalesce("root", "id").alias("root"))
    )
    out = rows.select("vec_id", "print").join(named, "print", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("root", "vec_id").alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _norms(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1, keepdims=True)
    return top * np.sqrt(((x / top) ** 2).sum(axis=1, keepdims=True))


def _compare(rows: pa.Table, group: np.ndarray, coder: Coder, threshold: float) -> Iterator[pa.RecordBatch]:
    ids, copies, slot, lo, hi, own = (
        rows.column(c).to_numpy() for c in ("id", "copies", "slot", "lo", "hi", "own")
    )
    x = _matrix(rows.column("vector"))
    unit = x / _norms(x)
    codes = coder.unpack(rows.column("code").to_pylist())
    keys, found = codes["keys"], []
    before = np.arange(coder.tables)[None, :]
    for left, right in close_rows(group, lo, hi, own):
        value, error = coder.estimate(codes, left, right)
        may = value + error >= threshold
        left, right = left[may], right[may]
        cosine = np.einsum("ij,ij->i", unit[left], unit[right])
        link = cosine >= threshold
        left, right = left[link], right[link]
        if len(left):
            earlier = ((keys[left] == keys[right]) & (before < slot[left][:, None])).any(axis=1)
            found.append((left[~earlier], right[~earlier]))
    if not found:
        return
    left, right = (np.concatenate(x) for x in zip(*found))
    if not len(left):
        return
    counts = np.bincount(left, copies[right], len(ids)) + np.bincount(right, copies[left], len(ids))
    # A block pair lists each vector once, groups apart: rows of different groups never share an edge.
    root = smallest_linked(ids, left, right)
    hit = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(ids[hit]), pa.array(counts[hit].astype(np.int64)), pa.array(root[hit])], ["id", "links", "root"]
    )
