"""Line dedup: lines that documents share stay in one of them; decisions come back as one small bitmap per document."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import small_batches, text_bytes
from matchloom.session import stage

SPACE = b" \t\n\x0b\x0c\r"
NO_ID = -(1 << 63)  # rows without an id are one document, before all others
_BREAK = ["hi", "lo"]


def line_key(line: bytes) -> bytes:
    """What lines are compared by: white space at both ends gone, A-Z lowered."""
    return line.strip(SPACE).lower()


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (key.isascii() or len(key) >= 4 * least or len(key.decode()) >= least)


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``text`` and what names the row: ``name`` (the id) and ``digest`` (of the text)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("name"),
        F.xxhash64(text).alias("digest"),
        text_bytes(text_col).alias("text"),
    )


def line_hashes(docs: DataFrame, least: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Places of the long lines of each document by the 128-bit hash (``hi``, ``lo``) of their key.

    One row per document and different key, so a line repeated within a document is one row however often it occurs, and one
    row per document without a hash, which carries the number of its lines.
    """
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, digests = (batch.column(i).to_pylist() for i in (0, 1))
            row, keys, places, counts = [], [], [], []
            for i, text in enumerate(batch.column(2)):
                lines = text.as_buffer().to_pybytes().split(b"\n")
                found: dict[bytes, list[int]] = {}
                for place, line in enumerate(lines):
                    if len(line) >= least:
                        key = line_key(line)
                        if _long_enough(key, least):
                            found.setdefault(key, []).append(place)
                row += [i] * (len(found) + 1)
                keys += [None, *found]
                places += [None, *found.values()]
                counts += [len(lines), *[None] * len(found)]
            raw = b"".join(xxhash.xxh3_128_digest(k) if k is not None else bytes(16) for k in keys)
            halves = np.frombuffer(raw, ">i8").astype(np.int64).reshape(-1, 2)
            absent = np.array([k is None for k in keys], dtype=bool)
            for first in range(0, len(row), 50_000):
                part = slice(first, first + 50_000)
                yield pa.RecordBatch.from_arrays([
                    pa.array(halves[part, 0], mask=absent[part]), pa.array(halves[part, 1], mask=absent[part]),
                    pa.array([names[i] for i in row[part]], pa.int64()), pa.array([digests[i] for i in row[part]], pa.int64()),
                    pa.array(places[part], pa.list_(pa.int32())), pa.array(counts[part], pa.int64()),
                ], ["hi", "lo", "name", "digest", "places", "n_lines"])

    rows = small_batches(_named(docs, id_col, text_col).select("name", "digest", "text"))
    return rows.mapInArrow(hashes, "hi long, lo long, name long, digest long, places array<int>, n_lines long")


def _stream(documents: int):
    """Decide the rows of one range, sorted by hash and descending document, in one pass.

    The document that comes first with a hash keeps its lines; the rows of all others go if the hash has at least
    ``documents`` of them. Such rows are given without the hash. The first hash of a range may have begun in the range before,
    so its rows are given with the hash, undecided. The last one may go on in the next range, which has to learn of it, so the
    rows of its first ``documents`` documents are given undecided as well. Memory holds a batch and the rows of that many documents.
    """
    def settled(rows: pa.RecordBatch) -> pa.RecordBatch:
        none = pa.nulls(rows.num_rows, pa.int64())
        return pa.RecordBatch.from_arrays([none, none, *rows.columns[2:]], schema=rows.schema)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = hash_before = name_before = None
        count = 0  # documents of the hash under way
        held: list[tuple[pa.RecordBatch, np.ndarray]] = []  # its rows of the first documents, and their ranks
        for batch in batches:
            if not batch.num_rows:
                continue
            hi, lo, name = (batch.column(c).to_numpy() for c in ("hi", "lo", "name"))
            first = first or (hi[0], lo[0])
            new, other = np.ones(len(hi), dtype=bool), np.ones(len(hi), dtype=bool)
            new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
            new[0] = hash_before != (hi[0], lo[0])
            other[1:] = new[1:] | (name[1:] != name[:-1])
            other[0] = new[0] or name_before != name[0]
            group, seen, at = np.cumsum(new), np.cumsum(other), np.flatnonzero(new)
            rank = seen - np.concatenate([[-count], seen[at] - 1])[group]  # of the row's document within its hash
            total = np.zeros(len(at) + 1, dtype=np.int64)
            total[0] = count
            np.maximum.at(total, group, rank)

            initial = (hi == first[0]) & (lo == first[1])
            if initial.any():
                yield batch.filter(pa.array(initial))
            under_way = (group == group[-1]) & (rank <= documents)
            gone = ~initial & ~under_way & (rank > 1) & (total[group] >= documents)
            if gone.any():
                yield settled(batch.filter(pa.array(gone)))
            if len(at):
                if total[0] >= documents:
                    for rows, ranks in held:
                        yield settled(rows.filter(pa.array(ranks > 1)))
                held = []
            keep = under_way & ~initial
            if keep.any():
                held.append((batch.filter(pa.array(keep)), rank[keep]))
            hash_before, name_before, count = (hi[-1], lo[-1]), name[-1], int(total[-1])
        for rows, _ in held:
            yield rows

    return decide


def dropped_lines(hashes: DataFrame, documents: int = 3) -> DataFrame:
    """``name``, ``digest`` and ``places`` of the lines that go, any number of rows per document.

    Rows are dealt out by ranges of (hash, descending document), so a hash that most documents hold fills several ranges.
    Only its parts in those ranges, and the hashes at the borders, are counted apart: at most two hashes a range, whose
    counts are the only thing that is broadcast.
    """
    keyed = hashes.filter("hi is not null").select("hi", "lo", "name", "digest", "places")
    order = [F.col("hi"), F.col("lo"), F.col("name").desc(), F.col("digest")]
    ranges = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    passed = stage(ranges.mapInArrow(_stream(documents), keyed.schema), "line-ranges")
    parts = passed.filter("hi is not null")
    borders = parts.select(*_BREAK, "name").distinct().groupBy(*_BREAK).agg(
        F.count("*").alias("documents"), F.max("name").alias("keeps")
    ).filter(F.col("documents") >= documents)
    settled = parts.join(F.broadcast(borders), _BREAK).filter("name <> keeps")
    return passed.filter("hi is null").select("name", "digest", "places").unionByName(settled.select("name", "digest", "places"))


def keep_bitmaps(docs: DataFrame, least: int = 20, documents: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``name``, ``digest``, ``n_lines``, ``n_dropped`` and ``keep`` of every different row of ``docs``.

    ``keep`` is a bit per line, first line first, packed and compressed by zlib; ``kept_text`` applies it. ``name`` is the id, or
    for a row without one the smallest long. ``digest`` is the 64-bit hash of the text; rows that repeat id and text are one row here.

    Lines are compared by their key (see ``line_key``). Those whose key has at least ``least`` code points and is found in at
    least ``documents`` documents go, except in the document with the largest id, which keeps all of them. Documents are
    told apart by their id alone. NULL and empty texts are one empty line, which stays. An empty table gives an empty
    result. Other columns are ignored.
    """
    hashes = stage(line_hashes(docs, least, id_col, text_col), "line-hashes")
    none = F.array().cast("array<int>")
    counts = hashes.filter("hi is null").select("name", "digest", none.alias("places"), "n_lines")
    gone = dropped_lines(hashes, documents).withColumn("n_lines", F.lit(None).cast("long"))
    # The places of one document: no more than it has lines. Repeated rows name the same places several times.
    per_row = counts.unionByName(gone).groupBy("name", "digest").agg(
        F.max("n_lines").alias("n_lines"), F.flatten(F.collect_list("places")).alias("places")
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps, dropped = [], []
            for n, places in zip(batch.column(2).to_pylist(), batch.column(3)):
                keep = np.ones(n, dtype=bool)
                keep[places.values.to_numpy()] = False
                dropped.append(n - int(keep.sum()))
                maps.append(zlib.compress(np.packbits(keep).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(dropped, pa.int64()), pa.array(maps, pa.binary())],
                ["name", "digest", "n_lines", "n_dropped", "keep"],
            )

    return per_row.mapInArrow(pack, "name long, digest long, n_lines long, n_dropped long, keep binary")


def kept_text(text: bytes, n_lines: int, keep: bytes) -> bytes:
    """The lines a bitmap keeps, joined by line feeds."""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n_lines)
    if bits.all():
        return text
    return b"\n".join(line for line, bit in zip(text.split(b"\n"), bits.tolist()) if bit)


def drop_lines(docs: DataFrame, least: int = 20, documents: int = 3, id_col: str = "doc_id", text_col: str = "text",
               digest: bool = False) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_dropped`` and ``kept`` (UTF-8), or with ``digest`` its SHA-256; one row per row of ``docs``.

    See ``keep_bitmaps`` for what goes and how odd rows are handled. The texts are read once for the hashes, and once more to
    meet their bitmaps.
    """
    column, kind = ("kept_sha256", "string") if digest else ("kept", "binary")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (kept_text(t.as_buffer().to_pybytes(), n, k) for t, n, k in zip(
                batch.column(3), batch.column(1).to_pylist(), batch.column(4).to_pylist()))
            out = [hashlib.sha256(t).hexdigest() if digest else t for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(out, pa.string() if digest else pa.binary())],
                ["doc_id", "n_lines", "n_dropped", column],
            )

    maps = keep_bitmaps(docs, least, documents, id_col, text_col)
    met = _named(docs, id_col, text_col).join(maps, ["name", "digest"]).select("doc_id", "n_lines", "n_dropped", "text", "keep")
    return small_batches(met).mapInArrow(apply, f"doc_id long, n_lines long, n_dropped long, {column} {kind}")
