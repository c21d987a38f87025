"""Token ids as Arrow IPC files of fixed-size lists: equal-length sequences and masks, readable in place."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchloom.llm.common import one_task_each, small_batches
from matchloom.llm.tokens import text_encoder
from matchloom.session import shared_dir, stage

BATCH = 512  # sequences of a record batch


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that all executors share, and the path within it."""
    return fs.FileSystem.from_uri(path)


class SequenceWriter:
    """One file of sequences of ``length`` ids with masks, and one with the place of each document in it.

    The last sequence is filled up with zeros; its mask says what counts.
    """

    def __init__(self, folder: str, length: int, dtype: str):
        store, self.path = open_folder(f"{folder}/part-{uuid.uuid4().hex}")
        self.name, self.length, self.dtype = self.path.rsplit("/", 1)[1], length, np.dtype(dtype)
        kind = pa.from_numpy_dtype(self.dtype)
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.docs_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.out = store.open_output_stream(f"{self.path}.arrow")
        self.docs_out = store.open_output_stream(f"{self.path}.docs.arrow")
        self.file = pa.ipc.new_file(self.out, self.schema)
        self.docs_file = pa.ipc.new_file(self.docs_out, self.docs_schema)
        self.held: list[np.ndarray] = []
        self.n_held = self.total = self.docs = 0
        self.first: int | None = None

    def add(self, doc_ids: list, ids: list[np.ndarray]) -> None:
        if not self.docs:
            self.first = doc_ids[0]
        sizes = np.array([len(x) for x in ids], dtype=np.int64)
        starts = self.total + np.cumsum(sizes) - sizes
        self.docs_file.write(pa.record_batch([pa.array(doc_ids, pa.int64()), starts, sizes], schema=self.docs_schema))
        self.docs += len(doc_ids)
        self.total += int(sizes.sum())
        self.held += ids
        self.n_held += int(sizes.sum())
        if self.n_held >= BATCH * self.length:
            self._write(self.n_held // (BATCH * self.length) * BATCH * self.length)

    def _write(self, upto: int) -> None:
        flat = np.concatenate(self.held)
        self.held, self.n_held = [flat[upto:]], max(0, len(flat) - upto)
        flat = flat[:upto]
        mask = np.ones(len(flat), dtype=bool)
        fill = -len(flat) % self.length
        flat, mask = np.pad(flat, (0, fill)), np.pad(mask, (0, fill))
        for first in range(0, len(flat), BATCH * self.length):
            part = slice(first, first + BATCH * self.length)
            self.file.write(pa.record_batch([
                pa.FixedSizeListArray.from_arrays(pa.array(x[part]), self.length) for x in (flat, mask)
            ], schema=self.schema))

    def close(self) -> dict:
        if self.n_held:
            self._write(self.n_held)
        for x in (self.file, self.docs_file, self.out, self.docs_out):
            x.close()
        return {"name": self.name, "first": self.first, "docs": self.docs, "n_ids": self.total}


class SequenceReader:
    """Random access to the documents of one file; batches are mapped or read only where needed."""

    def __init__(self, folder: str, name: str):
        store, path = open_folder(f"{folder}/{name}")
        local = isinstance(store, fs.LocalFileSystem)
        opened = [pa.memory_map(p) if local else store.open_input_file(p) for p in (f"{path}.arrow", f"{path}.docs.arrow")]
        self.file, self.docs = (pa.ipc.open_file(x) for x in opened)
        self.length = self.file.schema.field("ids").type.list_size
        self.at: tuple[int, np.ndarray] = (-1, np.zeros(0))

    def ids(self, start: int, count: int) -> np.ndarray:
        out, span = [], BATCH * self.length
        while count:
            number, skip = divmod(start, span)
            if self.at[0] != number:
                column = self.file.get_batch(number).column("ids")
                self.at = (number, column.flatten().to_numpy())
            part = self.at[1][skip:skip + count]
            out.append(part)
            start, count = start + len(part), count - len(part)
        return np.concatenate(out) if len(out) != 1 else out[0]


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, length: int = 2048, dtype: str = "uint16",
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode all documents and write them in ascending id order; returns the manifest, one row per file.

    Documents are dealt out by ranges of their id, so each task writes one file in order and the files follow one another
    by ``first``. NULL ids come first; rows repeated with one id are ordered by their text; NULL and empty texts
    are the end id alone. A retried task writes a new file, and only the file of the attempt that ended is in the
    manifest. ``dtype`` must hold every id.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, writer = text_encoder(tokenizer, keep_space=False), None
        most, end = np.iinfo(dtype).max, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                writer = writer or SequenceWriter(folder, length, dtype)
                ids = [np.frombuffer(x + end, "<u4") for x in cache.ids(part.column(1).to_pylist())]
                if max(int(x.max()) for x in ids) > most:
                    raise ValueError(f"an id does not fit {dtype}")
                writer.add(part.column(0).to_pylist(), [x.astype(dtype) for x in ids])
        if writer:
            yield pa.RecordBatch.from_pylist([writer.close()], pa.schema(
                [("name", pa.string()), ("first", pa.int64()), ("docs", pa.int64()), ("n_ids", pa.int64())]
            ))

    store, path = open_folder(folder)
    store.create_dir(path, recursive=True)
    ordered = small_batches(docs).select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return stage(ordered.mapInArrow(write, "name string, first long, docs long, n_ids long"), "arrow-manifest")


def read_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` and ``ids_crc32`` of all documents, from the files."""
    # One row per file: the window sees as many rows as the writer had tasks.
    placed = manifest.withColumn(
        "base", F.sum("n_ids").over(W.orderBy(F.asc_nulls_first("first")).rowsBetween(W.unboundedPreceding, 0)) - F.col("n_ids")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader = SequenceReader(folder, row["name"])
                for number in range(reader.docs.num_record_batches):
                    doc, start, size = reader.docs.get_batch(number).columns
                    sums = [
                        zlib.crc32(reader.ids(s, n).astype("<u4").tobytes()) for s, n in zip(start.to_pylist(), size.to_pylist())
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [doc, pa.array(start.to_numpy() + row["base"]), size, pa.array(sums, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return one_task_each(placed.select("name", "base")).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write the ids of all documents to the shared folder and read them back, one row per document."""
    folder = shared_dir(docs.sparkSession, "arrow-ids")
    return read_ids(write_ids(docs, folder, tokenizer, end_id), folder)
