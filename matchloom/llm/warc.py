"""WARC archives with one Zstandard dictionary: embedded in a leading skippable frame, one frame per record."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.arrow_ids import open_folder
from matchloom.llm.common import one_task_each, small_batches, text_bytes
from matchloom.session import shared_dir, stage

# Fixed values of the WARC and Zstandard formats.
DICTIONARY_FRAME = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http; msgtype=response"

SAMPLE_PAGES = 512  # pages the dictionary is built from
SAMPLE_BYTES = 16_384  # of each of them
DICTIONARY_BYTES = 32_768


def _block(payload_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()


def record(page_id: int | None, url: str | None, digest: str, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record. A revisit has the HTTP header of its page, which tells the size, but not the payload."""
    kind = "response" if refers_to is None else "revisit"
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    block = _block(len(payload)) + (payload if refers_to is None else b"")
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"Content-Type: {HTTP}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary, or, of too few samples to train on, their beginnings themselves."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return (b"".join(samples) or record(0, None, "", b"", None, ""))[:size]


def write_file(out: BinaryIO, dictionary: bytes, records: Iterator[bytes], level: int = 3) -> None:
    shared = zstandard.ZstdCompressionDict(dictionary)
    shared.precompute_compress(level=level)
    packer = zstandard.ZstdCompressor(level=level, dict_data=shared)
    out.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
    for one in records:
        out.write(packer.compress(one))


def read_file(source: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record; memory holds one record."""
    magic, size = struct.unpack("<II", source.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("no dictionary frame")
    shared = zstandard.ZstdCompressionDict(source.read(size))
    stream = zstandard.ZstdDecompressor(dict_data=shared).stream_reader(source, read_across_frames=True)
    held = b""
    while True:
        while b"\r\n\r\n" not in held:
            more = stream.read(1 << 16)
            if not more:
                if held:
                    raise ValueError("a record is torn")
                return
            held += more
        head, held = held.split(b"\r\n\r\n", 1)
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        need = int(fields["Content-Length"]) + 4
        parts, have = [held], len(held)
        while have < need:
            more = stream.read(max(1 << 16, need - have))
            if not more:
                raise ValueError("a record is torn")
            parts.append(more)
            have += len(more)
        held = b"".join(parts)
        yield fields, held[:need - 4]
        held = held[need:]


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z",
                   id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write one record per page, a file per task, into ``folder``; returns the names of the files.

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with the largest id is a response, the others
    are revisits of it; pages with smaller payloads are responses. NULL payloads are empty. A page without an id never
    stands for others unless no page with its payload has one. Rows repeated with the largest id are all responses.
    The dictionary is built from the beginnings of at most 512 pages, chosen by a hash of their id. A retried task
    writes a new file, and only the file of the attempt that ended is named in the result.
    """
    payload = text_bytes(html_col)
    rows = small_batches(pages).select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"),
        F.sha1(payload).alias("sha1"),
    )
    heads = rows.groupBy("sha1").agg(F.max("page_id").alias("head"))
    kept = F.col("head").isNull() | F.col("page_id").eqNullSafe(F.col("head")) | (F.length("payload") < min_bytes)
    decided = rows.join(heads, "sha1").withColumn("refers_to", F.when(~kept, F.col("head")))
    # The ids are chosen first, so that the pages of no others are moved.
    by_hash = [F.xxhash64("id"), F.col("id")]
    begun = pages.select(F.col(id_col).cast("long").alias("id"), F.substring(payload, 1, SAMPLE_BYTES).alias("payload"))
    chosen = begun.filter("id is not null").select("id").distinct().orderBy(*by_hash).limit(SAMPLE_PAGES)
    ids = [r.id for r in chosen.collect()]  # at most SAMPLE_PAGES numbers
    sample = begun.filter(F.col("id").isin(ids)).groupBy("id").agg(F.max("payload").alias("payload")).orderBy(*by_hash).collect()
    dictionary = build_dictionary([
        record(r.id, None, "", bytes(r.payload), None, date) for r in sample
    ])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            yield from first
            for batch in batches:
                yield from encoded(batch)

        def encoded(batch: pa.RecordBatch) -> Iterator[bytes]:
            for page, url, body, sha1, refers in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "sha1", "refers_to"))):
                digest = base64.b32encode(bytes.fromhex(sha1.as_py())).decode()
                yield record(page.as_py(), url.as_py(), digest, body.as_py(), refers.as_py(), date)

        for batch in batches:
            if batch.num_rows:
                first = encoded(batch)
                break
        else:
            return
        store, path = open_folder(f"{folder}/part-{uuid.uuid4().hex}.warc.zst")
        with store.open_output_stream(path) as out:
            write_file(out, dictionary, records())
        yield pa.RecordBatch.from_arrays([pa.array([path.rsplit("/", 1)[1]])], ["name"])

    store, path = open_folder(folder)
    store.create_dir(path, recursive=True)
    return stage(decided.select("page_id", "url", "payload", "sha1", "refers_to").mapInArrow(write, "name string"), "warc-files")


def read_archives(names: DataFrame, folder: str) -> DataFrame:
    """``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type`` and ``refers_to`` of every record of the files.

    The digest of a response is taken from its payload and must equal the one in its header.
    """
    def page(urn: str | None) -> int | None:
        number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                store, path = open_folder(f"{folder}/{name}")
                rows = []
                with store.open_input_stream(path) as source:
                    for fields, block in read_file(source):
                        head, payload = block.split(b"\r\n\r\n", 1)
                        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if fields["WARC-Type"] == "response":
                            found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                            if (found, len(payload)) != (digest, size):
                                raise ValueError(f"{name}: the payload does not match its digest")
                        rows.append((page(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"], page(fields.get("WARC-Refers-To"))))
                        if len(rows) == 4096:
                            yield emit(rows)
                            rows = []
                if rows:
                    yield emit(rows)

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
            ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
        )

    return one_task_each(names).mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write all pages into archives in the shared folder and read them back, one row per page."""
    folder = shared_dir(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, min_bytes), folder)
