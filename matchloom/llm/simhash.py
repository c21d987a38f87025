"""SimHash near-duplicates: an inverted index on byte positions, count filtering, exact verification."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import blocked, close_rows, complete_groups, components, small_batches, smallest_linked, text_bytes
from matchloom.session import stage

BYTES = 8
SEED = 42


def simhash(text: bytes, width: int = 3) -> int:
    """Majority bits of the XXH64 of all word shingles; 0 without words. A-Z are lowered first."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype=">u8")
    ones = np.zeros(64, dtype=np.int64)
    for first in range(0, len(hashes), 65536):
        part = hashes[first:first + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


_SKETCH = 64  # minimum hashes, eight bits kept of each
BANDS = 16  # of four minimum hashes each
_TURNS = np.random.default_rng(17).integers(0, 1 << 63, _SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes, width: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes of the different word shingles."""
    words = text.lower().split()
    runs = [b" ".join(words)] if len(words) < width else map(b" ".join, zip(*(words[i:] for i in range(width))))
    return np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, runs), dtype=np.uint64))


def sketch(hashes: np.ndarray) -> bytes:
    """Eight bits of each of 64 minimum hashes of a set of shingles; equal bytes estimate Jaccard similarity."""
    least = np.full(_SKETCH, np.iinfo(np.uint64).max, dtype=np.uint64)
    for first in range(0, len(hashes), 1024):
        turned = hashes[first:first + 1024, None] * _TURNS
        np.minimum(least, (turned ^ (turned >> np.uint64(29))).min(axis=0), out=least)
    return ((least * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.uint8).tobytes()


def digest(hashes: np.ndarray) -> int:
    """A signed number that names a set of shingles."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())).view(np.int64))


def with_simhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                 sketched: bool = False) -> DataFrame:
    """``doc_id``, ``hash`` (the 64 bits as a signed long), ``sketch`` and ``digest`` (or NULL) of each whole text."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, marks, digests = [], [], []
            for x in batch.column(1):
                text = x.as_buffer().to_pybytes()
                hashes.append(simhash(text, width))
                found = shingles(text) if sketched else None
                marks.append(sketch(found) if sketched else None)
                digests.append(digest(found) if sketched else None)
            signed = np.array(hashes, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(signed), pa.array(marks, pa.binary()), pa.array(digests, pa.int64())],
                ["doc_id", "hash", "sketch", "digest"],
            )

    rows = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    return rows.mapInArrow(encode, "doc_id long, hash long, sketch binary, digest long")


def shingle_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``digest`` and ``shingles`` (sorted hashes, eight bytes each) of each whole text."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(x.as_buffer().to_pybytes()) for x in batch.column(1)]
            digests = pa.array([digest(s) for s in sets], pa.int64())
            found = pa.array([s.tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), digests, found], ["id", "digest", "shingles"])

    rows = small_batches(docs).select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("text"))
    return rows.mapInArrow(encode, "id long, digest long, shingles binary")


def _runs(alike: int) -> list[tuple[tuple[int, ...], ...]]:
    """The byte positions in 10 - ``alike`` runs, two at a time."""
    return list(combinations([tuple(x.tolist()) for x in np.array_split(np.arange(BYTES), BYTES + 2 - alike)], 2))


def _key(run: tuple[tuple[int, ...], ...]) -> Column:
    mask = sum(0xFF << (8 * p) for part in run for p in part)
    return F.col("hash").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long"))


def _postings(hashes: DataFrame, keys: list[Column]) -> DataFrame:
    slots = [F.struct(F.lit(i).alias("slot"), key.alias("bucket")) for i, key in enumerate(keys)]
    return hashes.select("*", F.explode(F.array(*slots)).alias("s")).select("s.*", *hashes.columns)


_GROUP = ["slot", "bucket", "lo", "hi"]


def linked(hashes: DataFrame, most: int = 2, alike: int = BYTES - 2, block: int = 512) -> DataFrame:
    """Edges (a, b) that connect all ids whose hashes are near, through any number of links.

    ``hashes`` has one row per different hash: ``id`` and ``hash``. Two hashes are near if they share at least ``alike``
    bytes at their places (2 to 7) and differ in at most ``most`` bits. Differing in d bits leaves at least 8 - d bytes alike.

    The byte positions are cut into 10 - ``alike`` runs, of which a near pair shares at least two. The postings of the index are
    keyed by two runs at a time, so every near pair meets in a posting. In it the alike positional bytes of a pair are
    tallied, pairs below ``alike`` dropped, the rest verified. Each posting returns a spanning edge per id, not its
    pairs; a posting with more than ``block`` ids is worked in block pairs.
    """
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, group in complete_groups(batches, _GROUP):
            ids, bits, lo, hi, own = (rows.column(c).to_numpy() for c in ("id", "hash", "lo", "hi", "own"))
            found = []
            for left, right in close_rows(group, lo, hi, own):
                near = np.flatnonzero(_near(bits, left, right, most, alike)[0])
                if len(near):
                    found.append((left[near], right[near]))
            if found:
                left, right = (np.concatenate(x) for x in zip(*found))
                root = smallest_linked(ids, left, right)
                edge = np.flatnonzero(root != ids)
                yield pa.RecordBatch.from_arrays([pa.array(root[edge]), pa.array(ids[edge])], ["a", "b"])

    postings = _postings(hashes.select("id", "hash"), [_key(run) for run in _runs(alike)])
    return blocked(postings, block).mapInArrow(verify, "a long, b long")


def _near(bits: np.ndarray, left: np.ndarray, right: np.ndarray, most: int, alike: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether pairs of hashes are near, and which of their bytes are equal."""
    differ = (bits[left] ^ bits[right]).view(np.uint64)
    equal = differ.view(np.uint8).reshape(-1, BYTES) == 0
    return (equal.sum(axis=1) >= alike) & (np.bitwise_count(differ) <= most), equal


def linked_texts(nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, most: int, alike: int, similar: float,
                 block: int = 512) -> DataFrame:
    """Edges (a, b) that connect all texts whose five-word shingles have the Jaccard similarity ``similar`` or more.

    ``nodes`` has one row per different text: ``id``, ``hash``, ``sketch`` and ``digest``; ``docs`` has the texts. Candidates
    are near hashes (see ``linked``) and pairs that meet in one of 16 bands of four bytes of the sketch, by postings of the
    same kind. A pair at similarity s shares no band with chance (1 - s^4)^16: 0.0002 at 0.8. Pairs are dropped whose
    sketches show less than ``similar`` - 0.2; at 0.8 that drops a true pair with chance 0.00005. The rest is decided by
    whole shingle sets, each pair in the first posting it shares, so sets travel only to where a candidate is. Within a
    posting, pairs that verified links connect already are not looked at again.
    """
    runs = _runs(alike)
    least = int((similar - 0.2) * _SKETCH)
    keys = [F.xxhash64(F.substring("sketch", 4 * i + 1, 4)) for i in range(BANDS)] + [_key(run) for run in runs]
    columns = ["slot", "bucket", "lo", "hi", "own", "id", "digest", "hash", "sketch"]

    def candidates(rows: pa.Table, group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        bits, slot, lo, hi, own = (rows.column(c).to_numpy() for c in ("hash", "slot", "lo", "hi", "own"))
        marks = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(len(bits), -1)
        for left, right in close_rows(group, lo, hi, own):
            near, equal = _near(bits, left, right, most, alike)
            keep = np.flatnonzero(near | (slot[left] < BANDS))
            left, right, near, equal = left[keep], right[keep], near[keep], equal[keep]
            same = marks[left] == marks[right]
            keep = np.flatnonzero(same.sum(axis=1) >= least)
            if not len(keep):
                continue
            left, right, near, equal, same = left[keep], right[keep], near[keep], equal[keep], same[keep]
            met = [same.reshape(-1, BANDS, _SKETCH // BANDS).all(axis=2)]
            met += [(equal[:, [p for part in run for p in part]].all(axis=1) & near)[:, None] for run in runs]
            first = np.concatenate(met, axis=1).argmax(axis=1) == slot[left]
            yield left[first], right[first]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, group in complete_groups(batches, _GROUP):
            used = np.zeros(rows.num_rows, dtype=bool)
            for left, right in candidates(rows, group):
                used[left] = used[right] = True
            if used.any():
                yield from rows.filter(pa.array(used)).select(columns).to_batches()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, group in complete_groups(batches, _GROUP):
            ids = rows.column("id").to_numpy()
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("shingles")]
            label = list(range(len(ids)))

            def top(i: int) -> int:
                while label[i] != i:
                    label[i] = label[label[i]]
                    i = label[i]
                return i

            for left, right in candidates(rows, group):
                for i, j in zip(left.tolist(), right.tolist()):
                    a, b = top(i), top(j)
                    if a == b or min(len(sets[i]), len(sets[j])) < similar * max(len(sets[i]), len(sets[j])) - 1:
                        continue
                    both = np.intersect1d(sets[i], sets[j], assume_unique=True).size
                    if both / (len(sets[i]) + len(sets[j]) - both) >= similar:
                        label[max(a, b)] = min(a, b)
            root = ids[[top(i) for i in range(len(ids))]]
            edge = np.flatnonzero(root != ids)
            yield pa.RecordBatch.from_arrays([pa.array(root[edge]), pa.array(ids[edge])], ["a", "b"])

    shape = "slot int, bucket long, lo int, hi int, own int, id long, digest long, hash long, sketch binary"
    postings = _postings(nodes.select("id", "digest", "hash", "sketch"), keys)
    members = stage(blocked(postings, block).mapInArrow(meet, shape), "simhash-candidates")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    needed = texts.join(members.select("id").distinct(), "id", "left_semi")
    sets = shingle_sets(needed, "id", "text").dropDuplicates(["id", "digest"])
    whole = members.join(sets, ["id", "digest"]).repartition(*_GROUP).sortWithinPartitions(*_GROUP)
    return whole.mapInArrow(verify, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, most: int = 2,
                    alike: int = BYTES - 2, similar: float | None = None, block: int = 512) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, one row per row of ``docs``.

    Documents link if their fingerprints are near (see ``linked``); by default, if they differ in at most two bits. With
    ``similar``, they link if the Jaccard similarity of their five-word shingles is so large, and ``most`` and ``alike`` only say
    what is a candidate (see ``linked_texts``). A component is closed under links and named by its smallest id.

    NULL and empty texts and texts of white space have the fingerprint zero, and link like any other. Equal
    fingerprints (and shingles) are one node of the search, so copies cost one row each. Rows repeated with one id stay as
    they are; rows without an id are named NULL unless a document with an id links to them. An empty table gives an empty result. Other columns are ignored.
    """
    hashed = stage(with_simhash(docs, id_col, text_col, width, similar is not None), "simhash")
    nodes = stage(hashed.groupBy("hash", "sketch", "digest").agg(F.min("doc_id").alias("id")), "simhash-nodes")
    known = nodes.filter("id is not null")
    if similar is None:
        edges = linked(known, most, alike, block)
    else:
        edges = linked_texts(known, docs, id_col, text_col, most, alike, similar, block)
    roots = components(edges)
    named = nodes.join(roots, "id", "left").select("hash", "digest", F.coalesce("root", "id").alias("component_id"))
    same = (hashed.hash == named.hash) & hashed.digest.eqNullSafe(named.digest)
    return hashed.join(named, same).select(
        "doc_id", F.lower(F.lpad(F.hex(hashed.hash), 16, "0")).alias("fingerprint"), "component_id"
    )
