"""Exact repeats of long byte strings: content anchors, then suffix arrays by two-stage sorting."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchloom.llm.common import complete_groups, small_batches, text_bytes
from matchloom.session import stage

GRAM = 32  # bytes of an anchor
CHUNK = 1 << 20  # bytes worked at once
PLACE = np.uint64((1 << 24) - 1)
HOT = 4096  # different regions of one anchor above which they are split by offset
RANGE = 16  # offsets of a split
KEY = ["id", "print"]


# ---------------------------------------------------------------- suffix array

def suffix_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor. ``text`` ends in its smallest value."""
    differs = np.flatnonzero(text[:-1] != text[1:])
    at = np.searchsorted(differs, np.arange(len(text) - 1))
    low = np.zeros(len(text), dtype=bool)
    known = at < len(differs)
    place = differs[at[known]]
    low[:-1][known] = text[place] < text[place + 1]
    return low


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one big-endian number."""
    view = np.lib.stride_tricks.sliding_window_view(data, 8)
    return np.ascontiguousarray(view).view(">u8")[:, 0].astype(np.uint64)


def sort_directly(words: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """``places`` sorted by the ``depth`` bytes that follow, eight bytes a round; only ties stay in the game."""
    first = words[places]
    order = places[np.argsort(first, kind="stable")]
    value = words[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = value[1:] != value[:-1]
    live, group = _ties(np.arange(len(order)), new)
    for done in range(8, depth, 8):
        if not len(live):
            break
        value = words[order[live] + done]
        turn = np.lexsort((value, group))
        order[live] = order[live][turn]
        value = value[turn]
        new = np.ones(len(live), dtype=bool)
        new[1:] = (value[1:] != value[:-1]) | (group[1:] != group[:-1])
        live, group = _ties(live, new)
    return order


def _ties(live: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    group = np.cumsum(new)
    more = np.bincount(group)[group] > 1 if len(group) else new
    return live[more], group[more]


def two_stage(text: np.ndarray, words: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The ``wanted`` suffixes in the order of their first ``depth`` bytes.

    Suffixes smaller than their successors are sorted directly. The others are induced: buckets by first byte are
    scanned upwards, and each suffix found puts the one before it, if that is greater, at the end of its bucket's
    front part. ``text`` has -1 after each region; ``wanted`` must hold, for each greater suffix, its successor too.
    """
    small = suffix_types(text)
    places = np.flatnonzero(wanted & small)
    direct = sort_directly(words, places, depth)
    heads = text[direct]
    great = wanted & ~small & (text >= 0)
    waiting: dict[int, list[np.ndarray]] = {}
    sorted_out = []
    none = np.zeros(0, dtype=direct.dtype)
    ends = np.flatnonzero(wanted & (text < 0))
    for value in range(-1, 256):
        if value < 0:
            bucket = ends
        else:
            front = [np.concatenate(waiting.pop(value))] if value in waiting else [none]
            while len(front[-1]):  # runs of one byte grow by a byte a wave
                before = front[-1] - 1
                before = before[before >= 0]
                front.append(before[great[before] & (text[before] == value)])
            low, high = np.searchsorted(heads, (value, value + 1))
            bucket = np.concatenate([*front, direct[low:high]])
            sorted_out.append(bucket)
        before = bucket - 1
        before = before[before >= 0]
        before = before[great[before] & (text[before] > value)]
        if len(before):
            at = text[before]
            before = before[np.argsort(at, kind="stable")]
            at = text[before]
            cuts = np.flatnonzero(at[1:] != at[:-1]) + 1
            for part in np.split(before, cuts):
                waiting.setdefault(int(text[part[0]]), []).append(part)
    return np.concatenate(sorted_out)


def common_prefix(words: np.ndarray, left: np.ndarray, right: np.ndarray, most: int) -> np.ndarray:
    """Bytes that the suffixes at left and right share at their start, counted up to ``most``."""
    shared = np.zeros(len(left), dtype=np.int64)
    live = np.arange(len(left))
    for done in range(0, most, 8):
        if not len(live):
            break
        differ = words[left[live] + done] ^ words[right[live] + done]
        same = differ == 0
        rest = live[~same]
        top = differ[~same]
        zeros = np.zeros(len(top), dtype=np.int64)
        for byte in range(1, 8):
            zeros += (top >> np.uint64(64 - 8 * byte)) == 0
        shared[rest] = done + zeros
        live = live[same]
    shared[live] = most
    return np.minimum(shared, most)


def repeated_starts(regions: list[bytes], owned: np.ndarray, width: int) -> list[np.ndarray]:
    """For each region, which of its first ``owned`` places start a ``width``-byte string found at another such place."""
    sizes = np.array([len(r) for r in regions], dtype=np.int64)
    firsts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    flat = np.frombuffer(b"\0".join(regions) + bytes(width + 17), dtype=np.uint8)
    size = int(firsts[-1] + sizes[-1] + 1)
    text = flat[:size].astype(np.int16)
    text[firsts + sizes] = -1
    words = eights(flat)
    own = np.zeros(size + 1, dtype=np.int32)
    np.add.at(own, firsts, 1)
    np.add.at(own, firsts + owned, -1)
    own = np.cumsum(own[:-1]) > 0
    # Beyond the owned places as far as a greater suffix needs its successor.
    stops = np.flatnonzero(suffix_types(text) | (text < 0))
    upto = stops[np.searchsorted(stops, firsts + owned - 1)]
    wanted = np.zeros(size + 1, dtype=np.int32)
    np.add.at(wanted, firsts, 1)
    np.add.at(wanted, upto + 1, -1)
    wanted = np.cumsum(wanted[:-1]) > 0
    order = two_stage(text, words, wanted, width)
    order = order[own[order]]
    same = common_prefix(words, order[:-1], order[1:], width) >= width
    hit = np.zeros(size, dtype=bool)
    hit[order[:-1][same]] = True
    hit[order[1:][same]] = True
    return [hit[f:f + n] for f, n in zip(firsts, owned)]


# ---------------------------------------------------------------- anchors

_RANDOM = np.random.default_rng(3)
_BYTE = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place on."""
    h, step = _BYTE[data], 1
    while step < GRAM:
        h = h[:-step] * np.uint64(pow(_BASE, step, 1 << 64)) + h[step:]
        step *= 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def anchored_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int):
    """Windows of ``width`` bytes grouped by their anchor: arrays (document, first, last, anchor, hash).

    The anchor of a window is the leftmost of its grams with the smallest hash, so equal windows have equal anchors at equal
    offsets. ``starts`` and ``ends`` bound the documents in ``data``; first and last are places of windows.
    """
    span = width - GRAM + 1
    if len(data) < width:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4)) + (np.zeros(0, dtype=np.uint64),)
    hashes = gram_hashes(data)
    least = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64)
    step = 1
    while 2 * step <= span:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < span:
        least = np.minimum(least[:step - span], least[span - step:])
    anchor = (least & PLACE).astype(np.int64)
    valid = np.zeros(len(data) + 1, dtype=np.int32)
    long = ends - starts >= width
    np.add.at(valid, starts[long], 1)
    np.add.at(valid, ends[long] - width + 1, -1)
    valid = np.cumsum(valid[:-1])[:len(anchor)] > 0
    change = np.ones(len(anchor), dtype=bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    first = np.flatnonzero(valid & change)
    stop = np.flatnonzero(np.concatenate([change[1:] | ~valid[1:], [True]]) & valid)
    doc = np.searchsorted(starts, first, side="right") - 1
    return doc, first, stop, anchor[first], hashes[anchor[first]]


def _pieces(texts: list[bytes], width: int) -> Iterator[tuple[bytes, list[tuple[int, int, int]]]]:
    """Texts joined to at most CHUNK bytes, with (text, place in the text, size) of each part.

    Longer texts come in parts that overlap so that each window is whole in exactly one of them.
    """
    held, parts, size = [], [], 0
    for number, text in enumerate(texts):
        for place in range(0, max(1, len(text) - width + 1), CHUNK):
            part = text[place:place + CHUNK + width - 1] if len(text) > CHUNK else text
            if size and size + len(part) > CHUNK:
                yield b"".join(held), parts
                held, parts, size = [], [], 0
            held.append(part)
            parts.append((number, place, len(part)))
            size += len(part)
    if held:
        yield b"".join(held), parts


def _keyed(docs: DataFrame, id_col: str, text_col: str, keep: list[str]) -> DataFrame:
    """Texts as bytes under a key that tells rows with one id but other texts apart; columns to keep as k0, k1, …"""
    data = text_bytes(text_col)
    return small_batches(docs).select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias("id"),
        F.xxhash64(F.col(id_col).isNull(), data).alias("print"), data.alias("data"),
        *(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)),
    )


def _anchors(keyed: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(first, 256) for b in batches for first in range(0, b.num_rows, 256)):
            ids, prints = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            texts = [x.as_buffer().to_pybytes() for x in batch.column(2)]
            for joined, parts in _pieces(texts, width):
                number, place, size = (np.array(x, dtype=np.int64) for x in zip(*parts))
                ends = np.cumsum(size)
                starts = ends - size
                doc, first, last, anchor, hashes = anchored_runs(np.frombuffer(joined, np.uint8), starts, ends, width)
                if not len(doc):
                    continue
                view = memoryview(joined)
                digest = xxhash.xxh3_64_intdigest
                region = np.fromiter(
                    (digest(view[f:e], s) for f, e, s in zip(first.tolist(), (last + width).tolist(), (anchor - first).tolist())),
                    dtype=np.uint64, count=len(first),
                )
                move = place[doc] - starts[doc]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[number[doc]]), pa.array(prints[number[doc]]), pa.array(hashes.view(np.int64)),
                    pa.array(region.view(np.int64)),
                    *(pa.array((x + move).astype(np.int32)) for x in (first, last, anchor)),
                ], ["id", "print", "anchor", "region", "first", "last", "at"])

    # Shorter texts have no window; they need not cross to Python.
    return keyed.filter(F.length("data") >= width).select("id", "print", "data").mapInArrow(
        run, "id long, print long, anchor long, region long, first int, last int, at int"
    )


# ---------------------------------------------------------------- repeats

def repeated_windows(keyed: DataFrame, width: int) -> DataFrame:
    """``id``, ``print``, ``first``, ``last``: runs of places where a repeated ``width``-byte string starts."""
    found = stage(_anchors(keyed, width), "anchors")
    classes = found.groupBy("anchor").agg(
        F.count("*").alias("n"), F.min("region").alias("low"), F.max("region").alias("high")
    ).filter("n > 1").select("anchor", (F.col("low") == F.col("high")).alias("alike"))
    shared = stage(found.join(classes, "anchor"), "shared-anchors")
    mixed = shared.filter("not alike")
    # One row per different region; those that occur more than once are repeats as they are.
    heads = stage(
        mixed.groupBy("anchor", "region").agg(
            F.min(F.struct(*KEY, "first", "last", "at")).alias("head"), F.count("*").alias("n")
        ), "regions",
    )
    hot = heads.groupBy("anchor").agg(F.count("*").alias("regions")).filter(F.col("regions") > HOT).select("anchor")
    parts = heads.join(hot.withColumn("hot", F.lit(True)), "anchor", "left").select(
        "head.*", "anchor", F.coalesce("hot", F.lit(False)).alias("hot"), (F.col("n") > 1).alias("known")
    )
    spots = parts.groupBy(*KEY).agg(F.collect_list(F.struct("anchor", "first", "last", "at", "hot")).alias("spots"))
    # The texts are shuffled to their spots once, for both ways.
    cut = stage(_cut(keyed.select(*KEY, "data").join(spots, KEY), width), "cut")
    runs = [
        shared.filter("alike").select(*KEY, "first", "last"),
        _same_regions(mixed).select(*KEY, "first", "last"),
        _sorted_runs(cut.filter("part is null"), width),
    ]
    if not hot.isEmpty():
        runs.append(_split_runs(cut.filter("part is not null")))
    out = runs[0]
    for more in runs[1:]:
        out = out.unionByName(more)
    return out


def _same_regions(places: DataFrame, salts: int = 64) -> DataFrame:
    """Places whose region occurs at another place of their anchor as well.

    Places are counted by region within a salt, and then those that are first in their salt, at most ``salts`` of a region, across
    salts. So a region at most places of all is spread over tasks, and no place meets more than a count.
    """
    of = ["anchor", "region"]
    salted = places.withColumn("salt", F.pmod(F.xxhash64(*KEY, "first"), F.lit(salts)))
    within = W.partitionBy(*of, "salt")
    counted = salted.withColumn("n", F.count("*").over(within)).withColumn(
        "turn", F.row_number().over(within.orderBy(*KEY, "first"))
    )
    firsts = W.partitionBy(*of, F.when(F.col("turn") == 1, -1).otherwise(F.col("salt")))
    return counted.withColumn("across", F.count("*").over(firsts)).filter((F.col("n") > 1) | (F.col("across") > 1))


_RUNS = "id long, print long, first int, last int"


def _cut(found: DataFrame, width: int) -> DataFrame:
    """The regions of anchors; of those with very many different regions, hashes by offset instead."""
    names = ["anchor", *KEY, "first", "last", "bytes", "part", "core", "whole", "windows"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.int64(), pa.int64(),
             pa.list_(pa.int64())]

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, (key, mark, data, spots) in enumerate(zip(*batch.columns)):
                data = memoryview(data.as_buffer())
                for s in spots.as_py():
                    head = (s["anchor"], key.as_py(), mark.as_py())
                    if s["hot"]:
                        rows += [(*head, first, last, None, *rest) for first, last, *rest in _offsets(data, s, width)]
                    else:
                        rows.append((*head, s["first"], s["last"], bytes(data[s["first"]:s["last"] + width]), None, None, None, None))
                if rows and (len(rows) > 4000 or i + 1 == batch.num_rows):
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                    rows = []

    return found.select(*KEY, "data", "spots").mapInArrow(
        take, "anchor long, id long, print long, first int, last int, bytes binary, part int, core long, whole long, windows array<long>"
    )


def _sorted_runs(cut: DataFrame, width: int) -> DataFrame:
    """Repeats among the regions of one anchor, by suffix arrays of anchors worked together."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, group in complete_groups(batches, ["anchor"]):
            regions = rows.column("bytes").to_pylist()
            sizes = np.cumsum([len(r) for r in regions])
            ends = np.append(np.flatnonzero(group[1:] != group[:-1]) + 1, len(group))
            begin = 0
            while begin < len(group):
                limit = (sizes[begin - 1] if begin else 0) + CHUNK
                fits = ends[(ends > begin) & (sizes[ends - 1] <= limit)]
                end = int(fits[-1]) if len(fits) else int(ends[ends > begin][0])
                yield from _runs(rows.slice(begin, end - begin), regions[begin:end], width)
                begin = end

    return cut.select("anchor", *KEY, "first", "last", "bytes").repartition("anchor").sortWithinPartitions("anchor").mapInArrow(find, _RUNS)


def _runs(rows: pa.Table, regions: list[bytes], width: int) -> Iterator[pa.RecordBatch]:
    ids, prints, first, last = (rows.column(c).to_numpy() for c in ("id", "print", "first", "last"))
    out = []
    for i, hit in enumerate(repeated_starts(regions, (last - first + 1).astype(np.int64), width)):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
        out += [(ids[i], prints[i], first[i] + a, first[i] + b - 1) for a, b in zip(edge[::2], edge[1::2])]
    if out:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(c), k) for c, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
            [*KEY, "first", "last"],
        )


def _split_runs(rows: DataFrame) -> DataFrame:
    """The same for anchors with very many different regions, whatever their number.

    Windows are split by their offset from the anchor, ``RANGE`` offsets a row. The bytes that all windows of a row
    share must be found in another row, or none of the windows is repeated. Rows alike as a whole are repeats. Only
    for the rest the windows are counted one by one, by hashes. All counts combine within tasks first.
    """
    at = ["anchor", "part", "core"]
    cores = rows.groupBy(*at).agg(F.count("*").alias("n"), F.min("whole").alias("low"), F.max("whole").alias("high")).filter("n > 1")
    rows = rows.join(cores.select(*at, (F.col("low") == F.col("high")).alias("alike")), at)
    alike = rows.filter("alike").select(*KEY, "first", "last")
    single = rows.filter("not alike").select("anchor", *KEY, "first", F.posexplode("windows").alias("step", "window"))
    twice = single.groupBy("anchor", "window").agg(F.count("*").alias("n")).filter("n > 1").select("anchor", "window")
    place = F.col("first") + F.col("step")
    return alike.unionByName(single.join(twice, ["anchor", "window"]).select(*KEY, place.alias("first"), place.alias("last")))


def _offsets(data: memoryview, spot: dict, width: int) -> Iterator[tuple]:
    digest = xxhash.xxh3_64_intdigest

    def signed(value: int) -> int:
        return value - (1 << 64) if value >> 63 else value

    at = spot["at"]
    for part in range((at - spot["last"]) // RANGE, (at - spot["first"]) // RANGE + 1):
        first, last = max(spot["first"], at - part * RANGE - RANGE + 1), min(spot["last"], at - part * RANGE)
        core = data[at - part * RANGE:at - part * RANGE - RANGE + 1 + width]
        yield (
            first, last, part, signed(digest(core)), signed(digest(data[first:last + width], at - first)),
            [signed(digest(data[p:p + width], at - p)) for p in range(first, last + 1)],
        )


def merge_runs(first: np.ndarray, last: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Byte spans covered by windows that start from first to last; touching spans are one."""
    if not len(first):
        return []
    order = np.argsort(first, kind="stable")
    begin, end = first[order], np.maximum.accumulate(last[order] + width)
    new = np.append(True, begin[1:] > end[:-1])
    return list(zip(begin[new].tolist(), end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)].tolist()))


def remove_repeats(docs: DataFrame, width: int = 400, id_col: str = "doc_id", text_col: str = "text",
                   keep: list[str] | None = None, as_text: bool = False) -> DataFrame:
    """Every row of ``docs`` with its repeated bytes removed.

    Returns ``doc_id``, ``n_bytes``, ``spans`` (begin, end of each maximal removed run), ``kept`` (the remaining bytes; with
    ``as_text`` a string, without characters of which a part has gone) and the columns ``keep``. A byte goes if a ``width``-byte string over it also starts anywhere else, in the same document or another; all copies
    go, and overlaps count. Strings are judged on the input.

    Windows are keyed by a content anchor, the least hashed gram in them, so equal windows meet under equal anchors. Anchors
    that occur once are done; an anchor whose surroundings are alike at every place is a repeat as it is. All
    others have the different surroundings suffix-sorted by two stages, and adjacent common prefixes tell the repeats.

    NULL texts are empty; texts shorter than ``width`` keep everything. Rows repeated with one id and text are copies
    of each other; rows with one id and other texts are documents of their own. NULL ids are kept. An empty table
    gives an empty result.
    """
    keep = keep or []
    keyed = _keyed(docs, id_col, text_col, keep)
    runs = repeated_windows(keyed, width).groupBy(*KEY).agg(
        F.collect_list("first").alias("first"), F.collect_list("last").alias("last")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(first, 256) for b in batches for first in range(0, b.num_rows, 256)):
            rows = []
            for doc, data, first, last in zip(*batch.columns[:4]):
                data = data.as_buffer().to_pybytes()
                spans = []
                if first.is_valid:
                    spans = merge_runs(np.array(first.as_py(), dtype=np.int64), np.array(last.as_py(), dtype=np.int64), width)
                edges = [0, *(x for span in spans for x in span), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                kept = kept.decode("utf-8", "ignore") if as_text else kept
                rows.append((doc.as_py(), len(data), [{"begin": a, "end": b} for a, b in spans], kept))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, k) for c, k in zip(zip(*rows), out)), *batch.columns[4:]],
                ["doc_id", "n_bytes", "spans", "kept", *names],
            )

    spans_kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    out = [pa.int64(), pa.int64(), spans_kind, pa.string() if as_text else pa.binary()]
    names = [f"k{i}" for i in range(len(keep))]
    joined = keyed.join(runs, KEY, "left").select("doc_id", "data", "first", "last", *names)
    more = "".join(f", {n} {t}" for n, t in joined.dtypes[4:])
    done = joined.mapInArrow(cut, f"doc_id long, n_bytes long, spans array<struct<begin:long,end:long>>, kept {'string' if as_text else 'binary'}{more}")
    return done.select("doc_id", "n_bytes", "spans", "kept", *(F.col(n).alias(c) for n, c in zip(names, keep)))


def digest_removed(removed: DataFrame) -> DataFrame:
    """Counts and the SHA-256 of what is left, per row of ``remove_repeats``."""
    return removed.select(
        "doc_id", "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["begin"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
