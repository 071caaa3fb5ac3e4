"""Removal of repeated byte strings by a column-wise collection index.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier (in a smaller document, or earlier in the
same one) is removed; strings are judged on the input and never cross documents.

Splitting the collection. Every window of LENGTH bytes names an anchor: the leftmost of its shortest-hash substrings
of ``GRAM`` bytes. Equal windows have the same anchor at the same place, so windows need comparing only within the
same anchor. Neighbouring windows with one anchor form a *read*: the bytes from the first window's start to the last
one's end, with the anchor at a known place. Anchors that occur once in the whole table are set aside at once; reads
with the same bytes are one read from then on, standing for its earliest occurrence.

Comparing. What remains are different reads around a common anchor. They are laid side by side with their anchors in
one column, and the collection index is built column by column from the right: each round inserts one symbol per
read, sorts the reads stably by that symbol (which orders them by the suffix that starts there, as in the
Burrows-Wheeler transform of the collection) and updates the common prefixes of neighbours: one more than the
smallest between them where the symbols agree, else zero. Runs with common prefixes of at least LENGTH are equal
windows, and all but the earliest are late. The index of a task covers the anchors of one shuffle partition, a bounded number of reads
at a time; Spark's sorted shuffle files are the external files that the rounds read in sequence.

An anchor with more than ``HOT`` different reads is split by the windows themselves: every window becomes a row with
a digest, whose earliest place is a minimum combined inside tasks.

Defined results: null texts count as empty; null ids come before all others; documents that share an id are ordered by a hash of
their text, rows that repeat id and text are one document and get the same result each; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiostar.llm.common import filter_bits, key_filter, mixed, passes, small_batches
from regiostar.session import discard, materialize

LENGTH, GRAM = 100, 32
REACH = LENGTH - GRAM  # the anchor lies at most so far right of a window's start
COLUMNS = REACH + LENGTH
CHUNK = 1 << 18
READS = 1 << 15
HOT = 1 << 15
SYMBOLS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
PLACE = np.uint64((1 << 24) - 1)


def anchors(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Key, anchor place, first and last window of every read of a document, one piece of the document at a time."""
    for at in range(0, len(data) - LENGTH + 1, CHUNK):
        part = data[at : at + CHUNK + LENGTH - 1]
        h = SYMBOLS[part]
        for step in (1, 2, 4, 8, 16):  # hashes of 2, 4, ... 32 bytes
            factor = np.uint64(pow(0x9E3779B97F4A7C15, step, 1 << 64))
            h = h[:-step] * factor + h[step:]
        h = mixed(h)
        low = (h & ~PLACE) | np.arange(len(h), dtype=np.uint64)
        width = REACH + 1
        reached = 1
        while reached * 2 <= width:
            low = np.minimum(low[:-reached], low[reached:])
            reached *= 2
        if reached < width:
            low = np.minimum(low[: len(low) - (width - reached)], low[width - reached :])
        places = (low & PLACE).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(places)) + 1])
        last = np.append(first[1:] - 1, len(places) - 1)
        yield h[places[first]].view(np.int64), places[first] + at, first + at, last + at


def _bytes(value) -> np.ndarray:
    """A text's bytes without a copy."""
    buffer = value.as_buffer() if value.is_valid else None
    return np.frombuffer(buffer, np.uint8) if buffer is not None and len(buffer) else np.zeros(0, np.uint8)


def named(docs: DataFrame) -> DataFrame:
    """doc (null ids smallest), h (hash of the text) and the text's bytes."""
    return docs.select(*_keys())


def repeated_anchors(docs: DataFrame) -> DataFrame:
    """key of every anchor with more than one occurrence."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[np.ndarray] = []
            for value in batch.column(0):
                held += [k for k, *_ in anchors(_bytes(value))]
            if held:
                found, n = np.unique(np.concatenate(held), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["key", "n"])

    counted = docs.select("data").mapInArrow(keys, "key long, n long")
    return counted.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key")


def places(key: np.ndarray, doc: np.ndarray, h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hashes that name reads by where they stand."""
    doc, h, first = (np.asarray(x, np.int64).view(np.uint64) for x in (doc, h, first))
    return mixed(key.view(np.uint64) ^ mixed(doc * np.uint64(0x9E3779B97F4A7C15) + h) ^ (first * np.uint64(0xD1B54A32D192ED03)))


def occurrences(docs: DataFrame, map_: np.ndarray, with_bytes: bool) -> DataFrame:
    """Reads that pass ``map_``: key, read (digest), doc, h, first, span, place; with the bytes if asked.

    ``span`` is the number of windows less one, ``place`` the distance from the first window to the anchor. The map is over mixed
    keys, with bytes over the names of ``places``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(map_)
    names = ["key", "read", "doc", "h", "first", "span", "place"] + ["bytes"] * with_bytes

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bit_map = shared.value
        numbers: list[tuple] = []
        digests: list[bytes] = []
        pieces: list[bytes] = []

        def flush() -> pa.RecordBatch:
            key, doc, h, first, span, place = (np.concatenate(x) for x in zip(*numbers, strict=True))
            columns = [key, pa.array(digests, pa.binary()), doc, h, first, span.astype(np.int32), place.astype(np.int32)]
            columns += [pa.array(pieces, pa.binary())] * with_bytes
            for held in (numbers, digests, pieces):
                held.clear()
            return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

        for batch in batches:
            for doc, h, value in zip(batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2), strict=True):
                data = _bytes(value)
                raw = memoryview(data)
                for key, place, first, last in anchors(data):
                    name = places(key, np.array([doc]), np.array([h]), first) if with_bytes else mixed(key.view(np.uint64))
                    here = np.flatnonzero(passes(bit_map, name))
                    if not len(here):
                        continue
                    key, place, first, last = key[here], place[here], first[here], last[here]
                    found = [raw[a:b] for a, b in zip(first.tolist(), (last + LENGTH).tolist(), strict=True)]
                    digests += map(xxhash.xxh3_128_digest, found)
                    if with_bytes:
                        pieces += map(bytes, found)
                    numbers.append((key, np.full(len(key), doc), np.full(len(key), h), first, last - first, place - first))
                    if len(digests) >= 8192:
                        yield flush()
            if digests:
                yield flush()

    schema = "key long, read binary, doc long, h long, first long, span int, place int" + (", bytes binary" if with_bytes else "")
    return docs.mapInArrow(find, schema)


def late_windows(bytes_: list[bytes], place: np.ndarray, span: np.ndarray, age: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For reads with anchors in one column, which windows (read by column) also start earlier in another read.

    ``age`` ranks the reads by their earliest occurrence.
    """
    n = len(bytes_)
    sizes = span.astype(np.int64) + length
    table = np.zeros((COLUMNS, n), np.uint8)
    start = REACH - place.astype(np.int64)
    flat = np.frombuffer(b"".join(bytes_), np.uint8)
    owner = np.repeat(np.arange(n), sizes)
    offset = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    table[start[owner] + offset, owner] = flat
    order = np.arange(n)
    common = np.zeros(n, np.uint8)  # common prefix with the one before, at most COLUMNS
    late = np.zeros((n, REACH + 1), bool)
    for column in range(COLUMNS - 1, -1, -1):
        symbols = table[column][order]
        rank = np.argsort(symbols, kind="stable")
        least = _between(common, rank)
        sorted_symbols = symbols[rank]
        same = np.concatenate([[False], sorted_symbols[1:] == sorted_symbols[:-1]])
        common = np.where(same, least + np.uint8(1), np.uint8(0)).astype(np.uint8)
        order = order[rank]
        if column <= REACH:
            offset_here = column - start[order]
            valid = (offset_here >= 0) & (offset_here <= span[order])
            begins = np.flatnonzero(common < length)
            ages = np.where(valid, age[order], n)
            earliest = np.minimum.reduceat(ages, begins)
            runs = np.cumsum(common < length) - 1
            late[order, column] = valid & (ages > earliest[runs])
    return late


def _between(common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For neighbours in the new order that kept their old order, the smallest common prefix between them there."""
    n = len(common)
    left = np.concatenate([[0], rank[:-1]])
    low, high = np.minimum(left + 1, n - 1), rank  # entries low..high of the old order
    length = np.maximum(high - low + 1, 1)
    level = np.frexp(length.astype(np.float64))[1] - 1
    out = np.zeros(n, np.uint8)
    table, width = common, 1
    for k in range(int(level.max(initial=0)) + 1):
        at = np.flatnonzero(level == k)
        if len(at):
            a, b = low[at], np.maximum(high[at] - width + 1, 0)
            top = len(table) - 1
            out[at] = np.minimum(table[np.minimum(a, top)], table[np.minimum(b, top)])
        if len(table) > width:
            table = np.minimum(table[:-width], table[width:])
        width *= 2
    return out


def late_reads(reads: DataFrame) -> DataFrame:
    """key, read, mask (bits of late windows, from the read's first) of reads with late windows.

    ``reads``: key, read, doc, h, first, span, place, bytes; different reads of keys with several.
    """

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            while len(batch):
                keys = batch.column(0).to_numpy()
                if rows >= READS and held and held[-1].column(0)[len(held[-1]) - 1].as_py() != keys[0]:
                    yield _late(held)
                    held, rows = [], 0
                cut = len(batch)
                if rows + cut > READS:  # up to the end of the key that reaches the bound
                    near = max(0, READS - rows - 1)
                    other = np.flatnonzero(keys[near:] != keys[near])
                    cut = near + int(other[0]) if len(other) else cut
                held.append(batch.slice(0, cut))
                rows += cut
                batch = batch.slice(cut)
        if held:
            yield _late(held)

    dealt = reads.repartition("key").sortWithinPartitions("key")
    return dealt.select("key", "read", "doc", "h", "first", "span", "place", "bytes").mapInArrow(index, "key long, read binary, mask binary")


def _late(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(held)
    doc, h, first, span, place = (table.column(c).to_numpy() for c in ("doc", "h", "first", "span", "place"))
    age = np.empty(len(doc), np.int64)
    age[np.lexsort((first + place, h, doc))] = np.arange(len(doc))
    late = late_windows(table.column("bytes").to_pylist(), place, span, age)
    at = np.flatnonzero(late.any(axis=1))
    masks = [np.packbits(late[i, REACH - place[i] : REACH - place[i] + span[i] + 1]).tobytes() for i in at]
    key, read = table.column("key").combine_chunks(), table.column("read").combine_chunks()
    return pa.RecordBatch.from_arrays([key.take(pa.array(at)), read.take(pa.array(at)), pa.array(masks, pa.binary())], ["key", "read", "mask"])


def late_hot_reads(reads: DataFrame) -> DataFrame:
    """The same for anchors with very many different reads: windows are grouped by their own digests."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for key, read, doc, h, first, span, data in zip(*(batch.column(c).to_pylist() for c in ("key", "read", "doc", "h", "first", "span", "bytes")), strict=True):
                rows += [(key, read, xxhash.xxh3_128_digest(data[i : i + LENGTH]), doc, h, first + i, i) for i in range(span + 1)]
            columns = zip(*rows, strict=True)
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["key", "read", "window", "doc", "h", "at", "i"])

    windows = reads.select("key", "read", "doc", "h", "first", "span", "bytes").mapInArrow(
        explode, "key long, read binary, window binary, doc long, h long, at long, i int"
    )
    place = F.struct("doc", "h", "at")
    windows = materialize(windows, "hot-windows")
    first = windows.groupBy("window").agg(F.min(place).alias("earliest"), F.count("*").alias("n")).where("n > 1")
    late = windows.join(first, "window").where(place > F.col("earliest")).groupBy("key", "read").agg(F.collect_set("i").alias("late"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = []
            for found in batch.column(2).to_pylist():
                bits = np.zeros(REACH + 1, bool)
                bits[found] = True
                masks.append(np.packbits(bits).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(masks, pa.binary())], ["key", "read", "mask"])

    return late.mapInArrow(pack, "key long, read binary, mask binary")


def covered(docs: DataFrame) -> DataFrame:
    """doc, h, parts (first, span, mask) of every document with late windows; without a mask all windows are late."""
    keys = materialize(repeated_anchors(docs), "repeated-anchors")
    found = materialize(occurrences(docs, _mixed_filter(keys), with_bytes=False), "reads")
    discard(keys)
    at = F.struct("doc", "h", "first").alias("at")
    reads = found.groupBy("key", "read").agg(F.min(at).alias("at"), F.first("span").alias("span"), F.first("place").alias("place"), F.count("*").alias("n"))
    reads = materialize(reads, "distinct-reads")
    contested = reads.groupBy("key").agg(F.count("*").alias("kinds")).where("kinds > 1")
    contested = materialize(reads.join(contested, "key").select("key", "read", "at", "span", "place", "kinds"), "contested-reads")

    with_bytes = occurrences(docs, _place_filter(contested), with_bytes=True)
    joined = with_bytes.join(contested.select("key", "read", "at", "kinds"), ["key", "read"]).where(F.struct("doc", "h", "first") == F.col("at"))
    # A row that repeats id and text has the same reads at the same places.
    needed = materialize(joined.drop("at").dropDuplicates(["key", "read"]), "reads-with-bytes")
    late = late_reads(needed.where(F.col("kinds") <= HOT)).union(late_hot_reads(needed.where(F.col("kinds") > HOT)))
    late = materialize(late, "late-windows")
    discard(needed, contested)

    judged = reads.where("n > 1").select("key", "read", "at").join(late, ["key", "read"], "full_outer")
    judged = materialize(judged, "judged-reads")
    discard(reads, late)
    hits = found.join(judged, ["key", "read"])
    # The earliest occurrence loses the windows of its mask, every other one loses all.
    earliest = F.col("at").isNull() | (F.struct("doc", "h", "first") == F.col("at"))
    hits = hits.where(~earliest | F.col("mask").isNotNull())
    part = F.struct("first", "span", F.when(earliest, F.col("mask")).alias("mask"))
    return hits.groupBy("doc", "h").agg(F.collect_set(part).alias("parts"))


def _mixed_filter(keys: DataFrame) -> np.ndarray:
    """Keys are the smallest hashes of their windows; they are mixed again to spread over the filter."""

    def mix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(mixed(batch.column(0).to_numpy().view(np.uint64)).view(np.int64))], ["key"])

    return key_filter(keys.mapInArrow(mix, "key long"), "key", filter_bits(keys.count()))


def _place_filter(reads: DataFrame) -> np.ndarray:
    """A filter over where the reads' earliest occurrences stand."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(places(*(c.to_numpy() for c in batch.columns)).view(np.int64))], ["name"])

    at = reads.select("key", "at.doc", "at.h", "at.first")
    return key_filter(at.mapInArrow(name, "name long"), "name", filter_bits(reads.count()))


def removed_spans(parts: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal removed runs [start, end) of a document from its late windows."""
    spans: list[tuple[int, int]] = []
    for part in parts or ():
        first, span = part["first"], part["span"]
        if part["mask"] is None:
            spans.append((first, first + span + LENGTH))
            continue
        bits = np.unpackbits(np.frombuffer(part["mask"], np.uint8))[: span + 1]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], bits, [0]])))
        spans += [(first + int(a), first + int(b) - 1 + LENGTH) for a, b in zip(edges[::2], edges[1::2], strict=True)]
    merged: list[list[int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return [(a, b) for a, b in merged]


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (start, end in bytes), kept (the remaining bytes) of every row of ``docs``."""
    small_batches(docs.sparkSession)
    data = named(docs)
    parts = covered(data)
    joined = docs.select("doc_id", *_keys()).join(
        parts.withColumnRenamed("doc", "p_doc").withColumnRenamed("h", "p_h"), (F.col("doc") == F.col("p_doc")) & (F.col("h") == F.col("p_h")), "left"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, spans, kept = [], [], [], []
            for value, found in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                raw = value.as_py()
                runs = removed_spans(found)
                n.append(len(raw))
                gone.append(sum(b - a for a, b in runs))
                spans.append([{"start": a, "end": b} for a, b in runs])
                edges = [0, *[x for run in runs for x in run], len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    schema = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"
    return joined.select(F.col("doc_id").cast("long"), "data", "parts").mapInArrow(cut, schema)


def _keys():
    text = F.coalesce("text", F.lit(""))
    return (
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc"), F.xxhash64(text).alias("h"), text.cast("binary").alias("data"),
    )


def digested(found: DataFrame) -> DataFrame:
    """Counts and a digest in place of spans and bytes."""
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
