"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed pattern of compared and ignored positions. Every seed is laid over every position of the benchmark
items and of the documents, and the words under its compared positions are hashed together; a substituted word under
an ignored position leaves the hash as it is. Equal hashes are joined, which gives (document, item, offset) diagonals.
Around every hit the words of document and item are then compared one by one: an overlap is a stretch of a diagonal
covered by windows of ``PASSAGE`` to ``WINDOW`` words (the whole item if it is shorter) of which at least ``IDENTITY``
agree, found within ``MARGIN`` words of the hits.

The seeds lose no such window. Cut into blocks, a window has more blocks than substituted words may touch, so some
blocks stay intact, and every choice of blocks that may be left is a seed. Windows of 15 or more words with up to 3
substitutions (5 blocks of 3 words; 20 words with 4: 6 blocks), of 12 with 2 (4 blocks) and of 9 with 1 (3 blocks)
keep two blocks of three words: seeds are two such blocks at a distance. Windows of 10 words with 2 and of 8 with 1
keep three of their blocks of two words, those of 5 or 6 words with 1 all words but one.

Documents are not shuffled. Their hashes first pass a bit map of the benchmark's hashes whose size is bounded; only
positions that pass, with the word hashes around them, go to the join, which is exact.

Items of fewer than ``LEAST_WORDS`` words are never reported.

Defined results: null and empty texts have no overlaps; ``overlaps`` leaves out rows with a null id, ``clean`` judges
every row by its own id and text, null ids included; repeated documents and items are judged each, a pair of ids gives one row; empty tables give an empty result; other
columns, clashing names included, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiostar.llm.common import WordHashes, filter_bits, key_filter, mixed, passes, small_batches, words
from regiostar.llm.weighted_minhash import row_key
from regiostar.session import materialize

LEAST_WORDS = 5
PASSAGE = 13
WINDOW = 20
IDENTITY = 0.8
MARGIN = 48

#: Seeds as (words in a block, starts of the blocks compared).
TRIPLES = [(3, (0, 3 * gap)) for gap in range(1, 6)]
PAIRS = [(2, (0, 2 * a, 2 * b)) for b in range(2, 5) for a in range(1, b)]
ALL_BUT_ONE = {n: [(1, tuple(i for i in range(n) if i != out)) for out in range(1, n)] for n in (5, 6)}
SHAPES = TRIPLES + PAIRS + ALL_BUT_ONE[5] + ALL_BUT_ONE[6]
SPANS = [starts[-1] + size for size, starts in SHAPES]


def block_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` words from every position on."""
    n = max(0, len(hashes) - size + 1)
    total = np.zeros(n, np.uint64)
    for offset in range(size):
        total *= np.uint64(0x100000001B3 * 0x10001 + 0xD6)
        total += hashes[offset : offset + n]
    return total if size == 1 else mixed(total)


def seed_hashes(hashes: np.ndarray, shapes: list[int]) -> list[np.ndarray]:
    """The hashes of each shape at every position where it fits."""
    blocks = {size: block_hashes(hashes, size) for size in {SHAPES[i][0] for i in shapes}}
    out = []
    for shape in shapes:
        size, starts = SHAPES[shape]
        n = max(0, len(hashes) - SPANS[shape] + 1)
        total = np.full(n, (shape + 1) * 0x9E3779B97F4A7C15 % 2**64, np.uint64)
        for start in starts:
            total *= np.uint64(0x100000001B3 * 0x10001 + 0xD6)
            total += blocks[size][start : start + n]
        out.append(mixed(total))
    return out


def item_shapes(length: int) -> list[int]:
    """The seeds that together hit every window of an item that may agree."""
    if length >= 12 or length == 9:
        family = TRIPLES
    elif length >= 8:
        family = PAIRS
    else:
        family = ALL_BUT_ONE[min(length, 6)] if length >= LEAST_WORDS else []
    return [SHAPES.index(shape) for shape in family if shape[1][-1] + shape[0] <= length]


def benchmark_seeds(items: DataFrame) -> DataFrame:
    """item_id, length, shape, at, key of every seed of every item."""

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                hashes = known.of(words(text.as_py()))
                shapes = item_shapes(len(hashes))
                for shape, found in zip(shapes, seed_hashes(hashes, shapes), strict=True):
                    keys = found.view(np.int64)
                    n = len(keys)
                    yield pa.RecordBatch.from_pydict({"item_id": np.full(n, item, np.int64), "at": np.arange(n), "key": keys, "shape": np.full(n, shape)})

    kept = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null")
    return kept.mapInArrow(seeds, "item_id long, at long, key long, shape long").dropDuplicates(["item_id", "at", "key"])


def runs_of(places: np.ndarray, margin: int, length: int) -> list[tuple[int, int, int, int]]:
    """Places that lie within a margin of each other, as (first index, last + 1, start of context, its end)."""
    cuts = np.flatnonzero(np.diff(places) > margin) + 1
    bounds = zip(np.concatenate([[0], cuts]).tolist(), np.concatenate([cuts, [len(places)]]).tolist(), strict=True)
    return [(a, b, max(0, int(places[a]) - margin), min(length, int(places[b - 1]) + margin)) for a, b in bounds]


def document_hits(docs: DataFrame, map_: np.ndarray, shapes: list[int]) -> DataFrame:
    """doc_id, run, start, context (word hashes) and seeds (key, at) of the positions that pass the bit map."""
    shared = docs.sparkSession.sparkContext.broadcast(map_)

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bit_map = WordHashes(), shared.value
        for batch in batches:
            out: dict[str, list] = {"doc_id": [], "run": [], "start": [], "context": [], "keys": [], "places": []}
            ids = batch.column(0).to_pylist()
            for doc, text in zip(ids, batch.column(1), strict=True):
                hashes = known.of(words(text.as_py()))
                found, at = [], []
                for keys in seed_hashes(hashes, shapes):
                    here = np.flatnonzero(passes(bit_map, keys))
                    found.append(keys[here])
                    at.append(here)
                places = np.concatenate(at) if at else np.zeros(0, np.int64)
                if not len(places):
                    continue
                order = np.argsort(places, kind="stable")
                places, keys = places[order], np.concatenate(found)[order]
                for a, b, start, end in runs_of(places, MARGIN, len(hashes)):
                    out["doc_id"].append(doc)
                    out["run"].append(int(places[a]))
                    out["start"].append(start)
                    out["context"].append(hashes[start:end].astype("<u8").tobytes())
                    out["keys"].append(keys[a:b].view(np.int64))
                    out["places"].append(places[a:b])
                if len(out["run"]) >= 4096:
                    yield _hit_batch(out)
            if out["run"]:
                yield _hit_batch(out)

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    return kept.mapInArrow(hits, "doc_id long, run long, start long, context binary, keys array<long>, places array<long>")


def _hit_batch(out: dict[str, list]) -> pa.RecordBatch:
    kinds = {"doc_id": pa.int64(), "run": pa.int64(), "start": pa.int64(), "context": pa.binary(), "keys": pa.list_(pa.int64()), "places": pa.list_(pa.int64())}
    batch = pa.RecordBatch.from_arrays([pa.array(out[k], kind) for k, kind in kinds.items()], list(kinds))
    for values in out.values():
        values.clear()
    return batch


def overlap(document: np.ndarray, start: int, item: np.ndarray, diagonal: int) -> tuple[int, int, int] | None:
    """First and last + 1 word of the document covered by windows that agree, and the words that agree there.

    ``document`` holds the hashes from word ``start`` on; word d of the document faces word d - diagonal of the item.
    """
    low, high = max(start, diagonal), min(start + len(document), diagonal + len(item))
    least = min(PASSAGE, len(item))
    if high - low < least or least < LEAST_WORDS:
        return None
    same = document[low - start : high - start] == item[low - diagonal : high - diagonal]
    total = np.concatenate([[0], np.cumsum(same)])
    first, last = len(same), 0
    for window in range(least, min(WINDOW, len(item), high - low) + 1):
        good = np.flatnonzero(total[window:] - total[:-window] >= IDENTITY * window)
        if len(good):
            first, last = min(first, int(good[0])), max(last, int(good[-1]) + window)
    if not last:
        return None
    agree = np.flatnonzero(same[first:last])
    first, last = first + int(agree[0]), first + int(agree[-1]) + 1  # ends on words that agree
    return low + first, low + last, len(agree)


def overlaps(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, n_same, first_word, last_word: the largest verified overlap of every pair that has one."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    seeds = materialize(benchmark_seeds(items), "benchmark-seeds")
    shapes = sorted(r.shape for r in seeds.select("shape").distinct().toLocalIterator())  # at most len(SHAPES)
    bits = filter_bits(64 * seeds.count(), low=26)  # a stranger that passes costs a row with its surroundings
    hits = materialize(document_hits(docs, key_filter(seeds, "key", bits), shapes), "seed-hits")
    listed = hits.select("doc_id", "run", F.explode(F.arrays_zip("keys", "places")).alias("hit"))
    listed = listed.select("doc_id", "run", F.col("hit.keys").alias("key"), F.col("hit.places").alias("place"))
    # One row per item and diagonal of a run, however many seeds hit.
    found = listed.join(seeds.select("item_id", "at", "key"), "key").select("doc_id", "run", "item_id", (F.col("place") - F.col("at")).alias("diagonal")).distinct()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            packed = [known.of(words(t.as_py())).astype("<u8").tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["item_id", "item"])

    tokens = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null")
    tokens = materialize(tokens.dropDuplicates().mapInArrow(hashed, "item_id long, item binary"), "benchmark-words")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"doc_id": [], "item_id": [], "n_same": [], "first_word": [], "last_word": []}
            for doc, start, context, diagonal, name, item in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "start", "context", "diagonal", "item_id", "item")), strict=True):
                best = overlap(np.frombuffer(context, "<u8"), start, np.frombuffer(item, "<u8"), diagonal)
                if best:
                    for key, value in zip(out, (doc, name, best[2], best[0], best[1]), strict=True):
                        out[key].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out.values()], list(out))

    faced = found.join(hits.select("doc_id", "run", "start", "context"), ["doc_id", "run"]).join(tokens, "item_id")
    verified = faced.select("doc_id", "start", "context", "diagonal", "item_id", "item").mapInArrow(
        verify, "doc_id long, item_id long, n_same long, first_word long, last_word long"
    )
    best = F.max(F.struct("n_same", (-F.col("first_word")).alias("before"), "last_word")).alias("best")
    return verified.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", F.col("best.n_same"), (-F.col("best.before")).alias("first_word"), F.col("best.last_word")
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a verified overlap, all columns as they were."""
    found = overlaps(docs.select(row_key().alias("doc_id"), "text"), items)
    tainted = materialize(found.select(F.col("doc_id").alias("_tainted_row")).distinct(), "tainted")
    rows = docs.select(row_key().alias("own"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"))
    return rows.join(tainted, F.col("own") == F.col("_tainted_row"), "left_anti").select("whole.*")
