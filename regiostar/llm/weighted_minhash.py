"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles.

Words are lower-cased runs between white space; shingles are ``SHINGLE`` consecutive words (all words of a shorter
text). A shingle's weight is its count in the text times the mean inverse document frequency of its words. Document
frequencies are counted over all documents in a table of 2**CELL_BITS hashed cells (words that share a cell share a
frequency), and the inverse is damped to between 1 and 2, so that a text with thousands of copies does not lose the
weight that makes its copies alike.

Every text gets BANDS x ROWS consistent weighted samples: two texts agree in a sample with a probability equal to
their weighted Jaccard similarity. Texts that agree in all samples of a band share a bucket. Copies of one word
sequence are one text from the start. Candidates are then verified by the exact weighted Jaccard similarity:

1. every text of a bucket against the bucket's smallest text, which gives components of linked texts;
2. in every bucket with several components, the texts outside its largest component against all its texts of other
   components, block against block. Pairs that agree in at least ``AGREE`` samples and whose bound of the shared
   weight allows it are verified inside the task, which gives only links between texts not joined before.

A class is a connected component of the verified links; its id is the smallest document id in it.

Defined results: texts without words are classes of their own; a null id is ranked after all others (a class of null
ids only has a null id); repeated rows belong to the same class, as their texts are equal; an empty table gives an
empty result; other columns are ignored by ``classes`` and passed on by ``first_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostar.llm.common import mixed, small_batches
from regiostar.llm.components import components
from regiostar.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 12, 4
SAMPLES = BANDS * ROWS
#: At similarity 0.8 fewer agreements have a probability of 1.6 in ten thousand, which adds to the loss of the banding.
AGREE = 28
CELL_BITS = 18
BLOCK, STRAYS = 4096, 256
BLOCK_WEIGHT, STRAY_WEIGHT = 1 << 21, 1 << 19  # weight of a block's texts: 1 to 2 a word
COLUMNS = 2048  # shared keys of a block multiplied at a time
LEVELS = 1 << 16
CHUNK = 1 << 11  # shingles sampled at a time
PIECE = 1 << 16  # words hashed at a time
SYMBOLS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
POWERS = np.cumprod(np.full(1024, 0xD6E8FEB86659FD93, np.uint64))


def split_words(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def digest(found: list[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(found))


def hashes(found: list[str]) -> np.ndarray:
    """64-bit hashes of the words' bytes, a piece of the text at a time."""
    out = [np.zeros(0, np.uint64)]
    for at in range(0, len(found), PIECE):
        data = np.frombuffer((" ".join(found[at : at + PIECE]) + " ").encode(), np.uint8)
        ends = np.flatnonzero(data == 32)
        starts = np.concatenate([[0], ends[:-1] + 1])
        offset = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
        out.append(mixed(np.add.reduceat(SYMBOLS[data] * POWERS[offset & 1023], starts)))
    return np.concatenate(out)


def row_key() -> Column:
    """A hash of id and text that tells rows apart, null ids included."""
    return F.xxhash64(F.col("doc_id"), F.coalesce("text", F.lit("")), F.col("doc_id").isNull())


def word_weights(docs: DataFrame) -> np.ndarray:
    """Damped inverse document frequency of every hashed cell, from all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, total = np.zeros(1 << CELL_BITS, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                found = hashes(split_words(text.as_py()))
                cells[np.unique((found >> np.uint64(64 - CELL_BITS)).astype(np.int32))] += 1
                total += 1
        here = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(here, -1)), pa.array(np.append(cells[here], total))], ["cell", "n"])

    counted = docs.select("text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cell, n = counted.column("cell").to_numpy(), counted.column("n").to_numpy()  # at most 2**CELL_BITS + 1 rows
    frequency = np.ones(1 << CELL_BITS)
    total = max(2, int(n[cell < 0].sum()))
    frequency[cell[cell >= 0]] = np.clip(n[cell >= 0], 1, total)
    return (2.0 - np.log(frequency) / np.log(total)).astype(np.float32)


def shingles(words: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, rising, and their weights."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.float32)
    width = min(SHINGLE, n)
    each = weights[(words >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
    keys, sums = np.full(n - width + 1, width, np.uint64), np.zeros(n - width + 1, np.float32)
    for i in range(width):
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + words[i : n - width + 1 + i]
        sums += each[i : n - width + 1 + i]
    found, first, counts = np.unique(mixed(keys), return_index=True, return_counts=True)
    return found, (counts * (sums[first] / width)).astype(np.float32)


def draws(limit: float, n: int = LEVELS) -> tuple[np.ndarray, np.ndarray]:
    """n evenly spread pairs (log c, r) of independent Gamma(2, 1) variables with log c - r below ``limit``, rising by that difference."""
    c = np.geomspace(1e-18, 60, 1 << 14)
    below_c = np.where(c < 1e-4, c * c / 2, -np.expm1(-c) - c * np.exp(-c))
    r = np.linspace(0, 60, 1 << 15)[1:]
    bound = np.interp(np.minimum(limit + r, np.log(60)), np.log(c), below_c)  # chance that log c < limit + r
    spread = np.cumsum(r * np.exp(-r) * bound)
    i = np.arange(n)
    picked = np.interp((i + 0.5) / n, spread / spread[-1], r)
    part = np.interp(picked, r, bound) * ((i * 0.6180339887498949 + 0.5 / n) % 1)
    log_c = np.interp(np.log(np.maximum(part, 1e-36)), np.log(below_c), np.log(c))
    order = np.argsort(log_c - picked, kind="stable")
    return log_c[order].astype(np.float32), picked[order].astype(np.float32)


class Sampler:
    """Consistent weighted samples: each of SAMPLES functions picks the shingle of least rank and a level of its weight.

    A shingle's pair (log c, r) in a function is drawn by 16 hashed bits from a table that rises by log c - r, the 64 lowest
    entries by 16 more bits from a table of that tail. The rank lies at most r above log c - r - log(weight), so comparing
    the 16 bits with a limit of each shingle leaves few whose rank is to be computed. A function without a rank below the limit,
    seven in a thousand, computes all ranks; the samples are the same as if all did.
    """

    TAIL, SPAN = 64, np.log(5.0)

    def __init__(self):
        self.log_c, self.r = draws(np.inf)
        self.least = self.log_c - self.r
        self.tail_c, self.tail_r = draws(float(self.least[self.TAIL]))
        self.seeds = mixed(np.arange(1, SAMPLES // 4 + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
        self.own = mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB))

    def bits(self, keys: np.ndarray) -> np.ndarray:
        """16 bits of every function (rows: seeds, columns: keys, then four functions a seed)."""
        h = (keys ^ self.seeds[:, None]) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xE7037ED1A0B428DB)
        h ^= h >> np.uint64(29)
        return h.view(np.uint16).reshape(len(self.seeds), len(keys), 4)

    def ranks(self, function: np.ndarray, bits: np.ndarray, keys: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        more = mixed(keys ^ self.own[function])
        low = (more & np.uint64(LEVELS - 1)).astype(np.int64)
        beta = (more >> np.uint64(32)).astype(np.float64) / 2**32
        tail = bits < self.TAIL
        r = np.where(tail, self.tail_r[low], self.r[bits]).astype(np.float64)
        log_c = np.where(tail, self.tail_c[low], self.log_c[bits])
        level = np.floor(logs / r + beta)
        return log_c - r * (level - beta + 1), level

    def __call__(self, keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The samples as hashes of (shingle, level)."""
        best = np.full(SAMPLES, np.inf)
        picked = np.zeros(SAMPLES, np.uint64)
        logs = np.log(weights.astype(np.float64))
        bound = self.SPAN - np.log(weights.sum(dtype=np.float64))
        limits = np.searchsorted(self.least, (bound + logs + 1e-3).astype(np.float32), "right")
        limits = np.clip(limits, self.TAIL, LEVELS - 1).astype(np.uint16)

        def take(function: np.ndarray, at: np.ndarray, bits: np.ndarray) -> None:
            rank, level = self.ranks(function, bits.astype(np.int64), keys[at], logs[at])
            least = best.copy()
            np.minimum.at(least, function, rank)
            better = np.flatnonzero((rank == least[function]) & (rank < best[function]))
            first = better[np.unique(function[better], return_index=True)[1]]
            best[function[first]] = rank[first]
            picked[function[first]] = keys[at[first]] + level[first].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)

        for chunk in range(0, len(keys), CHUNK):
            bits = self.bits(keys[chunk : chunk + CHUNK])
            n = bits.shape[1] * 4
            place = np.flatnonzero(bits.reshape(-1, n) <= np.repeat(limits[chunk : chunk + CHUNK], 4)).astype(np.uint32)
            seed = place // np.uint32(n)
            rest = place - seed * np.uint32(n)
            take((seed * 4 + (rest & 3)).astype(np.int64), (rest >> 2).astype(np.int64) + chunk, bits.ravel()[place])
        missed = np.flatnonzero(best > bound)
        for chunk in range(0, len(keys) if len(missed) else 0, CHUNK):
            bits = self.bits(keys[chunk : chunk + CHUNK])
            function, at = (x.ravel() for x in np.meshgrid(missed, np.arange(bits.shape[1]), indexing="ij"))
            take(function, at + chunk, bits[function // 4, at, function % 4])
        return mixed(picked)


def band_keys(samples: np.ndarray) -> np.ndarray:
    total = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
    for row in samples.reshape(BANDS, ROWS).T:
        total = (total ^ row) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(total).view(np.int64)


def signed(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, row, v (digest of the word sequence), weight, bands, samples of every row; v is null without words."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, table = Sampler(), shared.value
        for batch in batches:
            vs, totals, bands, samples = [], [], [], []
            for value in batch.column(2):
                found = split_words(value.as_py())
                if not found:
                    vs.append(None)
                    totals.append(0.0)
                    bands.append(None)
                    samples.append(None)
                    continue
                keys, each = shingles(hashes(found), table)
                picked = sampler(keys, each)
                vs.append(digest(found))
                totals.append(float(each.sum(dtype=np.float64)))
                bands.append(band_keys(picked))
                samples.append((picked >> np.uint64(32)).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(vs, pa.binary()), pa.array(totals, pa.float64()), pa.array(bands, pa.list_(pa.int64())), pa.array(samples, pa.binary())],
                ["doc_id", "row", "v", "weight", "bands", "samples"],
            )

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row"), "text")
    return named.mapInArrow(sign, "doc_id long, row long, v binary, weight double, bands array<long>, samples binary")


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two lists of distinct rising keys with weights."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = float(np.minimum(a[1][i], b[1][j]).sum(dtype=np.float64))
    total = float(a[1].sum(dtype=np.float64)) + float(b[1].sum(dtype=np.float64)) - both
    return both / total if total else 0.0


def verified(pairs: DataFrame, texts: DataFrame, weights: np.ndarray, least: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose exact similarity reaches ``least``."""
    shared = pairs.sparkSession.sparkContext.broadcast(weights)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, last, left = shared.value, None, None
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            keep = []
            for name, one, two in zip(a, batch.column(2), batch.column(3), strict=True):
                if name.as_py() != last:
                    last, left = name.as_py(), shingles(hashes(split_words(one.as_py())), table)
                keep.append(similarity(left, shingles(hashes(split_words(two.as_py())), table)) >= least)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], ["a", "b"])

    right = pairs.join(texts.select(F.col("v").alias("b"), F.col("text").alias("b_text")), "b")
    both = right.join(texts.select(F.col("v").alias("a"), F.col("text").alias("a_text")), "a")
    return both.select("a", "b", "a_text", "b_text").mapInArrow(verify, "a binary, b binary")


def fetched(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """v, text of the wanted texts (v, row)."""
    texts = docs.select(row_key().alias("row"), "text").join(wanted, "row").select("v", "text")
    return materialize(texts, "candidate-texts").dropDuplicates(["v"])


def strays(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """key, v of the texts outside the largest component of their bucket."""
    member = materialize(labelled(buckets, labels), "bucket-members")
    counts = member.groupBy("key", "label").agg(F.count("*").alias("n"))
    main = counts.groupBy("key").agg(F.count("*").alias("kinds"), F.max(F.struct("n", "label"))["label"].alias("main")).where("kinds > 1")
    return member.join(main.select("key", "main"), "key").where("label <> main").select("key", "v")


def labelled(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    return buckets.join(labels, "v", "left").withColumn("label", F.coalesce("label", "v"))


def shared_weights(left: list[tuple], right: list[tuple]) -> np.ndarray:
    """An upper bound of the shared weight of every left and right list, exact where shared keys weigh the same.

    The smaller of two weights is at most the root of their product, so the bound is a product of matrices of roots,
    added up over ``COLUMNS`` shared keys at a time.
    """
    keys = np.intersect1d(np.concatenate([k for k, _ in left]), np.concatenate([k for k, _ in right]))
    total = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(keys), COLUMNS):
        part = keys[at : at + COLUMNS]
        sides = []
        for texts in (left, right):
            dense = np.zeros((len(texts), len(part)), np.float32)
            for i, (found, each) in enumerate(texts):
                low, high = np.searchsorted(found, part[0]), np.searchsorted(found, part[-1], "right")
                at_part = np.searchsorted(part, found[low:high])
                hit = part[at_part] == found[low:high]
                dense[i, at_part[hit]] = np.sqrt(each[low:high][hit])
            sides.append(dense)
        total += sides[0] @ sides[1].T
    return total


def across(buckets: DataFrame, labels: DataFrame, texts: DataFrame, left: DataFrame, candidates: DataFrame, weights: np.ndarray) -> DataFrame:
    """Links (a, b) that join different components within buckets; ``left`` (key, v) names the texts compared with all others.

    A block compares all its pairs and verifies them exactly inside its task. It gives a link only where its ends are
    not joined yet, so at most one less than its components, however many pairs it holds.
    """
    shared = buckets.sparkSession.sparkContext.broadcast(weights)
    of_left = left.join(texts.select("v", "weight"), "v").groupBy("key")
    sizes = of_left.agg(F.ceil(F.greatest(F.count("*") / STRAYS, F.sum("weight") / STRAY_WEIGHT)).alias("lefts"))
    of_all = buckets.join(sizes, "key", "left_semi").join(texts.select("v", "weight"), "v").groupBy("key")
    blocks = of_all.agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("weight") / BLOCK_WEIGHT)).alias("blocks"))
    member = labelled(buckets, labels).join(sizes, "key").join(blocks, "key").join(texts.select("v", "weight", "samples"), "v").join(candidates, "v")
    named = left.select("key", "v", F.lit(True).alias("stray"))
    member = materialize(member.join(named, ["key", "v"], "left"), "mixed-buckets")
    columns = ["key", "v", "label", "weight", "samples", "text"]
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    every = member.select(*columns, numbers("lefts").alias("i"), F.pmod(F.xxhash64(F.lit(3), "v"), F.col("blocks")).alias("j"), F.lit(False).alias("stray"))
    lefts = member.where("stray").select(*columns, F.pmod(F.xxhash64("v"), F.col("lefts")).alias("i"), numbers("blocks").alias("j"), F.lit(True).alias("stray"))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"a": [], "b": []})
        left, right = rows[rows.stray], rows[~rows.stray]
        if not len(left) or not len(right):
            return none
        a_table, b_table = (np.frombuffer(b"".join(side.samples), "<u4").reshape(-1, SAMPLES) for side in (left, right))
        a_weight, b_weight = left.weight.to_numpy(), right.weight.to_numpy()
        _, kinds = np.unique(np.concatenate([left.label.to_numpy(), right.label.to_numpy()]), return_inverse=True)
        ours, theirs, root = kinds[: len(left)], kinds[len(left) :], np.arange(kinds.max() + 1)
        near = np.empty((len(left), len(right)), bool)
        for i, samples in enumerate(a_table):
            alike = np.minimum(b_weight, a_weight[i]) >= SIMILARITY * np.maximum(b_weight, a_weight[i]) * (1 - 1e-9)
            near[i] = alike & (theirs != ours[i]) & ((b_table == samples).sum(axis=1) >= AGREE)
        rows_, columns_ = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        if not len(rows_):
            return none
        table = shared.value
        a_keys, b_keys = ([shingles(hashes(split_words(side.text.iat[i])), table) for i in at] for side, at in ((left, rows_), (right, columns_)))
        bound = shared_weights(a_keys, b_keys)
        a_names, b_names, out = left.v.to_numpy(), right.v.to_numpy(), []
        for i, row in enumerate(rows_):
            whole = a_weight[row] + b_weight[columns_] - bound[i]
            open_ = np.flatnonzero(near[row, columns_] & (bound[i] >= (SIMILARITY - 1e-3) * whole))
            while len(open_ := open_[root[theirs[columns_[open_]]] != root[ours[row]]]):
                j, open_ = open_[0], open_[1:]
                if similarity(a_keys[i], b_keys[j]) >= SIMILARITY:
                    out.append((a_names[row], b_names[columns_[j]]))
                    root[root == root[theirs[columns_[j]]]] = root[ours[row]]
        return pd.DataFrame(out, columns=["a", "b"]) if out else none

    return every.union(lefts).groupBy("key", "i", "j").applyInPandas(compare, "a binary, b binary")


def linked(buckets: DataFrame, links: DataFrame, texts: DataFrame, candidates: DataFrame, weights: np.ndarray) -> DataFrame:
    """Labels (v, label) of the components of ``links`` and of every link between texts that share a bucket."""
    labels = components(links)
    left = materialize(strays(buckets, labels), "strays")
    if not left.take(1):
        return labels
    return components(links.union(materialize(across(buckets, labels, texts, left, candidates, weights), "cross-links")))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, row, class_id, class_size, keeper (the row that stands for the class) of every row of ``docs``."""
    small_batches(docs.sparkSession)
    weights = word_weights(docs)
    rows = materialize(signed(docs, weights), "signatures")
    texts = rows.where("v is not null").groupBy("v").agg(F.min(F.struct("row", "weight", "bands", "samples")).alias("x")).select("v", "x.*")
    texts = materialize(texts, "distinct-texts")
    listed = texts.select("v", "weight", F.explode("bands").alias("key"))
    shared = listed.groupBy("key").agg(F.min(F.struct("v", "weight")).alias("centre"), F.count("*").alias("n")).where("n > 1")
    buckets = materialize(listed.join(shared.select("key", "centre"), "key"), "buckets")
    near = F.least("weight", "centre.weight") >= SIMILARITY * (1 - 1e-9) * F.greatest("weight", "centre.weight")
    pairs = materialize(buckets.where((F.col("v") != F.col("centre.v")) & near).select(F.col("centre.v").alias("a"), F.col("v").alias("b")).distinct(), "centre-pairs")
    wanted = buckets.select("v").distinct().join(texts.select("v", "row"), "v")
    candidates = materialize(fetched(docs, wanted), "bucket-texts")
    links = materialize(verified(pairs, candidates, weights), "centre-links")
    labels = linked(buckets.select("key", "v"), links, texts, candidates, weights)
    named = rows.select("doc_id", "row", "v").join(labels, "v", "left")
    # Texts without words stay alone: their class is their row.
    label = F.coalesce("label", "v", F.unhex(F.hex(F.col("row")))).alias("label")
    named = materialize(named.select("doc_id", "row", label), "labelled-rows")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    stats = named.groupBy("label").agg(F.min(place).alias("first"), F.count("*").alias("class_size"))
    return named.join(stats, "label").select(
        "doc_id", "row", F.col("first.doc_id").alias("class_id"), "class_size", F.col("first.row").alias("keeper")
    )


def first_of_each(docs: DataFrame) -> DataFrame:
    """One document of each class, all columns as they were; of repeated rows one."""
    found = materialize(classes(docs).select("row", "keeper"), "classes")
    gone = materialize(found.where("row <> keeper").select(F.col("row").alias("_gone")).distinct(), "gone-rows")
    again = materialize(found.where("row = keeper").groupBy(F.col("row").alias("_again")).count().where("count > 1").select("_again"), "repeated-rows")
    rows = docs.select(row_key().alias("own"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"))
    kept = rows.join(gone, F.col("own") == F.col("_gone"), "left_anti")
    if again.take(1):
        one = kept.join(again, F.col("own") == F.col("_again"), "left_semi").dropDuplicates(["own"])
        kept = kept.join(again, F.col("own") == F.col("_again"), "left_anti").union(one)
    return kept.select("whole.*")
