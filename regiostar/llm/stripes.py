"""Phrase collocation mining with stripes.

A stripe belongs to a prefix of 0 to 3 words: a counter of the words that follow it, with one element for "nothing, or
nothing that can be frequent". Tasks build stripes of many texts at a time, Spark merges them element by element, and
the merged elements give everything: each element is an extension (a phrase and its count), the sum over the stripe of
a language is its count of words, and a stripe's largest element is the largest phrase that extends the prefix to the
right; the same maximum by the elements' last words gives the largest extension to the left. A longer prefix's own count
is its element one level down, so only the language's stripe carries "nothing" and no other stripe ships it again.

Only phrases that can be frequent get elements. Rounds for one to four words add the hashes of phrases to cells, of
which there are an eighth to a quarter as many as bytes of text (at most 2**``MOST_BITS``); a phrase whose cell holds fewer than
``least`` occurrences, or whose first or last words fail, is rare. Cells only rule phrases out, the merged counts of the
words themselves decide, so collisions cost work and never change a result. Once the text is far beyond the cells, they
rule little out, and the merge sees up to four elements a word, combined inside each task.

A stripe is merged as rows of its elements, combined inside tasks before the shuffle, so the stripe of a very common
prefix is spread over all tasks. Joins of phrases with stripe totals are joins of written tables, whose hot keys
adaptive execution splits; the first ranks of a language are found in ``SHARES`` shares first.

Defined results: a null text counts as empty, a null language as ``und``; rows that share an id, and repeated rows,
count each; texts without phrases add nothing; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from regiostar.llm.common import mixed, passes, small_batches
from regiostar.session import materialize

LONGEST = 4
SEGMENT = 4 << 20
LEAST_BITS, MOST_BITS = 24, 28
#: Stripes that a task hands over at a time.
HANDED = 20_000
RANGE_BITS = 8
SHARES = 64
NEXT = np.uint64(0x9FB21C651E98DF25)

BLANKS, ENDS = b" \t", b".,;:!?\n\x0b\f\r"
#: For ``bytes.translate``: what a byte is (0 part of a word, 1 a blank between words, 2 the end of a piece).
KINDS = bytes(1 if b in BLANKS else 2 if b in ENDS else 0 for b in range(256))
PLACES = mixed(np.arange(1000, 1000 + 4096, dtype=np.uint64)) | np.uint64(1)


def kinds_of(data: np.ndarray) -> np.ndarray:
    return np.frombuffer(data.tobytes().translate(KINDS), np.uint8)


class Words:
    """The words of a run of whole pieces: a hash of word and language, the piece and the language of each."""

    def __init__(self, data: np.ndarray, starts_of_docs: np.ndarray, langs_of_docs: np.ndarray, langs: pa.Array):
        kinds = kinds_of(data)
        inside = kinds == 0
        edges = np.diff(inside.view(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        self.letters = np.frombuffer(data[inside].tobytes().lower(), np.uint8)  # of bytes, A to Z only
        self.lengths, self.langs = ends - starts, langs

        def numbered(borders: np.ndarray) -> np.ndarray:
            """For each word the number of borders before it."""
            return np.repeat(np.arange(len(borders) + 1, dtype=np.int32), np.diff(np.searchsorted(starts, borders), prepend=0, append=len(starts)))

        self.piece = numbered(np.flatnonzero(kinds == 2))
        self.lang = langs_of_docs[numbered(starts_of_docs[1:])]
        self.hashes = [np.empty(0, np.uint64)]
        if len(starts):
            first = np.cumsum(self.lengths) - self.lengths
            place = np.arange(len(self.letters)) - np.repeat(first, self.lengths)
            sums = np.add.reduceat(PLACES[place & (len(PLACES) - 1)] * (self.letters + np.uint64(1)), first)
            known = np.fromiter((xxhash.xxh64_intdigest(x) for x in langs.to_pylist()), np.uint64, len(langs))
            self.hashes = [mixed(sums ^ known[self.lang])]

    def __len__(self) -> int:
        return len(self.lengths)

    @cached_property
    def _encoded(self) -> pa.DictionaryArray:
        offsets = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(self), [None, pa.py_buffer(offsets), pa.py_buffer(self.letters)])
        return words.dictionary_encode()

    @property
    def vocabulary(self) -> pa.Array:
        return self._encoded.dictionary

    @cached_property
    def number(self) -> np.ndarray:
        """Each word's place in the vocabulary."""
        return self._encoded.indices.to_numpy()

    def hash(self, m: int) -> np.ndarray:
        """Of the phrase of ``m`` words at each place, whether or not it stays inside one piece."""
        while len(self.hashes) < m:
            shorter, one = self.hashes[-1], self.hashes[0]
            self.hashes.append(mixed(shorter[:-1] * NEXT + one[len(self.hashes) :]) if len(shorter) else shorter)
        return self.hashes[m - 1]

    def possible(self, maps: list[np.ndarray]) -> list[np.ndarray]:
        """For 1 to ``len(maps) + 1`` words, where a phrase can be frequent by the maps of all shorter ones and its own.

        The last has no map of its own: both phrases inside it that are one word shorter can be frequent.
        """
        found = [np.ones(len(self), bool)]
        for m, cells in enumerate(maps, 1):
            at = np.flatnonzero(found[-1])
            found[-1][at] = passes(cells, self.hash(m)[at])
            shorter = found[-1]
            found.append(shorter[:-1] & shorter[1:] & (self.piece[:-m] == self.piece[m:]) if len(shorter) > 1 else shorter[:0])
        return found


def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """The words of (lang, text) rows, about ``SEGMENT`` bytes at a time, cut between pieces."""

    def runs(held: list[pa.RecordBatch]) -> Iterator[Words]:
        table = pa.Table.from_batches(held).combine_chunks()
        langs = table["lang"].combine_chunks().dictionary_encode()
        text = table["text"].combine_chunks().cast(pa.large_binary())
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        raw = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        data = np.insert(raw, offsets[1:], 10)  # each text ends a piece
        starts_of_docs = offsets[:-1] + np.arange(len(text))
        langs_of_docs = langs.indices.to_numpy()
        start = 0
        while start < len(data):
            stop = start + SEGMENT
            if stop < len(data):
                ends = np.flatnonzero(kinds_of(data[start:stop]) == 2)
                if len(ends):
                    stop = start + int(ends[-1]) + 1
                else:  # one piece longer than a segment
                    while stop < len(data) and data[stop - 1] not in ENDS:
                        ends = np.flatnonzero(kinds_of(data[stop : stop + SEGMENT]) == 2)
                        stop = stop + int(ends[0]) + 1 if len(ends) else stop + SEGMENT
            yield Words(data[start:stop], starts_of_docs - start, langs_of_docs, langs.dictionary)
            start = stop

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= SEGMENT:
            yield from runs(held)
            held = []
    if held:
        yield from runs(held)


def _cells(texts: DataFrame, maps: list, bits: int, least: int) -> np.ndarray:
    """A bit map of the cells with ``least`` or more phrases of ``len(maps) + 1`` words.

    A task sends, for each of 2**``RANGE_BITS`` ranges of cells, the low 16 bits of the cells met, how many there are for
    each value of the bits above, and the cells' counts up to ``least``; the driver receives 2**(bits - 3) bytes.
    """
    m, kind, inner = len(maps) + 1, np.min_scalar_type(least), bits - RANGE_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shorter = [x.value for x in maps]
        for words in words_of(batches):
            at = np.flatnonzero(words.possible(shorter)[-1])
            cells = np.sort((words.hash(m)[at] >> np.uint64(64 - bits)).astype(np.uint32))
            first = np.flatnonzero(np.diff(cells, prepend=np.int64(-1)))
            met, counts = cells[first], np.minimum(np.diff(first, append=len(cells)), least).astype(kind)
            low, rows = met.astype(np.uint16), []
            cuts = np.searchsorted(met, np.arange((1 << RANGE_BITS) + 1, dtype=np.int64) << inner).tolist()
            for number, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                if a < b:
                    above = np.bincount((met[a:b] >> np.uint32(16)) & np.uint32((1 << inner - 16) - 1), minlength=1 << inner - 16)
                    rows.append((number, above.astype("<u4").tobytes(), low[a:b].tobytes(), counts[a:b].tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), sent, strict=True)], ["range", "above", "low", "counts"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total = None, np.zeros(1 << inner, np.int64)

        def done():
            packed = np.packbits(total >= least, bitorder="little").tobytes()
            return pa.RecordBatch.from_pydict({"range": pa.array([current], pa.int32()), "bits": pa.array([packed], pa.binary())})

        for batch in batches:
            for number, *packed in zip(batch.column(0).to_pylist(), *(batch.column(k) for k in (1, 2, 3)), strict=True):
                if number != current:
                    if current is not None:
                        yield done()
                    current = number
                    total[:] = 0
                above, low, counts = (np.frombuffer(x.as_buffer(), t) for x, t in zip(packed, ("<u4", np.uint16, kind), strict=True))
                total[np.repeat(np.arange(len(above)) << 16, above) + low] += counts
        if current is not None:
            yield done()

    sent = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = texts.mapInArrow(count, "range int, above binary, low binary, counts binary")
    found = counted.repartition(parts, "range").sortWithinPartitions("range").mapInArrow(merge, "range int, bits binary").toArrow()
    map_ = np.zeros(1 << (bits - 3), np.uint8)
    size = 1 << (inner - 3)
    for number, packed in zip(found.column("range").to_pylist(), found.column("bits"), strict=True):
        map_[number * size : (number + 1) * size] = np.frombuffer(packed.as_buffer(), np.uint8)
    return map_.view("<u8")


def _phrases(words: Words, at: np.ndarray, m: int) -> pa.Array:
    """The text of the phrases of ``m`` words at the given places."""
    parts = [words.vocabulary.take(pa.array(words.number[at + k])) for k in range(m)]
    if not parts:
        return pa.array([""] * len(at), pa.string())
    joined = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())) if m > 1 else parts[0]
    return joined.cast(pa.binary()).cast(pa.string())


def _stripes(words: Words, maps: list[np.ndarray], longest: int) -> Iterator[pa.RecordBatch]:
    """Prefix, following words and their counts, for each length of the prefix.

    Only the empty prefix has the following word null (none that can be frequent), so its stripe sums to all words.
    """
    possible = words.possible(maps)
    nothing = len(words.vocabulary)
    for m in range(1, longest + 1):
        at = np.flatnonzero(possible[m - 2]) if m > 1 else np.arange(len(words))
        if not len(at):
            continue
        goes_on = np.zeros(len(words), bool)
        goes_on[: len(possible[m - 1])] = possible[m - 1]
        if m > 1:  # a prefix's count is its own element one level down; only the language's stripe needs "nothing"
            at = at[goes_on[at]]
            if not len(at):
                continue
        follows = np.full(len(at), nothing)
        follows[goes_on[at]] = words.number[at[goes_on[at]] + m - 1]
        prefix = words.hash(m - 1)[at] if m > 1 else words.lang[at]
        order = np.lexsort((follows, prefix))
        at, follows = at[order], follows[order]
        # Neighbours belong together if language and words agree; hashes only bring them side by side.
        new = np.diff(words.lang[at], prepend=-1) != 0
        for k in range(m - 1):
            new |= np.diff(words.number[at + k], prepend=-1) != 0
        stripe = np.flatnonzero(new)
        element = np.flatnonzero(new | (np.diff(follows, prepend=-1) != 0))
        following = follows[element]
        texts = words.vocabulary.take(pa.array(following, mask=following == nothing)).cast(pa.binary()).cast(pa.string())
        counts = pa.array(np.diff(element, append=len(at)).astype(np.int64))
        bounds = pa.array(np.append(np.searchsorted(element, stripe), len(element)).astype(np.int32))
        found = pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(stripe), m, np.int32)),
                words.langs.take(pa.array(words.lang[at[stripe]])),
                _phrases(words, at[stripe], m - 1),
                *(pa.ListArray.from_arrays(bounds, x) for x in (texts, counts)),
            ],
            ["m", "lang", "prefix", "next", "n"],
        )
        yield from (found.slice(k, HANDED) for k in range(0, len(stripe), HANDED))


def merged(docs: DataFrame, least: int = 30, longest: int = LONGEST) -> DataFrame:
    """The elements of all stripes: m (words with the following one), lang, prefix, next, n."""
    small_batches(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bits = min(MOST_BITS, max(LEAST_BITS, size.bit_length() - 3))
    maps = []
    for _ in range(longest):
        maps.append(sc.broadcast(_cells(texts, maps, bits, least)))

    def stripes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [x.value for x in maps]
        for words in words_of(batches):
            yield from _stripes(words, cells, longest)

    found = texts.mapInArrow(stripes, "m int, lang string, prefix string, next array<string>, n array<long>")
    elements = found.select("m", "lang", "prefix", F.inline(F.arrays_zip("next", "n")))
    return elements.groupBy("m", "lang", "prefix", "next").agg(F.sum("n").alias("n"))


def collocations(docs: DataFrame, top: int = 2000, least: int = 30, subsumed: int = 80, longest: int = LONGEST) -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``longest`` words: lang, rank, phrase, a, l, r, n, score.

    ``subsumed`` is the percentage of a phrase's occurrences that a longer phrase must reach to replace it.
    """
    elements = materialize(merged(docs, least, longest), "stripe-elements")
    frequent = F.col("next").isNotNull() & (F.col("n") >= least)
    stripes = materialize(
        elements.groupBy("m", "lang", "prefix").agg(F.sum("n").alias("total"), F.max(F.when(frequent, F.col("n"))).alias("right")), "stripes"
    )
    phrases = elements.where(frequent & (F.col("m") > 1)).select("m", "lang", F.concat_ws(" ", "prefix", "next").alias("phrase"), F.col("n").alias("a"))
    phrases = materialize(phrases, "phrases")
    part = F.when(F.col("m") == 1, F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next"))
    totals = elements.where(frequent & (F.col("m") < longest)).select("lang", part.alias("part"), F.col("n").alias("total"))

    words = F.split("phrase", " ")
    left, right = (F.array_join(F.slice(words, a, b), " ") for a, b in ((F.lit(1), F.col("k")), (F.col("k") + 1, F.col("m") - F.col("k"))))
    cuts = phrases.select("m", "lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", left.alias("left"), right.alias("right"))
    cuts = cuts.join(totals.withColumnsRenamed({"part": "left", "total": "l"}), ["lang", "left"])
    cuts = cuts.join(totals.withColumnsRenamed({"part": "right", "total": "r"}), ["lang", "right"])
    score = F.expr("(cast(a as decimal(20, 0)) * 2000000) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    rest = phrases.where("m > 2").select("lang", F.array_join(F.slice(F.split("phrase", " "), F.lit(2), F.col("m") - 1), " ").alias("phrase"), "a")
    to_left = rest.groupBy("lang", "phrase").agg(F.max("a").alias("longer_left"))
    to_right = stripes.where("right is not null and m > 2").select("lang", F.col("prefix").alias("phrase"), F.col("right").alias("longer_right"))
    longer = F.coalesce(F.greatest("longer_left", "longer_right"), F.lit(0)).cast("decimal(20,0)")
    own = scored.join(to_left, ["lang", "phrase"], "left").join(to_right, ["lang", "phrase"], "left")
    own = own.where(longer * 100 < F.col("a").cast("decimal(20,0)") * subsumed).select("lang", "phrase", "a", "cut.*")
    own = materialize(own.drop("k"), "collocations")

    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    first = own.withColumn("place", F.row_number().over(Window.partitionBy("lang", share).orderBy(*best))).where(F.col("place") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    sizes = stripes.where("m = 1").select("lang", F.col("total").alias("n"))
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
