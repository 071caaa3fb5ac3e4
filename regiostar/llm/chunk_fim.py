"""Fill-in-middle transformation with content-defined chunks whose boundary summaries are remembered.

A rolling hash over the last ``WINDOW`` bytes cuts a text's UTF-8 bytes into chunks, so equal passages give equal chunks
wherever they stand. For each chunk a summary is kept: how many code points start in it, whether it contains a marker,
and its first and last two bytes, which decide about markers across a boundary. A worker remembers summaries by the
chunk's bytes (a dictionary compares contents, not only hashes), in two generations of bounded size. The sums of the
summaries give a text's length; a cut is found in the running sums, and only the one chunk that holds it is scanned.

Work stays inside the task that read the row: nothing is shuffled, and memory is one Arrow batch, one text's arrays
and the remembered summaries. A chunk holds at least ``LEAST`` and at most ``MOST`` bytes (the last may be shorter).

Defined results: a null text counts as empty; a null document id gives the hash of "1:" alone; a text without
characters, or with one of the markers, stays plain, as does the share 1 - ``rate`` of the others; rows that share an
id are cut at the same draws; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostar.llm.common import mixed, small_batches

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)
WINDOW, LEAST, MOST = 16, 256, 1 << 16
#: A chunk ends where these bits of the rolling hash are zero: about a kilobyte beyond the least size.
MASK = np.uint32(0x3FF << 20)
REMEMBERED_BYTES = 16 << 20
FACTOR = 0x9E3779B1
LETTERS = (mixed(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def rolling(data: np.ndarray) -> np.ndarray:
    """For each byte the polynomial hash of the ``WINDOW`` bytes that end there (of fewer at the start), modulo 2**32."""
    found, reach, factor = LETTERS[data], 1, FACTOR
    while reach < WINDOW:
        longer = found.copy()
        longer[reach:] += found[:-reach] * np.uint32(factor)
        found, reach, factor = longer, reach * 2, factor * factor & 0xFFFFFFFF
    return found


def chunk_ends(data: np.ndarray) -> list[int]:
    """Where the chunks of ``data`` end."""
    ends, last, size = [], 0, len(data)
    marks = np.flatnonzero((rolling(data) & MASK) == 0) + 1 if size > LEAST else np.empty(0, np.int64)
    at = 0
    while size - last > LEAST:
        at += int(np.searchsorted(marks[at:], last + LEAST))
        last = min(int(marks[at]) if at < len(marks) else size, last + MOST, size)
        ends.append(last)
    if last < size:
        ends.append(size)
    return ends


def starts_of_characters(chunk: bytes) -> np.ndarray:
    return (np.frombuffer(chunk, np.uint8) & 0xC0) != 0x80


class Summaries:
    """Of chunks by content: code points, a marker inside, first and last two bytes."""

    def __init__(self, limit: int = REMEMBERED_BYTES):
        self.limit, self.held = limit, 0
        self.recent: dict[bytes, tuple[int, bool, bytes, bytes]] = {}
        self.older: dict[bytes, tuple[int, bool, bytes, bytes]] = {}

    def of(self, chunk: bytes) -> tuple[int, bool, bytes, bytes]:
        found = self.recent.get(chunk)
        if found is None:
            found = self.older.get(chunk)
            if found is None:
                points = int(np.count_nonzero(starts_of_characters(chunk)))
                found = (points, any(m in chunk for m in MARKERS), chunk[:2], chunk[-2:])
            self.held += len(chunk)
            if self.held > self.limit:
                self.recent, self.older, self.held = {}, self.recent, len(chunk)
            self.recent[chunk] = found
        return found


class Cutter:
    """One text in chunks: its length in code points, whether it holds a marker, and where a code point starts."""

    def __init__(self, data: bytes, summaries: Summaries):
        self.data, self.ends = data, chunk_ends(np.frombuffer(data, np.uint8))
        counts, self.marked, tail = [], False, b""
        for start, end in zip([0, *self.ends], self.ends, strict=False):
            points, inside, head, last = summaries.of(data[start:end])
            counts.append(points)
            seam = tail + head
            self.marked = self.marked or inside or any(m in seam for m in MARKERS)
            tail = last  # two bytes, as only a text's last chunk can be shorter than LEAST
        self.sums = np.cumsum(counts) if counts else np.zeros(0, np.int64)
        self.points = int(self.sums[-1]) if counts else 0

    def offset(self, point: int) -> int:
        """The byte at which code point number ``point`` starts."""
        if point >= self.points:
            return len(self.data)
        k = int(np.searchsorted(self.sums, point, "right"))
        start, before = (self.ends[k - 1], int(self.sums[k - 1])) if k else (0, 0)
        return start + int(np.flatnonzero(starts_of_characters(self.data[start : self.ends[k]]))[point - before])


def transformed(docs: DataFrame, rate: int = 90, spm_rate: int = 20) -> DataFrame:
    """doc_id, n (code points), form (plain, psm, spm), prefix_chars, middle_chars, output (the transformed text).

    ``rate`` per cent of the texts that may be cut are cut, ``spm_rate`` per cent of these with the suffix first.
    """
    small_batches(docs.sparkSession)
    drawn = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring("drawn", 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summaries = Summaries()
        for batch in batches:
            lengths, forms, before, middles, outputs = [], [], [], [], []
            draws = zip(*(batch.column(f"h{k}").to_pylist() for k in (1, 2, 3, 4)), strict=True)
            for raw, (h1, h2, h3, h4) in zip(batch.column("text"), draws, strict=True):
                text = Cutter(raw.as_buffer().to_pybytes() if raw.is_valid else b"", summaries)
                lengths.append(text.points)
                if not text.points or text.marked or h3 % 100 >= rate:
                    forms.append("plain")
                    before.append(None)
                    middles.append(None)
                    outputs.append(text.data)
                    continue
                low, high = sorted((h1 % (text.points + 1), h2 % (text.points + 1)))
                a, b = text.offset(low), text.offset(high)
                prefix, middle, suffix = text.data[:a], text.data[a:b], text.data[b:]
                first = h4 % 100 < spm_rate
                forms.append("spm" if first else "psm")
                before.append(low)
                middles.append(high - low)
                outputs.append(b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle) if first else (PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(forms, pa.string()), pa.array(before, pa.int64()), pa.array(middles, pa.int64()), pa.array(outputs, pa.binary()).cast(pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    prepared = docs.select("doc_id", "text", drawn.alias("drawn")).select("doc_id", "text", *h)
    return prepared.mapInArrow(cut, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: str = "output", form: str = "form") -> Column:
    """The original text, rebuilt from a transformed text and its form."""
    parts = F.split(output, "<[PSM]>", -1)  # a cut text holds no marker of its own, and no cut can make one
    psm = F.concat(F.element_at(parts, 2), F.element_at(parts, 4), F.element_at(parts, 3))
    spm = F.concat(F.element_at(parts, 3), F.element_at(parts, 4), F.element_at(parts, 2))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))
