"""Token-ID output: flat unsigned-integer files with 64-bit document offsets, read back through memory maps.

A token set is a folder with four flat little-endian files per part, parts in ascending document order:

- ``tokens-NNNNN.bin``   ids of all documents of the part, unsigned 16 bits if every id fits, else 32 bits
- ``offsets-NNNNN.bin``  64-bit: for each document the number of ids before it in the whole set, then one closing entry
- ``ids-NNNNN.bin``      64-bit document ids
- ``valid-NNNNN.bin``    one byte per document, 0 where the document id is null

Offsets count over the whole set, so a reader needs no other part. Parts come from a range partitioning by document
id; rows of one id (or of none) are dealt out by how their texts begin, which keeps their order. The number of parts
follows the bytes of the texts. First every task writes its ids and counts; then the counts per part become bases by a
prefix sum, and a second step writes offsets as base plus running count. A task writes under a name of its own and
renames at its end, so a repeated or lost task leaves the same files.

Defined results: a null text counts as empty and yields the end id only; null document ids come first; rows that
share an id are ordered by their text; an empty table gives a set without parts; other columns are ignored.
"""

from __future__ import annotations

import re
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from regiostar.llm.common import small_batches
from regiostar.session import fresh_path

END_ID = 2
#: White space on both sides of a blank: only there may a token reach over the blank.
AMBIGUOUS = re.compile(r"\s \s")
#: White space beside a line feed: only there may the line feed be part of a longer piece.
BESIDE = re.compile(r"\s\n|\n\s")
CACHE = 300_000
READ_IDS = 1 << 20
#: Bytes of text a part holds at most on average, and characters that tell rows of one id apart between parts.
PART_BYTES = 1 << 28
PREFIX = 64


class ByteLetters(dict):
    """For ``str.translate``: what the tokenizer's byte-level step makes of a character, asked once each."""

    def __init__(self, tokenizer):
        super().__init__()
        self.step = tokenizer.pre_tokenizer.pre_tokenize_str

    def __missing__(self, code: int) -> str:
        self[code] = found = "".join(piece for piece, _ in self.step(chr(code)))
        return found


class Units(dict):
    """Ids of units seen, packed; a unit that is missing is encoded on its way out.

    ``blank`` is put before every unit, so that keys need not hold it. A unit of letters consists of one known piece, which goes
    to the merges directly; letters with marks after them consist of two, and any other unit goes to the tokenizer. Two
    generations of at most ``CACHE`` units bound the memory.
    """

    def __init__(self, encoder: UnitEncoder, blank: str):
        super().__init__()
        self.encoder, self.blank = encoder, blank
        self.older: dict[str, bytes] = {}

    def __missing__(self, unit: str) -> bytes:
        found = self.older.get(unit)
        if found is None:
            if unit.isalpha():
                found = self.encoder.piece(self.blank + unit)
            elif (core := unit.rstrip(punctuation)).isalpha():
                found = self[core] + self.encoder.bare[unit[len(core) :]]
            else:
                found = self.encoder.packed(self.blank + unit)
        self[unit] = found
        return found

    def age(self) -> None:
        """Forgets what was not used for a generation, once this one is full."""
        if len(self) > CACHE:
            self.older = dict(self)
            self.clear()


class UnitEncoder:
    """Encodes texts line by line and blank by blank, with the tokenizer's merges run once per distinct word.

    The byte-level pattern starts a new piece at a blank unless white space stands on both sides of it, and a line feed with
    no white space beside it is a piece of its own; merges stay inside pieces. So the ids of words with the blank before them,
    of line feeds and of first words of lines, joined, are the ids of the text. Where line feeds have white space beside them,
    lines are not taken apart. Texts with an ambiguous blank or the text of a special token go to the tokenizer whole.
    """

    def __init__(self, tokenizer_file: str, dtype: str):
        self.tokenizer_file, self.code = tokenizer_file, {"<u2": "H", "<u4": "I"}[dtype]
        self.tokenizer = None

    def opened(self) -> UnitEncoder:
        """Ready to encode; opened once per worker."""
        if self.tokenizer is None:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(self.tokenizer_file)
            self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
            self.merge = self.tokenizer.model.tokenize
            self.letters = ByteLetters(self.tokenizer)
            self.blank = self.letters[ord(" ")]
            self.line_feed = self.packed("\n")
            self.bare, self.blanked = Units(self, ""), Units(self, " ")
        return self

    def _bytes(self, ids: list[int]) -> bytes:
        packed = array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def packed(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids) if text else b""

    def piece(self, piece: str) -> bytes:
        letters = piece.replace(" ", self.blank) if piece.isascii() else piece.translate(self.letters)
        return self._bytes([t.id for t in self.merge(letters)])

    def _line(self, line: str) -> bytes:
        first, *rest = line.split(" ")
        return self.bare[first] + b"".join(map(self.blanked.__getitem__, rest))

    def __call__(self, text: str) -> bytes:
        if AMBIGUOUS.search(text) or any(s in text for s in self.special):
            return self.packed(text)
        self.bare.age()
        self.blanked.age()
        if "\n" not in text or BESIDE.search(text):
            return self._line(text)
        return self.line_feed.join(map(self._line, text.split("\n")))


def id_type(tokenizer_file: str, end_id: int = END_ID) -> str:
    from tokenizers import Tokenizer

    return "<u2" if max(Tokenizer.from_file(tokenizer_file).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"


def _file(folder: str, kind: str, part: int) -> str:
    return f"{folder}/{kind}-{part:05d}.bin"


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _normal(folder: str) -> str:
    """``file:/x`` and plain paths as ``file:///x``."""
    if folder.startswith("file:/") and not folder.startswith("file://"):
        return "file://" + folder[5:]
    return folder if "://" in folder else f"file://{folder}"


def _parts(docs: DataFrame) -> int:
    """As many parts as the session shuffles to, more where the texts would make them too large."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))


def write_tokens(docs: DataFrame, tokenizer_file: str, folder: str, end_id: int = END_ID, parts: int | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into a token set below ``folder``; returns a row per part: part, docs, tokens, base."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    folder, dtype = _normal(folder), id_type(tokenizer_file, end_id)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    parts = parts or _parts(docs)

    # What a worker puts into the broadcast dictionary stays there from task to task.
    memory = spark.sparkContext.broadcast({})

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mark = TaskContext.get().partitionId(), uuid.uuid4().hex
        store, root = _store(folder)
        encode = memory.value.setdefault("encoder", UnitEncoder(tokenizer_file, dtype)).opened()
        end = np.array([end_id], dtype).tobytes()
        width = np.dtype(dtype).itemsize
        store.create_dir(root, recursive=True)
        names = {kind: _file(root, kind, part) for kind in ("tokens", "counts", "ids", "valid")}
        out = {kind: store.open_output_stream(f"{name}.{mark}") for kind, name in names.items()}
        n_docs = n_tokens = 0
        for batch in batches:
            ids = batch.column(0)
            counts = np.empty(len(ids), "<i8")
            for i, text in enumerate(batch.column(1)):
                packed = encode(text.as_py() or "") + end
                counts[i] = len(packed) // width
                out["tokens"].write(packed)
            out["counts"].write(counts.tobytes())
            out["ids"].write(ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            out["valid"].write(ids.is_valid().to_numpy(zero_copy_only=False).astype("u1").tobytes())
            n_docs, n_tokens = n_docs + len(ids), n_tokens + int(counts.sum())
        for kind, name in names.items():
            out[kind].close()
            if n_docs:
                store.move(f"{name}.{mark}", name)
            else:
                store.delete_file(f"{name}.{mark}")
        if n_docs:
            yield pa.RecordBatch.from_pydict({"part": [part], "docs": [n_docs], "tokens": [n_tokens]})

    counted = (
        docs.repartitionByRange(parts, "doc_id", F.substring("text", 1, PREFIX)).sortWithinPartitions("doc_id", "text")
        .mapInArrow(write, "part long, docs long, tokens long")
    )
    table = fresh_path(spark, "token-parts")
    counted.write.parquet(table)  # from here on nothing is encoded again
    # One row per part: the prefix sum is over partitions, not documents.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = spark.read.parquet(table).withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                name, mark = _file(root, "offsets", row["part"]), uuid.uuid4().hex
                with store.open_input_file(_file(root, "counts", row["part"])) as f:
                    counts = np.frombuffer(f.read(), "<i8")
                with store.open_output_stream(f"{name}.{mark}") as f:
                    f.write((row["base"] + np.concatenate([[0], np.cumsum(counts)])).astype("<i8").tobytes())
                store.move(f"{name}.{mark}", name)
            yield batch

    index = fresh_path(spark, "token-index")
    _spread(based).mapInArrow(offsets, "part long, docs long, tokens long, base long").write.parquet(index)
    return spark.read.parquet(index)


def _spread(parts: DataFrame) -> DataFrame:
    """The rows of the few parts over as many tasks as the session shuffles to."""
    return parts.repartition(int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "part")


def _array(store: fs.FileSystem, path: str, dtype: str):
    """A memory map of a local file; elsewhere an object that reads the slices asked for."""
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype, "r")
    return _Ranges(store.open_input_file(path), np.dtype(dtype))


class _Ranges:
    def __init__(self, file, dtype):
        self.file, self.dtype = file, dtype

    def __len__(self):
        return self.file.size() // self.dtype.itemsize

    def __getitem__(self, s: slice) -> np.ndarray:
        start, stop, _ = s.indices(len(self))
        size = self.dtype.itemsize
        return np.frombuffer(self.file.read_at((stop - start) * size, start * size), self.dtype)


def read_tokens(spark: SparkSession, index: DataFrame, folder: str, dtype: str) -> DataFrame:
    """A row per document from the files: doc_id, start, n_tokens, ids_crc32 (of the ids as unsigned 32 bits)."""
    folder = _normal(folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                tokens, offsets, ids, valid = (
                    _array(store, _file(root, kind, row["part"]), kind_type)
                    for kind, kind_type in (("tokens", dtype), ("offsets", "<i8"), ("ids", "<i8"), ("valid", "u1"))
                )
                for at in range(0, len(ids), 4096):
                    starts = np.array(offsets[at : at + 4097])
                    crcs = [_crc(tokens, a, b) for a, b in zip(starts[:-1] - row["base"], starts[1:] - row["base"], strict=True)]
                    known = np.array(valid[at : at + 4096]) == 0
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.array(ids[at : at + 4096]), mask=known), pa.array(starts[:-1]), pa.array(np.diff(starts)), pa.array(crcs, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return _spread(index).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _crc(tokens, start: int, stop: int) -> int:
    value = 0
    for at in range(start, stop, READ_IDS):
        value = zlib.crc32(tokens[at : min(stop, at + READ_IDS)].astype("<u4").tobytes(), value)
    return value


def encoded(docs: DataFrame, tokenizer_file: str, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` as a token set below the shared folder and read it back."""
    spark = docs.sparkSession
    folder = fresh_path(spark, "tokens")
    index = write_tokens(docs, tokenizer_file, folder, end_id)
    return read_tokens(spark, index, folder, id_type(tokenizer_file, end_id))
