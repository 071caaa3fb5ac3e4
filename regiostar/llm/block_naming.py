"""Exact dedup by deterministic block naming.

A text loses its white space and is cut into blocks of ``BLOCK`` UTF-8 bytes (one empty block if nothing is left). All
distinct blocks of the table are sorted and get integers as names; then adjacent names are paired, all distinct pairs
are sorted and named in the same way, and so on until every text has one name. Equal texts get equal names, and
different texts never share one, since every name stands for one content: texts with one name left after the same
number of rounds have the same length in blocks at every round and the same blocks.

Sorting runs on two 64-bit digests first and on the content where digests tie, so that only the step that finds the
distinct blocks moves text. A name is 2**48 times the number of a digest range plus the rank inside the range; ranges
hold distinct keys under a uniform hash, so they are of even size and names don't depend on how Spark deals them out.

Tables between the rounds are written below the shared folder. Each round halves the names of a text, so
all rounds together handle about as many rows as there are blocks, whatever one text's length; the number of rounds is the
logarithm of the longest text. Blocks and pairs are made distinct inside each task before the shuffle, and joins by
name are joins of written tables, whose hot keys adaptive execution splits.

Defined results: a null text counts as empty; of equal texts the one with the most code points in the original stays,
then the smallest document id (null ids last), then the smallest hash of the original; of rows that are equal in all
that exactly one stays. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from regiostar.session import materialize

BLOCK = 4096
BLANKS = " \t\n\x0b\f\r"
RANGE_BITS = 12
RANK_BITS = 48


def two_digests(block: Column) -> Column:
    return F.struct(F.xxhash64(block).alias("d1"), F.xxhash64(F.lit(12), block).alias("d2"))


def numbered(keys: DataFrame, order: list[str], hashed: Column) -> DataFrame:
    """Distinct ``keys`` with a ``name``: the range of ``hashed`` in the high bits, the rank inside it in the low ones."""
    ranged = keys.withColumn("range", F.shiftrightunsigned(hashed, 64 - RANGE_BITS))
    rank = F.row_number().over(Window.partitionBy("range").orderBy(*order)).cast("long")
    return ranged.select(*order, (F.shiftleft("range", RANK_BITS) + rank).alias("name"))


def _blocks(norm: str) -> Column:
    last = F.floor(F.greatest(F.octet_length(norm) - 1, F.lit(0)) / F.lit(BLOCK)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(F.col(norm), i * BLOCK + 1, F.lit(BLOCK)))


def _block_names(rows: DataFrame, digests) -> tuple[DataFrame, DataFrame]:
    """Names of all distinct blocks: (d1, d2, block, name), block null where the digests belong to one content only.

    The second table has the digests that several contents share.
    """
    block = rows.select(F.explode("blocks").alias("block"))
    distinct = block.select(digests(F.col("block")).alias("d"), "block").select("d.d1", "d.d2", "block").distinct()
    counted = materialize(distinct.groupBy("d1", "d2").agg(F.count("*").alias("contents")), "block-digests")
    shared = counted.where("contents > 1").select("d1", "d2")
    keys = counted.where("contents = 1").select("d1", "d2", F.lit(None).cast("binary").alias("block"))
    if not shared.isEmpty():
        keys = keys.union(distinct.join(shared, ["d1", "d2"]))
    return materialize(numbered(keys, ["d1", "d2", "block"], F.col("d1")), "block-names"), shared


def identities(docs: DataFrame, digests=two_digests) -> DataFrame:
    """A row per document: row, doc_id, n_chars, original (a hash), text_sha256, level, name.

    (level, name) is the text's identity; ``digests`` turns a block into a struct of two 64-bit numbers.
    """
    text = F.coalesce("text", F.lit(""))
    norm = F.translate(text, BLANKS, "").cast("binary")
    rows = materialize(
        docs.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", F.length(text).cast("long").alias("n_chars"),
            F.xxhash64(text).alias("original"), norm.alias("norm"),
        ).withColumn("text_sha256", F.sha2("norm", 256)),
        "normalised-texts",
    )
    cut = rows.select("row", _blocks("norm").alias("blocks"))
    names, shared = _block_names(cut, digests)
    placed = cut.select("row", F.size("blocks").alias("parts"), F.posexplode("blocks").alias("at", "block"))
    placed = placed.withColumn("d", digests(F.col("block"))).select("row", "parts", "at", "d.d1", "d.d2", "block")
    alone = placed.select("row", "parts", "at", "d1", "d2").join(names.where("block is null").select("d1", "d2", "name"), ["d1", "d2"])
    named = alone.select("row", "parts", "at", "name")
    if not shared.isEmpty():
        by_content = placed.join(names.where("block is not null"), ["d1", "d2", "block"])
        named = named.union(by_content.select("row", "parts", "at", "name"))
    named = materialize(named, "named-blocks")

    found = []
    rounds = max((named.agg(F.max("parts")).first()[0] or 1) - 1, 0).bit_length()
    for level in range(rounds + 1):
        found.append(named.where("parts = 1").select("row", F.lit(level).alias("level"), "name"))
        if level == rounds:
            break
        first = F.max(F.when(F.col("at") % 2 == 0, F.col("name"))).alias("first")
        second = F.coalesce(F.max(F.when(F.col("at") % 2 == 1, F.col("name"))), F.lit(0)).alias("second")
        pairs = named.where("parts > 1").groupBy("row", "parts", F.shiftright("at", 1).alias("at")).agg(first, second)
        pairs = materialize(pairs, f"pairs-{level}")
        names = numbered(pairs.select("first", "second").distinct(), ["first", "second"], F.xxhash64("first", "second"))
        named = pairs.join(materialize(names, f"pair-names-{level}"), ["first", "second"])
        named = materialize(named.select("row", F.shiftright(F.col("parts") + 1, 1).alias("parts"), "at", "name"), f"named-{level}")
    return rows.drop("norm").join(reduce(DataFrame.union, found), "row")


def dedup(docs: DataFrame, digests=two_digests) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256; a row per document, dropped ones too."""
    known = materialize(identities(docs, digests), "identities")
    rank = F.struct(
        (-F.col("n_chars")).alias("shorter"), F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col("original"), F.col("row")
    )
    groups = known.groupBy("level", "name").agg(F.min(rank).alias("keeper"), F.count("*").alias("group_size"))
    joined = known.join(materialize(groups, "text-groups"), ["level", "name"])
    return joined.select(
        "doc_id", F.col("keeper.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("keeper.row")).alias("kept"), "text_sha256"
    )
