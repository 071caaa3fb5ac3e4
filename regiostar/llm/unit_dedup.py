"""Substring dedup by line hashing.

Units are the lines of a text. A unit is normalised (lower case, runs of blanks as one, ends trimmed) and reduced to
two independent 64-bit digests. All units but empty ones are grouped by digest over the whole table, however short;
the earliest occurrence (smallest document id, then smallest unit number) is kept and the others are removed, with
their offsets in the original text retained. Grouping is a minimum per digest, combined inside each task before the
shuffle; the join of all occurrences with the repeated digests is one of written tables, whose hot keys adaptive
execution splits. The cut itself takes time in proportion to the text.

Defined results: a null text counts as empty; rows with a null id come last in rank; rows that share an id are ranked
by their text's hash, rows that repeat id and text are one document and get the same result each; empty lines stay, and
units of fewer than ``least_words`` words (parted by blanks) if a caller asks for that; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostar.llm.common import small_batches
from regiostar.session import materialize

LEAST_WORDS = 1
BLANKS = r"[\t\x0B\f\r ]+"


def normalised(unit: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(unit), BLANKS, " "), F.lit(" "))


def dedup(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, n_units, units_removed, n_removed (code points), removed (array of start, end in code points), kept_text."""
    small_batches(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    named = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("h"))
    unit = F.col("unit")
    units = named.select("doc_id", "h", F.split("text", "\n").alias("units"))
    lines = F.transform(units["units"], normalised)
    listed = units.select("doc_id", "h", F.posexplode(lines).alias("at", "unit"))
    listed = listed.where((unit != "") & (F.size(F.split(unit, " ")) >= least_words)).select(
        "doc_id", "h", "at", F.xxhash64(unit).alias("d1"), F.xxhash64(F.lit(11), unit).alias("d2")
    )
    listed = materialize(listed, "unit-digests")
    place = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("h"), F.col("at"))
    first = listed.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    # Both sides of a join come from written tables, so that a digest or a row that repeats very often can be split.
    late = listed.join(materialize(first, "repeated-units"), ["d1", "d2"]).where(place != F.col("first"))
    late = late.groupBy(F.col("doc_id").alias("late_id"), F.col("h").alias("late_h")).agg(F.collect_set("at").alias("gone"))
    late = materialize(late, "late-units")
    joined = named.join(late, F.col("doc_id").eqNullSafe(F.col("late_id")) & (F.col("h") == F.col("late_h")), "left")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.select("doc_id", "text", "gone").mapInArrow(
        _cut, f"doc_id {kind}, n_units long, units_removed long, n_removed long, removed array<struct<start:int,end:int>>, kept_text string"
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Take the lines numbered in ``gone`` out of each text; starts come from one running sum of lengths."""
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        units, taken, points, removed, kept = [], [], [], [], []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist(), strict=True):
            lines, out = text.split("\n"), sorted(gone or ())
            units.append(len(lines))
            taken.append(len(out))
            if out:
                ends = list(accumulate((len(line) + 1 for line in lines)))
                places = [{"start": ends[i] - len(lines[i]) - 1, "end": ends[i] - 1} for i in out]
                late = set(out)
                text = "\n".join([line for i, line in enumerate(lines) if i not in late])
            else:
                places = []
            points.append(sum(x["end"] - x["start"] for x in places))
            removed.append(places)
            kept.append(text)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(units, pa.int64()), pa.array(taken, pa.int64()), pa.array(points, pa.int64()), pa.array(removed, spans), pa.array(kept, pa.string())],
            ["doc_id", "n_units", "units_removed", "n_removed", "removed", "kept_text"],
        )
