"""Best-match fuzzy join of distinct names, exact at its threshold and without a cross join.

Two texts of lengths m and n that score at least t differ by at most k = (1 - t/100)·(m + n) inserted or deleted
characters. Cut one of them into pieces: each edit spoils at most one, so of any k + 1 pieces one occurs unchanged in
the other text, shifted by no more than the edits allow. A text is cut into more pieces than that where it is long
enough, the partners of every piece are counted, and the k + 1 pieces with fewest partners are joined: a word that
all names share is looked up only where nothing rarer is left. Pairs that meet must then pass a bound on the shared
characters, counted in ``CLASSES`` classes, which is never below the true number. What is left is scored. No pair at
or above the threshold is lost by either step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from regiostar import schema
from regiostar.functions.similarity import indel_ratio, position_masks, sorted_tokens
from regiostar.functions.text import standardise, strip_accents

#: Least size of the surplus pieces.
PIECE = 2
CLASSES = 32


def _segments(texts: DataFrame, own: str, partner: str, threshold: float) -> DataFrame:
    """One row per text, partner length and piece of the target text: its one-based start, and its size.

    The margins absorb rounding, in favour of keeping a pair.
    """
    shrink, spare = threshold / (200.0 - threshold), (100.0 - threshold) / 100.0
    shortest = f"cast(ceil({own} * {shrink!r}D - 1e-6D) AS int)"
    longest = f"cast(floor({own} / {shrink!r}D + 1e-6D) AS int)"
    return (
        texts.selectExpr("*", f"explode(sequence({shortest}, {longest})) AS {partner}")
        .selectExpr("*", f"cast(floor({spare!r}D * (source_length + target_length) + 1e-6D) AS int) AS edits")
        .selectExpr("*", f"greatest(edits + 1, cast(target_length / {PIECE} AS int)) AS pieces")
        .selectExpr("*", "explode(sequence(0, pieces - 1)) AS segment")
        .selectExpr(
            "*",
            "cast(floor(segment * target_length / pieces) AS int) + 1 AS start",
            "cast(floor((segment + 1) * target_length / pieces) AS int)"
            " - cast(floor(segment * target_length / pieces) AS int) AS size",
        )
    )


def histogram(text: str) -> Column:
    """How many characters of a text fall into each of ``CLASSES`` classes."""
    return F.expr(f"""transform(array(transform(split({text}, ''), c -> pmod(ascii(c), {CLASSES}))), classes ->
        transform(sequence(0, {CLASSES - 1}), k -> size(filter(classes, x -> x = k AND {text} <> ''))))[0]""")


def candidate_pairs(sources: DataFrame, targets: DataFrame, threshold: float) -> DataFrame:
    """Distinct (source, target) texts that can reach the threshold. Inputs have one column of distinct texts each."""
    block = ["source_length", "target_length", "segment", "piece"]
    left = _segments(
        sources.selectExpr("source", "length(source) AS source_length"), "source_length", "target_length", threshold
    )
    # A surplus of inserted over deleted characters is fixed by the lengths; that limits the shift each way.
    left = (
        left.selectExpr(
            "*",
            "floor((edits - (source_length - target_length)) / 2) AS back",
            "floor((edits + (source_length - target_length)) / 2) AS ahead",
        )
        .selectExpr(
            "*",
            "cast(greatest(1, start - back) AS int) AS first",
            "cast(least(source_length - size + 1, start + ahead) AS int) AS last",
        )
        .filter("back >= 0 AND ahead >= 0 AND first <= last")
        .selectExpr("source", "source_length", "target_length", "segment", "size", "explode(sequence(first, last)) AS at")
        .selectExpr("source", "source_length", "target_length", "segment", "substring(source, at, size) AS piece")
        .distinct()
    )
    right = _segments(
        targets.selectExpr("target", "length(target) AS target_length"), "target_length", "source_length", threshold
    ).selectExpr("target", "edits", "source_length", "target_length", "segment", "substring(target, start, size) AS piece")
    partners = left.groupBy(*block).agg(F.count("*").alias("partners"))
    # Pieces without a partner count among the k + 1 rarest and meet nobody.
    counted = right.join(partners.hint("merge"), block, "left")
    rarest = F.row_number().over(W.partitionBy("target", "source_length").orderBy(F.coalesce("partners", F.lit(0)), "segment"))
    chosen = counted.withColumn("place", rarest).filter("place <= edits + 1 AND partners IS NOT NULL").select("target", *block)
    pairs = left.hint("merge").join(chosen, block).select("source", "target").distinct()

    own = sources.select("source", F.length("source").alias("m"), histogram("source").alias("source_classes"))
    other = targets.select("target", F.length("target").alias("n"), histogram("target").alias("target_classes"))
    shared = "aggregate(zip_with(source_classes, target_classes, (x, y) -> least(x, y)), 0, (a, x) -> a + x)"
    possible = pairs.join(own, "source").join(other, "target").filter(f"200.0D * {shared} >= {threshold!r}D * (m + n) - 1e-6D")
    return possible.select("source", "target")


def normalised_names(names: DataFrame, column: str, upper: bool) -> DataFrame:
    """Distinct non-null names with the text they are compared by."""
    cleaned = standardise(F.col(column)) if upper else F.col(column)
    distinct = names.select(F.col(column).cast("string").alias(column)).dropna().distinct()
    return distinct.select(column, sorted_tokens(strip_accents(cleaned)).alias("text"))


def best_matches(sources: DataFrame, targets: DataFrame, threshold: float) -> DataFrame:
    """Best target per source text: higher score first, then the smaller name.

    ``sources`` has a column ``source``; ``targets`` has ``target`` and its ``canonical`` name.
    """
    pairs = candidate_pairs(sources, targets.select("target"), threshold)
    known = targets.select("target", "canonical", position_masks("target").alias("masks"))
    scored = pairs.join(known, "target").select("source", "canonical", indel_ratio("source", "target", "masks").alias("score"))
    best = F.min(F.struct((-F.col("score")).alias("worst_first"), F.col("canonical").alias("canonical")))
    return (
        scored.filter(F.col("score") >= threshold)
        .groupBy("source")
        .agg(best.alias("best"))
        .selectExpr("source", "best.canonical AS canonical", "-best.worst_first AS score")
    )


def map_names(
    source: DataFrame,
    source_column: str,
    target: DataFrame,
    target_column: str,
    threshold: float = schema.MATCH_THRESHOLD,
) -> DataFrame:
    """(raw, canonical, score) for each distinct source name; no match at the threshold gives nulls.

    Lower thresholds let more pairs through the blocking; the result stays exact.
    """
    if not 0 < threshold <= 100:
        raise ValueError("threshold must lie above 0 and not exceed 100")
    raw = normalised_names(source, source_column, upper=True).withColumnsRenamed({source_column: "raw", "text": "source"})
    canonical = (
        normalised_names(target, target_column, upper=False)
        .groupBy(F.col("text").alias("target"))
        .agg(F.min(target_column).alias("canonical"))
    )
    matches = best_matches(raw.select("source").distinct(), canonical, threshold)
    return raw.join(matches, "source", "left").select("raw", "canonical", "score")


def apply_mapping(df: DataFrame, column: str, mapping: DataFrame, name: str) -> DataFrame:
    """Canonical name per row, null where there is none. Pass a written mapping, whose size Catalyst knows."""
    pairs = mapping.select(F.col("raw").alias("_raw"), F.col("canonical").alias(name))
    return df.join(pairs, F.col(column) == F.col("_raw"), "left").drop("_raw")


def with_name_score(df: DataFrame, left: str, right: str, name: str) -> DataFrame:
    """Token-sort score of two columns, row by row; each derived text is computed once."""
    texts = df.select("*", sorted_tokens(F.col(left)).alias("_left"), sorted_tokens(F.col(right)).alias("_right"))
    masked = texts.select("*", position_masks("_right").alias("_masks"))
    return masked.select(*df.columns, indel_ratio("_left", "_right", "_masks").alias(name))
