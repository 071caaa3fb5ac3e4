"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target in words: its weight's share of the budget, at most ``most`` times its size, the excess
shared again by weight. Inside a source a document's rate grows with its importance class, again at most ``most``
copies. The whole part of a rate is allocated as certain whole copies. The rest of the rate is the inclusion
probability p of one more copy: with u a uniform number drawn from the document's content and id, documents are
ranked by random odds over inclusion odds, u / (1 - u) * (1 - p) / p, and the first ones are taken until the source's
remaining words are met (fixed size, unequal probabilities).

Both levellings share what is left among those below their ceiling until none is above it; they work on one row per
source, or per source and class, and only run as many rounds as new ceilings are reached. The cut in the ranking is
found by counts: words per (source, cell of the rank value), cumulated over the cells of a source, and only the
documents of the cell that holds the cut are put in order. Cells hold equal shares of the rank values, so a source
that holds a third of all rows is split into ``CELLS`` parts; nothing is collected.

Defined results: a null text has size 0 and takes 0 words; a null source is a source of its own, last in order; rows
that repeat id and text are interchangeable, and the cut may take some of them only; a source without words has target 0; an empty table
gives an empty result; other columns are ignored. Reruns agree, as u is a hash.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from regiostar.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
CELLS = 4096
PORTIONS = 64
WEIGHTS, SHARE, MOST, SEED = (3, 1, 2), Fraction(3, 2), 2, 17
WHOLE = "decimal(38,0)"


def size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def importance(words: Column) -> Column:
    """A class from 1 to 6 by length: fragments count least, long documents most."""
    return F.when(words <= 0, 1).otherwise(F.least(F.lit(6), 1 + F.floor(F.log2(words.cast("double")) / 2))).cast("int")


def levels(groups: DataFrame, by: list[str], budget: Column, weight: str, ceiling: str) -> DataFrame:
    """Share the budget of each group of rows by weight, no row above its ceiling: adds num, den (the rate is num / den).

    ``weight`` and ``ceiling`` are whole numbers. A row gets min(ceiling, weight * num / den).
    """
    keys = by or [F.lit(1).alias("_all")]
    rows, full = groups.withColumn("_full", F.lit(False)), -1
    while True:
        open_weight = F.sum(F.when(~F.col("_full"), F.col(weight)).otherwise(0).cast(WHOLE))
        given = F.sum(F.when(F.col("_full"), F.col(ceiling)).otherwise(0).cast(WHOLE))
        level = rows.groupBy(*keys).agg((F.max(budget) - given).cast(WHOLE).alias("num"), open_weight.cast(WHOLE).alias("den"))
        joined = rows.drop("num", "den").join(level, by) if by else rows.drop("num", "den").withColumn("_all", F.lit(1)).join(level, "_all").drop("_all")
        above = (F.col("den") > 0) & (F.col(ceiling).cast("decimal(19,0)") * F.col("den") <= F.col(weight).cast("decimal(19,0)") * F.col("num"))
        rows = materialize(joined.withColumn("_full", F.col("_full") | F.coalesce(above, F.lit(False))), "levels")
        now = rows.where("_full").count()
        if now == full:
            return rows
        full = now


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: Fraction, most: int) -> DataFrame:
    """source, source_size, target, in twelfths where needed; from one row per source."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))  # one row per source
    table = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(rank - 1, F.lit(len(weights))) + 1))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    d = share.denominator
    table = table.withColumn("ceiling", F.col("source_size") * most * d)
    shared = levels(table, [], F.lit(int(total) * share.numerator), "weight", "ceiling")
    open_target = F.try_divide(F.col("weight") * F.col("num").cast("double"), F.col("den").cast("double") * d)
    target = F.when(F.col("_full"), F.col("source_size").cast("double") * most).otherwise(open_target)
    return shared.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def _drawn(docs: DataFrame, seed: int, *columns: Column) -> DataFrame:
    """source, size, class, u and the given columns of every document."""
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", F.coalesce(F.col("text"), F.lit(""))), 11)
    words = size(F.col("text"))
    return docs.select(*columns, "source", words.alias("size"), importance(words).alias("class"), ((drawn + 0.5) / 2.0**53).alias("u"))


def _ranked(drawn: DataFrame, rates: DataFrame) -> DataFrame:
    """Adds the rates of source and class, the ratio of odds, and the cell of the ranking."""
    odds = (F.col("u") / (1 - F.col("u"))) * F.try_divide(1 - F.col("p"), F.col("p"))
    rows = drawn.withColumn("key", _key()).join(rates, ["key", "class"])
    rows = rows.withColumn("odds", F.when((F.col("p") > 0) & (F.col("size") > 0), odds))
    return rows.withColumn("cell", F.floor(F.col("odds") / (1 + F.col("odds")) * CELLS).cast("int"))


def _key() -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))


def _plan(sized: DataFrame, weights: tuple[int, ...], share: Fraction, most: int) -> tuple[DataFrame, DataFrame]:
    """Rates per source and class, and where each source's ranking is cut; ``sized`` is a written table with doc_id."""
    classes = materialize(sized.groupBy("source", "class").agg(F.sum("size").alias("class_size")), "classes")
    sources = source_targets(classes.groupBy("source").agg(F.sum("class_size").alias("source_size")), weights, share, most)
    sources = materialize(sources.withColumn("key", _key()), "sources")

    # Rates of the classes of a source: in proportion to the class, at most ``most`` copies, meeting the target in words.
    rated = classes.select(_key().alias("key"), "class", "class_size").join(sources.select("key", "source_size", "target"), "key")
    rated = rated.withColumn("weight", F.col("class_size") * F.col("class")).withColumn("ceiling", F.col("class_size") * most)
    shared = levels(rated, ["key"], F.floor("target"), "weight", "ceiling")
    rate = F.when(F.col("_full") | (F.col("den") <= 0), F.lit(float(most))).otherwise(
        F.try_divide(F.col("class") * F.col("num").cast("double"), F.col("den").cast("double"))
    )
    rates = shared.select("key", "class", "class_size", "source_size", "target", F.least(rate, F.lit(float(most))).alias("rate"))
    rates = rates.withColumn("certain", F.floor("rate")).withColumn("p", F.col("rate") - F.col("certain"))
    whole = rates.groupBy("key").agg((F.max("target") - F.sum(F.col("certain") * F.col("class_size"))).alias("left"))
    rates = materialize(rates.drop("class_size", "rate").join(whole, "key"), "rates")

    # Words per cell; the cut lies in the first cell at which the cumulated words reach what is left.
    rows = _ranked(sized, rates).where("odds is not null")
    cells = rows.groupBy("key", "cell").agg(F.sum("size").alias("words"), F.max("left").alias("left"))
    before = F.sum("words").over(Window.partitionBy("key").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    cells = cells.withColumn("before", F.coalesce(before, F.lit(0)))
    cut = materialize(cells.where("before < left and before + words >= left").select("key", F.col("cell").alias("cut"), "before"), "cuts")
    # The documents of the cut's cell in order, equal rows as one group; a row belongs to the sample if that brings the
    # words nearer, so the cut may lie inside a group and take some of its rows.
    inside = rows.join(cut, "key").where("cell = cut").groupBy("key", "odds", "doc_id", "size").agg(
        F.count("*").alias("equal"), F.max("before").alias("before"), F.max("left").alias("left")
    )
    order = Window.partitionBy("key").orderBy("odds", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.col("before") + F.coalesce(F.sum(F.col("size") * F.col("equal")).over(order), F.lit(0))
    wanted = F.floor((F.col("left") - reached) / F.col("size") + 0.5).cast("long")
    edge = inside.withColumn("some", F.least(F.greatest(wanted, F.lit(0)), F.col("equal"))).where("some > 0")
    edge = edge.groupBy("key").agg(F.max(F.struct("odds", "doc_id", "size", "some", "equal")).alias("last"))
    edge = edge.select("key", F.struct("last.odds", "last.doc_id", "last.size").alias("last"), F.col("last.some").alias("some"), F.col("last.equal").alias("equal"))
    return rates, materialize(cut.join(edge, "key", "left").select("key", "cut", "last", "some", "equal"), "marks")


def _copies(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """Adds the number of copies the mix takes."""
    cut_inside = not marks.where("some < equal").isEmpty()
    rows = rows.join(marks, "key", "left")
    place = F.struct("odds", "doc_id", "size")
    at_cut = F.coalesce(F.col("cell") == F.col("cut"), F.lit(False))
    sampled = F.when(F.col("odds").isNull(), False).when(F.col("cut").isNull(), F.col("left") > 0).when(~at_cut, F.col("cell") < F.col("cut"))
    sampled = sampled.otherwise(F.coalesce(place <= F.col("last"), F.lit(False)))
    all_rows = rows.withColumn("sampled", sampled)
    if cut_inside:
        # Only some of the rows equal to the last one are taken: they are numbered in shares, as they may be a third of the table.
        last = at_cut & (F.col("some") < F.col("equal")) & place.eqNullSafe(F.col("last"))
        last = F.coalesce(last, F.lit(False))
        equal = materialize(rows.where(last).withColumn("mark", F.monotonically_increasing_id()), "rows-at-the-cut")
        equal = equal.withColumn("portion", F.pmod("mark", F.lit(PORTIONS)))
        earlier = Window.partitionBy("key").orderBy("portion").rowsBetween(Window.unboundedPreceding, -1)
        sizes = equal.groupBy("key", "portion").agg(F.count("*").alias("held"))
        sizes = sizes.select(F.col("key").alias("k"), F.col("portion").alias("q"), F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("earlier"))
        numbered = equal.withColumn("number", F.row_number().over(Window.partitionBy("key", "portion").orderBy("mark")))
        numbered = numbered.join(materialize(sizes, "portions"), (F.col("key") == F.col("k")) & (F.col("portion") == F.col("q")))
        numbered = numbered.withColumn("sampled", F.col("earlier") + F.col("number") <= F.col("some"))
        all_rows = all_rows.where(~last).unionByName(numbered.select(*rows.columns, "sampled"))
    return all_rows.withColumn("copies", F.when(F.col("size") > 0, F.col("certain") + F.col("sampled").cast("long")).otherwise(0).cast("long"))


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    return materialize(_drawn(docs, seed, F.col("doc_id")), "sized")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE, most: int = MOST, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies: what the mix takes of every document."""
    sized = _sized(docs, seed)
    rates, marks = _plan(sized, weights, share, most)
    found = _copies(_ranked(sized, rates), marks)
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE, most: int = MOST, seed: int = SEED) -> DataFrame:
    """The rows of ``docs``, all columns as they were, each as often as the mix takes it."""
    rates, marks = _plan(_sized(docs, seed), weights, share, most)
    drawn = _drawn(docs, seed, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id"))
    found = _copies(_ranked(drawn, rates), marks).where("copies > 0")
    return found.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
