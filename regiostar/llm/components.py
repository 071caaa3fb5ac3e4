"""Connected components of a table of links, by passing on the smallest label and jumping along labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiostar.session import materialize


def components(links: DataFrame) -> DataFrame:
    """v, label for every end of a link (columns a, b of any ordered type); the label is the smallest v it reaches.

    Every round each vertex takes the smallest label among its own, its neighbours', and that of its label, so the
    number of rounds grows with the logarithm of the longest chain. Rounds are written tables.
    """
    both = materialize(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = materialize(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        seen = both.join(labels, F.col("b") == F.col("v")).groupBy("a").agg(F.min("label").alias("near"))
        jump = labels.select(F.col("v").alias("at"), F.col("label").alias("far"))
        nearer = labels.join(seen, F.col("v") == F.col("a"), "left").join(jump, F.col("label") == F.col("at"), "left")
        moved = materialize(nearer.select("v", F.col("label").alias("old"), F.least("label", "near", "far").alias("label")), "labels")
        labels = moved.select("v", "label")
        if not moved.where("old <> label").take(1):
            return labels
