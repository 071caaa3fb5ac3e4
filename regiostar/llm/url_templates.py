"""URL filter: a tree of path templates per host, judged by smoothed labelled purity.

Every path becomes a sequence of segments; numbers, identifiers and file endings inside a segment are generalised
first. The tree is then built level by level on distinct (host, path shape) rows, never on single pages:

- a segment position with many values, of which each has few of the distinct shapes below or none has much of them,
  becomes the wildcard ``*``; repeated pages do not count;
- sibling branches whose labelled block rate does not differ significantly from that of their siblings taken
  together (two-proportion test) are merged into one branch ``~``; the others stay apart.

Labels come from the rules: a page that a rule fits is a labelled example. A template's block rate is smoothed
towards that of the same template over all hosts, which is smoothed towards the overall rate. A template with a
smoothed rate of at least ``reject`` is rejected. A page's verdict is its rule's, else that of its template.

Defined results: a null url, or one without ``://``, has an empty host and path and is judged as that template; ties
between rules of equal length go to the smaller rule; every row gives a row; an empty table gives an empty result;
other columns are ignored. Segments beyond ``DEPTH`` are judged together as the tail of the template.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostar.session import materialize

DEPTH = 6
#: A position is variable if it has at least so many values, and so many for each distinct shape below it, or if its
#: values count, by their shares of the shapes, as at least MANY / VARIETY equally frequent ones.
MANY, VARIETY = 16, 0.2
Z = 1.96
PRIOR = 4.0
REJECT = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest of a short list of rules ``host/path`` that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), [-ord(c) for c in r])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def shape(path: Column) -> Column:
    """Segments of a path: identifiers and numbers generalised, the empty end of ``/a/`` dropped."""
    cleaned = F.regexp_replace(path, r"^/|/$", "")
    segments = F.when(cleaned == "", F.array().cast("array<string>")).otherwise(F.split(cleaned, "/"))

    def general(s: Column) -> Column:
        s = F.regexp_replace(F.lower(s), r"[0-9a-f]{8}-[0-9a-f-]{27}|[0-9a-f]{16,}", "{x}")
        return F.regexp_replace(s, r"[0-9]+", "{n}")

    short = F.transform(segments, general)
    tail = F.array(F.array_join(F.slice(short, DEPTH + 1, 1_000_000), "/"))
    return F.when(F.size(short) > DEPTH, F.concat(F.slice(short, 1, DEPTH), tail)).otherwise(short)


def templates(labelled: DataFrame) -> DataFrame:
    """host, shape, template of every distinct shape; ``labelled`` has host, shape, n, n_block, n_labelled.

    The template of a shape is the string of its generalised segments.
    """
    rows = labelled.withColumn("template", F.lit(""))
    for level in range(DEPTH + 1):
        value = F.get("shape", F.lit(level))
        rows = rows.withColumn("value", value)
        if not rows.where(F.col("value").isNotNull()).take(1):
            break
        children = rows.where(F.col("value").isNotNull()).groupBy("host", "template", "value").agg(
            F.count("*").alias("shapes"), F.sum("n_block").alias("b"), F.sum("n_labelled").alias("l")
        )
        nodes = children.groupBy("host", "template").agg(
            F.count("value").alias("kinds"), F.sum("shapes").alias("all_shapes"),
            F.sum(F.col("shapes").cast("double") * F.col("shapes")).alias("squares"), F.sum("b").alias("all_b"), F.sum("l").alias("all_l")
        )
        pooled = F.try_divide(F.col("all_b"), F.col("all_l"))
        error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), F.col("l")) + F.try_divide(F.lit(1.0), F.col("all_l"))))
        apart = F.when((F.col("l") > 0) & (F.col("all_l") > F.col("l")), F.abs(F.try_divide(F.col("b"), F.col("l")) - pooled) > Z * error).otherwise(F.col("l") > 0)
        few_each = F.col("kinds") >= VARIETY * F.col("all_shapes")
        spread = F.col("all_shapes").cast("double") * F.col("all_shapes") >= MANY / VARIETY * F.col("squares")
        branch = (
            F.when((F.col("kinds") >= MANY) & (few_each | spread), F.lit("*"))
            .when((F.col("kinds") > 1) & ~F.coalesce(apart, F.lit(False)) & (F.col("l") > 0), F.lit("~"))
            .otherwise(F.col("value"))
        )
        named = materialize(children.join(nodes, ["host", "template"]).select("host", "template", "value", branch.alias("branch")), "branches")
        rows = rows.join(named, ["host", "template", "value"], "left")
        rows = materialize(rows.withColumn("template", F.when(F.col("branch").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), "branch"))).drop("branch", "value"), "templates")
    return rows.drop("value")


def verdicts(pages: DataFrame, rules: dict[str, str], reject: float = REJECT) -> DataFrame:
    """page_id, host, path, rule, verdict, template, block_rate of every page."""
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parsed = parsed.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("shape", shape(F.col("path")))
    verdict = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])[F.col("rule")] if rules else F.lit(None).cast("string")
    parsed = materialize(parsed.withColumn("ruled", verdict), "parsed-urls")
    block = F.when(F.col("ruled") == "block", 1).otherwise(0)
    shapes = parsed.groupBy("host", "shape").agg(F.count("*").alias("n"), F.sum(block).alias("n_block"), F.count("ruled").alias("n_labelled"))
    found = templates(materialize(shapes, "url-shapes"))

    def smoothed(b: Column, l: Column, towards: Column) -> Column:
        return (b + PRIOR * towards) / (l + PRIOR)

    # What holds for a template's last segments on all hosts, labelled or not, is the prior of each host's template.
    total = found.agg(F.sum("n_block"), F.sum("n_labelled")).first()
    overall = (total[0] or 0) / total[1] if total[1] else 0.0
    overall = math.floor(overall * 1e12) / 1e12
    path_shape = F.array_join("shape", "/").alias("path_shape")
    common = found.groupBy(path_shape).agg(F.sum("n_block").alias("cb"), F.sum("n_labelled").alias("cl"))
    common = common.select("path_shape", smoothed(F.col("cb"), F.col("cl"), F.lit(overall)).alias("prior"))
    own = found.select("*", path_shape).join(common, "path_shape")
    rates = own.groupBy("host", "template").agg(
        F.sum("n_block").alias("b"), F.sum("n_labelled").alias("l"), (F.sum(F.col("prior") * F.col("n")) / F.sum("n")).alias("prior")
    )
    rates = rates.select("host", "template", F.round(smoothed(F.col("b"), F.col("l"), F.col("prior")), 9).alias("block_rate"))
    judged = materialize(found.select("host", "shape", "template").join(rates, ["host", "template"]), "url-verdicts")
    method = F.when(F.col("block_rate") >= reject, "block").otherwise("allow")
    return parsed.join(judged, ["host", "shape"]).select(
        "page_id", "host", "path", "rule", F.coalesce(F.col("ruled"), method).alias("verdict"), "template", "block_rate"
    )
