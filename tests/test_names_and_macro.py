import math
import random

import pytest
from pyspark.sql import functions as F

from regiostar import schema
from regiostar.functions.similarity import indel_ratio, position_masks
from regiostar.operators import fuzzy, merge
from regiostar.operators.numbering import number_rows
from regiostar.operators.quantiles import quantiles_of_counts, value_counts
from regiostar.operators.sums import band_means, band_sums
from regiostar.operators.typing import inferred_types, optimise_types
from tests.test_functions import plain, score


def brute_force(sources, targets, threshold):
    best = {}
    for raw in {s for s in sources if s is not None}:
        text = plain(raw.strip().upper())
        ranked = sorted((-score(text, plain(t)), t) for t in {t for t in targets if t is not None})
        found = ranked and -ranked[0][0] >= threshold
        best[raw] = (ranked[0][1], round(-ranked[0][0], 6)) if found else (None, None)
    return best


def mapped(table, sources, targets, threshold):
    df = fuzzy.map_names(
        table("s string", *[(s,) for s in sources]), "s", table("t string", *[(t,) for t in targets]), "t", threshold
    )
    return {r["raw"]: (r["canonical"], r["score"] and round(r["score"], 6)) for r in df.collect()}


def noisy(rng, name):
    chars = list(name)
    for _ in range(rng.randint(0, 4)):
        at = rng.randrange(len(chars) + 1)
        if rng.random() < 0.5 and chars:
            chars.pop(min(at, len(chars) - 1))
        else:
            chars.insert(at, rng.choice("AEDR "))
    return "".join(chars)


@pytest.mark.parametrize("threshold", [60.0, 85.0, 100.0])
def test_blocking_loses_no_match(table, threshold):
    rng = random.Random(int(threshold))
    targets = ["".join(rng.choice("AAEDR") + rng.choice(["", "", " "]) for _ in range(rng.randint(1, 9))) for _ in range(40)]
    targets += ["NORTE DE SANTANDER", "SANTANDER", "VALLE DEL CAUCA", "CAUCA", "", "X" * 70 + "Y" * 10]
    sources = [noisy(rng, rng.choice(targets)) for _ in range(60)] + ["", "Q", "X" * 69 + "Y" * 9, None]
    assert mapped(table, sources, targets, threshold) == brute_force(sources, targets, threshold)


def test_ties_take_the_smaller_name_and_nulls_drop(table):
    found = mapped(table, ["ABCD EFGH", None], ["ABCD EFGX", "ABCD EFGA", None], 85.0)
    assert found == {"ABCD EFGH": ("ABCD EFGA", round(200 * 8 / 18, 6))}


def test_targets_are_not_upper_cased(table):
    assert mapped(table, ["meta"], ["meta"], 85.0) == {"meta": (None, None)}


def test_threshold_must_be_a_percentage(table):
    with pytest.raises(ValueError):
        fuzzy.map_names(table("s string", ("a",)), "s", table("s string", ("a",)), "s", 0)


def macro(table, *items):
    return table("a_o string, departamento string, valor double, code float", *items)


def test_merge_imputes_by_row_weighted_year_median(table, cohort):
    rows = cohort(
        *[(2018, 1, "OFICIAL", 1, 1)] * 3, (2018, 2, "OFICIAL", 1, 1), (2018, 3, "OFICIAL", 1, 1), (2018, None, "OFICIAL", 1, 1),
        (2017, 1, "OFICIAL", 1, 1),
    )
    records = macro(
        table, ("2018", "region 1", 10.0, 1.0), ("2018", "Región 1", 20.0, 1.0), ("2018.0", "REGION 2", 40.0, 2.0),
        ("2018", "elsewhere", 99.0, 9.0), ("bad", "REGION 2", 7.0, 2.0), (None, "REGION 3", 7.0, 3.0),
    )
    merged = merge.merge_macro(rows, records, threshold=95.0)
    found = sorted((r["vigencia"], r["departamento"] or "", r["valor"]) for r in merged.rows.collect())
    # Four rows carry a value: 15, 15, 15 and 40, whose median is 15; regions would give 27.5.
    assert found == sorted(
        [(2017, "REGION 1", None), (2018, "", 15.0), (2018, "REGION 3", 15.0), (2018, "REGION 2", 40.0)]
        + [(2018, "REGION 1", 15.0)] * 3,
        key=lambda x: (x[0], x[1]),
    )
    assert tuple(merged.unmatched().first())[:2] == (7, 3)
    assert [tuple(r) for r in merged.top_unmatched().collect()] == [("REGION 1", 1), ("REGION 3", 1)]
    assert {r[0]: r[1] for r in merged.residual_nulls().collect()} == {"code": 1, "valor": 1}
    assert merged.columns == ["code", "valor"]


def test_merge_renames_colliding_columns(table, cohort):
    rows = cohort((2018, 1, "OFICIAL", 1, 1)).withColumn("valor", F.lit("mine"))
    merged = merge.merge_macro(rows, macro(table, ("2018", "REGION 1", 5.0, 1.0)))
    assert merged.rows.select("valor", "valor_api").first() == ("mine", 5.0)


def test_merge_without_rows_or_matches_is_an_error(table, cohort):
    records = macro(table, ("2018", "elsewhere", 5.0, 1.0))
    with pytest.raises(RuntimeError, match="no macro region"):
        merge.merge_macro(cohort((2018, 1, "OFICIAL", 1, 1)), records)
    with pytest.raises(RuntimeError, match="empty"):
        merge.merge_macro(cohort((2018, 1, "OFICIAL", 1, 1)).limit(0), records)
    with pytest.raises(KeyError, match="a_o"):
        merge.merge_macro(cohort((2018, 1, "OFICIAL", 1, 1)), records.drop("a_o"))


def test_numbering_by_parts_equals_one_task(spark, rows):
    df = spark.range(1000).select((F.col("id") % 7).cast("string").alias("a"), F.hash("id").alias("b"))
    one = number_rows(df, ["a", "b"], "sk", start=10)
    parts = number_rows(df, ["a", "b"], "sk", start=10, single_task_rows=0)
    assert rows(one) == rows(parts)
    assert {r["sk"] for r in parts.collect()} == set(range(11, 1011))


@pytest.mark.parametrize("group", [[], ["g"]])
def test_quantiles_by_rank_equal_one_task(spark, group):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 5).cast("string"))).alias("g"),
        F.when(F.col("id") % 11 > 0, F.hash("id") % 400).alias("v"),
    )
    counts = value_counts(df, group, "v")
    probabilities = [0.0, 0.25, 0.5, 0.9, 1.0]
    one = quantiles_of_counts(counts, group, "v", probabilities)
    many = quantiles_of_counts(counts, group, "v", probabilities, single_task_values=0)

    def table_of(result):
        return {tuple(r[g] for g in group): [round(x, 9) for x in r["quantiles"]] for r in result.collect()}

    assert table_of(one) == table_of(many)
    frame = df.toPandas().dropna()
    if not group:
        assert table_of(many)[()] == pytest.approx(list(frame.v.quantile(probabilities)))
    else:
        for (g,), found in table_of(many).items():
            assert found == pytest.approx(list(frame[frame.g == g].v.quantile(probabilities)))


def test_type_inference(table):
    items = [(str(i), "x" if i == 0 else "1.5", "2020-01-01", "a", f"t{i}", None) for i in range(10)]
    df = table("n string, mostly string, fecha string, cat string, free string, none string", *items)
    kinds = {r["column"]: r["inferred"] for r in inferred_types(df).collect()}
    assert kinds == {"n": "float", "mostly": "float", "fecha": "timestamp", "cat": "category", "free": "string", "none": "category"}
    typed = optimise_types(df)
    assert [t for _, t in typed.dtypes] == ["float", "float", "timestamp", "string", "string", "string"]
    assert typed.filter("mostly IS NULL").count() == 1
    below = table("m string", *[("x" if i < 2 else "1",) for i in range(10)])
    assert inferred_types(below).first()["inferred"] == "category"


def test_schema_defaults():
    assert schema.MATCH_THRESHOLD == 85.0 and len(schema.COHORT_FIELDS) == 13


def plain_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
            diagonal = above
    return row[-1]


def test_scores_of_long_texts(spark):
    rng = random.Random(3)
    pairs = [
        tuple("".join(rng.choice(letters) for _ in range(size)) for size in (rng.randint(1, n + 40), n))
        for n in (1, 60, 61, 62, 122, 123, 183, 300, 500)
        for letters in ("ab", "abcdé日", "abcdefghijklmnopqrstuvwxyz ")
    ]
    frame = spark.createDataFrame(pairs, "l string, r string").withColumn("masks", position_masks("r"))
    for left, right, score in frame.select("l", "r", indel_ratio("l", "r", "masks")).collect():
        assert abs(score - 200 * plain_common(left, right) / (len(left) + len(right))) < 1e-9


def test_candidates_of_names_with_a_common_word(spark):
    """At 85 under 5 % of all pairs are compared, and no threshold loses a pair of the full comparison."""
    rng = random.Random(4)
    syllables = "RA MO LI TE NO SU GA PE CHI BO VAR DEL QUI TAN FU ZE".split()
    names = sorted({"MUNICIPIO " + "".join(rng.choice(syllables) for _ in range(rng.randint(5, 8))) for _ in range(400)})
    sources = spark.createDataFrame([(n,) for n in names], "source string")
    targets = sources.withColumnRenamed("source", "target")
    few = names[:25]
    full = [(a, b, 200 * plain_common(a, b) / (len(a) + len(b))) for a in few for b in few]
    for threshold in (40.0, 60.0, 85.0):
        found = fuzzy.candidate_pairs(sources.where(F.col("source").isin(few)), targets.where(F.col("target").isin(few)), threshold)
        assert {(a, b) for a, b, s in full if s >= threshold} <= {tuple(r) for r in found.collect()}
    assert fuzzy.candidate_pairs(sources, targets, 85.0).count() < 0.05 * len(names) ** 2


def test_means_do_not_depend_on_the_order_of_rows(spark):
    draw = random.Random(3)
    numbers = [draw.uniform(-1, 1) * 10.0 ** draw.randint(-30, 30) for _ in range(2000)] + [0.1] * 50 + [0.0, -0.0, 1e300, -1e300, 5e-324]
    rows = [(i % 3, "x", v, float(i)) for i, v in enumerate(numbers)] + [(3, "x", float("inf"), None), (3, "x", 2.0, None), (4, "x", None, None)]
    found = set()
    for parts in (1, 3, 8):
        draw.shuffle(rows)
        df = spark.createDataFrame(rows, "year int, name string, a double, b float").repartition(parts)
        sums = band_sums(df, {"year": F.col("year"), "raw": F.col("name")}, ["a", "b"])
        types = {f.name: f.dataType for f in df.schema.fields}
        means = band_means(sums, ["year", "raw"], ["a", "b"], types).orderBy("year").collect()
        found.add(tuple(means))
    assert len(found) == 1
    for year in range(3):
        mine = [(a, b) for y, _, a, b in rows if y == year]
        assert means[year]["a"] == pytest.approx(math.fsum(a for a, _ in mine) / len(mine), rel=1e-12)
        assert means[year]["b"] == pytest.approx(sum(b for _, b in mine) / len(mine), rel=1e-7)
    assert [(m["a"], m["b"]) for m in means[3:]] == [(float("inf"), None), (None, None)]
    assert band_means(band_sums(df, {"year": F.col("year")}, []), ["year"], [], {}).count() == 5
