import math

import pytest
from pyspark.sql import functions as F

from regiostar import schema
from regiostar.operators import profile, quality, quantiles
from regiostar.plans import dashboard
from regiostar.plans.runs import RunConfig, run_incremental


def outcome(df, *rules):
    return [(r["unexpected_count"], r["missing_count"], r["success"]) for r in quality.evaluate(df, rules).collect()]


def test_rules_at_their_bounds(table):
    df = table("n int, s string", *[(i, "A") for i in range(19)], (99, None))
    assert outcome(
        df,
        quality.not_null("n"), quality.not_null("s"),
        quality.in_set("n", list(range(19)), mostly=0.95), quality.in_set("n", list(range(19)), mostly=0.951),
        quality.in_set("s", ["A"]),
        quality.between("n", low=0), quality.between("n", low=0, high=99), quality.between("n", low=1, high=98),
        quality.row_count_between(20, 20), quality.row_count_between(21, None), quality.row_count_between(None, 19),
        quality.max_length("s", 1), quality.max_length("s", 0),
    ) == [
        (0, 0, True), (1, 1, False), (1, 0, True), (1, 0, False), (0, 1, True), (0, 0, True), (0, 0, True), (2, 0, False),
        (0, 0, True), (0, 0, False), (0, 0, False), (0, 1, True), (19, 1, False),
    ]


def test_rules_on_an_empty_table(table):
    df = table("n int", (1,)).limit(0)
    assert outcome(df, quality.not_null("n"), quality.in_set("n", [1]), quality.row_count_between(1, None)) == [
        (0, 0, True), (0, 0, True), (0, 0, False),
    ]


def test_decimal_precision(table):
    df = table("v double", (99999999999.9999,), (1e11,), (None,))
    assert outcome(df, quality.fits_decimal("v", 15, 4)) == [(1, 1, False)]


def test_gate_passes_or_names_every_failure(spark, cohort, tmp_path):
    rows = cohort((2015, 1, "OFICIAL", 1, 1), (2015, 1, "OTRO", 9, -4))
    history = str(tmp_path / "results")
    assert quality.gate(rows, [quality.not_null("vigencia")], history, "r1") is rows
    with pytest.raises(quality.QualityGateError) as error:
        quality.gate(rows, quality.standard_suite(min_rows=1, max_rows=2), history, "r2")
    text = str(error.value)
    assert "3 of 6 rules failed" in text
    assert "sector_ies" in text and "'OTRO'" in text and "estrato_socioeconomico" in text and "'-4'" in text
    stored = spark.read.parquet(history)
    assert {(r[0], r[1]) for r in stored.groupBy("run_id").count().collect()} == {("r1", 1), ("r2", 6)}
    found = quality.failures(rows, quality.standard_suite(min_rows=1, max_rows=2))
    assert [f["sample"] for f in found] == [["OTRO"], ["9"], ["-4"]]


def test_suite_takes_source_names(table):
    df = table(
        "VIGENCIA int, CODE int, SECTOR string, STRATUM int, N int", *[(2015, 1, "PRIVADA", 6, 0)] * 3
    )
    rules = quality.standard_suite("VIGENCIA", "CODE", "SECTOR", "STRATUM", "N", min_rows=3, max_rows=3)
    assert all(r["success"] for r in quality.evaluate(df, rules).collect())


def test_table_constraints_flag_long_text(cohort):
    rows = cohort((2015, 1, "X" * 51, 1, 1)).withColumn(schema.MACRO_VALUE, F.lit(None).cast("double"))
    failed = [r["column"] for r in quality.evaluate(rows, quality.table_constraints()).filter("not success").collect()]
    assert failed == ["sector_ies"]


def test_duplicates(table):
    df = table("a int, b string", (1, None), (1, None), (1, "x"), (2, None), (1, None))
    assert tuple(profile.duplicate_rows(df).first()) == (5, 2)
    assert [tuple(r) for r in quality.duplicate_keys(df, ["a", "b"]).collect()] == [(1, None, 3)]


def test_null_report_and_column_info(table):
    df = table("a int, `b c` string", *[(None if i == 0 else i, "x") for i in range(20)])
    assert [tuple(r) for r in profile.null_report(df).collect()] == [("a", 1, 5.0, False), ("b c", 0, 0.0, False)]
    assert [tuple(r) for r in profile.column_info(df).collect()] == [("a", "int", 19), ("b c", "string", 20)]


def test_outliers(spark):
    df = spark.range(1, 11).toDF("n").unionByName(spark.createDataFrame([(100,), (None,)], "n long"))
    report = profile.outlier_report(df, "n").first()
    assert (report["q1"], report["q3"], report["upper_bound"], report["outliers"], report["total_rows"]) == (3.5, 8.5, 16.0, 1, 12)
    assert [r["n"] for r in profile.outlier_rows(df, "n").collect()] == [100]


def test_describe_equals_pandas(spark):
    df = spark.range(100).select((F.col("id") % 17).alias("a"), (F.col("id") * 0.37).alias("b"), F.lit("t").alias("c"))
    expected = df.toPandas()[["a", "b"]].describe()
    for r in profile.describe(df).collect():
        want = expected[r["column"]]
        got = [r[k] for k in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")]
        assert got == pytest.approx(list(want))


def test_quantiles_around_sketched_ends(spark, table, monkeypatch):
    monkeypatch.setattr(quantiles, "SKETCH_ACCURACY", 100)
    n = 5000
    df = spark.range(n).select(
        ((F.col("id") * 7919) % n * 0.5).alias("spread"),
        F.when(F.col("id") % 3 > 0, 4.0).otherwise(F.col("id")).alias("tied"),
        F.when(F.col("id") < 4, F.col("id") * 1e300).otherwise(F.col("id") * 1e-300).alias("far apart"),
        F.when(F.col("id") % 2 == 0, -F.col("id")).alias("half null"),
        F.lit(None).cast("int").alias("null"),
        F.when(F.col("id") % 5 == 0, float("inf")).otherwise(F.col("id")).alias("infinite"),
    )
    data = df.toPandas()
    for r in profile.describe(df).collect():
        column = data[r["column"]].dropna().astype(float)
        want = [column.quantile(p) if len(column) else None for p in (0.25, 0.5, 0.75)]
        assert [r["q25"], r["q50"], r["q75"]] == pytest.approx(want), r["column"]
    sketched = {"spread": ([600.0, 650.0, 1225.0, 1275.0, 1850.0, 1900.0], n)}
    narrowed = quantiles.narrowed_counts(df, {"spread": quantiles.brackets_of(*sketched["spread"])})
    assert narrowed.count() == 3 * 101 + 4 and narrowed.agg(F.sum("_count")).first()[0] == n
    wrong = {"spread": ([0.0, 1.0, 2.0, 3.0, 4.0, 5.0], n)}
    for ends in (sketched, wrong):
        found = quantiles.column_quantiles(df, ends, [0.25, 0.5, 0.75]).first()["quantiles"]
        assert found == pytest.approx(list(data["spread"].quantile([0.25, 0.5, 0.75])))


def test_describe_counts_nan_as_greatest_and_takes_no_rows(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "SKETCH_ACCURACY", 100)
    df = spark.range(1001).select(F.when(F.col("id") > 600, float("nan")).otherwise(F.col("id")).alias("a b"))
    row = profile.describe(df).first()
    assert (row["q25"], row["q50"]) == (250.0, 500.0) and row["q75"] != row["q75"]
    empty = profile.describe(df.limit(0)).first()
    assert (empty["count"], empty["q50"], empty["max"]) == (0, None, None)


def test_histogram_closes_its_last_bin(table):
    df = table("n int", *[(i,) for i in (1, 1, 2, 50, 50, 51, 60)])
    bins = {r["bin"]: r["rows"] for r in profile.histogram(df, "n").collect()}
    assert bins == {0: 2, 1: 1, 49: 2}
    same = profile.histogram(table("n int", (5,), (5,)), "n", bins=2).collect()
    assert [(r["bin"], r["from"], r["to"], r["rows"]) for r in same] == [(1, 5.0, 5.5, 2)]


def test_geo_column_prefers_the_first_candidate(table):
    df = table("DP string, Municipio string", ("1", "b"), ("2", "a"), ("3", None))
    assert [tuple(r) for r in profile.geo_key_audit(df).collect()] == [("Municipio", "a"), ("Municipio", "b")]
    with pytest.raises(ValueError, match="no geographic column"):
        profile.geo_column(df.drop("DP", "Municipio"))


def test_counts_pivot_and_ranges(table):
    df = table("y int, s string, n int", (1, "a", 1), (1, "b", 2), (2, "a", 4), (2, None, 8))
    assert [tuple(r) for r in profile.value_frequencies(df, "s", 1).collect()] == [("a", 2)]
    assert {r[0]: r[1] for r in profile.distinct_counts(df, ["y", "s"]).collect()} == {"y": 2, "s": 2}
    assert sorted(tuple(r) for r in profile.yearly_pivot(df, "y", "s", "n", ["a", "b"]).collect()) == [(1, 1, 2), (2, 4, None)]
    assert tuple(profile.key_range(df, "y", "s").first()) == (1, 2, 4, 1, 25.0)
    assert tuple(profile.comma_count(table("t string", ("a,b",), ("c",), (None,)), "t").first()) == (3, 1)
    assert [r[0] for r in profile.preview(df, ["n"], 2).select("n").collect()] == [1, 2]


def test_dashboard(table):
    mart = table(
        "vigencia int, departamento string, sector_ies string, pib_miles_millones_promedio decimal(19,4), "
        "total_beneficiarios long, densidad_credito_pib double, variacion_yoy_pct double",
        (2015, "A", "OFICIAL", None, 1, None, None), (2015, "A", "PRIVADO", None, 3, None, -5.0), (2015, "B", "OFICIAL", None, 4, None, 5.0),
    )
    shares = {tuple(r)[:-2]: float(r[-1]) for r in dashboard.sector_shares(mart, ("vigencia", "departamento")).collect()}
    assert shares == {(2015, "A", "OFICIAL"): 25.0, (2015, "A", "PRIVADO"): 75.0, (2015, "B", "OFICIAL"): 100.0}
    assert dashboard.density_points(mart).isEmpty()
    assert dashboard.mart_slice(mart, years=[2015], regions=["A"], sectors=["PRIVADO"], max_change=0).count() == 1
    assert dashboard.mart_slice(mart, min_change=0).count() == 1
    assert dashboard.yearly_evolution(mart).first()["total_beneficiarios"] == 8
    assert not math.isnan(shares[2015, "A", "OFICIAL"])


def test_an_incremental_run_needs_rules(spark, tmp_path):
    with pytest.raises(ValueError, match="rules"):
        run_incremental(spark, RunConfig("nowhere", str(tmp_path)))


def test_duplicate_rows_with_nulls_and_equal_digests(spark, table):
    rows = [(1, None, 0.0), (1, None, -0.0), (None, "1", 0.0), (None, None, None), (None, None, None), (2, "", float("nan")), (2, "", float("nan"))]
    df = table("`a b` int, b string, c double", *rows)
    doubled = df.select(F.col("a b").alias("_a"), F.col("b").alias("_a_b"), F.col("c").alias("_copies"))
    one_digest = lambda columns: F.struct(F.lit(1).alias("a"), F.lit(1).alias("b"))
    for given in (df, doubled):
        assert tuple(profile.duplicate_rows(given).first()) == (7, 3)
        assert tuple(profile.duplicate_rows(given, one_digest).first()) == (7, 3)
    assert tuple(profile.duplicate_rows(df.limit(0)).first()) == (0, 0)
    swapped = table("a string, b string", ("x", None), (None, "x"), ("x", "y"), ("y", "x"))
    assert tuple(profile.duplicate_rows(swapped).first()) == (4, 0)
