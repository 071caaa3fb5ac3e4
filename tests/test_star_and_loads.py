import pytest
from pyspark.sql import functions as F

from regiostar import schema
from regiostar.operators import star
from regiostar.plans.mart import MART_COLUMNS, credit_mart, mart_base, mart_from_base
from regiostar.plans.warehouse import Warehouse
from regiostar.streaming.batches import load_batches


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def with_gdp(rows, value=2.5):
    return rows.withColumn(schema.MACRO_VALUE, F.lit(value).cast(schema.MACRO_VALUE_TYPE))


def facts(warehouse):
    period = warehouse.dimension(schema.PERIOD).select("sk_period", F.col("vigencia").alias("year"))
    joined = warehouse.fact().join(period, "sk_period").filter("year = vigencia")
    return sorted((r["vigencia"], r["total_nuevos_beneficiarios"]) for r in joined.collect())


def keys(warehouse):
    return {
        d.table: {tuple(r[n] for n in d.names): r[d.key] for r in warehouse.dimension(d).collect()}
        for d in schema.DIMENSIONS
    }


def test_dimensions_number_distinct_members(cohort):
    rows = cohort((2016, 2, "PRIVADO", 1, 1), (2015, 1, None, 2, 1), (2015, 1, "OFICIAL", 2, 1), (2016, 2, "PRIVADO", 1, 9))
    dims = star.new_dimensions(rows)
    assert sorted(tuple(r) for r in dims["dim_period"].collect()) == [(1, 2015, "S1"), (2, 2016, "S1")]
    assert sorted(tuple(r)[:2] for r in dims["dim_program"].collect()) == [(1, None), (2, "OFICIAL"), (3, "PRIVADO")]


def test_null_keys_match_only_in_the_null_safe_lookup(cohort):
    rows = cohort((2015, 1, None, 2, 1), (2015, 1, "OFICIAL", 2, 3), (2015, None, "OFICIAL", 2, 5))
    dims = star.new_dimensions(rows)
    assert star.fact_rows(rows, dims).dropna(subset=schema.SURROGATE_KEYS).count() == 3
    accepted, rejected = star.resolved_fact(with_gdp(rows), dims)
    assert [r["total_nuevos_beneficiarios"] for r in accepted.collect()] == [3]
    assert sorted(r["total_nuevos_beneficiarios"] for r in rejected.collect()) == [1, 5]


def test_orphans_are_counted_per_dimension(cohort):
    rows = cohort((2015, 1, "OFICIAL", 2, 1), (2016, 1, "OFICIAL", 2, 1), (2016, 1, "OFICIAL", 3, 1))
    dims = star.new_dimensions(rows)
    fact = star.fact_rows(rows, dims)
    assert {r[0]: r[1:] for r in star.orphan_counts(fact, dims).collect()} == {d.table: (0, 0) for d in schema.DIMENSIONS}
    dims["dim_period"] = dims["dim_period"].filter("vigencia = 2015")
    assert {r[0]: r[1:] for r in star.orphan_counts(fact, dims).collect()}["dim_period"] == (1, 2)


def test_rerun_changes_nothing(warehouse, cohort):
    rows = with_gdp(cohort((2015, 1, "OFICIAL", 1, 10), (2015, 1, "OFICIAL", 1, 10), (2016, 2, "PRIVADO", 2, 5)))
    warehouse.load(rows)
    before = facts(warehouse), keys(warehouse)
    warehouse.load(rows)
    assert (facts(warehouse), keys(warehouse)) == before
    assert before[0] == [(2015, 10), (2015, 10), (2016, 5)]
    assert warehouse.fact().select(schema.MACRO_VALUE).distinct().first()[0] == pytest.approx(2.5)


def test_keys_are_stable_and_new_members_continue(warehouse, cohort):
    warehouse.load(with_gdp(cohort((2016, 5, "PRIVADO", 2, 1))))
    first = keys(warehouse)
    warehouse.load(with_gdp(cohort((2015, 1, "OFICIAL", 1, 1), (2016, 5, "PRIVADO", 2, 1), (2017, 9, "OFICIAL", 3, 1))))
    second = keys(warehouse)
    for table, members in first.items():
        for natural, sk in members.items():
            assert second[table][natural] == sk
        assert sorted(second[table].values()) == list(range(1, len(second[table]) + 1))


def test_years_of_the_batch_are_replaced_even_if_all_rows_are_rejected(warehouse, cohort):
    warehouse.load(with_gdp(cohort((2015, 1, "OFICIAL", 1, 1), (2016, 1, "OFICIAL", 1, 2), (2017, 1, "OFICIAL", 1, 3))))
    untouched = [e for e in warehouse.current()[1] if e[0] == schema.FACT_TABLE and e[1] == "2015"]
    rejected = warehouse.load(with_gdp(cohort((2016, 1, "OFICIAL", 1, 20), (2017, None, "OFICIAL", 1, 30), (None, 1, "OFICIAL", 1, 40))))
    assert facts(warehouse) == [(2015, 1), (2016, 20)]
    assert sorted(r["total_nuevos_beneficiarios"] for r in rejected.collect()) == [30, 40]
    assert untouched == [e for e in warehouse.current()[1] if e[0] == schema.FACT_TABLE and e[1] == "2015"]


def test_a_load_that_fails_leaves_the_tables_as_they_were(warehouse, cohort):
    warehouse.load(with_gdp(cohort((2015, 1, "OFICIAL", 1, 1))))
    before = warehouse.current(), facts(warehouse), keys(warehouse)

    def fail():
        raise OSError("lost")

    with pytest.raises(OSError):
        warehouse.load(with_gdp(cohort((2015, 2, "PRIVADO", 3, 9), (2016, 1, "OFICIAL", 1, 9))), before_publish=fail)
    assert (warehouse.current(), facts(warehouse), keys(warehouse)) == before


def test_full_refresh_drops_what_was_there(warehouse, cohort):
    warehouse.load(with_gdp(cohort((2010, 7, "PRIVADO", 3, 9))))
    warehouse.replace_all(cohort((2015, 1, None, 1, 1), (2016, 1, "OFICIAL", 1, 2)))
    assert facts(warehouse) == [(2015, 1), (2016, 2)]
    assert list(keys(warehouse)["dim_geography"]) == [(1, "REGION 1", "CAT")]
    assert warehouse.fact().filter(F.col(schema.MACRO_VALUE).isNotNull()).isEmpty()
    warehouse.replace_all(cohort((None, 1, None, 1, 7), (2016, 1, "OFICIAL", 1, 2)))
    assert sorted(r["total_nuevos_beneficiarios"] for r in warehouse.fact().collect()) == [2, 7]


def mart_rows(df):
    return {(r["vigencia"], r["departamento"], r["sector_ies"]): r for r in df.collect()}


def test_mart_windows(cohort):
    rows = with_gdp(
        cohort(
            (2015, 1, "OFICIAL", 1, 0), (2015, 1, "PRIVADO", 2, 3), (2015, 1, "PRIVADO", 9, 100), (2015, 1, "NO CLASIFICADO", 1, 50),
            (2017, 1, "OFICIAL", 3, 4), (2017, 1, "PRIVADO", 1, 2), (2018, 1, "OFICIAL", 1, 5),
            (2017, 2, "OFICIAL", 1, 4), (2017, 3, "OFICIAL", 1, 3),
        ),
        3.0,
    )
    dims = star.new_dimensions(rows)
    fact, _ = star.resolved_fact(rows, dims)
    mart = credit_mart(fact, dims)
    assert mart.columns == MART_COLUMNS
    assert [r[0] for r in mart.collect()] == sorted(r[0] for r in mart.collect())
    found = mart_rows(mart)
    assert len(found) == 7  # strata above 3 and other sectors are out of scope
    first = found[2015, "REGION 1", "OFICIAL"]
    assert (first["participacion_sector_pct"], first["beneficiarios_anio_anterior"], first["variacion_yoy_pct"]) == (0, None, None)
    gap = found[2017, "REGION 1", "OFICIAL"]  # the year before is missing, so 2015 is the previous one
    assert gap["beneficiarios_anio_anterior"] == 0 and gap["variacion_yoy_pct"] is None  # division by zero
    assert float(gap["participacion_sector_pct"]) == 66.67 and float(gap["variacion_cuota_pp"]) == 66.67
    assert float(gap["variacion_yoy_pib_pct"]) == 0 and float(gap["densidad_credito_pib"]) == 1.3333
    fall = found[2017, "REGION 1", "PRIVADO"]
    assert float(fall["variacion_yoy_pct"]) == -33.33 and float(fall["variacion_cuota_pp"]) == -66.67
    ranks = {k: r["rank_depto_por_sector"] for k, r in found.items() if k[0] == 2017 and k[2] == "OFICIAL"}
    assert sorted(ranks.values()) == [1, 1, 3]
    for year, region in {k[:2] for k in found}:
        total = sum(float(r["participacion_sector_pct"]) for k, r in found.items() if k[:2] == (year, region))
        assert total == pytest.approx(100, abs=0.02)


def test_mart_without_macro_values(cohort):
    rows = cohort((2015, 1, "OFICIAL", 1, 2)).withColumn(schema.MACRO_VALUE, F.lit(None).cast(schema.MACRO_VALUE_TYPE))
    dims = star.new_dimensions(rows)
    only = credit_mart(star.resolved_fact(rows, dims)[0], dims).first()
    assert only["pib_miles_millones_promedio"] is None and only["densidad_credito_pib"] is None


def test_incremental_mart_equals_a_full_one(warehouse, cohort):
    first = with_gdp(cohort(*[(y, c, s, 1, y % 10 + c) for y in (2015, 2016, 2018) for c in (1, 2) for s in ("OFICIAL", "PRIVADO")]))
    warehouse.load(first)
    warehouse.refresh_mart()
    old = {e for e in warehouse.current()[1] if e[0] == "mart_base"}
    warehouse.load(with_gdp(cohort((2016, 1, "OFICIAL", 1, 50), (2019, 2, "PRIVADO", 9, 5)), 7.0))
    found = warehouse.refresh_mart()
    dims = warehouse.dimensions()
    expected = mart_from_base(mart_base(warehouse.fact(), dims))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)
    kept = old & {e for e in warehouse.current()[1] if e[0] == "mart_base"}
    assert {e[1].split("|")[0] for e in kept} == {"2015", "2018"}  # only changed years were read again
    again = warehouse.refresh_mart()
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)


def test_year_filters_prune_fact_and_mart_and_early_years_keep_their_folders(warehouse, cohort):
    warehouse.load(with_gdp(cohort(*[(y, 1, "OFICIAL", 1, y % 10) for y in (2015, 2016, 2018)])))
    warehouse.refresh_mart()
    before = {e for e in warehouse.current()[1] if e[0] == "credit_mart"}
    joined = star.star_join(warehouse.fact(), warehouse.dimensions()).filter(F.col(schema.YEAR) == 2016)
    for df in (joined, warehouse.mart().filter(F.col(schema.YEAR) == 2016)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert any("PartitionFilters: [isnotnull(vigencia" in line and "2016" in line for line in plan.splitlines())
    assert [r["total_nuevos_beneficiarios"] for r in joined.collect()] == [6]
    warehouse.load(with_gdp(cohort((2016, 1, "OFICIAL", 1, 60))))
    warehouse.refresh_mart()
    after = {e for e in warehouse.current()[1] if e[0] == "credit_mart"}
    assert sorted(e[1] for e in before & after) == ["", "2015"]
    assert sorted((r["vigencia"], r["total_beneficiarios"], r["beneficiarios_anio_anterior"]) for r in warehouse.mart().collect()) == [
        (2015, 5, None), (2016, 60, 5), (2018, 8, 60)
    ]


def test_rejected_rows_are_kept_with_their_run(warehouse, cohort):
    assert warehouse.rejects().isEmpty()
    warehouse.load(with_gdp(cohort((2015, None, "OFICIAL", 1, 7), (2015, 1, None, 2, 8), (2015, 1, "OFICIAL", 2, 9))), run_id="a")
    warehouse.load(with_gdp(cohort((2016, 1, "OFICIAL", 1, 1))), run_id="b")
    assert sorted(r["unresolved"] for r in warehouse.rejects("a").collect()) == ["dim_geography", "dim_program"]
    assert warehouse.rejects("b").isEmpty() and warehouse.rejects().count() == 2
    assert warehouse.rejects().filter(F.col("row").contains('"total_nuevos_beneficiarios":7')).count() == 1


def test_stream_loads_each_batch_once_and_the_last_one_wins(spark, warehouse, cohort, tmp_path):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")

    def land(batch, *items):
        with_gdp(cohort(*items)).write.parquet(f"{landing}/batch={batch}")

    land("a", (2015, 1, "OFICIAL", 1, 1), (2016, 1, "OFICIAL", 1, 2))
    land("b", (2016, 2, "PRIVADO", 1, 3))
    load_batches(spark, landing, warehouse, checkpoint)
    assert facts(warehouse) == [(2015, 1), (2016, 3)]
    assert len(keys(warehouse)["dim_geography"]) == 2
    version = warehouse.current()[0]
    load_batches(spark, landing, warehouse, checkpoint)
    assert warehouse.current()[0] == version
    land("c", (2015, 1, "OFICIAL", 1, 9))
    load_batches(spark, landing, warehouse, checkpoint)
    assert facts(warehouse) == [(2015, 9), (2016, 3)]


def test_share_change_of_very_large_totals(spark):
    from pyspark.sql import functions as F

    from regiostar import schema
    from regiostar.plans import mart

    for scale in (1, 10**12, 10**15):
        rows = [(2000 + y, "R", 1, s, n * scale) for y, (a, b) in enumerate([(1, 2), (2, 2), (3, 1)]) for s, n in (("A", a), ("B", b))]
        base = spark.createDataFrame(rows, f"{schema.YEAR} int, {schema.REGION} string, {mart.CODE} int, {schema.SECTOR} string, {mart.TOTAL} long")
        found = mart.with_region_total(base).withColumn("participacion_sector_pct", F.lit(0.0))
        changes = mart.with_share_change(found).where(f"{schema.SECTOR} = 'A'").orderBy(schema.YEAR).collect()
        assert [None if r.variacion_cuota_pp is None else float(r.variacion_cuota_pp) for r in changes] == [None, 16.67, 25.0]
