import json

import pytest

from regiostar import schema
from regiostar.operators.quality import between, not_null
from regiostar.plans.runs import RunConfig, staged_macro
from regiostar.sources import macro_records
from regiostar.sources.macro_records import PAGE_NUMBER, IncompletePages, landed_pages, page_report, read_records, require_complete_pages
from regiostar.streaming import monthly as monthly_module
from regiostar.streaming.monthly import MonthlyRuns

SOURCES = [f.source for f in schema.COHORT_FIELDS]
HEADER = ",".join(SOURCES)


def line(year, region="ANTIOQUIA", n=1):
    return f'"{year}",S1,5,{region},CAT,OFICIAL,N,L,C,F,1,BAJO,{n}'


def land(landing, batch, *lines, header=HEADER, name="a.csv"):
    folder = landing / f"batch={batch}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")


@pytest.fixture
def monthly(spark, tmp_path):
    macro = tmp_path / "macro"
    macro.mkdir()
    records = [{"a_o": str(y), "departamento": "antioquia", "valor_miles_de_millones_de": str(y - 2000)} for y in (2018, 2019)]
    (macro / "p1.json").write_text("\n".join(json.dumps(r) for r in records), encoding="utf-8")
    landing = tmp_path / "landing"
    landing.mkdir()
    rules = [not_null(schema.YEAR), between(schema.MEASURE, low=0)]
    config = RunConfig(str(landing), str(tmp_path / "warehouse"), str(macro), rules=rules)
    return MonthlyRuns(spark, config, str(tmp_path / "checkpoint")), landing


def facts(runs):
    rows = runs.warehouse.fact().collect()
    return sorted((r[schema.YEAR], r[schema.MEASURE], float(r[schema.MACRO_VALUE])) for r in rows)


def outcomes(runs):
    return {r.batch: (r.outcome, r.delivered, r.unreadable) for r in runs.log().collect()}


def test_batches_pass_or_fail_each_on_its_own(monthly, monkeypatch):
    runs, landing = monthly
    land(landing, "01", line("2,018"), line("2019", n=2))
    land(landing, "02", line("2018", n=-1))
    land(landing, "03", line("2019", n=7))
    land(landing, "04", line("2019") + ",surplus", line("2019", n=9))
    land(landing, "05", line("20x9"))
    land(landing, "06", line("2018"), header="A,B")
    land(landing, "07", line("2018", region="ZZZZ"))
    land(landing, "08")
    runs.run()
    assert facts(runs) == [(2018, 1, 18.0), (2019, 7, 19.0)]
    found = outcomes(runs)
    assert {b for b, o in found.items() if o[0] == "loaded"} == {"01", "03"}
    assert found["04"] == ("quarantined", 2, 1) and found["05"] == ("quarantined", 1, 1)
    held = {}
    for row in runs.quarantined().collect():
        held.setdefault(row.batch, []).append(row["_reason"])
    assert sorted(held) == ["02", "04", "05", "06", "07"]
    assert len(held["04"]) == 2 and "too many fields" in held["04"] and held["05"] == ["year is no number"]
    assert runs.warehouse.mart().count() == 2
    assert runs.warehouse.dimension(schema.GEOGRAPHY).count() == 1  # nothing of a quarantined batch

    # A corrected batch is replayed; the later batch keeps its year.
    monkeypatch.setattr(runs.warehouse, "refresh_mart", lambda: None)  # slow, and seen above
    version = runs.warehouse.current()[0]
    runs.run()
    assert runs.warehouse.current()[0] == version
    land(landing, "02", line("2018", n=4), line("2019", n=5))
    runs.replay("02")
    assert facts(runs) == [(2018, 4, 18.0), (2019, 7, 19.0)]
    assert outcomes(runs)["02"][0] == "loaded"
    assert runs.quarantined().filter("batch = '02'").isEmpty()

    # A file that joins a known batch makes the whole batch be read again.
    land(landing, "03", line("2019", n=8), name="b.csv")
    runs.run()
    assert facts(runs) == [(2018, 4, 18.0), (2019, 7, 19.0), (2019, 8, 19.0)]


def test_a_micro_batch_that_failed_is_taken_again(monthly, monkeypatch):
    runs, landing = monthly
    land(landing, "01", line("2018"))
    land(landing, "02", line("2019"))
    load, calls = runs._load, []

    def fail_second(merged, name):
        calls.append(name)
        if len(calls) == 2:
            raise OSError("lost")
        return load(merged, name)

    monkeypatch.setattr(runs, "_load", fail_second)
    monkeypatch.setattr(runs.warehouse, "refresh_mart", lambda: None)
    with pytest.raises(Exception, match="lost"):
        runs.run()
    assert facts(runs) == [(2018, 1, 18.0)]
    runs.run()
    assert facts(runs) == [(2018, 1, 18.0), (2019, 1, 19.0)] and len(outcomes(runs)) == 2


def page(folder, name, n):
    lines = [json.dumps({"a_o": "2019", "departamento": "X"}) for _ in range(n)] or ["[]"]
    (folder / name).write_text("\n".join(lines), encoding="utf-8")


@pytest.mark.parametrize("block", [2, 3, 10_000])
def test_pages_in_order_of_numbers(spark, tmp_path, block):
    for name, n in (("p2.json", 3), ("p9.json", 2), ("p10.json", 3), ("p11.json", 4), ("p14.json", 0), ("p15.json", 1), ("x.json", 1)):
        page(tmp_path, name, n)
    records = read_records(spark, str(tmp_path), min_year=None, page_number=PAGE_NUMBER)
    report = page_report(records, 3, landed_pages(spark, str(tmp_path)), block)
    assert sorted((tuple(r) for r in report.collect()), key=repr) == sorted([
        (2, 3, 1, "whole"), (9, 2, 6, "cut short"), (10, 3, 0, "whole"), (11, 4, 0, "too many"),
        (14, 0, 2, "cut short"), (15, 1, 0, "last"), (None, 1, None, "unnumbered"),
    ], key=repr)
    with pytest.raises(IncompletePages, match="page 9: cut short, 2 records, 6 pages missing"):
        require_complete_pages(report)


def test_whole_pages_pass(spark, tmp_path):
    for name, n in (("p9.json", 3), ("p10.json", 2)):
        page(tmp_path, name, n)
    records = read_records(spark, str(tmp_path), min_year=None, page_number=PAGE_NUMBER)
    require_complete_pages(page_report(records.filter("page_number > 0"), 3).filter("page_number > 9"))
    assert macro_records.incomplete_pages(records, 3).isEmpty()  # p10 is the last, not p9


def test_a_run_refuses_missing_pages(spark, monthly):
    runs, landing = monthly
    runs.config.page_size = 1
    land(landing, "01", line("2018"))
    with pytest.raises(Exception, match="macro pages are incomplete"):
        runs.run()
    assert runs.log().isEmpty()
    runs.config.page_size = 2
    assert staged_macro(spark, runs.config).count() == 2


def test_batches_are_cleaned_in_the_merge_by_small_methods(spark, monthly, monkeypatch):
    """No cleaned copy of a batch is written, and its wide projections stay below what the JVM compiles in any session."""
    runs, landing = monthly
    limit = "spark.sql.codegen.hugeMethodLimit"
    chosen, written, write = spark.conf.get(limit), [], monthly_module.materialize
    monkeypatch.setattr(monthly_module, "materialize", lambda df, name: written.append(name) or write(df, name))
    land(landing, "01", line("2,018"), line("2019", region=" antioquia ", n='"1,002"'))
    try:
        spark.conf.set(limit, "65535")
        MonthlyRuns(spark, runs.config, runs.checkpoint).run()
        assert spark.conf.get(limit) == "8000"
        spark.conf.set(limit, "500")
        MonthlyRuns(spark, runs.config, runs.checkpoint)
        assert spark.conf.get(limit) == "500"
    finally:
        spark.conf.set(limit, chosen)
    assert written == ["merged"]
    assert facts(runs) == [(2018, 1, 18.0), (2019, 1002, 19.0)]
