import json

import pytest
from pyspark.errors import AnalysisException, PySparkException

from regiostar.sources import cohort_csv, macro_records
from regiostar.sources.cohort_csv import extract_csv, read_cohort, sniff_delimiter
from regiostar.sources.columns import column_report, missing_columns, require_columns, strip_column_names
from regiostar.sources.macro_records import extract_records, incomplete_pages, page_counts, read_records
from regiostar.sources.staging import read_staging, write_staging

HEADER = 'VIGENCIA,ESTRATO SOCIOECONÓMICO," SECTOR IES ",NÚMERO DE NUEVOS BENEFICIARIOS DE CRÉDITO'


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_csv_types_and_missing_values(spark, tmp_path):
    path = write(
        tmp_path / "c.csv", HEADER, '"2,015",1,OFICIAL,"1,234"', "2016,N/A,,x", '2017,2.0,"a ""b"", c", 7 ', "NA,3,null,"
    )
    df = extract_csv(spark, path)
    assert [t for _, t in df.dtypes] == ["string", "int", "string", "int"]
    assert [tuple(r) for r in df.collect()] == [
        ("2,015", 1, "OFICIAL", 1234), ("2016", None, None, None), ("2017", 2, 'a "b", c', 7), (None, 3, None, None),
    ]
    assert read_cohort(spark, path).columns[2] == "SECTOR IES"


@pytest.mark.parametrize("delimiter", [",", ";", "\t", "|"])
def test_delimiter_is_found_in_the_header(spark, tmp_path, delimiter):
    path = write(tmp_path / "c.csv", delimiter.join(["VIGENCIA", '"A,B;C|D"', "X"]), delimiter.join(["2015", "y", "z"]))
    assert sniff_delimiter(spark, path) == delimiter
    assert tuple(extract_csv(spark, path, delimiter=None).first()) == ("2015", "y", "z")


def test_line_breaks_within_quotes(spark, tmp_path):
    path = write(tmp_path / "c.csv", "VIGENCIA,X", '2015,"a', 'b"')
    assert tuple(extract_csv(spark, path, multiline=True).first()) == ("2015", "a\nb")


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        extract_csv(spark, str(tmp_path / "none.csv"))


def page(path, name, years, array=False):
    records = [{"a_o": y, "departamento": "X", "valor_miles_de_millones_de": "1.5"} for y in years]
    text = json.dumps(records) if array else "\n".join(json.dumps(r) for r in records)
    (path / name).write_text(text, encoding="utf-8")


@pytest.mark.parametrize("array", [False, True])
def test_records_are_filtered_as_text(spark, tmp_path, array):
    page(tmp_path, "p1.json", ["2017", "2018", "2019"], array)
    page(tmp_path, "p2.json", ["2020", "1999", None], array)
    df = extract_records(spark, str(tmp_path), arrays=array)
    assert sorted(r["a_o"] for r in df.collect()) == ["2018", "2019", "2020"]
    assert all(t == "string" for _, t in df.dtypes)
    assert len(df.columns) == 7
    with pytest.raises(RuntimeError, match="no macro records"):
        extract_records(spark, str(tmp_path), arrays=array, min_year=2030)


def test_pages_cut_short_are_reported(spark, tmp_path):
    page(tmp_path, "p1.json", ["2018"] * 3)
    page(tmp_path, "p2.json", ["2018"] * 2)
    page(tmp_path, "p3.json", ["2018"])
    records = read_records(spark, str(tmp_path), min_year=None)
    assert {r[0]: r[1] for r in page_counts(records).collect()} == {"p1.json": 3, "p2.json": 2, "p3.json": 1}
    assert [r[0] for r in incomplete_pages(records, 3).collect()] == ["p2.json"]


def test_staging_overwrites(spark, tmp_path):
    path = str(tmp_path / "s")
    write_staging(spark.range(5).toDF("a b"), path)
    write_staging(spark.range(2).toDF("a b"), path)
    assert read_staging(spark, path).count() == 2
    assert list((tmp_path / "s").glob("*.snappy.parquet"))


def test_column_checks(spark):
    df = spark.range(1).toDF(" id ")
    assert strip_column_names(df).columns == ["id"]
    assert missing_columns(df, ["id", " id "]) == ["id"]
    with pytest.raises(KeyError, match="orders: missing columns"):
        require_columns(df, ["id"], "orders")


def test_rows_that_do_not_fit_are_reported_or_an_error(spark, tmp_path):
    path = write(tmp_path / "a.csv", "a,b,c", '1,F,"x, y"', "2016,b,extra,surplus", "2016,,,surplus", "3,F", "", '7,"F,x', "8,NA,z")
    rows = cohort_csv.read_csv_rows(spark, path)
    assert sorted((r.a, r.b or "", r.c or "") for r in cohort_csv.kept(rows).collect()) == [("1", "F", "x, y"), ("3", "F", ""), ("8", "", "z")]
    assert sorted(tuple(r) for r in cohort_csv.rejected(rows).collect()) == [
        ("a.csv", "open quote", '7,"F,x'), ("a.csv", "too many fields", "2016,,,surplus"), ("a.csv", "too many fields", "2016,b,extra,surplus")
    ]
    with pytest.raises(PySparkException, match="too many fields|open quote"):
        extract_csv(spark, path).select("a").collect()


def test_broken_json_lines_are_reported(spark, tmp_path):
    path = write(tmp_path / "p1.json", '{"k": "1", "more": 2}', '{"k": "2"', "[]", "text", '{"other": 1}', '{"k": "2020"}')
    rows = macro_records.read_record_rows(spark, path, ("k",))
    assert sorted(r.k or "" for r in macro_records.kept(rows).collect()) == ["", "1", "2020"]
    assert sorted(r._rejected for r in macro_records.rejected(rows).collect()) == ["[]", "text", '{"k": "2"']


def test_column_report(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "`a.b` int, c string")
    rows = [tuple(r) for r in column_report(df, ["a.b", "c", "d", "c"]).collect()]
    assert rows == [("a.b", True, 2), ("c", True, 1), ("d", False, 0)]
    assert [tuple(r) for r in column_report(df.limit(0), ["c"]).collect()] == [("c", True, 0)]
