import re
from pathlib import Path

from pyspark.sql import functions as F

from regiostar.checks import queries
from regiostar.sources import macro_records


def test_landed_pages_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """Many small pages: their files come from tasks dealt by page count, not from the few tasks their bytes fill."""
    spark.range(0, 100_000, 50).select(F.col("id").alias("o_orderkey")).write.parquet(str(tmp_path / "orders.parquet"))
    made = []
    monkeypatch.setattr(queries, "fresh_path", lambda s, name: made.append(str(tmp_path / name)) or made[-1])
    report = queries.page_completeness(spark, str(tmp_path))
    pages = {p for p in range(1000) if p % 11 != 3}
    assert {r["page_number"] for r in report.collect()} == pages
    landed = next(p for p in made if "landed-pages" in p)
    parts = {re.match(r"part-(\d+)", f.name).group(1) for f in Path(landed).rglob("part-*.json")}
    assert len(parts) >= 4


def test_landed_pages_share_a_folder_per_task(spark, tmp_path, monkeypatch):
    """A folder per page costs a listing each: a task's pages lie in one folder, a whole file per page."""
    keys = spark.range(0, 60_000, 20).select((F.col("id") % 50_000).alias("o_orderkey"))
    keys.union(spark.createDataFrame([(None,), (-5,)], "o_orderkey long")).write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(queries, "fresh_path", lambda s, name: str(tmp_path / name))
    report = {r.page_number: r.records for r in queries.page_completeness(spark, str(tmp_path)).collect()}
    files = [*(tmp_path / "landed-pages").rglob("part-*.json")]
    assert len({f.parent for f in files}) <= 4
    landed = {int(re.search(r"page=(-?\d+)\.json", f.name)[1]): f.read_text().splitlines() for f in files}
    assert len(landed) == len(files) == len(report)
    assert sorted(landed[0]) == ['{"key":"%d"}' % k for k in (0, 0, 20, 20, 40, 40, 60, 60, 80, 80)]
    assert report == {None if p < 0 else p: len(lines) for p, lines in landed.items()}


def test_no_orders_land_as_no_pages(spark, tmp_path):
    spark.createDataFrame([], "o_orderkey long").write.parquet(str(tmp_path / "orders.parquet"))
    assert queries.page_completeness(spark, str(tmp_path)).count() == 0


def test_many_small_files_are_read_by_few_tasks(spark, tmp_path):
    lines = spark.range(0, 60, 1, 60).select(F.format_string('{"key":"%s"}', "id").alias("value"))
    lines.write.text(str(tmp_path / "lines"))
    files = spark.read.text(str(tmp_path / "lines"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16")
    try:
        assert files.rdd.getNumPartitions() > 40
        few = macro_records.gathered(files, 5)
        assert few.rdd.getNumPartitions() == 32
        assert sorted(r[0] for r in few.collect()) == sorted('{"key":"%d"}' % i for i in range(60))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
