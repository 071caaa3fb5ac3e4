"""Decontamination judges rows, not ids."""

from regiostar.llm import spaced_seeds


def test_rows_without_id_and_rows_that_share_an_id(spark):
    item = " ".join(f"w{i}" for i in range(20))
    rows = [(None, f"a {item} b"), (None, "clean"), (1, f"c {item}"), (1, "another clean text"), (2, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = spaced_seeds.clean(docs, spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([rows[1], *rows[3:]], key=repr)
