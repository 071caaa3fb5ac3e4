"""Line dedup of short lines, of lines without blanks and of a whole table."""

import re

import duckdb

from regiostar.llm import unit_dedup
from regiostar.llm.queries import QUERIES


def test_short_lines_and_lines_without_blanks_are_grouped(spark):
    texts = ["of, edti\nhttps://a.org/x\n\n日本語の長い行です", "OF,  edti\n\nnew\nhttps://a.org/x", "日本語の長い行です\nnew\n\nnew"]
    found = unit_dedup.dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    kept = {r.doc_id: (r.units_removed, r.kept_text, [tuple(x) for x in r.removed]) for r in found.collect()}
    assert kept == {0: (0, texts[0], []), 1: (2, "\nnew", [(0, 9), (15, 30)]), 2: (3, "", [(0, 9), (10, 13), (15, 18)])}
    assert all(r.n_removed == 0 for r in unit_dedup.dedup(spark.createDataFrame([(1, "a b\na b")], "doc_id long, text string"), 3).collect())


def test_lines_of_a_table_as_in_plain_python(spark):
    docs = duckdb.sql("SELECT doc_id, coalesce(text, '') FROM '/root/testdata/sf0.001/documents.parquet' ORDER BY doc_id").fetchall()
    seen, want = set(), {}
    for doc, text in docs:
        kept, removed, start, points = [], [], 0, 0
        for line in text.split("\n"):
            unit = re.sub("[\t\x0b\f\r ]+", " ", line.lower()).strip(" ")
            if unit and unit in seen:
                removed.append(f"{start}-{start + len(line)}")
                points += len(line)
            else:
                kept.append(line)
            seen.add(unit)
            start += len(line) + 1
        want[doc] = (text.count("\n") + 1, len(removed), points, ",".join(removed), "\n".join(kept))
    assert {r.doc_id: tuple(r)[1:] for r in QUERIES["op8_line_dedup"](spark, "/root/testdata/sf0.001").collect()} == want


def test_many_repeated_lines_in_one_text_take_linear_time(spark):
    text = "\n".join(f"line {i % 50_000}" for i in range(100_000))
    found = unit_dedup.dedup(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (found.n_units, found.units_removed, found.kept_text) == (100_000, 50_000, "\n".join(f"line {i}" for i in range(50_000)))
    assert found.n_removed == sum(len(f"line {i}") for i in range(50_000))
