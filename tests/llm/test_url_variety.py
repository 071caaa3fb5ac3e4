"""Wildcards do not depend on how often pages are repeated or how many pages a value has."""

import pytest

from regiostar.llm import url_templates


@pytest.mark.parametrize("times", [1, 10])
@pytest.mark.parametrize(("names", "pages"), [(30, 1), (100, 10)])
def test_names_are_variable(spark, times, names, pages):
    letters = "abcdefghij"
    paths = [f"/user/{letters[i // 10]}{letters[i % 10]}/{letters[j]}" for i in range(names) for j in range(pages)]
    rows = [(n, f"http://a.org{p}") for n, p in enumerate(paths * times)]
    found = url_templates.verdicts(spark.createDataFrame(rows, "page_id long, url string"), {"a.org/user/a": "block"})
    assert {r.template.split("/")[2] for r in found.collect()} == {"*"}


def test_sections_are_not_variable(spark):
    letters = "abcdefghijklmnopqrst"
    rows = [(n, f"http://a.org/{x}/{y}{z}") for n, (x, y, z) in enumerate((x, y, z) for x in letters for y in letters for z in letters[:5])]
    found = url_templates.verdicts(spark.createDataFrame(rows, "page_id long, url string"), {"a.org/a": "block", "a.org/b": "allow"})
    assert "*" not in {r.template.split("/")[1] for r in found.collect()}
