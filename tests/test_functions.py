import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from regiostar.functions.numbers import percent, ratio, to_integer, to_moment, to_number
from regiostar.functions.text import standardise, strip, strip_accents
from regiostar.operators.clean import clean_and_standardise, clean_join_keys, map_columns, parse_year, resolve_macro_columns
from regiostar.operators.fuzzy import with_name_score
from regiostar import schema


def plain(text):
    return "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")


def score(a, b):
    """Token-sort ratio, written the slow way."""
    a, b = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    if not a and not b:
        return 100.0
    table = [0] * (len(b) + 1)
    for x in a:
        previous = table[:]
        for j, y in enumerate(b, 1):
            table[j] = previous[j - 1] + 1 if x == y else max(previous[j], table[j - 1])
    return 200.0 * table[-1] / (len(a) + len(b))


def test_strip_takes_all_white_space(table):
    texts = ["  a b ", "\ta ", " a　\n", "\x1ca\x1f", "", " \t", "á"]
    df = table("i int, t string", *enumerate(texts))
    found = {r[0]: (r[1], r[2]) for r in df.select("i", strip(F.col("t")), standardise(F.col("t"))).collect()}
    for i, text in enumerate(texts):
        assert found[i] == (text.strip(), text.strip().upper())


def test_strip_accents_equals_decomposition(table):
    texts = ["BOGOTÁ D.C.", "NARIÑO", "Ǻșħ", "Ελλάδα", "Йод", "é", "한국", "plain", ""]
    df = table("i int, t string", *enumerate(texts), (99, None))
    found = {r[0]: r[1] for r in df.select("i", strip_accents(F.col("t"))).collect()}
    assert found == {**{i: plain(text) for i, text in enumerate(texts)}, 99: None}


def test_numbers(table):
    cases = {"1": 1.0, " 2.50 ": 2.5, "-3e2": -300.0, ".5": 0.5, "1d": None, "2f": None, "0x1": None, "x": None, "": None, "2,015": None}
    df = table("t string", *[(t,) for t in cases])
    assert {r[0]: r[1] for r in df.select("t", to_number(F.col("t"))).collect()} == cases
    whole = {"7": 7, "2018.0": 2018, "7.5": None, "99999999999": None, "x": None}
    df = table("t string", *[(t,) for t in whole])
    assert {r[0]: r[1] for r in df.select("t", to_integer(F.col("t"))).collect()} == whole


def test_dates(table):
    df = table("t string", ("2020-03-04",), ("2020-03-04 05:06:07",), ("03/04/2020",), ("x",))
    found = [r[0] and str(r[0])[:10] for r in df.select(to_moment(F.col("t"))).collect()]
    assert found == ["2020-03-04", "2020-03-04", "2020-03-04", None]


def test_ratio_rounds_half_away_and_guards_zero(table):
    df = table("n long, d long", (1, 8), (-1, 8), (1, 0), (None, 2), (2, 3))
    found = [r[0] for r in df.select(ratio(F.col("n"), F.col("d"), 2).cast("double")).collect()]
    assert found == [0.13, -0.13, None, None, 0.67]
    assert df.select(percent(F.col("n"), F.col("d")).cast("double")).first()[0] == 12.5


def test_year_parse_raises_on_bad_text(table):
    good = table("VIGENCIA string", ("2,015",), (None,))
    assert [r[0] for r in parse_year(good, "VIGENCIA").collect()] == [2015, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        parse_year(table("VIGENCIA string", ("2015.0",)), "VIGENCIA").collect()


def test_clean_and_standardise(table):
    df = table("` VIGENCIA` string, `SECTOR IES ` string, X string, N int", ("2,016", None, " a\t", 1), ("2016", " oficial", None, 2))
    found = [tuple(r) for r in clean_and_standardise(df).collect()]
    assert found == [(2016, "NO CLASIFICADO", "A", 1), (2016, "OFICIAL", None, 2)]


def test_join_keys_need_their_columns(table):
    with pytest.raises(KeyError, match="DEPARTAMENTO DE ORIGEN"):
        clean_join_keys(table("VIGENCIA string", ("2015",)))


def test_map_columns_coerces(table):
    fields = [schema.Field("A", "a", "int"), schema.Field("B", "b", "string")]
    df = table("A string, B string", ("1", " x "), ("bad", None), ("3.0", "y"))
    assert [tuple(r) for r in map_columns(df, fields).collect()] == [(1, "x"), (None, None), (3, "y")]
    with pytest.raises(KeyError, match="'C'"):
        map_columns(df, [schema.Field("C", "c", "int")])


def test_macro_aliases_first_present_wins(table):
    df = table("b string, c string, k int", ("1.5", "9", 1), ("bad", "9", 2))
    found, absent = resolve_macro_columns(df, {"v": ("a", "b", "c"), "w": ("z",)})
    assert absent == ["w"]
    assert [tuple(r) for r in found.select("k", "c", "v", "w").collect()] == [(1, "9", 1.5, None), (2, "9", None, None)]


def test_known_scores(table):
    cases = {
        ("VALLE", "VALLE DEL CAUCA"): 50.0,
        ("BOGOTA", "BOGOTA D.C."): 70.588,
        ("BOGOTA, D.C.", "BOGOTA D.C."): 95.652,
        ("NORTE SANTANDER", "NORTE DE SANTANDER"): 90.909,
        ("A B", "B  A"): 100.0,
        ("", ""): 100.0,
        ("", "A"): 0.0,
    }
    df = table("a string, b string", *cases)
    found = {(r[0], r[1]): r[2] for r in with_name_score(df, "a", "b", "s").collect()}
    for pair, expected in cases.items():
        assert found[pair] == pytest.approx(expected, abs=1e-3)


def test_score_equals_the_slow_way_at_any_length(table):
    rng = random.Random(5)
    pairs = []
    for n in (0, 1, 5, 20, 60, 61, 62, 63, 64, 90):
        for _ in range(4):
            a = "".join(rng.choice("ABC D") for _ in range(n))
            b = "".join(rng.choice("ABC D") for _ in range(max(0, n + rng.randint(-3, 3))))
            pairs.append((a, b))
    df = with_name_score(table("a string, b string", *pairs), "a", "b", "s")
    for r in df.collect():
        assert r["s"] == pytest.approx(score(r["a"], r["b"])), (r["a"], r["b"])
        assert 0 <= r["s"] <= 100
    back = with_name_score(table("a string, b string", *[(b, a) for a, b in pairs]), "a", "b", "s")
    assert sorted(r["s"] for r in back.collect()) == sorted(r["s"] for r in df.collect())


def test_score_of_null_is_null(table):
    df = table("a string, b string", (None, "x"), ("x", None))
    assert [r["s"] for r in with_name_score(df, "a", "b", "s").collect()] == [None, None]


def test_short_cuts_change_no_text_and_no_number(table):
    """Texts that begin or end with spaces, control characters or signs, and what Java's parser takes beside decimals."""
    marks = ["", "\t", "\x01", "\x1c", "\x7f", "\x84", "\x85", "\xa0", "\xa1", "\u1680", "\u2003", "\u3000", "\ufeff", "\u00e9", "+", "-", ".", "/", ":", "x", "d"]
    cores = ["5", "1.0", "1.5", "1e5", "0x1p3", "2147483648", "007", "a b", "."]
    texts = [None, *[a + core + b for a in marks for core in cores for b in marks]]
    decimal = re.compile(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?")
    rows = table("v string", *[(t,) for t in texts])
    for r in rows.select("v", strip(F.col("v")).alias("s"), to_number(F.col("v")).alias("n"), to_integer(F.col("v")).alias("i")).collect():
        bare = None if r.v is None else r.v.strip()
        number = float(bare) if bare is not None and decimal.fullmatch(bare) else None
        whole = int(number) if number is not None and number == int(number) and -(2**31) <= number < 2**31 else None
        assert (r.s, r.n, r.i) == (bare, number, whole), repr(r.v)
