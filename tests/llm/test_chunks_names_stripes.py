"""Fill-in-middle, block naming and stripes against plain Python, on random texts and odd rows; test_sql compares whole tables."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from regiostar.llm import block_naming, chunk_fim, stripes

DOCS = "doc_id long, text string, lang string, row string, name string, next string, n long, h1 long, original long, phrase string"
MORE = (None,) * 7


def frame(spark, texts, langs=("en",)):
    rows = [(i, t, langs[i % len(langs)], *MORE) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


# fill in middle


def random_text(rng, letters, longest):
    return "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 5, 300, longest])))


def test_summaries_count_find_and_cut_like_whole_texts():
    rng = random.Random(1)
    memory = chunk_fim.Summaries(5000)
    for _ in range(600):
        text = random_text(rng, ["a", "é", "日", "😀", "<", "P", ">", "<M>", " "][: rng.randint(1, 9)], 3000)
        cut = chunk_fim.Cutter(text.encode(), memory)
        assert (cut.points, cut.marked) == (len(text), any(m.decode() in text for m in chunk_fim.MARKERS))
        k = rng.randint(0, len(text))
        assert cut.offset(k) == len(text[:k].encode())


def test_chunks_depend_on_content_only():
    rng = random.Random(2)
    passage = bytes(rng.randrange(256) for _ in range(40_000))
    chunks = []
    for before in (b"", b"x" * 777, bytes(rng.randrange(256) for _ in range(3000))):
        data = before + passage
        ends = chunk_fim.Cutter(data, chunk_fim.Summaries()).ends
        chunks.append({data[a:b] for a, b in zip([0, *ends], ends, strict=False)})
        assert all(chunk_fim.LEAST <= b - a <= chunk_fim.MOST for a, b in zip([0, *ends], ends[:-1], strict=False)) and ends[-1] == len(data)
    assert len(chunks[0] & chunks[1] & chunks[2]) > 20
    assert chunk_fim.Cutter(b"a" * 1_000_000, chunk_fim.Summaries()).points == 1_000_000


def test_markers_on_chunk_borders(monkeypatch):
    monkeypatch.setattr(chunk_fim, "LEAST", 2)
    monkeypatch.setattr(chunk_fim, "MOST", 2)
    for text in ("ab<M>", "a<M>b", "<M>", "abcd<S>", "xyz<P", "<<P>>"):
        cut = chunk_fim.Cutter(text.encode(), chunk_fim.Summaries())
        assert cut.marked == any(m.decode() in text for m in chunk_fim.MARKERS)


def test_transformed_texts_and_their_restoring(spark):
    texts = ["", None, "a", "<", "<S", "x<P>y", "plain text é", "日本語" * 500, "<P" * 30, "\n\r\x00tail"] * 12
    docs = frame(spark, texts).union(frame(spark, texts)).union(spark.createDataFrame([(None, "without an id", None, *MORE)], DOCS))
    found = chunk_fim.transformed(docs, 100, 50).select("*", chunk_fim.restored().alias("back")).collect()
    assert len(found) == 241
    originals = Counter((i, t or "") for i, t in enumerate(texts)) + Counter((i, t or "") for i, t in enumerate(texts)) + Counter([(None, "without an id")])
    assert Counter((r.doc_id, r.back) for r in found) == originals
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    for r in found:
        assert (r.form == "plain") == (r.back in ("", "x<P>y")) and r.n == len(r.back)
        if r.form == "psm":
            prefix, rest = r.output[3:].split("<S>")
            assert (len(prefix), len(rest.split("<M>")[1])) == (r.prefix_chars, r.middle_chars)
    assert chunk_fim.transformed(docs.where("false")).count() == 0


# exact dedup


def equal_groups(texts):
    groups = {}
    for i, t in enumerate(texts):
        groups.setdefault(re.sub("[ \t-\r]", "", t or ""), []).append((-len(t or ""), i))
    return {i: (min(g)[1], len(g), i == min(g)[1]) for g in groups.values() for _, i in g}


@pytest.mark.parametrize("weak", [False, True])
def test_names_of_random_texts(spark, monkeypatch, weak):
    monkeypatch.setattr(block_naming, "BLOCK", 4)
    rng = random.Random(3)
    texts = [None, "", " \n", " ", "a b", "ab", "a\tb", "é" * 9, "é" * 10, "abab" * 40, "abab" * 41, "ABAB"]
    texts += ["".join(rng.choice(["ab", "abcd", " ", "bcda"]) for _ in range(rng.randint(0, 12))) for _ in range(80)]
    digests = block_naming.two_digests
    if weak:  # few values: most blocks share their digests with others
        digests = lambda b: F.struct(F.pmod(F.xxhash64(b), F.lit(3)).alias("d1"), F.lit(0).cast("long").alias("d2"))
    found = block_naming.dedup(frame(spark, texts), digests).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in found} == equal_groups(texts)


def test_names_of_odd_rows(spark):
    rows = [(1, "a b"), (1, "a b"), (1, "ab"), (None, "a b"), (0, "ab"), (7, None), (None, ""), (7, "x" * 200_000), (8, " " + "x" * 200_000)]
    docs = spark.createDataFrame([(i, t, "en", *MORE) for i, t in rows], DOCS)
    found = sorted((repr(r.doc_id), repr(r.keep_id), r.group_size, r.kept) for r in block_naming.dedup(docs).collect())
    assert found == sorted(
        [("1", "1", 5, True), ("1", "1", 5, False), ("1", "1", 5, False), ("None", "1", 5, False), ("0", "1", 5, False)]
        + [("7", "7", 2, True), ("None", "7", 2, False), ("7", "8", 2, False), ("8", "8", 2, True)]
    )
    assert block_naming.dedup(docs.where("false")).count() == 0


# stripes


def plain_collocations(texts, langs, least, top, subsumed):
    found = {}
    for i, text in enumerate(texts):
        f = found.setdefault(langs[i % len(langs)] or "und", Counter())
        for piece in re.split("[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^ \t]+", piece)
            for m in range(1, 5):
                f.update(tuple(words[k : k + m]) for k in range(len(words) - m + 1))
    out = []
    for lang, f in found.items():
        n, kept = sum(c for p, c in f.items() if len(p) == 1), []
        for p, a in f.items():
            if len(p) == 1 or a < least:
                continue
            longer = [c for q, c in f.items() if len(q) > len(p) and c >= least and any(q[k : k + len(p)] == p for k in range(len(q)))]
            if any(100 * c >= subsumed * a for c in longer):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n, -s) for i, (s, a, p, x, y) in enumerate(sorted(kept)[:top])]
    return out


@pytest.mark.parametrize("segment", [8 << 20, 300])
def test_collocations_of_random_texts(spark, monkeypatch, segment):
    monkeypatch.setattr(stripes, "SEGMENT", segment)
    monkeypatch.setattr(stripes, "SHARES", 3)
    rng = random.Random(5)
    words = ["a", "B", "É", "é", "new", "York", "city", "日本", "x\x00", "z,", " "]
    texts = [None, "", " \t", "...", "of the " * 400] + [
        "".join(rng.choice([" ", "  ", "\t", ". ", " ", "\r"]) + rng.choice([*words, "New York city", "in the end of"]) for _ in range(rng.randint(0, 90)))
        for _ in range(60)
    ]
    langs = ["en", "de", None, "und", "en"]
    got = stripes.collocations(frame(spark, texts, langs), top=40, least=5).collect()
    assert sorted(map(tuple, got)) == sorted(plain_collocations(texts, langs, 5, 40, 80))


def test_collocations_of_odd_rows(spark):
    empty = frame(spark, ["", None])
    assert stripes.collocations(empty).count() == 0 and stripes.collocations(empty.where("false")).count() == 0
    rows = [(1, "a b", None, *MORE)] * 29 + [(None, "a\tb", "und", *MORE)]
    assert [tuple(r) for r in stripes.collocations(spark.createDataFrame(rows, DOCS)).collect()] == [("und", 1, "a b", 30, 30, 30, 60, 1_000_000)]


def test_stripes_ship_no_prefix_counts_twice(spark):
    texts = ["new york city is big. new york city"] * 40 + ["new york"] * 5 + ["old town, new york"]
    elements = stripes.merged(frame(spark, texts, ["en"]), least=5)
    assert elements.where("m > 1 and next is null").count() == 0
    got = stripes.collocations(frame(spark, texts, ["en"]), least=5).collect()
    assert sorted(map(tuple, got)) == sorted(plain_collocations(texts, ["en"], 5, 2000, 80))
