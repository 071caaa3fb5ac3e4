"""Nulls, empty and repeated rows, ties, empty tables and extra columns, for every operator and pipeline stage."""

import pytest

import corpus_pipeline
from regiostar.llm import (
    block_topk,
    collection_bwt,
    html_consensus,
    pareto_mix,
    spaced_seeds,
    token_files,
    toxic_segments,
    unit_dedup,
    url_templates,
    weighted_minhash,
)
from regiostar.llm.queries import RULES, tokenizer_file

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, key string, h long, v string, label string, size long, _row string, own long, whole string, _gone string"
LABELS = "doc_id long, quality int, toxic int, text string"
LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
ROWS = [
    (1, "one two three four five six seven eight", "en", "a", 3, "r", "k", 1, "v", "l", 9, "r", 1, "w", "g"),
    (1, "one two three four five six seven eight", "en", "a", 3, "r", "k", 1, "v", "l", 9, "r", 1, "w", "g"),
    (2, "ONE two three four five six seven eight", "en", None, None, None, None, None, None, None, None),
    (3, None, None, None, None, None, None, None, None, None, None),
    (4, "", "en", "b", 0, "r", "k", 1, "v", "l", 0, "r", 1, "w", "g"),
    (None, "a text without an id, that is long enough to be judged", "en", "b", 0, "r", "k", 1, "v", "l", 0, "r", 1, "w", "g"),
    (5, LONG, "en", "b", 0, "r", "k", 1, "v", "l", 0, "r", 1, "w", "g"),
]
ROWS = [(*r, *(None,) * (15 - len(r))) for r in ROWS]


@pytest.fixture(params=[ROWS, []], ids=["rows", "empty"])
def docs(spark, request):
    return spark.createDataFrame(request.param, DOCS)


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(1, 1, 0, "x"), (1, 1, None, "x"), (None, 0, 1, "x"), (5, 0, 1, None), (2, 0, 1, None)], LABELS)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_mix(docs):
    found = pareto_mix.mix(docs)
    assert found.count() == docs.count()
    assert all(0 <= r.taken <= 2 * r.size for r in found.collect())
    assert found.exceptAll(pareto_mix.mix(docs)).count() == 0
    assert pareto_mix.mixed(docs).columns == docs.columns


def test_mix_takes_some_of_equal_rows(spark):
    rows = [(1, "one two three", "en", "a")] * 3000 + [(i, f"other words {i}", "en", "b") for i in range(2, 1002)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = pareto_mix.mix(docs, weights=(1, 3), share=pareto_mix.Fraction(5, 6))
    for source in ("a", "b"):
        own = found.where("size > 0").join(docs.select("doc_id", "source").distinct(), "doc_id").where(f"source = '{source}'").collect()
        assert abs(sum(r.taken for r in own) - own[0].target) <= 3
        assert all(r.taken <= 2 * r.size for r in own)
    copies = pareto_mix.mixed(docs, weights=(1, 3), share=pareto_mix.Fraction(5, 6))
    assert copies.where("source = 'a'").count() * 3 == found.where("doc_id = 1").agg({"taken": "sum"}).first()[0]


def test_toxicity(docs, labels):
    found = toxic_segments.toxicity(docs, labels)
    assert found.count() == docs.count()
    assert all(0 <= r.score <= 1 for r in found.collect())
    assert toxic_segments.without_toxic(docs, labels).columns == docs.columns


def test_near_duplicates(docs):
    found = weighted_minhash.classes(docs)
    assert found.count() == docs.count()
    if docs.count():
        assert {r.doc_id: r.class_id for r in found.collect()} == {1: 1, 2: 1, 3: 3, 4: 4, None: None, 5: 5}
        kept = weighted_minhash.first_of_each(docs)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 5]


def test_decontamination(spark, docs):
    items = spark.createDataFrame(
        [(7, "two three four five six seven", "x"), (8, None, "x"), (None, "a text", "x"), (9, "", "x"), (10, "one two", "x"), (7, "two three four five six seven", "x")],
        "item_id long, text string, doc_id string",
    )
    pairs = {(r.doc_id, r.item_id) for r in spaced_seeds.overlaps(docs, items).collect()}
    assert pairs == ({(1, 7), (2, 7)} if docs.count() else set())
    clean = spaced_seeds.clean(docs, items)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == ({3, 4, None, 5} if docs.count() else set())
    assert spaced_seeds.overlaps(docs, items.where("false")).count() == 0


def test_repeated_strings(docs):
    found = collection_bwt.digested(collection_bwt.without_repeats(docs))
    assert found.count() == docs.count()
    assert all(r.n_removed == 0 for r in found.collect() if r.doc_id != 5)


def test_lines(docs):
    found = unit_dedup.dedup(docs)
    assert found.count() == docs.count()
    if docs.count():
        assert by_id(found)[2].units_removed == 1 and by_id(found)[2].n_removed == 39 and by_id(found)[2].kept_text == "" and by_id(found)[1].n_removed == 0
        assert by_id(found)[3].kept_text == "" and by_id(found)[5].kept_text == LONG


def test_tokens(docs):
    found = token_files.encoded(docs, tokenizer_file()).orderBy("start").collect()
    assert len(found) == docs.count()
    if found:
        assert found[0].doc_id is None and [r.doc_id for r in found[1:]] == [1, 1, 2, 3, 4, 5]
        assert by_id(token_files.encoded(docs, tokenizer_file()))[3].n_tokens == 1
        assert all(a.start + a.n_tokens == b.start for a, b in zip(found, found[1:], strict=False))


def test_pages(spark):
    schema = "page_id long, url string, html string, host string, text string, path string, rule string"
    rows = [(1, None, None, "h", "t", "p", "r"), (1, "no scheme", "", "h", "t", "p", "r"), (2, "http://A.org/x?y", "plain &amp; text", None, None, None, None), (None, "https://a.org", "<p>a<p>b<script>", None, None, None, None)]
    pages = spark.createDataFrame(rows, schema)
    judged = url_templates.verdicts(pages, RULES)
    assert sorted((r.page_id or 0, r.host, r.path, r.rule or "") for r in judged.collect()) == [(0, "a.org", "", ""), (1, "", "", ""), (1, "", "", ""), (2, "a.org", "/x", "org/")]
    texts = sorted((r.page_id or 0, r.text, r.n_chars) for r in html_consensus.extracted(pages).collect())
    assert texts == [(0, "a\n\nb", 4), (1, "", 0), (1, "", 0), (2, "plain & text", 12)]
    assert url_templates.verdicts(pages.where("false"), RULES).count() == 0
    assert html_consensus.extracted(pages.where("false")).count() == 0


def test_vectors(spark):
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (50, [0.5, None], 2), (100, [float("nan"), 1.0], 2), (None, [1.0, 1.0], 2), (1, None, 2), (2, [], 2), (3, [1.0], 1), (4, [1.0, 0.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id int")
    vectors = block_topk.whole_vectors(frame, "vec_id", "embedding")
    found = block_topk.top_k(vectors, vectors.where("id % 50 = 0"), 5)
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in found.orderBy("rank").collect()] == [(0, 1, 3, 65536), (0, 2, 4, 65536), (0, 3, 2, 0)]
    assert block_topk.top_k(vectors.where("false"), vectors.where("false"), 5).count() == 0


def test_stages_pass_columns_on(spark, docs, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "two three four five six")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
