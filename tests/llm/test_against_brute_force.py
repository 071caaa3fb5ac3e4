"""Operators that SQL cannot express, compared with plain Python on the smallest test tables or on random ones."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from regiostar.llm import collection_bwt, html_consensus, toxic_segments, weighted_minhash
from regiostar.llm.oracles import ORACLES
from regiostar.llm.queries import QUERIES, RULES, tokenizer_file
from regiostar.llm.token_files import UnitEncoder

FOLDER = "/root/testdata/sf0.001"


def read(sql):
    return duckdb.sql(sql).fetchall()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(tuple(r) for r in QUERIES[name](spark, FOLDER).select(*names).collect()) == sorted(cursor.fetchall())


TOKENIZER = Tokenizer.from_file(tokenizer_file())
ENCODER = UnitEncoder(tokenizer_file(), "<u2").opened()


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t.,!?'sabcé日 ́x12"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_units_encode_like_whole_texts(text):
    assert np.frombuffer(ENCODER(text), "<u2").tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_token_files(spark):
    start = 0
    got = {r.doc_id: r for r in QUERIES["op9_token_files"](spark, FOLDER).collect()}
    for doc, text in read(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet' ORDER BY 1"):
        ids = TOKENIZER.encode(text or "", add_special_tokens=False).ids + [2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (got[doc].start, got[doc].n_tokens, got[doc].ids_crc32) == (start, len(ids), crc)
        start += len(ids)


def without_repeats(texts):
    seen, out = set(), []
    for raw in texts:
        gone = np.zeros(len(raw), np.int8)
        for i in range(len(raw) - 99):
            window = raw[i : i + 100]
            if window in seen:
                gone[i : i + 100] = 1
            seen.add(window)
        runs = int((np.diff(np.concatenate([[0], gone])) == 1).sum())
        out.append((len(raw), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(raw, np.uint8)[gone == 0].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [None, 1])
def test_repeated_strings(spark, monkeypatch, hot):
    if hot:  # every contested anchor by the windows' own digests
        monkeypatch.setattr(collection_bwt, "HOT", hot)
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(400))
    texts = ["x" * 350, "xy" * 200, passage * 2]
    for _ in range(12):
        a, b = sorted(rng.sample(range(400), 2))
        texts.append("".join(rng.choice("abé ") for _ in range(rng.randint(0, 200))) + passage[a:b] + "".join(rng.choice("abé ") for _ in range(99)))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = collection_bwt.digested(collection_bwt.without_repeats(frame)).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in found] == without_repeats([t.encode() for t in texts])


def test_near_duplicates(spark):
    docs = read(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'")
    parts = {}
    for doc, text in docs:
        w = (text or "").lower().split()
        parts[doc] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    got = {r.doc_id: r.class_id for r in QUERIES["op7_weighted_minhash"](spark, FOLDER).collect()}
    for a in parts:
        for b in parts:
            if a < b and parts[a] and parts[b]:
                j = len(parts[a] & parts[b]) / len(parts[a] | parts[b])
                assert got[a] == got[b] if j >= 0.85 else j >= 0.7 or got[a] != got[b]


def test_near_duplicates_are_the_components_of_all_links(spark):
    rng = random.Random(8)
    base, texts = [f"w{i}" for i in range(200)], []
    for _ in range(80):
        found = list(base)
        for i in rng.sample(range(200), rng.randint(1, 4)):
            found[i] = f"x{rng.random()}"
        texts.append(" ".join(found))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    weights = weighted_minhash.word_weights(frame)
    parts = [weighted_minhash.shingles(weighted_minhash.hashes(t.split()), weights) for t in texts]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if weighted_minhash.similarity(parts[a], parts[b]) >= weighted_minhash.SIMILARITY:
                one, two = sorted((root[a], root[b]))
                root = [one if r == two else r for r in root]
    assert {r.doc_id: r.class_id for r in weighted_minhash.classes(frame).collect()} == dict(enumerate(root))
    bound = weighted_minhash.shared_weights(parts, parts)
    for a, (keys, each) in enumerate(parts[:20]):
        for b, (others, theirs) in enumerate(parts):
            _, i, j = np.intersect1d(keys, others, return_indices=True)
            assert bound[a, b] == pytest.approx(np.minimum(each[i], theirs[j]).sum(), rel=1e-4)


def test_decontamination(spark):
    def words(t):
        return re.findall(r"\w+", t.lower())

    items = {}
    for item, text in read(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet'"):
        w = words(text)
        for i in range(len(w) - 9):
            items.setdefault(tuple(w[i : i + 10]), set()).add(item)
    want = set()
    for doc, text in read(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'"):
        w = words(text or "")
        want |= {(doc, item) for i in range(len(w) - 9) for item in items.get(tuple(w[i : i + 10]), ())}
    assert {(r.doc_id, r.item_id) for r in QUERIES["op3_spaced_seeds"](spark, FOLDER).collect()} == want


def test_mix_meets_targets(spark):
    rows = QUERIES["op4_pareto_mix"](spark, "/root/testdata/sf0.01").collect()
    words = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in read("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet'")}
    assert {r.doc_id: r["size"] for r in rows} == words
    taken = {}
    for r in rows:
        key = (r.source_size, r.target)
        taken[key] = taken.get(key, 0) + r.taken
    assert all(abs(taken[k] - k[1]) <= 0.05 * k[1] for k in taken)
    assert abs(sum(k[1] for k in taken) - 1.5 * sum(words.values())) < 1


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-4, 4), max_size=40))
def test_segments(scores):
    """Every segment's ends are tight, segments are disjoint, and the best one is the maximum subsequence."""
    found = toxic_segments.segments(np.array(scores, float))
    best = max((sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=0)
    assert max((s for _, _, s in found), default=0) == max(best, 0)
    assert all(a < b and s == sum(scores[a:b]) > 0 for a, b, s in found)
    assert all(x[1] <= y[0] for x, y in zip(found, found[1:], strict=False))


def test_toxicity_on_held_out_rows(spark):
    found = {r.doc_id: r for r in QUERIES["op5_toxic_segments"](spark, "/root/testdata/sf0.1").where("held_out").collect()}
    labels = [(d, t) for d, t in read("SELECT doc_id, toxic FROM '/root/testdata/sf0.1/labels.parquet'") if d in found]
    hit = sum(1 for d, t in labels if t and found[d].predicted)
    assert hit >= 0.7 * sum(t for _, t in labels)
    assert hit >= 0.8 * sum(found[d].predicted for d, _ in labels)


def test_rules_and_verdicts(spark):
    pages = read(f"SELECT page_id, url FROM '{FOLDER}/pages.parquet'")
    got = {r.page_id: r for r in QUERIES["op1_url_templates"](spark, FOLDER).collect()}
    for page, url in pages:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host) :])[0]
        fits = [r for r in RULES if (f".{host}").lower().endswith("." + r.split("/")[0]) and path.startswith(r[r.index("/") :])]
        rule = max(fits, key=len, default=None)
        assert (got[page].host, got[page].path, got[page].rule) == (host.lower(), path, rule)
        assert got[page].verdict in ("allow", "block") and (rule is None or got[page].verdict == RULES[rule])


def test_article_text():
    html = (
        "<html><body><header>h</header><nav>n</nav><div class='ad'>ad</div><article><h1>T &amp; t</h1><p>One\n two<br>three<p>Four <b>five</b>"
        "<script>x</p></script><div class=comments>c</div><form>f</form><ul><li>a<li>b</ul></article><aside>s</aside><footer>f</footer>"
    )
    assert html_consensus.extract(html, "html>body>article") == "T & t\n\nOne two three\n\nFour five\n\na\n\nb"
    assert html_consensus.extract(html, "html>body>div") == "T & t\n\nOne two three\n\nFour five\n\na\n\nb"
