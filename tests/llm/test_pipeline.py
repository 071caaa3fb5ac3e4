"""The whole pipeline over planted cases, with the rows after each stage compared with brute force."""

import random

import tokenizers

import corpus_pipeline
from regiostar.llm.queries import tokenizer_file
from regiostar.session import materialize


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def classes(texts):
    """Class of each id under links of at least 0.8 between sets of five-word shingles."""
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = {i: shingles(t) for i, t in texts.items()}
    for a in texts:
        for b in texts:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                parent[root(b)] = root(a)
    return {i: root(i) for i in texts}


def planted():
    rng = random.Random(7)
    plain, foul = [f"word{i}" for i in range(400)], [f"foul{i}" for i in range(15)]

    def clean():
        return [rng.choice(plain) for _ in range(60)]

    texts = {i: " ".join(clean()) for i in range(120)}
    toxic = set(range(200, 230))
    for i in toxic:
        texts[i] = " ".join(rng.choice(foul if rng.random() < 0.5 else plain) for _ in range(60))
    labels = [(i, 0, 0) for i in range(80)] + [(i, 0, 1) for i in range(200, 225)]
    for i in range(5):  # an exact copy and one with another last word
        texts[300 + i] = texts[i]
        texts[310 + i] = " ".join([*texts[i].split()[:-1], "other"])
    items = [" ".join(f"item{k}x{j}" for j in range(20)) for k in range(4)]
    tainted = set(range(320, 324))
    for i, item in zip(sorted(tainted), items):
        texts[i] = " ".join([*clean()[:30], item, *clean()[:30]])
    return texts, labels, items, toxic, tainted


def test_stages_over_planted_cases(spark, tmp_path, monkeypatch):
    texts, labels, items, toxic, tainted = planted()
    rows = [(i, t, "en", "abc"[i % 3], len(t)) for i, t in texts.items()]
    documents = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, documents).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    after = {}

    def kept(df, name):
        after[name] = materialize(df, name)
        return after[name]

    monkeypatch.setattr(corpus_pipeline, "materialize", kept)
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {name: sorted(r[0] for r in df.select("doc_id").collect()) for name, df in after.items()}
    assert set(ids) == {name for name, _ in corpus_pipeline.STAGES}

    harmless = {i: t for i, t in texts.items() if i not in toxic}
    assert ids["toxicity"] == sorted(harmless)
    groups = classes(harmless)
    assert len(set(groups.values())) == len(harmless) - 10
    assert sorted(groups[i] for i in ids["near_duplicates"]) == sorted(set(groups.values()))
    assert ids["decontamination"] == sorted(set(ids["near_duplicates"]) - tainted)

    size = {i: len(texts[i].split()) for i in ids["decontamination"]}
    weights = dict(zip("abc", (3, 1, 2)))
    total = {s: sum(n for i, n in size.items() if "abc"[i % 3] == s) for s in "abc"}
    target, left, budget = {}, dict(weights), 1.5 * sum(total.values())
    while left:  # sources above twice their size stop there, the rest is shared again
        share = {s: budget * w / sum(left.values()) for s, w in left.items()}
        full = [s for s in left if share[s] >= 2 * total[s]] or list(left)
        capped = any(share[s] >= 2 * total[s] for s in left)
        for s in full:
            target[s] = 2 * total[s] if capped else share[s]
            budget -= target[s]
            del left[s]
    taken = {s: sum(size[i] for i in ids["mixing"] if "abc"[i % 3] == s) for s in "abc"}
    for s in "abc":
        assert abs(taken[s] - target[s]) <= max(size.values())
    assert all(ids["mixing"].count(i) <= 2 for i in size) and set(ids["mixing"]) <= set(size)

    coder = tokenizers.Tokenizer.from_file(tokenizer_file())
    lengths = sorted((r.doc_id, r.n_tokens) for r in found)
    assert lengths == [(i, len(coder.encode(texts[i], add_special_tokens=False).ids) + 1) for i in ids["mixing"]]
