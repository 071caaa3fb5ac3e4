"""Recall of short items and of partial passages with substituted words."""

import random
from itertools import combinations

import numpy as np
import pytest

from regiostar.llm import spaced_seeds


@pytest.mark.parametrize("length", range(5, 21))
def test_seeds_hit_every_placement_of_allowed_substitutions(length):
    item = np.arange(1, length + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    shapes = spaced_seeds.item_shapes(length)
    own = spaced_seeds.seed_hashes(item, shapes)
    for n in range(length // 5 + 1):
        for out in combinations(range(length), n):
            copy = item.copy()
            copy[list(out)] += np.uint64(1)
            assert any((a == b).any() for a, b in zip(own, spaced_seeds.seed_hashes(copy, shapes), strict=True)), out


def test_substituted_items_and_partial_passages_are_found(spark):
    rng = random.Random(6)
    docs, items, want = [], [], set()
    for name, length in enumerate(list(range(5, 21)) + [40] * 7):
        item = [f"i{name}w{i}" for i in range(length)]
        items.append((name, " ".join(item)))
        for _ in range(20):
            part = 13 + name - 16 if length == 40 else length  # of the long items, passages of 13 to 19 words
            start = rng.randint(0, length - part)
            passage = item[start : start + part]
            for i in rng.sample(range(part), part // 5):
                passage[i] = f"x{rng.getrandbits(40)}"
            docs.append((len(docs), " ".join([f"a{rng.getrandbits(40)}"] * 30 + passage + [f"b{rng.getrandbits(40)}"] * 30)))
            want.add((len(docs) - 1, name))
        if length < 13:  # one word more than may differ
            docs.append((len(docs), " ".join([f"x{i}" for i in range(length // 5 + 1)] + item[length // 5 + 1 :])))
    found = spaced_seeds.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == want
