import numpy as np
from regiostar.llm import block_topk


def test_blocks_meet_without_a_broadcast(spark):
    """Many blocks over few bytes: every query block meets every candidate block, and none is copied through the driver."""
    draws = np.random.default_rng(5)
    v = draws.integers(-3, 4, (90, 3)) * np.array([1, 1 << 9, 1 << 20])
    vectors = spark.createDataFrame([(i, [int(x) for x in row]) for i, row in enumerate(v)], "id long, v array<long>")
    vectors = vectors.union(vectors.where("id < 20"))
    found = block_topk.top_k(vectors, vectors.where("id % 3 = 0"), 4, query_rows=2, candidate_rows=4)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect())
    ids = [*range(90), *range(20)]
    expected = []
    for q in range(0, 90, 3):
        best = sorted((-int(v[i] @ v[q]), i) for i in ids if i != q)[:4]
        expected += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert got == expected
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_equal_rows_spread_over_the_grid(spark):
    """Equal candidates share a partition and fill several blocks; each block counts once for each query."""
    vectors = spark.createDataFrame([(1, [2, 1])] * 37 + [(n, [n, 0]) for n in range(2, 6)], "id long, v array<long>")
    found = block_topk.top_k(vectors, vectors.where("id = 2"), 30, query_rows=1, candidate_rows=3)
    assert [(r.vec_id, r.score) for r in found.orderBy("rank").collect()] == [(5, 10), (4, 8), (3, 6), *[(1, 4)] * 27]
