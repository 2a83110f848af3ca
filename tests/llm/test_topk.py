import math
import random

import numpy as np

from crashlake.llm import op2_topk as op


def plain(rows, k):
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asks = {}
    for i, v in ok:
        if i % 100 == 0:
            asks[i] = min(asks.get(i, v), v)
    out = []
    for q, a in asks.items():
        best = sorted((-sum(x * y for x, y in zip(a, v)), i) for i, v in ok if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def test_index_is_exact_on_ties_and_clusters():
    rng = np.random.default_rng(5)
    vectors = np.concatenate([rng.integers(-300, 300, (500, 12)), np.tile(rng.integers(-300, 300, 12), (300, 1)), np.zeros((50, 12), int)]).astype(np.int64)
    ids = rng.permutation(len(vectors)).astype(np.int64)
    index = op.ImpactIndex(ids, vectors)
    for row in (0, 3, 600, 840):
        got = index.search(int(ids[row]), vectors[row], 10)
        score = vectors @ vectors[row]
        others = np.flatnonzero(ids != ids[row])
        best = others[np.lexsort((ids[others], -score[others]))[:10]]
        assert got[0].tolist() == ids[best].tolist() and got[1].tolist() == score[best].tolist()


def test_queries_against_all_rows(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(8)]) for i in range(0, 900, 3)]
    rows += [(1, rows[0][1]), (2, rows[0][1]), (5, [0.5, -0.5]), (400, []), (7, None), (None, rows[0][1]), (8, [None] * 8), (10, [float("nan")] * 8),
             (11, [float("inf")] * 8), (4, rows[1][1]), (4, rows[1][1]), (300, rows[2][1])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id bigint, embedding array<double>, v string, block int")
    v = op.integer_vectors(df)
    got = sorted(tuple(r) for r in op.top_k(v, v.where("vec_id % 100 = 0"), 10).collect())
    assert got == plain(rows, 10)


def test_fewer_candidates_than_k_and_empty(spark):
    v = op.integer_vectors(spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id bigint, embedding array<float>"))
    assert [tuple(r) for r in op.top_k(v, v.where("vec_id = 0"), 10).collect()] == [(0, 1, 1, 1024 * 2048)]
    assert op.top_k(v.limit(0), v.limit(0), 10).count() == 0
