from __future__ import annotations

import numpy as np

from tributary.llm import neighbours


def brute_force(ids, x, queries, k=5):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in queries:
        i = int(np.flatnonzero(ids == q)[0])
        cosine = np.round(unit @ unit[i], 12)
        out[q] = [int(ids[j]) for j in np.lexsort((ids, -cosine)) if j != i][:k]
    return out


def test_recall_ties_and_copies(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 24))
    x[700:] = x[5]  # a large group of copies
    ids = rng.permutation(5000)[:900]
    frame = spark.createDataFrame([(int(i), v.tolist(), 1, "n") for i, v in zip(ids, x, strict=True)], "vec_id BIGINT, embedding ARRAY<DOUBLE>, node INT, id STRING")
    queries = frame.where("vec_id % 20 = 0")
    found = neighbours.nearest_neighbours(frame, queries).collect()
    want = brute_force(ids, x, [int(i) for i in ids if i % 20 == 0])
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    # Among copies the smaller ids win.
    for q in want:
        if q in set(ids[700:].tolist()):
            assert got[q] == want[q]


def test_unusable_vectors_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [-1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]),
        (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 0.0]), (8, [1.0, 2.0, 3.0]), (0, [1.0, 0.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>")
    found = neighbours.nearest_neighbours(frame, frame.where("vec_id % 2 = 0")).collect()
    got = {(r["query_id"], r["rank"]): (r["vec_id"], round(r["score"], 6)) for r in found}
    assert got == {
        (0, 1): (1, round(2**-0.5, 6)), (0, 2): (2, -1.0), (2, 1): (1, round(-(2**-0.5), 6)), (2, 2): (0, -1.0),
    }
    assert neighbours.nearest_neighbours(frame.limit(0), frame.limit(0)).collect() == []
    assert neighbours.nearest_neighbours(frame.limit(1), frame.limit(1)).collect() == []


def test_outliers_beside_tight_clusters(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(2, 64))
    x = np.concatenate([centres[i % 2] + 0.01 * rng.normal(size=(1, 64)) for i in range(2100)] + [rng.normal(size=(12, 64))])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    short = neighbours.short_vectors(frame.selectExpr("xxhash64(embedding) AS node", "embedding AS v"))
    edges = neighbours.start_edges(short, len(x), 32, 6).groupBy("node").count().collect()
    assert len(edges) == len(x) and min(r["count"] for r in edges) >= 32
    found = neighbours.nearest_neighbours(frame, frame.where("vec_id >= 2090"), turns=2).collect()
    counts = {q: sum(r["query_id"] == q for r in found) for q in range(2090, 2112)}
    assert set(counts.values()) == {5}


def test_tiny_and_huge_components(spark):
    """Squares that a double cannot hold: nearness is that of the directions."""
    tiny, huge = 5e-324, 1.5e308
    rows = [
        (0, [tiny, 0.0]), (1, [huge, 0.0]), (2, [1e-200, 1e-200]), (3, [huge, huge]), (4, [0.0, 1.0]), (5, [-huge, tiny]),
        (6, [1e200, -1e200]),
    ]
    frame = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    found = neighbours.nearest_neighbours(frame, frame).collect()
    got = {(r["query_id"], r["rank"]): (r["vec_id"], round(r["score"], 9)) for r in found}
    half = round(2**-0.5, 9)
    assert [got[0, r] for r in range(1, 6)] == [(1, 1.0), (2, half), (3, half), (6, half), (4, 0.0)]
    assert got[2, 1] == (3, 1.0) and got[4, 1] == (2, half) and got[5, 1] == (4, 0.0)
    assert len(found) == 35 and all(-1 - 1e-9 <= r["score"] <= 1 + 1e-9 for r in found)
