import math
from collections import defaultdict

import numpy as np

from logwarden.llm import topk
from logwarden.llm.queries import queries
from pyspark.sql import functions as F


def brute(rows, is_query, k=20, scale=64):
    vectors = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        vectors.append((i, [math.floor(scale * float(x)) for x in v]))
    out = defaultdict(list)
    for i, v in {(i, tuple(v)) for i, v in vectors if is_query(i)}:
        scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in vectors if j != i)
        out[i] = [(rank, j, max(-(2**63), min(2**63 - 1, -s))) for rank, (s, j) in enumerate(scores[:k], 1)]
    return dict(out)


def found(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r.query_id].append((r.rank, r.vec_id, r.score))
    return {i: sorted(v) for i, v in out.items()}


def test_query_against_brute_force(spark, sf_dir, table):
    rows = table("embeddings", "vec_id, embedding")
    assert found(queries()["op3_exact_top_k"](spark, sf_dir)) == brute(rows, lambda i: i % 20 == 0)


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, v, 1, 2, 3) for i, v in rows], "vec_id long, embedding array<double>, block int, rank int, score int"
    )


def test_many_blocks_ties_and_copies(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.integers(-40, 40, 8) / 64).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[5][1]) for i in range(150)]
    cfg = topk.TopKConfig(k=7, pivots=5, query_block=10, block=32, step=8)
    got = found(topk.top_k(frame(spark, rows), F.col("vec_id") % 9 == 0, cfg))
    assert got == brute(rows, lambda i: i % 9 == 0, 7)


def test_edge_cases(spark):
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [1.0]),
        (5, []), (6, [-0.001, 0.5, 9.0]), (7, [2.0, 2.0]), (7, [2.0, 2.0]), (20, [0.0]),
    ]
    got = found(topk.top_k(frame(spark, rows), F.col("vec_id") % 20 == 0))
    assert got == brute(rows, lambda i: i % 20 == 0)
    assert topk.top_k(frame(spark, []), F.lit(True)).collect() == []
    assert topk.top_k(frame(spark, [(1, [1.0])]), F.lit(True)).collect() == []
    assert topk.top_k(frame(spark, [(1, [1.0]), (2, [1.0])]), F.lit(False)).collect() == []
    big = [(0, [3e30, 1.0]), (1, [2.0, 5.0]), (2, [1e-30, 2e15]), (3, [-1e20, 4.0])]
    assert found(topk.top_k(frame(spark, big), F.col("vec_id") == 0)) == brute(big, lambda i: i == 0)
