import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from logwarden.llm.hard_negatives import HardNegativeConfig, mine

SCHEMA = "vec_id long, label int, embedding array<float>, key long, score long, block int, part int"


def brute(rows, is_anchor, cfg):
    kept = [
        (i, label, [math.floor(float(np.float32(x)) * cfg.scale) for x in v]) for i, label, v in rows
        if None not in (i, label, v) and all(x is not None and math.isfinite(x) for x in v)
    ]
    def score(a, b):
        return max(-(2**63), min(2**63 - 1, sum(p * q for p, q in zip(a, b, strict=False))))

    out = []
    for anchor, label, a in {(i, lab, tuple(v)) for i, lab, v in kept if is_anchor(i)}:
        scored = sorted((-score(a, v), i, lab) for i, lab, v in kept if i != anchor)
        for s, positive, _ in [r for r in scored if r[2] == label][: cfg.positives]:
            inside = [
                (t, i) for t, i, lab in scored if lab != label and cfg.low * -s <= 100 * -t <= cfg.high * -s
            ]
            out += [
                (anchor, positive, rank, i, -s, -t) for rank, (t, i) in enumerate(inside[: cfg.negatives], 1)
            ]
    return sorted(out)


def run(spark, rows, cfg, every=5):
    frame = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in mine(frame, F.col("vec_id") % every == 0, cfg).collect())


def made(seed=1, n=150, dims=6, labels=3, grain=8):
    pick = random.Random(seed)
    return [
        (i, pick.choice([0] * 3 + list(range(labels))), [pick.randint(-grain, grain) / grain for _ in range(dims)])
        for i in range(n)
    ]


@pytest.mark.parametrize("cfg", [
    HardNegativeConfig(), HardNegativeConfig(block=20, anchor_block=4, step=1),
    HardNegativeConfig(positives=2, negatives=50, low=0, high=100, block=64, step=7),
])
def test_brute_force(spark, cfg):
    rows = made()
    want = brute(rows, lambda i: i % 5 == 0, cfg)
    assert want and run(spark, rows, cfg) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        *made(2, 60), (None, 1, [1.0] * 6), (300, None, [1.0] * 6), (305, 1, None), (310, 1, [nan] * 6),
        (315, 1, [inf] + [0.0] * 5), (320, 1, [None] + [0.0] * 5), (325, 1, []), (330, 0, [0.0] * 6),
        (335, 2, [1.0, 1.0]), (340, 1, [-1.0] * 6), *made(2, 60)[:7],
    ]
    cfg = HardNegativeConfig(block=16, anchor_block=3, step=2)
    want = brute(rows, lambda i: i % 5 == 0, cfg)
    assert run(spark, rows, cfg) == want


def test_large_components(spark):
    pick = random.Random(4)
    rows = [(i, i % 2, [pick.uniform(-1, 1) * 10.0 ** pick.randint(0, 12) for _ in range(4)]) for i in range(40)]
    cfg = HardNegativeConfig(low=0, high=100)
    want = brute(rows, lambda i: i % 5 == 0, cfg)
    assert want and run(spark, rows, cfg) == want


def test_ties_go_to_the_smaller_id(spark):
    rows = [(0, 0, [1.0, 0.0]), *[(i, 0, [1.0, 0.0]) for i in range(9, 2, -1)]]
    rows += [(i, 1, [0.75, 0.5]) for i in range(30, 10, -1)]
    got = run(spark, rows, HardNegativeConfig(block=4, step=1), every=100)
    assert [(r[1], r[2], r[3]) for r in got] == [(p, k + 1, 11 + k) for p in range(3, 8) for k in range(3)]


def test_empty(spark):
    assert run(spark, [], HardNegativeConfig()) == []
    assert run(spark, [(5, 1, [1.0])], HardNegativeConfig()) == []
