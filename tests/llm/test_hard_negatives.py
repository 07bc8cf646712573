"""Hard negatives against a brute-force loop over all pairs."""

import math
import random

import numpy as np
import pytest

from hypeline.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, anchor string, id string, block string"


def brute(rows):
    """Rows of the contract from [(vec_id, vector, label)]."""
    v = []
    for i, x, y in rows:
        if y is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        y = (y + 1) % 10 if i is not None and i % 7 == 0 else y
        v.append((i, y, [math.floor(256 * float(np.float32(c))) for c in x]))
    out = []
    last = 1 << 63
    for k, (a, y, x) in enumerate(v):
        if a is None or a % 100:
            continue
        scored = [(-sum(p * q for p, q in zip(x, z)), last if b is None else b, w) for j, (b, w, z) in enumerate(v)
                  if j != k and len(z) == len(x)]
        scored.sort()
        for ps, p, _ in [t for t in scored if t[2] == y][:5]:
            fit = [t for t in scored if t[2] != y and 30 * -ps <= 100 * -t[0] <= 90 * -ps][:10]
            out += [(a, p, r, n, -ps, -s) for r, (s, n, _) in enumerate(fit, 1)]
    return sorted((tuple(None if c == last else c for c in r) for r in out), key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    got = H.hard_negatives(df, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted([tuple(r) for r in got.collect()], key=str)


def clustered(n, dims, seed, spread=0.4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dims))
    return [(i * 5, (centres[i % 4] + spread * rng.normal(size=dims)).astype(np.float32).tolist(), int(rng.integers(3)))
            for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"per_round": 3, "block": 7}])
def test_clusters(spark, options):
    rows = clustered(300, 6, 1)
    got = run(spark, rows, **options)
    assert got == brute(rows) and len(got) > 100


def test_awkward_rows(spark):
    same = [0.5, 0.25, -0.125]
    rows = [(100, same, 1), (100, same, 1), (200, same, 2), (None, same, 2), (None, same, 1), (3, None, 1), (4, same, None),
            (5, [None, 1.0, 1.0], 1), (6, [float("nan"), 1.0, 1.0], 2), (8, [float("inf"), 1.0, 1.0], 2),
            (300, [], 1), (301, [], 1), (302, [], 2), (400, [0.0, 0.0, 0.0], 1), (401, [0.0, 0.0, 0.0], 1),
            (402, [0.0, 0.0, 0.0], 2), (500, [-1.0, -1.0, 0.0], 3), (501, [1.0, 1.0, 0.0], 3), (502, [0.7, 0.7, 0.0], 2),
            (700, [0.3, 0.3, 0.1], 9), (701, [0.3, 0.2, 0.1], 0), (702, [0.2, 0.2, 0.1], 9), (9, [0.2, 0.1], 1)]
    rows += [(900 + i, [0.3, 0.1, 0.2], 2) for i in range(25)]              # ties
    rows += [(77, [0.6, 0.5, 0.1], 1)] * 30 + [(78, [0.4, 0.3, 0.1], 2)] * 30   # repeated rows
    for options in ({}, {"per_round": 2, "block": 4}):
        got = run(spark, rows, **options)
        assert got == brute(rows) and got


def test_nothing(spark):
    assert run(spark, []) == [] and run(spark, [(1, [1.0], 1)]) == [] and run(spark, [(100, [1.0], 1)]) == []


def test_bounds_hold():
    rng = np.random.default_rng(4)
    a, v = rng.integers(-300, 300, (20, 8)), rng.integers(-300, 300, (50, 8))
    least, most = H.bounds(a, v.min(axis=0)[None, :], v.max(axis=0)[None, :])
    score = H.products(a, v)
    assert (least[:, 0] <= score.min(axis=1)).all() and (most[:, 0] >= score.max(axis=1)).all()
    big = np.array([[1 << 30, 3]])
    assert H.products(big, big)[0, 0] == (1 << 60) + 9
    with pytest.raises(OverflowError):
        H.products(np.array([[1 << 32]]), np.array([[1 << 32]]))


@pytest.mark.parametrize("dims, bits", [(2, 3), (3, 2), (4, 2)])
def test_hilbert_curve_visits_neighbours(dims, bits):
    side = 1 << bits
    cells = np.stack(np.meshgrid(*[np.arange(side)] * dims), -1).reshape(-1, dims)
    keys = [k.tobytes() for k in H.hilbert_keys(cells, bits)]
    assert len(set(keys)) == len(cells)
    path = cells[np.argsort(np.array(keys, object), kind="stable")]
    assert (np.abs(np.diff(path.astype(int), axis=0)).sum(axis=1) == 1).all()


def test_blocks_are_skipped(spark):
    """Far clusters: the bounds keep most blocks from being read."""
    rng = np.random.default_rng(9)
    centres = np.eye(8) * 4
    rows = [(i, (centres[i % 8] + 0.05 * rng.normal(size=8)).astype(np.float32).tolist(), i % 8 // 2) for i in range(1600)]
    blocks = H.block_table(H.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"),
                                       "vec_id", "embedding", "label"), 20)
    anchors = H.anchor_table(blocks).toArrow().to_pylist()
    low = np.array([[-(1 << 62) if r["reach"] is None else r["reach"]] for r in anchors])
    task = H.Round(anchors, low, np.full_like(low, 1 << 62), 5, True)
    zones = blocks.select("label", "dim", "lo", "hi").collect()
    read = [len(task.reached(z["label"], z["dim"], np.array(z["lo"], np.int64), np.array(z["hi"], np.int64), low)) for z in zones]
    assert sum(read) < 0.15 * len(anchors) * len(zones)
