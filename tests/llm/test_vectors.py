"""Hard negatives (11) against brute force: odd rows, clusters, small leaves, blocks and chunks."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import hard_negatives

SCHEMA = "vec_id bigint, embedding array<double>, label int, row string, block int, unit string"


def brute(rows, anchor, positives=5, negatives=3):
    kept = []
    for vec_id, v, label in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [math.floor(256 * x) for x in v], label))
    best = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for i, (a, va, la) in enumerate(kept):
        if a is None or not anchor(a):
            continue
        scored = [(sum(x * y for x, y in zip(va, v, strict=False)), b, label) for k, (b, v, label) in enumerate(kept) if k != i]
        for ps, p, _ in sorted((s for s in scored if s[2] == la), key=best)[:positives]:
            hard = sorted((s for s in scored if s[2] != la and 50 * ps <= 100 * s[0] <= 95 * ps), key=best)[:negatives]
            out += [(a, p, r + 1, n, ps, ns) for r, (ns, n, _) in enumerate(hard)]
    return sorted(out, key=repr)


def mined(spark, rows, anchor=5, partitions=5):
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(partitions)
    got = hard_negatives.mine(frame, F.col("vec_id") % anchor == 0)
    return sorted((tuple(r) for r in got.collect()), key=repr)


def cloud(n, dim, centres, seed, spread=0.15):
    rng = random.Random(seed)
    middle = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(centres)]
    return [(i, [c + rng.gauss(0, spread) for c in middle[rng.randrange(centres)]], rng.randrange(3)) for i in range(n)]


def test_odd_rows(spark):
    rows = cloud(60, 6, 4, 1)
    nan, inf = float("nan"), float("inf")
    rows += [(65, None, 1), (70, [1.0, None], 1), (75, [nan] * 6, 1), (80, [inf] * 6, 2), (85, [0.5] * 6, None), (None, [0.4] * 6, 1), (None, [0.4] * 6, 2)]
    rows += [(90, [], 1), (95, [0.0] * 6, 2), (100, [1.0, 2.0], 0), (-5, [-0.3] * 6, 1), (105, [3e30] * 6, 1), (106, [3e30] * 6, 1), (107, [1e9] * 6, 2)]
    rows += [rows[10], rows[10], (10, [0.1] * 6, 0)] + [(200 + i, [0.7] * 6, i % 3) for i in range(40)]
    got, expected = mined(spark, rows), brute(rows, lambda i: i % 5 == 0)
    most = (1 << 63) - 1
    # what a bigint can't hold is its nearest value, and windows are of the scores that are held
    small = lambda out: [r for r in out if abs(r[4]) < most // 100]
    assert small(got) == small(expected)


@pytest.mark.parametrize("block,chunk", [(40, 7), (1000, 1000)])
def test_clusters(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(hard_negatives, "LEAF_ROWS", 20)
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "CHUNK", chunk)
    rows = cloud(700, 8, 12, 3, 0.05) + [(1000 + i, [0.2] * 8, i % 3) for i in range(150)]
    assert mined(spark, rows, 10) == brute(rows, lambda i: i % 10 == 0)


def test_ranges_leave_out_subtrees(monkeypatch):
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(20, 16))
    x = np.floor(256 * (middle[rng.integers(0, 20, 4000)] + rng.normal(scale=0.02, size=(4000, 16))))
    tree = hard_negatives.Tree(float(np.sqrt((x * x).sum(axis=1)).max()), 16)
    lifted = tree.lift(x)
    tree.grow(lifted, 100)
    leaf = tree.leaf_of(lifted)
    tree.low = [np.full((len(p), len(p)), np.inf) for p in tree.points]
    tree.high = [np.full((len(p), len(p)), -np.inf) for p in tree.points]
    for own in range(len(tree.paths)):
        for node, j in tree.paths[own]:
            angles = tree.angles(lifted[leaf == own], tree.points[node])
            tree.low[node][:, j] = np.minimum(tree.low[node][:, j], angles.min(axis=0))
            tree.high[node][:, j] = np.maximum(tree.high[node][:, j], angles.max(axis=0))
    a = x[:50]
    s = a @ x.T
    least, most = np.sort(s, axis=1)[:, -10], np.sort(s, axis=1)[:, -2]
    lengths = np.sqrt((a * a).sum(axis=1))
    reached = tree.reached(a, tree.angle_of(most, lengths)[:, None], tree.angle_of(least, lengths)[:, None])
    for i in range(50):
        needed = set(leaf[(s[i] >= least[i]) & (s[i] <= most[i])])
        assert needed <= set(reached[i])
    assert sum(map(len, reached)) < 0.5 * 50 * len(tree.paths)


def test_empty(spark):
    assert mined(spark, [(1, [1.0], None)]) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    none = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.mine(none, F.col("vec_id") % 5 == 0).count() == 0
