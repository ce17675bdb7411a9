"""Hard negatives against brute force, and what the trees promise."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from yearwheel.llm import cover_tree

SCHEMA = "vec_id long, label string, vec array<double>, row int, top int"


def brute(rows, is_anchor, positives=5, negatives=3, least=50, most=95):
    fine = {(i, c, tuple(v)) for i, c, v, *_ in rows if None not in (i, c, v) and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, c, v in fine:
        if not is_anchor(i):
            continue
        met = [(j, d, int(sum(x * y for x, y in zip(v, w, strict=True)))) for j, d, w in fine if j != i and len(w) == len(v)]
        own = sorted((-s, j) for j, d, s in met if d == c)[:positives]
        for p, j in own:
            fits = sorted((-s, k) for k, d, s in met if d != c and least * -p <= 100 * s <= most * -p)
            out += [(i, j, r, k, -p, -s) for r, (s, k) in enumerate(fits[:negatives], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for k in range(700):
        v = [float(rng.randint(-40, 40)) for _ in range(6)]
        if k % 3 == 0:  # a third are near copies of one vector, many of them exact
            v = [50.0, 40.0, -30.0, 20.0, 10.0 + rng.randint(0, 1), 5.0]
        out.append((k, "abcd"[rng.randrange(4)], v))
    out += [(k, "a", [float(k % 5)]) for k in range(1000, 1030)]
    out += [(k, "ab"[k % 2], [1.0, float(k % 7)]) for k in range(1030, 1060)] + [(1060, "a", []), (1061, "a", []), (1062, "b", [])]
    out += [(1070, "a", [0.0] * 6), (0, "a", out[0][2]), out[0], (0, "b", out[5][2]), (7, "c", [9.0] * 6)]
    out += [(None, "a", [1.0] * 6), (1080, None, [1.0] * 6), (1081, "a", None), (1082, "a", [1.0, None] * 3), (1083, "b", [float("nan")] * 6), (1084, "b", [float("inf")] * 6)]
    return [(*r, 1, 2) for r in out]


@pytest.mark.parametrize("block", [64, 4096])
def test_equals_brute_force(spark, stage, rows, block):
    table = spark.createDataFrame(rows, SCHEMA)
    found = cover_tree.mine_negatives(table, F.col("vec_id") % 10 == 0, stage, block_rows=block, block_anchors=block // 2, train_rows=200)
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute(rows, lambda i: i % 10 == 0)
    assert sorted(tuple(r) for r in found.select(columns).collect()) == want
    assert len(want) > 300


def test_no_rows_no_anchors_one_label(spark, stage, rows):
    one = spark.createDataFrame([(k, "a", [1.0, float(k)], 1, 1) for k in range(20)], SCHEMA)
    for k, (table, anchors) in enumerate([(spark.createDataFrame([], SCHEMA), F.lit(True)), (spark.createDataFrame(rows, SCHEMA), F.lit(False)), (one, F.lit(True))]):
        from yearwheel.operators.staging import Staging

        assert cover_tree.mine_negatives(table, anchors, Staging(spark, f"{stage.folder}/{k}")).count() == 0


def test_other_numbers(spark, stage, rows):
    table = spark.createDataFrame(rows, SCHEMA)
    found = cover_tree.mine_negatives(table, F.col("vec_id") == 30, stage, positives=2, negatives=4, least_percent=10, most_percent=90)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, lambda i: i == 30, 2, 4, 10, 90)


def test_radii_cover_and_descent_skips():
    rng = np.random.default_rng(2)
    centres = rng.integers(-200, 200, (40, 8))
    points = (centres[rng.integers(0, 40, 3000)] + rng.integers(-3, 4, (3000, 8))).astype(np.float64)
    tree = cover_tree.CoverTree(points)
    wide = cover_tree.augmented(points, tree.bound)[tree.order]
    for c, r, begin, end, child, last in zip(tree.centre, tree.radius, tree.begin, tree.end, tree.child, tree.last, strict=True):
        assert np.sqrt(((wide[begin:end] - wide[c]) ** 2).sum(1)).max() <= r + 1e-6
        if child < last:
            assert tree.begin[child] == begin
            assert tree.end[last - 1] == end
            assert all(tree.radius[k] <= r for k in range(child, last))
    names = ("centre", "radius", "begin", "end", "child", "last", "level")
    row = {"points": points[tree.order].tobytes(), "ids": tree.order.tolist(), "labels": ["a"] * 3000, "bound": tree.bound}
    search = cover_tree.Search(row | {n: getattr(tree, n) for n in names}, points[:50], np.array(["b"] * 50, object), np.arange(50), False, np.full((50, 1), -np.inf), np.full((50, 1), np.inf), 5)
    search.run()
    want = -np.sort(-(points[:50] @ points.T), 1)[:, :5]
    assert np.array_equal(search.scores[:, 0], want)
    # on clustered points most rows are never looked at
    assert search.verified < 0.3 * 50 * 3000
