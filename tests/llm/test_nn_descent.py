"""Nearest neighbours against brute force: exact on small tables, recall on larger ones."""

import math
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from yearwheel.llm import files, nn_descent

SCHEMA = "vec_id long, embedding array<float>, label string, node long, size int"


def brute(rows, k, is_query):
    fine = sorted({(i, tuple(v)) for i, v, *_ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)})
    out = {}
    for i, v in fine:
        if is_query(i):
            q = np.array(v, np.float32).astype(np.float64)
            met = sorted((-float(q @ np.array(w, np.float32).astype(np.float64)), j) for j, w in fine if j != i and len(w) == len(v))
            out[i] = [(j, -s) for s, j in met[:k]]
    return out


def got(found):
    out = {}
    for r in found.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def test_small_table_is_exact(spark, stage):
    rng = random.Random(4)
    rows = [(k, [rng.gauss(0, 1 + k % 3) for _ in range(5)]) for k in range(60)]
    rows += [(k, [1.0, 2.0, 2.0, 1.0, 0.5]) for k in range(100, 160)]  # more copies of a vector than are asked for
    rows += [(k, [float(k), 1.0]) for k in range(200, 204)] + [(210, [3.0])]
    rows += [rows[0], (300, None), (301, []), (302, [0.0] * 5), (303, [1.0, None, 1.0, 1.0, 1.0]), (304, [float("nan")] * 5), (305, [float("inf")] * 5), (None, [1.0] * 5)]
    table = spark.createDataFrame([(*r, "x", 1, 1) for r in rows], SCHEMA)
    found = got(nn_descent.nearest(table, F.col("vec_id") % 2 == 0, stage, k=4))
    want = brute(rows, 4, lambda i: i % 2 == 0)
    want = {i: w for i, w in want.items() if w}
    assert found.keys() == want.keys()
    for i, w in want.items():
        assert [r for r, _, _ in found[i]] == list(range(1, len(w) + 1))
        assert [j for _, j, _ in found[i]] == [j for j, _ in w]
        assert [s for *_, s in found[i]] == pytest.approx([s for _, s in w], rel=1e-12)


def test_empty_table(spark, stage):
    assert nn_descent.nearest(spark.createDataFrame([], SCHEMA), F.lit(True), stage).count() == 0


@pytest.mark.parametrize("crowd", [0, 700])
def test_recall(spark, stage, crowd):
    """Random directions, and a crowd of near copies beside them, in blocks far smaller than the table."""
    rng = np.random.default_rng(6)
    free = rng.standard_normal((2100 - crowd, 24))
    near = rng.standard_normal(24) + 0.1 * rng.standard_normal((crowd, 24))
    points = np.concatenate([free, near])
    points = (points / np.linalg.norm(points, axis=1)[:, None]).astype(np.float32)
    rows = [(k, v, "x", 1, 1) for k, v in enumerate(points.tolist())]
    found = got(nn_descent.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, stage, k=10, block_rows=128, file_rows=300, degree=16, reverse=8, beam=80))
    queries = np.arange(0, len(points), 20)
    scores = points[queries].astype(np.float64) @ points.T.astype(np.float64)
    scores[np.arange(len(queries)), queries] = -9
    hits = [len(set(np.argsort(-s)[:10].tolist()) & {j for _, j, _ in found[q]}) / 10 for q, s in zip(queries.tolist(), scores, strict=True)]
    assert np.mean(hits) >= 0.95
    for q, s in zip(queries.tolist(), scores, strict=True):
        assert [x for *_, x in found[q]] == pytest.approx([s[j] for _, j, _ in found[q]], rel=1e-12)


def test_records_by_range_and_by_block(tmp_path):
    values = np.arange(4000, dtype=np.float32).reshape(1000, 4)
    sink = files.Sink(str(tmp_path), ".vectors")
    sink.write(values.tobytes())
    sink.close()
    assert Path(sink.path).exists()
    nodes = (7 << nn_descent.PLACE_BITS) + np.array([5, 999, 5, 0])
    few = nn_descent.Records({7: (sink.path, 1000)}, np.float32, 4)
    assert np.array_equal(few(nodes), values[[5, 999, 5, 0]])
    assert not few.cache
    many = (7 << nn_descent.PLACE_BITS) + np.arange(1000)[::-1]
    assert np.array_equal(few(many), values[::-1])
    assert few.cache
