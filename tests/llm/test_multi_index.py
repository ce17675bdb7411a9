import numpy as np

from yearwheel.llm import multi_index
from yearwheel.operators.staging import Staging

SCHEMA = "vec_id long, embedding array<float>, label int, rep long"


def vectors(n=500, size=16, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(40, size))
    rows = []
    for i in range(n):
        v = centres[rng.integers(40)] + rng.normal(size=size) * (0.06 if i % 3 else 0.6)
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(rng.integers(3)) if i % 10 else 0, 1))
    rows += [(n + k, rows[7][1], rows[7][2], 1) for k in range(30)]  # exact copies
    return rows


def brute(rows):
    ids = np.array([r[0] for r in rows])
    v = np.array([r[1] for r in rows], np.float32).astype(float)
    v /= np.linalg.norm(v, axis=1)[:, None]
    near = (v @ v.T >= 0.98) & (np.array([r[2] for r in rows])[:, None] == np.array([r[2] for r in rows]))
    np.fill_diagonal(near, False)
    root = np.arange(len(rows))
    while True:
        low = np.minimum(root, np.where(near, root, len(rows)).min(1))
        if (low == root).all():
            return {int(i): (int(n), int(ids[c])) for i, n, c in zip(ids, near.sum(1), root, strict=True)}
        root = low


def test_links_and_recall(spark, stage):
    rows = vectors()
    got = multi_index.near_duplicates(spark.createDataFrame(rows, SCHEMA), stage, block_stored=64, block_searching=50).collect()
    found, want = {r.vec_id: (r.n_links, r.component_id) for r in got}, brute(rows)
    assert len(got) == len(rows) and all(found[k][0] <= want[k][0] for k in want)
    total = sum(n for n, _ in want.values())
    assert total > 500 and sum(n for n, _ in found.values()) >= 0.99 * total
    assert np.mean([found[k][1] == want[k][1] for k in want]) > 0.98
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_faulty_vectors_link_with_nothing(spark, stage):
    good = [1.0, 2.0, 3.0, 4.0]
    rows = [(1, good, 1, 0), (2, good, 1, 0), (3, good, None, 0), (4, None, 1, 0), (5, [0.0] * 4, 1, 0), (6, [1.0, None, 3.0, 4.0], 1, 0),
            (7, [float("nan"), 2.0, 3.0, 4.0], 1, 0), (8, [float("inf"), 2.0, 3.0, 4.0], 1, 0), (9, [], 1, 0), (10, good[:3], 1, 0), (None, good, 1, 0), (11, good, 2, 0)]
    table = spark.createDataFrame(rows, SCHEMA)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in multi_index.near_duplicates(table, stage).collect()}
    assert got.pop(1) == (1, 1, True) and got.pop(2) == (1, 1, False) and got.pop(None) == (0, None, False)
    assert got == {k: (0, k, True) for k in (3, 4, 5, 6, 7, 8, 9, 10, 11)}
    assert multi_index.near_duplicates(table.limit(0), Staging(spark)).count() == 0


def test_walk_visits_what_is_in_reach():
    rng = np.random.default_rng(1)
    sample = rng.normal(size=(400, 8))
    sample /= np.linalg.norm(sample, axis=1)[:, None]
    grid = multi_index.Grid(sample, 6, 0.98, 0.999)
    first, second = grid.bounds(sample)
    want = first[:, :, None] + second[:, None, :] <= grid.reach
    got = np.zeros_like(want)
    rows, ones, flags = grid.visits(sample)
    got[rows, ones] = flags
    assert np.array_equal(got, want)


def test_each_length_links(spark, stage):
    long, short = [1.0, 2.0, 3.0, 4.0], [1.0, 2.0]
    rows = [(1, long, 1, 0), (2, [1.001, 2.0, 3.0, 4.0], 1, 0), (3, [1.0, 2.001, 3.0, 4.0], 1, 0), (4, short, 1, 0), (5, [1.001, 2.0], 1, 0)]
    rows += [(6, [3.0], 1, 0), (7, [0.5], 1, 0), (8, [-1.0], 1, 0), (9, [float("inf")], 1, 0), (10, [0.0], 1, 0), (11, [3.0], 2, 0)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in multi_index.near_duplicates(spark.createDataFrame(rows, SCHEMA), stage).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (1, 4), 5: (1, 4), 6: (1, 6), 7: (1, 6), 8: (0, 8), 9: (0, 9), 10: (0, 10), 11: (0, 11)}


def test_both_ends_count_a_link(spark, stage):
    """A fine grid, and neighbours at the threshold that differ in all components, in two or in one half."""
    rng = np.random.default_rng(9)
    points = rng.normal(size=(2400, 16))
    points /= np.linalg.norm(points, axis=1)[:, None]
    twins = []
    for k, p in enumerate(points[:900]):
        noise = rng.normal(size=16)
        if k % 3 == 1:
            noise[2:] = 0
        elif k % 3 == 2:
            noise[8:] = 0
        noise -= (noise @ p) * p
        twins.append(0.9815 * p + np.sqrt(1 - 0.9815**2) * noise / np.linalg.norm(noise))
    rows = [(k, v, 1, 0) for k, v in enumerate(np.concatenate([points, twins]).astype(np.float32).tolist())]
    want = brute(rows)
    got = multi_index.near_duplicates(spark.createDataFrame(rows, SCHEMA), stage, cell_rows=4, block_stored=500, block_searching=700).collect()
    found = {r.vec_id: r.n_links for r in got}
    pairs = [(k, 2400 + k) for k in range(900)]
    # of the planted pairs nearly all are found, and no end lacks what the other has
    assert sum(found.values()) >= 0.99 * sum(n for n, _ in want.values())
    alone = [(a, b) for a, b in pairs if want[a][0] == want[b][0] == 1 and found[a] != found[b]]
    assert alone == []
    assert all(found[k] <= want[k][0] for k in want)
