"""Near-duplicate vectors by an inverted multi-index.

Two codebooks, one for each half of a vector, make a grid of cells. Every vector lies in the cell of its
nearest centroids and searches other cells in the order of a lower bound of their distance (how far it is
from the border to that cell, added over both halves) until the bound exceeds ``reach``; ``reach`` is the
quantile ``recall`` of the bounds at which neighbours at the threshold turn up, measured on the training
sample with neighbours in random directions. What is found is verified in double precision.

Cells are dealt out by label and first centroid. A key with many vectors or many searches is cut into
blocks of both, so no task holds more than one block of each. Equal vectors count as one with its number
of copies. A block reports the number of links of each vector and a spanning forest of its links, never
the pairs. A link that only one end finds is counted at both: the bound to the other's cell is not symmetric, so with
each link found the block tells whether the stored vector's own search reaches the searcher's cell.

Vectors of each length have a grid of their own; a length with few vectors has one cell, in which all are compared. Of
vectors of length 1 only the sign matters, so they are equal to others of their sign.

Defined cases: vectors that are null, empty, zero or with null or
non-finite components, and rows without label or vec_id, link with nothing; a row without vec_id has no
component; an empty table gives an empty result; rows with the same vec_id are one vertex; other columns are not read.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearwheel.llm.components import connected
from yearwheel.operators.staging import Staging


def _centroids(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    """k-means; an empty cluster keeps its centroid."""
    centres = points[rng.choice(len(points), k, replace=False)]
    for _ in range(rounds):
        near = _squared(points, centres).argmin(1)
        n = np.bincount(near, minlength=k)
        sums = np.stack([np.bincount(near, weights=column, minlength=k) for column in points.T], 1)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def _squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1), 0)


class Grid:
    """Codebooks of both halves and the distance up to which cells are searched."""

    def __init__(self, sample: np.ndarray, cells: int, threshold: float, recall: float, seed: int = 11):
        """``sample`` holds unit vectors; ``cells`` is the number of centroids of each half."""
        rng = np.random.default_rng(seed)
        self.half, self.size = sample.shape[1] // 2, sample.shape[1]
        k = min(cells, len(sample))
        self.books = [_centroids(part, k, rng) for part in self._halves(sample)]
        self.k = k
        noise = rng.standard_normal(sample.shape)
        noise -= (noise * sample).sum(1)[:, None] * sample
        noise /= np.maximum(np.linalg.norm(noise, axis=1), 1e-300)[:, None]
        near = threshold * sample + np.sqrt(max(0.0, 1 - threshold**2)) * noise
        bounds = np.zeros(len(sample))
        for bound, cell in zip(self.bounds(sample), self.cells(near), strict=True):
            bounds += bound[np.arange(len(sample)), cell]
        self.reach = float(np.quantile(bounds, recall)) + 1e-9

    def _halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return vectors[:, : self.half], vectors[:, self.half :]

    def cells(self, vectors: np.ndarray) -> list[np.ndarray]:
        return [_squared(part, book).argmin(1) for part, book in zip(self._halves(vectors), self.books, strict=True)]

    def bounds(self, vectors: np.ndarray) -> list[np.ndarray]:
        """Squared distance from each vector to the border of each cell, by halves."""
        out = []
        for part, book in zip(self._halves(vectors), self.books, strict=True):
            squared = _squared(part, book)
            own = squared.argmin(1)
            apart = np.sqrt(_squared(book, book))[own]
            border = (squared - squared.min(1)[:, None]) / np.maximum(2 * apart, 1e-12)
            border[np.arange(len(part)), own] = 0
            out.append(border**2)
        return out

    def visits(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cells searched: row, first centroid, and the flags of its second centroids.

        Both sequences are walked in ascending order; the walk along the first ends for all rows where
        even the nearest second centroid is out of reach.
        """
        first, second = self.bounds(vectors)
        order = np.argsort(first, 1, kind="stable")
        rows, ones, flags = [], [], []
        for step in range(self.k):
            cell = order[:, step]
            left = self.reach - first[np.arange(len(vectors)), cell]
            live = np.flatnonzero(left >= 0)
            if not len(live):
                break
            rows.append(live)
            ones.append(cell[live])
            flags.append(second[live] <= left[live][:, None])
        return np.concatenate(rows), np.concatenate(ones), np.concatenate(flags)

    def reaches(self, vectors: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Whether the search of each vector visits the cell of the other beside it."""
        first, second = self.bounds(vectors)
        one, two = self.cells(others)
        at = np.arange(len(vectors))
        return second[at, two] <= self.reach - first[at, one]


class OneCell:
    """Grid of a length with few vectors: one cell, which every search visits."""

    k = 1

    def cells(self, vectors: np.ndarray) -> list[np.ndarray]:
        return [np.zeros(len(vectors), np.int64)] * 2

    def visits(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(vectors)
        return np.arange(n), np.zeros(n, np.int64), np.ones((n, 1), bool)

    def reaches(self, vectors: np.ndarray, others: np.ndarray) -> np.ndarray:
        return np.ones(len(vectors), bool)


def _matrix(column: pa.Array, size: int | None = None) -> np.ndarray:
    """Rows of lists of equal length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, size or 1)


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1)[:, None]


def usable(rows: DataFrame) -> DataFrame:
    """Rows that can link: vec_id and label known, a vector without faults."""
    # a float that is neither NaN nor infinite is within the range of finite floats; null is not
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= 3.4028234663852886e38))
    some = F.exists("embedding", lambda x: x != 0)
    return rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND size(embedding) > 0").where(fine & some)


def _place(batches, grids: dict[int, Grid | OneCell]):
    """Cell of each class, and its searches."""
    for batch in batches:
        sizes = batch.column(2).value_lengths().to_numpy()
        for size in np.unique(sizes).tolist():
            rows_of = batch.filter(pa.array(sizes == size))
            grid = grids.get(size) or OneCell()
            unit = _units(_matrix(rows_of.column(2)))
            for begin in range(0, rows_of.num_rows, 2048):
                part = slice(begin, begin + 2048)
                own = grid.cells(unit[part])
                rows, ones, flags = grid.visits(unit[part])
                n = len(own[0])
                taken = rows_of.take(pa.array(np.concatenate([np.arange(n), rows]) + begin))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([np.ones(n, bool), np.zeros(len(rows), bool)])),
                        taken.column(1),
                        pa.array(np.full(taken.num_rows, size, np.int32)),
                        pa.array(np.concatenate([own[0], ones]).astype(np.int32)),
                        pa.array(np.concatenate([own[1], np.zeros(len(rows))]).astype(np.int32)),
                        pa.array([None] * n + [np.packbits(f).tobytes() for f in flags], pa.binary()),
                        taken.column(0),
                        taken.column(3),
                        taken.column(2),
                    ],
                    names=_PLACED,
                )


_PLACED = ["stored", "label", "size", "one", "two", "flags", "rep", "copies", "embedding"]
_LINKS = "rep long, other long, n long"


def _compare(stored: pa.Table, searching: pa.Table, grids: dict[int, Grid | OneCell], threshold: float) -> pa.Table:
    """Links of one block of searches with one block of vectors: counts by vector, and a forest."""
    empty = pa.table({"rep": pa.array([], pa.int64()), "other": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    if not stored.num_rows or not searching.num_rows:
        return empty
    d_vec, q_vec = (_matrix(t["embedding"].combine_chunks()) for t in (stored, searching))
    d_len, q_len = np.linalg.norm(d_vec, axis=1), np.linalg.norm(q_vec, axis=1)
    d_id, q_id = stored["rep"].to_numpy(), searching["rep"].to_numpy()
    copies, two = stored["copies"].to_numpy(), stored["two"].to_numpy()
    packed = np.frombuffer(b"".join(searching["flags"].to_pylist()), np.uint8).reshape(len(q_id), -1)
    grid = grids.get(q_vec.shape[1]) or OneCell()
    flags = np.unpackbits(packed, axis=1)[:, : grid.k].astype(bool)
    left, right = [], []
    for cell in np.unique(two):
        d, q = np.flatnonzero(two == cell), np.flatnonzero(flags[:, cell])
        cosine = (q_vec[q] @ d_vec[d].T) / (q_len[q][:, None] * d_len[d])
        i, j = np.nonzero(cosine >= threshold)
        left.append(q[i])
        right.append(d[j])
    q, d = np.concatenate(left), np.concatenate(right)
    other = q_id[q] != d_id[d]
    q, d = q[other], d[other]
    if not len(q):
        return empty
    # smallest id of each component of this block
    names, place = np.unique(np.concatenate([q_id, d_id]), return_inverse=True)
    a, b = place[: len(q_id)][q], place[len(q_id) :][d]
    n = np.bincount(a, weights=copies[d], minlength=len(names))
    # links the other end does not find itself
    for begin in range(0, len(q), 4096):
        part = slice(begin, begin + 4096)
        alone = ~grid.reaches(d_vec[d[part]] / d_len[d[part]][:, None], q_vec[q[part]] / q_len[q[part]][:, None])
        n += np.bincount(b[part][alone], weights=searching["copies"].to_numpy()[q[part]][alone], minlength=len(names))
    n = n.astype(np.int64)
    root = np.arange(len(names))
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if np.array_equal(root, before):
            break
    under = np.flatnonzero(root != np.arange(len(names)))
    seen = np.flatnonzero(n)
    return pa.table(
        {
            "rep": pa.array(np.concatenate([names[seen], names[under]]), pa.int64()),
            "other": pa.array(np.concatenate([np.zeros(len(seen), np.int64), names[root[under]]]), pa.int64(), mask=np.arange(len(seen) + len(under)) < len(seen)),
            "n": pa.array(np.concatenate([n[seen], np.zeros(len(under), np.int64)]), pa.int64()),
        }
    )


def near_duplicates(
    vectors: DataFrame,
    stage: Staging,
    threshold: float = 0.98,
    recall: float = 0.9999,
    train_rows: int = 20_000,
    cell_rows: int = 50,
    block_stored: int = 2048,
    block_searching: int = 4096,
) -> DataFrame:
    """vec_id, label, n_links, component_id and kept for each row of ``vectors`` (vec_id, embedding, label)."""
    vector = F.col("embedding").cast("array<float>")
    # of one component only the sign matters
    vector = F.when(F.size(vector) == 1, F.transform(vector, lambda x: F.when(F.isnan(x) | (F.abs(x) == float("inf")), x).otherwise(F.signum(x)).cast("float"))).otherwise(vector)
    rows = vectors.select(F.col("vec_id").cast("long"), vector.alias("embedding"), F.col("label").cast("string"))
    classes = usable(rows).groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = stage(classes.select("rep", "label", "embedding", "copies"), "classes")
    total = classes.count()
    none = rows.select(
        "vec_id", "label", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept")
    )
    if not total:
        return none
    # lengths whose vectors fill more than one cell are trained on a share of the sample
    sizes = classes.groupBy(F.size("embedding").alias("size")).count().where(F.col("count") >= 4 * cell_rows)
    grids: dict[int, Grid | OneCell] = {}
    for size, n in sizes.orderBy("size").collect():
        share = max(64, train_rows * n // total)
        sample = classes.where(F.size("embedding") == size).orderBy(F.xxhash64("rep"), "rep").select("embedding").limit(share)
        sample = np.array([r[0] for r in sample.collect()], np.float64)
        cells = int(np.clip(np.sqrt(n / cell_rows), 1, max(1, len(sample) // 32)))
        grids[size] = Grid(_units(sample), cells, threshold, recall)
    schema = "stored boolean, label string, size int, one int, two int, flags binary, rep long, copies long, embedding array<float>"
    placed = stage(classes.select("rep", "label", "embedding", "copies").mapInArrow(partial(_place, grids=grids), schema), "placed")
    # blocks of each key
    n = placed.groupBy("label", "size", "one").agg(F.count_if("stored").alias("d"), F.count_if(~F.col("stored")).alias("q"))
    n = n.where("d > 0").select(
        "label", "size", "one", F.ceil(F.col("d") / block_stored).cast("int").alias("d_blocks"), F.ceil(F.col("q") / block_searching).cast("int").alias("q_blocks")
    )
    blocks = stage(n, "blocks")
    dealt = placed.join(blocks, ["label", "size", "one"])
    # each vector has one block of its own kind and meets all blocks of the other
    d_own, q_own = F.pmod(F.xxhash64("rep"), F.col("d_blocks")), F.pmod(F.xxhash64("rep"), F.col("q_blocks"))
    own = F.when(F.col("stored"), d_own).otherwise(q_own).cast("int")
    other = F.when(F.col("stored"), F.col("q_blocks")).otherwise(F.col("d_blocks"))
    dealt = dealt.withColumn("own", own).withColumn("met", F.explode(F.sequence(F.lit(0), other - 1)))
    dealt = dealt.withColumns({"d": F.when(F.col("stored"), F.col("own")).otherwise(F.col("met")), "q": F.when(F.col("stored"), F.col("met")).otherwise(F.col("own"))})
    keys = ["label", "size", "one", "d", "q"]

    def compare(stored: pa.Table, searching: pa.Table) -> pa.Table:
        return _compare(stored, searching, grids, threshold)

    left = dealt.where("stored").select(*keys, "rep", "copies", "two", "embedding")
    right = dealt.where("NOT stored").select(*keys, "rep", "copies", "flags", "embedding")
    right = right.toDF(*right.columns)  # columns of its own: both sides come from one table
    found = stage(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, _LINKS), "found")
    roots = connected(found.where("other IS NOT NULL").select(F.col("rep").alias("a"), F.col("other").alias("b")), stage, "forest")
    counts = found.groupBy("rep").agg(F.sum("n").alias("links"))
    known = classes.join(counts, "rep", "left").join(roots.withColumnRenamed("vertex", "rep"), "rep", "left")
    known = stage(
        known.select(
            F.col("label").alias("__label"),
            F.col("embedding").alias("__embedding"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("root", "rep").alias("component"),
        ),
        "known",
    )
    out = rows.join(known, (F.col("label") == F.col("__label")) & (F.col("embedding") == F.col("__embedding")) & F.col("vec_id").isNotNull(), "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        "label",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
