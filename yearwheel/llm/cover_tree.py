"""Hard negatives by best-first search of cover trees.

For an anchor and one of its positives (the nearest rows of its own label), the hard negatives are the nearest
rows of other labels whose score lies in a window below the positive's score. A score is an inner product. Points get
one more component, sqrt(M^2 - |x|^2), so all have the length M; then the squared distance of an anchor (with 0
there) to a point is |q|^2 + M^2 - 2 q.x, and a ball of radius r around a centre bounds the scores of all it covers
from both sides.

Rows are dealt to the nearest of some top centres and, where a centre has many, cut into blocks; each block gets a tree,
built from the top: the children of a node are picked farthest first until they cover it within half its radius, and the
covering radius of each is measured. Anchors meet trees in blocks of both. A descent goes level by level, leaving out nodes
whose bounds miss all of an anchor's windows or hold one label that does not count; the leaves that remain are
taken in the order of their upper bounds and verified exactly, until none can reach the last place. A block hands on
the few rows an anchor needs from it.

The top centres come from a bounded sample (``train_rows``); they decide how rows are dealt, never what is found.

Defined cases: rows without vec_id, label or vector, or with a null or non-finite component, take no part; vectors of
different lengths have no score together; equal rows count once; different rows of one vec_id are rows of their own, and
never positives of each other; ties go to the smaller vec_id; an empty table, one without anchors and one
with a single label give empty results. Scores are exact while they stay below 2^53; components are whole numbers.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yearwheel.operators.staging import Staging

FAN = 16
LEAF = 256
MAX_TOPS = 256
_TREE = (
    "size int, top int, block int, ids array<long>, labels array<string>, points binary, bound double, "
    "centre array<int>, radius array<double>, begin array<int>, end array<int>, child array<int>, last array<int>, level array<int>"
)


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of lists of one length as doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), size)


def augmented(points: np.ndarray, bound: float) -> np.ndarray:
    """Points with the component that gives all of them the squared length ``bound``."""
    rest = np.sqrt(np.maximum(bound - (points**2).sum(1), 0))
    return np.concatenate([points, rest[:, None]], 1)


def _distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - centre) ** 2).sum(1))


def farthest_first(points: np.ndarray, most: int, enough: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centres, the first point first, until all points are within ``enough``: centres, nearest centre, distance."""
    centres, near = [0], np.zeros(len(points), np.int64)
    apart = _distances(points, points[0])
    while len(centres) < most:
        far = int(apart.argmax())
        if apart[far] <= enough:
            break
        d = _distances(points, points[far])
        closer = d < apart
        near[closer], apart[closer] = len(centres), d[closer]
        centres.append(far)
    return np.array(centres), near, apart


class CoverTree:
    """Nodes in order of levels; the points of a node, and its children, are runs."""

    def __init__(self, points: np.ndarray, fan: int = FAN, leaf: int = LEAF):
        self.bound = float((points**2).sum(1).max())
        wide = augmented(points, self.bound)
        order = np.arange(len(points))
        self.centre, self.radius, self.begin, self.end = [0], [float(_distances(wide, wide[0]).max())], [0], [len(points)]
        self.child, self.last, self.level = [], [], []
        depth, k, until = 0, 0, 1
        while k < len(self.centre):
            if k == until:
                depth, until = depth + 1, len(self.centre)
            begin, end = self.begin[k], self.end[k]
            own = order[begin:end].copy()
            self.level.append(depth)
            self.child.append(len(self.centre))
            if end - begin > leaf and self.radius[k] > 0:
                # the node's centre is the first of its points, and the first child's centre
                centres, near, apart = farthest_first(wide[own], fan, self.radius[k] / 2)
                if len(centres) > 1:
                    near[centres] = np.arange(len(centres))
                    # each child's centre goes first
                    first = np.ones(len(own), bool)
                    first[centres] = False
                    sort = np.lexsort((first, near))
                    order[begin:end] = own[sort]
                    sizes = np.bincount(near, minlength=len(centres))
                    ends = begin + np.cumsum(sizes)
                    apart[centres] = 0
                    self.centre += own[centres].tolist()
                    radius = np.zeros(len(centres))
                    np.maximum.at(radius, near, apart)
                    self.radius += radius.tolist()
                    self.begin += (ends - sizes).tolist()
                    self.end += ends.tolist()
            self.last.append(len(self.centre))
            k += 1
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.order = order
        self.centre = place[np.array(self.centre)].tolist()


def _plant(group: pa.Table) -> pa.Table:
    """The tree of one block as one row."""
    size = group["size"][0].as_py()
    points = matrix(group["vec"].combine_chunks(), size)
    # the order of rows within a group is not fixed; the tree should be
    ids = group["vec_id"].to_numpy()
    fixed = np.lexsort((*points.T[::-1], ids))
    tree = CoverTree(points[fixed])
    order = fixed[tree.order]
    first = {n: [group[n][0].as_py()] for n in ("size", "top", "block")}
    row = first | {
        "ids": [ids[order]],
        "labels": [group["label"].combine_chunks().take(pa.array(order)).to_pylist()],
        "points": [points[order].tobytes()],
        "bound": [tree.bound],
    }
    row |= {n: [getattr(tree, n)] for n in ("centre", "radius", "begin", "end", "child", "last", "level")}
    return pa.Table.from_pydict(row, _schema(_TREE))


_ARROW = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary()}


def _schema(ddl: str) -> pa.Schema:
    fields = [f.split(" ", 1) for f in ddl.split(", ")]
    return pa.schema([(n, pa.list_(_ARROW[t[6:-1]]) if t.startswith("array<") else _ARROW[t]) for n, t in fields])


class Search:
    """Best-first search of one tree for many anchors, each with windows of scores.

    ``best`` holds, by anchor and window, the scores and ids of the first ``k`` rows found; a place not taken
    has the score -inf.
    """

    def __init__(self, tree: dict, anchors: np.ndarray, labels: np.ndarray, ids: np.ndarray, same: bool, low: np.ndarray, high: np.ndarray, k: int):
        self.k, self.same, self.low, self.high = k, same, low, high
        self.anchors, self.ids = anchors, ids
        size = anchors.shape[1]
        self.row_ids = np.array(tree["ids"], np.int64)
        self.points = np.frombuffer(tree["points"], np.float64).reshape(len(self.row_ids), size)
        codes: dict[str, int] = {}
        self.row_labels = np.array([codes.setdefault(c, len(codes)) for c in tree["labels"]])
        self.labels = np.array([codes.get(c, -1) for c in labels])
        self.tree = {n: np.array(tree[n]) for n in ("centre", "radius", "begin", "end", "child", "last", "level")}
        self.bound = tree["bound"]
        shape = (*low.shape, k)
        self.scores, self.found = np.full(shape, -np.inf), np.full(shape, np.iinfo(np.int64).max)
        self.verified = 0

    def _bounds(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest score of any anchor with what each node covers."""
        score = self.anchors @ self.points[self.tree["centre"][nodes]].T
        length = (self.anchors**2).sum(1)[:, None] + self.bound
        squared = np.maximum(length - 2 * score, 0)
        apart, r = np.sqrt(squared), self.tree["radius"][nodes]
        # room for rounding: of a squared distance next to 0 most, so distances get its root
        slack = 1e-6 * (1 + np.sqrt(length))
        near, far = np.maximum(apart - r - slack, 0), apart + r + slack
        return (length - far**2) / 2 - 1e-6, (length - near**2) / 2 + 1e-6

    def _wanted(self, low: np.ndarray, high: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Whether scores between low and high may take a place in a window of the anchors."""
        least = np.maximum(self.low[rows], self.scores[rows][:, :, -1])
        reach = (high[:, None] >= least) & (low[:, None] <= self.high[rows])
        return reach.any(1)

    def _eligible(self, nodes: np.ndarray) -> np.ndarray:
        """Whether a node has rows of labels that count, by anchor."""
        tree, out = self.tree, np.ones((len(self.anchors), len(nodes)), bool)
        change = np.concatenate([[0], np.cumsum(self.row_labels[1:] != self.row_labels[:-1])])
        begin, end = tree["begin"][nodes], tree["end"][nodes]
        pure = change[begin] == change[end - 1]
        own = self.row_labels[begin][None, :] == self.labels[:, None]
        out[:, pure] = (own if self.same else ~own)[:, pure]
        return out

    def run(self) -> None:
        tree = self.tree
        live = np.ones((len(self.anchors), 1), bool)
        nodes = np.zeros(1, np.int64)
        leaves, alive, tops, lows = [], [], [], []
        while len(nodes):
            low, high = self._bounds(nodes)
            least, most = self.low.min(1), self.high.max(1)
            live = live & (high >= least[:, None]) & (low <= most[:, None]) & self._eligible(nodes)
            leaf = tree["child"][nodes] == tree["last"][nodes]
            leaves.append(nodes[leaf])
            alive.append(live[:, leaf])
            tops.append(high[:, leaf])
            lows.append(low[:, leaf])
            inner = np.flatnonzero(~leaf & live.any(0))
            counts = (tree["last"] - tree["child"])[nodes[inner]]
            parent = np.repeat(inner, counts)
            ends = np.cumsum(counts)
            nodes = np.repeat(tree["child"][nodes[inner]] - (ends - counts), counts) + np.arange(int(counts.sum()))
            live = live[:, parent]
        leaves, alive = np.concatenate(leaves), np.concatenate(alive, 1)
        tops, lows = np.concatenate(tops, 1), np.concatenate(lows, 1)
        order = np.argsort(np.where(alive, -tops, np.inf), 1, kind="stable")
        begin, take = 0, 1
        while begin < len(leaves):
            # the next leaves of each anchor, twice as many each time
            part = order[:, begin : begin + take]
            begin, take = begin + take, 2 * take
            rows = np.repeat(np.arange(len(part)), part.shape[1])
            cols = part.ravel()
            sort = np.argsort(cols, kind="stable")
            rows, cols = rows[sort], cols[sort]
            edges = np.flatnonzero(np.diff(cols, prepend=-1, append=-1))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                c, r = cols[a], rows[a:b]
                r = r[alive[r, c]]
                r = r[self._wanted(lows[r, c], tops[r, c], r)]
                if len(r):
                    self._verify(r, leaves[c])

    def _verify(self, rows: np.ndarray, leaf: int) -> None:
        begin, end = self.tree["begin"][leaf], self.tree["end"][leaf]
        # a leaf of equal points may be long
        for start in range(begin, end, 1024):
            part = slice(start, min(end, start + 1024))
            scores = self.anchors[rows] @ self.points[part].T
            self.verified += scores.size
            counts = (self.row_labels[part][None, :] == self.labels[rows][:, None]) == self.same
            if self.same:
                counts &= self.row_ids[part][None, :] != self.ids[rows][:, None]
            scores = np.where(counts, scores, -np.inf)
            for w in range(self.low.shape[1]):
                least = np.maximum(self.low[rows, w], self.scores[rows, w, -1])
                fits = (scores >= least[:, None]) & (scores <= self.high[rows, w][:, None]) & counts
                i, j = np.nonzero(fits)
                if len(i):
                    self._merge(rows[i], w, scores[i, j], self.row_ids[part][j])

    def _merge(self, rows: np.ndarray, w: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """Put rows found into the places of one window."""
        at, place = np.unique(rows, return_inverse=True)
        # the places taken so far, and what was found, by anchor, score and id
        who = np.concatenate([np.repeat(np.arange(len(at)), self.k), place])
        s = np.concatenate([self.scores[at, w].ravel(), scores])
        i = np.concatenate([self.found[at, w].ravel(), ids])
        order = np.lexsort((i, -s, who))
        starts = np.searchsorted(who[order], np.arange(len(at)))
        first = order[starts[:, None] + np.arange(self.k)]
        self.scores[at, w], self.found[at, w] = s[first], i[first]


_FOUND = "row long, anchor_id long, window int, vec_id long, score long"


def _meet(trees: pa.Table, anchors: pa.Table, same: bool, k: int) -> pa.Table:
    """What one block of anchors needs from one tree."""
    schema = _schema(_FOUND)
    if not trees.num_rows or not anchors.num_rows:
        return schema.empty_table()
    tree = {n: trees[n][0].as_py() for n in trees.column_names}
    vectors = matrix(anchors["vec"].combine_chunks(), tree["size"])
    low, high = anchors["low"].to_pylist(), anchors["high"].to_pylist()
    windows = max(map(len, low))
    # a window that is missing takes nothing
    fill = lambda lists, value: np.array([x + [value] * (windows - len(x)) for x in lists], np.float64).reshape(len(lists), windows)
    search = Search(
        tree, vectors, np.array(anchors["label"].to_pylist(), object), anchors["vec_id"].to_numpy(), same, fill(low, np.inf), fill(high, -np.inf), k
    )
    search.run()
    a, w, place = np.nonzero(np.isfinite(search.scores))
    columns = [
        pa.array(anchors["row"].to_numpy()[a]),
        pa.array(anchors["vec_id"].to_numpy()[a]),
        pa.array(w.astype(np.int32)),
        pa.array(search.found[a, w, place]),
        pa.array(search.scores[a, w, place].astype(np.int64)),
    ]
    return pa.Table.from_arrays(columns, schema=schema)


def usable(rows: DataFrame, vector: str) -> Column:
    """Whether a row has an id, a label and a vector without faults."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= 1.7976931348623157e308))
    return F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull() & F.coalesce(fine, F.lit(False))


def _place(batches, tops: dict[int, np.ndarray], bounds: dict[int, float]):
    """Nearest top centre of each row."""
    for batch in batches:
        sizes = batch.column(3).to_numpy()
        top = np.zeros(batch.num_rows, np.int32)
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            centres = tops.get(size)
            if centres is not None and len(centres) > 1:
                wide = augmented(matrix(batch.column(2).take(pa.array(at)), size), bounds[size])
                for begin in range(0, len(at), 4096):
                    part = wide[begin : begin + 4096]
                    top[at[begin : begin + 4096]] = ((centres**2).sum(1) - 2 * part @ centres.T).argmin(1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(top)], names=[*batch.schema.names, "top"])


def plant(rows: DataFrame, stage: Staging, block_rows: int, train_rows: int) -> DataFrame:
    """Trees over ``rows`` (vec_id, label, vec, size), one row per block."""
    sizes = rows.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)).alias("bound"))
    # top centres for the lengths that have more rows than a block; of those there are few
    large = sizes.where(F.col("n") > block_rows).orderBy(F.desc("n"), "size").limit(16).collect()
    tops, bounds = {}, {}
    for r in large:
        sample = rows.where(F.col("size") == r["size"]).orderBy(F.xxhash64("vec_id"), "vec_id").select("vec").limit(train_rows).collect()
        bounds[r["size"]] = r["bound"]
        wide = augmented(np.array([x[0] for x in sample], np.float64), r["bound"])
        centres, _, _ = farthest_first(wide, int(min(MAX_TOPS, -(-r["n"] // block_rows))), 0.0)
        tops[r["size"]] = wide[centres]
    placed = stage(rows.mapInArrow(partial(_place, tops=tops, bounds=bounds), "vec_id long, label string, vec array<double>, size int, top int"), "placed")
    blocks = placed.groupBy("size", "top").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    dealt = placed.join(blocks, ["size", "top"]).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    return stage(dealt.drop("blocks").groupBy("size", "top", "block").applyInArrow(_plant, _TREE), "trees")


def _searched(anchors: DataFrame, trees: DataFrame, block_anchors: int, same: bool, k: int) -> DataFrame:
    """What all trees of an anchor's length find: row, anchor_id, window, vec_id, score; k a tree and window."""
    counts = anchors.groupBy("size").agg(F.ceil(F.count(F.lit(1)) / block_anchors).cast("int").alias("blocks"))
    own = anchors.join(counts, "size").withColumn("a", F.pmod(F.col("row"), F.col("blocks")).cast("int")).drop("blocks")
    # each block of anchors meets each tree of its length: a few rows, of which both sides are dealt
    pairs = trees.select("size", "top", "block").join(counts, "size").withColumn("a", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    keys = ["size", "top", "block", "a"]
    left = trees.join(pairs, keys[:3])
    right = own.join(pairs, ["size", "a"]).select(*keys, "row", "vec_id", "label", "vec", "low", "high")
    # columns of their own: both sides come from one table
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(lambda t, q: _meet(t, q, same, k), _FOUND)


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k nearest rows of each key, numbered from 1; Spark keeps k a key before it shuffles."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine_negatives(
    rows: DataFrame,
    is_anchor: Column,
    stage: Staging,
    positives: int = 5,
    negatives: int = 3,
    least_percent: int = 50,
    most_percent: int = 95,
    block_rows: int = 4096,
    block_anchors: int = 1024,
    train_rows: int = 4096,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``rows`` has vec_id, label and vec, an array of whole numbers. Of each anchor's first ``positives`` rows
    of its label, each gets the first ``negatives`` rows of other labels with a score of ``least_percent`` to
    ``most_percent`` of the positive's.
    """
    # one column of one row's own name each; whatever else the table holds cannot clash
    own = rows.where(usable(rows, "vec")).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("vec").cast("array<double>").alias("vec"),
        F.size("vec").alias("size"), is_anchor.alias("is_anchor"),
    )
    own = stage(own.distinct(), "rows")
    trees = plant(own.drop("is_anchor"), stage, block_rows, train_rows)
    anchors = own.where("is_anchor").withColumn("row", F.xxhash64("vec_id", "label", "vec")).drop("is_anchor")
    everything = {"low": F.array(F.lit(float("-inf"))), "high": F.array(F.lit(float("inf")))}
    near = _first(_searched(anchors.withColumns(everything), trees, block_anchors, True, positives), ["row", "anchor_id"], positives)
    near = stage(near.select("row", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # whole numbers n with least * p <= 100 * n <= most * p
    p = F.col("positive_score")
    low = -F.floor(-p * least_percent / 100.0)
    high = F.floor(p * most_percent / 100.0)
    lists = near.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", low.cast("double").alias("low"), high.cast("double").alias("high")))).alias("w"))
    ranged = anchors.join(lists, "row").withColumns({"low": F.col("w.low"), "high": F.col("w.high")}).drop("w")
    met = _first(_searched(ranged, trees, block_anchors, False, negatives), ["row", "anchor_id", "window"], negatives)
    found = met.withColumn("place", F.col("window") + 1).join(near, ["row", "place"])
    return found.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
