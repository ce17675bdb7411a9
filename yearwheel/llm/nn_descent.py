"""Approximate nearest neighbours by inner product: a neighbour graph by NN-descent, greedy search over it.

* Equal vectors are one node with its first ids. Vectors are written to files of fixed-size records; a node is the
  address of its record (block and place), so that a task which meets a node reads its vector by a byte range, through a
  bounded cache, and shuffles carry numbers only.
* The graph starts from random projections: several times, rows are sorted by the signs of random projections and
  cut into blocks of ``block_rows``; each row takes its nearest in the block.
* A round of NN-descent joins neighbours of neighbours: each node gathers its neighbours and a sample of the nodes
  that name it, and offers pairs of them, of which one is new to it, to each other. A node takes offers that beat its last
  neighbour. Rounds end when few lists change.
* A query starts at its own node. Greedy search keeps the ``beam`` best nodes seen, looks at the neighbours of the best
  that are not yet expanded, and ends when all in the beam are. Inner products of what is returned are in double
  precision on the original vectors.

The sample of those that name a node holds one for each of ``reverse`` hash buckets, so a node that a third of all rows name
costs no more than others. Rows are sorted by projection, then by a hash: a crowd with the same signs is cut into blocks too.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows without vec_id, take no
part; inner products exist between vectors of one length only; rows with the same vec_id are candidates each but never
of each other; equal (vec_id, vector) rows count once; ties go to the smaller vec_id; an empty table gives an empty result. A
length with at most ``block_rows`` distinct vectors is compared in full in the first step.
"""

from __future__ import annotations

import gc
from collections import OrderedDict
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yearwheel.llm import files
from yearwheel.operators.staging import Staging

PLACE_BITS = 20
# blocks a task may number; addresses stay below 2^52, which leaves room for the number of a query beside them
_BLOCKS_A_TASK = 1 << 12
_KEY_BITS = 52
_NEAR = pa.list_(pa.struct([("id", pa.int64()), ("score", pa.float32()), ("new", pa.bool_())]))
_NEAR_DDL = "array<struct<id:long,score:float,new:boolean>>"
_GRAPH_DDL = f"node long, near {_NEAR_DDL}, fresh long"
_QUERIES_A_TASK = 512


class Records:
    """Records of ``width`` numbers by address, from the files of their blocks, through a bounded cache."""

    def __init__(self, paths: dict[int, tuple[str, int]], dtype, width: int, cache_bytes: int = 96 << 20):
        self.paths, self.dtype, self.width = paths, np.dtype(dtype), width
        self.cache, self.room = OrderedDict(), cache_bytes

    def _block(self, block: int, places: np.ndarray) -> np.ndarray:
        if block in self.cache:
            self.cache.move_to_end(block)
            return self.cache[block][places]
        path, rows = self.paths[block]
        size = self.dtype.itemsize * self.width
        if 16 * len(places) < rows:
            wanted, back = np.unique(places, return_inverse=True)
            read = files.coalesced([(path, k * size, size) for k in wanted.tolist()], gap=4 * size)
            return np.frombuffer(b"".join(data for _, data in read), self.dtype).reshape(-1, self.width)[back]
        system, inside = files.at(path)
        with system.open_input_file(inside) as f:
            whole = np.frombuffer(f.read(), self.dtype).reshape(-1, self.width)
        self.cache[block] = whole
        self.room -= whole.nbytes
        while self.room < 0 and len(self.cache) > 1:
            self.room += self.cache.popitem(last=False)[1].nbytes
        return whole[places]

    def __call__(self, nodes: np.ndarray) -> np.ndarray:
        out = np.empty((len(nodes), self.width), self.dtype)
        blocks = nodes >> PLACE_BITS
        order = np.argsort(blocks, kind="stable")
        edges = np.flatnonzero(np.diff(blocks[order], prepend=-1, append=-1))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            at = order[a:b]
            out[at] = self._block(int(blocks[at[0]]), nodes[at] & ((1 << PLACE_BITS) - 1))
        return out


def _padded(column: pa.Array, width: int, dtype) -> np.ndarray:
    """Lists as rows of a matrix, with zeros behind shorter ones; zeros change no inner product."""
    sizes = column.value_lengths().to_numpy()
    out = np.zeros((len(column), width), dtype)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _codes(vectors: np.ndarray, turn: int, bits: int = 30) -> np.ndarray:
    """Signs of random projections as bits, the first the highest."""
    planes = np.random.default_rng(1000 + turn).standard_normal((vectors.shape[1], bits)).astype(np.float32)
    signs = vectors.astype(np.float32) @ planes > 0
    return signs @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))


def _with_code(batches, width: int, dtype):
    for batch in batches:
        code = _codes(_padded(batch.column(0), width, dtype), 0)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code)], names=[*batch.schema.names, "code"])


def _write(batches, folder: str, block_rows: int, width: int, dtype):
    """Vectors as records, in the order they come, and the address of each row."""
    first = TaskContext.get().partitionId() * _BLOCKS_A_TASK
    # a long partition makes longer files rather than more than can be numbered
    most = (1 << PLACE_BITS) - 1
    number, sink, count = first, None, 0
    for batch in batches:
        begin = 0
        while begin < batch.num_rows:
            if sink is None:
                sink, count = files.Sink(folder, ".vectors"), 0
            room = (block_rows if number - first < _BLOCKS_A_TASK - 1 else most) - count
            rows = batch.slice(begin, room)
            sink.write(_padded(rows.column(0), width, dtype).tobytes())
            nodes = (number << PLACE_BITS) + count + np.arange(rows.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array([sink.path] * rows.num_rows), *rows.columns[:3]], names=["node", "path", "embedding", "size", "ids"])
            begin, count = begin + rows.num_rows, count + rows.num_rows
            if rows.num_rows == room:
                sink.close()
                sink, number = None, number + 1
    if sink is not None:
        sink.close()


def _dealt(batches, turns: int, width: int, dtype, scale: float, large: frozenset):
    """Each row once a turn, with its code and its vector in half precision."""
    for batch in batches:
        vectors = _padded(batch.column(1), width, dtype)
        half = (vectors / scale).astype(np.float16)
        cells = pa.array([h.tobytes() for h in half], pa.binary())
        big = np.isin(batch.column(2).to_numpy(), list(large))
        for turn in range(turns):
            # rows of a small length have one key and stay together
            code = np.where(big, _codes(vectors, turn + 1), 0)
            salt = np.where(big, batch.column(0).to_numpy() * (2 * turn + 0x9E3779B9) % 0x7FFFFFED, 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(vectors), turn, np.int32)), batch.column(2), pa.array(code), pa.array(salt), batch.column(0), cells],
                names=["turn", "size", "code", "salt", "node", "half"],
            )


def _lists(who: np.ndarray, ids: np.ndarray, scores: np.ndarray, new: np.ndarray, rows: int) -> pa.Array:
    ends = np.searchsorted(who, np.arange(rows + 1)).astype(np.int32)
    cells = pa.StructArray.from_arrays([pa.array(ids), pa.array(scores.astype(np.float32)), pa.array(new)], fields=list(_NEAR.value_type))
    return pa.ListArray.from_arrays(pa.array(ends), cells, type=_NEAR)


def _nearest_in_blocks(batches, block_rows: int, width: int, most: int):
    """The nearest of each row among the rows of its block: runs of sorted rows."""

    def near(nodes: np.ndarray, halves: list) -> pa.RecordBatch:
        vectors = np.frombuffer(b"".join(halves), np.float16).reshape(-1, width).astype(np.float32)
        scores = vectors @ vectors.T
        np.fill_diagonal(scores, -np.inf)
        k = min(most, len(nodes) - 1)
        part = np.argpartition(-scores, k - 1, 1)[:, :k]
        who = np.repeat(np.arange(len(nodes)), k)
        found = _lists(who, nodes[part].ravel(), np.take_along_axis(scores, part, 1).ravel(), np.ones(len(who), bool), len(nodes))
        return pa.RecordBatch.from_arrays([pa.array(nodes), found], names=["node", "near"])

    key, nodes, halves = None, [], []
    for batch in batches:
        keys = batch.column(0).to_numpy().astype(np.int64) << 32 | batch.column(1).to_numpy()
        for k, node, half in zip(keys.tolist(), batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True):
            if nodes and (k != key or len(nodes) >= block_rows):
                if len(nodes) > 1:
                    yield near(np.array(nodes), halves)
                nodes, halves = [], []
            key = k
            nodes.append(node)
            halves.append(half)
    if len(nodes) > 1:
        yield near(np.array(nodes), halves)


def _merged(batches, k: int):
    """The k best of each node's neighbours and offers; an offer that is taken is new."""
    for batch in batches:
        parts = []
        for kind, column in enumerate(batch.columns[1:]):
            sizes = column.value_lengths().fill_null(0).to_numpy()
            flat = column.flatten()
            who = np.repeat(np.arange(batch.num_rows), sizes)
            parts.append((who, flat.field("id").to_numpy(), flat.field("score").to_numpy(), np.full(len(who), kind)))
        who, ids, scores, kind = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.lexsort((kind, ids, who))
        who, ids, scores, kind = who[order], ids[order], scores[order], kind[order]
        once = np.ones(len(who), bool)
        once[1:] = (who[1:] != who[:-1]) | (ids[1:] != ids[:-1])
        who, ids, scores, kind = who[once], ids[once], scores[once], kind[once]
        order = np.lexsort((ids, -scores, who))
        starts = np.searchsorted(who, np.arange(batch.num_rows))
        kept = order[np.arange(len(order)) - starts[who] < k]
        fresh = np.bincount(who[kept], weights=kind[kept] > 0, minlength=batch.num_rows).astype(np.int64)
        near = _lists(who[kept], ids[kept], scores[kept], kind[kept] > 0, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), near, pa.array(fresh)], names=["node", "near", "fresh"])


def _offers(batches, records: Records, scale: float, most: int):
    """Pairs that one node's neighbours offer each other: node, offered, score."""
    for batch in batches:
        for begin in range(0, batch.num_rows, 512):
            column = batch.column(1).slice(begin, 512)
            sizes = column.value_lengths().to_numpy()
            wide = int(sizes.max())
            filled = np.arange(wide) < sizes[:, None]
            flat = column.flatten()
            ids = np.full(filled.shape, -1, np.int64)
            ids[filled] = flat.field("id").to_numpy()
            new = np.zeros(filled.shape, bool)
            new[filled] = flat.field("new").to_numpy(zero_copy_only=False)
            last = np.full(filled.shape, np.inf, np.float32)
            last[filled] = flat.field("last").to_numpy()
            nodes, place = np.unique(ids[filled], return_inverse=True)
            # as in the first step, scores are of vectors in half precision
            vectors = (records(nodes) / scale).astype(np.float16).astype(np.float32)
            gathered = np.zeros((*filled.shape, records.width), np.float32)
            gathered[filled] = vectors[place]
            scores = gathered @ gathered.transpose(0, 2, 1)
            fits = (new[:, :, None] | new[:, None, :]) & filled[:, None, :] & (ids[:, :, None] != ids[:, None, :]) & (scores > last[:, :, None])
            scores[~fits] = -np.inf
            k = min(most, wide)
            part = np.argpartition(-scores, k - 1, 2)[:, :, :k]
            best = np.take_along_axis(scores, part, 2)
            i, j, p = np.nonzero(best > -np.inf)
            yield pa.RecordBatch.from_arrays([pa.array(ids[i, j]), pa.array(ids[i, part[i, j, p]]), pa.array(best[i, j, p])], names=["node", "id", "score"])


def _write_lists(batches, folder: str, width: int):
    """Neighbours as records, -1 behind the last: rows come sorted by address, block by block."""
    sink = block = None
    count = 0
    for batch in batches:
        nodes = batch.column(0).to_numpy()
        blocks = nodes >> PLACE_BITS
        lists = batch.column(1)
        sizes = np.minimum(lists.value_lengths().fill_null(0).to_numpy(), width)
        out = np.full((len(nodes), width), -1, np.int64)
        out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
        edges = np.flatnonzero(np.diff(blocks, prepend=-1, append=-1))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if blocks[a] != block:
                if sink is not None:
                    sink.close()
                    yield _named(block, sink.path, count)
                sink, block, count = files.Sink(folder, ".lists"), blocks[a], 0
            sink.write(out[a:b].tobytes())
            count += b - a
    if sink is not None:
        sink.close()
        yield _named(block, sink.path, count)


def _named(block: int, path: str, rows: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"block": [int(block)], "path": [path], "rows": [int(rows)]})


def _search(batches, records: Records, lists: Records, beam: int, step: int, wanted: int):
    """Greedy search for each query node: node, found, score, at least ``wanted`` and all that tie with the last."""
    mask = (1 << _KEY_BITS) - 1
    for batch in batches:
        for begin in range(0, batch.num_rows, 128):
            queries = batch.column(0).to_numpy()[begin : begin + 128]
            vectors = records(queries)
            n = len(queries)
            # everything seen, by query and address, and the beam as rows of (query, score, node, expanded)
            seen = (np.arange(n) << _KEY_BITS) | queries
            who, node, done = np.arange(n), queries.copy(), np.zeros(n, bool)
            score = np.einsum("ij,ij->i", vectors, vectors)
            while True:
                open_ = np.flatnonzero(~done)
                if not len(open_):
                    break
                # rows are sorted by query and score: the first few open ones of each
                turn = np.arange(len(open_)) - np.searchsorted(who[open_], np.arange(n))[who[open_]]
                chosen = open_[turn < step]
                done[chosen] = True
                near = lists(node[chosen])
                keys = np.unique(((who[chosen] << _KEY_BITS)[:, None] | near)[near >= 0])
                keys = keys[seen[np.minimum(np.searchsorted(seen, keys), len(seen) - 1)] != keys]
                if not len(keys):
                    continue
                # two sorted runs, which a stable sort only merges
                seen = np.sort(np.concatenate([seen, keys]), kind="stable")
                new_who, new_node = keys >> _KEY_BITS, keys & mask
                new_score = np.einsum("ij,ij->i", records(new_node), vectors[new_who])
                # what cannot enter a full beam is not carried along
                starts = np.searchsorted(who, np.arange(n + 1))
                filled = starts[1:] - starts[:-1] > beam
                least = np.where(filled, score[starts[1:] - 1], -np.inf)
                enters = new_score >= least[new_who]
                new_who, new_node, new_score = new_who[enters], new_node[enters], new_score[enters]
                who, node, score = np.concatenate([who, new_who]), np.concatenate([node, new_node]), np.concatenate([score, new_score])
                done = np.concatenate([done, np.zeros(len(new_who), bool)])
                order = np.lexsort((node, -score, who))
                starts = np.searchsorted(who[order], np.arange(n))
                # the query's own node takes one place more
                order = order[np.arange(len(order)) - starts[who[order]] <= beam]
                who, node, score, done = who[order], node[order], score[order], done[order]
            score = np.einsum("ij,ij->i", records(node).astype(np.float64), vectors.astype(np.float64)[who])
            order = np.lexsort((node, -score, who))
            who, node, score = who[order], node[order], score[order]
            starts = np.searchsorted(who, np.arange(n + 1))
            last = score[np.minimum(starts[:-1] + wanted - 1, starts[1:] - 1)]
            keep = score >= last[who]
            yield pa.RecordBatch.from_arrays([pa.array(queries[who[keep]]), pa.array(node[keep]), pa.array(score[keep])], names=["query", "node", "score"])


def _reverse(edges: DataFrame, buckets: int, turn: int) -> DataFrame:
    """Of those that name a node, one for each hash bucket: v, id, new. Maps combine before anything is shuffled."""
    mix = F.xxhash64("node", F.lit(turn))
    bucket = F.pmod(mix, F.lit(buckets)).alias("bucket")
    return edges.groupBy(F.col("id").alias("v"), bucket).agg(F.min_by(F.struct("node", "new"), mix).alias("o")).select("v", F.col("o.node").alias("id"), F.col("o.new").alias("new"))


def _first_graph(placed: DataFrame, stage: Staging, turns: int, degree: int, block_rows: int, scale: float, large: list[int], setting: dict) -> DataFrame:
    dealt = placed.select("node", "embedding", "size").mapInArrow(
        partial(_dealt, turns=turns, scale=scale, large=frozenset(large), **setting), "turn int, size int, code long, salt long, node long, half binary"
    )
    keys = ["turn", "size", "code", "salt"]
    runs = dealt.repartitionByRange(*keys).sortWithinPartitions(*keys)
    most = min(degree, 16) if large else degree
    lists = runs.mapInArrow(partial(_nearest_in_blocks, block_rows=block_rows, width=setting["width"], most=most), f"node long, near {_NEAR_DDL}")
    gathered = lists.groupBy("node").agg(F.flatten(F.collect_list("near")).alias("offered"))
    none = F.array().cast(_NEAR_DDL).alias("near")
    return stage(gathered.select("node", none, "offered").mapInArrow(partial(_merged, k=degree), _GRAPH_DDL), "graph-0")


def _round(graph: DataFrame, stage: Staging, records: Records, turn: int, degree: int, reverse: int, offers: int, scale: float) -> DataFrame:
    """Neighbours of neighbours meet once; the graph after it."""
    edges = graph.select("node", F.inline("near"))
    named = edges.select(F.col("node").alias("v"), "id", "new").unionByName(_reverse(edges, reverse, turn))
    itself = graph.select(F.col("node").alias("v"), F.col("node").alias("id"), F.lit(False).alias("new"))
    # a node whose list has room takes any offer
    full = F.when(F.size("near") >= degree, F.array_min("near.score")).otherwise(F.lit(float("-inf")))
    last = graph.select(F.col("node").alias("id"), full.cast("float").alias("last"))
    members = named.unionByName(itself).join(last, "id").groupBy("v").agg(F.collect_list(F.struct("id", "new", "last")).alias("met"))
    moving = members.where(F.exists("met", lambda m: m["new"]))
    offered = moving.mapInArrow(partial(_offers, records=records, scale=scale, most=offers), "node long, id long, score float")
    offered = offered.groupBy("node").agg(F.collect_list(F.struct("id", "score", F.lit(True).alias("new"))).alias("offered"))
    none = F.array().cast(_NEAR_DDL)
    both = graph.drop("fresh").join(offered, "node", "left").select("node", "near", F.coalesce("offered", none).alias("offered"))
    return stage(both.mapInArrow(partial(_merged, k=degree), _GRAPH_DDL), f"graph-{turn}")


def _cleaned(spark) -> None:
    """Let Spark drop the shuffle files of steps that are over: it does so for plans that neither Python nor the JVM holds."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def nearest(
    rows: DataFrame,
    is_query: Column,
    stage: Staging,
    k: int = 20,
    degree: int = 32,
    reverse: int = 16,
    turns: int = 8,
    block_rows: int = 1024,
    file_rows: int = 16_384,
    offers: int = 4,
    rounds: int = 8,
    still: float = 0.03,
    beam: int = 200,
    step: int = 16,
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found of each row of ``rows`` (vec_id, embedding) that is a query.

    ``degree`` neighbours a node; at most ``rounds`` rounds, until less than the share ``still`` of all neighbours
    is new. ``beam`` trades time for recall.
    """
    spark = rows.sparkSession
    double = "double" in rows.schema["embedding"].dataType.simpleString()
    kind, dtype = ("double", np.float64) if double else ("float", np.float32)
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.col("vec_id").isNotNull() & fine & F.exists("embedding", lambda x: x != 0)
    own = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"), is_query.alias("is_query")).where(usable)
    own = own.distinct()
    # a query needs no more than k others of one vector; Spark keeps that many a map task
    order = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    firsts = own.withColumn("n", order).where(F.col("n") <= k + 1).groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    classes = stage(firsts.select("embedding", F.size("embedding").alias("size"), "ids"), "classes")
    sizes = classes.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.max(F.array_max(F.transform("embedding", F.abs))).alias("top"))
    facts = sizes.agg(F.max("size"), F.max("top"), F.sum("n"), F.collect_list(F.when(F.col("n") > block_rows, F.col("size")))).first()
    width, scale, total, large = facts
    schema = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], schema)
    setting = {"width": width, "dtype": dtype}

    coded = classes.mapInArrow(partial(_with_code, **setting), f"embedding array<{kind}>, size int, ids array<long>, code long")
    keys = ["size", "code", "embedding"]
    sorted_ = coded.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = sorted_.mapInArrow(partial(_write, folder=f"{stage.folder}/vectors", block_rows=file_rows, **setting), f"node long, path string, embedding array<{kind}>, size int, ids array<long>")
    placed = stage(placed, "placed")
    block = F.shiftright("node", PLACE_BITS)
    paths = {r["block"]: (r["path"], r["n"]) for r in placed.groupBy(block.alias("block"), "path").agg(F.count(F.lit(1)).alias("n")).collect()}
    records = Records(paths, dtype, width)

    graph = _first_graph(placed, stage, turns, degree, block_rows, scale, large, setting)
    _cleaned(spark)
    for turn in range(1, rounds + 1 if large else 1):
        graph = _round(graph, stage, records, turn, degree, reverse, offers, scale)
        fresh, nodes = graph.agg(F.sum("fresh"), F.count(F.lit(1))).first()
        _cleaned(spark)
        if fresh < still * degree * nodes:
            break

    edges = graph.select("node", F.inline("near"))
    near = edges.select("node", "id").unionByName(_reverse(edges, reverse, 0).select(F.col("v").alias("node"), "id"))
    near = placed.select("node").join(near.groupBy("node").agg(F.collect_set("id").alias("near")), "node", "left")
    by_block = near.repartition(block).sortWithinPartitions("node")
    named = by_block.mapInArrow(partial(_write_lists, folder=f"{stage.folder}/lists", width=degree + reverse), "block long, path string, rows long")
    neighbours = Records({r["block"]: (r["path"], r["rows"]) for r in stage(named, "lists-index").collect()}, np.int64, degree + reverse)

    queries = own.where("is_query").select(F.col("vec_id").alias("query_id"), "embedding").join(placed.select("node", "embedding"), "embedding")
    queries = stage(queries.select("query_id", F.col("node").alias("query")), "queries")
    starts = queries.select("query").distinct()
    # a task's time grows with its queries, not with their bytes
    starts = starts.repartition(max(1, -(-queries.count() // _QUERIES_A_TASK)), "query")
    wanted = starts.mapInArrow(
        partial(_search, records=records, lists=neighbours, beam=max(beam, k + 1), step=step, wanted=k + 1), "query long, node long, score double"
    )
    found = stage(wanted, "found").join(placed.select("node", F.explode("ids").alias("vec_id")), "node")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).drop("n", "node")
    others = queries.join(found, "query").where("vec_id <> query_id")
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return others.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
