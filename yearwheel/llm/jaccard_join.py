"""Documents linked by the Jaccard similarity of their word n-grams, with prefix filters of several orders.

The set of a document is its distinct ``shingle``-word runs. For any order of all shingles, linked sets
share one among their first n - ceil(n * percent / 100) + 1 shingles. Three orders are used:

* by hash: of the first m shingles a linked document shares all but n - ceil(n * percent / 100) with its
  partner. A document that shares fewer with others, over a prefix longer by a quarter, has no link and
  leaves. This needs no counts of shingles but of those in prefixes;
* two orders that put the documents' rare shingles first: shingles whose hash falls in a zone of its own
  come first, by the number of remaining documents that hold them, then by hash; the others follow by hash.
  Passages that many documents share stand last in the zone, and so outside most prefixes.

Candidates have sizes that may be linked and share a shingle of the first rare-first prefix and one of the
second; only those are verified, on whole texts. Documents with equal sets are one class. Inside a list of classes that share a shingle, all
are first compared with the smallest only, then with the largest of another component. Documents of lists that still hold
several components are open: all their shingles are counted again, among open documents only, and ordered rarest first, so
that a passage which makes up most of many documents stands behind what is their own. The open documents that share a
shingle of these prefixes, and are not yet in one component, are compared, if what both hold from their first common
shingle on is enough for a link: documents with many shingles of their own have too few left. The components are as if all
pairs had been compared.

Defined cases: a null text or one without words has an empty set and links with nothing; a shorter text than
the shingle is one shingle; a row without doc_id has no component; rows with the same doc_id are one document, linked by any of its texts (a
class of equal sets is a vertex, and the classes of one doc_id are linked). Very long texts are cut into words whole,
other columns are not read, an empty table gives an empty one.
"""

from __future__ import annotations

from functools import partial
from hashlib import md5
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearwheel.llm.components import connected
from yearwheel.llm.distinct import runs, slices
from yearwheel.llm.words import Words, mixed, prefix_sums, range_hashes
from yearwheel.operators.staging import Staging

# one constant per order; the first is the order by hash alone
ORDERS = [np.uint64(c) for c in (0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F)]
ZONE = 0.3
LEADER_ROUNDS = 2


def shingle_sets(texts: list[str | None], shingle: int) -> list[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text."""
    words = Words([(t or "").encode() for t in texts], lower=True)
    hashes = words.hashes()
    starts, keys = words.windows(shingle, hashes)
    at = np.searchsorted(starts, words.first)
    sums, out = None, []
    for k, n in enumerate(words.n.tolist()):
        if n >= shingle or not n:
            out.append(np.unique(keys[at[k] : at[k + 1]]))
        else:
            sums = prefix_sums(hashes) if sums is None else sums
            out.append(range_hashes(sums, words.first[k : k + 1], words.first[k + 1 : k + 2]))
    return out


def prefix_length(n: int, percent: int) -> int:
    return n - -(-n * percent // 100) + 1


def longer_prefix(n: int, percent: int) -> int:
    """Shingles looked at in the order by hash."""
    p = prefix_length(n, percent)
    return min(n, p + p // 4)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int64)))


def _first_prefix(batches, shingle: int, percent: int, text_chars: int):
    """Set size, digest of the set and prefix in the order by hash."""
    for batch in batches:
        ids, texts, marks = batch.column(0), batch.column(1).to_pylist(), batch.column(2)
        for part in slices(texts, text_chars):
            sets = shingle_sets(texts[part], shingle)
            prefixes = [_signed(np.sort(mixed(s ^ ORDERS[0]))[: longer_prefix(len(s), percent)]) if len(s) else s.astype(np.int64) for s in sets]
            keys = [md5(s.tobytes()).digest() if len(s) else None for s in sets]
            columns = [c[part.start : part.stop] for c in (ids, marks)] + [pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), _lists(prefixes)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "n", "key", "prefix"])


def _zone_rows(batches, shingle: int, percent: int, text_chars: int):
    """Shingles that may stand in the prefixes of the rare-first orders."""
    limit = np.uint64(int(ZONE * 2.0**64))
    for batch in batches:
        ids, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
        for part in slices(texts, text_chars):
            columns: list[list[np.ndarray]] = [[], [], [], []]
            for doc, s in zip(ids[part], shingle_sets(texts[part], shingle), strict=True):
                if not len(s):
                    continue
                for number, constant in enumerate(ORDERS[1:]):
                    tokens = np.sort(mixed(s ^ constant))
                    zone = int(np.searchsorted(tokens, limit))
                    tokens = tokens[: max(zone, prefix_length(len(s), percent))]
                    late = np.zeros(len(tokens), bool)
                    late[zone:] = True
                    for column, values in zip(columns, (np.full(len(tokens), doc), np.full(len(tokens), number, np.int32), _signed(tokens), late), strict=True):
                        column.append(values)
            if columns[0]:
                arrays = [pa.array(np.concatenate(c)) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc", "number", "token", "late"])


def _all_tokens(batches, shingle: int, text_chars: int):
    """All shingles of each document."""
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        for part in slices(texts, text_chars):
            sets = shingle_sets(texts[part], shingle)
            yield pa.RecordBatch.from_arrays([ids[part.start : part.stop], _lists([_signed(s) for s in sets])], names=["doc", "tokens"])


def _rarest(tokens: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Shared shingles (doc, n, token, place) inside the prefix of the order by rarity among the documents of ``tokens``."""
    rows = tokens.select("doc", F.explode("tokens").alias("token"))
    counts = rows.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ranked = rows.join(counts, "token").groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("ranked"))
    known = ranked.join(sizes, "doc")
    # shingles no other document holds fill the first places
    places = F.expr(f"greatest(n - (n * {percent} + 99) div 100 + 1 - (n - size(ranked)), 0)").cast("int")
    first = F.slice("ranked", F.lit(1), F.least(places, F.size("ranked")))
    found = known.select("doc", "n", (F.col("n") - F.size("ranked")).alias("alone"), F.posexplode(first).alias("at", "s"))
    return found.select("doc", "n", F.col("s.token").alias("token"), (F.col("alone") + F.col("at")).alias("place"))


def _verify(batches, shingle: int, percent: int, text_chars: int):
    """Pairs whose sets are linked."""
    for batch in batches:
        a, b, left, right = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_pylist(), batch.column(3).to_pylist()
        for part in runs([len(x or "") + len(y or "") for x, y in zip(left, right, strict=True)], text_chars):
            # the smaller vertex is the same for runs of rows
            names = list(dict.fromkeys([*left[part], *right[part]]))
            sets = dict(zip(names, shingle_sets(names, shingle), strict=True))
            found = [linked(sets[x], sets[y], percent) for x, y in zip(left[part], right[part], strict=True)]
            keep = np.flatnonzero(found) + part.start
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])


def _prefixes(zone: DataFrame, sizes: DataFrame, number: int, percent: int) -> DataFrame:
    """Shared shingles (doc, token) inside the prefix of one rare-first order."""
    rows = zone.where(F.col("number") == number).select("doc", "token", "late")
    counts = rows.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    early = rows.groupBy("doc").agg(F.count_if(~F.col("late")).alias("early"))
    shared = rows.join(counts, "token").groupBy("doc").agg(
        F.sort_array(F.collect_list(F.when(~F.col("late"), F.struct("df", "token")))).alias("ranked"),
        F.collect_list(F.when(F.col("late"), F.col("token"))).alias("last"),
    )
    length = F.expr(f"n - (n * {percent} + 99) div 100 + 1")
    known = shared.join(early, "doc").join(sizes, "doc")
    # shingles no other document holds fill the first places
    places = F.greatest(length - (F.col("early") - F.size("ranked")), F.lit(0)).cast("int")
    ranked = F.transform(F.slice("ranked", F.lit(1), F.least(places, F.size("ranked"))), lambda s: s["token"])
    return known.select("doc", "n", F.explode(F.concat(ranked, "last")).alias("token"))


def _fits(one: str, other: str, percent: int) -> Column:
    """Whether sets of these sizes may be linked."""
    return 100 * F.least(one, other) >= percent * F.greatest(one, other)


def _reach(x: str, y: str, percent: int) -> Column:
    """Whether the shingles from this place on, the first that both share, are enough for a link."""
    left = F.least(F.col(f"{x}.n") - F.col(f"{x}.place"), F.col(f"{y}.n") - F.col(f"{y}.place"))
    return left * (100 + percent) >= percent * (F.col(f"{x}.n") + F.col(f"{y}.n"))


def _candidates(pairs: DataFrame, seconds: DataFrame) -> DataFrame:
    """Pairs (a < b) that share a shingle of the second prefix as well."""
    of_b, of_a = (seconds.select(F.col("doc").alias(c), F.col("second").alias(f"second_{c}")) for c in "ba")
    return pairs.join(of_b, "b").join(of_a, "a").where(F.arrays_overlap("second_a", "second_b")).select("a", "b")


def link_documents(docs: DataFrame, stage: Staging, shingle: int = 4, percent: int = 85, text_chars: int = 2 << 20) -> DataFrame:
    """doc_id, n_shingles and component_id of each row of ``docs`` (doc_id, text)."""
    named = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn("mark", F.xxhash64("text"))
    settings = {"shingle": shingle, "percent": percent, "text_chars": text_chars}
    sets = stage(named.mapInArrow(partial(_first_prefix, **settings), "doc_id long, mark long, n long, key binary, prefix array<long>"), "sets")
    known = sets.where("doc_id IS NOT NULL AND n > 0")
    classes = known.groupBy("key").agg(F.min(F.struct("doc_id", "mark")).alias("low"), F.first("n").alias("n")).select("key", "low.*", "n")
    # doc_ids with several sets; all sets of one belong together
    several = stage(known.groupBy("doc_id").agg(F.min("key").alias("own"), F.max("key").alias("other")).where("own <> other"), "several")
    repeated = several.count() > 0
    if repeated:
        own = classes.groupBy("doc_id").agg(F.min("key").alias("own"))
        vertex = F.when(F.col("key") == F.col("own"), F.col("doc_id")).otherwise(F.xxhash64("key"))
        classes = classes.join(own, "doc_id").select("key", "doc_id", "mark", "n", vertex.alias("doc"))
    else:
        classes = classes.withColumn("doc", F.col("doc_id"))
    classes = stage(classes, "classes")
    # classes that share enough shingles of the prefix by hash with others
    # (equal sets have equal prefixes, which are shuffled once, by the key)
    heads = known.groupBy("key").agg(F.first("prefix").alias("prefix")).join(classes.select("key", "doc"), "key")
    length = f"(n - (n * {percent} + 99) div 100 + 1)"
    least = F.expr(f"least(n, {length} + {length} div 4) - {length} + 1")
    tokens = heads.select("doc", F.explode("prefix").alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select("token")
    met = tokens.join(shared, "token").groupBy("doc").agg(F.count(F.lit(1)).alias("met"))
    meeting = stage(met.join(classes.select("doc", "doc_id", "mark", "n"), "doc").where(F.col("met") >= least).drop("met"), "meeting")
    texts = stage(named.join(meeting, ["doc_id", "mark"]).select("doc", "text"), "texts")
    if texts.count() != meeting.count():  # rows repeated as a whole
        texts = stage(texts.dropDuplicates(["doc"]), "texts-once")
    zone = stage(texts.mapInArrow(partial(_zone_rows, **settings), "doc long, number int, token long, late boolean"), "zone")
    sizes = meeting.select("doc", "n")
    first, second = (_prefixes(zone, sizes, k, percent) for k in (0, 1))
    lists = stage(first, "lists")
    in_lists = lists.select("doc").distinct()
    seconds = stage(second.groupBy("doc").agg(F.collect_list("token").alias("second")).join(in_lists, "doc", "left_semi"), "seconds")
    stage.drop("zone")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        wanted = _candidates(pairs, seconds)
        right = texts.select(F.col("doc").alias("b"), F.col("text").alias("right"))
        left = texts.select(F.col("doc").alias("a"), F.col("text").alias("left"))
        rows = wanted.join(right, "b").join(left, "a").select("a", "b", "left", "right")
        return stage(rows.mapInArrow(partial(_verify, **settings), "a long, b long"), name)

    # rounds in which a list's members are compared with one of them, then all that is still open
    found, roots = None, None
    if repeated:
        mine = known.join(several.select("doc_id", "own"), "doc_id").join(classes.select("key", "doc"), "key")
        first_set = classes.select(F.col("key").alias("own"), F.col("doc").alias("b"))
        found = stage(mine.join(first_set, "own").where("doc <> b").select(F.col("doc").alias("a"), "b").distinct(), "same-id")
        roots = connected(found, stage, "round-ids")
    for turn in range(LEADER_ROUNDS + 1):
        members = lists.select("doc", "n", "token")
        if roots is not None:
            members = members.join(roots.withColumnRenamed("vertex", "doc"), "doc", "left").withColumn("root", F.coalesce("root", "doc"))
        else:
            members = members.withColumn("root", F.col("doc"))
        heads = members.groupBy("token").agg(F.min(F.struct("root", "doc", "n")).alias("low"), F.max(F.struct("root", "doc", "n")).alias("high"))
        heads = heads.where("low.root <> high.root")
        if turn < LEADER_ROUNDS:
            # the smallest of the list in the first round, then the largest of another component
            lead = F.col("low.doc") if turn % 2 == 0 else F.col("high.doc")
            lead_n, lead_root = (F.col(f"{'low' if turn % 2 == 0 else 'high'}.{c}") for c in ("n", "root"))
            pairs = members.join(heads.select("token", lead.alias("lead"), lead_n.alias("lead_n"), lead_root.alias("lead_root")), "token")
            pairs = pairs.where("root <> lead_root").where(_fits("n", "lead_n", percent)).select(F.least("doc", "lead").alias("a"), F.greatest("doc", "lead").alias("b"))
        else:
            still = stage(members.join(heads.select("token"), "token").groupBy("doc").agg(F.first("root").alias("root")), "still")
            whole = texts.join(still.select("doc"), "doc", "left_semi").select("doc", "text")
            whole = whole.mapInArrow(partial(_all_tokens, shingle=shingle, text_chars=text_chars), "doc long, tokens array<long>")
            rare = _rarest(stage(whole, "tokens"), sizes, percent).join(still, "doc")
            # sizes that may be linked are in the same band or in neighbouring ones
            band = F.floor(F.log("n") / max(1.001 * log(100 / percent), 1e-3))
            open_ = stage(rare.withColumn("band", band), "open")
            stage.drop("tokens")
            x = open_.withColumn("near", F.explode(F.array(F.col("band") - 1, "band", F.col("band") + 1))).alias("x")
            y = open_.alias("y")
            same = (F.col("x.token") == F.col("y.token")) & (F.col("x.near") == F.col("y.band"))
            other = (F.col("x.doc") < F.col("y.doc")) & (F.col("x.root") != F.col("y.root"))
            pairs = x.join(y, same & other & _fits("x.n", "y.n", percent) & _reach("x", "y", percent))
            pairs = pairs.select(F.col("x.doc").alias("a"), F.col("y.doc").alias("b"))
        more = verified(pairs.distinct(), f"links-{turn}")
        found = more if found is None else found.union(more)
        roots = connected(found, stage, f"round-{turn}")
    # the result needs sets, classes and roots only
    stage.drop("meeting", "texts", "texts-once", "lists", "seconds", "still", "open")
    of_class = classes.join(roots.withColumnRenamed("vertex", "doc"), "doc", "left").withColumn("root", F.coalesce("root", "doc"))
    if repeated:  # a root may be the hash of a set
        smallest = of_class.groupBy("root").agg(F.min("doc_id").alias("smallest"))
        of_class = of_class.join(smallest, "root").withColumn("root", F.col("smallest"))
    out = sets.select("doc_id", "n", "key").join(of_class.select("key", "root"), "key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
