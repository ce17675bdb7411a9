"""Audit of a chain of document filters: what each removes, in every order, by part.

Each document fails or passes each of n filters; counts by part and outcome are a tensor of shape 2 x ... x 2,
one axis per filter. Applying the filters in an order only asks for sums over such a tensor: at a step the earlier
filters passed, this one failed (removed) or passed (kept), the later ones either. A selector per axis, (1, 0) for
pass, (0, 1) for fail and (1, 1) for all, makes each of these sums a contraction; one ``einsum`` takes all steps of
all n! orders. The documents are read once, whatever the number of orders.

The filter on repeats is judged over the whole table: a text fails if a smaller doc_id has the same text, removed or
not. Texts are compared by SHA-256. Copies are added up before they meet, so a text that a third of all rows share is a
few rows by then.

Defined cases: a null text is empty; a null part is the empty string; a text of any length is one row of flags; an empty
table gives an empty result; rows with the same doc_id and text are counted each, and all of them pass or fail
the filter on repeats together; a row without doc_id neither fails that filter nor makes others fail it, and has no
label; of several labels of a doc_id the largest counts; a label without document counts nowhere. Columns other than
those named are not read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import permutations
from string import ascii_lowercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearwheel.operators.staging import Staging

REPEAT = "E"
COUNTS = ("all", "good", "toxic")
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
_PARTS_AT_ONCE = 64


def _conditions() -> dict[str, Column]:
    """Whether ``text`` fails each filter, from the number of its words, distinct words and characters."""
    capitals = F.length("text") - F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.col("n_words") < 200,
        "B": 100 * F.col("n_distinct") < 50 * F.col("n_words"),
        "C": 100 * capitals > 2 * F.length("text"),
        "D": F.col("text").rlike("[#$%&*|]"),
    }


def outcomes(docs: DataFrame, part: str, conditions: Mapping[str, Column]) -> DataFrame:
    """doc_id, part, digest and failures by text (bit k is the k-th condition) of each row."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    # splitting leaves an empty word before a leading or after a trailing space
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    counted = rows.withColumn("words", words).select(
        "doc_id", "part", "text", F.size("words").alias("n_words"), F.size(F.array_distinct("words")).alias("n_distinct")
    )
    failed = F.lit(0)
    for bit, condition in enumerate(conditions.values()):
        failed = failed + F.when(condition, 1 << bit).otherwise(0)
    return counted.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), failed.alias("failed"))


def cells(docs: DataFrame, labels: DataFrame, stage: Staging, part: str, conditions: Mapping[str, Column]) -> DataFrame:
    """Documents by part and outcome: part, cell (bits of failed filters, repeats last) and the three counts."""
    same = outcomes(docs, part, conditions).groupBy("doc_id", "part", "digest", "failed").agg(F.count(F.lit(1)).alias("n"))
    # a row without doc_id has a key of its own text, so that such rows do not meet in one task
    named = F.col("doc_id").isNotNull()
    same = same.withColumns({"at": F.coalesce("doc_id", F.xxhash64("digest", "part")), "named": named})
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("at")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    judged = same.join(known.withColumn("named", F.lit(True)), ["at", "named"], "left").fillna(0, ["good", "toxic"])
    first = F.min(F.when(named, F.struct("doc_id", "n")))
    texts = judged.groupBy("digest", "part", "failed", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(~named, F.col("n")).otherwise(0)).alias("unnamed"), first.alias("first")
    )
    texts = stage(texts, "texts")
    heads = texts.groupBy("digest").agg(F.min("first.doc_id").alias("head"))
    heads = heads.toDF("digest_", "head")
    met = texts.join(heads, F.col("digest") == F.col("digest_"))
    passing = F.col("unnamed") + F.when(F.col("first.doc_id") == F.col("head"), F.col("first.n")).otherwise(0)
    repeat = 1 << len(conditions)
    split = F.inline(
        F.array(
            F.struct(F.col("failed").alias("cell"), passing.alias("c")),
            F.struct((F.col("failed") + repeat).alias("cell"), (F.col("n") - passing).alias("c")),
        )
    )
    return (
        met.select("part", "good", "toxic", split)
        .groupBy("part", "cell")
        .agg(F.sum("c").alias("all"), F.sum(F.col("c") * F.col("good")).alias("good"), F.sum(F.col("c") * F.col("toxic")).alias("toxic"))
    )


PASS, FAIL, EITHER = (1, 0), (0, 1), (1, 1)


def selectors(n: int, steps: Sequence[tuple[Sequence[int], Sequence[int]]]) -> np.ndarray:
    """Selector of each axis for each (passed filters, failed filters)."""
    out = np.full((len(steps), n, 2), EITHER, np.int64)
    for row, (passed, failed) in zip(out, steps, strict=True):
        row[list(passed)] = PASS
        row[list(failed)] = FAIL
    return out


def contracted(tensor: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Sums of ``tensor`` (parts, counts, 2, ..., 2) that the selectors take: (parts, counts, steps)."""
    axes = ascii_lowercase[: tensor.ndim - 2]
    terms = ",".join(f"Z{a}" for a in axes)
    return np.einsum(f"XY{axes},{terms}->XYZ", tensor, *chosen.transpose(1, 0, 2), optimize="greedy")


def audited(tensor: np.ndarray) -> dict[str, np.ndarray]:
    """Each measure (parts, orders, steps) of tensors (parts, counts, 2, ..., 2)."""
    n = tensor.ndim - 2
    orders = list(permutations(range(n)))
    steps = [(order[:k], order[k]) for order in orders for k in range(n)]
    shape = (len(tensor), len(orders), n)
    lost = contracted(tensor, selectors(n, [(before, [f]) for before, f in steps]))
    kept = contracted(tensor[:, :1], selectors(n, [([*before, f], []) for before, f in steps]))
    fails = contracted(tensor[:, :1], selectors(n, [([], [f]) for _, f in steps]))
    alone = contracted(tensor[:, :1], selectors(n, [([o for o in range(n) if o != f], [f]) for _, f in steps]))
    removed = lost[:, 0].reshape(shape)
    of_filter = np.array([f for _, f in steps])
    total = np.stack([removed.reshape(len(tensor), -1)[:, of_filter == f].sum(1) for f in range(n)], 1)
    values = (kept[:, 0], lost[:, 0], fails[:, 0] - lost[:, 0], alone[:, 0], lost[:, 1], lost[:, 2], total[:, of_filter])
    return {name: v.reshape(shape) for name, v in zip(MEASURES, values, strict=True)}


def _steps(batches, letters: str):
    """Rows of the audit from lists of cells, some parts at a time."""
    n = len(letters)
    orders = ["".join(o) for o in permutations(letters)]
    for batch in batches:
        for begin in range(0, batch.num_rows, _PARTS_AT_ONCE):
            rows = batch.slice(begin, _PARTS_AT_ONCE)
            found = rows.column(1)
            at = np.repeat(np.arange(len(found)), found.value_lengths().to_numpy())
            flat = found.flatten()
            cell = flat.field("cell").to_numpy()
            tensor = np.zeros((len(found), len(COUNTS), *[2] * n), np.int64)
            # the first filter is the lowest bit and the first axis
            place = tuple((cell >> k) & 1 for k in range(n))
            for k, name in enumerate(COUNTS):
                np.add.at(tensor, (at, k, *place), flat.field(name).to_numpy())
            measured = audited(tensor)
            per = len(orders) * n
            names = pa.array(orders).take(pa.array(np.tile(np.repeat(np.arange(len(orders)), n), len(found))))
            step = np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders) * len(found))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(pa.array(np.repeat(np.arange(len(found)), per))), names, pa.array(step)]
                + [pa.array(measured[m].reshape(-1)) for m in MEASURES],
                names=["part", "filter_order", "step", *MEASURES],
            )


def audit(
    docs: DataFrame,
    labels: DataFrame,
    stage: Staging,
    part: str = "source",
    conditions: Mapping[str, Column] | None = None,
    repeat: str = REPEAT,
) -> DataFrame:
    """part, filter_order, step and the measures, for each part, order of the filters and step.

    ``docs`` has doc_id, text and the column ``part``; ``labels`` has doc_id, quality and toxic. ``conditions`` are
    failures by ``text``, ``n_words`` and ``n_distinct``, one letter each; ``repeat`` is the letter of the filter on
    repeats. n filters give n! * n rows a part, so n is small: seven make 35 280.
    """
    conditions = _conditions() if conditions is None else dict(conditions)
    letters = "".join(conditions) + repeat
    found = cells(docs, labels, stage, part, conditions)
    # at most 2^n cells a part
    lists = found.groupBy("part").agg(F.collect_list(F.struct("cell", *COUNTS)).alias("cells"))
    schema = "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in MEASURES)
    return lists.mapInArrow(lambda batches: _steps(batches, letters), schema)
