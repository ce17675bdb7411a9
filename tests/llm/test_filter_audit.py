"""The audit against applying the filters one after the other, document by document."""

import re
from itertools import permutations

import pytest

from yearwheel.llm import filter_audit



def brute(docs, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    smallest = {}
    for i, text, _ in docs:
        if i is not None:
            key = text or ""
            smallest[key] = min(i, smallest.get(key, i))
    parts = {}
    for i, text, part in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and i > smallest[text],
        }
        parts.setdefault(part or "", []).append((i, fails))
    out = set()
    for part, rows in parts.items():
        removed_by = dict.fromkeys("ABCDE", 0)
        found = []
        for order in permutations("ABCDE"):
            left = list(rows)
            for step, f in enumerate(order, 1):
                hit = [r for r in left if r[1][f]]
                left = [r for r in left if not r[1][f]]
                removed_by[f] += len(hit)
                fails = [r for r in rows if r[1][f]]
                found.append(
                    ["".join(order), step, len(left), len(hit), len(fails) - len(hit), sum(sum(r[1].values()) == 1 for r in fails),
                     sum(r[0] in good for r in hit), sum(r[0] in toxic for r in hit), f]
                )
        out |= {(part, *r[:-1], removed_by[r[-1]]) for r in found}
    return out


@pytest.fixture(scope="module")
def docs():
    prose = [" ".join(f"w{(k * j) % 331}" for k in range(260)) for j in range(1, 6)]
    texts = [None, "", " ", "short", "ALL CAPS HERE", "a # b", "日本 é", *prose, prose[0].upper(), "same " * 300, "x " * 40 + "A$", "\n".join(prose), prose[1] + "\t"]
    rows = [(k * 3 % 50, t, [None, "", "web", "news"][k % 4]) for k, t in enumerate(texts * 3)]
    return [*rows, (7, prose[0], "web"), (7, prose[0], "web"), (7, prose[1], "news"), (None, prose[0], "web"), (None, None, None), (None, "", "web")]


def test_audit_equals_filters_applied(spark, stage, docs):
    labels = [(k, k % 2, (k // 2) % 2) for k in range(0, 40)] + [(6, 1, 0), (6, None, None), (None, 1, 1), (999, 1, 1)]
    # clashing columns are not read
    table = spark.createDataFrame([(*r, 1, 2, "n") for r in docs], "doc_id long, text string, source string, n int, good int, part string")
    found = filter_audit.audit(table, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), stage)
    got = {tuple(r) for r in found.select("part", "filter_order", "step", *filter_audit.MEASURES).collect()}
    assert got == brute(docs, labels)
    assert len(got) == found.count() == 600 * 3


def test_empty_tables(spark, stage, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(spark.createDataFrame([], "doc_id long, text string, source string"), none, stage).count() == 0


def test_other_parts_and_filters(spark, stage):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, "a b", 5), (2, "a", 5), (3, "a", 6)], "doc_id long, text string, size int")
    labels = spark.createDataFrame([(2, 1, 0)], "doc_id long, quality int, toxic int")
    found = filter_audit.audit(docs, labels, stage, part="size", conditions={"X": F.col("n_words") < 2}, repeat="R")
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.good_lost, r.shapley) for r in found.collect()}
    assert got[("5", "XR", 1)] == (1, 1, 0, 1, 2)
    assert got[("6", "XR", 1)] == (0, 1, 0, 0, 1)
    assert got[("6", "XR", 2)] == (0, 0, 1, 0, 1)
    assert got[("6", "RX", 1)] == (0, 1, 0, 0, 1)
    assert len(got) == 8
