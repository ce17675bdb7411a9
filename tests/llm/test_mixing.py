import hashlib
import math

from pyspark.sql import functions as F

from yearwheel.llm import mixing
from yearwheel.operators.staging import Staging


def brute(rows, power, seed):
    """Copies of each (doc_id, text, source)."""
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text or "")
    sizes = {s: max(n, 1) for s, n in sizes.items()}
    total, weights = sum(sizes.values()), sum(n**power for n in sizes.values())
    out = []
    for doc, text, source in rows:
        rate = total * sizes[source] ** power / weights / sizes[source]
        name = str(doc) if doc is not None else f"text {text or ''}"
        u = int(hashlib.md5(f"{seed}:{name}".encode()).hexdigest()[:13], 16) / 2**52
        k, p = 0, math.exp(-rate)
        cdf = p
        while cdf < u:
            k += 1
            p *= rate / k
            cdf += p
        out += [(doc, text, source, c) for c in range(1, k + 1)]
    return out


def test_copies(docs, no_docs, stage, spark):
    mixed = mixing.mix(docs, stage, power=0.5, seed="s")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    key = lambda r: tuple((v is not None, v if v is not None else 0) for v in r)
    got = sorted(((r.doc_id, r.text, r.source, r["copy"]) for r in mixed.collect()), key=key)
    assert got == sorted(brute(rows, 0.5, "s"), key=key)
    assert set(docs.columns) <= set(mixed.columns) and mixed.where("rate IS NULL").count() == 0
    assert mixing.mix(no_docs, Staging(spark)).count() == 0


def test_steps_of_small_large_and_no_rates(spark):
    rates = spark.createDataFrame([(0.0,), (1e-3,), (1e-3,), (2000.0,), (60_000.0,)], "rate double")
    steps = {}
    for r in mixing.poisson_steps(rates).orderBy("rate", "k").collect():
        steps.setdefault(r.rate, []).append(r)
    assert [(r.k, r.low, r.high) for r in steps[0.0]] == [(0, -1.0, 2.0)]
    assert abs(steps[1e-3][0].high - math.exp(-1e-3)) < 1e-12
    high = {r.k: r.high for r in steps[2000.0]}
    assert abs(high[2000] - 0.506) < 0.001
    for rows in steps.values():
        assert rows[0].low == -1.0 and rows[-1].high == 2.0
        assert all(a.high == b.low for a, b in zip(rows, rows[1:], strict=False))
    assert abs([r.k for r in steps[60_000.0] if r.low < 0.5 <= r.high][0] - 60_000) <= 1


def test_columns_named_like_the_steps(spark, stage):
    docs = spark.createDataFrame([(i, "x", "a", -1, "l", 9.0, 0.5) for i in range(50)], "doc_id long, text string, source string, k int, low string, high double, rate double")
    mixed = mixing.mix(docs, stage)
    assert set(docs.columns) <= set(mixed.columns) and mixed.columns.count("rate") == 1
    assert {(r.k, r.low, r.high, r.rate) for r in mixed.collect()} == {(-1, "l", 9.0, 1.0)}


def test_a_hot_source_reaches_its_target(spark, stage):
    rows = [(i, "x" * 10, "hot" if i % 3 else f"s{i % 5}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    counts = {r.source: r["count"] for r in mixing.mix(docs, stage, power=0.0).groupBy("source").count().collect()}
    assert all(abs(n - 1000) < 150 for n in counts.values()) and len(counts) == 6
