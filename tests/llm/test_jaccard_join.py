import os
import random

from yearwheel.llm.components import connected
from yearwheel.llm.jaccard_join import link_documents
from yearwheel.operators.staging import Staging


def sets(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 4]) for k in range(len(words) - 3)} if len(words) >= 4 else ({tuple(words)} if words else set())


def brute(rows):
    """Component of each doc_id, all pairs compared."""
    known = [(i, sets(t)) for i, t in rows]
    root = {i: i for i, _ in known}  # rows of one doc_id are one document

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(known):
        for j, b in known[:k]:
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in known}


def corpus():
    rng = random.Random(9)
    words = [f"w{k}" for k in range(400)]
    common = [rng.choice(words) for _ in range(30)]
    out = []
    for _ in range(60):
        body = [rng.choice(words) for _ in range(rng.randrange(4, 60))]
        out.append(body + common if rng.random() < 0.5 else body)
    base = [rng.choice(words) for _ in range(120)]
    for _ in range(40):  # a large group of near copies, and chains between them
        copy = list(base)
        for _ in range(rng.randrange(0, 6)):
            copy[rng.randrange(120)] = rng.choice(words)
        out.append(copy)
    step = list(base)
    for k in range(0, 60, 3):
        step[k] = "chain"
        out.append(list(step))
    return [(i, " ".join(t)) for i, t in enumerate(out)]


def test_components(spark, stage):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in link_documents(docs, stage).collect()}
    want = brute(rows)
    assert got == want and len(set(want.values())) < len(rows) - 20


def test_passages_and_own_words(spark, stage):
    """Many texts that are alike, just under and just over the threshold, of one and of different lengths."""
    rng = random.Random(4)
    base = [f"b{k}" for k in range(160)]
    rows = []
    for doc in range(120):
        copy = list(base)
        for _ in range(rng.randrange(1, 9)):
            copy[rng.randrange(160)] = f"own{doc}x{rng.randrange(10**6)}"
        rows.append((doc, " ".join(copy[: rng.choice([160, 160, 150, 138])])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert {r.doc_id: r.component_id for r in link_documents(docs, stage).collect()} == want
    assert 5 < len(set(want.values())) < 115


def test_several_texts_of_one_id(spark):
    w, v, u, t = (" ".join(f"{c}{k}" for k in range(30)) for c in "wvut")
    rows = [(5, w), (5, v), (1, w), (2, v), (8, u), (8, t), (8, t), (9, t), (3, u + " more"), (4, "alone here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = link_documents(docs, Staging(spark)).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: {x.component_id for x in out if x.doc_id == r.doc_id} for r in out}
    assert got == {1: {1}, 2: {1}, 5: {1}, 3: {3}, 8: {3}, 9: {3}, 4: {4}}
    assert got == {i: {c} for i, c in brute(rows).items()}


def test_cases(spark, docs, no_docs, stage):
    out = link_documents(docs, stage).collect()
    assert len(out) == docs.count()
    assert all(r.component_id is None for r in out if r.doc_id is None)
    assert {r.component_id for r in out if r.doc_id == 6} == {5}  # an exact copy of document 5
    assert {(r.n_shingles, r.component_id) for r in out if r.doc_id in (0, 1, 2)} == {(0, 0), (0, 1), (0, 2)}
    assert {r.n_shingles for r in out if r.doc_id in (3, 4)} == {1}
    assert link_documents(no_docs, Staging(spark)).count() == 0


def test_long_chains_are_one_component(spark, stage):
    links = spark.createDataFrame([(k, k + 1) for k in range(1, 60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.vertex: r.root for r in connected(links, stage).collect()}
    assert got == {k: 1 for k in range(1, 61)} | {100: 100, 101: 100}
    assert connected(links.limit(0), Staging(spark)).count() == 0


def test_staged_tables_that_the_result_does_not_read_are_gone(spark, stage):
    rows = corpus()
    out = link_documents(spark.createDataFrame(rows, "doc_id long, text string"), stage)
    left = os.listdir(stage.folder)
    assert not {"zone", "texts", "lists", "seconds", "tokens", "open", "meeting"} & set(left)
    assert {r.doc_id: r.component_id for r in out.collect()} == brute(rows)
