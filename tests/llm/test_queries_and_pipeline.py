"""Registered queries on the smallest given tables, and the pipeline against its operators' brute force."""

import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parity import compare
from yearwheel.llm import queries, registry, viterbi_pieces
from yearwheel.operators.staging import Staging

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")
given = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="given tables not present")


def test_registry():
    numbers = sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in registry.QUERIES
    assert set(registry.ORACLE) <= set(registry.QUERIES)


@given
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(name, spark):
    assert compare.differences(spark, compare.connect(SF_DIR), name, SF_DIR, queries.QUERIES, queries.ORACLE) == ""


def fixture(spark, folder):
    from tests.llm.test_line_crf import labelled

    rows = labelled(spark, 80)
    rows.select("doc_id", "quality", F.lit(0).alias("toxic")).write.parquet(f"{folder}/labels.parquet")
    secret = F.when(F.col("doc_id") == 21, F.concat("text", F.lit(" password=abcdefgh"))).otherwise(F.col("text"))
    docs = rows.select("doc_id", secret.alias("text"), F.lit("en").alias("lang"), F.concat(F.lit("s"), F.col("doc_id") % 3).alias("source"))
    docs = docs.withColumn("n_chars", F.length("text").cast("long")).withColumn("__row", F.lit(1)).withColumn("kept", F.lit("x"))
    more = docs.where("doc_id in (1, 2)").withColumn("doc_id", F.col("doc_id") + 100)
    nulls = docs.limit(2).withColumn("doc_id", F.lit(None).cast("long"))
    empty = docs.limit(1).withColumns({"doc_id": F.lit(500).cast("long"), "text": F.lit(None).cast("string")})
    docs.unionByName(more).unionByName(more).unionByName(nulls).unionByName(empty).write.parquet(f"{folder}/documents.parquet")
    return folder


def test_pipeline(spark, tmp_path):
    folder = fixture(spark, str(tmp_path / "sf"))
    stage, docs = Staging(spark, str(tmp_path / "out")), spark.read.parquet(f"{tmp_path}/sf/documents.parquet")
    seen = {}
    for name, apply in corpus_pipeline.STAGES:
        before = docs
        docs = stage(apply(spark, before, folder), name)
        seen[name] = docs
        if name != "pieces":
            assert docs.columns == before.columns
    ids = {n: {r.doc_id for r in d.collect()} for n, d in seen.items()}
    good = {i for i in range(80) if i % 2}
    assert ids["quality"] - {None} == good | {101}
    # the documents differ by a number in few words: brute force says which are one group
    rows = sorted({(r.doc_id, r.text) for r in seen["quality"].collect() if r.doc_id is not None})
    groups = brute_stage(rows)
    assert ids["near_duplicates"] - {None} == {i for i, c in groups.items() if i == c}
    texts = {r.doc_id: (r.text, r.n_chars) for r in seen["secrets"].collect()}
    assert all("abcdefgh" not in t and n == len(t) for t, n in texts.values())
    model = viterbi_pieces._loaded(queries.tokenizer_path("piece_bpe_32k.model"))[0]
    known = {(r.doc_id, r.text) for r in seen["mixture"].collect()}
    assert {(r.doc_id, model.decode(r.piece_ids)) for r in docs.collect()} == known
    assert all(r.n_pieces == len(r.piece_ids) for r in docs.collect())


def brute_stage(rows):
    """Component of each doc_id by five-word shingles and 80 percent, all pairs compared."""
    words = {i: t.encode().lower().split() for i, t in rows}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in words.items()}
    root = {i: i for i in sets}
    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = {k: low if r == high else r for k, r in root.items()}
    return root


def test_near_duplicates_of_the_pipeline(spark):
    rng = random.Random(21)
    fresh = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    base = fresh(104)
    # 100 of 122, of 124, of 125 and of 126 five-word shingles are the same; the last is no link
    texts = [base, base + fresh(22), fresh(90)]
    for more in (24, 25, 26):
        own = fresh(104)
        texts += [own, own + fresh(more)]
    for _ in range(12):  # copies changed in one to eight words
        copy = fresh(150)
        texts.append(copy)
        changed = list(copy)
        for k in rng.sample(range(150), rng.randrange(1, 9)):
            changed[k] = "other"
        texts.append(changed)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    want = brute_stage(rows)
    assert got == {i for i, c in want.items() if i == c}
    assert 1 not in got and {2, 7, 8} <= got


def test_pipeline_of_no_documents(spark, tmp_path):
    folder = fixture(spark, str(tmp_path / "sf"))
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, apply in corpus_pipeline.STAGES:
        docs = Staging(spark, str(tmp_path / name))(apply(spark, docs, folder), name)
        assert docs.count() == 0


@given
def test_run(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
