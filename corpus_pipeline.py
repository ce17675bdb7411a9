"""From raw documents to token ids: quality, near-duplicates, secrets, mixture, pieces.

``STAGES`` are applied in order; each takes (spark, docs, sf_dir), is written as Parquet and read again as
the next one's ``docs``. All but the last return the columns of ``documents``, whatever else those hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearwheel.llm import jaccard_join, line_crf, mixing, secret_links, viterbi_pieces
from yearwheel.llm.queries import tokenizer_path
from yearwheel.llm.ship import ship
from yearwheel.operators.staging import Staging


def _packed(docs: DataFrame, *names: str) -> DataFrame:
    """The columns an operator needs, and whole rows, so that no other column can clash with its own."""
    return docs.select(*names, F.struct(*docs.columns).alias("__row"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counting rules and whose words mostly stand in content lines."""
    ship(spark)
    chain = line_crf.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    # each text goes to Python once: beside it, the row holds the other columns only
    others = [c for c in docs.columns if c != "text"]
    packed = docs.select("text", F.struct(*others).alias("__row"))
    kept = line_crf.label_quality(packed, chain, ["text", "__row"]).where("kept")
    return kept.select(*[F.col("text") if c == "text" else F.col("__row").getField(c).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group; rows without doc_id belong to no group.

    Documents are linked where four fifths of their five-word shingles are the same.
    """
    ship(spark)
    stage = Staging(spark)
    groups = jaccard_join.link_documents(docs.select("doc_id", "text"), stage, shingle=5, percent=80)
    heads = groups.where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(heads, "doc_id", "left_semi")
    rows, ids = kept.select("doc_id").agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if rows != ids:  # several rows of one doc_id are one document
        one = F.min_by(F.struct(*docs.columns), F.xxhash64("text")).alias("__row")
        kept = kept.groupBy("doc_id").agg(one).select("__row.*")
    return kept.select(docs.columns).unionByName(docs.where("doc_id IS NULL"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts."""
    found = secret_links.find_secrets(_packed(docs, "doc_id", "text"), Staging(spark))
    new = secret_links.redacted(F.col("__row.text"), F.col("spans"))
    rows = found.withColumn("__text", new).withColumn("__changed", F.size("spans") > 0)
    changed = {"text": F.col("__text"), "n_chars": F.when(F.col("__changed"), F.length("__text")).otherwise(F.col("__row.n_chars")).cast("long")}
    return rows.select(*[changed.get(c, F.col("__row").getField(c)).alias(c) for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents, sources mixed to the square root of their sizes."""
    return mixing.mix(_packed(docs, "doc_id", "text", "source"), Staging(spark), power=0.5, seed="pipeline").select("__row.*")


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each copy."""
    ship(spark)
    coded = viterbi_pieces.encode_texts(docs, tokenizer_path("piece_bpe_32k.model"), ["doc_id", "source"])
    return coded.withColumn("n_pieces", F.size("piece_ids").cast("long"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixture", mixture),
    ("pieces", pieces),
]

# the trained labelling and the segmentation have no SQL form; tests hold the pipeline against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``."""
    stage = Staging(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs
