"""Queries ``opN_<name>``: each operator, with production parameters, on its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearwheel.llm import cover_tree, filter_audit, jaccard_join, line_crf, mixing, multi_index, nn_descent, secret_links, substring_dedup, token_grammar, url_filter, viterbi_pieces, warc
from yearwheel.llm.ship import ship
from yearwheel.operators.staging import Staging

try:
    from public_tokenizers import path as tokenizer_path
except ModuleNotFoundError:  # the vocabulary files are optional; a caller passes paths of its own

    def tokenizer_path(name: str) -> str:
        return f"/opt/tokenizers/{name}"


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{d}/{name}.parquet")


URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def op1_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(_table(spark, d, "documents"), Staging(spark))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_url_filter(spark: SparkSession, d: str) -> DataFrame:
    judged = url_filter.filter_urls(_table(spark, d, "pages"), URL_RULES, Staging(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict", "tree_verdict")


def op3_warc(spark: SparkSession, d: str) -> DataFrame:
    folder = Staging(spark).folder
    index = warc.write_archives(_table(spark, d, "pages"), folder)
    return warc.read_records(index, payload=False).drop("payload")


def op4_token_grammar(spark: SparkSession, d: str) -> DataFrame:
    folder = Staging(spark).folder
    index = token_grammar.write_tokens(
        _table(spark, d, "documents"), folder, tokenizer_path("word_bpe_49k.json"), end_id=2
    )
    return token_grammar.read_tokens(index, digest=True)


def op5_line_crf(spark: SparkSession, d: str) -> DataFrame:
    docs = _table(spark, d, "documents")
    chain = line_crf.train(docs, _table(spark, d, "labels"))
    return line_crf.label_quality(docs, chain, ["doc_id"])


def op6_mixing(spark: SparkSession, d: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, d, "documents"), Staging(spark), power=0.5, seed="mix")
    return mixed.withColumn("rate", F.round("rate", 6))


def op7_secret_links(spark: SparkSession, d: str) -> DataFrame:
    found = secret_links.find_secrets(_table(spark, d, "documents").select("doc_id", "text"), Staging(spark))
    base, spans = F.col("base_spans"), F.col("spans")
    return found.select(
        "doc_id",
        *[secret_links.counted(base, k).alias(f"n_{k}") for k in secret_links.KINDS[: secret_links.BASE]],
        *[secret_links.counted(spans, k).alias(f"n_{k}") for k in secret_links.KINDS[secret_links.BASE :]],
        F.sha2(secret_links.named(base), 256).alias("base_sha256"),
        secret_links.named(spans).alias("spans"),
    )


def op8_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    return jaccard_join.link_documents(_table(spark, d, "documents"), Staging(spark))


def op9_multi_index(spark: SparkSession, d: str) -> DataFrame:
    return multi_index.near_duplicates(_table(spark, d, "embeddings"), Staging(spark))


def op10_viterbi_pieces(spark: SparkSession, d: str) -> DataFrame:
    return viterbi_pieces.encode_and_check(_table(spark, d, "documents"), tokenizer_path("piece_bpe_32k.model"), ["doc_id"])


def op11_nn_descent(spark: SparkSession, d: str) -> DataFrame:
    return nn_descent.nearest(_table(spark, d, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0, Staging(spark))


def op12_filter_audit(spark: SparkSession, d: str) -> DataFrame:
    return filter_audit.audit(_table(spark, d, "documents"), _table(spark, d, "labels"), Staging(spark))


def op13_cover_tree(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(256 * x).cast("double"))
    # a fault in the vector stays one
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    own = rows.select("vec_id", label.alias("label"), F.when(fine, whole).alias("vec"))
    return cover_tree.mine_negatives(own, F.col("vec_id") % 50 == 0, Staging(spark))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_warc": op3_warc,
    "op4_token_grammar": op4_token_grammar,
    "op5_line_crf": op5_line_crf,
    "op6_mixing": op6_mixing,
    "op7_secret_links": op7_secret_links,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_multi_index": op9_multi_index,
    "op10_viterbi_pieces": op10_viterbi_pieces,
    "op11_nn_descent": op11_nn_descent,
    "op12_filter_audit": op12_filter_audit,
    "op13_cover_tree": op13_cover_tree,
}

_MIX_SQL = """
WITH sizes AS (
    SELECT source, CAST(greatest(sum(coalesce(length(text), 0)), 1) AS DOUBLE) AS size FROM documents GROUP BY source
), rates AS (
    SELECT source, (SELECT sum(size) FROM sizes) * sqrt(size) / (SELECT sum(sqrt(size)) FROM sizes) / size AS rate FROM sizes
), pmf AS (
    SELECT source, rate, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) AS p
    FROM rates, LATERAL (SELECT unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 40) AS BIGINT) + 1)) AS k)
), cdf AS (
    SELECT source, any_value(rate) AS rate, list(total ORDER BY k) AS cdf
    FROM (SELECT source, rate, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS total FROM pmf) GROUP BY source
), drawn AS (
    SELECT d.*, r.rate, CAST(len(list_filter(r.cdf, lambda c:
        c < CAST('0x' || substr(md5('mix:' || d.doc_id), 1, 13) AS BIGINT) / 4503599627370496.0)) AS INTEGER) AS n_copies
    FROM documents d JOIN cdf r ON d.source IS NOT DISTINCT FROM r.source
), copies AS (SELECT *, CAST(unnest(range(1, n_copies + 1)) AS INTEGER) AS copy FROM drawn)
SELECT doc_id, text, lang, source, n_chars, round(rate, 6) AS rate, n_copies, copy,
       md5('mix:order:' || doc_id || ':' || copy) AS shuffle_key
FROM copies
"""

_AUDIT_SQL = r"""
WITH words AS (
    SELECT doc_id, coalesce(CAST(source AS VARCHAR), '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), flags AS (
    SELECT part, d.doc_id, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
           len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
           100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS c,
           regexp_matches(text, '[#$%&*|]') AS d,
           coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), false) AS e
    FROM words d LEFT JOIN (
        SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
        FROM labels GROUP BY doc_id
    ) l ON d.doc_id = l.doc_id
), bits AS (
    SELECT part, good, toxic, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS cell FROM flags
), cells AS (
    SELECT part, cell, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM bits GROUP BY part, cell
), letters AS (
    SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS t(letter, bit)
), orders AS (
    SELECT p.letter || q.letter || r.letter || s.letter || t.letter AS filter_order, [p.bit, q.bit, r.bit, s.bit, t.bit] AS bits
    FROM letters p, letters q, letters r, letters s, letters t WHERE p.bit | q.bit | r.bit | s.bit | t.bit = 31
), steps AS (
    SELECT filter_order, CAST(step AS INT) AS step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INT) AS before
    FROM orders, LATERAL (SELECT unnest(range(1, 6)) AS step)
), counted AS (
    SELECT part, filter_order, step, bit,
           CAST(sum(CASE WHEN cell & (before | bit) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
           CAST(sum(CASE WHEN cell & before = 0 AND cell & bit > 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
           CAST(sum(CASE WHEN cell & before > 0 AND cell & bit > 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
           CAST(sum(CASE WHEN cell = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
           CAST(sum(CASE WHEN cell & before = 0 AND cell & bit > 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
           CAST(sum(CASE WHEN cell & before = 0 AND cell & bit > 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
    FROM steps, cells GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""

_NEGATIVES_SQL = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same, CAST(list_inner_product(a.vec, r.vec) AS BIGINT) AS score
    FROM rows a JOIN rows r ON a.vec_id <> r.vec_id AND len(a.vec) = len(r.vec) WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND NOT same
    AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 3
"""

ORACLE: dict[str, str] = {"op13_cover_tree": _NEGATIVES_SQL, "op6_mixing": _MIX_SQL, "op12_filter_audit": _AUDIT_SQL}
