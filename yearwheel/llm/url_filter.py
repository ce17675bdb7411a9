"""Block or allow URLs: rules first, gradient-boosted trees on lexical features for the rest.

A rule is ``host/path``; it fits that host and its subdomains if the url's path begins with the rule's
path, and the longest fitting rule wins. URLs that a rule decides are the labelled URLs: their
suffix statistics (all of them, one aggregation) and a bounded sample of them (``train_rows``, the
smallest hashes among distinct URLs) train the trees, which judge every url without a rule.

Defined cases: a null url or one without ``://`` has empty host and path and is judged by the trees on
that; repeated URLs count once in training; if all labelled URLs have one label, that is the verdict,
and ``allow`` if there are none; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearwheel.operators.staging import Staging

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
NUMBERS = ["n_chars", "depth", "digit_ratio", "entropy", "n_params", "host_chars", "n_labels", "n_hyphens", "longest", "tld", "domain"]


def _folded(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parsed(urls: DataFrame) -> DataFrame:
    """Add host and path."""
    part = lambda k: F.coalesce(F.regexp_extract("url", PARTS, k), F.lit(""))
    return urls.withColumns({"host": _folded(part(1)), "path": part(2)})


def with_rule(urls: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Add rule and rule_verdict of the longest rule that fits host and path."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):
        host, slash, path = rule.partition("/")
        fits = ((F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))) & F.startswith("path", F.lit(slash + path))
        found = F.when(fits, F.lit(rule)).otherwise(found)
    verdicts = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])
    return urls.withColumn("rule", found).withColumn("rule_verdict", F.element_at(verdicts, F.col("rule")))


def with_features(urls: DataFrame) -> DataFrame:
    """Add the lexical features and the two host suffixes."""
    url = F.coalesce(F.col("url"), F.lit(""))
    length = F.length(url)
    digits = F.length(F.regexp_replace(url, "[^0-9]", ""))
    # share of each distinct character, from what is left when it is taken out
    shares = F.transform(
        F.array_distinct(F.split(url, "")), lambda c: (length - F.length(F.replace(url, c, F.lit("")))) / length
    )
    entropy = F.aggregate(shares, F.lit(0.0), lambda total, p: total - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    params = F.when(query == "", 0).otherwise(F.length(query) - F.length(F.replace(query, F.lit("&"), F.lit(""))) + 1)
    labels = F.split("host", r"\.")
    longest = F.aggregate(F.split(url, "[^A-Za-z0-9]+"), F.lit(0), lambda most, w: F.greatest(most, F.length(w)))
    return urls.withColumns(
        {
            "n_chars": length.cast("double"),
            "depth": F.size(F.filter(F.split("path", "/"), lambda x: x != "")).cast("double"),
            "digit_ratio": F.when(length > 0, digits / length).otherwise(0.0),
            "entropy": F.when(length > 0, entropy).otherwise(0.0),
            "n_params": params.cast("double"),
            "host_chars": F.length("host").cast("double"),
            "n_labels": F.size(labels).cast("double"),
            "n_hyphens": (length - F.length(F.replace(url, F.lit("-"), F.lit("")))).cast("double"),
            "longest": longest.cast("double"),
            "tld_name": F.substring_index("host", ".", -1),
            "domain_name": F.substring_index("host", ".", -2),
        }
    )


def suffix_statistics(labelled: DataFrame, smoothing: float = 10.0) -> DataFrame:
    """Smoothed share of blocked URLs of every host suffix (tld_name, domain_name)."""
    suffixes = labelled.select("blocked", F.explode(F.array_distinct(F.array("tld_name", "domain_name"))).alias("suffix"))
    sums = suffixes.groupBy("suffix").agg(F.sum("blocked").alias("blocked"), F.count(F.lit(1)).alias("n"))
    return sums.select("suffix", ((F.col("blocked") + smoothing / 2) / (F.col("n") + smoothing)).alias("share"))


def with_suffixes(urls: DataFrame, statistics: DataFrame) -> DataFrame:
    for name in ("tld", "domain"):
        own = statistics.select(F.col("suffix").alias(f"{name}_name"), F.col("share").alias(name))
        urls = urls.join(own, f"{name}_name", "left").fillna(0.5, [name])
    return urls


class UrlModel:
    """Boosted trees with the suffix statistics they were trained on."""

    def __init__(self, labelled: DataFrame, stage: Staging, train_rows: int = 20_000, rounds: int = 10, depth: int = 4, seed: int = 7):
        """``labelled`` has url and blocked (0 or 1)."""
        rows = with_features(parsed(labelled.where("url IS NOT NULL").groupBy("url").agg(F.max("blocked").alias("blocked"))))
        self.statistics = stage(suffix_statistics(rows), "suffixes")
        sample = rows.orderBy(F.xxhash64("url"), "url").limit(train_rows)
        sample = stage(with_suffixes(sample, self.statistics).select("blocked", *NUMBERS), "training")
        lowest, highest = sample.agg(F.min("blocked"), F.max("blocked")).first()
        self.only, self.trees = None, None
        self.assembler = VectorAssembler(inputCols=NUMBERS, outputCol="__features")
        if lowest == highest:
            self.only = float(lowest or 0)
        else:
            trees = GBTClassifier(featuresCol="__features", labelCol="blocked", maxIter=rounds, maxDepth=depth, seed=seed)
            self.trees = trees.fit(self.assembler.transform(sample.withColumn("blocked", F.col("blocked").cast("double"))))

    def judged(self, urls: DataFrame) -> DataFrame:
        """Add the feature columns and ``blocked``, 0.0 or 1.0, for each url."""
        rows = with_suffixes(with_features(urls), self.statistics)
        if self.trees is None:
            return rows.withColumn("blocked", F.lit(self.only))
        scored = self.trees.transform(self.assembler.transform(rows))
        return scored.withColumnRenamed("prediction", "blocked").drop("__features", "rawPrediction", "probability")


def filter_urls(pages: DataFrame, rules: dict[str, str], stage: Staging, **training) -> DataFrame:
    """page_id, url, host, path, rule, verdict and the tree's opinion for every page."""
    urls = with_rule(parsed(pages.select(F.col("page_id"), F.col("url").cast("string"))), rules)
    labelled = urls.where("rule IS NOT NULL").select("url", (F.col("rule_verdict") == "block").cast("int").alias("blocked"))
    model = UrlModel(labelled, stage, **training)
    opinion = F.when(F.col("blocked") > 0.5, "block").otherwise("allow")
    return model.judged(urls).select(
        "page_id", "url", "host", "path", "rule", F.coalesce("rule_verdict", opinion).alias("verdict"), opinion.alias("tree_verdict"), *NUMBERS
    )
