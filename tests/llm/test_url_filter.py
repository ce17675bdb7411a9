import re

from pyspark.sql import functions as F

from yearwheel.llm import url_filter
from yearwheel.llm.queries import URL_RULES
from yearwheel.operators.staging import Staging


def brute(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate({c: c + 32 for c in range(65, 91)}), m[2]) if m else ("", "")
    fit = [r for r in URL_RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.partition("/")[2])]
    return host, path, max(fit, key=len, default=None)


def pages(spark, n=400):
    kinds = ["http://Spam{i}.example.NET/x?a=1&b={i}", "https://good{i}.example.net/en/{i}", "http://w.example.com/de/{i}/{i}",
             "https://site.org/fr/page-{i}", "http://other{i}.example.com/en/a", "ftp://net", "http://x.net#top", "no scheme", "a://b://c/d"]
    urls = [k.format(i=i) for i in range(n // len(kinds)) for k in kinds] + [None, "", "http://x.net/"] * 2
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash"))


def test_rules_and_verdicts(spark, stage):
    table = pages(spark)
    rows = url_filter.filter_urls(table, URL_RULES, stage).collect()
    assert len(rows) == table.count()
    for r in rows:
        assert (r.host, r.path, r.rule) == brute(r.url)
        assert r.verdict == (URL_RULES[r.rule] if r.rule else r.tree_verdict)


def test_held_out_accuracy(spark, stage):
    urls = url_filter.with_rule(url_filter.parsed(pages(spark, 2000).select("page_id", "url")), URL_RULES).where("rule IS NOT NULL")
    known = urls.withColumn("blocked", (F.col("rule_verdict") == "block").cast("int"))
    held = F.xxhash64("url") % 4 == 0
    model = url_filter.UrlModel(known.where(~held).select("url", "blocked"), stage)
    judged = model.judged(known.where(held).withColumnRenamed("blocked", "truth"))
    assert judged.agg(F.avg((F.col("truth") == F.col("blocked")).cast("int"))).first()[0] > 0.95


def test_no_rows_and_one_label(spark, stage):
    table = pages(spark)
    assert url_filter.filter_urls(table.limit(0), URL_RULES, stage).count() == 0
    only = url_filter.filter_urls(table, {"net/": "block"}, Staging(spark)).select("tree_verdict").distinct().collect()
    assert [r[0] for r in only] == ["block"]
    none = url_filter.filter_urls(table, {"nowhere/": "block"}, Staging(spark)).select("verdict").distinct().collect()
    assert [r[0] for r in none] == ["allow"]
