"""Secrets in texts: patterns on their own, and weak candidates linked to their other parts.

Spans of three kinds are always reported: assignments of passwords and the like (``assign``), access
key ids (``access``) and long runs of hexadecimal digits (``hex``). A credential also has parts that
alone mean little: an identifier (``id``), a high-entropy token (``token``), an endpoint
(``endpoint``). Such a weak candidate is reported only if its complements begin within ``scope``
characters of it in the same document: an id near a secret (token, assign or hex), a token near an
identifier (id or access), an endpoint near both.

The link is an interval join: candidates meet complements in blocks of ``scope`` characters and the next
block on either side, as a left semi join, so no pairs are listed and a key never holds more than a few
blocks of one document. Everything is DataFrame code.

Defined cases: a null text is an empty one; rows with the same doc_id and text get the same spans; spans
are half open and count code points; columns of the input named like those added are replaced; an empty table gives
no rows; a very long text is scanned whole, in one task, and linked in blocks like any other.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearwheel.operators.staging import Staging

WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN = r"""(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# at least 20 characters; a shorter run holds no longer one
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
# a named identifier, or the mail address of an account
ID = (
    r"(?i:(?:client|account|access|user|key|tenant)[_-]?(?:id|name))[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9@._-]{4,}"
    r"|(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"
)
TOKEN = r"(?<![A-Za-z0-9+/_=-])(?=[a-z0-9+/_=-]*[A-Z])(?=[A-Z0-9+/_=-]*[a-z])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{32,}"
# an address with a scheme, a host name or an IPv4 address; what follows the @ of a mail address is none
ENDPOINT = (
    r"(?i:https?|postgres|mysql|mongodb|redis|amqp|ftp)://[^\s\"'<>]+"
    r"|(?<![A-Za-z0-9@._-])(?:[A-Za-z0-9-]{1,63}\.){1,8}(?:com|net|org|io|dev|cloud|internal|local)(?![A-Za-z0-9@_-])(?::[0-9]{1,5})?"
    r"|(?<![A-Za-z0-9@._-])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])(?::[0-9]{1,5})?"
)
KINDS = ("assign", "access", "hex", "id", "token", "endpoint")
BASE = 3
SPAN = "array<struct<start:int,kind:int,end:int>>"
# what a weak kind asks for: complements by name, and the kinds that count as each
NEEDS = {"id": ("secret",), "token": ("identifier",), "endpoint": ("identifier", "secret")}
COMPLEMENTS = {"secret": ("assign", "hex", "token"), "identifier": ("access", "id")}


def matches(text: Column, pattern: str, kind: str, least_value: int = 0) -> Column:
    """Spans of the leftmost matches that do not overlap; with ``least_value``, those whose value is as long.

    Offsets come from the lengths of the matches and of what lies between them.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) if least_value else hits
    gaps = F.split(text, pattern, -1)
    number = F.lit(KINDS.index(kind))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def step(acc: Column, part: Column) -> Column:
        begin = acc["at"] + F.length(part["gap"])
        end = begin + F.length(part["hit"])
        span = F.array(F.struct(begin.alias("start"), number.alias("kind"), end.alias("end")))
        kept = F.when(F.length(part["value"]) >= least_value, F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct(end.alias("at"), kept.alias("spans"))

    parts = F.zip_with(
        F.arrays_zip(gaps.alias("gap"), hits.alias("hit")), values, lambda p, v: F.struct(p["gap"].alias("gap"), p["hit"].alias("hit"), v.alias("value"))
    )
    found = F.filter(parts, lambda p: p["hit"].isNotNull())
    return F.aggregate(found, start, step)["spans"]


def _if(condition: Column, spans: Column) -> Column:
    """Look closely only where a quick test says there is something."""
    return F.when(condition, spans).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    low = F.lower(text)
    words = F.lit(False)
    for word in WORDS:
        words = words | F.contains(low, F.lit(word))
    return F.array_sort(
        F.concat(
            _if(words, matches(text, ASSIGN, "assign", 6)),
            _if(F.contains(text, F.lit("AKIA")), matches(text, ACCESS, "access")),
            _if(F.rlike(text, F.lit(HEX)), matches(text, HEX, "hex")),
        )
    )


def weak_spans(text: Column) -> Column:
    return F.concat(
        _if(F.rlike(text, F.lit(ID)), matches(text, ID, "id")),
        _if(F.rlike(text, F.lit(TOKEN)), matches(text, TOKEN, "token")),
        _if(F.rlike(text, F.lit(ENDPOINT)), matches(text, ENDPOINT, "endpoint")),
    )


def linked(parts: DataFrame, scope: int) -> DataFrame:
    """Weak spans (key, start, kind, end) of ``parts`` all of whose complements lie within ``scope``."""
    number = {k: i for i, k in enumerate(KINDS)}
    needs = F.create_map(*[x for k, n in NEEDS.items() for x in (F.lit(number[k]), F.array(*map(F.lit, n)))])
    roles = F.create_map(
        *[x for k in KINDS for x in (F.lit(number[k]), F.array(*[F.lit(r) for r, of in COMPLEMENTS.items() if k in of]).cast("array<string>"))]
    )
    block = F.floor(F.col("start") / scope)
    wanting = parts.where(F.col("kind") >= BASE).withColumns({"block": block, "needs": F.element_at(needs, F.col("kind"))})
    wanting = wanting.withColumn("need", F.explode("needs"))
    near = F.explode(F.sequence(block - 1, block + 1))
    giving = parts.select("key", F.col("start").alias("there"), F.explode(F.element_at(roles, F.col("kind"))).alias("need"), near.alias("block"))
    same = (F.col("w.key") == F.col("g.key")) & (F.col("w.block") == F.col("g.block")) & (F.col("w.need") == F.col("g.need"))
    met = wanting.alias("w").join(
        giving.alias("g"), same & (F.abs(F.col("w.start") - F.col("g.there")) <= scope), "left_semi"
    )
    whole = met.groupBy("key", "start", "kind", "end", F.size("needs").alias("asked")).agg(F.count_distinct("need").alias("met"))
    return whole.where("met = asked").select("key", "start", "kind", "end")


def find_secrets(docs: DataFrame, stage: Staging | None = None, scope: int = 256) -> DataFrame:
    """All columns of ``docs`` with base_spans and spans, arrays of (start, kind, end) in order.

    The parts of documents with a weak candidate are written to ``stage`` once; both sides of the link read them there. So is
    what was found: Spark then knows how little it is, and shuffles no texts for it where it can be broadcast.
    """
    stage = stage or Staging(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.drop("base_spans", "spans").withColumn("base_spans", base_spans(text))
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), text))
    weak = docs.select(key.alias("key"), text.alias("text")).withColumn("weak", weak_spans(F.col("text"))).where(F.size("weak") > 0)
    parts = weak.withColumn("part", F.explode(F.concat("weak", base_spans(F.col("text"))))).select("key", "part.*")
    run = uuid4().hex
    parts = stage(parts, f"parts_{run}")
    found = linked(parts, scope).groupBy("key").agg(F.collect_set(F.struct("start", "kind", "end")).alias("__more"))
    found = stage(found, f"found_{run}")
    stage.drop(f"parts_{run}")
    out = rows.withColumn("__key", key).join(found.withColumnRenamed("key", "__key"), "__key", "left")
    spans = F.array_sort(F.concat("base_spans", F.coalesce("__more", F.array().cast(SPAN))))
    return out.withColumn("spans", spans).drop("__key", "__more")


def named(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["end"])), ",")


def counted(spans: Column, kind: str) -> Column:
    number = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("long")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with each run of overlapping spans replaced by ``mark``; null stays null."""
    start = F.array().cast("array<struct<start:int,end:int>>")

    def merge(acc: Column, s: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        one = F.struct(s["start"].alias("start"), s["end"].alias("end"))
        head = F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))
        return F.when(s["start"] < last["end"], F.concat(head, F.array(joined))).otherwise(F.concat(acc, F.array(one)))

    merged = F.aggregate(spans, start, merge)
    pieces = F.transform(
        F.sequence(F.lit(0), F.size(merged)),
        lambda i: F.substring(
            text,
            F.when(i > 0, F.get(merged, i - 1)["end"]).otherwise(0) + 1,
            F.coalesce(F.get(merged, i)["start"], F.length(text)) - F.when(i > 0, F.get(merged, i - 1)["end"]).otherwise(0),
        ),
    )
    return F.when(F.size(spans) > 0, F.array_join(pieces, mark)).otherwise(text)
