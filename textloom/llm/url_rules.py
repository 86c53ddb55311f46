"""URL filters: fixed host rules first, then association rules learned from labelled URLs.

URLs are sets of tokens (host labels, path parts, query names). FP-growth finds token sets
that come with one label; rules of enough support and confidence are kept. A rule is
posted in an inverted index under its rarest token; a URL looks up its tokens and checks
the other tokens of each rule it finds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.tables import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A rule holds for this share of the labelled URLs, and for this share of those with its tokens.
LEAST_SUPPORT = 0.005
LEAST_CONFIDENCE = 0.95
#: ... and for this many of them at least; and its confidence is this many times the share of its verdict.
LEAST_URLS = 10
LEAST_LIFT = 1.1


@dataclass(frozen=True)
class HostRule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# Fixed values.
HOST_RULES = (HostRule("block", "net", "/"), HostRule("allow", "example.net", "/en/"),
              HostRule("block", "example.com", "/de/"), HostRule("allow", "org", "/fr/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or for a null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[HostRule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; nulls if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        name, verdict = F.when(fits, rule.text).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL, marked with where they stand; numbers are one token."""
    def marked(mark: str, parts: Column) -> Column:
        cleaned = F.transform(parts, lambda p: F.regexp_replace(F.lower(p), "[0-9]+", "0"))
        return F.transform(F.filter(cleaned, lambda p: p != ""), lambda p: F.concat(F.lit(mark), p))

    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda q: F.substring_index(q, "=", 1))
    scheme = F.array(F.substring_index(F.coalesce(url, F.lit("")), "://", 1))
    return F.array_distinct(F.concat(marked("scheme:", scheme), marked("host:", F.split(host, r"\.")),
                                     marked("path:", F.split(path, "[/.]")), marked("query:", names)))


def mine_rules(labelled: DataFrame, least_support: float = LEAST_SUPPORT,
               least_confidence: float = LEAST_CONFIDENCE, least_urls: int = LEAST_URLS) -> DataFrame:
    """``(tokens, verdict, confidence, support)`` from ``labelled (tokens, verdict)``.

    Tokens in all of the URLs are left out of the sets: a set holds for the same URLs without them. A rule must hold
    for the share ``least_support`` of the URLs and for ``least_urls`` of them. Every part of a rule holds for as many, so sets
    that do not are left out while they are mined, which gives the same rules as to drop them afterwards. A rule is
    pruned by confidence too, by its lift (it must say more than the
    share of its verdict), and if a part of it already has its confidence.
    """
    n = labelled.count()
    if n < max(1, least_urls):                                  # no rule can hold for so many
        return labelled.sparkSession.createDataFrame(
            [], "tokens array<string>, verdict string, confidence double, support double")
    least_support = max(least_support, (least_urls - 0.5) / n)  # half a URL less: the product with n may round up
    counts = (labelled.select(F.explode("tokens").alias("token")).groupBy("token").count()
              .where((F.col("count") >= least_support * n) & (F.col("count") < n)))
    useful = [row["token"] for row in counts.select("token").collect()]     # 1 / least_support a URL token at most
    known = F.array(*[F.lit(t) for t in sorted(useful)]).cast("array<string>")
    baskets = labelled.select(F.concat(F.array_intersect("tokens", known),
                                       F.array(F.concat(F.lit("="), "verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=least_support, minConfidence=least_confidence).fit(baskets)
    rules = model.associationRules.where(F.get("consequent", F.lit(0)).startswith("=")
                                         & ~F.exists("antecedent", lambda t: t.startswith("=")) & (F.col("lift") >= LEAST_LIFT))
    found = stored(rules.select(F.array_sort("antecedent").alias("tokens"),
                                F.substring(F.get("consequent", F.lit(0)), 2, 1000).alias("verdict"),
                                "confidence", "support"), "rules")
    parts = found.select("tokens", "verdict", "confidence", "support", F.explode(F.concat(
        F.transform("tokens", lambda t: F.array_except("tokens", F.array(t))))).alias("part"))
    better = (parts.join(found.select(F.col("tokens").alias("part"), "verdict",
                                      F.col("confidence").alias("part_confidence")), ["part", "verdict"])
              .where("part_confidence >= confidence").select("tokens", "verdict"))
    return found.join(better, ["tokens", "verdict"], "left_anti").select("tokens", "verdict", "confidence", "support")


def inverted_index(rules: DataFrame) -> DataFrame:
    """Every rule under the one of its tokens that the fewest rules have: ``(token, tokens, ...)``."""
    posted = rules.withColumn("token", F.explode("tokens"))
    uses = posted.groupBy("token").agg(F.count("*").alias("uses"))
    rarest = F.min_by("token", F.struct("uses", "token"))
    keyed = (posted.join(uses, "token").groupBy("tokens", "verdict", "confidence", "support")
             .agg(rarest.alias("token")))
    return stored(keyed, "index")


def match_rules(urls: DataFrame, index: DataFrame) -> DataFrame:
    """``(url, verdict)`` of the best rule that a URL of ``urls (url, tokens)`` meets; others are left out.

    Best: highest confidence, then support, then ``block`` before ``allow``.
    """
    looked_up = urls.withColumn("token", F.explode("tokens")).withColumnRenamed("tokens", "own")
    met = looked_up.join(index, "token").where(F.size(F.array_except("tokens", "own")) == 0)
    best = F.max(F.struct("confidence", "support", F.when(F.col("verdict") == "block", 1).otherwise(0).alias("b"),
                          F.col("verdict").alias("v")))
    return met.groupBy("url").agg(best["v"].alias("learned"))


def judge_urls(pages: DataFrame, labels: DataFrame | None = None, rules: Sequence[HostRule] = HOST_RULES,
               least_support: float = LEAST_SUPPORT, least_confidence: float = LEAST_CONFIDENCE,
               least_urls: int = LEAST_URLS) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for each row of ``pages (page_id, url)``.

    Verdicts of the host rules come first. They label their URLs, and ``labels (url,
    verdict)`` adds more; association rules learned from these judge the URLs without a
    rule, and a URL that meets none is allowed. A rule holds for at least the share ``least_support`` of the labelled URLs and for
    ``least_urls`` of them; the second is what counts below ``least_urls / least_support`` URLs. Every distinct URL is judged once.
    Null URLs and URLs without ``://`` have an empty host and path and are allowed.
    Repeated rows get the same verdict, one row each; other columns are ignored.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url").withColumn("host", host).withColumn("path", path)
    name, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = stored(rows.withColumn("rule", name).withColumn("ruled", verdict), "pages")

    distinct = rows.where("host <> ''").groupBy("url").agg(
        F.first("host").alias("host"), F.first("path").alias("path"), F.first("ruled").alias("ruled"))
    urls = stored(distinct.select("url", url_tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"),
                                  "ruled"), "urls")
    labelled = urls.where("ruled is not null").select("tokens", F.col("ruled").alias("verdict"))
    if labels is not None:
        known = labels.where("url is not null and verdict is not null").select("url", "verdict")
        labelled = labelled.unionByName(urls.select("url", "tokens").join(known, "url").select("tokens", "verdict"))
    index = inverted_index(mine_rules(labelled, least_support, least_confidence, least_urls))
    learned = stored(match_rules(urls.where("ruled is null").select("url", "tokens"), index), "learned")
    return (rows.join(learned, "url", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("ruled", "learned", F.lit("allow")).alias("verdict")))
