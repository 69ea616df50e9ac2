"""URL filter: rules first, gradient-boosted trees for the rest.

A rule is a host and a path prefix; it fits the host and its subdomains, and the longest fitting rule
decides.  Urls that a rule decides are the labelled ones: boosted trees (MLlib) learn from them what blocked
urls look like, and decide the urls without a rule.  The features are lexical: lengths, depth, digit
ratio, entropy, counts of parameters and signs, and the shares of blocked urls with the same domain suffix or file suffix
(smoothed; counted for every suffix there is and joined to the urls, a suffix without labels having the overall share).

Null urls and urls without ``://`` have an empty host and path and no rule.  Repeated rows are judged
alike.  Without labelled urls of both kinds, what no rule decides is allowed.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import saved

PRIOR_URLS = 5  # the overall share counts as so many urls of every suffix
ROUNDS, DEPTH = 12, 3


class Rule(NamedTuple):
    verdict: str  # "allow" or "block"
    host: str
    path: str  # with the leading slash


# The rules of the registered query.
RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FEATURES = ["length", "host_length", "path_length", "depth", "labels", "digits", "entropy", "parameters", "signs",
            "domain_share", "file_share"]


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for a null and without ``://``."""
    has = F.coalesce(url.contains("://"), F.lit(False))
    rest = F.expr("substring(__url, locate('://', __url) + 3)")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return (
        F.when(has, F.translate(host, _UPPER, _UPPER.lower())).otherwise(""),
        F.when(has, path).otherwise(""),
    )


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """``struct(size, rule, verdict)`` of the longest rule that fits, else null."""
    if not rules:
        return F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    table = F.array(
        *[
            F.struct(
                F.lit(len(r.host + r.path)).alias("size"), F.lit(r.host + r.path).alias("rule"),
                F.lit(r.verdict).alias("verdict"), F.lit(r.host).alias("host"), F.lit(r.path).alias("path"),
            )
            for r in rules
        ]
    )
    fits = F.filter(
        table,
        lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"]))) & F.startswith(path, r["path"]),
    )
    return F.array_max(fits)


def _features(frame: DataFrame) -> DataFrame:
    url, path = F.coalesce("__url", F.lit("")), F.col("path")
    size = F.greatest(F.length(url), F.lit(1))
    chars = F.array_distinct(F.split(url, ""))
    each = F.transform(chars, lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / size)
    entropy = F.aggregate(each, F.lit(0.0), lambda sum_, p: sum_ - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    return frame.withColumns(
        {
            "length": F.length(url).cast("double"),
            "host_length": F.length("host").cast("double"),
            "path_length": F.length(path).cast("double"),
            "depth": F.regexp_count(path, F.lit("/")).cast("double"),
            "labels": F.regexp_count("host", F.lit("[.]")).cast("double"),
            "digits": F.regexp_count(url, F.lit("[0-9]")) / size,
            "entropy": entropy,
            "parameters": F.regexp_count(url, F.lit("[?&][^=&#]+=")).cast("double"),
            "signs": F.regexp_count(url, F.lit("[-_%~@]")).cast("double"),
            "domain": F.substring_index("host", ".", -1),
            "file": F.regexp_extract(path, "[.]([A-Za-z0-9]+)$", 1),
        }
    )


def shares(labelled: DataFrame, suffix: str, overall: float) -> DataFrame:
    """``suffix`` and ``<suffix>_share``: the smoothed share of blocked urls of every suffix with labels."""
    share = (F.sum("label") + PRIOR_URLS * overall) / (F.count("*") + PRIOR_URLS)
    return labelled.groupBy(suffix).agg(share.alias(f"{suffix}_share"))


def decided(table: DataFrame, rules: list[Rule], *, id: str = "page_id", url: str = "url") -> DataFrame:
    """Per row: ``__id``, ``__url``, ``host``, ``path`` and ``found``, a struct with the rule's text and verdict, or null."""
    rows = table.select(F.col(f"`{id}`").alias("__id"), F.col(f"`{url}`").cast("string").alias("__url"))
    host, path = parts(F.col("__url"))
    rows = rows.withColumn("host", host).withColumn("path", path)
    return rows.withColumn("found", rule_for(F.col("host"), F.col("path"), rules))


def judge(table: DataFrame, rules: list[Rule], *, id: str = "page_id", url: str = "url") -> DataFrame:
    """Per row: the id, ``host``, ``path``, ``rule`` (or null), ``verdict`` and ``blocked`` (the trees' probability)."""
    rows = _features(decided(table, rules, id=id, url=url))
    labelled = rows.where("found is not null").withColumn("label", F.expr("if(found.verdict = 'block', 1.0D, 0.0D)"))
    labelled = saved(labelled.drop("__id", "__url", "found"), "labelled")
    total = labelled.agg(F.avg("label").alias("share")).first().share
    out = [F.col("__id").alias(id), "host", "path", F.col("found.rule").alias("rule")]
    if total is None or total in (0.0, 1.0):
        rows = rows.withColumn("blocked", F.lit(0.0))
    else:
        for suffix in ("domain", "file"):
            known = saved(shares(labelled, suffix, total), "shares")
            share = {f"{suffix}_share": F.coalesce(f"{suffix}_share", F.lit(total))}
            labelled = labelled.join(known, suffix, "left").withColumns(share)
            rows = rows.join(known, suffix, "left").withColumns(share)
        vector = VectorAssembler(inputCols=FEATURES, outputCol="features")
        trees = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, seed=7)
        model = trees.fit(vector.transform(labelled).select("features", "label"))
        scored = model.transform(vector.transform(rows))
        rows = scored.withColumn("blocked", vector_to_array("probability")[1])
    learned = F.when(F.col("blocked") > 0.5, "block").otherwise("allow")
    return rows.select(*out, F.coalesce("found.verdict", learned).alias("verdict"), "blocked")
