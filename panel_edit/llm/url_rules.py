"""URL filter: a rule list, and association rules mined from labelled URLs.

A rule of the list (host, path prefix) fits its host, all subdomains, and urls
whose path starts with its path; the longest fitting rule decides. Urls that no
rule fits are judged by association rules: FP-growth over the tokens of
labelled urls (bad where quality is 0 or toxic is 1) gives combinations of
tokens; those with enough support and confidence, and more confident than any
of their parts, block. They are matched by an inverted index from token to
rule: a rule matches where as many of its tokens are met as it has.

Everything is DataFrame expressions and Spark's own FP-growth.

Defined cases: a null url or one without ``://`` has an empty host and path, no
tokens, and is allowed; repeated rows are judged alike; without labels nothing
is mined and what no rule fits is allowed; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panel_edit.llm.common import keep

#: (verdict, host, path): the contract's rules.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
#: A combination counts from this share of the labelled urls (and so many of them), and blocks from this confidence.
MIN_SUPPORT, MIN_COUNT, MIN_CONFIDENCE = 0.002, 20, 0.6
BAD = "label=bad"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url, by the contract's definition."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, F.lit(at.cast("int") + 3), F.lit(1 << 30))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def listed(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as (rule, verdict), or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):  # a longer rule overrides
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens of a url: host labels and endings, path words and depth, query keys; numbers as a class."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    hosts = F.concat(F.transform(labels, lambda x: F.concat(F.lit("host:"), x)),
                     F.flatten(F.transform(labels, lambda x: F.transform(F.filter(F.split(x, "-"), lambda y: y != x), lambda y: F.concat(F.lit("part:"), y)))))
    words = F.transform(F.filter(F.split(F.lower(path), r"[/._-]"), lambda x: x != ""),
                        lambda x: F.concat(F.lit("path:"), F.when(x.rlike(r"^\d+$"), F.lit("#")).otherwise(x)))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("key:"), F.substring_index(x, "=", 1)))
    scheme = F.array(F.concat(F.lit("scheme:"), F.substring_index(F.coalesce(url, F.lit("")), "://", 1)))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(scheme, hosts, words, keys)))


def mined_rules(pages: DataFrame, labels: DataFrame, min_support: float = MIN_SUPPORT, min_count: int = MIN_COUNT,
                min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(items, confidence, support): token combinations that call for a block, of all tokens."""
    marks = (labels.select(F.col("doc_id").cast("bigint").alias("_id"), F.col("quality"), F.col("toxic"))
             .where("quality is not null or toxic is not null").groupBy("_id")
             .agg(F.max(((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).cast("int")).alias("bad")))
    host, path = parts(F.col("url"))
    rows = pages.select(F.col("page_id").cast("bigint").alias("_id"), tokens(host, path, F.col("url")).alias("tokens")).where(F.size("tokens") > 0).join(marks, "_id")
    rows = keep(rows.select("tokens", "bad"))
    empty = "items array<string>, confidence double, support double"
    n = rows.count()
    if n < min_count:
        return pages.sparkSession.createDataFrame([], empty)
    baskets = rows.select(F.concat("tokens", F.when(F.col("bad") == 1, F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=max(min_support, min_count / n), minConfidence=min_confidence).fit(baskets)
    rules = keep(model.associationRules.where(F.array_contains("consequent", BAD)).select(F.array_sort("antecedent").alias("items"), "confidence", "support"))
    return without_better_parts(rules)


def without_better_parts(rules: DataFrame) -> DataFrame:
    """Rules (items sorted, confidence, ...) of which no part is a rule that is as confident.

    Each rule looks up its own parts by their items, of which a rule of k tokens
    has fewer than 2**k; no two rules meet for sharing a token.
    """
    none = F.array().cast("array<array<string>>")
    every = F.aggregate("items", F.concat(none, F.array(F.array().cast("array<string>"))),
                        lambda found, x: F.concat(found, F.transform(found, lambda own: F.concat(own, F.array(x)))))
    parts_of = rules.select("items", "confidence", F.explode(F.filter(every, lambda own: (F.size(own) > 0) & (F.size(own) < F.size("items")))).alias("part"))
    known = rules.select(F.col("items").alias("part"), F.col("confidence").alias("part_confidence"))
    worse = parts_of.join(known, "part").where("part_confidence >= confidence").select("items").distinct()
    return rules.join(worse, "items", "left_anti")


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, **mining) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, and the number of mined rules that match."""
    index = mined_rules(pages, labels, **mining).select(F.xxhash64("items").alias("mined"), F.size("items").alias("need"), F.explode("items").alias("t"))
    host, path = parts(F.col("url"))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"))
    rows = rows.select("page_id", "url", host.alias("host"), path.alias("path")).withColumn("listed", listed(F.col("host"), F.col("path"), rules))
    # The mined rules see each url once, however many pages share it.
    open_ = rows.where(F.col("listed").isNull() & (F.col("host") != "")).select("url", "host", "path").distinct()
    met = open_.select("url", F.explode(tokens(F.col("host"), F.col("path"), F.col("url"))).alias("t")).join(index, "t")
    blocked = met.groupBy("url", "mined").agg(F.count(F.lit(1)).alias("have"), F.max("need").alias("need")).where("have = need").groupBy("url").agg(
        F.count(F.lit(1)).alias("mined_rules"))
    return rows.join(blocked, "url", "left").select(
        "page_id", "host", "path", F.col("listed.rule").alias("rule"),
        F.coalesce(F.col("listed.verdict"), F.when(F.col("mined_rules") > 0, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("mined_rules", F.lit(0)).alias("mined_rules"))
