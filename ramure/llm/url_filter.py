"""URL filters: rules of hosts and paths, and association rules of URL tokens mined with FP-growth for URLs that no rule fits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ramure.llm.common import stored

# Rules as (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LABEL = "verdict="


def host_of(url: Column) -> Column:
    """What stands between the first `://` and the next `/`, `?`, `#` or the end, A-Z lower-cased; empty if there is none."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _CAPITALS, _SMALL)


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits: its host or a subdomain of it, and a path that starts with its path; else null."""
    found = None
    for verdict, rule_host, rule_path in sorted(rules, key=lambda rule: (-len(rule[1] + rule[2]), rule)):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = (F if found is None else found).when(fits, value)
    return found


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL: its top-level domain, other host labels, their parts if hyphenated, path segments, query pairs.

    Numbers in paths are replaced by a sign, so pages of a site share tokens. No token follows from another one alone, which keeps the
    frequent sets few.
    """
    labels = F.filter(F.split(host, r"\."), lambda label: label != "")
    others = F.slice(labels, 1, F.greatest(F.size(labels) - 1, F.lit(0)))
    parts = F.flatten(F.transform(F.filter(others, lambda label: label.contains("-")), lambda label: F.split(label, "-")))
    segments = F.filter(F.split(F.regexp_replace(path, r"\d+", "0"), "/"), lambda segment: segment != "")
    query = F.split(F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1), "&")

    def named(prefix: str, values: Column) -> Column:
        return F.transform(F.filter(values, lambda value: value != ""), lambda value: F.concat(F.lit(prefix), value))

    return F.array_distinct(F.concat(
        named("top:", F.slice(labels, -1, 1)), named("label:", others), named("part:", parts), named("segment:", segments),
        named("query:", query)))


def mine_rules(labelled: DataFrame, support: float = 0.01, confidence: float = 0.8, least_rows: int = 10) -> DataFrame:
    """Association rules (tokens, verdict, confidence, support) from rows with `tokens` and `verdict`.

    FP-growth finds sets of tokens and verdict that occur in at least a share `support` of the rows, and in `least_rows`; a rule's tokens imply its verdict
    in at least a share `confidence` of the rows that have them, however many they are. Rules that add tokens to a rule of the same verdict
    without gaining confidence are left out.
    """
    baskets = labelled.select(F.array_union("tokens", F.array(F.concat(F.lit(_LABEL), F.col("verdict")))).alias("items"))
    rows = baskets.count()
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(support, (least_rows - 0.5) / max(rows, 1))), minConfidence=confidence).fit(baskets)
    rules = stored(model.associationRules.where(F.element_at("consequent", 1).startswith(_LABEL)
                                                & ~F.exists("antecedent", lambda token: token.startswith(_LABEL)))
                   .select(F.array_sort("antecedent").alias("tokens"), F.substring(F.element_at("consequent", 1), len(_LABEL) + 1, 99)
                           .alias("verdict"), "confidence", "support"), "rules")
    # a shorter rule is found by each token that a longer one could leave out
    shorter = rules.select(F.col("tokens").alias("less"), F.col("verdict"), F.col("confidence").alias("before"))
    leaving = rules.select("tokens", "verdict", "confidence", F.explode("tokens").alias("without")).select(
        "tokens", "verdict", "confidence", F.array_except("tokens", F.array("without")).alias("less"))
    needless = leaving.join(shorter, ["less", "verdict"]).where("before >= confidence").select("tokens", "verdict").distinct()
    return rules.join(needless, ["tokens", "verdict"], "left_anti")


def match_rules(urls: DataFrame, rules: DataFrame, key: str = "row") -> DataFrame:
    """(key, verdict, confidence) of the best rule whose tokens a URL all has: most confident, then most frequent, then block first.

    Inverted index: each rule is listed under its rarest token only, and the rest of its tokens are looked up in the URL's own.
    """
    ranked = stored(rules.select(F.explode("tokens").alias("token"), "tokens", "verdict", "confidence", "support"), "index")
    common = ranked.groupBy("token").agg(F.count("*").alias("listed"))
    index = (ranked.join(common, "token").groupBy("tokens", "verdict", "confidence", "support")
             .agg(F.min(F.struct("listed", "token"))["token"].alias("token")))
    found = (urls.select(key, F.col("tokens").alias("own"), F.explode("tokens").alias("token")).join(stored(index, "index"), "token")
             .where(F.size(F.array_except("tokens", "own")) == 0))
    return (found.groupBy(key).agg(F.max(F.struct("confidence", "support", "verdict")).alias("best"))
            .select(key, F.col("best.verdict").alias("verdict"), F.col("best.confidence").alias("confidence")))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, support: float = 0.01, confidence: float = 0.8,
               default: str = "allow", url: str = "url", key: str = "page_id") -> DataFrame:
    """(key, url, host, path, rule, verdict, confidence) of every row.

    Where one of `rules` fits, the longest gives the verdict. Those rows are the labelled ones: association rules mined from their
    tokens judge the others, and `default` those that no mined rule fits. Null and relative urls have empty hosts and paths; repeated
    rows and null keys stay; without a labelled row the default holds.
    """
    parsed = pages.select(F.col(key), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    ruled = parsed.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    rows = stored(ruled.select(key, "url", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("known"),
                               url_tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens")), "urls")
    labelled = rows.where("known IS NOT NULL").select("tokens", F.col("known").alias("verdict"))
    mined = mine_rules(labelled, support, confidence)
    # equal sets of tokens are judged once
    distinct = rows.where("known IS NULL").select("tokens").distinct().withColumn("row", F.xxhash64("tokens"))
    judged = stored(match_rules(distinct, mined), "judged")
    columns = (key, "url", "host", "path", "rule")
    # rows that a rule fits stay where they are
    left = rows.where("known IS NULL").withColumn("row", F.xxhash64("tokens")).join(judged, "row", "left")
    return (rows.where("known IS NOT NULL").select(*columns, F.col("known").alias("verdict"), F.lit(None).cast("double").alias("confidence"))
            .union(left.select(*columns, F.coalesce("verdict", F.lit(default)).alias("verdict"), "confidence")))
