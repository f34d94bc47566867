"""URL filters by association rules.

Stated rules (host, path; the longest fitting one wins) decide the urls they fit; these urls are the labelled ones. Their tokens and
label are mined by Spark's FP-growth; rules that lead to a label, have enough support and confidence and are no longer than another rule
that says the same as surely, decide the other urls: each rule stands in an inverted index under its rarest tokens, a url's tokens
are looked up there, and of the rules that fit, the surest, then best supported, then longest one decides. Without
any, the commoner label does (``allow`` on a tie or without labels).

Sets of tokens are many where tokens go together, as the parameters of a query do, but few of them say anything new. So before
mining, tokens that occur in the same labelled urls become one class: any of them stands for the others in a rule. Classes that
occur under one label only are rules as they are, and no rule that holds one with others is surer; the others are mined. What is
mined is the same as from all sets of tokens. (Classes that occur under both labels in nearly, but not quite, the same urls still
give all their frequent sets.)

FP-growth counts over all labelled urls in Spark; only frequent tokens and rules, which the support bounds, are ever listed.

Defined cases: a url that is null or has no ``://`` has an empty host and path and no tokens, no rule fits it; empty tables give no rows;
repeated rows are judged one by one; columns besides page_id and url are not read.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import written

#: (host, path, verdict).
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.8
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def stated(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule's text and verdict; null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: labels of the host, words of labels with hyphens, path parts (digits as #), query keys and pairs, fragment, scheme."""
    def tagged(kind: str, items: Column) -> Column:
        return F.transform(F.filter(items, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))

    labels = F.split(host, "\\.")
    parts = F.transform(F.split(path, "/"), lambda x: F.regexp_replace(F.lower(x), "[0-9]+", "#"))
    query = F.split(F.regexp_replace(F.regexp_extract(url, r"(?s)\?([^#]*)", 1), "[0-9]{3,}", "#"), "&")
    hyphen = F.split(F.concat_ws("-", F.filter(labels, lambda x: x.contains("-"))), "-")
    found = F.concat(
        tagged("host=", labels), tagged("word=", hyphen), tagged("path=", parts), tagged("query=", query),
        tagged("key=", F.transform(query, lambda x: F.split(x, "=")[0])),
        tagged("fragment=", F.array(F.regexp_extract(url, r"(?s)#(.*)$", 1))), tagged("scheme=", F.array(F.lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1)))),
    )
    return F.when(host != "", F.array_distinct(found)).otherwise(F.array().cast("array<string>"))


def classes(labelled: DataFrame, least: int) -> DataFrame:
    """From (row, tokens, label): one row per class of tokens that the same rows have, at least so many of them under one label.

    name (its first token), members, freq, and says, its only label (null: it has both).
    """
    each = labelled.select("row", "label", F.explode("tokens").alias("token"))
    # Which rows: 128 bits, whose order does not matter.
    same = [F.bit_xor(F.xxhash64(F.lit(seed), "row")).alias(f"rows{seed}") for seed in (71, 72)]
    block = F.count_if(F.col("label") == "block")
    counted = each.groupBy("token").agg(F.count("*").alias("freq"), block.alias("block"), *same).where(F.greatest("block", F.col("freq") - F.col("block")) >= least)
    found = counted.groupBy("freq", "block", "rows71", "rows72").agg(F.min("token").alias("name"), F.collect_set("token").alias("members"))
    return found.select("name", "members", "freq", F.when(F.col("block") == 0, "allow").when(F.col("block") == F.col("freq"), "block").alias("says"))


def mined(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """From (row, tokens, label): rules (antecedent, says, confidence, support, key), without those a shorter rule makes needless.

    The antecedent is a list of classes (lists of tokens): a url fits if it has a token of each. key: the tokens of its rarest class.
    """
    n = labelled.count()
    known = written(classes(labelled, math.ceil(min_support * n)), "url-classes")
    both = known.where("says is null").select("name", F.explode("members").alias("token"))
    inside = labelled.select("row", F.explode("tokens").alias("token")).join(both, "token").groupBy("row").agg(F.collect_set("name").alias("items"))
    label = F.array(F.concat(F.lit("label="), F.col("label")))
    baskets = labelled.select("row", "label").join(inside, "row", "left").select(F.when(F.col("items").isNull(), label).otherwise(F.concat("items", label)).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.where(F.col("consequent")[0].startswith("label=")).select(F.array_sort("antecedent").alias("antecedent"), F.substring(F.col("consequent")[0], 7, 100).alias("says"), "confidence", "support")
    rules = written(rules.where(~F.exists("antecedent", lambda x: x.startswith("label="))), "url-rules")
    # A rule is needless if one with a class less says the same with no less confidence.
    less = rules.select("antecedent", "says", "confidence", F.posexplode("antecedent").alias("at", "gone")).select(
        F.col("antecedent").alias("longer"), "says", "confidence", F.array_remove("antecedent", F.col("gone")).alias("antecedent"))
    short = rules.select("antecedent", "says", F.col("confidence").alias("sure"))
    needless = less.join(short, ["antecedent", "says"]).where("sure >= confidence").select(F.col("longer").alias("antecedent"), "says").distinct()
    rules = rules.join(needless, ["antecedent", "says"], "left_anti")
    pure = known.where("says is not null").select(F.array("name").alias("antecedent"), "says", F.lit(1.0).alias("confidence"), (F.col("freq") / F.lit(n)).alias("support"))
    each = rules.unionByName(pure).select("antecedent", "says", "confidence", "support", F.explode("antecedent").alias("name")).join(known.drop("says"), "name")
    lists = each.groupBy("antecedent", "says", "confidence", "support").agg(F.collect_list("members").alias("classes"), F.min_by("members", F.struct("freq", "name")).alias("key"))
    return lists.select(F.col("classes").alias("antecedent"), "says", "confidence", "support", "key")


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, mined_rule (tokens of the rule that decided) and confidence."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    df = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = stated(F.col("host"), F.col("path"), rules)
    df = df.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("said"), tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"), F.monotonically_increasing_id().alias("row"))
    df = written(df, "url-pages")
    labelled = df.where("said is not null").select("row", "tokens", F.col("said").alias("label"))
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    common = "block" if counts.get("block", 0) > counts.get("allow", 0) else "allow"
    none = F.lit(None).cast("string")
    if not counts:
        return df.select("page_id", "host", "path", "rule", F.coalesce("said", F.lit(common)).alias("verdict"), none.alias("mined_rule"), F.lit(None).cast("double").alias("confidence"))
    index = written(mined(labelled), "url-index")
    asked = df.where("said is null").select("row", "tokens", F.explode("tokens").alias("token")).join(index.withColumn("token", F.explode("key")), "token")
    hit = asked.where(F.forall("antecedent", lambda c: F.arrays_overlap(c, "tokens")))
    # Of a class the url's last token stands in the rule's text.
    shown = F.array_join(F.array_sort(F.transform("antecedent", lambda c: F.array_max(F.array_intersect(c, "tokens")))), " ")
    order = F.struct(F.col("confidence"), F.col("support"), F.size("antecedent").alias("classes"), shown.alias("shown"), F.col("says"))
    best = hit.groupBy("row").agg(F.max(order).alias("best")).select("row", F.col("best.says").alias("mined"), F.col("best.shown").alias("mined_rule"), F.col("best.confidence").alias("confidence"))
    found = df.join(best, "row", "left")
    return found.select("page_id", "host", "path", "rule", F.coalesce("said", "mined", F.lit(common)).alias("verdict"), "mined_rule", "confidence")
