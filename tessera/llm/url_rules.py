"""URL filters: stated host and path rules, and association rules mined from labels.

A url is cut into tokens: scheme, last two and last three host labels, labels before them,
path parts (digits folded to ``#``), extension, query keys and fragment.  Spark's FP-growth mines the token combinations
of labelled urls; rules whose consequence is the block label are kept when they reach the
support and confidence bounds and no shorter rule inside them is as confident.  Rules are
matched through an inverted index: a rule is filed under its rarest token, every url looks
up its tokens there, and the few rules found are tested in full.

Stated rules (host, path, verdict) fit their host and all its subdomains when the url's
path starts with the rule's path; the longest wins and goes before mined rules.  They are met
by an equi-join on the host's suffixes.  A url that no rule fits is allowed.

All work is on distinct urls, joins and groupings; rows that share a url share its verdict.

Defined results: a null url, or one without ``://``, has an empty host and path and no
rule (verdict allow); repeated rows are each returned; without labelled urls of the block
class nothing is mined; other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import read_table
from tessera.operators.sizing import materialise

#: Bounds of mined rules: share and number of the labelled urls that support them, and share of
#: block labels among the urls that they fit.
MIN_SUPPORT, MIN_COUNT, MIN_CONFIDENCE = 0.002, 10, 0.6
BLOCK = "#block"

# Fixed stated rules of the query: host, path, verdict.
STATED = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
          ("org", "/fr/", "allow"))


def _after(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url: Column) -> Column:
    """Distinct tokens of a url, each with its kind."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, "\\.")
    front = F.slice(labels, 1, F.greatest(F.size(labels) - 3, F.lit(0)))
    parts = F.filter(F.split(F.regexp_replace(path, "[0-9]+", "#"), "/"), lambda p: p != "")
    query = F.regexp_extract(url, "\\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda q: q != ""), lambda q: F.substring_index(q, "=", 1))
    pick = lambda kind, col: F.transform(col, lambda x: F.concat(F.lit(kind + ":"), x))
    one = lambda kind, col: F.when(F.length(col) > 0, F.array(F.concat(F.lit(kind + ":"), col))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(
        one("scheme", F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1)),
        pick("label", F.filter(front, lambda x: x != "")),
        one("site", F.substring_index(host, ".", -3)), one("domain", F.substring_index(host, ".", -2)),
        pick("part", parts), one("ext", F.regexp_extract(path, "\\.([A-Za-z0-9]{1,8})$", 1)),
        pick("key", keys), one("frag", F.regexp_extract(url, "#(.+)$", 1)), one("end", F.when(path.endswith("/"), "slash"))))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
         min_count: int = MIN_COUNT) -> DataFrame:
    """(rule_id, items, anchor, confidence, support) from (items, block boolean).

    FP-growth counts the combinations over all labelled urls.  The anchor is the rarest
    token of the rule."""
    rows = labelled.select(F.when(F.col("block"), F.array_append("items", F.lit(BLOCK))).otherwise(F.col("items")).alias("items"))
    least = min(1.0, max(min_support, min_count / max(rows.count(), 1)))
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=min_confidence).fit(rows)
    rules = (model.associationRules.where((F.size("consequent") == 1) & (F.col("consequent")[0] == BLOCK))
             .select(F.array_sort("antecedent").alias("items"), "confidence", "support")
             .withColumn("rule_id", F.xxhash64("items")))
    counts = (model.freqItemsets.where(F.size("items") == 1)
              .select(F.col("items")[0].alias("token"), F.col("freq").alias("n")))
    anchor = (rules.select("rule_id", F.explode("items").alias("token")).join(counts, "token")
              .groupBy("rule_id").agg(F.min_by("token", F.struct("n", "token")).alias("anchor")))
    rules = materialise(rules.join(anchor, "rule_id"), "url-rules", measure=False).df
    # a rule goes when a rule inside it is at least as confident
    inside = (rules.select("rule_id", "items", "confidence", F.explode("items").alias("anchor"))
              .join(rules.select(F.col("rule_id").alias("r2"), F.col("items").alias("i2"), F.col("confidence").alias("c2"), "anchor"), "anchor")
              .where((F.size("i2") < F.size("items")) & (F.size(F.array_except("i2", "items")) == 0) & (F.col("c2") >= F.col("confidence")))
              .select("rule_id").distinct())
    return materialise(rules.join(inside, "rule_id", "left_anti"), "url-rules-kept", measure=False).df


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule_id, confidence): the most confident mined rule that fits each url."""
    found = (urls.select("url", "items", F.explode("items").alias("anchor"))
             .join(rules.select("rule_id", F.col("items").alias("needs"), "anchor", "confidence"), "anchor")
             .where(F.size(F.array_except("needs", "items")) == 0))
    return found.groupBy("url").agg(F.max(F.struct("confidence", "rule_id")).alias("m")).select("url", "m.rule_id", "m.confidence")


def stated(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, verdict) of the longest stated rule that fits; ``urls`` has url, host, path,
    ``rules`` has host, path, verdict.  Only suffixes with as many labels as some rule's host are
    looked up."""
    depths = [int(r[0]) for r in rules.select(F.size(F.split("host", "\\.")).alias("n")).distinct().collect()]
    if not depths:
        return urls.select("url", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict")).limit(0)
    suffixes = F.array_distinct(F.array(*[F.substring_index("host", ".", -k) for k in sorted(depths)]))
    r = rules.select(F.col("host").alias("suffix"), F.col("path").alias("start"), F.col("verdict"))
    hit = (urls.where(F.col("host") != "").select("url", "path", F.explode(suffixes).alias("suffix")).join(r, "suffix")
           .where(F.expr("startswith(path, start)")).withColumn("rule", F.concat("suffix", "start")))
    best = F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("m")
    return hit.groupBy("url").agg(best).select("url", "m.rule", "m.verdict")


def judge(pages: DataFrame, labels: DataFrame, rules: DataFrame, key: str = "page_id") -> DataFrame:
    """page_id, host, path, rule, verdict, confidence; ``labels`` has page_id and block (boolean)."""
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"))
    urls = rows.select("url").distinct().select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                                                tokens(F.col("url")).alias("items"))
    known = (rows.where(F.col("url") != "").join(labels.where(F.col("block").isNotNull()), "page_id")
             .select(tokens(F.col("url")).alias("items"), "block"))
    verdicts = urls.join(stated(urls, rules), "url", "left")
    if known.where("block").limit(1).count():
        verdicts = verdicts.join(match(urls, mine(known)), "url", "left")
    else:
        verdicts = verdicts.withColumn("rule_id", F.lit(None).cast("long")).withColumn("confidence", F.lit(None).cast("double"))
    out = verdicts.select("url", "host", "path", "rule",
                          F.coalesce("verdict", F.when(F.col("rule_id").isNotNull(), F.lit("block")), F.lit("allow")).alias("verdict"),
                          F.when(F.col("verdict").isNull(), F.col("rule_id")).alias("mined_rule"),
                          F.when(F.col("verdict").isNull(), F.col("confidence")).alias("confidence"))
    return rows.join(out, "url").select("page_id", "host", "path", "rule", "verdict", "mined_rule", "confidence")


def url_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of pages: a page is marked block when the label row of its number has quality 0
    or toxic 1."""
    labels = read_table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("long").alias("page_id"),
        ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("block"))
    labels = labels.groupBy("page_id").agg(F.max("block").alias("block"))
    rules = spark.createDataFrame(list(STATED), "host string, path string, verdict string")
    return judge(read_table(spark, sf_dir, "pages"), labels, rules)
