"""URL filtering by association rules.

Labelled URLs become transactions of tokens (scheme, host suffixes, path segments, query keys and pairs,
fragment).  Tokens that stand in the very same labelled rows are one item.  An item that reaches the limits by itself is a rule; from the other items of the URLs to block,
Spark's FP-growth mines combinations.  Each one's confidence comes from counting it over all labelled rows.  For matching, each rule is listed in an inverted
index under the tokens of its rarest item; a URL's tokens are joined with the index and a found rule is compared whole.
Fixed rules (host, path prefix, verdict) come first: the longest that fits decides.

Support is a count of rows to block, the same for any size of input, so that rules from a few rows never pass and a bad
host has its rule however many other pages there are.  A combination that contains a rule of one token is left out, as it
fits no further URL.  Defined cases: a null
URL or one without ``://`` has empty host and path and no tokens, and is allowed unless a fixed rule fits; rows
that repeat a URL share its verdict; with no labelled rows there are no mined rules.  A label row counts once
for each page row of its id (the keys that join labels to pages are parameters); a null id or label is not used.  Only id and URL are read from the pages.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

MIN_COUNT, MIN_CONFIDENCE = 20, 0.8
# fixed values: the rules of the query's contract
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _part(url: Column, k: int) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, k), F.lit(""))


def host(url: Column) -> Column:
    return F.translate(_part(url, 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return _part(url, 2)


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL; empty for one without ``://``."""
    labels = F.split(host(url), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda k: F.concat(F.lit("h:"), F.array_join(F.slice(labels, k, F.size(labels)), ".")))
    listed = lambda text, by, name: F.transform(
        F.filter(F.split(text, by), lambda x: x != ""), lambda x: F.concat(F.lit(name), x))
    query = F.filter(F.split(_part(url, 3), "&"), lambda x: x != "")
    every = F.concat(
        F.array(F.concat(F.lit("s:"), F.lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1)))), suffixes,
        listed(path(url), "/", "p:"), listed(_part(url, 4), "\n", "f:"),
        F.transform(query, lambda x: F.concat(F.lit("q:"), x)),
        F.transform(query, lambda x: F.concat(F.lit("k:"), F.substring_index(x, "=", 1))))
    return F.when(url.contains("://"), F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def _classes(rows: DataFrame, min_count: int) -> DataFrame:
    """(token, members, n, bad): tokens that stand in the very same labelled rows are one item, named by its least token.

    Equal rows mean equal support and confidence in any combination, so the members stand for each other in every rule; without
    this, tokens that always come together would make all their subsets itemsets.  Row sets are compared by 128-bit digests."""
    seen = rows.select(F.explode("have").alias("token"), "n", "bad", F.xxhash64("have").alias("h1"), F.xxhash64(F.lit(1), "have").alias("h2"))
    single = (seen.groupBy("token").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("rows"),
                                        F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2")).where(F.col("bad") >= min_count))
    return (single.groupBy("n", "bad", "rows", "h1", "h2").agg(F.min("token").alias("token"), F.sort_array(F.collect_list("token")).alias("members"))
            .select("token", "members", "n", "bad"))  # members stand in one URL, so they are few


def mine(labelled: DataFrame, url_col: str = "url", bad: str = "bad", min_count: int = MIN_COUNT,
         min_confidence: float = MIN_CONFIDENCE) -> DataFrame | None:
    """The rules; None if too few rows are to block.

    ``antecedent`` names one token of each item, ``any_of`` all of them: a URL fits if it has a token of every item.
    ``anchors`` are the tokens of the rarest item (``anchor`` its name), by which the inverted index finds the rule."""
    rows = labelled.where(F.col(bad).isNotNull()).select(tokens(F.col(url_col)).alias("have"), F.col(bad).cast("int").alias("bad"))
    rows = stored(rows.where(F.size("have") > 0).groupBy("have").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad")), "url-rows")
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    if total.bad < max(1, min_count):
        return None
    confidence = F.col("bad") / F.col("n")
    limits = (confidence.alias("confidence"), (F.col("bad") / F.lit(total.n)).alias("support"))
    classes = stored(_classes(rows, min_count), "url-items")  # stored, so that Spark can split the joins of a frequent token
    alone = classes.where(confidence >= min_confidence).select(
        F.col("token").alias("anchor"), F.array("token").alias("antecedent"), F.array("members").alias("any_of"),
        F.col("members").alias("anchors"), *limits)
    rest = classes.where(confidence < min_confidence).select("token", "members", F.col("n").alias("freq"))
    items = (rows.where("bad > 0").select("have", "bad", F.explode("have").alias("token")).join(rest.select("token"), "token")
             .groupBy("have", "bad").agg(F.collect_list("token").alias("items"))
             .select("items", F.explode(F.sequence(F.lit(1).cast("bigint"), "bad"))).select("items"))
    n = items.count()
    if n < max(1, min_count):
        return alone
    model = FPGrowth(itemsCol="items", minSupport=max(0.5, min_count - 0.5) / n).fit(items)
    found = model.freqItemsets.where(F.size("items") > 1).select(F.array_sort("items").alias("antecedent"), F.col("freq").alias("bad"))
    rarest = F.min_by(F.struct("token", "members"), F.struct("freq", "token"))
    found = stored(found.withColumn("token", F.explode("antecedent")).join(rest, "token")
                   .groupBy("antecedent", "bad").agg(rarest.alias("r"), F.collect_list("members").alias("any_of"))
                   .select("antecedent", "bad", "any_of", F.col("r.token").alias("anchor"), F.col("r.members").alias("anchors")), "url-itemsets")
    counted = (rows.select("have", "n", F.explode("have").alias("anchor")).join(found.select("anchor", "antecedent"), "anchor")
               .where(F.size(F.array_except("antecedent", "have")) == 0)
               .groupBy("antecedent").agg(F.sum("n").alias("n")).join(found, "antecedent"))
    return alone.unionByName(counted.where(confidence >= min_confidence).select("anchor", "antecedent", "any_of", "anchors", *limits))


def mined_hits(urls: DataFrame, index: DataFrame, url_col: str = "url") -> DataFrame:
    """The distinct URLs that a mined rule fits, by the inverted index."""
    have = urls.select(F.col(url_col).alias("u")).where("u IS NOT NULL").distinct().withColumn("have", tokens(F.col("u")))
    found = have.withColumn("anchor", F.explode("have")).join(index.select(F.explode("anchors").alias("anchor"), "any_of"), "anchor")
    return found.where(F.forall("any_of", lambda c: F.arrays_overlap(c, F.col("have")))).select("u").distinct()


def fixed_rule(host_: Column, path_: Column, rules=RULES) -> Column:
    """The longest rule that fits, as struct (size, rule, verdict), or null; ``rules`` is configuration."""
    fits = [F.when(((host_ == h) | host_.endswith("." + h)) & path_.startswith(p),
                   F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
            for v, h, p in rules]
    return F.array_max(F.array(*fits))


def judge(pages: DataFrame, labelled: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
          **limits) -> DataFrame:
    """A row per page: id, host, path, rule, verdict, mined (whether a mined rule fits)."""
    index = mine(labelled, **limits)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    if index is None:
        rows = rows.withColumn("mined", F.lit(False))
    else:
        hits = mined_hits(rows, index).withColumn("hit", F.lit(True))
        rows = rows.join(hits, rows["url"] == hits["u"], "left").withColumn("mined", F.col("hit").isNotNull())
    at = rows.select("id", "mined", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    best = at.withColumn("best", fixed_rule(F.col("host"), F.col("path"), rules))
    return best.select(F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
                       F.coalesce("best.verdict", F.when(F.col("mined"), "block").otherwise("allow")).alias("verdict"), "mined")


def labelled_urls(pages: DataFrame, labels: DataFrame, page_key: str = "page_id", label_key: str = "doc_id") -> DataFrame:
    """(url, bad): URLs of pages whose key has a toxicity label; the keys are parameters, since tables differ in them."""
    marks = labels.where(F.col(label_key).isNotNull() & F.col("toxic").isNotNull())
    marks = marks.select(F.col(label_key).alias("_key"), (F.col("toxic") == 1).alias("bad"))
    return pages.select(F.col(page_key).alias("_key"), "url").join(marks, "_key").select("url", "bad")
