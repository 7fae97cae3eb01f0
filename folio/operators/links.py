"""Link extraction and request filtering over page tables (narrow transforms; the
only join is with the rules, grouped by host)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions import text as T
from folio.functions import urls as U
from folio.operators.listing import A_ATTRS_RE, element_regex, href_of


def extract_links(pages: DataFrame, container: str = "nav", skip_first: int = 4, skip_last: int = 1,
                  url_col: str = "url", id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Anchors of the first ``container`` element (a tag, or ``tag.class``), positions [skip_first, n-skip_last),
    anchors without href dropped after counting, hrefs resolved against the page URL."""
    tag, _, css_class = container.partition(".")
    box = element_regex(tag, css_class or None)
    p = pages.select(id_col, url_col,
                     F.regexp_extract_all(F.regexp_extract(T.strip_raw_blocks(F.col(html_col)), box, 1),
                                          F.lit(A_ATTRS_RE), 1).alias("_a"))
    p = p.select(id_col, url_col, F.size("_a").alias("_n"), F.posexplode("_a").alias("link_pos", "_attrs"))
    p = p.where((F.col("link_pos") >= skip_first) & (F.col("link_pos") < F.col("_n") - skip_last))
    p = p.select(id_col, url_col, F.col("link_pos").cast("int").alias("link_pos"), href_of(F.col("_attrs")).alias("href"))
    p = p.where(F.col("href").isNotNull())
    return p.select(id_col, "link_pos", "href", U.join_url(F.col(url_col), F.col("href")).alias("link"))


def offsite_filter(links: DataFrame, domains: list[str], link_col: str = "link") -> DataFrame:
    """Keep links whose host is an allowed domain or one of its subdomains."""
    return links.where(U.in_domains(U.host(F.col(link_col)), domains))


def domain_table(domains: DataFrame, domain_col: str = "domain") -> DataFrame:
    """Allowed domains in lower case, each once and without those below another of them, so that a host has at most one."""
    own = domains.select(F.lower(F.regexp_replace(domain_col, r"^\.+|\.+\z", "")).alias("domain")).where("domain <> ''").distinct()
    above = own.select("domain", F.explode(F.slice(U.host_suffixes("domain"), 2, 1 << 20)).alias("parent"))
    covered = above.join(own.select(F.col("domain").alias("parent")), "parent", "left_semi").select("domain")
    return own.join(covered, "domain", "left_anti").checkpoint(eager=True)


def offsite_filter_table(links: DataFrame, domains: DataFrame, link_col: str = "link") -> DataFrame:
    """``offsite_filter`` for any number of domains, a ``domain_table``: each link's host suffixes meet it by one semi-join."""
    suffix = F.explode(U.host_suffixes(U.host(F.col(link_col))))
    return (links.withColumn("_suffix", suffix).join(domains.select(F.col("domain").alias("_suffix")), "_suffix", "left_semi")
            .select(*links.columns))


def dedupe_links(links: DataFrame, link_col: str = "link", order: tuple = ("page_id", "link_pos")) -> DataFrame:
    """One request per canonical URL (the first by page and position).

    A keyed min over a struct: partial aggregation runs map-side, so a hot
    URL never lands whole in one task."""
    canon = links.withColumn("canonical", U.canonical_url(F.col(link_col)))
    first = F.min(F.struct(*[F.col(c) for c in order], F.col(link_col).alias("_l")))
    g = canon.groupBy("canonical").agg(first.alias("_f"))
    return g.select("canonical", *[F.col(f"_f.{c}").alias(c) for c in order], F.col("_f._l").alias(link_col))


def _robots_rules(text: Column, agent: str) -> Column:
    """Rules array<struct<prefix, allow>> of one robots.txt for ``agent``.

    A fold over the lines: user-agent lines that follow each other head one group, the rules up to the next head
    are its own.  The groups that name the agent count; if there is none, those of ``*``."""
    line = F.transform(F.split(text, "\n", -1), lambda x: F.substring_index(x, "#", 1))
    pairs = F.transform(line, lambda x: F.struct(F.lower(T.py_strip(F.substring_index(x, ":", 1))).alias("k"),
                                                 T.py_strip(F.regexp_replace(x, r"^[^:]*:?", "")).alias("v")))
    rule = "array<struct<agents:array<string>,prefix:string,allow:boolean>>"
    none = F.array().cast("array<string>")
    init = F.struct(none.alias("agents"), F.lit(False).alias("ruled"), F.array().cast(rule).alias("rules"))

    def step(acc, x):
        name = F.array(F.lower(x["v"]))
        return (F.when(x["k"] == "user-agent", F.struct(
                    F.when(acc["ruled"], name).otherwise(F.concat(acc["agents"], name)).alias("agents"),
                    F.lit(False).alias("ruled"), acc["rules"].alias("rules")))
                .when(x["k"].isin("allow", "disallow"), F.struct(
                    acc["agents"].alias("agents"), F.lit(True).alias("ruled"),
                    F.when(x["v"] == "", acc["rules"]).otherwise(F.concat(acc["rules"], F.array(F.struct(
                        acc["agents"].alias("agents"), x["v"].alias("prefix"), (x["k"] == "allow").alias("allow"))))).alias("rules")))
                .otherwise(acc))

    rules = F.aggregate(pairs, init, step, lambda acc: acc["rules"])
    named = F.exists(pairs, lambda x: (x["k"] == "user-agent") & (F.lower(x["v"]) == agent.lower()))
    return F.transform(F.filter(rules, lambda r: F.array_contains(r["agents"], F.when(named, agent.lower()).otherwise("*"))),
                       lambda r: F.struct(r["prefix"].alias("prefix"), r["allow"].alias("allow")))


def parse_robots(robots: DataFrame, host_col: str = "host", text_col: str = "robots_txt", agent: str = "*") -> DataFrame:
    """robots.txt text per host -> (host, prefix, allow) rules that hold for ``agent``."""
    return robots.select(F.lower(host_col).alias("host"), F.inline(_robots_rules(F.col(text_col), agent)))


def _fits(path: Column, prefix: Column) -> Column:
    """``*`` in a rule stands for any characters, a last ``$`` for the end of the path."""
    ends = F.endswith(prefix, F.lit("$"))
    body = F.length(prefix) - ends.cast("int")
    quoted = F.transform(F.split(F.substr(prefix, F.lit(1), body), r"\*", -1),
                         lambda x: F.concat(F.lit("\\Q"), F.replace(x, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E")))
    pattern = F.concat(F.lit("(?s)^"), F.array_join(quoted, ".*"), F.when(ends, "\\z").otherwise(""))
    return F.when(ends | prefix.contains("*"), F.regexp_like(path, pattern)).otherwise(F.startswith(path, prefix))


def robots_filter(links: DataFrame, rules: DataFrame, link_col: str = "link") -> DataFrame:
    """Drop links disallowed by their host's rules: the longest matching rule wins, allow wins a tie; no
    matching rule means allowed.  Rules are grouped per host (a site's rules are one short file) and joined
    on host; Spark broadcasts them when they are small, and splits a host with many links when not."""
    per_host = rules.groupBy("host").agg(F.collect_list(F.struct("prefix", "allow")).alias("_rules"))
    s = U.split_url(F.col(link_col))
    path = F.concat(F.when(s["path"] == "", F.lit("/")).otherwise(s["path"]),
                    F.when(s["query"] != "", F.concat(F.lit("?"), s["query"])).otherwise(F.lit("")))
    j = links.withColumn("host", U.host(F.col(link_col))).withColumn("_path", path).join(per_host, "host", "left")
    hits = F.filter(F.coalesce(F.col("_rules"), F.array().cast("array<struct<prefix:string,allow:boolean>>")),
                    lambda r: _fits(F.col("_path"), r["prefix"]))
    best = F.array_max(F.transform(hits, lambda r: F.struct(F.length(r["prefix"]).alias("n"), r["allow"].alias("a"))))
    return j.where(best.isNull() | best["a"]).drop("_rules", "_path", "host")
