"""URL verdicts by host and path rules, carried to redirect and canonical aliases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.components import components
from termloom.llm.storage import stored

LINK = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\burl\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z lower-cased; empty without :// or for NULL."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def node_of(url: Column) -> Column:
    """The form under which equivalent spellings meet: no scheme, fragment, tracking or last slash."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^(utm_|ref=)"))
    rest = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(kept), "&"))).otherwise("")
    return F.concat(host_of(url), F.regexp_replace(path_of(url), "/+$", ""), rest)


def declared_edges(pages: DataFrame) -> DataFrame:
    """(src, dst) URLs of canonical links and immediate refreshes in the pages' HTML."""
    some = pages.filter("url is not null and html is not null").filter(F.col("html").rlike("(?i)canonical|http-equiv"))
    goals = F.concat(F.regexp_extract_all("html", F.lit(LINK), 1), F.regexp_extract_all("html", F.lit(REFRESH), 1))
    absolute = F.when(F.col("to").contains("://"), F.col("to"))
    site = F.regexp_extract("url", r"(?s)^.*?://[^/?#]*", 0)
    absolute = F.coalesce(absolute, F.when(F.col("to").startswith("/"), F.concat(site, "to")))
    edges = some.select("url", F.explode(goals).alias("to")).select(F.col("url").alias("src"), absolute.alias("dst"))
    return edges.filter("dst is not null")


def rule_of(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of the longest fitting rule of each host and path that has one."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    fit = keys.filter("host <> ''").withColumn("rule_host", F.explode(suffixes)).join(rules, "rule_host").filter(F.col("path").startswith(F.col("rule_path")))
    name = F.concat("rule_host", "rule_path")
    best = F.max(F.struct(F.char_length(name).alias("len"), (F.col("verdict") == "allow").alias("allow"), name.alias("rule"), "verdict"))
    return fit.groupBy("host", "path").agg(best.alias("b")).select("host", "path", "b.rule", "b.verdict")


def judge(pages: DataFrame, rules: DataFrame, edges: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page.

    rules: (rule_host, rule_path, verdict). The longest rule decides (at equal length allow); a page
    without one takes its component's decision over `edges` (src, dst URLs): allow if any alias has
    an allow rule, else block if any has a block rule, else allow. Spellings of one URL are one node;
    ends of edges count with their own rule even if no page has that URL. A NULL or malformed URL has
    no host and no alias and is allowed. Repeated pages are judged alike; without rules all is allowed.
    """
    pages = pages.select("page_id", "url")
    keyed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), node_of(F.col("url")).alias("node"))
    aliases = edges.select("src", "dst").filter("src is not null and dst is not null")
    ends = aliases.select(F.col("src").alias("url")).union(aliases.select(F.col("dst").alias("url")))
    ends = ends.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), node_of(F.col("url")).alias("node")).filter("host <> ''")
    every = keyed.select("host", "path", "node").filter("host <> ''").union(ends).distinct()
    ruled = stored(rule_of(every.select("host", "path").distinct(), rules))
    links = aliases.select(node_of(F.col("src")).alias("a"), node_of(F.col("dst")).alias("b"))
    comps = components(links)
    # A node in no edge is its own component: spellings of one URL share decisions as well.
    seeds = every.join(ruled, ["host", "path"]).join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    groups = seeds.groupBy("component").agg(F.max(F.when(F.col("verdict") == "allow", 1).otherwise(0)).alias("allowed"))
    out = keyed.join(ruled.withColumnRenamed("verdict", "own"), ["host", "path"], "left").join(comps, "node", "left")
    out = out.withColumn("component", F.coalesce("component", "node")).join(groups, "component", "left")
    carried = F.when(F.col("allowed") == 0, "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("own", carried).alias("verdict"))
