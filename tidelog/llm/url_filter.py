"""URL filtering in which redirects and canonical links carry a block to every alias of a page. DataFrame work only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import components, staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
INLINE_RULES = 256


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"


PRODUCTION_RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    """After the first :// up to /, ? or #, A-Z in lower case; empty for null and for a url without ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ? or #; empty for null and for a url without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def with_node(df: DataFrame, url: str, name: str) -> DataFrame:
    """df with what counts as one page: host, path and query of url, without scheme and fragment; null without a host."""
    host, rest = host_of(F.col(url)), F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    node = F.concat(host, F.when(F.startswith(rest, F.lit("/")), rest).otherwise(F.concat(F.lit("/"), rest)))
    return df.withColumn(name, F.when(host != "", node))


def with_rule(df: DataFrame, rules: tuple[Rule, ...] | list[Rule], host: str, path: str, name: str) -> DataFrame:
    """df with the longest rule that fits, as struct (size, rule, verdict), or null.

    Of equally long rules that fit, the greater text counts. Up to INLINE_RULES rules are part of the expression and
    need no shuffle; more are joined by every suffix of the host, once per distinct host and path.
    """
    if not rules:
        return df.withColumn(name, F.lit(None).cast("struct<size:int,rule:string,verdict:string>"))
    if len(rules) <= INLINE_RULES:
        listed = F.array(*[F.struct(F.lit(len(r.text)).alias("size"), F.lit(r.text).alias("rule"),
                                    F.lit(r.verdict).alias("verdict"), F.lit(r.host).alias("host"),
                                    F.lit(r.path).alias("path")) for r in rules])
        fitting = F.filter(listed, lambda r: (
            ((F.col(host) == r.host) | F.endswith(F.col(host), F.concat(F.lit("."), r.host)))
            & F.startswith(F.col(path), r.path)))
        best = F.array_max(F.transform(fitting, lambda r: F.struct(r.size.alias("size"), r.rule.alias("rule"),
                                                                   r.verdict.alias("verdict"))))
        return df.withColumn(name, best)
    rows = df.sparkSession.createDataFrame(
        [(r.host, r.path, len(r.text), r.text, r.verdict) for r in rules],
        "rule_host string, rule_path string, size int, rule string, verdict string")
    places = df.select(F.col(host).alias("h"), F.col(path).alias("p")).distinct()
    labels = F.split("h", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)),
                        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    best = (
        places.withColumn("tail", F.explode(tails)).join(rows, F.col("tail") == F.col("rule_host"))
        .filter(F.startswith(F.col("p"), F.col("rule_path")))
        .groupBy("h", "p").agg(F.max(F.struct("size", "rule", "verdict")).alias("best_rule")))
    out = df.alias("d").join(best.alias("b"), (F.col(f"d.{host}") == F.col("b.h")) & (F.col(f"d.{path}") == F.col("b.p")),
                             "left")
    return out.select("d.*", F.col("b.best_rule").alias(name))


def _attribute(tag: Column, name: str) -> Column:
    found = [F.regexp_extract(tag, rf"(?is)\s{name}\s*=\s*{form}", 1)
             for form in (r'"([^"]*)"', r"'([^']*)'", r"""([^\s"'>]+)""")]
    return F.coalesce(*[F.when(x != "", x) for x in found])


def page_links(pages: DataFrame) -> DataFrame:
    """(src, dst) nodes: the canonical links and meta refreshes of (url, html), resolved against the page's url.

    Comments do not count. Targets are absolute, relative to the scheme, the host or the folder; dot segments stay.
    """
    tags = F.regexp_extract_all(F.regexp_replace("html", r"(?s)<!--.*?-->", ""), F.lit(r"(?is)(<(?:link|meta)\s[^>]*>)"), 1)
    found = (
        pages.select("url", "html").filter(F.col("html").rlike(r"(?i)canonical|refresh") & (host_of(F.col("url")) != ""))
        .select("url", F.explode(tags).alias("tag"))
        .select("url", F.when(
            F.col("tag").rlike(r"(?i)^<link") & F.lower(_attribute(F.col("tag"), "rel")).rlike(r"(^|\s)canonical(\s|$)"),
            _attribute(F.col("tag"), "href"),
        ).when(
            F.col("tag").rlike(r"(?i)^<meta") & (F.lower(_attribute(F.col("tag"), "http-equiv")) == "refresh"),
            F.regexp_extract(_attribute(F.col("tag"), "content"), r"""(?i)url\s*=\s*['"]?([^'"]+)""", 1),
        ).alias("to")))
    found = staged(found.select("url", F.trim(F.replace(F.col("to"), F.lit("&amp;"), F.lit("&"))).alias("to")).filter("to != ''"))
    to, url = F.col("to"), F.col("url")
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    base = F.concat(scheme, F.lit("://"), host_of(url))
    folder = F.regexp_extract(F.concat(F.lit("/"), path_of(url)), r"^/?(/.*/|/)", 1)
    target = (
        F.when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), to)
        .when(F.startswith(to, F.lit("//")), F.concat(scheme, F.lit(":"), to))
        .when(F.startswith(to, F.lit("/")), F.concat(base, to))
        .when(to.rlike(r"^([A-Za-z][A-Za-z0-9+.-]*:|#)"), None)
        .when(F.startswith(to, F.lit("?")), F.concat(base, path_of(url), to))
        .otherwise(F.concat(base, folder, F.regexp_replace(to, r"^\./", ""))))
    resolved = staged(found.select("url", target.alias("target")))
    return with_node(with_node(resolved, "url", "src"), "target", "dst").filter("dst is not null").select("src", "dst")


def filter_urls(pages: DataFrame, rules: tuple[Rule, ...] | list[Rule], redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and by of each page (page_id, url, html).

    A page with a rule of its own has that rule's verdict (by is "rule"). Others share what their redirect group
    holds: allow if any alias is allowed by a rule, else block if any is blocked, alias targets that are no page
    included ("alias"). The rest is allowed ("none"). redirects (from_url, to_url) adds edges known from a crawl.
    Null urls and urls without :// have no host, no links and no rule. Repeated rows are judged alike.
    """
    links = page_links(pages)
    if redirects is not None:
        known = with_node(with_node(redirects.select("from_url", "to_url"), "from_url", "src"), "to_url", "dst")
        links = links.union(known.select("src", "dst"))
    groups = components(links.filter("src is not null and dst is not null"))
    url = F.concat(F.lit("//://"), F.col("node"))
    judged = with_rule(groups.withColumn("node_host", host_of(url)).withColumn("node_path", path_of(url)),
                       rules, "node_host", "node_path", "own")
    shared = staged(
        judged.groupBy("component").agg(F.min("own.verdict").alias("shared"))  # allow comes before block
        .filter("shared is not null"))
    aliases = groups.join(shared, "component").select("node", "shared")
    named = with_node(pages.select("page_id", "url"), "url", "page_node")
    own = with_rule(named.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                                 "page_node"), rules, "host", "path", "own")
    out = own.alias("p").join(aliases.alias("a"), F.col("p.page_node") == F.col("a.node"), "left")
    verdict = F.coalesce("p.own.verdict", "a.shared", F.lit("allow"))
    return out.select("p.page_id", "p.host", "p.path", F.col("p.own.rule").alias("rule"), verdict.alias("verdict"),
                      F.when(F.col("p.own").isNotNull(), "rule").when(F.col("a.shared").isNotNull(), "alias")
                      .otherwise("none").alias("by"))
