"""URL filters with redirect equivalence.

Explicit rules judge a URL by host and path.  Pages also name other URLs for
themselves: a meta refresh redirects, a canonical link points to the preferred
address.  URLs joined by such links are aliases; their components are found
with distributed joins, and a component's explicit decisions reach the members
that no rule judges.  An explicit allow takes precedence over a block, both on
the URL that a rule names and inside a component.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import lower_ascii, materialize
from tillroll.llm.components import connected_components

#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; NULL if there is none."""
    return F.when(F.instr(url, "://") > 0, F.expr("substring(__u, instr(__u, '://') + 3)"))


def host_and_path(df: DataFrame, url: str) -> DataFrame:
    """Adds host and path: the host follows the first ``://`` up to ``/``, ``?``,
    ``#`` or the end, A-Z lowered; the path follows up to ``?``, ``#`` or the
    end.  Both are empty for NULL and for URLs without ``://``."""
    rest = F.coalesce(_after_scheme(F.col("__u")), F.lit(""))
    return (df.withColumn("__u", F.col(url)).withColumn("__rest", rest)
            .withColumn("host", lower_ascii(F.regexp_extract("__rest", r"^[^/?#]*", 0)))
            .withColumn("path", F.regexp_extract("__rest", r"^[^/?#]*([^?#]*)", 1)).drop("__u", "__rest"))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest fitting rule, NULL if none fits.

    A rule fits its host and all subdomains if the path starts with the rule's
    path.  The length counts host and path; of equally long rules allow wins."""
    def fits(h, p):
        return ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
    ranked = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[2]))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, v in reversed(ranked):
        found = F.when(fits(h, p), F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))).otherwise(found)
    return found


def node_of(url: Column) -> Column:
    """Name of a URL as a graph node: without scheme and fragment, host lowered;
    NULL for a URL without ``://`` or host."""
    rest = F.regexp_extract(url, r"^.*?://([^#]*)", 1)
    host = F.regexp_extract(rest, r"^[^/?]*", 0)
    return F.when((F.instr(url, "://") > 0) & (host != ""),
                  F.concat(lower_ascii(host), F.regexp_extract(rest, r"^[^/?]*(.*)$", 1)))


def _absolute(base: Column, link: Column) -> Column:
    """A link of the page ``base`` as an absolute URL."""
    scheme = F.regexp_extract(base, r"^(.*?)://", 1)
    site = F.regexp_extract(base, r"^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"^(.*?://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    return (F.when(link.isNull() | (link == ""), None)
            .when(F.rlike(link, F.lit("^[A-Za-z][A-Za-z0-9+.-]*://")), link)
            .when(F.startswith(link, F.lit("//")), F.concat(scheme, F.lit(":"), link))
            .when(F.startswith(link, F.lit("/")), F.concat(site, link))
            .when(F.rlike(link, F.lit("^(?:[A-Za-z][A-Za-z0-9+.-]*:|#)")), None)
            .otherwise(F.concat(folder, F.when(F.endswith(folder, F.lit("/")), F.lit("")).otherwise(F.lit("/")), link)))


def _attribute(tag: Column, name: str) -> Column:
    """An attribute's value, in either kind of quotes or none."""
    return F.regexp_extract(tag, rf"""(?is)[\s"']{name}\s*=\s*(?:"\s*([^"]*?)\s*"|'\s*([^']*?)\s*'|([^\s"'>]+))""", 0)


def _value(attribute: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(attribute, r"(?is)^[\s\"']?[a-z-]+\s*=\s*", ""), r"""^["']\s*|\s*["']$""", ""))


def links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(a, b): a page's node and the node that it redirects to or calls canonical.

    Only tags before the body count.  NULL urls, pages and targets link nothing."""
    head = F.regexp_extract(F.col("__html"), r"(?is)^(.*?)(?:<body[\s>]|$(?![\r\n]))", 1)
    tags = F.regexp_extract_all(head, F.lit(r"(?is)<(?:link|meta)\s[^>]*>"), F.lit(0))
    found = (pages.select(F.col(url_col).alias("__url"), F.col(html_col).alias("__html"))
             .where(F.col("__url").isNotNull() & F.rlike("__html", F.lit(r"(?i)canonical|refresh")))
             .select("__url", F.explode(tags).alias("__tag")))
    def step(df, **columns):
        """Columns computed once: the generator keeps them from being copied
        into every expression that follows."""
        made = F.struct(*[c.alias(n) for n, c in columns.items()])
        return df.select("__url", F.explode(F.array(made)).alias("x")).select("__url", "x.*")

    tag = F.col("__tag")
    found = step(found, tag=tag, rel=_value(_attribute(tag, "rel")), href=_value(_attribute(tag, "href")),
                 equiv=F.lower(_value(_attribute(tag, "http-equiv"))), content=_value(_attribute(tag, "content")))
    canonical = F.rlike("tag", F.lit("(?i)^<link")) & F.rlike("rel", F.lit(r"(?i)(^|\s)canonical(\s|$)"))
    refresh = F.rlike("tag", F.lit("(?i)^<meta")) & (F.col("equiv") == "refresh")
    aim = F.regexp_replace(F.regexp_extract("content", r"(?is)url\s*=\s*(.*)$", 1), r"""^["']|["']$""", "")
    found = step(found, aim=F.regexp_replace(F.when(canonical, F.col("href")).when(refresh, aim), "&amp;", "&"))
    found = step(found, full=_absolute(F.col("__url"), F.col("aim")))
    found = step(found, a=node_of(F.col("__url")), b=node_of(F.col("full")))
    return found.select("a", "b").where("a is not null and b is not null and a <> b").distinct()


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules=RULES) -> DataFrame:
    """One row per page row: id, host, path, rule (NULL if no rule fits), verdict
    (allow or block) and by (rule, alias or default).

    A page that no rule judges takes its component's explicit decision (allow
    before block), else it is allowed.  NULL urls and urls without ``://`` have
    empty host and path and no aliases; equal rows share their fate; NULL html
    has no links.
    """
    edges = materialize(links(pages, url_col, html_col), "url-links")
    comp = connected_components(edges)
    judged = host_and_path(comp.withColumn("__full", F.concat(F.lit("x://"), "node")), "__full").withColumn(
        "v", rule_of(F.col("host"), F.col("path"), rules)["verdict"])
    decided = judged.groupBy("root").agg(F.max(F.col("v") == "allow").alias("ok"), F.max(F.col("v") == "block").alias("no"))
    alias = comp.join(decided, "root").select("node", F.when(F.col("ok"), "allow").when(F.col("no"), "block").alias("passed"))
    own = host_and_path(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("__url")), "__url")
    own = own.withColumn("r", rule_of(F.col("host"), F.col("path"), rules)).withColumn("node", node_of(F.col("__url")))
    return own.join(alias, "node", "left").select(
        "id", "host", "path", F.col("r.rule").alias("rule"),
        F.coalesce("r.verdict", "passed", F.lit("allow")).alias("verdict"),
        F.when(F.col("r.rule").isNotNull(), "rule").when(F.col("passed").isNotNull(), "alias").otherwise("default").alias("by"))
