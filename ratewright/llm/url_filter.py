"""URL rules with redirect equivalence.

A page's own rule, if one fits, decides.  Pages without a rule take the verdict of the urls that they are the same as:
redirects (meta refresh) and canonical links are edges, their connected components are aliases; a component that holds an
explicitly allowed url is allowed, else one that holds a blocked url is blocked, else allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewright.llm.components import connected_components

RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK, _META = r"(?is)<link\b[^>]*>", r"(?is)<meta\b[^>]*>"
_CANONICAL = r"""(?is)\brel\s*=\s*("[^"]*\bcanonical\b|'[^']*\bcanonical\b|canonical\b)"""
_HREF = r"""(?is)\bhref\s*=\s*["']?\s*([^"'\s>]+)"""
_REFRESH = r"""(?is)\bhttp-equiv\s*=\s*["']?\s*refresh\b"""
_CONTENT = r"""(?is)\bcontent\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)"""
_URL = r"""(?is)\burl\s*=\s*["']?\s*([^"'\s>]+)"""
_SCHEME = r"(?s)^[A-Za-z][A-Za-z0-9+.-]*:"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null or without ://."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; empty for null or without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as struct(rule, verdict), else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def address(url: Column) -> Column:
    """What aliases are compared by: host, path and query, without scheme and fragment."""
    query = F.coalesce(F.regexp_extract(url, r"(?s)^[^#]*?(\?[^#]*)", 1), F.lit(""))
    return F.concat(host_of(url), path_of(url), query)


def targets_of(html: Column) -> Column:
    """The targets of canonical links and meta refreshes, as they are written but with &amp; decoded."""
    found = F.concat(
        F.transform(F.filter(F.regexp_extract_all(html, F.lit(_LINK), F.lit(0)), lambda t: t.rlike(_CANONICAL)), lambda t: F.regexp_extract(t, _HREF, 1)),
        F.transform(F.filter(F.regexp_extract_all(html, F.lit(_META), F.lit(0)), lambda t: t.rlike(_REFRESH)), lambda t: F.regexp_extract(F.regexp_extract(t, _CONTENT, 1), _URL, 1)),
    )
    return F.array_distinct(F.transform(F.filter(found, lambda t: t != ""), lambda t: F.replace(t, F.lit("&amp;"), F.lit("&"))))


def resolved(target: Column, host: Column, path: Column) -> Column:
    """A target on a page of that host and path as a url; null for fragments and for other schemes without ://, such as mailto."""
    own, rest = F.regexp_extract(target, r"(?s)^([^?#]*)", 1), F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1)
    folder = F.regexp_extract(path, r"(?s)^(.*/)", 1)
    joined = F.when(own.startswith("/"), own).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), own))
    joined = F.when(joined.rlike(r"(?s)/\.\.?$"), F.concat(joined, F.lit("/"))).otherwise(joined)
    parts = F.aggregate(
        F.split(F.substr(joined, F.lit(2)), "/"),
        F.array(F.lit("")),
        lambda done, s: F.when(s == ".", done).when((s == "..") & (F.size(done) > 1), F.slice(done, 1, F.size(done) - 1)).when(s == "..", done).otherwise(F.concat(done, F.array(s))),
    )
    url = F.when(target.startswith("?"), F.concat(F.lit("http://"), host, path, target)).otherwise(F.concat(F.lit("http://"), host, F.array_join(parts, "/"), rest))
    url = F.when(target.startswith("//"), F.concat(F.lit("http:"), target)).when(target.startswith("#") | target.rlike(_SCHEME), F.lit(None)).otherwise(url)
    return F.when(target.rlike(_SCHEME + "//"), target).otherwise(url)


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules=RULES) -> DataFrame:
    """All columns of `pages` but the html, and host, path, rule (null: none) and verdict (in place of columns of those names).

    Relative targets are resolved against the page; fragments and targets like mailto: are no edges.  Null urls have no host, no rule and
    no aliases, and are allowed.  Repeated urls are one node; repeated rows are all returned.
    """
    keep = [c for c in pages.columns if c not in (html_col, "host", "path", "rule", "verdict")]
    named = pages.select(F.struct(*keep).alias("row"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    named = named.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url")), "node": F.xxhash64(address(F.col("url")))})
    named = named.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    tags = F.col("html").rlike("(?i)canonical|refresh") & (F.col("host") != "")
    links = named.where(tags).select("node", "host", "path", F.explode(targets_of(F.col("html"))).alias("target"))
    links = links.select("node", resolved(F.col("target"), F.col("host"), F.col("path")).alias("to")).where("to is not null")
    links = links.select("node", F.xxhash64(address(F.col("to"))).alias("to"), rule_of(host_of(F.col("to")), path_of(F.col("to")), rules).alias("rule"))
    roots = connected_components(links, "node", "to").withColumnRenamed("node", "alias")
    judged = named.where("host <> ''").select("node", "rule").unionByName(links.select(F.col("to").alias("node"), "rule")).where("rule is not null")
    # 'allow' sorts before 'block', so the least verdict is the one with precedence
    verdicts = judged.join(roots, F.col("node") == F.col("alias")).groupBy("root").agg(F.min("rule.verdict").alias("inherited"))
    inherited = roots.join(verdicts, "root").select(F.col("alias").alias("node"), "inherited")
    out = named.select("row", "host", "path", "node", "rule").join(inherited, "node", "left")
    verdict = F.coalesce("rule.verdict", F.when(F.col("host") != "", F.col("inherited")), F.lit("allow"))
    return out.select(*(F.col("row")[c].alias(c) for c in keep), "host", "path", F.col("rule.rule").alias("rule"), verdict.alias("verdict"))
