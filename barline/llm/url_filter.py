"""Operator 10: URL rules spread over redirect equivalence. DataFrame functions only.

A page's canonical link and its refresh redirect make its address and the
target aliases. Aliases form classes by distributed connected components
(``components.py``). A page's own rule decides. A page without a rule is
blocked if an address of its class is blocked by a rule, unless another one of
the class is explicitly allowed: an explicit allow takes precedence. All other
pages are allowed.

Addresses are compared without fragment and without dot segments (RFC 3986,
5.2.4), with scheme and host in lower case; this form names classes only. Rules
see a page's host and path as its url has them, dot segments included. Targets
may be absolute or relative to the page or to its first <base href>; targets that
are no pages carry their own rule into the class, absolute ones as they are
written, relative ones as they resolve. Only the address column is read for
verdicts; html is read once, for the links.

Edge cases: a null address or one without "://" has empty host and path and no
aliases; null html has no links; repeated pages are judged each; pages without
links need no class; an empty table gives no rows. Very long addresses and html
are read whole, by the regular expressions of their row alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .components import connected_components
from .quality_rules import let

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
LINK_TAG, META_TAG = r"(?is)<link\b[^>]*>", r"(?is)<meta\b[^>]*>"
CANONICAL = r"(?is)\brel\s*=\s*(?:\"[^\">]*\bcanonical\b|'[^'>]*\bcanonical\b|canonical\b)"
REFRESH = r"(?is)\bhttp-equiv\s*=\s*[\"']?\s*refresh\b"
HREF = r"(?is)\bhref\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)"
BASE_TAG = r"(?is)<base(?=[\s/>])[^>]*>"
DOTS = r"(?s)/\.\.?(?:/|\z)"
REFRESH_URL = r"(?is)\bcontent\s*=\s*[\"']?[^\"'>]*?\burl\s*=\s*[\"']?([^\"'>\s]+)"

#: (host, path, allow): a rule fits its host and all subdomains if the path starts with the rule's.
RULES = [("net", "/", False), ("example.net", "/en/", True), ("example.com", "/de/", False), ("org", "/fr/", True)]


def lower(c: Column) -> Column:
    return F.translate(c, CAPITALS, CAPITALS.lower())


def host_of(url: Column) -> Column:
    return lower(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, bool]]) -> Column:
    """The longest rule that fits, as host + path; null if none. Of equal length the one that sorts first."""
    out = F.lit(None).cast("string")
    for h, p, _ in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))[::-1]:
        out = F.when(((host == h) | host.endswith(f".{h}")) & path.startswith(p), F.lit(h + p)).otherwise(out)
    return out


def allowed_by(rule: Column, rules: list[tuple[str, str, bool]]) -> Column:
    """What the rule says: true to allow; null without a rule."""
    return F.when(rule.isin([h + p for h, p, ok in rules if ok]), True).when(rule.isNotNull(), False)


def without_dots(path: Column) -> Column:
    """A path, empty or from a slash on, without its . and .. segments."""
    none = F.array().cast("array<string>")

    def step(kept, x):
        return F.when(x == ".", kept).when(x == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))).otherwise(F.concat(kept, F.array(x)))

    def shorter(p):
        kept = let(F.split(p, "/"), lambda x: F.aggregate(F.slice(x, 2, F.size(x)), none, step))
        folder = F.when(p.rlike(r"/\.\.?\z"), F.array(F.lit(""))).otherwise(none)
        return F.when(p.rlike(DOTS), F.concat(F.lit("/"), F.array_join(F.concat(kept, folder), "/"))).otherwise(p)

    return let(path, shorter)


def address(url: Column) -> Column:
    """The form in which addresses are compared."""
    def parts(bare):
        return let(F.struct(F.regexp_extract(bare, "(?s)^.*?://[^/?#]*", 0).alias("head"), path_of(bare).alias("path")), lambda x: F.concat(
            lower(x["head"]), without_dots(x["path"]), F.substr(bare, F.length(x["head"]) + F.length(x["path"]) + 1)))

    return let(F.regexp_replace(url, "(?s)#.*$", ""), parts)


def resolved(url: Column, target: Column) -> Column:
    """A target, as seen from ``url``, as (address, form that rules see); both null for one that leads nowhere."""
    def absolute(x):
        url, t = x["url"], x["t"]
        scheme, root = F.regexp_extract(url, "(?s)^(.*?):\\/\\/", 1), F.regexp_extract(url, "(?s)^.*?://[^/?#]*", 0)
        path = path_of(url)
        folder = F.regexp_extract(F.when(path == "", F.lit("/")).otherwise(path), "(?s)^.*/", 0)
        return (F.when(t.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), t)
                .when(t.startswith("//"), F.concat(scheme, F.lit(":"), t))
                .when(t.startswith("#"), url)
                .when((t == "") | t.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
                .when(t.startswith("/"), F.concat(root, t))
                .when(t.startswith("?"), F.concat(root, path, t))
                .otherwise(F.concat(root, folder, t)))

    def both(x):
        own = x["t"].rlike("^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//")
        return let(absolute(x), lambda a: F.struct(address(a).alias("address"), F.when(own, a).otherwise(address(a)).alias("seen")))

    t = F.trim(F.replace(F.regexp_replace(target, "^[\"']|[\"']$", ""), F.lit("&amp;"), F.lit("&")))
    return let(F.struct(url.alias("url"), t.alias("t")), both)


def links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, seen) of canonical links and refresh redirects: two addresses, and the target as rules see it."""
    df = pages.select(F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html")).filter(F.instr("url", "://") > 0)
    low = F.col("html")
    canonical = F.transform(F.filter(F.regexp_extract_all("html", F.lit(LINK_TAG), F.lit(0)), lambda t: t.rlike(CANONICAL)),
                            lambda t: F.regexp_extract(t, HREF, 1))
    refresh = F.transform(F.filter(F.regexp_extract_all("html", F.lit(META_TAG), F.lit(0)), lambda t: t.rlike(REFRESH)),
                          lambda t: F.regexp_extract(t, REFRESH_URL, 1))
    df = df.filter(low.rlike("(?i)canonical|refresh"))  # most pages have neither
    hrefs = F.filter(F.transform(F.regexp_extract_all("html", F.lit(BASE_TAG), F.lit(0)), lambda t: F.regexp_extract(t, HREF, 1)), lambda h: h != "")
    return (df.select("url", F.try_element_at(hrefs, F.lit(1)).alias("base"), F.explode(F.concat(canonical, refresh)).alias("target"))
            .select("url", F.coalesce(resolved(F.col("url"), F.col("base"))["address"], F.col("url")).alias("base"), "target")
            .select(address(F.col("url")).alias("src"), resolved(F.col("base"), F.col("target")).alias("to"))
            .select("src", F.col("to.address").alias("dst"), F.col("to.seen").alias("seen")).filter("dst is not null and src <> dst"))


def judge(pages: DataFrame, rules: list[tuple[str, str, bool]] | None = None, id_col: str = "page_id",
          url_col: str = "url", html_col: str = "html", redirects: DataFrame | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict (allow or block).
    ``redirects`` may add (src, dst) addresses known from elsewhere."""
    rules = RULES if rules is None else rules
    url = F.col("url")
    df = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"))
    df = df.select("page_id", address(url).alias("node"), host_of(url).alias("host"), path_of(url).alias("path"))
    df = df.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))

    found = stored(links(pages, url_col, html_col), "links")
    seen = found.select(F.col("dst").alias("node"), "seen")
    if redirects is not None:
        ends = redirects.select("src", "dst")
        found = found.select("src", "dst").union(ends.select(address(F.col("src")), address(F.col("dst"))))
        seen = seen.union(ends.select(address(F.col("src")), "src")).union(ends.select(address(F.col("dst")), "dst"))
    classes = stored(connected_components(found), "aliases")
    ruled = df.select("node", allowed_by(F.col("rule"), rules).alias("ok")).union(
        seen.select("node", allowed_by(rule_of(host_of(F.col("seen")), path_of(F.col("seen")), rules), rules).alias("ok")))
    said = classes.join(ruled.filter("ok is not null").distinct(), "node").groupBy("component").agg(F.max(~F.col("ok")).alias("blocked"), F.max("ok").alias("allowed"))
    bad = classes.join(said.filter("blocked and not allowed"), "component").select("node")
    judged = df.join(bad.withColumn("alias_blocked", F.lit(True)), "node", "left")
    own = allowed_by(F.col("rule"), rules)
    allowed = F.coalesce(own, ~F.coalesce("alias_blocked", F.lit(False)))
    return judged.select("page_id", "host", "path", "rule", F.when(allowed, "allow").otherwise("block").alias("verdict"))
