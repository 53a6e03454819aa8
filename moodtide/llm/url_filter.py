"""URL filters: block and allow rules, carried to aliases over redirect and canonical-link edges."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.llm.common import ascii_lower, connected_components


@dataclass(frozen=True)
class Rule:
    verdict: str  # block or allow
    host: str
    path: str = "/"

    def __str__(self) -> str:
        return self.host + self.path


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _longest(rules: list[Rule], host: Column, path: Column, value) -> Column:
    out = None
    for rule in sorted(rules, key=lambda r: (-len(str(r)), str(r))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, value(rule)) if out is None else out.when(fits, value(rule))
    return out if out is not None else F.lit(None).cast("string")


def node(url: Column) -> Column:
    """The resource of a url: host, path and query without scheme and fragment; null without host."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    rest = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(host(url) != "", F.concat(host(url), rest))


_BLANKS = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z"

# start tags with a canonical link among their relations, and refresh tags
_CANONICAL = (
    r"(?is)<link\b[^>]*[\s\"'/]rel\s*=\s*(?:\"(?:[^\">]*\s)?canonical(?:\s[^\">]*)?\"[^>]*"
    r"|'(?:[^'>]*\s)?canonical(?:\s[^'>]*)?'[^>]*|canonical(?:[\s/][^>]*)?)>"
)
_REFRESH = r"(?is)<meta\b[^>]*[\s\"'/]http-equiv\s*=\s*[\"']?refresh\b[^>]*>"


def _attribute(tag: Column, name: str) -> Column:
    pattern = rf"(?is)[\s\"'/]{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
    value = F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])
    return F.replace(value, F.lit("&amp;"), F.lit("&"))


def _without_dots(path: Column) -> Column:
    """A path without its segments ``.`` and ``..`` (RFC 3986, 5.2.4)."""
    parts = F.split(path, "/", -1)

    def step(acc: Column, part: Column) -> Column:
        up = F.regexp_replace(acc, r"/[^/]*\z", "")
        return F.when(part == ".", acc).when(part == "..", up).otherwise(F.concat(acc, F.lit("/"), part))

    kept = F.aggregate(F.slice(parts, 2, F.size(parts)), F.lit(""), step)
    closed = F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(kept, F.lit("/"))).otherwise(kept)
    return F.when(F.contains(path, F.lit("/.")), closed).otherwise(path)


def resolve(target: Column, base: Column) -> Column:
    """The url that ``target`` names on a page at ``base`` (RFC 3986, 5.2), without fragment.

    Null where it names the page itself (empty or a fragment only) or no resource with a host
    (``mailto:`` and the like).
    """
    t = F.regexp_replace(F.regexp_replace(target, _BLANKS, ""), r"(?s)#.*\z", "")
    t = F.when(F.startswith(t, F.lit("//")), F.concat(F.regexp_extract(base, r"(?s)^(.*?):", 1), F.lit(":"), t)).otherwise(t)
    site = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(path(base), r"(?s)^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    own = F.regexp_extract(t, r"(?s)^([^?]*)", 1)
    query = F.regexp_extract(t, r"(?s)^[^?]*(.*)\z", 1)
    merged = F.when(own == "", path(base)).when(F.startswith(own, F.lit("/")), own).otherwise(F.concat(folder, own))
    return (
        F.when(F.coalesce(t, F.lit("")) == "", F.lit(None))
        .when(
            t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"),
            F.concat(F.regexp_extract(t, r"(?s)^(.*?://[^/?]*)", 1), _without_dots(path(t)), query),
        )
        .when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .otherwise(F.concat(site, _without_dots(merged), query))
    )


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst) urls: canonical links and immediate redirects (refresh tags) of each page.

    The first of each kind outside comments counts; targets are resolved against the page's url.
    """
    page = F.regexp_replace(F.coalesce(F.col(html), F.lit("")), r"(?s)<!--.*?-->", "")
    canonical = F.regexp_extract("page", _CANONICAL, 0)
    refresh = F.regexp_extract("page", _REFRESH, 0)
    to = F.regexp_extract(_attribute(refresh, "content"), r"(?is)^[\s\d.;,]*url\s*=\s*['\"]?([^'\"]+)", 1)
    targets = F.array(_attribute(canonical, "href"), to)
    found = pages.select(F.col(url).alias("src"), page.alias("page")).select("src", F.explode(targets).alias("target"))
    return found.filter("target <> ''").select("src", resolve(F.col("target"), F.col("src")).alias("dst"))


def judge(
    pages: DataFrame,
    rules: list[Rule],
    edges: DataFrame | None = None,
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    The longest rule that fits a url decides it. A url without a rule takes the decision of its
    aliases, the component of ``edges(src, dst)`` that it lies in: allow if an alias is explicitly
    allowed, else block if one is blocked, else ``default``. Aliases that are no page count too.
    Null urls and urls without ``://`` have empty host and path, fit no rule and get ``default``;
    repeated pages are judged alike; an empty table gives an empty result. Columns of ``pages`` that
    bear one of the four names are replaced.
    """
    u = F.col(url)
    pages = pages.drop("host", "path", "rule", "verdict")
    own = pages.withColumns({"host": host(u), "path": path(u)})
    own = own.withColumns(
        {
            "rule": _longest(rules, F.col("host"), F.col("path"), lambda r: F.lit(str(r))),
            "verdict": _longest(rules, F.col("host"), F.col("path"), lambda r: F.lit(r.verdict)),
        }
    )
    if edges is None:
        return own.withColumn("verdict", F.coalesce("verdict", F.lit(default)))
    roots = connected_components(edges.select(node(F.col("src")).alias("src"), node(F.col("dst")).alias("dst")), "urls")
    as_url = F.concat(F.lit("http://"), F.col("node"))
    ruled = roots.withColumn(
        "said", _longest(rules, host(as_url), path(as_url), lambda r: F.lit(r.verdict))
    )
    decided = (
        ruled.groupBy("root")
        .agg(F.max(F.col("said") == "allow").alias("allow"), F.max(F.col("said") == "block").alias("block"))
        .select("root", F.expr("CASE WHEN allow THEN 'allow' WHEN block THEN 'block' END").alias("by_alias"))
        .filter("by_alias IS NOT NULL")
    )
    inherited = roots.join(decided, "root").select(F.col("node").alias("_node"), "by_alias")
    return (
        own.withColumn("_node", node(u))
        .join(inherited, "_node", "left")
        .withColumn("verdict", F.coalesce("verdict", "by_alias", F.lit(default)))
        .drop("_node", "by_alias")
    )
