"""URL filters with redirect equivalence.

Rules decide a url by its host and path. Urls joined by a redirect or a
canonical link are aliases of one resource: connected components over those
edges carry a block to every alias that no rule decides. A rule on the url
itself always wins, so an explicit allow keeps its url inside a blocked
component.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonlab.llm.common import cut
from seasonlab.llm.components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _part(url: Column, pattern: str) -> Column:
    """A group of what follows the first ``://``; empty if there is none or the url is null."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://" + pattern, 1), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(_part(url, "([^/?#]*)"), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return _part(url, "[^/?#]*([^?#]*)")


def _without_dots(path: Column) -> Column:
    """A path without ``.`` and ``..`` segments."""
    steps = F.aggregate(
        F.slice(F.split(path, "/"), F.lit(2), F.size(F.split(path, "/"))), F.array().cast("array<string>"),
        lambda done, step: F.when(step == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when(step == ".", done).otherwise(F.concat(done, F.array(step))),
    )
    whole = F.concat(F.lit("/"), F.array_join(steps, "/"), F.when(path.rlike(r"/\.\.?$") & (F.size(steps) > 0), F.lit("/")).otherwise(F.lit("")))
    return F.when(path.rlike(r"^/(.*/)?\.\.?(/|$)"), whole).otherwise(path)


def alias_of(url: Column) -> Column:
    """The node of a url: host, path without dot segments (``/`` if empty) and query, without scheme and fragment; null if it has no host."""
    path = path_of(url)
    path = F.when(path == "", F.lit("/")).otherwise(_without_dots(path))
    return F.when(host_of(url) != "", F.concat(host_of(url), path, _part(url, r"[^/?#]+[^?#]*(\?[^#]*)")))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """``(name, verdict)`` of the longest rule that fits (ties: the longer host, then the smaller name); null if none does.

    The rules are configuration, a literal list of the caller's.
    """
    if not rules:
        return F.lit(None).cast("struct<name:string,verdict:string>")
    ordered = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.name))
    table = F.array(*(
        F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"), F.lit(r.host).alias("host"), F.lit(r.path).alias("path"))
        for r in ordered
    ))
    fits = F.filter(table, lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"]))) & F.startswith(path, r["path"]))
    first = F.get(fits, F.lit(0))
    return F.when(first.isNotNull(), F.struct(first["name"].alias("name"), first["verdict"].alias("verdict")))


def _decoded(link: Column) -> Column:
    """An attribute's value without character references: numbers of ASCII characters and the names of markup."""
    numbers = F.array_distinct(F.regexp_extract_all(link, F.lit(r"(?i)&#(?:x0*[0-7]?[0-9a-f]|0*1?[0-9]?[0-9]);?"), F.lit(0)))

    def code(ref: Column) -> Column:
        digits = F.regexp_extract(ref, r"(?i)&#x?([0-9a-f]+)", 1)
        return F.when(F.lower(ref).startswith("&#x"), F.conv(digits, 16, 10)).otherwise(digits).cast("int")

    plain = F.aggregate(numbers, link, lambda done, ref: F.when(code(ref) < 128, F.replace(done, ref, F.char(code(ref)))).otherwise(done))
    link = F.when(link.contains("&#"), plain).otherwise(link)
    for name, character in (("quot", '"'), ("apos", "'"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        link = F.replace(link, F.lit(f"&{name};"), F.lit(character))
    return F.trim(link)


def _absolute(link: Column, base: Column) -> Column:
    """A reference as an absolute url, seen from another one; null if it names that one itself or isn't a web address."""
    host = F.concat(F.lit("http://"), host_of(base))
    path = F.when(path_of(base) == "", F.lit("/")).otherwise(path_of(base))
    folder = F.regexp_extract(path, r"^(?s)(.*/)", 1)
    return (
        F.when((link == "") | link.startswith("#"), F.lit(None))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(F.lit("http:"), link))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(link.startswith("/"), F.concat(host, link))
        .when(link.startswith("?"), F.concat(host, path, link))
        .otherwise(F.concat(host, folder, link))
    )


def page_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(src, dst)`` urls: all canonical links and meta refresh targets that a page names, outside comments and scripts.

    References are resolved as a browser does: from the page's first ``<base href>``, else from
    its url, with character references decoded; dot segments go when a url becomes a node.
    """
    attribute = r"""(?is)\s{0}\s*=\s*["']?\s*([^"'\s>]+)"""
    rel = r"""(?is)[\s"']rel\s*=\s*(?:"(?:[^">]*\s)?canonical[\s"]|'(?:[^'>]*\s)?canonical[\s']|canonical[\s/>])"""

    def named(tag: str, holds: str, target: str) -> Column:
        found = F.regexp_extract_all("__html", F.lit(rf"(?is)<{tag}\b[^>]*>"), F.lit(0))
        return F.transform(F.filter(found, lambda x: F.regexp_like(x, F.lit(holds))), lambda x: F.regexp_extract(x, target, 1))

    canonical = named("link", rel, attribute.format("href"))
    refresh = named("meta", r"""(?is)\bhttp-equiv\s*=\s*["']?refresh\b""", r"""(?is)\burl\s*=\s*["']?\s*([^"'\s>]+)""")
    rows = pages.select(F.col(url_col).alias("src"), F.col(html_col).alias("__html"))
    rows = rows.where(F.col("src").isNotNull() & F.col("__html").rlike(r"(?i)canonical|http-equiv"))
    rows = rows.withColumn("__html", F.regexp_replace("__html", r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\b|\z)", " "))
    first_base = F.regexp_extract("__html", r"""(?is)<base\b[^>]*\shref\s*=\s*["']?\s*([^"'\s>]+)""", 1)
    base = F.coalesce(_absolute(_decoded(first_base), F.col("src")), F.col("src"))
    rows = rows.select("src", base.alias("__base"), F.explode(F.concat(canonical, refresh)).alias("__link"))
    rows = rows.select("src", "__base", _decoded(F.col("__link")).alias("__link"))
    return rows.select("src", _absolute(F.col("__link"), F.col("__base")).alias("dst")).where("dst IS NOT NULL")


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], *, id_col: str = "page_id", url_col: str = "url", html_col: str | None = "html",
    redirects: DataFrame | None = None, default: str = "allow",
) -> DataFrame:
    """``(id, host, path, rule, verdict)`` for every row.

    Edges are the canonical links and meta refreshes in ``html_col`` plus the
    ``(src, dst)`` urls of ``redirects``. A row's verdict is its own rule's; else
    ``block`` if any url of its component is blocked by a rule, else ``default``.

    A null url, or one without ``://``, has an empty host and path, no aliases
    and gets ``default`` (no rule has an empty host). Null html has no edges.
    Repeated rows get a row each; other columns are not read.
    """
    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    own = own.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), alias_of(F.col("url")).alias("__node"))
    own = own.withColumn("__fit", matching_rule(F.col("host"), F.col("path"), rules))
    own = own.select("page_id", "host", "path", F.col("__fit.name").alias("rule"), F.col("__fit.verdict").alias("__own"), "__node")

    edges = page_edges(pages, url_col, html_col) if html_col else None
    if redirects is not None:
        given = redirects.select(F.col("src").cast("string"), F.col("dst").cast("string"))
        edges = given if edges is None else edges.union(given)
    if edges is None:
        return own.select("page_id", "host", "path", "rule", F.coalesce("__own", F.lit(default)).alias("verdict"))

    ends = edges.select(alias_of(F.col("src")).alias("src"), alias_of(F.col("dst")).alias("dst"))
    members = connected_components(ends, "src", "dst")
    # a node is host + path + query: as a url again it is judged by the same rules
    url = F.concat(F.lit("http://"), F.col("node"))
    blocked = members.where(matching_rule(host_of(url), path_of(url), rules)["verdict"] == "block").select("component").distinct()
    blocked = cut(members.join(blocked, "component", "left_semi").select(F.col("node").alias("__node"), F.lit(True).alias("__blocked")))
    judged = own.join(blocked, "__node", "left")
    spread = F.when(F.col("__blocked"), F.lit("block")).otherwise(F.lit(default))
    return judged.select("page_id", "host", "path", "rule", F.coalesce("__own", spread).alias("verdict"))
