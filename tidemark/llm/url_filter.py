"""URL filters: rules by host and path, and decisions that spread over redirects and canonical links to equivalent addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.runtime import ascii_lower, materialize, prepare, tuned

#: Above so many rules they are joined by host instead of being part of the expression.
FEW = 100

#: Query parameters that name a visit, not a page.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"

LINK = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
GOAL = r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ?, # or the end, A-Z lower-cased. Path: from there up to ?, # or the end."""
    rest = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + 3, F.length(url)))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def alias_key(url: Column) -> Column:
    """One spelling for addresses that name one page: without scheme, www, final slash, .html, fragment and tracking. Null if no host."""
    host, path = host_and_path(url)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    short = F.regexp_replace(F.regexp_replace(path, r"(/index)?\.html?$", ""), "/+$", "")
    return F.when(host != "", F.concat(F.regexp_replace(host, r"^www\.", ""), short, F.lit("?"), F.array_join(kept, "&")))


def resolved(link: Column, url: Column) -> Column:
    """The address that a link on the page at url leads to; null for an empty link."""
    link = F.replace(link, F.lit("&amp;"), F.lit("&"))
    scheme, root = F.regexp_extract(url, "^([^:]*):", 1), F.regexp_extract(url, "^[^/?#]*//[^/?#]*", 0)
    folder = F.regexp_extract(url, "^([^?#]*/)[^/?#]*", 1)
    return (
        F.when(link.isNull() | (link == ""), None)
        .when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, link))
        .when(F.length(folder) > F.length(root), F.concat(folder, link))
        .otherwise(F.concat(root, F.lit("/"), link))
    )


def rule_parts(rules: list[tuple[str, str]]) -> list[tuple[str, str, str, str]]:
    """(host, path, rule, verdict), the longest first; of equal rules an allowing one first."""
    split = [(r.partition("/")[0].lower(), r[len(r.partition("/")[0]) :], r, v) for v, r in rules]
    return sorted(split, key=lambda x: (-len(x[2]), x[3] != "allow", x[2]))


def match_rules(df: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """df, which has host and path, with rule and explicit: the longest rule that fits and its verdict, else null.

    A rule fits its host and the subdomains of it where the path starts with the rule's.
    """
    parts = rule_parts(rules)
    if len(parts) <= FEW:
        rule = explicit = F.lit(None).cast("string")
        for host, path, name, verdict in reversed(parts):
            fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
            rule, explicit = F.when(fits, F.lit(name)).otherwise(rule), F.when(fits, F.lit(verdict)).otherwise(explicit)
        return df.withColumns({"rule": rule, "explicit": explicit})
    listed = df.sparkSession.createDataFrame(parts, "_host string, _path string, rule string, explicit string")
    labels = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    places = df.select("host", "path").distinct()
    fits = places.withColumn("_host", F.explode(ends)).join(listed, "_host").filter(F.startswith("path", F.col("_path")))
    rank = F.struct(F.length("rule"), F.col("explicit") == "allow", "rule", "explicit")
    best = fits.groupBy("host", "path").agg(F.max(rank).alias("best")).select("host", "path", "best.rule", "best.explicit")
    return df.join(best, ["host", "path"], "left")


def filter_urls(
    pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", html_col: str | None = "html",
    redirects: DataFrame | None = None, spelling: bool = True,
) -> DataFrame:
    """(id, host, path, rule, verdict, component): the verdict on each page.

    rules: (allow or block, rule) pairs; a page that a rule fits takes the longest rule's verdict. Other pages take that of their
    component: pages are equivalent if their addresses differ only in spelling (see alias_key), if one names the other as
    canonical or refreshes to it, or if redirects (src, dst: two address columns) links them. Rules are also read against
    addresses that are only linked to. In a component an explicit allow outweighs any block; without either, pages are allowed.
    spelling=False: only links join pages, and addresses are one if they are equal. Of a page the first canonical link and the first refresh
    count.

    Null addresses, or without ://, have empty host and path, no component, and are allowed. Null html: no links. Rows that
    repeat get the same verdict. Empty table: empty result. Extra columns are ignored.
    """
    prepare(pages.sparkSession)
    url = F.col("url")
    key_of = alias_key if spelling else lambda u: F.when(host_and_path(u)[0] != "", u)
    link = lambda tag, inner: resolved(F.regexp_extract(F.regexp_extract("html", tag, 0), inner, 1), url)
    html = F.col(html_col).cast("string") if html_col else F.lit(None).cast("string")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), html.alias("html"))
    rows = rows.select("id", "url", key_of(url).alias("key"), F.array(link(LINK, HREF), link(REFRESH, GOAL)).alias("links"))
    rows = materialize(rows)
    edges = rows.select(F.col("url").alias("src"), F.explode("links").alias("dst"))
    if redirects is not None:
        edges = edges.union(redirects.select(F.col("src").cast("string"), F.col("dst").cast("string")))
    edges = edges.filter("src is not null and dst is not null").withColumns({"a": key_of(F.col("src")), "b": key_of(F.col("dst"))})
    edges = materialize(edges.filter("a <> b"))
    labels = connected_components(edges).withColumnRenamed("node", "key")

    said = rows.select("url", "key").union(edges.select("src", "a")).union(edges.select("dst", "b")).filter("key is not null")
    host, path = host_and_path(url)
    said = match_rules(said.withColumns({"host": host, "path": path}), rules).filter("explicit is not null")
    component = F.coalesce("component", "key").alias("component")
    said = said.groupBy("key").agg(F.max(F.col("explicit") == "allow").alias("allow")).join(labels, "key", "left").select(component, "allow")
    said = said.groupBy("component").agg(F.max("allow").alias("allow"))

    judged = match_rules(rows.withColumns({"host": host, "path": path}), rules)
    judged = judged.join(labels, "key", "left").withColumn("component", component).join(said, "component", "left")
    verdict = F.coalesce("explicit", F.when(F.col("allow") == F.lit(False), "block").otherwise("allow"))
    return judged.select("id", "host", "path", "rule", verdict.alias("verdict"), "component")


RULES = [
    ("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"),
]


def op2_url_filter(spark, sf_dir: str) -> DataFrame:
    """The verdict on every page."""
    out = filter_urls(tuned(spark).read.parquet(f"{sf_dir}/pages.parquet"), RULES)
    return out.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")
