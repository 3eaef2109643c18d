"""URL filter with decisions shared by redirect equivalence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uttermill.llm.common import UPPER, staged
from uttermill.llm.components import connected

#: (host, path prefix, verdict)
Rule = tuple[str, str, str]

#: What holds no markup of the page itself: comments, scripts, styles and the like.
_HIDDEN = r"(?is)<!--.*?(?:-->|$)|<(script|style|textarea|title|noscript|template)\b.*?(?:</\1\s*>|$)"
#: A tag with its attributes; quoted values may hold ``>``.
_TAG = r"""(?is)<(?:link|meta|base)(?=[\s/>])(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
#: Named entities that occur in addresses (fixed values); numeric ones are decoded by code.
_ENTITIES = {"quot": '"', "apos": "'", "lt": "<", "gt": ">", "amp": "&"}
#: Ports that addresses leave out (fixed values).
_PORTS = {"http": "80", "https": "443"}


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/ ? #``, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null.

    A rule fits its host and all subdomains when the path starts with the
    rule's.  The list becomes part of the plan: at most 10,000 rules.
    """
    if len(rules) > 10_000:
        raise ValueError("more than 10,000 rules: give them as several filters")
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a tag, null without it; names end at white space, so ``data-href`` is no ``href``."""
    # Attributes before it are stepped over, whatever their values hold; possessive, so no tag is too long for the stack.
    before = r"""(?is)^<\w+(?:[\s/]++(?!%s[\s=/>])[^\s=/>"']++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?+)*+[\s/]+%s\s*=\s*""" % (name, name)
    found = F.regexp_extract(tag, before + r"""("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return F.when(found != "", _decoded(F.regexp_replace(found, r"""(?s)^(["'])(.*)\1$""", "$2")))


def _decoded(value: Column) -> Column:
    """Numeric and the five basic named entities of an attribute value; one pass, so ``&amp;lt;`` is ``&lt;``."""
    parts = F.regexp_extract_all(value, F.lit(r"(?is)(&(?:#x[0-9a-f]{1,6}|#[0-9]{1,7}|quot|apos|lt|gt|amp);|[^&]+|&)"), F.lit(1))

    def one(part: Column) -> Column:
        name = F.lower(F.regexp_extract(part, r"(?s)^&(.*);$", 1))
        code = F.when(name.startswith("#x"), F.conv(F.substring(name, 3, 6), 16, 10)).when(name.startswith("#"), F.substring(name, 2, 7)).cast("int")
        # A code point as four bytes, so that those above 65,535 are right too.
        letter = F.decode(F.unhex(F.lpad(F.hex(code.cast("bigint")), 8, "0")), "UTF-32")
        out = F.when(code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF), letter)
        for entity, sign in _ENTITIES.items():
            out = out.when(name == entity, F.lit(sign))
        return out.otherwise(part)

    plain = ~F.contains(value, F.lit("&"))
    return F.when(plain, value).otherwise(F.array_join(F.transform(parts, one), ""))


def _without_dots(path: Column) -> Column:
    """``.`` and ``..`` of a path that begins with ``/`` resolved; it never climbs above the root."""
    steps = F.slice(F.split(path, "/", -1), F.lit(2), F.size(F.split(path, "/", -1)))
    dots = lambda x: F.regexp_replace(x, r"(?i)%2e", ".")
    kept = F.aggregate(
        steps, F.array().cast("array<string>"),
        lambda done, x: F.when(dots(x) == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(dots(x) == ".", done).otherwise(F.concat(done, F.array(x))),
    )
    # A path that ends with a dot step names a folder.
    folder = dots(F.element_at(steps, -1)).isin(".", "..")
    out = F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(folder & (F.size(kept) > 0), "/").otherwise(""))
    return F.when(F.regexp_like(path, F.lit(r"(?i)/(?:\.|%2e){1,2}(?:/|$)")), out).otherwise(path)


def _node(url: Column) -> Column:
    """A URL as a node of the graph: without fragment, user, default port and dot steps, scheme and host in lower case.

    Null for what has no scheme and host.
    """
    bare = F.regexp_replace(F.regexp_replace(url, r"[\t\r\n]", ""), r"(?s)^[\x00-\x20]+|#.*$|[\x00-\x20]+$", "")
    scheme = F.lower(F.regexp_extract(bare, r"(?s)^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = F.regexp_replace(host_of(bare), r"(?s)^.*@", "")
    for name, port in _PORTS.items():
        host = F.when(scheme == name, F.regexp_replace(host, f":(?:{port})?$", "")).otherwise(host)
    path = path_of(bare)
    query = F.regexp_extract(bare, r"(?s)^[^?]*(\?.*)$", 1)
    whole = F.concat(scheme, F.lit("://"), host, _without_dots(F.when(path == "", "/").otherwise(path)), query)
    return F.when((scheme != "") & (host != ""), whole)


def _absolute(base: Column, target: Column) -> Column:
    """``target`` as an address, relative to the page ``base`` as browsers resolve it; null for other schemes."""
    target = F.regexp_replace(F.regexp_replace(target, r"[\t\r\n]", ""), r"(?s)^[\x00-\x20]+|[\x00-\x20]+$", "")
    bare = F.regexp_replace(base, r"(?s)#.*$", "")
    origin = F.regexp_extract(bare, r"(?s)^(.*?://[^/?#]*)", 1)
    page = F.regexp_extract(bare, r"(?s)^(.*?://[^?]*)", 1)
    folder = F.regexp_extract(bare, r"(?s)^(.*?://[^/?]*(?:/[^?]*/|/)?)", 1)
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    return (
        F.when((target == "") | target.startswith("#"), bare)
        .when(F.regexp_like(target, F.lit(r"(?i)^[a-z][a-z0-9+.-]*://")), target)
        .when(F.regexp_like(target, F.lit(r"(?i)^[a-z][a-z0-9+.-]*:")), F.lit(None).cast("string"))
        .when(target.startswith("//"), F.concat(F.regexp_extract(bare, r"(?s)^(.*?:)//", 1), target))
        .when(target.startswith("/"), F.concat(origin, target))
        .when(target.startswith("?"), F.concat(page, target))
        .otherwise(F.concat(folder, target))
    )


def page_targets(url: Column, html: Column) -> Column:
    """Addresses that the markup of a page names as itself: its first canonical link and its first refresh.

    Comments, scripts and styles are cut first, entities are decoded, and targets are relative to
    the first ``base`` element, else to the page.
    """
    seen = F.regexp_replace(html, _HIDDEN, " ")
    tags = F.regexp_extract_all(seen, F.lit(_TAG), F.lit(0))

    def of(kind: str) -> Column:
        return F.filter(tags, lambda t: F.lower(F.substring(t, 2, 4)) == kind)

    def first(values: Column) -> Column:
        return F.try_element_at(F.filter(values, lambda v: v.isNotNull()), F.lit(1))

    own = F.coalesce(_absolute(url, first(F.transform(of("base"), lambda t: _attribute(t, "href")))), url)
    rel = lambda t: F.split(F.lower(F.coalesce(_attribute(t, "rel"), F.lit(""))), r"\s+")
    link = first(F.transform(of("link"), lambda t: F.when(F.array_contains(rel(t), "canonical"), _attribute(t, "href"))))
    hop = first(F.transform(of("meta"), lambda t: F.when(F.lower(_attribute(t, "http-equiv")) == "refresh", _attribute(t, "content"))))
    # ``0; url='/b'`` and ``0;/b``: what follows the time, up to the closing quotation mark if it began with one.
    said = F.regexp_extract(hop, r"""(?is)^\s*[0-9.]+\s*[;,\s]\s*(?:url\s*=\s*)?("[^"]*|'[^']*|.*)""", 1)
    to = F.regexp_replace(said, r"""^["']""", "")
    return F.array(F.when(link != "", _absolute(own, link)), F.when(to != "", _absolute(own, to)))


def page_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): a page's URL and the canonical or redirect target its markup names."""
    rows = pages.select(F.col(url).alias("_url"), F.col(html).alias("_html")).where(F.contains("_url", F.lit("://")))
    rows = rows.where(F.regexp_like("_html", F.lit(r"(?i)<(?:link|meta)[\s/]")))
    named = rows.select("_url", F.explode(page_targets(F.col("_url"), F.col("_html"))).alias("_target"))
    return named.select(_node(F.col("_url")).alias("a"), _node(F.col("_target")).alias("b")).where("a is not null and b is not null")


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url", html: str | None = "html",
    redirects: DataFrame | None = None,
) -> DataFrame:
    """(key, host, path, rule, verdict, alias_of) for every row of ``pages``.

    A page's own rule decides first.  Otherwise the page shares the fate of its
    aliases, the component of URLs linked by canonical links, ``meta refresh``
    and ``redirects`` (columns a, b: a crawler's redirect log): allow if one of
    them is explicitly allowed, else block if one is blocked.  All others are allowed.
    ``alias_of`` is the smallest URL of the component, null outside one.

    Markup is read as browsers do: comments and scripts do not count, entities are decoded, targets
    are resolved against the page or its ``base`` element, and ``mailto:`` and the like are no pages.  Percent
    codes and host names stay as they are written.

    A null URL, or one without ``://``, has an empty host and path, fits no rule
    and joins no component.  Repeated rows are judged each.  An empty table gives
    an empty result.
    """
    edges = page_edges(pages, url, html) if html else None
    if redirects is not None:
        log = redirects.select(_node(F.col("a")).alias("a"), _node(F.col("b")).alias("b"))
        edges = log if edges is None else edges.unionByName(log)
    host, path = host_of(F.col("_url")), path_of(F.col("_url"))
    judged = pages.select(F.col(key).alias("_key"), F.col(url).alias("_url")).select("*", host.alias("host"), path.alias("path"))
    judged = judged.withColumn("_own", best_rule(F.col("host"), F.col("path"), rules))
    if edges is None:
        judged = judged.withColumns({"_allowed": F.lit(None).cast("boolean"), "_blocked": F.lit(None).cast("boolean"), "component": F.lit(None).cast("string")})
    else:
        labels = staged(connected(edges), "aliases")
        own = best_rule(host_of(F.col("node")), path_of(F.col("node")), rules)["verdict"]
        fates = labels.withColumn("_v", own).groupBy("component").agg(
            F.coalesce(F.bool_or(F.col("_v") == "allow"), F.lit(False)).alias("_allowed"),
            F.coalesce(F.bool_or(F.col("_v") == "block"), F.lit(False)).alias("_blocked"),
        )
        known = labels.join(fates, "component")
        judged = judged.withColumn("_node", _node(F.col("_url"))).join(known, F.col("_node") == known["node"], "left")
    shared = F.when(F.col("_allowed"), "allow").when(F.col("_blocked"), "block").otherwise("allow")
    return judged.select(
        F.col("_key").alias(key), "host", "path", F.col("_own.rule").alias("rule"),
        F.coalesce(F.col("_own.verdict"), shared).alias("verdict"), F.col("component").alias("alias_of"),
    )
