"""URL filters: host and path rules, and decisions that follow redirects and canonical links.

Addresses that name one page form a component of the graph of redirect and canonical-link edges.
A page without a rule of its own is judged by its component: allowed where any alias is allowed by
a rule, else blocked where any alias is blocked, else allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import components, staged

# The rules as (verdict, host/path).
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES_AT_ENDS = r"^[ \t\r\n\f]+|[ \t\r\n\f]+$"
REFERENCES = (
    (r"&(?:quot|#0*34|#[xX]0*22);", '"'),
    (r"&(?:apos|#0*39|#[xX]0*27);", "'"),
    (r"&(?:sol|#0*47|#[xX]0*2[fF]);", "/"),
    (r"&(?:colon|#0*58|#[xX]0*3[aA]);", ":"),
    (r"&(?:amp|#0*38|#[xX]0*26);", "&"),
)
# Query parameters that do not change the page.
TRACKING = r"(?:utm_[^=&]*|ref|fbclid|gclid)"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def host_of(url: Column) -> Column:
    """The text between the first ``://`` and the next ``/``, ``?``, ``#`` or the end."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_fits(host: Column, path: Column, rule: str) -> Column:
    name, slash, rest = rule.partition("/")
    same = (host == name) | host.endswith("." + name)
    return same & path.startswith(slash + rest)


def first_fit(host: Column, path: Column, rules, value) -> Column:
    """``value(rule)`` of the longest rule that fits, else null; of equally long, the larger text."""
    found = F.lit(None).cast("string")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        found = F.when(rule_fits(host, path, rule), F.lit(value(verdict, rule))).otherwise(found)
    return found


def longest_fits(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, own) of the urls (host, path) that a rule of the table fits.

    ``rules`` is (verdict, rule) and may be large: a host is looked up under each of its suffixes,
    and its path cut to each length that rules of that suffix have, so all lookups are equalities.
    """
    cut = rules.select(
        F.regexp_extract("rule", "^[^/]*", 0).alias("_suffix"),
        F.regexp_extract("rule", "(?s)/.*$", 0).alias("_start"),
        "rule",
        F.col("verdict").alias("own"),
    )
    cut = staged(cut.groupBy("_suffix", "_start", "rule").agg(F.max("own").alias("own")), "rules")
    lengths = cut.select("_suffix", F.length("_start").alias("_length")).distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."),
    )
    asked = (
        staged(urls.select("host", "path").distinct(), "hosts")
        .withColumn("_suffix", F.explode(suffixes))
        .join(lengths, "_suffix")
        .where(F.col("_length") <= F.length("path"))
        .withColumn("_start", F.substring(F.col("path"), F.lit(1), F.col("_length")))
    )
    best = F.max(F.struct(F.length("rule"), "rule", "own")).alias("_best")
    found = asked.join(cut, ["_suffix", "_start"]).groupBy("host", "path").agg(best)
    return found.select("host", "path", "_best.rule", "_best.own")


def address(url: Column) -> Column:
    """The url as a graph node: host in lower case, without fragment; null without ``://``."""
    scheme = lower_ascii(F.regexp_extract(url, r"(?s)^(.*?)://", 1))
    tail = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(url.contains("://"), F.concat(scheme, F.lit("://"), host_of(url), tail))


def canonical(url: Column) -> Column:
    """The address that a site gives for all forms of one page, as far as the url shows it.

    Scheme, ``www.`` and ``m.``, tracking parameters, and slashes at the end of the path are left
    out; other parameters stay in their order.
    """
    host = F.regexp_replace(host_of(url), r"^(?:www|m)\.", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(query, rf"(?:^|&){TRACKING}(?:=[^&]*)?(?=&|$)", "")
    query = F.regexp_replace(query, r"^&", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    tail = F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")
    return F.when(url.contains("://"), F.concat(F.lit("http://"), host, path, tail))


def _attribute(tag: Column, name: str) -> Column:
    pattern = rf"(?is)\s{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
    return F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)])


def _without_dots(path: Column) -> Column:
    """An absolute path without its ``.`` and ``..`` segments, as RFC 3986 removes them."""
    parts = F.slice(F.split(path, "/"), 2, F.greatest(F.size(F.split(path, "/")) - 1, F.lit(0)))
    up = lambda done: F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == "..", up(done))
        .when(part == ".", done)
        .otherwise(F.array_append(done, part)),
    )
    end = F.when(F.element_at(parts, -1).isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    joined = F.concat(F.lit("/"), F.array_join(kept, "/"))
    return F.when(joined == "/", joined).otherwise(F.concat(joined, end))


def _cleaned(value: Column) -> Column:
    """An attribute value without white space around it and without the character references that
    addresses are written with."""
    text = value
    for pattern, letter in REFERENCES:
        text = F.regexp_replace(text, pattern, letter)
    text = F.when(value.contains("&"), text).otherwise(value)
    return F.regexp_replace(text, SPACES_AT_ENDS, "")


def _absolute(base: Column, link: Column) -> Column:
    """The reference ``link`` on the page ``base``, absolute; null for one that names no page.

    References of other schemes than ``scheme://`` name no page, nor does an empty one.
    """
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    site = F.concat(scheme, F.lit("://"), host_of(base))
    path = F.when(path_of(base) == "", "/").otherwise(path_of(base))
    query = F.regexp_extract(base, r"(?s)^[^?#]*(\?[^#]*)", 1)
    own_path = F.regexp_extract(link, r"(?s)^([^?#]*)", 1)
    rest = F.regexp_extract(link, r"(?s)^[^?#]*(.*)$", 1)
    folder = F.regexp_extract(path, r"(?s)^(.*/)", 1)
    return (
        F.when(link == "", F.lit(None).cast("string"))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), F.lit(None).cast("string"))
        .when(link.startswith("/"), F.concat(site, _without_dots(own_path), rest))
        .when(link.startswith("#"), F.concat(site, path, query, link))
        .when(link.startswith("?"), F.concat(site, path, rest))
        .otherwise(F.concat(site, _without_dots(F.concat(folder, own_path)), rest))
    )


def declared_targets(url: Column, html: Column) -> Column:
    """Absolute targets of the page's canonical links and refresh redirects, as an array.

    References are resolved against the first ``<base href>`` of the page, itself resolved against
    the address of the page, or against that; ``canonical`` may be one of several values of ``rel``.
    """
    bases = F.filter(
        F.transform(
            F.regexp_extract_all(html, F.lit(r"(?is)<base\s[^>]*>"), 0),
            lambda t: _attribute(t, "href"),
        ),
        lambda t: t != "",
    )
    # Values are cleaned once, in arrays of their own, as they are used many times.
    first = F.transform(F.slice(bases, 1, 1), _cleaned)
    base = F.coalesce(F.get(F.transform(first, lambda t: _absolute(url, t)), F.lit(0)), url)
    links = F.filter(
        F.regexp_extract_all(html, F.lit(r"(?is)<link\s[^>]*>"), 0),
        lambda t: F.array_contains(
            F.split(F.lower(_attribute(t, "rel")), r"[ \t\r\n\f]+"), "canonical"
        ),
    )
    metas = F.filter(
        F.regexp_extract_all(html, F.lit(r"(?is)<meta\s[^>]*>"), 0),
        lambda t: F.lower(_attribute(t, "http-equiv")) == "refresh",
    )
    to = F.concat(
        F.transform(links, lambda t: _attribute(t, "href")),
        F.transform(
            metas,
            lambda t: F.regexp_extract(
                _attribute(t, "content"), r"(?is)url\s*=\s*['\"]?([^'\"]*)", 1
            ),
        ),
    )
    return F.flatten(
        F.transform(
            F.array(base),
            lambda b: F.filter(
                F.transform(F.transform(to, _cleaned), lambda t: _absolute(b, t)),
                lambda t: t.isNotNull(),
            ),
        )
    )


def url_verdicts(pages: DataFrame, rules=RULES, redirects: DataFrame | None = None) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict.

    Edges are: url to its canonical form, url to that of the canonical links and refresh targets in
    its html, and between those of ``redirects`` (src, dst) if given. ``rules`` are pairs (verdict,
    rule), or for many rules a DataFrame of these columns, which is joined. Null urls and urls without
    ``://`` have empty host and path, no edges, and are allowed; null html declares nothing.
    Repeated rows get equal answers; extra columns are ignored; an empty table gives no rows. Nodes
    are MD5 digests of addresses, so hot pages cost 16 bytes an edge.
    """
    few = () if isinstance(rules, DataFrame) else rules
    url = F.col("url")
    node = F.unhex(F.md5(address(url)))
    declared = F.transform(
        F.coalesce(declared_targets(url, F.col("html")), F.array().cast("array<string>")),
        lambda t: F.unhex(F.md5(canonical(t))),
    )
    host, path = host_of(url), path_of(url)
    read = staged(
        pages.select(
            "page_id",
            host.alias("host"),
            path.alias("path"),
            node.alias("node"),
            F.when(
                node.isNotNull(), F.concat(F.array(F.unhex(F.md5(canonical(url)))), declared)
            ).alias("to"),
        )
        .withColumn("rule", first_fit(F.col("host"), F.col("path"), few, lambda v, r: r))
        .withColumn("own", first_fit(F.col("host"), F.col("path"), few, lambda v, r: v)),
        "urls",
    )
    if isinstance(rules, DataFrame):
        fits = staged(longest_fits(read, rules), "fits")
        read = staged(read.drop("rule", "own").join(fits, ["host", "path"], "left"), "urls")
    edges = read.select(F.col("node").alias("a"), F.explode("to").alias("b"))
    if redirects is not None:
        edges = edges.unionByName(
            redirects.select(
                F.unhex(F.md5(canonical(F.col("src")))).alias("a"),
                F.unhex(F.md5(canonical(F.col("dst")))).alias("b"),
            )
        )
    groups = staged(components(edges), "aliases")
    decided = (
        read.where("own IS NOT NULL AND node IS NOT NULL")
        .groupBy("node")
        .agg(F.max(F.col("own") == "allow").alias("allow"))
    )
    verdicts = staged(
        groups.join(decided, "node")
        .groupBy("component")
        .agg(F.when(F.max("allow"), "allow").otherwise("block").alias("shared")),
        "shared",
    )
    by_node = staged(groups.join(verdicts, "component").select("node", "shared"), "shared")
    # Only pages without a rule ask their component.
    open_pages = read.where("own IS NULL").join(by_node, "node", "left")
    columns = ["page_id", "host", "path", "rule"]
    return (
        open_pages.select(*columns, F.coalesce("shared", F.lit("allow")).alias("verdict"))
    ).unionByName(read.where("own IS NOT NULL").select(*columns, F.col("own").alias("verdict")))
