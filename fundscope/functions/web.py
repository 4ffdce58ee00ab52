"""URLs and HTML text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def host(url: Column, parity: bool = False) -> Column:
    """Lower-case host without a leading ``www.``; NULL becomes ''.

    ``parity`` strips any leading run of w and dots instead, as a character set.
    """
    u = F.lower(F.trim(F.coalesce(url, F.lit(""))))
    bare = F.regexp_extract(u, r"^(?:[a-z][a-z0-9+.\-]*://)?([^/?#]*)", 1)
    return F.regexp_replace(bare, "^[w.]+" if parity else r"^www\.", "")


def host_anywhere(url: Column) -> Column:
    """Host with every ``www.`` taken out, '' where the text is no URL."""
    return F.replace(F.lower(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit(""))), F.lit("www."), F.lit(""))


def canonical(url: Column) -> Column:
    u = F.lower(F.regexp_replace(F.trim(F.coalesce(url, F.lit(""))), "/+$", ""))
    return F.regexp_replace(u, r"/index\.html?$", "")


def under(h: Column, domain: Column) -> Column:
    """The domain itself or a host below it."""
    return (h == domain) | h.endswith(F.concat(F.lit("."), domain))


def trust(url: Column) -> Column:
    """Points for the top-level domain and for a root path."""
    h = host(url)
    points = F.when(h.endswith(".or.jp"), 10).when(h.endswith(".go.jp") | h.endswith(".ac.jp"), 8).when(h.endswith(".org"), 6).when(h.endswith(".jp"), 4).when(h.endswith(".com"), 2).otherwise(0)
    return points + F.when(F.regexp_replace(url, r"^[a-z]+://[^/]*", "").isin("", "/"), 3).otherwise(0)


def trust_of_site(url: Column) -> Column:
    """The second weight set: other points for the same domains, and one for a root path."""
    h = host(url)
    points = F.when(h.endswith(".or.jp"), 6).when(h.endswith(".go.jp") | h.endswith(".ac.jp"), 4).when(h.endswith(".jp") | h.endswith(".org"), 3).otherwise(0)
    return points + F.when(F.regexp_replace(url, r"^[a-z]+://[^/]*", "").isin("", "/"), 1).otherwise(0)


def candidate_urls(cores: Column, templates: list[str]) -> Column:
    """Every core in every template ('{}' stands for it), without repeats, in order."""
    each = F.transform(cores, lambda c: F.array(*[F.replace(F.lit(t), F.lit("{}"), c) for t in templates]))
    return F.array_distinct(F.flatten(each))


def strip_tags(html: Column) -> Column:
    """Text without tags, four entities resolved, white space squeezed."""
    s = F.regexp_replace(html, "(?s)<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        s = F.replace(s, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def cell_after(html: Column, header: str) -> Column:
    """Text of the cell that follows a header cell matching ``header``; NULL if there is none."""
    raw = F.regexp_extract(html, rf"(?is)<th[^>]*>[^<]*(?:{header})[^<]*</th>\s*<td[^>]*>(.*?)</td>", 1)
    return F.nullif(strip_tags(raw), F.lit(""))


def label_value(text: Column, label: str) -> Column:
    """``label: value`` to the end of the line; NULL if there is none."""
    return F.nullif(F.trim(F.regexp_extract(text, rf"(?m){label}[:：\s]+([^\n]+)$", 1)), F.lit(""))


def stable_file_name(url: Column) -> Column:
    base = F.regexp_replace(F.element_at(F.split(F.regexp_replace(url, r"[?#].*$", ""), "/"), -1), r"[^A-Za-z0-9._-]", "_")
    return F.concat(F.when(base == "", "index").otherwise(base), F.lit("_"), F.substring(F.sha1(url.cast("binary")), 1, 8))


def with_context(text: Column, pattern: str, chars: int, most: int | None = None) -> Column:
    """array<struct<hit, before, after>>: matches with up to ``chars`` characters on each side."""
    between = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if most is not None:
        hits = F.slice(hits, 1, most)
    one = lambda hit, k: F.struct(hit.alias("hit"), F.right(F.get(between, k), F.lit(chars)).alias("before"), F.left(F.get(between, k + 1), F.lit(chars)).alias("after"))
    return F.transform(hits, one)
