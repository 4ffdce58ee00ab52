"""Additive scores of records, titles and URLs, and greedy picks by them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import any_of, web


def present(c: Column, text: bool = False) -> Column:
    """1 for a value that is neither NULL nor empty or zero."""
    return F.when(c.isNull(), 0).when((c == "") if text else (c.cast("double") == 0), 0).otherwise(1)


def richness(fields: Mapping[Column, int] | Sequence[tuple[Column, int]]) -> Column:
    """Weights of the fields that have a value; fields are text."""
    items = fields.items() if isinstance(fields, Mapping) else fields
    return sum((present(c, text=True) * w for c, w in items), F.lit(0))


def title_score(title: Column, base: Column, keywords: Column, generic: Sequence[str], bad: str) -> Column:
    """10 for the whole name, 3 for a generic word, 2 per keyword of 3 and more characters, -5 for a disambiguation page."""
    hits = F.size(F.filter(keywords, lambda k: (F.length(k) >= 3) & F.contains(title, k)))
    return F.when((base != "") & F.contains(title, base), 10).otherwise(0) + F.when(any_of(title, list(generic)), 3).otherwise(0) + 2 * hits + F.when(F.contains(title, F.lit(bad)), -5).otherwise(0)


def best_title(candidates: DataFrame, key: str, order: str, score: str) -> DataFrame:
    """The candidate with the largest positive score, the first of several."""
    w = Window.partitionBy(key).orderBy(F.desc(score), order)
    return candidates.filter(F.col(score) > 0).withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def pick_urls(links: DataFrame, denied: DataFrame, hints: Sequence[str], rounds: int = 3) -> DataFrame:
    """(id, root, score): each entity's best free root URL; a root goes to the lowest id that wants it.

    ``links``: id, place, url; ``denied``: domain.  Entities that lose a root try their next one, ``rounds`` times in all;
    each round is a pair of ranked windows, and what is taken leaves the candidates.
    """
    root = F.regexp_extract(F.lower("url"), r"^(https?://[^/?#]+)", 1)
    c = links.withColumn("root", root).filter("root <> ''").withColumn("host", web.host(F.col("root")))
    parts = F.split("host", r"\.")
    c = c.withColumn("up", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))))
    bad = c.join(F.broadcast(denied.select(F.col("domain").alias("up"))), "up", "left_semi").select("id", "root").distinct()
    score = web.trust(F.concat("root", F.lit("/"))) + F.when(any_of(F.col("host"), list(hints)), 2).otherwise(0)
    c = c.groupBy("id", "root", "host").agg(F.min("place").alias("place")).join(bad, ["id", "root"], "left_anti").withColumn("score", score)
    taken = None
    for _ in range(rounds):
        free = c if taken is None else c.join(taken.select("id"), "id", "left_anti").join(taken.select("root"), "root", "left_anti")
        want = free.withColumn("n", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "place"))).filter("n = 1")
        won = want.withColumn("m", F.row_number().over(Window.partitionBy("root").orderBy("id"))).filter("m = 1").select("id", "root", "score")
        taken = won if taken is None else taken.unionByName(won)
    return taken


def core_keywords(name: Column, base: Column, suffixes: Sequence[str]) -> Column:
    """The whole name, its normalised form, and that without its generic suffix; two characters and more."""
    stem = F.regexp_extract(base, f"^(.+?)({'|'.join(suffixes)})$", 1)
    return F.array_sort(F.array_distinct(F.filter(F.array(base, F.trim(name), stem), lambda k: F.length(k) >= 2)))


def latin_core(name: Column, readings: Mapping[str, str]) -> Column:
    """Latin names for a domain: the reading of the longest known part, then the name's own Latin letters and digits."""
    known = F.when(F.lit(False), F.lit(None).cast("string"))
    for part in sorted(readings, key=lambda p: (-len(p), p)):
        known = known.when(F.contains(name, F.lit(part)), readings[part])
    own = F.lower(F.regexp_replace(name, "[^A-Za-z0-9]", ""))
    return F.array_distinct(F.filter(F.array_compact(F.array(known, own)), lambda s: F.length(s).between(3, 30)))


def inferred_fields(domains: Column, name: Column, by_domain: Mapping[str, str], by_word: Mapping[str, str], most: int = 3) -> Column:
    """Fields of the domains and of words in the name, sorted, at most ``most``."""
    lookup = F.create_map(*[F.lit(x) for kv in by_domain.items() for x in kv])
    words = F.array_compact(F.array(*[F.when(F.contains(F.lower(name), F.lit(w.lower())), f) for w, f in by_word.items()]))
    return F.slice(F.array_sort(F.array_distinct(F.concat(F.array_compact(F.transform(domains, lambda d: lookup[d])), words))), 1, most)
