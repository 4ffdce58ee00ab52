"""JSON text, arrays and provenance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MAP = "map<string,string>"


def as_map(json: Column) -> Column:
    """Top-level members as text; malformed JSON and NULL give an empty map."""
    return F.coalesce(F.from_json(json, _MAP, {"mode": "PERMISSIVE"}), F.create_map().cast(_MAP))


def raw_or_map(json: Column) -> Column:
    """Like ``as_map``, but malformed text is kept under ``_raw_metadata``."""
    bad = json.isNotNull() & F.try_parse_json(json).isNull()
    return F.when(bad, F.create_map(F.lit("_raw_metadata"), json).cast(_MAP)).otherwise(as_map(json))


def merged(left: Column, right: Column) -> Column:
    """Members of both maps, the left one's where both have a key; sources of both as one sorted list."""
    list_of = lambda m: F.coalesce(F.from_json(F.coalesce(m["source"], m["sources"]), "array<string>"), F.array_compact(F.array(F.coalesce(m["source"], m["sources"]))))
    sources = F.array_sort(F.array_union(list_of(left), list_of(right)))
    rest = F.map_filter(F.map_zip_with(right, left, lambda k, r, v: F.coalesce(v, r)), lambda k, v: ~k.isin("source", "sources"))
    return F.when(F.size(sources) > 0, F.map_concat(rest, F.create_map(F.lit("sources"), F.to_json(sources)))).otherwise(rest)


def set_default(m: Column, key: str, value: Column) -> Column:
    return F.when(F.map_contains_key(m, key), m).otherwise(F.map_concat(m, F.create_map(F.lit(key), value)))


def joined(items: Column, most: int = 400, sep: str = ", ") -> Column:
    return F.substring(F.array_join(items, sep), 1, most)


def csv_union(a: Column, b: Column) -> Column:
    """Members of two comma-separated lists, sorted, without repeats and blanks."""
    parts = lambda c: F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_join(F.array_sort(F.array_union(parts(a), parts(b))), ",")


def weighted_labels(labels: Column, valid: list[str], most: int = 5, first: float = 1.0, rest: float = 0.4) -> Column:
    """array<struct<label, weight, is_primary>> of the valid labels, the first one primary."""
    kept = F.slice(F.filter(labels, lambda x: x.isin(valid)), 1, most)
    return F.transform(kept, lambda x, k: F.struct(x.alias("label"), F.when(k == 0, first).otherwise(rest).alias("weight"), (k == 0).alias("is_primary")))


def stable_id(prefix: str, *parts: Column) -> Column:
    """The same id for the same natural key in every run."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts]), 256), 1, 12))
