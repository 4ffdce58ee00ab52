"""Prefectures and municipalities in addresses and free text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The prefectures.
PREFECTURES = [
    "北海道", "青森県", "岩手県", "宮城県", "秋田県", "山形県", "福島県", "茨城県", "栃木県", "群馬県", "埼玉県", "千葉県", "東京都", "神奈川県", "新潟県", "富山県",
    "石川県", "福井県", "山梨県", "長野県", "岐阜県", "静岡県", "愛知県", "三重県", "滋賀県", "京都府", "大阪府", "兵庫県", "奈良県", "和歌山県", "鳥取県", "島根県",
    "岡山県", "広島県", "山口県", "徳島県", "香川県", "愛媛県", "高知県", "福岡県", "佐賀県", "長崎県", "熊本県", "大分県", "宮崎県", "鹿児島県", "沖縄県",
]
_ANY = "|".join(PREFECTURES)


def _found(c: Column, names: Mapping[str, str]) -> Column:
    """Value of the first key, in order, that the text holds; NULL without one."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for key, value in names.items():
        out = out.when(F.contains(c, F.lit(key)), value)
    return out


def at_start(address: Column) -> Column:
    return F.nullif(F.regexp_extract(address, f"^({_ANY})", 1), F.lit(""))


def near_start(address: Column, chars: int = 10) -> Column:
    """In the first characters, after composition has been done."""
    return _found(F.substring(address, 1, chars), {p: p for p in PREFECTURES})


def anywhere(text: Column, cities: Mapping[str, str] = {}) -> Column:
    """A prefecture's name, else a known city's prefecture."""
    return _found(text, {p: p for p in PREFECTURES} | dict(cities))


def cascade(text: Column, universities: Mapping[str, str], cities: Mapping[str, str]) -> Column:
    """(prefecture, method): full name, then university, then city, then the name without its last character."""
    short = {p[:-1]: p for p in PREFECTURES if p != "北海道"}
    steps = [("prefecture", _found(text, {p: p for p in PREFECTURES})), ("university", _found(text, universities)), ("city", _found(text, cities)), ("short", _found(text, short))]
    return first_success(steps)


def first_success(steps: Sequence[tuple[str, Column]]) -> Column:
    """(value, method) of the first step that gives a value."""
    method = F.lit(None).cast("string")
    for name, value in reversed(list(steps)):
        method = F.when(value.isNotNull(), name).otherwise(method)
    return F.struct(F.coalesce(*[v for _, v in steps]).alias("value"), method.alias("method"))


def split_address(address: Column) -> Column:
    """(prefecture, municipality); a prefecture that is written twice counts once."""
    prefecture = at_start(address)
    rest = F.regexp_replace(F.regexp_replace(address, f"^({_ANY})", ""), f"^({_ANY})(?=.+[市区町村])", "")
    town = F.nullif(F.regexp_extract(rest, "^(.+?[市区町村])", 1), F.lit(""))
    return F.struct(prefecture.alias("prefecture"), F.when(prefecture.isNotNull(), town).alias("municipality"))
