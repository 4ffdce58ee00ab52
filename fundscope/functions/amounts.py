"""Amounts of money in yen, years and dates in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE, _HALF = "０１２３４５６７８９", "0123456789"


def half_digits(c: Column) -> Column:
    return F.translate(c, _WIDE + "，", _HALF + ",")


def _number(c: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(c, pattern, group).try_cast("double")


def plain_yen(c: Column) -> Column:
    """'5,000,000円' -> 5000000; NULL without such an amount."""
    digits = F.regexp_extract(half_digits(c), r"([0-9][0-9,]*)\s*円", 1)
    return F.regexp_replace(digits, ",", "").try_cast("long")


def parse_yen(c: Column) -> Column:
    """Amounts with 億, 千万, 百万 or 万; the first form that fits counts, 億 with what follows before 億 alone."""
    s = F.trim(F.regexp_replace(half_digits(c), ",", ""))
    n = r"([0-9]+(?:\.[0-9]+)?)\s*"
    both = rf"{n}億\s*([0-9]+(?:\.[0-9]+)?)?\s*千?万?\s*円"
    long = lambda x: x.cast("long")
    out = F.when(s.rlike(both), long(_number(s, both) * 1e8 + F.coalesce(_number(s, both, 2), F.lit(0.0)) * 1e4))
    for unit, factor in (("千万", 1e7), ("百万", 1e6), ("万", 1e4)):
        out = out.when(s.rlike(rf"{n}{unit}\s*円"), long(_number(s, rf"{n}{unit}\s*円") * factor))
    return out


def strict_yen(c: Column, least: int = 1_000_000) -> Column:
    """The whole text is one amount in whole numbers; bare yen count from ``least`` on."""
    s = F.regexp_replace(half_digits(c), r"[, ]", "")
    whole = lambda p, g=1: F.regexp_extract(s, p, g).try_cast("long")
    pair = r"^(\d+)億(\d+)万円?$"
    bare = whole(r"^(\d+)円?$")
    return (
        F.when(s.rlike(pair), whole(pair) * 100_000_000 + whole(pair, 2) * 10_000)
        .when(s.rlike(r"^(\d+)億円?$"), whole(r"^(\d+)億円?$") * 100_000_000)
        .when(s.rlike(r"^(\d+)万円?$"), whole(r"^(\d+)万円?$") * 10_000)
        .when(bare >= least, bare)
    )


def line_amounts(c: Column, least: int = 1_000_000) -> Column:
    """Numbers of a line with thousands separators, or 4 to 13 digits, that stand alone; in order, from ``least`` on."""
    pattern = r"(?<![0-9０-９.,，])([0-9０-９](?:[0-9０-９]{0,2}[,，][0-9０-９]{3})+|[0-9０-９]{4,13})(?![0-9０-９.,，])"
    found = F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(1)), lambda x: F.regexp_replace(half_digits(x), ",", "").try_cast("long"))
    return F.filter(found, lambda x: x >= least)


def largest_amount(c: Column, least: int = 1_000_000) -> Column:
    return F.array_max(line_amounts(c, least))


def scaled(amount: Column, unit: Column) -> Column:
    """Amounts in 千円 or 万円 to yen."""
    return amount * F.when(F.contains(unit, F.lit("千円")), 1_000).when(F.contains(unit, F.lit("万円")), 10_000).otherwise(1)


def show_yen(c: Column) -> Column:
    """Rounded to 億円 or 万円 where large enough."""
    return F.when(c.isNull(), "-").when(c >= 100_000_000, F.concat(F.format_number(c / 1e8, 1), F.lit("億円"))).when(c >= 10_000, F.concat(F.format_number(c / 1e4, 0), F.lit("万円"))).otherwise(F.concat(F.format_number(c, 0), F.lit("円")))


def close_to(a: Column, b: Column, share: float = 0.05) -> Column:
    """Within ``share`` of ``b``; NULL where ``b`` is 0 or NULL."""
    return F.abs(a - b) / F.nullif(b, F.lit(0)) <= share


def isolate_total(per_award: Column, most: Column, awards: Column, name: Column, notes: Column, floor: int = 50_000_000) -> Column:
    """(amount, total, kind): a large amount that is not per award and covers several awards is a total."""
    amount = F.coalesce(F.nullif(per_award, F.lit(0)), most)
    total = F.coalesce(F.nullif(per_award, F.lit(0)), F.lit(0)) == 0
    total = total & (amount >= floor) & (F.coalesce(awards > 1, F.lit(False)) | F.contains(F.concat_ws(" ", name, notes), F.lit("総額")))
    return F.struct(F.when(~total, amount).alias("amount"), F.when(total, amount).alias("total"), F.when(total, "total_only").otherwise("per_award").alias("kind"))


def fiscal_year(d: Column) -> Column:
    """Year that starts in April."""
    return F.year(d) - (F.month(d) < 4).cast("int")


def western_year(c: Column) -> Column:
    """Four digits, or a year of Heisei (h, 平成) or Reiwa (r, 令和)."""
    s = F.lower(F.trim(half_digits(c)))
    era = lambda marks, base: F.regexp_extract(s, rf"^(?:{marks})(\d{{1,2}})$", 1).try_cast("int") + base
    return F.coalesce(F.regexp_extract(s, r"^((?:19|20)\d\d)$", 1).try_cast("int"), era("h|平成", 1988), era("r|令和", 2018))


def year_from_url(url: Column, first: int, last: int) -> Column:
    """A year 20dd in the URL, else of Reiwa, if within the window."""
    year = F.coalesce(F.regexp_extract(url, r"(20\d\d)", 1).try_cast("int"), F.regexp_extract(F.lower(url), r"(?:^|[^a-z])r(\d{1,2})(?:[^0-9]|$)", 1).try_cast("int") + 2018)
    return F.when(year.between(first, last), year)


def year_and_estimate(c: Column) -> Column:
    """'2024est' -> (2024, true)."""
    return F.struct(F.regexp_extract(c, r"^(\d{4})", 1).try_cast("int").alias("year"), F.contains(c, F.lit("est")).alias("estimate"))


def iso_date(c: Column) -> Column:
    """ISO date of a text with full-width digits or 年月日; NULL if there is no such day."""
    s = F.regexp_replace(half_digits(F.trim(c)), r"[年月/.]", "-")
    s = F.regexp_replace(s, "日.*$", "")
    part = lambda k: F.regexp_extract(s, r"^(\d{4})-(\d{1,2})-(\d{1,2})$", k)
    return F.try_to_date(F.concat_ws("-", part(1), F.lpad(part(2), 2, "0"), F.lpad(part(3), 2, "0")), "yyyy-MM-dd")
