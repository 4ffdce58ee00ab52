"""Document parsers: layouts of award lists as window expressions over lines or rows, and a registry of them.

All give one record: (doc, pos, section, name, affiliation, title, amount).  Windows are partitioned by document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import amounts
from . import windows

_RECORD = ("doc", "pos", "section", "name", "affiliation", "title", "amount")


def _record(df: DataFrame, **columns: Column) -> DataFrame:
    none = {"amount": F.lit(None).cast("long")}
    return df.select(*[columns.get(c, F.col(c) if c in ("doc", "pos") and c in df.columns else none.get(c, F.lit(None).cast("string"))).alias(c) for c in _RECORD])


def sectioned_rows(rows: DataFrame, header: Column, columns: int = 3, fixed: Column | None = None) -> DataFrame:
    """Rows (doc, pos, cells) under the last header: cells are name, affiliation and title, then perhaps an amount.

    Headers may span pages, as positions run through the document.
    """
    cells = lambda k: F.trim(F.get("cells", F.lit(k)))
    placed = rows.withColumn("section", windows.carried(F.when(header, cells(0)), ["doc"], [F.col("pos")]))
    body = placed.filter(~header & (F.size("cells") >= columns))
    amount = fixed if fixed is not None else amounts.plain_yen(cells(3))
    return _record(body, section=F.col("section"), name=cells(0), affiliation=cells(1), title=cells(2), amount=amount)


def anchored_lines(lines: DataFrame, anchor: Column, header: Column, before: int = 4, after: int = 5) -> DataFrame:
    """Lines (doc, pos, text): an anchor has the name, lines before it the title, lines after it the affiliation.

    Looking back stops at a header or another anchor, looking ahead likewise.
    """
    by, order = ["doc"], [F.col("pos")]
    stop = anchor | header
    marked = F.struct(F.col("text").alias("t"), F.coalesce(stop, F.lit(False)).alias("s"))
    w = Window.partitionBy(*by).orderBy(*order)
    df = lines.withColumns({"section": windows.carried(F.when(header, F.col("text")), by, order), "back": F.reverse(F.collect_list(marked).over(w.rowsBetween(-before, -1))), "ahead": F.collect_list(marked).over(w.rowsBetween(1, after))})
    taken = lambda xs: F.aggregate(
        xs,
        F.struct(F.lit(False).alias("d"), F.array().cast("array<string>").alias("k")),
        lambda s, x: F.struct((s["d"] | x["s"]).alias("d"), F.when(s["d"] | x["s"], s["k"]).otherwise(F.array_append(s["k"], x["t"])).alias("k")),
        lambda s: s["k"],
    )
    return _record(df.filter(anchor), section=F.col("section"), name=F.trim("text"), affiliation=F.trim(F.array_join(taken(F.col("ahead")), " ")), title=F.trim(F.array_join(F.reverse(taken(F.col("back"))), " ")))


def paired_rows(rows: DataFrame, is_first: Column) -> DataFrame:
    """Rows (doc, pos, cells) in pairs: name and affiliation, then title and amount; a missing second row leaves NULLs."""
    w = Window.partitionBy("doc").orderBy("pos")
    df = rows.withColumns({"first": is_first, "next": F.when(~F.lead(is_first, 1, True).over(w), F.lead("cells", 1).over(w))}).filter("first")
    cell = lambda c, k: F.nullif(F.trim(F.get(c, F.lit(k))), F.lit(""))
    return _record(df, name=cell("cells", 0), affiliation=cell("cells", 1), title=cell("next", 0), amount=amounts.plain_yen(cell("next", 1)))


def trailing_amounts(rows: DataFrame, unit: int = 10_000, look: int = 3) -> DataFrame:
    """Rows (doc, pos, cells) with an amount in the last cell; single-cell rows right after it continue the title."""
    w = Window.partitionBy("doc").orderBy("pos").rowsBetween(1, look)
    df = rows.withColumn("ahead", F.collect_list("cells").over(w)).filter((F.size("cells") >= 3) & F.element_at("cells", -1).rlike(r"^[0-9０-９,，]+$"))
    more = windows.until(F.transform("ahead", lambda c: F.when(F.size(c) == 1, c[0]).otherwise("\x00")), lambda x: x == "\x00")
    value = F.regexp_replace(amounts.half_digits(F.element_at("cells", -1)), ",", "").try_cast("long") * unit
    return _record(df, name=F.trim(F.get("cells", F.lit(0))), affiliation=F.trim(F.get("cells", F.lit(1))), title=F.trim(F.concat_ws(" ", F.when(F.size("cells") > 3, F.get("cells", F.lit(2))), F.array_join(more, " "))), amount=value)


def tagged_cells(cells: DataFrame, classes: dict[str, str]) -> DataFrame:
    """Cells (doc, pos, class, text) to records by their class names; ``classes``: field -> class."""
    value = {field: F.max(F.when(F.col("class") == c, F.trim("text"))) for field, c in classes.items()}
    out = cells.groupBy("doc", "pos").agg(*[v.alias(k) for k, v in value.items()])
    return _record(out, **{k: F.col(k) if k != "amount" else amounts.plain_yen(F.col(k)) for k in classes})


def statement_lines(lines: DataFrame, keywords: list[str], least: int = 1_000_000) -> DataFrame:
    """(doc, keyword, amount): of lines that start with a keyword, the first keyword's largest amount."""
    text = F.regexp_replace("text", r"^[\s　0-9０-９.()（）①-⑳Ⅰ-Ⅻ]*", "")
    which = F.lit(None).cast("int")
    for k, w in reversed(list(enumerate(keywords))):
        which = F.when(F.startswith(text, F.lit(w)), k).otherwise(which)
    found = lines.withColumns({"k": which, "amount": amounts.largest_amount(F.col("text"), least)}).filter("k is not null and amount is not null")
    names = F.array(*map(F.lit, keywords))
    return windows.first_per_key(found, ["doc"], [F.col("k"), F.desc("amount"), F.col("pos")]).select("doc", F.element_at(names, F.col("k") + 1).alias("keyword"), "amount")


# Keywords of statement lines by priority, of balance sheets, and of amounts told in prose.
GRANT_LINES = ["助成事業費", "公益目的事業費", "助成金支出", "事業費計", "研究助成事業", "事業費", "助成事業"]
ASSET_LINES, ASSET_LINES_ELSE = ["資産合計", "総資産"], ["正味財産合計"]
TOLD = r"(?:研究助成金の支払総額|助成金総額|助成金支出総額)[はをが、]*([0-9０-９,，]{1,4}億[0-9０-９,，]{0,5}万?円?|[0-9０-９,，]{4,}\s*円)"


def asset_lines(lines: DataFrame, keywords: list[str], least: int = 10_000_000) -> DataFrame:
    """(doc, keyword, amount): of lines that start with a keyword the first amount, which is the current year's; the largest."""
    text = F.regexp_replace("text", r"^[\s　□■・(（ⅠⅡⅢⅣⅤ１-９0-9.]*", "")
    which = F.lit(None).cast("string")
    for w in reversed(keywords):
        which = F.when(F.startswith(text, F.lit(w)), w).otherwise(which)
    found = lines.withColumns({"keyword": which, "amount": F.get(amounts.line_amounts(F.col("text"), least), F.lit(0))}).filter("keyword is not null and amount is not null")
    return windows.first_per_key(found, ["doc"], [F.desc("amount"), F.col("pos")]).select("doc", "keyword", "amount")


def told_amounts(lines: DataFrame) -> DataFrame:
    """(doc, amount): the first amount of grants that a line's prose tells."""
    found = lines.withColumn("amount", amounts.strict_yen(F.regexp_replace(F.nullif(F.regexp_extract("text", TOLD, 1), F.lit("")), r"\s", "")))
    return windows.first_per_key(found.filter("amount is not null"), ["doc"], [F.col("pos")]).select("doc", "amount")


def statement(lines: DataFrame, least: int = 10_000_000) -> DataFrame:
    """(doc, grants, grants_from, assets, assets_from) of the lines (doc, pos, text) of financial statements.

    Grants are the best statement line, else what the prose tells; assets are a balance line, else net assets.  Blanks
    between Japanese characters don't count.  A document without any of them has NULLs.
    """
    from ..functions.names import squeeze_japanese

    lines = lines.withColumn("text", squeeze_japanese(F.col("text")))
    docs = lines.select("doc").distinct()
    best = lambda df, name: df.select("doc", F.col("amount").alias(name), F.col("keyword").alias(f"{name}_from"))
    grants, told = best(statement_lines(lines, GRANT_LINES, least), "g"), told_amounts(lines).select("doc", F.col("amount").alias("t"))
    one, two = best(asset_lines(lines, ASSET_LINES, least), "a"), best(asset_lines(lines, ASSET_LINES_ELSE, least), "n")
    out = docs.join(grants, "doc", "left").join(told, "doc", "left").join(one, "doc", "left").join(two, "doc", "left")
    prose = F.when(F.col("t").isNotNull(), "narrative")
    return out.select("doc", F.coalesce("g", "t").alias("grants"), F.when(F.col("g").isNotNull(), F.col("g_from")).otherwise(prose).alias("grants_from"), F.coalesce("a", "n").alias("assets"), F.coalesce("a_from", "n_from").alias("assets_from"))


def external_links(html: DataFrame, key: str, column: str, own: str) -> DataFrame:
    """(key, place, url): links that leave the site, in order, those of an info box first."""
    links = lambda text, base: F.transform(F.regexp_extract_all(text, F.lit(r"(?i)href=[\"'](https?://[^\"']+)"), F.lit(1)), lambda u, k: F.struct((k + base).alias("place"), u.alias("url")))
    box = F.regexp_extract(column, r"(?is)<table[^>]*infobox[^>]*>(.*?)</table>", 1)
    both = F.concat(links(box, F.lit(0)), links(F.col(column), F.lit(1_000_000)))
    out = html.select(key, F.explode(both).alias("x")).select(key, "x.place", "x.url").filter(~F.contains("url", F.lit(own)))
    return windows.first_per_key(out, [key, "url"], [F.col("place")])


def disclosure_candidates(orgs: DataFrame, templates: list[str], years: list[int]) -> DataFrame:
    """(id, year, url): a template's '{host}', '{yyyy}' and '{r}' (Reiwa year) filled for every year."""
    each = orgs.select("id", "host", F.explode(F.array(*map(F.lit, years))).alias("year")).withColumn("t", F.explode(F.array(*map(F.lit, templates))))
    url = F.replace(F.replace(F.replace("t", F.lit("{host}"), F.col("host")), F.lit("{yyyy}"), F.col("year").cast("string")), F.lit("{r}"), (F.col("year") - 2018).cast("string"))
    return each.select("id", "year", url.alias("url")).distinct()


#: Layout name -> parser; a collector's landing table names its layout.
PARSERS: dict[str, Callable[..., DataFrame]] = {"sectioned": sectioned_rows, "anchored": anchored_lines, "paired": paired_rows, "trailing_amount": trailing_amounts, "tagged": tagged_cells, "statement": statement_lines}


def parse(layout: str, df: DataFrame, **options) -> DataFrame:
    return PARSERS[layout](df, **options)
