"""Operators on given texts of kinds that the test tables lack: names in Japanese, amounts, dates, layouts.

Each case states its inputs with the rows that must come out.
"""

from __future__ import annotations

from types import SimpleNamespace

import duckdb
import pytest
from pyspark.sql import functions as F

from fundscope.functions import amounts as M
from fundscope.functions import eligibility, places, web
from fundscope.functions import names as N
from fundscope.operators import documents as D
from fundscope.operators import matching, merging
from fundscope.sources import readers

CASES = []


def query(sql):
    """A case: the operator's rows and those of the SQL."""
    return lambda f: CASES.append((f, sql)) or f


def _shown(v) -> str:
    return "NULL" if v is None else str(v).lower() if isinstance(v, bool) else f"{v}::BIGINT" if isinstance(v, int) else "'" + v.replace("'", "''") + "'"


def values(columns: str, rows: list[tuple]) -> str:
    return "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(_shown, r)) + ")" for r in rows) + f") v({columns})"


def texts(t, rows: list[tuple], columns: str = "text"):
    names = columns.split(", ")
    return t.spark.createDataFrame([r[: len(names)] for r in rows], ", ".join(f"{c} string" for c in names))


NAMES = [
    ("verify", "公益財団法人 ＡＢＣ財団（旧:甲）", "abc財団"),
    ("xdb", "（公財）公益財団法人　ＡＢＣ財団 (東京)", "abc財団"),
    ("import", "一般財団法人 山 田", "山田"),
    ("import_nfkc", "一般財団法人　ＡＢ会", "ab会"),
    ("core", "公益財団法人山田振興会", "山田"),
    ("core_kana", "公益財団法人ヤマーダ・基金", "ヤマダ"),
    ("loose", "(公財)山-田（東京）財団", "山田"),
    ("koeki", "特定非営利活動法人「山田。」", "山田"),
    ("abbrev", "（一財）ヤマーダ・会", "ヤマダ会"),
    ("amounts", "山田株式会社（旧：川田）", "山田"),
    ("person", "山田　太・郎", "山田太郎"),
    ("person_ws", "山田 太郎", "山田太郎"),
    ("search", "公益財団法人 Yamada（東京）", "Yamada"),
    ("codex", "公益財団法人 Ａ 会", "Ａ会"),
    ("dedup", "Ａ／Ｂ財団", "__compound__Ａ／Ｂ財団"),
    ("dedup", "（学）株式会社１２会 (x)", "12会"),
    ("audit", "公益財団法人 A 会", "A会"),
]


@query(values("profile, raw, key", NAMES))
def name_profiles_japanese(t):
    df, key = texts(t, NAMES, "profile, raw"), None
    for p in dict.fromkeys(r[0] for r in NAMES):
        here = N.normalize_name(F.col("raw"), p)
        key = F.when(F.col("profile") == p, here) if key is None else key.when(F.col("profile") == p, here)
    return df.withColumn("key", key)


AFFILIATIONS = [("東京大学大学院 理学系", "東京大学", None), ("国立大学法人京都大学医学部", "京都大学", "京都大学"), ("阪大", "大阪大学", None), ("北里大学医学部", "北里大学", "北里大学"), ("理化学研究所", "理化学研究所", "理化学研究所")]
AFFILIATIONS = [(a, b, "東京大学" if a.startswith("東京") else c) for a, b, c in AFFILIATIONS]


@query(values("text, institution, core", AFFILIATIONS))
def affiliations(t):
    return texts(t, AFFILIATIONS).select("text", N.affiliation(F.col("text")).alias("institution"), N.institution_core(F.col("text"), drop_prefix=True).alias("core"))


TIERED = [("東京大学", "elite"), ("北里大学", "university"), ("Univ X", "university"), ("理化学研究所", "institute"), ("", None), (None, None)]


@query(values("text, tier", TIERED))
def institution_tiers(t):
    return texts(t, TIERED).select("text", N.institution_tier(F.col("text"), ["東京大学"]).alias("tier"))


POSITIONS = [("東大 准教授", "東大", "准教授", False, "東大 "), ("東大", "東大", None, False, "東大"), ("特任助教（兼）", "特任助教（兼）", None, True, "特任助"), (" ", " ", None, None, " ")]


@query(values("text, affiliation, position, early, short", POSITIONS))
def position_parts(t):
    c = F.col("text")
    return texts(t, POSITIONS).withColumn("x", N.position_split(c, ["教授", "准教授"])).select("text", "x.affiliation", "x.position", N.early_career(c, ["助教", "研究員"]).alias("early"), N.position_short(c, 3).alias("short"))


FORMS = [("公益財団法人A", "公益財団法人", False), ("A財団", "公益財団法人", True), ("A", None, False), ("社会福祉法人 B会", "社会福祉法人", False)]


@query(values("text, form, inferred", FORMS))
def legal_forms(t):
    return texts(t, FORMS).withColumn("x", N.legal_form_inferred(F.col("text"))).select("text", "x.form", "x.inferred")


AGREE = [("東京大学医", "東京大学理", True), ("会社甲乙", "別物", False), ("", "東京大学", None), ("理化学研", "独立理化学研", True)]


@query(values("a, b, agrees", AGREE))
def affiliation_agreement(t):
    return texts(t, AGREE, "a, b").withColumn("agrees", N.affiliation_agrees(F.col("a"), F.col("b")))


LINKS = [("甲株式会社", "東京大学", "7", False, True), ("乙高校", "丙病院", "8", False, False), ("東京大学 理学部", "東京大学", "9", True, False), ("", "東京大学", "10", None, False), ("京都大学", "大阪大学", "11", False, False)]


@query(values("affiliation, institution, rid, match, demoted", [(a, i, None if d else r, None if d else m, d) for a, i, r, m, d in LINKS]))
def link_demotion(t):
    x = N.demote_links(texts(t, LINKS, "affiliation, institution, rid"), "affiliation", "institution", "rid")
    return x.select("affiliation", "institution", "rid", "match", F.col("demotion").isNotNull().alias("demoted"))


SQUEEZED = [("東 京 大 学 A B", "東京大学 A B"), ("A　B", "A　B"), ("研 究 助 成 1 000", "研究助成 1 000")]


@query(values("text, squeezed", SQUEEZED))
def squeezed_japanese(t):
    return texts(t, SQUEEZED).withColumn("squeezed", N.squeeze_japanese(F.col("text")))


STRICT = [("5億6,710万円", 567_100_000), ("3億", 300_000_000), ("999円", None), ("2000000円", 2_000_000), ("約3億", None)]


@query(values("text, yen", STRICT))
def strict_amounts(t):
    return texts(t, STRICT).withColumn("yen", M.strict_yen(F.col("text")))


SHOWN = [("120000000", "千円", "1.2億円", 120_000_000_000), ("50000", "万円", "5万円", 500_000_000), ("999", "円", "999円", 999)]


@query(values("amount, unit, shown, yen", SHOWN))
def shown_amounts(t):
    a = F.col("amount").cast("long")
    return texts(t, SHOWN, "amount, unit").withColumns({"shown": M.show_yen(a), "yen": M.scaled(a, F.col("unit")).cast("long")})


YEARS = [("h24", 2012, None, None), ("平成2", 1990, None, None), ("R2", 2020, 2020, None), ("令和３", 2021, None, None), ("2020", 2020, 2020, None), ("/report2023.pdf", None, 2023, None), ("/r5/x.pdf", None, 2023, None), ("２０２４年4月1日", None, None, "2024-04-01"), ("2024/02/30", None, 2024, None), ("2024-12-05", None, 2024, "2024-12-05")]


@query(values("text, year, in_url, day", YEARS))
def years_and_dates(t):
    c = F.col("text")
    return texts(t, YEARS).withColumns({"year": M.western_year(c).cast("long"), "in_url": M.year_from_url(c, 2018, 2025).cast("long"), "day": M.iso_date(c).cast("string")})


ESTIMATES = [("2024est", 2024, True), ("2024codex", 2024, False), ("x", None, False)]


@query(values("text, year, estimate", ESTIMATES))
def year_estimates(t):
    return texts(t, ESTIMATES).withColumn("x", M.year_and_estimate(F.col("text"))).select("text", F.col("x.year").cast("long").alias("year"), "x.estimate")


SITES = [("https://a.or.jp/", 10 + 3, 6 + 1), ("https://b.go.jp/x", 8, 4), ("http://c.ac.jp", 8 + 3, 4 + 1), ("https://d.org/", 6 + 3, 3 + 1), ("https://e.jp/x", 4, 3), ("https://f.com/", 2 + 3, 1)]


@query(values("url, trust, site", SITES))
def trust_weights(t):
    return texts(t, SITES, "url").withColumns({"trust": web.trust(F.col("url")).cast("long"), "site": web.trust_of_site(F.col("url")).cast("long")})


TABLE = '<table><tr><th>名</th><td>A</td></tr><tr><th>URL</th><td><a href="http://a">x</a></td></tr><tr><td>no label</td></tr></table>'


@query(values("id, label, value, href", [("p", "名", "A", None), ("p", "URL", "x", "http://a")]))
def html_table_rows(t):
    return readers.html_rows(texts(t, [("p", TABLE)], "id, html"), "id", "html").select("id", "label", "value", "href")


@query(values("id, hit, before, after", [("p", "100万円", "助成は", "、総額"), ("p", "１億円", "、総額", "まで")]))
def money_mentions(t):
    found = readers.money_mentions(texts(t, [("p", "助成は100万円、総額１億円まで"), ("q", None), ("r", "")], "id, text"), "id", "text", 3)
    return found.select("id", "hit", "before", "after")


def _lines(t, rows: list[str], doc: str = "d"):
    return t.spark.createDataFrame([(doc, k, x) for k, x in enumerate(rows)], "doc string, pos int, text string")


def _cells(t, rows: list[list[str]]):
    return t.spark.createDataFrame([("d", k, x) for k, x in enumerate(rows)], "doc string, pos int, cells array<string>")


RECORD = "pos, section, name, affiliation, title, amount"


def _records(df):
    return df.select(F.col("pos").cast("long").alias("pos"), "section", "name", "affiliation", "title", F.col("amount").cast("long").alias("amount"))


@query(values(RECORD, [(1, "部門A", "Ann", "X大学", "研究一", 5000), (2, "部門A", "Bob", "Y", "研究二", None), (4, "部門B", "Cy", "Z", "研究三", 70)]))
def layout_sections(t):
    cells = _cells(t, [["部門A"], ["Ann", "X大学", "研究一", "5,000円"], ["Bob", " Y ", "研究二"], ["部門B"], ["Cy", "Z", "研究三", "70円"], ["x"]])
    return _records(D.parse("sectioned", cells, header=F.startswith(F.get("cells", F.lit(0)), F.lit("部門"))))


@query(values(RECORD, [(2, "SECTION A", "* Ann", "Univ X", "title one", None), (5, "SECTION B", "* Cy", "", "", None)]))
def layout_anchors(t):
    lines = _lines(t, ["SECTION A", "title one", "* Ann", "Univ X", "SECTION B", "* Cy"])
    return _records(D.parse("anchored", lines, anchor=F.startswith("text", F.lit("*")), header=F.startswith("text", F.lit("SECTION"))))


@query(values(RECORD, [(0, None, "Ann", "X", "t1", 1000), (2, None, "Bob", "Y", None, None), (3, None, "Cy", "Z", None, None)]))
def layout_pairs(t):
    return _records(D.parse("paired", _cells(t, [["Ann", "X"], ["t1", "1,000円"], ["Bob", "Y"], ["Cy", "Z"]]), is_first=F.get("cells", F.lit(0)) != "t1"))


@query(values(RECORD, [(0, None, "Ann", "X", "more", 500_000), (2, None, "Bob", "Y", "t", 1_000_000)]))
def layout_trailing(t):
    return _records(D.parse("trailing_amount", _cells(t, [["Ann", "X", "50"], ["more"], ["Bob", "Y", "t", "1,00"]])))


@query(values(RECORD, [(0, None, "Ann", None, None, 5), (1, None, "Bob", None, "t", None)]))
def layout_tags(t):
    tags = t.spark.createDataFrame([("d", 0, "n", "Ann"), ("d", 0, "a", "5円"), ("d", 1, "n", " Bob "), ("d", 1, "t", "t")], "doc string, pos int, class string, text string")
    return _records(D.parse("tagged", tags, classes={"name": "n", "amount": "a", "title": "t"}))


STATEMENTS = {
    "a": ["事業費 11,000,000 22,000,000", "助 成 金 支 出 33,000,000 44,000,000", "Ⅰ 資産合計 90,000,000 99,000,000", "負債及び正味財産合計 95,000,000", "資産合計 91,000,000"],
    "b": ["当年の助成金総額は5億6,710万円です", "正味財産合計 70,000,000 80,000,000"],
    "c": ["本文 99,000,000"],
}


@query(values("doc, grants, grants_from, assets, assets_from", [("a", 44_000_000, "助成金支出", 91_000_000, "資産合計"), ("b", 567_100_000, "narrative", 70_000_000, "正味財産合計"), ("c", None, None, None, None)]))
def statement_figures(t):
    lines = None
    for doc, rows in STATEMENTS.items():
        part = _lines(t, rows, doc)
        lines = part if lines is None else lines.unionByName(part)
    return D.statement(lines)


@query(values("url", [("http://y.com", ), ("http://x.com/1", )]))
def links_outside(t):
    page = '<a href="http://x.com/1">a</a><table class="infobox"><a href="http://y.com">b</a></table><a href="http://own.org/z">c</a>'
    return D.external_links(texts(t, [("1", page)], "id, html"), "id", "html", "own.org").select("url")


@query(values("url", [("http://a.org/2023",), ("http://a.org/r5",), ("http://a.org/2024",), ("http://a.org/r6",)]))
def disclosure_urls(t):
    return D.disclosure_candidates(texts(t, [("1", "a.org")], "id, host"), ["http://{host}/{yyyy}", "http://{host}/r{r}"], [2023, 2024]).select("url")


def _keyed(t, rows: list[tuple]):
    return t.spark.createDataFrame(rows, "k string, n long, v string, w string")


@query(values("k, v, w", [("a", "y", "q"), ("b", "old", "p"), ("c", "z", None), (None, "null2", "n")]))
def upsert_repeated_and_null_keys(t):
    """Rows of one key take effect in order, and NULL is a key."""
    current = _keyed(t, [("a", 0, "x", "o"), ("b", 0, "old", "o"), (None, 0, "null", "n")])
    incoming = _keyed(t, [("a", 1, "x2", "q"), ("a", 2, "y", None), ("b", 1, None, "p"), ("c", 1, "z", None), ("c", 0, "early", None), (None, 5, "null2", None)])
    return merging.upsert(current, incoming, ["k"], ["v", "w"], [F.col("n")])[0]


@query(values("k, v", [("a", "late"), ("b", "kept"), ("c", None), (None, None)]))
def fill_repeated_keys(t):
    current = _keyed(t, [("a", 0, "", None), ("b", 0, "kept", None), ("c", 0, None, None), (None, 0, "", None)])
    incoming = _keyed(t, [("a", 1, "early", None), ("a", 2, "late", None), ("a", 3, "", None), ("b", 1, "new", None), (None, 1, "x", None)])
    return merging.fill_blanks(current, incoming, "k", ["v"], order=[F.col("n")]).select("k", "v")


@query(values("k, v, audit", [("a", None, "v|bad|one"), ("a", None, "v|worse|two"), ("a", "good", None), ("b", "bad", None)]))
def corrections_of_one_key(t):
    current = _keyed(t, [("a", 0, "bad", None), ("a", 1, "worse", None), ("a", 2, "good", None), ("b", 0, "bad", None)])
    named = t.spark.createDataFrame([("a", "bad", "one"), ("a", "worse", "two"), ("a", "bad", "one")], "k string, bad string, reason string")
    return merging.correct(current, named, "k", "v").select("k", "v", "audit")


SHORT, LONG = ["公益財団法人山田", "一般財団法人", "法人山", "財団法人川", "公益財団法人"], ["公益財団法人山田会", "一般財団法人川田", "山田"]


@query(values("s, t", [("公益財団法人山田", "公益財団法人山田会"), ("一般財団法人", "一般財団法人川田"), ("財団法人川", "一般財団法人川田"), ("公益財団法人", "公益財団法人山田会")]))
def contained_names(t):
    """Names that share their beginnings meet at their rarest part."""
    side = lambda xs, i, c: texts(t, [(x, x) for x in xs], f"{i}, {c}")
    return matching.contained_pairs(side(SHORT, "short_id", "s"), side(LONG, "long_id", "t")).select(F.col("short_id").alias("s"), F.col("long_id").alias("t"))


_ADDRESSES = [("東京都千代田区丸の内1", "東京都", "千代田区"), ("京都府京都府京都市左京区", "京都府", "京都市"), ("北海道札幌市", "北海道", "札幌市"), ("ロンドン", None, None), ("", None, None)]
_LIT = lambda v: "NULL" if v is None else f"'{v}'"


@query("SELECT * FROM (VALUES " + ", ".join(f"({_LIT(a)}, {_LIT(p)}, {_LIT(m)})" for a, p, m in _ADDRESSES) + ") v(address, prefecture, municipality)")
def address_split(t):
    df = t.spark.createDataFrame([(a,) for a, _, _ in _ADDRESSES], "address string")
    return df.withColumn("x", places.split_address(F.col("address"))).select("address", "x.prefecture", "x.municipality")


_PLACES = [("本部は大阪府です", "大阪府", "prefecture"), ("甲大学の研究室", "愛知県", "university"), ("横浜市の財団", "神奈川県", "city"), ("広島の会", "広島県", "short"), ("不明", None, None)]


@query("SELECT * FROM (VALUES " + ", ".join(f"({_LIT(a)}, {_LIT(p)}, {_LIT(m)})" for a, p, m in _PLACES) + ") v(text, value, method)")
def prefecture_cascade(t):
    df = t.spark.createDataFrame([(a,) for a, _, _ in _PLACES], "text string")
    return df.withColumn("x", places.cascade(F.col("text"), {"甲大学": "愛知県"}, {"横浜": "神奈川県"})).select("text", "x.value", "x.method")


_CALLS = [
    ("35歳以下の助教", "35歳以下", "助教", None, "pi_early"),
    ("博士課程の留学生", None, "博士課程", "留学生対応あり", "phd_candidate"),
    ("満 45 歳、教授、国籍は問わない", "満45歳", "教授", "国籍不問", "pi_mid"),
    ("研究者", None, None, None, "unrestricted"),
    ("若手歓迎", "若手研究者", None, None, "pi_early"),
    ("記念品", None, None, None, None),
]


@query("SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(_LIT, r)) + ")" for r in _CALLS) + ") v(text, age, position, nationality, stage)")
def eligibility_extract(t):
    df = t.spark.createDataFrame([(r[0],) for r in _CALLS], "text string")
    c = F.col("text")
    df = df.withColumns({"age": eligibility.ages(c), "position": eligibility.listed(c, eligibility.POSITIONS), "nationality": eligibility.nationality(c)})
    return df.withColumn("stage", eligibility.career_stage(c, F.col("age"), F.col("position")))


_YEN = [("5,000,000円", 5_000_000, None), ("1億2,000万円", None, 120_000_000), ("1.5億円", None, 150_000_000), ("3千万円", None, 30_000_000), ("100百万円", None, 100_000_000), ("５０万円", None, 500_000), ("no unit", None, None)]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{s}', {'NULL' if a is None else a}::BIGINT, {'NULL' if b is None else b}::BIGINT)" for s, a, b in _YEN) + ") v(text, plain, parsed)")
def yen_parse(t):
    df = t.spark.createDataFrame([(s,) for s, _, _ in _YEN], "text string")
    return df.select("text", F.when(~F.col("text").rlike("[億万]"), M.plain_yen(F.col("text"))).alias("plain"), M.parse_yen(F.col("text")).alias("parsed"))


@pytest.mark.parametrize("case, sql", CASES, ids=[f.__name__ for f, _ in CASES])
def test_given_texts(spark, case, sql):
    df = case(SimpleNamespace(spark=spark))
    columns = sorted(df.columns)
    want = duckdb.connect().execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
    assert sorted(map(tuple, df.select(columns).collect()), key=repr) == sorted(want, key=repr)
