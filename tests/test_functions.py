import pytest
from pyspark.sql import functions as F

from fundscope.functions import amounts, names, structured, web


@pytest.fixture
def one(spark):
    """Values of an expression over texts."""

    def get(f, *texts):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        return [r.v for r in df.select("i", f(F.col("t")).alias("v")).orderBy("i").collect()]

    return get


@pytest.mark.parametrize(
    ("profile", "raw", "key"),
    [
        ("verify", "公益財団法人 ＡＢＣ財団（旧:甲）", "abc財団"),
        ("xdb", "（公財）公益財団法人　ＡＢＣ財団 (東京)", "abc財団"),
        ("import", "一般財団法人 山 田", "山田"),
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
    ],
)
def test_name_profiles(one, profile, raw, key):
    assert one(lambda c: names.normalize_name(c, profile), raw, None, "") == [key, "", ""]


@pytest.mark.parametrize("profile", ["verify", "import", "koeki", "abbrev", "person", "pref"])
def test_profiles_are_idempotent(one, profile):
    raw = ["公益財団法人 Ａ会", "（公財）Ｂ・Ｃ", "株式会社 D", "plain name"]
    first = one(lambda c: names.normalize_name(c, profile), *raw)
    assert one(lambda c: names.normalize_name(c, profile), *first) == first


def test_affiliations_and_the_alias_quirk(one):
    raw = ["東京大学大学院 理学系", "国立大学法人 京都大学 医学部", "阪大", "北里大学医学部", "理化学研究所", None]
    assert one(names.affiliation, *raw) == ["東京大学", "京都大学", "大阪大学", "北里大学", "理化学研究所", ""]
    assert one(lambda c: names.affiliation(c, parity=True), "東京大学") == ["京都大学"]


def test_institutions_positions_and_flags(one):
    assert one(names.institution_core, "名古屋大学医学部", "産業技術センター東", "会社") == ["名古屋大学", "産業技術センター", None]
    assert one(lambda c: names.early_career(c, ["助教", "研究員"], ["主任研究員"]), "助教", "主任研究員", "教授", " ", None) == [True, False, False, None, None]
    assert [tuple(r) for r in one(lambda c: names.position_split(c, ["教授", "准教授"]), "東大 准教授", "東大")] == [("東大", "准教授"), ("東大", None)]
    assert one(lambda c: names.position_short(c, 3), "特任助教（兼）") == ["特任助"]
    assert one(names.squeeze_japanese, "東 京 大 学 A B") == ["東京大学 A B"]
    assert [tuple(r) for r in one(names.legal_form_inferred, "公益財団法人A", "A財団", "A")] == [("公益財団法人", False), ("公益財団法人", True), (None, False)]


def test_agreement_is_three_valued(spark):
    df = spark.createDataFrame([("東京大学医", "東京大学理"), ("会社甲乙", "別物"), ("", "東京大学"), ("理化学研", "独立理化学研")], "a string, b string")
    assert [r.v for r in df.select(names.affiliation_agrees(F.col("a"), F.col("b")).alias("v")).collect()] == [True, False, None, True]


def test_amounts(one):
    assert one(amounts.parse_yen, "1億2,000万円", "1.5億円", "3千万円", "100百万円", "５０万円", "なし", None) == [120_000_000, 150_000_000, 30_000_000, 100_000_000, 500_000, None, None]
    assert one(amounts.plain_yen, "助成 5,000,000円", "x") == [5_000_000, None]
    assert one(amounts.strict_yen, "5億6,710万円", "3億", "999円", "2000000円", "約3億") == [567_100_000, 300_000_000, None, 2_000_000, None]
    assert one(amounts.line_amounts, "a 259,953,314 1,533,349,483 12", "x") == [[259_953_314, 1_533_349_483], []]


def test_years_and_dates(one):
    assert one(amounts.western_year, "h24", "平成2", "R2", "令和３", "2020", "x") == [2012, 1990, 2020, 2021, 2020, None]
    assert one(lambda c: amounts.fiscal_year(c.cast("date")), "2024-03-31", "2024-04-01") == [2023, 2024]
    assert [str(x) if x else None for x in one(amounts.iso_date, "２０２４年4月1日", "2024/02/30", "2024-12-05")] == ["2024-04-01", None, "2024-12-05"]
    assert one(lambda c: amounts.year_from_url(c, 2018, 2025), "/report2023.pdf", "/r5/x.pdf", "/2001/") == [2023, 2023, None]
    assert [tuple(r) for r in one(amounts.year_and_estimate, "2024est", "2024codex", "x")] == [(2024, True), (2024, False), (None, False)]


def test_web(one):
    assert one(web.host, "https://WWW.a.example.com/x", "http://webb.org?q", None) == ["a.example.com", "webb.org", ""]
    assert one(lambda c: web.host(c, parity=True), "http://webb.org") == ["ebb.org"]
    assert one(web.host_anywhere, "https://x.www.a.com/", "no url") == ["x.a.com", ""]
    assert one(web.canonical, " HTTP://a.com/index.html ", "http://a.com//") == ["http://a.com", "http://a.com"]
    assert one(web.strip_tags, "<p>a&nbsp;<b>b</b>\n&amp;lt;</p>") == ["a b &lt;"]
    assert one(lambda c: web.cell_after(c, "名称"), "<tr><th>正式名称</th><td> A <i>会</i></td></tr>", "<p>") == ["A 会", None]
    assert one(lambda c: web.label_value(c, "住所"), "名: a\n住所: 東京 1\nx", "x") == ["東京 1", None]
    got = one(lambda c: web.with_context(c, "[0-9]+円", 2), "ab12円cd34円e")[0]
    assert [tuple(r) for r in got] == [("12円", "ab", "cd"), ("34円", "cd", "e")]
    assert one(web.stable_file_name, "http://a.com/r.pdf?x=1")[0].startswith("r.pdf_")


def test_json_and_arrays(one):
    assert one(structured.as_map, '{"a": 1}', "{bad", None) == [{"a": "1"}, {}, {}]
    assert one(structured.raw_or_map, "{bad") == [{"_raw_metadata": "{bad"}]
    merge = lambda c: structured.merged(structured.as_map(F.lit('{"a":"1","source":"x"}')), structured.as_map(c))
    assert one(merge, '{"a":"2","b":"3","sources":["y","x"]}') == [{"a": "1", "b": "3", "sources": '["x","y"]'}]
    assert one(lambda c: structured.csv_union(c, F.lit("b, a")), "c,a,,", None) == ["a,b,c", "a,b"]
    assert one(lambda c: structured.set_default(structured.as_map(c), "k", F.lit("v")), '{"k":"1"}', "{}") == [{"k": "1"}, {"k": "v"}]
