"""Japanese names, amounts and dates made of the tables' columns, in Spark and SQL alike, and what is read from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import amounts as M
from ..functions import eligibility, places
from ..functions import names as N
from .registry import query

_BLANKS, _FORMS, _MORE, _ENDS, _PARENS = ["", " ", "　", " 　"], ["公益財団法人", "株式会社", "（公財）", "一般社団法人", "", "NPO法人", "特定非営利活動法人"], ["", "株式会社", "(一財)", "学校法人"], ["", "財団", "振興会", "会社"], ["", "（東京）", "(x)"]


def _pick(words: list[str], index: str) -> str:
    """The SQL, for both engines, of the word at the index modulo their number."""
    return f"CASE {index} % {len(words)} " + " ".join(f"WHEN {k} THEN '{w}'" for k, w in enumerate(words)) + " END"


_RAW = "concat(" + ", ".join([_pick(_BLANKS, "id"), _pick(_FORMS, "id"), _pick(_BLANKS, "(id + CAST(floor(id / 7) AS BIGINT))"), _pick(_MORE, "CAST(floor(id / 5) AS BIGINT)"), "'Ａ・'", "replace(name, '#', '１-')", _pick(_ENDS, "CAST(floor(id / 3) AS BIGINT)"), _pick(_PARENS, "CAST(floor(id / 2) AS BIGINT)"), _pick(_BLANKS, "(id + 1)")]) + ")"
_S = "[ 　]"


def _sub(x: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({x}, '{pattern}', '{to}', 'g')"


def _drop(x: str, chars: str) -> str:
    return f"translate({x}, '{chars}', '')"


def _trim(x: str) -> str:
    return f"trim({x}, ' 　')"


def _profiles() -> dict[str, str]:
    """The SQL of every profile over the column raw, for the characters that occur in it."""
    composed = "translate(raw, '（）Ａ１　', '()A1 ')"
    latin, latin_digits = "translate(raw, 'Ａ', 'A')", "translate(raw, 'Ａ１', 'A1')"
    lead, lead_loose = rf"^(公益|一般|特定非営利活動|特例)?(財団法人|社団法人)?{_S}*", rf"^(公益|一般|特定非営利活動|認定特定非営利活動|特例)?(財団法人|社団法人)?{_S}*"
    phrase, paren = r"(公益|一般|特定非営利活動|認定特定非営利活動)?(財団|社団)?法人", rf"[（(].*?[)）]{_S}*$"
    either = N._either
    leading = lambda x, words, n: _trim(_sub(x, rf"^(?:(?:{either(words)}){_S}*){{1,{n}}}"))
    legal, more = N.LEGAL_LEADING, ["（NPO）", "(NPO)", "（特非）", "(特非)"]
    dedup = leading(_trim(latin_digits), legal + N.LEGAL_LEADING_DEDUP, 3)
    return {
        "verify": "lower(" + _sub(_sub(_sub(composed, r"[（(].*?[）)]"), either(N.LEGAL_ANYWHERE)), r"[\s　・\-_,，、。./／]+") + ")",
        "xdb": "lower(" + _drop(_sub(leading(_trim(latin), legal + N.LEGAL_LEADING_XDB, 3), paren), "　 ・()（）") + ")",
        "import": "lower(" + _drop(_sub("raw", lead), "　 ") + ")",
        "import_nfkc": "lower(" + _drop(_sub(composed, lead), "　 ") + ")",
        "core": "lower(" + _sub(_sub(_drop(_sub(_sub("raw", lead), f"({either(N.CORE_SUFFIXES)})$"), "　 "), "公益"), "法人") + ")",
        "core_kana": "lower(" + _drop(_sub(_sub("raw", lead), f"({either(N.CORE_SUFFIXES)})$"), "　 ・ー") + ")",
        "loose": "lower(" + _drop(_sub(_sub(_sub(_sub("raw", lead_loose), rf"^({either(N.LOOSE_ABBREVIATED)}){_S}*"), f"({either(N.LOOSE_SUFFIXES)})$"), r"[（(].*?[)）]"), "　 ・-ー") + ")",
        "koeki": "lower(" + _sub(_sub(composed, phrase), r"[\s　・,，.。()（）「」『』]") + ")",
        "abbrev": "lower(" + _sub(_drop(_sub(_sub(composed, f"[（(]({either(N.ABBREVIATED)})[）)]"), phrase), "ー・"), r"[\s　,，.。()（）「」『』]") + ")",
        "amounts": "lower(" + _sub(_sub(composed, r"(公益|一般|認定)?(財団|社団|特定非営利活動)?法人|株式会社|旧[：:].*|（.*?）|\(.*?\)"), r"[\s　・,，.。「」]") + ")",
        "person": _sub(composed, r"[\s　・]"),
        "person_ws": _sub("raw", r"[\s　]+"),
        "pref": "lower(" + _sub(_sub(_sub(composed, either(N.LEGAL_PREF)), r"[\s　・･]+"), r"[（）()【】「」『』、。．,.\-_/]") + ")",
        "search": _trim(_sub(leading(f"translate({_trim('raw')}, '　', ' ')", legal, 1), paren)),
        "inventory": "lower(" + _drop(_sub(leading(_trim(latin_digits), legal + more, 3), paren), "　 ・()（）") + ")",
        "audit": _sub(_sub("raw", "(公益|一般)?(財団|社団)法人|特定非営利活動法人|株式会社"), r"[\s　]+"),
        "codex": _drop(_sub("raw", rf"^(公益|一般)(財団法人|社団法人){_S}*"), "　 "),
        "dedup": f"lower(replace({_drop(f'CASE WHEN regexp_matches({dedup}, $q$^[（(]$q$) THEN {dedup} ELSE {_trim(_sub(dedup, paren))} END', ' 　・()（）')}, '株式会社', ''))",
    }


_NAMES = f"WITH n AS (SELECT id, {_RAW} AS raw FROM (SELECT c_custkey AS id, c_name AS name FROM customer) UNION ALL SELECT -id AS id, {_RAW} AS raw FROM (SELECT s_suppkey + 1 AS id, s_name AS name FROM supplier)) "


@query(_NAMES + " UNION ALL ".join(f"SELECT id, '{p}' AS profile, {sql} AS key FROM n" for p, sql in _profiles().items()))
def name_profiles_derived(t):
    """All eighteen profiles of names with legal forms, full-width letters, parentheses and blanks of both kinds."""
    one = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    two = t.supplier.select((F.col("s_suppkey") + 1).alias("id"), F.col("s_name").alias("name"))
    n = one.select("id", F.expr(_RAW).alias("raw")).unionByName(two.select((-F.col("id")).alias("id"), F.expr(_RAW).alias("raw")))
    keys = [F.struct(F.lit(p).alias("profile"), N.normalize_name(F.col("raw"), p).alias("key")) for p in (*N.PROFILES, "dedup")]
    return n.select("id", F.explode(F.array(*keys)).alias("k")).select("id", "k.profile", "k.key")


_AMOUNT = "CAST(floor(o_totalprice) AS BIGINT)"
_AMOUNTS = f"""CASE o_orderkey % 8 WHEN 0 THEN concat({_AMOUNT}, '円') WHEN 1 THEN concat(o_orderkey % 90 + 1, '億', {_AMOUNT} % 10000, '万円') WHEN 2 THEN concat('約', {_AMOUNT} % 900 + 1, '千万円')
  WHEN 3 THEN concat({_AMOUNT} % 900 + 1, '百万 円') WHEN 4 THEN concat({_AMOUNT} % 9000 + 1, '.5万円') WHEN 5 THEN concat(o_orderkey % 90 + 1, '億円') WHEN 6 THEN concat({_AMOUNT} + 1000000, '円') ELSE concat('no ', {_AMOUNT}) END"""


@query(f"""WITH a AS (SELECT o_orderkey AS id, o_orderkey % 8 AS kind, {_AMOUNT} AS p, o_orderkey % 90 + 1 AS oku FROM orders)
SELECT id, CASE kind WHEN 0 THEN p WHEN 6 THEN p + 1000000 END AS plain,
  CAST(CASE kind WHEN 1 THEN oku * 100000000 + (p % 10000) * 10000 WHEN 2 THEN (p % 900 + 1) * 10000000 WHEN 3 THEN (p % 900 + 1) * 1000000 WHEN 4 THEN (p % 9000 + 1) * 10000 + 5000 WHEN 5 THEN oku * 100000000 END AS BIGINT) AS parsed,
  CAST(CASE kind WHEN 0 THEN CASE WHEN p >= 1000000 THEN p END WHEN 1 THEN oku * 100000000 + (p % 10000) * 10000 WHEN 5 THEN oku * 100000000 WHEN 6 THEN p + 1000000 END AS BIGINT) AS strict,
  p * CASE kind % 3 WHEN 0 THEN 1000 WHEN 1 THEN 10000 ELSE 1 END AS scaled,
  CASE WHEN kind % 4 = 3 THEN '-' WHEN p >= 10000 THEN format('{{:,}}', CAST(round_even(p / 1e4, 0) AS BIGINT)) || '万円' ELSE format('{{:,}}', p) || '円' END AS shown FROM a""")
def amount_texts(t):
    """Amounts of orders written in yen, 万, 百万, 千万 and 億, read again; and shown in the unit that suits them."""
    a = t.orders.select(F.col("o_orderkey").alias("id"), F.expr(_AMOUNT).alias("p"), F.expr(_AMOUNTS).alias("text"))
    c, kind = F.col("text"), F.col("id") % 8
    unit = F.when(kind % 3 == 0, "千円").when(kind % 3 == 1, "万円").otherwise("円")
    return a.select("id", F.when(~c.rlike("[億万]"), M.plain_yen(c)).alias("plain"), M.parse_yen(c).alias("parsed"), M.strict_yen(c).alias("strict"), M.scaled(F.col("p"), unit).cast("long").alias("scaled"), M.show_yen(F.when(kind % 4 != 3, F.col("p"))).alias("shown"))


_YEAR, _MONTH, _DAY = "year(o_orderdate)", "month(o_orderdate)", "day(o_orderdate)"
_DATES = f"CASE o_orderkey % 5 WHEN 0 THEN concat({_YEAR}, '年', {_MONTH}, '月', {_DAY}, '日') WHEN 1 THEN concat({_YEAR}, '/', {_MONTH}, '/', {_DAY}) WHEN 2 THEN concat('h', {_YEAR} - 1988) WHEN 3 THEN concat({_YEAR}, CASE WHEN o_orderkey % 2 = 0 THEN 'est' ELSE '' END) ELSE concat('令和', o_orderkey % 9 + 1) END"
_URLS = f"concat('http://x.org/', CASE o_orderkey % 3 WHEN 0 THEN concat('r', o_orderkey % 12 + 1) WHEN 1 THEN concat('report', {_YEAR} + 25) ELSE 'page' END, '/index')"


@query(f"""WITH a AS (SELECT o_orderkey AS id, o_orderkey % 5 AS kind, {_YEAR} AS y, o_orderdate AS d FROM orders)
SELECT id, CAST(CASE kind WHEN 2 THEN y WHEN 3 THEN CASE WHEN id % 2 = 1 THEN y END WHEN 4 THEN 2018 + id % 9 + 1 END AS BIGINT) AS year,
  CASE WHEN kind < 2 THEN strftime(d, '%Y-%m-%d') END AS day, CAST(CASE WHEN kind IN (0, 1, 3) THEN y END AS BIGINT) AS first_year, CASE kind WHEN 3 THEN id % 2 = 0 ELSE false END AS estimate,
  CAST(CASE id % 3 WHEN 0 THEN CASE WHEN 2018 + id % 12 + 1 BETWEEN 2018 AND 2025 THEN 2018 + id % 12 + 1 END WHEN 1 THEN CASE WHEN y + 25 BETWEEN 2018 AND 2025 THEN y + 25 END END AS BIGINT) AS in_url FROM a""")
def date_texts(t):
    """Dates of orders written in four ways and years of eras, read again; years within URLs."""
    c = F.col("text")
    a = t.orders.select(F.col("o_orderkey").alias("id"), F.expr(_DATES).alias("text"), F.expr(_URLS).alias("url")).withColumn("x", M.year_and_estimate(c))
    return a.select("id", M.western_year(c).cast("long").alias("year"), M.iso_date(c).cast("string").alias("day"), F.col("x.year").cast("long").alias("first_year"), F.col("x.estimate").alias("estimate"), M.year_from_url(F.col("url"), 2018, 2025).cast("long").alias("in_url"))


_PREFIX, _BODY, _PART = ["国立大学法人", "学校法人　", "", "　"], ["東京大学", "京大", "北里大学", "阪大", "理化学研究所", "甲株式会社", ""], ["", "医学部", "大学院 理学系", "　工学部", "病院"]
_POSITIONS = ["", " 准教授", "　教授", "助教", "教授（兼）"]
_TEXT = "concat(" + ", ".join([_pick(_PREFIX, "id"), _pick(_BODY, "id"), f"CASE WHEN id % 7 < 4 THEN {_pick(_PART, 'CAST(floor(id / 7) AS BIGINT)')} ELSE '' END"]) + ")"
_OTHER = _pick(["東京大学", "北里大学病院", "独立理化学研究所", "", "東京大学医学部"], "CAST(floor(id / 3) AS BIGINT)")
_POST = f"concat({_TEXT}, {_pick(_POSITIONS, 'CAST(floor(id / 2) AS BIGINT)')})"
_TOKEN = r"([\p{Han}\p{Katakana}ー]+?(?:大学|研究所|機構|センター|病院|高専))"
_FORM = "公益財団法人 一般財団法人 公益社団法人 一般社団法人 特定非営利活動法人 学校法人 社会福祉法人 独立行政法人 国立研究開発法人 株式会社".split()


@query(f"""WITH a AS (SELECT id, {_TEXT} AS text, {_OTHER} AS other, {_POST} AS post FROM (SELECT c_custkey AS id FROM customer)),
b AS (SELECT *, CASE id % 7 WHEN 0 THEN '東京大学' WHEN 1 THEN '京都大学' WHEN 2 THEN '北里大学' WHEN 3 THEN '大阪大学' WHEN 4 THEN '理化学研究所' WHEN 5 THEN '甲株式会社' ELSE '' END AS institution,
  regexp_replace(text, '^(国立大学法人|公立大学法人|学校法人)', '') AS bare FROM a),
c AS (SELECT *, coalesce(nullif(regexp_extract(bare, '^(.+?大学)', 1), ''), nullif(regexp_extract(bare, '^(.+?(研究所|機構|センター|大学校|高専|工業高等専門学校))', 1), '')) AS core,
  nullif(regexp_extract(post, '[ 　]*((准教授|教授|助教))$', 1), '') AS position, regexp_extract_all(text, '{_TOKEN}', 1) AS mine, regexp_extract_all(other, '{_TOKEN}', 1) AS theirs FROM b)
SELECT id, institution, core, CASE WHEN institution = '東京大学' THEN 'elite' WHEN institution LIKE '%大学' THEN 'university' WHEN institution <> '' THEN 'institute' END AS tier, position,
  CASE WHEN position IS NULL THEN post ELSE regexp_extract(post, '^(.*?)[ 　]*(准教授|教授|助教)$', 1) END AS affiliation,
  CASE WHEN trim(post, ' 　') <> '' THEN regexp_matches(post, '助教|准教授') END AS early, substr(regexp_replace(post, '[（(].*$', ''), 1, 5) AS short,
  CASE WHEN text <> '' AND other <> '' THEN list_has_any(mine, theirs) OR (least(length(text), length(other)) >= 4 AND CASE WHEN length(text) <= length(other) THEN contains(other, text) ELSE contains(text, other) END) END AS agrees,
  coalesce(nullif(regexp_extract(concat(text, '基金'), '{"|".join(_FORM)}'), ''), '公益財団法人') AS form, regexp_extract(text, '{"|".join(_FORM)}') = '' AS inferred FROM c""")
def affiliation_texts(t):
    """Institutions, cores, tiers, positions, agreement and legal forms of affiliations made for every customer."""
    a = t.customer.select(F.col("c_custkey").alias("id")).select("id", F.expr(_TEXT).alias("text"), F.expr(_OTHER).alias("other"), F.expr(_POST).alias("post"))
    text, post, words = F.col("text"), F.col("post"), ["教授", "准教授", "助教"]
    a = a.withColumns({"institution": N.affiliation(text), "p": N.position_split(post, words), "f": N.legal_form_inferred(F.concat(text, F.lit("基金")))})
    return a.select(
        "id", "institution", N.institution_core(text, drop_prefix=True).alias("core"), N.institution_tier(F.col("institution"), ["東京大学"]).alias("tier"), F.col("p.position").alias("position"), F.col("p.affiliation").alias("affiliation"),
        N.early_career(post, ["助教", "准教授"]).alias("early"), N.position_short(post, 5).alias("short"), N.affiliation_agrees(text, F.col("other")).alias("agrees"), F.col("f.form").alias("form"), F.col("f.inferred").alias("inferred"),
    )


_PREF, _TOWN = ["東京都", "大阪府", "北海道", "京都府", ""], ["千代田区", "堺市北区", "札幌市中央区", "丸の内", "軽井沢町"]
_ADDRESS = "concat(" + ", ".join([_pick(_PREF, "id"), f"CASE WHEN id % 3 = 0 THEN {_pick(_PREF, 'id')} ELSE '' END", _pick(_TOWN, "CAST(floor(id / 5) AS BIGINT)"), "CAST(id AS STRING)"]) + ")"
_CALL = "concat(" + ", ".join(["CAST(20 + id % 40 AS STRING)", _pick(["歳以下の", " 歳未満、", "歳の", "件の"], "id"), _pick(["助教", "博士課程の学生", "准教授", "研究者", "記念品"], "CAST(floor(id / 4) AS BIGINT)")]) + ")"


@query(f"""WITH a AS (SELECT id, {_pick(_PREF, 'id')} AS pref, {_pick(_TOWN, 'CAST(floor(id / 5) AS BIGINT)')} AS town, id % 4 AS limit_, CAST(floor(id / 4) AS BIGINT) % 5 AS who, 20 + id % 40 AS age FROM (SELECT s_suppkey AS id FROM supplier UNION ALL SELECT c_custkey + 1000000 FROM customer))
SELECT id, nullif(pref, '') AS prefecture, CASE WHEN pref <> '' THEN CASE town WHEN '千代田区' THEN town WHEN '堺市北区' THEN '堺市' WHEN '札幌市中央区' THEN '札幌市' WHEN '軽井沢町' THEN town END END AS municipality,
  CASE WHEN pref <> '' THEN pref WHEN town LIKE '堺%' THEN '大阪府' WHEN town LIKE '札幌%' THEN '北海道' END AS found, CASE WHEN pref <> '' THEN 'prefecture' WHEN town LIKE '堺%' OR town LIKE '札幌%' THEN 'city' END AS method,
  CASE limit_ WHEN 0 THEN age || '歳以下' WHEN 1 THEN age || '歳未満' END AS ages,
  CASE WHEN who = 1 THEN 'phd_candidate' WHEN limit_ < 2 AND age <= 35 THEN 'pi_early' WHEN limit_ < 2 AND age <= 45 THEN 'pi_mid' WHEN limit_ < 2 AND age <= 55 THEN 'senior' WHEN who IN (0, 2) THEN 'pi_early' WHEN who = 3 AND limit_ >= 2 THEN 'unrestricted' END AS stage FROM a""")
def place_and_call_texts(t):
    """Prefectures and towns of addresses, and age limits and career stages of calls, made for every supplier and customer."""
    ids = t.supplier.select(F.col("s_suppkey").alias("id")).unionByName(t.customer.select((F.col("c_custkey") + 1_000_000).alias("id")))
    a = ids.select("id", F.expr(_ADDRESS).alias("address"), F.expr(_CALL).alias("call"))
    call, address = F.col("call"), F.col("address")
    a = a.withColumns({"s": places.split_address(address), "c": places.cascade(address, {"甲大学": "愛知県"}, {"堺": "大阪府", "札幌": "北海道"}), "ages": eligibility.ages(call), "position": eligibility.listed(call, eligibility.POSITIONS)})
    return a.select("id", F.col("s.prefecture").alias("prefecture"), F.col("s.municipality").alias("municipality"), F.col("c.value").alias("found"), F.col("c.method").alias("method"), "ages", eligibility.career_stage(call, F.col("ages"), F.col("position")).alias("stage"))
