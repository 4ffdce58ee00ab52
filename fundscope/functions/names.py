"""Names of organisations and people: normalisation profiles.

Profiles differ on purpose; each serves one kind of match and none replaces another.  A profile is a list of steps that
become one chain of built-in expressions; only ``nfkc`` needs Python, as an Arrow UDF.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import BLANKS, strip

# Legal forms and their abbreviations, as they occur in names.
LEGAL_ANYWHERE = ["公益財団法人", "一般財団法人", "公益社団法人", "一般社団法人", "特定非営利活動法人", "NPO法人", "株式会社", "有限会社", "学校法人", "独立行政法人", "国立大学法人", "社会福祉法人", "宗教法人"]
LEGAL_LEADING = ["公益財団法人", "一般財団法人", "公益社団法人", "一般社団法人", "特定非営利活動法人", "認定特定非営利活動法人", "ＮＰＯ法人", "NPO法人", "株式会社", "有限会社", "公益財団", "一般財団", "公益社団", "一般社団", "（公財）", "(公財)", "（一財）", "(一財)", "（公社）", "(公社)", "（一社）", "(一社)", "（独法）", "(独法)", "（株）", "(株)", "（有）", "(有)"]
LEGAL_LEADING_XDB = ["社会福祉法人", "学校法人", "独立行政法人", "国立研究開発法人"]
LEGAL_LEADING_DEDUP = ["（NPO）", "(NPO)", "（特非）", "(特非)", "社会福祉法人", "学校法人", "宗教法人", "医療法人", "独立行政法人", "国立研究開発法人", "国立大学法人", "（社福）", "(社福)", "（学）", "(学)", "（独）", "(独)", "（特）", "(特)"]
LEGAL_PREF = ["公益財団法人", "一般財団法人", "公益社団法人", "一般社団法人", "特定非営利活動法人", "特活", "ＮＰＯ法人", "NPO法人", "（公財）", "（一財）", "（公社）", "（一社）", "（特）", "(NPO)", "(公財)", "(一財)", "(公社)", "(一社)", "株式会社", "有限会社", "（株）", "（有）", "(株)", "(有)", "独立行政法人", "国立研究開発法人", "国立大学法人", "公立大学法人", "学校法人", "宗教法人", "社会福祉法人", "財団法人", "社団法人"]
CORE_SUFFIXES = ["財団", "基金", "振興会", "奨学会", "事業団", "研究会", "学会", "協会", "機構", "センター"]
LOOSE_SUFFIXES = [*CORE_SUFFIXES, "株式会社", "会社", "法人", "財団法人", "社団法人"]
ABBREVIATED = ["公財", "公社", "一財", "一社", "特非", "社福", "独", "国", "地独", "福", "学", "宗", "財", "社", "一", "特", "医", "地財", "学財"]
LOOSE_ABBREVIATED = ["(公財)", "（公財）", "(一財)", "（一財）", "(公社)", "（公社）", "(一社)", "（一社）", "(独)", "（独）"]

# Patterns of what profiles cut off.
_S = BLANKS
_TRAILING_PAREN = rf"[（(].*?[)）][{_S}]*$"
_LEAD = rf"^(公益|一般|特定非営利活動|特例)?(財団法人|社団法人)?[{_S}]*"
_LEAD_LOOSE = rf"^(公益|一般|特定非営利活動|認定特定非営利活動|特例)?(財団法人|社団法人)?[{_S}]*"
_PHRASE = r"(公益|一般|特定非営利活動|認定特定非営利活動)?(財団|社団)?法人"
_DOTS = rf"[{_S}・,，.。()（）「」『』]"


@F.pandas_udf(StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Unicode compatibility composition; NULL stays NULL."""
    return texts.map(lambda s: unicodedata.normalize("NFKC", s), na_action="ignore")


def _either(words: list[str]) -> str:
    """Alternation that tries the words in their order."""
    return "|".join(re.sub(r"([()|.*+?\[\]{}^$\\])", r"\\\1", w) for w in words)


def sub(pattern: str, to: str = ""):
    return lambda c: F.regexp_replace(c, pattern, to)


def leading(words: list[str], times: int):
    """Up to ``times`` leading words off, each the first of the list that fits."""
    return lambda c: strip(F.regexp_replace(c, rf"^(?:(?:{_either(words)})[{_S}]*){{1,{times}}}", ""))


def halfwidth(digits: bool):
    """Full-width Latin letters, and digits, to their half-width forms."""
    wide = "".join(chr(0xFEE0 + ord(c)) for c in _latin(digits))
    return lambda c: F.translate(c, wide, _latin(digits))


def _latin(digits: bool) -> str:
    letters = "".join(map(chr, [*range(65, 91), *range(97, 123)]))
    return letters + "0123456789" if digits else letters


def _drop(chars: str):
    return lambda c: F.translate(c, chars, "")


#: Profile -> steps; every profile starts from '' for NULL.
PROFILES: dict[str, list] = {
    "verify": [nfkc, sub(r"[（\(].*?[）\)]"), sub(_either(LEGAL_ANYWHERE)), sub(rf"[{_S}・\-_,，、。\.／/]+"), strip, F.lower],
    "xdb": [strip, halfwidth(False), leading(LEGAL_LEADING + LEGAL_LEADING_XDB, 3), sub(_TRAILING_PAREN), strip, _drop("　 ・()（）"), F.lower],
    "import": [sub(_LEAD), _drop("　 "), F.lower],
    "import_nfkc": [nfkc, sub(_LEAD), _drop("　 "), F.lower],
    "core": [sub(_LEAD), sub(rf"({_either(CORE_SUFFIXES)})$"), _drop("　 "), sub("公益"), sub("法人"), F.lower],
    "core_kana": [sub(_LEAD), sub(rf"({_either(CORE_SUFFIXES)})$"), _drop("　 ・ー"), F.lower],
    "loose": [sub(_LEAD_LOOSE), sub(rf"^({_either(LOOSE_ABBREVIATED)})[{_S}]*"), sub(rf"({_either(LOOSE_SUFFIXES)})$"), sub(r"[（(].*?[)）]"), _drop("　 ・-ー"), F.lower, strip],
    "koeki": [nfkc, sub(_PHRASE), sub(_DOTS), strip, F.lower],
    "abbrev": [nfkc, sub(rf"[（(]({_either(ABBREVIATED)})[）)]"), sub(_PHRASE), _drop("ー・"), sub(rf"[{_S},，.。()（）「」『』]"), strip, F.lower],
    "amounts": [nfkc, sub(r"(公益|一般|認定)?(財団|社団|特定非営利活動)?法人|株式会社|旧[：:].*|（.*?）|\(.*?\)"), sub(rf"[{_S}・,，.。「」]"), strip, F.lower],
    "person": [nfkc, sub(rf"[{_S}・]")],
    "person_ws": [sub(rf"[{_S}]+")],
    "pref": [nfkc, sub(_either(LEGAL_PREF)), sub(rf"[{_S}・･]+"), sub(r"[（）()【】「」『』、。．,.\-_/]"), F.lower],
    "search": [strip, lambda c: F.translate(c, "　", " "), leading(LEGAL_LEADING, 1), sub(_TRAILING_PAREN), strip],
    "inventory": [halfwidth(True), strip, leading(LEGAL_LEADING + ["（NPO）", "(NPO)", "（特非）", "(特非)"], 3), sub(_TRAILING_PAREN), _drop("　 ・()（）"), F.lower],
    "audit": [sub(r"(公益|一般)?(財団|社団)法人|特定非営利活動法人|株式会社"), sub(rf"[{_S}]+")],
    "codex": [sub(rf"^(公益|一般)(財団法人|社団法人)[{_S}]*"), _drop("　 "), strip],
}


def normalize_name(c: Column, profile: str) -> Column:
    """The name's key in one of ``PROFILES``, or ``dedup``; NULL becomes ''."""
    if profile == "dedup":
        return _dedup(c)
    c = F.coalesce(c, F.lit(""))
    for step in PROFILES[profile]:
        c = step(c)
    return c


def _dedup(c: Column) -> Column:
    """Like ``xdb`` with more prefixes; joint programmes (names with a slash) keep a key of their own."""
    name = strip(F.coalesce(c, F.lit("")))
    key = leading(LEGAL_LEADING + LEGAL_LEADING_DEDUP, 3)(halfwidth(True)(name))
    key = F.when(F.substring(key, 1, 1).isin("（", "("), key).otherwise(strip(F.regexp_replace(key, _TRAILING_PAREN, "")))
    key = F.lower(F.regexp_replace(F.translate(key, "　 ・()（）", ""), "株式会社", ""))
    return F.when(name == "", "").when(name.rlike("[／/]"), F.concat(F.lit("__compound__"), name)).otherwise(key)


def squeezed(c: Column, compose: bool = True) -> Column:
    """White space collapsed and trimmed; NULL becomes ''."""
    c = F.coalesce(c, F.lit(""))
    return strip(F.regexp_replace(nfkc(c) if compose else c, rf"[{_S}]+", " "))


# Short and English names of universities, and what is cut off an affiliation.
UNIVERSITY_ALIASES = {
    "東大": "東京大学", "東京大学院": "東京大学", "京大": "京都大学", "阪大": "大阪大学", "東北大": "東北大学", "名大": "名古屋大学",
    "北大": "北海道大学", "九大": "九州大学", "東工大": "東京工業大学", "東京工業大": "東京工業大学", "早大": "早稲田大学",
    "慶大": "慶應義塾大学", "慶応": "慶應義塾大学", "慶應大学": "慶應義塾大学", "Tokyo University": "東京大学",
    "University of Tokyo": "東京大学", "Kyoto University": "京都大学", "Osaka University": "大阪大学",
    "Tohoku University": "東北大学", "Nagoya University": "名古屋大学",
}
AFFILIATION_PREFIXES = ["国立大学法人", "公立大学法人", "学校法人", "独立行政法人", "国立研究開発法人"]
AFFILIATION_SUFFIXES = ["大学院", "研究科", "医学部", "工学部", "理学部", "農学部", "教育学部", "文学部", "経済学部", "法学部", "研究院", "院"]


def affiliation(c: Column, parity: bool = False) -> Column:
    """Canonical institution of an affiliation.

    Aliases match as substrings, longest first.  京大 lies within 東京大学, so full names are looked for first;
    ``parity`` leaves that out, and then counts Tokyo as Kyoto.
    """
    s = strip(F.coalesce(c, F.lit("")))
    for p in AFFILIATION_PREFIXES:
        s = strip(F.regexp_replace(s, rf"^{p}[{_S}]*", ""))
    out = F.when(s == "", F.lit(""))
    if not parity:
        for name in sorted(set(UNIVERSITY_ALIASES.values()), key=lambda n: (-len(n), n)):
            out = out.when(F.contains(s, F.lit(name)), name)
    for alias in sorted(UNIVERSITY_ALIASES, key=lambda a: -len(a)):
        out = out.when(F.contains(s, F.lit(alias)), UNIVERSITY_ALIASES[alias])
    base = F.regexp_extract(s, r"^(.+?大学)院?", 1)
    out = out.when(~s.rlike("大学院?$") & (base != ""), base)
    cut = s
    for suffix in AFFILIATION_SUFFIXES:
        cut = strip(F.regexp_replace(cut, rf"{suffix}.*$", ""))
    return out.otherwise(cut)


def institution_core(c: Column, otherwise: Column | None = None, drop_prefix: bool = False) -> Column:
    """Up to 大学, else up to a research body's suffix, else ``otherwise`` (NULL by default)."""
    if drop_prefix:
        c = F.regexp_replace(c, "^(国立大学法人|公立大学法人|学校法人)", "")
    first = blank_or(F.regexp_extract(c, "^(.+?大学)", 1))
    second = blank_or(F.regexp_extract(c, "^(.+?(研究所|機構|センター|大学校|高専|工業高等専門学校))", 1))
    return F.coalesce(first, second, otherwise if otherwise is not None else F.lit(None).cast("string"))


def blank_or(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def institution_tier(core: Column, elite: list[str]) -> Column:
    """elite, university, institute, or NULL without an institution."""
    return F.when(core.isin(elite), "elite").when(core.rlike("大学$|(?i:univ)"), "university").when(core.isNotNull() & (core != ""), "institute")


def early_career(position: Column, words: list[str], but: list[str] = ()) -> Column:
    """True, false, or NULL for a blank position."""
    hit = position.rlike(_either(list(words)))
    if but:
        hit = hit & ~position.rlike(_either(list(but)))
    return F.when(strip(F.coalesce(position, F.lit(""))) != "", hit)


def institution_tokens(c: Column) -> Column:
    """Distinct institution-like runs of a text."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"([\p{IsHan}\p{IsKatakana}ー]+?(?:大学|研究所|機構|センター|病院|高専))"), F.lit(1)))


def affiliation_agrees(a: Column, b: Column) -> Column:
    """Shared institution token, or the shorter of at least 4 characters within the longer; NULL if either is blank."""
    short, long = F.when(F.length(a) <= F.length(b), a).otherwise(b), F.when(F.length(a) <= F.length(b), b).otherwise(a)
    within = (F.length(short) >= 4) & F.contains(long, short)
    blank = (F.coalesce(a, F.lit("")) == "") | (F.coalesce(b, F.lit("")) == "")
    return F.when(~blank, F.arrays_overlap(institution_tokens(a), institution_tokens(b)) | within)


# Marks of affiliations outside research, of academic institutions, and ends of institutions' names.
NOT_ACADEMIC = r"株式会社|（株）|\(株\)|小学校|中学校|高等学校|高校|クリニック|診療所"
ACADEMIC = r"大学|研究所|高専|機構|研究センター"
INSTITUTION_ENDS = "大学|大学校|研究所|高専|高等専門学校|機構|研究センター|病院|医療センター"


def link_match(affiliation: Column, institution: Column) -> Column:
    """(match, demoted): if a linked person's affiliation shares an institution, NULL if it is blank.

    A link between an affiliation outside research and an academic institution that doesn't match is surely another
    person: it is to be taken back.
    """
    cores = lambda c: F.regexp_extract_all(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\s　]", ""), F.lit(rf"([一-龥ぁ-んァ-ヴA-Za-z]+?(?:{INSTITUTION_ENDS}))"), F.lit(1))
    match = F.when(F.regexp_replace(F.coalesce(affiliation, F.lit("")), r"[\s　]", "") != "", F.arrays_overlap(cores(affiliation), cores(institution)))
    demoted = F.coalesce(~match & affiliation.rlike(NOT_ACADEMIC) & institution.rlike(ACADEMIC), F.lit(False))
    return F.struct(match.alias("match"), demoted.alias("demoted"))


def demote_links(links: DataFrame, affiliation: str, institution: str, link: str) -> DataFrame:
    """``links`` with ``match``; demoted links become NULL, and ``demotion`` keeps what was there, so that it can be undone."""
    x = links.withColumn("_m", link_match(F.col(affiliation), F.col(institution)))
    kept = F.to_json(F.struct(F.col(link).alias("was"), F.col(affiliation).alias("affiliation"), F.col(institution).alias("institution")))
    x = x.withColumns({"match": F.when(~F.col("_m.demoted"), F.col("_m.match")), "demotion": F.when(F.col("_m.demoted"), kept), link: F.when(~F.col("_m.demoted"), F.col(link))})
    return x.drop("_m")


def name_agrees(a: Column, b: Column) -> Column:
    """Equal or one within the other, if both are given; a missing one does not disagree."""
    return (a == "") | (b == "") | F.contains(a, b) | F.contains(b, a)


def legal_form(c: Column, default: str = "その他") -> Column:
    """Stated legal form, else ``default``; ordered, longer forms first."""
    forms = ["公益財団法人", "一般財団法人", "公益社団法人", "一般社団法人", "特定非営利活動法人", "学校法人", "社会福祉法人", "独立行政法人", "国立研究開発法人", "株式会社"]
    out = F.when(F.contains(c, F.lit(forms[0])), forms[0])
    for f in forms[1:]:
        out = out.when(F.contains(c, F.lit(f)), f)
    return out.otherwise(default)


def legal_form_inferred(c: Column) -> Column:
    """(form, inferred): names that only look like a foundation's get its commonest form, and say so."""
    stated = legal_form(c, "")
    looks = c.rlike("財団|基金|振興会|研究会")
    return F.struct(F.when(stated != "", stated).when(looks, "公益財団法人").alias("form"), ((stated == "") & looks).alias("inferred"))


def position_split(c: Column, positions: list[str]) -> Column:
    """(affiliation, position): a trailing position word goes to the second field."""
    pattern = rf"^(.*?)[\s　]*((?:{_either(sorted(positions, key=lambda p: (-len(p), p)))}))$"
    pos = F.regexp_extract(c, pattern, 2)
    return F.struct(F.when(pos != "", F.regexp_extract(c, pattern, 1)).otherwise(c).alias("affiliation"), blank_or(pos).alias("position"))


def position_short(c: Column, chars: int) -> Column:
    return F.substring(F.regexp_replace(c, "[（(].*$", ""), 1, chars)


def squeeze_japanese(c: Column) -> Column:
    """Blanks between two Japanese characters go; others stay."""
    return F.regexp_replace(c, r"(?<=[぀-ヿ一-鿿])[ 　]+(?=[぀-ヿ一-鿿])", "")
