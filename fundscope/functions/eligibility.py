"""Conditions of calls in free text: age, position, nationality, affiliation, career stage; officers' corporate ties."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators.rules import decision
from . import any_of

# Terms in the order in which they are reported.
POSITIONS = ["教授", "准教授", "講師", "助教", "助手", "ポストドクター", "ポスドク", "PI", "プリンシパル", "博士課程", "博士後期", "博士前期", "修士課程", "修士", "学部生", "大学院生", "院生", "研究員", "主任研究員", "上席研究員", "特任", "客員", "名誉教授", "招聘", "補助員", "技術職員", "URA", "医師", "歯科医師", "看護師"]
AFFILIATIONS = ["大学", "大学院", "研究機関", "国公立", "私立", "企業研究者", "民間企業", "NPO", "NGO", "独立行政法人", "国立研究開発法人"]
NATIONALITY = [("日本国籍", ["日本国籍", "日本国民"]), ("国籍不問", ["国籍不問", "国籍を問わない", "国籍は問わない"]), ("外国籍可", ["在日外国人", "外国籍"]), ("永住権保持者可", ["永住権", "永住者", "永住を許可"]), ("留学生対応あり", ["留学生"])]


def listed(text: Column, terms: Sequence[str]) -> Column:
    """Terms that the text holds, comma-separated; NULL without any."""
    found = F.array_compact(F.array(*[F.when(F.contains(text, F.lit(t)), t) for t in terms]))
    return F.nullif(F.array_join(F.array_distinct(found), ","), F.lit(""))


def age_simple(text: Column) -> Column:
    age = F.regexp_extract(text, r"(\d{2})\s*歳\s*(?:以下|未満|まで)", 1)
    return F.when(age != "", F.concat(age, F.lit("歳以下"))).when(F.contains(text, F.lit("若手")), "若手研究者（年齢制限あり）")


def ages(text: Column) -> Column:
    """All stated limits in order of kind, each once; words for career stages only where no age is stated."""
    spelled = lambda pattern, group: F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    limit = F.transform(spelled(r"\d{2}\s*歳\s*(?:以下|未満|まで|程度)", 0), lambda s: F.regexp_replace(s, r"\s", ""))
    full = F.transform(spelled(r"満\s*(\d{2})\s*歳", 1), lambda s: F.concat(F.lit("満"), s, F.lit("歳")))
    since = r"(?:博士号取得後|学位取得後|博士取得後|ポストドクター|ポスドク[^\s\d]{0,8})\s*(\d{1,2}\s*年(?:以内|未満))"
    after = F.transform(spelled(since, 1), lambda s: F.concat(F.lit("博士号取得後"), F.regexp_replace(s, r"\s", "")))
    stated = F.array_distinct(F.concat(limit, full, after))
    words = listed(text, ["若手", "新進", "中堅"])
    return F.when(F.size(stated) > 0, F.array_join(stated, ",")).otherwise(F.regexp_replace(words, "(若手|新進|中堅)", "$1研究者"))


def nationality(text: Column) -> Column:
    flags = F.array_compact(F.array(*[F.when(any_of(text, words) | (F.contains(text, F.lit("外国人")) & F.contains(text, F.lit("歓迎"))) if name == "外国籍可" else any_of(text, words), name) for name, words in NATIONALITY]))
    return F.nullif(F.array_join(flags, ","), F.lit(""))


# Rules of career stages in the order in which they apply.  A rule holds if the text has one of ``any``, one
# of ``also`` and none of ``but``, or the position one of ``position``, or the least age is at most ``age``.
STAGES: list[tuple[str, dict]] = [
    ("undergraduate", {"any": ["学部生"]}),
    ("phd_candidate", {"any": ["博士課程", "博士後期", "博士前期", "大学院生", "院生"]}),
    ("phd_candidate", {"any": ["修士"], "also": ["学生"]}),
    ("postdoc", {"any": ["ポスドク", "ポストドクター", "博士号取得後", "学位取得後"]}),
    ("pi_early", {"age": 35}),
    ("pi_mid", {"age": 45}),
    ("senior", {"age": 55}),
    ("pi_early", {"any": ["若手", "新進"]}),
    ("pi_early", {"lower": ["early career"]}),
    ("pi_mid", {"any": ["中堅"]}),
    ("senior", {"any": ["名誉教授"]}),
    ("senior", {"any": ["教授"], "but": ["准教授", "助教"]}),
    ("pi_early", {"position": ["准教授", "講師", "助教"]}),
    ("undergraduate", {"any": ["奨学", "スカラシップ"], "also": ["学部", "高校", "高等学校"]}),
    ("phd_candidate", {"any": ["奨学", "スカラシップ"]}),
    ("unrestricted", {"any": ["国籍不問", "年齢制限なし", "年齢を問わない", "あらゆる", "制限なし", "問いません"]}),
    ("unrestricted", {"any": ["研究者"], "but": ["若手", "中堅"], "no_age": True}),
]


def career_stage(text: Column, age: Column, position: Column) -> Column:
    """The stage of the first rule of ``STAGES`` that holds; NULL without any."""
    least = F.array_min(F.transform(F.regexp_extract_all(age, F.lit(r"(\d{2})"), F.lit(1)), lambda s: s.cast("int")))
    clauses = {
        "any": lambda words: any_of(text, words),
        "also": lambda words: any_of(text, words),
        "but": lambda words: ~any_of(text, words),
        "lower": lambda words: any_of(F.lower(text), words),
        "position": lambda words: any_of(position, words),
        "age": lambda most: least <= most,
        "no_age": lambda _: age.isNull(),
    }
    return decision([(reduce(Column.__and__, [clauses[k](v) for k, v in rule.items()]), stage) for stage, rule in STAGES])


def corporate_relation(claimed: Column, company: Column, title: Column, name: Column, executive: Sequence[str], advisory: Sequence[str], never: Sequence[str] = ()) -> Column:
    """exec, advisor or none: titles decide, advisory terms exclude, and listed names are never executives."""
    company = F.coalesce(company, F.lit("")) != ""
    title = F.coalesce(title, F.lit(""))
    serves = F.coalesce(claimed, F.lit(False)) & company & any_of(title, list(executive)) & ~any_of(title, list(advisory)) & ~name.isin(list(never) or [""])
    return F.when(serves, "exec").when(company & any_of(title, list(advisory)), "advisor").otherwise("none")
