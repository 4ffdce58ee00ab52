"""Keyword rules as data: a rule has an order, a label, keywords and weights; five ways to apply them.

Rule sets are small, given data (tens to hundreds of keywords), so they compile to expressions that stay in generated
code, from literals or from a table (``rules_from``); ``long_matches`` takes tables of many more.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import windows


@dataclass(frozen=True)
class Rule:
    label: str
    keywords: tuple[str, ...]
    weight: float = 1.0


def _hit(text: Column, word: str) -> Column:
    return F.contains(text, F.lit(word))


def _any(text: Column, rule: Rule) -> Column:
    out = F.lit(False)
    for w in rule.keywords:
        out = out | _hit(text, w)
    return out


def first_match(text: Column, rules: Sequence[Rule], default: str | None = None) -> Column:
    """Label of the first rule with any keyword in the text."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for r in rules:
        out = out.when(_any(text, r), r.label)
    return out.otherwise(F.lit(default))


def distinct_hits(text: Column, rule: Rule) -> Column:
    return sum((_hit(text, w).cast("int") for w in rule.keywords), F.lit(0))


def most_hits(text: Column, rules: Sequence[Rule]) -> Column:
    """Label with the most distinct keywords; ties go to the earlier rule; NULL without a hit."""
    scored = F.array(*[F.struct(distinct_hits(text, r).alias("score"), F.lit(-k).alias("ord"), F.lit(r.label).alias("label")) for k, r in enumerate(rules)])
    best = F.array_max(scored)
    return F.when(best["score"] > 0, best["label"])


def all_matches(text: Column, rules: Sequence[Rule]) -> Column:
    """Labels of all rules with any keyword, in rule order."""
    return F.array_compact(F.array(*[F.when(_any(text, r), r.label) for r in rules]))


def occurrences(text: Column, word: str) -> Column:
    """How often the word occurs, without overlaps."""
    return (F.length(text) - F.length(F.replace(text, F.lit(word), F.lit("")))) / len(word)


def weighted(text: Column, rules: Sequence[Rule], most: int = 3, cap: int = 6) -> Column:
    """Labels by occurrences times min(keyword length, ``cap``), best first, at most ``most``."""
    score = lambda r: sum((occurrences(text, w) * min(len(w), cap) for w in r.keywords), F.lit(0.0))
    scored = F.array(*[F.struct((-score(r)).alias("s"), F.lit(k).alias("k"), F.lit(r.label).alias("label")) for k, r in enumerate(rules)])
    return F.transform(F.slice(F.sort_array(F.filter(scored, lambda x: x["s"] < 0)), 1, most), lambda x: x["label"])


def decision(rules: Sequence[tuple[Column, str]], default: str | None = None) -> Column:
    """The first test that holds decides."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for test, label in rules:
        out = out.when(test, label)
    return out.otherwise(F.lit(default))


@dataclass(frozen=True)
class Evidence:
    """``points`` for ``label`` where ``test`` holds; ``after`` sees the first round's scores by label."""

    label: str
    points: float
    reason: str
    test: Column | None = None
    after: object = None


def evidence_score(labels: Sequence[str], evidence: Sequence[Evidence], margin: tuple[float, float], other: str) -> Column:
    """(label, score, confidence, reasons): additive evidence in two rounds, as later rules may ask for earlier scores.

    Confidence is high or medium by the margin over the second label, else low, and low gives ``other``.
    """
    gain = lambda e, test: F.when(F.coalesce(test, F.lit(False)), F.lit(float(e.points))).otherwise(0.0)
    first = {x: sum((gain(e, e.test) for e in evidence if e.label == x and e.after is None), F.lit(0.0)) for x in labels}
    late = [(e, e.after(first)) for e in evidence if e.after is not None]
    total = {x: sum((gain(e, t) for e, t in late if e.label == x), first[x]) for x in labels}
    ranked = F.sort_array(F.array(*[F.struct((-total[x]).alias("s"), F.lit(k).alias("k"), F.lit(x).alias("label")) for k, x in enumerate(labels)]))
    gap = ranked[1]["s"] - ranked[0]["s"] if len(labels) > 1 else -ranked[0]["s"]
    sure = F.when(gap >= margin[0], "high").when(gap >= margin[1], "medium").otherwise("low")
    tests = [(e, e.test) for e in evidence if e.after is None] + late
    reasons = F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.concat(F.lit(e.label + ":"), F.lit(e.reason))) for e, t in tests]))
    return F.struct(F.when(sure == "low", other).otherwise(ranked[0]["label"]).alias("label"), (-ranked[0]["s"]).alias("score"), sure.alias("confidence"), reasons.alias("reasons"))


def rule_table(df: DataFrame, ruleset: str | None = None) -> DataFrame:
    """Rules from a table (ruleset, ord, label, keyword, weight), blank keywords and repeats left out; weight 1 by default."""
    weight = F.coalesce("weight", F.lit(1.0)).cast("double") if "weight" in df.columns else F.lit(1.0)
    rules = df.filter((F.col("ruleset") == ruleset) if ruleset is not None else F.lit(True))
    rules = rules.filter("keyword is not null and keyword <> ''").withColumn("weight", weight)
    return rules.groupBy("ord", *[c for c in df.columns if c not in ("ruleset", "ord", "keyword", "weight")], "keyword").agg(F.max("weight").alias("weight"))


def rules_from(df: DataFrame, ruleset: str | None = None, most: int = 2_000) -> list[Rule]:
    """A rule table as ``Rule`` objects, in order, for the expressions above; more than ``most`` keywords are refused."""
    rows = rule_table(df, ruleset).select("ord", "label", "keyword", "weight").orderBy("ord", "keyword").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} keywords; use long_matches")
    out: dict[tuple, list] = {}
    for r in rows:
        out.setdefault((r.ord, r.label), []).append(r)
    return [Rule(label, tuple(r.keyword for r in group), max(r.weight for r in group)) for (_, label), group in out.items()]


def long_matches(df: DataFrame, key: str, text: str, rules: DataFrame, most: int = 200_000) -> DataFrame:
    """(key, ord, hits, score): keywords of a rule table (ord, keyword, weight) that lie within the text.

    Each keyword counts once for a row of the table ``df``.  All keywords are looked for in one pass over a text, by an
    automaton that each task builds; more than ``most`` of them, which bounds it, are refused.
    """
    import pyarrow as pa

    words = rules.select("ord", "keyword", F.col("weight").cast("double")).filter("keyword <> ''").distinct().limit(most + 1).collect()
    if len(words) > most:
        raise ValueError(f"more than {most} keywords")
    by_word: dict[str, list[tuple[int, float]]] = {}
    for r in words:
        by_word.setdefault(r.keyword, []).append((r.ord, r.weight))
    texts = df.select(F.col(key).cast("string").alias("k"), F.col(text).cast("string").alias("t")).filter("t is not null")

    def run(it):
        import ahocorasick

        finder = ahocorasick.Automaton()
        for w in by_word:
            finder.add_word(w, w)
        finder.make_automaton()
        for batch in it:
            found = []
            for k, t in zip(batch.column("k").to_pylist(), batch.column("t").to_pylist(), strict=True):
                scores: dict[int, list[float]] = {}
                for w in {w for _, w in finder.iter(t)} if by_word else ():
                    for ord_, weight in by_word[w]:
                        scores.setdefault(ord_, []).append(weight)
                found += [(k, ord_, len(x), sum(sorted(x))) for ord_, x in scores.items()]
            cols = list(zip(*found, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.int64(), pa.float64()), strict=True)], ["k", "ord", "hits", "score"])

    kind = dict(df.dtypes)[key]
    return texts.mapInArrow(run, "k string, ord int, hits long, score double").select(F.col("k").cast(kind).alias(key), "ord", "hits", "score")


def hierarchy_scores(matches: DataFrame, key: str, levels: Sequence[str], unclassified: DataFrame | None = None) -> DataFrame:
    """(key, a column per level): names of each level by summed score, best first, ties by the rules' order.

    ``matches``: key, ord, score and the levels.  Keys of ``unclassified`` without a match come with empty lists.
    """
    out = None
    for level in levels:
        scored = matches.groupBy(key, level).agg(F.sum("score").alias("score"), F.min("ord").alias("ord"))
        ranked = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "ord", F.col(level).alias("name"))))
        part = scored.groupBy(key).agg(F.transform(ranked, lambda x: x["name"]).alias(level))
        out = part if out is None else out.join(part, key)
    if unclassified is not None:
        none = F.array().cast("array<string>")
        out = unclassified.select(key).join(out, key, "left").select(key, *[F.coalesce(F.col(x), none).alias(x) for x in levels])
    return out


def evidence_first(curated: DataFrame, key: str, order: Sequence[Column], fallback: DataFrame) -> DataFrame:
    """(key, label, method): the first curated label by ``order``, else the fallback's (key, label), else none."""
    best = windows.first_per_key(curated, [key], order).select(key, F.col("label").alias("curated"))
    return fallback.join(best, key, "left").select(key, F.coalesce("curated", "label").alias("label"), F.when(F.col("curated").isNotNull(), "curated").when(F.col("label").isNotNull(), "keyword").otherwise("none").alias("method"))
