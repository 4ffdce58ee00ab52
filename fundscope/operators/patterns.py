"""Many patterns in long texts: both sides are tables of any size.

A pattern waits at one of its grams, the one that the texts have least often; texts send only the places and hashes of
those grams that some pattern has, never themselves.  Candidates then go to the texts, which are shuffled once, and the
comparison is part of that join, so no text is copied to a candidate.  There is no limit on the number of patterns and
none is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..store import stored


def _grams(c: Column, size: int) -> Column:
    """(place from 1, hash) of every ``size`` characters that follow each other, in time in proportion to the text."""
    chars = F.filter(F.split(c, ""), lambda x: x != "")
    # an array of one array, so that the characters are cut once and not again for every place
    of = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - size + 1), lambda k: F.struct(k.alias("place"), F.xxhash64(*[F.get(w, k + (i - 1)) for i in range(size)]).alias("gram")))
    return F.flatten(F.transform(F.array(chars), of))


def _sent(df: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(key, place, gram) of all grams of the texts that are long enough."""
    found = F.explode(_grams(F.col(text), size)).alias("g")
    return df.filter(F.length(text) >= size).select(key, found).select(key, "g.place", "g.gram")


def occurrences(patterns: DataFrame, texts: DataFrame, gram: int = 4) -> DataFrame:
    """(pid, tid, place): every place, from 1, where a pattern of ``patterns`` (pid, pattern) begins in ``texts`` (tid, text).

    Patterns under ``gram`` characters are searched by grams of their own length.  Null or empty patterns occur nowhere;
    null texts hold nothing.  Each row of a repeated pattern or text is one of its own, so ids should be unique.
    """
    patterns = patterns.filter(F.length("pattern") > 0).select("pid", "pattern")
    out = None
    for size in range(1, gram + 1):
        mine = patterns.filter(F.length("pattern") >= gram if size == gram else F.length("pattern") == size)
        if size < gram and mine.isEmpty():
            continue
        part = _by_grams(mine, texts, size)
        out = part if out is None else out.unionByName(part)
    return out


def _by_grams(patterns: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    own = stored(_sent(patterns, "pid", "pattern", size), "pattern-grams")
    asked = own.select("gram").distinct()
    sent = stored(_sent(texts, "tid", "text", size).join(asked, "gram", "left_semi"), "text-grams")
    often = sent.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    # a gram that no text has comes first, and its pattern meets nothing
    known = own.join(often, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    anchor = known.groupBy("pid").agg(F.min(F.struct("n", "place", "gram")).alias("a")).filter("a.n > 0").select("pid", F.col("a.gram").alias("gram"), F.col("a.place").alias("at"))
    waiting = anchor.join(patterns, "pid")
    candidates = sent.join(waiting, "gram").select("pid", "pattern", F.col("tid").alias("_t"), (F.col("place") - F.col("at") + 1).alias("place")).filter("place >= 1")
    same = (F.col("tid") == F.col("_t")) & (F.substring(F.col("text"), F.col("place"), F.length("pattern")) == F.col("pattern"))
    return texts.select("tid", "text").hint("merge").join(candidates, same).select("pid", "tid", "place")


def held(patterns: DataFrame, texts: DataFrame, gram: int = 4) -> DataFrame:
    """(pid, tid, times, first): how often, and where first, each pattern lies in each text."""
    return occurrences(patterns, texts, gram).groupBy("pid", "tid").agg(F.count(F.lit(1)).alias("times"), F.min("place").alias("first"))


def chained_lookup(names: DataFrame, cache: DataFrame, value: Column, least: int = 4) -> DataFrame:
    """(nid, key, value, how): what ``value`` draws from the cached text (key, text) that belongs to a name (nid, name).

    A cached text whose key equals the name counts first; else the first key, by code points, of those that contain the
    name or lie in it, the shorter of the two having ``least`` characters.  Texts from which nothing is drawn are passed
    over.  Names without any come with nulls.  Keys are told apart by their text; of one key's texts the least counts.
    """
    drawn = cache.withColumn("value", value).filter("value is not null and key <> ''").groupBy("key").agg(F.min("value").alias("value"))
    drawn = stored(drawn, "drawn")
    plain = names.select("nid", "name").filter("name <> ''")
    direct = plain.join(drawn, F.col("name") == F.col("key")).select("nid", "key", "value", F.lit("equal").alias("how"))
    rest = plain.join(direct.select("nid"), "nid", "left_anti")
    # each name once, however many rows have it
    distinct = rest.select("name").distinct()
    inside = occurrences(distinct.filter(F.length("name") >= least).select(F.col("name").alias("pid"), F.col("name").alias("pattern")), drawn.select(F.col("key").alias("tid"), F.col("key").alias("text")))
    around = occurrences(drawn.filter(F.length("key") >= least).select(F.col("key").alias("pid"), F.col("key").alias("pattern")), distinct.select(F.col("name").alias("tid"), F.col("name").alias("text")))
    met = inside.select(F.col("pid").alias("name"), F.col("tid").alias("key")).unionByName(around.select(F.col("tid").alias("name"), F.col("pid").alias("key")))
    first = met.groupBy("name").agg(F.min("key").alias("key")).join(drawn, "key")
    loose = rest.join(first, "name").select("nid", "key", "value", F.lit("contains").alias("how"))
    return names.select("nid").join(direct.unionByName(loose), "nid", "left")
