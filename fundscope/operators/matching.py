"""Entity matching: keyed, tiered, homonym-aware, disambiguating and containment joins.

Equalities are equi-joins on computed keys.  Containment is blocked by fixed-length substrings: a contained text shares
its rarest ``gram`` characters with some place of the longer one, so candidates come from an equi-join too and only they
are compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..store import stored
from . import windows


def keyed(probe: DataFrame, build: DataFrame, key: str, order: Sequence[Column], how: str = "left") -> DataFrame:
    """Join to the first build row of each key by ``order``; reversed orders give last-wins."""
    return probe.join(windows.first_per_key(build, [key], order), key, how)


def repeated_per_match(left: DataFrame, right: DataFrame, key: str, piece: int = 1024) -> DataFrame:
    """Rows of ``left``, each as often as rows of ``right`` have its key (NULL is a key of its own): an inner join for its left columns.

    The matches are counted, not met, and the rows are dealt evenly before they are repeated, in pieces of ``piece``: a
    task's memory and its share of the work depend on no key's size.
    """
    n = right.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    j = left.join(n, F.col(key).eqNullSafe(F.col("_k"))).select(*left.columns, "_n")
    tasks = 4 * left.sparkSession.sparkContext.defaultParallelism
    pieces = j.repartition(tasks).withColumn("_p", F.explode(F.sequence(F.lit(0), F.expr(f"(_n - 1) DIV {piece}"))))
    rest = F.least(F.col("_n") - F.col("_p") * piece, F.lit(piece)).cast("int")
    return pieces.select(*left.columns, F.explode(F.array_repeat(F.lit(True), rest)).alias("_one")).select(*left.columns)


def contained_pairs(short: DataFrame, long: DataFrame, gram: int = 4) -> DataFrame:
    """(short_id, long_id): texts of ``short`` (short_id, s) that lie within texts of ``long`` (long_id, t).

    Texts under ``gram`` characters are left out.  A long text gives a row per distinct substring of that length; a short
    one waits at the rarest of its own, so that a common beginning or ending brings nothing together.  A text with a
    substring that no long text has lies in none.
    """
    grams = lambda c: F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - gram + 1), lambda k: F.substring(F.col(c), k, F.lit(gram)))))
    b = long.filter(F.length("t") >= gram).withColumn("g", grams("t"))
    often = b.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    own = short.filter(F.length("s") >= gram).withColumn("g", grams("s")).join(often, "g", "left")
    best = F.min(F.struct("n", "g"))
    a = own.groupBy("short_id", "s").agg(F.bool_and(F.col("n").isNotNull()).alias("known"), best.alias("best")).filter("known").select("short_id", "s", F.col("best.g").alias("g"))
    return a.join(b, "g").filter(F.contains("t", "s")).select("short_id", "long_id")


def rank_zip(left: DataFrame, right: DataFrame, key: str, lid: str, rid: str) -> DataFrame:
    """(lid, rid): within a key, the first left row gets the first right row, and so on; each is used once."""
    ranked = lambda df, i: df.filter(F.col(key).isNotNull() & (F.col(key) != "")).withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(i)))
    return ranked(left, lid).select(key, "_r", lid).join(ranked(right, rid).select(key, "_r", rid), [key, "_r"]).select(lid, rid)


def greedy(edges: DataFrame, lid: str, rid: str) -> tuple[DataFrame, int]:
    """(pairs, rounds): what a scan finds that gives each left row, in order, its first right row that is still free.

    Each round every left row proposes to the first right row it has left.  Right rows hold the first of those that
    propose and strike all later left rows, who can't have them any more; so nothing is struck that the scan would give.
    Once no proposal is struck, the proposals are the pairs.  A round is two aggregations and two joins on the edges that
    remain; there are as many rounds as the longest chain of rivals has links, and each strikes an edge at least.
    """
    edges = stored(edges.select(lid, rid).filter(F.col(lid).isNotNull() & F.col(rid).isNotNull()).distinct(), "edges")
    rounds = 0
    while True:
        rounds += 1
        proposed = edges.groupBy(lid).agg(F.min(rid).alias(rid))
        holder = proposed.groupBy(rid).agg(F.min(lid).alias("_holder"))
        refused = proposed.join(holder, rid).filter(F.col(lid) > F.col("_holder"))
        if refused.isEmpty():
            return proposed, rounds
        edges = stored(edges.join(holder, rid, "left").filter(F.col("_holder").isNull() | (F.col(lid) <= F.col("_holder"))).select(lid, rid), "edges")


def tiered(left: DataFrame, right: DataFrame, aggregators: Sequence[str] = ()) -> DataFrame:
    """One-to-one matches (lid, rid, method, confidence) of rows (lid, name, host) and (rid, name, host).

    By equal names, then hosts other than aggregators', then containment of names of 4 or more characters.  The last tier
    takes the left rows in order and gives each the first free right row that contains it or lies in it.
    """
    tier = lambda df, name, sure: df.select("lid", "rid", F.lit(name).alias("method"), F.lit(sure).alias("confidence"))
    one = tier(rank_zip(left, right, "name", "lid", "rid"), "name", 0.95)
    rest = lambda done: (left.join(done, "lid", "left_anti"), right.join(done, "rid", "left_anti"))
    l2, r2 = rest(one)
    known = ~F.col("host").isin(list(aggregators)) if aggregators else F.lit(True)
    two = tier(rank_zip(l2.filter(known), r2.filter(known), "host", "lid", "rid"), "host", 0.85)
    l3, r3 = rest(one.unionByName(two))
    a = contained_pairs(l3.select(F.col("lid").alias("short_id"), F.col("name").alias("s")), r3.select(F.col("rid").alias("long_id"), F.col("name").alias("t"))).select(F.col("short_id").alias("lid"), F.col("long_id").alias("rid"))
    b = contained_pairs(r3.select(F.col("rid").alias("short_id"), F.col("name").alias("s")), l3.select(F.col("lid").alias("long_id"), F.col("name").alias("t"))).select(F.col("long_id").alias("lid"), F.col("short_id").alias("rid"))
    three = tier(greedy(a.unionByName(b), "lid", "rid")[0], "contains", 0.70)
    return one.unionByName(two).unionByName(three)


def candidates(people: DataFrame, index: DataFrame, key: str, pid: str, xid: str, tests: Sequence[Column], need: str | None = None, few: int = 20_000) -> DataFrame:
    """(pid, n0, x0, n1, x1, ...): how many index rows share a row's ``key``, and how many of these meet each test.

    ``x0``, ``x1``, ... are the ids of those rows where there is one.  The tests may ask for all other columns of both
    frames, whose names must differ.  Rows that agree in key and these columns are compared once and counted, so the pairs
    within a key are of distinct values, however many rows share them.  Rows without candidates are left out.

    ``need`` is a condition on the counts of one row; ids of which no row meets it may be left out as well.  The counts are
    stored first: files have a known size, so where they are small Spark sends them to the rows, and the rows aren't
    shuffled to meet them.  They also tell how many rows meet ``need``; where these are at most ``few``, the others of
    their ids are found by a broadcast of the ids, and nothing else is shuffled.
    """
    mine, theirs = ([c for c in df.columns if c not in (key, i)] for df, i in ((people, pid), (index, xid)))
    x = index.groupBy(key, *theirs).agg(F.count(F.lit(1)).alias("_rows"), F.min(xid).alias("_x"))
    kept = [F.lit(True), *tests]
    counts = [F.sum(F.when(ok, F.col("_rows")).otherwise(0)).alias(f"n{k}") for k, ok in enumerate(kept)]
    ids = [F.min(F.when(ok, F.col("_x"))).alias(f"x{k}") for k, ok in enumerate(kept)]
    values = people.groupBy(key, *mine).agg(F.count(F.lit(1)).alias("_people"))
    votes = values.join(x, key).groupBy(key, *mine).agg(*counts, *ids, F.max("_people").alias("_people"))
    votes = votes.withColumnsRenamed({c: f"_{c}" for c in (key, *mine)})
    same = F.col(key) == F.col(f"_{key}")
    for c in mine:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    votes = votes if need is None else stored(votes, "votes")
    met = people.join(votes, same)
    if need is not None and (votes.filter(need).agg(F.sum("_people")).first()[0] or 0) <= few:
        those = met.filter(need).select(F.col(pid).alias("_id"))
        met = met.join(F.broadcast(those), F.col(pid).eqNullSafe(F.col("_id")), "left_semi")
    # several rows of one id have their candidates together
    all_ = [F.sum(f"n{k}").alias(f"n{k}") for k in range(len(kept))]
    one = [F.max(F.when(F.col(f"n{k}") == 1, F.col(f"x{k}"))).alias(f"x{k}") for k in range(len(kept))]
    return met.groupBy(pid).agg(*all_, *one)


def homonyms(people: DataFrame, index: DataFrame, prefix: int = 6, parity: bool = False) -> DataFrame:
    """(pid, xid, method): people (pid, name, inst) against an index (xid, name, inst).

    One candidate by name is taken; of several, those whose institution agrees (one contains the other's first ``prefix``
    characters), if exactly one does.  Blank institutions agree with nothing, unless ``parity`` holds.
    """
    p = people.select("pid", "name", F.coalesce("inst", F.lit("")).alias("inst"))
    i = index.select("xid", "name", F.coalesce("inst", F.lit("")).alias("xinst"))
    agree = F.contains("inst", F.substring("xinst", 1, prefix)) | F.contains("xinst", F.substring("inst", 1, prefix))
    if not parity:
        agree = agree & (F.col("inst") != "") & (F.col("xinst") != "")
    one = "n0 = 1 or n1 = 1"
    c = candidates(p, i, "name", "pid", "xid", [agree], one).filter(one)
    return c.select("pid", F.when(F.col("n0") == 1, F.col("x0")).otherwise(F.col("x1")).alias("xid"), F.when(F.col("n0") == 1, "unique").otherwise("institution").alias("method"))


def conservative(people: DataFrame, index: DataFrame) -> DataFrame:
    """(pid, xid, method): a name that the index counts once, else the one candidate that shares an institution token.

    ``people``: pid, name, tokens; ``index``: xid, name, tokens, homonyms.
    """
    i = index.select("xid", "name", F.col("tokens").alias("xtokens"), "homonyms")
    c = candidates(people.select("pid", "name", "tokens"), i, "name", "pid", "xid", [F.arrays_overlap("tokens", "xtokens"), F.col("homonyms") == 1])
    once = (F.col("n0") == 1) & (F.col("n2") == 1)
    return c.filter(once | (F.col("n1") == 1)).select("pid", F.when(once, F.col("x0")).otherwise(F.col("x1")).alias("xid"), F.when(once, "unique_name").otherwise("institution_token").alias("method"))


def disambiguated(entities: DataFrame, registry: DataFrame, tests: Sequence[tuple[str, Column]]) -> DataFrame:
    """(eid, rid, rule): candidates by ``key``; a single one is taken, else the first test that leaves exactly one.

    Entities without a decision come with a null rid and rule 'unresolved' or 'none'.  The frames should hold no columns
    but their id, the key and what the tests ask for.
    """
    c = candidates(entities, registry, "key", "eid", "rid", [test for _, test in tests])
    rid, rule = F.lit(None), F.lit("unresolved")
    for k, name in reversed(list(enumerate(["single", *(name for name, _ in tests)]))):
        rid, rule = F.when(F.col(f"n{k}") == 1, F.col(f"x{k}")).otherwise(rid), F.when(F.col(f"n{k}") == 1, name).otherwise(rule)
    best = c.select("eid", rid.alias("rid"), rule.alias("rule"))
    return entities.select("eid").distinct().join(best, "eid", "left").select("eid", "rid", F.coalesce("rule", F.lit("none")).alias("rule"))


def places(short: DataFrame, long: DataFrame, gram: int = 4) -> DataFrame:
    """Rows of ``long`` (t, ...) with each of their substrings ``s`` that can be a text of ``short`` (s), to be joined by equality.

    A short text waits at the rarest of its grams, as in ``contained_pairs``; what it leaves there is only where the gram
    lies in it and its length.  A long text cuts such a piece at each place of the gram, so it never meets the short texts
    one by one: its rows are its places times the shapes that wait there, however many texts wait or hold the gram.
    """
    at = F.sequence(F.lit(1), F.length("t") - gram + 1)
    b = long.filter(F.length("t") >= gram).withColumn("at", F.explode(at)).withColumn("g", F.substring("t", F.col("at"), F.lit(gram)))
    often = b.select("t", "g").groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    own = short.select("s").filter(F.length("s") >= gram).distinct()
    own = own.withColumn("off", F.explode(F.sequence(F.lit(1), F.length("s") - gram + 1))).withColumn("g", F.substring("s", F.col("off"), F.lit(gram)))
    best = own.join(often, "g", "left").groupBy("s").agg(F.bool_and(F.col("n").isNotNull()).alias("known"), F.min(F.struct("n", "g", "off")).alias("best"))
    shapes = best.filter("known").select(F.col("best.g").alias("g"), F.col("best.off").alias("off"), F.length("s").alias("len")).distinct()
    cut = b.join(shapes.groupBy("g").agg(F.collect_list(F.struct("off", "len")).alias("shapes")), "g").withColumn("shape", F.explode("shapes"))
    start, size = F.col("at") - F.col("shape.off") + 1, F.col("shape.len")
    inside = cut.filter((start >= 1) & (start + size - 1 <= F.length("t")))
    return inside.withColumn("s", F.substring("t", start, size)).drop("at", "g", "shapes", "shape")


def fuzzy_first(external: DataFrame, table: DataFrame, prefix: int = 5) -> DataFrame:
    """(xid, tid, kind): the first table row, by tid, with an equal name, containment, or a shared prefix contained.

    ``external``: xid, name; ``table``: tid, name.  The kind tells the strongest rule that the row meets.  Each rule finds
    its own first row for each distinct name; the first of these is the row, and the strongest rule that found it the kind.
    """
    first = F.min("tid").alias("tid")
    x = external.select("xid", F.col("name").alias("a"))
    t = table.select(F.struct(F.col("tid").isNull().alias("none"), "tid").alias("tid"), F.col("name").alias("t")).groupBy("t").agg(first)
    a = x.select("a").distinct()
    start = F.substring("a", 1, prefix)
    names, starts = a.filter(F.length("a") >= 4).select(F.col("a").alias("s")), a.filter(F.length("a") >= prefix).select(start.alias("s"))
    holders = places(names.unionByName(starts), t, min(4, prefix)).groupBy("s").agg(first)
    held = places(t.filter(F.length("t") >= 4).select(F.col("t").alias("s")), a.select(F.col("a").alias("t"))).distinct()
    by = lambda df, key, k: df.select(F.col(key).alias("key"), F.col("tid").alias(k))
    c = a.join(by(t, "t", "equal"), F.col("a") == F.col("key"), "left").drop("key")
    c = c.join(by(holders, "s", "inside"), (F.col("a") == F.col("key")) & (F.length("a") >= 4), "left").drop("key")
    c = c.join(by(held.join(t.withColumnRenamed("t", "s"), "s").groupBy("t").agg(first), "t", "around"), F.col("a") == F.col("key"), "left").drop("key")
    c = c.join(by(holders, "s", "start"), (start == F.col("key")) & (F.length("a") >= prefix), "left").drop("key")
    c = c.withColumn("first", F.least("equal", "inside", "around", "start")).filter("first is not null")
    met = lambda k: F.coalesce(F.col(k) == F.col("first"), F.lit(False))
    kind = F.when(met("equal"), 1).when(met("inside") | met("around"), 2).otherwise(3)
    best = x.join(c.select("a", "first", kind.alias("k")), "a").groupBy("xid").agg(F.min(F.struct("first", "k")).alias("best"))
    return best.select("xid", F.col("best.first.tid").alias("tid"), F.element_at(F.array(F.lit("equal"), F.lit("contains"), F.lit("prefix")), F.col("best.k")).alias("kind"))


def loose_fallback(source: DataFrame, target: DataFrame, gram: int = 4) -> DataFrame:
    """(sid, tid, kind): exact keys first, the rest by containment; each source and target once.

    Sources go in order, and one whose first target is taken gets the next one that is free.
    """
    exact = rank_zip(source, target, "key", "sid", "tid").withColumn("kind", F.lit("exact"))
    s, t = source.join(exact, "sid", "left_anti"), target.join(exact, "tid", "left_anti")
    one = contained_pairs(s.select(F.col("sid").alias("short_id"), F.col("key").alias("s")), t.select(F.col("tid").alias("long_id"), F.col("key").alias("t")), gram).select(F.col("short_id").alias("sid"), F.col("long_id").alias("tid"))
    two = contained_pairs(t.select(F.col("tid").alias("short_id"), F.col("key").alias("s")), s.select(F.col("sid").alias("long_id"), F.col("key").alias("t")), gram).select(F.col("long_id").alias("sid"), F.col("short_id").alias("tid"))
    return exact.unionByName(greedy(one.unionByName(two), "sid", "tid")[0].select("sid", "tid", F.lit("contains").alias("kind")))


def not_prefix_duplicates(new: DataFrame, old: DataFrame, name: str = "name", prefix: int = 6) -> DataFrame:
    """Rows of ``new`` whose name neither shares its first characters with an old name nor contains or lies in one."""
    key = F.substring(name, 1, prefix)
    left = new.withColumn("_k", key).join(old.select(key.alias("_k")).distinct(), "_k", "left_anti").drop("_k")
    ids = left.select(F.col(name)).distinct()
    olds = old.select(name).distinct()
    a = contained_pairs(ids.select(F.col(name).alias("short_id"), F.col(name).alias("s")), olds.select(F.col(name).alias("long_id"), F.col(name).alias("t")), 5).select(F.col("short_id").alias(name))
    b = contained_pairs(olds.select(F.col(name).alias("short_id"), F.col(name).alias("s")), ids.select(F.col(name).alias("long_id"), F.col(name).alias("t")), 5).select(F.col("long_id").alias(name))
    return left.join(a.unionByName(b).distinct(), name, "left_anti")


def pattern_lookup(table: DataFrame, patterns: Sequence[str], exact_prefix: str = "", name: str = "name", key: str = "id") -> DataFrame:
    """The row that the first matching pattern picks: the exact name first, then the shortest, then the lowest key."""
    which, exact = F.lit(None).cast("int"), F.lit(False)
    for k, p in reversed(list(enumerate(patterns))):
        hit = F.contains(F.lower(name), F.lit(p.lower()))
        which, exact = F.when(hit, k).otherwise(which), F.when(hit, F.col(name) == exact_prefix + p).otherwise(exact)
    return table.withColumns({"_p": which, "_e": exact}).filter("_p is not null").orderBy("_p", F.desc("_e"), F.length(name), key).limit(1).drop("_p", "_e")
