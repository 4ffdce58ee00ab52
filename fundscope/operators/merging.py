"""Merging incoming records into a current table, as pure functions: the caller writes the result.

Each returns the new table, and where it matters a plan of what changes, so that a dry run is just not writing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import blank_to_null
from ..store import stored
from . import windows


def _last(incoming: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[Column], blanks: bool = True) -> DataFrame:
    """A row per key: of each value column the last one, by ``order`` and then by all columns, that isn't NULL."""
    place = F.struct(*order, *[F.col(c) for c in incoming.columns])
    given = lambda c: blank_to_null(F.col(c)) if dict(incoming.dtypes)[c] == "string" and not blanks else F.col(c)
    return incoming.groupBy(*keys).agg(*[F.max_by(given(v), F.when(given(v).isNotNull(), place)).alias(f"_n_{v}") for v in values])


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & a[k].eqNullSafe(b[f"_k_{k}"])
    return out


def upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[Column] = ()) -> tuple[DataFrame, DataFrame]:
    """(table, plan): new values win where they aren't NULL; the plan counts inserted and updated keys.

    Incoming rows of one key take effect one after the other, by ``order`` and then by all columns, and make one row.
    NULL keys equal each other.
    """
    cur = current.select(*keys, *[F.col(v).alias(f"_o_{v}") for v in values], F.lit(True).alias("_old"))
    new = _last(incoming.select(*dict.fromkeys([*incoming.columns])), keys, values, order).withColumn("_new", F.lit(True)).withColumnsRenamed({k: f"_k_{k}" for k in keys})
    both = cur.join(new, _same(cur, new, keys), "full_outer")
    table = both.select(*[F.when(F.col("_old"), cur[k]).otherwise(F.col(f"_k_{k}")).alias(k) for k in keys], *[F.coalesce(f"_n_{v}", f"_o_{v}").alias(v) for v in values])
    plan = both.agg(F.count_if(F.col("_new") & F.col("_old").isNull()).alias("inserted"), F.count_if(F.col("_new") & F.col("_old")).alias("updated"), F.count_if(F.col("_new").isNull()).alias("kept"))
    return table, plan


def get_or_create(current: DataFrame, wanted: DataFrame, keys: Sequence[str], prefix: str, extra: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(table, ids): rows of ``current`` (id, keys, extra) and new ones for wanted keys it lacks; ids of all wanted keys.

    New ids are hashes of the keys, so a second run finds what the first one made.  Of several rows with one key the least
    id counts, and a new row takes the first extra values by their order.  NULL keys equal each other.
    """
    known = current.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.min("id").alias("_id"))
    asked = wanted.groupBy(*keys).agg(*[F.min(F.struct(*extra))[e].alias(e) for e in extra], F.lit(True).alias("_asked"))
    both = asked.join(known, _same(asked, known, keys), "left").select(*keys, *extra, "_id")
    parts = F.concat_ws("\x1f", *[F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys])
    made = F.coalesce("_id", F.concat(F.lit(f"{prefix}_"), F.substring(F.sha2(parts, 256), 1, 32)))
    ids = stored(both.select(made.alias("id"), *keys, *extra, F.col("_id").isNull().alias("is_new")), "ids")
    table = current.select("id", *keys, *extra).unionByName(ids.filter("is_new").select("id", *keys, *extra))
    return table, ids.select("id", *keys, "is_new")


def upsert_star(tables: dict[str, DataFrame], records: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """(tables, plan) after records have entered a star of organisations, programmes, calls and results in one run.

    ``tables``: organisations (id, name), programs (id, organization_id, name), calls (id, program_id, fiscal_year),
    results (id, call_id, awardee, title, amount, source_url).  ``records``: seq, organization, program, fiscal_year,
    awardee, title, amount, source_url.  Each level is found by its natural key or made, and its id flows to the next.
    Records without a year make nothing; those without awardee or title make no result, but their call.  A result that
    exists takes the values that aren't NULL, record by record in the order of ``seq``; the plan counts, for each table,
    rows that were inserted, found and left alone.
    """
    from ..functions import strip

    r = records.filter("fiscal_year is not null").withColumns({c: F.coalesce(strip(F.col(c)), F.lit("")) for c in ("awardee", "title")})
    r = stored(r.withColumn("program", F.coalesce("program", F.lit("general"))), "records")
    orgs, ids = get_or_create(tables["organisations"], r.select(F.col("organization").alias("name")), ["name"], "org")
    new = {"organisations": ids}
    r = r.join(ids.select(F.col("id").alias("organization_id"), F.col("name").alias("_name")), F.col("organization").eqNullSafe(F.col("_name"))).drop("_name", "organization")
    programs, ids = get_or_create(tables["programs"], r.select("organization_id", F.col("program").alias("name")), ["organization_id", "name"], "prog")
    new["programs"] = ids
    r = r.withColumnRenamed("program", "name").join(ids.select(F.col("id").alias("program_id"), "organization_id", "name"), ["organization_id", "name"]).drop("organization_id", "name")
    calls, ids = get_or_create(tables["calls"], r, ["program_id", "fiscal_year"], "call")
    new["calls"] = ids
    r = r.join(ids.select(F.col("id").alias("call_id"), "program_id", "fiscal_year"), ["program_id", "fiscal_year"])
    r = r.filter("awardee <> '' and title <> ''").select("seq", "call_id", "awardee", "title", "amount", "source_url")
    keys, values = ["call_id", "awardee", "title"], ["amount", "source_url"]
    _, ids = get_or_create(tables["results"].select("id", *keys), r, keys, "res")
    new["results"] = ids
    incoming = r.join(ids.select("id", *keys), keys).select("id", *keys, *values, "seq")
    results, _ = upsert(tables["results"].select("id", *keys, *values), incoming, ["id"], [*keys, *values], [F.col("seq")])
    plan = None
    for name, ids in new.items():
        counts = ids.agg(F.count_if(F.col("is_new")).alias("inserted"), F.count_if(~F.col("is_new")).alias("found"))
        row = counts.crossJoin(tables[name].agg(F.count(F.lit(1)).alias("before"))).select(F.lit(name).alias("name"), "inserted", "found", (F.col("before") - F.col("found")).alias("untouched"))
        plan = row if plan is None else plan.unionByName(row)
    return {"organisations": orgs, "programs": programs, "calls": calls, "results": results}, plan


def fill_blanks(current: DataFrame, incoming: DataFrame, key: str, columns: Sequence[str], zero_too: bool = False, order: Sequence[Column] = ()) -> DataFrame:
    """Current values where they aren't blank (nor 0, if ``zero_too``), else incoming ones.

    Of several incoming rows with one key, the last value that isn't blank fills; a NULL key fills nothing.
    """
    new = _last(incoming, [key], columns, order, blanks=False)
    kinds = dict(current.dtypes)

    def kept(c: str) -> Column:
        if kinds[c] == "string":
            return blank_to_null(F.col(c))
        return F.nullif(F.col(c), F.lit(0).cast(kinds[c])) if zero_too else F.col(c)

    return current.join(new, key, "left").select(*[F.coalesce(kept(c), f"_n_{c}").alias(c) if c in columns else F.col(c) for c in current.columns])


def insert_or_ignore(current: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key exists are left out; among incoming rows of one key the first by all columns enters."""
    fresh = windows.first_per_key(incoming.join(current, list(keys), "left_anti"), list(keys), [F.col(c) for c in incoming.columns])
    return current.unionByName(fresh)


def replace_slices(current: DataFrame, incoming: DataFrame, slice_keys: Sequence[str]) -> DataFrame:
    """All rows of the slices that the incoming rows belong to are replaced by them; applying twice is applying once."""
    kept = current.join(incoming.select(*slice_keys).distinct(), list(slice_keys), "left_anti")
    return kept.select(current.columns).unionByName(incoming)


def absorb_duplicates(df: DataFrame, group: Column, order: Sequence[Column], key: str, fill: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(primaries, id map): the first of each group takes values it lacks from the others in order; the map repoints children."""
    w = Window.partitionBy(group).orderBy(*order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    kinds = dict(df.dtypes)
    value = lambda c: blank_to_null(F.col(c)) if kinds[c] == "string" else F.col(c)
    ranked = df.withColumns({"_rn": F.row_number().over(w), "_primary": F.first(key).over(whole), **{f"_f_{c}": F.first(value(c), ignorenulls=True).over(whole) for c in fill}})
    primaries = ranked.filter("_rn = 1").select(*[F.col(f"_f_{c}").alias(c) if c in fill else F.col(c) for c in df.columns])
    return primaries, ranked.filter("_rn > 1").select(F.col(key).alias("old_id"), F.col("_primary").alias("new_id"))


def resolved(id_map: DataFrame, old: str = "old_id", new: str = "new_id") -> DataFrame:
    """``id_map`` with each old id pointing to the end of its chain: the one that was not merged itself.

    Pointers jump: every round an id takes what its target points to, so chains of length n need log2(n) rounds.  An id
    that comes to point to itself, or chains that don't end, are a cycle and refused; so is an old id with two new ones.
    Rows that map an id to itself, or have a null, say nothing and go.
    """
    links = stored(id_map.select(F.col(old).alias("a"), F.col(new).alias("b")).filter("a <> b").distinct(), "links")
    n, distinct = links.agg(F.count(F.lit(1)), F.count_distinct("a")).first()
    if n != distinct:
        raise ValueError("an id was merged into two others")
    for _ in range(n.bit_length() + 1):
        far = links.select(F.col("a").alias("b"), F.col("b").alias("c"))
        jumped = stored(links.join(far, "b", "left").select("a", F.coalesce("c", "b").alias("b"), F.col("c").isNotNull().alias("moved")), "links")
        if not jumped.filter("a = b").isEmpty():
            break
        links = jumped.select("a", "b")
        if jumped.filter("moved").isEmpty():
            return links.select(F.col("a").alias(old), F.col("b").alias(new))
    raise ValueError("the map of merged ids has a cycle")


def repoint(children: DataFrame, id_map: DataFrame, column: str, unique: Sequence[str] | None = None, order: Sequence[Column] = ()) -> DataFrame:
    """Children of merged parents point to the primary; of rows that now share ``unique`` the first stays.

    The map is followed to its end where a primary was merged itself.
    """
    id_map = resolved(id_map)
    out = children.join(id_map, children[column] == id_map["old_id"], "left")
    out = out.withColumn(column, F.coalesce("new_id", column)).select(children.columns)
    return windows.first_per_key(out, list(unique), list(order) or [F.col(c) for c in children.columns]) if unique else out


def soft_duplicates(df: DataFrame, group: Column, order: Sequence[Column], key: str) -> DataFrame:
    """``duplicate_of``: the group's first key for all but the first row."""
    w = Window.partitionBy(group).orderBy(*order)
    first = F.first(key).over(w)
    return df.withColumn("duplicate_of", F.when(first != F.col(key), first))


def resolve_collisions(df: DataFrame, column: str, group: Column, order: Sequence[Column], never: Column) -> DataFrame:
    """The value stays with the best row of its group and becomes NULL elsewhere, and everywhere where ``never`` holds."""
    best = F.row_number().over(Window.partitionBy(group).orderBy(*order)) == 1
    return df.withColumn(column, F.when(best & ~F.coalesce(never, F.lit(False)), F.col(column)))


def supersede(current: DataFrame, authority: DataFrame, key: str, column: str) -> tuple[DataFrame, DataFrame]:
    """(table, log): the authority's value wins; the log has every value that it replaced."""
    both = current.join(authority.select(key, F.col(column).alias("_a")), key, "left")
    table = both.withColumn(column, F.coalesce("_a", column)).select(current.columns)
    log = both.filter(F.col("_a").isNotNull() & F.col(column).isNotNull() & (F.col("_a") != F.col(column))).select(key, F.col(column).alias("old"), F.col("_a").alias("new"))
    return table, log


def append_missing(current: DataFrame, registry: DataFrame, key: str, prefer: Sequence[Column], require: Column) -> DataFrame:
    """Registry entities that the table lacks, one per key, by preference, if they meet the requirement."""
    fresh = windows.first_per_key(registry.filter(require), [key], prefer).join(current, key, "left_anti")
    return current.unionByName(fresh, allowMissingColumns=True)


def correct(current: DataFrame, corrections: DataFrame, key: str, column: str) -> DataFrame:
    """Values named by corrections (key, bad, reason) become NULL; ``audit`` keeps what and why.

    A key may have several corrections, each for a value of its own; of equal ones the first reason counts.
    """
    c = corrections.groupBy(F.col(key).alias("_k"), F.col("bad").alias("_bad")).agg(F.min("reason").alias("_reason"), F.lit(True).alias("_hit"))
    out = current.join(c, (current[key] == F.col("_k")) & (current[column] == F.col("_bad")), "left")
    out = out.withColumn("audit", F.when(F.col("_hit"), F.concat_ws("|", F.lit(column), F.col(column).cast("string"), "_reason")))
    return out.withColumn(column, F.when(F.col("_hit").isNull(), F.col(column))).select(*current.columns, "audit")


def fill_from_children(parents: DataFrame, children: DataFrame, key: str, column: str, agg: Column) -> DataFrame:
    """NULLs of the column are filled from an aggregate over the children."""
    return parents.join(children.groupBy(key).agg(agg.alias("_v")), key, "left").withColumn(column, F.coalesce(column, "_v")).drop("_v")


def insert_missing_types(current: DataFrame, wide: DataFrame, key: str, types: Sequence[str]) -> DataFrame:
    """Unpivot extracted columns to (key, type, value) and add those that the table lacks."""
    long = wide.unpivot([key], list(types), "type", "value").filter("value is not null and value <> ''")
    return current.unionByName(long.join(current, [key, "type"], "left_anti"))


def purge_orphans(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    return children.join(parents, key, "left_semi")


def without_attempted(todo: DataFrame, attempts: DataFrame, key: str) -> DataFrame:
    """Keys that no earlier run tried; a NULL among the attempts excludes nothing."""
    return todo.join(attempts.filter(F.col(key).isNotNull()), key, "left_anti")


def derive_dimension(facts: DataFrame, column: str, prefix: str) -> tuple[DataFrame, DataFrame]:
    """(dimension, facts with its id): ids are hashes of the text, equal in every run."""
    from ..functions.structured import stable_id

    key = F.trim(column)
    dim = facts.filter(blank_to_null(key).isNotNull()).select(stable_id(prefix, key).alias("id"), key.alias("name")).distinct()
    return dim, facts.withColumn(f"{column}_id", F.when(blank_to_null(key).isNotNull(), stable_id(prefix, key)))


def gate(df: DataFrame, reasons: Sequence[tuple[str, Column]]) -> DataFrame:
    """``reason``: the first test that holds, NULL for accepted rows."""
    reason = F.lit(None).cast("string")
    for name, test in reversed(list(reasons)):
        reason = F.when(F.coalesce(test, F.lit(False)), name).otherwise(reason)
    return df.withColumn("reason", reason)
