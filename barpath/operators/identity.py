"""Who is who: resolving lifters, scoring duplicates, merging. SURVEY DQ-*."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barpath.operators.tables import first_by


def surgical_merge(results: DataFrame, masters: DataFrame, harvest: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """DQ-13: the results after every athlete is merged into his master (``masters``: lifter_id, master), and the emptied profiles.

    Masters keep all their own results, equal ones too, and so do athletes in no merge. A duplicate's result goes if the master
    has one of the same meet and day whose total, of known ones, is less than 0.1 away; that one takes what it lacks of ``harvest`` ('' and '-' are
    lacking too). Results that meet none are reassigned. Duplicates come in the order of their ids, and what one has brought is the
    master's when the next one comes. ``action``: kept or reassigned. Only rows of one athlete, meet and day are ever held together.
    """
    others = masters.where(F.col("lifter_id") != F.col("master"))
    merged = others.select("lifter_id", "master").unionByName(others.select(F.col("master").alias("lifter_id"), "master")).distinct()
    rows = results.join(merged, "lifter_id", "left")
    alone = rows.where(F.col("master").isNull()).select("result_id", "lifter_id", *harvest, F.lit("kept").alias("action"))
    own = F.col("lifter_id") == F.col("master")
    one = F.struct((~own).alias("late"), "lifter_id", "result_id", F.col("total").cast("double").alias("t"), *harvest)
    days = rows.where(F.col("master").isNotNull()).groupBy("master", "meet_name", "date").agg(F.array_sort(F.collect_list(one)).alias("all"))
    meets = lambda k, x: (k["lifter_id"] != x["lifter_id"]) & F.coalesce(F.abs(k["t"] - x["t"]) < 0.1, F.lit(False))
    lacks = lambda y, c: y[c].isNull() | y[c].cast("string").isin("", "-")
    filled = lambda k, x: F.struct(*[k[c].alias(c) for c in ("late", "lifter_id", "result_id", "t")], *[F.when(lacks(k, c) & ~lacks(x, c), x[c]).otherwise(k[c]).alias(c) for c in harvest])

    def step(kept: Column, x: Column) -> Column:
        hit = F.filter(F.transform(kept, lambda k, i: F.when(meets(k, x), i)), lambda i: i.isNotNull())
        return F.when(F.size(hit) == 0, F.concat(kept, F.array(x))).otherwise(F.transform(kept, lambda k, i: F.when(i == F.get(hit, F.lit(0)), filled(k, x)).otherwise(k)))

    none = F.slice("all", 1, 0)
    kept = days.select("master", F.explode(F.aggregate("all", none, step)).alias("r"))
    action = F.when(F.col("r.lifter_id") == F.col("master"), "kept").otherwise("reassigned")
    out = kept.select("r.result_id", F.col("master").alias("lifter_id"), *[F.col(f"r.{c}").alias(c) for c in harvest], action.alias("action"))
    return alone.unionByName(out), others.select("lifter_id").distinct()


def name_change_plan(people: DataFrame, results: DataFrame, active: DataFrame, scraped: DataFrame) -> DataFrame:
    """DQ-21: memberships held under several names, one of which at least has an internal id: ``membership_number``, ``keeper``,
    ``decision``, ``missing``.

    ``people``: lifter_id, athlete_name, membership_number, internal_id; ``results``: lifter_id, date, total; ``active``:
    membership_number, active_name (that of the public profile); ``scraped``: membership_number, date, total (its history). The keeper is the
    holder of the active name, of several the first with an internal id. Nobody of that name: 'no destination'. The merge is safe if
    every signature (date and total over 0) of the holders' results is in the history, however often it occurs in either; else
    'history mismatch', and ``missing`` lists what is not there. No profile: 'no profile'.
    """
    name = F.lower(F.trim("athlete_name"))
    held = people.where(F.col("membership_number").isNotNull())
    groups = held.groupBy("membership_number").agg(F.count_distinct(name).alias("names"), F.count("internal_id").alias("ids")).where("names > 1 and ids > 0")
    held = held.join(groups.select("membership_number"), "membership_number")
    matching = held.join(active, "membership_number").where(F.lower(F.trim("athlete_name")) == F.lower(F.trim("active_name")))
    keeper = matching.groupBy("membership_number").agg(F.min(F.struct(F.col("internal_id").isNull(), F.col("lifter_id")))["lifter_id"].alias("keeper"))
    stored = results.select("lifter_id", "date", "total").join(held.select("lifter_id", "membership_number"), "lifter_id").where("total > 0").select("membership_number", "date", F.col("total").cast("double").alias("total")).distinct()
    there = scraped.select("membership_number", "date", F.col("total").cast("double").alias("total"))
    gone = stored.join(there, ["membership_number", "date", "total"], "left_anti")
    gone = gone.groupBy("membership_number").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("|", "date", F.col("total").cast("decimal(12,1)").cast("string")))), ",").alias("missing"))
    j = groups.select("membership_number").join(active, "membership_number", "left").join(keeper, "membership_number", "left").join(gone, "membership_number", "left")
    decision = F.when(F.col("active_name").isNull(), "no profile").when(F.col("keeper").isNull(), "no destination").when(F.col("missing").isNotNull(), "history mismatch").otherwise("merge")
    return j.select("membership_number", "keeper", decision.alias("decision"), F.when(F.col("keeper").isNotNull(), F.col("missing")).alias("missing"))


def dedupe_valid(df: DataFrame, keys: Sequence[str], total: str = "total", tie: str = "result_id") -> DataFrame:
    """DQ-3: of each key the row of the largest valid total, else the oldest."""
    value = F.col(total).try_cast("int")
    return first_by(df, keys, [F.when(value > 0, 0).otherwise(1), F.desc_nulls_last(value), tie])


def duplicate_score(shared_id: Column, all_ids_differ: Column, shared_membership: Column, memberships_differ: Column, identical: Column, conflict: Column, many_classes: Column, anomaly: Column, overlap: Column) -> Column:
    """DQ-4: 20 and the weight of each flag, from 0 to 100."""
    flags = [(shared_id, 30), (all_ids_differ, -30), (shared_membership, 20), (memberships_differ, -15), (identical, 15), (conflict, 10), (many_classes, 5), (anomaly, 5), (overlap, 10)]
    score = F.lit(20)
    for flag, weight in flags:
        score = score + F.when(flag, weight).otherwise(0)
    return F.greatest(F.lit(0), F.least(F.lit(100), score))


def case_type(score: Column) -> Column:
    return F.when(score >= 60, "merge").when(score <= 10, "split").otherwise("ambiguous")


def merge_by(df: DataFrame, shared: str, key: str) -> DataFrame:
    """DQ-12, 14: every row with its master, the smallest key that shares the value; rows without one are their own, and meet
    in no window."""
    known = df.where(F.col(shared).isNotNull()).withColumn("master", F.min(key).over(Window.partitionBy(shared)))
    return known.unionByName(df.where(F.col(shared).isNull()).withColumn("master", F.col(key)))


def shared_signatures(rows: DataFrame, name: str) -> DataFrame:
    """DQ-5: of each name and ``signature`` how many results belong to another athlete at another meet than the first that has it (by
    athlete, meet and result)."""
    first = rows.groupBy(name, "signature").agg(F.min(F.struct("lifter_id", "meet_id", "result_id")).alias("f"))
    other = (F.col("lifter_id") != F.col("f.lifter_id")) & (F.col("meet_id") != F.col("f.meet_id"))
    return rows.join(first, [name, "signature"]).where(other).groupBy(name, "signature").agg(F.count("*").alias("others"))


def cleanup_plan(matches: DataFrame, orphans: DataFrame) -> DataFrame:
    """DQ-17: the rows of a plan: athletes to create or update, results to reassign, results of nobody.

    ``matches``: result_id, lifter_id, lifter_name, membership_number, birth_year, internal_id, needs_new; ``orphans``: result_id. An athlete is
    an internal id; what is known of him is that of his first result, whose athlete he keeps unless he needs an id of his own ('NEW_'
    and the internal id, until it is made).
    """
    facts = F.min(F.struct("result_id", F.col("lifter_name").alias("athlete_name"), "membership_number", "birth_year", F.col("lifter_id").alias("old"))).alias("f")
    people = matches.groupBy("internal_id", "needs_new").agg(facts, F.count("*").alias("meets"))
    new = F.col("needs_new")
    athletes = people.select(F.when(new, "create").otherwise("update").alias("kind"), "internal_id", F.col("f.old").alias("lifter_id"), "f.athlete_name", "f.membership_number", F.when(new, F.col("f.birth_year")).alias("birth_year"), "meets")
    target = F.when(new, F.concat(F.lit("NEW_"), F.col("internal_id").cast("string"))).otherwise(F.col("f.old").cast("string"))
    moves = matches.select("result_id", "lifter_id", F.col("lifter_name").alias("athlete_name"), "internal_id", "needs_new").join(people.select("internal_id", "needs_new", "f"), ["internal_id", "needs_new"])
    moves = moves.select(F.lit("reassign").alias("kind"), "internal_id", "result_id", "lifter_id", target.alias("target"), "athlete_name", F.lit(1).cast("long").alias("meets"))
    return athletes.unionByName(moves, allowMissingColumns=True).unionByName(orphans.select(F.lit("orphan").alias("kind"), "result_id"), allowMissingColumns=True)


def safe_ghosts(people: DataFrame, results: DataFrame, metadata: Sequence[str]) -> DataFrame:
    """DQ-24: athletes without results of whom another with results has the name, and whatever is known of ``metadata`` too."""
    ghosts = people.join(results.select("lifter_id"), "lifter_id", "left_anti").alias("g")
    active = people.join(results.select("lifter_id"), "lifter_id", "left_semi").alias("a")
    same = F.col("g.athlete_name") == F.col("a.athlete_name")
    for c in metadata:
        same = same & (F.col(f"g.{c}").isNull() | F.coalesce(F.col(f"a.{c}") == F.col(f"g.{c}"), F.lit(False)))
    return ghosts.join(active, same, "left_semi")


def audit_verdict(name, title) -> Column:
    """DQ-26: is the title of a public profile the name? Letters and single spaces only."""
    plain = lambda t: F.trim(F.regexp_replace(F.regexp_replace(F.lower(t), r"[^a-z\s]", ""), r"\s+", " "))
    page = F.regexp_replace(F.col(title), r"(?i)\s*Results\s*Back\s*to\s*Rankings\s*$", "")
    return F.when(plain(F.col(name)) == plain(page), "MATCH").otherwise("MISMATCH")


def audit_queue(people: DataFrame, n: int, first: str | None = None) -> DataFrame:
    """DQ-26: the next ``n`` to audit with their ``place``: the least recently audited; of equals those of the sex that comes first, then the
    unknown; then by id. Only n rows are ever in one task."""
    order = ["last_audited"]
    if first:
        order.append(F.when(F.col("gender_hint") == first, 0).when(F.col("gender_hint").isin("F", "M"), 2).otherwise(1))
    order.append("lifter_id")
    chosen = people.orderBy(*order).limit(n)
    return chosen.withColumn("place", F.row_number().over(Window.orderBy(*order)))


def completeness(stored: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """DQ-11: rows stored and in the source, their difference and status."""
    a = stored.groupBy(key).agg(F.count("*").alias("stored"), F.max(F.col("total").isNull()).alias("holes"))
    b = source.groupBy(key).agg(F.count("*").alias("expected"))
    j = a.join(b, key, "full_outer").na.fill(0, ["stored", "expected"])
    status = F.when(F.coalesce("holes", F.lit(False)), "incomplete").when(F.col("stored") == F.col("expected"), "complete").otherwise("discrepancy")
    return j.select(key, "stored", "expected", (F.col("expected") - F.col("stored")).alias("gap"), status.alias("status"))
