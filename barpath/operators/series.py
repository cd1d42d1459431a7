"""Running bests, ranks, rolling activity, careers and percentiles. SURVEY WIN-*, AGG-18..27."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barpath.functions import divisions, parse


def year_to_date(df: DataFrame, value: Column, out: str, strict: bool = False) -> DataFrame:
    """WIN-2: the best of a lifter so far in the calendar year, rows of the same day included; with ``strict`` (WIN-3) of
    earlier days only."""
    day = F.datediff(F.to_date("date"), F.lit("1970-01-01"))
    w = Window.partitionBy("lifter_id", F.year(F.to_date("date"))).orderBy(day)
    return df.withColumn(out, F.max(value).over(w.rangeBetween(Window.unboundedPreceding, -1 if strict else 0)))


def legacy_year_to_date(df: DataFrame, value: str, out: str) -> DataFrame:
    """WIN-3b: the best integer of the year so far, 0 if there is none. Rows whose date is only a year count all through that
    year and themselves see its first day; a row without a year sees itself alone."""
    number = parse.strict_int(value)
    full = F.when(F.col("date").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date("date", "yyyy-MM-dd"))
    year = F.substring("date", 1, 4).try_cast("int")
    year = F.when(year.between(1900, 2100), year)
    day = F.datediff(F.coalesce(full, F.make_date(year, F.lit(1), F.lit(1))), F.lit("1970-01-01"))
    rows = df.withColumns({"__n": number, "__full": full.isNotNull(), "__y": year, "__d": day})
    w = Window.partitionBy("lifter_id", "__y")
    dated = F.max(F.when(F.col("__full"), F.col("__n"))).over(w.orderBy("__d").rangeBetween(Window.unboundedPreceding, 0))
    undated = F.max(F.when(~F.col("__full"), F.col("__n"))).over(w)
    best = F.when(F.col("__y").isNotNull(), F.greatest(dated, undated))
    return rows.withColumn(out, F.greatest(best, F.col("__n"), F.lit(0))).drop("__n", "__full", "__y", "__d")


def division_ranks(df: DataFrame, keys: list[str]) -> DataFrame:
    """WIN-5: places for snatch, clean and jerk, and total: the larger lift, then the lighter lifter, then the smaller id."""
    weight = F.when(F.coalesce("body_weight_kg", F.lit(0.0)) == 0, 999.0).otherwise(F.col("body_weight_kg"))
    place = lambda lift: F.row_number().over(Window.partitionBy(*keys).orderBy(F.coalesce(lift, F.lit(0)).desc(), weight, F.col("result_id")))
    return df.withColumns({"snatch_rank": place("best_snatch"), "cj_rank": place("best_cj"), "total_rank": place("total")})


def id_gaps(df: DataFrame, key: str, width: int = 1 << 16) -> DataFrame:
    """WIN-11: ``first, last, missing``: the gaps between ids. Neighbours are found within ranges of ``width`` ids, and those that end
    a range by the ends of the ranges: of these there are a ``width``-th of the ids' span at most, dealt again in ranges of theirs, until
    few are left. No gap is written out, however long."""
    ids = df.select(F.col(key).cast("long").alias("id")).where(F.col("id").isNotNull()).distinct()
    part = F.floor(F.col("id") / width)
    w = Window.partitionBy(part).orderBy("id")
    inside = ids.select("id", F.lead("id").over(w).alias("next")).where("next > id + 1")
    ends = ids.groupBy(part.alias("part")).agg(F.min("id").alias("low"), F.max("id").alias("high"))
    far = ends.select("*", F.floor(F.col("part") / width).alias("far"))
    v = Window.partitionBy("far").orderBy("part")
    across = far.select("high", F.lead("low").over(v).alias("next"), "far", "low")
    last = across.groupBy("far").agg(F.min("low").alias("low"), F.max("high").alias("high"))  # a row for each width ** 2 ids
    final = last.select("high", F.lead("low").over(Window.orderBy("far")).alias("next"))
    gaps = inside.unionByName(across.where("next is not null").select(F.col("high").alias("id"), "next")).unionByName(final.select(F.col("high").alias("id"), "next"))
    return gaps.where("next > id + 1").select((F.col("id") + 1).alias("first"), (F.col("next") - 1).alias("last"), (F.col("next") - F.col("id") - 1).alias("missing"))


def snapshots(first: str, last: str, months: int = 6) -> Column:
    """DAT-5."""
    return F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.make_interval(months=F.lit(months)))


def rolling_members(results: DataFrame, first: str, last: str, months: int = 6, key: str = "club_name") -> DataFrame:
    """WIN-4: distinct lifters and meets of a club in the twelve months before each snapshot, zero where there were none.

    A result goes to the (at most 12 / months) snapshots whose window holds it, so the sliding distinct count is a plain
    aggregation and there is no range join.
    """
    day = F.to_date("date")
    covering = F.filter(snapshots(first, last, months), lambda m: (day >= F.add_months(m, -12)) & (day < m))
    active = results.select(key, "lifter_id", "meet_id", F.explode(covering).alias("snapshot"))
    counts = active.groupBy(key, "snapshot").agg(F.count_distinct("lifter_id").alias("active_members"), F.count_distinct("meet_id").alias("meets"), F.count("*").alias("participations"))
    grid = results.select(key).distinct().select(key, F.explode(snapshots(first, last, months)).alias("snapshot"))
    joined = grid.join(counts, [key, "snapshot"], "left").na.fill(0, ["active_members", "meets", "participations"])
    factor = F.when(F.col("active_members") > 0, F.round(F.col("participations") / F.col("active_members"), 2))
    return joined.withColumn("activity_factor", factor)


def activity(results: DataFrame, key: str, since: str, until: str) -> DataFrame:
    """AGG-18: meets, lifters, participations and their ratio over a period; 0 without lifters."""
    inside = results.where(F.col("date").between(since, until))
    counts = inside.groupBy(key).agg(F.count_distinct("meet_id").alias("meets"), F.count_distinct("lifter_id").alias("lifters"), F.count("*").alias("participations"))
    return counts.withColumn("activity_factor", F.coalesce(F.round(F.col("participations") / F.nullif("lifters", F.lit(0)), 2), F.lit(0.0)))


def career(results: DataFrame, least: int = 12) -> DataFrame:
    """AGG-24: success, clutch, bounce-back, consistency, frequency, best score, openings and jumps of each lifter, of ``least``
    attempts or more. Consistency needs two totals. Openings are held against the total of the result before, if there is one.

    ``results``: lifter_id, result_id, date, total, the six attempts, qpoints, q_youth, q_masters. One window and one aggregation
    over the same rows of a lifter, so one shuffle.
    """
    a = {k: parse.attempt(k) for k in ("s1", "s2", "s3", "c1", "c2", "c3")}
    total = lambda f, ks: sum((f(a[k]) for k in ks), F.lit(0))
    made, missed = (lambda x: F.when(x > 0, 1).otherwise(0)), (lambda x: F.when(x < 0, 1).otherwise(0))
    both = lambda f: f("s") + f("c")
    clutch = lambda k: (a[k + "1"] < 0) & (a[k + "2"] < 0) & a[k + "3"].isNotNull()
    flag = lambda c: F.when(c, 1).otherwise(0)
    size = lambda k: F.abs(a[k])
    jumps = F.filter(F.array(*[100.0 * (size(f"{k}{i + 1}") - size(f"{k}{i}")) / F.nullif(size(f"{k}{i}"), F.lit(0)) for k in "sc" for i in (1, 2)]), lambda x: x.isNotNull())
    before = F.nullif(F.lag("total").over(Window.partitionBy("lifter_id").orderBy("date", "result_id")), F.lit(0))
    opening = F.nullif(F.coalesce(size("s1"), F.lit(0)) + F.coalesce(size("c1"), F.lit(0)), F.lit(0))
    per = results.select(
        "lifter_id", "date", "total", jumps.alias("jumps"), (100.0 * opening / before).alias("opening"), F.greatest("qpoints", "q_youth", "q_masters").alias("q"),
        *[total(made, [f"{k}{i}" for i in (1, 2, 3)]).alias(f"{k}_made") for k in "sc"], *[total(missed, [f"{k}{i}" for i in (1, 2, 3)]).alias(f"{k}_missed") for k in "sc"],
        both(lambda k: flag(clutch(k))).alias("clutch"), both(lambda k: flag(clutch(k) & (a[k + "3"] > 0))).alias("clutch_made"),
        *[flag((a[k + "1"] < 0) & a[k + "2"].isNotNull()).alias(f"{k}_bounce") for k in "sc"], *[flag((a[k + "1"] < 0) & (a[k + "2"] > 0)).alias(f"{k}_bounce_made") for k in "sc"],
    )
    rate = lambda x, n: 100 * F.sum(x) / F.nullif(F.sum(n), F.lit(0))
    days = F.datediff(F.max(F.to_date("date")), F.min(F.to_date("date")))
    scored = F.when(F.col("total") > 0, F.col("total"))
    out = per.groupBy("lifter_id").agg(
        F.sum(F.expr("s_made + s_missed + c_made + c_missed")).alias("attempts"),
        rate(F.expr("s_made + c_made"), F.expr("s_made + s_missed + c_made + c_missed")).alias("success_rate"),
        rate(F.col("s_made"), F.expr("s_made + s_missed")).alias("snatch_rate"), rate(F.col("c_made"), F.expr("c_made + c_missed")).alias("cj_rate"),
        rate(F.col("clutch_made"), F.col("clutch")).alias("clutch_rate"),
        rate(F.expr("s_bounce_made + c_bounce_made"), F.expr("s_bounce + c_bounce")).alias("bounce_rate"), rate(F.col("s_bounce_made"), F.col("s_bounce")).alias("snatch_bounce_rate"), rate(F.col("c_bounce_made"), F.col("c_bounce")).alias("cj_bounce_rate"),
        F.when(F.count(scored) >= 2, F.greatest(F.lit(0.0), 100 - 100 * F.stddev_pop(scored) / F.avg(scored))).alias("consistency"), F.max("q").alias("q_score"), F.avg("opening").alias("opening_strategy"),
        (F.sum(F.aggregate("jumps", F.lit(0.0), lambda s, x: s + x)) / F.nullif(F.sum(F.size("jumps")), F.lit(0))).alias("jump_percentage"),
        F.when(F.count("*") < 2, 0.0).otherwise((F.count("*") - 1) / F.greatest(F.lit(90), days) * 365.25).alias("frequency"),
    )
    return out.where(F.col("attempts") >= least)


def with_percentile(df: DataFrame, value: str, keys: list[str], out: str) -> DataFrame:
    """WIN-7: 100 (rows below + half of those equal) / rows of the key, rounded. Null values count and rank as the least.

    Equal values are counted first, so the windows see a row for each distinct value and a key of most rows is no hot task.
    """
    names = [*keys, value]
    counts = df.groupBy(*names).agg(F.count("*").alias("__same"))
    w = Window.partitionBy(*keys)
    below = F.coalesce(F.sum("__same").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = counts.select(*[F.col(c).alias(f"__{i}") for i, c in enumerate(names)], F.round(100 * (below + 0.5 * F.col("__same")) / F.sum("__same").over(w)).alias(out))
    same = reduce(operator.and_, (df[c].eqNullSafe(ranks[f"__{i}"]) for i, c in enumerate(names)))
    return df.join(ranks, same).select(*[df[c] for c in df.columns], out)


def quantile_points(counts: DataFrame, keys: list[str], value: str, count: str, points: int = 101) -> DataFrame:
    """AGG-26: ``i`` from 0 to 100 and ``value``, the element at floor(i / 100 n) of the sorted values of a key.

    Values come with their counts, so the windows see a row for each distinct value. Each value gives the points that lie
    between the number of smaller values and that of those up to it.
    """
    w = Window.partitionBy(*keys)
    upto = F.sum(count).over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    rows = counts.withColumns({"__upto": upto, "__n": F.sum(count).over(w)})
    last = F.lit(points - 1)
    at = lambda i: F.least(F.col("__n") - 1, F.floor((i / F.lit(float(points - 1))) * F.col("__n")))
    own = F.filter(F.sequence(F.lit(0), last), lambda i: (at(i) >= F.col("__upto") - F.col(count)) & (at(i) < F.col("__upto")))
    return rows.select(*keys, F.col(value).alias("value"), F.explode(own).alias("i"))


def map_percentile(points: Column, value: Column) -> Column:
    """WIN-8: the place of a value among the first hundred points of a quantile map, ties in the middle."""
    head = F.slice(points, 1, 100)
    return F.floor(F.size(F.filter(head, lambda x: x < value)) + 0.5 * F.size(F.filter(head, lambda x: x == value)) + 0.5)


def distributions(careers: DataFrame, people: DataFrame, metrics: list[str]) -> DataFrame:
    """AGG-25: for each demographic bucket and metric its distinct values and how often each occurs (``n``): the sorted array
    of the bucket as rows, so that no bucket has to fit in a task. ``people``: lifter_id, source, gender, age."""
    long = careers.unpivot("lifter_id", metrics, "metric", "value").where("value is not null")
    tagged = long.join(people, "lifter_id").select("metric", "value", F.explode(divisions.buckets("source", "gender", "age")).alias("bucket"))
    return tagged.groupBy("bucket", "metric", "value").agg(F.count("*").alias("n"))


def medals(ranked: DataFrame, by: list[str] = ["lift"]) -> DataFrame:  # noqa: B006
    """AGG-27: medals of each lifter by colour and by kind of lift, or by other columns such as the level of the meet."""
    keep = [c for c in by if c != "lift"]
    long = ranked.unpivot(["lifter_id", *keep], ["snatch_rank", "cj_rank", "total_rank"], "lift", "place").where("place between 1 and 3")
    count = lambda n, name: F.count_if(F.col("place") == n).alias(name)
    return long.groupBy("lifter_id", *by).agg(count(1, "gold"), count(2, "silver"), count(3, "bronze"))


def medal_list(ranked: DataFrame) -> DataFrame:
    """AGG-27: the results of each lifter that won a medal, the latest first."""
    won = ranked.where(F.least("snatch_rank", "cj_rank", "total_rank") <= 3)
    rows = F.sort_array(F.collect_list(F.struct("date", F.col("result_id").cast("string").alias("__order"), "result_id", "snatch_rank", "cj_rank", "total_rank")), asc=False)
    return won.groupBy("lifter_id").agg(rows.alias("medals"))


def name_tokens(*columns) -> Column:
    """Distinct words of three letters or more of names, no numbers."""
    words = F.split(F.regexp_replace(F.lower(F.concat_ws(" ", *columns)), "[^a-z0-9 ]", ""), " ")
    return F.array_distinct(F.filter(words, lambda x: (F.length(x) > 2) & ~x.rlike("^[0-9]+$")))


def batch_proximity(rows: DataFrame, key: str, time: str, within: int) -> DataFrame:
    """DQ-22: ``a, b, n, near, share``: of the n rows of a, how many have a row of b less than ``within`` away; pairs with none are left out.

    The nearest row of b is in the bin of the row (any there is near enough), or it is the last of the bin before or the first of
    the bin after: the ends of each b in a bin are all that is needed. Rows of one time are counted first, so a time that very many share is
    one row.
    """
    counts = rows.groupBy(F.col(key).alias("a"), F.col(time).alias("t")).agg(F.count("*").alias("k")).withColumn("bin", F.floor(F.col("t") / within))
    ends = counts.groupBy("bin", F.col("a").alias("b")).agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    side = F.explode(F.array(*[F.struct((F.col("bin") + i).alias("bin"), F.when(F.lit(i == 0), True).alias("own"), F.when(F.lit(i == 1), F.col("hi")).alias("before"), F.when(F.lit(i == -1), F.col("lo")).alias("after")) for i in (-1, 0, 1)]))
    around = ends.select("b", side.alias("s")).groupBy("s.bin", "b").agg(F.max("s.own").alias("own"), F.max("s.before").alias("before"), F.min("s.after").alias("after"))
    close = F.col("own").isNotNull() | F.coalesce(F.col("before") > F.col("t") - within, F.lit(False)) | F.coalesce(F.col("after") < F.col("t") + within, F.lit(False))
    near = counts.join(around, "bin").where((F.col("a") != F.col("b")) & close).groupBy("a", "b").agg(F.sum("k").alias("near"))
    total = counts.groupBy("a").agg(F.sum("k").alias("n"))
    return near.join(total, "a").select("a", "b", "n", "near", (F.col("near") / F.col("n")).alias("share"))


def nearest_meet(meets: DataFrame, others: DataFrame, days: int = 14) -> DataFrame:
    """JOIN-9: of the meets within ``days`` days the one that shares most words of name and level, at least one; of equals the
    smallest id. Each meet is copied to the bins of days it can match in, so the range join is an equi-join."""
    day = F.datediff(F.to_date("meet_date"), F.lit("1970-01-01"))
    a = meets.select("meet_id", name_tokens("meet_name", "level").alias("w"), day.alias("d")).withColumn("bin", F.explode(F.array(*[F.floor(F.col("d") / days) + k for k in (-1, 0, 1)])))
    b = others.select(F.col("meet_id").alias("other"), name_tokens("meet_name", "level").alias("w2"), day.alias("d2")).withColumn("bin", F.floor(F.col("d2") / days))
    near = a.join(b, "bin").where((F.col("meet_id") != F.col("other")) & (F.abs(F.col("d") - F.col("d2")) <= days))
    shared = near.select("meet_id", "other", F.size(F.array_intersect("w", "w2")).cast("long").alias("shared")).where("shared > 0")
    best = shared.groupBy("meet_id").agg(F.min_by(F.struct("other", "shared"), F.struct(-F.col("shared"), "other")).alias("b"))
    return best.select("meet_id", "b.other", "b.shared")
