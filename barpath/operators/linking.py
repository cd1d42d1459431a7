"""Athletes of two federations linked by names and attempts. SURVEY DQ-9, 10, JOIN-11."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barpath.functions.attempts import SLOTS, overlap_of
from barpath.functions.text import tokens
from barpath.session import SHUFFLED, materialise, shuffle_partitions

#: Two of six slots may differ, and these spoil two of three groups at most: rows that agree in four slots agree in a whole group.
GROUPS = ((0, 1), (2, 3), (4, 5))
#: The distinct attempts of a meet are compared in so many tasks.
PARTS = 8


def _words(name) -> Column:
    return F.array_distinct(F.split(F.lower(name), " "))


def contained(a: DataFrame, b: DataFrame, words: Callable[[str], Column] = _words) -> DataFrame:
    """JOIN-11: rows of ``a`` (name, birth_year) and of ``b`` (other_name, birth_year) born in one year, where all words of the
    other name, two or more, are in the name. The year, the last word of the other name and another one are the join key."""
    # two words of the other name are a key, and every two of the name: few meet who share only a last name
    w, n = F.col("__w"), F.col("__n")
    long = a.withColumn("__n", F.array_distinct(words("name"))).withColumn("__key", F.explode(n)).withColumn("__key2", F.explode(n))
    other = b.withColumn("__w", words("other_name")).where(F.size(w) >= 2).withColumn("__key", F.element_at(w, -1))
    other = other.withColumn("__key2", F.coalesce(F.get(F.filter(w, lambda x: x != F.element_at(w, -1)), F.lit(0)), "__key"))
    return long.join(other.hint(SHUFFLED), ["birth_year", "__key", "__key2"]).where(F.size(F.array_except(w, n)) == 0).drop("__key", "__key2", "__w", "__n")


def attempt_pairs(a: DataFrame, b: DataFrame, block: str) -> DataFrame:
    """(left, right) for the rows of ``a`` and ``b`` of one ``block`` whose attempts agree (``overlap``): a superset, which the caller
    tests. Rows: id, block, a (six attempts as sizes, null if there was none).

    Rows that agree within one in four slots of six agree in both slots of one of three groups. Values are binned by two, so a value and
    what is within one of it lie in two bins: the left row goes to all bins of its group, the right row to its own. A pair of
    which fewer than four slots are known on both sides has a side with two unknown ones or more; these few rows meet the others by
    every two slots, and those of three unknown ones or more by single slots too: a pair with one slot known on both sides has such a side.
    """

    def side(df: DataFrame, name: str, slots, reach: int) -> DataFrame:
        """A row for each two slots and each of their bins; ``reach`` is how far a value looks."""
        which = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in slots]))
        rows = df.select(block, F.col("id").alias(name), "a", which.alias("s")).select(block, name, "s", F.get("a", F.col("s.i")).alias("v"), F.get("a", F.col("s.j")).alias("w")).where("v is not null and w is not null")
        for x in ("v", "w"):  # a value and what is within one of it lie in two bins
            low, high = (F.floor((F.col(x) + k) / 2) for k in (-reach, reach))
            rows = rows.withColumn(x, F.explode(F.array(low, high)) if reach else low)
        return rows.select(block, name, F.xxhash64("s", "v", "w").alias("__key"))

    def met(left: DataFrame, right: DataFrame, slots) -> DataFrame:
        return side(left, "left", slots, 1).join(side(right, "right", slots, 0).hint(SHUFFLED), [block, "__key"]).select("left", "right")

    unknown = F.size(F.filter("a", lambda x: x.isNull()))
    two, one = [(i, j) for i in range(SLOTS) for j in range(i + 1, SLOTS)], [(i, i) for i in range(SLOTS)]
    pairs = met(a, b, GROUPS)
    for few, slots in ((unknown >= 2, two), (unknown >= 3, one)):
        pairs = pairs.unionByName(met(a.where(few), b, slots)).unionByName(met(a.where(~few), b.where(few), slots))
    return pairs.distinct()


def name_pairs(a: DataFrame, b: DataFrame, block: str) -> DataFrame:
    """(left, right) of one ``block`` whose names are equal, or share the last word of the right one or two words of it. Rows: id,
    block, name, w (its words). Two words are a key of their own, so a first name that very many have brings no pairs about."""
    w = F.col("w")
    two = lambda x: F.flatten(F.transform(x, lambda p: F.transform(F.filter(x, lambda q: q > p), lambda q: F.concat_ws(" ", p, q))))
    tag = lambda t, x: F.transform(x, lambda v: F.concat(F.lit(t), v))
    plain = F.lower(F.trim("name"))
    left = F.concat(F.array(F.concat(F.lit("="), plain)), tag("1", F.array_distinct(w)), tag("2", two(F.array_distinct(w))))
    right = F.concat(F.array(F.concat(F.lit("="), plain)), tag("1", F.when(F.size(w) > 0, F.array(F.element_at(w, -1))).otherwise(F.array().cast("array<string>"))), tag("2", two(F.array_distinct(w))))
    side = lambda df, name, keys: df.select(block, F.col("id").alias(name), F.explode(keys).alias("__key"))
    return side(a, "left", left).join(side(b, "right", right).hint(SHUFFLED), [block, "__key"]).select("left", "right").distinct()


def _class() -> list[Column]:
    """total, best_snatch, the six attempts as columns, and a text of all that is equal for results that no rule but the names tells apart."""
    slots = [F.get("a", F.lit(k)).alias(f"a{k}") for k in range(SLOTS)]
    whole = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("-")) for c in (F.col("total"), F.col("best_snatch"), *[F.get("a", F.lit(k)) for k in range(SLOTS)])])
    return [F.col("total"), F.col("best_snatch"), *slots, whole.alias("class")]


def _slots(prefix: str = "") -> list[Column]:
    return [F.col(f"{prefix}a{k}") for k in range(SLOTS)]


_OF_CLASS = ["total", "best_snatch", *[f"a{k}" for k in range(SLOTS)]]


def _nearest(a: DataFrame, b: DataFrame) -> DataFrame:
    """ir, near (the least usaw of those at the least distance), more (others are as near), low, high (of all usaw), for each of ``a`` who
    has a partner of the same name, or one who shares a word and whose attempts agree.

    All of it is made of minima and maxima, so that it does not matter how many words bring a pair about, and a class needs to know only
    its first and last result and person. Distances come first, and then who is at the least one.
    """
    keys = lambda df: df.withColumn("__key", F.explode(F.concat(F.array(F.concat(F.lit("="), F.lower(F.trim("name")))), F.transform(F.array_distinct("w"), lambda x: F.concat(F.lit("1"), x))))).where("__key is not null")
    by = ["meet_id", "__key", "class"]
    asked = keys(a.withColumn("w", F.coalesce("w", F.array().cast("array<string>")))).select("ir", *by, *_OF_CLASS)
    left = materialise(asked.groupBy(*by).agg(*[F.first(c).alias(c) for c in _OF_CLASS]).withColumn("id", F.monotonically_increasing_id()), "classes")
    there = keys(b.withColumn("w", F.coalesce("w", F.array().cast("array<string>"))))
    right = there.groupBy(*by).agg(*[F.first(c).alias(f"o_{c}") for c in _OF_CLASS], *[f(c).alias(f"{n}_{c}") for c in ("ur", "usaw") for n, f in (("first", F.min), ("last", F.max))])
    right = materialise(right.drop("class"), "other_classes")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    delta = F.abs(F.when(zero("total") == 0, zero("best_snatch") - zero("o_best_snatch")).otherwise(zero("total") - zero("o_total")))
    physics = F.coalesce(overlap_of(_slots(), _slots("o_")), (zero("total") == 0) & (zero("o_total") == 0))
    n = shuffle_partitions(a.sparkSession)  # few bytes bring much work about: no partitions are put together
    met = lambda df: df.repartition(n, "meet_id", "__key").join(right.repartition(n, "meet_id", "__key").hint(SHUFFLED), ["meet_id", "__key"]).where(F.col("__key").startswith("=") | physics)
    best = materialise(met(left).groupBy("id").agg(F.min(delta).alias("best"), F.min("first_usaw").alias("low"), F.max("last_usaw").alias("high")), "best")
    at = met(left.join(best.select("id", "best").hint(SHUFFLED), "id")).where(delta == F.col("best"))
    at = at.groupBy("id").agg(F.min("first_ur").alias("first"), F.max("last_ur").alias("last"), F.min("first_usaw").alias("near"))
    of_class = left.select("id", *by).join(best.hint(SHUFFLED), "id").join(at.hint(SHUFFLED), "id").drop("id")
    rows = asked.select("ir", *by).join(of_class.hint(SHUFFLED), by).withColumn("least", F.min("best").over(Window.partitionBy("ir")))
    nearest = lambda f, c: f(F.when(F.col("best") == F.col("least"), F.col(c)))
    return rows.groupBy("ir").agg(nearest(F.min, "near").alias("near"), (nearest(F.min, "first") != nearest(F.max, "last")).alias("more"), F.min("low").alias("low"), F.max("high").alias("high"))


def _failed(a: DataFrame, b: DataFrame) -> DataFrame:
    """ir, failed: those of ``a`` who share with one of the meet the last word of the other, or two words of it (a repeated one is two)."""
    w = F.col("w")
    two = lambda x: F.flatten(F.transform(x, lambda p: F.transform(F.filter(x, lambda q: q > p), lambda q: F.concat_ws(" ", p, q))))
    tag = lambda t, x: F.transform(x, lambda v: F.concat(F.lit(t), v))
    once = F.array_distinct(w)
    strong = F.when(F.size(w) > 0, F.concat(F.array(F.element_at(w, -1)), F.filter(once, lambda x: F.size(F.filter(w, lambda y: y == x)) > 1)))
    left = a.select("ir", "meet_id", F.explode(F.concat(tag("1", once), tag("2", two(once)))).alias("__key"))
    right = b.select("meet_id", F.explode(F.concat(tag("1", strong), tag("2", two(once)))).alias("__key")).distinct()
    return left.join(right.hint(SHUFFLED), ["meet_id", "__key"], "left_semi").select("ir").distinct().withColumn("failed", F.lit(True))


def _alike(a: DataFrame, b: DataFrame) -> DataFrame:
    """ir, only: those of ``a`` with whose attempts those of one of the meet agree, by distinct attempts of a meet."""
    slots = [f"a{k}" for k in range(SLOTS)]
    # stored, so that Spark does not compare before it has made them distinct; dealt by number, as few bytes bring much work about
    n = shuffle_partitions(a.sparkSession)
    left = materialise(a.select("meet_id", *slots).distinct(), "attempts").withColumn("__part", F.pmod(F.xxhash64(*slots), F.lit(PARTS))).repartition(n, "meet_id", "__part")
    right = materialise(b.select("meet_id", *[F.col(c).alias(f"o_{c}") for c in slots]).distinct(), "other_attempts").withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))
    on = (F.col("meet_id") == F.col("o_meet")) & (F.col("__part") == F.col("o_part")) & overlap_of(_slots(), _slots("o_"))
    right = right.withColumnsRenamed({"meet_id": "o_meet", "__part": "o_part"}).repartition(n, "o_meet", "o_part")
    hit = left.join(right.hint(SHUFFLED), on, "left_semi").select("meet_id", *slots)
    same = reduce(lambda p, q: p & q, [F.col(f"h_{c}").eqNullSafe(F.col(c)) for c in ("meet_id", *slots)])
    return a.join(hit.withColumnsRenamed({c: f"h_{c}" for c in ("meet_id", *slots)}).hint(SHUFFLED), same, "left_semi").select("ir", F.lit(True).alias("only"))


def link(i: DataFrame, u: DataFrame, people: DataFrame, manual: DataFrame, banned: Callable[[Column, Column], Column]) -> DataFrame:
    """DQ-9: athletes of two federations: ``iwf, usaw, decision, confidence``.

    ``i``: ir (a result), iwf, name, meet_id, total, best_snatch, birth_year, home (of the other federation's country), a (six
    attempts); ``u``: ur, usaw, name, meet_id, total, best_snatch, a; ``people``: usaw, name, birth_year; ``manual``: iwf, usaw.
    Sizes of attempts, null where there was none. At each result, in this order:

    - the manual partner, if it is at the meet: linked;
    - partners of the same name, or who share a word and whose attempts agree: the one of the nearest total (of the best snatch,
      without a total), unless it is ``banned`` (unmatched), or another is as near (ambiguous, but if all are one person);
    - no such, but for an athlete of the home country with a total, others whose attempts agree without any word in common: ambiguous;
    - no such, but others who share the last word or two, and whose attempts differ: physics failed;
    - else unmatched.

    An athlete's best step over all results counts; one without a partner gets the only person born in the same year whose name
    words, two or more, are all in the athlete's, at a confidence of 90. No pairs are stored or shuffled: results of equal attempts and
    totals that share a word at a meet are one class, classes meet by the word, and only the nearest of each goes on (``_nearest``); what
    counts only for those without a partner is asked for by semi joins, which stop at the first hit (``_failed``, ``_alike``).
    """
    a = materialise(i.select("ir", "iwf", "name", "birth_year", "home", "meet_id", *_class(), tokens("name").alias("w")), "left")  # words are made once
    b = materialise(u.select("ur", "usaw", "name", "meet_id", *_class(), tokens("name").alias("w")), "right")
    found = materialise(_nearest(a, b), "nearest")
    lone = materialise(a.join(found.select("ir").hint(SHUFFLED), "ir", "left_anti"), "lone")
    found = found.unionByName(_failed(lone, b).join(_alike(lone.where("home and total > 0"), b).hint(SHUFFLED), "ir", "full"), allowMissingColumns=True)
    held = i.join(manual.withColumnRenamed("usaw", "by_hand").hint(SHUFFLED), "iwf").join(u.select("meet_id", F.col("usaw").alias("by_hand")).hint(SHUFFLED), ["meet_id", "by_hand"], "left_semi").groupBy("ir").agg(F.min("by_hand").alias("by_hand"))
    several = F.col("more") & (F.col("low") != F.col("high"))
    step = (
        F.when(F.col("by_hand").isNotNull(), 5).when(F.col("near").isNotNull() & several, 3).when(F.col("near").isNotNull(), F.when(banned(F.col("iwf"), F.col("near")), 1).otherwise(4))
        .when(F.col("only"), 3).when(F.col("failed"), 2).otherwise(1)
    )
    steps = i.select("ir", "iwf", "name", "birth_year").join(found.hint(SHUFFLED), "ir", "left").join(held.hint(SHUFFLED), "ir", "left")
    steps = materialise(steps.select("iwf", "name", "birth_year", step.alias("step"), F.coalesce("by_hand", "near").alias("usaw")), "steps")
    linked = steps.where("step >= 4").select("iwf", "usaw").distinct().select("iwf", "usaw", F.lit("linked").alias("decision"), F.lit(100).alias("confidence"))
    whole = steps.groupBy("iwf").agg(F.max("birth_year").alias("birth_year"), F.max("name").alias("name"), F.max("step").alias("step")).where("step < 4")
    named = contained(whole, people.withColumnRenamed("name", "other_name"), tokens).where(~banned(F.col("iwf"), F.col("usaw")))
    named = named.groupBy("iwf").agg(F.min("usaw").alias("usaw"), F.count("*").alias("n")).where("n = 1").select("iwf", "usaw", F.lit("linked").alias("decision"), F.lit(90).alias("confidence"))
    why = F.when(F.col("step") == 3, "ambiguous").when(F.col("step") == 2, "physics_failed").otherwise("unmatched")
    rest = whole.join(named.hint(SHUFFLED), "iwf", "left_anti").select("iwf", F.lit(None).cast(u.schema["usaw"].dataType).alias("usaw"), why.alias("decision"), F.lit(0).alias("confidence"))
    return linked.unionByName(named).unionByName(rest)
