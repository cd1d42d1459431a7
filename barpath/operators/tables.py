"""Keyed table operations: upserts, change feeds, dedupe, fill-ins. SURVEY SNK-*, DML-*, SET-*, WIN-1, DQ-3, 12."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """SET-4: the first row of each key in an order, which should end in a unique column."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def labelled(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], out: str = "action") -> DataFrame:
    """WIN-1: KEEP for the first row of each key, DELETE for the others."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(out, F.when(n == 1, "KEEP").otherwise("DELETE"))


def upsert(target: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = ()) -> DataFrame:
    """SNK-1, 2: rows of ``new`` replace those of their key; of several new ones the first in ``order``."""
    both = target.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    return first_by(both, keys, [F.desc("__new"), *order]).drop("__new")


def insert_ignore(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SNK-3, 4: the rows of ``new`` whose key the target does not have, one for each key."""
    return new.join(target.select(*keys), list(keys), "left_anti").dropDuplicates(list(keys))


def changes(old: DataFrame, new: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """SNK-7: keys with ``status`` new, updated, unchanged or gone, failed for rows of no key; nulls are equal to nulls."""
    a = old.select(*keys, F.lit(True).alias("__old"), F.struct(*fields).alias("__a"))
    b = new.select(*keys, F.lit(True).alias("__new"), F.struct(*fields).alias("__b"))
    same = reduce(lambda x, y: x & y, (F.col("__a")[f].eqNullSafe(F.col("__b")[f]) for f in fields))
    none = reduce(lambda x, y: x & y, (F.col(k).isNull() for k in keys))
    status = F.when(none, "failed").when(F.col("__old").isNull(), "new").when(F.col("__new").isNull(), "gone").when(same, "unchanged").otherwise("updated")
    return a.join(b, list(keys), "full_outer").select(*keys, status.alias("status"))


def replace_by_key(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SNK-6: all rows of the keys in ``new`` are replaced."""
    return target.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new)


def audit(old: DataFrame, new: DataFrame, key: str, field: str) -> DataFrame:
    """SNK-10: before and after, where they differ."""
    joined = old.select(key, F.col(field).alias("before")).join(new.select(key, F.col(field).alias("after")), key)
    return joined.where(~F.col("before").eqNullSafe(F.col("after")))


def fill_in(target: DataFrame, new: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """DML-4: fields take the new value where there is one. ``new`` has one row for each key."""
    renamed = new.select(key, *[F.col(f).alias(f"__{f}") for f in fields])
    return target.join(renamed, key, "left").withColumns({f: F.coalesce(f"__{f}", f) for f in fields}).drop(*[f"__{f}" for f in fields])


def harmonised(sources: Sequence[DataFrame], columns: dict[str, tuple[str, Sequence[str]]]) -> DataFrame:
    """AGG-40: tables of one kind with other columns under one schema. ``columns``: by name the type and the names it may have in a
    source; the first that a source has is taken, and null if it has none."""

    def one(df: DataFrame) -> DataFrame:
        there = {c.lower(): c for c in df.columns}
        pick = lambda names: next((F.col(f"`{there[n.lower()]}`") for n in names if n.lower() in there), F.lit(None))
        return df.select(*[pick(names).cast(kind).alias(name) for name, (kind, names) in columns.items()])

    return reduce(DataFrame.unionByName, (one(df) for df in sources))


def checks(df: DataFrame, conditions: dict[str, str]) -> DataFrame:
    """AGG-40: ``issue, n, status``: how many rows meet each condition (SQL), and PASS if none does. One pass."""
    counts = df.agg(*[F.count_if(F.expr(c)).alias(name) for name, c in conditions.items()])
    long = counts.unpivot([], list(conditions), "issue", "n")
    return long.withColumn("status", F.when(F.col("n") == 0, "PASS").otherwise("FAIL"))


def fingerprint(columns: Sequence[str | Column]) -> Column:
    """AGG-35: md5 of the columns as text, nulls marked."""
    return F.md5(F.concat_ws("|", *[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("NULL")) for c in columns]).cast("binary"))


def missing(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """SET-3, 5: rows of ``a`` that ``b`` does not have, nulls equal, repeats kept."""
    condition = reduce(lambda x, y: x & y, (F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in on))
    return a.alias("l").join(b.select(*on).distinct().alias("r"), condition, "left_anti")
