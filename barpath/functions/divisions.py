"""Divisions, weight classes and demographic groups. SURVEY FN-20..28."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barpath.functions.parse import col

# Upper limits of weight classes by era (first day), age group and sex.
ERAS = (("2025-06-01", "current"), ("2018-11-01", "2018"), ("1998-01-01", "1998"))
LIMITS = {
    "current": {
        "13U": {"M": (32, 36, 40, 44, 48, 52, 56, 60, 65), "F": (30, 33, 36, 40, 44, 48, 53, 58, 63)},
        "14-15": {"M": (48, 52, 56, 60, 65, 71, 79), "F": (40, 44, 48, 53, 58, 63, 69)},
        "16-17": {"M": (56, 60, 65, 71, 79, 88, 94), "F": (44, 48, 53, 58, 63, 69, 77)},
        "open": {"M": (60, 65, 71, 79, 88, 94, 110), "F": (48, 53, 58, 63, 69, 77, 86)},
    },
    "2018": {
        "13U": {"M": (32, 36, 39, 44, 49, 55, 61, 67, 73), "F": (30, 33, 36, 40, 45, 55, 59, 64)},
        "14-15": {"M": (39, 44, 49, 55, 61, 67, 73, 81, 89), "F": (36, 40, 45, 49, 55, 59, 64, 71, 76)},
        "16-17": {"M": (49, 55, 61, 67, 73, 81, 89, 96, 102), "F": (40, 45, 49, 55, 59, 64, 71, 76, 81)},
        "open": {"M": (55, 61, 67, 73, 81, 89, 96, 102, 109), "F": (45, 49, 55, 59, 64, 71, 76, 81, 87)},
    },
    "1998": {
        "13U": {"M": (31, 35, 39, 44, 50, 56, 62, 69), "F": (31, 35, 39, 44, 48, 53, 58)},
        "14-15": {"M": (44, 50, 56, 62, 69, 77, 85), "F": (44, 48, 53, 58, 63, 69)},
        "16-17": {"M": (50, 56, 62, 69, 77, 85, 94, 105), "F": (44, 48, 53, 58, 63, 69)},
        "open": {"M": (56, 62, 69, 77, 85, 94, 105), "F": (48, 53, 58, 63, 69, 75, 90)},
    },
}
OVER = {"current": ("", "+kg"), "2018": ("+", "kg"), "1998": ("+", " Kg")}


def female(gender) -> Column:
    g = F.lower(col(gender))
    return g.startswith("f") | g.contains("women")


def eligible_divisions(gender, age, weight_class) -> Column:
    """FN-20: an array of division names, in order; empty without an age or gender."""
    a, f = col(age), female(gender)
    five = F.floor(a / 5) * 5
    masters = (
        F.when(f & (a >= 75), "Masters (75+)").when(~f & (a >= 80), "Masters (80+)").when(~f & (a >= 75), "Masters (75-79)")
        .otherwise(F.concat(F.lit("Masters ("), five.cast("string"), F.lit("-"), (five + 4).cast("string"), F.lit(")")))
    )
    groups = [
        (a <= 11, F.lit("11 Under Age Group")), (a <= 13, F.lit("13 Under Age Group")), (a.between(14, 15), F.lit("14-15 Age Group")), (a.between(16, 17), F.lit("16-17 Age Group")),
        (a.between(13, 17), F.lit("Youth")), (a.between(15, 20), F.lit("Junior")), (a >= 15, F.lit("Open")), (a >= 35, masters),
    ]
    names = F.array_compact(F.array(*[F.when(when, name) for when, name in groups]))
    whole = F.transform(names, lambda n: F.concat_ws(" ", F.when(f, "Women's").otherwise("Men's"), n, F.coalesce(F.nullif(col(weight_class), F.lit("")), F.lit("Unknown"))))
    return F.when(a.isNull() | col(gender).isNull(), F.array().cast("array<string>")).otherwise(whole)


def age_group(category) -> Column:
    """The group of a free-text age category. A bare 'youth' is the oldest of the youth groups."""
    c = F.lower(F.coalesce(col(category), F.lit("")))
    return (
        F.when(c.contains("11 under") | c.contains("13 under"), "13U").when(c.contains("14-15"), "14-15").when(c.contains("16-17"), "16-17")
        .when(c.contains("youth"), "16-17").otherwise("open")
    )


def weight_class(category, body_weight, date) -> Column:
    """FN-21: the weight class of a body weight under the limits of its era; null before the first era or without a weight."""
    c, b = F.lower(F.coalesce(col(category), F.lit(""))), col(body_weight).cast("double")
    women = c.contains("women") | (c.contains("female") & ~c.contains("male"))
    group, out = age_group(category), F.lit(None).cast("string")
    for first, era in reversed(ERAS):
        before, after = OVER[era]
        here = F.lit(None).cast("string")
        for name, by_sex in LIMITS[era].items():
            for s, limits in by_sex.items():
                fits = F.array_min(F.filter(F.array(*map(F.lit, limits)), lambda x: b <= x))
                label = F.coalesce(F.concat(fits.cast("string"), F.lit("kg")), F.lit(f"{before}{limits[-1]}{after}"))
                here = F.when((group == name) & (women == (s == "F")), label).otherwise(here)
        out = F.when(col(date) >= F.lit(first).cast("date"), here).otherwise(out)
    return F.when(b > 0, out)


def alternatives(position: Column, ladder: Column) -> Column:
    """FN-22: the entry of a ladder at a position (from 1), then its neighbours up to two steps away, nearest first, then the
    open division; without repeats and what is beyond the ladder."""
    steps = F.array(*map(F.lit, (0, -1, 1, -2, 2)))
    near = F.transform(steps, lambda s: F.when((position + s).between(1, F.size(ladder)), F.element_at(ladder, position + s)))
    return F.array_distinct(F.concat(F.array_compact(near), F.array(F.lit("Open"))))


def buckets(source, gender, age) -> Column:
    """FN-23: demographic groups; only the whole for an unknown age, none for an unknown gender."""
    a = col(age)
    g = F.when(F.lower(col(gender)).startswith("f"), "F").otherwise("M")
    name = lambda end: F.concat_ws("_", col(source), g, F.lit(end))
    rules = [("U13", a < 13), ("Youth", a.between(13, 17)), ("Junior", a.between(15, 20)), ("Senior", a >= 15), ("Masters", a >= 35)]
    return F.when(col(gender).isNull(), F.array().cast("array<string>")).otherwise(F.array_compact(F.array(name("all"), *[F.when(w, name(n)) for n, w in rules])))


def gender_from_class(text) -> Column:
    """FN-24: 'women' holds 'men', so it is tried first."""
    t = F.lower(col(text))
    return F.when(t.contains("women"), "F").when(t.contains("men"), "M")


def birth_year(text) -> Column:
    """FN-25: d.m.yyyy, '..., yyyy' or any 19xx or 20xx."""
    parts = [F.regexp_extract(col(text), p, 1).try_cast("int") for p in (r"\d{1,2}\.\d{1,2}\.(\d{4})", r",\s*(\d{4})\s*$", r"\b((?:19|20)\d{2})\b")]
    return F.coalesce(*parts)


def age_and_weight(text) -> Column:
    """FN-26: a struct of age category and weight class."""
    weight = F.regexp_extract(col(text), r"(?i)(\+?\d+\+?\s?kg)$", 1)
    return F.struct(F.trim(F.regexp_replace(col(text), r"(?i)\+?\d+\+?\s?kg$", "")).alias("age_category"), F.nullif(weight, F.lit("")).alias("weight_class"))


def entry_status(entered, actual) -> Column:
    """FN-27."""
    return F.when(col(actual) > col(entered), "Exceeded").when(col(actual) == col(entered), "Met").otherwise("Below")


def medal_level(level) -> Column:
    """FN-28."""
    return F.when(col(level) == "International", "international").when(col(level).isin("National", "North American Open Series"), "national").otherwise("local")
