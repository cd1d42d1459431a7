"""Attempts of a result: how many were made, bounce-backs, age at the competition. SURVEY FN-1..5, DQ-10."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from barpath.functions import parse
from barpath.functions.parse import col

#: Attempts of a result.
SLOTS = 6


def made(*lifts) -> Column:
    """FN-1: how many of the attempts are over 0."""
    return reduce(lambda a, b: a + b, (F.when(parse.strict_int(x) > 0, 1).otherwise(0) for x in lifts))


def bounce_back_national(previous, current) -> Column:
    """FN-2: made after a miss. Null if an attempt is null; false if one is no integer."""
    p, c = parse.strict_int(previous), parse.strict_int(current)
    junk = (col(previous).isNotNull() & p.isNull()) | (col(current).isNotNull() & c.isNull())
    return F.when(junk, False).otherwise((p <= 0) & (c > 0))


def is_made(lift) -> Column:
    return F.coalesce(F.nullif(col(lift), F.lit("---")).try_cast("double") > 0, F.lit(False))


def bounce_back_international(previous, current, null_prev_is_miss: bool = True) -> Column:
    """FN-3: whether the next attempt was made, if the one before was not and the next was tried; else null."""
    tried = col(current).isNotNull() & (col(current) != "---")
    missed = ~is_made(previous)
    if not null_prev_is_miss:
        missed = missed & col(previous).isNotNull() & (col(previous) != "---")
    return F.when(missed & tried, is_made(current))


def analytics(s1, s2, s3, c1, c2, c3) -> list[Column]:
    """FN-4: made attempts and bounce-backs of both lifts, and their totals."""
    b = lambda p, c, name: bounce_back_national(p, c).alias(name)
    return [
        made(s1, s2, s3).alias("snatch_made"), made(c1, c2, c3).alias("cj_made"), made(s1, s2, s3, c1, c2, c3).alias("total_made"),
        b(s1, s2, "bounce_snatch_2"), b(s2, s3, "bounce_snatch_3"), b(c1, c2, "bounce_cj_2"), b(c2, c3, "bounce_cj_3"),
    ]


def competition_age(date, birth_year, given_age=None) -> tuple[Column, Column]:
    """FN-5: (age, birth year), each from the other and the year of the date where one is missing."""
    year = F.year(F.try_to_date(col(date), "yyyy-MM-dd"))
    by = col(birth_year)
    given = F.lit(None).cast("int") if given_age is None else col(given_age)
    age = F.when(year.isNotNull() & by.isNotNull(), year - by).when(year.isNotNull() & given.isNotNull(), given)
    return age, F.coalesce(by, year - given)


def overlap(a: Column, b: Column) -> Column:
    """DQ-10: do two arrays of attempts belong to one lifter on one day? Of four shared slots or more, four within a kilo;
    of fewer, all; of none, null (the caller compares totals)."""
    return overlap_of([F.get(a, F.lit(k)) for k in range(SLOTS)], [F.get(b, F.lit(k)) for k in range(SLOTS)])


def overlap_of(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """The same of attempts as columns. No array is made for a pair, so very many pairs are cheap."""
    gaps = [F.abs(x - y) for x, y in zip(a, b, strict=True)]
    total = lambda flags: reduce(lambda p, q: p + q, (F.when(f, 1).otherwise(0) for f in flags))
    known, near = total(g.isNotNull() for g in gaps), total(g <= 1 for g in gaps)
    return F.when(known >= 4, near >= 4).when(known > 0, near == known)
