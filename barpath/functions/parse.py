"""Parsers for numbers kept as text. Each names the rule it follows; none ever raises. SURVEY §1.3."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str, *sentinels: str) -> Column:
    c = col(c)
    return F.when(c.isin("", *sentinels), None).otherwise(c)


def strict_int(c):
    """P1: an integer or null; decimals, sentinels and junk are null."""
    return col(c).try_cast("int")


def rounded_int(c):
    """P2: a decimal rounded half away from zero; '---' and junk are null."""
    return F.round(F.nullif(col(c), F.lit("---")).try_cast("decimal(10,3)")).cast("int")


def safe_decimal(c, keep_sign: bool = True):
    """P3: digits and dots only ('109+' is 109, several dots are null). The original loses the sign, so a failed lift counts
    as made; with ``keep_sign`` a leading minus gives null instead."""
    text = F.regexp_replace(col(c), "[^0-9.]", "")
    value = blank_to_null(text, ".").try_cast("decimal(12,4)")
    return F.when(F.trim(col(c)).startswith("-") & value.isNotNull(), None).otherwise(value) if keep_sign else value


def attempt(c):
    """P4: null, '', '0' and '---' are no attempt; else the integer a text begins with."""
    return F.when(~F.coalesce(col(c), F.lit("")).isin("", "0", "---"), F.regexp_extract(col(c), r"^\s*([+-]?[0-9]+)", 1).try_cast("int"))


def attempt_value(c):
    """P5: as P4, but '0' is a miss, and decimals count."""
    return F.when(~F.coalesce(col(c), F.lit("")).isin("", "---"), F.regexp_extract(col(c), r"^\s*([+-]?[0-9]+\.?[0-9]*)", 1).try_cast("double"))


def attempt_magnitude(c):
    """P6: the size of an attempt whether made or not; none for 0."""
    return F.nullif(F.abs(attempt(c)), F.lit(0))


def lift_or_zero(c):
    """P7: a lift, or 0."""
    return F.coalesce(F.nullif(col(c), F.lit("---")).try_cast("double"), F.lit(0.0))


def checked_number(c):
    """P8: cast only what looks like a plain number."""
    return F.when(col(c).rlike(r"^[0-9]+\.?[0-9]*$"), col(c).try_cast("double"))


def lift_text(c):
    """P9: for comparing lifts as text: one leading minus dropped, empty is '0'."""
    text = F.regexp_replace(F.trim(F.coalesce(col(c), F.lit(""))), "^-", "")
    return F.when(text == "", "0").otherwise(text)
