"""Names, dates, addresses and links in free text, as Column expressions. SURVEY STR-*, DAT-*."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barpath.functions.parse import col

SUFFIX = r"(?i)\s+(jr|sr|ii|iii|iv|v)\.?$"


def normal_name(name) -> Column:
    """STR-1: 'SMITH Jane Jr (USA)' becomes 'Jane SMITH Jr': the country goes, leading words in capitals move behind, the
    suffix stays last."""
    plain = F.trim(F.regexp_replace(F.trim(col(name)), r"\s*\([A-Z]{3}\)$", ""))
    suffix = F.regexp_extract(plain, SUFFIX, 0)
    words = F.split(F.trim(F.regexp_replace(plain, SUFFIX, "")), r"\s+")
    capital = lambda w: (w == F.upper(w)) & (F.length(w) > 1)
    first = F.aggregate(words, F.struct(F.lit(0).alias("n"), F.lit(True).alias("go")), lambda s, w: F.struct((s["n"] + F.when(s["go"] & capital(w), 1).otherwise(0)).alias("n"), (s["go"] & capital(w)).alias("go")))["n"]
    moved = F.when((first > 0) & (first < F.size(words)), F.concat(F.slice(words, first + 1, F.size(words)), F.slice(words, F.lit(1), first))).otherwise(words)
    return F.concat(F.array_join(moved, " "), F.when(suffix != "", F.concat(F.lit(" "), F.trim(suffix))).otherwise(""))


def match_key(name) -> Column:
    """STR-2."""
    return F.upper(F.trim(col(name)))


def tokens(text, digits: bool = True) -> Column:
    """STR-3: lower-case words of three characters or more, hyphens split."""
    kept = "[^a-z0-9 ]" if digits else "[^a-z ]"
    plain = F.regexp_replace(F.regexp_replace(F.lower(col(text)), r"[-\s]+", " "), kept, "")
    return F.filter(F.split(plain, " "), lambda w: F.length(w) > 2)


def trigrams(text) -> Column:
    """The set of trigrams of the words of a text, each word padded by two spaces before and one after."""
    words = F.filter(F.split(F.lower(col(text)), "[^a-z0-9]+"), lambda w: w != "")
    each = F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))))
    return F.array_distinct(F.flatten(each))


def similarity(a, b) -> Column:
    """STR-4: shared trigrams over all."""
    x, y = trigrams(a), trigrams(b)
    return F.size(F.array_intersect(x, y)) / F.nullif(F.size(F.array_union(x, y)), F.lit(0))


def name_and_pronouns(text) -> Column:
    """STR-5: a struct; no pronouns without parentheses at the end."""
    p = r"^(.+?)\s*\((.+)\)$"
    has = col(text).rlike(p)
    return F.struct(F.when(has, F.regexp_extract(col(text), p, 1)).otherwise(col(text)).alias("name"), F.when(has, F.regexp_extract(col(text), p, 2)).alias("pronouns"))


def sanction_name(text) -> Column:
    """STR-6: titles, gender marks, notes in parentheses and dates go."""
    t = F.regexp_replace(col(text), r"\([^)]*\)", " ")
    t = F.regexp_replace(t, r"\d{1,2}[./]\d{1,2}[./]\d{2,4}", " ")
    t = F.regexp_replace(t, r"(?i)\b(mr|mrs|ms|dr)\b\.?|\b[MF]\b", " ")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def result_id(url) -> Column:
    """STR-7."""
    return F.regexp_extract(col(url), r"/rankings/results/(\d+)", 1).try_cast("long")


def query_value(url, name: str) -> Column:
    return F.nullif(F.regexp_extract(col(url), rf"[?&]{name}=([^&#]*)", 1), F.lit(""))


def map_coordinates(url) -> Column:
    """STR-8: a struct of lat and lng from '@lat,lng' or '!3dlat' and '!2dlng'."""
    number = r"(-?\d+\.\d+)"
    pick = lambda a, b, group: F.coalesce(F.regexp_extract(col(url), a, group).try_cast("double"), F.regexp_extract(col(url), b, 1).try_cast("double"))
    return F.struct(pick(rf"@{number},{number}", rf"!3d{number}", 1).alias("lat"), pick(rf"@{number},{number}", rf"!2d{number}", 2).alias("lng"))


def pager(text) -> Column:
    """STR-9: '1-20 of 300' as a struct of first, last, total."""
    p = r"(\d+)-(\d+) of (\d+)"
    return F.struct(*[F.regexp_extract(col(text), p, i).try_cast("int").alias(n) for i, n in ((1, "first"), (2, "last"), (3, "total"))])


def without_suite(address) -> Column:
    """STR-10."""
    return F.trim(F.regexp_replace(F.regexp_replace(col(address), r"(?i),?\s*(suite|ste|unit|apt|apartment|bldg|#)\.?\s*[a-z0-9-]+", ""), r"\s+", " "))


def shard(key) -> Column:
    """STR-12: the last two characters, padded."""
    return F.lpad(F.right(col(key).cast("string"), F.lit(2)), 2, "0")


def listing_dates(text) -> Column:
    """DAT-1: first and last day of 'May 20th 2023 - May 21st 2023'; nulls if a part is no date."""
    clean = F.regexp_replace(F.regexp_replace(col(text), r"(?i)\s*\d{1,2}:\d{2}\s*(am|pm)?", ""), r"\s*\([A-Z]{2,4}\)", "")
    clean = F.regexp_replace(clean, r"(?i)(\d+)(st|nd|rd|th)\b", "$1")
    parts = F.split(clean, r"\s+-\s+")
    day = lambda s: F.coalesce(F.try_to_date(F.trim(s), "MMMM d yyyy"), F.try_to_date(F.trim(s), "MMMM d, yyyy"), F.try_to_date(F.trim(s), "yyyy-MM-dd"))
    first, last = day(F.get(parts, F.lit(0))), day(F.get(parts, F.size(parts) - 1))
    both = first.isNotNull() & last.isNotNull()
    return F.struct(F.when(both, first).alias("start_date"), F.when(both, last).alias("end_date"))


def year_of(text, as_of) -> Column:
    """DAT-2: the year of a text date by the first format that fits, else of ``as_of``."""
    t = col(text)
    return F.coalesce(F.year(F.try_to_date(t, "yyyy-MM-dd")), F.year(F.try_to_date(t, "MM/dd/yyyy")), F.regexp_extract(t, r"\b((?:19|20)\d{2})\b", 1).try_cast("int"), F.year(col(as_of)))


def friendly_duration(start, end) -> Column:
    """DAT-3: '1 year 2 months 3 days'; 'LIFE' without an end, '0 days' for none; days are borrowed from the earlier month."""
    months = F.floor(F.months_between(col(end), col(start))).cast("int")
    years, rest = F.floor(months / 12).cast("int"), months % 12
    days = F.datediff(col(end), F.add_months(col(start), months))
    part = lambda n, word: F.when(n > 0, F.concat(n.cast("string"), F.lit(f" {word}"), F.when(n == 1, "").otherwise("s")))
    text = F.concat_ws(" ", part(years, "year"), part(rest, "month"), part(days, "day"))
    return F.when(col(start).isNull(), None).when(col(end).isNull(), "LIFE").when(text == "", "0 days").otherwise(text)


def sanction_date(text) -> Column:
    """DAT-4: d.m.yyyy (a doubled dot too) or yyyy-MM-dd between 1990 and 2040; other texts are null."""
    t = F.regexp_replace(F.trim(col(text)), r"\.+", ".")
    d = F.coalesce(F.try_to_date(t, "d.M.yyyy"), F.try_to_date(t, "yyyy-MM-dd"))
    return F.when(F.year(d).between(1990, 2040), d)


def day_gap(a, b) -> Column:
    """DAT-8: days between two text dates, 9999 if one is none."""
    return F.coalesce(F.abs(F.datediff(F.try_to_date(col(a), "yyyy-MM-dd"), F.try_to_date(col(b), "yyyy-MM-dd"))), F.lit(9999))


def whole_years(start, end) -> Column:
    """AGG-3: years from one day to another, less one before the month and day come round: 29 February does on 1 March."""
    early = F.date_format(col(end), "MMdd") < F.date_format(col(start), "MMdd")
    return F.year(col(end)).cast("long") - F.year(col(start)) - F.when(early, 1).otherwise(0)


def date_format_class(text) -> Column:
    """AGG-41."""
    rules = [(r"^\d{4}-\d{2}-\d{2}$", "iso"), (r"^\d{1,2}/\d{1,2}/\d{4}$", "us"), (r"^[A-Za-z]+ \d{1,2}(st|nd|rd|th)? \d{4}$", "long"), (r" - ", "range")]
    out = F.lit("other")
    for pattern, name in reversed(rules):
        out = F.when(col(text).rlike(pattern), name).otherwise(out)
    return out
