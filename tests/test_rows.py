"""Parsers, scores, attempts, divisions, text and places on the rows that are hard."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from barpath.functions import attempts, divisions, geo, parse, scoring, text


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


RAW = [None, "", "0", "---", "-105", "105", "102.5", " 105 ", "105kg", "abc", "1.2.3", "109+"]


@pytest.mark.parametrize(
    "f, expected",
    [
        (parse.strict_int, [None, None, 0, None, -105, 105, None, 105, None, None, None, None]),
        (parse.rounded_int, [None, None, 0, None, -105, 105, 103, 105, None, None, None, None]),
        (lambda c: parse.safe_decimal(c).cast("double"), [None, None, 0, None, None, 105, 102.5, 105, 105, None, None, 109]),
        (lambda c: parse.safe_decimal(c, keep_sign=False).cast("double"), [None, None, 0, None, 105, 105, 102.5, 105, 105, None, None, 109]),
        (parse.attempt, [None, None, None, None, -105, 105, 102, 105, 105, None, 1, 109]),
        (parse.attempt_value, [None, None, 0, None, -105, 105, 102.5, 105, 105, None, 1.2, 109]),
        (parse.attempt_magnitude, [None, None, None, None, 105, 105, 102, 105, 105, None, 1, 109]),
        (parse.checked_number, [None, None, 0, None, None, 105, 102.5, None, None, None, None, None]),
        (parse.lift_text, ["0", "0", "0", "--", "105", "105", "102.5", "105", "105kg", "abc", "1.2.3", "109+"]),
    ],
)
def test_parsers(spark, f, expected):
    assert column(spark, RAW, f) == expected


def test_bounce_backs(spark):
    pairs = [("-100", "100"), ("-100", "-100"), ("100", "-100"), (None, "100"), ("---", "100"), ("-100", "---"), ("102.5", "1")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, p string, c string")
    got = df.select("i", attempts.bounce_back_national("p", "c").alias("n"), attempts.bounce_back_international("p", "c").alias("k"), attempts.bounce_back_international("p", "c", False).alias("s")).orderBy("i").collect()
    assert [r.n for r in got] == [True, False, False, None, False, False, False]
    assert [r.k for r in got] == [True, False, None, True, True, None, None]
    assert [r.s for r in got] == [True, False, None, None, None, None, None]


def test_age_from_either_side(spark):
    df = spark.createDataFrame([("2020-05-01", 1990, None), ("2020-05-01", None, 30), ("junk", 1990, 30), (None, None, None)], "date string, birth_year int, given int")
    age, born = attempts.competition_age("date", "birth_year", "given")
    assert [tuple(r) for r in df.select(age, born).collect()] == [(30, 1990), (30, 1990), (None, 1990), (None, None)]


def test_points_and_factors(spark):
    df = spark.createDataFrame([(300, 85.0, "m"), (200, 60.0, "FEMALE"), (0, 85.0, "M"), (100, 0.0, "M"), (100, 70.0, "x"), (None, 70.0, "M")], "t int, b double, g string")
    got = [r[0] for r in df.select(scoring.points("t", "b", "g")).collect()]
    expected = lambda t, b, s, a, m, p: round(t * s / (a - m * (b / 100) ** -2 + p * (b / 100) ** 2), 2)
    assert got == [expected(300, 85, *scoring.CURVE["M"]), expected(200, 60, *scoring.CURVE["F"]), 0, 0, 0, 0]
    ages = spark.createDataFrame([(a, g) for a in (9, 29, 30, 31, 75, 76, 90, 91, 95, 110, 111, None) for g in ("M", "F", "U")], "a int, g string")
    rows = ages.select("a", "g", scoring.age_factor("a", "g").alias("f"), scoring.is_master("g", "a").alias("m")).collect()
    f = {(r.a, r.g): (r.f, r.m) for r in rows}
    assert f[29, "M"][0] == 1 and f[31, "M"] == (1.010, True) and f[91, "F"] == (3.935, True) and f[111, "F"] == (3.935, False) and f[95, "M"] == (4.863, False) and f[75, "M"][1] and not f[76, "M"][1] and f[90, "U"] == (1, False)


def test_normal_distribution(spark):
    got = column(spark, [0.0, 1.0, -1.0, 1.96], scoring.erf, "double")
    assert got == pytest.approx([math.erf(x) for x in (0, 1, -1, 1.96)], abs=2e-7)
    inverse = column(spark, [0.5, 0.975, 0.01, 1e-20, 1 - 1e-15], scoring.norm_inv, "double")
    assert inverse[:3] == pytest.approx([0, 1.959963985, -2.326347874], abs=1e-6) and -9.4 < inverse[3] < -9.2 and 7.9 < inverse[4] < 8
    assert column(spark, [0.0, 1.0, 1.5, None], scoring.norm_inv, "double") == [-math.inf, math.inf, None, None]
    df = spark.createDataFrame([(200.0, 200.0, 0.2, 1.0), (200.0, 200.0, 0.2, 0.0), (0.0, 200.0, 0.2, 1.0), (200.0, None, 0.2, 1.0)], "q double, mu double, s double, nu double")
    scores = [r[0] for r in df.select(scoring.distribution_score("q", "mu", "s", "nu")).collect()]
    assert scores[0] == pytest.approx(1000, abs=0.01) and scores[1] == pytest.approx(1000, abs=0.01) and scores[2:] == [None, None]


def test_divisions(spark):
    df = spark.createDataFrame([("F", 75, "59kg"), ("M", 75, None), ("M", 80, "89kg"), ("M", 11, "40kg"), ("F", 16, "59kg"), (None, 20, "x"), ("M", None, "x")], "g string, a int, w string")
    got = [r[0] for r in df.select(divisions.eligible_divisions("g", "a", "w")).collect()]
    assert got[0][-1] == "Women's Masters (75+) 59kg" and got[1][-1] == "Men's Masters (75-79) Unknown" and got[2][-1] == "Men's Masters (80+) 89kg"
    assert got[3] == ["Men's 11 Under Age Group 40kg", "Men's 13 Under Age Group 40kg"] and got[4] == ["Women's 16-17 Age Group 59kg", "Women's Youth 59kg", "Women's Junior 59kg", "Women's Open 59kg"] and got[5:] == [[], []]
    classes = spark.createDataFrame([("Open Men's", 60.0, "2025-06-01"), ("Open Men's", 111.0, "2025-06-01"), ("13 Under Men's", 74.0, "2020-01-01"), ("Open Women's", 91.0, "2000-01-01"), ("Open Men's", 80.0, "1990-01-01"), ("Open Men's", 0.0, "2025-06-01")], "c string, b double, d string")
    assert [r[0] for r in classes.select(divisions.weight_class("c", "b", F.col("d").cast("date"))).collect()] == ["60kg", "110+kg", "+73kg", "+90 Kg", None, None]
    assert column(spark, ["3.4.1990", "Name, 1985", "born 2001?", "none"], divisions.birth_year) == [1990, 1985, 2001, None]


def test_names_and_dates(spark):
    assert column(spark, ["SMITH Jane", "VAN DER BERG Jan Jr", "Jane Smith (USA)", "ALL CAPS", "O'Neil-Ray Pat III"], text.normal_name) == ["Jane SMITH", "Jan VAN DER BERG Jr", "Jane Smith", "ALL CAPS", "O'Neil-Ray Pat III"]
    dates = column(spark, ["May 20th 2023 - May 21st 2023", "January 8th 2022", "March 3rd 2022 10:00 AM (EST) - March 4th 2022", "junk", None], text.listing_dates)
    d = datetime.date
    assert [tuple(x) for x in dates] == [(d(2023, 5, 20), d(2023, 5, 21)), (d(2022, 1, 8), d(2022, 1, 8)), (d(2022, 3, 3), d(2022, 3, 4)), (None, None), (None, None)]
    spans = spark.createDataFrame([(d(2020, 1, 31), d(2020, 3, 1)), (d(2020, 2, 29), d(2021, 2, 28)), (d(2020, 1, 1), d(2020, 1, 1)), (d(2020, 1, 1), None)], "a date, b date")
    assert [r[0] for r in spans.select(text.friendly_duration("a", "b")).collect()] == ["1 month 1 day", "1 year", "0 days", "LIFE"]
    assert [str(x) for x in column(spark, ["1..2.2020", "2020-02-03", "RETIRED", "1.1.1980"], text.sanction_date)] == ["2020-02-01", "2020-02-03", "None", "None"]
    assert column(spark, ["12 Main St Suite 4, Town", "5 Elm Apt. B"], text.without_suite) == ["12 Main St, Town", "5 Elm"]


def test_places(spark):
    shape = '{"geometry":{"type":"Polygon","coordinates":[[[0,0],[10,0],[10,10],[0,10],[0,0]],[[4,4],[6,4],[6,6],[4,6],[4,4]]]}}'
    df = spark.createDataFrame([(x, y, shape) for x, y in ((5.0, 5.0), (2.0, 2.0), (11.0, 5.0), (-1.0, -1.0))], "x double, y double, g string").withColumn("s", geo.polygons("g"))
    got = [tuple(r) for r in df.select(geo.in_shape("x", "y", "s"), geo.in_shape("x", "y", "s", holes=True)).collect()]
    assert got == [(True, False), (True, True), (False, False), (False, False)]
    many = '{"geometry":{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,1]]],[[[5,5],[7,5],[7,7],[5,7]]]]}}'
    row = spark.createDataFrame([(6.0, 6.0, many)], "x double, y double, g string").withColumn("s", geo.polygons("g"))
    assert row.select(geo.in_shape("x", "y", "s"), geo.bbox("s")["max_x"]).first()[:] == (True, 7.0)
    km = spark.createDataFrame([(40.0, -75.0, 41.0, -75.0), (0.0, 1.0, 2.0, 3.0)], "a double, b double, c double, d double")
    assert [r[0] for r in km.select(geo.haversine_km("a", "b", "c", "d")).collect()] == [111.2, None]


def test_whole_years_at_the_end_of_february(spark):
    d = datetime.date
    rows = [(d(2000, 2, 29), d(2005, 2, 28)), (d(2000, 2, 29), d(2004, 2, 29)), (d(2001, 2, 28), d(2004, 2, 29)), (d(2000, 5, 31), d(2001, 5, 30)), (d(2000, 5, 1), d(2000, 5, 1)), (None, d(2000, 5, 1))]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a date, b date")
    assert [r.y for r in df.orderBy("i").select(text.whole_years("a", "b").alias("y")).collect()] == [4, 4, 3, 0, 0, None]
