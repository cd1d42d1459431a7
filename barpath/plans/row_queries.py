"""Queries that work on each row: parsers, scores, attempts, divisions, text and dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from barpath.functions import attempts, divisions, parse, regions, scoring, text
from barpath.operators import names
from barpath.plans.binding import WITH
from barpath.plans.registry import ORACLE_SQL, query

_P1 = "TRY_CAST(CASE WHEN regexp_matches(trim({0}), '^[+-]?[0-9]+$') THEN trim({0}) END AS INT)"
_NUM = "TRY_CAST(NULLIF({0}, '---') AS DOUBLE)"
_MADE = f"CASE WHEN {_P1} > 0 THEN 1 ELSE 0 END"


def _case(pairs, otherwise="NULL"):
    return "CASE " + " ".join(f"WHEN {a} THEN {b}" for a, b in pairs) + f" ELSE {otherwise} END"


_RAW = ", raw AS (SELECT result_id, CASE result_id % 11 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '0' WHEN 3 THEN '---' WHEN 4 THEN '-105' WHEN 5 THEN '105' WHEN 6 THEN '102.5' WHEN 7 THEN ' 105 ' WHEN 8 THEN '105kg' WHEN 9 THEN '109+' ELSE '1.2.3' END AS t FROM results) "


def _raw(v):
    texts = [None, "", "0", "---", "-105", "105", "102.5", " 105 ", "105kg", "109+", "1.2.3"]
    return v.results.select("result_id", F.get(F.array(*[F.lit(t).cast("string") for t in texts]), (F.col("result_id") % 11).cast("int")).alias("t"))


@query("p_parsers", _RAW + """SELECT result_id, """ + _P1.format("t") + """ AS p1,
    CAST(CASE WHEN TRY_CAST(NULLIF(t, '---') AS DECIMAL(10,3)) IS NOT NULL THEN floor(abs(TRY_CAST(trim(t) AS DOUBLE)) + 0.5) * sign(TRY_CAST(trim(t) AS DOUBLE)) END AS INT) AS p2,
    CAST(TRY_CAST(NULLIF(NULLIF(regexp_replace(t, '[^0-9.]', '', 'g'), ''), '.') AS DECIMAL(12,4)) AS DOUBLE) AS p3,
    CASE WHEN t NOT IN ('', '0', '---') THEN TRY_CAST(NULLIF(regexp_extract(t, '^\\s*([+-]?[0-9]+)', 1), '') AS INT) END AS p4,
    CASE WHEN t NOT IN ('', '---') THEN TRY_CAST(NULLIF(regexp_extract(t, '^\\s*([+-]?[0-9]+\\.?[0-9]*)', 1), '') AS DOUBLE) END AS p5,
    CASE WHEN regexp_matches(t, '^[0-9]+\\.?[0-9]*$') THEN TRY_CAST(t AS DOUBLE) END AS p8,
    CASE WHEN regexp_replace(trim(coalesce(t, '')), '^-', '') = '' THEN '0' ELSE regexp_replace(trim(coalesce(t, '')), '^-', '') END AS p9 FROM raw""")  # fmt: skip
def p_parsers(v):
    return _raw(v).select(
        "result_id", parse.strict_int("t").alias("p1"), parse.rounded_int("t").alias("p2"), parse.safe_decimal("t", keep_sign=False).cast("double").alias("p3"),
        parse.attempt("t").alias("p4"), parse.attempt_value("t").alias("p5"), parse.checked_number("t").alias("p8"), parse.lift_text("t").alias("p9"),
    )


@query("fn_1_made", "SELECT result_id, " + " + ".join(_MADE.format(k) for k in ("s1", "s2", "s3")) + " AS snatch_made, " + " + ".join(_MADE.format(k) for k in ("c1", "c2", "c3")) + " AS cj_made FROM results")
def fn_1(v):
    return v.results.select("result_id", attempts.made("s1", "s2", "s3").alias("snatch_made"), attempts.made("c1", "c2", "c3").alias("cj_made"))


def _bounce(p, c):
    a, b = _P1.format(p), _P1.format(c)
    return f"CASE WHEN ({p} IS NOT NULL AND {a} IS NULL) OR ({c} IS NOT NULL AND {b} IS NULL) THEN FALSE ELSE {a} <= 0 AND {b} > 0 END"


@query("fn_2_bounce_back_national", f"SELECT result_id, {_bounce('s1', 's2')} AS s2, {_bounce('s2', 's3')} AS s3, {_bounce('c1', 'c2')} AS c2 FROM results")
def fn_2(v):
    b = attempts.bounce_back_national
    return v.results.select("result_id", b("s1", "s2").alias("s2"), b("s2", "s3").alias("s3"), b("c1", "c2").alias("c2"))


_OK = f"COALESCE({_NUM} > 0, FALSE)"


def _bounce_i(p, c, strict=False):
    tried = f" AND {p} IS NOT NULL AND {p} <> '---'" if strict else ""
    return f"CASE WHEN NOT {_OK.format(p)}{tried} AND {c} IS NOT NULL AND {c} <> '---' THEN {_OK.format(c)} END"


@query("fn_3_bounce_back_international", f"SELECT result_id, {_bounce_i('s1', 's2')} AS s2, {_bounce_i('c2', 'c3')} AS c3, {_bounce_i('s1', 's2', True)} AS s2_strict FROM results")
def fn_3(v):
    b = attempts.bounce_back_international
    return v.results.select("result_id", b("s1", "s2").alias("s2"), b("c2", "c3").alias("c3"), b("s1", "s2", null_prev_is_miss=False).alias("s2_strict"))


_ALL = ("s1", "s2", "s3", "c1", "c2", "c3")


@query("fn_4_analytics", "SELECT result_id, " + ", ".join(f"{' + '.join(_MADE.format(k) for k in ks)} AS {n}" for n, ks in (("snatch_made", _ALL[:3]), ("cj_made", _ALL[3:]), ("total_made", _ALL)))
       + "".join(f", {_bounce(p, c)} AS {n}" for n, p, c in (("bounce_snatch_2", "s1", "s2"), ("bounce_snatch_3", "s2", "s3"), ("bounce_cj_2", "c1", "c2"), ("bounce_cj_3", "c2", "c3"))) + " FROM results")
def fn_4(v):
    return v.results.select("result_id", *attempts.analytics(*_ALL))


@query("fn_5_age", "SELECT result_id, CASE WHEN birth_year IS NOT NULL THEN CAST(SUBSTRING(date, 1, 4) AS INT) - birth_year ELSE CASE WHEN result_id % 2 = 0 THEN 30 END END AS age, COALESCE(birth_year, CAST(SUBSTRING(date, 1, 4) AS INT) - CASE WHEN result_id % 2 = 0 THEN 30 END) AS birth_year FROM results")
def fn_5(v):
    given = v.results.withColumn("given", F.when(F.col("result_id") % 2 == 0, 30))
    age, born = attempts.competition_age("date", "birth_year", "given")
    return given.select("result_id", age.alias("age"), born.alias("birth_year"))


def _curve(digits):
    one = lambda s, a, m, p: f"ROUND(CAST(total AS DOUBLE) * {s}::DOUBLE / ({a}::DOUBLE - {m}::DOUBLE * POWER(body_weight_kg / 100, -2) + {p}::DOUBLE * POWER(body_weight_kg / 100, 2)), {digits})"
    return f"CASE WHEN NOT (total > 0 AND body_weight_kg > 0) THEN 0.0::DOUBLE WHEN gender = 'M' THEN {one(*scoring.CURVE['M'])} ELSE {one(*scoring.CURVE['F'])} END"


@query("fn_6_qpoints", f"SELECT result_id, {_curve(2)} AS qpoints FROM results")
def fn_6(v):
    return v.results.select("result_id", scoring.points("total", "body_weight_kg", "gender").alias("qpoints"))


_FACTOR = "CASE WHEN age IS NULL THEN 1.0::DOUBLE WHEN age < 30 THEN 1.0::DOUBLE WHEN gender = 'F' THEN ([" + ",".join(map(str, scoring.WOMEN_FROM_30)) + "]::DOUBLE[])[LEAST(age - 29, 62)] ELSE ([" + ",".join(map(str, scoring.MEN_FROM_30)) + "]::DOUBLE[])[LEAST(age - 29, 66)] END"
_MASTER = "COALESCE((gender = 'M' AND age BETWEEN 31 AND 75) OR (gender = 'F' AND age BETWEEN 31 AND 110), FALSE)"


@query("fn_7_national_points", f", q AS (SELECT result_id, age, gender, total, {_curve(2)} AS q, {_FACTOR} AS f, {_MASTER} AS m FROM results) SELECT result_id, CASE WHEN total > 0 AND age BETWEEN 21 AND 30 THEN q END AS qpoints, CASE WHEN total > 0 AND age BETWEEN 10 AND 20 THEN ROUND(CAST(total AS DOUBLE), 2) END AS q_youth, CASE WHEN total > 0 AND m THEN CAST(ROUND(CAST(q AS DECIMAL(14,3)) * CAST(f AS DECIMAL(8,4)), 2) AS DOUBLE) END AS q_masters FROM q")
def fn_7(v):
    return v.results.select("result_id", *scoring.national_points("total", "body_weight_kg", "gender", "age"))


@query("fn_8_international_points", f", q AS (SELECT result_id, age, total, {_curve(3)} AS q, {_MASTER} AS m FROM results) SELECT result_id, CASE WHEN total > 0 AND age BETWEEN 21 AND 30 THEN q END AS qpoints, CASE WHEN total > 0 AND age BETWEEN 10 AND 20 THEN q END AS q_youth, CASE WHEN total > 0 AND m THEN q END AS q_masters FROM q")
def fn_8(v):
    return v.results.select("result_id", *scoring.international_points("total", "body_weight_kg", "gender", "age"))


@query("fn_9_is_master", f"SELECT result_id, {_MASTER} AS is_master FROM results")
def fn_9(v):
    return v.results.select("result_id", scoring.is_master("gender", "age").alias("is_master"))


@query("fn_10_age_factor", f"SELECT result_id, {_FACTOR} AS factor FROM results WHERE age IS NOT NULL")
def fn_10(v):
    return v.results.where("age is not null").select("result_id", scoring.age_factor("age", "gender").alias("factor"))


def _youth_factors(v):
    """Synthetic factors by rule: the published ones are not public."""
    ages, weights = F.explode(F.sequence(F.lit(8), F.lit(20))), F.explode(F.sequence(F.lit(30), F.lit(115)))
    base = v.spark.range(1).select(F.explode(F.array(F.lit("M"), F.lit("F"))).alias("gender")).select("gender", ages.alias("age")).select("gender", "age", weights.alias("bodyweight_kg"))
    return base.withColumn("factor", F.lit(2.0) - F.col("age") / 25.0 + F.col("bodyweight_kg") / 1000.0 + F.when(F.col("gender") == "F", 0.05).otherwise(0.0))


_YOUTH = ", y AS (SELECT g AS gender, a AS age, w AS kg, 2.0::DOUBLE - a / 25.0::DOUBLE + w / 1000.0::DOUBLE + CASE WHEN g = 'F' THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END AS factor FROM (VALUES ('M'), ('F')) t(g), range(8, 21) s(a), range(30, 116) r(w)), w AS (SELECT *, GREATEST(30.0, LEAST(115.0, body_weight_kg)) AS b FROM results) "


@query("fn_12_youth_factor", _YOUTH + "SELECT result_id, CASE WHEN w.age BETWEEN 8 AND 20 THEN ROUND(lo.factor + (b - FLOOR(b)) * (hi.factor - lo.factor), 4) ELSE 1.0 END AS youth_factor FROM w LEFT JOIN y lo ON lo.gender = w.gender AND lo.age = w.age AND lo.kg = FLOOR(b) LEFT JOIN y hi ON hi.gender = w.gender AND hi.age = w.age AND hi.kg = CEIL(b)")
def fn_12(v):
    return scoring.with_youth_factor(v.results, _youth_factors(v)).select("result_id", "youth_factor")


@query("fn_11_youth_factor_exact", _YOUTH + "SELECT result_id, COALESCE(factor, 1.0) AS factor FROM w LEFT JOIN y ON y.gender = w.gender AND y.age = w.age AND y.kg = GREATEST(30, LEAST(115, CAST(FLOOR(body_weight_kg) AS INT)))")
def fn_11(v):
    kg = F.greatest(F.lit(30), F.least(F.lit(115), F.floor("body_weight_kg").cast("int")))
    rows = v.results.select("result_id", "gender", "age", kg.alias("bodyweight_kg"))
    return rows.join(F.broadcast(_youth_factors(v)), ["gender", "age", "bodyweight_kg"], "left").select("result_id", F.coalesce("factor", F.lit(1.0)).alias("factor"))


def _sql_poly(x, cs):
    out = f"({cs[0]!r}::DOUBLE)"
    for c in cs[1:]:
        out = f"({out} * {x} + ({c!r}::DOUBLE))"
    return out


def _sql_erf(x):
    t = f"(1 / (1 + {scoring.ERF_T}::DOUBLE * ABS({x})))"
    return f"(SIGN({x}) * (1 - {_sql_poly(t, scoring.ERF)} * {t} * EXP(-({x}) * ({x}))))"


def _sql_cdf(x):
    return f"(0.5 * (1 + {_sql_erf(f'({x} / SQRT(2.0))')}))"


def _sql_inv(p):
    tail = lambda q: f"({_sql_poly(f'SQRT(-2 * LN({q}))', scoring.INV_C)} / {_sql_poly(f'SQRT(-2 * LN({q}))', scoring.INV_D)})"
    mid = f"({_sql_poly(f'(({p} - 0.5) * ({p} - 0.5))', scoring.INV_A)} * ({p} - 0.5) / {_sql_poly(f'(({p} - 0.5) * ({p} - 0.5))', scoring.INV_B)})"
    return f"CASE WHEN {p} < 0.02425 THEN {tail(p)} WHEN {p} > 1 - 0.02425 THEN -{tail(f'(1 - {p})')} ELSE {mid} END"


@query("fn_13_erf", f", x AS (SELECT result_id, (body_weight_kg - 85) / 20 AS x FROM results) SELECT result_id, ROUND({_sql_erf('x')}, 6) AS erf, ROUND({_sql_cdf('x')}, 6) AS cdf FROM x")
def fn_13(v):
    x = (F.col("body_weight_kg") - 85) / 20
    return v.results.select("result_id", F.round(scoring.erf(x), 6).alias("erf"), F.round(scoring.norm_cdf(x), 6).alias("cdf"))


@query("fn_15_norm_inv", f", p AS (SELECT result_id, (result_id % 9973 + 1) / 10000.0::DOUBLE AS p FROM results) SELECT result_id, ROUND({_sql_inv('p')}, 6) AS z FROM p")
def fn_15(v):
    return v.results.select("result_id", F.round(scoring.norm_inv((F.col("result_id") % 9973 + 1) / F.lit(10000.0)), 6).alias("z"))


_GAMX = """, f AS (SELECT result_id, CAST(total AS DOUBLE) AS q, 100.0 + body_weight_kg AS mu, 0.25::DOUBLE AS sigma, CASE result_id % 3 WHEN 0 THEN 0.0 WHEN 1 THEN 0.5 ELSE -0.5 END::DOUBLE AS nu, total FROM results),
 z AS (SELECT *, CASE WHEN nu <> 0 THEN (POWER(q / mu, nu) - 1) / (nu * sigma) ELSE LN(CASE WHEN q > 0 THEN q / mu END) / sigma END AS z, CASE WHEN nu <> 0 THEN 1 / (sigma * ABS(nu)) END AS e FROM f WHERE q > 0),
 p AS (SELECT *, GREATEST(1e-20, LEAST(1 - 1e-15, (""" + _sql_cdf("z") + " - CASE WHEN nu > 0 THEN " + _sql_cdf("(-e)") + " ELSE 0.0 END) / CASE WHEN nu <> 0 THEN " + _sql_cdf("e") + " ELSE 1.0 END)) AS p FROM z) "


@query("fn_16_distribution_score", _GAMX + f"SELECT f.result_id, ROUND(1000 + 100 * ({_sql_inv('p')}), 1) AS score FROM f LEFT JOIN p ON p.result_id = f.result_id")
def fn_16(v):
    nu = F.when(F.col("result_id") % 3 == 0, 0.0).when(F.col("result_id") % 3 == 1, 0.5).otherwise(-0.5)
    return v.results.select("result_id", F.round(scoring.distribution_score("total", F.col("body_weight_kg") + 100.0, F.lit(0.25), nu), 1).alias("score"))


@query("fn_18_distribution_scores", """, w AS (SELECT result_id, total, age, CAST(body_weight_kg AS DOUBLE) AS b FROM results), f AS (SELECT *, CAST(total AS DOUBLE) AS q, 120.0 + b AS mu, 0.3 AS sigma FROM w WHERE total > 0), s AS (SELECT *, LN(q / mu) / sigma AS z FROM f), p AS (SELECT *, GREATEST(1e-20, LEAST(1 - 1e-15, """ + _sql_cdf("z") + """)) AS p FROM s)
 SELECT w.result_id, ROUND(ROUND(1000 + 100 * (""" + _sql_inv("p") + """), 2), 1) AS gamx_u, CASE WHEN COALESCE(w.age BETWEEN 15 AND 40, TRUE) THEN ROUND(ROUND(1000 + 100 * (""" + _sql_inv("p") + """), 2), 1) END AS gamx_total FROM w LEFT JOIN p ON p.result_id = w.result_id""")
def fn_18(v):
    base = v.spark.range(400, 1300).select((F.col("id") / 10).cast("decimal(5,1)").alias("bodyweight"))
    table = base.select(F.explode(F.array(F.lit("m"), F.lit("f"))).alias("gender"), "bodyweight", (F.lit(120.0) + F.col("bodyweight").cast("double")).alias("mu"), F.lit(0.3).alias("sigma"), F.lit(0.0).alias("nu"))
    out = scoring.with_distribution_scores(v.results.select("result_id", "gender", "age", "body_weight_kg", "total"), {"u": table, "total": table}, ages={"total": (15, 40)})
    return out.select("result_id", F.round("gamx_u", 1).alias("gamx_u"), F.round("gamx_total", 1).alias("gamx_total"))


_DIV = """list_filter([CASE WHEN age <= 11 THEN '11 Under Age Group' END, CASE WHEN age <= 13 THEN '13 Under Age Group' END, CASE WHEN age BETWEEN 14 AND 15 THEN '14-15 Age Group' END, CASE WHEN age BETWEEN 16 AND 17 THEN '16-17 Age Group' END,
 CASE WHEN age BETWEEN 13 AND 17 THEN 'Youth' END, CASE WHEN age BETWEEN 15 AND 20 THEN 'Junior' END, CASE WHEN age >= 15 THEN 'Open' END,
 CASE WHEN age >= 35 THEN CASE WHEN gender = 'F' AND age >= 75 THEN 'Masters (75+)' WHEN gender = 'M' AND age >= 80 THEN 'Masters (80+)' WHEN gender = 'M' AND age >= 75 THEN 'Masters (75-79)' ELSE 'Masters (' || CAST(age // 5 * 5 AS VARCHAR) || '-' || CAST(age // 5 * 5 + 4 AS VARCHAR) || ')' END END], lambda x: x IS NOT NULL)"""
_PREFIX = "CASE WHEN gender = 'F' THEN 'Women''s ' ELSE 'Men''s ' END"


@query("fn_20_divisions", f", d AS (SELECT result_id, gender, weight_class, UNNEST({_DIV}) AS n FROM results WHERE age IS NOT NULL) SELECT result_id, {_PREFIX} || n || ' ' || weight_class AS division FROM d")
def fn_20(v):
    return v.results.select("result_id", F.explode(divisions.eligible_divisions("gender", "age", "weight_class")).alias("division"))


def _weight_sql():
    whens = []
    for first, era in divisions.ERAS:
        before, after = divisions.OVER[era]
        for s, limits in divisions.LIMITS[era]["open"].items():
            inner = _case([(f"body_weight_kg <= {x}", f"'{x}kg'") for x in limits], f"'{before}{limits[-1]}{after}'")
            whens.append((f"d >= '{first}' AND gender = '{s}'", inner))
    return _case(whens)


@query("fn_21_weight_class", f", d AS (SELECT *, CASE WHEN result_id % 4 = 0 THEN '2025-07-01' WHEN result_id % 4 = 1 THEN '2019-01-01' ELSE date END AS d FROM results) SELECT result_id, {_weight_sql()} AS standard_class FROM d")
def fn_21(v):
    d = F.when(F.col("result_id") % 4 == 0, "2025-07-01").when(F.col("result_id") % 4 == 1, "2019-01-01").otherwise(F.col("date"))
    return v.results.select("result_id", divisions.weight_class(F.when(F.col("gender") == "F", "Open Women's").otherwise("Open Men's"), "body_weight_kg", d.cast("date")).alias("standard_class"))


@query("fn_22_alternatives", """, l AS (SELECT result_id, CAST(result_id % 7 + 1 AS INT) AS p, ['49kg','55kg','61kg','67kg','73kg','81kg','89kg'] AS l FROM results)
 SELECT result_id, array_to_string(list_concat(list_filter([l[p], CASE WHEN p > 1 THEN l[p - 1] END, l[p + 1], CASE WHEN p > 2 THEN l[p - 2] END, l[p + 2]], lambda x: x IS NOT NULL), ['Open']), ',') AS classes FROM l""")
def fn_22(v):
    ladder = F.array(*map(F.lit, ("49kg", "55kg", "61kg", "67kg", "73kg", "81kg", "89kg")))
    return v.results.select("result_id", F.array_join(divisions.alternatives((F.col("result_id") % 7 + 1).cast("int"), ladder), ",").alias("classes"))


@query("fn_23_buckets", ", b AS (SELECT result_id, UNNEST(list_filter(['all', CASE WHEN age < 13 THEN 'U13' END, CASE WHEN age BETWEEN 13 AND 17 THEN 'Youth' END, CASE WHEN age BETWEEN 15 AND 20 THEN 'Junior' END, CASE WHEN age >= 15 THEN 'Senior' END, CASE WHEN age >= 35 THEN 'Masters' END], lambda x: x IS NOT NULL)) AS e, source, gender FROM results) SELECT result_id, source || '_' || gender || '_' || e AS bucket FROM b")
def fn_23(v):
    return v.results.select("result_id", F.explode(divisions.buckets("source", "gender", "age")).alias("bucket"))


@query("fn_24_gender_from_class", ", t AS (SELECT result_id, CASE result_id % 3 WHEN 0 THEN 'Open Women''s 59kg' WHEN 1 THEN 'Junior Men''s 73kg' ELSE '81kg' END AS t FROM results) SELECT result_id, CASE WHEN lower(t) LIKE '%women%' THEN 'F' WHEN lower(t) LIKE '%men%' THEN 'M' END AS gender FROM t")
def fn_24(v):
    t = F.when(F.col("result_id") % 3 == 0, "Open Women's 59kg").when(F.col("result_id") % 3 == 1, "Junior Men's 73kg").otherwise("81kg")
    return v.results.select("result_id", divisions.gender_from_class(t).alias("gender"))


@query("fn_25_birth_year", ", t AS (SELECT result_id, CAST(1950 + result_id % 60 AS INT) AS y FROM results) SELECT result_id, CASE result_id % 4 WHEN 3 THEN NULL ELSE y END AS birth_year FROM t")
def fn_25(v):
    y = (1950 + F.col("result_id") % 60).cast("string")
    t = F.when(F.col("result_id") % 4 == 0, F.concat(F.lit("1.12."), y)).when(F.col("result_id") % 4 == 1, F.concat(F.lit("Born, "), y)).when(F.col("result_id") % 4 == 2, F.concat(F.lit("b. "), y, F.lit(" x"))).otherwise("unknown")
    return v.results.select("result_id", divisions.birth_year(t).alias("birth_year"))


@query("fn_26_age_and_weight", "SELECT result_id, CASE WHEN gender = 'M' THEN 'Open Men''s' ELSE 'Open Women''s' END AS age_category, CASE WHEN result_id % 5 = 0 THEN NULL ELSE weight_class END AS weight_class FROM results")
def fn_26(v):
    t = F.concat_ws(" ", F.when(F.col("gender") == "M", "Open Men's").otherwise("Open Women's"), F.when(F.col("result_id") % 5 != 0, F.col("weight_class")))
    return v.results.select("result_id", divisions.age_and_weight(t).alias("x")).select("result_id", "x.*")


@query("fn_27_entry_status", "SELECT entry_id, CASE WHEN total > entry_total THEN 'Exceeded' WHEN total = entry_total THEN 'Met' ELSE 'Below' END AS status, CAST(total - entry_total AS INT) AS diff FROM entries JOIN results ON result_id = entry_id")
def fn_27(v):
    rows = v.entries.join(v.results.select(F.col("result_id").alias("entry_id"), "total"), "entry_id")
    return rows.select("entry_id", divisions.entry_status("entry_total", "total").alias("status"), (F.col("total") - F.col("entry_total")).cast("int").alias("diff"))


@query("fn_28_medal_level", "SELECT meet_id, CASE WHEN level = 'International' THEN 'international' WHEN level IN ('National', 'North American Open Series') THEN 'national' ELSE 'local' END AS medal_level FROM meets")
def fn_28(v):
    return v.meets.select("meet_id", divisions.medal_level("level").alias("medal_level"))


@query("str_3_tokens", "SELECT doc_id, CAST(len(list_filter(string_split(regexp_replace(regexp_replace(lower(text), '[-\\s]+', ' ', 'g'), '[^a-z0-9 ]', '', 'g'), ' '), lambda x: len(x) > 2)) AS INT) AS n FROM documents")
def str_3(v):
    return v.table("documents").select("doc_id", F.size(text.tokens("text")).alias("n"))


_SYL = "substr('anbecodifugahelimopuranesitolu', CAST(1 + 2 * ({0} % 15) AS INT), 2)"
_DIV_ = "CAST(floor(abs(lifter_id) / {0}) AS BIGINT)"
_INITIAL = "chr(CAST(65 + {0} % 26 AS INT))"
_NAMED = "{} || {} || {} || CASE WHEN lifter_id % 4 = 0 THEN '-' ELSE ' ' END || {} || {} || {} || CASE WHEN lifter_id % 9 = 0 THEN ' Jr.' ELSE '' END".format(
    _INITIAL.format("abs(lifter_id)"), _SYL.format("abs(lifter_id)"), _SYL.format(_DIV_.format(15)), _INITIAL.format(_DIV_.format(7)), _SYL.format(_DIV_.format(3)), _SYL.format(_DIV_.format(11)))
_TERM = "CASE lifter_id % 300 WHEN 0 THEN upper(nm) WHEN 100 THEN substr(nm, 2, 6) ELSE COALESCE(membership_number, lower(substr(nm, 1, 4))) END"
_GRAMS = "list_distinct(flatten(list_transform(list_filter(string_split_regex(lower({0}), '[^a-z0-9]+'), lambda w: w <> ''), lambda w: list_transform(range(1, len(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"


@query("str_4_similarity", f""", n AS (SELECT lifter_id, {_NAMED} AS nm, membership_number FROM lifters), t AS (SELECT lifter_id AS term_id, {_TERM} AS term FROM n WHERE lifter_id % 100 = 0),
 q AS (SELECT lifter_id, gender, CASE WHEN result_id % 7 = 0 THEN NULL WHEN result_id % 7 = 1 THEN ' ' ELSE club_name END AS club, CASE WHEN result_id % 5 = 0 THEN '' ELSE wso END AS wso, date, result_id FROM results),
 r AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY lifter_id ORDER BY date DESC, result_id DESC) AS k FROM q WHERE trim(club) <> '' OR trim(wso) <> '') WHERE k = 1 AND club IS NOT NULL),
 p AS (SELECT n.lifter_id, nm, membership_number, COALESCE(r.gender, 'Unknown') AS gender, r.club AS club_name, COALESCE(r.wso, 'Unknown') AS wso, {_GRAMS.format('nm')} AS g FROM n JOIN r ON r.lifter_id = n.lifter_id), tg AS (SELECT *, {_GRAMS.format('term')} AS h FROM t),
 x AS (SELECT *, len(list_intersect(g, h))::DOUBLE / (len(g) + len(h) - len(list_intersect(g, h))) AS sim FROM tg, p),
 y AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY term_id ORDER BY CASE WHEN membership_number = term THEN 1 WHEN lower(nm) = lower(term) THEN 2 ELSE 3 END, sim DESC, nm, lifter_id) AS place FROM x WHERE sim > 0.2 OR contains(lower(nm), lower(term)) OR membership_number = term)
 SELECT term_id, CAST(place AS INT) AS place, lifter_id, nm AS athlete_name, membership_number, gender, club_name, wso FROM y WHERE place <= 50""")
def str_4(v):
    # names of syllables by rule; the terms are names of athletes in capitals, parts of them, and membership numbers
    n = v.lifters.select("lifter_id", F.expr(_NAMED).alias("athlete_name"), "membership_number")
    t = n.where("lifter_id % 100 = 0").select(F.col("lifter_id").alias("term_id"), F.expr(_TERM.replace("nm", "athlete_name")).alias("term"))
    k = F.col("result_id")
    q = v.results.select("lifter_id", "gender", F.when(k % 7 == 1, " ").when(k % 7 != 0, F.col("club_name")).alias("club_name"), F.when(k % 5 == 0, "").otherwise(F.col("wso")).alias("wso"), "date", "result_id")
    last = F.max_by(F.struct("gender", "club_name", "wso"), F.struct("date", "result_id"))
    recent = q.where("trim(club_name) != '' or trim(wso) != ''").groupBy("lifter_id").agg(last.alias("r")).select("lifter_id", "r.*")
    return names.search_athletes(n, recent, t)


@query("str_7_url_ids", "SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, TRY_CAST(NULLIF(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS INT) AS page FROM pages")
def str_7(v):
    return v.table("pages").select("page_id", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), text.query_value("url", "page").try_cast("int").alias("page"))


@query("str_12_shard", "SELECT lifter_id, lpad(right(CAST(lifter_id AS VARCHAR), 2), 2, '0') AS shard FROM lifters")
def str_12(v):
    return v.lifters.select("lifter_id", text.shard("lifter_id").alias("shard"))


@query("str_5_pronouns", "SELECT lifter_id, athlete_name AS name, CASE WHEN lifter_id % 3 = 0 THEN 'they/them' END AS pronouns FROM lifters")
def str_5(v):
    t = F.when(F.col("lifter_id") % 3 == 0, F.concat("athlete_name", F.lit(" (they/them)"))).otherwise(F.col("athlete_name"))
    return v.lifters.select("lifter_id", text.name_and_pronouns(t).alias("x")).select("lifter_id", "x.*")


@query("str_8_map_coordinates", "SELECT meet_id, CASE WHEN meet_id % 3 = 2 THEN NULL ELSE latitude END AS lat, CASE WHEN meet_id % 3 = 2 THEN NULL ELSE longitude END AS lng FROM meets")
def str_8(v):
    lat, lng = F.col("latitude").cast("string"), F.col("longitude").cast("string")
    url = F.when(F.col("meet_id") % 3 == 0, F.concat(F.lit("https://maps.example/@"), lat, F.lit(","), lng, F.lit(",17z"))).when(F.col("meet_id") % 3 == 1, F.concat(F.lit("https://maps.example/x!2d"), lng, F.lit("!3d"), lat)).otherwise("https://maps.example/")
    return v.meets.select("meet_id", text.map_coordinates(url).alias("x")).select("meet_id", "x.*")


@query("str_9_pager", "SELECT meet_id, CAST(1 AS INT) AS first, CAST(20 AS INT) AS last, meet_id AS total FROM meets")
def str_9(v):
    return v.meets.select("meet_id", text.pager(F.concat(F.lit("1-20 of "), F.col("meet_id").cast("string"))).alias("x")).select("meet_id", "x.*")


@query("dat_1_listing_dates", "SELECT meet_id, strftime(CAST(meet_date AS DATE), '%Y-%m-%d') AS start_date, strftime(CAST(meet_date AS DATE) + 1, '%Y-%m-%d') AS end_date FROM meets")
def dat_1(v):
    day = lambda n: F.date_format(F.date_add(F.to_date("meet_date"), n), "MMMM d'th' yyyy")
    x = text.listing_dates(F.concat(day(0), F.lit(" - "), day(1)))
    return v.meets.select("meet_id", x["start_date"].cast("string").alias("start_date"), x["end_date"].cast("string").alias("end_date"))


@query("dat_2_year", "SELECT meet_id, CASE meet_id % 4 WHEN 3 THEN 2030 ELSE CAST(SUBSTRING(meet_date, 1, 4) AS INT) END AS year FROM meets")
def dat_2(v):
    m, d = F.col("meet_id") % 4, F.to_date("meet_date")
    t = F.when(m == 0, F.col("meet_date")).when(m == 1, F.date_format(d, "MM/dd/yyyy")).when(m == 2, F.concat(F.lit("in "), F.year(d).cast("string"))).otherwise("soon")
    return v.meets.select("meet_id", text.year_of(t, F.lit("2030-01-01").cast("date")).alias("year"))


@query("dat_8_day_gap", "SELECT result_id, CASE WHEN result_id % 9 = 0 THEN 9999 ELSE CAST(abs(date_diff('day', CAST(date AS DATE), DATE '1995-06-15')) AS INT) END AS gap FROM results")
def dat_8(v):
    return v.results.select("result_id", text.day_gap(F.when(F.col("result_id") % 9 != 0, F.col("date")).otherwise("junk"), F.lit("1995-06-15")).alias("gap"))


@query("dat_6_date_parts", "SELECT event_id, CAST(year(ts) AS INT) AS y, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS minute, strftime(date_trunc('month', ts), '%Y-%m-%d') AS month FROM events")
def dat_6(v):
    f = lambda unit, fmt: F.date_format(F.date_trunc(unit, "ts"), fmt)
    return v.table("events").select("event_id", F.year("ts").alias("y"), f("minute", "yyyy-MM-dd HH:mm:ss").alias("minute"), f("month", "yyyy-MM-dd").alias("month"))


@query("dat_7_iso_week", "SELECT event_id, CAST(isoyear(ts) AS INT) AS y, CAST(week(ts) AS INT) AS w FROM events")
def dat_7(v):
    return v.table("events").select("event_id", F.expr("CAST(extract(YEAROFWEEK FROM ts) AS INT)").alias("y"), F.weekofyear("ts").alias("w"))


@query("jsn_1_json_path", ", p AS (SELECT lifter_id, MAX(CASE WHEN total > 280 THEN total END) AS best, COUNT(*) FILTER (total > 280) AS n FROM results GROUP BY 1) SELECT l.lifter_id, l.athlete_name AS name, COALESCE(n, 0) AS n_results, best, COALESCE(n, 0) = 0 AS empty FROM lifters l LEFT JOIN p ON p.lifter_id = l.lifter_id")
def jsn_1(v):
    # objects of results in an array for each lifter, an empty one where there is none, and read again by path
    good = v.results.where("total > 280").groupBy("lifter_id").agg(F.sort_array(F.collect_list(F.struct("total", "result_id")), asc=False).alias("r"))
    built = F.to_json(F.struct(F.struct(F.col("athlete_name").alias("name")).alias("athlete"), F.coalesce("r", F.array().cast("array<struct<total:int,result_id:bigint>>")).alias("results")))
    j = v.lifters.join(good, "lifter_id", "left").select("lifter_id", built.alias("j"))
    got = lambda p: F.get_json_object("j", p)
    n = F.json_array_length(got("$.results"))
    return j.select("lifter_id", got("$.athlete.name").alias("name"), n.cast("long").alias("n_results"), got("$.results[0].total").try_cast("int").alias("best"), (n == 0).alias("empty"))


@query("fil_1_valid", "SELECT result_id FROM results WHERE total > 0 AND body_weight_kg > 0 AND age IS NOT NULL AND gender IS NOT NULL")
def fil_1(v):
    return v.results.where((F.col("total") > 0) & (F.col("body_weight_kg") > 0) & F.col("age").isNotNull() & F.col("gender").isNotNull()).select("result_id")


@query("fil_2_missing_by_band", f", q AS (SELECT *, {_MASTER} AS m FROM results) SELECT result_id, CASE WHEN age BETWEEN 10 AND 20 THEN 'youth' WHEN age BETWEEN 21 AND 30 THEN 'open' WHEN m THEN 'masters' END AS band FROM q WHERE total > 0 AND (age BETWEEN 10 AND 30 OR m)")
def fil_2(v):
    m, a = scoring.is_master("gender", "age"), F.col("age")
    rows = v.results.where((F.col("total") > 0) & (a.between(10, 30) | m))
    return rows.select("result_id", F.when(a.between(10, 20), "youth").when(a.between(21, 30), "open").when(m, "masters").alias("band"))


@query("fil_4_bomb_out_status", "SELECT result_id, CASE WHEN best_snatch <= 0 AND best_cj <= 0 THEN 'DNC' WHEN best_snatch <= 0 THEN 'Bombout SN' ELSE 'Bombout CJ' END AS status FROM results WHERE total = 0")
def fil_4(v):
    s, c = F.col("best_snatch") <= 0, F.col("best_cj") <= 0
    return v.results.where("total = 0").select("result_id", F.when(s & c, "DNC").when(s, "Bombout SN").otherwise("Bombout CJ").alias("status"))


@query("fil_6_real_clubs", "SELECT DISTINCT club_name FROM (SELECT CASE WHEN result_id % 5 = 0 THEN ' - ' WHEN result_id % 7 = 0 THEN '' ELSE club_name END AS club_name FROM results) WHERE lower(trim(club_name)) NOT IN ('', 'null', '-', '.')")
def fil_6(v):
    name = F.when(F.col("result_id") % 5 == 0, " - ").when(F.col("result_id") % 7 == 0, "").otherwise(F.col("club_name"))
    return v.results.select(name.alias("club_name")).where(~F.lower(F.trim("club_name")).isin("", "null", "-", ".")).distinct()


@query("fil_7_level_words", "SELECT meet_id FROM meets WHERE level ILIKE '%national%' OR level ILIKE '%open%'")
def fil_7(v):
    return v.meets.where(F.col("level").ilike("%national%") | F.col("level").ilike("%open%")).select("meet_id")


@query("fil_8_ranges", "SELECT result_id FROM results WHERE NOT (body_weight_kg BETWEEN 30 AND 120 AND COALESCE(age BETWEEN 8 AND 60, TRUE) AND (total = 0 OR best_snatch BETWEEN 60 AND 500))")
def fil_8(v):
    fine = F.col("body_weight_kg").between(30, 120) & F.coalesce(F.col("age").between(8, 60), F.lit(True)) & ((F.col("total") == 0) | F.col("best_snatch").between(60, 500))
    return v.results.where(~fine).select("result_id")


@query("fil_10_manual_override", "SELECT result_id, CASE WHEN result_id % 6 = 0 THEN 1 ELSE total END AS total FROM results")
def fil_10(v):
    return v.results.select("result_id", F.when(F.col("result_id") % 6 == 0, F.lit(1)).otherwise(F.col("total")).alias("total"))


@query("fn_14_norm_cdf", f", x AS (SELECT result_id, (body_weight_kg - 85) / 10 AS x FROM results) SELECT result_id, ROUND({_sql_cdf('x')}, 6) AS p FROM x")
def fn_14(v):
    return v.results.select("result_id", F.round(scoring.norm_cdf((F.col("body_weight_kg") - 85) / 10), 6).alias("p"))


@query("fn_17_score_by_age_limit", ORACLE_SQL["fn_18_distribution_scores"].split(WITH)[1] + " WHERE w.result_id % 2 = 0")
def fn_17(v):
    """The score of one type for what is asked: here of half of the results, in whatever order they come."""
    asked = v.results.where("result_id % 2 = 0").select("result_id")
    return fn_18(v).join(asked, "result_id", "left_semi")


@query("fn_19_recompute_range", f", c AS (SELECT MIN(result_id) AS lo, MAX(result_id) AS hi FROM results), k AS (SELECT r.*, {_curve(2)} AS q, CASE WHEN CAST(SUBSTRING(date, 1, 4) AS INT) = 1995 AND lifter_id % 10 = 3 THEN 'lifter and year' WHEN result_id BETWEEN lo + (hi - lo) // 4 AND lo + (hi - lo) // 2 THEN 'range' END AS why, (result_id - lo) // 5000 AS chunk FROM results r, c) SELECT result_id, why, chunk, CASE WHEN why IS NULL THEN -1.0 ELSE q END AS qpoints FROM k")
def fn_19(v):
    """Stored scores, all -1 here, are computed again for some athletes in one year and for a quarter of the ids, in chunks of 5,000 ids;
    what was not asked for stays as it was."""
    r, k = v.results, F.col("result_id")
    ends = r.agg(F.min(k).alias("lo"), F.max(k).alias("hi"))
    stored = r.withColumn("qpoints", F.lit(-1.0)).join(F.broadcast(ends), F.lit(True))
    asked = F.when((F.substring("date", 1, 4).cast("int") == 1995) & (F.col("lifter_id") % 10 == 3), "lifter and year")
    asked = asked.when(k.between(F.expr("lo + (hi - lo) div 4"), F.expr("lo + (hi - lo) div 2")), "range")
    out = scoring.recompute(stored, "qpoints", scoring.points("total", "body_weight_kg", "gender"), asked)
    return out.select("result_id", asked.alias("why"), F.expr("(result_id - lo) div 5000").alias("chunk"), "qpoints")


@query("fn_29_country_names", ", c(code, name) AS (VALUES ('FRA', 'France'), ('CHN', 'China'), ('BRA', 'Brazil')) SELECT region, name FROM regions LEFT JOIN c ON code = substr(region, 1, 3)")
def fn_29(v):
    names = v.spark.createDataFrame([("FRA", "France"), ("CHN", "China"), ("BRA", "Brazil")], "code string, name string")
    return v.regions.select("region", F.substring("region", 1, 3).alias("code")).join(F.broadcast(names), "code", "left").select("region", "name")


_STATES_SQL = ", sn(state, area, people) AS (VALUES " + ", ".join(f"('{s}', {repr(next((r for r, ss in regions.REGIONS.items() if s in ss), None)).replace('None', 'NULL')}, {regions.POPULATIONS.get(s, 'NULL')})" for s in regions.STATES.values()) + ")"


@query("fn_30_region_of_state", _STATES_SQL + ", k AS (SELECT result_id, [" + ", ".join(f"'{s}'" for s in [*regions.STATES.values(), "Nowhere"]) + "][result_id % 52 + 1] AS state FROM results) SELECT result_id, area, CAST(people AS INT) AS people FROM k LEFT JOIN sn USING (state)")
def fn_30(v):
    state = F.get(F.array(*map(F.lit, [*regions.STATES.values(), "Nowhere"])), (F.col("result_id") % 52).cast("int"))
    return v.results.select("result_id", state.alias("state")).select("result_id", regions.region_of_mapped_state("state").alias("area"), regions.population("state").alias("people"))


@query("fil_3_zero_total", "SELECT result_id FROM results WHERE total = 0")
def fil_3(v):
    t = F.when(F.col("result_id") % 2 == 0, F.col("total").cast("string")).otherwise(F.when(F.col("total") == 0, "---").otherwise(F.col("total").cast("string")))
    return v.results.select("result_id", t.alias("t")).where(F.col("t").isNull() | F.col("t").isin("0", "---")).select("result_id")


@query("fil_5_changed", "SELECT result_id FROM results WHERE birth_year IS DISTINCT FROM CASE WHEN result_id % 4 = 0 THEN NULL ELSE birth_year END")
def fil_5(v):
    new = F.when(F.col("result_id") % 4 != 0, F.col("birth_year"))
    return v.results.where(~F.col("birth_year").eqNullSafe(new)).select("result_id")


@query("fil_9_tuple_in", "SELECT result_id FROM results WHERE (lifter_name, meet_id) IN (SELECT lifter_name, meet_id FROM results GROUP BY 1, 2 HAVING COUNT(*) > 1)")
def fil_9(v):
    many = v.results.groupBy("lifter_name", "meet_id").count().where("count > 1")
    return v.results.join(many, ["lifter_name", "meet_id"], "left_semi").select("result_id")


@query("fil_11_is_admin", "SELECT lifter_id, EXISTS (SELECT 1 FROM aliases WHERE a = lifter_id) AS flagged FROM lifters")
def fil_11(v):
    flagged = v.aliases.select(F.col("a").alias("lifter_id")).distinct().withColumn("f", F.lit(True))
    return v.lifters.select("lifter_id").join(flagged, "lifter_id", "left").select("lifter_id", F.coalesce("f", F.lit(False)).alias("flagged"))


@query("fil_12_work_queue", "SELECT result_id FROM results WHERE membership_number IS NULL OR birth_year IS NULL")
def fil_12(v):
    return v.results.where("membership_number is null or birth_year is null").select("result_id")


@query("fil_13_missing_fields", "SELECT result_id FROM results WHERE (membership_number IS NULL OR membership_number = '' OR birth_year IS NULL) AND total > 0 AND result_id NOT IN (SELECT result_id FROM results WHERE result_id % 5 = 0)")
def fil_13(v):
    from functools import reduce

    empty = reduce(lambda a, b: a | b, [F.col(c).isNull() | (F.col(c).cast("string") == "") for c in ("membership_number", "birth_year")])
    skip = v.results.where("result_id % 5 = 0").select("result_id")
    return v.results.where(empty & (F.col("total") > 0)).join(skip, "result_id", "left_anti").select("result_id")


@query("str_1_normal_name", "SELECT lifter_id, CASE lifter_id % 3 WHEN 0 THEN 'Jo BERG' WHEN 1 THEN 'Ann Lee VAN BERG Jr' ELSE athlete_name END AS name FROM lifters")
def str_1(v):
    t = F.when(F.col("lifter_id") % 3 == 0, "BERG Jo (USA)").when(F.col("lifter_id") % 3 == 1, "VAN BERG Ann Lee Jr").otherwise(F.col("athlete_name"))
    return v.lifters.select("lifter_id", text.normal_name(t).alias("name"))


@query("str_2_match_key", "SELECT lifter_id, upper(trim('  ' || athlete_name || ' ')) AS k FROM lifters")
def str_2(v):
    return v.lifters.select("lifter_id", text.match_key(F.concat(F.lit("  "), "athlete_name", F.lit(" "))).alias("k"))


@query("str_6_sanction_name", "SELECT lifter_id, athlete_name AS name FROM lifters")
def str_6(v):
    return v.lifters.select("lifter_id", text.sanction_name(F.concat(F.lit("Mr. "), "athlete_name", F.lit(" (note) 1.2.2020"))).alias("name"))


@query("str_10_without_suite", "SELECT meet_id, CAST(meet_id AS VARCHAR) || ' Main St, Town' AS address FROM meets")
def str_10(v):
    return v.meets.select("meet_id", text.without_suite(F.concat(F.col("meet_id").cast("string"), F.lit(" Main St, Suite 4, Town"))).alias("address"))


@query("str_11_keyword_flags", "SELECT meet_id, regexp_matches(level, '(?i)inter|open') AS flag FROM meets")
def str_11(v):
    return v.meets.select("meet_id", F.col("level").rlike("(?i)inter|open").alias("flag"))


@query("str_13_plural_labels", "SELECT meet_id, CAST(meet_id % 3 AS VARCHAR) || ' meet' || CASE WHEN meet_id % 3 = 1 THEN '' ELSE 's' END AS label FROM meets")
def str_13(v):
    n = F.col("meet_id") % 3
    return v.meets.select("meet_id", F.concat(n.cast("string"), F.lit(" meet"), F.when(n == 1, "").otherwise("s")).alias("label"))


@query("dat_3_duration", "SELECT meet_id, CASE meet_id % 3 WHEN 0 THEN '1 year 2 months' WHEN 1 THEN 'LIFE' ELSE '10 days' END AS duration FROM meets")
def dat_3(v):
    d = F.to_date("meet_date")
    first = F.trunc(d, "month")
    end = F.when(F.col("meet_id") % 3 == 0, F.add_months(first, 14)).when(F.col("meet_id") % 3 == 2, F.date_add(first, 10))
    return v.meets.select("meet_id", text.friendly_duration(first, end).alias("duration"))


@query("dat_4_sanction_dates", "SELECT meet_id, CASE meet_id % 3 WHEN 0 THEN meet_date WHEN 1 THEN meet_date END AS d FROM meets")
def dat_4(v):
    m = F.col("meet_id") % 3
    t = F.when(m == 0, F.col("meet_date")).when(m == 1, F.date_format(F.to_date("meet_date"), "d..M.yyyy")).otherwise("RETIRED")
    return v.meets.select("meet_id", text.sanction_date(t).cast("string").alias("d"))


@query("dat_5_series", ", b AS (SELECT CAST(date_trunc('year', MIN(CAST(date AS DATE))) AS DATE) AS lo, MAX(CAST(date AS DATE)) AS hi FROM results) SELECT strftime(CAST(UNNEST(generate_series(lo, hi, INTERVAL 6 MONTH)) AS DATE), '%Y-%m-%d') AS d, 6 AS months FROM b UNION ALL SELECT strftime(CAST(UNNEST(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE), '%Y-%m-%d'), 1 FROM b")
def dat_5(v):
    """Semi-annual and monthly snapshots from the year of the first result to the last."""
    day = F.to_date("date")
    ends = v.results.agg(F.to_date(F.date_trunc("year", F.min(day))).alias("lo"), F.max(day).alias("hi"))
    each = lambda n: ends.select(F.explode(F.sequence("lo", "hi", F.make_interval(months=F.lit(n)))).alias("d")).select(F.col("d").cast("string").alias("d"), F.lit(n).alias("months"))
    return each(6).unionByName(each(1))


@query("dat_9_odd_years", "SELECT meet_id, CAST(SUBSTRING(meet_date, 1, 4) AS INT) AS year FROM meets")
def dat_9(v):
    t = F.when(F.col("meet_id") % 2 == 0, F.concat(F.lit("-"), "meet_date")).otherwise(F.col("meet_date"))
    return v.meets.select("meet_id", F.regexp_extract(t, r"^-?0*(\d{4})-", 1).try_cast("int").alias("year"))


@query("mth_1_functions", "SELECT result_id, ROUND(power(body_weight_kg, 0.5) + ln(body_weight_kg) + exp(-body_weight_kg / 50) + sqrt(body_weight_kg), 6) AS x, CAST(floor(body_weight_kg) AS BIGINT) AS lo, CAST(ceil(body_weight_kg) AS BIGINT) AS hi FROM results")
def mth_1(v):
    b = F.col("body_weight_kg")
    return v.results.select("result_id", F.round(F.power(b, 0.5) + F.ln(b) + F.exp(-b / 50) + F.sqrt(b), 6).alias("x"), F.floor(b).alias("lo"), F.ceil(b).alias("hi"))


@query("mth_4_half_up", "SELECT result_id, floor((body_weight_kg - 85) / 7 * 1000 + 0.5) / 1000 AS x FROM results")
def mth_4(v):
    return v.results.select("result_id", (F.floor((F.col("body_weight_kg") - 85) / 7 * 1000 + 0.5) / 1000).alias("x"))


@query("arr_1_merge_lists", ", m AS (SELECT membership_number, lifter_id, MIN(lifter_id) OVER (PARTITION BY membership_number) AS master FROM lifters WHERE membership_number IS NOT NULL) SELECT master, lifter_id AS member FROM m WHERE lifter_id <> master")
def arr_1(v):
    g = v.lifters.where("membership_number is not null").groupBy("membership_number").agg(F.array_sort(F.collect_list("lifter_id")).alias("ids"))
    return g.select(F.element_at("ids", 1).alias("master"), F.explode("ids").alias("member")).where("member <> master")


@query("arr_3_id_columns", "SELECT lifter_id, CAST(len(ids) AS INT) AS n, list_contains(ids, 7) AS has_seven FROM (SELECT lifter_id, list_filter([internal_id, birth_year, TRY_CAST(membership_number AS BIGINT), NULLIF(lifter_id % 5, 0), NULLIF(lifter_id % 7, 0), NULLIF(lifter_id % 11, 0), NULLIF(lifter_id % 13, 0), NULLIF(lifter_id % 9, 0)], lambda x: x IS NOT NULL) AS ids FROM lifters)")
def arr_3(v):
    columns = ["internal_id", "birth_year", F.col("membership_number").try_cast("long"), *[F.nullif(F.col("lifter_id") % k, F.lit(0)) for k in (5, 7, 11, 13, 9)]]
    ids = F.array_compact(F.array(*[(F.col(c) if isinstance(c, str) else c).cast("long") for c in columns]))
    return v.lifters.select("lifter_id", ids.alias("ids")).select("lifter_id", F.size("ids").alias("n"), F.array_contains("ids", F.lit(7).cast("long")).alias("has_seven"))


@query("arr_4_states", ", s AS (SELECT club_name, string_agg(DISTINCT wso, ' , ' ORDER BY wso) AS states FROM results GROUP BY 1), l AS (SELECT club_name, list_filter(list_transform(string_split(states, ','), lambda x: trim(x)), lambda x: x <> '') AS a FROM s) SELECT club_name, CAST(len(a) AS INT) AS n, a[1] AS first, a[len(a)] AS last FROM l")
def arr_4(v):
    s = v.results.groupBy("club_name").agg(F.array_join(F.array_sort(F.collect_set("wso")), " , ").alias("states"))
    a = F.filter(F.transform(F.split("states", ","), lambda x: F.trim(x)), lambda x: x != "")
    return s.select("club_name", F.size(a).alias("n"), F.try_element_at(a, F.lit(1)).alias("first"), F.try_element_at(a, F.lit(-1)).alias("last"))


@query("map_1_overrides", "SELECT lifter_id, CASE WHEN lifter_id = 11 THEN 1011 WHEN lifter_id = 12 THEN 1012 ELSE lifter_id END AS target FROM lifters WHERE lifter_id NOT IN (13, 14)")
def map_1(v):
    to = v.spark.createDataFrame([(11, 1011), (12, 1012)], "lifter_id long, to long")
    block = v.spark.createDataFrame([(13,), (14,)], "lifter_id long")
    return v.lifters.join(F.broadcast(block), "lifter_id", "left_anti").join(F.broadcast(to), "lifter_id", "left").select("lifter_id", F.coalesce("to", "lifter_id").alias("target"))
