"""The library's scalar and table functions under their SQL names. SURVEY §2.14.

``register(spark)`` makes temporary SQL functions of the session: expressions that Spark puts into the plan of the query that
calls them, so nothing runs outside the engine. Formulas take their fixed values from the library's modules. Functions that look
something up, and the two table functions, read the temporary views named beside them, which must be there when they are
registered.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from barpath.functions import scoring

_SEX = "CASE WHEN upper(gender) IN ('M', 'MALE') THEN 'M' WHEN upper(gender) IN ('F', 'FEMALE') THEN 'F' END"


def _poly(x: str, coefficients) -> str:
    out = f"{float(coefficients[0])!r}D"
    for c in coefficients[1:]:
        out = f"({out} * {x} + {float(c)!r}D)"
    return out


def _curve(sex: str) -> str:
    s, a, m, p = scoring.CURVE[sex]
    return f"round(cast(total_lifted AS DOUBLE) * {s}D / ({a}D - {m}D * power(bodyweight / 100, -2.0D) + {p}D * power(bodyweight / 100, 2.0D)), 2)"


def _table(values) -> str:
    return f"element_at(array({', '.join(f'{v}D' for v in values)}), cast(least(age - 29, {len(values)}) AS INT))"


def _bounce(prev: str, cur: str) -> str:
    return f"calculate_bounce_back({prev}, {cur})"


#: name: (parameters, type, body). Later ones may call earlier ones.
SCALARS: dict[str, tuple[str, str, str]] = {
    "text_to_numeric_safe": ("p_input STRING", "DECIMAL(12,4)", "try_cast(nullif(nullif(regexp_replace(p_input, '[^0-9.]', ''), ''), '.') AS DECIMAL(12,4))"),
    "count_successful_attempts": ("lift1 STRING, lift2 STRING, lift3 STRING", "INT", " + ".join(f"if(try_cast(lift{k} AS INT) > 0, 1, 0)" for k in (1, 2, 3))),
    "calculate_bounce_back": (
        "prev_lift STRING, current_lift STRING", "BOOLEAN",
        "CASE WHEN (prev_lift IS NOT NULL AND try_cast(prev_lift AS INT) IS NULL) OR (current_lift IS NOT NULL AND try_cast(current_lift AS INT) IS NULL) THEN false ELSE try_cast(prev_lift AS INT) <= 0 AND try_cast(current_lift AS INT) > 0 END",
    ),
    "calculate_qpoints_from_row": ("total_lifted DOUBLE, bodyweight DOUBLE, gender STRING", "DOUBLE", f"CASE WHEN total_lifted > 0 AND bodyweight > 0 AND {_SEX} = 'M' THEN {_curve('M')} WHEN total_lifted > 0 AND bodyweight > 0 AND {_SEX} = 'F' THEN {_curve('F')} ELSE 0.0D END"),
    "is_master_age": ("gender STRING, age INT", "BOOLEAN", "coalesce((gender = 'M' AND age BETWEEN 31 AND 75) OR (gender = 'F' AND age BETWEEN 31 AND 110), false)"),
    "get_age_factor": ("age INT, gender STRING", "DOUBLE", f"CASE WHEN age IS NULL OR age < 30 THEN 1.0D WHEN {_SEX} = 'F' THEN {_table(scoring.WOMEN_FROM_30)} WHEN {_SEX} = 'M' THEN {_table(scoring.MEN_FROM_30)} ELSE 1.0D END"),
    "erf_of": ("x DOUBLE, t DOUBLE", "DOUBLE", f"signum(x) * (1 - {_poly('t', scoring.ERF)} * t * exp(-x * x))"),
    "gamx_erf": ("x DOUBLE", "DOUBLE", f"erf_of(x, 1 / (1 + {scoring.ERF_T}D * abs(x)))"),
    "gamx_norm_cdf": ("x DOUBLE", "DOUBLE", f"0.5D * (1 + gamx_erf(x / {2.0**0.5!r}D))"),
    "norm_inv_tail": ("t DOUBLE", "DOUBLE", f"{_poly('t', scoring.INV_C)} / {_poly('t', scoring.INV_D)}"),
    "norm_inv_middle": ("q DOUBLE, r DOUBLE", "DOUBLE", f"{_poly('r', scoring.INV_A)} * q / {_poly('r', scoring.INV_B)}"),
    "gamx_norm_inv": (
        "p DOUBLE", "DOUBLE",
        f"CASE WHEN p < 0 OR p > 1 THEN NULL WHEN p = 0 THEN double('-Infinity') WHEN p = 1 THEN double('Infinity') WHEN p < {scoring.INV_LOW}D THEN norm_inv_tail(sqrt(-2 * ln(p))) WHEN p > 1 - {scoring.INV_LOW}D THEN -norm_inv_tail(sqrt(-2 * ln(1 - p))) ELSE norm_inv_middle(p - 0.5D, (p - 0.5D) * (p - 0.5D)) END",
    ),
    "gamx_place": (
        "z DOUBLE, edge DOUBLE, nu DOUBLE", "DOUBLE",
        "(gamx_norm_cdf(z) - CASE WHEN nu > 0 THEN gamx_norm_cdf(-edge) ELSE 0.0D END) / CASE WHEN nu <> 0 THEN gamx_norm_cdf(edge) ELSE 1.0D END",
    ),
    "calculate_gamx_raw": (
        "q DOUBLE, mu DOUBLE, sigma DOUBLE, nu DOUBLE", "DOUBLE",
        "CASE WHEN q > 0 AND mu > 0 AND sigma > 0 AND nu IS NOT NULL THEN 1000 + 100 * gamx_norm_inv(greatest(1e-20D, least(1D - 1e-15D, gamx_place(CASE WHEN nu <> 0 THEN (power(q / mu, nu) - 1) / (nu * sigma) ELSE ln(q / mu) / sigma END, 1 / nullif(sigma * abs(nu), 0), nu)))) END",
    ),
}

#: The bests of an athlete on a day: at most 366 of them in a year.
_DAY = "STRUCT<date: STRING, snatch: INT, cj: INT, total: INT>"

#: name: (parameters, type, body, view and its columns).
LOOKUPS: dict[str, tuple[str, str, str, str]] = {
    "get_youth_factor_exact": ("input_age INT, input_bodyweight INT, input_gender STRING", "DOUBLE", "(SELECT max(f.factor) FROM youth_factors f WHERE f.age = input_age AND f.bodyweight_kg = input_bodyweight AND f.gender = upper(substr(input_gender, 1, 1)))", "youth_factors"),
    "youth_between": ("age INT, weight DOUBLE, gender STRING", "DOUBLE", "round(coalesce(get_youth_factor_exact(age, cast(floor(weight) AS INT), gender), 1.0D) + (weight - floor(weight)) * (coalesce(get_youth_factor_exact(age, cast(ceil(weight) AS INT), gender), 1.0D) - coalesce(get_youth_factor_exact(age, cast(floor(weight) AS INT), gender), 1.0D)), 4)", "youth_factors"),
    "get_youth_age_factor_interpolated": ("age INT, bodyweight DOUBLE, gender STRING", "DOUBLE", "CASE WHEN age BETWEEN 8 AND 20 THEN youth_between(age, greatest(30.0D, least(115.0D, bodyweight)), gender) ELSE 1.0D END", "youth_factors"),
    # conditions on a lookup are equalities alone: with another one, Spark joins all dates asked for with all results of their years
    "ytd_days": (
        "p_lifter_id BIGINT, p_year STRING", f"ARRAY<{_DAY}>",
        "(SELECT collect_list(struct(r.date, r.snatch, r.cj, r.total)) FROM (SELECT lifter_id, substr(date, 1, 4) AS year, date, max(best_snatch) AS snatch, max(best_cj) AS cj, max(total) AS total FROM meet_results GROUP BY lifter_id, date) r WHERE r.lifter_id = p_lifter_id AND r.year = p_year)", "meet_results",
    ),
    "bests_of_days": (f"days ARRAY<{_DAY}>", "STRUCT<snatch: INT, cj: INT, total: INT>", "struct(array_max(days.snatch), array_max(days.cj), array_max(days.total))", "meet_results"),
    "bests_until": (f"days ARRAY<{_DAY}>, p_date STRING", "STRUCT<snatch: INT, cj: INT, total: INT>", "bests_of_days(filter(days, d -> d.date <= p_date))", "meet_results"),
    "ytd_bests": ("p_lifter_id BIGINT, p_date STRING", "STRUCT<snatch: INT, cj: INT, total: INT>", "bests_until(ytd_days(p_lifter_id, substr(p_date, 1, 4)), p_date)", "meet_results"),
    "best_of": ("b STRUCT<snatch: INT, cj: INT, total: INT>, p_lift_type STRING", "INT", "CASE p_lift_type WHEN 'snatch' THEN b.snatch WHEN 'cj' THEN b.cj ELSE b.total END", "meet_results"),
    "calculate_ytd_best": ("p_lifter_id BIGINT, p_date STRING, p_lift_type STRING", "INT", "best_of(ytd_bests(p_lifter_id, p_date), p_lift_type)", "meet_results"),
    "gamx_factor_of": (
        "p_type STRING, p_gender STRING, p_age INT, p_bodyweight DECIMAL(5,1)", "STRUCT<mu: DOUBLE, sigma: DOUBLE, nu: DOUBLE>",
        "(SELECT max(struct(f.mu, f.sigma, f.nu)) FROM gamx_factors f WHERE f.kind = p_type AND f.gender = p_gender AND f.bodyweight = p_bodyweight AND coalesce(f.age, -1) = p_age)", "gamx_factors",
    ),
    "gamx_score_of": ("p_result DOUBLE, f STRUCT<mu: DOUBLE, sigma: DOUBLE, nu: DOUBLE>", "DOUBLE", "round(calculate_gamx_raw(p_result, f.mu, f.sigma, f.nu), 2)", "gamx_factors"),
    "get_gamx_score": (
        "p_type STRING, p_gender STRING, p_age INT, p_bodyweight DOUBLE, p_result DOUBLE", "DOUBLE",
        "gamx_score_of(p_result, gamx_factor_of(p_type, CASE WHEN lower(substr(p_gender, 1, 1)) = 'w' THEN 'f' ELSE lower(substr(p_gender, 1, 1)) END, CASE WHEN p_type IN ('u', 'a', 'masters') THEN p_age ELSE -1 END, cast(round(p_bodyweight, 1) AS DECIMAL(5,1))))",
        "gamx_factors",
    ),
}

_TRIGRAMS = "array_distinct(flatten(transform(filter(split(lower({0}), '[^a-z0-9]+'), w -> w <> ''), w -> transform(sequence(1, length(w) + 1), i -> substr(concat('  ', w, ' '), i, 3)))))"
_ALIKE = f"coalesce(size(array_intersect({_TRIGRAMS.format('{0}')}, {_TRIGRAMS.format('{1}')})) / nullif(size(array_union({_TRIGRAMS.format('{0}')}, {_TRIGRAMS.format('{1}')})), 0), 0.0D)".replace("{0}", "p.athlete_name").replace("{1}", "term")

#: name: (parameters, columns, body, view).
TABLES: dict[str, tuple[str, str, str, str]] = {
    "calculate_meet_result_analytics": (
        "p_lifter_id BIGINT, p_date STRING, p_snatch_1 STRING, p_snatch_2 STRING, p_snatch_3 STRING, p_cj_1 STRING, p_cj_2 STRING, p_cj_3 STRING",
        "snatch_successful_attempts INT, cj_successful_attempts INT, total_successful_attempts INT, best_snatch_ytd INT, best_cj_ytd INT, best_total_ytd INT, bounce_back_snatch_2 BOOLEAN, bounce_back_snatch_3 BOOLEAN, bounce_back_cj_2 BOOLEAN, bounce_back_cj_3 BOOLEAN",
        "SELECT count_successful_attempts(p_snatch_1, p_snatch_2, p_snatch_3), count_successful_attempts(p_cj_1, p_cj_2, p_cj_3), count_successful_attempts(p_snatch_1, p_snatch_2, p_snatch_3) + count_successful_attempts(p_cj_1, p_cj_2, p_cj_3), "
        + ", ".join(f"calculate_ytd_best(p_lifter_id, p_date, '{v}')" for v in ("snatch", "cj", "total")) + ", "
        + ", ".join(_bounce(f"p_{k}_{i}", f"p_{k}_{i + 1}") for k in ("snatch", "cj") for i in (1, 2)),
        "meet_results",
    ),
    "search_athletes": (
        "term STRING", "lifter_id BIGINT, athlete_name STRING, membership_number STRING, gender STRING, club_name STRING, wso STRING",
        f"SELECT p.lifter_id, p.athlete_name, p.membership_number, coalesce(p.gender, 'Unknown'), p.club_name, coalesce(p.wso, 'Unknown') FROM athletes p WHERE p.club_name IS NOT NULL AND (contains(lower(p.athlete_name), lower(term)) OR p.membership_number = term OR {_ALIKE} > 0.2D) "
        f"ORDER BY CASE WHEN p.membership_number = term THEN 1 WHEN lower(p.athlete_name) = lower(term) THEN 2 ELSE 3 END, {_ALIKE} DESC, p.athlete_name, p.lifter_id LIMIT 50",
        "athletes",
    ),
}


def register(spark: SparkSession) -> list[str]:
    """Make the functions whose views the session has; their names. Views: ``youth_factors`` (gender, bodyweight_kg, age, factor),
    ``gamx_factors`` (kind, gender, age, bodyweight, mu, sigma, nu), ``meet_results`` (lifter_id, date, best_snatch, best_cj, total),
    ``athletes`` (lifter_id, athlete_name, membership_number, gender, club_name, wso)."""
    out = []

    def make(name: str, parameters: str, returns: str, body: str) -> None:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {returns} RETURN {body}")
        out.append(name)

    for name, (parameters, kind, body) in SCALARS.items():
        make(name, parameters, kind, body)
    for name, (parameters, kind, body, view) in LOOKUPS.items():
        if spark.catalog.tableExists(view):
            make(name, parameters, kind, body)
    for name, (parameters, columns, body, view) in TABLES.items():
        if spark.catalog.tableExists(view):
            make(name, parameters, f"TABLE({columns})", body)
    return out
