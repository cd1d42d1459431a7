"""Scores of results as Column expressions: body-weight normalised, age-adjusted and distribution-based. SURVEY FN-6..18."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barpath.functions.parse import col

# Age factors, women from age 30 to 91 and men from 30 to 95; the last holds for all later ages.
WOMEN_FROM_30 = (
    1.000, 1.010, 1.021, 1.031, 1.042, 1.052, 1.063, 1.073, 1.084, 1.096, 1.108, 1.122, 1.138, 1.155, 1.173, 1.194, 1.216, 1.240, 1.265, 1.292,
    1.321, 1.352, 1.384, 1.419, 1.456, 1.494, 1.534, 1.575, 1.617, 1.660, 1.704, 1.748, 1.794, 1.841, 1.890, 1.942, 1.996, 2.052, 2.109, 2.168,
    2.226, 2.285, 2.343, 2.402, 2.464, 2.528, 2.597, 2.670, 2.749, 2.831, 2.918, 3.009, 3.104, 3.201, 3.301, 3.403, 3.507, 3.613, 3.720, 3.827,
    3.935, 3.935,
)
MEN_FROM_30 = (
    1.000, 1.010, 1.018, 1.026, 1.038, 1.052, 1.064, 1.076, 1.088, 1.100, 1.112, 1.124, 1.136, 1.148, 1.160, 1.173, 1.187, 1.201, 1.215, 1.230,
    1.247, 1.264, 1.283, 1.304, 1.327, 1.351, 1.376, 1.401, 1.425, 1.451, 1.477, 1.504, 1.531, 1.560, 1.589, 1.620, 1.654, 1.693, 1.736, 1.784,
    1.833, 1.883, 1.932, 1.981, 2.031, 2.083, 2.139, 2.202, 2.271, 2.348, 2.430, 2.524, 2.635, 2.755, 2.877, 3.008, 3.168, 3.356, 3.545, 3.709,
    3.880, 4.059, 4.247, 4.443, 4.648, 4.863,
)
# The total-to-body-weight curve (scale, a, b, c) of each sex.
CURVE = {"M": (463.26, 416.7, 47.87, 18.93), "F": (306.54, 266.5, 19.44, 18.61)}
# The error function (Abramowitz and Stegun 7.1.26) and the inverse normal (Acklam).
ERF_T, ERF = 0.3275911, (1.061405429, -1.453152027, 1.421413741, -0.284496736, 0.254829592)
INV_A = (-39.69683028665376, 220.9460984245205, -275.9285104469687, 138.3577518672690, -30.66479806614716, 2.506628277459239)
INV_B = (-54.47609879822406, 161.5858368580409, -155.6989798598866, 66.80131188771972, -13.28068155288572, 1.0)
INV_C = (-0.007784894002430293, -0.3223964580411365, -2.400758277161838, -2.549732539343734, 4.374664141464968, 2.938163982698783)
INV_D = (0.007784695709041462, 0.3224671290700398, 2.445134137142996, 3.754408661907416, 1.0)
INV_LOW = 0.02425


def sex(gender) -> Column:
    """'M' or 'F' from M, MALE, F, FEMALE in any case; else null."""
    g = F.upper(col(gender))
    return F.when(g.isin("M", "MALE"), "M").when(g.isin("F", "FEMALE"), "F")


def _let(value: Column, f) -> Column:
    """f(value) with the value computed once: long formulas stay small enough to compile."""
    return F.transform(F.array(value), f)[0]


def _poly(x: Column, coefficients) -> Column:
    out = F.lit(float(coefficients[0]))
    for c in coefficients[1:]:
        out = out * x + F.lit(float(c))
    return out


def points(total, body_weight, gender, digits: int = 2) -> Column:
    """FN-6: total times the curve of the sex; 0 without a total, body weight or known sex."""
    t, b = col(total).cast("double"), col(body_weight).cast("double") / 100
    curve = lambda s, a, m, p: F.round(t * s / (F.lit(a) - F.lit(m) * F.power(b, F.lit(-2.0)) + F.lit(p) * F.power(b, F.lit(2.0))), digits)
    known = (t > 0) & (b > 0)
    return F.when(known & (sex(gender) == "M"), curve(*CURVE["M"])).when(known & (sex(gender) == "F"), curve(*CURVE["F"])).otherwise(0.0)


def age_factor(age, gender) -> Column:
    """FN-10: 1 under 30 or for an unknown age or sex, else by the table."""
    look = lambda values: F.element_at(F.array(*map(F.lit, values)), F.least(col(age) - 29, F.lit(len(values))).cast("int"))
    return F.when(col(age).isNull() | (col(age) < 30), 1.0).when(sex(gender) == "F", look(WOMEN_FROM_30)).when(sex(gender) == "M", look(MEN_FROM_30)).otherwise(1.0)


def is_master(gender, age) -> Column:
    """FN-9: men of 31 to 75, women of 31 to 110."""
    return F.coalesce(((col(gender) == "M") & col(age).between(31, 75)) | ((col(gender) == "F") & col(age).between(31, 110)), F.lit(False))


def national_points(total, body_weight, gender, age, youth_factor=None) -> list[Column]:
    """FN-7: three columns of which one at most is set: open 21-30, youth 10-20 (the *total* times the youth factor), masters."""
    q = points(total, body_weight, gender)
    valid = (col(total) > 0) & (col(body_weight) > 0) & sex(gender).isNotNull()
    # products of values with few digits are exact decimals, so that halves round the same way everywhere
    exact = lambda value, factor: F.round(value.cast("decimal(14,3)") * factor.cast("decimal(8,4)"), 2).cast("double")
    youth = F.lit(1.0) if youth_factor is None else col(youth_factor)
    return [
        F.when(valid & col(age).between(21, 30), q).alias("qpoints"),
        F.when(valid & col(age).between(10, 20), exact(col(total), youth)).alias("q_youth"),
        F.when(valid & is_master(gender, age), exact(q, age_factor(age, gender))).alias("q_masters"),
    ]


def international_points(total, body_weight, gender, age, multiplier=None) -> list[Column]:
    """FN-8: three decimals, no age factor for masters, the youth multiplier if there is one."""
    q = points(total, body_weight, gender, 3)
    valid = (col(total) > 0) & (col(body_weight) > 0)
    strict = col(gender).isin("M", "F")
    youth = q if multiplier is None else F.round(q * F.coalesce(col(multiplier), F.lit(1.0)), 3)
    return [
        F.when(valid & strict & col(age).between(21, 30), q).alias("qpoints"),
        F.when(valid & strict & col(age).between(10, 20), youth).alias("q_youth"),
        F.when(valid & is_master(gender, age), q).alias("q_masters"),
    ]


def with_youth_factor(df: DataFrame, factors: DataFrame, age="age", body_weight="body_weight_kg", gender="gender", out: str = "youth_factor") -> DataFrame:
    """FN-11, 12: the factor of (gender, age, body weight) between whole kilograms, linear, to 4 digits; 1 outside ages 8-20
    or without a factor. ``factors``: gender, bodyweight_kg, age, factor; it has a row for each kilogram and age, a fixed few
    thousand at most, and is broadcast."""
    weight = F.greatest(F.lit(30.0), F.least(F.lit(115.0), col(body_weight).cast("double")))
    keyed = df.withColumns({"__w": weight, "__lo": F.floor(weight).cast("int"), "__hi": F.ceil(weight).cast("int"), "__g": F.upper(F.substring(col(gender), 1, 1))})
    side = lambda name: F.broadcast(factors.select(F.col("gender").alias("__g"), F.col("bodyweight_kg").alias(f"__{name}"), F.col("age").alias("__a"), F.col("factor").alias(f"__f{name}")))
    keyed = keyed.withColumn("__a", col(age))
    joined = keyed.join(side("lo"), ["__g", "__lo", "__a"], "left").join(side("hi"), ["__g", "__hi", "__a"], "left")
    lo, hi = F.coalesce("__flo", F.lit(1.0)), F.coalesce("__fhi", F.lit(1.0))
    value = F.when(col(age).between(8, 20), F.round(lo + (F.col("__w") - F.col("__lo")) * (hi - lo), 4)).otherwise(1.0)
    return joined.withColumn(out, value).drop("__w", "__lo", "__hi", "__g", "__a", "__flo", "__fhi")


def erf(x) -> Column:
    """FN-13: within 1.5e-7 of the error function."""
    part = lambda x, a: _let(1 / (1 + F.lit(ERF_T) * a), lambda t: F.signum(x) * (1 - _poly(t, ERF) * t * F.exp(-a * a)))
    return _let(col(x).cast("double"), lambda x: part(x, F.abs(x)))


def norm_cdf(x) -> Column:
    """FN-14."""
    return 0.5 * (1 + erf(col(x) / F.lit(2.0**0.5)))


def norm_inv(p) -> Column:
    """FN-15: infinite at 0 and 1, null outside."""
    tail = lambda q: _let(F.sqrt(-2 * F.ln(q)), lambda t: _poly(t, INV_C) / _poly(t, INV_D))
    middle = lambda q: _let(q * q, lambda r: _poly(r, INV_A) * q / _poly(r, INV_B))
    return _let(
        col(p),
        lambda p: F.when((p < 0) | (p > 1), None).when(p == 0, float("-inf")).when(p == 1, float("inf"))
        .when(p < INV_LOW, tail(p)).when(p > 1 - INV_LOW, -tail(1 - p)).otherwise(middle(p - 0.5)),
    )


def distribution_score(q, mu, sigma, nu, base: float = 1000.0, scale: float = 100.0, low: float = 1e-20, high: float = 1 - 1e-15) -> Column:
    """FN-16: the place of q in a truncated Box-Cox normal distribution (mu, sigma, nu), as base + scale * z."""
    q, mu, sigma, nu = (col(c).cast("double") for c in (q, mu, sigma, nu))
    ratio = q / mu
    z = F.when(nu != 0, (F.power(ratio, nu) - 1) / (nu * sigma)).otherwise(F.ln(ratio) / sigma)
    edge = 1 / (sigma * F.abs(nu))
    cut = F.when(nu > 0, norm_cdf(-edge)).otherwise(0.0)
    room = F.when(nu != 0, norm_cdf(edge)).otherwise(1.0)
    p = F.greatest(F.lit(low), F.least(F.lit(high), (norm_cdf(z) - cut) / room))
    return F.when((q > 0) & (mu > 0) & (sigma > 0) & nu.isNotNull() & (room != 0), F.lit(base) + F.lit(scale) * norm_inv(p))


def with_distribution_scores(df: DataFrame, factors: dict[str, DataFrame], value="total", body_weight="body_weight_kg", gender="gender", age="age", ages: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """FN-17, 18: a column ``gamx_<name>`` for each table of factors, joined on gender (m or f), body weight to one decimal
    and, if the table has it, age. ``ages`` gives the ages that a name is scored for; an unknown age passes."""
    g = F.lower(F.substring(col(gender), 1, 1))
    keyed = df.withColumns({"__g": F.when(g == "w", "f").when(g.isin("m", "f"), g), "__b": F.round(col(body_weight), 1).cast("decimal(5,1)"), "__a": col(age)})
    for name, table in factors.items():
        on = ["__g", "__b"] + ["__a"] * ("age" in table.columns)
        small = table.select(F.col("gender").alias("__g"), F.col("bodyweight").cast("decimal(5,1)").alias("__b"), *[F.col("age").alias("__a")] * ("age" in table.columns), "mu", "sigma", "nu")
        keyed = keyed.join(small, on, "left")
        score = F.round(distribution_score(value, "mu", "sigma", "nu"), 2)
        if ages and name in ages:
            score = F.when(F.coalesce(col(age).between(*ages[name]), F.lit(True)), score)
        keyed = keyed.withColumn(f"gamx_{name}", score).drop("mu", "sigma", "nu")
    return keyed.drop("__g", "__b", "__a")


def recompute(df: DataFrame, name: str, value: Column, asked: Column) -> DataFrame:
    """FN-19: a stored score is computed again in the rows that are asked for (a condition, or what is not null); the others keep theirs."""
    return df.withColumn(name, F.when(asked.isNotNull(), value).otherwise(F.col(name)))


def age_factor_table(spark: SparkSession) -> DataFrame:
    rows = [("F", 30 + i, f) for i, f in enumerate(WOMEN_FROM_30)] + [("M", 30 + i, f) for i, f in enumerate(MEN_FROM_30)]
    return spark.createDataFrame(rows, "gender string, age int, factor double")
