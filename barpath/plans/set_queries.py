"""Queries over sets of rows: joins, aggregations, windows, sets and sorts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from barpath.functions import scoring, text
from barpath.operators import series, tables
from barpath.plans.binding import WITH
from barpath.plans.registry import ORACLE_SQL, query
from barpath.plans.row_queries import _DIV, _MASTER, _PREFIX, _curve  # noqa: F401
from barpath.session import materialise



#: What each column of results may be called in a source, and its type.
RESULT_COLUMNS = {
    "result_id": ("long", ["result_id", "db_result_id"]), "lifter_name": ("string", ["lifter_name"]), "competition_age": ("int", ["competition_age"]), "gender": ("string", ["gender"]), "total": ("string", ["total"]),
    "body_weight_kg": ("string", ["body_weight_kg"]), "q_youth": ("double", ["q_youth"]), "qpoints": ("double", ["qpoints"]), "q_masters": ("double", ["q_masters"]),
}


def n_rows():
    return F.count("*")


_YTD = "MAX(NULLIF(total, 0)) OVER (PARTITION BY lifter_id, SUBSTRING(date, 1, 4) ORDER BY date RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_RANK = "ROW_NUMBER() OVER (PARTITION BY meet_id, gender, weight_class ORDER BY {} DESC, body_weight_kg, result_id)"


@query("flagship_top3", f", r AS (SELECT result_id, meet_id, lifter_id, total, {_curve(2)} AS qpoints, {_YTD} AS ytd, {_PREFIX} AS p, UNNEST({_DIV}) AS d, weight_class, body_weight_kg FROM results WHERE age IS NOT NULL), k AS (SELECT *, p || d || ' ' || weight_class AS division, CAST(ROW_NUMBER() OVER (PARTITION BY meet_id, p, d, weight_class ORDER BY total DESC, body_weight_kg, result_id) AS INT) AS place FROM r) SELECT meet_id, division, place, result_id, lifter_id, total, qpoints, ytd FROM k WHERE place <= 3")
def flagship(v):
    from barpath.functions import divisions

    rows = v.results.where("age is not null").withColumn("qpoints", scoring.points("total", "body_weight_kg", "gender"))
    rows = series.year_to_date(rows, F.nullif("total", F.lit(0)), "ytd").withColumn("division", F.explode(divisions.eligible_divisions("gender", "age", "weight_class")))
    place = F.row_number().over(Window.partitionBy("meet_id", "division").orderBy(F.desc("total"), "body_weight_kg", "result_id"))
    return rows.withColumn("place", place).where("place <= 3").select("meet_id", "division", "place", "result_id", "lifter_id", "total", "qpoints", "ytd")


# Joins.


@query("join_1_star", "SELECT r.result_id, m.level, l.athlete_name FROM results r JOIN meets m ON m.meet_id = r.meet_id JOIN lifters l ON l.lifter_id = r.lifter_id")
def join_1(v):
    return v.results.join(v.meets, "meet_id").join(v.lifters, "lifter_id").select("result_id", "level", "athlete_name")


@query("join_2_completeness", "SELECT ROUND(100.0 * COUNT(r.result_id) / COUNT(*), 1)::DOUBLE AS pct, COUNT(*) AS n FROM lifters l LEFT JOIN (SELECT DISTINCT lifter_id, 1 AS result_id FROM results) r ON r.lifter_id = l.lifter_id")
def join_2(v):
    have = v.results.select("lifter_id", F.lit(1).alias("has")).distinct()
    return v.lifters.join(have, "lifter_id", "left").agg(F.round(100 * F.count("has") / n_rows(), 1).alias("pct"), n_rows().alias("n"))


@query("join_3_ghosts", "SELECT l.lifter_id FROM lifters l LEFT JOIN results r ON r.lifter_id = l.lifter_id WHERE r.result_id IS NULL")
def join_3(v):
    return v.lifters.join(v.results, "lifter_id", "left_anti").select("lifter_id")


@query("join_4_entries_five_way", "SELECT e.entry_id, l.meet_name, m.level, f.athlete_name, r.total FROM entries e JOIN listings l ON l.listing_id = e.listing_id JOIN meets m ON m.meet_id = l.meet_id JOIN lifters f ON CAST(f.lifter_id AS VARCHAR) = e.lifter_text JOIN results r ON r.lifter_id = f.lifter_id AND r.meet_id = m.meet_id AND r.result_id = e.entry_id")
def join_4(v):
    f = v.lifters.select("lifter_id", "athlete_name", F.col("lifter_id").cast("string").alias("lifter_text"))
    r = v.results.select("lifter_id", "meet_id", F.col("result_id").alias("entry_id"), "total")
    rows = v.entries.join(v.listings, "listing_id").join(v.meets.select("meet_id", "level"), "meet_id").join(f, "lifter_text")
    return rows.join(r, ["lifter_id", "meet_id", "entry_id"]).select("entry_id", "meet_name", "level", "athlete_name", "total")


@query("join_5_between_dates", ", c AS (SELECT l.listing_id, m.meet_id, ROW_NUMBER() OVER (PARTITION BY l.listing_id ORDER BY m.meet_date, m.meet_id) AS n FROM listings l JOIN meets m ON m.meet_name = l.meet_name AND m.meet_date BETWEEN l.start_date AND l.end_date) SELECT listing_id, meet_id FROM c WHERE n = 1")
def join_5(v):
    near = v.listings.drop("meet_id").join(v.meets, "meet_name").where(F.col("meet_date").between(F.col("start_date"), F.col("end_date")))
    return tables.first_by(near, ["listing_id"], ["meet_date", "meet_id"]).select("listing_id", "meet_id")


@query("join_6_name_and_year", "SELECT l.listing_id, m.meet_id FROM listings l JOIN meets m ON m.meet_name = l.meet_name AND regexp_extract(l.start_date, '[0-9]{4}') = SUBSTRING(m.meet_date, 1, 4)")
def join_6(v):
    left = v.listings.select("listing_id", "meet_name", F.regexp_extract("start_date", r"\d{4}", 0).alias("y"))
    return left.join(v.meets.withColumn("y", F.year(F.to_date("meet_date")).cast("string")), ["meet_name", "y"]).select("listing_id", "meet_id")


@query("join_7_exact_first", ", c AS (SELECT l.listing_id, m.meet_id, ROW_NUMBER() OVER (PARTITION BY l.listing_id ORDER BY m.meet_id) AS n FROM listings l JOIN meets m ON m.meet_name = l.meet_name AND m.meet_date = l.start_date WHERE l.meet_id IS NULL) SELECT listing_id, meet_id FROM c WHERE n = 1")
def join_7(v):
    left = v.listings.where("meet_id is null").select("listing_id", "meet_name", F.col("start_date").alias("meet_date"))
    return tables.first_by(left.join(v.meets, ["meet_name", "meet_date"]), ["listing_id"], ["meet_id"]).select("listing_id", "meet_id")


@query("join_8_near_days", "SELECT a.result_id, b.result_id AS other_id FROM results a JOIN results b ON a.lifter_id = b.lifter_id AND a.result_id < b.result_id AND abs(date_diff('day', CAST(a.date AS DATE), CAST(b.date AS DATE))) <= 5")
def join_8(v):
    a, b = v.results.select("lifter_id", "result_id", "date"), v.results.select("lifter_id", F.col("result_id").alias("other_id"), F.col("date").alias("d2"))
    return a.join(b, "lifter_id").where((F.col("result_id") < F.col("other_id")) & (text.day_gap("date", "d2") <= 5)).select("result_id", "other_id")


_TOKENS = "list_distinct(list_filter(string_split(regexp_replace(lower(meet_name || ' ' || level), '[^a-z0-9 ]', '', 'g'), ' '), lambda x: length(x) > 2 AND NOT regexp_matches(x, '^[0-9]+$')))"


@query("join_9_nearest_meet", f", t AS (SELECT meet_id, CAST(meet_date AS DATE) AS d, {_TOKENS} AS w FROM meets), c AS (SELECT a.meet_id, b.meet_id AS other, len(list_intersect(a.w, b.w)) AS shared FROM t a JOIN t b ON a.meet_id <> b.meet_id AND abs(date_diff('day', a.d, b.d)) <= 14 + 31), k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY meet_id ORDER BY shared DESC, other) AS n FROM c WHERE shared > 0) SELECT meet_id, other, CAST(shared AS BIGINT) AS shared FROM k WHERE n = 1")
def join_9(v):
    # the tables have one meet a month, so the reference's 14 days are 14 more than a month here
    return series.nearest_meet(v.meets, v.meets, 14 + 31).select("meet_id", "other", "shared")


@query("join_12_latest_result", ", c AS (SELECT lifter_id, result_id, club_name, ROW_NUMBER() OVER (PARTITION BY lifter_id ORDER BY date DESC, result_id) AS n FROM results WHERE club_name <> '') SELECT lifter_id, result_id, club_name FROM c WHERE n = 1")
def join_12(v):
    return tables.first_by(v.results.where("club_name <> ''"), ["lifter_id"], [F.desc("date"), "result_id"]).select("lifter_id", "result_id", "club_name")


@query("join_15_semi", "SELECT lifter_id FROM lifters WHERE lifter_id IN (SELECT lifter_id FROM results WHERE total > 250)")
def join_15(v):
    return v.lifters.join(v.results.where("total > 250"), "lifter_id", "left_semi").select("lifter_id")


@query("join_16_shared_membership", "SELECT result_id, EXISTS (SELECT 1 FROM results b WHERE b.membership_number = a.membership_number AND b.meet_id = a.meet_id AND b.lifter_id <> a.lifter_id) AS redundant FROM results a")
def join_16(v):
    # rows without a membership meet in no window
    w = Window.partitionBy("membership_number", "meet_id")
    known, none = (v.results.where(F.col("membership_number").isNull() == n).select("result_id", "lifter_id", "membership_number", "meet_id") for n in (False, True))
    many = known.select("result_id", (F.min("lifter_id").over(w) != F.max("lifter_id").over(w)).alias("redundant"))
    return many.unionByName(none.select("result_id", F.lit(False).alias("redundant")))


@query("join_17_scalar_count", "SELECT meet_id, (SELECT COUNT(*) FROM results r WHERE r.meet_id = m.meet_id AND r.total = 0) AS bombed FROM meets m")
def join_17(v):
    bombed = v.results.where("total = 0").groupBy("meet_id").agg(n_rows().alias("bombed"))
    return v.meets.select("meet_id").join(bombed, "meet_id", "left").na.fill(0, ["bombed"])


@query("join_18_unlinked", "SELECT lifter_id FROM lifters LEFT JOIN aliases ON a = lifter_id WHERE a IS NULL")
def join_18(v):
    return v.lifters.join(v.aliases.select(F.col("a").alias("lifter_id")), "lifter_id", "left_anti").select("lifter_id")


@query("join_20_overlaps", ", p AS (SELECT meet_name, listing_id, CAST(start_date AS DATE) AS s, CAST(end_date AS DATE) + CAST(listing_id % 3 * 1300 AS INT) AS e FROM listings) SELECT a.listing_id, b.listing_id AS other FROM p a JOIN p b ON a.meet_name = b.meet_name AND a.listing_id < b.listing_id AND a.s <= b.e AND b.s <= a.e")
def join_20(v):
    end = F.date_add(F.to_date("end_date"), (F.col("listing_id") % 3 * 1300).cast("int"))  # some periods are long
    side = lambda p: v.listings.select("meet_name", F.col("listing_id").alias(p), F.to_date("start_date").alias(p + "s"), end.alias(p + "e"))
    j = side("a").join(side("b"), "meet_name").where("a < b and as <= be and bs <= ae")
    return j.select(F.col("a").alias("listing_id"), F.col("b").alias("other"))


@query("join_21_band", ", h AS (SELECT result_id AS other, lifter_id, upper(trim(lifter_name)) AS nm, date, meet_name, body_weight_kg + (result_id % 5 - 2) AS bw, best_snatch, best_cj, CASE WHEN result_id % 6 = 0 THEN total + 1 ELSE total END AS total FROM results WHERE total > 0) SELECT r.result_id, MIN(h.other) AS other FROM results r JOIN h ON h.nm = upper(trim(r.lifter_name)) AND h.date = r.date AND h.meet_name = r.meet_name AND h.best_snatch = r.best_snatch AND h.best_cj = r.best_cj AND h.total = r.total AND abs(h.bw - r.body_weight_kg) <= 2.0 GROUP BY r.result_id, h.lifter_id")
def join_21(v):
    # scraped history of the same day, name and meet, its body weights and some totals a little off
    key = text.match_key("lifter_name").alias("nm")
    total = F.when(F.col("result_id") % 6 == 0, F.col("total") + 1).otherwise(F.col("total"))
    history = v.results.where("total > 0").select(F.col("result_id").alias("other"), F.col("lifter_id").alias("who"), key, "date", "meet_name", (F.col("body_weight_kg") + (F.col("result_id") % 5 - 2)).alias("bw"), "best_snatch", "best_cj", total.alias("total"))
    on = ["nm", "date", "meet_name", "best_snatch", "best_cj", "total"]
    j = v.results.select("result_id", "body_weight_kg", key, *on[1:]).join(history, on).where(F.abs(F.col("bw") - F.col("body_weight_kg")) <= 2.0)
    return j.groupBy("result_id", "who").agg(F.min("other").alias("other")).select("result_id", "other")


@query("join_22_normal_key", "SELECT r.result_id, m.meet_id IS NOT NULL AS kept FROM results r LEFT JOIN meets m ON regexp_replace(lower(r.meet_name || '_' || r.date), '[^a-z0-9]', '', 'g') = regexp_replace(lower(m.meet_name || '_' || m.meet_date), '[^a-z0-9]', '', 'g')")
def join_22(v):
    key = lambda *c: F.regexp_replace(F.lower(F.concat_ws("_", *c)), "[^a-z0-9]", "")
    m = v.meets.select(key("meet_name", "meet_date").alias("k"), F.lit(True).alias("kept"))
    return v.results.select("result_id", key("meet_name", "date").alias("k")).join(m, "k", "left").select("result_id", F.coalesce("kept", F.lit(False)).alias("kept"))


# Aggregations.


@query("agg_1_problem_names", "SELECT athlete_name, COUNT(DISTINCT lifter_id) AS n, COUNT(DISTINCT membership_number) AS members, string_agg(DISTINCT gender, ',' ORDER BY gender) AS genders FROM lifters GROUP BY athlete_name HAVING COUNT(DISTINCT lifter_id) > 1")
def agg_1(v):
    return v.lifters.groupBy("athlete_name").agg(F.count_distinct("lifter_id").alias("n"), F.count_distinct("membership_number").alias("members"), F.array_join(F.array_sort(F.collect_set("gender")), ",").alias("genders")).where("n > 1")


@query("agg_2_true_duplicates", "SELECT athlete_name FROM lifters GROUP BY athlete_name HAVING COUNT(DISTINCT lifter_id) > COUNT(DISTINCT membership_number)")
def agg_2(v):
    return v.lifters.groupBy("athlete_name").agg((F.count_distinct("lifter_id") > F.count_distinct("membership_number")).alias("x")).where("x").select("athlete_name")


@query("agg_3_long_careers", ", s AS (SELECT lifter_id, date_diff('year', MIN(CAST(date AS DATE)), MAX(CAST(date AS DATE))) - CASE WHEN strftime(MAX(CAST(date AS DATE)), '%m%d') < strftime(MIN(CAST(date AS DATE)), '%m%d') THEN 1 ELSE 0 END AS years FROM results GROUP BY lifter_id) SELECT lifter_id, CAST(years AS BIGINT) AS years FROM s WHERE years >= 5")
def agg_3(v):
    first, last = F.min(F.to_date("date")), F.max(F.to_date("date"))
    return v.results.groupBy("lifter_id").agg(text.whole_years(first, last).alias("years")).where("years >= 5")


@query("agg_4_top_volume", "SELECT lifter_id, COUNT(*) AS n FROM results GROUP BY lifter_id ORDER BY n DESC, lifter_id LIMIT 20")
def agg_4(v):
    return v.results.groupBy("lifter_id").agg(n_rows().alias("n")).orderBy(F.desc("n"), "lifter_id").limit(20)


@query("agg_5_minutes", "SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M') AS minute, COUNT(*) AS n, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS ids FROM events GROUP BY 1 HAVING COUNT(*) > 1")
def agg_5(v):
    minute = F.date_format(F.date_trunc("minute", "ts"), "yyyy-MM-dd HH:mm")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("event_id")), lambda x: x.cast("string")), ",")
    return v.table("events").groupBy(minute.alias("minute")).agg(n_rows().alias("n"), ids.alias("ids")).where("n > 1")


@query("agg_6_duplicate_meets", "SELECT meet_name, level, COUNT(DISTINCT meet_id) AS n FROM meets GROUP BY 1, 2 HAVING COUNT(DISTINCT meet_id) > 1")
def agg_6(v):
    return v.meets.groupBy("meet_name", "level").agg(F.count_distinct("meet_id").alias("n")).where("n > 1")


_SAME = "meet_id, meet_name, date, weight_class, body_weight_kg % 5, age % 10, total, s1, s2, s3, best_snatch, c1, c2, c3, best_cj, gender"


@query("agg_7_shared_performance", f", x AS (SELECT lifter_id AS who, * FROM results UNION ALL SELECT -lifter_id, * FROM results WHERE result_id % 10 = 0) SELECT meet_id, total, COUNT(DISTINCT who) AS lifters, string_agg(DISTINCT CAST(who AS VARCHAR), ', ' ORDER BY CAST(who AS VARCHAR)) AS ids FROM x WHERE total > 0 GROUP BY {_SAME} HAVING COUNT(DISTINCT who) > 1")
def agg_7(v):
    # every tenth result again under another athlete: sixteen columns tell them from one another
    rows = v.results.withColumn("who", F.col("lifter_id"))
    rows = rows.unionByName(v.results.where("result_id % 10 = 0").withColumn("who", -F.col("lifter_id"))).where("total > 0")
    keys = [F.expr(c.strip()).alias(f"k{i}") for i, c in enumerate(_SAME.split(","))]
    g = rows.select("who", *keys).groupBy(*[f"k{i}" for i in range(len(keys))]).agg(F.count_distinct("who").alias("lifters"), F.array_join(F.array_sort(F.collect_set(F.col("who").cast("string"))), ", ").alias("ids"))
    return g.where("lifters > 1").select(F.col("k0").alias("meet_id"), F.col("k6").alias("total"), "lifters", "ids")


@query("agg_8_completeness_by_year", "SELECT SUBSTRING(date, 1, 4) AS year, COUNT(*) AS n, ROUND(100.0 * (COUNT(*) - COUNT(birth_year)) / COUNT(*), 1)::DOUBLE AS missing_birth, ROUND(100.0 * (COUNT(*) - COUNT(membership_number)) / COUNT(*), 1)::DOUBLE AS missing_member FROM results GROUP BY 1")
def agg_8(v):
    gap = lambda c: F.round(100 * (n_rows() - F.count(c)) / n_rows(), 1)
    return v.results.groupBy(F.substring("date", 1, 4).alias("year")).agg(n_rows().alias("n"), gap("birth_year").alias("missing_birth"), gap("membership_number").alias("missing_member"))


@query("agg_9_problem_meets", "SELECT meet_id, COUNT(*) AS n FROM results GROUP BY meet_id HAVING COUNT(birth_year) < 0.94 * COUNT(*) OR SUM(CASE WHEN total = 0 THEN 1 ELSE 0 END) > 4 ORDER BY n DESC, meet_id LIMIT 25")
def agg_9(v):
    g = v.results.groupBy("meet_id").agg(n_rows().alias("n"), F.count("birth_year").alias("b"), F.count_if(F.col("total") == 0).alias("z"))
    return g.where("b < 0.94 * n or z > 4").orderBy(F.desc("n"), "meet_id").limit(25).select("meet_id", "n")


@query("agg_10_entry_accuracy", "SELECT listing_id, COUNT(*) AS n, ROUND(AVG(total - entry_total), 2) AS avg_diff, ROUND(100.0 * SUM(CASE WHEN total >= entry_total THEN 1 ELSE 0 END) / COUNT(*), 1)::DOUBLE AS pct_met FROM entries JOIN results ON result_id = entry_id WHERE total > 0 GROUP BY listing_id HAVING COUNT(*) >= 5")
def agg_10(v):
    rows = v.entries.join(v.results.where("total > 0").select(F.col("result_id").alias("entry_id"), "total"), "entry_id")
    met = F.round(100 * F.count_if(F.col("total") >= F.col("entry_total")) / n_rows(), 1)
    return rows.groupBy("listing_id").agg(n_rows().alias("n"), F.round(F.avg(F.col("total") - F.col("entry_total")), 2).alias("avg_diff"), met.alias("pct_met")).where("n >= 5")


@query("agg_11_progress", "SELECT 'results' AS part, COUNT(*) FILTER (total > 0) AS done, COUNT(*) AS n FROM results UNION ALL SELECT 'lifters', COUNT(*) FILTER (birth_year IS NOT NULL), COUNT(*) FROM lifters")
def agg_11(v):
    part = lambda df, name, when: df.agg(F.count_if(when).alias("done"), n_rows().alias("n")).select(F.lit(name).alias("part"), "done", "n")
    return part(v.results, "results", F.col("total") > 0).unionByName(part(v.lifters, "lifters", F.col("birth_year").isNotNull()))


@query("agg_12_active_and_ghost", ", n AS (SELECT lifter_id, COUNT(*) AS k FROM results GROUP BY 1) SELECT athlete_name, COUNT(DISTINCT CASE WHEN k > 0 THEN l.lifter_id END) AS active, COUNT(DISTINCT CASE WHEN k IS NULL THEN l.lifter_id END) AS ghosts, MAX(CASE WHEN k > 0 THEN k END) AS most FROM lifters l LEFT JOIN n ON n.lifter_id = l.lifter_id GROUP BY athlete_name HAVING COUNT(k) > 0 AND COUNT(*) > COUNT(k)")
def agg_12(v):
    k = v.results.groupBy("lifter_id").agg(n_rows().alias("k"))
    j = v.lifters.join(k, "lifter_id", "left").groupBy("athlete_name").agg(F.count_distinct(F.when(F.col("k") > 0, F.col("lifter_id"))).alias("active"), F.count_distinct(F.when(F.col("k").isNull(), F.col("lifter_id"))).alias("ghosts"), F.max("k").alias("most"))
    return j.where("active > 0 and ghosts > 0")


@query("agg_13_collisions_in_names", ", d AS (SELECT athlete_name FROM lifters GROUP BY 1 HAVING COUNT(*) > 1) SELECT lifter_name, meet_id, COUNT(*) AS n FROM results WHERE lifter_name IN (SELECT athlete_name FROM d) GROUP BY 1, 2 HAVING COUNT(DISTINCT lifter_id) > 1")
def agg_13(v):
    d = v.lifters.groupBy(F.col("athlete_name").alias("lifter_name")).count().where("count > 1")
    g = v.results.join(d, "lifter_name", "left_semi").groupBy("lifter_name", "meet_id").agg(n_rows().alias("n"), F.count_distinct("lifter_id").alias("k"))
    return g.where("k > 1").select("lifter_name", "meet_id", "n")


@query("agg_14_collisions_across_names", "SELECT meet_id, best_snatch, best_cj, string_agg(DISTINCT lifter_name, ',' ORDER BY lifter_name) AS names FROM results WHERE total > 0 GROUP BY 1, 2, 3 HAVING COUNT(DISTINCT lifter_name) > 1")
def agg_14(v):
    return v.results.where("total > 0").groupBy("meet_id", "best_snatch", "best_cj").agg(F.array_sort(F.collect_set("lifter_name")).alias("x")).where("size(x) > 1").select("meet_id", "best_snatch", "best_cj", F.array_join("x", ",").alias("names"))


@query("agg_15_membership_names", ", d AS (SELECT membership_number FROM lifters GROUP BY 1 HAVING COUNT(DISTINCT athlete_name) > 1) SELECT lifter_id, membership_number FROM lifters JOIN d USING (membership_number)")
def agg_15(v):
    d = v.lifters.groupBy("membership_number").agg(F.count_distinct("athlete_name").alias("k")).where("k > 1")
    return v.lifters.join(d, "membership_number", "left_semi").select("lifter_id", "membership_number")


@query("agg_16_meet_counts", "SELECT meet_id, COUNT(DISTINCT lifter_id) AS results FROM results GROUP BY meet_id")
def agg_16(v):
    return v.results.groupBy("meet_id").agg(F.count_distinct("lifter_id").alias("results"))


@query("agg_17_entry_counts", "SELECT l.listing_id, COUNT(e.entry_id) AS entry_count FROM listings l LEFT JOIN entries e ON e.listing_id = l.listing_id GROUP BY 1")
def agg_17(v):
    n = v.entries.groupBy("listing_id").agg(n_rows().alias("entry_count"))
    return v.listings.select("listing_id").join(n, "listing_id", "left").na.fill(0, ["entry_count"])


@query("agg_18_club_activity", "SELECT club_name, COUNT(DISTINCT meet_id) AS meets, COUNT(DISTINCT lifter_id) AS lifters, COUNT(*) AS participations, ROUND(COUNT(*)::DOUBLE / COUNT(DISTINCT lifter_id), 2) AS activity_factor FROM results WHERE date BETWEEN '1994-01-01' AND '1995-12-31' GROUP BY 1")
def agg_18(v):
    return series.activity(v.results, "club_name", "1994-01-01", "1995-12-31")


@query("agg_20_monthly", ", m AS (SELECT SUBSTRING(date, 1, 7) AS month, club_name, COUNT(DISTINCT lifter_id) AS k FROM results GROUP BY 1, 2) SELECT month, COUNT(DISTINCT club_name) AS clubs, ROUND(AVG(k), 1) AS avg_members, CAST(SUM(k) AS BIGINT) AS members, MAX(k) AS most FROM m GROUP BY month")
def agg_20(v):
    m = v.results.groupBy(F.substring("date", 1, 7).alias("month"), "club_name").agg(F.count_distinct("lifter_id").alias("k"))
    return m.groupBy("month").agg(F.count_distinct("club_name").alias("clubs"), F.round(F.avg("k"), 1).alias("avg_members"), F.sum("k").alias("members"), F.max("k").alias("most"))


@query("agg_21_top_clubs", ", m AS (SELECT SUBSTRING(date, 1, 7) AS month, club_name, COUNT(DISTINCT lifter_id) AS k FROM results GROUP BY 1, 2) SELECT club_name, MAX(k) AS peak, MAX(CASE WHEN month >= '1997-01' THEN k END) AS recent, ROUND(AVG(k), 2) AS average FROM m GROUP BY 1 HAVING MAX(k) >= 3 ORDER BY peak DESC, club_name LIMIT 30")
def agg_21(v):
    m = v.results.groupBy(F.substring("date", 1, 7).alias("month"), "club_name").agg(F.count_distinct("lifter_id").alias("k"))
    g = m.groupBy("club_name").agg(F.max("k").alias("peak"), F.max(F.when(F.col("month") >= "1997-01", F.col("k"))).alias("recent"), F.round(F.avg("k"), 2).alias("average"))
    return g.where("peak >= 3").orderBy(F.desc("peak"), "club_name").limit(30)


@query("agg_22_available_clubs", "SELECT club_name, COUNT(DISTINCT lifter_id) AS members FROM results WHERE date >= '1996-01-01' GROUP BY 1 HAVING COUNT(DISTINCT lifter_id) >= 5")
def agg_22(v):
    return v.results.where("date >= '1996-01-01'").groupBy("club_name").agg(F.count_distinct("lifter_id").alias("members")).where("members >= 5")


@query("agg_23_mode", ", c AS (SELECT club_name, wso, COUNT(*) AS n FROM results GROUP BY 1, 2), r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY club_name ORDER BY n DESC, wso) AS k FROM c) SELECT club_name, wso, n FROM r WHERE k = 1")
def agg_23(v):
    return tables.first_by(v.results.groupBy("club_name", "wso").agg(n_rows().alias("n")), ["club_name"], [F.desc("n"), "wso"])


_ATT = "CASE WHEN {0} NOT IN ('', '0', '---') THEN TRY_CAST({0} AS INT) END"


_SCORED = "SELECT results.*, qpoints, q_youth, q_masters, LAG(total) OVER (PARTITION BY lifter_id ORDER BY date, result_id) AS before, COALESCE(ABS(" + _ATT.format("s1") + "), 0) + COALESCE(ABS(" + _ATT.format("c1") + "), 0) AS opening FROM results JOIN (" + ORACLE_SQL["fn_7_national_points"].split(WITH)[1].split(") SELECT", 1)[0].replace(", q AS (", "WITH q AS (", 1) + ") SELECT" + ORACLE_SQL["fn_7_national_points"].split(WITH)[1].split(") SELECT", 1)[1] + ") USING (result_id)"


def _career_sql(least=12):
    a = {k: f"({_ATT.format(k)})" for k in ("s1", "s2", "s3", "c1", "c2", "c3")}
    add = lambda cs: "CAST(SUM(" + " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for c in cs) + ") AS BIGINT)"
    made, tried = (lambda ks: add([f"{a[k]} > 0" for k in ks])), (lambda ks: add([f"{a[k]} <> 0" for k in ks]))
    clutch = [f"{a[k + '1']} < 0 AND {a[k + '2']} < 0 AND {a[k + '3']} IS NOT NULL" for k in "sc"]
    bounce = [f"{a[k + '1']} < 0 AND {a[k + '2']} IS NOT NULL" for k in "sc"]
    s, c = ("s1", "s2", "s3"), ("c1", "c2", "c3")
    jumps = [f"CASE WHEN {a[k + str(i)]} <> 0 AND {a[k + str(i + 1)]} <> 0 THEN 100.0::DOUBLE * (ABS({a[k + str(i + 1)]}) - ABS({a[k + str(i)]})) / ABS({a[k + str(i)]}) END" for k in "sc" for i in (1, 2)]
    rate = lambda x, n: f"ROUND(100.0::DOUBLE * {x} / NULLIF({n}, 0), 4)"
    return f"""SELECT lifter_id, {tried(s + c)} AS attempts, {rate(made(s + c), tried(s + c))} AS success_rate, {rate(made(s), tried(s))} AS snatch_rate, {rate(made(c), tried(c))} AS cj_rate,
      {rate(add([f"{x} AND {a[k + '3']} > 0" for x, k in zip(clutch, "sc")]), add(clutch))} AS clutch_rate, {rate(add([f"{x} AND {a[k + '2']} > 0" for x, k in zip(bounce, "sc")]), add(bounce))} AS bounce_rate,
      CASE WHEN COUNT(NULLIF(total, 0)) >= 2 THEN ROUND(GREATEST(0.0::DOUBLE, 100 - 100 * stddev_pop(NULLIF(total, 0)) / AVG(NULLIF(total, 0))), 4) END AS consistency,
      ROUND(CASE WHEN COUNT(*) < 2 THEN 0 ELSE (COUNT(*) - 1)::DOUBLE / GREATEST(90, date_diff('day', MIN(CAST(date AS DATE)), MAX(CAST(date AS DATE)))) * 365.25 END, 4) AS frequency,
      {', '.join(f"{rate(add([f'{bounce[k]} AND {a[l + chr(50)]} > 0']), add([bounce[k]]))} AS {n}_bounce_rate" for k, l, n in ((0, 's', 'snatch'), (1, 'c', 'cj')))},
      ROUND(MAX(GREATEST(qpoints, q_youth, q_masters)), 4) AS q_score,
      ROUND(AVG(CASE WHEN before <> 0 AND opening > 0 THEN 100.0::DOUBLE * opening / before END), 4) AS opening_strategy,
      ROUND(({' + '.join(f'SUM(COALESCE({j}, 0))' for j in jumps)}) / NULLIF({' + '.join(f'COUNT({j})' for j in jumps)}, 0), 4) AS jump_percentage
      FROM ({_SCORED}) x GROUP BY lifter_id HAVING {tried(s + c)} >= {least}"""


_METRICS = ["success_rate", "snatch_rate", "cj_rate", "clutch_rate", "bounce_rate", "consistency", "frequency", "snatch_bounce_rate", "cj_bounce_rate", "q_score", "opening_strategy", "jump_percentage"]


@query("agg_24_careers", _career_sql(1))
def agg_24(v):
    """All metrics of a document: any attempt will do."""
    c = series.career(_scored(v), least=1)
    return c.select("lifter_id", "attempts", *[F.round(m, 4).alias(m) for m in _METRICS])


def _scored(v):
    return v.results.select("*", *scoring.national_points("total", "body_weight_kg", "gender", "age"))


_BUCKETED = "['all', CASE WHEN age < 13 THEN 'U13' END, CASE WHEN age BETWEEN 13 AND 17 THEN 'Youth' END, CASE WHEN age BETWEEN 15 AND 20 THEN 'Junior' END, CASE WHEN age >= 15 THEN 'Senior' END, CASE WHEN age >= 35 THEN 'Masters' END]"


@query("agg_25_distributions", ", k AS (" + _career_sql() + "), p AS (SELECT lifter_id, MAX(gender) AS gender, MAX(age) AS age FROM results GROUP BY 1), m AS (UNPIVOT (SELECT lifter_id, " + ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in _METRICS[:10]) + " FROM k) ON " + ", ".join(_METRICS[:10]) + " INTO NAME metric VALUE value), t AS (SELECT metric, value, UNNEST(list_filter(" + _BUCKETED + ", lambda x: x IS NOT NULL)) AS e, gender FROM m JOIN p ON p.lifter_id = m.lifter_id WHERE value IS NOT NULL) SELECT 'USAW_' || gender || '_' || e AS bucket, metric, COUNT(*) AS n, MIN(value) AS low, MAX(value) AS high, ROUND(SUM(value), 2) AS total FROM t GROUP BY 1, 2")
def agg_25(v):
    # of those with twelve attempts, every metric that is held against a population
    kept = _METRICS[:10]
    people = v.results.groupBy("lifter_id").agg(F.max("gender").alias("gender"), F.max("age").alias("age")).withColumn("source", F.lit("USAW"))
    k = series.career(_scored(v)).withColumns({m: F.round(m, 4) for m in kept})
    d = series.distributions(k, people, kept)
    return d.groupBy("bucket", "metric").agg(F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"), F.round(F.sum(F.col("value") * F.col("n")), 2).alias("total"))


@query("agg_26_quantile_maps", ", b AS (SELECT MIN(CAST(SUBSTRING(date, 1, 4) AS INT)) AS lo, MAX(CAST(SUBSTRING(date, 1, 4) AS INT)) AS hi FROM results), y AS (SELECT UNNEST(range(lo, hi + 1)) AS year FROM b), l AS (SELECT year, gender, list_sort(list(total)) AS v FROM y JOIN results ON CAST(SUBSTRING(date, 1, 4) AS INT) <= year WHERE total > 0 GROUP BY 1, 2), i AS (SELECT *, UNNEST(range(0, 101)) AS i FROM l) SELECT CAST(year AS INT) AS year, gender, CAST(i AS INT) AS i, v[LEAST(len(v), CAST(FLOOR((i / 100.0::DOUBLE) * len(v)) AS INT) + 1)] AS value FROM i")
def agg_26(v):
    # equal totals of a year are counted first, and the counts go to all later years of the data
    low, high = v.results.agg(F.min(F.year(F.to_date("date"))), F.max(F.year(F.to_date("date")))).first()
    own = v.results.where("total > 0").groupBy(F.year(F.to_date("date")).alias("y"), "gender", "total").agg(n_rows().alias("k"))
    later = own.select("gender", "total", "k", F.explode(F.sequence(F.col("y"), F.lit(high))).alias("year")) if low is not None else own.withColumn("year", F.col("y"))
    return series.quantile_points(later.groupBy("year", "gender", "total").agg(F.sum("k").alias("k")), ["year", "gender"], "total", "k")


_LEVEL = "CASE WHEN level = 'International' THEN 'international' WHEN level IN ('National', 'North American Open Series') THEN 'national' ELSE 'local' END"


@query("agg_27_medals", f", k AS (SELECT r.lifter_id, r.result_id, r.date, {_LEVEL} AS level, {_RANK.replace('meet_id', 'r.meet_id').format('best_snatch')} AS s, {_RANK.replace('meet_id', 'r.meet_id').format('best_cj')} AS c, {_RANK.replace('meet_id', 'r.meet_id').format('total')} AS t FROM results r JOIN meets m ON m.meet_id = r.meet_id), u AS (SELECT lifter_id, result_id, date, level, UNNEST([s, c, t]) AS place FROM k), p AS (SELECT * FROM u WHERE place <= 3), l AS (SELECT lifter_id, string_agg(DISTINCT date || ':' || CAST(result_id AS VARCHAR), ',' ORDER BY date || ':' || CAST(result_id AS VARCHAR) DESC) AS list FROM p GROUP BY 1) SELECT p.lifter_id, level, COUNT(*) FILTER (place = 1) AS gold, COUNT(*) FILTER (place = 2) AS silver, COUNT(*) FILTER (place = 3) AS bronze, MAX(list) AS list FROM p JOIN l ON l.lifter_id = p.lifter_id GROUP BY 1, 2")
def agg_27(v):
    ranked = series.division_ranks(v.results, ["meet_id", "gender", "weight_class"]).join(v.meets.select("meet_id", "level"), "meet_id")
    by_level, medals = series.medals(ranked.withColumn("level", F.expr(_LEVEL)), ["level"]), series.medal_list(ranked)
    return by_level.join(medals, "lifter_id").select("lifter_id", "level", "gold", "silver", "bronze", F.array_join(F.transform("medals", lambda m: F.concat_ws(":", m["date"], m["result_id"].cast("string"))), ",").alias("list"))


@query("agg_28_decades", "SELECT club_name, wso, COUNT(*) AS n, MIN(CAST(SUBSTRING(date, 1, 4) AS INT)) AS first, MAX(CAST(SUBSTRING(date, 1, 4) AS INT)) - MIN(CAST(SUBSTRING(date, 1, 4) AS INT)) AS span, COUNT(DISTINCT CAST(SUBSTRING(date, 1, 4) AS INT) // 10) AS decades FROM results GROUP BY 1, 2 HAVING COUNT(*) > 1 AND (span >= 3 OR COUNT(*) >= 5)")
def agg_28(v):
    y = F.year(F.to_date("date"))
    g = v.results.groupBy("club_name", "wso").agg(n_rows().alias("n"), F.min(y).alias("first"), (F.max(y) - F.min(y)).alias("span"), F.count_distinct(F.floor(y / 10)).alias("decades"))
    return g.where("n > 1 and (span >= 3 or n >= 5)")


@query("agg_29_missing_scores", "SELECT SUBSTRING(date, 1, 4) AS year, CASE WHEN age BETWEEN 10 AND 20 THEN 'youth' WHEN age BETWEEN 21 AND 30 THEN 'open' WHEN age > 30 THEN 'masters' ELSE 'unknown' END AS band, COUNT(*) AS n FROM results WHERE total > 0 GROUP BY 1, 2")
def agg_29(v):
    a = F.col("age")
    band = F.when(a.between(10, 20), "youth").when(a.between(21, 30), "open").when(a > 30, "masters").otherwise("unknown")
    return v.results.where("total > 0").groupBy(F.substring("date", 1, 4).alias("year"), band.alias("band")).agg(n_rows().alias("n"))


@query("agg_30_lifter_stats", "SELECT lifter_id, MIN(date) AS first, MAX(date) AS last, MAX(total) AS best, ROUND(AVG(NULLIF(total, 0)), 2) AS average, COUNT(DISTINCT meet_id) AS meets, arg_min(club_name, date || lpad(CAST(result_id AS VARCHAR), 12, '0')) AS first_club FROM results GROUP BY 1")
def agg_30(v):
    order = F.struct("date", "result_id")
    return v.results.groupBy("lifter_id").agg(F.min("date").alias("first"), F.max("date").alias("last"), F.max("total").alias("best"), F.round(F.avg(F.nullif("total", F.lit(0))), 2).alias("average"), F.count_distinct("meet_id").alias("meets"), F.min_by("club_name", order).alias("first_club"))


@query("agg_33_uniformity", ", c AS (SELECT club_name, COUNT(*) AS n FROM results GROUP BY 1) SELECT MIN(n) AS low, MAX(n) AS high, ROUND(AVG(n), 4) AS average, COUNT(*) FILTER (n < 0) AS negative FROM c")
def agg_33(v):
    return v.results.groupBy("club_name").agg(n_rows().alias("n")).agg(F.min("n").alias("low"), F.max("n").alias("high"), F.round(F.avg("n"), 4).alias("average"), F.count_if(F.col("n") < 0).alias("negative"))


_PRINT = ["lifter_name", "birth_year", "gender", "weight_class", "CAST(body_weight_kg AS INT)", "s1", "s2", "s3", "best_snatch", "c1", "c2", "c3", "best_cj", "total", "result_id % 4", "club_name", "age", "membership_number", "source", "wso"]
_MD5 = "md5(" + " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in _PRINT) + ")"


@query("agg_35_fingerprints", f", x AS (SELECT result_id AS id, meet_id AS meet, * FROM results UNION ALL SELECT -result_id, meet_id + 1, * FROM results WHERE result_id % 8 = 0), f AS (SELECT id, meet, {_MD5} AS k FROM x WHERE total > 0) SELECT id, MIN(id) OVER (PARTITION BY k) AS group_id FROM f WHERE k IN (SELECT k FROM f GROUP BY k HAVING COUNT(DISTINCT meet) > 1)")
def agg_35(v):
    # every eighth result again at the next meet; all twenty columns make the fingerprint
    k, meet = F.col("result_id"), F.col("meet_id")
    own = F.struct(k.alias("id"), meet.alias("meet"))
    again = F.when(k % 8 == 0, F.array(own, F.struct((-k).alias("id"), (meet + 1).alias("meet")))).otherwise(F.array(own))
    rows = v.results.where("total > 0").select(F.unhex(tables.fingerprint([F.expr(c) for c in _PRINT])).alias("k"), F.explode(again).alias("r"))
    f = materialise(rows.select("k", "r.id", "r.meet"), "fingerprints")  # read twice: made once
    g = f.groupBy("k").agg(F.min("id").alias("group_id"), F.min("meet").alias("a"), F.max("meet").alias("b")).where("a != b").select("k", "group_id")
    return f.join(g, "k").select("id", "group_id")


@query("agg_36_duplicate_events", "SELECT meet_name, COUNT(*) AS n, string_agg(CAST(meet_id AS VARCHAR), ',' ORDER BY meet_id) AS ids, MIN(meet_date) AS first, MAX(meet_date) AS last FROM meets GROUP BY 1 HAVING COUNT(*) > 1")
def agg_36(v):
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("meet_id")), lambda x: x.cast("string")), ",")
    return v.meets.groupBy("meet_name").agg(n_rows().alias("n"), ids.alias("ids"), F.min("meet_date").alias("first"), F.max("meet_date").alias("last")).where("n > 1")


@query("agg_37_counts_with_zero", "SELECT l.lifter_id, COUNT(r.result_id) AS n FROM lifters l LEFT JOIN results r ON r.lifter_id = l.lifter_id AND r.total > 250 GROUP BY 1")
def agg_37(v):
    return v.lifters.select("lifter_id").join(v.results.where("total > 250").select("lifter_id", "result_id"), "lifter_id", "left").groupBy("lifter_id").agg(F.count("result_id").alias("n"))


_LIFES = ", w AS (SELECT lifter_id, lifter_name, CASE WHEN lifter_id % 17 = 0 THEN NULL WHEN lifter_id % 23 = 0 AND result_id % 3 = 0 THEN birth_year + 1 ELSE birth_year END AS born, date, weight_class FROM results)"


@query("agg_38_birth_years", _LIFES + ", g AS (SELECT lifter_id, COUNT(DISTINCT born) AS years, string_agg(DISTINCT CAST(born AS VARCHAR), ', ' ORDER BY CAST(born AS VARCHAR)) AS births, COUNT(DISTINCT date) AS competitions, COUNT(DISTINCT weight_class) AS classes FROM w WHERE born IS NOT NULL GROUP BY 1 HAVING COUNT(DISTINCT born) > 1) SELECT 'several years of birth' AS issue, lifter_id, years, births, competitions, classes, NULL::BIGINT AS n FROM g UNION ALL SELECT 'all with several', NULL, NULL, NULL, NULL, NULL, COUNT(*) FROM g UNION ALL SELECT 'no internal id', NULL, NULL, NULL, NULL, NULL, COUNT(*) FROM lifters WHERE internal_id IS NULL UNION ALL SELECT 'nor year of birth', NULL, NULL, NULL, NULL, NULL, COUNT(*) FROM lifters WHERE internal_id IS NULL AND birth_year IS NULL")
def agg_38(v):
    k = F.col("lifter_id")
    born = F.when(k % 17 == 0, None).when((k % 23 == 0) & (F.col("result_id") % 3 == 0), F.col("birth_year") + 1).otherwise(F.col("birth_year"))
    w = v.results.withColumn("born", born).where("born is not null")
    g = w.groupBy("lifter_id").agg(F.count_distinct("born").alias("years"), F.array_join(F.array_sort(F.collect_set(F.col("born").cast("string"))), ", ").alias("births"), F.count_distinct("date").alias("competitions"), F.count_distinct("weight_class").alias("classes")).where("years > 1")
    summary = lambda df, issue: df.agg(n_rows().alias("n")).select(F.lit(issue).alias("issue"), "n")
    none = v.lifters.where("internal_id is null")
    out = g.select(F.lit("several years of birth").alias("issue"), "*")
    for df, issue in ((g, "all with several"), (none, "no internal id"), (none.where("birth_year is null"), "nor year of birth")):
        out = out.unionByName(summary(df, issue), allowMissingColumns=True)
    return out


@query("agg_39_misplaced", f", s AS (SELECT age, {_MASTER} AS m FROM results WHERE total > 0) SELECT CASE WHEN age <= 20 THEN 'youth' WHEN age <= 30 THEN 'open' ELSE 'older' END AS band, CASE WHEN m THEN 'masters' ELSE 'none' END AS kind, COUNT(*) AS n FROM s GROUP BY 1, 2")
def agg_39(v):
    a = F.col("age")
    band, kind = F.when(a <= 20, "youth").when(a <= 30, "open").otherwise("older"), F.when(scoring.is_master("gender", "age"), "masters").otherwise("none")
    return v.results.where("total > 0").groupBy(band.alias("band"), kind.alias("kind")).agg(n_rows().alias("n"))


_SIDES_40 = """, a AS (SELECT result_id AS db_result_id, lifter_name, age AS competition_age, gender, CAST(total AS VARCHAR) AS total, body_weight_kg, CASE WHEN result_id % 10 < 8 THEN qpoints ELSE total END AS qpoints, q_youth FROM results JOIN q7 USING (result_id) WHERE source = 'IWF'),
    b AS (SELECT result_id, lifter_name, age AS competition_age, gender, total, CAST(body_weight_kg AS VARCHAR) AS body_weight_kg, qpoints, CASE WHEN result_id % 10 < 9 THEN q_youth END AS q_youth, CASE WHEN result_id % 10 < 7 THEN q_masters ELSE 1.0 END AS q_masters FROM results JOIN q7 USING (result_id) WHERE source = 'USAW'),
    x AS (SELECT db_result_id AS result_id, lifter_name, competition_age AS age, gender, total, CAST(body_weight_kg AS VARCHAR) AS bw, q_youth, qpoints, NULL::DOUBLE AS q_masters FROM a UNION ALL SELECT result_id, lifter_name, competition_age, gender, CAST(total AS VARCHAR), body_weight_kg, q_youth, qpoints, q_masters FROM b),
    y AS (SELECT *, TRY_CAST(total AS DOUBLE) > 0 AND TRY_CAST(bw AS DOUBLE) > 0 AND gender IS NOT NULL AS whole, COALESCE((gender = 'M' AND age BETWEEN 31 AND 75) OR (gender = 'F' AND age BETWEEN 31 AND 110), FALSE) AS master FROM x)"""
_Q7 = ", q7 AS (" + ORACLE_SQL["fn_7_national_points"].split(WITH)[1].replace(", q AS (", "WITH q AS (", 1) + ")"
_CHECKS = {
    "q_youth outside 10 to 20": "q_youth IS NOT NULL AND (age < 10 OR age > 20 OR age IS NULL)", "qpoints outside 21 to 30": "qpoints IS NOT NULL AND (age < 21 OR age > 30 OR age IS NULL)", "q_masters of no master": "q_masters IS NOT NULL AND NOT master",
    "q_youth missing": "age BETWEEN 10 AND 20 AND q_youth IS NULL AND whole", "qpoints missing": "age BETWEEN 21 AND 30 AND qpoints IS NULL AND whole", "q_masters missing": "master AND q_masters IS NULL AND whole",
    "several scores": "(CASE WHEN q_youth IS NULL THEN 0 ELSE 1 END + CASE WHEN qpoints IS NULL THEN 0 ELSE 1 END + CASE WHEN q_masters IS NULL THEN 0 ELSE 1 END) > 1", "no result id": "result_id IS NULL",
}


@query("agg_40_checks", _Q7 + _SIDES_40 + " " + " UNION ALL ".join(f"SELECT '{n}' AS issue, COUNT(*) AS n, CASE WHEN COUNT(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM y WHERE {c}" for n, c in _CHECKS.items()))
def agg_40(v):
    """Two tables of one kind of results with other columns and types, some of their scores spoilt, under one schema."""
    k = F.col("result_id")
    rows = _scored(v).withColumn("competition_age", F.col("age"))
    a = rows.where("source = 'IWF'").select(k.alias("db_result_id"), "lifter_name", "competition_age", "gender", F.col("total").cast("string").alias("total"), "body_weight_kg", F.when(k % 10 < 8, F.col("qpoints")).otherwise(F.col("total")).alias("qpoints"), "q_youth")
    b = rows.where("source = 'USAW'").select(k, "lifter_name", "competition_age", "gender", "total", F.col("body_weight_kg").cast("string").alias("body_weight_kg"), "qpoints", F.when(k % 10 < 9, F.col("q_youth")).alias("q_youth"), F.when(k % 10 < 7, F.col("q_masters")).otherwise(1.0).alias("q_masters"))
    both = tables.harmonised([a, b], RESULT_COLUMNS)
    number = lambda c: F.col(c).try_cast("double")
    both = both.select("*", F.col("competition_age").alias("age"), ((number("total") > 0) & (number("body_weight_kg") > 0) & F.col("gender").isNotNull()).alias("whole"), scoring.is_master("gender", "competition_age").alias("master"))
    return tables.checks(both, _CHECKS)


@query("agg_41_date_formats", ", t AS (SELECT CASE result_id % 5 WHEN 0 THEN 'us' WHEN 1 THEN 'iso' WHEN 2 THEN 'long' WHEN 3 THEN 'range' ELSE 'other' END AS format FROM results) SELECT format, COUNT(*) AS n FROM t GROUP BY 1")
def agg_41(v):
    d, m = F.to_date("date"), F.col("result_id") % 5
    t = F.when(m == 0, F.date_format(d, "M/d/yyyy")).when(m == 1, F.col("date")).when(m == 2, F.date_format(d, "MMMM d'th' yyyy")).when(m == 3, F.concat_ws(" - ", "date", "date")).otherwise("soon")
    return v.results.groupBy(text.date_format_class(t).alias("format")).agg(n_rows().alias("n"))


@query("agg_42_coverage", ", m AS (SELECT level, meet_id % 4 <> 0 AS has, CASE WHEN meet_id % 4 <> 0 OR meet_id % 12 = 0 THEN 1 END AS assigned FROM meets) SELECT COALESCE(level, 'overall') AS part, COUNT(*) AS n, ROUND(100.0 * COUNT(*) FILTER (has) / COUNT(*), 1)::DOUBLE AS pct, ROUND(100.0 * COUNT(*) FILTER (NOT has AND assigned = 1) / NULLIF(COUNT(*) FILTER (NOT has), 0), 1)::DOUBLE AS failed_assigned FROM m GROUP BY ROLLUP (level)")
def agg_42(v):
    k = F.col("meet_id")
    m = v.meets.select("level", (k % 4 != 0).alias("has"), ((k % 4 != 0) | (k % 12 == 0)).alias("assigned"))
    failed = F.round(100 * F.count_if(~F.col("has") & F.col("assigned")) / F.nullif(F.count_if(~F.col("has")), F.lit(0)), 1)
    g = m.rollup("level").agg(n_rows().alias("n"), F.round(100 * F.count_if("has") / n_rows(), 1).alias("pct"), failed.alias("failed_assigned"))
    return g.select(F.coalesce("level", F.lit("overall")).alias("part"), "n", "pct", "failed_assigned")


@query("agg_43_matrix", ", s AS (SELECT club_name, SUBSTRING(date, 1, 4) AS y, COUNT(*) AS n FROM results WHERE total > 200 GROUP BY 1, 2), g AS (SELECT c.club_name, p.y, COALESCE(s.n, 0) AS n FROM (SELECT DISTINCT club_name FROM results) c CROSS JOIN (SELECT DISTINCT SUBSTRING(date, 1, 4) AS y FROM results) p LEFT JOIN s ON s.club_name = c.club_name AND s.y = p.y) SELECT COUNT(DISTINCT club_name) AS clubs, COUNT(DISTINCT y) AS periods, COUNT(*) AS n, COUNT(DISTINCT club_name) * COUNT(DISTINCT y) = COUNT(*) AS complete, ROUND(100.0 * COUNT(*) FILTER (n = 0) / COUNT(*), 2)::DOUBLE AS zero_share FROM g")
def agg_43(v):
    low, high = v.results.agg(F.min(F.substring("date", 1, 4).cast("int")), F.max(F.substring("date", 1, 4).cast("int"))).first()
    years = F.sequence(F.lit(low or 0), F.lit(high or 0)).cast("array<string>")
    s = v.results.where("total > 200").groupBy("club_name", F.substring("date", 1, 4).alias("y")).agg(n_rows().alias("n"))
    grid = v.results.select("club_name").distinct().select("club_name", F.explode(years).alias("y")).join(s, ["club_name", "y"], "left").na.fill(0, ["n"])
    g = grid.agg(F.count_distinct("club_name").alias("clubs"), F.count_distinct("y").alias("periods"), n_rows().alias("k"), F.count_if(F.col("n") == 0).alias("zero"))
    return g.select("clubs", "periods", F.col("k").alias("n"), (F.col("clubs") * F.col("periods") == F.col("k")).alias("complete"), F.round(100 * F.col("zero") / F.col("k"), 2).alias("zero_share"))


@query("agg_45_duplicate_names", ", k AS (SELECT lifter_id, club_name, wso FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY lifter_id ORDER BY date DESC, result_id DESC) AS r FROM results) WHERE r = 1) SELECT athlete_name, COUNT(*) AS n, COUNT(DISTINCT membership_number) AS members, COUNT(DISTINCT club_name) AS clubs, COUNT(DISTINCT wso) AS regions, string_agg(CAST(l.lifter_id AS VARCHAR), ',' ORDER BY l.lifter_id) AS ids FROM lifters l LEFT JOIN k ON k.lifter_id = l.lifter_id GROUP BY 1 HAVING COUNT(*) > 1")
def agg_45(v):
    latest = tables.first_by(v.results, ["lifter_id"], [F.desc("date"), F.desc("result_id")]).select("lifter_id", "club_name", "wso")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("lifter_id")), lambda x: x.cast("string")), ",")
    many = lambda c, name: F.count_distinct(c).alias(name)
    g = v.lifters.join(latest, "lifter_id", "left").groupBy("athlete_name")
    return g.agg(n_rows().alias("n"), many("membership_number", "members"), many("club_name", "clubs"), many("wso", "regions"), ids.alias("ids")).where("n > 1")


@query("agg_volume_lineitem", "SELECT l_returnflag, l_linestatus, COUNT(*) AS n, ROUND(SUM(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem GROUP BY 1, 2")
def agg_volume(v):
    return v.table("lineitem").groupBy("l_returnflag", "l_linestatus").agg(n_rows().alias("n"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


# Windows.


@query("win_1_keep_best", ", k AS (SELECT result_id, ROW_NUMBER() OVER (PARTITION BY meet_id, lifter_id ORDER BY total DESC, result_id) AS n FROM results) SELECT result_id, CASE WHEN n = 1 THEN 'KEEP' ELSE 'DELETE' END AS action FROM k")
def win_1(v):
    return tables.labelled(v.results, ["meet_id", "lifter_id"], [F.desc_nulls_last("total"), "result_id"]).select("result_id", "action")


@query("win_2_ytd", f"SELECT result_id, {_YTD} AS ytd FROM results")
def win_2(v):
    return series.year_to_date(v.results, F.nullif("total", F.lit(0)), "ytd").select("result_id", "ytd")


@query("win_3_ytd_before", "SELECT a.result_id, (SELECT MAX(b.total) FROM results b WHERE b.lifter_id = a.lifter_id AND SUBSTRING(b.date, 1, 4) = SUBSTRING(a.date, 1, 4) AND b.date < a.date) AS ytd FROM results a")
def win_3(v):
    return series.year_to_date(v.results, F.col("total"), "ytd", strict=True).select("result_id", "ytd")


@query("win_4_rolling_members", ", s AS (SELECT CAST(UNNEST(generate_series(DATE '1993-01-01', DATE '1998-07-01', INTERVAL 6 MONTH)) AS DATE) AS snapshot), c AS (SELECT DISTINCT club_name FROM results) SELECT c.club_name, strftime(s.snapshot, '%Y-%m-%d') AS snapshot, COUNT(DISTINCT lifter_id) AS active_members, COUNT(DISTINCT meet_id) AS meets, COUNT(result_id) AS participations, CASE WHEN COUNT(DISTINCT lifter_id) > 0 THEN ROUND(COUNT(result_id)::DOUBLE / COUNT(DISTINCT lifter_id), 2) END AS activity_factor FROM c CROSS JOIN s LEFT JOIN results r ON r.club_name = c.club_name AND CAST(r.date AS DATE) >= s.snapshot - INTERVAL 12 MONTH AND CAST(r.date AS DATE) < s.snapshot GROUP BY 1, 2")
def win_4(v):
    return series.rolling_members(v.results, "1993-01-01", "1998-07-01").withColumn("snapshot", F.col("snapshot").cast("string"))


@query("win_5_division_ranks", f", k AS (SELECT result_id, CAST({_RANK.format('best_snatch')} AS INT) AS snatch_rank, CAST({_RANK.format('best_cj')} AS INT) AS cj_rank, CAST({_RANK.format('total')} AS INT) AS total_rank FROM results) SELECT * FROM k WHERE LEAST(snatch_rank, cj_rank, total_rank) <= 3")
def win_5(v):
    r = series.division_ranks(v.results, ["meet_id", "gender", "weight_class"])
    return r.where(F.least("snatch_rank", "cj_rank", "total_rank") <= 3).select("result_id", "snatch_rank", "cj_rank", "total_rank")


@query("win_6_previous_total", "SELECT result_id, LAG(total) OVER (PARTITION BY lifter_id ORDER BY date, result_id) AS previous FROM results")
def win_6(v):
    return v.results.select("result_id", F.lag("total").over(Window.partitionBy("lifter_id").orderBy("date", "result_id")).alias("previous"))


@query("win_7_percentile", ", t AS (SELECT result_id, weight_class, total FROM results WHERE total > 0), k AS (SELECT result_id, RANK() OVER (PARTITION BY weight_class ORDER BY total) - 1 AS below, COUNT(*) OVER (PARTITION BY weight_class, total) AS same, COUNT(*) OVER (PARTITION BY weight_class) AS n FROM t) SELECT result_id, ROUND(100 * (below + 0.5::DOUBLE * same) / n) AS percentile FROM k")
def win_7(v):
    rows = v.results.where("total > 0").select("result_id", "weight_class", "total")
    return series.with_percentile(rows, "total", ["weight_class"], "percentile").select("result_id", F.col("percentile").cast("double").alias("percentile"))


@query("win_8_map_percentile", ", l AS (SELECT list_sort(list(total)) AS v FROM results WHERE total > 0 AND gender = 'M'), p AS (SELECT list_transform(range(0, 101), lambda i: v[LEAST(len(v), CAST(FLOOR((i / 100.0::DOUBLE) * len(v)) AS INT) + 1)]) AS m FROM l) SELECT result_id, CAST(FLOOR(len(list_filter(m[1:100], lambda x: x < total)) + 0.5::DOUBLE * len(list_filter(m[1:100], lambda x: x = total)) + 0.5) AS BIGINT) AS percentile FROM results, p WHERE gender = 'M'")
def win_8(v):
    men = v.results.where("gender = 'M'")
    counts = men.where("total > 0").groupBy("gender", "total").agg(n_rows().alias("k"))
    points = series.quantile_points(counts, ["gender"], "total", "k")  # 101 rows
    m = points.groupBy("gender").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "value"))), lambda x: x["value"]).alias("m"))
    return men.join(F.broadcast(m), "gender").select("result_id", series.map_percentile(F.col("m"), F.col("total")).alias("percentile"))


@query("win_9_jumps", ", k AS (SELECT result_id, total - LAG(total) OVER (PARTITION BY lifter_id ORDER BY date, result_id) AS jump FROM results WHERE total > 0) SELECT result_id, jump FROM k WHERE abs(jump) > 50")
def win_9(v):
    jump = F.col("total") - F.lag("total").over(Window.partitionBy("lifter_id").orderBy("date", "result_id"))
    return v.results.where("total > 0").select("result_id", jump.alias("jump")).where("abs(jump) > 50")


@query("win_10_class_gap", ", c AS (SELECT DISTINCT lifter_id, CAST(regexp_extract(weight_class, '[0-9]+') AS INT) AS k FROM results), g AS (SELECT lifter_id, k - LAG(k) OVER (PARTITION BY lifter_id ORDER BY k) AS gap FROM c) SELECT lifter_id, MAX(gap) AS gap FROM g GROUP BY 1 HAVING MAX(gap) > 20")
def win_10(v):
    c = v.results.select("lifter_id", F.regexp_extract("weight_class", "[0-9]+", 0).cast("int").alias("k")).distinct()
    g = c.withColumn("gap", F.col("k") - F.lag("k").over(Window.partitionBy("lifter_id").orderBy("k")))
    return g.groupBy("lifter_id").agg(F.max("gap").alias("gap")).where("gap > 20")


_IDS = ", i AS (SELECT lifter_id FROM lifters WHERE lifter_id % 6 <> 0 AND NOT lifter_id BETWEEN 100 AND 140) "


@query("win_11_missing_ids", _IDS + ", g AS (SELECT lifter_id, LEAD(lifter_id) OVER (ORDER BY lifter_id) AS n FROM i) SELECT lifter_id + 1 AS first, n - 1 AS last, n - lifter_id - 1 AS missing FROM g WHERE n > lifter_id + 1")
def win_11(v):
    return series.id_gaps(v.lifters.where("lifter_id % 6 != 0 and not lifter_id between 100 and 140"), "lifter_id")


@query("win_12_order_rank", ", c AS (SELECT club_name, COUNT(DISTINCT lifter_id) AS members FROM results GROUP BY 1) SELECT club_name, members, CAST(ROW_NUMBER() OVER (ORDER BY members DESC, club_name) AS INT) AS place FROM c ORDER BY place LIMIT 15")
def win_12(v):
    top = v.results.groupBy("club_name").agg(F.count_distinct("lifter_id").alias("members")).orderBy(F.desc("members"), "club_name").limit(15)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("members"), "club_name")))


@query("win_13_last_known", ", k AS (SELECT lifter_id, arg_max(membership_number, date || lpad(CAST(result_id AS VARCHAR), 12, '0')) AS membership_number FROM results WHERE membership_number IS NOT NULL GROUP BY 1) SELECT DISTINCT r.lifter_id, k.membership_number FROM results r LEFT JOIN k ON k.lifter_id = r.lifter_id")
def win_13(v):
    known = F.struct("date", "result_id")
    return v.results.groupBy("lifter_id").agg(F.max_by("membership_number", F.when(F.col("membership_number").isNotNull(), known)).alias("membership_number"))


# Sets and sorts.


@query("set_1_union", "SELECT lifter_id FROM results WHERE total > 280 UNION SELECT lifter_id FROM lifters WHERE balance > 9000")
def set_1(v):
    return v.results.where("total > 280").select("lifter_id").union(v.lifters.where("balance > 9000").select("lifter_id")).distinct()


@query("set_3_difference", "SELECT result_id, meet_id, birth_year FROM results a WHERE NOT EXISTS (SELECT 1 FROM lifters b WHERE b.lifter_id = a.lifter_id AND b.birth_year IS NOT DISTINCT FROM a.birth_year AND b.balance > 0)")
def set_3(v):
    good = v.lifters.where("balance > 0")
    return tables.missing(v.results.select("result_id", "meet_id", "lifter_id", "birth_year"), good, ["lifter_id", "birth_year"]).select("result_id", "meet_id", "birth_year")


@query("set_4_distinct_on", ", k AS (SELECT lifter_name, result_id, wso, ROW_NUMBER() OVER (PARTITION BY lifter_name ORDER BY date DESC, result_id DESC) AS n FROM results) SELECT lifter_name, result_id, wso FROM k WHERE n = 1")
def set_4(v):
    return tables.first_by(v.results, ["lifter_name"], [F.desc("date"), F.desc("result_id")]).select("lifter_name", "result_id", "wso")


@query("set_5_missing_and_extra", "SELECT 'missing' AS kind, lower(athlete_name) AS name FROM lifters WHERE lower(athlete_name) NOT IN (SELECT lower(lifter_name) FROM results WHERE total > 270) GROUP BY 2")
def set_5(v):
    a, b = v.lifters.select(F.lower("athlete_name").alias("name")), v.results.where("total > 270").select(F.lower("lifter_name").alias("name"))
    return a.join(b, "name", "left_anti").distinct().select(F.lit("missing").alias("kind"), "name").unionByName(b.join(a, "name", "left_anti").distinct().select(F.lit("extra").alias("kind"), "name"))


@query("set_6_batch_duplicates", ", k AS (SELECT result_id, ROW_NUMBER() OVER (PARTITION BY lower(lifter_name), date, weight_class, total ORDER BY result_id) AS n FROM results) SELECT result_id FROM k WHERE n > 1")
def set_6(v):
    n = F.row_number().over(Window.partitionBy(F.lower("lifter_name"), "date", "weight_class", "total").orderBy("result_id"))
    return v.results.select("result_id", n.alias("n")).where("n > 1").select("result_id")


@query("srt_1_search_order", "SELECT lifter_id, athlete_name FROM lifters WHERE athlete_name LIKE '%12%' ORDER BY CASE WHEN athlete_name = 'Athlete 12' THEN 0 ELSE 1 END, athlete_name, lifter_id LIMIT 50")
def srt_1(v):
    return v.lifters.where(F.col("athlete_name").contains("12")).orderBy(F.when(F.col("athlete_name") == "Athlete 12", 0).otherwise(1), "athlete_name", "lifter_id").limit(50).select("lifter_id", "athlete_name")


@query("srt_3_top_results", "SELECT result_id, total FROM results ORDER BY total DESC, result_id LIMIT 25")
def srt_3(v):
    return v.results.select("result_id", "total").orderBy(F.desc("total"), "result_id").limit(25)


@query("srt_4_sorted_arrays", "SELECT lifter_id, string_agg(date || ':' || CAST(total AS VARCHAR), ',' ORDER BY date DESC, total DESC) AS history FROM results GROUP BY 1")
def srt_4(v):
    h = F.transform(F.sort_array(F.collect_list(F.struct("date", "total")), asc=False), lambda x: F.concat_ws(":", x["date"], x["total"].cast("string")))
    return v.results.groupBy("lifter_id").agg(F.array_join(h, ",").alias("history"))


@query("srt_5_pivot", "SELECT SUBSTRING(date, 1, 7) AS month, CASE WHEN COUNT(*) FILTER (gender = 'M') > 0 THEN COUNT(*) FILTER (gender = 'M') END AS men, CASE WHEN COUNT(*) FILTER (gender = 'F') > 0 THEN COUNT(*) FILTER (gender = 'F') END AS women FROM results GROUP BY 1")
def srt_5(v):
    p = v.results.groupBy(F.substring("date", 1, 7).alias("month")).pivot("gender", ["M", "F"]).agg(F.count("result_id"))
    return p.select("month", F.col("M").alias("men"), F.col("F").alias("women"))


@query("srt_6_club_series", "SELECT SUBSTRING(date, 1, 7) AS month, club_name, COUNT(DISTINCT lifter_id) AS members FROM results WHERE club_name IN ('BUILDING 1', 'MACHINERY 2', 'FURNITURE 3') AND date BETWEEN '1993-01-01' AND '1996-12-31' GROUP BY 1, 2")
def srt_6(v):
    rows = v.results.where(F.col("club_name").isin("BUILDING 1", "MACHINERY 2", "FURNITURE 3") & F.col("date").between("1993-01-01", "1996-12-31"))
    return rows.groupBy(F.substring("date", 1, 7).alias("month"), "club_name").agg(F.count_distinct("lifter_id").alias("members"))
