"""Queries over files, scraped pages and resumed streams, and the older forms of derivations that differ from today's."""

from __future__ import annotations

import itertools

import pyarrow as pa
from pyspark.sql import functions as F

from barpath.functions import attempts
from barpath.operators import series, tables
from barpath.plans.registry import query
from barpath.plans.row_queries import _bounce_i
from barpath.sources import readers, sheets
from barpath.streaming import streams

# Files.

_NAMED = "SELECT CAST(result_id AS VARCHAR) AS result_id, lifter_name, CAST(total AS VARCHAR) AS total FROM results WHERE result_id % 6 <> 0"


@query("src_2_pipe_files", _NAMED)
def src_2(v):
    path = readers.fresh_path(v.spark, "pipes")
    blank = F.when(F.col("result_id") % 6 != 0, F.concat(F.lit("  "), "lifter_name"))
    readers.write_delimited(v.results.select("result_id", blank.alias("lifter_name"), "total"), path)
    return readers.delimited(v.spark, path, ["result_id", "lifter_name", "total"], required="lifter_name")


@query("src_3_comma_files", "SELECT result_id, club_name || ', \"' || wso || '\"' AS place, body_weight_kg FROM results")
def src_3(v):
    path = readers.fresh_path(v.spark, "commas")
    place = F.concat("club_name", F.lit(', "'), "wso", F.lit('"'))
    v.results.select("result_id", place.alias("place"), "body_weight_kg").write.csv(path, sep=",", header=True, quote='"', escape='"')
    return v.spark.read.schema("result_id long, place string, body_weight_kg double").csv(path, sep=",", header=True, quote='"', escape='"')


@query("src_4_any_separator", "SELECT CAST(meet_id AS VARCHAR) AS meet_id, meet_name FROM meets")
def src_4(v):
    path = readers.fresh_path(v.spark, "tabs")
    readers.write_delimited(v.meets.select("meet_id", "meet_name"), path, sep="\t")
    return readers.delimited(v.spark, path, ["meet_id", "meet_name"], sep="\t")


@query("src_6_scraped_json", "SELECT CAST(lifter_id AS INT) AS internal_id, lifter_name AS athlete_name, meet_name, date, CAST(total AS VARCHAR) AS total FROM results")
def src_6(v):
    path = readers.fresh_path(v.spark, "scrapes")
    history = F.array(F.struct("meet_name", "date", F.col("total").cast("string").alias("total"))).alias("competition_history")
    person = F.struct(F.col("lifter_id").cast("int").alias("internal_id"), F.col("lifter_name").alias("athlete_name"), history)
    v.results.select(F.array(person).alias("data")).write.json(path)
    return readers.scrapes(v.spark, path, multi_line=False).select("internal_id", "athlete_name", "meet_name", "date", "total")


@query("src_7_result_cards", """, t AS (SELECT result_id, lifter_id, weight_class, birth_year, 'snatch' AS lift, UNNEST([s1, s2, s3]) AS a FROM results UNION ALL SELECT result_id, lifter_id, weight_class, birth_year, 'cj', UNNEST([c1, c2, c3]) FROM results)
    SELECT result_id, weight_class, lift, lifter_id AS athlete_id, birth_year, CAST(COUNT(TRY_CAST(a AS INT)) AS INT) AS n, CAST(SUM(TRY_CAST(a AS INT)) AS BIGINT) AS total FROM t GROUP BY 1, 2, 3, 4, 5""")  # fmt: skip
def src_7(v):
    lift = lambda c: F.coalesce(F.regexp_replace(F.when(F.col(c).startswith("-") & (F.col(c) != "---"), F.concat(F.lit("<strike>"), F.substring(c, 2, 9), F.lit("</strike>"))).when(F.col(c) != "---", F.concat(F.lit("<i>"), c, F.lit("</i>"))), "^$", ""), F.lit("---"))
    born = F.coalesce(F.concat(F.lit('<p class="normal__text">Born: Jan 02, '), F.col("birth_year").cast("string"), F.lit("</p>")), F.lit(""))
    card = lambda k: F.concat(F.lit('<div class="card"><a href="/athlete/?a=1&id='), F.col("lifter_id").cast("string"), F.lit('">x</a>'), born, *[lift(f"{k}{i}") for i in (1, 2, 3)], F.lit("</div>"))
    html = F.concat(F.lit("<h3> "), "weight_class", F.lit(" </h3><p>Snatch</p>"), card("s"), F.lit("<p>Clean &amp; Jerk</p>"), card("c"))
    cards = readers.result_blocks(v.results.select("result_id", html.alias("html")), "html")
    total = F.when(F.size("attempts") > 0, F.aggregate("attempts", F.lit(0).cast("long"), lambda a, x: a + x))
    return cards.select("result_id", "weight_class", "lift", "athlete_id", "birth_year", F.size("attempts").alias("n"), total.alias("total"))


@query("src_9_sanction_cards", """, s AS (SELECT lifter_id, athlete_name AS name, CASE WHEN lifter_id % 2 = 0 THEN 'FRA' ELSE 'BRA' END AS nation, '01.02.' || CAST(2000 + lifter_id % 20 AS VARCHAR) AS since, 'S' || CAST(lifter_id % 4 AS VARCHAR) AS substance FROM lifters)
    SELECT name, MIN_BY(nation, lifter_id) AS nation, since, 'LIFE' AS until, substance, MIN(lifter_id) AS page FROM s GROUP BY name, since, substance""")  # fmt: skip
def src_9(v):
    line = lambda label, value: F.concat(F.lit(f'<p class="normal__text">{label} '), value, F.lit("</p>"))
    nation = F.when(F.col("lifter_id") % 2 == 0, "FRA").otherwise("BRA")
    titled = F.when(F.col("lifter_id") % 3 == 0, F.concat(F.lit("<div>"), nation, F.lit("</div>"))).otherwise(F.concat(F.lit('<div class="col-5"><p class="title"> '), nation, F.lit(" </p></div>")))
    since, substance = F.concat(F.lit("01.02."), (2000 + F.col("lifter_id") % 20).cast("string")), F.concat(F.lit("S"), (F.col("lifter_id") % 4).cast("string"))
    card = F.concat(F.lit('<div class="card"><p class="title"><strong> '), "athlete_name", F.lit(" </strong></p>"), titled, line("From:", since), line("Until:", F.lit("LIFE")), line("Substance/ADRV:", substance), F.lit("</div>"))
    pages = v.lifters.select(F.col("lifter_id").alias("page"), F.concat(card, F.lit('<div class="card"><strong>X</strong></div>'), card).alias("html"))
    cards = readers.sanction_cards(pages, "html")
    return tables.first_by(cards, ["name", "since", "substance"], ["page", "position"]).select("name", "nation", "since", "until", "substance", "page")


_SHEETS = """, f AS (SELECT result_id, CASE WHEN result_id % 3 = 0 THEN 'u' ELSE 's' END AS kind, lower(gender) AS gender, CASE WHEN result_id % 3 = 0 THEN age END AS age, CASE WHEN result_id % 7 <> 0 AND result_id % 11 <> 0 THEN body_weight_kg END AS bw, 120 + body_weight_kg AS mu, CASE WHEN result_id % 5 <> 0 THEN 0.25::DOUBLE END AS nu FROM results)
    SELECT kind, gender, age, bw AS bodyweight, mu, 0.3::DOUBLE AS sigma, nu FROM f WHERE bw IS NOT NULL"""  # fmt: skip


@query("src_11_factor_sheets", _SHEETS)
def src_11(v):
    """Factors in workbooks: one for a thousand result ids, four sheets each, of which two have ages. Some weights
    are missing, some are remarks, and some rows end early; the first row is a header."""
    k, low = F.col("result_id"), F.lower("gender")
    weight = F.when(k % 7 == 0, None).when(k % 11 == 0, "n/a").otherwise(F.col("body_weight_kg").cast("string"))
    rows = v.results.select(F.floor(k / 1000).alias("ids"), (k % 3 == 0).alias("aged"), low.alias("gender"), F.col("age").cast("int").alias("age"), weight.alias("weight"), (F.col("body_weight_kg") + 120).alias("mu"), F.when(k % 5 != 0, 0.25).alias("nu"))
    books = rows.repartition("ids").sortWithinPartitions("ids")

    def pages_of(own):
        for aged in (True, False):
            for sex in "mf":
                lines = [[r["age"]] * aged + [r["weight"] if r["weight"] in (None, "n/a") else float(r["weight"]), r["mu"], 0.3, r["nu"]] for r in own if r["aged"] == aged and r["gender"] == sex]
                yield f"params_{'u' if aged else 's'}_{sex}", [["age"] * aged + ["bmass", "mu", "sigma", "nu"]] + lines

    def write(it):
        """The rows of a book follow one another: a task holds those of one."""
        flat = (r for batch in it for part in range(0, batch.num_rows, 1000) for r in batch.slice(part, 1000).to_pylist())
        for at, own in itertools.groupby(flat, key=lambda r: r["ids"]):
            yield pa.RecordBatch.from_pydict({"path": [str(at)], "content": pa.array([sheets.workbook(dict(pages_of(list(own))))], pa.binary())})

    items = [(f"params_{kind}_{sex}", kind, sex, kind == "u") for kind in "us" for sex in "mf"]
    cells = sheets.cells_of(books.mapInArrow(write, "path string, content binary"), [i[0] for i in items])
    return sheets.factors(cells, items).withColumn("bodyweight", F.col("bodyweight").cast("double"))


@query("arr_2_split_parts", ", t AS (SELECT meet_id, string_split(CASE WHEN meet_id % 2 = 0 THEN meet_date || ' - ' || level ELSE meet_date END, ' - ') AS p FROM meets) SELECT meet_id, CAST(len(p) AS INT) AS n, p[1] AS first, p[2] AS second FROM t")
def arr_2(v):
    p = F.split(F.when(F.col("meet_id") % 2 == 0, F.concat_ws(" - ", "meet_date", "level")).otherwise(F.col("meet_date")), " - ")
    return v.meets.select("meet_id", F.size(p).alias("n"), F.get(p, F.lit(0)).alias("first"), F.get(p, F.lit(1)).alias("second"))


# Older forms.


@query("fn_3b_strict_bounce_backs", "SELECT result_id, " + ", ".join(f"{_bounce_i(p, c, True)} AS {c}" for p, c in (("s1", "s2"), ("s2", "s3"), ("c1", "c2"), ("c2", "c3"))) + " FROM results")
def fn_3b(v):
    pairs = (("s1", "s2"), ("s2", "s3"), ("c1", "c2"), ("c2", "c3"))
    return v.results.select("result_id", *[attempts.bounce_back_international(p, c, null_prev_is_miss=False).alias(c) for p, c in pairs])


@query("win_3b_legacy_ytd", r""", t AS (SELECT result_id, lifter_id, CASE WHEN result_id % 50 = 1 THEN 'TBD' WHEN result_id % 7 = 0 THEN SUBSTRING(date, 1, 4) || '-??' ELSE date END AS d, CASE WHEN result_id % 11 = 0 THEN NULL ELSE total END AS n FROM results),
    k AS (SELECT *, TRY_CAST(CASE WHEN regexp_matches(d, '^\d{4}-\d{2}-\d{2}$') THEN d END AS DATE) AS day, TRY_CAST(SUBSTRING(d, 1, 4) AS INT) AS y FROM t)
    SELECT a.result_id, GREATEST(COALESCE(MAX(b.n), 0), COALESCE(ANY_VALUE(a.n), 0), 0) AS ytd FROM k a LEFT JOIN k b ON b.lifter_id = a.lifter_id AND b.y = a.y AND (b.day IS NULL OR b.day <= COALESCE(a.day, make_date(a.y, 1, 1))) GROUP BY a.result_id""")  # fmt: skip
def win_3b(v):
    d = F.when(F.col("result_id") % 50 == 1, "TBD").when(F.col("result_id") % 7 == 0, F.concat(F.substring("date", 1, 4), F.lit("-??"))).otherwise(F.col("date"))
    total = F.when(F.col("result_id") % 11 == 0, "102.5").otherwise(F.col("total").cast("string"))
    return series.legacy_year_to_date(v.results.select("result_id", "lifter_id", d.alias("date"), total.alias("total")), "total", "ytd").select("result_id", "ytd")


# Streams.


@query("stm_4_rebuilt_documents", "SELECT user_id, COUNT(*) AS n, MAX(event_id) AS last FROM events GROUP BY 1")
def stm_4(v):
    path, events = readers.fresh_path(v.spark, "rebuilt"), f"{v.sf_dir}/events.parquet"
    document = lambda df: df.groupBy("user_id").agg(F.count("*").alias("n"), F.max("event_id").alias("last")).select("user_id", F.to_json(F.struct("n", "last")).alias("document"))
    streams.recompute_affected(streams.source(v.spark, events), ["user_id"], document, path).awaitTermination()
    return streams.latest(v.spark, path, ["user_id"]).select("user_id", F.from_json("document", "n long, last long").alias("d")).select("user_id", "d.*")


@query("stm_6_scheduled_months", ", e AS (SELECT event_type, user_id, CAST(date_trunc('month', ts) AS DATE) AS m FROM events), x AS (SELECT event_type, user_id, strftime(m + to_months(CAST(k AS INT)), '%Y-%m') AS month FROM e, (SELECT UNNEST([1, 2, 3]) AS k)) SELECT event_type, month, COUNT(DISTINCT user_id) AS users, COUNT(*) AS n FROM x GROUP BY 1, 2")
def stm_6(v):
    """At each run the windows of the three months before each month, of the event types that have new rows."""
    path, events = readers.fresh_path(v.spark, "months"), f"{v.sf_dir}/events.parquet"
    later = F.transform(F.array(*map(F.lit, (1, 2, 3))), lambda k: F.date_format(F.add_months(F.date_trunc("month", "ts"), k), "yyyy-MM"))
    rolling = lambda df: df.select("event_type", "user_id", F.explode(later).alias("month")).groupBy("event_type", "month").agg(F.count_distinct("user_id").alias("users"), F.count("*").alias("n"))
    streams.recompute_affected(streams.source(v.spark, events), ["event_type"], rolling, path).awaitTermination()
    return streams.latest(v.spark, path, ["event_type"])


@query("stm_8_resumed", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1")
def stm_8(v):
    path = readers.fresh_path(v.spark, "resumed")
    for _ in range(2):  # the second run resumes after the last file and adds nothing
        rows = streams.source(v.spark, f"{v.sf_dir}/events.parquet").select("event_id", "event_type")
        streams.append_to(rows, f"{path}/out", f"{path}/check").awaitTermination()
    return v.spark.read.parquet(f"{path}/out").groupBy("event_type").agg(F.count("*").alias("n"))
