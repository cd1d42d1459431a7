"""Files in and out: delimited text, scraped JSON, documents, GeoJSON. SURVEY SRC-*, SNK-8..11."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barpath.functions.text import shard
from barpath.session import scratch_dir


def delimited(spark: SparkSession, path: str, columns: Sequence[str], sep: str = "|", required: str | None = None) -> DataFrame:
    """SRC-2..4: all columns as trimmed text; rows without the required one are dropped."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = spark.read.schema(schema).csv(path, sep=sep, header=True, mode="PERMISSIVE", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    return rows.where(F.trim(required) != "") if required else rows


def repair_collapsed(df: DataFrame, line: str, columns: Sequence[str], sep: str = r"\|") -> DataFrame:
    """SRC-5: rows whose columns fell into one are split again, repeats dropped."""
    parts = F.split(line, sep)
    return df.select(*[F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(columns)]).distinct()


HISTORY = "array<struct<meet_name:string,date:string,body_weight_kg:string,best_snatch:string,best_cj:string,total:string>>"


def scrapes(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """SRC-6: a row for each competition of each athlete in scraped JSON files, each one document or one on each line."""
    schema = f"data array<struct<internal_id:int,athlete_name:string,competition_history:{HISTORY}>>"
    people = spark.read.schema(schema).json(path, multiLine=multi_line).select(F.explode("data").alias("p"))
    return people.select("p.internal_id", "p.athlete_name", F.explode("p.competition_history").alias("h")).select("internal_id", "athlete_name", "h.*")


def embedded_json(df: DataFrame, html: str, schema: str, attribute: str = "data-page") -> DataFrame:
    """SRC-8: JSON in an attribute of a page, its quotes as references."""
    raw = F.regexp_replace(F.regexp_extract(html, rf'{attribute}="([^"]*)"', 1), "&quot;", '"')
    return df.withColumn("page", F.from_json(F.regexp_replace(raw, "&amp;", "&"), schema))


def _rest(parts):
    """All parts of an array but the first."""
    return F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))


def result_blocks(df: DataFrame, html: str) -> DataFrame:
    """SRC-7: attempts of a result page: the weight class of the heading before, the kind of lift (snatch or cj) of the last
    paragraph that names one, the athlete id of the link, the year of birth, struck attempts negative."""
    b = df.select("*", F.explode(_rest(F.split(html, "<h3[^>]*>"))).alias("__b")).withColumn("weight_class", F.trim(F.regexp_extract("__b", "^([^<]*)<", 1)))
    # a block is cut where a paragraph names the kind of lift; what stands before the first has none
    marked = F.regexp_replace("__b", r"(?i)<p(?![^>]*normal__text)[^>]*>\s*(snatch|clean|[^<]*jerk)[^<]*</p>", "\u0001$1\u0002")
    parts = b.withColumn("__p", F.explode(F.split(marked, "\u0001")))
    name = F.lower(F.regexp_extract("__p", "^([^\u0002]*)\u0002", 1))
    parts = parts.withColumn("lift", F.when(name == "snatch", "snatch").when(name != "", "cj"))
    card = parts.select("*", F.explode(_rest(F.split("__p", 'class="card"'))).alias("__c")).drop("__b", "__p")
    struck = F.regexp_replace("__c", r"<strike>\s*(\d+)\s*</strike>", "<i>-$1</i>")
    attempts = F.transform(F.regexp_extract_all(struck, F.lit(r"<i>(-?\d+)</i>"), F.lit(1)), lambda x: x.cast("int"))
    born = F.regexp_extract("__c", r"Born:[^<]*?(\d{4})", 1).try_cast("int")
    return card.select(*[c for c in card.columns if c != "__c"], F.regexp_extract("__c", r"[?&]id=(\d+)", 1).try_cast("long").alias("athlete_id"), born.alias("birth_year"), attempts.alias("attempts"))


def sanction_cards(df: DataFrame, html: str) -> DataFrame:
    """SRC-9: a row for each card of a page with a name of three letters or more, and its position. Fields that a card lacks
    are empty; the nation is the titled one, else the first word of three capitals."""
    cards = df.select("*", F.posexplode(_rest(F.split(html, 'class="card"'))).alias("position", "__c")).drop(html)
    words = F.regexp_replace("__c", "<[^>]*>", " ")
    titled = F.trim(F.regexp_extract("__c", r'class="col-5"[^>]*>\s*<p class="title">([^<]*)<', 1))
    line = lambda label: F.trim(F.regexp_extract("__c", rf'<p class="normal__text">\s*{label}([^<]*)<', 1))
    out = cards.withColumns({
        "name": F.trim(F.regexp_extract("__c", "<strong>([^<]*)<", 1)),
        "nation": F.when(titled != "", titled).otherwise(F.regexp_extract(words, r"\b([A-Z]{3})\b", 1)),
        "since": line("From:"), "until": line("Until:"), "event": line(r"Event type\*:"), "substance": line("Substance/ADRV:"),
    })
    return out.where(F.length("name") > 2).drop("__c")


def feature_collection(df: DataFrame, x: str, y: str, properties: Sequence[str]) -> DataFrame:
    """GEO-20: a GeoJSON Feature for each row (a collection of them is their concatenation)."""
    geometry = F.struct(F.lit("Point").alias("type"), F.array(x, y).alias("coordinates"))
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*properties).alias("properties"))).alias("feature"))


def athlete_documents(results: DataFrame) -> DataFrame:
    """DQ-16, SNK-8: a JSON document for each athlete, all in one job, and the shard it is stored in."""
    rows = F.sort_array(F.collect_list(F.struct("date", "result_id", "meet_name", "total", "body_weight_kg")), asc=False)
    docs = results.groupBy("lifter_id").agg(rows.alias("results"), F.max("total").alias("best"), F.max_by("club_name", F.struct("date", "result_id")).alias("club"))
    return docs.select("lifter_id", F.to_json(F.struct("lifter_id", "best", "club", "results")).alias("document"), shard("lifter_id").alias("shard"))


def write_documents(docs: DataFrame, path: str) -> None:
    """SNK-8: compressed JSON lines in a folder for each shard."""
    docs.select("shard", F.col("document").alias("value")).write.partitionBy("shard").mode("overwrite").option("compression", "gzip").text(path)


def write_delimited(df: DataFrame, path: str, sep: str = "|") -> None:
    """SNK-9."""
    df.write.mode("append").csv(path, sep=sep, header=True, quote='"', escape='"')


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder in the place all executors share."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


_CACHED: dict[tuple, tuple[float, DataFrame]] = {}


def cached_for(seconds: float, key: tuple, make, clock=time.monotonic) -> DataFrame:
    """SRC-14: a small table that is made once and kept in memory for some time; after it, it is made anew and the old one is let go."""
    held = _CACHED.get(key)
    if held and clock() - held[0] < seconds and held[1].sparkSession.getActiveSession() is not None and not held[1].sparkSession.sparkContext._jsc.sc().isStopped():
        return held[1]
    if held:
        _CACHED.pop(key)
        if not held[1].sparkSession.sparkContext._jsc.sc().isStopped():
            held[1].unpersist()
    table = make().cache()
    _CACHED[key] = clock(), table
    return table
