"""The sport relations as views over the test tables, in SQL that Spark and DuckDB both read. SURVEY §7.2."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession


def _attempt(k: int) -> str:
    n = f"(o_orderkey + {k})"
    size = f"(40 + (o_orderkey * {7 * k + 1}) % 120)"
    return f"CASE WHEN {n} % 37 = 0 THEN NULL WHEN {n} % 31 = 0 THEN '0' WHEN {n} % 29 = 0 THEN '---' WHEN {n} % 3 = 0 THEN '-' || CAST({size} AS STRING) ELSE CAST({size} AS STRING) END"


_LIFT = "GREATEST({})"
_INT = "TRY_CAST(NULLIF({}, '---') AS INT)"

VIEWS = {
    "attempts": f"""
        SELECT o_orderkey AS result_id, o_custkey AS lifter_id, CAST(CAST(o_orderdate AS DATE) AS STRING) AS date,
            CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INT) AS meet_id,
            CASE WHEN o_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
            CASE WHEN o_custkey % 17 = 0 THEN NULL ELSE CAST(1995 - (8 + o_custkey % 75) AS INT) END AS birth_year,
            CAST(400 + (o_orderkey * 7919) % 900 AS DOUBLE) / 10 AS body_weight_kg,
            {_attempt(1)} AS s1, {_attempt(2)} AS s2, {_attempt(3)} AS s3, {_attempt(4)} AS c1, {_attempt(5)} AS c2, {_attempt(6)} AS c3,
            c_mktsegment || ' ' || CAST(o_custkey % 40 AS STRING) AS club_name, n_name AS wso,
            'Athlete ' || CAST(o_custkey % 700 AS STRING) AS lifter_name,
            CASE WHEN o_custkey % 13 = 0 THEN NULL ELSE CAST(o_custkey % 1100 AS STRING) END AS membership_number,
            CASE WHEN o_orderkey % 3 = 0 THEN 'IWF' ELSE 'USAW' END AS source, CAST(o_orderdate AS TIMESTAMP) AS created_at
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "bests": f"""
        SELECT *, COALESCE({_LIFT.format(', '.join(_INT.format(f's{k}') for k in (1, 2, 3)))}, 0) AS best_snatch,
            COALESCE({_LIFT.format(', '.join(_INT.format(f'c{k}') for k in (1, 2, 3)))}, 0) AS best_cj
        FROM attempts""",
    "results": """
        SELECT *, CASE WHEN best_snatch > 0 AND best_cj > 0 THEN best_snatch + best_cj ELSE 0 END AS total,
            'Meet ' || CAST(meet_id % 40 AS STRING) AS meet_name,
            CAST(CAST(FLOOR(body_weight_kg / 10) AS INT) * 10 AS STRING) || 'kg' AS weight_class,
            CASE WHEN birth_year IS NULL THEN NULL ELSE CAST(SUBSTRING(date, 1, 4) AS INT) - birth_year END AS age
        FROM bests""",
    "meets": """
        SELECT meet_id, 'Meet ' || CAST(meet_id % 40 AS STRING) AS meet_name, MIN(date) AS meet_date,
            CASE WHEN meet_id % 5 = 1 THEN 'National' WHEN meet_id % 5 = 2 THEN 'International' WHEN meet_id % 5 = 4 THEN 'North American Open Series' ELSE 'Local' END AS level,
            CAST(200 + (meet_id * 37) % 300 AS DOUBLE) / 10 AS latitude, CAST((meet_id * 53) % 500 - 1200 AS DOUBLE) / 10 AS longitude
        FROM results GROUP BY meet_id""",
    "lifters": """
        SELECT c_custkey AS lifter_id, 'Athlete ' || CAST(c_custkey % 700 AS STRING) AS athlete_name,
            CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(c_custkey % 1100 AS STRING) END AS membership_number,
            CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey % 1300 END AS internal_id,
            CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
            CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(1995 - (8 + c_custkey % 75) AS INT) END AS birth_year, c_acctbal AS balance
        FROM customer
        UNION ALL SELECT -1 - c_custkey, 'Athlete ' || CAST(c_custkey % 700 AS STRING), CAST(c_custkey % 1100 AS STRING), NULL, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END, NULL, 0
        FROM customer WHERE c_custkey % 29 = 0""",
    "listings": """
        SELECT meet_id * 10 AS listing_id, meet_name, meet_date AS start_date, SUBSTRING(meet_date, 1, 8) || '28' AS end_date,
            CASE WHEN meet_id % 3 = 0 THEN NULL ELSE meet_id END AS meet_id FROM meets""",
    "entries": """
        SELECT result_id AS entry_id, meet_id * 10 AS listing_id, CAST(lifter_id AS STRING) AS lifter_text, CAST(total + lifter_id % 11 - 5 AS INT) AS entry_total
        FROM results""",
    "clubs": """
        SELECT club_name, MIN(wso) AS wso, CAST(200 + (COUNT(*) * 37) % 300 AS DOUBLE) / 10 AS latitude, CAST((COUNT(*) * 53) % 500 - 1200 AS DOUBLE) / 10 AS longitude
        FROM results GROUP BY club_name""",
    "regions": """
        SELECT n_name AS region, CAST(20 + 6 * (n_nationkey % 5) AS DOUBLE) AS min_y, CAST(26 + 6 * (n_nationkey % 5) AS DOUBLE) AS max_y,
            CAST(-120 + 10 * FLOOR(n_nationkey / 5) AS DOUBLE) AS min_x, CAST(-110 + 10 * FLOOR(n_nationkey / 5) AS DOUBLE) AS max_x
        FROM nation""",
    "aliases": """
        SELECT c_custkey AS a, c_custkey + 100 AS b FROM customer WHERE c_custkey % 10 = 3
        UNION ALL SELECT c_custkey, c_custkey + 7 FROM customer WHERE c_custkey % 50 = 5""",
}
TABLES = ("orders", "customer", "nation", "lineitem", "events", "documents", "pages")

#: The same views before a query in DuckDB.
WITH = "WITH " + ",\n".join(f"{name} AS ({' '.join(sql.split())})" for name, sql in VIEWS.items()) + "\n"


class Views:
    """The relations of one folder of test tables, made as they are asked for: ``Views(spark, folder).results``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _view(self, name: str) -> DataFrame:
        sql = VIEWS[name]
        words = set(sql.replace(",", " ").replace("(", " ").split())
        known = {n: self.table(n) for n in TABLES if n in words} | {n: getattr(self, n) for n in VIEWS if n in words and n != name}
        for n in known:
            sql = " ".join(f"{{{n}}}" if w == n else w for w in sql.split(" "))
            sql = sql.replace(f" {n})", f" {{{n}}})").replace(f" {n}\n", f" {{{n}}}\n")
        return self.spark.sql(sql, **known)


for _name in VIEWS:
    setattr(Views, _name, cached_property(lambda self, n=_name: self._view(n)))
    getattr(Views, _name).__set_name__(Views, _name)
