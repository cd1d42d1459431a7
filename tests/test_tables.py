"""Keyed tables, components, series, sources and streams; and every query against its SQL."""

import datetime
import decimal
import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from barpath.operators import series, tables
from barpath.operators.components import components
from barpath.plans import registry
from barpath.sources import readers
from barpath.streaming import streams
from barpath.streaming.keyed import KeyedTable


#: Where queries are held against their SQL: the smallest tables hide what needs many rows.
TABLES = "/root/testdata/sf0.01"


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, None)], "k int, v string")
    once = tables.upsert(old, new, ["k"])
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(once) == [(1, "a"), (2, "c"), (3, None)] == rows(tables.upsert(once, new, ["k"]))
    assert rows(tables.insert_ignore(old, new, ["k"])) == [(3, None)] and rows(tables.replace_by_key(old, new, ["k"])) == rows(once)
    assert {r.k: r.status for r in tables.changes(old, new, ["k"], ["v"]).collect()} == {1: "gone", 2: "updated", 3: "new"}
    assert rows(tables.audit(old, new, "k", "v")) == [(2, "b", "c")]


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_links(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(20)] + [(None, 3), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rolling_window_ends(spark):
    rows = [("c", 1, 1, "2020-01-01"), ("c", 2, 1, "2019-01-01"), ("c", 3, 1, "2018-12-31"), ("d", 4, 1, "2000-01-01")]
    df = spark.createDataFrame(rows, "club_name string, lifter_id int, meet_id int, date string")
    got = {(r.club_name, str(r.snapshot)): r.active_members for r in series.rolling_members(df, "2019-07-01", "2020-07-01").collect()}
    assert got[("c", "2020-01-01")] == 1 and got[("c", "2019-07-01")] == 2 and got[("c", "2020-07-01")] == 1 and got[("d", "2020-01-01")] == 0


def test_year_to_date_counts_the_same_day(spark):
    df = spark.createDataFrame([(1, 1, "2020-01-05", 100), (2, 1, "2020-01-05", 120), (3, 1, "2020-02-01", 90), (4, 1, "2021-01-01", 80), (5, 1, "2020-01-01", None)], "result_id int, lifter_id int, date string, total int")
    got = lambda **k: {r.result_id: r.y for r in series.year_to_date(df, F.col("total"), "y", **k).collect()}
    assert got() == {1: 120, 2: 120, 3: 120, 4: 80, 5: None} and got(strict=True) == {1: None, 2: None, 3: 120, 4: None, 5: None}


def test_files_go_round(spark, tmp_path):
    df = spark.createDataFrame([("1", "Meet | one"), ("2", None)], "id string, name string")
    readers.write_delimited(df, f"{tmp_path}/csv")
    assert sorted(r.id for r in readers.delimited(spark, f"{tmp_path}/csv", ["id", "name"]).collect()) == ["1", "2"]
    assert [r.id for r in readers.delimited(spark, f"{tmp_path}/csv", ["id", "name"], required="name").collect()] == ["1"]
    (tmp_path / "s.json").write_text('{"data": [{"internal_id": 7, "athlete_name": "A", "competition_history": [{"meet_name": "M", "date": "2020-01-01", "total": "100"}]}]}')
    assert readers.scrapes(spark, f"{tmp_path}/s.json").first().total == "100"
    page = spark.createDataFrame([('<h3 class="t">59kg</h3><div class="card"><a href="/x?id=12">n</a><i>50</i><strike>55</strike></div><h3>64kg</h3><div class="card"><i>70</i></div>',)], "html string")
    got = [(r.weight_class, r.athlete_id, r.attempts) for r in readers.result_blocks(page, "html").collect()]
    assert got == [("59kg", 12, [50, -55]), ("64kg", None, [70])]
    long = spark.createDataFrame([("<h3>x</h3><p>Snatch</p>" + '<div class="card"><i>1</i></div>' * 150_000 + "<h3>y</h3>" * 3,)], "html string")
    assert readers.result_blocks(long, "html").where("lift = 'snatch'").count() == 150_000


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.glob("data/batch=*/bucket=*/*.parquet")}


def test_a_batch_that_is_run_again_adds_nothing(spark, tmp_path):
    t = KeyedTable(spark, f"{tmp_path}/t", ["k"], 4)
    rows = lambda x: spark.createDataFrame(x, "k int, v string")
    t.replace(0, range(4), rows([(1, "a"), (2, "b"), (3, "c"), (None, "n")]))
    assert t.read(0) is None
    for value in ("x", "y"):  # batch 1 twice: the second time takes the place of the first
        new = rows([(1, value)])
        touched = t.touched(new)
        t.replace(1, touched, t.read(1, touched).where("k is distinct from 1").unionByName(new))
    got = lambda: sorted((r.k or 0, r.v) for r in t.read().collect())
    assert got() == [(0, "n"), (1, "y"), (2, "b"), (3, "c")]
    t.replace(2, t.touched(rows([(1, "")])), t.read(2, t.touched(rows([(1, "")]))).where("k is distinct from 1"))
    assert got() == [(0, "n"), (2, "b"), (3, "c")]
    with pytest.raises(ValueError, match="buckets"):
        KeyedTable(spark, f"{tmp_path}/t", ["k"], 8).read()


def test_a_batch_rewrites_only_its_buckets_and_old_versions_go(spark, tmp_path):
    t = KeyedTable(spark, f"{tmp_path}/t", ["k"])
    t.replace(0, range(t.buckets), spark.range(2000).select(F.col("id").alias("k"), F.lit(0).alias("v")))
    first = files(tmp_path / "t")
    assert len(first) >= t.buckets
    for n in range(1, 6):
        new = spark.range(10).select(F.col("id").alias("k"), F.lit(n).alias("v"))
        touched = t.touched(new)
        assert len(touched) <= 10
        t.replace(n, touched, tables.upsert(t.read(n, touched), new, ["k"]))
        now = files(tmp_path / "t")
        new_buckets = {int(p.split("bucket=")[1].split("/")[0]) for p in now if f"batch={n}/" in p}
        assert new_buckets == set(touched)
        assert {p: m for p, m in now.items() if "batch=0/" in p}.items() <= first.items()  # nothing else was written again
    assert t.commits() == [4, 5] and t.read().count() == 2000 and t.read().where("v = 5").count() == 10
    assert {p.split("/")[1] for p in files(tmp_path / "t")} == {"batch=0", "batch=4", "batch=5"}
    assert not any("batch=0/" in p and int(p.split("bucket=")[1].split("/")[0]) in touched for p in files(tmp_path / "t"))


def test_late_rows_recompute_their_keys(spark, tmp_path):
    facts, out = f"{tmp_path}/facts", f"{tmp_path}/out"
    rows = lambda x: spark.createDataFrame(x, "lifter_id int, date string, total int")
    ytd = lambda df: series.year_to_date(df, F.col("total"), "ytd")
    for new in ([(1, "2020-02-01", 90), (2, "2020-02-01", 50), (None, "2020-03-01", 7)], [(1, "2020-01-01", 95)], [(None, "2020-01-01", 9)]):
        rows(new).write.mode("append").parquet(facts)
        streams.recompute_affected(streams.source(spark, facts), ["lifter_id"], ytd, out).awaitTermination()
    got = sorted((r.lifter_id or 0, r.date, r.ytd) for r in streams.latest(spark, out, ["lifter_id"]).collect())
    assert got == [(0, "2020-01-01", 9), (0, "2020-03-01", 9), (1, "2020-01-01", 95), (1, "2020-02-01", 95), (2, "2020-02-01", 50)]


def test_a_replayed_batch_counts_once(spark, tmp_path):
    """The last batch's mark of completion is lost, as when the driver dies before it is written: the batch is run again."""
    facts, out = tmp_path / "facts", tmp_path / "out"
    count = lambda df: df.groupBy("k").agg(F.count("*").alias("n"))
    run = lambda: streams.recompute_affected(streams.source(spark, str(facts)), ["k"], count, str(out)).awaitTermination()
    for new in ([(1,), (2,)], [(1,), (3,)]):
        spark.createDataFrame(new, "k int").write.mode("append").parquet(str(facts))
        run()
    for p in (out / "checkpoint/commits").glob("*1*"):
        p.unlink()
    run()
    assert sorted(tuple(r) for r in streams.latest(spark, str(out), ["k"]).select("k", "n").collect()) == [(1, 2), (2, 1), (3, 1)]


def test_upserts_of_two_batches_and_their_feed(spark, tmp_path):
    facts, out = f"{tmp_path}/facts", f"{tmp_path}/out"
    for new in ([(1, 1, "a"), (2, 2, "x"), (1, 3, "b")], [(1, 4, "b"), (2, 5, "y"), (3, 6, "z")]):
        spark.createDataFrame(new, "k int, n int, v string").coalesce(1).write.mode("append").parquet(facts)
        streams.upsert_into(streams.source(spark, facts), out, ["k"], ["n"], ["v"]).awaitTermination()
    assert sorted((r.k, r.n, r.v) for r in streams.latest(spark, out, ["k"]).collect()) == [(1, 3, "b"), (2, 5, "y"), (3, 6, "z")]
    feed = sorted((r.batch, r.k, r.status) for r in spark.read.parquet(f"{out}/feed").collect())
    assert feed == [(0, 1, "new"), (0, 2, "new"), (1, 1, "unchanged"), (1, 2, "updated"), (1, 3, "new")]


def test_quantile_points_are_those_of_the_sorted_values(spark):
    rng = random.Random(2)
    values = [rng.randint(0, 30) for _ in range(257)]
    df = spark.createDataFrame([("g", v) for v in values], "g string, v int").groupBy("g", "v").agg(F.count("*").alias("k"))
    got = {r.i: r.value for r in series.quantile_points(df, ["g"], "v", "k").collect()}
    s = sorted(values)
    assert got == {i: s[min(len(s) - 1, math.floor(i / 100.0 * len(s)))] for i in range(101)}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TABLES}/{name}.parquet'")
    return con


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6) or 0.0
    return float(x) if isinstance(x, decimal.Decimal) else str(x) if isinstance(x, datetime.date) else x


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_against_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, TABLES)
    rows = sorted(repr([plain(r[c]) for c in sorted(df.columns)]) for r in df.collect())
    if name not in registry.ORACLE_SQL:
        assert rows
        return
    got = duck.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in got.description]
    assert sorted(names) == sorted(df.columns)
    assert rows == sorted(repr([plain(r[names.index(c)]) for c in sorted(names)]) for r in got.fetchall())


def test_plans_of_large_tables(spark, sf):
    """Pairs are compared without an array or a lambda for each; fingerprints are made once and read from where they are stored."""
    from barpath.plans import registry

    plan = lambda name: registry.QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan("dq_10_physics")
    assert "md5" not in plan("agg_35_fingerprints")


def test_batch_proximity_keeps_no_row_apart_after_the_join(spark):
    import random
    import re

    from barpath.operators import series

    rng = random.Random(5)
    rows = [(rng.choice("xyz"), rng.choice([None, *range(0, 400, 7), -30, -1])) for _ in range(60)]
    got = series.batch_proximity(spark.createDataFrame(rows, "e string, t long"), "e", "t", 10)
    near = lambda t, b: any(e == b and u is not None and abs(u - t) < 10 for e, u in rows)
    want = {(a, b): sum(e == a and t is not None and near(t, b) for e, t in rows) for a in "xyz" for b in "xyz" if a != b}
    assert {(r.a, r.b): r.near for r in got.collect()} == {k: n for k, n in want.items() if n}
    assert not re.search(r"Aggregate \[a#\d+, b#\d+, t#\d+L?, k#\d+L?\]", got._jdf.queryExecution().optimizedPlan().toString())
