"""Regions of places, branch by branch; and the small identity and batch rules."""

from pyspark.sql import functions as F

from barpath.functions import regions, scoring
from barpath.operators import identity, series
from barpath.sources import readers


def values(spark, f, rows, schema):
    return [r.x for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}").select("i", f.alias("x")).orderBy("i").collect()]


def test_states_of_addresses(spark):
    cases = {
        "1 Main, Austin, TX 73301, USA": "Texas", "Hall, Washington, Utah": "Washington", "A, West Virginia": "West Virginia", "A, Virginia 2": "Virginia", "Kansas": None, "Kansas, a, b, c": None, "x, United States": None,
        "x, tx": "Texas", "x, Texas USA": None, "": None, "x,california 94601,us": "California", "a, Indiana, in": "Indiana",
    }
    assert values(spark, regions.state_of_address("a"), [(a,) for a in cases] + [(None,)], "a string") == [*cases.values(), None]


def test_regions_of_states(spark):
    rows = [("Texas", None, None, None, None), ("California", "Fremont", 36.0, -120.0, None), ("California", "x", 36.0, -120.0, "California South"), ("California", "12 Fremont Rd", None, None, None), ("California", "Oakland", 0.0, -1.0, None), ("California", None, None, None, None), ("Ontario", None, None, None, None), (None, None, 1.0, 1.0, None)]
    schema = "s string, a string, lat double, lng double, t string"
    assert values(spark, regions.region_of_state("s", "a", "lat", "lng", "t"), rows, schema) == ["Texas-Oklahoma", regions.NORTH, regions.SOUTH, regions.SOUTH, regions.NORTH, regions.NORTH, None, None]
    assert values(spark, regions.region_of_state("s", "a", "lat", "lng"), rows, schema)[1:3] == [regions.SOUTH, regions.NORTH]
    assert set(regions.POPULATIONS) == set(regions.STATES.values()) - {"District of Columbia"} and sorted(s for r in regions.REGIONS.values() for s in r) == sorted(set(regions.STATES.values()) - {"California"})


def test_locations_of_names(spark):
    cases = {"NorCal Texas Open": ("region", regions.NORTH), "SoCal Open": ("region", regions.SOUTH), "2020 National Open": ("state", "Alabama"), "Open, TX": ("state", "Texas"), "TXO": None, "West Virginia Open": ("state", "Iowa"), "DC Open": ("state", "District of Columbia"), "New  Mexico": ("state", "Colorado")}
    got = values(spark, regions.location_of_name("n"), [(n,) for n in cases] + [(None,)], "n string")
    assert [g and tuple(g) for g in got] == [*cases.values(), None]


def test_cascade(spark):
    schema = "lat double, lng double, state string, address string, name string, box string, polygon string, territory string, history string"
    p = (40.0, -80.0)
    rows = [
        (*p, "TX", None, None, "Ohio", None, None, None), (*p, "ohio, Ohio", None, None, "Ohio", "P", None, None), (None, None, "tx", None, None, None, None, None, None), (*p, None, "x", None, "Ohio", "P", None, None),
        (*p, None, None, None, "Ohio", None, None, None), (*p, "?", "a, Iowa", "TX", None, None, None, None), (None, None, None, None, "PNW Open", None, None, None, "H"), (None, None, "?", None, "Open TX", None, None, None, "H"),
        (None, None, None, None, "Zzz", None, None, None, "H"), (None, None, None, None, None, "Ohio", "P", None, "H"), (*p, "TX", None, None, "Guam", None, None, None),
    ]
    got = values(spark, regions.assign("lat", "lng", "state", "address", "name", "box", "polygon", "territory", "history"), rows, schema)
    assert [(g.region, g.method, g.confidence) for g in got] == [
        ("Ohio", "coordinates_validated", 1.0), ("Ohio", "state_field_validated", 1.0), ("Texas-Oklahoma", "state_field", 0.98), ("P", "coordinates_polygon", 1.0), ("Ohio", "coordinates_bbox", 0.855),
        ("Iowa-Nebraska", "address_state", 0.9), ("Pacific Northwest", "meet_name_region", 0.95), ("Texas-Oklahoma", "meet_name_state", 0.85), ("H", "historical_data", 0.9), (None, None, 0.0), (None, None, 0.0),
    ]
    v = values(spark, regions.validate("r", "lat", "lng", "box"), [("Ohio", *p, "Ohio"), ("Iowa", *p, "Ohio"), ("Ohio", *p, None), (None, *p, "Ohio"), ("Ohio", 0.0, 1.0, "Ohio"), ("x", *p, "Guam")], "r string, lat double, lng double, box string")
    assert [tuple(x) for x in v] == [("valid", "Ohio", "right"), ("contaminated", "Ohio", "other"), ("contaminated", None, "outside"), ("invalid", None, "missing"), ("invalid", None, "missing"), ("contaminated", None, "no region")]


def test_ghosts_plans_and_audits(spark):
    people = spark.createDataFrame([(1, "A", "m", 5), (2, "A", None, None), (3, "A", "m", None), (4, "A", "n", None), (5, "A", "m", 6), (6, "B", None, None), (7, None, None, None)], "lifter_id long, athlete_name string, membership_number string, internal_id long")
    results = spark.createDataFrame([(1,), (1,)], "lifter_id long")
    assert sorted(r.lifter_id for r in identity.safe_ghosts(people, results, ["membership_number", "internal_id"]).collect()) == [2, 3]
    q = spark.createDataFrame([(1, 5, "F"), (2, 0, "M"), (3, 0, "U"), (4, 0, "F")], "lifter_id long, last_audited long, gender_hint string")
    assert [r.lifter_id for r in identity.audit_queue(q, 3, "F").orderBy("place").collect()] == [4, 3, 2] and [r.lifter_id for r in identity.audit_queue(q, 9).orderBy("place").collect()] == [2, 3, 4, 1]
    names = spark.createDataFrame([("Ann O'Lee", "ANN  OLEE Results Back to Rankings "), ("Ann", "Anne")], "n string, t string")
    assert [r.x for r in names.select(identity.audit_verdict("n", "t").alias("x")).collect()] == ["MATCH", "MISMATCH"]
    m = spark.createDataFrame([(1, 10, "A", "m", 1990, 7, True), (2, 11, "A", "m", None, 7, True), (3, 12, "B", None, None, 8, False)], "result_id long, lifter_id long, lifter_name string, membership_number string, birth_year int, internal_id long, needs_new boolean")
    plan = {(r.kind, r.internal_id, r.result_id, r.lifter_id, r.target, r.meets) for r in identity.cleanup_plan(m, spark.createDataFrame([(9,)], "result_id long")).collect()}
    assert plan == {("create", 7, None, 10, None, 2), ("update", 8, None, 12, None, 1), ("reassign", 7, 1, 10, "NEW_7", 1), ("reassign", 7, 2, 11, "NEW_7", 1), ("reassign", 8, 3, 12, "12", 1), ("orphan", None, 9, None, None, None)}


def test_proximity_gaps_and_caches(spark):
    rows = spark.createDataFrame([("a", 0), ("a", 99), ("a", 500), ("b", 100), ("b", 199), ("c", 1000)], "k string, t long")
    got = {(r.a, r.b): (r.n, r.near) for r in series.batch_proximity(rows, "k", "t", 100).collect()}
    assert got == {("a", "b"): (3, 1), ("b", "a"): (2, 1)}
    ids = [1, 2, 5, 6, 40, 41, 10**12, 10**12 + 2, -7, None, 5]
    gaps = series.id_gaps(spark.createDataFrame([(i,) for i in ids], "id long"), "id", width=10)
    assert sorted((r["first"], r["last"], r.missing) for r in gaps.collect()) == [(-6, 0, 7), (3, 4, 2), (7, 39, 33), (42, 10**12 - 1, 10**12 - 42), (10**12 + 1, 10**12 + 1, 1)]
    now, made = [0.0], []
    make = lambda: made.append(1) or spark.range(3)
    tables = []
    for now[0] in (0.0, 299.0, 301.0):
        tables.append(readers.cached_for(300, ("test",), make, clock=lambda: now[0]))
    assert len(made) == 2 and tables[0] is tables[1] and tables[2] is not tables[0] and tables[2].is_cached


def test_recomputing_some(spark):
    df = spark.createDataFrame([(1, -1.0), (2, -1.0)], "k int, q double")
    out = scoring.recompute(df, "q", F.lit(5.0), F.when(F.col("k") == 2, "range"))
    assert sorted((r.k, r.q) for r in out.collect()) == [(1, -1.0), (2, 5.0)]


def test_joins_that_grow_are_not_sent_through_the_driver(spark):
    from barpath.operators import borders, linking

    square = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    parts = spark.createDataFrame([("g", k, [[(x + k, y) for x, y in square]]) for k in range(2)], "g string, p long, r array<array<struct<x: double, y: double>>>")
    people = spark.createDataFrame([(1, 1, "Ann Lee", ["ann", "lee"])], "id long, meet long, name string, w array<string>")
    rows = spark.createDataFrame([(1, 1, [1.0] * 6)], "id long, meet long, a array<double>")
    for df in (borders.split(borders.edges(parts, "g", "p", "r")), linking.name_pairs(people, people, "meet"), linking.attempt_pairs(rows, rows, "meet")):
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
