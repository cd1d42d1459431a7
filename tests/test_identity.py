"""Linking, merging and resolving: each branch by hand, and against walks through all pairs or all rows one by one."""

import random

import pytest

from barpath.operators import identity, linking, resolving

RESULT = "result_id long, lifter_id long, meet_name string, date string, total double, club_name string, wso string"


def merged(spark, rows, masters):
    kept, erased = identity.surgical_merge(spark.createDataFrame(rows, RESULT), spark.createDataFrame(masters, "lifter_id long, master long"), ["club_name", "wso"])
    return sorted(tuple(r) for r in kept.collect()), sorted(r.lifter_id for r in erased.collect())


def test_merge_leaves_own_rows_and_other_athletes_alone(spark):
    rows = [
        (1, 5, "M", "d", 100.0, None, "x"), (2, 5, "M", "d", 100.0, "c", None),  # two equal results of the master
        (3, 7, "M", "d", 100.05, "e", "f"),  # a duplicate's, within 0.1
        (4, 12, "M", "d", None, "g", "h"), (5, 12, "M", "d", None, "g", "h"),  # somebody who is never merged
    ]
    assert merged(spark, rows, [(5, 5), (7, 5)]) == ([(1, 5, "e", "x", "kept"), (2, 5, "c", None, "kept"), (4, 12, "g", "h", "kept"), (5, 12, "g", "h", "kept")], [7])


def test_merge_harvests_and_reassigns(spark):
    rows = [
        (1, 5, "M", "d", 90.0, "-", ""), (2, 7, "M", "d", 90.0, "-", "w"), (3, 8, "M", "d", 90.0, "c", "v"),  # what the first lacks, the second has
        (4, 7, "N", "d", 80.0, None, None), (5, 8, "N", "d", 80.0, "c", "w"),  # brought by one duplicate, met by the next
        (6, 7, "O", "d", None, "c", "w"), (7, 5, "O", "d", None, "c", "w"),  # no total meets nothing
        (8, 7, "P", "d", 70.0, "c", "w"), (9, 7, "P", "d", 70.0, "c", "w"), (10, 5, "P", "d", 70.2, "c", "w"),  # two of one duplicate, and one too far
        (11, 7, None, None, 60.0, "c", "w"), (12, 5, None, None, 60.0, "c", "w"),
    ]
    kept, erased = merged(spark, rows, [(5, 5), (7, 5), (8, 5), (20, 20)])
    assert erased == [7, 8]
    assert kept == [
        (1, 5, "c", "w", "kept"), (4, 5, "c", "w", "reassigned"), (6, 5, "c", "w", "reassigned"), (7, 5, "c", "w", "kept"),
        (8, 5, "c", "w", "reassigned"), (9, 5, "c", "w", "reassigned"), (10, 5, "c", "w", "kept"), (12, 5, "c", "w", "kept"),
    ]


def test_merge_takes_nothing_from_one_that_lacks_it_too(spark):
    rows = [(1, 5, "M", "d", 90.0, None, ""), (2, 7, "M", "d", 90.0, "-", "-"), (3, 5, "N", "d", 90.0, None, "-"), (4, 7, "N", "d", 90.0, "-", ""), (5, 8, "N", "d", 90.0, "c", "-")]
    assert merged(spark, rows, [(5, 5), (7, 5), (8, 5)])[0] == [(1, 5, None, "", "kept"), (3, 5, "c", "-", "kept")]


def test_name_changes(spark):
    people = spark.createDataFrame([(1, "Ann Lee", "m", None), (2, "Ann Roe ", "m", 7), (3, "ann roe", "m", 8), (4, "Bo", "n", None), (5, "Bob", "n", None), (6, "Cy", "o", 1), (7, "Cyd", "o", None), (8, "Di", "p", 3), (9, "Dy", "p", None), (10, "X", "q", 1), (11, "x ", "q", 2)], "lifter_id long, athlete_name string, membership_number string, internal_id long")
    active = spark.createDataFrame([("m", "ANN ROE"), ("o", "Nobody"), ("p", "dy")], "membership_number string, active_name string")
    results = spark.createDataFrame([(1, "d1", 100.0), (3, "d1", 100.0), (2, "d2", 0.0), (8, "d3", 90.0), (9, "d4", 80.0), (9, "d4", 81.0), (6, "d", 5.0)], "lifter_id long, date string, total double")
    scraped = spark.createDataFrame([("m", "d1", 100.0), ("p", "d3", 90.0), ("m", "d4", 80.0)], "membership_number string, date string, total double")
    got = {r.membership_number: tuple(r)[1:] for r in identity.name_change_plan(people, results, active, scraped).collect()}
    assert got == {"m": (2, "merge", None), "o": (None, "no destination", None), "p": (9, "history mismatch", "d4|80.0,d4|81.0")}


A = "a array<double>"


def test_links_of_two_federations(spark):
    t = lambda *x: [float(v) for v in x]
    one = t(1, 1, 1, 1, 1, 1)
    i = [
        (1, 10, "Ann Lee", 1, 200, 1990, False, t(80, 85, 90, 100, 105, 110)),  # same name, other attempts
        (2, 11, "Bob Ray-Jun", 1, 210, 1991, False, t(90, 95, 100, 105, 110, 110)),  # a word and the attempts agree
        (3, 12, "Cyr Roe Jun", 1, 150, 1992, False, t(60, 65, 70, 75, 80, 80)),  # the last word agrees, the attempts do not
        (4, 13, "Dia Fox", 1, 220, 1993, True, t(199, 190, 191, 192, 195, 199)),  # nobody
        (5, 14, "Edy Hay", 1, 180, 1994, False, t(70, 75, 80, 90, 95, 100)),  # two of one name, as near
        (6, 15, "Flo Kim", 1, 190, 1995, False, t(70, 75, 80, 90, 95, 110)),  # by hand
        (7, 16, "Gus Orr", 1, 191, 1996, False, t(70, 75, 80, 90, 95, 111)),  # banned
        (8, 17, "Hal Poe Junior", 9, 100, 1997, False, t(40, 41, 42, 50, 55, 58)),  # no meet in common, name in name
        (9, 18, "Ivy New", 1, 140, 1998, True, t(51, 54, 57, 80, 83, 86)),  # attempts alone, of the home country
        (10, 19, "Jan New", 1, 140, 1998, False, t(51, 54, 57, 80, 83, 86)),  # and not
        (11, 20, "Kay Married", 1, 160, 1999, False, t(61, 64, 67, 90, 93, 96)),  # the first name alone, and the attempts
        (12, 21, "Lou Sun", 1, 170, 1999, False, t(3, 3, 3, 3, 3, 3)),  # one person twice, as near
    ]
    u = [
        (1, 20, "ann lee ", 1, 203, one), (2, 21, "Ray Bob", 1, 210, t(90, 95, 100, 105, 110, 111)), (3, 22, "Cyril Roe", 1, 150, t(11, 12, 13, 14, 15, 16)), (4, 24, "Edy Hay", 1, 181, one), (5, 25, "Edy Hay", 1, 179, one),
        (6, 26, "Other", 1, 50, one), (7, 27, "Gus Orr", 1, 191, one), (8, 28, "Xen Old", 1, 139, [50.0, 55.0, None, 81.0, 83.0, 10.0]), (9, 29, "Kay Maiden", 1, 160, t(61, 64, 67, 90, 20, 20)),
        (10, 30, "Lou Sun", 1, 171, one), (11, 30, "Lou Sun", 1, 169, one),
    ]
    a = spark.createDataFrame([(*r[:5], 0, *r[5:]) for r in i], f"ir long, iwf long, name string, meet_id long, total int, best_snatch int, birth_year int, home boolean, {A}")
    b = spark.createDataFrame([(*r[:5], 0, r[5]) for r in u], f"ur long, usaw long, name string, meet_id long, total int, best_snatch int, {A}")
    people = spark.createDataFrame([(40, "Hal Poe", 1997), (41, "Hal", 1997), (42, "Hal Poe", 1990)], "usaw long, name string, birth_year int")
    manual = spark.createDataFrame([(15, 26)], "iwf long, usaw long")
    got = {r.iwf: (r.usaw, r.decision, r.confidence) for r in linking.link(a, b, people, manual, lambda x, y: (x == 16) & (y == 27)).collect()}
    assert got == {
        10: (20, "linked", 100), 11: (21, "linked", 100), 12: (None, "physics_failed", 0), 13: (None, "unmatched", 0), 14: (None, "ambiguous", 0), 15: (26, "linked", 100), 16: (None, "unmatched", 0),
        17: (40, "linked", 90), 18: (None, "ambiguous", 0), 19: (None, "unmatched", 0), 20: (29, "linked", 100), 21: (30, "linked", 100),
    }


def test_attempt_pairs_are_all_that_agree(spark):
    rng = random.Random(8)
    row = lambda n: (n, rng.randint(1, 3), [None if rng.random() < 0.25 else rng.choice([60, 60.5, 61, 62, 63.5, 64, 80]) + 0.0 for _ in range(6)])
    a, b = [row(n) for n in range(150)], [row(n) for n in range(150)]
    df = lambda rows: spark.createDataFrame(rows, f"id long, meet long, {A}")
    got = {tuple(r) for r in linking.attempt_pairs(df(a), df(b), "meet").collect()}

    def agree(x, y):
        gaps = [abs(p - q) for p, q in zip(x, y, strict=True) if p is not None and q is not None]
        near = sum(g <= 1 for g in gaps)
        return near >= 4 if len(gaps) >= 4 else bool(gaps) and near == len(gaps)

    want = {(i, j) for i, m, x in a for j, n, y in b if m == n and agree(x, y)}
    assert want and want <= got


def test_resolving_in_tiers(spark):
    people = spark.createDataFrame([(1, "A", 5), (2, "A", None), (3, "B", None), (4, "C", 6), (5, "C", 7), (6, "D", 8), (7, "D", 9)], "lifter_id long, athlete_name string, internal_id long")
    e = [(1, "A", 5, 1), (2, "Z", 6, 1), (3, "B", 99, 1), (4, "A", 99, 1), (5, "C", 99, 1), (6, "C", 99, 2), (7, "Q", None, 1), (8, "D", 99, 1), (9, "D", 99, 2), (10, "A", None, 1)]
    entries = spark.createDataFrame([(*r, 80.0, 200.0) for r in e], "entry_id long, athlete_name string, internal_id long, meet_id long, body_weight_kg double, total double")
    busy = [(4, 1, 50, 80.0, 200.0), (6, 1, 51, 80.4, 200.05), (7, 1, 52, None, None), (6, 2, 53, 80.5, 200.0), (7, 2, 54, 80.0, 201.0), (6, 2, 9, 80.0, 200.0), (4, 2, 6, 1.0, 1.0)]
    got = {r.entry_id: (r.lifter_id, r.tier) for r in resolving.resolve_in_tiers(entries, people, spark.createDataFrame(busy, "lifter_id long, meet_id long, x long, body_weight_kg double, total double")).collect()}
    assert got == {
        1: (1, "id and name"), 2: (4, "id"), 3: (3, "name"), 4: (2, "adopted"), 5: (5, "exclusion"), 6: (4, "exclusion"), 7: (None, "new"), 8: (6, "again"), 9: (None, "conflict"), 10: (1, "exclusion"),
    }


def walk(entries, people):
    """One by one, as the entries come."""
    people = [list(p) for p in people]  # id, membership, internal id, name
    out = {}
    for e, m, i, n, create in sorted(entries):
        by = lambda f: sorted((p for p in people if f(p)), key=lambda p: p[0])
        if m is not None:
            hit = by(lambda p: p[1] == m)
            if hit and i is not None and hit[0][2] is None:
                hit[0][2] = i
                out[e] = hit[0][0], "membership adopts"
            else:
                out[e] = (hit[0][0], "membership") if hit else (None, "no such member")
            continue
        ided = by(lambda p: i is not None and p[2] == i)
        if ided:
            same = [p for p in ided if p[3] == n]
            out[e] = (same[0][0], "id and name") if same else (ided[0][0], "id")
            continue
        named = by(lambda p: n is not None and p[3] == n)
        free = [p for p in named if p[2] is None]
        if len(named) == 1:
            if i is not None and free:
                free[0][2] = i
                out[e] = free[0][0], "name adopts"
            else:
                out[e] = named[0][0], "name"
        elif len(named) > 1 and i is not None and len(free) == 1:
            free[0][2] = i
            out[e] = free[0][0], "adopts among several"
        elif create:
            people.append([-e, None, i, n])
            out[e] = -e, "created"
        else:
            out[e] = None, "unmatched"
    return out


@pytest.mark.parametrize("seed", range(3))
def test_entries_see_what_earlier_ones_changed(spark, seed):
    rng = random.Random(seed)
    some = lambda p, x: x if rng.random() < p else None
    people = [(k, some(0.6, f"m{rng.randrange(12)}"), some(0.4, rng.randrange(20)), f"n{rng.randrange(12)}") for k in range(25)]
    entries = [(k, some(0.2, f"m{rng.randrange(14)}"), some(0.7, rng.randrange(30)), f"n{rng.randrange(16)}", rng.random() < 0.6) for k in range(1, 121)]
    e = spark.createDataFrame(entries, "entry_id long, membership_number string, internal_id long, athlete_name string, may_create boolean")
    p = spark.createDataFrame(people, "lifter_id long, membership_number string, internal_id long, athlete_name string")
    got = {r.entry_id: (r.lifter_id, r.rule) for r in resolving.resolve_entries(e, p).collect()}
    assert got == walk(entries, people)
    assert len({r for _, r in got.values()}) >= 8


def test_find_or_create(spark):
    people = spark.createDataFrame([(1, "A", "USA", 1990), (2, "A", "USA", 1991), (3, "B", "USA", None), (4, "B", "USA", 1980), (5, "C", "CAN", 1970)], "lifter_id long, athlete_name string, country_code string, birth_year int")
    e = [(1, 5, "X", "USA", 1), (2, None, "A", "USA", 1991), (3, None, "B", "USA", 1999), (4, 77, "B", "USA", None), (5, None, "A", "USA", 1980), (6, None, "C", "USA", 1970), (7, None, None, None, None)]
    got = {r.entry_id: (r.lifter_id, r.rule, r.takes_year) for r in resolving.find_or_create(spark.createDataFrame(e, "entry_id long, exact long, athlete_name string, country_code string, birth_year int"), people, "entry_id", "lifter_id").collect()}
    assert got == {1: (5, 1, False), 2: (2, 2, False), 3: (3, 3, True), 4: (3, 3, False), 5: (None, 4, False), 6: (None, 4, False), 7: (None, 4, False)}


def test_linking_reads_its_tables_a_few_times(spark, sf):
    from barpath.plans import registry

    plan = registry.QUERIES["dq_9_link_decision"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("orders.parquet") == 0  # all that is left to read are the stored pairs and steps


def test_tiers_of_a_full_meet_and_of_unknown_weights(spark):
    rng = random.Random(3)
    people = [(p, f"N{p % 3}", rng.choice([None, 1, 2, 3])) for p in range(1, 19)]
    some = lambda *x: rng.choice([None, *x])
    entries = [(e, f"N{rng.randint(0, 3)}", some(1, 2, 3), rng.randint(1, 5), some(80.0, 80.3, 81.0), some(200.0, 200.05, 201.0)) for e in range(60)]
    own = [(rng.randint(1, 18), r[3], r[0], r[4], r[5]) for r in entries]
    more = [(p, m, -(100 * m + p), 80.4 if p % 2 else None, 200.0 if p % 4 else None) for p, n, _ in people for m in (1, 2) if (n, m) != ("N0", 2)]
    least = {}  # of those alike the one of the least x stands for all: the meets are full
    for p, m, x, w, t in more:
        key = f"N{p % 3}", m, w, t
        least[key] = min(least.get(key, (p, m, x, w, t)), (p, m, x, w, t), key=lambda r: r[2])
    kind = "lifter_id long, meet_id long, x long, body_weight_kg double, total double"
    e = spark.createDataFrame(entries, "entry_id long, athlete_name string, internal_id long, meet_id long, body_weight_kg double, total double")
    q = spark.createDataFrame(people, "lifter_id long, athlete_name string, internal_id long")
    whole = resolving.resolve_in_tiers(e, q, spark.createDataFrame(own + more, kind))
    full = spark.createDataFrame(sorted({k[:2] for k in least}), "athlete_name string, meet_id long")
    brief = resolving.resolve_in_tiers(e, q, spark.createDataFrame(own + list(least.values()), kind), full)

    def plain(entry, name, iid, meet, bw, total):
        named, ided = [p for p in people if p[1] == name], [p for p in people if iid is not None and p[2] == iid]
        for tier, found in (("id and name", [p for p in ided if p[1] == name]), ("id", ided), ("name", named), ("adopted", [p for p in named if iid is not None and p[2] is None])):
            if len(found) == 1:
                return found[0][0], tier
        others = [b for b in own + more if b[1] == meet and b[2] != entry and b[0] in {p[0] for p in named}]
        free = {p[0] for p in named} - {b[0] for b in others}
        near = lambda a, b, d: a is None or b is None or abs(a - b) < d
        again = [(b[2], b[0]) for b in others if near(b[3], bw, 0.5) and near(b[4], total, 0.1)]
        return (min(free), "exclusion") if free else (min(again)[1], "again") if again else (None, "conflict" if named else "new")

    want = {r[0]: plain(*r) for r in entries}
    assert {"exclusion", "again", "new"} <= {t for _, t in want.values()}
    for got in (whole, brief):
        assert {r.entry_id: (r.lifter_id, r.tier) for r in got.collect()} == want


def test_namesakes_do_not_lengthen_the_walk(spark):
    """One creation leads to another all along the entries of a name (they settled one by one), and no entry meets its namesakes in a join."""
    entries = [(k, None, (None, 1000 + k % 3)[k % 2], f"x{k % 2}" if k % 5 else "y", k % 3 != 0) for k in range(1, 301)]
    people = [(k, None, None if k % 2 else 5 + k, "y") for k in range(40)]
    e = spark.createDataFrame(entries, "entry_id long, membership_number string, internal_id long, athlete_name string, may_create boolean")
    p = spark.createDataFrame(people, "lifter_id long, membership_number string, internal_id long, athlete_name string")
    out = resolving.resolve_entries(e, p, max_rounds=6)
    assert {r.entry_id: (r.lifter_id, r.rule) for r in out.collect()} == walk(entries, people)
    joins = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert not any("athlete_name" in line or "internal_id" in line for line in joins)


def rounds_of_walk(entries, people, rounds):
    """The rounds that the SQL of dq_28 writes out, one by one: takes of known and created persons alike go by their ids, which they may share."""
    takes, made, out = {}, [], {}
    for _ in range(rounds):
        known = [(p, m, n, takes.get(p, (None, None))[0] if i is None else i, None, takes.get(p, (None, None))[1]) for p, m, i, n in people]
        known += [(p, None, n, takes.get(p, (None, None))[0] if i is None else i, since, takes.get(p, (None, None))[1]) for p, i, n, since in made]
        before = lambda since, e: since is None or since < e
        out = {}
        for e, m, i, n, create in entries:
            has = lambda k, e=e: k[3] is not None and before(k[5], e)
            if m is not None:
                own = min((k for k in known if k[1] == m), default=None, key=lambda k: k[0])
                out[e] = (None, "no such member") if own is None else (own[0], "membership adopts" if i is not None and not has(own) else "membership")
                continue
            there = [k for k in known if before(k[4], e)]
            ided, named = [k for k in there if i is not None and k[3] == i and before(k[5], e)], [k for k in there if k[2] == n]
            free = [k for k in named if not has(k)]
            if ided:
                both = [k[0] for k in ided if k[2] == n]
                out[e] = (min(both), "id and name") if both else (min(k[0] for k in ided), "id")
            elif len(named) == 1:
                out[e] = named[0][0], "name adopts" if i is not None and len(free) == 1 else "name"
            elif len(named) > 1 and i is not None and len(free) == 1:
                out[e] = free[0][0], "adopts among several"
            else:
                out[e] = (-e, "created") if create else (None, "unmatched")
        takes, made = {}, [(-e, i, n, e) for e, _, i, n, _ in entries if out[e][1] == "created"]
        for e, _, i, _, _ in entries:
            if "adopts" in out[e][1]:
                takes.setdefault(out[e][0], (i, e))
    return out


def test_rounds_are_those_of_the_sql(spark):
    """Known persons have the ids of created ones, and the chain of changes is longer than the rounds."""
    rng = random.Random(8)
    some = lambda p, x: x if rng.random() < p else None
    people = [(-k, some(0.5, f"m{rng.randrange(12)}"), None, f"n{rng.randrange(8)}") for k in range(1, 120, 3)]
    entries = [(k, some(0.1, f"m{rng.randrange(14)}"), some(0.7, rng.randrange(60)), f"n{rng.randrange(24)}", rng.random() < 0.6) for k in range(1, 161)]
    e = spark.createDataFrame(entries, "entry_id long, membership_number string, internal_id long, athlete_name string, may_create boolean")
    p = spark.createDataFrame(people, "lifter_id long, membership_number string, internal_id long, athlete_name string")
    plain = [rounds_of_walk(entries, people, n) for n in range(1, 40)]
    assert plain[1] != plain[2] != plain[3] and plain[37] == plain[38]
    for n in (1, 2, 3, 39):
        assert {r.entry_id: (r.lifter_id, r.rule) for r in resolving.resolve_entries(e, p, rounds=n).collect()} == plain[n - 1]


def test_linking_stores_no_pairs(spark, monkeypatch):
    """Results that are equal but for their names and persons meet as one: what is stored grows with the results, not with their pairs."""
    stored, materialise = {}, linking.materialise
    monkeypatch.setattr(linking, "materialise", lambda df, name: stored.setdefault(name, materialise(df, name)))
    kind = "name string, meet_id long, total int, best_snatch int, {}a array<int>"
    six, n = [100, 101, 102, 120, 121, 122], 120
    i = spark.createDataFrame([(k, k, f"Ann Lee{k % 3}", 1, 222, 100, 1990, True, six) for k in range(n)], "ir long, iwf long, " + kind.format("birth_year int, home boolean, "))
    u = spark.createDataFrame([(k, 1000 + k, f"Ann Ray{k % 3}", 1, 222, 100, six) for k in range(n)], "ur long, usaw long, " + kind.format(""))
    people = spark.createDataFrame([(1000 + k, f"Ann Ray{k % 3}", 1990) for k in range(n)], "usaw long, name string, birth_year int")
    out = linking.link(i, u, people, spark.createDataFrame([], "iwf long, usaw long"), lambda a, b: a == b).collect()
    assert {r.iwf: r.decision for r in out} == {k: "ambiguous" for k in range(n)}
    assert max(df.count() for df in stored.values()) <= n
