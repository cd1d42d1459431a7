"""Unions and borders of polygons on random grids, and the search for athletes, against plain versions."""

import random

import pytest

from barpath.functions import geo
from barpath.operators import borders, names

PARTS = "g string, p long, rings array<array<struct<x:double,y:double>>>"


def quad(x0, y0, x1, y1, shear, turn=False):
    pts = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    pts = [(float(x), float(y + shear * x)) for x, y in (reversed(pts) if turn else pts)]
    return [[*pts, pts[0]]] if turn else [pts]


def grid(rng, w, h, share, shear):
    """Cells of a grid, some of them in two halves, some against the clock, some with a hole of their own that another part fills."""
    cells = {(x, y) for x in range(w) for y in range(h) if rng.random() < share}
    parts = []
    for x, y in cells:
        kind = rng.randrange(4)
        if kind == 0:
            parts += [quad(x, y, x + 0.5, y + 1, shear), quad(x + 0.5, y, x + 1, y + 1, shear, True)]
        elif kind == 1:
            parts += [quad(x, y, x + 1, y + 0.25, shear), quad(x, y + 0.25, x + 1, y + 1, shear)]
        elif kind == 2:
            hole = quad(x + 0.25, y + 0.25, x + 0.75, y + 0.75, shear)
            parts += [quad(x, y, x + 1, y + 1, shear) + hole, hole]
        else:
            parts.append(quad(x, y, x + 1, y + 1, shear, rng.random() < 0.5))
    return cells, parts


def pieces(cells, corners):
    """How many connected pieces a set of cells has."""
    left, n = set(cells), 0
    steps = [(1, 0), (-1, 0), (0, 1), (0, -1)] + [(a, b) for a in (1, -1) for b in (1, -1)] * corners
    while left:
        todo, n = [left.pop()], n + 1
        while todo:
            x, y = todo.pop()
            near = {(x + a, y + b) for a, b in steps} & left
            left -= near
            todo += near
    return n


@pytest.mark.parametrize("shear", [0.0, 0.5])
def test_union_of_random_grids(spark, shear):
    rng = random.Random(int(shear * 10))
    grids = {f"g{k}": grid(rng, 9, 7, share, shear) for k, share in enumerate((0.3, 0.55, 0.7, 0.9, 1.0))}
    rows = [(g, i, p) for g, (_, parts) in grids.items() for i, p in enumerate(parts)]
    df = spark.createDataFrame([*rows, rows[0]], PARTS)
    got = {r.group: r for r in borders.union(df, "g", "p", "rings").collect()}
    assert set(got) == set(grids)
    for g, (cells, _) in grids.items():
        outside = {(x, y) for x in range(-1, 10) for y in range(-1, 8)} - cells
        assert got[g].area == pytest.approx(len(cells), abs=1e-6)
        assert len(got[g].shape) == pieces(cells, False) and sum(len(p) - 1 for p in got[g].shape) == pieces(outside, True) - 1
    assert [len(p) for p in got["g4"].shape] == [1] and len(got["g4"].shape[0][0]) == 4  # no corners on straight lines
    shapes = spark.createDataFrame(list(got.values()))
    points = spark.createDataFrame([(x + 0.4, y + 0.6 + shear * (x + 0.4), x, y) for x in range(-1, 10) for y in range(-1, 8)], "px double, py double, cx int, cy int")
    hits = {(r.group, r.cx, r.cy) for r in shapes.crossJoin(points).where(geo.in_shape("px", "py", "shape", holes=True)).collect()}
    assert hits == {(g, *c) for g, (cells, _) in grids.items() for c in cells}


def test_an_island_in_a_hole_and_pieces_that_touch(spark):
    ring = [(0, 0), (9, 0), (9, 9), (0, 9)], [(1, 1), (8, 1), (8, 8), (1, 8)]
    square = lambda a, b: [[(a, a), (b, a), (b, b), (a, b)]]
    rows = [("a", 1, [[(float(x), float(y)) for x, y in r] for r in ring]), ("a", 2, square(3.0, 5.0)), ("a", 3, square(5.0, 6.0)), ("a", 4, [[(0.0, 0.0), (1.0, 1.0)]])]
    got = borders.union(spark.createDataFrame(rows, PARTS), "g", "p", "rings").collect()
    assert len(got) == 1 and got[0].area == pytest.approx(81 - 49 + 4 + 1)
    assert sorted(len(p) for p in got[0].shape) == [1, 1, 2]
    assert borders.union(spark.createDataFrame([], PARTS), "g", "p", "rings").count() == 0


def test_borders_of_polygons_that_are_no_boxes(spark):
    p = lambda *pts: [[(float(x), float(y)) for x, y in pts]]
    rows = [
        ("a", 1, p((0, 0), (4, 1), (4, 5), (0, 4))), ("b", 2, p((4, 3), (8, 0), (8, 9), (4, 9))),  # along half an edge
        ("c", 3, p((0, 4), (2, 4.5), (2, 8), (0, 8))), ("c", 4, p((2, 4.5), (4, 5), (4, 9), (2, 8))),  # two parts of one, along a slope
        ("d", 5, p((8, 9), (9, 9), (9, 10))), ("e", 6, p((20, 20), (21, 20), (20, 21))),  # in a corner only; nowhere
    ]
    got = {(r.a, r.b): r.length for r in borders.borders(spark.createDataFrame(rows, PARTS), "g", "rings").collect()}
    assert got == {("a", "b"): pytest.approx(2.0), ("a", "c"): pytest.approx(17**0.5), ("b", "c"): pytest.approx(4.0)}


def trigrams(t):
    out = set()
    for w in "".join(c if c.isascii() and c.isalnum() else " " for c in t.lower()).split():
        out |= {f"  {w} "[i : i + 3] for i in range(len(w) + 1)}
    return out


def test_search_is_that_of_all_pairs(spark):
    rng = random.Random(3)
    syllables = ["an", "be", "co", "di", "fu", "ga", "he", "li", "mo", "pu", "ra", "ne", "si", "to", "lu", "x"]
    word = lambda: "".join(rng.choice(syllables[: rng.choice([3, 16])]) for _ in range(rng.randint(1, 4)))
    people = [(k, (word().title() + rng.choice([" ", "-", " O'"]) + word().title()) if k % 50 else None, rng.choice([None, str(k)])) for k in range(400)]
    people += [(400 + k, people[k][1], None) for k in range(1, 40)]
    recent = [(k, rng.choice(["M", None]), None if k % 9 == 0 else f"c{k}", rng.choice(["w", None])) for k, _, _ in people if k % 7]
    terms = [None, "", "a", "AN", "x-", "o'", "zz", "17", "be co", "%", "anbe", *[people[k][1].upper() for k in (1, 2, 3)], *[people[k][1][1:6] for k in range(4, 30)], *[word() for _ in range(20)]]
    df = lambda rows, schema: spark.createDataFrame(rows, schema)
    got = names.search_athletes(df(people, "lifter_id long, athlete_name string, membership_number string"), df(recent, "lifter_id long, gender string, club_name string, wso string"), df(list(enumerate(terms)), "term_id int, term string"), top=20)
    found = {}
    for r in got.orderBy("term_id", "place").collect():
        found.setdefault(r.term_id, []).append((r.lifter_id, r.gender, r.club_name))
    clubs = {k: (g or "Unknown", c) for k, g, c, _ in recent if c is not None}
    for n, t in enumerate(terms):
        hits = []
        for k, name, member in people:
            if t is None or k not in clubs:
                continue
            a, b = trigrams(name or ""), trigrams(t)
            alike = len(a & b) / len(a | b) if a | b else 0.0
            if name is not None and (t.lower() in name.lower() or alike > 0.2) or member == t:
                hits.append((1 if member == t else 2 if name.lower() == t.lower() else 3, -alike, name, k))
        assert found.get(n, []) == [(k, *clubs[k]) for *_, k in sorted(hits, key=lambda h: (h[:2], h[2] is not None, h[2] or "", h[3]))[:20]], t


def test_repeated_terms_are_searched_once(spark, monkeypatch):
    asked, similar = [], names.similar
    monkeypatch.setattr(names, "similar", lambda known, terms: asked.append(terms) or similar(known, terms))
    people = spark.createDataFrame([(1, "Ann Lee", "7"), (2, "Bo Ann", "8")], "lifter_id long, athlete_name string, membership_number string")
    recent = spark.createDataFrame([(1, "F", "C", "W"), (2, "M", "C", None)], "lifter_id long, gender string, club_name string, wso string")
    terms = spark.createDataFrame([(1, "ann"), (2, "ann"), (3, "7"), (4, "7"), (5, "ann"), (6, None)], "term_id long, term string")
    got = sorted((r.term_id, r.place, r.lifter_id) for r in names.search_athletes(people, recent, terms).collect())
    assert [t[1:] for t in got if t[0] == 1] == [t[1:] for t in got if t[0] == 5] != [] and [t for t in got if t[0] in (3, 4)] == [(3, 1, 1), (4, 1, 1)]
    assert asked[0].count() == 2


def test_only_the_best_names_of_a_block_leave_it(spark, monkeypatch):
    """Blocks of few names and terms find what one block finds, and each sends on no more than is asked for."""
    import random

    rng = random.Random(4)
    people = [(k, "".join(rng.choice("abc") for _ in range(5)) + " " + rng.choice(["Lee", "lee\nx", "Ro"])) for k in range(400)]
    known = spark.createDataFrame(sorted({n for _, n in people}), "string").toDF("athlete_name")
    terms = spark.createDataFrame([(k, t) for k, t in enumerate(["ab", "LEE", "abc", "ca r", "e\nx", "zz", "-", people[0][1].upper(), "bca lee"])], "term_id long, term string")
    monkeypatch.setattr(names, "NAMES", 50)
    monkeypatch.setattr(names, "TERMS", 4)
    got = {}
    for r in names.best_of(names.similar(known, terms), 7, "long").collect():
        got.setdefault(r.term_id, set()).add(r.athlete_name)
    from barpath.functions.text import similarity

    rows = known.crossJoin(terms).select("*", similarity("athlete_name", "term").alias("s")).collect()
    for t in terms.collect():
        hits = [(r.athlete_name.lower() != t.term.lower(), -(r.s or 0), r.athlete_name) for r in rows if r.term_id == t.term_id and ((r.s or 0) > 0.2 or t.term.lower() in r.athlete_name.lower())]
        assert got.get(t.term_id, set()) == {n for *_, n in sorted(hits)[:7]}, t
