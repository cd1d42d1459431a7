"""Polygons that touch: their union, and who borders on whom. SURVEY GEO-16, GEO-19.

Coordinates become whole numbers of a millionth of a degree, so that whether points lie on a line is exact. Every edge is split
where a corner of another polygon lies on it; what is shared by two polygons is then the same segment twice, in opposite
directions. Parts must not overlap but in their borders (parts of a map do not); a part that occurs twice counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barpath.functions.geo import in_ring
from barpath.session import SHUFFLED, materialise

SCALE = 1_000_000


def _area2(ring) -> Column:
    """Twice the signed area of a ring of whole numbers: over 0 if it runs against the clock. In double: enough for the sign and
    to nine digits."""
    n = F.size(ring)
    x0, y0 = F.get(ring, F.lit(0))["x"], F.get(ring, F.lit(0))["y"]

    def part(i: Column) -> Column:
        a, b = F.element_at(ring, i), F.element_at(ring, F.when(i == n, 1).otherwise(i + 1))
        return ((a["x"] - x0) * (b["y"] - y0) - (b["x"] - x0) * (a["y"] - y0)).cast("double")

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0.0), lambda s, i: s + part(i))


def edges(parts: DataFrame, group: str, part: str, rings: str) -> DataFrame:
    """``group, part, ax, ay, bx, by``: the edges of polygons (rings: the outer one first, then holes), the inside on the left. Rings may
    be closed or not. Parts of one group that are equal count once."""
    snapped = F.transform(rings, lambda r: F.transform(r, lambda p: F.struct(F.round(p["x"] * SCALE).cast("long").alias("x"), F.round(p["y"] * SCALE).cast("long").alias("y"))))
    each = parts.select(F.col(group).alias("group"), F.col(part).alias("part"), snapped.alias("__r")).dropDuplicates(["group", "__r"]).select("group", "part", F.posexplode("__r").alias("__k", "ring"))
    each = each.where(F.size("ring") >= 3).withColumn("__turn", (_area2(F.col("ring")) > 0) != (F.col("__k") == 0))
    n = F.size("ring")
    pair = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(F.element_at("ring", i).alias("a"), F.element_at("ring", F.when(i == n, 1).otherwise(i + 1)).alias("b")))
    e = each.select("group", "part", "__turn", F.explode(pair).alias("e"))
    end = lambda p, q, c: F.when(F.col("__turn"), F.col(f"e.{q}.{c}")).otherwise(F.col(f"e.{p}.{c}"))
    e = e.select("group", "part", end("a", "b", "x").alias("ax"), end("a", "b", "y").alias("ay"), end("b", "a", "x").alias("bx"), end("b", "a", "y").alias("by"))
    return e.where("ax != bx or ay != by")


def split(e: DataFrame) -> DataFrame:
    """The edges cut where an end of another edge of the group lies on them: ``group, part, x, y, u, v, sign``; (x, y) is before
    (u, v), by x and then y, and the sign is 1 if the edge runs that way.

    Only edges of one line can lie on one another. Lines have a key: their slope, which is the same double for all of a line
    because equal ratios round alike, and where they cross the axis, to a millionth; whether a point is on the line is then tested in
    whole numbers. Along the line, edges go to the bins they reach through and points to their own, a bin being as long as the
    group's edges are on average, so a line of very many edges brings no square of pairs about.
    """
    forward = F.expr("ax < bx or (ax = bx and ay < by)")
    rows = e.select("group", "part", *[F.when(forward, F.col(a)).otherwise(F.col(b)).alias(n) for a, b, n in (("ax", "bx", "x"), ("ay", "by", "y"), ("bx", "ax", "u"), ("by", "ay", "v"))], F.when(forward, 1).otherwise(-1).alias("sign"))
    dx, dy = F.col("u") - F.col("x"), F.col("v") - F.col("y")
    steep = F.abs(dy) > F.abs(dx)
    rows = rows.withColumns({"steep": steep, "slope": F.when(steep, dx / dy).otherwise(dy / dx), "id": F.monotonically_increasing_id()})
    crossing = F.when(F.col("steep"), F.col("x") - F.col("slope") * F.col("y")).otherwise(F.col("y") - F.col("slope") * F.col("x"))
    long = F.when(F.col("steep"), F.abs(dy)).otherwise(dx)
    rows = materialise(rows.withColumns({"crossing": crossing, "long": long}), "edges")
    size = rows.groupBy("group").agg(F.ceil(F.avg("long")).alias("size"))
    rows = rows.join(size.hint(SHUFFLED), "group")
    bin_ = lambda steep, x, y: F.floor(F.when(steep, y).otherwise(x) / F.col("size"))
    s = F.col("steep")
    ends = F.array(F.struct(F.col("x").alias("px"), F.col("y").alias("py")), F.struct(F.col("u").alias("px"), F.col("v").alias("py")))
    points = rows.select("group", "steep", "slope", "size", F.explode(F.array_distinct(F.array(F.floor(F.col("crossing") + 0.49), F.floor(F.col("crossing") + 0.51)))).alias("line"), F.explode(ends).alias("p"))
    points = points.select("group", "steep", "slope", "line", bin_(s, F.col("p.px"), F.col("p.py")).alias("bin"), "p.px", "p.py").distinct()
    lo, hi = bin_(s, F.col("x"), F.col("y")), bin_(s, F.col("u"), F.col("v"))
    reach = rows.select("id", "group", "steep", "slope", F.floor(F.col("crossing") + 0.5).alias("line"), "x", "y", "u", "v", F.explode(F.sequence(F.least(lo, hi), F.greatest(lo, hi))).alias("bin"))
    on = F.expr("(u - x) * (py - y) = (v - y) * (px - x) and (x < px or (x = px and y < py)) and (px < u or (px = u and py < v))")
    cut = reach.join(points.hint(SHUFFLED), ["group", "steep", "slope", "line", "bin"]).where(on).groupBy("id").agg(F.array_sort(F.collect_set(F.struct("px", "py"))).alias("cuts"))
    j = rows.join(cut.hint(SHUFFLED), "id", "left")
    place = lambda a, b: F.array(F.struct(F.col(a).alias("px"), F.col(b).alias("py")))
    stops = F.when(F.col("cuts").isNull(), F.concat(place("x", "y"), place("u", "v"))).otherwise(F.concat(place("x", "y"), F.col("cuts"), place("u", "v")))
    pieces = F.transform(F.sequence(F.lit(1), F.size(stops) - 1), lambda i: F.struct(F.element_at(stops, i).alias("a"), F.element_at(stops, i + 1).alias("b")))
    return j.select("group", "part", "sign", F.explode(pieces).alias("s")).select("group", "part", F.col("s.a.px").alias("x"), F.col("s.a.py").alias("y"), F.col("s.b.px").alias("u"), F.col("s.b.py").alias("v"), "sign")


def _length() -> Column:
    return F.sqrt(F.pow(F.col("u") - F.col("x"), F.lit(2.0)) + F.pow(F.col("v") - F.col("y"), F.lit(2.0))) / SCALE


def borders(parts: DataFrame, owner: str, rings: str) -> DataFrame:
    """GEO-19: ``a, b, length``: owners (a before b) whose polygons share more than points of their borders, and for how many
    degrees. An owner may have many polygons."""
    whole = parts.select(F.lit(0).alias("__all"), F.col(owner).alias("__owner"), F.col(rings).alias("__rings"))
    pieces = split(edges(whole, "__all", "__owner", "__rings"))
    # at most two polygons lie along a segment, one on each side
    sides = pieces.groupBy("x", "y", "u", "v").agg(F.min("part").alias("a"), F.max("part").alias("b"))
    return sides.where("a < b").groupBy("a", "b").agg(F.sum(_length()).alias("length"))


def outline(parts: DataFrame, group: str, part: str, rings: str) -> DataFrame:
    """The border of each group's union: ``group, x, y, u, v, sign``: segments that have a part on one side only."""
    pieces = split(edges(parts, group, part, rings))
    return pieces.groupBy("group", "x", "y", "u", "v").agg(F.sum("sign").alias("sign")).where("sign != 0")


def rings_of(border: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``group, ring, area, points``: the border stitched together, the inside on the left, so that the area of a hole is under 0.

    Each segment is followed by one that begins where it ends; where two pieces of the union touch in a corner, by that of the
    sharpest turn to the left, so that they stay two rings. Segments learn the least of their ring, and then how far they are from
    it, by jumps of twice the length in each round: rounds grow with the logarithm of the longest ring.
    """
    s = border.select("group", *[F.when(F.col("sign") > 0, F.col(a)).otherwise(F.col(b)).alias(n) for a, b, n in (("x", "u", "fx"), ("y", "v", "fy"), ("u", "x", "tx"), ("v", "y", "ty"))])
    s = materialise(s.withColumn("id", F.monotonically_increasing_id()), "segments")
    after = s.select("group", F.col("fx").alias("tx"), F.col("fy").alias("ty"), (F.col("tx") - F.col("fx")).cast("double").alias("nx"), (F.col("ty") - F.col("fy")).cast("double").alias("ny"), F.col("id").alias("next"))
    dx, dy = (F.col("tx") - F.col("fx")).cast("double"), (F.col("ty") - F.col("fy")).cast("double")
    turn = F.atan2(dx * F.col("ny") - dy * F.col("nx"), dx * F.col("nx") + dy * F.col("ny"))
    follow = s.join(after.hint(SHUFFLED), ["group", "tx", "ty"]).groupBy("id").agg(F.max_by("next", turn).alias("next"))
    follow = materialise(follow, "next")

    def jumps(state: DataFrame, value: str, put, done) -> DataFrame:
        for _ in range(max_rounds):
            there = state.select(F.col("id").alias("ptr"), F.col("ptr").alias("far"), F.col(value).alias("theirs"))
            state = materialise(state.join(there.hint(SHUFFLED), "ptr").select("id", F.col("far").alias("ptr"), put(F.col(value), F.col("theirs")).alias(value), (put(F.col(value), F.col("theirs")) != F.col(value)).alias("moved")), "jumps")
            if state.where(done).isEmpty():
                return state
        raise RuntimeError(f"rings of over 2**{max_rounds} segments")

    least = jumps(follow.select("id", F.col("next").alias("ptr"), F.least("id", "next").alias("low")), "low", lambda a, b: F.least(a, b), "moved").select("id", F.col("low").alias("ring"))
    first = F.col("id") == F.col("ring")
    start = follow.join(least.hint(SHUFFLED), "id").select("id", F.when(first, F.col("id")).otherwise(F.col("next")).alias("ptr"), F.when(first, 0).otherwise(1).cast("long").alias("left"))
    order = jumps(start, "left", lambda a, b: a + b, "moved").select("id", "left")
    # the last before the first has one step left: the farther, the earlier
    rows = s.join(least.hint(SHUFFLED), "id").join(order.hint(SHUFFLED), "id")
    corner = F.struct((-F.when(first, F.lit(1 << 62)).otherwise(F.col("left"))).alias("__k"), F.col("fx").alias("x"), F.col("fy").alias("y"))
    whole = rows.groupBy("group", "ring").agg(F.transform(F.array_sort(F.collect_list(corner)), lambda c: F.struct(c["x"].alias("x"), c["y"].alias("y"))).alias("points"))
    n = F.size("points")

    def straight(i: Column) -> Column:
        a, b, c = F.element_at("points", F.when(i == 1, n).otherwise(i - 1)), F.element_at("points", i), F.element_at("points", F.when(i == n, 1).otherwise(i + 1))
        return (b["x"] - a["x"]) * (c["y"] - b["y"]) == (b["y"] - a["y"]) * (c["x"] - b["x"])

    corners = F.transform(F.filter(F.sequence(F.lit(1), n), lambda i: ~straight(i)), lambda i: F.element_at("points", i))
    return whole.select("group", "ring", (_area2(F.col("points")) / (2.0 * SCALE * SCALE)).alias("area"), corners.alias("points"))


def union(parts: DataFrame, group: str, part: str, rings: str) -> DataFrame:
    """GEO-16: ``group, shape, area``: the union of the polygons of each group, as polygons (rings: the outer one first, then its holes)
    without corners on straight lines, in degrees. Pieces that touch in points only stay polygons of their own; a piece within a hole of
    another is one too."""
    r = materialise(rings_of(outline(parts, group, part, rings)), "rings")
    degrees = F.transform("points", lambda p: F.struct((p["x"] / F.lit(float(SCALE))).alias("x"), (p["y"] / F.lit(float(SCALE))).alias("y")))
    r = r.withColumns({"points": degrees, "__x": F.transform("points", lambda p: p["x"]), "__y": F.transform("points", lambda p: p["y"])})
    box = {f"{m}_{c}": f(f"__{c}") / F.lit(float(SCALE)) for c in "xy" for m, f in (("low", F.array_min), ("high", F.array_max))}
    r = r.withColumns(box).drop("__x", "__y")
    outer = r.where("area > 0").select("group", F.col("ring").alias("outer"), F.col("area").alias("size"), F.col("points").alias("around"), *[F.col(c).alias(f"o_{c}") for c in box])
    # the middle of a hole's edge lies on no other ring: rings meet in corners only
    a, b = F.get("points", F.lit(0)), F.get("points", F.lit(1))
    holes = r.where("area < 0").withColumns({"mx": (a["x"] + b["x"]) / 2, "my": (a["y"] + b["y"]) / 2})
    inside = holes.join(outer.hint(SHUFFLED), "group").where("low_x >= o_low_x and high_x <= o_high_x and low_y >= o_low_y and high_y <= o_high_y").where(in_ring("mx", "my", F.col("around")))
    owned = inside.groupBy("group", "ring").agg(F.min_by(F.struct("outer", "points", "area"), F.struct("size", "outer")).alias("h"))
    owned = owned.groupBy("group", F.col("h.outer").alias("ring")).agg(F.array_sort(F.collect_list(F.col("h.points"))).alias("holes"), F.sum("h.area").alias("less"))
    shapes = r.where("area > 0").join(owned.hint(SHUFFLED), ["group", "ring"], "left")
    polygon = F.concat(F.array("points"), F.coalesce("holes", F.array().cast(r.schema["points"].dataType.simpleString().join(["array<", ">"]))))
    return shapes.groupBy("group").agg(F.array_sort(F.collect_list(polygon)).alias("shape"), F.sum(F.col("area") + F.coalesce("less", F.lit(0.0))).alias("area"))
