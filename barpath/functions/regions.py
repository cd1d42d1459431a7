"""From addresses, coordinates and names of meets to states and regions. SURVEY GEO-5..9, FN-30.

Where territories and the boxes of states matter, they come as columns: whoever has them joins them first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barpath.functions.parse import col

# States, the regions they belong to, estimated populations, and cities of the state that two regions share.
STATES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas", "CA": "California", "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware", "FL": "Florida", "GA": "Georgia",
    "HI": "Hawaii", "ID": "Idaho", "IL": "Illinois", "IN": "Indiana", "IA": "Iowa", "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine", "MD": "Maryland",
    "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota", "MS": "Mississippi", "MO": "Missouri", "MT": "Montana", "NE": "Nebraska", "NV": "Nevada", "NH": "New Hampshire", "NJ": "New Jersey",
    "NM": "New Mexico", "NY": "New York", "NC": "North Carolina", "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma", "OR": "Oregon", "PA": "Pennsylvania", "RI": "Rhode Island", "SC": "South Carolina",
    "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah", "VT": "Vermont", "VA": "Virginia", "WA": "Washington", "WV": "West Virginia", "WI": "Wisconsin", "WY": "Wyoming",
    "DC": "District of Columbia",
}
REGIONS = {
    "Alabama": ["Alabama"], "Florida": ["Florida"], "Georgia": ["Georgia"], "Illinois": ["Illinois"], "Indiana": ["Indiana"], "Michigan": ["Michigan"], "New Jersey": ["New Jersey"], "New York": ["New York"],
    "Ohio": ["Ohio"], "Wisconsin": ["Wisconsin"], "Carolina": ["North Carolina", "South Carolina"], "DMV": ["Delaware", "Maryland", "Virginia", "District of Columbia"], "Iowa-Nebraska": ["Iowa", "Nebraska"],
    "Minnesota-Dakotas": ["Minnesota", "North Dakota", "South Dakota"], "Missouri Valley": ["Missouri", "Kansas"], "Mountain North": ["Montana", "Idaho", "Colorado", "Wyoming"],
    "Mountain South": ["Utah", "Arizona", "New Mexico", "Nevada"], "New England": ["Maine", "New Hampshire", "Vermont", "Massachusetts", "Rhode Island", "Connecticut"],
    "Pacific Northwest": ["Washington", "Oregon", "Alaska"], "Pennsylvania-West Virginia": ["Pennsylvania", "West Virginia"], "Southern": ["Louisiana", "Mississippi", "Arkansas"],
    "Tennessee-Kentucky": ["Tennessee", "Kentucky"], "Texas-Oklahoma": ["Texas", "Oklahoma"], "Hawaii and International": ["Hawaii"],
}
POPULATIONS = {
    "Alabama": 5108000, "Alaska": 732000, "Arizona": 7431000, "Arkansas": 3067000, "California": 38965000, "Colorado": 5917000, "Connecticut": 3618000, "Delaware": 1031000, "Florida": 23244000,
    "Georgia": 11029000, "Hawaii": 1435000, "Idaho": 1967000, "Illinois": 12587000, "Indiana": 6862000, "Iowa": 3207000, "Kansas": 2940000, "Kentucky": 4506000, "Louisiana": 4573000, "Maine": 1423000,
    "Maryland": 6164000, "Massachusetts": 7001000, "Michigan": 10037000, "Minnesota": 5742000, "Mississippi": 2940000, "Missouri": 6196000, "Montana": 1122000, "Nebraska": 1978000, "Nevada": 3194000,
    "New Hampshire": 1403000, "New Jersey": 9290000, "New Mexico": 2114000, "New York": 19336000, "North Carolina": 10835000, "North Dakota": 783000, "Ohio": 11785000, "Oklahoma": 4019000,
    "Oregon": 4233000, "Pennsylvania": 12972000, "Rhode Island": 1095000, "South Carolina": 5373000, "South Dakota": 919000, "Tennessee": 7126000, "Texas": 30503000, "Utah": 3423000, "Vermont": 647000,
    "Virginia": 8715000, "Washington": 7812000, "West Virginia": 1770000, "Wisconsin": 5910000, "Wyoming": 584000,
}
SPLIT_STATE, NORTH, SOUTH, SPLIT_LATITUDE = "California", "California North Central", "California South", 35.5
SOUTH_CITIES = (
    "los angeles", "long beach", "anaheim", "santa ana", "riverside", "stockton", "irvine", "chula vista", "fremont", "san bernardino", "fontana", "oxnard", "moreno valley", "huntington beach",
    "glendale", "santa clarita", "garden grove", "oceanside", "rancho cucamonga", "ontario", "corona", "lancaster", "palmdale", "pomona", "torrance", "orange", "fullerton", "elk grove", "hayward",
    "escondido", "sunnyvale", "pasadena", "hollywood", "burbank", "west hollywood", "beverly hills", "santa monica", "venice", "manhattan beach", "redondo beach", "hermosa beach", "culver city",
    "inglewood", "hawthorne", "compton", "downey", "norwalk", "whittier", "lakewood", "cerritos", "cypress", "la mirada", "woodland hills", "van nuys", "north hollywood", "sherman oaks", "encino",
    "tarzana", "costa mesa", "mission viejo", "westminster", "newport beach", "buena park", "tustin", "yorba linda", "san clemente", "laguna niguel", "lake forest", "placentia", "victorville",
    "rialto", "chino", "upland", "redlands", "chino hills", "diamond bar", "hesperia", "apple valley", "colton", "yucaipa", "highland", "san diego", "carlsbad", "el cajon", "vista", "san marcos",
    "encinitas", "national city", "la mesa", "santee", "poway", "coronado", "ventura", "thousand oaks", "simi valley", "santa barbara", "santa maria", "lompoc", "camarillo", "carpinteria", "goleta",
    "paso robles", "san luis obispo", "arroyo grande",
)
NORTH_CITIES = (
    "san francisco", "oakland", "san jose", "fremont", "hayward", "sunnyvale", "santa clara", "berkeley", "daly city", "san mateo", "richmond", "vallejo", "concord", "fairfield", "antioch", "temecula",
    "livermore", "santa rosa", "petaluma", "napa", "emeryville", "alameda", "palo alto", "mountain view", "cupertino", "milpitas", "union city", "sacramento", "stockton", "modesto", "salinas",
    "santa cruz", "watsonville", "monterey", "merced", "turlock", "tracy", "manteca", "lodi", "davis", "woodland", "yuba city", "marysville", "chico", "redding", "eureka", "ukiah",
)
#: What names of meets say of a region, in order; and more ways to name two states.
REGION_WORDS = {
    "New England": r"new\s*england|northeast", "Pacific Northwest": r"pacific\s*northwest|pnw", "Mountain North": r"mountain\s*north|rocky\s*mountain", "Mountain South": r"mountain\s*south|southwest",
    "Southern": r"southern\s*states|deep\s*south", NORTH: r"nor\s*cal|northern\s*california|bay\s*area|san\s*francisco", SOUTH: r"so\s*cal|southern\s*california|los\s*angeles|san\s*diego",
}
MORE_WORDS = {"California": r"|socal|norcal|nor\s*cal|so\s*cal"}
#: The confidence of each method, what agreeing sources add, and what a box takes.
CONFIDENCE = {
    "coordinates_validated": 0.95, "state_field_validated": 0.98, "state_field": 0.98, "coordinates_polygon": 0.95, "coordinates_bbox": 0.95, "address_state": 0.85, "meet_name_region": 0.90,
    "meet_name_state": 0.80, "historical_data": 0.85,
}
AGREE, BOX = 0.05, 0.9


def _map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def _first(values: Column) -> Column:
    return F.get(F.filter(values, lambda v: v.isNotNull()), F.lit(0))


def region_of_mapped_state(state) -> Column:
    """FN-30: the region of a state that is in one region only."""
    return F.try_element_at(_map({s: r for r, states in REGIONS.items() for s in states}), col(state))


def population(state) -> Column:
    """FN-30."""
    return F.try_element_at(_map(POPULATIONS), col(state))


def state_of_address(address) -> Column:
    """GEO-6: the state that one of the last three comma parts is or begins with: by its letters, else by its name. Parts that name the
    country are no states; an address without a comma has none."""
    parts = F.transform(F.split(col(address), ","), lambda p: F.trim(p))
    last = F.slice(parts, F.greatest(F.size(parts) - 2, F.lit(1)), 3)
    word = lambda p: F.split(p, " ")[0]
    codes, names = _map(STATES), _map({n.lower(): n for n in STATES.values()})
    by_code = _first(F.transform(last, lambda p: F.coalesce(F.try_element_at(codes, F.upper(p)), F.try_element_at(codes, F.upper(word(p))))))
    abroad = lambda p: F.contains(p, F.lit("united states")) | F.contains(p, F.lit("usa")) | (p == "america")
    named = lambda p: F.when(~abroad(p), F.coalesce(F.try_element_at(names, p), F.try_element_at(names, word(p))))
    return F.when(F.size(parts) >= 2, F.coalesce(by_code, _first(F.transform(last, lambda p: named(F.lower(p))))))


def state_of_field(state) -> Column:
    """What a state field says: its letters, or an address in it."""
    t = F.trim(col(state))
    return F.coalesce(F.try_element_at(_map(STATES), F.upper(t)), state_of_address(t))


def city_region(address) -> Column:
    """The part of the divided state that a city of an address lies in; southern ones are looked for first."""
    low = F.lower(col(address))
    has = lambda cities: F.exists(F.array(*map(F.lit, cities)), lambda c: F.contains(low, c))
    return F.when(has(SOUTH_CITIES), SOUTH).when(has(NORTH_CITIES), NORTH)


def region_of_state(state, address, lat, lng, territory=None) -> Column:
    """GEO-5: the region of a state. The divided one goes by its territory that holds the point (``territory``, a column: its name, or
    null) and else the latitude; without a point by the city, and else to the north. Without territories (no column) the city comes
    before the latitude. A coordinate of 0 is missing."""
    point = (F.coalesce(col(lat), F.lit(0.0)) != 0) & (F.coalesce(col(lng), F.lit(0.0)) != 0)
    half = F.when(col(lat) >= SPLIT_LATITUDE, NORTH).otherwise(SOUTH)
    city = city_region(address)
    divided = F.coalesce(F.when(point, half if territory is None else F.coalesce(col(territory), half)), city, F.lit(NORTH)) if territory is not None else F.coalesce(city, F.when(point, half), F.lit(NORTH))
    return F.when(col(state) == SPLIT_STATE, divided).otherwise(region_of_mapped_state(state))


def location_of_name(name) -> Column:
    """GEO-7: a struct of type and value: the first region, else the first state, that the name of a meet speaks of. A state is spoken of
    by its name, or its two letters at the end of a word."""

    def pattern(code: str, state: str) -> str:
        whole = state.lower().replace(" ", r"\s*")
        if code == "DC":  # the city's short name comes first
            return rf"(?i)washington\s*dc|dc(?:\s|$)|{whole}"
        return rf"(?i){whole}|{code.lower()}(?:\s|$){MORE_WORDS.get(state, '')}"

    found = lambda kind, value: F.struct(F.lit(kind).alias("type"), F.lit(value).alias("value"))
    out = F.lit(None).cast("struct<type:string,value:string>")
    for code, state in sorted(STATES.items(), key=lambda x: (x[0] == "DC", x[1]), reverse=True):
        out = F.when(col(name).rlike(pattern(code, state)), found("state", state)).otherwise(out)
    for region, words in reversed(REGION_WORDS.items()):
        out = F.when(col(name).rlike(f"(?i){words}"), found("region", region)).otherwise(out)
    return out


def confidence(method: str, coordinates: Column, address: Column, history: bool = False, named: bool = False) -> Column:
    """GEO-8: of a method, with what agreeing sources add; at most 1."""
    sure = F.lit(CONFIDENCE[method] + AGREE * history + AGREE * named) + F.when(coordinates & address, AGREE).otherwise(0.0)
    return F.least(sure, F.lit(1.0)) * (BOX if method == "coordinates_bbox" else 1.0)


def assign(lat, lng, state, address, name, box_state, polygon, territory, history) -> Column:
    """GEO-8: a struct of region, method and confidence, by the first step that gives a region:

    - the coordinates' state, where the state field says another; the state field, where it says the same;
    - the state field, without coordinates;
    - the territory that holds the point, else the region of the box that does;
    - the state in the address;
    - the name of the meet, a region and then a state;
    - what meets of the name had most often.

    Columns: ``box_state``, the state whose box holds the point; ``polygon``, the region whose territory holds it; ``territory``, the part of the
    divided state that does; ``history``. A coordinate of 0 is missing.
    """
    point = (F.coalesce(col(lat), F.lit(0.0)) != 0) & (F.coalesce(col(lng), F.lit(0.0)) != 0)
    some = lambda c: F.coalesce(col(c), F.lit("")) != ""
    said, boxed = F.when(some(state), state_of_field(state)), F.when(point, col(box_state))
    anything = some(address) | some(state)
    nothing, yes = F.lit(None).cast("string"), F.lit(True)
    of_box = region_of_state(boxed, nothing, lat, lng, territory)
    place = location_of_name(name)
    parsed = F.coalesce(state_of_address(address), state_of_address(state))
    parsed_from = F.when(state_of_address(address).isNotNull(), col(address)).otherwise(col(state))
    steps = [
        ("coordinates_validated", F.when(said != boxed, of_box), yes, yes, {}), ("state_field_validated", F.when(said == boxed, region_of_state(said, address, lat, lng, territory)), yes, yes, {}),
        ("state_field", F.when(~point, region_of_state(said, address, lat, lng, territory)), F.lit(False), yes, {}),
        ("coordinates_polygon", F.when(point, col(polygon)), yes, anything, {}), ("coordinates_bbox", of_box, yes, anything, {}),
        ("address_state", region_of_state(parsed, parsed_from, lat, lng, territory), point, yes, {}),
        ("meet_name_region", F.when(place["type"] == "region", place["value"]), point, anything, {"named": True}),
        ("meet_name_state", F.when(place["type"] == "state", region_of_state(place["value"], address, lat, lng, territory)), point, anything, {"named": True}),
        ("historical_data", F.when(some(name), col(history)), point, anything, {"history": True}),
    ]
    each = [F.when(r.isNotNull(), F.struct(r.alias("region"), F.lit(m).alias("method"), F.round(confidence(m, c, a, **more), 4).alias("confidence"))) for m, r, c, a, more in steps]
    none = F.struct(nothing.alias("region"), nothing.alias("method"), F.lit(0.0).alias("confidence"))
    return F.coalesce(*each, none)


def validate(region, lat, lng, box_state) -> Column:
    """GEO-9: a struct of verdict, right (the region of the coordinates) and reason. Valid, contaminated, or invalid where
    something is missing."""
    point = (F.coalesce(col(lat), F.lit(0.0)) != 0) & (F.coalesce(col(lng), F.lit(0.0)) != 0)
    right = region_of_state(box_state, F.lit(None).cast("string"), lat, lng)
    known = point & (F.coalesce(col(region), F.lit("")) != "")
    reason = F.when(~known, "missing").when(col(box_state).isNull(), "outside").when(right.isNull(), "no region").when(col(region) == right, "right").otherwise("other")
    verdict = F.when(~known, "invalid").when(F.coalesce(col(region) == right, F.lit(False)), "valid").otherwise("contaminated")
    return F.struct(verdict.alias("verdict"), F.when(known, right).alias("right"), reason.alias("reason"))
