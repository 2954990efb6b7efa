"""Postal addresses that denote the same place, however they are written."""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicloom.llm.names import edit_distance, fold
from civicloom.operators.skew import block_join
from civicloom.session import stage

#: Neighbours a key is compared with in each sorted pass, and sorted rows of a task.
WINDOW, TASK_ROWS = 12, 4_000

# Spellings of street types, directions, units and common words.
STREET_TYPES = {
    x: line.split()[0]
    for line in """
street st str strt
avenue ave av aven
boulevard blvd boul blv bvd
drive dr drv
court ct crt
lane ln
place pl
road rd
square sq sqr
highway hwy hiway hway
parkway pkwy pky pkway
terrace ter terr
circle cir circ
way wy
trail trl
pike pk
loop lp
plaza plz
crescent cres
alley aly
""".strip().split("\n")
    for x in line.split()
}
DIRECTIONS = {
    x: line.split()[0]
    for line in "n north\ns south\ne east\nw west\nne northeast\nnw northwest\nse southeast\nsw southwest".split("\n")
    for x in line.split()
}
ORDINALS = dict(zip("first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth thirteenth fourteenth fifteenth sixteenth seventeenth eighteenth nineteenth twentieth".split(), range(1, 21)))
WORDS = {"ft": "fort", "lk": "lake", "mt": "mount", "mtn": "mountain", "st": "saint", "n": "north", "s": "south", "no": "north", "so": "south", "nth": "north", "sth": "south", "e": "east", "w": "west", "bldg": "building", "bld": "building", "fed": "federal", "ctr": "center", "centre": "center", "cthse": "courthouse", "twr": "tower", "plz": "plaza", "sq": "square", "hse": "house", "ofc": "office", "vlg": "village", "spgs": "springs", "hts": "heights", "pt": "port"}
BUILDING_WORDS = {"building", "plaza", "tower", "center", "house", "courthouse", "hall", "complex", "annex", "tower", "mall", "office"}

_UNIT = re.compile(r"(?:\b(?P<kind>suite|ste|room|rm|unit|apartment|apt|floor|flr|fl|no|number)\b\.?\s*#?\s*|#\s*)(?P<value>\d+[a-z]?(?:-\d+)?|[a-z]\d*\b)|\b(?P<nth>\d+)(?:st|nd|rd|th)\s+(?:floor|flr|fl)\b\.?")
_NTH = re.compile(r"\b(" + "|".join(ORDINALS) + r")(?=\s+(?:floor|flr|fl)\b)")
_BOX = re.compile(r"\bp\.?\s*o\.?\s*box\s*#?\s*\w+|\bbox\s+\d+")
_ORDINAL = re.compile(r"^(\d+)(?:st|nd|rd|th)$")
_NUMBER = re.compile(r"^\d+[a-z]?(?:-\d+[a-z]?)?$")


@dataclass
class Place:
    """What a record tells of its place; an empty part is unknown."""

    number: str = ""
    core: str = ""
    direction: str = ""
    kind: str = ""
    unit: str = ""
    building: str = ""


def _tokens(text: str) -> list[str]:
    text = re.sub(r"\b([nsew])\.\s?([ew])\b\.?", r"\1\2", text)
    return [t for t in re.split(r"[^a-z0-9'-]+", text.replace("'", "")) if t and t != "-"]


def _take_unit(text: str, place: Place) -> str:
    def put(m: re.Match[str]) -> str:
        if m.group("nth"):
            found = "f" + m.group("nth")
        else:
            value = m.group("value").lstrip("0") or "0"
            found = ("f" if (m.group("kind") or "").startswith("fl") else "u") + value
        place.unit = place.unit or found
        return " "

    return _UNIT.sub(put, _NTH.sub(lambda m: f"{ORDINALS[m.group(1)]}th", text))


def _building_name(tokens: list[str]) -> str:
    words = [WORDS.get(t, t) for t in tokens]
    return "_".join(w for w in words if w not in ("the", "at", "of"))


def _street(tokens: list[str], place: Place) -> None:
    """Reads number, direction, core and type off the tokens of a street, in any of the usual orders."""
    words = list(tokens)
    if not place.number:
        if words and _NUMBER.match(words[0]):
            place.number = words.pop(0)
        elif words and _NUMBER.match(words[-1]):
            place.number = words.pop()
    if len(words) > 1 and words[-1] in DIRECTIONS:
        place.direction = place.direction or DIRECTIONS[words.pop()]
    if len(words) > 1 and words[0] in DIRECTIONS:
        place.direction = place.direction or DIRECTIONS[words.pop(0)]
    if len(words) > 1 and words[-1] in STREET_TYPES:
        place.kind = place.kind or STREET_TYPES[words.pop()]
    if len(words) > 1 and words[-1] in DIRECTIONS:
        place.direction = place.direction or DIRECTIONS[words.pop()]
    core = []
    for w in words:
        m = _ORDINAL.match(w)
        core.append(m.group(1) if m else str(ORDINALS[w]) if w in ORDINALS else WORDS.get(w, w))
    place.core = place.core or "".join(core)


def parse_place(address: str | None, building: str | None, suite: str | None) -> Place:
    """The parts of an address whose suite, building and street may stand in any field and order."""
    place = Place()
    streets: list[list[str]] = []
    for text, field in ((suite, "s"), (address, "a"), (building, "b")):
        if not text:
            continue
        text = _BOX.sub(" ", fold(text))
        if field == "s":
            bare = text.strip(" .,#")
            if re.fullmatch(r"\d+[a-z]?(?:-\d+)?|[a-z]", bare):
                place.unit = place.unit or "u" + (bare.lstrip("0") or "0")
                continue
        for part in re.split(r"[,;()\n]+", text):
            part = _take_unit(part, place)
            tokens = _tokens(part)
            if not tokens:
                continue
            numbered = _NUMBER.match(tokens[0]) or _NUMBER.match(tokens[-1])
            named = any(WORDS.get(t, t) in BUILDING_WORDS for t in tokens) and not (tokens[-1] in STREET_TYPES and WORDS.get(tokens[-1], tokens[-1]) not in BUILDING_WORDS)
            if len(tokens) == 1 and numbered and field != "s":
                place.number = place.number or tokens[0]
            elif field == "b" or (named and not numbered):
                if not (field == "b" and numbered and not named and len(tokens) > 1):
                    place.building = place.building or _building_name(tokens)
                else:
                    streets.append(tokens)
            elif field == "a":
                streets.append(tokens)
    numbered = [t for t in streets if _NUMBER.match(t[0]) or _NUMBER.match(t[-1])]
    for tokens in numbered or streets:
        _street(tokens, place)
        if place.core:
            break
    if numbered and len(streets) > len(numbered) and not place.building:
        place.building = _building_name(next(t for t in streets if t not in numbered))
    return place


def city_key(city: str | None) -> str:
    """A city's name with its abbreviations written out, letters only."""
    return "".join(WORDS.get(t, t) for t in _tokens(fold(city))) if city else ""


def zip_key(zip_code: str | None) -> str:
    """The five digits of a postal code, of which leading zeros may be lost; empty if it isn't one."""
    digits = re.sub(r"\s", "", (zip_code or "").split("-")[0])
    return digits.zfill(5) if digits.isdigit() and 3 <= len(digits) <= 5 else ""


def alike(a: str, b: str) -> bool:
    """Whether two names differ by a slip at most, word by word; numbers in them must be equal."""
    if a == b:
        return True
    if not a or not b or re.sub(r"\D", "", a) != re.sub(r"\D", "", b):
        return False
    if "_" in a or "_" in b:
        x, y = a.split("_"), b.split("_")
        return len(x) == len(y) and all(map(alike, x, y))
    n = min(len(a), len(b))
    most = 2 if n >= 7 else 1 if n >= 3 else 0
    return most > 0 and edit_distance(a, b, most + 1) <= most


def places_of(rows: DataFrame, key: str, columns: dict[str, str], states: dict[str, str]) -> DataFrame:
    """(key, number, core, direction, kind, unit, building, city, zip, state) of each record with a key.

    ``columns`` names the columns for address, building, suite, city, state and zip; ``states`` gives the
    code of a state by name or code in lower case. All parts are strings; an unknown one is empty.
    """
    names = ["address", "building", "suite", "city", "state", "zip"]
    chosen = rows.filter(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("key"), *[F.col(columns[c]).cast("string").alias(c) for c in names]).distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                v = {c: x if isinstance(x := getattr(r, c), str) else None for c in names}
                p = parse_place(v["address"], v["building"], v["suite"])
                state = (v["state"] or "").strip().lower()
                out.append((r.key, p.number, p.core, p.direction, p.kind, p.unit, p.building, city_key(v["city"]), zip_key(v["zip"]), states.get(state, state)))
            yield pd.DataFrame(out, columns=["key", "number", "core", "direction", "kind", "unit", "building", "city", "zip", "state"])

    return chosen.mapInPandas(run, ", ".join(f"{c} string" for c in ["key", "number", "core", "direction", "kind", "unit", "building", "city", "zip", "state"])).distinct()


def neighbours(keys: DataFrame, order: list[Column], window: int = WINDOW, partitions: int | None = None) -> DataFrame:
    """(a, b), a < b: the keys (name, place) alike among the ``window`` next in any of several orders.

    ``keys`` has k, number, name, place. ``order`` gives a sort key for each pass. All passes are one
    range-partitioned sort, with more partitions the more keys there are; each task slides over its sorted rows, and
    what a window reaches over the edge of a partition is compared in a second, small step. Should a partition turn out
    shorter than a window, which could then reach beyond it, the sort is done again with half of them. Numbers
    must be equal.
    """
    partitions = partitions or max(1, keys.count() * len(order) // TASK_ROWS)
    passes = keys.withColumn("_o", F.explode(F.array(*[F.concat(F.lit(f"{i}|"), o) for i, o in enumerate(order)])))
    ranged = passes.repartitionByRange(partitions, "_o", "k").sortWithinPartitions("_o", "k").select("_o", "k", "number", "name", "place")

    def same(x: tuple, y: tuple) -> bool:
        return x[0][:2] == y[0][:2] and x[1] != y[1] and x[2] == y[2] and alike(x[3], y[3]) and alike(x[4], y[4])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        recent: deque = deque(maxlen=window - 1)
        heads: list[tuple] = []
        part = TaskContext.get().partitionId()
        for batch in batches:
            found = []
            for row in batch.itertuples(index=False, name=None):
                found += [(*sorted((row[1], old[1])), -1, -1, "", "", "", "") for old in recent if same(old, row)]
                recent.append(row)
                if len(heads) < window - 1:
                    heads.append(row)
            yield pd.DataFrame(found, columns=columns)
        edge = [("", "", part, i, *r[:1], r[1], *[F_SEP.join(r[2:])], "h") for i, r in enumerate(heads)]
        edge += [("", "", part, len(recent) - 1 - i, *r[:1], r[1], *[F_SEP.join(r[2:])], "t") for i, r in enumerate(recent)]
        yield pd.DataFrame(edge, columns=columns)

    columns = ["a", "b", "part", "rank", "o", "k", "rest", "side"]
    found = stage(ranged.mapInPandas(run, "a string, b string, part int, rank int, o string, k string, rest string, side string"), "windows")
    edges = found.filter("side = 'h'")
    if partitions > 1 and edges.groupBy("part").count().agg(F.min("count"), F.count("*")).filter((F.col("min(count)") < window - 1) | (F.col("count(1)") < partitions)).count():
        return neighbours(keys, order, window, partitions // 2)
    heads = edges.select((F.col("part") - 1).alias("part"), F.col("rank").alias("i"), F.col("o").alias("oh"), F.col("k").alias("kh"), F.col("rest").alias("rh"))
    tails = found.filter("side = 't'").select("part", F.col("rank").alias("j"), F.col("o").alias("ot"), F.col("k").alias("kt"), F.col("rest").alias("rt"))

    @F.pandas_udf("boolean")
    def agree(oh: pd.Series, kh: pd.Series, rh: pd.Series, ot: pd.Series, kt: pd.Series, rt: pd.Series) -> pd.Series:
        return pd.Series([same((a, b, *c.split(F_SEP)), (d, e, *f.split(F_SEP))) for a, b, c, d, e, f in zip(oh, kh, rh, ot, kt, rt)])

    over = tails.join(heads, "part").filter(F.col("i") + F.col("j") < window - 1).filter(agree("oh", "kh", "rh", "ot", "kt", "rt"))
    inner = found.filter("part = -1").select("a", "b")
    return stage(inner.unionByName(over.select(F.least("kh", "kt").alias("a"), F.greatest("kh", "kt").alias("b"))).distinct(), "near")


F_SEP = "\x1f"


def _sorted_letters(c: Column) -> Column:
    return F.array_join(F.array_sort(F.split(c, "")), "")


def _key_pairs(keys: DataFrame, numbered: bool) -> DataFrame:
    """(a, b) both ways, each key with itself too: keys that are written alike."""
    sep = F.lit(" ")
    order = [
        F.concat("number", sep, "name", sep, "place"),
        F.concat("place", sep, "name", sep, "number"),
        F.concat(_sorted_letters(F.col("name")), sep, "number", sep, "place"),
        F.concat("number", sep, "place", sep, "name"),
        F.concat(F.reverse("name"), sep, "number", sep, "place"),
        F.concat("name", sep, "number", sep, _sorted_letters(F.col("place"))),
    ]
    keys = stage(keys, "keys")
    near = neighbours(keys, order if numbered else order[:3] + order[4:])
    return near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"))).unionByName(keys.select(F.col("k").alias("a"), F.col("k").alias("b")))


def _fits(a: str, b: str) -> Column:
    return (F.col(a) == "") | (F.col(b) == "") | (F.col(a) == F.col(b))


def _digits(name: str) -> Column:
    return F.regexp_replace(name, "[^0-9]", "")


def _names_alike() -> Callable[..., Column]:
    @F.pandas_udf("boolean")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([alike(x, y) for x, y in zip(a, b)], dtype=bool)

    return run


def _code_blocks(base: Column, asks: bool) -> Column:
    """Blocks in which a record that asks meets every record of its ``base`` whose postal code may be the same.

    Known codes may differ by a digit (one of five blocks leaves it out) or in the order of the digits. Where a
    code is unknown the states decide, equal or unknown.
    """
    block = lambda *parts: F.concat_ws("|", base, *[F.lit(x) if isinstance(x, str) else x for x in parts])
    code, state = F.col("zip"), F.col("state")
    coded = [block(str(i), F.substring(code, 1, i), F.substring(code, i + 2, 5)) for i in range(5)] + [block("any order", _sorted_letters(code))]

    def stated(mark: str) -> Column:
        one, none, every = block(mark, "in", state), block(mark, "none"), block(mark, "every")
        return F.when(state != "", F.array(one, none if asks else every)).otherwise(F.array(every) if asks else F.array(none, every))

    if asks:  # a known code meets equal and unknown ones, an unknown code meets all
        return F.when(code != "", F.concat(F.array(*coded), stated("other unknown"))).otherwise(stated("own unknown"))
    return F.concat(F.when(code != "", F.array(*coded)).otherwise(stated("other unknown")), stated("own unknown"))


def same_place_pairs(places: DataFrame) -> DataFrame:
    """(key_a, key_b), key_a < key_b: the records that denote the same place.

    ``places`` is as ``places_of`` gives. Records are first told apart by site, the street address or
    building without the unit, so exact copies and the many offices of one building count once. Sites with
    equal keys meet by a join, so a site with any number of spellings loses none; keys that differ by slips
    are found by sorted neighbourhoods in several orders of their components. Sites without a city meet every
    other of their number (or kind of building name) and postal code by a join. Then the strict checks: the
    number equal, direction, type and state equal where both are known, and, when the records are paired, the
    unit equal where both are known. A record without a street has the address its building has in others.
    Records that tell neither street nor building match nothing.
    """
    site_columns = ["number", "core", "direction", "kind", "building", "city", "zip", "state"]
    rows = stage(places.withColumn("site", F.sha2(F.concat_ws("\x1f", *site_columns), 256)), "places")
    sites = stage(rows.select("site", *site_columns).distinct(), "sites")
    town = F.when(F.col("city") != "", F.col("city")).when(F.col("zip") != "", F.concat(F.lit("zip"), "zip")).otherwise("")
    streets = sites.filter("number != '' and core != ''").withColumn("place", town).withColumn("k", F.concat_ws(" ", "number", "core", "place"))
    houses = sites.filter("building != ''").withColumn("place", town).withColumn("k", F.concat_ws(" ", "building", "place"))
    named = lambda df, name, number: df.select("k", number.alias("number"), F.col(name).alias("name"), "place").distinct()
    side = lambda df, s: df.select(F.col("k").alias(f"k_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in ("site", *site_columns)])

    def meet(found: DataFrame, pairs: DataFrame) -> DataFrame:
        joined = block_join(side(found, "a").withColumnRenamed("k_a", "a"), pairs, ["a"])
        return block_join(joined.withColumnRenamed("b", "k"), side(found, "b").withColumnRenamed("k_b", "k"), ["k"])

    def both_ways(df: DataFrame, *parts: str) -> DataFrame:
        turned = [F.struct(*[F.col(f"{c}_{x}").alias(f"{c}_{y}") for c in parts for x, y in zip(w, "ab")]) for w in ("ab", "ba")]
        return df.select(F.explode(F.array(*turned)).alias("p")).select("p.*")

    agree = _fits("direction_a", "direction_b") & _fits("kind_a", "kind_b") & _fits("state_a", "state_b")
    by_street = meet(streets, _key_pairs(named(streets, "core", F.col("number")), True)).filter(agree).select("site_a", "site_b")
    # A record without a city meets those of its street, slips included, whose postal code isn't another.
    one_code = (F.col("zip_a") == "") | (F.col("zip_b") == "") | (F.levenshtein("zip_a", "zip_b") <= 1) | (_sorted_letters(F.col("zip_a")) == _sorted_letters(F.col("zip_b")))
    at_street = F.concat_ws("|", "number", _digits("core"))
    code = lambda df, s, asks: side(df.withColumn("k", F.explode(_code_blocks(at_street, asks))), s).withColumnRenamed(f"k_{s}", "k")
    met = block_join(code(streets.filter("city = ''"), "a", True), code(streets, "b", False), ["k"]).filter(agree & one_code & (F.levenshtein("core_a", "core_b") <= 4))
    by_code = both_ways(met.filter(_names_alike()("core_a", "core_b")), "site")
    address = stage(by_street.unionByName(by_code).distinct(), "address-pairs")

    no_conflict = (F.col("number_a") == "") | (F.col("number_b") == "") | (F.col("core_a") == "") | (F.col("core_b") == "")
    one_street = (F.col("number_a") == F.col("number_b")) & (F.levenshtein("core_a", "core_b") <= 2) & _fits("direction_a", "direction_b") & _fits("kind_a", "kind_b")
    by_house = meet(houses, _key_pairs(named(houses, "building", F.lit("")), False)).filter(_fits("state_a", "state_b") & (no_conflict | one_street))
    at_house = F.concat_ws("|", F.size(F.split("building", "_")).cast("string"), _digits("building"))
    house_code = lambda df, s, asks: side(df.withColumn("k", F.explode(_code_blocks(at_house, asks))), s).withColumnRenamed(f"k_{s}", "k")
    coded = block_join(house_code(houses.filter("city = '' and zip != ''"), "a", True), house_code(houses, "b", False), ["k"])
    house_by_code = coded.filter(_fits("state_a", "state_b") & one_code & (no_conflict | one_street)).filter(_names_alike()("building_a", "building_b"))
    house = both_ways(by_house.select("site_a", "site_b", "core_a", "core_b").unionByName(house_by_code.select("site_a", "site_b", "core_a", "core_b")), "site", "core")
    house = stage(house.distinct(), "house-pairs")
    # A site known by its building alone stands where others put the building.
    lone = house.filter("core_a = '' and core_b != ''").select(F.col("site_a").alias("lone"), F.col("site_b").alias("site_a"))
    led = block_join(lone, address, ["site_a"]).select(F.col("lone").alias("site_a"), "site_b")
    every = [address, house.select("site_a", "site_b"), led, led.select(F.col("site_b").alias("site_a"), F.col("site_a").alias("site_b"))]
    linked = stage(reduce(DataFrame.unionByName, every).distinct(), "site-pairs")

    record = lambda s: rows.select(F.col("site").alias(f"site_{s}"), F.col("key").alias(f"key_{s}"), F.col("unit").alias(f"unit_{s}"))
    left = stage(block_join(record("a"), linked, ["site_a"]), "sited")  # each record with the sites of its place
    known = left.filter("unit_a != ''")
    right = record("b")
    exact = block_join(known.withColumnRenamed("unit_a", "unit"), right.filter("unit_b != ''").withColumnRenamed("unit_b", "unit"), ["site_b", "unit"]).select("key_a", "key_b")
    open_left = block_join(left.filter("unit_a = ''"), right, ["site_b"]).select("key_a", "key_b")
    open_right = block_join(known, right.filter("unit_b = ''"), ["site_b"]).select("key_a", "key_b")
    pairs = exact.unionByName(open_left).unionByName(open_right).filter(F.col("key_a") != F.col("key_b"))
    return pairs.select(F.least("key_a", "key_b").alias("key_a"), F.greatest("key_a", "key_b").alias("key_b")).distinct()
