"""Records of two sources that denote the same person, found without keys and without labels."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from civicloom.llm.names import Name, edit_distance, parse_name, roots
from civicloom.operators.skew import block_join, lookup_join
from civicloom.session import stage

#: The features, each a likeness from 0 to 1 of which 0.5 means unknown (a surname is always known). Their
#: steps are tenths, so distinct vectors are bounded by the product of the steps however many pairs there are.
FEATURES = ["last", "first", "middle", "birth", "state", "chamber", "time", "identifier", "suffix", "unclashed"]
ENTITY = "id string, names array<string>, years array<int>, states array<string>, chambers array<string>, first_year int, last_year int, ids array<string>"
PREPARED = "id string, names string, years array<int>, states array<string>, chambers array<string>, first_year int, last_year int, ids array<string>, keys array<string>"


def _values(x: object) -> list:
    return [] if x is None else [v for v in x if v is not None]


def _parsed(names: object) -> list[Name]:
    out = []
    for text in _values(names):
        given, _, family = text.partition("\t")
        if (n := parse_name(given, family or None)) is not None and n not in out:
            out.append(n)
    return out


def _packed(names: list[Name]) -> str:
    """Parsed names as one text: names by ``;``, parts by ``|``, other surnames by ``+`` (parts are letters and digits)."""
    return ";".join("|".join((n.last, n.first, n.middle[0] if n.middle else "", n.suffix, n.nick, "+".join(n.also))) for n in names)


@lru_cache(maxsize=50_000)
def _unpacked(text: str) -> tuple[Name, ...]:
    out = []
    for name in text.split(";") if text else []:
        last, first, middle, suffix, nick, also = name.split("|")
        out.append(Name(last, first, (middle,) if middle else (), suffix, nick, tuple(also.split("+")) if also else ()))
    return tuple(out)


def _keys(row: object, names: list[Name], left: bool) -> set[str]:
    """Blocking keys of a record. Two records meet if they share any.

    Every key holds a surname, whole or with a letter left out, or its first letters: people of unlike surnames
    who share a given name, a state and a first year are coincidences that grow with the square of the
    data. Beside it stand one or two partial facts, so that any of them may be absent or wrong.
    """
    years, states = _values(row.years), _values(row.states)
    near = {y + d for y in years for d in ((-1, 0, 1) if left else (0,))}
    firsts = {r for n in names for g in (n.first, n.nick) if len(g) > 1 for r in roots(g)}
    initials = {r[0] for n in names for g in (n.first, n.nick) if g for r in (g, *roots(g))}
    start = row.first_year if row.first_year is not None and row.first_year == row.first_year and row.first_year > 0 else None
    lacking, initialled = not years or not states, any(len(n.first) < 2 for n in names)
    ids = [row.id] if left else _values(row.ids)
    keys: set[str] = set()
    for last in {x for n in names for x in (n.last, *n.also) if x}:
        slips = {last, *(last[:i] + last[i + 1 :] for i in range(len(last)))} if len(last) > 3 else {last}
        keys.update(f"A|{x}|{f}|{s}" for x in slips for f in firsts for s in states)
        keys.update(f"B|{x}|{f}|{y}" for x in slips for f in firsts for y in years)
        keys.update(f"B|{last}|{f}|{y}" for f in firsts for y in near)
        keys.update(f"C|{last}|{y}|{s}" for y in near for s in states)
        keys.update(f"D|{last}|{i}|{s}" for i in initials for s in states)
        keys.update(f"E|{last}|{i}|{y}" for i in initials for y in near)
        keys.update(f"F|{i.lower()}|{last[0]}" for i in ids)
        if start:
            keys.update(f"G|{last}|{i}|{int(start)}" for i in initials)
            keys.update(f"H|{last[:3]}|{f}|{s}|{int(start)}" for f in firsts for s in states)
        # Where one side lacks a year or a state, the surname and given name must do (its initial, if no more is
        # given); only that side is loose, so two complete records never meet this way.
        for kind, loose in (("I", lacking or left), ("J", lacking or not left)):
            keys.update(f"{kind}|{last}|{f}" for f in firsts if loose)
        for kind, loose in (("K", (lacking and initialled) or left), ("L", (lacking and initialled) or not left)):
            keys.update(f"{kind}|{last}|{i}" for i in initials if loose)
    return keys


def prepared(entities: DataFrame, left: bool) -> DataFrame:
    """The records with their names parsed, once, and their blocking keys; lists without nulls."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                names = _parsed(r.names)
                rows.append((_packed(names), sorted(_keys(r, names, left))))
            yield batch.drop(columns="names").assign(names=[x for x, _ in rows], keys=[k for _, k in rows])[[x.split()[0] for x in PREPARED.split(", ")]]

    listed = {c: F.filter(F.coalesce(F.col(c), F.array().cast("array<string>" if c != "years" else "array<int>")), lambda x: x.isNotNull()) for c in ("names", "years", "states", "chambers", "ids")}
    fields = [x.split()[0] for x in ENTITY.split(", ")]
    whole = entities.filter(F.col("id").isNotNull()).select(*[listed[c].alias(c) if c in listed else F.col(c).cast("int").alias(c) if c.endswith("year") else c for c in fields])
    return whole.mapInPandas(run, PREPARED)


def _last_likeness(a: Name, b: Name) -> float:
    """1 for equal surnames, 0.9 for one slip or a shared part, 0.7 for two slips, then down to 0."""
    if not a.last or not b.last:
        return 0.0
    if a.last == b.last:
        return 1.0
    if {a.last, *a.also} & {b.last, *b.also}:
        return 0.9
    slips, longest = edit_distance(a.last, b.last), max(len(a.last), len(b.last))
    if slips == 1 and longest > 3:
        return 0.9
    return 0.7 if slips == 2 and longest > 5 else round(0.6 * (1 - slips / longest), 1)


def _first_likeness(a: Name, b: Name) -> float:
    best = 0.5 if not a.first or not b.first else 0.0
    for x, y in product({a.first, a.nick} - {""}, {b.first, b.nick} - {""}):
        if len(x) > 1 and len(y) > 1:
            s = 1.0 if x == y or roots(x) & roots(y) else 0.9 if min(len(x), len(y)) > 3 and edit_distance(x, y, 2) < 2 else 0.3 if x[0] == y[0] else 0.0
        else:
            s = 0.7 if x[0] == y[0] else 0.0
        best = max(best, s)
    return best


def _middle_likeness(a: Name, b: Name) -> float:
    if not a.middle or not b.middle:
        return 0.5
    x, y = a.middle[0], b.middle[0]
    if len(x) > 1 and len(y) > 1:
        return 1.0 if x == y or roots(x) & roots(y) or edit_distance(x, y, 2) < 2 else 0.0
    return 0.8 if x[0] == y[0] else 0.0


@lru_cache(maxsize=100_000)
def name_likeness(left: str, right: str) -> tuple[float, float, float, float]:
    """Likeness of surname, given name, middle name and suffix, of the two names of both records that agree best."""
    best = (0.0, 0.0, 0.5, 0.6)
    for a, b in product(_unpacked(left), _unpacked(right)):
        suffix = 0.6 if not a.suffix and not b.suffix else 0.4 if not a.suffix or not b.suffix else 1.0 if a.suffix == b.suffix else 0.0
        found = (_last_likeness(a, b), _first_likeness(a, b), _middle_likeness(a, b), suffix)
        if (found[0] + found[1], found[2] + found[3]) > (best[0] + best[1], best[2] + best[3]):
            best = found
    return best


@F.pandas_udf(StructType([StructField(f, DoubleType()) for f in ("last", "first", "middle", "suffix")]))
def _names(left: pd.Series, right: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([name_likeness(a, b) for a, b in zip(left, right)], columns=["last", "first", "middle", "suffix"])


def _overlap(x: str, y: str) -> Column:
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.5).when(F.arrays_overlap(x, y), 1.0).otherwise(0.0)


def _birth(x: str, y: str) -> Column:
    """Years of birth: equal, a year apart, a slip (a few years, ten, or the same digits in another order)."""
    apart = F.array_min(F.flatten(F.transform(x, lambda a: F.transform(y, lambda b: F.abs(a - b)))))
    digits = lambda c: F.array_sort(F.split(c.cast("string"), ""))
    turned = F.exists(x, lambda a: F.exists(y, lambda b: digits(a) == digits(b)))
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.5).when(apart == 0, 1.0).when(apart == 1, 0.9).when((apart <= 3) | (apart == 10) | turned, 0.4).otherwise(0.0)


def _time(cross: bool) -> Column:
    """A first term against the first year seen in the other source, whose early years may be absent; one person
    holds one number of the same source at a time."""
    if not cross:
        return F.when((F.col("a_first_year") <= F.col("b_last_year")) & (F.col("b_first_year") <= F.col("a_last_year")), 0.0).otherwise(0.8)
    d = F.col("b_first_year") - F.col("a_first_year")
    unknown = F.coalesce((F.col("a_first_year") <= 0) | (F.col("b_first_year") <= 0), F.lit(True))
    return F.when(unknown, 0.5).when(F.abs(d) <= 1, 1.0).when((d > 1) & (d <= 12), 0.8).when((d > 12) & (d <= 40), 0.6).when((d >= -4) & (d < 0), 0.3).otherwise(0.0)


def similarity(pairs: DataFrame, left: DataFrame, right: DataFrame, cross: bool = True) -> DataFrame:
    """(a, b, features...) of pairs (a, b) of ids of prepared records: of both sources, or (``cross`` false) of two
    records of the second. Only names go through Python, as two texts a pair."""
    side = lambda df, s: df.drop("keys").select(F.col("id").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in df.columns if c not in ("id", "keys")])
    full = pairs.join(side(left, "a"), "a").join(side(right, "b"), "b").withColumn("_n", _names("a_names", "b_names"))
    if cross:
        hits = F.size(F.filter("b_ids", lambda i: F.lower(i) == F.lower("a")))
        identifier = F.when(F.size("b_ids") == 0, 0.5).when(hits * 2 > F.size("b_ids"), 1.0).when(hits > 0, 0.7).otherwise(0.2)
    else:
        lowered = full.withColumn("a_ids", F.transform("a_ids", F.lower)).withColumn("b_ids", F.transform("b_ids", F.lower))
        full, identifier = lowered, _overlap("a_ids", "b_ids")
    known = full.select(
        "a", "b", F.col("_n.last").alias("last"), F.col("_n.first").alias("first"), F.col("_n.middle").alias("middle"), _birth("a_years", "b_years").alias("birth"),
        _overlap("a_states", "b_states").alias("state"), _overlap("a_chambers", "b_chambers").alias("chamber"), _time(cross).alias("time"), identifier.alias("identifier"), F.col("_n.suffix").alias("suffix"),
    )
    unclashed = F.when(F.col("birth") == 0, 0.0).when((F.col("middle") == 0) | (F.col("suffix") == 0), 0.5).otherwise(1.0)
    return known.withColumn("unclashed", unclashed).select("a", "b", *FEATURES)


class Mixture:
    """Two Gaussians over similarity vectors, of matches and of the rest, fitted without labels.

    The covariances are regularised: their off-diagonal parts are shrunk, and each variance is widened
    by a share of the squared distance of the two means in that feature, so a feature that happens to be
    constant among the matches can't decide alone.
    """

    def __init__(self, spread: float = 0.08, shrink: float = 0.3, floor: float = 0.02) -> None:
        self.spread, self.shrink, self.floor = spread, shrink, floor
        self.share, self.means, self.covs = 0.5, np.zeros((2, 1)), np.zeros((2, 1, 1))

    def maximise(self, x: np.ndarray, n: np.ndarray, matched: np.ndarray) -> None:
        """Parameters from vectors, their counts and the sum of the posteriors of the pairs of each."""
        weights = [np.maximum(n - matched, 0), matched]
        self.share = float(np.clip(matched.sum() / max(n.sum(), 1), 1e-6, 1 - 1e-6))
        self.means = np.array([(w[:, None] * x).sum(0) / max(w.sum(), 1e-9) for w in weights])
        apart = (self.means[1] - self.means[0]) ** 2
        covs = []
        for w, m in zip(weights, self.means):
            c = (w[:, None] * (x - m)).T @ (x - m) / max(w.sum(), 1e-9)
            c = np.diag(np.diag(c)) * (1 - self.shrink) + c * self.shrink
            covs.append(c + np.diag(self.spread * apart + self.floor))
        self.covs = np.array(covs)

    def odds(self, x: np.ndarray) -> np.ndarray:
        """The odds that a pair with each vector is a match, before any constraint."""
        logs = []
        for m, c, p in zip(self.means, self.covs, (1 - self.share, self.share)):
            d = x - m
            logs.append(np.log(p) - 0.5 * (np.linalg.slogdet(c)[1] + np.einsum("ij,ij->i", d @ np.linalg.inv(c), d)))
        return np.exp(np.clip(logs[1] - logs[0], -50, 50))


#: Weights of the features in the first guess, from which expectation-maximisation starts.
FIRST_GUESS = np.array([3.0, 2.5, 1.0, 2.0, 1.0, 0.5, 1.0, 1.0, 0.5, 1.0])


def first_guess(x: np.ndarray) -> np.ndarray:
    """1 for vectors of agreement in the names and in most of what else is known, else 0."""
    return ((x @ FIRST_GUESS / FIRST_GUESS.sum() > 0.78) & (x[:, 0] >= 0.7) & (x[:, 1] >= 0.7) & (x[:, 3] > 0.1)).astype(float)


def _code() -> Column:
    """A vector as one whole number: its features in tenths, as digits to base eleven."""
    code = F.lit(0).cast("long")
    for f in FEATURES:
        code = code * 11 + F.round(F.col(f) * 10).cast("long")
    return code


def _vectors(codes: np.ndarray) -> np.ndarray:
    out = np.zeros((len(codes), len(FEATURES)))
    for k in reversed(range(len(FEATURES))):
        out[:, k] = codes % 11 / 10
        codes = codes // 11
    return out


def _table(values: np.ndarray) -> Column:
    """Numbers as an array literal, folded once by the optimiser."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def _shapes(pairs: DataFrame, index: DataFrame) -> DataFrame:
    """(entries, m): the records of the second source by what their candidates look like, and how many look so.

    A record's entries are the vectors (and bounds) of its candidates with their counts: as many at most as there
    are distinct vectors and bounds, whatever the number of its candidates. All that the E-step needs of a
    record is in its entries, so its cost is that of the distinct shapes.
    """
    counted = pairs.groupBy("b", "code", "bound").agg(F.count("*").cast("double").alias("n")).join(F.broadcast(index), "code")
    each = counted.groupBy("b").agg(F.array_sort(F.collect_list(F.struct("i", "bound", "n"))).alias("entries"))
    return each.groupBy("entries").agg(F.count("*").cast("double").alias("m"))


def _expected(shapes: DataFrame, odds: np.ndarray) -> np.ndarray:
    """The E-step: the sum of the posteriors of the pairs of each vector, under the constraints.

    At most one record of the first source is the person of a record b, so given independent odds o of its
    pairs the posterior of one is o / (1 + the sum of o over b), which is exact. A bound limits the odds of a pair.
    """
    book = _table(odds)
    weight = lambda e: F.least(F.get(book, e["i"]), e["bound"])
    total = F.aggregate("entries", F.lit(0.0), lambda x, e: x + weight(e) * e["n"])
    each = shapes.select("m", total.alias("s"), F.explode("entries").alias("e"))
    sums = each.groupBy(F.col("e.i").alias("i")).agg(F.sum(weight(F.col("e")) / (1 + F.col("s")) * F.col("e.n") * F.col("m")).alias("p")).toPandas()
    out = np.zeros(len(odds))
    out[sums["i"].to_numpy()] = sums["p"].to_numpy()
    return out


def _likely(pairs: DataFrame, index: DataFrame, odds: np.ndarray) -> DataFrame:
    """(a, b, p, o): the pairs with a posterior above a half. Such a pair is the likeliest of its b, so partial aggregates do."""
    weighed = pairs.join(F.broadcast(index), "code").select("a", "b", F.least(F.get(_table(odds), F.col("i")), F.col("bound")).alias("o"))
    best = weighed.groupBy("b").agg(F.min(F.struct((-F.col("o")).alias("o"), "a")).alias("t"), F.sum("o").alias("s"))
    return best.select("t.a", "b", (-F.col("t.o") / (1 + F.col("s"))).alias("p"), (-F.col("t.o")).alias("o")).filter(F.col("p") > 0.5)


def _bounds(likely: DataFrame, right: DataFrame, model: Mixture) -> DataFrame:
    """(a, b, limit): bounds on the odds of pairs by transitivity over a.

    Records b, c that both match one a must match each other: the posterior of the less likely pair is at most
    that of (b, c), c being the likeliest of a. A record a with one likely partner has no bound.
    """
    leads = likely.groupBy("a").agg(F.min(F.struct((-F.col("p")).alias("p"), "b")).alias("t"), F.count("*").alias("n")).filter("n > 1")
    beside = likely.join(leads.select("a", F.col("t.b").alias("c")), "a").filter(F.col("b") != F.col("c")).select("a", "b", "c")
    among = similarity(beside.select(F.col("c").alias("a"), "b").distinct(), right, right, cross=False)
    means, covs, share = model.means, model.covs, max(model.share, 0.3)

    @F.pandas_udf("double")
    def odds(*columns: pd.Series) -> pd.Series:
        m = Mixture()
        m.means, m.covs, m.share = means, covs, share
        return pd.Series(m.odds(np.column_stack([c.to_numpy(float) for c in columns])))

    judged = among.select(F.col("a").alias("c"), "b", F.round(odds(*FEATURES), 2).alias("limit"))
    return beside.join(judged, ["c", "b"]).select("a", "b", "limit")


class Fit:
    """What the fit found: the mixture, the number of candidates, and the share of them that match."""

    def __init__(self, model: Mixture, candidates: int) -> None:
        self.model, self.candidates, self.share = model, candidates, model.share


def _trust(levels: np.ndarray, n: np.ndarray, tops: dict[int, int], n_right: int) -> dict[int, float]:
    """The confidence of a likeliest pair by the level (logarithm, floored) of its odds.

    A record has one partner at most, so its other candidates are coincidences, and their odds show how often a
    coincidence reaches a level. What the records without a partner would meet by chance there, over all likeliest
    pairs there, is the share of wrong ones. Confidence doesn't fall with the level.
    """
    total = sum(tops.values())
    chance = max(n_right - total, 1) / max(total, 1)
    best, out = 0.5, {}
    for level in sorted(tops):
        others = max(float(n[levels == level].sum()) - tops[level], 0.0)
        best = max(best, 1 - (chance * others + 0.5) / (tops[level] + 1))
        out[level] = best
    return out


def fit_match(left: DataFrame, right: DataFrame, rounds: int = 2, steps: int = 30) -> tuple[DataFrame, Fit | None]:
    """As ``match``, with the fit (None where there is no candidate)."""
    left, right = stage(prepared(left, True), "left"), stage(prepared(right, False), "right")
    side = lambda df, s: df.select(F.col("id").alias(s), F.explode("keys").alias("key"))
    met = block_join(side(left, "a"), side(right, "b"), ["key"]).select("a", "b").distinct()
    compared = similarity(met, left, right).select("a", "b", _code().alias("code"), F.lit(float("inf")).alias("bound"))
    pairs = stage(compared, "pairs")
    counts = pairs.groupBy("code").count().toPandas().sort_values("code")  # bounded by the steps of the features
    if not len(counts):
        return pairs.select("a", "b", F.lit(0.0).alias("confidence")), None
    codes, n = counts["code"].to_numpy(), counts["count"].to_numpy(float)
    x = _vectors(codes)
    index = pairs.sparkSession.createDataFrame(pd.DataFrame({"code": codes, "i": np.arange(len(codes), dtype="int32")}), "code long, i int")
    model, matched = Mixture(), n * first_guess(x)
    for k in range(rounds):
        shapes = stage(_shapes(pairs, index), "shapes")
        for _ in range(steps):
            before = model.means
            model.maximise(x, n, matched)
            if before.shape == model.means.shape and np.abs(model.means - before).max() < 1e-3:
                break
            matched = _expected(shapes, model.odds(x))
        bounds = stage(_bounds(_likely(pairs, index, model.odds(x)), right, model), "bounds")
        limited = lookup_join(pairs, bounds, ["a", "b"], bounds.count())
        pairs = stage(limited.select("a", "b", "code", F.least("bound", F.coalesce("limit", F.lit(float("inf")))).alias("bound")), "pairs")
    odds = model.odds(x)
    likely = stage(_likely(pairs, index, odds).withColumn("level", F.floor(F.log("o")).cast("int")), "likely")
    tops = {r["level"]: r["count"] for r in likely.groupBy("level").count().collect()}  # odds are kept within exp(-50) and exp(50)
    trust = _trust(np.floor(np.log(odds)).astype(int), n, tops, right.count())
    known = pairs.sparkSession.createDataFrame(list(trust.items()) or [(0, 0.5)], "level int, trust double")
    return likely.join(F.broadcast(known), "level").select("a", "b", F.least("p", "trust").alias("confidence")), Fit(model, int(n.sum()))


def match(left: DataFrame, right: DataFrame, rounds: int = 2, steps: int = 30) -> DataFrame:
    """(a, b, confidence): records of ``left`` and ``right`` that denote the same person.

    Both have the columns of ENTITY; others are dropped, rows without id left out. Candidates share a key of a
    surname and other partial facts; their similarity vectors have few distinct values, and so have the shapes of
    the candidates of one record, so expectation-maximisation over all candidates costs as much as its distinct
    shapes. Every E-step is constrained: a record of ``right`` gets one partner at most; from the second round
    on, records of ``right`` with one partner must match the likeliest of them. Records without names meet
    none. Ties go to the smaller id. Empty sides give nothing. ``id`` must be unique on either side.
    """
    return fit_match(left, right, rounds, steps)[0]
