"""Column expressions of the domain: guarded casts, normalisers, code builders."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words of votes and results, and how the upper chamber prints document types.
YES_WORDS = ["yea", "yes", "aye"]
NO_WORDS = ["nay", "no"]
PASS_WORDS = ["passed", "agreed to", "adopted"]
FAIL_WORDS = ["failed", "rejected", "not agreed to"]
DOCUMENT_TYPES = {"H.R.": "hr", "S.": "s", "H.Res.": "hres", "S.Res.": "sres", "H.Con.Res.": "hconres", "S.Con.Res.": "sconres", "H.J.Res.": "hjres", "S.J.Res.": "sjres"}


def guarded_int(c: Column) -> Column:
    """The whole number a text is, else null; never an error."""
    return F.when(c.rlike("^-?[0-9]+$"), c).try_cast("bigint")


def strict_whole(c: Column) -> Column:
    """A whole number that may be written 1.0; 1.5 is null."""
    return F.when(c.rlike(r"^-?[0-9]+(\.0+)?$"), F.regexp_replace(c, r"\.0+$", "")).try_cast("bigint")


def number_or_null(c: Column, markers: Sequence[str] = ("", "N", "NA", "N/A", ".", "-999999999")) -> Column:
    """The number a text is; a missing marker or anything else is null."""
    t = F.trim(c)
    return F.when(~t.isin(list(markers)), t).try_cast("decimal(38,9)")


def number_or_reason(c: Column, markers: Sequence[str] = ("", "N", "NA", "N/A", ".", "-999999999")) -> tuple[Column, Column]:
    """(the number a text is, the reason it is none): a missing marker has neither; other text has a reason, for a
    load that refuses what it can't read."""
    t = F.trim(c)
    value = number_or_null(c, markers)
    return value, F.when(t.isNotNull() & ~t.isin(list(markers)) & value.isNull(), F.concat(F.lit("not a number: "), t))


def first_known(*columns: Column) -> Column:
    """The first value that isn't null or blank."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in columns])


def chosen(pairs: dict[str, str], c: Column) -> Column:
    """The value a fixed table has for ``c``, else null."""
    return reduce(lambda acc, kv: acc.when(c == kv[0], kv[1]), pairs.items(), F.when(F.lit(False), None))


def vote_position(raw: Column) -> Column:
    """yes, no, not voting or other for a printed word."""
    w = F.lower(F.trim(raw))
    return F.when(w.isin(YES_WORDS), "yes").when(w.isin(NO_WORDS), "no").when(w == "not voting", "not voting").otherwise("other")


def house_result(raw: Column) -> Column:
    """pass or fail where the whole text is a plain outcome; anything else (an election, "H R 5 passed") is null."""
    w = F.lower(F.trim(raw))
    return F.when(w.isin(PASS_WORDS), "pass").when(w.isin(FAIL_WORDS), "fail")


def senate_result(raw: Column) -> Column:
    """pass, fail or null for the outcome a text ends with; a "not" just before turns it.

    "Not Guilty" and "Veto Sustained" are neither. The words are taken from the end, so what was decided may
    be anything.
    """
    words = F.split(F.trim(F.lower(raw)), r"\s+")
    tail = lambda n: F.array_join(F.slice(words, F.greatest(F.size(words) - n + 1, F.lit(1)), n), " ")
    won = (F.element_at(words, -1).isin("confirmed", "passed", "adopted"), 1), (tail(2) == "agreed to", 2)
    lost = F.element_at(words, -1).rlike("(?:rejected|failed|defeated)$")
    out = F.when(raw.isNull(), None).when(lost, "fail")
    for hit, n in won:
        out = out.when(hit & (F.try_element_at(words, F.lit(-n - 1)) == "not"), "fail").when(hit, "pass")
    return out


def document_type(printed: Column) -> Column:
    """The bill type behind a printed document type, else null."""
    return chosen(DOCUMENT_TYPES, printed)


def bill_key(session: Column, identifier: Column) -> Column:
    """struct(congress, bill_type, bill_number) of a federal bill, else null."""
    shape = r"(?i)^\s*(hr|s|hres|sres|hconres|sconres|hjres|sjres)\s*0*([0-9]+)\s*$"
    ok = session.rlike("^[0-9]+$") & identifier.rlike(shape)
    return F.when(ok, F.struct(session.alias("congress"), F.lower(F.regexp_extract(identifier, shape, 1)).alias("bill_type"), F.regexp_extract(identifier, shape, 2).alias("bill_number")))


def ordinal(n: Column) -> Column:
    """1st, 2nd, 3rd, 4th, 11th."""
    tail = F.when((n % 100).between(10, 20), "th").when(n % 10 == 1, "st").when(n % 10 == 2, "nd").when(n % 10 == 3, "rd").otherwise("th")
    return F.concat(n.cast("string"), tail)


def slug(c: Column) -> Column:
    """Lower case words joined by hyphens."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), F.lit("-"))


def geography_of(geo_id: Column) -> Column:
    """struct(geography_type, geoid) of a summary-level id of a state (two digits) or county (five), else null."""
    code = F.substring_index(geo_id, "US", -1)
    kind = F.when(geo_id.rlike("^040[0-9]{4}US[0-9]{2}$"), "state").when(geo_id.rlike("^050[0-9]{4}US[0-9]{5}$"), "county")
    return F.when(kind.isNotNull(), F.struct(kind.alias("geography_type"), code.alias("geoid")))


def term_place(chamber: Column, state: Column, district: Column, country: str = "ocd-division/country:us") -> Column:
    """The division of a term's post: the state for a senator, the district for a representative, 0 at large."""
    home = F.concat(F.lit(f"{country}/state:"), F.lower(state))
    seat = F.when(district == 0, "at-large").when(district > 0, district.cast("string"))
    return F.when(chamber == "sen", home).otherwise(F.concat(home, F.lit("/cd:"), seat))


def congress_start(congress: Column) -> Column:
    """The day a congress begins."""
    return F.make_date(congress * 2 + 1787, F.lit(1), F.lit(3))


def clerk_day(c: Column) -> Column:
    """The date of 4-Jan-2007."""
    return F.try_to_timestamp(F.initcap(F.regexp_replace(c, "-", " ")), F.lit("d MMM yyyy")).cast("date")


def eastern_stamp(c: Column) -> Column:
    """UTC instant of "January 4, 2007, 02:05 PM" on the eastern clock, with or without the second comma; else null.

    The date parser decides: a text is read as it stands, and again with its spaces and letter case made even.
    """
    even = F.initcap(F.regexp_replace(F.regexp_replace(F.trim(c), r"\s+", " "), "(?i) ?([ap])m$", " $1m"))
    even = F.regexp_replace(F.regexp_replace(even, " Am$", " AM"), " Pm$", " PM")
    read = [F.try_to_timestamp(even, F.lit(p)) for p in ("MMMM d, yyyy, h:mm a", "MMMM d, yyyy h:mm a")]
    return F.to_utc_timestamp(F.coalesce(*read), "America/New_York")


def eastern_clock(day: Column, clock: Column) -> Column:
    """UTC instant of a day and a time H:MM on the eastern clock; null where either is absent or no time."""
    text = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "), F.regexp_extract(clock, "^[0-9]{1,2}:[0-9]{1,2}", 0))
    return F.to_utc_timestamp(F.try_to_timestamp(text, F.lit("yyyy-MM-dd H:m")), "America/New_York")


def month_start(year: Column, period: Column) -> Column:
    """The first day of M01 to M12 of a year; other periods are null."""
    return F.when(period.rlike("^M(0[1-9]|1[0-2])$"), F.make_date(year.try_cast("int"), F.substring(period, 2, 2).try_cast("int"), F.lit(1)))


def all_terms(text: Column, query: str) -> Column:
    """Whether a text contains every word of a query, in any case."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return reduce(Column.__and__, [F.contains(low, F.lit(t)) for t in query.lower().split()], F.lit(True))


def web_query(text: Column, query: str) -> Column:
    """A search-box query: words, "a phrase", -without, or. Words match whole, without stemming."""
    import re

    low = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    alternatives: list[Column] = []
    current: list[Column] = []
    for minus, phrase, word in re.findall(r'(-?)(?:"([^"]*)"|(\S+))', query.lower()):
        if word == "or" and not minus:
            alternatives.append(reduce(Column.__and__, current, F.lit(True)))
            current = []
            continue
        term = re.sub(r"[^\w]+", " ", phrase or word).strip()
        if term:
            hit = F.contains(low, F.lit(f" {term} "))
            current.append(~hit if minus else hit)
    return reduce(Column.__or__, [*alternatives, reduce(Column.__and__, current, F.lit(True))])


def trigrams(text: Column) -> Column:
    """The distinct three-character pieces of a text's words, each with two blanks before and one after, as trigram indexes have them."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    pieces = lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substr(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3)))
    return F.array_distinct(F.flatten(F.transform(words, pieces)))


def trigram_similarity(a: Column, b: Column) -> Column:
    """Shared trigrams of two texts over all of theirs; 0 where neither has any."""
    x, y = trigrams(a), trigrams(b)
    union = F.size(F.array_union(x, y))
    return F.when(union > 0, F.size(F.array_intersect(x, y)) / union).otherwise(F.lit(0.0))


def optional(c: Column, value: object) -> Column:
    """The condition ``c = value``, or none where no value is given."""
    return F.lit(True) if value is None else c == F.lit(value)


def json_has_key(c: Column, key: str) -> Column:
    """Whether a JSON object has a key, with whatever value."""
    return F.coalesce(F.array_contains(F.json_object_keys(c), key), F.lit(False))
