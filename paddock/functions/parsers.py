"""Column expressions that normalise raw race text. No Python runs for any row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Codes of runners that did not finish.
NON_FINISHER_CODES = ("F", "U", "PU", "BD", "RO", "DSQ", "VO", "RR", "CO", "SU", "UR", "DIED")
#: Country suffixes of horse names and their region codes.
BREEDING_REGIONS = {
    "GB": "gb", "UK": "gb", "IRE": "ire", "FR": "fr", "USA": "usa", "GER": "ger", "AUS": "aus", "NZ": "nz", "JPN": "jpn",
    "CAN": "can", "ITY": "ity", "SPA": "spa", "SAF": "saf", "ARG": "arg", "BRZ": "brz", "CHI": "chi",
}
#: Points of the first four places, of any later one, and weights of the last five runs.
FORM_POINTS = {1: 10, 2: 7, 3: 5, 4: 3}
LATER_POINTS = 1
FORM_WEIGHTS = {1: 2.0, 2: 1.5, 3: 1.2, 4: 1.0, 5: 1.0}

#: Surfaces that are artificial, and those of jump races.
AW_SURFACES = ("aw", "all weather", "tapeta", "polytrack")
JUMP_SURFACES = ("hurdle", "chase", "nh flat")
#: Names of home countries.
HOME_COUNTRIES = ("Great Britain", "United Kingdom", "UK", "England", "Scotland", "Wales", "Northern Ireland", "Ireland", "Irish")
#: Suffixes of course names.
COURSE_SUFFIXES = ("rh", "lh", "left", "right", "gb", "ire")

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)$"


def text(c: Column) -> Column:
    """Trimmed text, blank as null."""
    return F.nullif(F.trim(c), F.lit(""))


def position(c: Column) -> Column:
    """Finishing position: a death at a given age gives that number, non-finishers null, else the
    integer or the first digits."""
    t = F.upper(F.trim(c))
    died = F.regexp_extract(t, r"^DIED AS (?:AN? )?(\d+)", 1)
    return (
        F.when(died != "", died.try_cast("int"))
        .when(t.rlike("^(" + "|".join(NON_FINISHER_CODES) + ")"), F.lit(None).cast("int"))
        .otherwise(F.nullif(F.regexp_extract(t, r"(\d+)", 1), F.lit("")).try_cast("int"))
    )


def text_position(c: Column) -> Column:
    """As ``position``, and WON is the first place."""
    return F.when(F.upper(F.trim(c)) == "WON", F.lit(1)).otherwise(position(c))


def strict_position(c: Column) -> Column:
    """Integer text only."""
    return integer(c)


def beaten_distance(c: Column) -> Column:
    """``0`` stays, numbers get the suffix L without needless decimals, other text stays."""
    t = text(c)
    value = F.when(t.rlike(NUMBER), t.try_cast("double"))
    shown = F.when(value == F.floor(value), F.floor(value).cast("string")).otherwise(value.cast("string"))
    return F.when(value.isNull(), t).when(value == 0, F.lit("0")).otherwise(F.concat(shown, F.lit("L")))


def money(c: Column) -> Column:
    """Amount without currency signs and thousands separators."""
    t = F.regexp_replace(F.trim(c), "[£€$,]", "")
    return F.when(t.rlike(NUMBER), t.try_cast("double"))


def integer(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t.rlike(r"^[+-]?\d+$"), t.try_cast("int"))


rating = integer


def decimal(c: Column) -> Column:
    """A number, perhaps with a trailing L."""
    t = F.regexp_replace(F.trim(c), "L$", "")
    return F.when(t.rlike(NUMBER), t.try_cast("double"))


def is_winner(p: Column) -> Column:
    return F.coalesce(p == 1, F.lit(False))


def is_placed(p: Column, places: int = 3) -> Column:
    return F.coalesce(p.between(1, places), F.lit(False))


def did_not_finish(raw: Column) -> Column:
    return text(raw).isNotNull() & position(raw).isNull()


def breeding_region(name: Column, fallback: Column | None = None) -> Column:
    """Region code from a trailing ``(XXX)``; codes that aren't known are lower-cased."""
    code = F.nullif(F.regexp_extract(name, r"\(([A-Z]{2,3})\)\s*$", 1), F.lit(""))
    known = F.create_map(*[F.lit(x) for pair in BREEDING_REGIONS.items() for x in pair])
    region = F.coalesce(F.try_element_at(known, code), F.lower(code))
    return region if fallback is None else F.coalesce(region, fallback)


def _part(c: Column, pattern: str) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(F.lower(F.trim(c)), pattern, 1), F.lit("")).try_cast("double"), F.lit(0.0))


def metres(c: Column) -> Column:
    """``2m4f`` in metres: 1609 a mile, 201 a furlong, truncated; a plain number is metres."""
    t = F.lower(F.trim(c))
    total = _part(c, r"(\d+(?:\.\d+)?)m") * 1609 + _part(c, r"(\d+(?:\.\d+)?)f") * 201
    return F.when(t.rlike(NUMBER), t.try_cast("double").cast("int")).when(t.rlike(r"\d[mf]"), total.cast("int"))


def yards(c: Column) -> Column:
    """``1m2f110y`` in yards: 1760 a mile, 220 a furlong."""
    t = F.lower(F.trim(c))
    total = _part(c, r"(\d+(?:\.\d+)?)m") * 1760 + _part(c, r"(\d+(?:\.\d+)?)f") * 220 + _part(c, r"(\d+(?:\.\d+)?)y")
    return F.when(t.rlike(r"\d[mfy]"), total.cast("int"))


def distance_band(y: Column) -> Column:
    return F.when(y < 1400, "sprint").when(y < 1800, "mile").when(y < 2400, "middle").when(y.isNotNull(), "staying")


def seconds(c: Column) -> Column:
    """``m:ss.ss`` or plain seconds."""
    t = F.trim(c)
    minutes, rest = F.regexp_extract(t, r"^(\d+):(\d+(?:\.\d+)?)$", 1), F.regexp_extract(t, r"^(\d+):(\d+(?:\.\d+)?)$", 2)
    return F.when(t.rlike(r"^\d+:\d+(\.\d+)?$"), minutes.try_cast("double") * 60 + rest.try_cast("double")).when(t.rlike(NUMBER), t.try_cast("double"))


def race_class(c: Column) -> Column:
    return integer(F.replace(F.lower(c), F.lit("class"), F.lit("")))


def furlongs(c: Column) -> Column:
    return decimal(F.replace(F.lower(c), F.lit("f"), F.lit("")))


def name_key(c: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))


def course_key(c: Column) -> Column:
    """Course name without the parts that only some sources carry."""
    t = F.regexp_replace(F.lower(c), "-aw$", "")
    t = F.regexp_replace(t, "-(" + "|".join(COURSE_SUFFIXES) + ")$", "")
    t = F.when(t.startswith("newmarket-"), "newmarket").when(t.contains("limerick"), "limerick").otherwise(t)
    return F.trim(F.when(t.contains("-on-") | t.contains("-upon-"), F.substring_index(t, "-", 1)).otherwise(t))


def rate(part: Column, whole: Column, digits: int = 2, zero: float | None = None) -> Column:
    """Percentage; null (or ``zero``) where there is nothing to divide by."""
    out = F.round(F.try_divide(part * F.lit(100.0), whole), digits)
    return out if zero is None else F.coalesce(out, F.lit(zero))


def days_since(as_of: Column, d: Column) -> Column:
    return F.datediff(as_of, d)


def age_years(as_of: Column, born: Column) -> Column:
    return F.floor(F.months_between(as_of, born) / 12).cast("int")


def form_points(p: Column) -> Column:
    out = F.when(p > max(FORM_POINTS), LATER_POINTS).otherwise(0)
    for place, points in FORM_POINTS.items():
        out = F.when(p == place, points).otherwise(out)
    return out


def form_weight(rank: Column) -> Column:
    out = F.lit(0.0)
    for n, weight in FORM_WEIGHTS.items():
        out = F.when(rank == n, weight).otherwise(out)
    return out


def update_phase(hours: Column) -> Column:
    return F.when(hours < 0, "post").when(hours < 24, "race_day").otherwise("pre")


def going_is(going: Column, kind: str) -> Column:
    return F.coalesce(F.lower(going).contains(kind), F.lit(False))


def surface_is(surface: Column, kinds: tuple[str, ...]) -> Column:
    return F.coalesce(F.lower(surface).isin(*kinds), F.lit(False))


def coalesced_position(candidates: list[Column], payload: Column, field: str = "$.position") -> Column:
    """The first candidate that is an integer, else the payload's."""
    return F.coalesce(*[integer(c.cast("string")) for c in candidates], integer(F.get_json_object(payload, field)))


def population_status(percent: Column) -> Column:
    return F.when(percent == 0, "empty").when(percent < 20, "sparse").when(percent < 80, "partial").when(percent < 100, "good").otherwise("complete")


def in_region(code: Column, codes: tuple[str, ...] = ("gb", "ire", "uk")) -> Column:
    return F.coalesce(F.lower(code).isin(*codes), F.lit(False))


def in_country(name: Column, names: tuple[str, ...] = HOME_COUNTRIES) -> Column:
    return F.coalesce(name.rlike("(?i)" + "|".join(names)), F.lit(False))
