"""Location rules. Each parser returns a struct of city, state and country."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobstrata import vocab
from jobstrata.functions.text import blank_to_null, contains_any, present


def _place(city: Column, state: Column, country: Column) -> Column:
    return F.struct(city.alias("city"), state.alias("state"), country.alias("country"))


def _part(parts: Column, index: int) -> Column:
    return F.trim(F.get(parts, F.lit(index)))


def parse_dash(location: Column, fallback_country: Column) -> Column:
    """``city - state, country``."""
    sides = F.split(location, "-")
    right = F.split(_part(sides, 1), ",")
    return _place(_part(sides, 0), _part(right, 0), F.coalesce(_part(right, 1), fallback_country))


def parse_general(location: Column, default_country: str = "Brasil") -> Column:
    """Dashes count as commas; first, second and third part."""
    parts = F.split(F.regexp_replace(location, r"[ \t]*-[ \t]*", ","), ",")
    return _place(_part(parts, 0), _part(parts, 1), F.coalesce(_part(parts, 2), F.lit(default_country)))


def parse_listing(
    location: Column,
    city: Column | None = None,
    state: Column | None = None,
    country: Column | None = None,
    default_country: str = "Brazil",
) -> Column:
    """API form: split only when no city is given and there are two or more parts."""
    blank = F.lit("")
    city, state, country = (F.coalesce(c, blank) if c is not None else blank for c in (city, state, country))
    parts = F.split(location, ",")
    split_here = present(location) & (city == "") & (F.size(parts) >= 2)
    split_here = F.coalesce(split_here, F.lit(False))
    last = F.when(F.size(parts) > 2, F.trim(F.try_element_at(parts, F.lit(-1)))).otherwise(F.lit(default_country))
    found = F.when(split_here, last).otherwise(country)
    return _place(
        F.when(split_here, _part(parts, 0)).otherwise(city),
        F.when(split_here, _part(parts, 1)).otherwise(state),
        F.coalesce(blank_to_null(found), F.lit(default_country)),
    )


def rebuild_location(location: Column, city: Column, state: Column, country: Column) -> Column:
    """The location text, or one put together from its parts when it is missing."""
    blank = F.lit("")
    joined = F.concat_ws(", ", *[F.coalesce(c, blank) for c in (city, state, country)])
    return F.when(present(location), location).otherwise(F.regexp_replace(joined, "^[, ]+|[, ]+$", ""))


def parse_state_suffix(location: Column) -> Column:
    """``city, ST``; without the suffix the whole text is the city."""
    return _place(
        F.regexp_replace(location, ", [A-Z]{2}$", ""),
        blank_to_null(F.regexp_extract(location, ", ([A-Z]{2})$", 1)),
        F.lit(None).cast("string"),
    )


def parse_auto(location: Column, fallback_country: Column) -> Column:
    """Pick the parser by shape: a dash or three parts, two parts, or one.

    Two parts are city and state. A single part that names the country has no city.
    """
    parts = F.split(F.regexp_replace(location, r"[ \t]*-[ \t]*", ","), ",")
    n = F.size(parts)
    country_only = F.lower(F.trim(location)).isin("brasil", "brazil")
    return _place(
        F.when(~country_only, _part(parts, 0)),
        F.when(n >= 2, _part(parts, 1)),
        F.when(country_only, F.trim(location)).otherwise(F.coalesce(_part(parts, 2), fallback_country)),
    )


def location_tier(
    city: Column, tier_1: list[str] = vocab.TIER_1_CITIES, tier_2: list[str] = vocab.TIER_2_CITIES
) -> Column:
    return F.when(city.isin(tier_1), "tier_1").when(city.isin(tier_2), "tier_2").otherwise("tier_3")


def city_matches(city: Column, parts: list[str] = vocab.BRAZIL_CITY_PARTS) -> Column:
    """Lower-cased city holds any of the parts."""
    return contains_any(F.lower(city), parts)


def city_in(city: Column, cities: list[str]) -> Column:
    return F.lower(city).isin(cities)
