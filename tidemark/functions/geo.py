"""Geography identifiers: grammar, level inference and builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The identifier grammar of the eleven geography levels.  An
# identifier made of a code beyond its width fits none of them.
GEO_GRAMMAR = {
    "municipality": r"^mun-\d{5}$",
    "district": r"^dist-\d{5}-\d{2}$",
    "barrio": r"^barrio-\d{5}-\d{3}$",
    "province": r"^prov-\d{2}$",
    "ccaa": r"^ccaa-\d{2}$",
    "nation": r"^(es|eu)$",
    "euro_area": r"^euro-area$",
    "world": r"^world$",
    "airport": r"^apt-[A-Z]{3}$",
    "port": r"^port-[A-Z]{3}$",
    "fua": r"^fua-[A-Z]{2}\d{3}[A-Z]\d$",
}

# Sub-city levels never stand in for a city.
CITY_LEVELS = ["municipality", "province", "ccaa", "nation", "airport", "port"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def geo_level_of(geo_id) -> Column:
    """Level implied by an identifier; NULL when it fits no grammar."""
    out = None
    for level, pattern in GEO_GRAMMAR.items():
        hit = _c(geo_id).rlike(pattern)
        out = F.when(hit, level) if out is None else out.when(hit, level)
    return out


def geo_is_valid(geo_id, level) -> Column:
    return F.coalesce(geo_level_of(geo_id) == _c(level), F.lit(False))


def _padded(code, width: int) -> Column:
    """``code`` with zeros in front, at least ``width`` long; a longer code is kept whole, so it never equals another."""
    text = _c(code).cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def municipality(code) -> Column:
    return F.concat(F.lit("mun-"), _padded(code, 5))


def province(code) -> Column:
    return F.concat(F.lit("prov-"), _padded(code, 2))


def ccaa(code) -> Column:
    return F.concat(F.lit("ccaa-"), _padded(code, 2))


def district(municipality_code, code) -> Column:
    return F.concat(F.lit("dist-"), _padded(municipality_code, 5), F.lit("-"), _padded(code, 2))


def barrio(municipality_code, code) -> Column:
    return F.concat(F.lit("barrio-"), _padded(municipality_code, 5), F.lit("-"), _padded(code, 3))


def airport(code) -> Column:
    return F.concat(F.lit("apt-"), F.upper(_c(code)))


def port(code) -> Column:
    return F.concat(F.lit("port-"), F.upper(_c(code)))
