"""Text and number normalisation used at the edges of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Latin letters with a mark, and the letter left once it is removed.
_MARKED = "áàâäãåéèêëíìîïóòôöõúùûüñçýÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇÝ"
_PLAIN = "aaaaaaeeeeiiiiooooouuuuncyAAAAAAEEEEIIIIOOOOOUUUUNCY"

# Spellings that mean "no value".
MISSING_SPELLINGS = ["", "_", "-", "nan", "null", "none"]

# Unit labels that stand for a thousand of the base unit.
THOUSAND_UNITS = ["miles de euros", "miles de €"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_accents(text) -> Column:
    return F.translate(_c(text), _MARKED, _PLAIN)


def normalise_name(name, prefix: str | None = None) -> Column:
    """Accent-free upper-case key: one space between words, bare hyphens."""
    t = F.upper(strip_accents(_c(name)))
    if prefix:
        t = F.regexp_replace(t, rf"^\s*{prefix.upper()}\s*", "")
    t = F.regexp_replace(t, r"\s*-\s*", "-")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def is_missing(text) -> Column:
    return _c(text).isNull() | F.lower(F.trim(_c(text))).isin(MISSING_SPELLINGS)


def european_number(text) -> Column:
    """``1.234,5`` to 1234.5; missing spellings and junk to NULL."""
    cleaned = F.replace(F.replace(F.trim(_c(text)), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.when(~is_missing(text), cleaned.try_cast("double"))


def whole_number(text) -> Column:
    """Digits with thousands separators of either kind; NULL for junk."""
    cleaned = F.regexp_replace(F.trim(_c(text)), r"[.,]", "")
    return F.when(~is_missing(text), cleaned.try_cast("bigint"))


def canonical_number(value) -> Column:
    """Whole numbers as integers, else up to six decimals without trailing zeros."""
    v = _c(value)
    fixed = F.format_string("%.6f", v)
    return F.when(v == F.floor(v), F.floor(v).cast("string")).otherwise(
        F.regexp_replace(F.regexp_replace(fixed, r"0+$", ""), r"\.$", "")
    )


def same_value(a, b) -> Column:
    """Equality at the precision values are stored with (six decimals)."""
    return F.round(_c(a), 6).eqNullSafe(F.round(_c(b), 6))


def base_unit_value(value, unit) -> Column:
    return F.when(F.lower(F.trim(_c(unit))).isin(THOUSAND_UNITS), _c(value) * 1000).otherwise(_c(value))


def first_code_by_keyword(text, keywords: list[tuple[str, str]]) -> Column:
    """Code of the first declared keyword contained in the text.

    The normalised text is bound to a lambda variable, so it is formed once per
    evaluation even where a pushed-down filter repeats the expression.
    """

    def choose(key: Column) -> Column:
        code = None
        for word, value in keywords:
            hit = key.contains(word.upper())
            code = F.when(hit, value) if code is None else code.when(hit, value)
        return code

    return F.get(F.transform(F.array(normalise_name(text)), choose), F.lit(0))


def alias_table(dimension: DataFrame, code: str, aliases: str, order: str) -> DataFrame:
    """(key, code): every alias of a list column, normalised; of codes that claim one alias the first by ``order``."""
    each = dimension.select(code, F.col(order).alias("_order"), F.explode(aliases).alias("_alias"))
    keyed = each.select(code, "_order", normalise_name("_alias").alias("key")).where(F.col("key") != "")
    return keyed.groupBy("key").agg(F.min_by(code, F.struct("_order", code)).alias(code))


def by_alias(df: DataFrame, name: str, table: DataFrame, how: str = "left") -> DataFrame:
    """``df`` with the code of its name; case, accents and blanks do not matter.  ``left_semi`` keeps the titles of a set."""
    keyed = df.withColumn("key", normalise_name(name))
    return keyed.join(table, "key", how).drop("key")


def code_has_prefix(code, prefixes: list[str]) -> Column:
    c, hit = F.trim(_c(code)), F.lit(False)
    for prefix in prefixes:
        hit = hit | c.startswith(prefix)
    return hit


def code_in_range(code, low: int, high: int) -> Column:
    """Integer code within inclusive bounds; malformed codes are false."""
    text = F.trim(_c(code))
    return F.coalesce(text.rlike(r"^\d+$") & text.try_cast("int").between(low, high), F.lit(False))
