"""Column expressions for attribute cleaning, numeric casts and comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "None"

# Spellings that count as a missing category, per cleaning rule.
BASIC_BLANKS = ("", " ", "nan")
ZERO_BLANKS = ("", " ", "nan", "0")
STRIP_ZERO = "0"


def clean_basic(c: Column) -> Column:
    return F.when(c.isin(*BASIC_BLANKS), MISSING).otherwise(c)


def clean_zero(c: Column) -> Column:
    return F.when(c.isin(*ZERO_BLANKS), MISSING).otherwise(c)


def clean_strip(c: Column) -> Column:
    return F.when((c == STRIP_ZERO) | c.rlike(r"^\s*$"), MISSING).otherwise(c)


def fill_category(c: Column) -> Column:
    return F.coalesce(c, F.lit(MISSING))


CLEANERS = {"basic": clean_basic, "zero": clean_zero, "strip": clean_strip}


def category(c: Column, clean: str = "basic") -> Column:
    """Cleaned, never-null category."""
    return fill_category(CLEANERS[clean](c))


def to_float32(c: Column, null_policy: str = "nan") -> Column:
    """Cast to float32; a null becomes NaN, or 0 together with NaN."""
    value = c.cast("float")
    if null_policy == "nan":
        return F.coalesce(value, F.lit(float("nan")).cast("float"))
    if null_policy == "zero":
        return nan_to_zero(value)
    raise ValueError(f"null_policy must be 'nan' or 'zero', not {null_policy!r}")


def nan_to_zero(c: Column) -> Column:
    zero = F.lit(0).cast("float")
    return F.coalesce(F.nanvl(c, zero), zero)


def has_value(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c)


def values_close(a: Column, b: Column, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """Tolerance equality relative to the second value; false if either is missing."""
    a, b = a.cast("double"), b.cast("double")
    inf = F.lit(float("inf"))
    near = (a == b) | ((F.abs(b) < inf) & (F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)))
    return F.when(has_value(a) & has_value(b), near).otherwise(F.lit(False))


def title_of(path: Column) -> Column:
    """Last path element without its extension (leading dots start no extension)."""
    base = F.regexp_extract(path, r"([^/]*)$", 1)
    stem = F.regexp_extract(base, r"^(.*[^.].*)\.[^.]*$", 1)
    return F.when(stem == "", base).otherwise(stem)


def provenance(title: Column, url: Column, day: Column) -> Column:
    return F.concat(
        F.lit("Converted from "), title, F.lit(", downloaded from "), url, F.lit(", on "), day
    )
