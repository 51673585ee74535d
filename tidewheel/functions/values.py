"""Null-safe numeric and text column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean(c: Column) -> Column:
    """NaN becomes null; comparisons and aggregates then skip it."""
    return F.nanvl(c, F.lit(None).cast("double"))


def blank(c: Column) -> Column:
    """True for null and for the empty string, both of which mean a missing path."""
    return c.isNull() | (c == "")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.coalesce(F.try_divide(100.0 * part, whole.cast("double")), F.lit(0.0)), digits)


def wildcard(c: Column, pattern: str) -> Column:
    """``*`` and ``?`` as wildcards, without regard to case; other LIKE signs keep their meaning."""
    return c.ilike(pattern.replace("*", "%").replace("?", "_"))


def matches_source(c: Column, wanted: str | None) -> Column:
    """Equality, or a wildcard match where the pattern has wildcards; all rows where there is none."""
    if not wanted:
        return F.lit(True)
    return wildcard(c, wanted) if set(wanted) & set("*?") else c == wanted


#: Names that mark a calibrator, and the ordered tests of a source's group.
CALIBRATORS = ["TauA", "CasA", "CygA", "Jupiter", "Venus", "Mars"]
GROUP_TESTS = [(["co"], "CO"), (["field"], "Galactic"), ([c.lower() for c in CALIBRATORS], "Calibrator"), (["fg"], "Foreground")]


def source_name(raw: Column) -> Column:
    return F.trim(F.split_part(F.coalesce(raw, F.lit("Unknown")), F.lit(","), F.lit(1)))


def source_group(raw: Column, comment: Column) -> Column:
    """The group of a source: a sky nod first, null for an empty name, then the tests in order."""
    name = F.lower(source_name(raw))
    out = F.when(F.lower(F.coalesce(comment, F.lit(""))).contains("sky nod"), "SkyDip").when(name == "", F.lit(None))
    for words, group in GROUP_TESTS:
        hit = F.lit(False)
        for w in words:
            hit = hit | name.contains(w)
        out = out.when(hit, group)
    return out.otherwise("Other")


def obsid_of_path(path: Column) -> Column:
    """The observation id in a file name: the second dash-separated field, after any prefix up to the last underscore."""
    base = F.substring_index(path, "/", -1)
    base = F.when(base.contains("Level2"), F.substring_index(base, "_", -1)).otherwise(base)
    return F.split_part(base, F.lit("-"), F.lit(2)).try_cast("bigint")


def obsid_by_digits(path: Column) -> Column:
    """The seven digits of a processed file's name, or null."""
    return F.nullif(F.regexp_extract(path, r"Level2_[A-Za-z]+-(\d{7})-", 1), F.lit("")).cast("bigint")


def feature_bit(word: Column) -> Column:
    """The highest set bit of a feature word, -1 where there is none."""
    return F.when(word > 0, F.floor(F.log2(word.cast("double")))).otherwise(-1).cast("bigint")


def polynomial(coeffs: Column, x: Column) -> Column:
    """Constant-first coefficients, evaluated by Horner's rule."""
    return F.aggregate(F.reverse(coeffs), F.lit(0.0), lambda acc, c: acc * x + c)


def mjd(ts: Column) -> Column:
    """Modified Julian Date of a timestamp without zone."""
    return F.unix_micros(ts.cast("timestamp")) / 86400e6 + 40587.0


def parse_utc(text: Column) -> Column:
    """``YYYY-MM-DD-HH:MM:SS``; null where it doesn't parse."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd-HH:mm:ss"))


def map_mask(hits: Column, low: Column, edge: Column) -> Column:
    """Bits: 1 never hit, 2 few hits (or none), 4 clipped border."""
    return F.when(hits <= 0, 1).otherwise(0).bitwiseOR(F.when(low, 2).otherwise(0)).bitwiseOR(F.when(edge, 4).otherwise(0))
