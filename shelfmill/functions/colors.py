"""Colour functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import DEFAULT_PROFILE, SiteProfile
from .columns import any_of, as_col, let
from .text import clean_text


def is_bad_color(x: Column | str, profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    """Text that cannot be a colour: stop words, codes, numbers, long text."""
    bad = lambda v, low: (
        (v == "")
        | low.isin(*profile.color_stop_words)
        | (F.length(v) > 40)
        | low.contains("http")
        | v.contains("€")
        | v.rlike(r"^#[0-9a-fA-F]{3,8}$")
        | low.rlike(any_of(profile.css_color_marks))
        | (F.size(F.split(v, " - ")) >= 3)
        | v.rlike(rf"(?U)^[\d\s\x1c-\x1f,./%-]+$")
    )
    # Cleaned once: inside lambdas Spark works out each mention anew.
    return let(clean_text(x), lambda v: let(F.lower(v), lambda low: bad(v, low)))


def last_part(name: Column | str) -> Column:
    """Last non-empty ' - ' part of a text with at least two; else null."""
    parts = F.filter(
        F.transform(F.split(F.coalesce(as_col(name), F.lit("")), " - "), clean_text),
        lambda p: p != "",
    )
    return let(parts, lambda p: F.when(F.size(p) >= 2, F.get(p, F.size(p) - 1)))


def color_from_name(name: Column | str, profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    return let(
        last_part(name),
        lambda c: F.when(c.isNotNull() & ~is_bad_color(c, profile), c).otherwise(""),
    )


def color_from_phrase(text: Column | str, profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    """What follows 'color:' up to a separator; '' when there is none."""
    words = "|".join(profile.color_labels)
    pattern = rf"(?iU)(?:^|\b)(?:{words})[:\s\x1c-\x1f-]+([^|;,]+)"
    return clean_text(F.regexp_extract(as_col(text), pattern, 1))


def is_color_label(text: Column | str, profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    return F.lower(F.rtrim(as_col(text), F.lit(":"))).isin(*profile.color_labels)
