"""Text functions: whitespace, word counts, date text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import DEFAULT_PROFILE, SiteProfile
from .columns import as_col, blank_to_null

# Unicode white space plus the four separators that Java leaves out of \s.
SPACE = r"[\s\x1c-\x1f]"
# Every run of white space but a single blank, which can stay as it is. Most
# characters fail the look ahead, which is cheaper than the Unicode classes.
_UNEVEN_SPACE = r"(?U)(?=[^!-~])(?:[\s\x1c-\x1f]{2,}|[\s\x1c-\x1f&&[^ ]])"


def clean_text(x: Column | str) -> Column:
    """Collapse runs of white space to one space and trim; null gives ''."""
    spaced = F.regexp_replace(as_col(x), _UNEVEN_SPACE, " ")
    return F.coalesce(F.trim(spaced), F.lit(""))


def word_count(x: Column | str) -> Column:
    """Words of an already cleaned text."""
    x = as_col(x)
    return F.when(x == "", 0).otherwise(F.size(F.split(x, " ")))


def few_words(x: Column | str, most: int = 3) -> Column:
    return word_count(x) <= most


def end_date_text(x: Column | str, profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    """Lower-cased 'ends in …' phrase up to ``|``; lead words in list order."""
    low = F.lower(as_col(x))
    hits = [
        blank_to_null(F.regexp_extract(low, rf"(?U)({lead}{SPACE}+[^|]+)", 1))
        for lead in profile.end_date_leads
    ]
    return clean_text(F.coalesce(*hits, F.lit("")))
