"""Size and stock functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import DEFAULT_PROFILE, SiteProfile
from .columns import any_of, as_col, let
from .text import SPACE, clean_text

# ---- fixed values: stock states, strongest last ----
STOCK_STATES = ("OK", "ALMOST", "LAST", "OUT")
# ---- end of fixed values ----


def size_patterns(profile: SiteProfile = DEFAULT_PROFILE) -> tuple[str, ...]:
    """The four passes: region pair, region single, letters, bare numbers."""
    region = rf"\((?:{'|'.join(profile.size_regions)})\)"
    end = "" if profile.strict_fix else r"\b"
    token = r"\b([A-Z\d/]+)"
    gap = f"{SPACE}*"
    letters = "|".join(profile.letter_sizes)
    return (
        rf"(?U){token}{gap}{region}{gap}-{gap}\1{gap}{region}{end}",
        rf"(?U){token}{gap}{region}{end}",
        rf"(?U)\b({letters})\b",
        # A number is no size when € % . or , lies within 12 characters. The
        # look back comes last, so that it runs at numbers only.
        r"(?U)\b(1\d|2\d|3\d|4\d|50|51|52)\b(?!.{0,11}[€%.,])(?<![€%.,].{0,11}\d\d)",
    )


def size_tokens(text: Column | str, profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    """Distinct sizes of a text, pass by pass, each in text order."""
    upper = F.upper(clean_text(text))
    every = lambda t, patterns: F.concat(*[F.regexp_extract_all(t, F.lit(p), 1) for p in patterns])
    none = F.array().cast("array<string>")
    regions, bare = size_patterns(profile)[:2], size_patterns(profile)[2:]
    found = lambda t: F.concat(F.when(t.contains("("), every(t, regions)).otherwise(none), every(t, bare))
    return let(upper, lambda t: F.array_distinct(found(t)))


def stock_status(
    text: Column, attrs: Column, tag: Column, combined: Column,
    profile: SiteProfile = DEFAULT_PROFILE,
) -> Column:
    """OUT, LAST, ALMOST or OK from an element's words and attributes."""
    attr = lambda name: clean_text(attrs[name])
    # Class names are searched as a quoted list, so no phrase spans two names.
    names = F.when(attr("class") == "", "").otherwise(
        F.concat(F.lit("['"), F.replace(attr("class"), F.lit(" "), F.lit("', '")), F.lit("']"))
    )
    raw = F.lower(
        F.concat_ws(
            " ", text, names, attr("aria-label"), attr("title"), attr("disabled"),
            attr("aria-disabled"), combined,
        )
    )
    unmarked = F.lit(False)
    if profile.in_stock_class:
        option = (tag == "li") | F.lower(attr("role")).contains("option")
        unmarked = option & ~F.lower(attr("class")).contains(profile.in_stock_class)
    by_words = let(
        raw,
        lambda words: F.when(words.rlike(any_of(profile.sold_out_words)), "OUT")
        .when(words.rlike(any_of(profile.last_unit_words)), "LAST")
        .when(words.rlike(any_of(profile.low_stock_words)), "ALMOST")
        .otherwise("OK"),
    )
    return F.when(unmarked, "OUT").otherwise(by_words)


def stock_priority(status: Column | str) -> Column:
    """OK 1 … OUT 4; 0 for anything else."""
    states = F.array(*[F.lit(s) for s in STOCK_STATES])
    return F.coalesce(F.array_position(states, as_col(status)), F.lit(0)).cast("int")


def stock_state(priority: Column | str) -> Column:
    return F.get(F.array(*[F.lit(s) for s in STOCK_STATES]), as_col(priority) - 1)


def is_numeric_size(size: Column) -> Column:
    return size.rlike(r"(?U)^\d+$")


def sorted_size_text(sizes: Column) -> Column:
    """Array of ``size, status`` structs to 'size:STATUS, …', numbers first."""
    keyed = F.transform(
        sizes,
        lambda s: F.struct(
            (~is_numeric_size(s["size"])).alias("is_text"),
            # Without a digit it is no number; a cast that fails raises inside, which is slow.
            F.when(s["size"].rlike(r"(?U)\d"), s["size"].try_cast("decimal(38,0)")).alias("num"),
            s["size"].alias("size"),
            s["status"].alias("status"),
        ),
    )
    shown = F.transform(
        F.array_sort(keyed), lambda s: F.concat(s["size"], F.lit(":"), s["status"])
    )
    return F.array_join(shown, ", ")
