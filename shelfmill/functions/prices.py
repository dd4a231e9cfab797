"""Price and discount functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import DEFAULT_PROFILE, SiteProfile
from .columns import as_col, let
from .text import SPACE

# ---- fixed values: price patterns in the order they are tried, scores ----
PRICE_PATTERNS = (
    rf"(?U)€{SPACE}*(\d{{1,4}}{SPACE}*[.,]{SPACE}*\d{{2}})",
    rf"(?U)€{SPACE}*(\d{{1,4}}{SPACE}\d{{2}})",
    rf"(?U)(\d{{1,4}}{SPACE}*[.,]{SPACE}*\d{{2}}){SPACE}*€",
    rf"(?U)(\d{{1,4}}{SPACE}\d{{2}}){SPACE}*€",
    rf"(?U)\b(\d{{1,4}}{SPACE}*[.,]{SPACE}*\d{{2}})\b",
    rf"(?U)\b(\d{{1,4}}{SPACE}\d{{2}})\b",
)
GROUPED_PRICE = r"(?U)(?<![\d.,])(\d{1,3}(?:\.\d{3})+,\d{2}|\d{1,3}(?:,\d{3})+\.\d{2})(?!\d)"
# What every pattern needs; most texts fail it, and one look is enough then.
_PRICE_LIKE = rf"(?U)\d{SPACE}*[.,\s\x1c-\x1f]{SPACE}*\d{{2}}"
MAX_PRICE = 10000
SOURCE_BONUS = {"json": 60, "meta": 45, "local_node": 35, "local_text": 20, "page": 0}
DISCOUNT_LOW, DISCOUNT_HIGH = 1, 95
# ---- end of fixed values ----
_DIGITS = r"\d+(?:_\d+)*"
_NUMBER = rf"^\s*[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?\s*$"


def to_float(x: Column | str) -> Column:
    """Decimal text to a number; null for anything else, type suffixes too."""
    x = as_col(x)
    number = x.rlike(_NUMBER) | x.rlike(r"(?i)^\s*[+-]?(inf|infinity|nan)\s*$")
    return F.when(number, F.regexp_replace(x, "_", "").try_cast("double"))


def _bounded(value: Column) -> Column:
    return (value > 0) & (value <= MAX_PRICE)


def _price_number(raw: Column) -> Column:
    """Text to number. Most are plain, as 18,99, and need none of the steps."""
    plain = raw.rlike(r"\A[0-9]{1,4}[.,][0-9]{2}\z")
    return F.when(plain, F.replace(raw, F.lit(","), F.lit(".")).try_cast("double")).otherwise(_any_price_number(raw))


def _any_price_number(raw: Column) -> Column:
    """Each step names its input once, so it stays one pass."""
    steps = (
        ("€", ""),
        (rf"(?U){SPACE}+", " "),
        ("^ | $", ""),
        (r" ?, ?", ","),
        (r" ?\. ?", "."),
        (r"(?U)^(\d{1,4}) (\d{2})$", "$1.$2"),  # 18 99
        (r",(?=.*\.)", ""),  # the last separator is the decimal one
        (r"\.(?=.*,)", ""),
        (",", "."),
        (r"[^0-9.\-]", ""),
        (r"\.(?=.*\.)", ""),
    )
    for pattern, repl in steps:
        raw = F.regexp_replace(raw, pattern, repl)
    return raw.try_cast("double")  # only digits, points and signs are left


def normalize_price(raw: Column | str) -> Column:
    """Price text to a number of at most two decimals; null outside (0, 10000]."""
    number = _price_number(as_col(raw))
    return F.when(_bounded(number), F.round(number, 2))


def price_candidates(text: Column | str, profile: SiteProfile = DEFAULT_PROFILE) -> Column:
    """Distinct prices of a text in pattern order, then text order."""
    text = as_col(text)
    every = lambda patterns: F.concat(*[F.regexp_extract_all(text, F.lit(p), 1) for p in patterns])
    none = F.array().cast("array<string>")
    grouped = [every((GROUPED_PRICE,))] if profile.strict_fix else []
    signed = F.when(text.contains("€"), every(PRICE_PATTERNS[:4])).otherwise(none)
    hits = F.when(text.rlike(_PRICE_LIKE), F.concat(*grouped, signed, every(PRICE_PATTERNS[4:])))
    numbers = F.filter(F.transform(hits, _price_number), _bounded)
    found = F.array_distinct(F.transform(numbers, lambda v: F.round(v, 2)))
    return F.coalesce(found, F.array().cast("array<double>"))


def price_pair(prices: Column | str) -> Column:
    """(max, min) of two or more, (null, it) of one, null of none."""
    prices = as_col(prices)
    low = F.array_min(prices)
    high = F.when(F.size(prices) >= 2, F.array_max(prices))
    return F.when(
        F.size(prices) >= 1, F.struct(high.alias("original"), low.alias("current"))
    )


def format_price(x: Column | str) -> Column:
    x = as_col(x)
    return F.when(x.isNull(), "").otherwise(F.format_string("%.2f", x))


def discount_label(text: Column | str) -> Column:
    """First '-NN%' of the text when N is 1..95, else ''."""
    digits = F.regexp_extract(as_col(text), rf"(?U)-{SPACE}*(\d{{1,2}}){SPACE}*%", 1)
    return _label(_whole(digits))


def _whole(text: Column) -> Column:
    """Text to a whole number. Empty text is told first: a cast that fails raises inside, which is slow."""
    return F.nullif(text, F.lit("")).try_cast("int")


def _label(pct: Column) -> Column:
    shown = F.concat(F.lit("-"), pct.cast("string"), F.lit("%"))
    return F.when(pct.between(DISCOUNT_LOW, DISCOUNT_HIGH), shown).otherwise("")


def discount_number(original: Column | str, current: Column | str) -> Column:
    """Whole per cent off, halves to even."""
    share = F.try_divide(as_col(current).cast("double"), as_col(original).cast("double"))
    return F.rint((1 - share) * 100).try_cast("int")


def discount_pct(original: Column | str, current: Column | str) -> Column:
    """'-N%' label computed from a price pair; '' when outside 1..95."""
    return _label(discount_number(original, current))


def source_bonus(source: Column | str) -> Column:
    source = as_col(source)
    cases = F.lit(0)
    for name, bonus in SOURCE_BONUS.items():
        cases = F.when(source == name, bonus).otherwise(cases)
    return cases


def score_pair(
    original: Column | str, current: Column | str, discount: Column | str, source: Column | str
) -> Column:
    """How plausible a price pair is; -999 without a current price."""
    return _score(as_col(original), as_col(current), _discount_of(as_col(discount)), source)


def _discount_of(label: Column) -> Column:
    return _whole(F.translate(label, "-%", ""))


def _score(o: Column, c: Column, label: Column, source: Column | str) -> Column:
    # Without a label there is no gap, and none need be worked out.
    gap = F.when(label.isNotNull(), F.abs(discount_number(o, c) - label))
    off = F.try_divide(o - c, o)
    in_range = F.when(c.between(1, 5000), 10).otherwise(0)
    order = F.when(o.isNull(), 0).when(o >= c, 10).otherwise(-25)
    ratio = F.when(o.isNull() | (o <= c), 0).when(off.between(0.01, 0.95), 15).otherwise(-10)
    by_gap = F.get(F.array(*[F.lit(n) for n in (40, 25, 25, 10, 10, 10)]), gap)
    agree = F.coalesce(
        F.when(o.isNotNull(), F.coalesce(by_gap, F.when(gap.isNotNull(), -30))), F.lit(0)
    )
    return F.when(c.isNull(), -999).otherwise(
        source_bonus(source) + in_range + order + ratio + agree
    )


def choose_pair(pairs: Column, discount: Column) -> Column:
    """Best (original, current) of an array of ``ord, original, current,
    source`` structs: highest score, then lowest ``ord``; null when none."""
    usable = F.filter(pairs, lambda p: _bounded(p["current"]))
    swapped = F.transform(
        usable,
        lambda p: F.struct(
            p["ord"].alias("ord"),
            F.when(p["original"].isNotNull(), F.greatest(p["original"], p["current"])).alias("original"),
            F.least(p["current"], p["original"]).alias("current"),
            p["source"].alias("source"),
        ),
    )
    ranked = lambda d: F.transform(
        swapped,
        lambda p: F.struct(
            (-_score(p["original"], p["current"], d, p["source"])).alias("rank"),
            p["ord"].alias("ord"),
            p["original"].alias("original"),
            p["current"].alias("current"),
        ),
    )
    best = let(_discount_of(discount), lambda d: F.array_min(ranked(d)))
    return let(best, lambda b: F.when(b.isNotNull(), F.struct(b["original"], b["current"])))
