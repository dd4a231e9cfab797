"""Small Column helpers shared by the function modules."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def as_col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once, so ``body`` may use it many times inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def first(arr: Column) -> Column:
    return F.get(arr, F.lit(0))


def blank_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def strings(values: Iterable[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def any_of(values: Iterable[str]) -> str:
    """Regex alternation that matches any of the given plain strings."""
    return "|".join(re.escape(v) for v in values)


def distinct_by_first(arr: Column, key: str) -> Column:
    """Of structs that start with ``key`` and then their order, keep the
    first per key. Sorting and looking one back is n log n, not all pairs."""
    return let(
        F.array_sort(arr),
        lambda s: F.filter(
            s, lambda x, i: (i == 0) | (x[key] != F.get(s, i - 1)[key])
        ),
    )


def built_once(fn: Callable) -> Callable:
    """Build a large expression once per application and set of arguments.
    Columns are plain descriptions, so plans can share them."""
    built: dict = {}

    @functools.wraps(fn)
    def build(*args):
        app = SparkSession.active().sparkContext.applicationId
        if (app, args) not in built:
            built[(app, args)] = fn(*args)
        return built[(app, args)]

    return build
