"""Walk over JSON values, used inside tasks.

Spark's own JSON readers sort keys or need a schema. Key order decides which
value wins here, so objects are walked in document order.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

MEMBER = "struct<key:string,value:string,kind:string>"
WALKED = f"array<struct<obj:int,members:array<{MEMBER}>>>"

# ---- fixed values: script types and words that mark shop data ----
LINKED_DATA = "application/ld+json"
FLAT_OBJECT = re.compile(r"\{.*?\}", re.DOTALL)
FLAT_WORDS = ("price", "color", "colour")
# ---- end of fixed values ----


def load(text: str) -> list:
    """``[value]``, or ``[]`` when the text is not JSON."""
    try:
        return [json.loads(text)]
    except (ValueError, RecursionError):
        return []


def objects(value: object) -> Iterator[dict]:
    """Every object at any depth, each before the objects it holds."""
    stack = [value]
    while stack:
        top = stack.pop()
        if isinstance(top, dict):
            yield top
        if isinstance(top, (dict, list)):
            inner = top.values() if isinstance(top, dict) else top
            stack.extend(reversed(list(inner)))


def _storable(text: str) -> str:
    """JSON escapes can hold half of a surrogate pair, which no column can."""
    return text if text.isascii() else text.encode("utf-8", "replace").decode("utf-8")


def members(obj: dict, keys: frozenset[str] | None, nested: frozenset[str] = frozenset()) -> list[dict]:
    """Members whose lower-cased key is wanted, values as text. What a value
    holds inside is members of its own, so it is not written out again, but
    for the keys in ``nested``."""
    kind = {str: "text", bool: "flag", int: "number", float: "number", type(None): "null"}
    found = []
    for k, v in obj.items():
        if keys is None or k.lower() in keys:
            sort = kind.get(type(v), "nested")
            text = str(v) if sort != "nested" or k.lower() in nested else ""
            found.append({"key": _storable(k), "value": _storable(text), "kind": sort})
    return found


def script_objects(
    script_type: str, text: str, keys: frozenset[str], nested: frozenset[str] = frozenset()
) -> Iterator[tuple[int, list]]:
    """``(part, members)`` of a script: part 0 is the whole text read as JSON,
    parts from 1 are flat ``{…}`` pieces of other scripts."""
    kind = script_type.lower()
    whole = load(text) if "json" in kind else []
    for obj in objects(whole):
        yield 0, members(obj, keys, nested)
    if whole and kind.strip() == LINKED_DATA:
        return
    low = text.lower()
    if not any(w in low for w in FLAT_WORDS):
        return
    for n, piece in enumerate(FLAT_OBJECT.findall(text), 1):
        if any(w in piece.lower() for w in FLAT_WORDS):
            for obj in objects(load(piece)):
                yield n, members(obj, keys, nested)


def walk_json(col: Column | str) -> Column:
    """All objects of a JSON text column, in document order (Arrow batches)."""

    @F.pandas_udf(WALKED)
    def walk(texts: pd.Series) -> pd.Series:
        def one(text: str | None) -> list[dict]:
            found = objects(load(text)) if text is not None else ()
            return [{"obj": i, "members": members(o, None)} for i, o in enumerate(found)]

        return texts.map(one)

    return walk(col)
