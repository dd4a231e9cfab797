"""Secret scans: fixed patterns and sliding-window entropy (operator 8)."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_documents

# Kinds in their order, patterns, least lengths (group, characters).
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+", re.ASCII)
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

# The entropy scan: candidates, window, bits per character class, what is allowed.
WINDOW = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW, re.ASCII)
LONG_HEX = re.compile(r"[0-9a-f]{%d,}" % LEAST_HEX, re.ASCII)
# Runs of a class that hold a window, narrowest first, and a window's least entropy in bits.
CLASSES = tuple((re.compile(r"[%s]{%d,}" % (chars, WINDOW), re.ASCII), bits) for chars, bits in (
    ("0-9a-f", 3.0), ("0-9A-F", 3.0), ("A-Za-z0-9", 3.7), ("A-Za-z0-9+/_=-", 3.8),
))
ALLOWED = tuple(re.compile(p) for p in (
    r"\d+",  # numbers
    r"[A-Za-z]+",  # words
    r"[A-Za-z]+(?:[-_/][A-Za-z]+)*",  # names and paths of words
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",  # UUIDs
    r"(?:[0-9]+|[A-Za-z]+)(?:[-/_=](?:[0-9]+|[A-Za-z]+))*",  # dates, slugs, paths with numbers
))
# Placeholders, allowed as far as the separators round them; and one known key that separators part.
PLACEHOLDER, SEGMENT = re.compile(r"EXAMPLE|example|XXXX|xxxx"), re.compile(r"[^-/_=]+")
SAMPLE_KEY = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"


def dense(text: str, window: int = WINDOW, least: float = 3.7) -> list[tuple[int, int]]:
    """Stretches covered by windows with a Shannon entropy of ``least`` bits.

    The sum of ``c * log2(c)`` over the counts follows the window by the two
    characters that leave and enter; the entropy is log2(window) less its mean.
    """
    n = len(text)
    if n < window:
        return []
    weight = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    total = 0.0
    found: list[tuple[int, int]] = []
    for end in range(n):
        c = counts.get(text[end], 0)
        total += weight[c + 1] - weight[c]
        counts[text[end]] = c + 1
        if end >= window:
            c = counts[text[end - window]]
            total += weight[c - 1] - weight[c]
            counts[text[end - window]] = c - 1
        if end >= window - 1 and math.log2(window) - total / window >= least - 1e-9:
            start = end - window + 1
            if found and start <= found[-1][1]:
                found[-1] = (found[-1][0], end + 1)
            else:
                found.append((start, end + 1))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the fixed patterns, matches that are too short dropped."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    # Runs of at least the least length are whole runs, as runs are greedy.
    out += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(out)


def entropy_spans(text: str) -> list[tuple[int, int, int]]:
    out = []
    for m in CANDIDATE.finditer(text):
        if allowed(m.group()):
            continue
        for at, word in real_parts(m.group()):
            if not allowed(word):
                out += [(m.start() + at + a, 3, m.start() + at + b) for a, b in dense_runs(word)]
    return out


def real_parts(word: str) -> list[tuple[int, str]]:
    """Parts of a candidate, with their places, between segments that hold a
    placeholder; separators beside such a segment go with it."""
    if not PLACEHOLDER.search(word):
        return [(0, word)]
    gaps = [m.span() for m in re.finditer(re.escape(SAMPLE_KEY), word)]
    gaps += [m.span() for m in SEGMENT.finditer(word) if PLACEHOLDER.search(m.group())]
    out, at = [], 0
    for a, b in [*sorted(gaps), (len(word), len(word))]:
        part = word[at:a]
        own = part.lstrip("-/_=") if at else part
        start = at + len(part) - len(own)
        if a < len(word):
            own = own.rstrip("-/_=")
        if len(own) >= WINDOW:
            out.append((start, own))
        at = max(at, b)
    return out


def allowed(word: str) -> bool:
    return any(a.fullmatch(word) for a in ALLOWED)


def dense_runs(word: str) -> list[tuple[int, int]]:
    """Dense stretches of a candidate: each run of one class inside it is judged
    by that class's limit, so what is glued to a key does not raise the key's. A
    run that is itself a word or a number is judged with what surrounds it only."""
    seen: set[tuple[int, int]] = set()
    found: list[tuple[int, int]] = []
    for chars, least in CLASSES:
        for run in chars.finditer(word):
            # The same run in a narrower class has the lower limit; the whole word is not allowed.
            if run.span() not in seen and not allowed(run.group()):
                seen.add(run.span())
                found += [(run.start() + a, run.start() + b) for a, b in dense(run.group(), WINDOW, least)]
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan_secrets(documents: DataFrame) -> DataFrame:
    """``doc_id, base, spans`` per row of ``documents(doc_id, text)``: lists of
    ``(kind, start, end)`` in code points, end exclusive, by start and kind.
    ``base`` holds the fixed patterns, ``spans`` those and the entropy scan's.

    Whole texts are read where they lie; nothing is shuffled. Null and empty
    texts have no spans. Repeated rows each get theirs, null ids stay null, other
    columns are ignored, an empty table gives an empty result. The entropy scan
    takes strings of base64 characters, judges each run of a character class in
    them by that class's limit, and leaves out what the allow list names: plain
    words, numbers, dates, slugs, UUIDs, and segments that hold a placeholder.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, every = [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                fixed = base_spans(text)
                spans = sorted(fixed + entropy_spans(text))
                for spans, out in ((fixed, base), (spans, every)):
                    out.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, kind), pa.array(every, kind)], ["doc_id", "base", "spans"]
            )

    list_type = "array<struct<kind: string, start: int, end: int>>"
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id long, base {list_type}, spans {list_type}"
    )


def op8_secret_scan(spark, sf_dir: str) -> DataFrame:
    def text_of(column: str):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return scan_secrets(read_documents(spark, sf_dir)).select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(text_of("base").cast("binary"), 256).alias("base_sha256"), text_of("spans").alias("spans"),
    )
