"""Secret scans: fixed patterns, and windows of high Shannon entropy in long tokens.

Each document is scanned in its own task step; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regweave.llm.common import append_columns

KINDS = ("assign", "access", "hex", "entropy")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ASSIGN_WORDS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run of the class from its first character, as the scan for [0-9a-f]+ finds it.
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{20,}")

#: Character classes of a candidate, narrowest first, with the entropy in bits per
#: character that a window needs. A window of 20 can reach 4.32.
WINDOW = 20
CLASSES = (
    (re.compile(r"[0-9]+"), math.inf),  # long numbers are not keys
    (re.compile(r"[0-9a-f]+|[0-9A-F]+"), 3.0),
    (re.compile(r"[a-z]+|[A-Z]+|[A-Z][a-z]+"), math.inf),  # words
    (re.compile(r"[A-Za-z]+"), 4.0),
    (re.compile(r"[A-Za-z0-9]+"), 3.7),
    (re.compile(r"[A-Za-z0-9+/=_-]+"), 3.9),
)
#: Maximal runs inside a candidate that are judged by their own class as well.
_RUNS = tuple(re.compile(r) for r in (r"[0-9a-f]{20,}", r"[0-9A-F]{20,}", r"[A-Za-z0-9]{20,}"))

#: Look-alikes that are no secrets. They suppress entropy spans that they overlap.
ALLOWED = re.compile(
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"  # UUID
    r"|sha(?:1|256|384|512)[-:=][A-Za-z0-9+/=]+"  # published digests
    r"|(?<=://)[A-Za-z0-9.:-]+(?=[/?#\s\"'<>]|$)|(?<=@)[A-Za-z0-9.-]+"  # hosts of addresses
    r"|(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]*(?:EXAMPLE|example|placeholder|PLACEHOLDER|xxxx|XXXX)[A-Za-z0-9+/=_-]*"
    r"|0123456789abcdef|ABCDEFGHIJKLMNOPQRSTUVWXYZ|abcdefghijklmnopqrstuvwxyz"
)

#: Addresses. Their paths and queries are cut at these signs, so that a key in one of them is
#: judged by itself and the words around it are not.
_ADDRESS = re.compile(r"https?://[^\s\"'<>]+")
_CUTS = re.compile(r"[^/=+]+")

_SEPARATORS = re.compile(r"[-_/=+]+")
#: A part of a name: a number, a word in one case or in camel case, with few digits at an end.
_WORDLIKE = re.compile(
    r"[0-9]+|[0-9]{1,4}[a-z]{1,3}|(?:[a-z]+|[A-Z]+|[A-Z]?[a-z]+(?:[A-Z][a-z]+)*)[0-9]{0,4}"
)
_PREFIX = re.compile(r"([^=]*)=+(?=[^=])")


def _wordlike(run: str) -> int:
    """The number of parts of ``run``; 0 if one of them does not look like a word."""
    parts = [part for part in _SEPARATORS.split(run) if part]
    return len(parts) if all(map(_WORDLIKE.fullmatch, parts)) else 0


def _value_start(run: str) -> int:
    """Where the value starts behind names and '=', if it is long enough for a key."""
    start = 0
    while (m := _PREFIX.match(run, start)) and len(run) - m.end() >= WINDOW:
        if m[1] and not _wordlike(m[1]):
            break
        start = m.end()
    return start


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the fixed patterns, by start, then kind."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in _ASSIGN_WORDS):
        found += [(*m.span(), 0) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(*m.span(), 1) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(*m.span(), 2) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda span: (span[0], span[2]))


def high_entropy(run: str, needed: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Merged windows of ``run`` with at least ``needed`` bits per character.

    Counts change by one character in and one out, and with them the sum of c * log2(c).
    """
    weigh = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    total = 0.0
    spans: list[tuple[int, int]] = []
    most = window * (math.log2(window) - needed) + 1e-9  # entropy = log2(w) - total / w
    for i, char in enumerate(run):
        if i >= window:
            gone = run[i - window]
            count = counts[gone]
            counts[gone] = count - 1
            total += weigh[count - 1] - weigh[count]
        count = counts.get(char, 0)
        counts[char] = count + 1
        total += weigh[count + 1] - weigh[count]
        if i >= window - 1 and total <= most:
            start = i - window + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


def _class_bits(run: str) -> float:
    return next(bits for pattern, bits in CLASSES if pattern.fullmatch(run))


def _windows(run: str) -> list[tuple[int, int]]:
    """Merged windows that their candidate's class or that of a run in it finds."""
    needed = _class_bits(run)
    if needed == math.inf or _wordlike(run) > 2:  # three or more words are a name
        return []
    found = high_entropy(run, needed)
    for pattern in _RUNS:
        for m in pattern.finditer(run):
            bits = _class_bits(m[0])
            if bits < needed:
                found += [(m.start() + s, m.start() + e) for s, e in high_entropy(m[0], bits)]
    merged: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def entropy_spans(text: str) -> list[tuple[int, int, int]]:
    """High-entropy spans that no allow-listed text overlaps.

    ``name=`` in front of a value of at least a window is no part of the candidate. A
    candidate that consists of three or more word-like parts is a name and has no spans. In an
    address each part of the path and the query is a candidate of its own.
    """
    found = []
    addresses = [m.span() for m in _ADDRESS.finditer(text)] if "://" in text else []
    at = 0
    for candidate in _CANDIDATE.finditer(text):
        start = candidate.start()
        while at < len(addresses) and addresses[at][1] <= start:
            at += 1
        if at < len(addresses) and addresses[at][0] <= start:
            runs = [(start + m.start(), m[0]) for m in _CUTS.finditer(candidate[0])]
        else:
            skip = _value_start(candidate[0])
            runs = [(start + skip, candidate[0][skip:])]
        for offset, run in runs:
            if len(run) >= WINDOW:
                found += [(offset + s, offset + e, 3) for s, e in _windows(run)]
    if not found:
        return []
    return _uncovered(found, [m.span() for m in ALLOWED.finditer(text)])


def _uncovered(
    spans: list[tuple[int, int, int]], covers: list[tuple[int, int]]
) -> list[tuple[int, int, int]]:
    """The spans that no cover overlaps. Both are disjoint and in order; one pass over both."""
    left, i = [], 0
    for span in spans:
        while i < len(covers) and covers[i][1] <= span[0]:
            i += 1
        if i == len(covers) or covers[i][0] >= span[1]:
            left.append(span)
    return left


def _listed(spans: list[tuple[int, int, int]]) -> str:
    ordered = sorted(spans, key=lambda span: (span[0], span[2], span[1]))
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, end, kind in ordered)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``secrets``: structs (kind, start, end) in code points, end exclusive.

    Spans come by start, then kind. NULL and empty texts have none. A column ``secrets`` of
    the input is replaced.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        rows = []
        for value in batch.column(text).to_pylist():
            spans = base_spans(value or "") + entropy_spans(value or "")
            spans.sort(key=lambda s: (s[0], s[2], s[1]))
            rows.append([{"kind": KINDS[k], "start": s, "end": e} for s, e, k in spans])
        return [pa.array(rows, kind)]

    return append_columns(
        docs, "secrets array<struct<kind:string,start:long,end:long>>", compute
    )


def report(scanned: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row per document: base counts, the base spans' digest and all spans."""

    def listed(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
            )), ",",
        )

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("secrets", lambda s: s["kind"] != "entropy")
    return scanned.select(
        doc_id, count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"), F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
    )


def base_digest(text: str | None) -> str:
    return hashlib.sha256(_listed(base_spans(text or "")).encode()).hexdigest()
