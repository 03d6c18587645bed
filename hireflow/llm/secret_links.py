"""Secrets in texts: patterns, and parts of credentials that only count together.

Base patterns are reported wherever they match. Beyond them a text is searched for weak parts:
identifiers (``user = bob``), long mixed-character keys, and endpoints (addresses of services).
Alone they are ordinary text. Each weak part is joined to the intervals of the other parts in its
scope (lines up to a blank line), however far apart: an identifier needs a secret, a key needs an
identifier or an endpoint, and an endpoint needs both an identifier and a secret. Base matches count
as parts: access keys as identifiers, assignments and hexadecimal runs as secrets. A key in the query,
fragment or user part of an address is a key like others, but the address around it is not its
complement; in the host or path it is part of the address.

A scope lies inside a document, so everything happens where the document is read and nothing is
shuffled. Intervals of one kind are sorted and do not overlap, so a part finds its neighbour by
bisection; no pairs are listed.

* Null and empty texts have no spans; ``redacted`` leaves null as null.
* Equal intervals of different kinds are all reported, in the order of ``KINDS``.
* Repeated rows are scanned one by one; an empty table gives no rows. Extra columns are ignored by
  ``scanned``, whatever their names, and kept by ``redacted``.
* A very long text is scanned whole by one task, in time that grows with its length.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

#: Kinds in the order in which spans of one start are listed; the first three are base kinds.
KINDS = ("assign", "access", "hex", "id", "key", "endpoint")
BASE = KINDS[:3]

#: Put in place of a secret.
MASK = "[SECRET]"

#: Fixed patterns. Group 2 of an assignment is the value.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 12, 18, 16

#: Weak parts.
IDENTIFIER = re.compile(
    r"""\b(?:access[_-]?key(?:[_-]?id)?|client[_-]?id|account(?:[_-]?id)?|user(?:[_-]?name)?|login)"""
    r"""["']?[ \t]*[:=][ \t]*["']?([A-Za-z0-9_.@-]{3,})""",
    re.IGNORECASE | re.ASCII,
)
KEY = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
ENDPOINT = re.compile(
    r"\b(?:https?|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3|ftp|ssh)://[^\s\"'<>]+"
    r"|\b(?:host|endpoint|server)[ \t]*[:=][ \t]*[\"']?[A-Za-z0-9.-]+(?::[0-9]{2,5})?",
    re.IGNORECASE | re.ASCII,
)
#: User part, and query with fragment, of an address.
USER_PART = re.compile(r"://([^/?#]*)@")
QUERY_PART = re.compile(r"[?#](.*)", re.DOTALL)
BLANK_LINE = re.compile(r"\n[ \t\r]*\n")

#: A text without any of these has neither a base match nor a secret to link to.
POSSIBLE = r"(?i:passw|secret|token|api_?key)|AKIA|[0-9a-f]{16}|[A-Za-z0-9+/_-]{20}"


class Span(NamedTuple):
    start: int
    kind: int
    end: int


def base_spans(text: str) -> list[Span]:
    found = [
        Span(m.start(), 0, m.end())
        for m in ASSIGN.finditer(text)
        if len(m.group(2)) >= LEAST_VALUE
    ]
    for kind, pattern, least in ((1, ACCESS, LEAST_ACCESS), (2, HEX, LEAST_HEX)):
        found += [
            Span(m.start(), kind, m.end())
            for m in pattern.finditer(text)
            if m.end() - m.start() >= least
        ]
    return sorted(found)


def is_mixed(key: str) -> bool:
    """Whether a run has small letters, capitals and digits, as generated keys have."""
    return (
        any(c.isdigit() for c in key)
        and any(c.islower() for c in key)
        and any(c.isupper() for c in key)
    )


def within(parts: list[Span], low: int, high: int) -> int:
    """How many of the sorted, disjoint parts lie in a scope."""
    first = bisect_left(parts, low, key=lambda p: p.start)
    return bisect_left(parts, high, key=lambda p: p.start) - first


def linked_spans(text: str, base: list[Span]) -> list[Span]:
    """Weak parts that have their complements in their scope."""
    secrets = disjoint([s for s in base if s.kind != 1])
    access = [s for s in base if s.kind == 1]

    def weak(pattern: re.Pattern, kind: int, test=lambda m: True) -> list[Span]:
        taken = disjoint(base)
        found = (Span(m.start(), kind, m.end()) for m in pattern.finditer(text) if test(m))
        return [s for s in found if not overlaps(taken, s)]

    ids = weak(IDENTIFIER, 3)
    keys = weak(KEY, 4, lambda m: is_mixed(m.group()))
    points = weak(ENDPOINT, 5)
    keys = [k for k in keys if not overlaps(points, k)]
    taken = disjoint([*base, *ids])
    keys += [k for p in points for k in inner_keys(text, p)]
    keys = sorted(k for k in keys if not overlaps(taken, k))
    if not (ids or keys or points):
        return []
    breaks = [0, *(m.end() for m in BLANK_LINE.finditer(text)), len(text)]
    all_ids = disjoint([*access, *ids])
    all_secrets = disjoint([*secrets, *keys])

    def scope(span: Span) -> tuple[int, int]:
        i = bisect_left(breaks, span.start + 1)
        return breaks[i - 1], breaks[min(i, len(breaks) - 1)]

    kept = [s for s in ids if within(all_secrets, *scope(s))]
    kept += [
        s
        for s in keys
        if within(all_ids, *scope(s)) or within(points, *scope(s)) > overlaps(points, s)
    ]
    kept += [s for s in points if within(all_ids, *scope(s)) and within(all_secrets, *scope(s))]
    return kept


def inner_keys(text: str, point: Span) -> list[Span]:
    """Keys in the query, fragment or user part of an endpoint."""
    address = text[point.start : point.end]
    parts = [m for m in (USER_PART.search(address), QUERY_PART.search(address)) if m]
    return [
        Span(point.start + m.start(1) + k.start(), 4, point.start + m.start(1) + k.end())
        for m in parts
        for k in KEY.finditer(m.group(1))
        if is_mixed(k.group())
    ]


def disjoint(spans: list[Span]) -> list[Span]:
    """Sorted union of the spans."""
    out: list[Span] = []
    for s in sorted(spans):
        if out and s.start < out[-1].end:
            out[-1] = out[-1]._replace(end=max(out[-1].end, s.end))
        else:
            out.append(s)
    return out


def overlaps(parts: list[Span], span: Span) -> bool:
    i = bisect_left(parts, span.start + 1, key=lambda p: p.end)
    return i < len(parts) and parts[i].start < span.end


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in spans)


def possible(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(texts, POSSIBLE), False).to_numpy(
        zero_copy_only=False
    )


def scanned(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and n_assign, n_access, n_hex, base_sha256 and spans of every document."""
    names = [f"keep_{i}" for i in range(len(keep))]
    source = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(text).alias("text"))
    fields = [source.schema[n] for n in names]
    fields += [T.StructField(f"n_{k}", T.LongType()) for k in BASE]
    fields += [T.StructField(c, T.StringType()) for c in ("base_sha256", "spans")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = (0, 0, 0, hashlib.sha256(b"").hexdigest(), "")
        for batch in batches:
            texts = batch.column("text")
            rows = [nothing] * batch.num_rows
            for i in np.flatnonzero(possible(texts)):
                whole = texts[int(i)].as_py()
                base = base_spans(whole)
                spans = sorted([*base, *linked_spans(whole, base)])
                counts = [sum(s.kind == k for s in base) for k in range(3)]
                rows[i] = (*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 3 + [pa.string()] * 2)]
            if rows:
                yield pa.record_batch(
                    [batch.column(n) for n in names] + columns, names=[f.name for f in fields]
                )

    found = source.mapInArrow(scan, T.StructType(fields))
    return found.withColumnsRenamed(dict(zip(names, keep)))


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with ``MASK`` in place of secrets and of what identifies their owner.

    Endpoints stay. Texts without secrets stay as they are.
    """

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            texts = batch.column(at)
            spotted = np.flatnonzero(possible(texts))
            if spotted.size:
                values = texts.to_pylist()
                for i in spotted:
                    base = base_spans(values[i])
                    spans = [s for s in [*base, *linked_spans(values[i], base)] if s.kind != 5]
                    values[i] = without(values[i], disjoint(spans))
                batch = batch.set_column(at, batch.schema.field(at), pa.array(values, texts.type))
            yield batch

    return docs.mapInArrow(mask, docs.schema)


def without(text: str, spans: list[Span]) -> str:
    parts, upto = [], 0
    for s in spans:
        parts += [text[upto : s.start], MASK]
        upto = s.end
    return "".join([*parts, text[upto:]])
