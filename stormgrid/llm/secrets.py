"""Secret spans, and multipart credentials: identifiers, secrets and endpoints that stand near each other.

Strong parts (an assigned secret, an access key id, a long hex run) are reported wherever they stand. Weak parts (a
bare 40-character token, an assigned user or client name, a host) say nothing alone: they are reported only when an
interval join inside their scope, the text between blank lines, finds the parts that complete them within
``reach`` characters. The join is a binary search in the sorted spans of one document, so no pairs are listed.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_ranges

KINDS = ("assign", "access", "hex", "ident", "secret", "endpoint")
REACH = 400

_ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_IDENT = re.compile(
    r"""(?i:\b(?:access_?key_?id|client_?id|app_?id|account|user_?name|user|login))["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9._@-]{3,})""", re.A)
_SECRET = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])")
_ENDPOINT = re.compile(r"\b[a-z][a-z0-9+.-]*://[^\s\"'<>]+|(?i:\b(?:endpoint|host|server))[\"']?\x20*[:=]\x20*[\"']?"
                       r"[A-Za-z0-9.-]+\.[A-Za-z]{2,}(?::\d+)?", re.A)
_BLANK = re.compile(r"\n[\x20\t\r]*\n")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    partners: tuple[int, ...] = ()      # starts of the parts that complete a weak one


def base_spans(text: str) -> list[Span]:
    spans = [Span("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    spans += [Span("access", *m.span()) for m in _ACCESS.finditer(text)]
    return spans + [Span("hex", *m.span()) for m in _HEX.finditer(text)]


class _Near:
    """Sorted spans of one sort of part; the one nearest to an interval inside bounds."""

    def __init__(self, spans: list[Span]):
        spans = sorted(spans, key=lambda s: (s.start, s.end))
        self.starts, self.ends = [s.start for s in spans], []
        for s in spans:         # ends never fall, so that they can be searched
            self.ends.append(max(s.end, self.ends[-1] if self.ends else 0))

    def to(self, span: Span, low: int, high: int) -> int | None:
        first, last = bisect_right(self.ends, low), bisect_left(self.starts, high)
        if first >= last:
            return None
        at = bisect_left(self.starts, span.start, first, last)
        around = self.starts[max(first, at - 1):min(last, at + 1)]
        return min(around, key=lambda s: abs(s - span.start))


def find(text: str | None, reach: int = REACH) -> list[Span]:
    """All spans by start, then kind in the order of ``KINDS``."""
    text = text or ""
    spans = base_spans(text)
    strong = _Near(spans)

    def weak(kind, pattern):
        found = (Span(kind, *m.span()) for m in pattern.finditer(text))
        return [s for s in found if strong.to(s, s.start, s.end) is None]

    names = [s for s in spans if s.kind == "access"]
    idents = weak("ident", _IDENT)
    # a later kind matters only where an earlier one is there to complete it
    tokens = weak("secret", _SECRET) if names or idents else []
    values = [s for s in spans if s.kind != "access"] + tokens
    hosts = weak("endpoint", _ENDPOINT) if values and (names or idents) else []
    if idents or tokens or hosts:
        cuts = [m.start() for m in _BLANK.finditer(text)]
        who, what = _Near(names + idents), _Near(values)
        for group, needs in ((idents, (what,)), (tokens, (who,)), (hosts, (who, what))):
            for s in group:
                at = bisect_right(cuts, s.start)
                low = max(s.start - reach, cuts[at - 1] if at else 0)
                high = min(s.end + reach, cuts[at] if at < len(cuts) else len(text))
                partners = tuple(near.to(s, low, high) for near in needs)
                if None not in partners:
                    spans.append(s._replace(partners=partners))
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


_ROW = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                  ("partners", pa.list_(pa.int64()))])


def credential_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     reach: int = REACH) -> DataFrame:
    """``(doc_id, found)``: for each row the array of its spans (code points, end exclusive).

    One narrow pass over whole texts, nothing is shuffled. A null or empty text has no spans; repeated and
    null ids are kept as rows of their own; other columns are not looked at.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(batches):
        for batch in batches:
            for lo, hi in row_ranges(batch.column(1), 1 << 23):
                found = [[s._asdict() for s in find(t, reach)] for t in batch.column(1)[lo:hi].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], pa.array(found, pa.list_(_ROW))], ["doc_id", "found"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        rows, f"doc_id {kind}, found array<struct<kind: string, start: bigint, end: bigint, partners: array<bigint>>>")
