"""Secret scan with multipart credential linking.

Strong finds stand on their own: assignments to a secret-like name, access
key ids and long hex runs. Weak parts (an identifier assignment, a bare
40-character key, an endpoint) are common in clean text, so they are
reported only where complementary parts co-occur: the parts of a document
are interval-joined by distance, and a weak identifier needs a secret, a
weak key needs an identifier, and an endpoint needs both within ``scope``
code points. A part is never its own partner: only spans that share no
character with it count, and an identifier whose value looks like a key is an
identifier alone.

Each document is judged on its own inside one Arrow task; there is no
shuffle. The join is a binary search per part for the nearest partner on
either side, so a very long text costs n log n of its finds.

Defined results: a null or empty text has no spans; each row gets one result
row, also repeated ones and ones with a null id; at equal start the order of
``KINDS`` holds; an empty table gives an empty result; other columns are
dropped.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import text_or_empty

SCOPE = 200
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "ident", "key", "endpoint")

# What a find looks like. A match that fails its length is dropped, not searched again.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so this equals dropping the shorter ones
IDENT = re.compile(r"""(?<![A-Za-z0-9])(?:access_?key_?id|client_?id|account_?id|user_?name|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@_.-]{3,})""", re.IGNORECASE | re.ASCII)
IDENT_WORDS = ("key_id", "keyid", "client", "account", "user", "login")
KEY = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])")
ENDPOINT = re.compile(r"""[a-z][a-z0-9+.-]{1,20}://[^\s"'<>]+""")

Span = tuple[int, int]


def base_spans(text: str) -> dict[str, list[Span]]:
    low = text.lower()
    found: dict[str, list[Span]] = {}
    found["assign"] = (
        [m.span() for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6] if any(w in low for w in ASSIGN_WORDS) else []
    )
    found["access"] = [m.span() for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found["hex"] = [m.span() for m in HEX.finditer(text)]
    return found


class _Partners:
    """Spans that a part may be linked with."""

    def __init__(self, *lists: list[Span]):
        self.starts = sorted(s for one in lists for s, _ in one)
        self.ends = sorted(e for one in lists for _, e in one)

    def near(self, at: Span, scope: int) -> bool:
        """Whether a span without a character of ``at`` lies within ``scope`` of it: the nearest on either side."""
        before, after = bisect_right(self.ends, at[0]) - 1, bisect_left(self.starts, at[1])
        return (before >= 0 and at[0] - self.ends[before] <= scope) or (after < len(self.starts) and self.starts[after] - at[1] <= scope)


def _clear_of(spans: list[Span], taken: list[Span]) -> list[Span]:
    """The spans that overlap none of ``taken`` (sorted, disjoint)."""
    out = []
    for s, e in spans:
        k = bisect_left(taken, (s, e))
        if not any(a < e and s < b for a, b in taken[max(k - 1, 0) : k + 1]):
            out.append((s, e))
    return out


def _merged(*lists: list[Span]) -> list[Span]:
    out: list[Span] = []
    for s, e in sorted(x for one in lists for x in one):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def secret_spans(text: str, scope: int = SCOPE) -> list[tuple[str, int, int]]:
    """All spans ``(kind, start, end)`` of one text, by start, then kind."""
    found = base_spans(text)
    low = text.lower()
    taken = _merged(*found.values())
    idents = [m.span() for m in IDENT.finditer(text)] if any(w in low for w in IDENT_WORDS) else []
    keys = [m.span() for m in KEY.finditer(text) if _mixed(m.group())]
    ends = [m.span() for m in ENDPOINT.finditer(text)] if "://" in text else []
    idents, keys, ends = (_clear_of(x, taken) for x in (idents, keys, ends))
    keys = _clear_of(keys, idents)  # an identifier whose value looks like a key is one part
    if idents or keys or ends:
        all_ids = _Partners(found["access"], idents)
        all_secrets = _Partners(found["assign"], found["hex"], keys)
        found["ident"] = [x for x in idents if all_secrets.near(x, scope)]
        found["key"] = [x for x in keys if all_ids.near(x, scope)]
        found["endpoint"] = [x for x in ends if all_ids.near(x, scope) and all_secrets.near(x, scope)]
    return sorted(((k, s, e) for k, v in found.items() for s, e in v), key=lambda x: (x[1], KINDS.index(x[0])))


def _mixed(key: str) -> bool:
    """Digits, capitals and small letters together: a key rather than a long word or number."""
    return not (key.isalpha() or key.isdigit() or key == key.lower() or key == key.upper())


SPANS_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_secrets(docs: DataFrame, scope: int = SCOPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, spans array<struct<kind, start, end>>``; starts and ends in code points."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [{"kind": k, "start": s, "end": e} for k, s, e in secret_spans(t, scope)]
                for t in batch.column(1).to_pylist()
            ]
            yield pa.record_batch([batch.column(0), pa.array(spans, type=SPANS_TYPE)], names=[id_col, "spans"])

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), text_or_empty(text_col).alias("_text"))
    return rows.mapInArrow(scan, f"`{id_col}` {id_type}, spans array<struct<kind:string,start:bigint,end:bigint>>")
