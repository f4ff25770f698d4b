"""Secret scans with multipart credential linking (operator 3).

Method. Base patterns find assignments, access ids and long hex strings. Weaker
candidates are parts of a credential: identifiers (user, client or account names,
short access ids), secrets (long mixed strings without a name), endpoints (URLs,
hosts with a port). Alone they mean nothing. Each part has a scope, ``REACH``
characters to both sides but not across a blank line, and parts whose scopes
reach each other are joined: a weak secret is reported if an identifier or an
endpoint is in reach, an identifier if a secret is, an endpoint if a secret and
an identifier are. Base spans are secrets (assignments, hex) or identifiers
(access ids) for this purpose and are always reported.

The join sorts the parts of a text and looks up each part's neighbours, so a
text with very many parts yields no pairs of them. Texts without anything like a
secret are passed over by a scan in Arrow.

Defined cases. Null text is empty and has no span. Rows that repeat an id are
scanned each. Overlapping spans of different kinds are all reported; redaction
merges them.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import chunks, fresh_names, id_and_text, import_on_executors

REACH = 200
PLACEHOLDER = "[redacted]"

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "secret", "identifier", "endpoint")

_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_LENGTH)
_WEAK_SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{32,}={0,2}(?![A-Za-z0-9+/_=-])")
_IDENTIFIER = re.compile(
    r"""(?:access_key_id|client_?id|account_?id|user_?name|username|user|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""",
    re.ASCII | re.IGNORECASE,
)
_ENDPOINT = re.compile(
    r"(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s\"'<>]+"
    r"|(?<![A-Za-z0-9.-])(?:[a-z0-9-]+\.)+[a-z]{2,}:[0-9]{2,5}(?![0-9])"
)
#: Whatever any secret, strong or weak, holds; a text without it has no span to report.
_ANY = r"(?i:password|passwd|secret|token|api_?key)|AKIA[A-Z0-9]|[A-Za-z0-9+/_-]{24}"
_BLANK = re.compile(r"\n[ \t\r]*\n")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns, in code points, end exclusive."""
    out = [
        ("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH
    ]
    out += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    # a run that is too short fails anyway, so only long ones are looked for
    return out + [("hex", *m.span()) for m in _HEX.finditer(text)]


def _mixed(value: str) -> bool:
    """Upper and lower case and digits, or letters and digits, with the entropy of random text."""
    if not (re.search("[0-9]", value) and re.search("[A-Za-z]", value)):
        return False
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= 3.5


def weak_parts(text: str, base: list[Span]) -> list[Span]:
    """Candidates that count only in company, apart from what base spans cover."""
    taken = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in taken]
    ends = np.maximum.accumulate([b for _, b in taken]).tolist() if taken else []

    def free(a: int, b: int) -> bool:
        at = bisect.bisect_left(starts, b)
        return at == 0 or ends[at - 1] <= a

    out = [
        ("identifier", *m.span()) for m in _ACCESS.finditer(text)
        if 12 <= len(m[0]) < ACCESS_LENGTH
    ]
    out += [("identifier", *m.span()) for m in _IDENTIFIER.finditer(text)]
    out += [("endpoint", *m.span()) for m in _ENDPOINT.finditer(text)]
    urls = sorted(out, key=lambda s: s[1])
    out = [s for s in urls if free(s[1], s[2])]
    taken = sorted([*taken, *((a, b) for _, a, b in out)])
    starts = [a for a, _ in taken]
    ends = np.maximum.accumulate([b for _, b in taken]).tolist() if taken else []
    out += [
        ("secret", *m.span()) for m in _WEAK_SECRET.finditer(text) if free(*m.span()) and _mixed(m[0])
    ]
    return out


def linked(text: str, base: list[Span], weak: list[Span], reach: int = REACH) -> list[Span]:
    """The weak parts that have their complements in scope."""
    if not weak:
        return []
    blanks = [m.start() for m in _BLANK.finditer(text)]
    roles: dict[str, list[tuple[int, int, int]]] = {"secret": [], "identifier": [], "endpoint": []}
    role = {"assign": "secret", "hex": "secret", "access": "identifier"}
    for kind, a, b in [*base, *weak]:
        # a blank line parts scopes
        roles[role.get(kind, kind)].append((bisect.bisect(blanks, a), a, b))
    sides = {}
    for name, parts in roles.items():
        parts.sort()
        blocks = [p[0] for p in parts]
        ends, last = [], {}
        for block, _, b in parts:
            last[block] = max(last.get(block, 0), b)
            ends.append(last[block])
        sides[name] = ([(p[0], p[1]) for p in parts], blocks, ends)

    def near(name: str, block: int, a: int, b: int) -> bool:
        """Whether a part of this role begins before the scope's end and ends after its start."""
        keys, blocks, ends = sides[name]
        at = bisect.bisect_right(keys, (block, b + reach)) - 1
        return at >= 0 and blocks[at] == block and ends[at] >= a - reach

    out = []
    for kind, a, b in weak:
        block = bisect.bisect(blanks, a)
        company = {name: near(name, block, a, b) for name in roles if name != kind}
        if kind == "secret":
            kept = company["identifier"] or company["endpoint"]
        elif kind == "identifier":
            kept = company["secret"]
        else:
            kept = company["secret"] and company["identifier"]
        if kept:
            out.append((kind, a, b))
    return out


def spans_of(text: str, reach: int = REACH) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, each by start and then by kind."""
    base = base_spans(text)
    extra = linked(text, base, weak_parts(text, base), reach)

    def order(span: Span) -> tuple[int, int, int]:
        return span[1], KINDS.index(span[0]), span[2]

    return sorted(base, key=order), sorted([*base, *extra], key=order)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def _suspect(text: pa.Array) -> np.ndarray:
    return pc.match_substring_regex(text, _ANY).to_numpy(zero_copy_only=False)


def _scan(reach: int) -> Callable:
    nothing = hashlib.sha256(b"").hexdigest()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            n, text = batch.num_rows, batch.column("text")
            counts = np.zeros((n, len(BASE)), dtype=np.int64)
            digests, found = [nothing] * n, [""] * n
            suspects = np.flatnonzero(_suspect(text))
            for i, value in zip(suspects, text.take(pa.array(suspects)).to_pylist()):
                base, every = spans_of(value, reach)
                counts[i] = [sum(kind == k for kind, _, _ in base) for k in BASE]
                digests[i] = hashlib.sha256(joined(base).encode()).hexdigest()
                found[i] = joined(every)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    **{f"n_{kind}": pa.array(counts[:, k]) for k, kind in enumerate(BASE)},
                    "base_sha256": pa.array(digests),
                    "spans": pa.array(found),
                }
            )

    return scan


def secret_scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH
) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (``kind:start:end``, comma-joined)."""
    return id_and_text(docs, id_col, text_col).mapInArrow(
        _scan(reach),
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
    )


def redacted(text: str, reach: int = REACH, placeholder: str = PLACEHOLDER) -> str:
    """The text with a placeholder for each run of overlapping spans."""
    out, at = [], 0
    for _, a, b in spans_of(text, reach)[1]:
        if a >= at:
            out += [text[at:a], placeholder]
        at = max(at, b)
    return "".join([*out, text[at:]])


def changed_by_redaction(text: Column, reach: int = REACH) -> Column:
    """The text with secrets replaced, null where there is none."""

    @F.arrow_udf("string")
    def changed(texts: pa.Array) -> pa.Array:
        suspects = np.flatnonzero(_suspect(pc.fill_null(texts, "")))
        out: list[str | None] = [None] * len(texts)
        for i, value in zip(suspects.tolist(), texts.take(pa.array(suspects)).to_pylist()):
            clean = redacted(value, reach)
            if clean != value:
                out[i] = clean
        return pa.array(out, pa.string())

    return changed(text.cast("string"))


def redact_secrets(
    docs: DataFrame,
    text_col: str = "text",
    length_col: str | None = None,
    reach: int = REACH,
) -> DataFrame:
    """All rows and columns of ``docs``, with secrets in the text replaced; null stays null.

    ``length_col``, if given, becomes the number of characters where the text changed.
    """
    import_on_executors(docs.sparkSession)
    (name,) = fresh_names(docs.columns, "changed")
    changed = F.col(name)
    columns = {text_col: F.coalesce(changed, docs[text_col].cast("string"))}
    if length_col:
        kind = docs.schema[length_col].dataType
        columns[length_col] = F.coalesce(F.char_length(changed).cast(kind), F.col(length_col))
    found = docs.withColumn(name, changed_by_redaction(docs[text_col], reach))
    return found.withColumns(columns).select(*docs.columns)
