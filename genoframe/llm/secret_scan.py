"""Secrets in texts: fixed patterns, and random-looking strings by entropy.

Base spans are the leftmost non-overlapping matches of three patterns, dropped
if they are too short.  The method adds ``entropy`` spans:

1. Candidates are the runs of ``shortest`` or more characters that keys and
   tokens are written with.
2. For each character class (hexadecimal digits, letters and digits, the
   base-64 alphabet) the candidate is cut into runs of that class, and a window
   of fixed width slides over each run.  Moving by one character changes two
   counts, so the entropy log2(width) - sum(c * log2(c)) / width costs two table
   look-ups a step.  The sum is kept in fixed point, which makes the result the
   same whatever way the window came.
3. Windows over the threshold of their class are joined to spans.  A span needs
   characters of ``kinds`` kinds (lower case, upper case, digits, signs), or it
   is a long word and not a key.
4. Allow list: a span is suppressed if its candidate equals a listed value,
   matches a listed form (identifiers in the form of a UUID, paths, runs in
   alphabetical order, words joined by hyphens) or stands after a listed
   context (data URIs, integrity hashes, commit ids).  Overlaps with base spans
   are suppressed as well.

A document is scanned where it lies; no row moves.  Defined cases: null text is
empty, an empty text has no spans, an empty table gives an empty result, rows
that repeat an id are scanned one by one, very long texts and runs cost linear
time.  Offsets count code points, the end is exclusive.  Columns other than id
and text are not looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}+")
#: Every assignment holds one of these; most texts hold none.
GATES = ("passw", "secret", "token", "apikey", "api_key")
#: Every long run of hexadecimal digits holds such a run.
LONG_RUN = re.compile(r"[0-9A-Za-z+/_=-]{20,}+")

#: Class -> (its characters, window width, least entropy in bits).
CLASSES = {
    "hex": ("0-9a-fA-F", 24, 3.1),
    "alnum": ("0-9A-Za-z", 20, 3.7),
    "base64": (r"0-9A-Za-z+/_=\-", 24, 4.0),
}
#: Forms and contexts of strings that are no secrets.
ALLOWED_FORMS = (
    r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"/?(?:[A-Za-z_.-]+/)+[A-Za-z_.-]*",
    r"[A-Za-z]+(?:[-_][A-Za-z]+)+",
    r"(?:[a-z]+|[A-Z]+|[0-9]+|[=_-]+|[A-Z][a-z]+)",
    r"[A-Z]?[a-z]+(?:[A-Z][a-z]+)+[0-9]{0,4}",
)
ALLOWED_CONTEXTS = (r"base64,$", r"sha(?:1|256|384|512)[-:]$", r"(?i:commit)\x20+$", r"(?i:example|sample|placeholder)[_-]?(?i:key|value)?[:=]\x20*$")
#: Sequences whose parts are no secrets, however many different characters they have.
SEQUENCES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "qwertyuiop", "asdfghjkl", "zxcvbnm")
FIXED = 1 << 20


@dataclass(frozen=True)
class Rules:
    """What counts as a random-looking string."""

    shortest: int = 20
    kinds: int = 2
    classes: dict = field(default_factory=lambda: dict(CLASSES))
    values: frozenset = frozenset()
    forms: tuple = ALLOWED_FORMS
    contexts: tuple = ALLOWED_CONTEXTS


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed."""
    found = []
    low = text.lower()
    if any(word in low for word in GATES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if LONG_RUN.search(text):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(KINDS[kind], start, end) for start, kind, end in sorted(found)]


def entropy_table(width: int) -> list[int]:
    """c * log2(c) for c = 0..width, in fixed point."""
    return [0] + [round(c * math.log2(c) * FIXED) for c in range(1, width + 1)]


def windows_over(run: str, width: int, least: float, table: list[int]) -> Iterator[tuple[int, int]]:
    """Joined (start, end) of the windows of ``run`` with ``least`` bits or more."""
    # H = log2(width) - total / width >= least
    most = round((math.log2(width) - least) * width * FIXED)
    counts: dict[str, int] = {}
    total, start, end = 0, -1, -1
    for at, char in enumerate(run):
        if at >= width:
            out = run[at - width]
            c = counts[out]
            total -= table[c] - table[c - 1]
            counts[out] = c - 1
        c = counts.get(char, 0)
        total += table[c + 1] - table[c]
        counts[char] = c + 1
        if at >= width - 1 and total <= most:
            first = at - width + 1
            if first > end:
                if end > 0:
                    yield start, end
                start = first
            end = at + 1
    if end > 0:
        yield start, end


def _kinds(text: str) -> int:
    return any(c.islower() for c in text) + any(c.isupper() for c in text) + any(c.isdigit() for c in text) + any(not c.isalnum() for c in text)


def _sequence(text: str) -> bool:
    """Whether most of ``text`` runs along a known sequence."""
    low = text.lower()
    steps = sum(any(low[i : i + 3] in s for s in SEQUENCES) for i in range(len(low) - 2))
    return steps * 2 > len(low)


class Scanner:
    """The compiled form of :class:`Rules`."""

    def __init__(self, rules: Rules):
        self.rules = rules
        self.candidate = re.compile(rf"[0-9A-Za-z+/_=-]{{{rules.shortest},}}+")
        self.classes = [(re.compile(f"[{chars}]{{{width},}}"), width, least, entropy_table(width)) for chars, width, least in rules.classes.values()]
        self.form = re.compile("|".join(f"(?:{f})" for f in rules.forms)) if rules.forms else None
        self.context = re.compile("|".join(f"(?:{c})" for c in rules.contexts)) if rules.contexts else None

    def allowed(self, text: str, start: int, end: int) -> bool:
        value = text[start:end]
        if value in self.rules.values or value.strip("=_-/+") in self.rules.values:
            return True
        if self.form and self.form.fullmatch(value):
            return True
        return bool(self.context and self.context.search(text[max(0, start - 40) : start]))

    def entropy_spans(self, text: str) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        for m in self.candidate.finditer(text):
            start, value = m.start(), m[0]
            spans = []
            for runs, width, least, table in self.classes:
                for run in runs.finditer(value):
                    spans += [(run.start() + a, run.start() + b) for a, b in windows_over(run[0], width, least, table)]
            if not spans or self.allowed(text, start, m.end()):
                continue
            for a, b in _united(spans):
                part = value[a:b]
                if _kinds(part) >= self.rules.kinds and any(c.isdigit() for c in part) and not _sequence(part):
                    out.append((start + a, start + b))
        return out

    def spans(self, text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
        """The base spans, and all spans by start and kind."""
        base = base_spans(text)
        taken = _united([(a, b) for _, a, b in base])
        more, at = [], 0
        for a, b in self.entropy_spans(text):
            while at < len(taken) and taken[at][1] <= a:
                at += 1
            if at == len(taken) or taken[at][0] >= b:
                more.append(("entropy", a, b))
        order = {k: n for n, k in enumerate((*KINDS, "entropy"))}
        return base, sorted(base + more, key=lambda s: (s[1], order[s[0]]))


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])
SPANS = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"


def _scan(rules: Rules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            base, every = [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                own, spans = scanner.spans(text)
                base.append([{"kind": k, "start": a, "end": b, "value": text[a:b]} for k, a, b in own])
                every.append([{"kind": k, "start": a, "end": b, "value": text[a:b]} for k, a, b in spans])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, pa.list_(SPAN)), pa.array(every, pa.list_(SPAN))], names=["doc_id", "base", "spans"]
            )

    return run


def find(docs: DataFrame, rules: Rules = Rules(), text: str = "text", doc: str = "doc_id") -> DataFrame:
    """(doc_id, base, spans) per row of ``docs``: arrays of (kind, start, end, value)."""
    rows = docs.select(F.col(doc).alias("doc_id"), F.col(text).cast("string").alias("t"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_scan(rules), f"doc_id {kind}, base {SPANS}, spans {SPANS}")


def redact(docs: DataFrame, rules: Rules = Rules(), mark: str = "[secret]", text: str = "text") -> DataFrame:
    """``docs`` with every found secret replaced by ``mark``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            out = []
            for value in batch.column(at).to_pylist():
                if value:
                    for a, b in reversed(_united([(a, b) for _, a, b in scanner.spans(value)[1]])):
                        value = value[:a] + mark + value[b:]
                out.append(value)
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def joined(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def counted(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
