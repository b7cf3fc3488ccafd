"""Secret scan: known forms first, then sliding-window entropy.

Known forms are an assignment to a password-like name, an access key and a
long hex run.  Beyond them, candidate strings (long runs of token characters)
are cut into runs of one character class; a window slides over each run, its
Shannon entropy kept by incremental counts, and windows above the class's
threshold merge into spans, each extended to its whole token.  Harmless forms
(words, numbers, dates, UUIDs) are suppressed by an allow-list that has to
match from end to end; sequences and placeholders are left out of a candidate
before the rest of it is judged.  Of a span that meets a known form, what lies
outside is reported.  Offsets count code points, ends are exclusive.  One pass,
no shuffle, whole texts.

Edge cases: a null text counts as empty and has no spans; any length of text
or run is scanned in linear time; repeated rows are scanned each; an empty
table gives an empty result; extra columns pass through ``redact`` and are
ignored by ``scan``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BASE_KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_CHARS = 12
# a greedy run of one class: the least length inside the pattern finds the same runs
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

#: Entropy classes: name, pattern of a run, window, bits per character.
CLASSES = (
    ("entropy_hex", re.compile(r"[0-9A-Fa-f]{20,}"), 20, 3.0),
    ("entropy_base64", re.compile(r"[A-Za-z0-9+/_=-]{20,}"), 20, 3.85),
    # a hundredth of the windows of random tokens are below (simulated: 3.41 of 36 symbols, 3.32 of 32)
    ("entropy_lower", re.compile(r"[a-z0-9]{20,}"), 20, 3.4),
    ("entropy_upper", re.compile(r"[A-Z0-9]{20,}"), 20, 3.4),
    ("entropy_base32", re.compile(r"[A-Z2-7]{20,}|[a-z2-7]{20,}"), 20, 3.3),
)
#: Classes in the order in which they claim characters, and the one whose symbols are separators too.
CLASS_ORDER, WITH_SEPARATORS = (0, 4, 2, 3, 1), 1
SEPARATORS = "+/_=-"
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: A span that one of these matches from end to end is harmless.
ALLOWED = (
    re.compile(r"[0-9_+/=-]+"),  # numbers, dates, phone numbers
    re.compile(r"[+/_=-]*(?:[A-Z]?[a-z]+|[A-Z]+)(?:[+/_=-]+(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4}))*[+/_=-]*"),  # words, paths
    re.compile(r"(?:[A-Z]?[a-z]+|[A-Z]+)[0-9]{1,4}"),  # a word and its number
    re.compile(r"[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}"),  # UUIDs
)
#: Stretches that are not judged: sequences, as far as they go on, and placeholders.
ALLOWED_PART = re.compile("(?P<sequence>abcdefgh|ABCDEFGH|01234567|12345678|xxxxxxxx)|EXAMPLE|example|placeholder")
PART, NEXT_PART, PADDING = re.compile(r"[A-Za-z0-9]*"), re.compile(r"[+/_-]{1,2}([A-Za-z0-9]+)"), re.compile(r"=*")
MARK = "[SECRET]"


def windows(run: str, width: int, bits: float) -> Iterator[tuple[int, int]]:
    """Merged (start, end) of the windows of ``run`` whose entropy is at least
    ``bits``.  entropy = log2(width) - sum(c * log2(c)) / width."""
    if len(run) < width:
        return
    part = [0.0] + [c * math.log2(c) for c in range(1, width + 2)]  # a window and the next character
    most = (math.log2(width) - bits) * width + 1e-9  # of the sum of c * log2(c)
    counts: dict[str, int] = {}
    total, start, end = 0.0, -1, -1
    for i, char in enumerate(run):
        c = counts.get(char, 0)
        counts[char] = c + 1
        total += part[c + 1] - part[c]
        if i >= width:
            gone = run[i - width]
            c = counts[gone]
            counts[gone] = c - 1
            total += part[c - 1] - part[c]
        if i >= width - 1 and total <= most:
            first = i - width + 1
            if first > end:
                if end >= 0:
                    yield start, end
                start = first
            end = i + 1
    if end >= 0:
        yield start, end


def allowed(run: str) -> bool:
    return any(p.fullmatch(run) for p in ALLOWED)


def harmless(run: str) -> bool:
    return allowed(run) or not (re.search("[0-9]", run) and re.search("[A-Za-z]", run))


def judged_places(candidate: str) -> list[int]:
    """Places of ``candidate`` outside placeholders and whole sequences."""
    places, at = [], 0
    for m in ALLOWED_PART.finditer(candidate):
        if m.start() < at:
            continue
        start, end = m.span()
        step = ord(candidate[start + 1]) - ord(candidate[start])
        if m.lastgroup == "sequence":
            while end < len(candidate) and ord(candidate[end]) - ord(candidate[end - 1]) == step:
                end += 1
            while start > at and ord(candidate[start]) - ord(candidate[start - 1]) == step:
                start -= 1
        places += range(at, start)
        at = end
    return [*places, *range(at, len(candidate))]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), leftmost and non-overlapping per kind, by start and kind."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_CHARS]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def entropy_spans(text: str, known: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of high-entropy spans, as far as they lie outside the
    known ones and each other; the kinds follow those of BASE_KINDS in the order
    of CLASSES."""
    found: list[tuple[int, int, int]] = []
    taken = None  # of every character: is it in a span
    for match in CANDIDATE.finditer(text):
        candidate, at = match.group(), match.start()
        places = judged_places(candidate)
        rest = candidate if len(places) == len(candidate) else "".join(candidate[i] for i in places)
        if harmless(rest):
            continue
        for k in CLASS_ORDER:
            _, runs, width, bits = CLASSES[k]
            done = 0  # end of the last span of the class in the candidate
            for run in runs.finditer(rest):
                for a, b in windows(run.group(), width, bits):
                    start, end = places[run.start() + a], places[run.start() + b - 1] + 1
                    if end <= done or harmless(run.group()[a:b]):
                        continue
                    start, end = whole(candidate, max(start, done), end, done, k == WITH_SEPARATORS)
                    done = end
                    if taken is None:
                        taken = bytearray(len(text))
                        for s, _, e in known:
                            taken[s:e] = b"\1" * (e - s)
                    for s, e in free(text, taken, at + start, at + end):
                        taken[s:e] = b"\1" * (e - s)
                        found.append((s, len(BASE_KINDS) + k, e))
    return found


def whole(candidate: str, start: int, end: int, least: int, across: bool) -> tuple[int, int]:
    """The span and the rest of the token it is part of, from ``least`` on: up to
    separators or, ``across`` them, up to a word or number of four characters."""
    size = len(candidate)
    back = candidate[::-1]
    start, end = max(least, size - PART.match(back, size - start).end()), PART.match(candidate, end).end()
    while across and (m := NEXT_PART.match(candidate, end)) and not (len(m[1]) >= 4 and allowed(m[1])):
        end = m.end()
    while across and (m := NEXT_PART.match(back, size - start)) and not (len(m[1]) >= 4 and allowed(m[1][::-1])) \
            and m.end() <= size - least:
        start = size - m.end()
    return start, PADDING.match(candidate, end).end()


def free(text: str, taken: bytearray, start: int, end: int) -> list[tuple[int, int]]:
    """What of ``start`` to ``end`` is not taken.  A word or number that a
    separator parts from a taken stretch is no remainder of a secret."""
    out = []
    while 0 <= (s := taken.find(0, start, end)):
        e = taken.find(1, s, end)
        e = end if e < 0 else e
        cut_left, cut_right = s > 0 and taken[s - 1], e < len(taken) and taken[e]
        apart = (not cut_left or text[s] in SEPARATORS) and (not cut_right or text[e - 1] in SEPARATORS)
        if any(c not in SEPARATORS for c in text[s:e]) and not ((cut_left or cut_right) and apart and allowed(text[s:e])):
            out.append((s, e))
        start = e
    return out


def find(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and all spans."""
    text = text or ""
    base = base_spans(text)
    return base, sorted(base + entropy_spans(text, base))


def kind_name(kind: int) -> str:
    return (*BASE_KINDS, *(c[0] for c in CLASSES))[kind]


def digest(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{kind_name(k)}:{a}:{b}" for a, k, b in spans)


SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = []
        for text in batch.column("text"):
            base, every = find(text.as_py())
            is_base = set(base)
            spans.append([{"kind": kind_name(k), "start": a, "end": b, "base": (a, k, b) in is_base}
                          for a, k, b in every])
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(spans, SPAN)], names=["id", "spans"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>`` and ``spans``, an array of (kind, start, end, base) by start
    and kind, for every row of ``docs``."""
    kind_of_id = dict(docs.dtypes)[id_col]
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(_scan, f"id {kind_of_id}, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>")
            .withColumnRenamed("id", id_col))


def span_digest(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def summary(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digests of the spans of ``scan``."""
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    return scanned.select(id_col, *(count(k).alias(f"n_{k}") for k in BASE_KINDS),
                          F.sha2(span_digest(base), 256).alias("base_sha256"), span_digest(F.col("spans")).alias("spans"))


def masked(text: str | None, mark: str = MARK) -> str | None:
    """``text`` with every span, and spans that overlap, replaced by one mark."""
    if not text:
        return text
    out, at = [], 0
    for start, _, end in find(text)[1]:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


def redact(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with secrets masked in ``text_col`` and ``chars_col`` (if there)
    set to the new length of a text that changed."""
    names = docs.columns
    at = names.index(text_col)
    chars = names.index(chars_col) if chars_col in names else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            fresh = [masked(t) for t in texts]
            columns = list(batch.columns)
            columns[at] = pa.array(fresh, columns[at].type)
            if chars >= 0:
                old = columns[chars].to_pylist()
                columns[chars] = pa.array([n if a is None or a == b else len(b) for n, a, b in zip(old, texts, fresh, strict=True)],
                                          columns[chars].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema.fields])
    return docs.mapInArrow(run, schema)
