"""Chat formatting: a finite-state machine over roles and a declarative template.

Conversations are dealt by identifier and sorted by turn; one streaming pass
per partition runs the machine, renders every turn and emits its segments
with a loss flag each.  State is one conversation's position, never its rows,
so a conversation of any length fits.  ``read_back`` parses rendered text
alone and undoes the escapes.

Escaping: every control string inside a role or a text gets a backslash before
it and every backslash is doubled, so a control string counts only after an
even number of backslashes.

Edge cases: a null text or role counts as empty; a role outside the machine
makes the conversation invalid but is rendered all the same; equal turn numbers
are ordered by role, then text; null turns come first and null identifiers
form one conversation; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """How a turn is rendered and which orders of roles are valid."""

    head: str = "### "
    after_role: str = ": "
    tail: str = "</turn>\n"
    #: Strings that are escaped inside roles and texts.
    control: tuple[str, ...] = ("### ", ": ", "</turn>")
    #: Roles whose text is learned.
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    accept: tuple[str, ...] = ("assistant",)
    #: (state, role) -> state.
    moves: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user",
        ("user", "assistant"): "assistant", ("assistant", "user"): "user"})

    def escape(self, text: str) -> str:
        text = text.replace("\\", "\\\\")
        for control in self.control:
            text = text.replace(control, "\\" + control)
        return text

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """(rendered text, loss flag) of one turn."""
        return [(self.head + self.escape(role) + self.after_role, False),
                (self.escape(text), role in self.loss_roles), (self.tail, False)]

    def parse(self, rendered: str) -> Iterator[tuple[str, int, int]]:
        """(role, start, end) of each turn's text in ``rendered``."""
        at = 0
        while at < len(rendered):
            if not rendered.startswith(self.head, at):
                raise ValueError(f"no turn begins at {at}")
            role_end = _unescaped(rendered, self.after_role, at + len(self.head))
            start = role_end + len(self.after_role)
            end = _unescaped(rendered, self.tail, start)
            yield self.unescape(rendered[at + len(self.head):role_end]), start, end
            at = end + len(self.tail)


def _unescaped(text: str, control: str, at: int) -> int:
    """Where ``control`` first stands after an even number of backslashes."""
    begin = at
    while (at := text.find(control, at)) >= 0:
        before = at
        while before > begin and text[before - 1] == "\\":
            before -= 1
        if (at - before) % 2 == 0:
            return at
        at += 1
    raise ValueError(f"{control!r} is missing")


TURN_SCHEMA = ("id {kind}, first boolean, last boolean, valid boolean, formatted string, "
               "segments array<struct<start:bigint,end:bigint,loss:boolean>>")
SEGMENTS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("loss", pa.bool_())]))


def _render(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, started, current, held = None, False, None, None

        for batch in batches:
            ids = batch.column("id")
            rows = []
            for key, role, text in zip(ids.to_pylist(), batch.column("role").to_pylist(),
                                       batch.column("text").to_pylist(), strict=True):
                first = not started or key != current
                if held is not None:
                    rows.append((*held, first))
                if first:
                    state, started, current = template.start, True, key
                state = template.moves.get((state, role), "invalid")
                at, pieces, segments = 0, [], []
                for piece, loss in template.segments(role, text):
                    segments.append({"start": at, "end": at + len(piece), "loss": loss})
                    pieces.append(piece)
                    at += len(piece)
                held = (key, first, state in template.accept, "".join(pieces), segments)
            yield _turn_batch(rows, ids.type)
        if held is not None:
            yield _turn_batch([(*held, True)], ids.type)
    return run


def _turn_batch(rows, kind: pa.DataType) -> pa.RecordBatch:
    key, first, valid, text, segments, last = (list(x) for x in zip(*rows, strict=True)) if rows else ([],) * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(key, kind), pa.array(first, pa.bool_()), pa.array(last, pa.bool_()),
         pa.array([v if z else None for v, z in zip(valid, last, strict=True)], pa.bool_()),
         pa.array(text, pa.string()), pa.array(segments, SEGMENTS)],
        names=["id", "first", "last", "valid", "formatted", "segments"])


def format_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", template: Template = Template()) -> DataFrame:
    """One row per turn, the turns of a conversation in order and next to each
    other: ``id``, ``first``, ``last``, ``valid`` (at the last turn: whether
    the machine accepted), ``formatted`` and its ``segments`` with loss flags."""
    kind = dict(conversations.dtypes)[id_col]
    rows = conversations.select(F.col(id_col).alias("id"), F.col(turn_col).alias("turn"),
                                F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                                F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = rows.repartition("id").sortWithinPartitions("id", "turn", "role", "text")
    return ordered.select("id", "role", "text").mapInArrow(_render(template), TURN_SCHEMA.format(kind=kind))


def read_back(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation from the rendered turns alone: ``n_turns``,
    ``turns_sha256``, ``loss_chars``, ``loss_sha256``, ``formatted_chars`` and
    ``valid``.  Hashes run along the rows; nothing is gathered."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = loss_chars = chars = 0
        all_hash = loss_hash = None
        for batch in batches:
            out = []
            for row in batch.select(["id", "first", "last", "valid", "formatted", "segments"]).to_pylist():
                if row["first"]:
                    n = loss_chars = chars = 0
                    all_hash, loss_hash = hashlib.sha256(), hashlib.sha256()
                text = row["formatted"]
                for role, start, end in template.parse(text):
                    n += 1
                    all_hash.update(f"{role}\n{template.unescape(text[start:end])}\n".encode())
                for s in row["segments"]:
                    if s["loss"]:
                        learned = template.unescape(text[s["start"]:s["end"]])
                        loss_chars += len(learned)
                        loss_hash.update(learned.encode())
                chars += len(text)
                if row["last"]:
                    out.append((row["id"], n, all_hash.hexdigest(), loss_chars, loss_hash.hexdigest(), chars, row["valid"]))
            columns = [list(x) for x in zip(*out, strict=True)] if out else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (batch.column("id").type, pa.int64(), pa.string(), pa.int64(),
                                                          pa.string(), pa.int64(), pa.bool_()), strict=True)],
                names=["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"])

    kind = dict(turns.dtypes)["id"]
    return turns.mapInArrow(run, f"id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                                 "loss_sha256 string, formatted_chars bigint, valid boolean")


PROBE_ID, PROBE_TEXT = -7, r"\### Assistant: </turn> ok"


def with_probe(conversations: DataFrame) -> DataFrame:
    """The conversations and one more whose texts hold control strings."""
    probe = conversations.sparkSession.createDataFrame(
        [(PROBE_ID, 0, "user", PROBE_TEXT), (PROBE_ID, 1, "assistant", PROBE_TEXT)],
        "conv_id bigint, turn bigint, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)


OP5_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
         length('### ' || replace(replace(replace(replace(role, '\', '\\'), '### ', '\### '), ': ', '\: '), '</turn>', '\</turn>')
                || ': ' || replace(replace(replace(replace(text, '\', '\\'), '### ', '\### '), ': ', '\: '), '</turn>', '\</turn>')
                || '</turn>' || chr(10)) AS rendered
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(rendered) AS BIGINT) AS formatted_chars,
       regexp_full_match(string_agg(role, ',' ORDER BY k), '(system,)?user,assistant(,user,assistant)*') AS valid
FROM e GROUP BY conv_id
"""
