"""Repair of conversation structure by a streamed dynamic programme.

Rows are repartitioned by conversation once and all passes run inside that
exchange's partitions on local, external sorts, so no conversation is ever
held whole:

1. Duplicates: numbered by a window over (conversation, role, text).
2. Backward, turns descending: a fold over the rows carries, across Arrow
   batches, the least cost from each state of the grammar ``(s?(ua)+)?`` to
   the end.  Each row leaves with one byte of backpointers, two bits per
   state: Delete, Insert before it, Keep or Rerole.  From a state each letter
   has one outcome, so taking the least letter among equal costs gives the
   least audit.
3. Forward, turns ascending: the next external sort carries rows and
   backpointers (it spills them with the rows of giant conversations); the walk follows
   them from the start state and folds counts, audit and digest, or gives the
   repaired turns themselves.

Costs: Keep 0, Rerole to user or assistant 2, Delete 3 (the only edit of blank
and duplicate rows), Insert of an empty user or assistant turn 2; an undeleted
truncated row adds 1.

Edge cases: null role and text count as one space; turns sort with nulls
first, rows of one turn by role and text; a null identifier is a
conversation; rows repeated are duplicates; an empty table gives an empty
result; extra columns are ignored; gaps beyond 64 bits are cut to the largest
long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LETTERS = "DIKR"
FAULTS = ("blank", "duplicate", "truncated")
_OTHER, _MUST_GO, _CUT = 3, 4, 8  # a row's class: its role's initial (s, u, a or another), and what is wrong with it
#: States: start, after s, after u, after a.  What keeping a row of the initial s, u, a leads to.
_KEEP = ({0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2})
#: What a user or assistant turn, the one that is due, leads to.
_DUE = (2, 2, 3, 2)
_ROLE = ("user", "user", "assistant", "user")
_END = (0, 4, 2, 0)
_MAX = 2 ** 63 - 1


def damaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows damaged by crc32(``conversation:turn``) mod 20: 0 drops the row
    (``present`` false), 1 empties its text, 2 removes its full stops, question
    and exclamation marks, 3 repeats it, 4 makes its role user."""
    def word(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = turns.select(F.col(conv_col), F.col(turn_col), word(role_col).alias(role_col), word(text_col).alias(text_col),
                        F.pmod(F.crc32(F.concat(word(conv_col), F.lit(":"), word(turn_col)).cast("binary")), F.lit(20)).alias("_way"))
    way = F.col("_way")
    rows = rows.withColumn("_copy", F.explode(F.when(way == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    text = (F.when(way == 1, F.lit("")).when(way == 2, F.regexp_replace(text_col, "[.!?]", "")).otherwise(F.col(text_col)))
    return rows.select(conv_col, turn_col, F.when(way == 4, F.lit("user")).otherwise(F.col(role_col)).alias(role_col),
                       text.alias(text_col), (way != 0).alias("present"))


def step(after: tuple, kind: int) -> tuple[tuple, int]:
    """Least costs from each state before a row, given those after it, and the
    row's backpointers."""
    cut = 1 if kind & _CUT else 0
    row = []
    for state in range(4):
        options = [(3 + after[state], "D")]
        if not kind & _MUST_GO:
            if (kept := _KEEP[state].get(kind & 3)) is not None:
                options.append((cut + after[kept], "K"))
            options.append((2 + cut + after[_DUE[state]], "R"))
        row.append(min(options))
    costs, moves = [], 0
    for state in range(4):
        one = _DUE[state]
        inserted = min(2 + row[one][0], 4 + row[_DUE[one]][0])
        cost, letter = min(row[state], (inserted, "I"))
        costs.append(cost)
        moves |= LETTERS.index(letter) << (2 * state)
    return tuple(costs), moves


class _Steps(dict):
    """``step`` by (costs relative to the least, class); few of them occur."""

    def __missing__(self, key):
        costs, moves = step(*key)
        self[key] = value = (tuple(c - min(costs) for c in costs), moves)
        return value


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    steps, conv, costs, begun = _Steps(), None, _END, False
    for batch in batches:
        moves = bytearray()
        for key, kind, present in zip(batch.column("conv").to_pylist(), batch.column("kind").to_pylist(), batch.column("present").to_pylist(), strict=True):
            if not begun or key != conv:
                conv, costs, begun = key, _END, True
            move = 0
            if present:
                costs, move = steps[costs, kind]
            moves.append(move)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(moves), pa.int16())], names=[*batch.schema.names, "moves"])


class _Report:
    """The counts, audit and digest of one conversation, row by row."""

    names = ("gaps", *FAULTS, "illegal", "cost", "audit", "repaired_sha256")

    def __init__(self):
        self.least = self.most = self.last = None
        self.turns = self.illegal = self.cost = 0
        self.faults = [0, 0, 0]
        self.before = None
        self.audit, self.digest, self.any = bytearray(), hashlib.sha256(), False

    def row(self, turn, initial: str, fault: int) -> None:
        if turn is not None and (self.last is None or turn != self.last):
            self.least = turn if self.least is None else self.least
            self.most = self.last = turn
            self.turns += 1
        if fault:
            self.faults[fault - 1] += 1
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial

    def edit(self, letter: str, role, text, fault: int) -> None:
        self.audit += letter.encode()
        self.cost += {"D": 3, "I": 2, "K": 0, "R": 2}[letter] + (letter in "KR" and fault == 3)
        if letter != "D":
            self.digest.update(("\n" * self.any + f"{role}:{text}").encode())
            self.any = True

    def finish(self) -> list[tuple]:
        gaps = 0 if self.least is None else min(self.most - self.least + 1 - self.turns, _MAX)
        return [(gaps, *self.faults, self.illegal, self.cost, self.audit.decode(), self.digest.hexdigest())]


class _Turns:
    """The repaired turns of one conversation, and what was done to each."""

    names = ("position", "turn", "edit", "role", "text")

    def __init__(self):
        self.n, self.turn = 0, None

    def row(self, turn, initial: str, fault: int) -> None:
        self.turn = turn

    def edit(self, letter: str, role, text, fault: int) -> tuple | None:
        if letter == "D":
            return None
        self.n += 1
        return self.n - 1, None if letter == "I" else self.turn, letter, role, text

    def finish(self) -> list[tuple]:
        return []


def _forward(make: Callable, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv = fold = conv_type = None
        state, out = 0, []

        def edit(letter, role, text, fault=0):
            if (made := fold.edit(letter, role, text, fault)) is not None:
                out.append((conv, *made))

        def inserts_until(state: int, moves: int | None) -> int:
            while (_END[state] if moves is None else LETTERS[moves >> 2 * state & 3] == "I"):
                edit("I", _ROLE[state], "")
                state = _DUE[state]
            return state

        def finish():
            if fold is not None:
                inserts_until(state, None)
                out.extend((conv, *made) for made in fold.finish())

        def table():
            rows = list(zip(*out, strict=True)) if out else [[] for _ in range(len(schema) + 1)]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(rows[0], conv_type), *(pa.array(x, f.type) for x, f in zip(rows[1:], schema, strict=True))],
                                              names=["conv", *schema.names])

        for batch in batches:
            conv_type = batch.column("conv").type
            columns = (batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "kind", "fault", "present", "moves"))
            for key, turn, role, text, kind, fault, present, moves in zip(*columns, strict=True):
                if fold is None or key != conv:
                    finish()
                    conv, fold, state = key, make(), 0
                if not present:
                    continue
                fold.row(turn, role[:1], fault)
                state = inserts_until(state, moves)
                letter = LETTERS[moves >> 2 * state & 3]
                if letter == "D":
                    edit("D", role, text)
                elif letter == "K":
                    edit("K", role, text, fault)
                    state = _KEEP[state][kind & 3]
                else:
                    edit("R", _ROLE[state], text, fault)
                    state = _DUE[state]
            if len(out) > 10_000:
                yield table()
        finish()
        if out:
            yield table()
    return run


def _walked(turns: DataFrame, make: Callable, fields: list, conv_col: str, turn_col: str, role_col: str, text_col: str,
            present_col: str | None) -> DataFrame:
    kind = dict(turns.dtypes)[conv_col]
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
                        (F.coalesce(F.col(present_col), F.lit(False)) if present_col else F.lit(True)).alias("present"))
    same = Window.partitionBy("conv", "present", F.xxhash64("role", "text"), "role", "text").orderBy(F.col("turn").asc_nulls_first())
    rows = rows.repartition("conv").withColumn("place", F.row_number().over(same))
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = (F.when(last == "", 1).when(F.col("place") > 1, 2).when(~last.isin(".", "!", "?"), 3).otherwise(0))
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(_OTHER)
    rows = rows.withColumn("fault", fault).withColumn(
        "kind", initial + F.when(F.col("fault").isin(1, 2), _MUST_GO).when(F.col("fault") == 3, _CUT).otherwise(0))
    order = ["turn", "role", "text", "place"]
    back = rows.sortWithinPartitions("conv", F.col("turn").desc_nulls_last(), *(F.desc(c) for c in order[1:]))
    columns = ", ".join(f"{c} {t}" for c, t in back.dtypes)
    marked = back.mapInArrow(_backward, f"{columns}, moves smallint")
    ahead = marked.sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), *order[1:])
    schema = pa.schema([(n, {"bigint": pa.int64(), "string": pa.string()}[t]) for n, t in fields])
    out = ahead.mapInArrow(_forward(make, schema), f"conv {kind}, " + ", ".join(f"{n} {t}" for n, t in fields))
    return out.withColumnRenamed("conv", conv_col)


def repair_report(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                  present_col: str | None = None) -> DataFrame:
    """One row per conversation: ``<conv_col>``, ``gaps``, ``blank``,
    ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit`` and
    ``repaired_sha256``.  Rows whose ``present_col`` is not true only name
    their conversation."""
    fields = [(n, "string" if n in ("audit", "repaired_sha256") else "bigint") for n in _Report.names]
    return _walked(turns, _Report, fields, conv_col, turn_col, role_col, text_col, present_col)


def repaired_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                   present_col: str | None = None) -> DataFrame:
    """The repaired turns: ``<conv_col>``, ``position`` (from 0), ``turn``
    (null: inserted), ``edit`` (I, K or R), ``role`` and ``text``."""
    fields = [(n, "string" if n in ("edit", "role", "text") else "bigint") for n in _Turns.names]
    return _walked(turns, _Turns, fields, conv_col, turn_col, role_col, text_col, present_col)


def _option(cost: str, letter: str, state: str, made: str) -> str:
    return f"{{'c': {cost} + {state}.c, 'a': '{letter}' || {state}.a, 'r': {made} || {state}.r}}"


def oracle() -> str:
    """The same by a recursive query that carries whole audits and repaired
    rows per state and takes the least of them."""
    none = "CAST([] AS VARCHAR[])"
    row, relaxed = [], []
    for state in range(4):
        options = [_option("3", "D", f"f[{state + 1}]", none)]
        for number, initial in enumerate("sua"):
            if number in _KEEP[state]:
                allowed = f"CASE WHEN fault IN (0, 3) AND left(role, 1) = '{initial}' THEN CAST(fault = 3 AS BIGINT) ELSE 1000000000 END"
                options.append(_option(allowed, "K", f"f[{_KEEP[state][number] + 1}]", "[role || ':' || text]"))
        allowed = "CASE WHEN fault IN (0, 3) THEN 2 + CAST(fault = 3 AS BIGINT) ELSE 1000000000 END"
        options.append(_option(allowed, "R", f"f[{_DUE[state] + 1}]", f"['{_ROLE[state]}:' || text]"))
        row.append(f"list_sort([{', '.join(options)}])[1]")
        one = _DUE[state]
        relaxed.append("list_sort([" + ", ".join([
            f"g[{state + 1}]", _option("2", "I", f"g[{one + 1}]", f"['{_ROLE[state]}:']"),
            _option("4", "II", f"g[{_DUE[one] + 1}]", f"['{_ROLE[state]}:', '{_ROLE[one]}:']")]) + "])[1]")
    start = ", ".join(f"{{'c': CAST({c} AS BIGINT), 'a': '{a}', 'r': {r}}}" for c, a, r in (
        (0, "", none), (4, "II", "['user:', 'assistant:']"), (2, "I", "['assistant:']"), (0, "", none)))
    return rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations),
way AS (
  SELECT * EXCLUDE key, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(key, ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, b: list_reduce(list_concat([xor(crc, b)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS way
  FROM keyed),
kept AS (
  SELECT conv_id, turn, CASE way WHEN 4 THEN 'user' ELSE role END AS role,
         CASE way WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE way WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM way WHERE way <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS spot,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
         right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) AS ending
  FROM kept),
faulty AS (
  SELECT conv_id, turn, role, text, spot, row_number() OVER (PARTITION BY conv_id ORDER BY spot DESC) AS k,
         CASE WHEN ending = '' THEN 1 WHEN seen > 1 THEN 2 WHEN ending NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY spot) || left(role, 1) AS pair
  FROM placed),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id),
walk AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS k, [{start}] AS f FROM conversations
  UNION ALL
  SELECT conv_id, k, [{', '.join(relaxed)}] AS f
  FROM (SELECT walk.conv_id, walk.k + 1 AS k, [{', '.join(row)}] AS g
        FROM walk JOIN faulty ON walk.conv_id IS NOT DISTINCT FROM faulty.conv_id AND faulty.k = walk.k + 1)),
convs AS (SELECT DISTINCT conv_id FROM conversations)
SELECT convs.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, f[1].c AS cost, f[1].a AS audit,
       sha256(coalesce(array_to_string(f[1].r, chr(10)), '')) AS repaired_sha256
FROM convs LEFT JOIN counted ON convs.conv_id IS NOT DISTINCT FROM counted.conv_id
JOIN walk ON convs.conv_id IS NOT DISTINCT FROM walk.conv_id AND walk.k = coalesce(n, 0)
"""
