"""Conversation structure repair: exhaustive search and edge cases."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from quire.llm import conversation_repair as C

SCHEMA = "conv_id bigint, turn bigint, role string, text string, kind int, conv string, moves int"
GRAMMAR = re.compile("(s?(ua)+)?")


def frame(spark, rows):
    """Turns with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(*r, 1, "x", None) for r in rows], SCHEMA)


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append(1 if not solid else 2 if (role, text) in seen else 3 if solid[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def ordered(rows):
    return sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def exhaustive(rows):
    """The cheapest, then least audit among all edits with up to two inserts in a row."""
    rows = ordered(rows)
    wrong = faults(rows)
    inserts = [x for n in range(3) for x in itertools.product(("user", "assistant"), repeat=n)]
    best = None
    for kinds in itertools.product(("D", "K", "user", "assistant"), repeat=len(rows)):
        if any(k != "D" and w in (1, 2) for k, w in zip(kinds, wrong, strict=True)):
            continue
        for gaps in itertools.product(inserts, repeat=len(rows) + 1):
            cost, audit, made = 0, "", []
            for n in range(len(rows) + 1):
                made += [(role, "") for role in gaps[n]]
                audit, cost = audit + "I" * len(gaps[n]), cost + 2 * len(gaps[n])
                if n < len(rows):
                    kind, (_, role, text) = kinds[n], rows[n]
                    cost += {"D": 3, "K": 0}.get(kind, 2) + (kind != "D" and wrong[n] == 3)
                    audit += kind if kind in "DK" else "R"
                    made += [] if kind == "D" else [(role if kind == "K" else kind, text)]
            if all(r for r, _ in made) and GRAMMAR.fullmatch("".join(r[0] for r, _ in made)):
                best = min(filter(None, [best, (cost, audit, made)]), key=lambda b: b[:2])
    cost, audit, made = best
    turns = [t for t, _, _ in rows if t is not None]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(wrong.count(k) for k in (1, 2, 3)),
            sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(rows)), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest())


def random_rows(rng, n):
    return [(rng.choice([None, *range(5)]), rng.choice(["user", "assistant", "system", "tool", None, ""]),
             rng.choice(["Yes.", "No", "ok? ", "", None, " \n"])) for _ in range(n)]


@pytest.mark.parametrize("batch", [10_000, 2])
def test_repair_equals_exhaustive_search(spark, batch):
    rng = random.Random(5)
    convs = {k: random_rows(rng, k % 4) for k in range(60)}
    convs |= {None: random_rows(rng, 3), 1000: [(0, "system", "Be good."), (1, "user", "Hi."), (2, "assistant", "Yes.")],
              1001: [(2, "user", "same."), (2, "user", "same."), (9, "assistant", "end")]}
    rows = [(k, *r) for k, v in convs.items() for r in v]
    rng.shuffle(rows)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        out = {r[0]: tuple(r[1:]) for r in C.repair_report(frame(spark, rows)).collect()}
        turns = C.repaired_turns(frame(spark, rows)).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert out == {k: exhaustive(v) for k, v in convs.items() if v}
    for k, report in out.items():
        made = sorted((t.position, t.edit, t.role, t.text) for t in turns if t.conv_id == k)
        assert hashlib.sha256("\n".join(f"{t[2]}:{t[3]}" for t in made).encode()).hexdigest() == report[-1]
        assert "".join(t[1] for t in made) == report[-2].replace("D", "")


def test_a_giant_conversation_crosses_batches(spark):
    """Whole strings carried forward, per state, against the streamed backpointers."""
    rng = random.Random(6)
    rows = [(t, rng.choice(["user", "assistant", "user", "assistant", "tool"]), f"{t}{rng.choice('.!? ,')}") for t in range(25_000)]
    [report] = C.repair_report(frame(spark, [(1, *r) for r in rows])).collect()
    wrong, costs, total = faults(rows), C._END, 0
    for (_, role, _), fault in zip(reversed(rows), reversed(wrong), strict=True):
        kind = {"u": 1, "a": 2}.get(role[0], 3) + (4 if fault in (1, 2) else 8 if fault == 3 else 0)
        costs, _ = C.step(costs, kind)
    total = costs[0]
    assert report.cost == total and len(report.audit.replace("I", "")) == len(rows) and report.truncated == wrong.count(3)


def test_damage(spark):
    rows = [(c, t, "assistant", "a. b! c?") for c in (0, 1, None) for t in [None, *range(40)]] + [(5, 0, None, None)]
    out = C.damaged(frame(spark, rows)).collect()
    expected = []
    for c, t, role, text in rows:
        way = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        row = (c, t, "user" if way == 4 else role, {1: "", 2: re.sub("[.!?]", "", text)}.get(way, text), way != 0)
        expected += [row] * (2 if way == 3 else 1)
    assert sorted(map(tuple, out), key=repr) == sorted(expected, key=repr)


def test_conversations_without_rows_and_empty_tables(spark):
    from pyspark.sql import functions as F
    data = frame(spark, [(1, 0, "user", "a" * 500_000), (2, 0, "user", "x.")]).withColumn("present", F.col("conv_id") == 1)
    out = {r.conv_id: r for r in C.repair_report(data, present_col="present").collect()}
    assert tuple(out[2])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert out[1].cost == 3 and out[1].audit == "D"
    assert C.repair_report(frame(spark, []).limit(0)).collect() == []


def test_gaps_beyond_64_bits(spark):
    data = frame(spark, [(1, -2 ** 63, "user", "a."), (1, 2 ** 63 - 1, "assistant", "b.")])
    assert C.repair_report(data).first().gaps == 2 ** 63 - 1
