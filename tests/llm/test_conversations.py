"""Repair of conversations against a search over all edits."""

import hashlib
import random
import re
import zlib

import pytest

from clickloom.llm import conversations, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, seg long, place long, cost int"
GRAMMAR, BEGUN = re.compile(r"(s?(ua)+)?"), re.compile(r"(s?(ua)*u?)?")


def brute(rows):
    """The result of one conversation's rows (turn, role, text): all edits whose cost can still win, as strings."""
    faults, seen = [], set()
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else None if solid[-1] in ".!?" else "truncated"
        faults.append(fault)
        seen.add((role, text))
    states = [("", 0, "", ())]
    for i in range(len(rows) + 1):
        grown = layer = states
        for _ in range(2):
            layer = [(s + r[0], c + 2, a + "I", x + ((r, ""),)) for s, c, a, x in layer for r in ("user", "assistant") if BEGUN.fullmatch(s + r[0])]
            grown = grown + layer
        if i == len(rows):
            break
        (_, role, text), states = rows[i], []
        for s, c, a, x in grown:
            states.append((s, c + 3, a + "D", x))
            if faults[i] in ("blank", "duplicate"):
                continue
            more = faults[i] == "truncated"
            if role[:1] and BEGUN.fullmatch(s + role[:1]):
                states.append((s + role[:1], c + more, a + "K", x + ((role, text),)))
            states += [(s + r[0], c + 2 + more, a + "R", x + ((r, text),)) for r in ("user", "assistant") if BEGUN.fullmatch(s + r[0])]
        # Any stack can be completed for 4 more than the best one, at most.
        least = min(x[1] for x in states)
        states = [x for x in states if x[1] <= least + 7]
    _, cost, audit, lines = min((x for x in grown if GRAMMAR.fullmatch(x[0])), key=lambda x: (x[1], x[2]))
    turns, initials = [x[0] for x in rows if x[0] is not None], [x[1][:1] for x in rows]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials[:-1], initials[1:], strict=True))
    counts = [faults.count(x) for x in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{x}" for r, x in lines).encode()).hexdigest())


def brute_all(table):
    found = {}
    for conv, turn, role, text in table:
        rows = found.setdefault(conv, [])
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        if code:
            rows += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return {k: brute(sorted(v, key=lambda x: (x[0] is not None, x[0] or 0))) for k, v in found.items()}


def results(frame, params=conversations.RepairParams()):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = conversations.repair_damaged(frame, params).collect()
    assert len({x.conv_id for x in rows}) == len(rows)
    return {x.conv_id: tuple(x[k] for k in names) for x in rows}


def made(n):
    """Conversations with nulls, odd roles, blank, repeated and cut texts, some of them empty after the damage."""
    rng = random.Random(n)
    table = []
    for conv in [None, *range(n)]:
        turns = sorted(rng.sample(range(9), rng.randint(0, 6)))
        if turns and rng.random() < 0.2:
            turns[0] = None
        roles, texts = ["user", "assistant", "system", "user", "assistant", None, "", "tool"], ["Hi.", "ok", "", "a b!", " \t", "Yes?\n", None, "no"]
        table += [(conv, t, rng.choice(roles), rng.choice(texts)) for t in turns]
    return table


# Whole conversations, and such as are cut into segments of one or two rows and put together in a tree.
@pytest.mark.parametrize("params", [{}, {"segment_rows": 2, "children": 2}, {"segment_rows": 1, "children": 3}, {"segment_chars": 0, "children": 2}])
def test_all_edits(spark, params):
    table = made(150)
    frame = spark.createDataFrame([(*x, 1, 2, 3) for x in table], SCHEMA).repartition(5)
    assert results(frame, conversations.RepairParams(**params)) == brute_all(table)


def test_query(spark):
    table = [tuple(x) for x in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    got = {x.conv_id: tuple(x[k] for k in names) for x in queries.op13_conversation_repair(spark, SF).collect()}
    assert got == brute_all(table)


def test_one_conversation_over_many_segments_and_partitions(spark):
    rng = random.Random(1)
    table = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["Hi.", f"text {t}.", f"cut {t}"])) for t in range(600)]
    frame = spark.createDataFrame([(*x, 1, 2, 3) for x in table], SCHEMA).repartition(6)
    whole = results(frame, conversations.RepairParams(segment_rows=10_000))
    for rows, children in ((16, 4), (7, 3), (100, 64)):
        assert results(frame, conversations.RepairParams(segment_rows=rows, children=children)) == whole


def test_rows_that_repeat_and_empty_tables(spark):
    # Equal rows of one turn stand side by side; the later ones are duplicates.
    table = [(1, 1, "user", "Hi.")] * 3 + [(1, 2, "assistant", "Yes.")]
    frame = spark.createDataFrame([(*x, 1, 2, 3) for x in table], SCHEMA)
    assert results(frame) == brute_all(table)
    assert conversations.repair_damaged(frame.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, None, None, None, 1, 2, 3)] * 2, SCHEMA)
    assert results(nulls) == brute_all([(None, None, None, None)] * 2)
