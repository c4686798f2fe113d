"""Repair of conversation structure: a generalised LR parse over the roles, with weighted edits.

Grammar of the role initials: nothing, or an optional `s` and one or more pairs `ua`. Its stacks have four
tops; the graph-structured stack keeps, for each top, the cheapest edits that lead to it, equal tops merged
by the least (cost, audit). Rows are sorted over the cluster and cut into segments of bounded size. A
conversation of one segment is parsed at once; the segments of longer ones are parsed from every top, and
put together in a tree, so no task meets all rows of a long conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.session import shared_table

_BLANK = " \t\n\x0b\x0c\r"
_START, _SYSTEM, _USER, _PAIRS = range(4)
#: Stack tops after a role is shifted; an assistant's completes a pair, which is reduced at once.
_MOVES = {(_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER, (_PAIRS, "u"): _USER, (_USER, "a"): _PAIRS}
_ACCEPTED = (_START, _PAIRS)
#: The one role that can be put in at each top.
_PUT = {_START: "user", _SYSTEM: "user", _PAIRS: "user", _USER: "assistant"}
_LEGAL = ("su", "ua", "au")

Stack = dict[int, tuple[int, str]]


@dataclass(frozen=True)
class RepairParams:
    """Costs of the edits, and of a truncated row that stays; bounds of a segment; children of a tree node."""

    rerole: int = 2
    delete: int = 3
    insert: int = 2
    truncated: int = 1
    segment_rows: int = 256
    segment_chars: int = 4_000_000
    children: int = 64


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults put in by crc32 of `conv_id:turn` modulo 20.

    0 drops the row, 1 empties its text, 2 removes the marks . ! ? from it, 3 repeats the row, 4 makes it
    the user's. A null counts as one blank in the key, as role and as text.
    """
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    rows = rows.withColumns({x: F.coalesce(x, F.lit(" ")) for x in ("role", "text")})
    names = [F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("conv_id", "turn")]
    rows = rows.withColumn("code", F.crc32(F.concat_ws(":", *names).cast("binary")) % 20).where("code <> 0")
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("code") == 3, 2).otherwise(1)))
    rows = rows.select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies)
    return rows.drop("col")


def _better(stack: Stack, top: int, cost: int, audit: str) -> bool:
    if top in stack and stack[top] <= (cost, audit):
        return False
    stack[top] = (cost, audit)
    return True


def _with_inserts(stack: Stack, params: RepairParams) -> Stack:
    """The stack after any number of inserts."""
    stack, queue = dict(stack), list(stack)
    while queue:
        top = queue.pop()
        cost, audit = stack[top]
        onward = _MOVES[top, _PUT[top][0]]
        if _better(stack, onward, cost + params.insert, audit + "I"):
            queue.append(onward)
    return stack


def _shift(stack: Stack, initial: str, fault: str | None, params: RepairParams) -> Stack:
    """The stack after one row: inserts before it, then every edit of it; equal tops merge by (cost, audit)."""
    out: Stack = {}
    gone = fault in ("blank", "duplicate")
    stays = params.truncated if fault == "truncated" else 0
    for top, (cost, audit) in _with_inserts(stack, params).items():
        _better(out, top, cost + params.delete, audit + "D")
        if not gone:
            if (top, initial) in _MOVES:
                _better(out, _MOVES[top, initial], cost + stays, audit + "K")
            _better(out, _MOVES[top, _PUT[top][0]], cost + params.rerole + stays, audit + "R")
    return out


def _accept(stack: Stack, params: RepairParams) -> tuple[int, str]:
    return min(x for top, x in _with_inserts(stack, params).items() if top in _ACCEPTED)


def _replay(audit: str, top: int, roles: list[str], texts: list[str]) -> Iterator[tuple[str, str]]:
    """Role and text of the rows that the edits leave."""
    at = 0
    for edit in audit:
        if edit == "I":
            yield _PUT[top], ""
            top = _MOVES[top, _PUT[top][0]]
            continue
        if edit == "K":
            yield roles[at], texts[at]
            top = _MOVES[top, roles[at][:1]]
        elif edit == "R":
            yield _PUT[top], texts[at]
            top = _MOVES[top, _PUT[top][0]]
        at += 1


def _digest(role: str, text: str) -> bytes:
    role_bytes = role.encode()
    return hashlib.sha256(len(role_bytes).to_bytes(8, "little") + role_bytes + text.encode()).digest()


def _faults(roles: list[str], texts: list[str], seen: Iterable[bytes]) -> list[str | None]:
    """First fault of every row; `seen`: digests of role and text in earlier segments."""
    known, out = set(seen), []
    for role, text in zip(roles, texts, strict=True):
        plain = text.rstrip(_BLANK)
        if not plain:
            out.append("blank")
            continue
        digest = _digest(role, text)
        out.append("duplicate" if digest in known else None if plain[-1] in ".!?" else "truncated")
        known.add(digest)
    return out


_SEGMENTS = "conv_id long, seg long, whole boolean, turns array<long>, roles array<string>, texts array<string>"


def segments(rows: DataFrame, params: RepairParams) -> DataFrame:
    """Rows (conv_id, turn, role, text) in order, cut into segments; `whole`: it is all of its conversation.

    The range sort splits long conversations too. Rows of one turn go by a hash of role and text.
    """
    spot = F.xxhash64("role", "text")
    keyed = rows.select("conv_id", "turn", spot.alias("spot"), F.monotonically_increasing_id().alias("row"), "role", "text")
    keyed = keyed.repartitionByRange("conv_id", "turn", "spot", "row").sortWithinPartitions("conv_id", "turn", "spot", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        names = [x.split()[0] for x in _SEGMENTS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string())]
        # The first and last conversation of a partition may go on in another one.
        held: list[tuple] = []
        part, size, opened, edge, held_chars = [], 0, True, True, 0

        def close(last: bool) -> None:
            nonlocal number
            turns, roles, texts = ([x[k] for x in part] for k in (1, 2, 3))
            held.append((part[0][0], number, opened and last and not edge, turns, roles, texts))
            number += 1

        def batch_of() -> pa.RecordBatch:
            out = pa.record_batch([pa.array([x[k] for x in held], kinds[k]) for k in range(6)], names)
            held.clear()
            return out

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if part and row[0] != part[0][0]:
                    close(True)
                    part, size, opened, edge = [], 0, True, False
                elif part and (len(part) >= params.segment_rows or size + len(row[3]) > params.segment_chars):
                    close(False)
                    part, size, opened = [], 0, False
                part.append(row)
                size += len(row[3])
                held_chars += len(row[3])
                if held and held_chars > params.segment_chars:
                    held_chars = 0
                    yield batch_of()
        if part:
            edge = True
            close(True)
        if held:
            yield batch_of()

    return keyed.select("conv_id", "turn", "role", "text").mapInArrow(run, _SEGMENTS)


_COUNTS = "blank long, duplicate long, truncated long, illegal long, least long, most long, turns long"
_SUMMARY = f"{_COUNTS}, first string, last string, paths array<struct<a:int,b:int,cost:long,audit:string,via:array<int>>>"


def _counts(turns: list[int | None], roles: list[str], faults: list[str | None]) -> dict:
    known = [x for x in turns if x is not None]
    initials = [x[:1] for x in roles]
    return {
        **{x: faults.count(x) for x in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in _LEGAL for a, b in zip(initials[:-1], initials[1:], strict=True)),
        "least": min(known, default=None),
        "most": max(known, default=None),
        "turns": len(set(known)),
        "first": initials[0],
        "last": initials[-1],
    }


def _parse(roles: list[str], faults: list[str | None], top: int, params: RepairParams) -> Stack:
    stack: Stack = {top: (0, "")}
    for role, fault in zip(roles, faults, strict=True):
        stack = _shift(stack, role[:1], fault, params)
    return stack


_RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _result(x: dict, cost: int, audit: str) -> dict:
    gaps = 0 if x["least"] is None else x["most"] - x["least"] + 1 - x["turns"]
    return {"conv_id": x["conv_id"], "gaps": gaps, **{k: x[k] for k in ("blank", "duplicate", "truncated", "illegal")}, "cost": cost, "audit": audit}


def _schema(text: str) -> pa.Schema:
    """The Arrow schema of a Spark schema text."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(text))


def _whole(parts: DataFrame, params: RepairParams) -> DataFrame:
    """Result rows and texts' hashes of conversations of one segment."""
    kinds = _schema(f"{_RESULT}, repaired_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.to_pylist():
                faults = _faults(x["roles"], x["texts"], ())
                cost, audit = _accept(_parse(x["roles"], faults, _START, params), params)
                lines = (f"{role}:{text}" for role, text in _replay(audit, _START, x["roles"], x["texts"]))
                found = {"conv_id": x["conv_id"], **_counts(x["turns"], x["roles"], faults)}
                out.append({**_result(found, cost, audit), "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()})
            yield pa.RecordBatch.from_pylist(out, kinds)

    return parts.mapInArrow(run, f"{_RESULT}, repaired_sha256 string")


def _match(left: DataFrame, right: DataFrame, *others: str, how: str = "inner") -> DataFrame:
    """Join on conv_id, where null meets null, and on other columns."""
    right = right.withColumnsRenamed({x: f"other_{x}" for x in ("conv_id", *others)})
    condition = F.col("conv_id").eqNullSafe(F.col("other_conv_id"))
    for x in others:
        condition &= F.col(x) == F.col(f"other_{x}")
    return left.join(right, condition, how).drop("other_conv_id", *(f"other_{x}" for x in others))


def _earlier(parts: DataFrame) -> DataFrame:
    """conv_id, seg, seen: digests of its rows that occur in an earlier segment of the conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                found = {_digest(r, t) for r, t in zip(x["roles"], x["texts"], strict=True) if t.strip(_BLANK)}
                yield pa.record_batch(
                    [pa.array([x["conv_id"]] * len(found), pa.int64()), pa.array([x["seg"]] * len(found), pa.int64()), pa.array(list(found), pa.binary())],
                    ["conv_id", "seg", "digest"],
                )

    digests = parts.select("conv_id", "seg", "roles", "texts").mapInArrow(run, "conv_id long, seg long, digest binary")
    digests = shared_table(digests, "digests")
    firsts = digests.groupBy("conv_id", "digest").agg(F.min("seg").alias("first_seg"))
    later = _match(digests, firsts, "digest").where("seg > first_seg")
    return later.groupBy("conv_id", "seg").agg(F.collect_list("digest").alias("seen"))


def _summaries(parts: DataFrame, params: RepairParams) -> DataFrame:
    """conv_id, seg and the summary of every segment: its counts, and the cheapest edits from each top to each."""
    kinds = _schema(f"conv_id long, seg long, {_SUMMARY}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                faults = _faults(x["roles"], x["texts"], x["seen"] or ())
                paths = [
                    {"a": a, "b": b, "cost": cost, "audit": audit, "via": []}
                    for a in range(4)
                    for b, (cost, audit) in _parse(x["roles"], faults, a, params).items()
                ]
                out = {"conv_id": x["conv_id"], "seg": x["seg"], **_counts(x["turns"], x["roles"], faults), "paths": paths}
                yield pa.RecordBatch.from_pylist([out], kinds)

    return _match(parts, _earlier(parts), "seg", how="left").mapInArrow(run, f"conv_id long, seg long, {_SUMMARY}")


def _joined(rows: list[dict]) -> dict:
    """One summary of consecutive ones; `via` holds the tops between them."""
    out = {**rows[0], "paths": []}
    for before, x in zip(rows[:-1], rows[1:], strict=True):
        for k in ("blank", "duplicate", "truncated"):
            out[k] += x[k]
        out["illegal"] += x["illegal"] + (before["last"] + x["first"] not in _LEGAL)
        # Turns rise, so two neighbours share one at most.
        out["turns"] += x["turns"] - (x["least"] is not None and out["most"] == x["least"])
        out["least"] = x["least"] if out["least"] is None else out["least"]
        out["most"] = out["most"] if x["most"] is None else x["most"]
        out["last"] = x["last"]
    for a in range(4):
        stack = {a: (0, "", ())}
        for x in rows:
            onward: dict[int, tuple] = {}
            for path in x["paths"]:
                if path["a"] in stack:
                    cost, audit, via = stack[path["a"]]
                    found = (cost + path["cost"], audit + path["audit"], (*via, path["b"]))
                    if path["b"] not in onward or found[:2] < onward[path["b"]][:2]:
                        onward[path["b"]] = found
            stack = onward
        out["paths"] += [{"a": a, "b": b, "cost": c, "audit": s, "via": list(v[:-1])} for b, (c, s, v) in stack.items()]
    return out


def _put_together(level: DataFrame, params: RepairParams) -> DataFrame:
    """The next level of the tree: every `children` consecutive nodes of a conversation become one."""
    kinds = _schema(f"conv_id long, place long, {_SUMMARY}")

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda x: x["place"])
        out = _joined(rows)
        out["place"] = rows[0]["place"] // params.children
        return pa.Table.from_pylist([{k: out[k] for k in kinds.names}], kinds)

    grouped = level.withColumn("node", F.floor(F.col("place") / params.children)).groupBy("conv_id", "node")
    return grouped.applyInArrow(run, f"conv_id long, place long, {_SUMMARY}")


def _rooted(level: DataFrame, params: RepairParams) -> DataFrame:
    """Result rows of the roots, with the top the last segment ends at and the inserts after it."""
    schema = f"{_RESULT}, place long, a int, b int, tail string"
    kinds = _schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.to_pylist():
                ends = {p["b"]: (p["cost"], p["audit"]) for p in x["paths"] if p["a"] == _START}
                cost, audit = _accept(ends, params)
                # Edits tell the tops they pass, so the end is the one whose edits begin the audit.
                b = next(b for b, (_, s) in ends.items() if audit.startswith(s) and set(audit[len(s) :]) <= {"I"} and _accept({b: ends[b]}, params) == (cost, audit))
                out.append({**_result(x, cost, audit), "place": x["place"], "a": _START, "b": b, "tail": audit[len(ends[b][1]) :]})
            yield pa.RecordBatch.from_pylist(out, kinds)

    return level.mapInArrow(run, schema)


def _below(chosen: DataFrame, level: DataFrame, params: RepairParams) -> DataFrame:
    """conv_id, place, a, b, tail of the children of chosen nodes."""
    nodes = level.select("conv_id", "place", F.explode("paths").alias("p")).select("conv_id", "place", "p.a", "p.b", "p.via")
    picked = _match(chosen, nodes, "place", "a", "b")
    tops = F.concat(F.array("a"), "via", F.array("b"))
    pairs = F.transform(F.sequence(F.lit(0), F.size("via")), lambda i: F.struct(i.alias("i"), F.get(tops, i).alias("a"), F.get(tops, i + 1).alias("b")))
    out = picked.select("conv_id", "place", "tail", F.size("via").alias("last"), F.explode(pairs).alias("x"))
    return out.select(
        "conv_id",
        (F.col("place") * params.children + F.col("x.i")).alias("place"),
        "x.a",
        "x.b",
        F.when(F.col("x.i") == F.col("last"), F.col("tail")).otherwise("").alias("tail"),
    )


def _edited(parts: DataFrame, summaries: DataFrame, chosen: DataFrame) -> DataFrame:
    """conv_id, seg, lines: the repaired rows of every segment, joined by newlines (null if there are none)."""
    schema = "conv_id long, seg long, lines string"
    kinds = _schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                lines = [f"{role}:{text}" for role, text in _replay(x["audit"] + x["tail"], x["a"], x["roles"], x["texts"])]
                yield pa.RecordBatch.from_pylist([{"conv_id": x["conv_id"], "seg": x["seg"], "lines": "\n".join(lines) if lines else None}], kinds)

    paths = summaries.select("conv_id", "seg", "place", F.explode("paths").alias("p")).select("conv_id", "seg", "place", "p.a", "p.b", "p.audit")
    picked = _match(paths, chosen, "place", "a", "b").select("conv_id", "seg", "a", "audit", "tail")
    return _match(parts, picked, "seg").mapInArrow(run, schema)


def _hashed(lines: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: segments go through the hash one after the other, never held together."""
    schema = "conv_id long, repaired_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, current, empty = None, None, True

        def done() -> pa.RecordBatch:
            return pa.record_batch([pa.array([current], pa.int64()), pa.array([state.hexdigest()])], ["conv_id", "repaired_sha256"])

        for batch in batches:
            for conv, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if state is not None and conv != current:
                    yield done()
                    state = None
                if state is None:
                    state, current, empty = hashlib.sha256(), conv, True
                if text is not None:
                    state.update((b"" if empty else b"\n") + text.encode())
                    empty = False
        if state is not None:
            yield done()

    return lines.repartition("conv_id").sortWithinPartitions("conv_id", "seg").select("conv_id", "lines").mapInArrow(run, schema)


def repair(rows: DataFrame, params: RepairParams = RepairParams()) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation in `rows`.

    `rows` (conv_id, turn, role, text; role and text not null) count in the order of their turns, nulls
    first; rows of one turn by a hash of role and text, equal ones side by side. The first fault of a row
    counts: blank text, role and text of an earlier row, or a last character that ends no sentence.
    Blank and duplicate rows go; other edits are chosen for the least cost, then the first audit in
    ASCII order. The hash is of the repaired `role:text` lines: it takes a conversation's segments one
    after the other in one task, as it must. Other columns are ignored. An empty table gives no rows;
    a null conv_id is a conversation of its own.
    """
    cut = shared_table(segments(rows, params), "segments")
    parts = cut.where("NOT whole")
    results = _whole(cut.where("whole"), params)
    found = shared_table(_summaries(parts, params), "summaries")
    places = found.select("conv_id", "seg").withColumn(
        "place", (F.expr("row_number() OVER (PARTITION BY conv_id ORDER BY seg)") - 1).cast("long")
    )
    numbered = shared_table(_match(found, places, "seg"), "numbered")
    most = numbered.agg(F.max("place").alias("most")).first()["most"]
    if most is None:
        return results
    levels = [numbered.select("conv_id", "place", *[x.split()[0] for x in _SUMMARY.split(", ")[:9]], "paths")]
    while most:
        levels.append(shared_table(_put_together(levels[-1], params), "level"))
        most //= params.children
    roots = shared_table(_rooted(levels[-1], params), "roots")
    chosen = roots.select("conv_id", "place", "a", "b", "tail")
    for level in levels[:0:-1]:
        chosen = shared_table(_below(chosen, level, params), "chosen")
    hashes = _hashed(_edited(parts, numbered, chosen))
    names = [x.split()[0] for x in _RESULT.split(", ")]
    return results.unionByName(_match(roots.select(*names), hashes))


def repair_damaged(conversations: DataFrame, params: RepairParams = RepairParams()) -> DataFrame:
    """`repair` of the damaged table, with a row for every conv_id of the given one.

    Where the damage leaves no row: zeros, an empty audit and the hash of the empty text.
    """
    found = repair(damage(conversations), params)
    every = conversations.select(F.col("conv_id").cast("long")).distinct()
    joined = _match(every, found, how="left")
    zeros = {x: F.coalesce(x, F.lit(0).cast("long")) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    empty = {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256))}
    return joined.withColumns(zeros | empty)
