"""Packing of tokenised documents: best fit, then swap-based local search between underfull bins."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.session import shared_table

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = f"{_PIECES}, sequence_id long, offset long"


@dataclass(frozen=True)
class PackParams:
    """`capacity` tokens a sequence. `ranks`: the vocabulary as a rank file (read by the driver, about
    1 MB, and sent with the job), `pattern`: how it splits text, `added`: tokens found in a text as a
    whole before that, with their ids; `end`: the id that closes a document. About `pieces_at_once`
    pieces are packed together; bins filled below `full` of the capacity are packed again with those
    of other groups. The local search makes at most `moves` changes for each bin it is given.
    """

    ranks: str
    pattern: str
    added: tuple[tuple[str, int], ...] = ()
    capacity: int = 2048
    end: int = 0
    pieces_at_once: int = 20_000
    full: float = 0.995
    moves: int = 60


def default_params() -> PackParams:
    """The 50k byte-level vocabulary: rank file and added tokens give the ids of its JSON file, five times as fast."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        added = tuple((x["content"], x["id"]) for x in json.load(file)["added_tokens"])
    return PackParams(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, added)


def load_encoding(ranks: bytes, params: PackParams):
    """The encoding of a rank file's content."""
    import base64

    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=params.pattern, mergeable_ranks=table, special_tokens=dict(params.added))


def pieces(docs: DataFrame, params: PackParams) -> DataFrame:
    """Documents as ids and an end id, cut only where longer than the capacity; the first piece is the short one."""

    with open(params.ranks, "rb") as file:
        content = file.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(content, params)
        for batch in batches:
            ids_of, texts = batch.column(0), pc.fill_null(batch.column(1), "")
            rows: list[tuple] = []
            where = []
            for i in range(batch.num_rows):
                ids = np.array([*encoding.encode(texts[i].as_py(), allowed_special="all"), params.end], "<u4")
                first = len(ids) % params.capacity or min(len(ids), params.capacity)
                cuts = [0, *range(first, len(ids) + 1, params.capacity)]
                for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    rows.append((k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
                    where.append(i)
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array([x[k] for x in rows], kinds[k]) for k in range(4)]
            yield pa.record_batch([ids_of.take(pa.array(where, pa.int64())), *columns], _PIECES_NAMES)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _PIECES)


_PIECES_NAMES = [x.split()[0] for x in _PIECES.split(", ")]


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest first, each into the fullest bin that still holds it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room r
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[item]
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, at = capacity, len(bins)
            bins.append([])
        bins[at].append(item)
        left = room - n
        by_room[left].append(at)
        rooms |= 1 << left
    return bins


class _OpenBins:
    """Bins by their room, and their items by the space that would be there without them."""

    def __init__(self, bins: list[list[int]], lengths: list[int], capacity: int):
        self.bins, self.lengths, self.capacity = bins, lengths, capacity
        self.fill = [sum(lengths[i] for i in x) for x in bins]
        self.at: dict[int, int] = {}
        self.by_room: list[set[int]] = [set() for _ in range(capacity + 1)]
        self.by_space: list[dict[int, set[int]]] = [{} for _ in range(capacity + 1)]
        self.rooms = self.spaces = 0  # bit n: by_room[n], by_space[n] hold something

    def add(self, b: int) -> None:
        room = self.capacity - self.fill[b]
        self.by_room[room].add(b)
        self.rooms |= 1 << room
        for i in self.bins[b]:
            self.at[i], space = b, room + self.lengths[i]
            self.by_space[space].setdefault(self.lengths[i], set()).add(i)
            self.spaces |= 1 << space

    def take(self, b: int) -> None:
        room = self.capacity - self.fill[b]
        self.by_room[room].discard(b)
        if not self.by_room[room]:
            self.rooms &= ~(1 << room)
        for i in self.bins[b]:
            space, n = room + self.lengths[i], self.lengths[i]
            same = self.by_space[space][n]
            same.discard(i)
            if not same:
                del self.by_space[space][n]
                if not self.by_space[space]:
                    self.spaces &= ~(1 << space)

    def fullest(self, n: int) -> int | None:
        """The fullest bin that holds `n` more."""
        fitting = self.rooms >> n
        return min(self.by_room[n + (fitting & -fitting).bit_length() - 1]) if fitting else None

    def partner(self, n: int, low: int) -> int | None:
        """The shortest item that leaves room for `n` in its bin, which `n` then fills best, if that raises the sum of squares."""
        fitting = self.spaces >> n
        while fitting:
            step = (fitting & -fitting).bit_length() - 1
            small = min(self.by_space[n + step])
            # The bin's fill becomes capacity - step; `low` gives n and gets the item.
            if small < n and self.capacity - step > self.fill[low] - n + small:
                return min(self.by_space[n + step][small])
            fitting &= fitting - 1
        return None


def local_search(bins: list[list[int]], lengths: list[int], capacity: int, moves: int) -> list[list[int]]:
    """Move one document, or exchange one for one or two for one, between underfull bins.

    A change counts if it raises the sum of squared fills, which empties the lesser bin step by step.
    The least filled bin is worked on until nothing helps it; then it is set aside. Every other bin
    that is not full, every document of it and every pair of the bin worked on can take part.
    """
    pool = _OpenBins(bins, lengths, capacity)
    order = sorted((b for b in range(len(bins)) if pool.fill[b] < capacity), key=lambda b: pool.fill[b])
    for b in order:
        pool.add(b)

    def shift(items: tuple[int, ...], source: int, target: int) -> None:
        for i in items:
            bins[source].remove(i)
            bins[target].append(i)
            pool.fill[source] -= lengths[i]
            pool.fill[target] += lengths[i]

    def change(low: int) -> bool:
        items = sorted(bins[low], key=lambda i: (-lengths[i], i))
        for i in items:
            target = pool.fullest(lengths[i])
            if target is not None:
                pool.take(target)
                shift((i,), low, target)
                pool.add(target)
                return True
        groups = {lengths[i]: (i,) for i in reversed(items)}
        for x, i in enumerate(items):
            for j in items[x + 1 :]:
                if lengths[i] + lengths[j] <= capacity:
                    groups.setdefault(lengths[i] + lengths[j], (i, j))
        for n in sorted(groups, reverse=True):
            other = pool.partner(n, low)
            if other is not None:
                target = pool.at[other]
                pool.take(target)
                shift((other,), target, low)
                shift(groups[n], low, target)
                pool.add(target)
                return True
        return False

    budget = moves * len(order)
    for low in order:
        pool.take(low)
        while bins[low] and budget > 0 and change(low):
            budget -= 1
        # Set aside: what it holds now stays, as a bin that nothing else enters.
    return [x for x in bins if x]


def pack(docs: DataFrame, params: PackParams | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: every piece, in as few sequences as found.

    A null or empty text is the end id alone. Every row of the input is packed, repeated ones too;
    a null doc_id stays null. Other columns are ignored; an empty table gives an empty one.
    Groups are dealt by place in the stored pieces, so no key can fill one, and hold about
    `pieces_at_once` in every round. Bins of a group that stay underfull are dealt again to fewer
    groups, until one group holds them all or a round closed the bins of less than half its pieces:
    then another deal would help little, and the round after closes all.
    """
    params = params or default_params()
    stored = shared_table(pieces(docs, params).withColumn("place", F.monotonically_increasing_id()), "pieces")
    whole = stored.where(F.col("length") == params.capacity).select(
        *_PIECES_NAMES, F.col("place").alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = stored.where(F.col("length") < params.capacity)
    n, level, done, last = rest.count(), 0, whole, False
    while True:
        level += 1
        n_groups = max(1, -(-n // params.pieces_at_once))
        last = last or n_groups == 1
        packed = shared_table(_pack_groups(rest, n_groups, level, last, params), "packed")
        done = done.union(packed.where("closed").select(*done.columns))
        if last:
            return done
        rest = packed.where("NOT closed").select(*rest.columns)
        left = rest.count()
        n, last = left, 2 * left > n


def _pack_groups(rest: DataFrame, n_groups: int, level: int, last: bool, params: PackParams) -> DataFrame:
    """Pack each group; `closed` marks the pieces of bins that are full enough (all, in the last round)."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        group, lengths = table.column("group")[0].as_py(), table.column("length").to_pylist()
        bins = local_search(best_fit(lengths, params.capacity), lengths, params.capacity, params.moves)
        sequence, offset, closed = (np.zeros(len(lengths), np.int64) for _ in range(3))
        # Level above, then group, then bin: numbers of whole pieces stay below 2**56.
        base = (level << 56) + (group << 24)
        for b, items in enumerate(bins):
            at = 0
            for i in items:
                sequence[i], offset[i] = base + b, at
                at += lengths[i]
            closed[items] = last or at >= params.full * params.capacity
        table = table.drop_columns(["group"])
        for name, values in (("sequence_id", sequence), ("offset", offset), ("closed", closed.astype(bool))):
            table = table.append_column(name, pa.array(values))
        return table

    group = F.pmod(F.xxhash64("place", F.lit(level)), F.lit(n_groups))
    schema = f"{_PIECES}, place long, sequence_id long, offset long, closed boolean"
    return rest.withColumn("group", group).groupBy("group").applyInArrow(run, schema)
