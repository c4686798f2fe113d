"""Repeated word windows: a count-min prefilter, then exact grouping of the windows it cannot clear.

Documents are packed once into blocks (a stored table). A block sends, for each range of sketch
cells, the cells its windows fall into; the ranges are merged by addition and every block gets back
one bit per cell it sent: counted at least twice or not. Windows with a clear cell occur once. The
others are grouped exactly by a 96-bit fingerprint in the same way: each block sends the first
place of every window, and gets back one bit: seen earlier elsewhere or not. So nothing is
broadcast, every message is bounded by the block, and a window that all documents share is sent
once per block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.hashing import U64, mix, slices, window_firsts, window_hashes, word_hashes, words
from clickloom.session import shared_table

_MESSAGE = "block long, kind int, slice long, payload binary"
_SKETCH, _WINDOWS, _TEXTS = 0, 9, 8
_NONE = np.iinfo(np.int64).max


@dataclass(frozen=True)
class SubstringParams:
    """`rows` count-min rows of `cells_per_window` cells for each window of the corpus.

    `block_chars` bounds the text of a block (one longer document is a block of its own),
    `slice_windows` the windows that meet in one merging task.
    """

    window: int = 20
    rows: int = 2
    cells_per_window: int = 4
    block_chars: int = 12_000_000
    slice_windows: int = 1_500_000


def _pack(values: np.ndarray) -> bytes:
    """Byte planes of an integer array, compressed: small values cost about their entropy."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, -1).T).reshape(-1).view(kind)


def _join(*parts: bytes) -> bytes:
    return b"".join(len(x).to_bytes(4, "little") + x for x in parts)


def _split(data: bytes) -> list[bytes]:
    parts, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 4], "little")
        parts.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    return parts


def blocks(docs: DataFrame, params: SubstringParams) -> DataFrame:
    """block, n_windows, ids, offsets, texts: whole documents packed in the order they are read."""

    def pack(ids: list, raws: list, number: int) -> pa.RecordBatch:
        sizes = np.array([len(x) for x in raws], np.int64)
        raw, offsets = np.frombuffer(b"".join(raws), np.uint8), np.concatenate([[0], np.cumsum(sizes)])
        n = 0
        if len(raw):
            counts = np.diff(words(raw, offsets)[2])
            n = int(np.maximum(counts - params.window + 1, 0).sum())
        known = np.array([x is not None for x in ids])
        values = np.array([x if x is not None else 0 for x in ids], np.int64)
        return pa.record_batch(
            [
                pa.array([number], pa.int64()),
                pa.array([n], pa.int64()),
                pa.array([_join(_pack(values), _pack(known.view(np.uint8)), _pack(sizes))], pa.binary()),
                pa.array([zstandard.ZstdCompressor(level=3).compress(raw.tobytes())], pa.binary()),
            ],
            ["block", "n_windows", "head", "texts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, raws, size = [], [], 0
        for batch in batches:
            column = batch.column(1).cast(pa.binary())
            for row in range(batch.num_rows):
                value = column[row].as_buffer()
                text = value.to_pybytes() if value is not None else b""
                if ids and size + len(text) > params.block_chars:
                    yield pack(ids, raws, number)
                    number, ids, raws, size = number + 1, [], [], 0
                ids.append(batch.column(0)[row].as_py())
                raws.append(text)
                size += len(text)
        if ids:
            yield pack(ids, raws, number)

    return docs.select("doc_id", "text").mapInArrow(run, "block long, n_windows long, head binary, texts binary")


class _Block:
    """One stored block: its documents, words, and the windows that start in it."""

    def __init__(self, head: bytes, texts: bytes, size: int, families: int = 1):
        ids, known, sizes = _split(head)
        self.sizes = _unpack(sizes, np.int64)
        self.known = _unpack(known, np.uint8).astype(bool)
        self.ids = _unpack(ids, np.int64)
        self.order = np.where(self.known, self.ids, _NONE)
        self.raw = zstandard.ZstdDecompressor().decompress(texts) if len(self.sizes) else b""
        column = pa.Array.from_buffers(
            pa.string(), len(self.sizes), [None, pa.py_buffer(_offsets(self.sizes)), pa.py_buffer(self.raw)]
        )
        keys: list[list[np.ndarray]] = [[] for _ in range(families)]
        whole: list[list[np.ndarray]] = [[], []]
        docs, starts, counts = [], [], []
        for first, last, raw, offsets in slices(column):
            begin, end, row_words = words(raw, offsets)
            firsts = window_firsts(row_words, size)
            rows = np.searchsorted(row_words, firsts, "right") - 1
            docs.append(rows + first)
            starts.append(firsts - row_words[rows])
            counts.append(np.diff(row_words))
            for family in range(2):
                hashes = word_hashes(raw, begin, end, family)
                if family < families:
                    keys[family].append(window_hashes(hashes, firsts, size, family))
                sums = np.zeros(last - first, U64)
                full = np.flatnonzero(np.diff(row_words))
                if len(full):
                    within = np.arange(len(hashes)) - np.repeat(row_words[:-1], np.diff(row_words))
                    sums[full] = np.add.reduceat(mix(hashes + within.astype(U64) * U64(0x2545F4914F6CDD1D)), row_words[full])
                whole[family].append(sums)
        self.counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        self.docs = np.concatenate(docs) if docs else np.zeros(0, np.int64)
        self.starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        self.keys = [np.concatenate(x) if x else np.zeros(0, U64) for x in keys]
        self.whole = [np.concatenate(x) if x else np.zeros(0, U64) for x in whole]
        self.size = size

    def firsts(self, keys: list[np.ndarray], order: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of equal keys, the item with the least (order, start); and for each item that one's number."""
        by = np.lexsort((starts, order, keys[1], keys[0]))
        new = np.ones(len(by), bool)
        new[1:] = (keys[0][by][1:] != keys[0][by][:-1]) | (keys[1][by][1:] != keys[1][by][:-1])
        heads = by[new]
        head_of = np.empty(len(by), np.int64)
        head_of[by] = np.cumsum(new) - 1
        return heads, head_of

    def texts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents that have a window; the first of equal ones; and each one's first."""
        rows = np.flatnonzero(self.counts >= self.size)
        heads, head_of = self.firsts([x[rows] for x in self.whole], self.order[rows], rows)
        return rows, heads, head_of


def _offsets(sizes: np.ndarray) -> bytes:
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32).tobytes()


def _cells(keys: np.ndarray, row: int, width: int) -> np.ndarray:
    return (mix(keys + U64(0x9E3779B97F4A7C15 * (row + 1) & 0xFFFFFFFFFFFFFFFF)) % U64(width)).astype(np.int64)


def _key_messages(block: int, kind: int, keys: list[np.ndarray], order: np.ndarray, starts: np.ndarray, n_slices: int) -> tuple[list, np.ndarray]:
    """First places of a block's distinct keys, by range of keys, and the order they are sent in."""
    to = (keys[0] >> U64(33)).astype(np.int64) * n_slices >> 31
    by = np.lexsort((starts, order, to))
    edges = np.searchsorted(to[by], np.arange(n_slices + 1))
    out = []
    for s in np.flatnonzero(np.diff(edges)):
        at = by[edges[s] : edges[s + 1]]
        payload = _join(
            keys[0][at].tobytes(),
            (keys[1][at] >> U64(32)).astype(np.uint32).tobytes(),
            _pack(np.diff(order[at], prepend=0)),
            _pack(starts[at].astype(np.uint32)),
        )
        out.append((block, kind, int(s), payload))
    return out, by


def _rows(out: list) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    columns = [pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)]
    return pa.record_batch(columns, ["block", "kind", "slice", "payload"])


def _merge(messages: DataFrame, slice_width: int) -> DataFrame:
    """One answer for every message: a bit for each cell (counted twice) or key (an earlier place exists)."""

    def cells(payloads: list[bytes]) -> list[bytes]:
        sent = []
        counts = np.zeros(slice_width, np.uint8)
        for payload in payloads:
            gaps, twice = _split(payload)
            at = np.cumsum(_unpack(gaps, np.uint32).astype(np.int64))
            more = np.unpackbits(np.frombuffer(zstandard.ZstdDecompressor().decompress(twice), np.uint8))[: len(at)]
            counts[at] = np.minimum(counts[at] + 1 + more, 2)
            sent.append(at)
        return [np.packbits(counts[at] >= 2).tobytes() for at in sent]

    def keys(payloads: list[bytes], blocks: np.ndarray) -> list[bytes]:
        parts = [_split(x) for x in payloads]
        sizes = [len(x[0]) // 8 for x in parts]
        high = np.concatenate([np.frombuffer(x[0], U64) for x in parts])
        low = np.concatenate([np.frombuffer(x[1], np.uint32) for x in parts])
        order = np.concatenate([np.cumsum(_unpack(x[2], np.int64)) for x in parts])
        starts = np.concatenate([_unpack(x[3], np.uint32) for x in parts])
        # Rows that repeat a doc_id are told apart by their block.
        by = np.lexsort((np.repeat(blocks, sizes), starts, order, low, high))
        later = np.zeros(len(by), bool)
        later[by[1:]] = (high[by][1:] == high[by][:-1]) & (low[by][1:] == low[by][:-1])
        return [np.packbits(x).tobytes() for x in np.split(later, np.cumsum(sizes)[:-1])]

    def run(group: pa.Table) -> pa.Table:
        kind, payloads = group.column("kind")[0].as_py(), group.column("payload").to_pylist()
        blocks = group.column("block").to_numpy()
        bits = keys(payloads, blocks) if kind >= _TEXTS else cells(payloads)
        return group.set_column(group.schema.get_field_index("payload"), "payload", pa.array(bits, pa.binary()))

    return messages.groupBy("kind", "slice").applyInArrow(run, _MESSAGE)


def remove_repeats(docs: DataFrame, params: SubstringParams = SubstringParams()) -> DataFrame:
    """doc_id, n_words, n_removed, kept (text: kept words joined by one space), kept_sha256.

    Words are maximal runs without white space, unchanged. Every word goes that lies in a window of
    `window` words whose sequence also starts earlier: in a document of smaller doc_id (null: last),
    or earlier in the same one; all windows are judged on the input. Rows that repeat a doc_id
    count as separate documents, ordered as they were read. Null and empty texts have no words and
    keep the empty text; shorter texts than a window keep all words. Other columns are ignored.
    """
    size, packed = params.window, shared_table(blocks(docs, params), "blocks")
    total = packed.agg(F.sum("n_windows").alias("n")).first()["n"] or 0
    n_slices = max(1, -(-total // params.slice_windows))
    width = -(-max(total, 1) * params.cells_per_window // n_slices) * n_slices
    slice_width = width // n_slices

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                number = batch.column(0)[i].as_py()
                block = _Block(batch.column(2)[i].as_py(), batch.column(3)[i].as_py(), size)
                for row in range(params.rows):
                    cells, counts = np.unique(_cells(block.keys[0], row, width), return_counts=True)
                    edges = np.searchsorted(cells, np.arange(n_slices + 1) * slice_width)
                    out = []
                    for s in np.flatnonzero(np.diff(edges)):
                        part = slice(edges[s], edges[s + 1])
                        gaps = np.diff(cells[part] - s * slice_width, prepend=0).astype(np.uint32)
                        twice = zstandard.ZstdCompressor(level=1).compress(np.packbits(counts[part] > 1).tobytes())
                        out.append((number, row, int(s), _join(_pack(gaps), twice)))
                    if out:
                        yield _rows(out)
                rows, heads, _ = block.texts()
                if len(rows):
                    at = rows[heads]
                    yield _rows(_key_messages(number, _TEXTS, [x[at] for x in block.whole], block.order[at], at, n_slices)[0])

    def cleared(block: _Block, answers: dict) -> tuple[np.ndarray, np.ndarray]:
        """Whether each window is a candidate, and whether each document repeats an earlier one."""
        candidate = np.ones(len(block.keys[0]), bool)
        for row in range(params.rows):
            cells, back = np.unique(_cells(block.keys[0], row, width), return_inverse=True)
            edges = np.searchsorted(cells, np.arange(n_slices + 1) * slice_width)
            flags = [_bits(answers[row, s], edges[s + 1] - edges[s]) for s in np.flatnonzero(np.diff(edges))]
            if flags:
                candidate &= np.concatenate(flags)[back]
        copy = np.zeros(len(block.counts), bool)
        rows, heads, head_of = block.texts()
        if len(rows):
            at = rows[heads]
            out, by = _key_messages(0, _TEXTS, [x[at] for x in block.whole], block.order[at], at, n_slices)
            later = np.empty(len(at), bool)
            later[by] = np.concatenate([_bits(answers[_TEXTS, s], len(_split(x)[0]) // 8) for _, _, s, x in out])
            own = np.ones(len(rows), bool)
            own[heads] = False
            copy[rows] = later[head_of] | own
        return candidate & ~copy[block.docs], copy

    def candidates(block: _Block, answers: dict):
        candidate, copy = cleared(block, answers)
        at = np.flatnonzero(candidate)
        keys, order, starts = [x[at] for x in block.keys], block.order[block.docs[at]], block.starts[at]
        heads, head_of = block.firsts(keys, order, starts)
        return copy, at, heads, head_of, keys, order, starts

    def second_pass(left: pa.Table, right: pa.Table) -> pa.Table:
        number, answers = left.column("block")[0].as_py(), _answers(right)
        block = _Block(left.column("head")[0].as_py(), left.column("texts")[0].as_py(), size, 2)
        _, at, heads, _, keys, order, starts = candidates(block, answers)
        out, _ = _key_messages(number, _WINDOWS, [x[heads] for x in keys], order[heads], starts[heads], n_slices)
        return pa.Table.from_batches([_rows(out)])

    def third_pass(left: pa.Table, right: pa.Table) -> pa.Table:
        answers = _answers(right)
        block = _Block(left.column("head")[0].as_py(), left.column("texts")[0].as_py(), size, 2)
        copy, at, heads, head_of, keys, order, starts = candidates(block, answers)
        gone = np.zeros(len(block.keys[0]), bool)
        if len(at):
            out, by = _key_messages(0, _WINDOWS, [x[heads] for x in keys], order[heads], starts[heads], n_slices)
            later = np.empty(len(heads), bool)
            later[by] = np.concatenate([_bits(answers[_WINDOWS, s], len(_split(x)[0]) // 8) for _, _, s, x in out])
            own = np.ones(len(at), bool)
            own[heads] = False
            gone[at] = later[head_of] | own
        return _kept(block, gone, copy)

    messages = packed.mapInArrow(first_pass, _MESSAGE)
    first = shared_table(_merge(messages, slice_width), "sketch-answers")
    sent = packed.groupBy("block").cogroup(first.groupBy("block")).applyInArrow(second_pass, _MESSAGE)
    second = shared_table(_merge(sent, slice_width), "window-answers")
    answers = first.union(second)
    return packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        third_pass, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string"
    )


def _answers(table: pa.Table) -> dict:
    kinds, at = table.column("kind").to_pylist(), table.column("slice").to_pylist()
    return {(k, s): x for k, s, x in zip(kinds, at, table.column("payload").to_pylist(), strict=True)}


def _bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8))[:n].astype(bool)


def _kept(block: _Block, gone: np.ndarray, copy: np.ndarray) -> pa.Table:
    """Rows of the result: words under a window that is gone are left out."""
    n = block.counts
    word_at = np.concatenate([[0], np.cumsum(n)])
    cover = np.zeros(word_at[-1] + 1, np.int32)
    starts = word_at[block.docs[gone]] + block.starts[gone]
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + block.size, -1)
    out = np.cumsum(cover[:-1]) > 0
    out |= np.repeat(copy, n)
    removed = np.concatenate([[0], np.cumsum(out)])
    removed = removed[word_at[1:]] - removed[word_at[:-1]]
    texts, byte_at = [], np.concatenate([[0], np.cumsum(block.sizes)])
    for i in range(len(n)):
        # bytes.split() parts at exactly 0x20 and 0x09-0x0D.
        parts = block.raw[byte_at[i] : byte_at[i + 1]].split()
        if removed[i]:
            parts = [x for x, drop in zip(parts, out[word_at[i] : word_at[i + 1]], strict=True) if not drop]
        texts.append(b" ".join(parts))
    return pa.table(
        {
            "doc_id": pa.array(block.ids, pa.int64(), mask=~block.known),
            "n_words": pa.array(n, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "kept": pa.array(texts, pa.binary()).cast(pa.string()),
            "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()),
        }
    )
