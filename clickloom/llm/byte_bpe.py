"""Byte-level BPE: recursive DuckDB queries over token-position rows in every partition, ordered aggregation back.

Spark deals out the documents; each task keeps a private in-memory DuckDB with the vocabulary and the
merge table. Texts are cut where no token can reach across: between the matches of the pattern, and
between two bytes that stand next to each other in no token. What is left is encoded once for each
distinct segment: its rows (one a token) join the merge table, the leftmost pair of least rank is
contracted, and the query recurs on the segments that still had one.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.hashing import slices

_ROUND_TRIP = "doc_id long, n_tokens long, ids binary, decoded binary"

#: Rows are numbered from the right end (0 is the last token), so a contraction renumbers the rows left
#: of it only: its right row becomes the merged token, its left row goes. `nxt` is the token to the right.
#: A recursion goes on for at most `depth` contractions; what is not done then starts the next one.
_ONE_PAIR = """
WITH RECURSIVE run AS (
  SELECT word, num, token, nxt, 0 AS step, false AS done FROM segment_rows
  UNION ALL
  (WITH pairs AS (
     SELECT run.*, id FROM run LEFT JOIN merges ON merges.l = token AND merges.r = nxt WHERE NOT done AND step < {depth}
   ), best AS (
     SELECT word, min(id::BIGINT * {places} + ({places} - 1 - num)) AS best FROM pairs WHERE id IS NOT NULL GROUP BY word
   ), chosen AS (
     SELECT word, (best // {places})::INTEGER AS merged, ({places} - 1 - best % {places})::INTEGER AS here FROM best
   )
   SELECT p.word,
     CASE WHEN num > here THEN num - 1 ELSE num END,
     CASE WHEN num = here - 1 THEN merged ELSE token END,
     CASE WHEN num = here + 1 THEN merged ELSE nxt END,
     step + 1, merged IS NULL
   FROM pairs p LEFT JOIN chosen c ON p.word = c.word WHERE merged IS NULL OR num <> here)
)
SELECT word, num, token, nxt, done FROM run WHERE done OR step = {depth}
"""

#: The same for long segments, several contractions at once: all pairs of the least rank that do not
#: overlap, from the left up to the first one that makes a pair of lesser rank with a neighbour. One pair
#: at a time would take exactly these next: until that one, every new pair has a greater rank.
_EVERY_PAIR = """
WITH RECURSIVE run AS (
  SELECT word, num, token, nxt, 0 AS step, false AS done FROM segment_rows
  UNION ALL
  (WITH pairs AS (
     SELECT run.*, id FROM run LEFT JOIN merges ON merges.l = token AND merges.r = nxt WHERE NOT done AND step < {depth}
   ), least AS (
     SELECT *, min(id) OVER (PARTITION BY word) AS merged FROM pairs
   ), runs AS (
     SELECT word, num, num + row_number() OVER (PARTITION BY word ORDER BY num DESC) AS island FROM least WHERE id = merged
   ), hits AS (
     SELECT word, num FROM runs QUALIFY row_number() OVER (PARTITION BY word, island ORDER BY num DESC) % 2 = 1
   ), marked AS (
     SELECT a.*, h.num IS NOT NULL AS hit FROM least a LEFT JOIN hits h ON a.word = h.word AND a.num = h.num
   ), around AS (
     SELECT *,
       CASE WHEN lag(hit, 2) OVER w THEN merged ELSE lag(token) OVER w END AS left_token, lead(nxt) OVER w AS right_token
     FROM marked WINDOW w AS (PARTITION BY word ORDER BY num DESC)
   ), stops AS (
     SELECT word, max(num) AS last FROM around
     LEFT JOIN merges m ON m.l = left_token AND m.r = merged
     LEFT JOIN merges n ON n.l = merged AND n.r = right_token
     WHERE hit AND (m.id < merged OR n.id < merged) GROUP BY word
   ), taken AS (
     SELECT a.*, hit AND (last IS NULL OR num >= last) AS take FROM around a LEFT JOIN stops s ON a.word = s.word
   ), placed AS (
     SELECT *, lag(take) OVER w AS after_take, lead(take) OVER w AS before_take,
       sum(take::INTEGER) OVER (PARTITION BY word ORDER BY num ROWS UNBOUNDED PRECEDING) AS gone
     FROM taken WINDOW w AS (PARTITION BY word ORDER BY num DESC)
   )
   SELECT word, (num - coalesce(gone, 0))::INTEGER,
     CASE WHEN after_take THEN merged ELSE token END,
     CASE WHEN before_take THEN merged ELSE nxt END,
     step + 1, merged IS NULL
   FROM placed WHERE take IS NOT TRUE)
)
SELECT word, num, token, nxt, done FROM run WHERE done OR step = {depth}
"""

#: Letters and numbers of Unicode versions after the one the reference encoder knows, to which
#: they are neither.
_NEWER = (
    "\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c-\uab6d"
    "\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a"
    "\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686"
    "\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda"
    "\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128"
    "\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff"
    "\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4"
    "\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479"
    "\U0003d000-\U0003fc3f"
)

_DECODE = """
SELECT doc, part, unhex(string_agg(hex_bytes, '' ORDER BY pos)) AS piece
FROM token_rows JOIN vocabulary USING (token) GROUP BY doc, part ORDER BY doc, part
"""


@dataclass(frozen=True)
class BpeParams:
    """`ranks`: the vocabulary as a rank file (read by the driver and sent with the job, refused above
    `most_bytes`), `pattern`: how a text is split before the merges (any; the usual one is found on
    whole buffers). Segments of more than `long`
    bytes contract several pairs at a time. `bytes_at_once` bounds the segments of one query, `known`
    the segments a task remembers, `part` the tokens put together at a time when decoding.
    """

    ranks: str
    pattern: str
    most_bytes: int = 64 << 20
    long: int = 48
    bytes_at_once: int = 200_000
    known: int = 600_000
    part: int = 1 << 16


def default_params() -> BpeParams:
    """The 50k byte-level vocabulary for many languages."""
    import public_tokenizers

    return BpeParams(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one range after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _binary(raw: np.ndarray, edges: np.ndarray) -> pa.Array:
    """The slices of a buffer between consecutive edges."""
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(raw)])


#: The pattern whose matches are found on whole buffers, and the endings it takes as one match.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ENDINGS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
_OTHER, _LETTER, _NUMBER, _SPACE = range(4)


def _kinds() -> np.ndarray:
    """Kind of every code point, as the reference encoder sees it."""
    import regex

    kinds = np.zeros(0x110000, np.uint8)
    # Surrogates are in no text.
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, name in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+"), (_OTHER, f"[{_NEWER}]+")):
        for found in regex.finditer(name, points):
            first, last = ord(found[0][0]), ord(found[0][-1])
            kinds[first : last + 1] = kind
    return kinds


def _matches(points: np.ndarray, rows: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Whether a match of `_PATTERN` begins at each code point; `rows`: where the (non-empty) rows begin."""
    n, kind = len(points), kinds[points]
    head = np.zeros(n + 1, bool)
    head[rows] = head[n] = True
    space = kind == _SPACE
    cut = np.empty(n, bool)
    cut[0], cut[1:] = True, kind[1:] != kind[:-1]
    # A run of white space before other characters leaves its last one: a blank goes with what follows.
    last = space.copy()
    last[:-1] &= ~space[1:]
    last &= ~head[1:]
    cut |= last
    cut[1:] &= ~(last & (points == 32))[:-1]
    cut |= head[:-1]
    quote = np.flatnonzero((points == 39) & cut)
    for ending in _ENDINGS:
        at, size = quote[quote <= n - len(ending)], len(ending)
        for k in range(1, size):
            at = at[(points[at + k] == ord(ending[k])) & ~head[at + k]]
        cut[at + 1] = False
        after = at + size
        cut[after[after < n]] = True
    return cut


class Codec:
    """Encodes and decodes by SQL over one vocabulary; the database lives in the memory of its task."""

    def __init__(self, content: bytes, params: BpeParams):
        import duckdb
        import regex

        self.params, self.pattern = params, regex.compile(params.pattern)
        self.kinds = _kinds() if params.pattern == _PATTERN else None
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
        merges, self.together = [], np.zeros((256, 256), bool)
        for token, rank in ranks.items():
            if len(token) > 1:
                at = np.frombuffer(token, np.uint8)
                self.together[at[:-1], at[1:]] = True
                halves = ((ranks.get(token[:k]), ranks.get(token[k:])) for k in range(1, len(token)))
                merges += [(a, b, rank) for a, b in halves if a is not None and b is not None]
        self.letters = np.array([ranks[bytes([x])] for x in range(256)], np.int32)
        # Memory only: nothing is spilled to a folder, since every query is over a bounded slice.
        self.db = duckdb.connect(config={"threads": 1, "temp_directory": "", "memory_limit": "1GB"})
        self._table("merges", {k: pa.array(x, pa.int32()) for k, x in zip(("l", "r", "id"), zip(*merges, strict=True), strict=True)} if merges else {k: pa.array([], pa.int32()) for k in ("l", "r", "id")})
        hexes = [x.hex() for x in ranks]
        self._table("vocabulary", {"token": pa.array(ranks.values(), pa.int32()), "hex_bytes": pa.array(hexes, pa.string())})
        self._forget()

    def _table(self, name: str, columns: dict) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.tokens, self.edges = [np.zeros(0, np.int32)], [0]

    def _contract(self, query: str, rows: pa.Table, depth: int, places: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all segments, in order, and the number of them in each."""
        query, out = query.format(depth=depth, places=places), []
        while rows.num_rows:
            self.db.register("segment_rows", rows)
            found = self.db.sql(query).to_arrow_table()
            done = found.column("done")
            out.append(found.filter(done).select(["word", "num", "token"]))
            rows = found.filter(pa.compute.invert(done)).select(["word", "num", "token", "nxt"])
        found = pa.concat_tables(out)
        word, num, token = (found.column(x).to_numpy() for x in ("word", "num", "token"))
        return token[np.lexsort((-num, word))], np.bincount(word)

    def _learn(self, segments: list[bytes]) -> None:
        """Encode segments not known yet and remember their tokens."""
        if len(self.number) > self.params.known:
            self._forget()
        new = [x for x in segments if x not in self.number]
        new.sort(key=len)
        first = 0
        while first < len(new):
            last, size, is_long = first, 0, len(new[first]) > self.params.long
            while last < len(new) and (last == first or size + len(new[last]) <= self.params.bytes_at_once):
                if (len(new[last]) > self.params.long) != is_long:
                    break
                size, last = size + len(new[last]), last + 1
            part = new[first:last]
            sizes = np.array([len(x) for x in part])
            token = self.letters[np.frombuffer(b"".join(part), np.uint8)]
            word = np.repeat(np.arange(len(part), dtype=np.int32), sizes)
            ends = np.cumsum(sizes)
            num = (np.repeat(ends, sizes) - 1 - np.arange(size)).astype(np.int32)
            nxt = np.append(token[1:], -1)
            nxt[ends - 1] = -1
            rows = pa.table({"word": word, "num": num, "token": token, "nxt": pa.array(nxt, mask=nxt < 0)})
            tokens, counts = self._contract(_EVERY_PAIR if is_long else _ONE_PAIR, rows, 8 if is_long else 64, 1 << 16)
            base = self.edges[-1]
            self.tokens.append(tokens)
            self.edges += (base + np.cumsum(counts)).tolist()
            self.number.update(zip(part, range(len(self.number), len(self.number) + len(part)), strict=True))
            first = last

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a UTF-8 buffer, and the number of ids of each row."""
        if not len(raw):
            return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        cut = np.zeros(len(raw) + 1, bool)
        cut[1:-1] = ~self.together[raw[:-1], raw[1:]]
        cut[offsets] = True
        cut |= self._splits(raw, offsets)
        cuts = np.flatnonzero(cut)
        segments = _binary(raw, cuts).dictionary_encode()
        distinct = segments.dictionary.to_pylist()
        self._learn(distinct)
        number = np.array([self.number[x] for x in distinct])[segments.indices.to_numpy()]
        self.tokens, edges = [np.concatenate(self.tokens)], np.array(self.edges)
        sizes = edges[number + 1] - edges[number]
        total = np.concatenate([[0], np.cumsum(sizes)])
        return self.tokens[0][_ranges(edges[number], sizes)], np.diff(total[np.searchsorted(cuts, offsets)])

    def _splits(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Marks the bytes where a match of the pattern begins."""
        out = np.zeros(len(raw) + 1, bool)
        if self.kinds is not None:
            points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
            starts = np.flatnonzero((raw & 0xC0) != 0x80)
            rows = np.searchsorted(starts, offsets[:-1][np.diff(offsets) > 0])
            out[starts[_matches(points, rows, self.kinds)]] = True
            return out
        for first, last in zip(offsets[:-1], offsets[1:], strict=True):
            at = first
            for piece in self.pattern.findall(raw[first:last].tobytes().decode()):
                out[at] = True
                at += len(piece.encode())
        return out

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of every row's ids. An id that is not in the vocabulary is an error."""
        rows = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        pos = _ranges(np.zeros(len(counts), np.int64), counts)
        self.db.register("token_rows", pa.table({"doc": rows, "part": pos // self.params.part, "pos": pos, "token": ids}))
        found = self.db.sql(_DECODE).to_arrow_table()
        out: list[list[bytes]] = [[] for _ in counts]
        for row, piece in zip(found.column("doc").to_pylist(), found.column("piece").to_pylist(), strict=True):
            out[row].append(piece)
        return [b"".join(x) for x in out]


_CODECS: dict[tuple[bytes, BpeParams], Codec] = {}


def _codec(content: bytes, params: BpeParams) -> Codec:
    """The codec of this worker process; the tables are built once for many tasks."""
    if (content, params) not in _CODECS:
        _CODECS.clear()
        _CODECS[content, params] = Codec(content, params)
    return _CODECS[content, params]


def _vocabulary(params: BpeParams) -> bytes:
    with open(params.ranks, "rb") as file:
        content = file.read(params.most_bytes + 1)
    if len(content) > params.most_bytes:
        raise ValueError(f"{params.ranks} has more than {params.most_bytes} bytes")
    return content


def round_trip(docs: DataFrame, params: BpeParams | None = None) -> DataFrame:
    """doc_id, n_tokens, ids (binary, little-endian unsigned 32-bit), decoded (binary, from the ids alone).

    Null and empty texts have no ids. Every row of the input gives one, repeated ones and null doc_ids
    too; other columns are ignored; an empty table gives an empty one. No special tokens are looked for.
    Texts are read whole, however long; a batch is worked on in slices of 4 MB or one longer text.
    """
    params = params or default_params()
    content = _vocabulary(params)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(content, params)
        for batch in batches:
            for first, last, raw, offsets in slices(batch.column(1), 4 << 20):
                ids, counts = codec.encode(raw, offsets)
                edges = 4 * np.concatenate([[0], np.cumsum(counts)])
                columns = [
                    batch.column(0).slice(first, last - first),
                    pa.array(counts, pa.int64()),
                    _binary(ids.astype("<u4"), edges),
                    pa.array(codec.decode(ids, counts), pa.binary()),
                ]
                yield pa.record_batch(columns, ["doc_id", "n_tokens", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _ROUND_TRIP)


def digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of a round trip."""
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
