"""WARC archives of pages: written and read back, and their capture index merged from sorted runs."""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.session import new_folder

_RUN = "url_key string, captured string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, place long"
_NAMES = [x.split()[0] for x in _RUN.split(", ")]


@dataclass(frozen=True)
class WarcParams:
    """`least_bytes` of a payload that may be revisited; about `archive_records` records an archive."""

    least_bytes: int = 100
    archive_records: int = 2000


def url_key(url: Column) -> Column:
    """Sort-friendly key: host labels reversed, then path and query, lower case; scheme, port, fragment and user left out."""
    plain = F.lower(F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20\x7f]+", "%20"))
    plain = F.regexp_replace(F.regexp_replace(plain, r"^[a-z][a-z0-9+.-]*://", ""), r"#.*$", "")
    authority = F.regexp_extract(plain, r"^([^/?]*)", 1)
    host = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":\d*$", "")
    labels = F.reverse(F.split(F.regexp_replace(host, r"^www\.", ""), r"\."))
    rest = F.regexp_replace(plain, r"^[^/?]*", "")
    return F.concat(F.array_join(labels, ","), F.lit(")"), F.when(rest == "", "/").otherwise(rest))


def records(pages: DataFrame, params: WarcParams) -> DataFrame:
    """page_id, value: one WARC record a row, as text that the text writer ends with a line break.

    Pages with equal payloads are found by digest and length: the smallest page_id is combined before
    the shuffle, and only digests that occur twice are joined back.
    """
    rows = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
    )
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256)).withColumn("bytes", F.octet_length("html"))
    able = rows.where((F.col("bytes") >= params.least_bytes) & F.col("page_id").isNotNull())
    firsts = able.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = rows.join(firsts, "digest", "left")
    revisit = F.coalesce((F.col("bytes") >= params.least_bytes) & (F.col("page_id") > F.col("first_id")), F.lit(False))
    kind = F.when(revisit, "revisit").otherwise("response")
    target = F.regexp_replace(F.col("url"), r"[\x00-\x20\x7f]+", "%20")
    captured = F.date_format(
        F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(31536000))),
        "yyyy-MM-dd'T'HH:mm:ss'Z'",
    )

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    def urn(page: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(">"))

    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", F.coalesce(urn(F.col("page_id")), F.lit("<urn:page:>"))),
        line("WARC-Date", captured),
        line("WARC-Target-URI", target),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("WARC-Refers-To", F.when(revisit, urn(F.col("first_id")))),
        line("WARC-URL-Key", url_key(F.col("url"))),
        F.when(revisit, line("WARC-Payload-Length", F.col("bytes").cast("string"))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
        F.lit("\r\n"),
    )
    return rows.select(F.concat(head, F.when(revisit, "").otherwise(F.col("html")), F.lit("\r\n")).alias("value"))


def write_archives(pages: DataFrame, folder: str, params: WarcParams = WarcParams()) -> None:
    """Gzipped WARC files in `folder`; every record ends with two line breaks, as the format asks."""
    writer = records(pages, params).write.option("lineSep", "\r\n").option("compression", "gzip")
    writer.option("maxRecordsPerFile", params.archive_records).text(folder)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record; lengths are taken from the headers, never from the payload."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/1."):
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        begin = end + 4
        after = begin + int(headers["Content-Length"])
        yield headers, data[begin:after]
        at = after + 4


def sorted_runs(archives: DataFrame) -> DataFrame:
    """Index entries of every archive, each archive's in order of (url_key, captured, page_id).

    Payload lengths and digests are taken from the payloads; those of a revisit, which has none,
    from its headers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                entries = []
                for place, (headers, block) in enumerate(parse(gzip.decompress(content.as_py()))):
                    page, refers = (headers.get(x, "<urn:page:>")[10:-1] for x in ("WARC-Record-ID", "WARC-Refers-To"))
                    kind, size, digest = headers["WARC-Type"], len(block), hashlib.sha256(block).hexdigest()
                    stated = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    if kind == "revisit":
                        size, digest = int(headers["WARC-Payload-Length"]), stated
                    elif digest != stated:
                        raise ValueError(f"payload of record {place} in {path} does not match its digest")
                    number = int(page) if page else None
                    entries.append(
                        (headers["WARC-URL-Key"], headers["WARC-Date"], number, size, digest, kind, int(refers) if refers else None, path.as_py(), place)
                    )
                entries.sort(key=_order)
                yield _table(entries)

    return archives.select("path", "content").mapInArrow(run, _RUN)


def _order(entry: tuple) -> tuple:
    """Place in the index: key, time, page (null first), archive and place in it."""
    return (entry[0], entry[1], entry[2] is not None, entry[2] or 0, entry[7], entry[8])


def _table(entries: list[tuple], extra: list | None = None) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    columns = [pa.array([x[i] for x in entries], kind) for i, kind in enumerate(kinds)]
    names = list(_NAMES)
    if extra is not None:
        columns.append(pa.array(extra, pa.int64()))
        names.append("merged_at")
    return pa.record_batch(columns, names)


class LoserTree:
    """k-way merge: inner nodes keep the loser of their match, so a step replays one path to the root."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.at = runs, [0] * len(runs)
        self.size = max(1, 1 << (len(runs) - 1).bit_length()) if runs else 1
        self.losers = [-1] * self.size
        winners = [-1] * self.size + [i if i < len(runs) else -1 for i in range(self.size)]
        for node in range(self.size - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.winner = winners[1] if self.size > 1 else winners[self.size]

    def _head(self, i: int):
        return self.runs[i][self.at[i]] if i >= 0 and self.at[i] < len(self.runs[i]) else None

    def _before(self, a: int, b: int) -> bool:
        x, y = self._head(a), self._head(b)
        if x is None or y is None:
            return y is None
        return _order(x) <= _order(y)

    def __iter__(self) -> Iterator[tuple]:
        while (head := self._head(self.winner)) is not None:
            yield head
            i = self.winner
            self.at[i] += 1
            node = (self.size + i) // 2
            while node:
                if self._before(self.losers[node], i):
                    self.losers[node], i = i, self.losers[node]
                node //= 2
            self.winner = i


def merge_runs(runs: DataFrame) -> DataFrame:
    """The entries in global order: `merged_at` is their place in a range of keys, ranges in order.

    Ranges hold similar numbers of entries; one url_key with many captures is split by time. A
    task gets its share of every sorted run and merges them with a loser tree.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        parts: dict[str, list[tuple]] = {}
        for batch in batches:
            for entry in zip(*(batch.column(i).to_pylist() for i in range(len(_NAMES))), strict=True):
                parts.setdefault(entry[7], []).append(entry)
        for part in parts.values():
            # Fetched blocks of one run may arrive in any order; each is sorted, which makes this one pass.
            part.sort(key=_order)
        out, place = [], base
        for entry in LoserTree([parts[x] for x in sorted(parts)]):
            out.append(entry)
            if len(out) == 5000:
                yield _table(out, list(range(place, place + len(out))))
                place, out = place + len(out), []
        yield _table(out, list(range(place, place + len(out))))

    ordered = runs.repartitionByRange("url_key", "captured", "page_id", "archive", "place")
    return ordered.mapInArrow(run, f"{_RUN}, merged_at long")


def archive_pages(pages: DataFrame, params: WarcParams = WarcParams()) -> DataFrame:
    """The merged capture index of `pages`, written to WARC archives and read back from them.

    page_id, payload_bytes, payload_digest, record_type, refers_to, url_key, captured, archive, place,
    merged_at. The payload is the html in UTF-8, empty if null. Of equal payloads of at least
    `least_bytes`, that with the smallest page_id is a response and the others revisit it; rows that
    repeat this page_id are responses too. A null page_id is a response with a null id, a null url
    an empty key; white space in a url becomes %20. Capture times follow from page_id, as pages
    have none. Every row gives a record; other columns are ignored; empty in, empty out.
    """
    spark, folder = pages.sparkSession, new_folder(pages.sparkSession, "warc")
    write_archives(pages, folder, params)
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    index = merge_runs(sorted_runs(archives))
    first = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return index.select(*first, "url_key", "captured", "archive", "place", "merged_at")
