"""Language profiles in a hyperdimensional space, compared with documents by cosine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.hashing import U64, mix, slices

DIMENSIONS = 1024
#: Whole numbers are summed, so that the profiles do not depend on the order of the sums.
_SCALE = 1 << 20


def crc_remainder(column: str, parts: int) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


def letter_vectors(letters: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """A random vector of +1 and -1 for every code point, the same in every task."""
    seeds = mix(letters.astype(U64) * U64(0x9E3779B97F4A7C15))[:, None]
    bits = mix(seeds + np.arange(dimensions // 64, dtype=U64) * U64(0xD1342543DE82EF95))
    return np.unpackbits(bits.view(np.uint8), axis=1).astype(np.float32) * 2 - 1


def document_vectors(column: pa.Array, dimensions: int = DIMENSIONS) -> Iterator[np.ndarray]:
    """For consecutive rows: the sum of their letter trigrams, as vectors of length one (or zero).

    A trigram binds its letters by product, after shifting the first by two and the second by one
    place; everything between words is one letter. Case is folded.
    """
    is_letter: dict[int, bool] = {}
    for first, last, raw, offsets in slices(pc.utf8_lower(column)):
        points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        begins = np.cumsum((raw & 0xC0) != 0x80)
        ends = np.concatenate([[0], begins])[offsets]
        present = np.zeros(0x110000, bool)
        present[points] = True
        found = np.flatnonzero(present)
        for p in found:
            if p not in is_letter:
                is_letter[p] = chr(p).isalpha()
        letters = np.array([p for p in found if is_letter[p]], np.int64)
        codes = np.zeros(0x110000, np.int64)
        codes[letters] = np.arange(1, len(letters) + 1)
        base = len(letters) + 1
        # A gap before, between and after the rows, so that no trigram spans two of them.
        rows = np.repeat(np.arange(last - first), np.diff(ends))
        line = np.zeros(len(points) + last - first + 1, np.int64)
        line[np.arange(len(points)) + rows + 1] = codes[points]
        row_of = np.zeros(len(line), np.int64)
        row_of[np.arange(len(points)) + rows + 1] = rows
        middle = np.flatnonzero(line[1:-1]) + 1
        grams = (line[middle - 1] * base + line[middle]) * base + line[middle + 1]
        if base**3 <= 1 << 24:
            seen = np.zeros(base**3, bool)
            seen[grams] = True
            kinds = np.flatnonzero(seen)
            place = np.zeros(base**3, np.int64)
            place[kinds] = np.arange(len(kinds))
            grams = place[grams]
        else:
            kinds, grams = np.unique(grams, return_inverse=True)
        vectors = np.concatenate([np.ones((1, dimensions), np.float32), letter_vectors(letters, dimensions)])
        bound = np.roll(vectors, 2, axis=1)[kinds // base**2]
        bound *= np.roll(vectors, 1, axis=1)[kinds // base % base]
        bound *= vectors[kinds % base]
        out = np.zeros((last - first, dimensions), np.float32)
        for part in range(0, last - first, 256):
            inside = (row_of[middle] >= part) & (row_of[middle] < part + 256)
            n = min(256, last - first - part)
            cell = (row_of[middle][inside] - part) * len(kinds) + grams[inside]
            counts = np.bincount(cell, minlength=n * len(kinds)).reshape(n, len(kinds)).astype(np.float32)
            out[part : part + n] = counts @ bound
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        yield out / np.where(norms > 0, norms, 1)


def language_profiles(docs: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """A vector of length one for every lang: the bundle of its documents, each of length one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, at = batch.column(1).to_pylist(), 0
            for vectors in document_vectors(batch.column(0), dimensions):
                own = np.array(langs[at : at + len(vectors)], object)
                at += len(vectors)
                for lang in set(own):
                    part = np.rint(vectors[own == lang] * _SCALE).astype(np.int64).sum(axis=0)
                    sums[lang] = sums.get(lang, 0) + part
        for lang, total in sums.items():
            yield pa.record_batch(
                [pa.array([lang] * dimensions), pa.array(np.arange(dimensions), pa.int64()), pa.array(total)],
                ["lang", "place", "total"],
            )

    known = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    parts = known.mapInArrow(run, "lang string, place long, total long")
    profiles: dict[str, np.ndarray] = {}
    # One row for each language and dimension: as many as there are languages, however many documents.
    for lang, place, total in parts.groupBy("lang", "place").agg(F.sum("total")).collect():
        profiles.setdefault(lang, np.zeros(dimensions))[place] = total
    profiles = {lang: vector / np.linalg.norm(vector) for lang, vector in profiles.items() if vector.any()}
    return dict(sorted(profiles.items()))


def identify(docs: DataFrame, profiles: dict[str, np.ndarray]) -> DataFrame:
    """doc_id, held_out, lang_pred, score (cosine with the nearest profile, at least 0).

    Whole texts are read. A null text, or one without a letter, is `und` with score 0, as is every
    text when there is no profile. Ties go to the first language in order. Every row is returned,
    repeated ones too; other columns are ignored.
    """
    names = [*profiles, "und"]
    matrix = np.array(list(profiles.values()), np.float32).reshape(len(profiles), DIMENSIONS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for vectors in document_vectors(batch.column(2)):
                n = len(vectors)
                best, score = np.full(n, len(names) - 1), np.zeros(n)
                if len(matrix):
                    cosines = vectors @ matrix.T
                    lettered = vectors.any(axis=1)
                    best[lettered] = cosines.argmax(axis=1)[lettered]
                    score[lettered] = np.clip(cosines.max(axis=1)[lettered], 0, 1)
                picked = pa.array([names[i] for i in best], pa.string())
                head = batch.slice(at, n)
                yield pa.record_batch(
                    [head.column(0), head.column(1), picked, pa.array(score.astype(np.float64))],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )
                at += n

    held_out = F.coalesce(crc_remainder("doc_id", 5) == 0, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def predict_languages(docs: DataFrame) -> DataFrame:
    """`identify` with profiles learned from documents whose crc32(doc_id) leaves a remainder other than 0 by 5."""
    return identify(docs, language_profiles(docs.where(crc_remainder("doc_id", 5) != 0)))
