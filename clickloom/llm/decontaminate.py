"""Benchmark passages in documents: latent semantic search, then longest common subsequence and answer checks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.hashing import U64, letter_gaps, mix, slices, word_hashes, words
from clickloom.session import shared_table

_HITS = "doc_id long, item_id long, kind string, common double, answered double, cosine double, first_word long, n_words long"


@dataclass(frozen=True)
class LeakParams:
    """`spans`: words of a passage, each taken every half of it; passages as long as the item are taken
    too, every eighth. `rank`: latent dimensions. A passage is a candidate for an item from cosine
    `cosine`, in latent space or of the TF-IDF weights. With n words either side it is a copy if the longest common subsequence
    has `copy` of the item's words, a paraphrase if it has `paraphrase` of them and `answer` of the
    item's answer: the words of its `answer` column, else its rarest quarter. Benchmark items are
    taken `items_at_once`, which bounds what is sent to the tasks.
    """

    spans: tuple[int, ...] = (12, 40)
    rank: int = 96
    rounds: int = 2
    cosine: float = 0.5
    copy: float = 0.8
    paraphrase: float = 0.55
    answer: float = 0.8
    items_at_once: int = 5000


def _lines(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """first row, last row, word hashes and word number of every row; case folded, letters only."""
    for first, last, raw, offsets in slices(pc.utf8_lower(column)):
        starts, ends, row_words = words(raw, offsets, letter_gaps(raw))
        yield first, last, word_hashes(raw, starts, ends), row_words


class Vocabulary:
    """Places of sorted word hashes; -1 for a word that is not among them."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.quick = np.zeros(1 << 16, bool)
        self.quick[(hashes & U64(0xFFFF)).astype(np.int64)] = True

    def places(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.quick[(hashes & U64(0xFFFF)).astype(np.int64)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
            hit = self.hashes[at] == hashes[maybe]
            out[maybe[hit]] = at[hit]
        return out


def document_frequencies(docs: DataFrame, vocabulary: Vocabulary) -> tuple[np.ndarray, int]:
    """In how many documents each word of the vocabulary occurs, and the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, width = 0, len(vocabulary.hashes)
        total = np.zeros(width + 1, np.int64)
        for batch in batches:
            for first, last, hashes, row_words in _lines(batch.column(0)):
                rows = np.repeat(np.arange(last - first), np.diff(row_words))
                places = vocabulary.places(hashes)
                seen = np.sort((rows * width + places)[places >= 0])
                seen = seen[np.diff(seen, prepend=-1) > 0]
                total[:-1] += np.bincount(seen % width, minlength=width)
                n += last - first
        total[-1] = n
        yield pa.record_batch([pa.array(np.arange(width + 1)), pa.array(total)], ["place", "n"])

    parts = docs.select("text").mapInArrow(run, "place long, n long")
    counts = np.zeros(len(vocabulary.hashes) + 1, np.int64)
    summed = parts.groupBy("place").agg(F.sum("n").alias("n")).toArrow()  # one row for each vocabulary word
    counts[summed.column("place").to_numpy()] = summed.column("n").to_numpy()
    return counts[:-1], int(counts[-1])


def latent_basis(items: DataFrame, vocabulary: Vocabulary, idf: np.ndarray, params: LeakParams) -> np.ndarray:
    """Right singular vectors of the items' TF-IDF matrix: randomised subspace iteration.

    A round multiplies a thin matrix by A'A: every task adds up its items' share, and the shares are
    summed by vocabulary word; only matrices of vocabulary by rank leave the tasks.
    """
    width = len(vocabulary.hashes)
    rank = max(1, min(params.rank, width))
    seeds = mix(np.arange(1, width * rank + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
    basis = (seeds >> U64(11)).astype(np.float64).reshape(width, rank) / 2.0**53 - 0.5
    for _ in range(params.rounds + 1):
        basis = np.linalg.qr(basis)[0]

        def run(batches: Iterator[pa.RecordBatch], basis: np.ndarray = basis) -> Iterator[pa.RecordBatch]:
            share = np.zeros_like(basis)
            for batch in batches:
                for _, last, hashes, row_words in _lines(batch.column(0)):
                    places = vocabulary.places(hashes)
                    for i, j in zip(row_words[:-1], row_words[1:], strict=True):
                        terms, counts = np.unique(places[i:j][places[i:j] >= 0], return_counts=True)
                        weights = counts * idf[terms]
                        norm = np.sqrt((weights**2).sum())
                        if norm:
                            weights = weights / norm
                            share[terms] += np.outer(weights, weights @ basis[terms])
            used = np.flatnonzero(share.any(axis=1))
            yield pa.record_batch([pa.array(used), pa.array(list(share[used]), pa.list_(pa.float64()))], ["place", "share"])

        shares = items.select("text").mapInArrow(run, "place long, share array<double>")
        summed = shares.select("place", F.posexplode("share").alias("i", "value")).groupBy("place", "i")
        summed = summed.agg(F.sum("value").alias("value")).toArrow()
        basis = np.zeros_like(basis)
        basis[summed.column("place").to_numpy(), summed.column("i").to_numpy()] = summed.column("value").to_numpy()
    return np.linalg.qr(basis)[0].astype(np.float32)


def common_subsequence(item: list[int], region: list[int]) -> int:
    """Length of the longest common subsequence, by whole numbers as bit rows."""
    masks: dict[int, int] = {}
    for i, word in enumerate(item):
        masks[word] = masks.get(word, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for word in region:
        mask = masks.get(word)
        if mask:
            held = row & mask
            row = ((row + held) | (row - held)) & full
    return len(item) - row.bit_count()


class ItemIndex:
    """Which items can be in which rows, by an exact bound: a copy or paraphrase shares `need` of an item's n words.

    However those are chosen, `held` of them are among the item's n - need + held rarest words, and
    lie within its longest region. So only rows with so many of these words close together are looked
    at, and there only regions that share `need` words with the item, each as often as it has it.
    """

    def __init__(self, texts: list[np.ndarray], frequency: np.ndarray, params: LeakParams):
        least = min(params.copy, params.paraphrase)
        self.spans = [(*((x, max(1, x // 2)) for x in params.spans), (len(t), max(1, len(t) // 8))) for t in texts]
        self.terms, self.times, self.need, held, reach, heads = [], [], [], [], [], []
        for text, spans in zip(texts, self.spans, strict=True):
            n = len(text)
            need = next(c for c in range(max(1, int(least * n) - 1), n + 2) if c / n >= least or c > n)
            some = max(1, need // 4)
            terms, times = np.unique(text, return_counts=True)
            self.terms.append(terms)
            self.times.append(times)
            self.need.append(need)
            held.append(some)
            reach.append(max(x for x, _ in spans) + 2 * n)
            heads.append(np.unique(text[np.lexsort((text, frequency[text]))[: n - need + some]]))
        self.held, self.reach = np.array(held), np.array(reach)
        words_of = np.concatenate(heads)
        order = np.argsort(words_of, kind="stable")
        self.items = np.repeat(np.arange(len(heads)), [len(x) for x in heads])[order]
        self.starts = np.searchsorted(words_of[order], np.arange(len(frequency) + 1))

    def pairs(self, places: np.ndarray, row_words: np.ndarray) -> list[tuple[int, int]]:
        """Rows and items that have `held` of the item's rarest words within its reach."""
        counts = np.where(places >= 0, self.starts[places + 1] - self.starts[places], 0)
        at = np.flatnonzero(counts)
        counts = counts[at]
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        items = self.items[np.repeat(self.starts[places[at]], counts) + within]
        keys = np.sort(items * len(places) + np.repeat(at, counts))
        if not len(keys):
            return []
        items, at = keys // len(places), keys % len(places)
        rows = np.searchsorted(row_words, at, "right") - 1
        other = np.arange(len(keys)) + self.held[items] - 1
        inside = np.minimum(other, len(keys) - 1)
        able = (other == inside) & (items[inside] == items) & (rows[inside] == rows) & (at[inside] - at < self.reach[items])
        found = np.unique(rows[able] * len(self.held) + items[able])
        return [divmod(int(x), len(self.held)) for x in found]

    def regions(self, item: int, places: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Span, first words of its passages whose regions can hold the item, and the words that region shares with it."""
        terms, times, need, n = self.terms[item], self.times[item], self.need[item], int(self.times[item].sum())
        term = np.minimum(np.searchsorted(terms, places), len(terms) - 1)
        at = np.flatnonzero(terms[term] == places)
        if len(at) < need:
            return
        at = at[np.argsort(term[at], kind="stable")]
        term = term[at]
        # A word counts in a region unless as many of its like as the item has stand before it there.
        before = np.arange(len(at)) - times[term]
        before = np.where((before >= 0) & (term[before] == term), at[before], -1)

        def shared(size: int) -> np.ndarray:
            begins, ends = (np.bincount(x + 1, minlength=len(places) + 1) for x in (np.maximum(before, at - size), at))
            return np.cumsum(begins - ends)

        if shared(int(self.reach[item])).max() < need:
            return
        for span, step in dict.fromkeys(self.spans[item]):
            begin = np.arange(max(-(-(len(places) - span) // step), 0) + 1) * step
            common = shared(span + 2 * n)[np.maximum(begin - n, 0)]
            able = common >= need
            if able.any():
                yield span, begin[able], common[able]


def _cosines(begin, span, places, idf, vectors, latent, terms, weights) -> np.ndarray:
    """Of passages with one item: the larger of that in latent space and that of the TF-IDF weights themselves.

    The second keeps items that the latent dimensions hold badly. Words of no item count in neither.
    """
    out, width = [], len(idf)
    most = max(1, 160_000 // span)
    for i in range(0, len(begin), most):
        b = begin[i : i + most]
        span_at = b[:, None] + np.arange(span)
        own = np.where(span_at < len(places), places[np.minimum(span_at, len(places) - 1)], -1)
        passages = vectors[own].sum(axis=1)
        near = passages @ latent / np.maximum(np.linalg.norm(passages, axis=1), 1e-9)
        rows, words_of = np.nonzero(own >= 0)
        keys, times = np.unique(rows * width + own[rows, words_of], return_counts=True)
        value = times * idf[keys % width]
        term = np.minimum(np.searchsorted(terms, keys % width), len(terms) - 1)
        shared = np.where(terms[term] == keys % width, value * weights[term], 0.0)
        norms, dots = (np.bincount(keys // width, x, len(b)) for x in (value**2, shared))
        out.append(np.maximum(near, dots / np.maximum(np.sqrt(norms), 1e-9)))
    return np.concatenate(out)


def leaks(docs: DataFrame, benchmark: DataFrame, params: LeakParams = LeakParams()) -> DataFrame:
    """doc_id, item_id, kind (copy or paraphrase), common, answered, cosine, first_word, n_words.

    One row for every document and benchmark item found in it, with the place of the best passage
    (ties: the first). Words are runs of letters, case folded. Items with null id or text, or
    without a word, are found nowhere; null and empty texts hold nothing; a null doc_id stays null.
    Repeated item ids count as one item (the least text), repeated documents give repeated rows.
    Other columns are ignored, but for an `answer` in the benchmark.
    """
    text = F.struct("text", "answer") if "answer" in benchmark.columns else F.struct("text", F.lit(None).cast("string").alias("answer"))
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").groupBy("item_id").agg(F.min(text).alias("item"))
    items = shared_table(items.select(F.col("item_id").cast("long"), "item.*"), "items")
    vocabulary = _vocabulary(items)
    if not len(vocabulary.hashes):
        return docs.sparkSession.createDataFrame([], _HITS)
    # Vocabulary, weights and latent space are of all items, so a hit does not depend on the part its item is in.
    frequency, n_docs = document_frequencies(docs, vocabulary)
    idf = np.log((n_docs + 1) / (frequency + 1)) + 0.05
    basis = latent_basis(items, vocabulary, idf, params)
    vectors = np.concatenate([(idf[:, None] * basis).astype(np.float32), np.zeros((1, basis.shape[1]), np.float32)])
    total, found = items.count(), None
    n_parts = max(1, -(-total // params.items_at_once))
    for part in range(n_parts):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(n_parts)) == part)
        hits = _search(docs, own, vocabulary, frequency, idf, vectors, params)
        found = hits if found is None else found.union(hits)
    return found


def _vocabulary(items: DataFrame) -> Vocabulary:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, hashes, _ in _lines(batch.column(0)):
                yield pa.record_batch([pa.array(np.unique(hashes).view(np.int64))], ["word"])

    found = items.select("text").mapInArrow(run, "word long").distinct().toArrow()
    return Vocabulary(np.sort(found.column("word").to_numpy().view(U64)))


def _search(docs: DataFrame, items: DataFrame, vocabulary: Vocabulary, frequency: np.ndarray, idf: np.ndarray, vectors: np.ndarray, params: LeakParams) -> DataFrame:
    rows = [x for x in items.orderBy("item_id").collect()]  # at most about items_at_once
    ids = np.array([x["item_id"] for x in rows], np.int64)
    texts = [vocabulary.places(hashes) for _, _, hashes, _ in _each([x["text"] for x in rows])]
    answers = [hashes for _, _, hashes, _ in _each([x["answer"] or "" for x in rows])]
    keep = [i for i, x in enumerate(texts) if len(x)]
    ids, texts, answers = ids[keep], [texts[i] for i in keep], [answers[i] for i in keep]
    if not keep:
        return docs.sparkSession.createDataFrame([], _HITS)
    latent = np.stack([vectors[x].sum(axis=0) for x in texts])
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
    for i, x in enumerate(texts):
        if not len(answers[i]):
            order = np.argsort(frequency[x], kind="stable")
            answers[i] = vocabulary.hashes[x[order[: max(1, -(-len(x) // 4))]]]
    item_words, answer_sets = [x.tolist() for x in texts], [set(x.tolist()) for x in answers]
    index = ItemIndex(texts, frequency, params)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, hashes, row_words in _lines(batch.column(1)):
                best: dict[tuple[int, int], tuple] = {}
                places = vocabulary.places(hashes)
                for row, i in index.pairs(places, row_words):
                    own, n = places[row_words[row] : row_words[row + 1]], len(item_words[i])
                    terms = index.terms[i]
                    weights = index.times[i] * idf[terms]
                    weights = weights / np.sqrt((weights**2).sum())
                    for span, begins, most in index.regions(i, own):
                        cosines = _cosines(begins, span, own, idf, vectors, latent[i], terms, weights)
                        for p in np.argsort(-cosines, kind="stable"):
                            begin, cosine, old = int(begins[p]), float(cosines[p]), best.get((row, i))
                            if cosine < params.cosine:
                                break
                            if old and (most[p] / n, cosine) <= (old[0], old[2]):
                                continue
                            end = min(begin + span, len(own))
                            left, right = max(begin - n, 0), min(end + n, len(own))
                            common = common_subsequence(item_words[i], own[left:right].tolist()) / n
                            if common < min(params.copy, params.paraphrase):
                                continue
                            region = hashes[row_words[row] + left : row_words[row] + right].tolist()
                            answered = len(answer_sets[i].intersection(region)) / len(answer_sets[i])
                            copied = common >= params.copy
                            if copied or common >= params.paraphrase and answered >= params.answer:
                                if not old or (common, cosine) > (old[0], old[2]):
                                    best[row, i] = (common, answered, cosine, begin, end - begin)
                found = sorted(best)
                yield pa.record_batch(
                    [
                        batch.column(0).take(pa.array([first + r for r, _ in found], pa.int64())),
                        pa.array([int(ids[i]) for _, i in found], pa.int64()),
                        pa.array(["copy" if best[x][0] >= params.copy else "paraphrase" for x in found], pa.string()),
                        *(pa.array([best[x][k] for x in found], pa.float64()) for k in range(3)),
                        *(pa.array([best[x][k] for x in found], pa.int64()) for k in (3, 4)),
                    ],
                    ["doc_id", "item_id", "kind", "common", "answered", "cosine", "first_word", "n_words"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _HITS)


def _each(texts: list[str]):
    for text in texts:
        column = pa.array([text], pa.string())
        yield from _lines(column)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, params: LeakParams = LeakParams()) -> DataFrame:
    """The documents of `docs` that hold no benchmark item (all rows of a doc_id go together)."""
    bad = leaks(docs, benchmark, params).select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)
