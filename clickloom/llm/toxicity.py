"""Weak supervision for toxicity: voters, a generative label model, a linear classifier."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.hashing import U64, letter_gaps, mix, slices, word_hashes, words
from clickloom.llm.language_id import crc_remainder

#: A general lexicon of insults and threats, one voter a line.
LEXICONS = (
    "idiot idiots moron morons imbecile stupid dumb fool dumbass retard",
    "trash garbage scum filth vermin worthless pathetic disgusting loser clown",
    "bastard bitch asshole shit fuck fucking crap whore slut",
    "kill kys murder murderer lynch",
    "idiota estupido estúpido imbécil basura mierda puta asqueroso",
    "idiote stupide imbécile connard merde salaud ordure débile",
    "idiot blöd dumm arschloch scheiße dreck abschaum trottel",
)
PATTERNS = 4


@dataclass(frozen=True)
class ToxicityParams:
    """`fit_rows` bounds the labelled documents the models are fitted on; half of them suggest the
    learned lexicon, the other half fit the label model and the classifier. `lexicon` bounds the
    learned word beginnings, dealt to `voters` voters; `evidence` is the least G statistic of
    one, `favour` how many times as common it is in toxic documents at least, and `support` the
    least share of them that has it, which keeps out the rare words that copies of a document share.
    """

    fit_rows: int = 12_000
    lexicon: int = 800
    voters: int = 16
    evidence: float = 20.0
    favour: float = 20.0
    support: float = 0.02
    threshold: float = 0.3


_PREFIXES = (4, 5, 6, 7, 8, 9, 11, 13)


def _features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and hashes of words and of their beginnings (once a row each for distinct words of a slice)."""
    starts, ends, row_words = words(raw, offsets, letter_gaps(raw))
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(row_words))

    def hashed(begin: np.ndarray, end: np.ndarray, kind: int) -> np.ndarray:
        return mix(word_hashes(raw, begin, end) + U64(kind))

    whole = hashed(starts, ends, 0)
    _, kept = np.unique(mix(whole + rows.astype(U64) * U64(0xD1342543DE82EF95)), return_index=True)
    starts, ends, rows, whole = starts[kept], ends[kept], rows[kept], whole[kept]
    out_rows, out = [rows], [whole]
    for n in _PREFIXES:
        long = ends - starts > n
        out_rows.append(rows[long])
        out.append(hashed(starts[long], starts[long] + n, n))
    return np.concatenate(out_rows), np.concatenate(out)


def _word_hash(word: str) -> int:
    raw = np.frombuffer(word.encode(), np.uint8)
    rows, hashes = _features(raw, np.array([0, len(raw)]))
    return int(hashes[0])


def _patterns(raw: np.ndarray, lowered_gap: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For every row: much upper case, shouting, many marks, very many marks."""

    def share(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)

    upper, shout = share((raw >= 65) & (raw <= 90)), share(raw == 33)
    marks = share((raw > 32) & (raw < 127) & lowered_gap & ~((raw >= 48) & (raw <= 57)))
    return np.stack([upper > 0.4, shout > 0.02, marks > 0.08, marks > 0.2], axis=1)


def _hits(column: pa.Array, lexicon: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For slices of rows: first, last, rows and lexicon places of distinct hits, patterns by row."""
    order = np.argsort(lexicon)
    known = lexicon[order]
    quick = np.zeros(1 << 16, bool)
    quick[(lexicon & U64(0xFFFF)).astype(np.int64)] = True
    lowered = pc.utf8_lower(column)
    for first, last, raw, offsets in slices(lowered):
        rows, hashes = _features(raw, offsets)
        maybe = np.flatnonzero(quick[(hashes & U64(0xFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(known, hashes[maybe]), max(len(known) - 1, 0))
        hit = known[at] == hashes[maybe] if len(known) else np.zeros(0, bool)
        pairs = np.unique(rows[maybe][hit] * max(len(known), 1) + order[at[hit]])
        _, _, plain, plain_offsets = next(slices(column.slice(first, last - first), 1 << 40))
        patterns = _patterns(plain, letter_gaps(plain), plain_offsets)
        yield first, last, pairs // max(len(known), 1), pairs % max(len(known), 1), patterns


def _learned_lexicon(docs: DataFrame, params: ToxicityParams) -> np.ndarray:
    """Hashes of words and beginnings of words that labelled toxic documents favour most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            for first, _, raw, offsets in slices(pc.utf8_lower(batch.column(0))):
                rows, hashes = _features(raw, offsets)
                _, once = np.unique(mix(hashes + rows.astype(U64)), return_index=True)
                found, back = np.unique(hashes[once], return_inverse=True)
                is_toxic = toxic[rows[once] + first] == 1
                yield pa.record_batch(
                    [
                        pa.array(found.view(np.int64)),
                        pa.array(np.bincount(back, is_toxic, len(found)).astype(np.int64)),
                        pa.array(np.bincount(back, ~is_toxic, len(found)).astype(np.int64)),
                    ],
                    ["feature", "toxic", "clean"],
                )

    totals = docs.agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("clean")).first()
    if not totals["toxic"] or not totals["clean"]:
        return np.zeros(0, U64)
    counts = docs.select("text", "toxic").mapInArrow(run, "feature long, toxic long, clean long")
    counts = counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    n_toxic, n_clean = F.lit(float(totals["toxic"])), F.lit(float(totals["clean"]))
    rate = (F.col("toxic") + F.col("clean")) / (n_toxic + n_clean)

    def term(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    statistic = 2 * (
        term(F.col("toxic"), n_toxic * rate)
        + term(F.col("clean"), n_clean * rate)
        + term(n_toxic - F.col("toxic"), n_toxic * (1 - rate))
        + term(n_clean - F.col("clean"), n_clean * (1 - rate))
    )
    favoured = counts.withColumn("g", statistic).where(
        (F.col("g") >= params.evidence)
        & (F.col("toxic") >= params.support * n_toxic)
        & (F.col("toxic") / n_toxic > params.favour * F.col("clean") / n_clean)
    )
    best = favoured.orderBy(F.desc("g"), "feature").limit(params.lexicon).select("feature").collect()
    return np.array([x["feature"] for x in best], np.int64).view(U64)


def label_model(votes: np.ndarray, words: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Posterior probability of toxic for every row of votes, and each voter's accuracy.

    A voter that fires says toxic and is right with its accuracy; one that does not fire abstains,
    and a row without any vote of a word voter (`words`) is voted clean by one voter more. The
    accuracies are fitted to the votes alone by expectation maximisation, begun from the number of
    word voters that agree. A voter's evidence is divided by one plus its correlations with the
    others inside the classes, estimated along with it: voters of one mind do not count twice.
    """
    fired = votes[:, words].sum(axis=1)
    posterior = np.select([fired >= 3, fired == 2, fired == 1], [0.95, 0.8, 0.3], 0.02)
    quiet = np.column_stack([votes, fired == 0]).astype(float)
    accuracy = np.full(quiet.shape[1], 0.5)
    if not len(votes):
        return posterior, accuracy[:-1]
    for _ in range(rounds):
        accuracy = (posterior @ quiet + 0.5) / (quiet.sum(axis=0) + 1.0)
        accuracy = np.clip(accuracy, 0.01, 0.99)
        shared = np.zeros(quiet.shape[1])
        for weight in (posterior, 1 - posterior):
            centred = (quiet - weight @ quiet / max(weight.sum(), 1e-9)) * np.sqrt(weight)[:, None]
            spread = np.sqrt((centred**2).sum(axis=0)) + 1e-9
            shared += weight.mean() * (np.clip(centred.T @ centred / np.outer(spread, spread), 0, 1).sum(axis=1) - 1)
        prior = np.clip(posterior.mean(), 0.01, 0.5)
        known = np.log(prior / (1 - prior))
        lift = np.log(accuracy / (1 - accuracy)) - known  # ratio of a voter's firing rates in the two classes
        odds = known + quiet @ (lift / (1 + np.maximum(shared, 0)))
        posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return posterior, accuracy[:-1]


def fit_linear(rows: np.ndarray, places: np.ndarray, n: int, width: int, target: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Logistic regression on sparse 0/1 features and soft targets; the last weight is the constant."""
    weights = np.zeros(width + 1)
    if not n:
        weights[-1] = -3
        return weights
    mean = float(np.clip(target.mean(), 0.01, 0.99))
    weights[-1] = np.log(mean / (1 - mean))
    speed = np.zeros_like(weights)
    for step in range(rounds):
        odds = weights[-1] + np.bincount(rows, weights[places], n)
        error = 1 / (1 + np.exp(-np.clip(odds, -30, 30))) - target
        slope = np.append(np.bincount(places, error[rows], width), error.sum()) + 0.02 * np.append(weights[:-1], 0)
        speed += slope**2
        weights -= 0.5 * slope / np.sqrt(speed + 1e-9)
    return weights


@dataclass(frozen=True)
class ToxicityModel:
    """Lexicon hashes; weights of them, of the patterns and the constant; accuracies of the voters."""

    lexicon: np.ndarray
    weights: np.ndarray
    accuracy: np.ndarray


def learn(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    """Fit on documents with a label whose crc32(doc_id) leaves a remainder other than 2 by 4.

    Labels suggest the learned lexicon and nothing else: the label model sees votes only, and the
    classifier its posteriors.
    """
    usable = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(crc_remainder("doc_id", 4) != 2)
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(params.fit_rows)
    # At most fit_rows pairs of numbers.
    fit = docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    fit = fit.groupBy("text").agg(F.max("toxic").alias("toxic"))
    half = F.pmod(F.xxhash64("text"), F.lit(2))
    fixed = [[_word_hash(x) for x in line.split()] for line in LEXICONS]
    learned = _learned_lexicon(fit.where(half == 0), params)
    every = np.array([x for line in fixed for x in line], U64)
    voter_of = np.repeat(np.arange(len(fixed)), [len(x) for x in fixed])
    fresh = learned[~np.isin(learned, every)]
    lexicon, where = np.unique(np.concatenate([every, fresh]), return_index=True)
    voter_of = np.concatenate([voter_of, len(fixed) + np.arange(len(fresh)) % params.voters])[where]
    n_voters, width = len(fixed) + params.voters + PATTERNS, len(lexicon) + PATTERNS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, rows, places, patterns in _hits(batch.column(0), lexicon):
                at = [[] for _ in range(last - first)]
                for row, place in zip(rows, places, strict=True):
                    at[row].append(int(place))
                for row, pattern in zip(*np.nonzero(patterns), strict=True):
                    at[row].append(len(lexicon) + int(pattern))
                yield pa.record_batch([pa.array(at, pa.list_(pa.int32()))], ["places"])

    # One short list of lexicon places for each of at most fit_rows documents.
    found = [x["places"] for x in fit.where(half == 1).select("text").mapInArrow(run, "places array<int>").collect()]
    rows = np.repeat(np.arange(len(found)), [len(x) for x in found]).astype(np.int64)
    places = np.array([y for x in found for y in x], np.int64)
    votes = np.zeros((len(found), n_voters))
    voters = np.append(voter_of, len(fixed) + params.voters + np.arange(PATTERNS))
    votes[rows, voters[places] if len(places) else places] = 1
    is_word = np.arange(n_voters) < n_voters - PATTERNS
    posterior, accuracy = label_model(votes, is_word)
    weights = fit_linear(rows, places, len(found), width, posterior)
    if not votes[:, is_word].any():  # nothing to learn from: the fixed lexicons decide
        weights[: len(lexicon)], weights[len(lexicon) : -1], weights[-1] = 2.5, 0, -3
    return ToxicityModel(lexicon, weights, accuracy)


def score(docs: DataFrame, model: ToxicityModel, params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """doc_id, held_out (crc32(doc_id) leaves 2 by 4), score, predicted, n_hits.

    Whole texts are read; null and empty ones score as texts without any hit. Every row is
    returned, repeated ones too; a null doc_id is not held out; other columns are ignored.
    """
    lexicon, weights = model.lexicon, model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(2), "")
            for first, last, rows, places, patterns in _hits(texts, lexicon):
                odds = weights[-1] + np.bincount(rows, weights[places], last - first)
                odds += patterns @ weights[len(lexicon) : -1]
                value = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
                head = batch.slice(first, last - first)
                yield pa.record_batch(
                    [
                        head.column(0),
                        head.column(1),
                        pa.array(value),
                        pa.array((value >= params.threshold).astype(np.int32)),
                        pa.array(np.bincount(rows, minlength=last - first).astype(np.int64)),
                    ],
                    ["doc_id", "held_out", "score", "predicted", "n_hits"],
                )

    held_out = F.coalesce(crc_remainder("doc_id", 4) == 2, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, n_hits long")


def drop_toxic(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """The documents of `docs` that are not predicted toxic (decided by doc_id: all rows of one go together)."""
    bad = score(docs, learn(docs, labels, params), params).where("predicted = 1").select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)
