"""MinHash near-duplicates: banded candidates, sequential Bayesian pruning, exact verification."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.components import components
from clickloom.llm.hashing import U64, mix, slices, window_firsts, window_hashes, word_hashes, words
from clickloom.session import shared_table


@dataclass(frozen=True)
class NearDedupParams:
    """`percent`: least Jaccard similarity of a link, in hundredths.

    A pair at exactly that similarity shares no band with probability (1 - s**rows)**bands, 5e-8
    as set here. `batch` signature values are compared at a time, and a pair is dropped once the
    posterior probability that its similarity reaches the bound falls below `miss`.
    """

    shingle_words: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 4
    batch: int = 32
    miss: float = 1e-9


def least_matches(params: NearDedupParams) -> list[tuple[int, int]]:
    """(values compared, fewest matches to go on): uniform prior, so the posterior is Beta(m+1, n-m+1).

    P(S >= s | m of n) is a binomial tail: P(Bin(n+1, s) <= m).
    """
    s, steps = params.percent / 100, []
    for n in range(params.batch, params.bands * params.rows + 1, params.batch):
        tail, m = 0.0, 0
        while m <= n:
            tail += math.comb(n + 1, m) * s**m * (1 - s) ** (n + 1 - m)
            if tail >= params.miss:
                break
            m += 1
        steps.append((n, m))
    return steps


def _lower(raw: np.ndarray) -> np.ndarray:
    return np.where((raw >= 65) & (raw <= 90), raw | 32, raw).astype(np.uint8)


def _shingles(raw: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every row, in row order, and the first one of each row."""
    raw = _lower(raw)
    starts, ends, row_words = words(raw, offsets)
    hashes = word_hashes(raw, starts, ends)
    counts = np.diff(row_words)
    firsts = window_firsts(row_words, k)
    found, rows = window_hashes(hashes, firsts, k), np.repeat(np.arange(len(counts)), np.maximum(counts - k + 1, 0))
    for size in range(1, k):
        short = np.flatnonzero(counts == size)
        if len(short):
            found = np.concatenate([found, mix(window_hashes(hashes, row_words[short], size) + U64(size))])
            rows = np.concatenate([rows, short])
    _, kept = np.unique(mix(found + rows.astype(U64) * U64(0xD1342543DE82EF95)), return_index=True)
    kept = kept[np.argsort(rows[kept], kind="stable")]
    return found[kept], np.searchsorted(rows[kept], np.arange(len(counts) + 1))


def _set_keys(found: np.ndarray, at: np.ndarray) -> np.ndarray:
    """128-bit fingerprint of every row's shingle set, as two words; zero for an empty one."""
    full = np.flatnonzero(np.diff(at))
    keys = np.zeros((len(at) - 1, 2), U64)
    if len(full):
        keys[full, 0] = np.add.reduceat(mix(found + U64(0x632BE59BD9B4E019)), at[full])
        keys[full, 1] = np.add.reduceat(mix(found ^ U64(0xE220A8397B1DCDAF)), at[full])
    return keys


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
    return (seeds[:n] >> U64(32)).astype(np.uint32) | np.uint32(1), (seeds[n:] >> U64(32)).astype(np.uint32)


def sketches(docs: DataFrame, params: NearDedupParams) -> DataFrame:
    """doc_id, n_shingles, set_key (128-bit fingerprint of the shingle set), signature (uint32 minima)."""
    k, width = params.shingle_words, params.bands * params.rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _permutations(width)
        for batch in batches:
            for first, last, raw, offsets in slices(batch.column(1)):
                found, at = _shingles(raw, offsets, k)
                n = np.diff(at)
                full = np.flatnonzero(n)
                signature = np.zeros((len(n), width), np.uint32)
                keys = _set_keys(found, at)
                if len(full):
                    base, begin = (found >> U64(32)).astype(np.uint32), at[full]
                    for i in range(width):
                        signature[full, i] = np.minimum.reduceat(base * a[i] + b[i], begin)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(first, last - first).cast(pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array([x.tobytes() for x in keys], pa.binary()),
                        pa.array([x.tobytes() for x in signature], pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "set_key", "signature"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, set_key binary, signature binary")


def shingle_sets(docs: DataFrame, params: NearDedupParams) -> DataFrame:
    """set_key, shingles (sorted 64-bit hashes of the full set) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, raw, offsets in slices(batch.column(0)):
                found, at = _shingles(raw, offsets, params.shingle_words)
                sets = [np.sort(found[i:j]).tobytes() for i, j in zip(at[:-1], at[1:], strict=True)]
                keys = [x.tobytes() for x in _set_keys(found, at)]
                yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], ["set_key", "shingles"])

    return docs.select("text").mapInArrow(run, "set_key binary, shingles binary")


def band_rows(classes: DataFrame, params: NearDedupParams) -> DataFrame:
    """id, bucket: one row for every band of every signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                values = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32)
                values = values.reshape(part.num_rows, params.bands, params.rows).astype(U64)
                bucket = np.broadcast_to(np.arange(1, params.bands + 1, dtype=U64), values.shape[:2])
                for i in range(params.rows):
                    bucket = mix(bucket * U64(0x9FB21C651E98DF25) + values[:, :, i])
                ids = np.repeat(part.column(0).to_numpy(zero_copy_only=False), params.bands)
                yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(bucket.ravel().view(np.int64))], ["id", "bucket"])

    return classes.select("id", "signature").mapInArrow(run, "id long, bucket long")


def _survivors(pairs: DataFrame, classes: DataFrame, params: NearDedupParams) -> DataFrame:
    """Pairs (a, b) whose signatures stay likely to be similar enough, batch after batch."""
    steps = least_matches(params)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                part = batch.slice(at, 4000)
                left, right = (
                    np.frombuffer(b"".join(part.column(i).to_pylist()), np.uint32).reshape(part.num_rows, -1) for i in (2, 3)
                )
                alive, matches, done = np.arange(part.num_rows), np.zeros(part.num_rows, np.int64), 0
                for n, least in steps:
                    matches[alive] += (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
                    alive, done = alive[matches[alive] >= least], n
                yield part.select([0, 1]).take(pa.array(alive))

    a = classes.select(F.col("id").alias("a"), F.col("signature").alias("signature_a"))
    b = classes.select(F.col("id").alias("b"), F.col("signature").alias("signature_b"))
    joined = pairs.join(a, "a").join(b, "b").select("a", "b", "signature_a", "signature_b")
    return joined.mapInArrow(run, "a long, b long")


def _links(survivors: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough: 100 * shared >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(j)[i].as_buffer(), U64) for j in (2, 3))
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    continue
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    kept.append(i)
            yield batch.select([0, 1]).take(pa.array(kept, pa.int64()))

    a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("shingles_a"))
    b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("shingles_b"))
    joined = survivors.join(a, "a").join(b, "b").select("a", "b", "shingles_a", "shingles_b")
    return joined.mapInArrow(run, "a long, b long")


def _set_members(sets: DataFrame) -> DataFrame:
    """id, component, n, shingle: one row for every shingle of every set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shingles = np.frombuffer(batch.column(2)[i].as_buffer(), np.int64)
                n = len(shingles)
                own = [pa.array(np.full(n, batch.column(k)[i].as_py())) for k in (0, 1)]
                yield pa.record_batch([*own, pa.array(np.full(n, n, np.int64)), pa.array(shingles)], ["id", "component", "n", "shingle"])

    return sets.select("id", "component", "shingles").mapInArrow(run, "id long, component long, n long, shingle long")


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """shingle, id, component, n, place: the rarest shingles of every set that may be linked to another component.

    All sets are put in one order: shingles that only one component has come first, then by how many
    sets have them. Two sets of similarity s share one of their first n - ceil(s * n) + 1 shingles,
    and a set whose share of shingles known to other components is below s is linked to none.
    """
    members = shared_table(_set_members(sets), "set-members")
    across = members.groupBy("shingle").agg(F.count("*").alias("sets"), F.min("component").alias("least"), F.max("component").alias("most"))
    across = across.where("least < most").select("shingle", "sets")
    known = members.join(across, "shingle").groupBy("id", "component", "n").agg(
        F.sort_array(F.collect_list(F.struct("sets", "shingle"))).alias("known")
    )
    known = known.where(100 * F.size("known") >= percent * F.col("n"))
    wanted = F.col("n") - F.ceil(percent * F.col("n") / 100) + 1 - (F.col("n") - F.size("known"))
    first = F.slice("known", 1, F.greatest(wanted, F.lit(0)).cast("int"))
    rows = known.select("id", "component", "n", F.size("known").alias("shared"), F.posexplode(first).alias("i", "x"))
    return rows.select("x.shingle", "id", "component", "n", (F.col("n") - F.col("shared") + F.col("i") + 1).alias("place"))


def _leader_pairs(rows: DataFrame, leaders: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of every group's `leaders` most typical sets with sets of other components; the leaders' rows.

    The group of a shingle holds at most what follows it in both sets: pairs that this cannot make
    similar enough are left out, since for a linked pair their first common shingle's group keeps it.
    """
    order = "ORDER BY place / n, n, id"
    ranked = rows.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY shingle {order})")).where(F.col("rank") <= leaders)
    ranked = shared_table(ranked.drop("rank"), "leaders")
    other = ranked.withColumnsRenamed({x: f"other_{x}" for x in ("id", "component", "n", "place")})
    common = F.least(F.col("n") - F.col("place"), F.col("other_n") - F.col("other_place")) + 1
    able = (100 + percent) * common >= percent * (F.col("n") + F.col("other_n"))
    met = rows.join(other, "shingle").where((F.col("component") != F.col("other_component")) & able)
    return met.select(F.least("id", "other_id").alias("a"), F.greatest("id", "other_id").alias("b")), ranked.select("shingle", "id")


#: How many times as many leaders a round has as the one before.
_MORE_LEADERS = 16


def _rest(placed: DataFrame, sets: DataFrame, confirmed, percent: int) -> list[DataFrame]:
    """Tables id, component that, one after the other, rename components that further links join.

    Rounds of stars in the groups of rare shingles: leaders are compared with all members of other
    components and then leave their groups, until no two components that meet in a bucket can hold
    another link. Rounds grow by a factor, so a group of any size is done after a few.
    """
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most")
    meeting = placed.join(mixed.select("bucket"), "bucket", "left_semi").select("id", "component").distinct()
    rows = shared_table(prefixes(sets.join(meeting, "id"), percent), "prefixes")
    leaders, renamed = 1, []
    while True:
        after = F.col("n") - F.col("place") + 1
        groups = rows.groupBy("shingle").agg(
            F.min("component").alias("least"), F.max("component").alias("most"), F.min("n").alias("shortest"), F.max(after).alias("reach")
        )
        groups = groups.where("least < most").select("shingle", "shortest", "reach")
        # Who could not be similar enough even to the best partner of the group leaves it.
        able = (100 + percent) * F.least(after, F.col("reach")) >= percent * (F.col("n") + F.col("shortest"))
        rows = shared_table(rows.join(groups, "shingle").where(able).drop("shortest", "reach"), "open-groups")
        if rows.isEmpty():
            return renamed
        pairs, used = _leader_pairs(rows, leaders, percent)
        more = shared_table(confirmed(pairs), "more-links")
        if not more.isEmpty():
            # Links between components, by the members they were found by.
            named = rows.select("id", "component").distinct()
            links = more.join(named.withColumnsRenamed({"id": "a", "component": "c"}), "a")
            links = links.join(named.withColumnsRenamed({"id": "b", "component": "d"}), "b")
            renamed.append(components(links.select(F.col("c").alias("a"), F.col("d").alias("b")).distinct()))
            rows = _rename(rows, renamed[-1])
        rows = rows.join(used, ["shingle", "id"], "left_anti")
        leaders *= _MORE_LEADERS


def _rename(rows: DataFrame, names: DataFrame) -> DataFrame:
    """`rows` with the new names of their components."""
    names = names.select(F.col("id").alias("old"), F.col("component").alias("new")).withColumnRenamed("old", "component")
    return rows.join(names, "component", "left").withColumn("component", F.coalesce("new", "component")).drop("new")


def near_duplicates(docs: DataFrame, params: NearDedupParams = NearDedupParams()) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept.

    Words are runs without white space, A-Z lower-cased. Documents with fewer words than a shingle
    have their whole sequence as one; those without words, or with null text, have an empty set
    and no link. Equal sets form one class with the smallest doc_id; classes are linked, so copies
    cost one row each. Rows repeating a doc_id are each returned and are one document; a null
    doc_id gets a row and links to nothing. Other columns are ignored. Empty in, empty out.

    Classes of equal sets are numbered. Of a bucket, the smallest number is first compared with every
    other member, so a bucket of any size gives one pair a member. Then members of buckets that still
    hold several components are compared further, in groups by their rarest shingles, until no pair of
    them can be a link: no candidate link between components is left out, and pairs inside one never appear.
    """
    marked = shared_table(sketches(docs, params), "sketches")
    full = marked.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = full.groupBy("set_key").agg(F.min("doc_id").alias("doc"), F.first("signature").alias("signature"))
    classes = shared_table(classes.withColumn("id", F.monotonically_increasing_id()), "classes")

    buckets = band_rows(classes, params)
    shared = buckets.groupBy("bucket").agg(F.min("id").alias("leader"), F.max("id").alias("last")).where("leader < last")
    buckets = shared_table(buckets.join(shared.select("bucket", "leader"), "bucket"), "buckets")
    wanted = classes.join(buckets.select("id"), "id", "left_semi").select("id", "set_key", "doc")
    wanted = shared_table(wanted, "wanted-classes")
    # A doc_id may name several rows: only those sets count that a class is to be known by.
    texts = docs.join(wanted.select(F.col("doc").alias("doc_id")), "doc_id", "left_semi")
    sets = shingle_sets(texts, params).join(wanted.select("id", "set_key"), "set_key")
    sets = shared_table(sets.groupBy("id").agg(F.first("shingles").alias("shingles")), "shingle-sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        return _links(_survivors(pairs.distinct(), classes, params), sets, params.percent)

    stars = buckets.where("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b"))
    links = shared_table(confirmed(stars).union(_same_document(full, classes)), "links")
    labels = components(links)

    placed = shared_table(
        buckets.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id")), "placed-buckets"
    )
    found = classes.select("set_key", "id", "doc").join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    for names in _rest(placed, sets, confirmed, params.percent):
        found = _rename(found, names)
    least = found.groupBy("component").agg(F.min("doc").alias("component_id"))
    named = found.join(least, "component").select("set_key", "component_id")
    member = marked.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
    own = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id"))
    component = F.coalesce(own, F.col("doc_id"))
    return member.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def _same_document(full: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes that one doc_id has rows in."""
    several = full.groupBy("doc_id").agg(F.min("set_key").alias("least"), F.max("set_key").alias("most")).where("least < most")
    rows = full.join(several.select("doc_id"), "doc_id", "left_semi").select("doc_id", "set_key").distinct()
    rows = rows.join(classes.select("set_key", "id"), "set_key")
    firsts = rows.groupBy("doc_id").agg(F.min("id").alias("a"))
    return rows.join(firsts, "doc_id").where("a <> id").select("a", F.col("id").alias("b"))


def drop_near_duplicates(docs: DataFrame, params: NearDedupParams = NearDedupParams()) -> DataFrame:
    """The documents of `docs` that stay: those with the smallest doc_id of their component."""
    gone = near_duplicates(docs, params).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
