"""Whitening of embeddings by the exact characteristic polynomial of their integer scatter.

One pass sums the products of all pairs of dimensions exactly. The polynomial of that integer matrix is
found modulo many primes, one Hessenberg reduction each (Spark rows), and put together by Chinese
remainders. All its roots are real, so the sign changes of its shifted coefficients count the roots above
a point; bisection on them isolates each root, to high precision. Every component is then a null vector
of the matrix less its root, by inverse iteration in decimals (Spark rows again).
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Sums are shipped as high and low parts, low below this, since they can pass 38 digits.
_LOW = 10**18


@dataclass(frozen=True)
class WhitenParams:
    """`components` at most; an entry c becomes floor(`scale` * c) + `shift`; roots have `digits` digits."""

    components: int = 32
    scale: int = 64
    shift: int = 1_000_000
    digits: int = 60


@dataclass(frozen=True)
class Whitening:
    """`n` vectors with sums `sums` of their integer entries; row k of `axes` is component k + 1, `roots`
    its eigenvalues of n * n * covariance, `trace` that matrix's trace; rows of another `width` take no part.
    """

    n: int
    width: int
    sums: tuple[int, ...]
    trace: int
    roots: tuple[Decimal, ...]
    axes: np.ndarray


def _integers(vectors: pa.Array, width: int, params: WhitenParams) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose vector has `width` finite entries, and their integers less the shift (int64)."""
    vectors = vectors.cast(pa.list_(pa.float64()))
    sizes = np.array([-1 if x is None else x for x in pa.compute.list_value_length(vectors).to_pylist()], np.int64)
    rows = np.flatnonzero(sizes == width)
    flat = vectors.take(pa.array(rows)).flatten().fill_null(np.nan)
    values = np.floor(params.scale * flat.to_numpy(zero_copy_only=False).reshape(len(rows), width))
    # What is beyond the long range counts as not finite.
    able = (np.abs(values) < 2.0**62).all(axis=1)
    return rows[able], values[able].astype(np.int64)


def _usable(vectors: DataFrame, column: str) -> DataFrame:
    wrong = F.exists(column, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vectors.where(F.col(column).isNotNull() & ~wrong & (F.size(column) > 0))


def _width(vectors: DataFrame, column: str) -> int | None:
    """The commonest length of a vector; of equally common ones the greatest."""
    found = _usable(vectors, column).groupBy(F.size(column).alias("width")).count()
    found = found.orderBy(F.desc("count"), F.desc("width")).first()
    return found["width"] if found else None


def _products(values: np.ndarray) -> np.ndarray:
    """Exact sums of x[i] * x[j] over the rows, as Python integers."""
    width = values.shape[1]
    total = np.zeros((width, width), object)
    most = int(np.abs(values).max(initial=0))
    # Doubles are exact as long as every partial sum stays below 2**53.
    step = (1 << 53) // max(1, most * most)
    if not step:
        wide = values.astype(object)
        return wide.T @ wide
    for first in range(0, len(values), min(step, 1 << 16)):
        part = values[first : first + min(step, 1 << 16)].astype(np.float64)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def scatter(vectors: DataFrame, width: int, params: WhitenParams, column: str = "embedding") -> tuple[int, list[int], list[list[int]]]:
    """n, sums of the integers less the shift, and sums of their products: one row a task before the shuffle.

    What reaches the driver is width * (width + 3) / 2 + 1 numbers, however many vectors there are.
    """
    pairs = [(i, j) for i in range(width) for j in range(i, width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, total = 0, np.zeros(width, object), np.zeros((width, width), object)
        for batch in batches:
            _, values = _integers(batch.column(0), width, params)
            n += len(values)
            for first in range(0, len(values), 1 << 16):
                part = values[first : first + (1 << 16)]
                sums = sums + part.astype(object).sum(axis=0) if int(np.abs(part).max(initial=0)) >> 46 else sums + part.sum(axis=0).astype(object)
            total = total + _products(values)
        numbers = [n, *(int(x) for x in sums), *(int(total[i, j]) for i, j in pairs)]
        kinds = pa.decimal128(38, 0)
        columns = [
            pa.array(range(len(numbers)), pa.int32()),
            pa.array([Decimal(x // _LOW) for x in numbers], kinds),
            pa.array([Decimal(x % _LOW) for x in numbers], kinds),
        ]
        yield pa.record_batch(columns, ["at", "high", "low"])

    parts = vectors.select(column).mapInArrow(run, "at int, high decimal(38,0), low decimal(38,0)")
    found = parts.groupBy("at").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    number = {x["at"]: int(x["high"]) * _LOW + int(x["low"]) for x in found}
    products = [[0] * width for _ in range(width)]
    for k, (i, j) in enumerate(pairs):
        products[i][j] = products[j][i] = number.get(width + 1 + k, 0)
    return number.get(0, 0), [number.get(1 + i, 0) for i in range(width)], products


def primes_below(top: int, n: int) -> list[int]:
    """The `n` greatest primes below `top` (below 2**32, for which these three bases decide)."""
    out, x = [], top - 1 | 1
    while len(out) < n:
        x -= 2
        d, r = x - 1, 0
        while d % 2 == 0:
            d, r = d // 2, r + 1
        if all(pow(a, d, x) in (1, x - 1) or any(pow(a, d << k, x) == x - 1 for k in range(1, r)) for a in (2, 7, 61)):
            out.append(x)
    return out


def polynomial_modulo(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients (constant first) of det(x - matrix) modulo a prime below 2**31, by Hessenberg reduction."""
    n = len(matrix)
    h = np.array([[x % p for x in row] for row in matrix], np.int64)
    for k in range(1, n - 1):
        found = np.flatnonzero(h[k:, k - 1])
        if not len(found):
            continue
        pivot = k + int(found[0])
        if pivot != k:
            h[[k, pivot]] = h[[pivot, k]]
            h[:, [k, pivot]] = h[:, [pivot, k]]
        factors = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - factors[:, None] * h[k] % p) % p
        # The inverse change of basis, column by column modulo p.
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * factors % p).sum(axis=1)) % p
    polys = np.zeros((n + 1, n + 1), np.int64)
    polys[0, 0] = 1
    for k in range(n):
        new = np.roll(polys[k], 1)
        new = (new - h[k, k] * polys[k] % p) % p
        below = 1
        for i in range(k - 1, -1, -1):
            below = below * int(h[i + 1, i]) % p
            if not below:
                break
            new = (new - (int(h[i, k]) * below % p) * polys[i] % p) % p
        polys[k + 1] = new
    return polys[n].tolist()


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Integer coefficients (constant first) of det(x - matrix) of a positive semidefinite integer matrix.

    The k-th elementary symmetric sum of its roots is at most C(n, k) * (trace / k)**k or so; primes are
    taken until their product is beyond twice that. Each prime is a row of a Spark job.
    """
    n, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    bound = max([1] + [math.comb(n, k) * (trace // n + 1) ** k for k in range(1, n + 1)])
    primes = primes_below(1 << 31, (2 * bound).bit_length() // 30 + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in batch.column(0).to_pylist():
                found = polynomial_modulo(matrix, primes[at])
                yield pa.record_batch([pa.array([at]), pa.array([found], pa.list_(pa.int64()))], ["at", "found"])

    frame = spark.range(0, len(primes), 1, min(len(primes), max(1, spark.sparkContext.defaultParallelism)))
    residues = {x["at"]: x["found"] for x in frame.mapInArrow(run, "at long, found array<long>").collect()}
    product = math.prod(primes)
    total = [0] * (n + 1)
    for at, p in enumerate(primes):
        rest = product // p
        weight = rest * pow(rest, -1, p)
        total = [a + weight * b for a, b in zip(total, residues[at], strict=True)]
    return [x - product if x > product // 2 else x for x in (x % product for x in total)]


def _changes(coefficients: list[int]) -> int:
    signs = [x > 0 for x in coefficients if x]
    return sum(a != b for a, b in zip(signs[:-1], signs[1:], strict=True))


def roots_above(poly: list[int], point: int, bits: int) -> int:
    """How many roots are greater than point / 2**bits, with multiplicity: sign changes after the shift.

    By Descartes' rule with equality, which holds as all roots are real.
    """
    n = len(poly) - 1
    # Coefficients of 2**(bits * n) * poly(x / 2**bits), then shifted by `point`.
    shifted = [x << bits * (n - i) for i, x in enumerate(poly)]
    for i in range(n):
        for j in range(n - 1, i - 1, -1):
            shifted[j] += point * shifted[j + 1]
    return _changes(shifted)


def _sign_at(poly: list[int], point: int, bits: int) -> int:
    value, scale = 0, 0
    for x in reversed(poly):
        value = value * point + (x << scale)
        scale += bits
    return (value > 0) - (value < 0)


def real_roots(poly: list[int], most: int, digits: int) -> list[tuple[Decimal, int]]:
    """The greatest positive roots, falling, with multiplicities, until `most` are covered.

    Intervals are cut in half until each holds one root or is relatively narrower than 10**-`digits`
    (then its roots count as one multiple root); single roots are then refined by the polynomial's sign.
    """
    n = len(poly) - 1
    top = 1 << max([1] + [-(-abs(x).bit_length() // (n - i)) + 2 for i, x in enumerate(poly[:-1])])
    precise = int(digits * 3.33) + 8
    found: list[tuple[Decimal, int]] = []
    # (low, high, bits, above low, above high): roots in (low, high] / 2**bits.
    stack = [(0, top, 0, roots_above(poly, 0, 0), 0)]
    covered = 0
    while stack and covered < most:
        low, high, bits, above_low, above_high = stack.pop()
        inside = above_low - above_high
        if not inside:
            continue
        narrow = low > 0 and (high - low) << precise <= low
        if narrow or inside == 1 and low > 0:
            if not narrow:
                low, high, bits = _refine(poly, low, high, bits, precise)
            with decimal.localcontext(prec=digits + 20):
                found.append((Decimal(low + high) / Decimal(2 << bits), inside))
            covered += inside
            continue
        if (low + high) % 2:
            low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) // 2
        above = roots_above(poly, middle, bits)
        stack += [(low, middle, bits, above_low, above), (middle, high, bits, above, above_high)]
    return found


def _refine(poly: list[int], low: int, high: int, bits: int, precise: int) -> tuple[int, int, int]:
    """Halve an interval (low, high] with one simple root until it is relatively narrow."""
    side = _sign_at(poly, high, bits)
    if not side:
        return high, high, bits
    while (high - low) << precise > low:
        if (low + high) % 2:
            low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) // 2
        sign = _sign_at(poly, middle, bits)
        if not sign:
            return middle, middle, bits
        low, high = (low, middle) if sign == side else (middle, high)
    return low, high, bits


def null_vectors(matrix: list[list[int]], root: Decimal, many: int, digits: int) -> list[list[float]]:
    """`many` orthonormal vectors v with matrix v = root v, by inverse iteration in decimals."""
    n = len(matrix)
    with decimal.localcontext(prec=2 * digits + 20):
        least = abs(root) * Decimal(10) ** (-2 * digits)
        a = np.array([[Decimal(x) - (root if i == j else 0) for j, x in enumerate(row)] for i, row in enumerate(matrix)], object)
        order = np.arange(n)
        for k in range(n):
            pivot = k + max(range(n - k), key=lambda i: abs(a[k + i, k]))
            a[[k, pivot]], order[[k, pivot]] = a[[pivot, k]], order[[pivot, k]]
            if abs(a[k, k]) < least:
                a[k, k] = least
            a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
            a[k + 1 :, k + 1 :] = a[k + 1 :, k + 1 :] - np.outer(a[k + 1 :, k], a[k, k + 1 :])
        out: list[np.ndarray] = []
        for start in range(many):
            v = np.array([Decimal((i * (2 * start + 3) + 7 * start) % 11 + 1) for i in range(n)], object)
            for _ in range(3):
                v = _without(v, out)
                v = v[order]
                for i in range(n):
                    v[i] = v[i] - (a[i, :i] * v[:i]).sum()
                for i in range(n - 1, -1, -1):
                    v[i] = (v[i] - (a[i, i + 1 :] * v[i + 1 :]).sum()) / a[i, i]
                v = _without(v, out)
                v = v / (v * v).sum().sqrt()
            out.append(v)
        return [[float(x) for x in v] for v in out]


def _without(v: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for other in others:
        v = v - (v * other).sum() * other
    return v


def fit(vectors: DataFrame, params: WhitenParams = WhitenParams(), column: str = "embedding") -> Whitening | None:
    """The components of all usable vectors; None if there is no vector or no spread."""
    spark, width = vectors.sparkSession, _width(vectors, column)
    if width is None:
        return None
    n, sums, products = scatter(vectors, width, params, column)
    # n * n * covariance, which a common shift of the entries doesn't change.
    matrix = [[n * products[i][j] - sums[i] * sums[j] for j in range(width)] for i in range(width)]
    trace = sum(matrix[i][i] for i in range(width))
    if not trace:
        return None
    roots = real_roots(characteristic_polynomial(spark, matrix), params.components, params.digits)
    where = [(str(root), many) for root, many in roots]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in batch.column(0).to_pylist():
                axes = null_vectors(matrix, Decimal(where[at][0]), where[at][1], params.digits)
                yield pa.record_batch([pa.array([at]), pa.array([axes], pa.list_(pa.list_(pa.float64())))], ["at", "axes"])

    frame = spark.range(0, len(where), 1, len(where)).mapInArrow(run, "at long, axes array<array<double>>")
    axes = {x["at"]: x["axes"] for x in frame.collect()}
    all_axes = np.array([axis for at in range(len(where)) for axis in axes[at]])[: params.components]
    every = tuple(root for root, many in roots for _ in range(many))[: params.components]
    return Whitening(n, width, tuple(s + n * params.shift for s in sums), trace, every, all_axes)


def _project(values: np.ndarray, model: Whitening, params: WhitenParams) -> tuple[np.ndarray, list[int | None]]:
    """Whitened values (rows x components) and deviations of integers less the shift."""
    centre = [s - model.n * params.shift for s in model.sums]
    reach = model.n * int(np.abs(values).max(initial=0)) + max(abs(x) for x in centre)
    if reach * reach * model.width < 1 << 63:
        moved = values * model.n - np.array(centre, np.int64)
        deviations = (moved * moved).sum(axis=1).tolist()
        spread = moved / model.n
    else:
        wide = values.astype(object) * model.n - np.array(centre, object)
        deviations = [x if x < 1 << 63 else None for x in (wide * wide).sum(axis=1)]
        spread = np.array([[x / model.n for x in row] for row in wide], np.float64).reshape(values.shape)
    scale = np.array([float(Decimal(model.n) / root.sqrt()) for root in model.roots])
    return spread @ model.axes.T * scale, deviations


def identity_error(vectors: DataFrame, model: Whitening, params: WhitenParams = WhitenParams(), column: str = "embedding") -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity.

    Every task centres its own rows; the tasks' sums are then put together about the common mean.
    """
    k = len(model.roots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, spread = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            _, values = _integers(batch.column(0), model.width, params)
            if not len(values):
                continue
            whitened, _ = _project(values, model, params)
            m, own = len(values), whitened.mean(axis=0)
            centred, apart = whitened - own, own - mean
            spread += centred.T @ centred + np.outer(apart, apart) * (n * m / (n + m))
            mean, n = mean + apart * (m / (n + m)), n + m
        if n:
            yield pa.record_batch([pa.array([n]), pa.array([mean.tolist()]), pa.array([spread.ravel().tolist()])], ["n", "mean", "spread"])

    parts = vectors.select(column).mapInArrow(run, "n long, mean array<double>, spread array<double>")
    # A row for every task: about 8 KB each, summed by Spark before anything reaches the driver.
    means = parts.select("n", F.posexplode("mean")).groupBy("pos").agg((F.sum(F.col("n") * F.col("col")) / F.sum("n")).alias("mean"))
    mean = {x["pos"]: x["mean"] for x in means.collect()}
    middle = F.array(*(F.lit(mean[i]) for i in range(k)))
    i, j = F.floor(F.col("pos") / k).cast("int"), F.pmod("pos", F.lit(k)).cast("int")
    about = F.col("n") * (F.get("mean", i) - F.get(middle, i)) * (F.get("mean", j) - F.get(middle, j))
    sums = parts.select("n", "mean", F.posexplode("spread")).groupBy("pos").agg((F.sum(F.col("col") + about) / F.sum("n")).alias("entry"))
    apart = F.abs(F.col("entry") - F.when(F.pmod("pos", F.lit(k + 1)) == 0, 1.0).otherwise(0.0))
    return sums.agg(F.max(apart).alias("error")).first()["error"]


_WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, params: WhitenParams = WhitenParams(), column: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row for every usable vector and component.

    Vectors that are null, empty or hold null, infinite or missing entries (or such as leave the long
    range) are left out, and those of another length than most. A component of no spread cannot be
    whitened and is left out; equal eigenvalues get any orthonormal vectors. A deviation beyond the long
    range is null. Rows repeating a vec_id count each, a null vec_id stays null, other columns are
    ignored. A table without usable vectors or without spread gives no rows.
    """
    model = fit(vectors, params, column)
    if model is None:
        return vectors.sparkSession.createDataFrame([], _WHITENED)
    error = identity_error(vectors, model, params, column)
    with decimal.localcontext(prec=50):
        explained = np.array([float(root / model.trace) for root in model.roots])
    k = len(model.roots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                part = batch.slice(first, 4096)
                rows, values = _integers(part.column(1), model.width, params)
                whitened, deviations = _project(values, model, params)
                columns = [
                    part.column(0).take(pa.array(np.repeat(rows, k))),
                    pa.array(np.tile(np.arange(1, k + 1), len(rows)), pa.int32()),
                    pa.array(np.full(len(rows) * k, model.n), pa.int64()),
                    pa.array(deviations, pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), k))),
                    pa.array(whitened.ravel()),
                    pa.array(np.tile(explained, len(rows))),
                    pa.array(np.full(len(rows) * k, error)),
                ]
                yield pa.record_batch(columns, [x.split()[0] for x in _WHITENED.split(", ")])

    return vectors.select(F.col("vec_id").cast("long"), column).mapInArrow(run, _WHITENED)
