"""Whitening of embeddings by a polarisation covariance.

Entries become whole numbers x, and the fit list holds each distinct x vector once: n vectors with sums S per dimension.
With y = n * x - S, the centred values times n, the tasks add up two kinds of exact squares: y_i ** 2 for every dimension
and (y_i + y_j) ** 2 for every pair. A cross-covariance is half the difference between the variance of a pair sum and
the two variances, so no product of two dimensions is ever taken and nothing is rounded before the d x d matrix is
assembled. Its eigenvectors are the components; whitened values are projections over the root of the eigenvalue.

What reaches the driver has d or d * d numbers and n, whatever the rows; a task holds one block of vectors and its sums.
Equal vectors are united map-side before they are shuffled, so a vector that fills a third of the rows costs no more.

Rows whose vector is null or holds null, NaN or an infinity are dropped. Repeated rows and null ids stay, each with its
own result. Entries beyond 64 bits take the nearest 64-bit number. Shorter vectors count as followed by zeros up to the
longest. Components without variance have no whitened values and are left out, so constant vectors, a single distinct
vector, empty vectors and an empty table give no rows. Other columns take no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import stored

#: Whole numbers per unit of an entry; components returned.
STEPS, COMPONENTS = 256, 4
#: Entries of a block of vectors that a task works on at once.
BLOCK = 1 << 18
#: Rows of a block: sums of squares of 24-bit halves stay within 64 bits.
MOST_ROWS = 1 << 14
#: Eigenvalues below this share of the trace are rounding errors of a dimension without variance.
LEAST_SHARE = 1e-12
#: Sums travel as high * LIMB + low, which decimals of 38 digits hold for any table.
LIMB = 10 ** 30
_HALF = 24
_LIMBS = "i int, j int, high decimal(38,0), low decimal(38,0)"


def whole(embedding: Column) -> Column:
    """The vector in whole numbers."""
    return F.transform(embedding, lambda c: F.floor(c.cast("double") * STEPS))


def usable(embedding: Column) -> Column:
    """Neither null nor with an entry that is null, NaN or infinite."""
    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))

    return embedding.isNotNull() & F.coalesce(F.forall(embedding, lambda c: finite(c.cast("double"))), F.lit(False))


def _blocks(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of a batch with their vectors as a matrix of whole numbers."""
    rows = max(1, min(BLOCK // max(width, 1), MOST_ROWS))
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            lists = part.column("__x")
            sizes = np.diff(lists.offsets.to_numpy())
            out = np.zeros((part.num_rows, width), np.int64)
            out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
            yield part, out


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, in 64 bits where every later sum of two fits, else in whole numbers of any size."""
    most = max((int(np.max(x)), -int(np.min(x))), default=0) if x.size else 0
    if 2 * (most * n + max(map(abs, sums), default=0)) < 1 << 47:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _squares(z: np.ndarray) -> list[int]:
    """The exact sum of squares of every column. 64-bit entries are below 2 ** 47 and are squared in two halves."""
    if z.dtype == object:
        return [int(s) for s in (z * z).sum(axis=0)]
    high = z >> _HALF
    low = z - (high << _HALF)
    tops, cross, rest = ((a * b).sum(axis=0) for a, b in ((high, high), (high, low), (low, low)))
    return [(int(t) << 2 * _HALF) + (int(c) << _HALF + 1) + int(r) for t, c, r in zip(tops, cross, rest, strict=True)]


def _limbs(totals: dict[tuple[int, int], int]) -> pa.RecordBatch:
    from decimal import Context, Decimal

    exact = Context(prec=80)
    keys = list(totals)
    split = [divmod(totals[k], LIMB) for k in keys]
    kind = pa.decimal128(38, 0)
    return pa.record_batch({
        "i": pa.array([k[0] for k in keys], pa.int32()), "j": pa.array([k[1] for k in keys], pa.int32()),
        "high": pa.array([exact.create_decimal(Decimal(h)) for h, _ in split], kind),
        "low": pa.array([exact.create_decimal(Decimal(w)) for _, w in split], kind)})


def _total(parts: DataFrame) -> dict[tuple[int, int], int]:
    """Partial sums of all tasks, united by Spark: one number per dimension or pair."""
    united = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    return {(r.i, r.j): int(r.high) * LIMB + int(r.low) for r in united.collect()}


def fit_list(vectors: DataFrame) -> DataFrame:
    """__x: each distinct vector of the usable ones once, written to the shared folder."""
    return stored(vectors.select("__x").distinct(), "whitening_fit")


def dimension_sums(fit: DataFrame, width: int) -> list[int]:
    def run(batches):
        totals: dict[tuple[int, int], int] = {}
        for _, x in _blocks(batches, width):
            high = x >> 32
            low = x - (high << 32)
            for i, (h, w) in enumerate(zip(high.sum(axis=0), low.sum(axis=0), strict=True)):
                totals[i, i] = totals.get((i, i), 0) + (int(h) << 32) + int(w)
        if totals:
            yield _limbs(totals)

    found = _total(fit.mapInArrow(run, _LIMBS))
    return [found[i, i] for i in range(width)]


def polarised(fit: DataFrame, n: int, sums: list[int]) -> dict[tuple[int, int], int]:
    """(i, i): sum of y_i ** 2; (i, j): sum of (y_i + y_j) ** 2, over the fit list and exact."""
    width = len(sums)

    def run(batches):
        totals: dict[tuple[int, int], int] = {}
        for _, x in _blocks(batches, width):
            y = _centred(x, n, sums)
            for i, square in enumerate(_squares(y)):
                totals[i, i] = totals.get((i, i), 0) + square
            for i in range(width - 1):
                for j, square in enumerate(_squares(y[:, i + 1:] + y[:, i, None]), i + 1):
                    totals[i, j] = totals.get((i, j), 0) + square
        if totals:
            yield _limbs(totals)

    return _total(fit.mapInArrow(run, _LIMBS))


def covariance(squares: dict[tuple[int, int], int], n: int, width: int) -> np.ndarray:
    """The covariance of x with divisor n; every entry is the double nearest to the exact value."""
    out = np.empty((width, width))
    for i in range(width):
        out[i, i] = float(Fraction(squares[i, i], n ** 3))
        for j in range(i + 1, width):
            out[i, j] = out[j, i] = float(Fraction(squares[i, j] - squares[i, i] - squares[j, j], 2 * n ** 3))
    return out


def components(cov: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """Falling eigenvalues, their unit vectors as columns, and the trace. A vector's largest entry is positive."""
    trace = float(np.trace(cov))
    if not trace > 0:
        return np.empty(0), np.empty((len(cov), 0)), trace
    values, vectors = np.linalg.eigh(cov)
    order = [k for k in np.argsort(-values, kind="stable")[:most] if values[k] > LEAST_SHARE * trace]
    vectors = vectors[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), range(len(order))])
    return values[order], vectors * signs, trace


def _whitened(x: np.ndarray, n: int, sums: list[int], projection: np.ndarray) -> np.ndarray:
    return (_centred(x, n, sums).astype(np.float64) / n) @ projection


def identity_error(fit: DataFrame, n: int, sums: list[int], projection: np.ndarray) -> float:
    """Largest entry of the whitened values' covariance minus the identity: means first, then centred products."""
    width, k = projection.shape

    def added(measure, size: int) -> np.ndarray:
        def run(batches):
            total = np.zeros(size)
            for _, x in _blocks(batches, width):
                total += measure(_whitened(x, n, sums, projection))
            yield pa.record_batch({"i": pa.array(range(size), pa.int32()), "value": total})

        sums_of = fit.mapInArrow(run, "i int, value double").groupBy("i").agg(F.sum("value").alias("value")).collect()
        out = np.zeros(size)
        for r in sums_of:
            out[r.i] = r.value
        return out / n

    means = added(lambda w: w.sum(axis=0), k)
    products = added(lambda w: ((w - means).T @ (w - means)).ravel(), k * k)
    return float(np.abs(products.reshape(k, k) - np.eye(k)).max())


_RESULT = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whitened(vectors: DataFrame, embedding: str = "embedding", key: str = "vec_id", most: int = COMPONENTS) -> DataFrame:
    """key, component, n, deviation, whitened, explained, identity_error: a row per usable vector and component.

    deviation is exact as long as it has no more than 38 digits, and null beyond.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, {_RESULT}"
    rows = vectors.where(usable(F.col(embedding))).select(F.col(key), whole(F.col(embedding)).alias("__x"))
    fit = fit_list(rows)
    n, width = fit.agg(F.count("*"), F.coalesce(F.max(F.size("__x")), F.lit(0))).first()
    if not n or not width:
        return spark.createDataFrame([], schema)
    sums = dimension_sums(fit, width)
    values, directions, trace = components(covariance(polarised(fit, n, sums), n, width), most)
    if not len(values):
        return spark.createDataFrame([], schema)
    projection = directions / np.sqrt(values)
    explained, error = values / trace, identity_error(fit, n, sums, projection)
    k = len(values)

    def run(batches):
        from decimal import Decimal

        for part, x in _blocks(batches, width):
            y = _centred(x, n, sums)
            rows = part.num_rows
            spread = [Decimal(d) if d < 10 ** 38 else None for d in _squares(y.T)]
            each = np.repeat(np.arange(rows), k)
            yield pa.record_batch({
                key: part.column(key).take(pa.array(each)), "component": pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                "n": pa.array(np.full(rows * k, n), pa.int64()), "deviation": pa.array(spread, pa.decimal128(38, 0)).take(pa.array(each)),
                "whitened": ((y.astype(np.float64) / n) @ projection).ravel(), "explained": np.tile(explained, rows),
                "identity_error": np.full(rows * k, error)})

    return rows.mapInArrow(run, schema)


def digest(vectors: DataFrame) -> DataFrame:
    """The rows of `whitened` with deviation as long; null where it takes more than 64 bits."""
    return whitened(vectors).withColumn("deviation", F.expr("try_cast(deviation AS long)"))
