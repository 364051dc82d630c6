"""Whitening of embeddings by a covariance from squares alone.

The covariance of two dimensions is half of what the variance of their sum has beyond their own variances. So the only
thing to add up over the rows is, for every dimension and every sum of two, the square of the centred value: an integer
that is exact. The entries are integers, and they are centred at the whole part of their mean first; what the mean's
fraction changes is exact integer arithmetic on the sums. Sums are decimals, so their order does not matter.

The matrix has a row and a column per dimension, whatever the number of rows. It is put together and taken apart by
``eigh`` in a task, where Spark gives numpy one thread; in the driver, beside its JVM, threaded routines may wait for ever.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.session import written

#: Entries become floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Beyond this size an entry counts as not finite: no embedding is there, and its square would not be exact.
LARGEST = 2.0**40
#: Rows whose centred values are squared at a time.
ROWS = 4096
EXACT = "decimal(38,0)"


def usable(vectors: DataFrame, entry: str = "embedding") -> DataFrame:
    """Rows whose vector has finite entries alone, as ``x``: an array of longs. The vector's column goes.

    Vectors of another length than most rows have (of lengths as frequent, the greatest) are left out, as are empty ones.
    """
    values = F.col(entry)
    finite = F.forall(values, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < LARGEST))
    x = F.transform(values, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT)
    rows = vectors.where(values.isNotNull() & finite & (F.size(values) > 0)).withColumn("x", x).drop(*{entry} - {"x"})
    lengths = rows.groupBy(F.size("x").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.col("n").desc(), F.col("length").desc()).select("length").first()
    return rows.where(F.size("x") == (usual["length"] if usual else 0))


@dataclass(frozen=True)
class Fit:
    """Number of rows, sums by dimension, and the components with their variances and shares of the whole variance."""

    n: int
    sums: tuple[int, ...]
    weights: np.ndarray
    variances: np.ndarray
    explained: np.ndarray


def _blocks(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[np.ndarray]:
    """The vectors as matrices of a bounded number of rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.column(column).slice(start, ROWS)
            yield part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)


def _exact_squares(z: np.ndarray) -> np.ndarray:
    """Sums of the squares of every column (diagonal) and of every sum of two columns (above), as Python integers."""
    if np.abs(z).max() >= 1 << 24:
        z = z.astype(object)
    found = np.zeros((z.shape[1], z.shape[1]), object)
    for i in range(z.shape[1]):
        found[i, i] = int((z[:, i] ** 2).sum())
        pair = z[:, i, None] + z[:, i + 1 :]
        found[i, i + 1 :] = (pair**2).sum(0).astype(object)
    return found


def _numbers(found: np.ndarray) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in found], pa.decimal128(38, 0))


def squares(rows: DataFrame, centre: list[int]) -> DataFrame:
    """``i``, ``j`` and ``total``: the sum of the squared values, centred at ``centre``, of dimension i (j = i) or of the
    sum of i and j (j > i). A task adds up its rows, so as many numbers leave it as there are pairs."""
    at = np.array(centre, np.int64)
    i, j = np.triu_indices(len(centre))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for x in _blocks(batches):
            total = total + _exact_squares(x - at)
        if not isinstance(total, int):
            arrays = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), _numbers(total[i, j])]
            yield pa.RecordBatch.from_arrays(arrays, ["i", "j", "total"])

    found = rows.select("x").mapInArrow(run, f"i int, j int, total {EXACT}")
    return found.groupBy("i", "j").agg(F.sum("total").cast(EXACT).alias("total"))


def _centred_squares(total: np.ndarray, n: int, rest: list[int]) -> np.ndarray:
    """n times the sums of squares centred at the very mean: ``rest`` is what n times the centre lacks of the sums."""
    r = np.array(rest, object)
    pair = r[:, None] + r[None, :]
    pair[np.diag_indices(len(r))] = r
    return n * total - pair * pair


def _components(n: int, rest: list[int], most: int):
    """From the table of squares, in one task: components, variances and shares, greatest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(rest), len(rest)), object)
        for batch in batches:
            for i, j, value in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                total[i, j] = total[j, i] = int(value)
        whole = _centred_squares(total, n, rest)
        own = np.diag(whole)
        # Twice n squared times the covariance; of a dimension with itself the sum would be twice the value.
        twice = whole - own[:, None] - own[None, :]
        twice[np.diag_indices(len(rest))] = 2 * own
        covariance = np.array([[v / (2 * n * n) for v in row] for row in twice])
        variance, vectors = np.linalg.eigh(covariance)
        trace = sum(own.tolist()) / (n * n)
        keep = [k for k in np.argsort(-variance, kind="stable")[:most] if variance[k] > len(rest) * np.finfo(float).eps * variance.max()]
        columns = [
            pa.array(variance[keep]), pa.array(variance[keep] / trace if trace else variance[keep]),
            pa.array([vectors[:, k] for k in keep], pa.list_(pa.float64())),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["variance", "explained", "weights"])

    return run


def fit(rows: DataFrame, most: int = 8) -> Fit | None:
    """The components of all rows (``x``, as :func:`usable` gives them; a written table); None if there are no rows.

    Components whose variance is not above rounding are left out, since they cannot be whitened: those beyond the rank.
    """
    sums = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(28,0)")).cast(EXACT).alias("total")
    )
    # A row per dimension.
    found = sorted(sums.collect())
    if not found:
        return None
    n, totals = found[0]["n"], [int(r["total"]) for r in found]
    centre, rest = [t // n for t in totals], [t % n for t in totals]
    table = written(squares(rows, centre), "centred-squares")
    # A row per pair of dimensions, in one task.
    parts = table.coalesce(1).mapInArrow(_components(n, rest, most), "variance double, explained double, weights array<double>").collect()
    parts = sorted(parts, key=lambda r: -r["variance"])
    weights = np.array([r["weights"] for r in parts]).reshape(len(parts), len(totals))
    return Fit(n, tuple(totals), weights, np.array([r["variance"] for r in parts]), np.array([r["explained"] for r in parts]))


def whiten(rows: DataFrame, fitted: Fit) -> DataFrame:
    """The rows with ``deviation``, the exact sum over dimensions of (n x - S)^2, and ``whitened``, a number per component.

    A deviation of more than 38 digits is null. Other columns stay as they are, unless they have these names.
    """
    n, centre = fitted.n, np.array([s // fitted.n for s in fitted.sums], np.int64)
    rest = np.array([s % fitted.n for s in fitted.sums], object)
    fraction = rest.astype(float) / n
    scaled = fitted.weights / np.sqrt(fitted.variances)[:, None]

    @F.arrow_udf(f"deviation {EXACT}, whitened array<double>")
    def of(column: pa.Array) -> pa.Array:
        deviations, found = [], []
        for x in _blocks(iter([pa.RecordBatch.from_arrays([column], ["x"])])):
            z = x - centre
            # The sum of (n z - r)^2 from integers that fit, or else from Python's.
            wide = z.astype(object) if n * int(np.abs(z).max(initial=0) + 1) >= 1 << 28 else z
            off = wide * n - (rest if wide.dtype == object else rest.astype(np.int64))
            sums = (off * off).sum(1).tolist()
            deviations += [Decimal(v) if v < 10**38 else None for v in sums]
            found += list(np.einsum("rd,kd->rk", z - fraction, scaled))
        return pa.StructArray.from_arrays(
            [pa.array(deviations, pa.decimal128(38, 0)), pa.array(found, pa.list_(pa.float64()))], ["deviation", "whitened"]
        )

    kept = [c for c in rows.columns if c not in ("deviation", "whitened")]
    both = rows.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), of("x").alias("new"))
    return both.select(*[F.col("row").getField(c).alias(c) for c in kept], "new.deviation", "new.whitened")


def identity_error(white: DataFrame, parts: int) -> float:
    """The largest absolute entry of the whitened columns' covariance less the identity, over all rows.

    Partial sums of a task are rounded to decimals, so that the order in which they come does not matter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = np.zeros(parts), np.zeros((parts, parts))
        n = 0
        for w in _blocks(batches):
            one, two, n = one + w.sum(0), two + np.einsum("rk,rl->kl", w, w), n + len(w)
        values = [Decimal(n), *[Decimal(f"{v:.18f}") for v in [*one, *two.ravel()]]]
        ids = pa.array(range(len(values)), pa.int32())
        yield pa.RecordBatch.from_arrays([ids, pa.array(values, pa.decimal128(38, 18))], ["k", "v"])

    found = white.select("whitened").mapInArrow(run, "k int, v decimal(38,18)").groupBy("k").agg(F.sum("v").alias("v"))
    values = np.array([float(r["v"]) for r in sorted(found.collect())])
    n, mean, second = values[0], values[1 : parts + 1] / values[0], values[parts + 1 :].reshape(parts, parts) / values[0]
    return float(np.abs(second - mean[:, None] * mean[None, :] - np.eye(parts)).max(initial=0.0))


def whitened_rows(vectors: DataFrame, key: Column, entry: str = "embedding", most: int = 8) -> DataFrame:
    """One row per usable vector and component, in the contract's columns; ``key`` gives ``vec_id``.

    Rows that repeat others count and come back as often as given, those without an id too. No rows, or rows that are all
    equal, have no components, and so come back as none. A deviation beyond a long is null.
    """
    rows = written(usable(vectors.select(key.alias("vec_id"), F.col(entry).alias("vector")), "vector"), "usable-vectors")
    fitted = fit(rows, most)
    if fitted is None or not len(fitted.variances):
        return rows.limit(0).select(
            "vec_id", F.lit(0).alias("component"), *[F.lit(0).cast("long").alias(c) for c in ("n", "deviation")],
            *[F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")],
        )
    white = written(whiten(rows, fitted).drop("x"), "whitened")
    error = identity_error(white, len(fitted.variances))
    shares = F.array(*[F.lit(float(v)) for v in fitted.explained])
    return white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(fitted.n).cast("long").alias("n"),
        F.expr("try_cast(deviation as bigint)").alias("deviation"), "whitened",
        shares[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"),
    )
