"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation.

The entries c of a vector become whole numbers x = floor(64 * c) + 1000000, so that sums are exact.
The rows, centred, are the matrix X. Alternating products X v and X'u build the bidiagonal matrix B with
X V = U B; its singular vectors turn V into the components, its singular values squared over n
are their variances. Both bases are orthogonalised against all of their earlier vectors in every step.

U has as many entries as there are rows, but each of its columns is X times a vector as long as a
row. That vector is what is kept; tasks make their part of U from their rows. So a step is one pass
over the rows, and what comes back is as long as a row.

A row counts if its vector has no null and no non-finite entry and as many entries as most vectors (the larger
number if two are as frequent); a null or empty vector never does. Repeated rows and ids count each. Components without
variance are left out, so equal vectors, a single one or an empty table give no rows. A deviation beyond 64 bits is null.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.storage import importable, stored, summed

SCALE, OFFSET = 64, 1_000_000
# Relative size below which a norm is rounding error.
NOISE = 1e-12


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a list column without nulls, all of the same length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def whole_numbers(vectors: DataFrame) -> tuple[DataFrame, int]:
    """vec_id and x of the rows that count, and the length of x."""
    entries = F.col("embedding").cast("array<double>")
    finite = ~F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.select(F.col("vec_id"), entries.alias("entries")).filter((F.size(entries) > 0) & finite)
    sizes = rows.groupBy(F.size("entries").alias("width")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("width")).first()
    width = most["width"] if most else 0
    x = F.transform("entries", lambda c: F.floor(c * SCALE).cast("long") + OFFSET)
    return rows.filter(F.size("entries") == width).select("vec_id", x.alias("x")), width


class Centred:
    """The stored rows, their number, sums and centred products."""

    def __init__(self, rows: DataFrame, width: int) -> None:
        self.rows, self.width = rows, width
        both = summed(
            rows, width + 1, lambda b: np.append(matrix(b.column("x"), width).sum(axis=0), b.num_rows), "long"
        )
        self.n, self.sums = int(both[-1]), both[:-1]

    def part(self) -> Callable[[pa.RecordBatch], np.ndarray]:
        n, sums, width = self.n, self.sums, self.width

        def centred(batch: pa.RecordBatch) -> np.ndarray:
            # n * x - S needs no rounding before the division.
            return (matrix(batch.column("x"), width) * n - sums) / n

        return centred

    def products(self, v: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """With r = X @ v and the columns u of X @ before: X'r, the products u'r and r'r."""
        centred, width, k = self.part(), self.width, before.shape[1]

        def own(batch: pa.RecordBatch) -> np.ndarray:
            x = centred(batch)
            r = x @ v
            return np.concatenate((x.T @ r, (x @ before).T @ r, [r @ r]))

        found = summed(self.rows, width + k + 1, own)
        return found[:width], found[width:-1], float(found[-1])


def orthogonal(v: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """`v` without its parts along the columns of `basis`; twice is enough."""
    for _ in range(2):
        v = v - basis @ (basis.T @ v)
    return v


def components(rows: Centred, count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit components as columns and their variances, largest first; at most `count` with a variance above 0.

    A start vector meets one direction of each distinct variance. When its directions are used up the
    next one is drawn at right angles to all before it, so equal variances are found as often as they occur.
    The steps end when the wanted values and their vectors have converged, at the latest with the length of a row.
    """
    random = np.random.default_rng(seed)
    d = rows.width
    right = np.zeros((d, 0))  # v: orthonormal directions of rows
    makes = np.zeros((d, 0))  # X @ makes = u, orthonormal columns over rows
    images = np.zeros((d, 0))  # X'u
    b = np.zeros((0, 0))
    scale, beta, v = 0.0, 0.0, random.standard_normal(d)
    v /= np.linalg.norm(v)
    for step in range(d):
        # r = X v - beta u, and X'r, in one pass.
        way = v - beta * makes[:, -1] if beta else v
        back, along, square = rows.products(way, makes)
        scale = max(scale, np.sqrt(square))
        # Orthogonal to all earlier u; what is taken off goes into B, which is bidiagonal up to rounding.
        alpha = np.sqrt(max(0.0, square - along @ along))
        b = np.pad(b, ((0, 1), (0, 1)))
        b[:step, step] = along
        if beta:
            b[step - 1, step] += beta
        right = np.column_stack((right, v))
        if alpha > NOISE * scale and alpha > 0:
            b[step, step] = alpha
            make, image = (way - makes @ along) / alpha, (back - images @ along) / alpha
        else:
            make, image = np.zeros(d), np.zeros(d)
        makes, images = np.column_stack((makes, make)), np.column_stack((images, image))
        rest = orthogonal(image, right)
        beta = float(np.linalg.norm(rest))
        fresh = beta <= 1e-9 * scale
        if not fresh and step + 1 >= min(count, d) and step % 8 == 7:
            left, values, _ = np.linalg.svd(b)
            # The residual of each triplet; a repeated variance shows only when directions run out.
            if (beta * np.abs(left[-1, :count]) <= NOISE * values[:count]).all():
                break
        if fresh:
            rest, beta = orthogonal(random.standard_normal(d), right), 0.0
        if np.linalg.norm(rest) <= 1e-9 * max(beta, 1.0) or step + 1 == d:
            break
        v = orthogonal(rest / np.linalg.norm(rest), right)
        v /= np.linalg.norm(v)
    _, values, turn = np.linalg.svd(b)
    kept = min(count, int((values > 1e-10 * max(scale, 1e-300)).sum()))
    return (right @ turn.T)[:, :kept], values[:kept] ** 2 / max(1, rows.n)


def whitened(spark: SparkSession, vectors: DataFrame, count: int = 32, seed: int = 1) -> DataFrame:
    """One row per vector that counts: vec_id, n, deviation, whitened and explained (arrays over components),
    and identity_error, the largest entry of the whitened vectors' covariance minus the identity.

    Reads `vec_id` and `embedding`.
    """
    importable(spark)
    x, width = whole_numbers(vectors)
    rows = Centred(stored(spark, x, "whitening"), width)
    if rows.n and width:
        axes, variances = components(rows, count, seed)
    else:
        axes, variances = np.zeros((width, 0)), np.zeros(0)
    centred, k = rows.part(), len(variances)
    turned = axes / np.sqrt(variances)

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        z = centred(batch)
        return np.append((z @ turned).T @ (z @ turned), (z * z).sum())

    found = summed(rows.rows, k * k + 1, moments) if k else np.ones(1)
    error = float(np.abs(found[:-1].reshape(k, k) / max(1, rows.n) - np.eye(k)).max(initial=0.0))
    explained = variances * rows.n / max(found[-1], 1e-300)
    n, sums = rows.n, rows.sums

    def project(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            far = matrix(batch.column("x"), width) * n - sums
            size = np.square(far.astype(float)).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    pa.array(np.full(batch.num_rows, n)),
                    pa.array((far * far).sum(axis=1), mask=size > 9.2e18),
                    pa.array(list(far / n @ turned), pa.list_(pa.float64())),
                    pa.array([explained] * batch.num_rows, pa.list_(pa.float64())),
                    pa.array(np.full(batch.num_rows, error)),
                ],
                names=["vec_id", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    kind = rows.rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    return rows.rows.mapInArrow(project, schema)


def by_component(rows: DataFrame) -> DataFrame:
    """The rows of `whitened`, one per component, numbered from 1."""
    each = F.arrays_zip("whitened", "explained")
    long = rows.select("vec_id", "n", "deviation", "identity_error", F.posexplode(each).alias("place", "entry"))
    return long.select(
        "vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", F.col("entry")["whitened"].alias("whitened"),
        F.col("entry")["explained"].alias("explained"), "identity_error",
    )
