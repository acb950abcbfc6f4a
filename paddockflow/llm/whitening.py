"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Every entry c becomes the integer x = floor(scale * c); the fit list is each distinct vector of
them once, written as blocks of rows to the shared folder, and X stands for the fit list with
its mean subtracted.

One step multiplies X by a right vector v and the transposed X by the result, both block by
block, and brings back sums alone.  Left vectors are as long as the corpus and never stored:
each is X times a short vector w, so a task makes its rows of all of them anew from its blocks
and gives their inner products with X v.  Those re-orthogonalise the new left vector against all
earlier ones; right vectors are short and re-orthogonalised on the driver.  The bidiagonal
matrix of the steps has the singular values of X; its singular vectors turn the right vectors
into components, and singular value / sqrt(n) is the deviation along each.

Where a Krylov space is used up (repeated eigenvalues, less than full rank), the next step starts
from a fresh direction.  The run ends once the wanted components stand, also after one such
fresh start, and after as many steps as there are dimensions at the latest.

Left out are rows whose vector is null or empty, holds null or non-finite entries, or has another
length than most vectors have (the shorter one among equally frequent).  Repeated vectors count
once in the fit list, and each of their rows is returned; null ids are kept.  An empty table, or
one with a single distinct vector, has no components and gives no rows; fewer dimensions or less
rank give fewer components.  Exact sums need entries below 2 ** 47 / scale; larger ones, and
deviations beyond a LONG, raise an error.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddockflow import scratch

BLOCK_ROWS = 4096
_LARGEST = 1 << 47
_SEED = 12


def scaled(rows: DataFrame, id_column: str, vector: str, scale: int) -> DataFrame:
    """(id, x ARRAY<LONG>) of the rows whose vector is whole."""

    def sound(entry: Column) -> Column:
        value = entry.cast("double")
        return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))

    return rows.where((F.size(vector) > 0) & F.forall(vector, sound)).select(
        F.col(id_column).alias("id"),
        F.transform(vector, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("long")).alias("x"),
    )


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    if values.size and max(int(values.max()), -int(values.min())) >= _LARGEST:
        raise ValueError(f"an entry of {_LARGEST} or more after scaling")
    return values


def fit_blocks(vectors: DataFrame, dims: int) -> DataFrame:
    """Distinct vectors as written blocks: rows, bytes of integers, and sums by dimension."""

    def run(batches):
        for batch in batches:
            whole = _matrix(batch.column("x"), dims)
            for low in range(0, len(whole), BLOCK_ROWS):
                block = whole[low : low + BLOCK_ROWS]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([len(block)], pa.int64()), pa.array([block.astype("<i8").tobytes()], pa.binary()),
                        pa.array([block.sum(axis=0)], pa.list_(pa.int64())),
                    ],
                    names=["n", "block", "sums"],
                )

    distinct = vectors.select("x").distinct()
    return scratch.saved(distinct.mapInArrow(run, "n long, block binary, sums array<long>"), "whitening")


@dataclass(frozen=True)
class FitList:
    """Blocks of the fit list, its size and its exact sums by dimension."""

    blocks: DataFrame
    n: int
    sums: tuple[int, ...]

    @property
    def dims(self) -> int:
        return len(self.sums)

    def total(self, of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
        """Sum over all blocks of ``of`` (centred rows -> ``size`` numbers).

        Each task adds up its blocks, and one last task the sums of the tasks.
        """
        mean, dims = np.array([s / self.n for s in self.sums]), self.dims

        def partial(batches):
            found = np.zeros(size)
            for batch in batches:
                for block in batch.column("block"):
                    whole = np.frombuffer(block.as_buffer(), "<i8").reshape(-1, dims)
                    found += of(whole - mean)
            yield pa.RecordBatch.from_arrays([pa.array([found], pa.list_(pa.float64()))], names=["sums"])

        def whole(batches):
            found = np.zeros(size)
            for batch in batches:
                found += batch.column("sums").flatten().to_numpy().reshape(-1, size).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array([found], pa.list_(pa.float64()))], names=["sums"])

        parts = self.blocks.select("block").mapInArrow(partial, "sums array<double>")
        # collected, since a limit would end the Python worker each time
        ((found,),) = parts.repartition(1).mapInArrow(whole, "sums array<double>").collect()
        return np.array(found)


def fit_list(vectors: DataFrame) -> FitList | None:
    """The fit list of the commonest length; None without any vector."""
    commonest = vectors.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    if commonest is None:
        return None
    blocks = fit_blocks(vectors.where(F.size("x") == commonest["dims"]), commonest["dims"])
    by_dimension = (
        blocks.select("n", F.posexplode("sums").alias("at", "part")).groupBy("at")
        .agg(F.sum("n").alias("n"), F.sum("part").alias("part")).orderBy("at").collect()
    )
    return FitList(blocks, by_dimension[0]["n"], tuple(r["part"] for r in by_dimension))


def _apart(vector: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The vector without its part in the span of the basis; twice, which is enough."""
    for _ in range(2):
        vector = vector - basis @ (basis.T @ vector)
    return vector


def bidiagonalise(fit: FitList, wanted: int, tolerance: float = 1e-14) -> tuple[np.ndarray, np.ndarray, float]:
    """(singular values, right singular vectors as columns, squared norm) of the centred fit list.

    The first ``wanted`` have converged: what is left of them is below ``tolerance`` of the norm.
    """
    dims = fit.dims
    draw = np.random.default_rng(_SEED)
    right, short, images = np.zeros((dims, 0)), np.zeros((dims, 0)), np.zeros((dims, 0))
    alphas, betas = [], []
    v, beta, norm, settled = draw.normal(size=dims), 0.0, 0.0, None
    v /= np.linalg.norm(v)
    while True:
        step = right.shape[1]
        w_all, b = short, beta

        def products(rows):
            left = rows @ w_all
            p = rows @ v - (b * left[:, -1] if step and b else 0.0)
            inner = np.zeros(dims)
            inner[:step] = left.T @ p
            return np.concatenate([inner, rows.T @ p, [p @ p, np.einsum("ij,ij->", rows, rows)]])

        sums = fit.total(products, 2 * dims + 2)
        inner, image, square, total = sums[:step], sums[dims : 2 * dims], sums[-2], sums[-1]
        norm = np.sqrt(total)
        if not norm:
            return np.zeros(0), np.zeros((dims, 0)), 0.0
        alpha = np.sqrt(max(0.0, square - inner @ inner))
        if alpha <= tolerance * norm:
            alpha, w, z = 0.0, np.zeros(dims), np.zeros(dims)  # X v lies in the span of the left vectors
        else:
            w = (v - (b * short[:, -1] if step and b else 0.0) - short @ inner) / alpha
            z = (image - images @ inner) / alpha
        right, short, images = (np.column_stack([m, c]) for m, c in ((right, v), (short, w), (images, z)))
        alphas.append(alpha)
        rest = _apart(z - alpha * v, right)
        beta = float(np.linalg.norm(rest))
        bidiagonal = np.diag(alphas) + np.diag(betas, 1)
        left, values, turned = np.linalg.svd(bidiagonal)
        k = step + 1
        found = min(wanted, k)
        done = k >= wanted and (beta * np.abs(left[-1, :found]) <= tolerance * norm).all()
        if k == dims or done and settled is not None and np.allclose(values[:found], settled, rtol=1e-12, atol=tolerance * norm):
            return values, right @ turned.T, float(total)
        if done or beta <= tolerance * norm:
            settled = values[:found] if done else settled
            beta, rest = 0.0, _apart(draw.normal(size=dims), right)
            rest /= np.linalg.norm(rest)
            rest = _apart(rest, right)
            v = rest / np.linalg.norm(rest)
        else:
            v = rest / beta
        betas.append(beta)


WHITENED = (
    "component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whitened(
    rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", scale: int = 256, components: int = 4
) -> DataFrame:
    """One row for each sound vector and component, numbered from 1 by falling eigenvalue.

    ``n``: size of the fit list; ``deviation``: the exact sum over dimensions of
    (n * x - sum)^2; ``whitened``: the centred vector along the component, in deviations;
    ``explained``: the component's share of the variance; ``identity_error``: how far the
    covariance of the whitened fit list is from the identity, at its worst entry.
    """
    vectors = scaled(rows, id_column, vector, scale)
    id_type = vectors.schema["id"].dataType.simpleString()
    out = f"{id_column} {id_type}, {WHITENED}"
    fit = fit_list(vectors)
    if fit is None:
        return rows.sparkSession.createDataFrame([], out)
    wanted = min(components, fit.dims)
    values, right, total = bidiagonalise(fit, wanted)
    kept = int((values[:wanted] > 1e-10 * np.sqrt(total)).sum()) if total else 0
    if not kept:
        return rows.sparkSession.createDataFrame([], out)
    n, sums, dims = fit.n, fit.sums, fit.dims
    deviations = values[:kept] / np.sqrt(n)
    turn = right[:, :kept] / deviations

    def moments(centred):
        along = centred @ turn
        return np.concatenate([(along.T @ along).ravel(), along.sum(axis=0)])

    found = fit.total(moments, kept * kept + kept) / n
    middle = found[kept * kept :]
    covariance = found[: kept * kept].reshape(kept, kept) - np.outer(middle, middle)
    error = float(np.abs(covariance - np.eye(kept)).max())
    explained = values[:kept] ** 2 / total
    mean = np.array([s / n for s in sums])
    largest = max(map(abs, sums))

    def run(batches):
        for batch in batches:
            whole = _matrix(batch.column("x"), dims)
            along = (whole - mean) @ turn
            top = n * int(np.abs(whole).max()) + largest if whole.size else 0
            if top * top * dims < 1 << 63:
                apart = n * whole - np.array(sums)
                exact = (apart * apart).sum(axis=1)
            else:
                exact = [sum((n * x - s) ** 2 for x, s in zip(row, sums)) for row in whole.tolist()]
                if max(exact) >= 1 << 63:
                    raise OverflowError("a deviation does not fit into a LONG")
            m = len(whole)
            each = np.repeat(np.arange(m), kept)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(each)), pa.array(np.tile(np.arange(1, kept + 1), m), pa.int32()),
                    pa.array(np.full(m * kept, n)), pa.array(np.array(exact, np.int64)[each]), pa.array(along.ravel()),
                    pa.array(np.tile(explained, m)), pa.array(np.full(m * kept, error)),
                ],
                names=[id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return vectors.where(F.size("x") == dims).mapInArrow(run, out)
