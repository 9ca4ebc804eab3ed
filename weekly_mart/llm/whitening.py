"""Operator 12: embedding whitening by blockwise QR and a bidiagonal qd solver.

Vectors are laid on an integer grid, so that counts, sums and deviations are
exact. Every task reduces its centred rows to one triangle by QR, block after
block, and triangles are reduced sixteen at a time until one is left, whose
square is the covariance. What comes to the driver is that triangle, d x d for
vectors of d numbers; its bidiagonal form gives the spectrum and the directions
(`bidiagonal`).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekly_mart.llm.bidiagonal import EPS, bidiagonalise, right_vectors, singular_values
from weekly_mart.llm.common import materialise

COMPONENTS = 16
#: Steps of the grid in one unit, and the number added to every entry.
GRID, OFFSET = 64, 1_000_000
#: Entries beyond this have no exact place on the grid; they count as not finite.
EXACT = float(1 << 53)
#: Triangles that one task reduces.
FAN_IN = 16
#: Rows of a block.
BLOCK_ROWS = 4096


@dataclass
class Whitening:
    """What was fitted: ``n`` distinct vectors with ``sums`` a dimension; ``directions`` are unit
    eigenvectors (columns) over the root of their eigenvalues."""

    n: int
    sums: list[int]
    values: np.ndarray
    trace: float
    directions: np.ndarray
    identity_error: float

    @property
    def explained(self) -> list[float]:
        return [float(v) / self.trace for v in self.values]

    def centred(self, grid: np.ndarray) -> np.ndarray:
        """Grid vectors less the mean. The whole part of the mean is taken off in whole numbers."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (grid - whole) - rest

    def deviations(self, grid: np.ndarray) -> np.ndarray:
        """Sum over dimensions of (n x - S) squared, exact."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        if float(np.abs(grid - whole).max(initial=0) + 1) * self.n * len(self.sums) ** 0.5 >= 2**31.5:
            exact = (grid - whole).astype(object) * self.n - rest
            return np.array([int(x) for x in (exact * exact).sum(axis=1)], np.int64)  # OverflowError beyond a long
        return (((grid - whole) * self.n - rest) ** 2).sum(axis=1)


def on_grid(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x): vectors without null or non-finite entries, each entry as a whole number.

    Of vectors of several lengths those of the commonest stay (of the longest, if
    equally common). Empty vectors are left out.
    """
    entry = lambda c: F.floor(c.cast("double") * GRID)
    sound = lambda c: c.isNotNull() & (F.abs(c.cast("double") * GRID) < EXACT)  # noqa: E731  (NaN is above all)
    rows = embeddings.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(
        F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", sound)
    )
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("v") == (lengths.d if lengths else 0)).select(
        "id", F.transform("v", lambda c: (entry(c) + OFFSET).cast("long")).alias("x")
    )


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, d)


def _triangles(model: Whitening):
    """One triangle for each task: the QR of all its centred rows, block after block."""
    d = len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for batch in batches:
            x = model.centred(_matrix(batch.column("x"), d))
            for first in range(0, len(x), BLOCK_ROWS):
                r = np.linalg.qr(np.vstack((r, x[first : first + BLOCK_ROWS])), mode="r")
        if len(r):
            yield _triangle(TaskContext.get().partitionId(), r, d)

    return run


def _triangle(part: int, r: np.ndarray, d: int) -> pa.RecordBatch:
    square = np.zeros((d, d))
    square[: len(r)] = r
    return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([square.ravel()])], names=["part", "r"])


def _merge(d: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("part")
        r = np.linalg.qr(_matrix(group["r"].combine_chunks(), d * d).reshape(-1, d), mode="r")
        return pa.Table.from_batches([_triangle(group["part"][0].as_py() // FAN_IN, r, d)])

    return run


def _triangle_of_all(fit: DataFrame, model: Whitening) -> np.ndarray:
    d, kind = len(model.sums), "part long, r array<double>"
    level = materialise(fit.select("x").mapInArrow(_triangles(model), kind), "triangles")
    while True:
        parts = level.agg(F.max("part")).first()[0]
        level = materialise(
            level.groupBy(F.floor(F.col("part") / FAN_IN).alias("g")).applyInArrow(_merge(d), kind), "triangles"
        )
        if parts < FAN_IN:
            return np.array(level.first().r).reshape(d, d)


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened fit list less the identity."""
    d, k = len(model.sums), model.directions.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            y = model.centred(_matrix(batch.column("x"), d)) @ model.directions
            total[:k] += y.T @ y
            total[k] += y.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()])], names=["m"])

    sums = (
        fit.select("x").mapInArrow(run, "m array<double>").select(F.posexplode("m")).groupBy("pos").agg(F.sum("col").alias("s"))
    )
    total = np.zeros((k + 1) * k)
    for r in sums.collect():  # 17 x 16 numbers
        total[r.pos] = r.s
    moments, mean = total[: k * k].reshape(k, k) / model.n, total[k * k :] / model.n
    return float(np.abs(moments - np.outer(mean, mean) - np.eye(k)).max())


def fit_whitening(grid: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors ``x`` of ``grid``; None where there are none.

    Copies are dropped by an aggregate that combines before the shuffle, so a
    vector that a third of all rows share costs one row a task. Directions whose
    deviation is no more than rounding (rank below ``components``) are left out.
    """
    fit = materialise(grid.select("x").distinct(), "whitening-fit")
    n = fit.count()
    if n == 0:
        return None
    sums = fit.select(F.posexplode("x")).groupBy("pos").agg(F.sum("col").alias("s")).orderBy("pos").collect()
    d = len(sums)
    model = Whitening(n, [int(r.s) for r in sums], np.zeros(0), 0.0, np.zeros((d, 0)), 0.0)
    triangle = _triangle_of_all(fit, model) / np.sqrt(n)
    diagonal, above, right = bidiagonalise(triangle)
    deviations = singular_values(diagonal, above)
    rank = int((deviations > max(n, d) * EPS * deviations[0]).sum()) if deviations[0] > 0 else 0
    wanted = deviations[: min(components, rank)]
    model.values, model.trace = wanted**2, float((triangle**2).sum())
    model.directions = right @ right_vectors(diagonal, above, wanted) / wanted
    if rank:
        model.identity_error = _identity_error(fit, model)
    return model


def whiten(
    embeddings: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row for each sound vector: the id, ``deviation``, ``whitened`` (one number a component), and the
    same in all rows ``n``, ``explained`` (one number a component) and ``identity_error``.

    Rows whose vector is null or empty, holds null or non-finite entries, or has
    not the commonest length are dropped. Null and repeated ids are ids like any
    other; every row gets its result. The spectrum is fitted on each distinct
    vector once. Fewer components come back where the vectors span fewer
    dimensions, none for a single distinct vector; a table without sound vectors
    gives an empty result. A deviation that no long can hold raises. Only the two
    named columns are read.
    """
    rows = on_grid(embeddings, id_col, vector_col)
    model = fit_whitening(rows, components)
    ids = rows.schema["id"].dataType.simpleString()
    kind = f"id {ids}, deviation long, whitened array<double>"
    k = model.directions.shape[1] if model else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = _matrix(batch.column("x"), len(model.sums))
            y = model.centred(x) @ model.directions
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * k, y.ravel())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(model.deviations(x)), lists], names=["id", "deviation", "whitened"]
            )

    scored = rows.mapInArrow(run, kind) if model else rows.select(
        "id", F.lit(0).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened")
    ).where("false")
    explained: Column = F.array(*[F.lit(v) for v in model.explained] if model else []).cast("array<double>")
    return scored.select(
        F.col("id").alias(id_col), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation", "whitened",
        explained.alias("explained"), F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )
