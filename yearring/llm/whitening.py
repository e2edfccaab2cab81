"""Embedding whitening by blockwise QR and a bidiagonal qd solver.

Entries become integers ``x = floor(64 c) + 1000000``.  Counts and sums are exact.  Each task reduces its centred rows, block by block, to
one triangle R; triangles meet in a tree of groups.  From the last R (as wide as a vector) the driver takes the directions:
Householder bidiagonal form, singular values by dqds, vectors by twisted factorisations (:mod:`yearring.llm.bidiagonal`).  The covariance is
never formed, so small eigenvalues keep their digits.  Two narrow passes follow: one measures the whitened rows' covariance, one writes.

Vectors that are null or hold a null, a NaN or an infinity are dropped.  Shorter vectors count as padded with zeros to the longest; entries
beyond ``2**53 / 64`` are held at that.  Null ids and repeated rows stay.  Components without variance (to rounding) have no direction and are
left out, so equal vectors, a single one or vectors of no entries give no rows.  A ``deviation`` beyond a long is null.  Equal eigenvalues share a
space; any base of it serves.  A component's largest entry is positive.  Very long vectors cost a square of their length in memory.
An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearring.llm.bidiagonal import EPS, right_vectors
from yearring.llm.parts import written

COMPONENTS = 32
OFFSET = 1_000_000
LIMIT = 1 << 53
#: Rows of a block that one QR reduces, and bytes of states that one group of the tree holds.
BLOCK_ROWS = 4096
GROUP_BYTES = 64 << 20


@dataclass(frozen=True)
class Sums:
    """Exact number of vectors and sums of ``x - 1000000`` by dimension."""

    n: int
    sums: tuple[int, ...]

    @property
    def whole(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def fraction(self) -> np.ndarray:
        return np.array([(s % self.n) / self.n for s in self.sums])

    def from_mean(self, y: np.ndarray) -> np.ndarray:
        """Rows minus the mean; the integer part of the mean goes first, without rounding."""
        return (y - self.whole).astype(np.float64) - self.fraction

    def deviations(self, y: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, in integers."""
        rest = [s % self.n for s in self.sums]
        near = y - self.whole
        bound = (int(np.abs(near).max(initial=0)) + 1) * self.n
        kind = np.int64 if bound * bound * max(len(rest), 1) < 1 << 63 else object
        gaps = near.astype(kind) * self.n - np.array(rest, kind)
        return [d if d < 1 << 63 else None for d in (gaps * gaps).sum(axis=1).tolist()]


def valid_vectors(embeddings: DataFrame, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``vec_id, vector array<double>`` of the rows whose vector has finite entries only."""
    vectors = embeddings.select(F.col(key).alias("vec_id"), F.col(column).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.filter(F.col("vector").isNotNull() & finite)


def integers(vectors: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of ``floor(64 c)``, padded with the integer of c = 0 to ``width``."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    flat = np.clip(np.floor(64 * flat), -LIMIT, LIMIT).astype(np.int64)
    width = int(lengths.max(initial=0)) if width is None else width
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def exact_sums(vectors: DataFrame) -> Sums:
    """Partial sums in each task, added by dimension; dimension -1 counts."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, []
        for batch in batches:
            y = integers(batch.column(0))
            wide = int(np.abs(y).max(initial=0)) * max(len(y), 1) >= 1 << 63
            n += len(y)
            sums += [0] * (y.shape[1] - len(sums))
            for k, s in enumerate(y.astype(object).sum(axis=0) if wide else y.sum(axis=0).tolist()):
                sums[k] += s
        dims = pa.array(range(-1, len(sums)), pa.int32())
        yield pa.RecordBatch.from_arrays([dims, pa.array([str(v) for v in (n, *sums)])], names=["dim", "part"])

    parts = vectors.select("vector").mapInArrow(partial, "dim int, part string")
    total = parts.groupBy("dim").agg(F.sum(F.col("part").cast("decimal(38,0)")).cast("string").alias("total"))
    found = {r["dim"]: int(r["total"]) for r in total.collect()}
    return Sums(found.pop(-1, 0), tuple(found[k] for k in range(len(found))))


def merged(vectors: DataFrame, partial: Callable, merge: Callable, size: int, name: str) -> np.ndarray | None:
    """One array of ``size`` floats: ``partial(batches)`` in each task, then ``merge(arrays)`` in a tree of groups."""

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = partial(batch.column(0) for batch in batches)
        if state is not None:
            columns = [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([state.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "state"])

    def join(key: tuple, table: pa.Table) -> pa.Table:
        state = merge([np.frombuffer(s) for s in table.column("state").to_pylist()])
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "state": pa.array([state.tobytes()], pa.binary())})

    states = written(vectors.select("vector").mapInArrow(start, "part long, state binary"), name)
    last, fan = states.agg(F.max("part")).first()[0], max(2, min(64, GROUP_BYTES // (8 * max(size, 1))))
    if last is None:
        return None
    while last > 0:
        states = states.withColumn("part", F.expr(f"part div {fan}")).groupBy("part").applyInArrow(join, "part long, state binary")
        last //= fan
    return np.frombuffer(states.first()["state"])


def triangle(vectors: DataFrame, sums: Sums) -> np.ndarray:
    """R of the centred rows."""
    d = len(sums.sums)

    def reduced(rows: list[np.ndarray]) -> np.ndarray:
        return np.linalg.qr(np.vstack(rows), mode="r")

    def partial(columns: Iterator[pa.Array]) -> np.ndarray:
        r, block, held = np.zeros((d, d)), [], 0
        for column in columns:
            rows = sums.from_mean(integers(column, d))
            for at in range(0, len(rows), BLOCK_ROWS):
                block.append(rows[at : at + BLOCK_ROWS])
                held += len(block[-1])
                if held >= max(BLOCK_ROWS, d):
                    r, block, held = reduced([r, *block]), [], 0
        return reduced([r, *block]) if block else r

    def merge(states: list[np.ndarray]) -> np.ndarray:
        r = states[0].reshape(d, d)
        for state in states[1:]:
            r = reduced([r, state.reshape(d, d)])
        return r

    return merged(vectors, partial, merge, d * d, "whitening-triangles").reshape(d, d)


@dataclass(frozen=True)
class Whitener:
    """Fitted directions: ``directions`` has a column per component, already over its standard deviation."""

    sums: Sums
    directions: np.ndarray
    variances: np.ndarray
    explained: np.ndarray

    def whiten(self, y: np.ndarray) -> np.ndarray:
        return self.sums.from_mean(y) @ self.directions


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Directions of the ``components`` largest variances; None without any."""
    sums = exact_sums(vectors)
    if sums.n == 0 or not sums.sums:
        return None
    squares, v = right_vectors(triangle(vectors, sums))
    d = len(squares)
    kept = min(components, int((squares > squares[0] * (EPS * max(d, 16)) ** 2).sum())) if squares[0] > 0 else 0
    if not kept:
        return None
    v = v[:, :kept] * np.sign(v[np.abs(v[:, :kept]).argmax(axis=0), np.arange(kept)])
    variances = squares[:kept] / sums.n
    return Whitener(sums, v / np.sqrt(variances), variances, squares[:kept] / squares.sum())


def identity_error(vectors: DataFrame, whitener: Whitener) -> float:
    """Largest entry of the whitened rows' covariance minus the identity; counts, means and products are merged."""
    k, d = len(whitener.variances), len(whitener.sums.sums)

    def state_of(rows: np.ndarray) -> np.ndarray:
        mean = rows.mean(axis=0)
        centred = rows - mean
        return np.concatenate([[len(rows)], mean, (centred.T @ centred).ravel()])

    def merge(states: list[np.ndarray]) -> np.ndarray:
        one = states[0].copy()
        for two in states[1:]:
            n, gap = one[0] + two[0], two[1 : k + 1] - one[1 : k + 1]
            one[k + 1 :] += two[k + 1 :] + (np.outer(gap, gap) * (one[0] * two[0] / n)).ravel()
            one[1 : k + 1] += gap * (two[0] / n)
            one[0] = n
        return one

    def partial(columns: Iterator[pa.Array]) -> np.ndarray | None:
        state = None
        for column in columns:
            if len(column):
                new = state_of(whitener.whiten(integers(column, d)))
                state = new if state is None else merge([state, new])
        return state

    state = merged(vectors, partial, merge, 1 + k + k * k, "whitening-check")
    return float(np.abs(state[k + 1 :].reshape(k, k) / state[0] - np.eye(k)).max())


COLUMNS = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per remaining vector and component."""
    vectors = valid_vectors(embeddings)
    whitener = fit(vectors, components)
    if whitener is None:
        return embeddings.sparkSession.createDataFrame([], COLUMNS)
    error, d, k = identity_error(vectors, whitener), len(whitener.sums.sums), len(whitener.variances)
    # 32 rows come out for each vector, so a batch is cut before it grows.
    step = max(1, (1 << 18) // k)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                piece = batch.slice(at, step)
                y, rows = integers(piece.column(1), d), piece.num_rows
                each = np.repeat(np.arange(rows), k)
                columns = [
                    piece.column(0).cast(pa.int64()).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, whitener.sums.n)),
                    pa.array(whitener.sums.deviations(y), pa.int64()).take(pa.array(each)),
                    pa.array(whitener.whiten(y).ravel()),
                    pa.array(np.tile(whitener.explained, rows)),
                    pa.array(np.full(rows * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in COLUMNS.split(", ")])

    return vectors.mapInArrow(emit, COLUMNS)
