"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Every step is one distributed pass that gives V·Q for a block Q of a few dozen
columns: each task multiplies its centred rows, and Spark adds the products up
cell by cell.  Between passes the driver holds matrices of ``dimensions x
block`` only.  A polynomial of V, run as a three-term recurrence of such
passes, damps the part of the spectrum below the block; QR and Rayleigh-Ritz
then give the components, until their residuals certify them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsift.llm.common import checkpoint

#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64.0, 1_000_000

#: Entries from this magnitude on have no exact long form in double precision.
LARGEST = float(1 << 46)

#: Columns beyond the wanted ones, passes of a filter at most, ratio to which a
#: filter may drive components apart, residual (as a part of the component's
#: eigenvalue) that certifies, the one (as a part of the largest) that does
#: when rounding stops further progress, and filters at most.
GUARD, DEGREE, APART, TIGHT, LOOSE, FILTERS = 16, 12, 1e8, 4e-15, 1e-12, 200

#: Rows of a block.
BLOCK_ROWS = 2000

#: Eigenvalues below this part of the largest are zero but for rounding.
ZERO = 1e-13


def vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id``, ``x`` (array of long) of the rows whose vector is complete."""
    c = F.col(vector_col)
    bad = F.exists(c, lambda e: e.isNull() | F.isnan(e.cast("double")) | (F.abs(e.cast("double")) == float("inf")))
    huge = F.exists(c, lambda e: F.abs(e.cast("double")) >= LARGEST)
    whole = F.transform(c, lambda e: F.floor(e.cast("double") * SCALE) + F.lit(SHIFT).cast("long"))
    x = F.when(huge, F.raise_error(F.lit("an entry is too large to become an exact long"))).otherwise(whole)
    return rows.filter(c.isNotNull() & ~F.coalesce(bad, F.lit(True))).select(F.col(id_col).alias("vec_id"), x.cast("array<long>").alias("x"))


def _blocks(vecs: DataFrame, dims: int) -> DataFrame:
    """``ids`` and ``x`` of many rows as one row, ``x`` as the bytes of a matrix
    of longs: the passes read it as it lies."""
    kind = vecs.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(a, BLOCK_ROWS)
                ids = part.column("vec_id")
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).astype("<i8", copy=False)
                whole = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
                yield pa.RecordBatch.from_arrays([whole, pa.array([x.tobytes()], pa.binary())], names=["ids", "x"])

    return vecs.filter(F.size("x") == dims).mapInArrow(run, f"ids array<{kind}>, x binary")


def _matrix(x: pa.Scalar, dims: int) -> np.ndarray:
    return np.frombuffer(x.as_buffer(), "<i8").reshape(-1, dims)


def _cells(out: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(out.size)), pa.array(out.ravel())], names=["cell", "v"])


def _summed(blocks: DataFrame, dims: int, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int], kind: str = "double") -> np.ndarray:
    """Sum of a matrix that ``part`` makes of each block: one partial sum per
    task, added up cell by cell by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in batch.column("x"):
                own = part(_matrix(x, dims))
                total = own if total is None else total + own
        if total is not None:
            yield _cells(total)

    cells = blocks.select("x").mapInArrow(run, f"cell long, v {kind}").groupBy("cell")
    if kind == "long":
        got = cells.agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
        out = np.zeros(shape, object)
        for r in got:
            out.flat[r["cell"]] = int(r["v"])
        return out
    table = cells.agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(shape[0] * shape[1])
    out[table.column("cell").to_numpy()] = table.column("v").to_numpy()
    return out.reshape(shape)


def _centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """``n*x - S``, exact."""
    return x * np.int64(n) - total


def filtered(times: Callable[[np.ndarray], np.ndarray], q: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of V that stays within 1 on [low, high] and
    grows fastest above, applied to ``q`` and scaled to about 1 at ``top``."""
    centre, half = (low + high) / 2, (high - low) / 2
    first = half / (top - centre)
    scale, before, now = first, q, (times(q) - centre * q) * (first / half)
    for _ in range(degree - 1):
        grown = 1 / (2 / first - scale)
        before, now = now, (times(now) - centre * now) * (2 * grown / half) - before * (scale * grown)
        scale = grown
    return now


def components(times: Callable[[np.ndarray], np.ndarray], dims: int, wanted: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors of V, at most ``wanted``, the
    zero ones left out.  ``times`` gives V·Q."""
    width = min(dims, wanted + GUARD)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, width)))[0]
    last, value = math.inf, np.zeros(width)
    for _ in range(FILTERS):
        image = times(q)
        value, turn = np.linalg.eigh((q.T @ image + image.T @ q) / 2)
        value, turn = value[::-1], turn[:, ::-1]
        q, image = q @ turn, image @ turn
        top = value[0]
        if not top > 0:
            return np.zeros(0), np.zeros((dims, 0))
        real = int((value[: min(wanted, width)] > ZERO * top).sum())
        off = np.linalg.norm(image - q * value, axis=0)[:real]
        miss = (off / value[:real]).max(initial=0.0)
        if miss <= TIGHT or (off.max() <= LOOSE * top and miss > last / 4):
            q = q[:, :real] * np.sign(q[np.abs(q[:, :real]).argmax(axis=0), np.arange(real)])
            return value[:real], q
        last = miss
        high = max(value[-1], ZERO * top)
        if width == dims or top - high <= ZERO * top:  # nothing below the block, or a flat spectrum
            q = np.linalg.qr(q)[0]
        else:
            # the largest component must not drown the least one in rounding
            rise = np.arccosh(np.maximum(2 * value[[0, max(real - 1, 0)]] / high - 1, 1))
            degree = min(DEGREE, max(1, int(math.log(APART) / max(rise[0] - rise[1], 1e-9))))
            q = np.linalg.qr(filtered(times, q, 0.0, high, top, degree))[0]
    raise RuntimeError(f"components are not certified after {FILTERS} filters (residual {last:.1e})")


def whiten(rows: DataFrame, wanted: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per remaining row of ``rows`` and component: ``vec_id``, ``component``
    (from 1), ``n``, ``deviation``, ``whitened``, ``explained``,
    ``identity_error``.

    Rows whose vector is null or holds null or non-finite entries are left out,
    and so are vectors of another length than the most common one (of equally
    common ones the longest).  Repeated rows and null ids stay.  Components
    whose eigenvalue is zero have no whitened form and are left out: equal
    vectors, or an empty table, give no rows.  Each component's largest entry is
    positive.  Other columns of ``rows`` are ignored.  Entries of 2^46 and more,
    and deviations beyond a long, raise an error.
    """
    spark = rows.sparkSession
    vecs = vectors(rows, id_col, vector_col)
    kind = vecs.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    sizes = vecs.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if sizes is None or not sizes["d"]:
        return spark.createDataFrame([], schema)
    dims, n = sizes["d"], sizes["count"]
    made = checkpoint(_blocks(vecs, dims))
    exact = _summed(made, dims, lambda x: x.sum(axis=0, dtype=np.int64)[None, :], (1, dims), "long")[0]
    if max(map(abs, exact), default=0) >= 1 << 62:
        raise OverflowError("sums are beyond a long")
    total = exact.astype(np.int64)

    def centred(x: np.ndarray) -> np.ndarray:
        return _centred(x, n, total) / n

    def squares(x: np.ndarray) -> np.ndarray:
        return np.square(centred(x)).sum(axis=0)[None, :]

    def times(q: np.ndarray) -> np.ndarray:
        block = spark.sparkContext.broadcast(q)  # dims x block

        def product(x: np.ndarray) -> np.ndarray:
            own = centred(x)
            return own.T @ (own @ block.value)

        out = _summed(made, dims, product, q.shape) / n
        block.unpersist()
        return out

    trace = float(_summed(made, dims, squares, (1, dims)).sum() / n)
    value, vector = components(times, dims, wanted)
    if not len(value):
        return spark.createDataFrame([], schema)
    project = spark.sparkContext.broadcast(vector / np.sqrt(value))

    def gram(x: np.ndarray) -> np.ndarray:
        own = centred(x) @ project.value
        return own.T @ own

    error = float(np.abs(_summed(made, dims, gram, (len(value), len(value))) / n - np.eye(len(value))).max())
    explained = value / trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, block in zip(batch.column("ids"), batch.column("x")):
                x = _matrix(block, dims)
                for a in range(0, len(x), 500):
                    apart = _centred(x[a : a + 500], n, total)
                    if np.square(apart.astype(np.float64)).sum(axis=1).max(initial=0) >= 2.0**63:
                        raise OverflowError("a deviation is beyond a long")
                    out = apart / n @ project.value
                    m, k = out.shape
                    deviation = np.square(apart).sum(axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [ids.values.slice(a, m).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                         pa.array(np.full(m * k, n, np.int64)), pa.array(np.repeat(deviation, k)), pa.array(out.ravel()),
                         pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                        names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return made.mapInArrow(run, schema)
