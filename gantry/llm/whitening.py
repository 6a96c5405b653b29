"""Embedding whitening with exact integer statistics from bit planes.

1. Entries become integers x = floor(64 * c) + 1,000,000; each dimension is shifted by its
   smallest x, so it needs only as many bits as its range has.
2. Tasks pack every bit plane of every dimension across the rows of a batch, 64 rows to a
   word. The planes p of dimension i and q of dimension j share popcount(i_p & j_q) rows, and
   the cross-product of the two dimensions is the sum of 2 ** (p + q) times that. Tasks hand
   over the popcounts summed by (i, j, p + q), so nothing is rounded and nothing overflows;
   their number depends on the dimensions, not on the rows.
3. The driver, which holds one d x d matrix, centres in integers (n * sum(xy) - sum(x) *
   sum(y)), divides once and takes the eigenvectors.
4. A second pass projects every row; the covariance of what comes out is measured.

Cases: a vector that is null or holds null, NaN or infinite entries is dropped; a vector
shorter than the longest counts as 0.0 in the dimensions it lacks; entries beyond 2 ** 52 are
taken as 2 ** 52; a ``deviation`` beyond a long is null; directions without variance (below
1e-12 of the total) are no components, so equal vectors, or a single one, give no rows;
repeated rows and null ids are rows like others; an empty table gives an empty result; other
columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gantry.sources.scratch import stored

# ---- fixed values of the contract ----
SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
# --------------------------------------

MOST = float(1 << 52)
#: Rows whose planes are packed together; a multiple of 64.
BLOCK_ROWS = 8192
NO_VARIANCE = 1e-12


def usable_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``x``, the vector as integers, of rows whose entries are all finite."""

    def finite(c):
        value = c.cast("double")
        return c.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))

    def to_integer(c):
        value = F.least(F.greatest(c.cast("double"), F.lit(-MOST)), F.lit(MOST))
        return F.floor(F.lit(float(SCALE)) * value) + F.lit(OFFSET).cast("long")

    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    usable = rows.where(F.col("v").isNotNull() & F.forall("v", finite))
    return usable.select("id", F.transform("v", to_integer).alias("x"))


@dataclass(frozen=True)
class Ranges:
    """The number of rows, and the smallest x and the bits of each dimension."""

    n: int
    low: np.ndarray
    bits: list[int]


def dimension_ranges(rows: DataFrame) -> Ranges:
    found = rows.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(
        F.min("x").alias("low"), F.max("x").alias("high"), F.count("*").alias("there")
    )
    n = rows.count()
    each = sorted(found.collect())  # one row for each dimension
    low = [r.low if r.there == n else min(r.low, OFFSET) for r in each]
    high = [r.high if r.there == n else max(r.high, OFFSET) for r in each]
    return Ranges(n, np.array(low, np.int64), [int(b - a).bit_length() for a, b in zip(low, high)])


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A list column as rows of ``dims`` integers; what a shorter list lacks is a zero entry."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy()
    if len(sizes) * dims == len(values):
        return values.reshape(len(sizes), dims)
    out = np.full((len(sizes), dims), OFFSET, np.int64)
    out[np.arange(dims) < sizes[:, None]] = values
    return out


# ---- bit planes ----------------------------------------------------------


def bit_planes(x: np.ndarray, low: np.ndarray, bits: list[int]) -> np.ndarray:
    """All planes of all dimensions, in order: a row of 64-bit words for each."""
    shifted = (x - low).T
    words = -(-len(x) // 64)
    planes = np.zeros((sum(bits), words * 8), np.uint8)
    at = 0
    for values, depth in zip(shifted, bits):
        marks = (values >> np.arange(depth)[:, None]) & 1
        packed = np.packbits(marks.astype(bool), axis=1)
        planes[at : at + depth, : packed.shape[1]] = packed
        at += depth
    return planes.view(np.uint64)


def shared_bits(planes: np.ndarray, bits: list[int], counts: np.ndarray) -> None:
    """Add to ``counts[i, j, p + q]`` (i <= j) the rows that have bit p of i and bit q of j."""
    dim = np.repeat(np.arange(len(bits)), bits)
    bit = np.concatenate([np.arange(b) for b in bits])
    for at in range(len(planes)):
        i, p = dim[at], bit[at]
        first = at - p  # planes of the same dimension and of later ones
        both = np.bitwise_count(planes[first:] & planes[at]).sum(axis=1, dtype=np.int64)
        counts[i][dim[first:], bit[first:] + p] += both


def _plane_counts(ranges: Ranges):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims = len(ranges.bits)
        weights = 2 * max(ranges.bits) - 1
        products = np.zeros((dims, dims, weights), np.int64)
        singles = np.zeros((dims, max(ranges.bits)), np.int64)
        dim = np.repeat(np.arange(dims), ranges.bits)
        bit = np.concatenate([np.arange(b) for b in ranges.bits])
        for batch in batches:
            x = _matrix(batch.column("x"), dims)
            for start in range(0, len(x), BLOCK_ROWS):
                planes = bit_planes(x[start : start + BLOCK_ROWS], ranges.low, ranges.bits)
                shared_bits(planes, ranges.bits, products)
                singles[dim, bit] += np.bitwise_count(planes).sum(axis=1, dtype=np.int64)
        i, j, s = np.nonzero(products)
        d, p = np.nonzero(singles)
        # the sums of single dimensions are those with j = -1
        columns = [np.r_[i, d], np.r_[j, np.full(len(d), -1)], np.r_[s, p], np.r_[products[i, j, s], singles[d, p]]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["i", "j", "s", "n"])

    return run


@dataclass(frozen=True)
class Whitener:
    """What the second pass needs: exact sums and the projection."""

    ranges: Ranges
    sums: list[int]  # of x, exact
    projection: np.ndarray  # dims x components, already divided by the roots of the eigenvalues
    explained: np.ndarray


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """The whitening of rows of :func:`usable_vectors`; None where nothing varies."""
    ranges = dimension_ranges(rows)
    n, dims = ranges.n, len(ranges.bits)
    if not n or not any(ranges.bits):
        return None
    counted = rows.select("x").mapInArrow(_plane_counts(ranges), "i long, j long, s long, n long")
    sums, products = [0] * dims, {}
    # at most dims * (dims + 1) / 2 * (2 * 63) rows, whatever the table's size
    for r in counted.groupBy("i", "j", "s").agg(F.sum("n").alias("n")).collect():
        if r.j < 0:
            sums[r.i] += r.n << r.s
        else:
            products[r.i, r.j] = products.get((r.i, r.j), 0) + (r.n << r.s)
    covariance = np.zeros((dims, dims))
    for i in range(dims):
        for j in range(i, dims):
            centred = n * products.get((i, j), 0) - sums[i] * sums[j]  # integers, shift-free
            covariance[i, j] = covariance[j, i] = centred / (n * n)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(values)[::-1]
    trace = float(np.trace(covariance))
    kept = [k for k in order[:components] if values[k] > NO_VARIANCE * trace]
    totals = [s + n * int(low) for s, low in zip(sums, ranges.low)]
    return Whitener(ranges, totals, vectors[:, kept] / np.sqrt(values[kept]), values[kept] / trace)


def _whitened(model: Whitener):
    n = model.ranges.n
    widest = max(1 << b for b in model.ranges.bits)
    furthest = widest + int(np.abs(model.ranges.low).max())
    # beyond 64 bits Python's integers take over
    small = len(model.sums) * (n * widest) ** 2 < 1 << 62 and n * furthest < 1 << 62

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.array(model.sums, np.int64 if small else object)
        for batch in batches:
            x = _matrix(batch.column("x"), len(sums))
            centred = (x if small else x.astype(object)) * n - sums
            square = (centred * centred).sum(axis=1)
            deviation = [v if v < 1 << 63 else None for v in square.tolist()]
            white = (centred / n).astype(float) @ model.projection
            offsets = np.arange(0, white.size + 1, white.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(deviation, pa.int64()), pa.ListArray.from_arrays(offsets, white.ravel())],
                names=["id", "deviation", "white"],
            )

    return run


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each task the sums, and the sums of products, of the whitened columns."""
    total = None
    for batch in batches:
        if batch.num_rows:
            lists = batch.column("white")
            white = lists.flatten().to_numpy().reshape(batch.num_rows, -1)
            white = np.c_[white, np.ones(batch.num_rows)]
            total = white.T @ white if total is None else total + white.T @ white
    if total is not None:
        i, j = np.indices(total.shape)
        columns = [pa.array(i.ravel(), pa.int64()), pa.array(j.ravel(), pa.int64()), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "total"])


def identity_error(white: DataFrame, components: int) -> float:
    """The largest absolute entry of the covariance of column ``white`` minus the identity."""
    sums = np.zeros((components + 1, components + 1))
    partial = white.select("white").mapInArrow(_products, "i long, j long, total double")
    for r in partial.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        sums[r.i, r.j] = r.total
    n, mean = sums[-1, -1], sums[-1, :-1] / sums[-1, -1]
    return float(np.abs(sums[:-1, :-1] / n - np.outer(mean, mean) - np.eye(components)).max())


def whitened_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per usable vector and component: id, ``component``, ``n``, ``deviation``,
    ``whitened``, ``explained`` and ``identity_error``."""
    rows = usable_vectors(vectors, id_col, vector_col)
    id_type = rows.schema["id"].dataType.simpleString()
    model = fit(rows, components)
    if model is None:
        schema = f"id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return rows.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    white = stored(rows.mapInArrow(_whitened(model), f"id {id_type}, deviation long, white array<double>"))
    error = identity_error(white, len(model.explained))
    shares = F.array(*[F.lit(float(e)) for e in model.explained])
    return white.select("id", "deviation", F.posexplode("white").alias("at", "whitened")).select(
        F.col("id").alias(id_col),
        (F.col("at") + 1).alias("component"),
        F.lit(model.ranges.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
