"""Whitening of embeddings from exact integer cross-products that are taken bit by bit.

Entries become integers x = floor(256 c). The fit list holds every distinct integer vector once. Each dimension is
shifted by its minimum, its bits are laid out as planes, and each plane packs the rows of a run into 64-bit words
(`Planes`). The cross-product of two dimensions is the sum, over pairs of their planes, of the bits that both planes have
(AND, then popcount), weighted by two to the power of the planes' bit numbers. Tasks send these sums as limbs that a long
holds, whatever the number of rows; the scatter n * sum(x_i x_j) - S_i * S_j is put together from them in whole numbers, so
nothing is rounded before its entries are divided for `eigh`. The shift cancels in it.

Rows whose vector is null, or holds a null or a non-finite entry, are dropped. Vectors of different lengths are spaces
of their own, each with its own fit list. Entries beyond the range of a long count as its ends. A direction without
variance cannot be scaled: `whitened` is null there (all of them if the fit list has one vector, when `explained` is
null, too). Vectors of fewer dimensions than components, empty ones included, have as many components as dimensions.
Equal vectors get equal results, whatever their ids; rows with a null id take part. An empty table gives an empty result.
Other columns are not read. `deviation` is null where it is beyond a long; `deviation_text` has it in full.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import Scratch, arrow

SCALE = 256
COMPONENTS = 4
#: Rows whose planes are made at a time: 64 words a plane.
ROWS_AT_ONCE = 4096
#: Weights of one limb are below two to this power, so that the sums of a task stay below 2^63.
LIMB_BITS = 20
#: Of the largest eigenvalue; what is below is rounding.
LEAST_EIGENVALUE = 1e-12


def usable(vector: Column) -> Column:
    """Vectors without null, infinite or undefined entries."""
    limit = F.lit(float("inf"))
    good = F.forall(vector, lambda c: F.coalesce((c < limit) & (c > -limit), F.lit(False)))
    return vector.isNotNull() & F.coalesce(good, F.lit(False))


def integers(vector: Column) -> Column:
    """floor(256 c) of every entry, as long."""
    top = float(2**63)

    def whole(c: Column) -> Column:
        scaled = F.floor(c.cast("double") * SCALE)
        return F.when(c.cast("double") * SCALE >= top, F.lit(2**63 - 1)).when(
            c.cast("double") * SCALE < -top, F.lit(-(2**63))).otherwise(scaled)

    return F.transform(vector, whole)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """(rows x width) of a list column whose rows all have `width` entries."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten()).reshape(len(column), width)


def by_width(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, np.ndarray, pa.RecordBatch]]:
    """The rows of each vector length: length, matrix of the vectors, rows."""
    sizes = np.asarray(batch.column(name).value_lengths()) if batch.num_rows else np.zeros(0, np.int32)
    for width in np.unique(sizes):
        rows = batch.filter(pa.array(sizes == width))
        yield int(width), matrix(rows.column(name), int(width)), rows


class Planes:
    """Weighted AND-popcounts of the bit planes of shifted dimensions, summed over blocks of rows."""

    def __init__(self, least: np.ndarray, most: np.ndarray) -> None:
        self.least = least
        bits = [(int(hi) - int(lo)).bit_length() for lo, hi in zip(least, most, strict=True)]
        self.dim = np.repeat(np.arange(len(bits)), bits)
        self.bit = np.concatenate([np.arange(b) for b in bits]).astype(np.int64) if bits else np.zeros(0, np.int64)
        self.starts = np.searchsorted(self.dim, np.arange(len(bits) + 1))
        limbs = 2 * max(bits, default=0) // LIMB_BITS + 1
        self.products = np.zeros((limbs, len(bits), len(bits)), np.int64)  # of dimension i with j >= i
        self.sums = np.zeros((limbs, len(bits)), np.int64)

    def add(self, x: np.ndarray) -> None:
        for start in range(0, len(x), ROWS_AT_ONCE):
            self._block(x[start: start + ROWS_AT_ONCE])

    def _block(self, x: np.ndarray) -> None:
        shifted = x.astype(np.uint64) - self.least.astype(np.uint64)  # modulo 2^64, which the shift undoes
        planes = (shifted[:, self.dim] >> self.bit.astype(np.uint64)) & np.uint64(1)
        packed = np.packbits(planes.astype(bool), axis=0)
        padded = np.zeros((-(-len(packed) // 8) * 8, len(self.dim)), np.uint8)
        padded[: len(packed)] = packed
        words = np.ascontiguousarray(padded.T).view(np.uint64)  # planes x words of 64 rows
        for p, (i, a) in enumerate(zip(self.dim.tolist(), self.bit.tolist(), strict=True)):
            first = self.starts[i]
            both = np.bitwise_count(words[p] & words[first:]).sum(axis=1, dtype=np.int64)
            power = self.bit[first:] + a
            for limb in range(len(self.products)):
                value = np.where(power // LIMB_BITS == limb, both << (power % LIMB_BITS), 0)
                np.add.at(self.products[limb, i], self.dim[first:], value)
            self.sums[a // LIMB_BITS, i] += int(np.bitwise_count(words[p]).sum()) << (a % LIMB_BITS)

    def rows(self) -> Iterator[tuple[int, int, int, int]]:
        """(i, j, limb, value); a sum of dimension i alone has j = -1."""
        for limb, table in enumerate(self.products):
            for i, j in zip(*np.nonzero(table), strict=True):
                yield int(i), int(j), limb, int(table[i, j])
            for i in np.flatnonzero(self.sums[limb]):
                yield int(i), -1, limb, int(self.sums[limb, i])


@dataclass
class Whitener:
    """Whitening of one vector length; `directions` are unit vectors in columns, over the root of their variance."""

    n: int
    sums: list[int]
    scatter: list[list[int]]
    directions: np.ndarray
    explained: list[float | None]
    error: float | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact; whole numbers of Python where a long is too short."""
        most = max((abs(s) for s in self.sums), default=0)
        if len(x) and x.size and self.n * max(int(x.max()), -int(x.min())) + most < 2**62:
            return self.n * x - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """(rows x components), NaN where a direction has no variance."""
        return (self.centred(x) / self.n).astype(np.float64) @ self.directions

    def deviations(self, x: np.ndarray) -> list[int]:
        d = self.centred(x)
        if d.dtype != object and d.size and int(np.abs(d).max()) ** 2 * d.shape[1] >= 2**63:
            d = d.astype(object)
        return [int(v) for v in (d * d).sum(axis=1)]


def solved(n: int, sums: list[int], scatter: list[list[int]], components: int) -> Whitener:
    """Directions from the exact scatter n^2 * covariance; every entry is divided once, correctly rounded."""
    covariance = np.array([[v / (n * n) for v in row] for row in scatter]).reshape(len(sums), len(sums))
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    trace = sum(scatter[i][i] for i in range(len(sums))) / (n * n)
    top = max(float(values.max()), 0.0) if len(values) else 0.0
    good = values[order] > LEAST_EIGENVALUE * top
    scale = np.where(good, 1 / np.sqrt(np.where(good, values[order], 1)), np.nan)
    return Whitener(n, sums, scatter, vectors[:, order] * scale,
                    [max(float(v), 0.0) / trace if trace else None for v in values[order]])


def fit_list(vectors: DataFrame, scratch: Scratch) -> DataFrame:
    """Every distinct integer vector, once: `width`, `x`. Equal ones are dropped before the shuffle, too."""
    rows = vectors.select(F.size("x").alias("width"), "x").groupBy("width", "x").agg(F.count(F.lit(1)).alias("_n"))
    return scratch.keep(rows.select("width", "x"), "fit")


def learn(distinct: DataFrame, components: int = COMPONENTS) -> dict[int, Whitener]:
    """Whitener of each vector length; what reaches the driver are sums by pair of dimensions, not rows."""
    spark = distinct.sparkSession

    def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list] = {}
        for batch in batches:
            for width, x, _ in by_width(batch, "x"):
                n, least, most = seen.get(width, (0, None, None))
                seen[width] = (n + len(x), x.min(0) if least is None else np.minimum(least, x.min(0)),
                               x.max(0) if most is None else np.maximum(most, x.max(0)))
        out = [(w, i, n, lo, hi) for w, (n, least, most) in seen.items()
               for i, (lo, hi) in enumerate([(0, 0), *zip(least.tolist(), most.tolist(), strict=True)], -1)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(list(zip(*out, strict=True)) or [()] * 5, EXTREMES, strict=True)],
            names=["width", "i", "n", "least", "most"])

    found = arrow(distinct.select("x"), extremes, "width int, i int, n long, least long, most long").groupBy("width", "i").agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))
    # One row per dimension.
    ranges: dict[int, dict[int, tuple]] = {}
    for r in found.collect():
        ranges.setdefault(r.width, {})[r.i] = (r.n, r.least, r.most)
    borders = {w: (np.array([own[i][1] for i in range(w)], np.int64), np.array([own[i][2] for i in range(w)], np.int64))
               for w, own in ranges.items()}
    sent = spark.sparkContext.broadcast(borders)

    def popcounts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = {w: Planes(*b) for w, b in sent.value.items()}
        for batch in batches:
            for width, x, _ in by_width(batch, "x"):
                planes[width].add(x)
        for width, own in planes.items():
            out = list(own.rows())
            for start in range(0, len(out), 1 << 16):
                part = list(zip(*out[start: start + (1 << 16)], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([width] * len(part[0]), pa.int32()),
                     *(pa.array(c, t) for c, t in zip(part, POPCOUNTS, strict=True))],
                    names=["width", "i", "j", "limb", "value"])

    totals = arrow(distinct.select("x"), popcounts, "width int, i int, j int, limb int, value long").groupBy(
        "width", "i", "j", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    sums = {w: [0] * w for w in ranges}
    products = {w: [[0] * w for _ in range(w)] for w in ranges}
    # One row per pair of dimensions and limb.
    for r in totals.toLocalIterator():
        value = int(r.value) << (LIMB_BITS * r.limb)
        if r.j < 0:
            sums[r.width][r.i] += value
        else:
            products[r.width][r.i][r.j] += value
    out = {}
    for w, own in ranges.items():
        n, u, least = own[-1][0], sums[w], borders[w][0].tolist()
        scatter = [[n * products[w][min(i, j)][max(i, j)] - u[i] * u[j] for j in range(w)] for i in range(w)]
        out[w] = solved(n, [u[i] + n * least[i] for i in range(w)], scatter, components)
    return out


EXTREMES = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
POPCOUNTS = [pa.int32(), pa.int32(), pa.int32(), pa.int64()]


def checked(distinct: DataFrame, model: dict[int, Whitener]) -> dict[int, Whitener]:
    """The model with the largest difference of the whitened fit list's covariance from the identity."""
    sent = distinct.sparkSession.sparkContext.broadcast(model)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for width, x, _ in by_width(batch, "x"):
                w = sent.value[width].whitened(x)
                with_one = np.concatenate((w, np.ones((len(w), 1))), axis=1)
                total[width] = total.get(width, 0) + with_one.T @ with_one
        out = [(w, i, j, t[i, j]) for w, t in total.items() for i in range(len(t)) for j in range(len(t))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(list(zip(*out, strict=True)) or [()] * 4,
                                            [pa.int32(), pa.int32(), pa.int32(), pa.float64()], strict=True)],
            names=["width", "i", "j", "value"])

    got = arrow(distinct.select("x"), moments, "width int, i int, j int, value double").groupBy("width", "i", "j").agg(
        F.sum("value").alias("value"))
    tables = {w: np.zeros((m.directions.shape[1] + 1,) * 2) for w, m in model.items()}
    for r in got.collect():
        tables[r.width][r.i, r.j] = r.value
    for w, t in tables.items():
        mean = t[-1, :-1] / model[w].n
        covariance = t[:-1, :-1] / model[w].n - np.outer(mean, mean)
        known = ~np.isnan(np.diag(covariance))
        gap = np.abs(covariance - np.eye(len(covariance)))[np.ix_(known, known)]
        model[w].error = float(gap.max()) if gap.size else None
    return model


def whitened(rows: DataFrame, scratch: Scratch, vector: str = "embedding", row_id: str = "vec_id",
             components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component."""
    usable_rows = rows.where(usable(F.col(vector))).select(row_id, integers(F.col(vector)).alias("x"))
    distinct = fit_list(usable_rows, scratch)
    model = checked(distinct, learn(distinct, components))
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, x, own in by_width(batch, "x"):
                m = sent.value[width]
                k = len(m.explained)
                if not k:
                    continue
                each = np.repeat(np.arange(len(x)), k)
                far = m.deviations(x)
                values = m.whitened(x).ravel()
                yield pa.RecordBatch.from_arrays([
                    own.column(row_id).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), m.n)),
                    pa.array([v if v < 2**63 else None for v in far], pa.int64()).take(pa.array(each)),
                    pa.array([str(v) for v in far]).take(pa.array(each)),
                    pa.array(values, mask=np.isnan(values)),
                    pa.array(m.explained * len(x), pa.float64()),
                    pa.array([m.error] * len(each), pa.float64()),
                ], names=[row_id, "component", "n", "deviation", "deviation_text", "whitened", "explained", "identity_error"])

    kind = dict(rows.dtypes)[row_id]
    return arrow(usable_rows, score, f"`{row_id}` {kind}, component int, n long, deviation long, deviation_text string, "
                                     "whitened double, explained double, identity_error double")
