"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its factor."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from evstream.llm.common import query, saved, table

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LARGEST = 2.0**52  # scaled entries are held within this, so that they stay exact in double precision
EXACT = 2.0**53  # sums of products below this are exact in double precision
SWEEPS = 60


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """A factor ``l`` with ``l @ l.T`` equal to ``v``, a column for each step.

    Every step takes the largest diagonal entry left; once none stands out of rounding, the rank
    is reached and the rest is left out. Rows are in the order of ``v``; in the order of the pivots
    the factor is lower triangular.
    """
    d = v.shape[0]
    rest = v.astype(np.float64).copy()
    diagonal = rest.diagonal().copy()
    least = d * np.finfo(np.float64).eps * max(diagonal.max(initial=0.0), 0.0)
    columns = []
    for _ in range(d):
        p = int(diagonal.argmax())
        if not diagonal[p] > least:
            break
        c = rest[:, p] / np.sqrt(diagonal[p])
        columns.append(c)
        rest -= np.outer(c, c)
        diagonal = rest.diagonal().copy()
        rest[p, :] = rest[:, p] = 0.0
        diagonal[p] = 0.0
    return np.array(columns).T if columns else np.zeros((d, 0))


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of ``n`` columns, in rounds of disjoint ones."""
    m = n + n % 2
    ring = np.arange(m)
    for _ in range(m - 1):
        p, q = ring[:m // 2], ring[m // 2:][::-1]
        real = (p < n) & (q < n)
        yield np.minimum(p, q)[real], np.maximum(p, q)[real]
        ring = np.r_[ring[0], ring[-1], ring[1:-1]]


def jacobi(l: np.ndarray) -> tuple[np.ndarray, np.ndarray]:  # noqa: E741
    """Eigenvalues, falling, and unit eigenvectors (columns) of ``l @ l.T``.

    Columns are rotated in pairs until all are at right angles. Rotations from the right leave
    ``l @ l.T`` as it is, so squared column norms are its eigenvalues and the columns their vectors.
    The sign of a vector makes its largest entry, the first of equals, positive.
    """
    a = l.copy()
    for _ in range(SWEEPS):
        turned = False
        for p, q in _rounds(a.shape[1]):
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            turn = np.abs(xy) > 1e-15 * np.sqrt(xx * yy)
            if not turn.any():
                continue
            turned = True
            p, q, x, y = p[turn], q[turn], x[:, turn], y[:, turn]
            zeta = (yy - xx)[turn] / (2 * xy[turn])
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1 / np.hypot(1.0, t)
            a[:, p], a[:, q] = c * x - c * t * y, c * t * x + c * y
        if not turned:
            break
    e = (a * a).sum(0)
    order = np.argsort(-e, kind="stable")
    e, u = e[order], a[:, order] / np.sqrt(e[order])
    lead = u[np.abs(u).argmax(0), np.arange(u.shape[1])] if len(e) else np.zeros(0)
    return e, u * np.where(lead < 0, -1.0, 1.0)


def _scaled(vectors: DataFrame, column: str) -> DataFrame:
    """``vec_id, x, dim`` of every vector without NULL or non-finite entries."""

    def run(batches):
        for b in batches:
            ids, v = b.column("vec_id").cast(pa.int64()), b.column("v")
            lengths = v.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = v.flatten()
            c = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False).astype(np.float64)
            bad = np.bincount(np.repeat(np.arange(len(v)), lengths)[~np.isfinite(c)], minlength=len(v)) > 0
            good = ~bad & (lengths > 0)
            c = c[np.repeat(good, lengths)]
            x = np.clip(np.floor(SCALE * c), -LARGEST, LARGEST).astype(np.int64) + SHIFT
            offsets = np.r_[0, np.cumsum(lengths[good])].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [ids.filter(pa.array(good)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(x)),
                 pa.array(lengths[good], pa.int32())], names=["vec_id", "x", "dim"])

    return vectors.select("vec_id", F.col(column).cast("array<double>").alias("v")).mapInArrow(
        run, "vec_id long, x array<long>, dim int")


def _blocks(batches) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray]]:
    """The rows of each batch by length of vector: which rows, and their entries."""
    for b in batches:
        dims = b.column("dim").to_numpy()
        flat = b.column("x").flatten().to_numpy()
        at = np.r_[0, np.cumsum(dims)]
        for d in np.unique(dims).tolist():
            rows = np.flatnonzero(dims == d)
            yield b.take(pa.array(rows)), d, flat[at[rows][:, None] + np.arange(d)]


def _products(y: np.ndarray) -> np.ndarray:
    """``y.T @ y`` of whole numbers, exact: in double precision as far as sums fit, else by integers."""
    top = float(np.abs(y).max(initial=0.0))
    step = int(min(len(y), EXACT // (top * top))) if top else len(y)
    if step < 1:
        wide = y.astype(object)
        return wide.T @ wide
    total = np.zeros((y.shape[1],) * 2, object)
    for i in range(0, len(y), step):
        part = y[i:i + step].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


def _scatter(rows: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """``dim, i, j, s``: exact sums of products of entries centred by whole numbers, for i <= j."""
    schema = pa.schema([("dim", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("s", pa.decimal128(38, 0))])

    def run(batches):
        from decimal import Decimal

        sums: dict[int, np.ndarray] = {}
        for _, d, x in _blocks(batches):
            sums[d] = sums.get(d, 0) + _products(x - centres[d])
        for d, s in sums.items():
            for i in range(d):  # a row of the matrix at a time
                yield pa.RecordBatch.from_arrays([
                    pa.array([d] * (d - i), pa.int32()), pa.array([i] * (d - i), pa.int32()), pa.array(range(i, d), pa.int32()),
                    pa.array([Decimal(int(v)) for v in s[i, i:]], pa.decimal128(38, 0))], schema=schema)

    made = rows.select("vec_id", "x", "dim").mapInArrow(run, "dim int, i int, j int, s decimal(38,0)")
    return made.groupBy("dim", "i", "j").agg(F.sum("s").cast("decimal(38,0)").alias("s"))


def fitted(rows: DataFrame) -> dict[int, dict]:
    """For each length of vector: count, sums, centre and the leading components of the covariance.

    Sums and products are exact whole numbers, so the model does not depend on how rows are dealt.
    The driver receives d sums and d * d / 2 products for vectors of length d, however many rows.
    """
    flat = rows.select("dim", F.posexplode("x").alias("i", "v")).groupBy("dim", "i").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s"))
    models: dict[int, dict] = {}
    for r in flat.orderBy("dim", "i").collect():
        m = models.setdefault(r["dim"], {"n": r["n"], "sums": []})
        m["sums"].append(int(r["s"]))
    for m in models.values():
        m["centre"] = np.array([(2 * s + m["n"]) // (2 * m["n"]) for s in m["sums"]], np.int64)
    moments = {d: np.zeros((d, d), object) for d in models}
    for r in _scatter(rows, {d: m["centre"] for d, m in models.items()}).collect():
        moments[r["dim"]][r["i"], r["j"]] = moments[r["dim"]][r["j"], r["i"]] = int(r["s"])
    for d, m in models.items():
        n = m["n"]
        off = np.array([s - n * int(c) for s, c in zip(m["sums"], m["centre"], strict=True)], object)
        exact = n * moments[d] - np.outer(off, off)  # n * n times the covariance
        v = np.array([[x / (n * n) for x in row] for row in exact], np.float64)
        e, u = jacobi(pivoted_cholesky(v))
        m |= {"off": np.array([x / n for x in off], np.float64), "trace": float(sum(exact.diagonal())) / n / n, "e": e, "u": u}
    return models


def whitened(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row for each usable
    vector and each of the leading components.

    Entries are scaled to whole numbers, floor(1024 c) + 100000 (held within 2^52 in size before the
    shift). Rows whose vector is NULL, empty or holds a NULL or non-finite entry go. Vectors of
    different lengths cannot share a covariance: each length is fitted by itself, with its own n.
    Components whose eigenvalue is zero up to rounding have no rows, so fewer than ``components``
    come out if the rank is smaller, none if all vectors are equal. Among equal eigenvalues the
    components are any base of their space. ``deviation`` is a decimal; repeated rows and rows
    without an id count and come out as often as they occur. An empty table gives an empty one.
    """
    rows = saved(_scaled(vectors, column), "scaled")
    models = fitted(rows)

    def run(batches):
        from decimal import Decimal

        for b, d, x in _blocks(batches):
            m = models[d]
            k = min(components, len(m["e"]))
            w = ((x - m["centre"]) - m["off"]) @ m["u"][:, :k] / np.sqrt(m["e"][:k])
            n, sums = m["n"], np.array(m["sums"], object)
            near = np.abs(x - m["centre"]).max(initial=0) + 1
            if float(n) * n * near * near * d < 2.0**62:
                deviation = ((n * (x - m["centre"]) - (sums - n * m["centre"].astype(object)).astype(np.int64)) ** 2).sum(1).tolist()
            else:
                deviation = [int(((n * r.astype(object) - sums) ** 2).sum()) for r in x]
            yield pa.RecordBatch.from_arrays([
                b.column("vec_id"), pa.array([d] * len(x), pa.int32()),
                pa.array([Decimal(v) if v < 10**38 else None for v in deviation], pa.decimal128(38, 0)),
                pa.array(list(w), pa.list_(pa.float64()))], names=["vec_id", "dim", "deviation", "w"])

    done = saved(rows.mapInArrow(run, "vec_id long, dim int, deviation decimal(38,0), w array<double>"), "whitened")
    facts = []
    for d, m in models.items():
        k = min(components, len(m["e"]))
        facts += [(d, i + 1, m["n"], float(m["e"][i] / m["trace"]), error) for error in [_identity_error(done, d, k)] for i in range(k)]
    facts = rows.sparkSession.createDataFrame(facts, "dim int, component int, n long, explained double, identity_error double")
    each = done.select("vec_id", "dim", "deviation", F.posexplode("w").alias("_at", "whitened")).withColumn("component", F.col("_at") + 1)
    return each.join(F.broadcast(facts), ["dim", "component"]).select(  # a few rows for each length of vector
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def _identity_error(done: DataFrame, dim: int, k: int) -> float:
    """Largest entry of the covariance of what came out, less the identity. Two passes: means first."""
    if not k:
        return 0.0
    own = done.where(F.col("dim") == dim)
    means = own.agg(*[F.avg(F.col("w")[i]) for i in range(k)]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    got = own.agg(*[F.avg((F.col("w")[i] - F.lit(means[i])) * (F.col("w")[j] - F.lit(means[j]))) for i, j in pairs]).first()
    return float(max(abs(c - (i == j)) for (i, j), c in zip(pairs, got, strict=True)))


@query("op11_whitening")
def op11_whitening(spark, folder):
    out = whitened(table(spark, folder, "embeddings"))
    return out.withColumn("deviation", F.expr("try_cast(deviation as long)"))  # NULL beyond 64 bits
