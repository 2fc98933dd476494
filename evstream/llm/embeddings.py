"""Embedding near-duplicates: an exact metric range join over cells around pivots."""

from __future__ import annotations

import math
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from evstream.llm.common import components, grows, query, saved, table, without
from evstream.llm.minhash import mixed

COSINE = 0.95
CELL = 3000  # home vectors a task holds while the others of their cell pass by
PIVOTS = 1024  # or the square root of the vectors, if more: pivots only set how work is dealt, never what is linked
SLACK = 1e-9  # on bounds, for rounding


def unit_rows(raw: list[bytes | None], dtype: str) -> np.ndarray:
    """Vectors of one length, scaled to length 1 in double precision."""
    x = np.frombuffer(b"".join(raw), dtype).astype(np.float64).reshape(len(raw), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _usable(vectors: DataFrame, column: str) -> DataFrame:
    """``vec_id, raw`` (bytes of the components) and ``dim``; NULL where nothing can be linked."""
    kind = "f4" if vectors.schema[column].dataType.elementType == T.FloatType() else "f8"

    def run(batches):
        for b in batches:
            raw, dim = [], []
            for v in b.column(column).to_pylist():
                ok = v is not None and len(v) > 0 and None not in v
                x = np.array(v, f"<{kind}") if ok else None
                ok = ok and bool(np.isfinite(x).all() and x.any())
                raw.append((x + 0.0).tobytes() if ok else None)  # -0.0 and 0.0 are the same
                dim.append(len(x) if ok else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").cast(pa.int64()), pa.array(raw, pa.binary()), pa.array(dim, pa.int32())],
                names=["vec_id", "raw", "dim"])

    return vectors.select("vec_id", column).mapInArrow(run, "vec_id long, raw binary, dim int"), f"<{kind}"


def _assigned(classes: DataFrame, pivots: dict[int, np.ndarray], dtype: str) -> DataFrame:
    """Each vector's home: the nearest pivot of its length, and its distance."""

    def run(batches):
        for b in batches:
            raw, dims = b.column("raw").to_pylist(), np.array(b.column("dim").to_pylist(), np.int64)
            cell, dist = np.zeros(len(raw), np.int32), np.zeros(len(raw))
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                if d in pivots:
                    far = np.sqrt(np.maximum(0, 2 - 2 * unit_rows([raw[i] for i in at], dtype) @ pivots[d].T))
                    cell[at], dist[at] = far.argmin(axis=1), far.min(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(dist)],
                                             names=[*b.schema.names, "cell", "dist"])

    return classes.mapInArrow(run, T.StructType([
        *classes.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("dist", T.DoubleType())]))


def _dealt(homes: DataFrame, pivots, cells: dict, eps: float, dtype: str) -> DataFrame:
    """A row for each block of each cell that may hold a neighbour of the vector.

    For a home vector u of cell j within eps of v, the triangle inequality gives both
    d(v, p_j) <= radius_j + eps and d(v, p_j) <= d(v, p_home) + 2 eps, and u lies on p_j's side of
    the plane between the pivots, so v is at most eps behind it. Cells of one vector that fail any
    of these need not see it.
    """

    def run(batches):
        for b in batches:
            rows = b.to_pydict()
            raw, dims, home = rows["raw"], np.array(rows["dim"], np.int64), np.array(rows["cell"], np.int64)
            # Hashed, since ids may have a step in common with the number of blocks.
            deal = mixed(np.array(rows["rep"], np.int64).view(np.uint64)).tolist()
            out = []
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                if d in pivots:
                    p = pivots[d]
                    far = np.sqrt(np.maximum(0, 2 - 2 * unit_rows([raw[i] for i in at], dtype) @ p.T))
                    near = far[np.arange(len(at)), home[at], None]
                    apart = np.sqrt(np.maximum(0, 2 - 2 * p @ p.T))[home[at]]
                    radius = np.array([cells.get((int(d), j), (0, -9.0))[1] for j in range(len(p))])
                    reach = ((far <= radius + eps + SLACK) & (far <= near + 2 * eps + SLACK)
                             & (far ** 2 - near ** 2 <= 2 * eps * apart + SLACK))
                else:
                    reach = np.ones((len(at), 1), bool)
                for i, j in zip(*np.nonzero(reach), strict=True):
                    i, j = int(at[i]), int(j)
                    blocks = cells[int(d), j][0] if (int(d), j) in cells else 0
                    own = deal[i] % blocks if blocks and j == home[i] else -1
                    for k in range(blocks):
                        if k == own:
                            out.append((int(d), j, k, 0, rows["rep"][i], rows["n"][i], raw[i]))
                        out.append((int(d), j, k, 1, rows["rep"][i], rows["n"][i], raw[i]))
                    if len(out) >= 2000:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)
                        out = []
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

    arrow = pa.schema([("dim", pa.int32()), ("cell", pa.int32()), ("block", pa.int32()), ("side", pa.int32()),
                       ("rep", pa.int64()), ("n", pa.int64()), ("raw", pa.binary())])
    return homes.select("rep", "n", "raw", "dim", "cell").mapInArrow(
        run, "dim int, cell int, block int, side int, rep long, n long, raw binary")


def _joined(batches, least: float, dtype: str):
    """Rows sorted by (dim, cell, block, side): the home vectors are held, the others stream by.

    Gives (0, home, vectors linked to it) and (1, a, b): links thinned to what connects the same
    vectors, a row for each streamed vector and each merger of classes at most.
    """
    out: list[tuple[int, int, int]] = []

    def flush(force=False):
        nonlocal out
        if out and (force or len(out) >= 20_000):
            a = np.array(out, np.int64)
            out = []
            yield pa.RecordBatch.from_arrays([pa.array(a[:, 0].astype(np.int32)), pa.array(a[:, 1]), pa.array(a[:, 2])],
                                             names=["kind", "a", "b"])

    def parts():
        for b in batches:
            rows = list(zip(*[c.to_pylist() for c in b.columns], strict=True))
            for key, group in groupby(rows, key=lambda r: r[:4]):
                yield key, list(group)

    homes, key = None, None
    big = np.iinfo(np.int64).max

    def close():
        if homes is not None:
            out.extend((0, int(i), int(c) - 1) for i, c in zip(homes["ids"], homes["links"], strict=True))

    for (d, cell, block, side), rows in parts():
        if (d, cell, block) != key:
            close()
            homes, key = None, (d, cell, block)
        ids = np.array([r[4] for r in rows], np.int64)
        x = unit_rows([r[6] for r in rows], dtype)
        if side == 0:
            if homes is None:
                homes = {"ids": ids, "x": x}
            else:
                homes = {"ids": np.r_[homes["ids"], ids], "x": np.r_[homes["x"], x]}
            homes |= {"label": homes["ids"].copy(), "links": np.zeros(len(homes["ids"]), np.int64)}
            continue
        if homes is None:
            continue
        near = homes["x"] @ x.T >= least
        u, v = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        near = near[np.ix_(u, v)]
        homes["links"][u] += near @ np.array([r[5] for r in rows], np.int64)[v]
        label, ids = homes["label"][u], ids[v]
        while len(u):
            mine = np.minimum(np.where(near, label[:, None], big).min(axis=0), ids)
            new = np.minimum(np.where(near, mine[None, :], big).min(axis=1), label)
            moved = new < label
            out.extend((1, int(p), int(q)) for p, q in set(zip(label[moved].tolist(), new[moved].tolist(), strict=True)))
            label = new
            if not moved.any():
                out.extend((1, int(p), int(q)) for p, q in zip(ids, mine, strict=True) if p != q)
                break
        homes["label"][u] = label
        yield from flush()
    close()
    yield from flush(True)


def near_vectors(vectors: DataFrame, column: str = "embedding", least: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Two vectors of one length are linked if their cosine, in double precision, is at least
    ``least``. NULL, zero and empty vectors and those with a NULL or non-finite component have no
    links, nor do rows without an id. Equal vectors are joined once and counted as often as they
    occur; different vectors under one id are judged each by its own. All vectors within reach are compared whatever their number; a crowded cell is cut
    into blocks of home vectors, which the rest of the cell passes by.
    """
    eps = float(np.sqrt(2 - 2 * least))
    rows, dtype = _usable(without(vectors, "raw", "dim"), column)
    rows = saved(rows.withColumn("key", F.md5("raw")), "vectors")
    classes = rows.where("raw is not null and vec_id is not null").groupBy("key").agg(
        F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("n"), F.first("raw").alias("raw"), F.first("dim").alias("dim"))
    # Classes of equal vectors bear numbers of their own, fixed by writing them: an id may name several.
    classes = saved(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    n = classes.count()
    wanted = min(-(-n // CELL), max(PIVOTS, math.isqrt(n)))
    pivots: dict[int, list[bytes]] = {}
    for r in classes.orderBy(F.xxhash64("key"), "rep").limit(wanted).select("dim", "raw").collect():
        pivots.setdefault(r["dim"], []).append(bytes(r["raw"]))
    units = {d: unit_rows(v, dtype) for d, v in pivots.items()}
    homes = saved(_assigned(classes, units, dtype), "homes")
    cells = {(r["dim"], r["cell"]): (-(-r["n"] // CELL), r["radius"]) for r in homes.groupBy("dim", "cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("dist").alias("radius")).collect()}  # a row for each pivot
    by = ["dim", "cell", "block"]
    dealt = _dealt(homes, units, cells, eps, dtype).repartition(*by).sortWithinPartitions(*by, "side")
    found = saved(dealt.select(*by, "side", "rep", "n", "raw").mapInArrow(
        lambda b: _joined(b, least, dtype), "kind int, a long, b long"), "links")
    counts = found.where("kind = 0").select(F.col("a").alias("rep"), F.col("b").alias("_n"))
    joint = components(found.where("kind = 1")).withColumnRenamed("node", "rep")
    of = classes.select("key", "rep", "least_id").join(counts, "rep", "left").join(joint, "rep", "left")
    of = of.withColumn("component", F.coalesce("component", "rep"))
    lowest = of.groupBy("component").agg(F.min("least_id").alias("lowest_id"))
    of = of.join(grows(lowest), "component").select("key", "_n", "lowest_id")
    out = rows.select("vec_id", "key").join(of, "key", "left")
    none = F.col("vec_id").isNull()
    return out.select(
        "vec_id", F.when(none, 0).otherwise(F.coalesce("_n", F.lit(0))).cast("long").alias("n_links"),
        F.when(~none, F.coalesce("lowest_id", "vec_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


@query("op1_embedding_join")
def op1_embedding_join(spark, folder):
    return near_vectors(table(spark, folder, "embeddings"))
