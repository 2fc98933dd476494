"""Whitening against an eigenvalue solver, and its own promises."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from evstream.llm import whitening as w
from evstream.llm.common import table
from evstream.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def usable(rows):
    return [(i, [float(np.float64(c)) for c in v]) for i, v in rows
            if v and all(c is not None and np.isfinite(c) for c in v)]


def restated(rows):
    """{(id, component): n, deviation, whitened, explained} up to the sign of a component."""
    x = np.floor(1024 * np.array([v for _, v in rows])).astype(np.int64).astype(object) + 100_000
    n, s = len(x), x.sum(0)
    deviation = ((n * x - s) ** 2).sum(1)
    c = ((n * x - s) / n).astype(np.float64)
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    k = min(8, int((e > 1e-10 * e[0]).sum()))
    return n, deviation, (c @ u[:, :k]) / np.sqrt(e[:k]), e[:k] / e.sum()


def compare(df, rows):
    n, deviation, want, explained = restated(rows)
    got = {}
    for r in df.collect():
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    assert {r["n"] for v in got.values() for r in v.values()} == {n}
    assert max(r["identity_error"] for v in got.values() for r in v.values()) < 1e-9
    for k in range(want.shape[1]):
        mine = np.array([got[i][k + 1]["whitened"] for i, _ in rows])
        assert min(np.abs(mine - want[:, k]).max(), np.abs(mine + want[:, k]).max()) < 1e-8, k
        assert abs(got[rows[0][0]][k + 1]["explained"] / explained[k] - 1) < 1e-9
    assert [int(got[i][1]["deviation"]) for i, _ in rows] == list(deviation)
    assert {len(v) for v in got.values()} == {want.shape[1]} and len(got) == len(rows)


def test_factor_and_rotations():
    r = np.random.default_rng(1)
    for d, rank in ((1, 1), (5, 5), (7, 3), (33, 33), (64, 20)):
        a = r.normal(size=(d, rank)) * 10.0 ** r.integers(-3, 4, rank)
        v = a @ a.T
        l = w.pivoted_cholesky(v)  # noqa: E741
        assert l.shape[1] <= d and np.allclose(l @ l.T, v, atol=1e-9 * np.abs(v).max())
        e, u = w.jacobi(l)
        assert np.allclose(e[:rank], np.linalg.eigvalsh(v)[::-1][:rank], rtol=1e-6, atol=1e-12 * e[0])
        assert np.allclose(u.T @ u, np.eye(len(e)), atol=1e-9) and (np.diff(e) <= 0).all()
    assert w.pivoted_cholesky(np.zeros((4, 4))).shape == (4, 0)
    pairs = [(int(a), int(b)) for p, q in w._rounds(7) for a, b in zip(p, q)]
    assert sorted(pairs) == [(i, j) for i in range(7) for j in range(i + 1, 7)]


def test_products_are_exact():
    r = np.random.default_rng(2)
    for top in (10, 2**20, 2**30, 2**52):
        y = r.integers(-top, top, (50, 3))
        assert (w._products(y) == y.astype(object).T @ y.astype(object)).all()
    assert (w._products(np.zeros((4, 2), np.int64)) == 0).all()


@pytest.mark.parametrize("d", [1, 3, 12])
def test_whitening(spark, d):
    r = np.random.default_rng(d)
    mix = r.normal(size=(d, d))
    rows = [(i, (mix @ r.normal(size=d) + 5).tolist()) for i in range(200)]
    bad = [(900, None), (901, [None] + [1.0] * (d - 1)), (902, [float("nan")] * d), (903, [float("inf")] * d), (904, [])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumns({n: F.lit(1) for n in ("x", "dim", "n", "w", "v")})
    compare(w.whitened(df.repartition(5)), rows)


def test_lengths_ranks_ids_and_large_entries(spark):
    r = random.Random(3)
    flat = [(i, [r.random(), 1.0, 2.0]) for i in range(20)]  # rank 1
    other = [(100 + i, [r.random(), r.random()]) for i in range(20)]
    df = spark.createDataFrame([*flat, *other, (None, [0.5, 0.5])], "vec_id long, embedding array<double>")
    out = w.whitened(df).collect()
    assert sum(x["vec_id"] is None for x in out) == 2 and {x["n"] for x in out if x["vec_id"] is None} == {21}
    assert {x["component"] for x in out if x["vec_id"] is not None and x["vec_id"] < 100} == {1}
    same = spark.createDataFrame([(1, [1.0, 2.0])] * 3, "vec_id long, embedding array<double>")
    assert w.whitened(same).count() == 0 and w.whitened(df.limit(0)).count() == 0
    huge = spark.createDataFrame([(1, [1e300]), (2, [-1e300]), (3, [0.0])], "vec_id long, embedding array<double>")
    assert [round(x["whitened"], 9) for x in w.whitened(huge).orderBy("vec_id").collect()] == [round(1.5**0.5, 9), -round(1.5**0.5, 9), 0.0]


def test_repeated_rows_count(spark):
    rows = [(1, [0.0, 1.0]), (1, [0.0, 1.0]), (2, [1.0, 0.25]), (3, [0.5, 0.75]), (3, [2.0, 0.0])]
    out = w.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(out) == 10 and {x["n"] for x in out} == {5} and max(x["identity_error"] for x in out) < 1e-12


def test_registered_query(spark):
    rows = usable([(r["vec_id"], r["embedding"]) for r in table(spark, DATA, "embeddings").select("vec_id", "embedding").collect()])
    out = QUERIES["op11_whitening"](spark, DATA)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(out, rows)
