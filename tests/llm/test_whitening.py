import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekly_mart.llm import whitening as module
from weekly_mart.llm.bidiagonal import bidiagonalise, right_vectors, singular_values
from weekly_mart.llm.queries import queries
from weekly_mart.llm.whitening import whiten

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
])
SF = "/root/testdata/sf0.001"


def brute(rows):
    """(n, deviations of the sound rows, V, centred rows) by whole numbers and numpy's covariance."""
    sound = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in sound], object)
    fit = np.array(sorted({tuple(r) for r in x.tolist()}), object)
    n, s = len(fit), fit.sum(axis=0)
    deviations = [int(((n * r - s) ** 2).sum()) for r in x]
    centred = ((n * fit - s) / n).astype(float)
    return n, [i for i, _ in sound], deviations, centred.T @ centred / n, ((n * x - s) / n).astype(float)


def check(spark, rows, components=16):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    out = whiten(df).collect()
    n, ids, deviations, v, centred = brute(rows)
    pairs = sorted(((r["vec_id"], r["deviation"]) for r in out), key=str)
    assert pairs == sorted(zip(ids, deviations, strict=True), key=str)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    assert {r["n"] for r in out} == {n}
    assert np.allclose(out[0]["explained"], values / np.trace(v), rtol=1e-9)
    assert out[0]["identity_error"] < 1e-8
    expected = centred @ vectors / np.sqrt(values)
    found = {(r["vec_id"], r["deviation"]): r["whitened"] for r in out}
    mine = np.array([found[key] for key in zip(ids, deviations, strict=True)])
    signs = np.sign((mine * expected).sum(axis=0))
    assert np.allclose(mine, expected * signs, atol=1e-7)


def test_against_numpy_with_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(k, [float(c) for c in rng.normal(size=24) * np.linspace(3, 0.5, 24)]) for k in range(400)]
    rows += [(1000 + k, rows[0][1]) for k in range(200)]  # a vector many rows share
    rows += [(None, rows[1][1]), (5, rows[2][1])]
    rows += [(2000, None), (2001, [None] * 24), (2002, [float("nan")] + [0.0] * 23), (2003, [float("inf")] * 24)]
    check(spark, rows)


def test_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(spark, rows)
    out = queries()["op12_embedding_whitening"](spark, SF)
    assert out.count() == 16 * len(rows)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    one = out.where("vec_id = 3").orderBy("component").collect()
    assert [r["component"] for r in one] == list(range(1, 17))


def test_triangles_are_merged_over_levels(spark, monkeypatch):
    monkeypatch.setattr(module, "FAN_IN", 2)
    monkeypatch.setattr(module, "BLOCK_ROWS", 7)
    rng = np.random.default_rng(9)
    check(spark, [(k, [float(c) for c in rng.normal(size=6)]) for k in range(300)], components=6)


def test_few_rows_low_rank_and_ragged_vectors(spark):
    def run(rows):
        return whiten(spark.createDataFrame(rows, SCHEMA)).collect()

    assert run([]) == []
    assert run([(1, None), (2, []), (3, [float("nan")])]) == []
    (single,) = run([(1, [1.0, 2.0])])
    assert (single["n"], single["deviation"], single["whitened"], single["explained"]) == (1, 0, [], [])
    line = run([(k, [float(k), 2.0 * k, 5.0]) for k in range(10)])  # one dimension is constant, two are one line
    assert all(len(r["whitened"]) == 1 for r in line) and line[0]["explained"] == pytest.approx([1.0])
    ragged = run([(1, [1.0]), (2, [1.0, 2.0]), (3, [0.0, 1.0]), (4, [1.0, 2.0, 3.0])])
    assert sorted(r["vec_id"] for r in ragged) == [2, 3]


def test_clashing_columns(spark):
    rows = [(k, [float(k % 7), float(k % 5), float(k % 3)]) for k in range(100)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "v", "x", "n", "d", "count", "deviation", "whitened", "explained", "part", "r"):
        df = df.withColumn(name, F.lit("x"))
    assert whiten(df).count() == 100


def test_deviations_stay_exact_until_no_long_holds_them():
    grid = np.array([[5_000_000, 1_000_000]], np.int64)
    model = module.Whitening(500, [500 * 1_000_000 + 3, 500 * 1_000_000], np.zeros(0), 0.0, np.zeros((2, 0)), 0.0)
    assert model.deviations(grid).tolist() == [(500 * 4_000_000 - 3) ** 2]
    with pytest.raises(OverflowError):
        module.Whitening(10**6, [10**12, 10**12], np.zeros(0), 0.0, np.zeros((2, 0)), 0.0).deviations(grid)


@pytest.mark.parametrize("kind", ["any", "graded", "rising", "rank", "equal", "identity", "one", "gaps"])
def test_bidiagonal_solver(kind):
    rng = np.random.default_rng(7)
    turn = lambda n: np.linalg.qr(rng.normal(size=(n, n)))[0]
    m = {
        "any": lambda: rng.normal(size=(50, 50)), "graded": lambda: rng.normal(size=(30, 30)) * np.logspace(0, -10, 30),
        "rising": lambda: rng.normal(size=(30, 30)) * np.logspace(-10, 0, 30),
        "rank": lambda: rng.normal(size=(20, 4)) @ rng.normal(size=(4, 20)),
        "equal": lambda: turn(20) @ np.diag([5.0] * 4 + [3] * 8 + [1] * 8) @ turn(20),
        "identity": lambda: np.eye(12), "one": lambda: np.array([[-2.0]]),
        "gaps": lambda: rng.normal(size=(20, 20)) * (np.arange(20) % 3 > 0),
    }[kind]()
    diagonal, above, right = bidiagonalise(m)
    values = singular_values(diagonal, above)
    assert np.allclose(values, np.linalg.svd(m, compute_uv=False), atol=1e-13 * values[0])
    k = min(10, int((values > 1e-12 * values[0]).sum()))
    z = right @ right_vectors(diagonal, above, values[:k])
    assert np.abs(z.T @ z - np.eye(k)).max() < 1e-10
    assert np.abs(m.T @ (m @ z) - z * values[:k] ** 2).max() < 1e-12 * values[0] ** 2
