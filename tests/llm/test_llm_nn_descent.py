import numpy as np
import pytest

from tidemark.llm import nn_descent

SCHEMA = "vec_id long, embedding array<float>, label int, node string, half string, a string"


def table(spark, rows):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows]
    return spark.createDataFrame([(i, v, 0, "x", "x", "x") for i, v in rows], SCHEMA)


def brute_force(rows, queries, k):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v) and len(v) == 4:
            good.setdefault(i, []).append(np.array(v, np.float32).astype(float))
    out = {}
    for q in queries:
        if q in good:
            found = sorted((min(float(np.sqrt(((good[q][0] - v) ** 2).sum())) for v in vs), i)
                           for i, vs in good.items() if i != q)
            out[q] = found[:k]
    return out


def result(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(got[r.query_id])
    return got


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0, 0, 0]), (1, [1.0, 0, 0, 0]), (2, [1.0, 0, 0, 0]), (3, [1.0, 0, 0, 0.5]), (3, [1.0, 0, 0, 0.5]),
        (4, None), (5, []), (6, [0.0, 0, 0, 0]), (7, [1.0, nan, 0, 0]), (8, [1.0, inf, 0, 0]), (9, [1.0, None, 0, 0]),
        (10, [1.0, 0, 0]), (None, [1.0, 0, 0, 0]), (11, [-1.0, 2, 0, 0]), (12, [-1.0, -2, 0, 0]),
    ]
    df = table(spark, rows)
    for k in (2, 10):
        got = result(nn_descent.nearest_neighbours(df, df, k))
        want = brute_force(rows, [i for i, _ in rows], k)
        assert {q: [(pytest.approx(s), i) for s, i in v] for q, v in want.items()} == got


def test_many_copies(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(0, 300, 2)]
    rows += [(i, rng.standard_normal(4).tolist()) for i in range(1, 200, 2)]
    df = table(spark, rows)
    got = result(nn_descent.nearest_neighbours(df.where("vec_id % 50 = 0"), df, 10))
    want = brute_force(rows, range(0, 300, 50), 10)
    assert {q: [i for _, i in v] for q, v in got.items()} == {q: [i for _, i in v] for q, v in want.items()}


def test_empty_and_alone(spark):
    empty = table(spark, []).where("false")
    assert nn_descent.nearest_neighbours(empty, empty).count() == 0
    alone = table(spark, [(0, [1.0, 2, 3, 4])])
    assert nn_descent.nearest_neighbours(alone, alone).count() == 0


def test_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], float)
    got = result(nn_descent.op4_nn_descent(spark, sf))
    assert set(got) == set(ids[ids % 100 == 0])
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        best = set(ids[np.lexsort((ids, d))[:10]])
        hits += len(best & {i for _, i in found})
        assert found == [(pytest.approx(d[ids == i][0]), i) for _, i in found]
    assert hits >= 0.9 * 10 * len(got)


def hits_of(spark, monkeypatch, rows, queries, entries=8):
    """Share of the 10 nearest found, with few entry nodes so that the graph has to lead the way."""
    monkeypatch.setattr(nn_descent, "ENTRIES", entries)
    df = table(spark, rows)
    got = result(nn_descent.nearest_neighbours(df.where(df["vec_id"].isin(queries)), df, 10))
    x = np.array([v for _, v in rows], np.float32).astype(float)
    hits = 0
    for q in queries:
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        hits += len(set(np.argsort(d, kind="stable")[:10].tolist()) & {i for _, i in got[q]})
    return hits / (10 * len(queries))


def test_one_huge_vector(spark, monkeypatch):
    x = np.random.default_rng(3).standard_normal((3000, 16))
    x[7] *= 1e8
    rows = list(enumerate(x.tolist()))
    assert hits_of(spark, monkeypatch, rows, list(range(10, 3000, 100))) >= 0.9


def test_near_copies(spark, monkeypatch):
    """A third of the rows lies within 1e-5 of one vector."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((3000, 16))
    x[::3] = x[0] + rng.standard_normal((1000, 16)) * 1e-5
    rows = list(enumerate(x.tolist()))
    assert hits_of(spark, monkeypatch, rows, list(range(0, 3000, 90))) >= 0.9


def test_distances_of_any_scale():
    x = np.random.default_rng(5).standard_normal((60, 8))
    x[20:40] = x[0] + (x[20:40] - x[0]) * 1e-9
    x[50] *= 1e9
    want = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    assert np.allclose(nn_descent.distances(x), want, rtol=1e-6, atol=0)


def test_recall_where_trees_and_entries_say_little(spark, monkeypatch):
    """20,000 vectors in 200 clusters, trees of a few leaves and 32 entry nodes: what is found comes from the graph."""
    monkeypatch.setattr(nn_descent, "TREE_SAMPLE", 64)
    monkeypatch.setattr(nn_descent, "ENTRIES", 32)
    rng = np.random.default_rng(5)
    n = 20_000
    x = (rng.standard_normal((200, 32))[rng.integers(0, 200, n)] + 0.15 * rng.standard_normal((n, 32))).astype(np.float32)
    df = table(spark, [(i, v.tolist()) for i, v in enumerate(x)]).repartition(8)
    got = result(nn_descent.nearest_neighbours(df.where("vec_id % 100 = 0"), df, 10))
    assert set(got) == set(range(0, n, 100))
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        d[q] = np.inf
        hits += len({i for _, i in found} & set(np.argsort(d, kind="stable")[:10].tolist()))
    print(f"recall {hits / (10 * len(got)):.4f}")
    assert hits >= 0.9 * 10 * len(got)
