"""Centroid clustering and vector codes against SQL, plain Python and hard inputs."""

import hashlib

import duckdb
import numpy as np
import pytest

from tidemark.llm import active_lloyd, ptolemaic

NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    """embeddings from (vec_id, vector, label), with further columns of clashing names."""
    schema = ("vec_id long, embedding array<double>, label int, x string, code string, cluster string, far string, "
              "distance string, error string, to_pivots string, part string, held string, __key string, n string")
    return spark.createDataFrame([(*r, *"xxxxxxxxxxx") for r in rows], schema)


def vectors(n, width, seed=1, spread=1.0):
    """A third of the vectors within a hair of one, some exact copies, the rest in loose groups."""
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((6, width))
    rows = centers[rng.integers(0, 6, n)] + spread * rng.standard_normal((n, width))
    rows[: n // 3] = rows[0] + 1e-3 * rng.standard_normal((n // 3, width))
    rows[n // 3: n // 3 + n // 10] = rows[0]
    return rows


def floor_all(v, scale):
    return [int(np.floor(scale * x)) for x in v]


def far(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def nearest(x, entries):
    return min((far(x, e), i) for i, e in enumerate(entries))


def lloyd(points, entries, rounds):
    """Plain Lloyd rounds on lists of Python integers, complete scans: (numbers, distances, entries)."""
    for _ in range(rounds):
        placed = [nearest(x, entries)[1] for x in points]
        for k in range(len(entries)):
            own = [x for x, p in zip(points, placed, strict=True) if p == k]
            if own:
                entries = [*entries[:k], [sum(c) // len(own) for c in zip(*own, strict=True)], *entries[k + 1:]]
    found = [nearest(x, entries) for x in points]
    return [i for _, i in found], [d for d, _ in found], entries


@pytest.mark.parametrize("name", ["op11_ptolemaic", "op12_active_lloyd"])
def test_query_equals_sql(spark, sf, name):
    module = ptolemaic if name.startswith("op11") else active_lloyd
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    df, want = getattr(module, name)(spark, sf), con.sql(module.ORACLE)
    assert sorted(df.columns) == sorted(want.columns)
    assert sorted(map(tuple, df.select(*want.columns).collect())) == sorted(want.fetchall())


def test_clusters_equal_brute_force(spark):
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(vectors(300, 6))]
    got, centroids = ptolemaic.cluster(frame(spark, rows).repartition(5), clusters=9, rounds=4, width=6, scale=64)
    points = [floor_all(v, 64) for _, v, _ in rows]
    order = sorted(range(300), key=lambda i: hashlib.sha256(f"3:{i}".encode()).hexdigest())
    number, distance, entries = lloyd(points, [points[i] for i in order[:9]], 4)
    found = {r.vec_id: r for r in got.collect()}
    assert [found[i].cluster for i in range(300)] == number
    assert [found[i].distance for i in range(300)] == distance
    assert centroids.tolist() == entries
    for r in found.values():
        assert r.inertia == sum(distance)
        assert r.cluster_inertia == sum(d for d, n in zip(distance, number, strict=True) if n == r.cluster)


def test_bounds_never_exceed_distances_and_rule_out():
    rng = np.random.default_rng(3)
    for scale in (3, 1000, 10**7):
        x = rng.integers(-scale, scale, (400, 8))
        pivots, centroids = x[:5], np.concatenate([x[:2], rng.integers(-scale, scale, (5, 8))])
        bounds = ptolemaic.Bounds(pivots)
        least = bounds.below(bounds.distances(x), bounds.distances(centroids))
        exact = np.array([[far(a, b) for b in centroids.tolist()] for a in x.tolist()], float)
        assert (least <= exact).all()
        number, distance, measured = bounds.nearest(x, bounds.distances(x), centroids)
        assert number.tolist() == exact.argmin(axis=1).tolist()
        assert (distance == exact.min(axis=1)).all()
        assert measured < len(x) * len(centroids)


def test_ties_go_to_the_smaller_number():
    x = np.array([[0, 0], [2, 0], [1, 5]])
    bounds = ptolemaic.Bounds(np.array([[0, 0], [9, 0], [0, 9]]))
    centroids = np.array([[1, 0], [-1, 0], [1, 0], [3, 0]])
    number, distance, _ = bounds.nearest(x, bounds.distances(x), centroids)
    assert number.tolist() == [0, 0, 0] and distance.tolist() == [1, 1, 25]


@pytest.mark.parametrize("which", ["clusters", "codes"])
def test_odd_vectors(spark, which):
    """Nulls, other widths, infinite and huge components, repeated rows and ids, rows without an id."""
    good = vectors(30, 4).tolist()
    rows = [(i, v, None if i % 4 == 0 else i % 2) for i, v in enumerate(good)]
    rows += [(0, good[0], 1), (0, good[1], 1), (None, good[2], None), (None, good[2], None)]
    out = [(100, None, 1), (101, [], 1), (102, [1.0, None, 0.0, 0.0], 1), (103, [NAN, 0.0, 0.0, 0.0], 1),
           (104, [INF, 0.0, 0.0, 0.0], 2), (105, [-INF, 0.0, 0.0, 0.0], 2), (106, [1.0, 2.0], 2), (107, [1.0] * 8, 2)]
    huge = [(200, [1e300, 0.0, -1e300, 1.0], 1), (201, [3e9, 0.0, 0.0, 0.0], 1)]
    df = frame(spark, rows + out + huge)
    if which == "clusters":
        got = ptolemaic.cluster(df, clusters=3, rounds=3, width=4)[0].collect()
        assert max(r.distance for r in got) <= 2**63 - 1 and all(r.distance >= 0 for r in got)
    else:
        got = active_lloyd.compress(df, parts=2, entries=5)[0].collect()
        assert all(len(r.code) == 2 and r.error >= 0 for r in got)
    want = sorted(str(r[0]) for r in rows + huge)
    assert sorted(str(r.vec_id) for r in got) == want
    # the same rows in another order and partitioning give the same
    again = df.repartition(7, "vec_id").orderBy("label")
    if which == "clusters":
        more = ptolemaic.cluster(again, clusters=3, rounds=3, width=4)[0].collect()
    else:
        more = active_lloyd.compress(again, parts=2, entries=5)[0].collect()
    assert sorted(map(str, more)) == sorted(map(str, got))
    for empty in (df.limit(0), frame(spark, out).where("vec_id < 106")):
        if which == "clusters":
            assert ptolemaic.cluster(empty, clusters=3, width=4)[0].count() == 0
        else:
            assert active_lloyd.compress(empty, parts=2)[0].count() == 0
    few = frame(spark, rows[:2])
    if which == "clusters":
        assert {r.distance for r in ptolemaic.cluster(few, width=4)[0].collect()} == {0}
    else:
        assert {r.error for r in active_lloyd.compress(few, parts=2)[0].collect()} == {0}


def test_codes_equal_brute_force(spark):
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(vectors(400, 12, spread=0.3))]
    got, books = active_lloyd.compress(frame(spark, rows).repartition(5), parts=4, entries=7, rounds=5, scale=8)
    found = {r.vec_id: r for r in got.collect()}
    points = [floor_all(v, 8) for _, v, _ in rows]
    errors = [0] * 400
    for p in range(4):
        own = [x[3 * p:3 * p + 3] for x in points]
        number, distance, entries = lloyd(own, own[:7], 5)
        assert [found[i].code[p] for i in range(400)] == number
        assert books[p].tolist() == entries
        errors = [e + d for e, d in zip(errors, distance, strict=True)]
    assert [found[i].error for i in range(400)] == errors


def test_active_scan_equals_a_complete_one():
    """Random moves with many ties: the active scan gives the complete one, with fewer distances."""
    rng = np.random.default_rng(5)
    for _ in range(60):
        x, entries = rng.integers(-3, 4, (80, 2)), rng.integers(-3, 4, (9, 2))
        number, distance = active_lloyd.first_scan(x, entries)
        moved = rng.random(9) < 0.3
        after = np.where(moved[:, None], rng.integers(-3, 4, (9, 2)), entries)
        moved = (after != entries).any(axis=1)
        got = active_lloyd.next_scan(x, after, moved, number, distance)
        want = active_lloyd.first_scan(x, after)
        assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()
        assert got[2] <= len(x) * len(after)
        if not moved[number].all() and not moved.all():
            assert got[2] < len(x) * len(after)


def test_label_errors_of_a_hot_label(spark, tmp_path):
    """A third of the rows without a label, many labels of one row: sums over equal labels, nulls together."""
    rows = [(i, v.tolist(), None if i % 3 == 0 else i) for i, v in enumerate(vectors(200, 16))]
    frame(spark, rows).select("vec_id", "embedding", "label").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = active_lloyd.op12_active_lloyd(spark, str(tmp_path)).collect()
    label = {i: k for i, _, k in rows}
    total = {}
    for r in got:
        total[label[r.vec_id]] = total.get(label[r.vec_id], 0) + r.error
    assert len(got) == 200 and all(r.label_error == total[label[r.vec_id]] for r in got)
