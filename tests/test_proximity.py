import numpy as np
import pytest

from placeloom.functions.kdtree import LocalTree, SplitTree, arc_m, unit_vectors
from placeloom.operators import proximity
from placeloom.operators.proximity import near_join, near_pairs, points_in_regions

SCHEMA = "id string, lat double, lon double, dist_m string, block long"


def _brute(rows, radius):
    out = set()
    for i, a in enumerate(rows):
        for b in rows[i + 1 :]:
            v = unit_vectors(np.array([a[1], b[1]]), np.array([a[2], b[2]]))
            if a[0] != b[0] and arc_m(((v[0] - v[1]) ** 2).sum()) <= radius:
                out.add(tuple(sorted((a[0], b[0]))))
    return out


def _random(n, seed):
    rng = np.random.default_rng(seed)
    at = np.vstack((rng.normal((60, 25), 0.0005, (n // 2, 2)), rng.uniform((-90, -180), (90, 180), (n // 4, 2)), np.full((n - n // 2 - n // 4, 2), (10.0, 179.99995))))
    at[::7, 1] = np.where(at[::7, 1] > 179, -179.99995, at[::7, 1])
    return [(f"i{k:04}", float(a), float(b), "x", 1) for k, (a, b) in enumerate(at)]


@pytest.mark.parametrize("leaf_rows", [8_000, 12])
def test_pairs_equal_brute_force(spark, leaf_rows):
    rows = _random(160, leaf_rows)
    df = spark.createDataFrame(rows + rows[:20], SCHEMA)  # repeated rows, clashing extra columns
    got = [(r.id_a, r.id_b) for r in near_pairs(df, 25.0, leaf_rows=leaf_rows).collect()]
    assert len(got) == len(set(got)) and set(got) == _brute(rows, 25.0)


def test_places_that_are_none(spark):
    rows = [("a", None, 1.0), ("b", 1.0, None), ("c", 0.0, 0.0), ("d", 91.0, 5.0), ("e", 91.0, 5.0), (None, 2.0, 2.0), ("f", 2.0, 2.0), ("g", 90.0, 1.0), ("h", 90.0, 170.0)]
    df = spark.createDataFrame(rows, "id string, lat double, lon double")
    assert [(r.id_a, r.id_b) for r in near_pairs(df, 25.0).collect()] == [("g", "h")]
    assert near_pairs(df.where("false"), 25.0).count() == 0


def test_join_of_two_sets(spark):
    rows = _random(120, 3)
    a, b = spark.createDataFrame(rows[::2], SCHEMA), spark.createDataFrame(rows[1::2] + rows[1:9:2], SCHEMA)
    got = [(r.left_id, r.right_id) for r in near_join(a, b, 25.0, leaf_rows=10).collect()]
    left = {r[0] for r in rows[::2]}
    want = {(x, y) if x in left else (y, x) for x, y in _brute(rows, 25.0) if (x in left) != (y in left)}
    assert len(got) == len(set(got)) and set(got) == want


def test_hot_spot_is_split_into_blocks():
    at = unit_vectors(np.full(1000, 5.0), np.full(1000, 6.0))
    tree = SplitTree(at, 1000, 1e-6, 50)
    row, block, _, side = tree.place(at, np.arange(1000))
    assert tree.blocks == 55 and max(np.bincount(block)) <= 220 and len(row) == 10_000
    assert LocalTree(at[:0]).near(at, 1.0) is not None and set(side) == {0, 1, 2}


@pytest.mark.parametrize("at_once", [50_000, 0])
def test_regions(spark, monkeypatch, at_once):
    monkeypatch.setattr(proximity, "EDGES_AT_ONCE", at_once)
    rings = [("tri", [[0.0, 1.0], [10.0, 1.0], [5.0, 9.0]]), ("box", [[4.0, 0.0], [12.0, 0.0], [12.0, 4.0], [4.0, 4.0], [4.0, 0.0]]), ("none", None), ("line", [[0.0, 0.0], [1.0, 1.0]])]
    points = [("a", 2.0, 5.0), ("b", 8.0, 5.0), ("c", 3.0, 11.0), ("d", 3.0, 4.0), ("e", 4.0, 11.0), ("f", None, 5.0), ("g", 8.0, 1.0), ("a", 2.0, 5.0)]
    got = points_in_regions(spark.createDataFrame(points, "id string, lat double, lon double"), spark.createDataFrame(rings, "area string, ring array<array<double>>"), "area", "ring", strip_rows=2)
    assert sorted((r.id, r.region_id) for r in got.collect()) == [("a", "box"), ("a", "box"), ("a", "tri"), ("a", "tri"), ("b", "tri"), ("c", "box"), ("d", "box"), ("d", "tri")]
