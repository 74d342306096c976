"""Pairs of boxes that meet in places of a grid, against brute force."""

import numpy as np
import pytest

from tessera.functions import box_arrays as A
from tessera.operators import overlap

KIND = "k string, {0} long, {0}_box array<double>"


def made(n: int, seed: int, side: float = 12.0):
    """Boxes of two keys: most are small, some much larger than a cell, some of no area, many of them in one place."""
    r = np.random.default_rng(seed)
    low = np.where(r.uniform(size=(n, 1)) < 0.4, 50.0, r.integers(-90, 90, (n, 2)))
    sides = r.integers(0, side, (n, 2)) * np.where(r.uniform(size=(n, 1)) < 0.05, 9, 1)
    return [("xy"[i % 2], i, [*map(float, low[i]), *map(float, low[i] + sides[i])]) for i in range(n)]


def brute(a, b):
    for k, i, p in a:
        for m, j, q in b:
            x, y = np.array([p]), np.array([q])
            if k == m and A.inter(x, y)[0] > 0:
                yield k, i, j, A.iou(x, y)[0]


def test_pairs_in_places_of_a_grid(spark):
    a, b = made(150, 1), made(170, 2)
    df, other = spark.createDataFrame(a, KIND.format("a")), spark.createDataFrame(b, KIND.format("b"))
    for below in (False, True):
        out = overlap.met_pairs(df, other, ["k"], 10.0, {"iou": A.iou}, lambda m: m["iou"] >= 0.1, below)
        assert sorted(map(tuple, out.collect())) == sorted(x for x in brute(a, b) if x[3] >= 0.1 and (not below or x[1] < x[2]))


def test_one_place_is_many_calls(spark):
    df = spark.range(3000).selectExpr("id", "array(0d, 0d, 1d + id % 7, 1d) as box")
    calls = overlap.by_place(df.selectExpr("id as a", "box as a_box"), df.selectExpr("id as b", "box as b_box"), [], 8.0, lambda p, q: p.slice(0, 1).select(["a"]).append_column("n", [[p.num_rows * q.num_rows]]), "a long, n long").collect()
    assert len(calls) > 9 and sum(r["n"] for r in calls) == 3000**2 and max(r["n"] for r in calls) < 2**20


def test_measures_of_rows_are_those_of_columns(spark):
    from pyspark.sql import functions as F

    from tessera.functions import boxes as B

    pairs = [(p, q) for _, _, p in made(40, 3) for _, _, q in made(40, 4)]
    x, y = F.col("p"), F.col("q")
    columns = spark.createDataFrame(pairs, "p array<double>, q array<double>").select(B.giou_xyxy(x, y), B.ioa_xyxy(x, y), B.iom_xyxy(x, y), B.centre_similarity(x, y, 100.0)).collect()
    p, q = (np.array(v) for v in zip(*pairs, strict=True))
    ours = np.stack((A.giou(p, q), A.ioa(p, q), A.iom(p, q), A.centre_similarity(p, q, 100.0)), axis=1)
    assert np.array_equal(ours, np.array(columns))
    assert A.rounded(np.array([0.5, -0.5, 1.5, 2.4]), 0).tolist() == [1.0, -1.0, 2.0, 2.0]


def test_best_tracks_against_all_pairs(spark):
    d, t = made(150, 5), made(150, 6)
    dets = spark.createDataFrame([(*x, x[1] / 150) for x in d], "k string, det long, box array<double>, score double")
    tracks = spark.createDataFrame(t, "k string, track long, box array<double>")
    met = [(k, i, j, round(v, 6)) for k, i, j, v in brute(d, t) if round(v, 6) >= 0.1]
    of_dets, of_tracks = overlap.associate(dets, tracks, ["k"], 10.0, 0.1, 0.5)
    for r in of_dets.collect():
        own = sorted((-v, j) for k, i, j, v in met if i == r["det"])
        assert (r["best_track"], r["best_iou"]) == ((own[0][1], pytest.approx(-own[0][0])) if own else (None, None))
        assert r["is_new"] == (not own and r["score"] >= 0.5)
    for r in of_tracks.collect():
        own = [(i, v) for k, i, j, v in met if j == r["track"]]
        assert r["unmatched"] == (not own) and r["confident"] == any(v >= 0.8 and i / 150 >= 0.8 for i, v in own)


def test_one_to_many_against_all_pairs(spark):
    a = made(120, 7)
    p = lambda i: i % 13 / 13
    df = spark.createDataFrame(a, KIND.format("a"))
    other = spark.createDataFrame([(*x, p(x[1])) for x in a], f"{KIND.format('b')}, p double")
    rated: dict = {}
    for k, i, j, v in brute(a, a):
        if i != j:
            rated.setdefault((k, i), []).append((j, A.rounded(np.array([0.3 * p(j) + (1 - 0.3) * v]), 6)[0]))
    expected = set()
    for (k, i), found in rated.items():
        cut = round(float(np.quantile([c for _, c in found], 1 - 3 / 10)), 6)
        expected |= {(k, i, j, c) for j, c in found if c > cut and c > 0.4}
    assert set(map(tuple, overlap.one_to_many(df, other, ["k"], 10.0, 3, 10).collect())) == expected
