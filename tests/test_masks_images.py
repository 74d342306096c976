import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.functions import images as I
from tessera.functions import masks as M
from tessera.operators import degrade


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 9), st.integers(0, 10**6))
def test_run_lengths_round_trip(h, w, seed):
    m = np.random.default_rng(seed).random((h, w)) < 0.5
    counts = M.encode(m)
    assert sum(counts) == h * w and (M.decode(counts, h, w) == m).all() and sum(counts[1::2]) == m.sum()


def test_boxes_of_both_conventions():
    m = np.zeros((5, 6), bool)
    m[1:3, 2:5] = True
    assert M.box(m) == [2, 1, 4, 2] and M.box(m, inclusive=False) == [2, 1, 5, 3] and M.box(np.zeros((2, 2), bool)) == [0, 0, 0, 0]


def test_overlap_measures():
    a, b = np.zeros((4, 4), bool), np.zeros((4, 4), bool)
    assert M.iou(a, b) == 1.0 and M.boundary_f(a, b) == 1.0
    a[:2], b[1:3] = True, True
    assert M.iou(a, b) == 4 / 12 and abs(M.iom(a, b) - 0.5) < 1e-6 and 0 < M.boundary_f(a, b) <= 1
    assert M.keep_apart([a, b], [0.9, 0.8]) == ([0], [1]) and M.keep_apart([a], [0.1]) == ([0], [])
    assert M.union([], [], (2, 2))[1] == 0.0 and M.union([a, b], [0.5, 0.7], (4, 4))[0].sum() == 12


def test_regions_touch_at_corners():
    m = np.array([[1, 0, 0, 1], [0, 1, 0, 1], [0, 0, 0, 0], [1, 0, 0, 0]], bool)
    labels, n = M.components(m)
    assert n == 3 and labels[0, 0] == labels[1, 1]


def test_kernels():
    flat = np.full((8, 8, 3), 0.4)
    assert np.allclose(I.blur(flat, 1.0), flat) and np.allclose(I.sharpened(flat), flat)
    n = I.normals(np.zeros((4, 4)))
    assert np.allclose(n, [0, 0, 1]) and np.allclose(I.lambert(n, np.array([0, 0, 1.0]), 0.3), 1) and np.allclose(I.specular(n, np.array([0, 0, 1.0]), 8), 1)
    assert np.allclose(I.composited(flat, np.zeros((8, 8))), 0.5)
    for name in I.PATTERNS:
        s = I.shadow(8, 8, name, 1, 0.5, 1.0)
        assert s.shape == (8, 8) and (s >= 0.5 - 1e-9).all() and (s <= 1 + 1e-9).all() and (s == I.shadow(8, 8, name, 1, 0.5, 1.0)).all()


def test_failed_record_keeps_its_row(spark):
    df = spark.createDataFrame([(1, b"abcdef" * 50), (2, b"")], "id long, content binary")
    rows = {r["id"]: r for r in degrade.degrade(df, "id", "content").collect()}
    assert rows[1]["error"] is None and rows[2]["error"] == "empty image"
