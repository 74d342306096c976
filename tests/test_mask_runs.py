"""Run operators against decoded masks: random sizes, single rows and columns, ties, empty masks, odd polygons."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import masks as D
from tessera.operators import masks as M

RUN = "image long, obj long, score double, start long, stop long"


def some_masks(r, n, h, w, density=0.4):
    return {k: np.array([[r.random() < density for _ in range(w)] for _ in range(h)], dtype=bool) for k in range(n)}


def runs_of(mask):
    flat = np.concatenate(([0], mask.ravel(order="F").astype(int), [0]))
    edges = np.flatnonzero(np.diff(flat))
    return [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def frame(spark, masks, image=0, score=lambda k: float(k % 3)):
    return spark.createDataFrame([(image, k, score(k), a, b) for k, m in masks.items() for a, b in runs_of(m)], RUN)


def decoded(rows, size):
    out = np.zeros(size, dtype=bool)
    for a, b in rows:
        assert a < b and not out[a:b].any()
        out[a:b] = True
    return out


def test_owners_and_overlaps(spark):
    r = random.Random(1)
    masks = some_masks(r, 7, 9, 13) | {7: np.zeros((9, 13), dtype=bool), 8: np.ones((9, 13), dtype=bool)}
    score = {0: 0.5, 1: 0.9, 2: None, 3: 0.9, 4: 0.1, 5: 0.5, 6: 0.7, 8: 0.2}
    df = frame(spark, masks, score=score.get).unionByName(frame(spark, masks, image=1, score=lambda k: 1.0))
    for width in (5, 1 << 16):
        out = M.owned_runs(df, ["image"], "obj", "score", width).collect()
        for image, value in ((0, lambda k: -9.0 if score[k] is None else score[k]), (1, lambda k: 1.0)):
            owner = np.full(9 * 13, -1)
            for k in sorted((k for k in masks if k != 7), key=lambda k: (value(k), -k)):
                owner[masks[k].ravel(order="F")] = k
            for k in masks:
                assert (decoded([(x["start"], x["stop"]) for x in out if x["image"] == image and x["obj"] == k], 9 * 13) == (owner == k)).all()
            assert len({(x["obj"], x["start"]) for x in out if x["image"] == image}) == sum(len(runs_of((owner == k).reshape((9, 13), order="F"))) for k in masks)
    found = {(x["a"], x["b"]): x for x in M.ious(df.where("image = 0"), ["image"], "obj").collect()}
    for a in masks:
        for b in masks:
            shared = int((masks[a] & masks[b]).sum())
            assert ((a, b) in found) == (a < b and shared > 0)
            if (a, b) in found:
                assert found[a, b]["shared"] == shared and abs(found[a, b]["iou"] - D.iou(masks[a], masks[b])) < 1e-12 and abs(found[a, b]["iom"] - D.iom(masks[a], masks[b])) < 1e-12


def test_keep_apart_equals_decoded(spark):
    r = random.Random(3)
    masks = some_masks(r, 12, 6, 6, 0.3) | {12: np.zeros((6, 6), dtype=bool)}
    score = lambda k: float(k % 4)
    items = spark.createDataFrame([(0, k, score(k)) for k in masks], "image long, obj long, score double")
    out = {x["obj"]: x["keep"] for x in M.keep_apart(items, frame(spark, masks), ["image"], "obj").collect()}
    kept, _ = D.keep_apart(list(masks.values()), [score(k) for k in masks])
    assert {k for k, keep in out.items() if keep} == set(kept) and 12 in kept and len(kept) < len(masks)


@pytest.mark.parametrize(("h", "w"), [(7, 11), (1, 9), (9, 1)])
def test_boundaries(spark, h, w):
    r = random.Random(h)
    masks = some_masks(r, 6, h, w)
    truth = {k: np.zeros((h, w), dtype=bool) if k in (0, 5) else masks[k] for k in masks}
    found = {k: np.zeros((h, w), dtype=bool) if k in (1, 5) else (~masks[k] if k == 2 else masks[(k + 1) % 6]) for k in masks}
    pairs = spark.createDataFrame([(0, k) for k in masks], "image long, obj long")
    edges = M.boundary(M.columns(frame(spark, truth), h), ["image", "obj"], h, w).collect()
    out = {x["obj"]: x for x in M.boundary_scores(pairs, frame(spark, truth), frame(spark, found), ["image", "obj"], h, w).collect()}
    for k in masks:
        got = np.zeros((h, w), dtype=bool)
        for e in edges:
            if e["obj"] == k:
                got[e["y0"] : e["y1"], e["x"]] = True
        a, b = D.boundary(truth[k]), D.boundary(found[k])
        assert (got == a).all()
        grown = lambda m: np.array([[m[max(0, y - 1) : y + 2, max(0, x - 1) : x + 2].any() for x in range(w)] for y in range(h)])
        p, q = (float((x & grown(y)).sum() / x.sum()) if x.any() else 1.0 for x, y in ((b, a), (a, b)))
        assert abs(out[k]["f"] - (2 * p * q / (p + q) if p + q else 0.0)) < 1e-12
        assert abs(out[k]["j"] - (D.iou(truth[k], found[k]) if truth[k].any() or found[k].any() else 0.0)) < 1e-12
    means = M.mean_boundary_scores(spark.createDataFrame([(1, 0.5, 1.0), (1, 1.0, 0.5), (2, None, None)], "image long, j double, f double"), ["image"]).collect()
    assert {x["image"]: (x["n"], round(x["j"], 6), round(x["f"], 6), round(x["jf"], 6)) for x in means} == {1: (2, 0.75, 0.75, 0.75), 2: (0, -1.0, -1.0, -1.0)}


def test_counts_and_text_round_trip(spark):
    r = random.Random(5)
    masks = {k: (np.array([[r.random() < d for _ in range(w)] for _ in range(h)], dtype=bool)) for k, (h, w, d) in enumerate([(5, 7, 0.5), (5, 7, 0.1), (5, 7, 1.0), (5, 7, 0.9)])}
    rows = [(k, D.encode(m)) for k, m in masks.items()]
    df = spark.createDataFrame(rows, "obj long, counts array<bigint>")
    back = {x["obj"]: list(x["counts"]) for x in M.run_counts(M.mask_runs(df, ["obj"]), ["obj"], 35).collect()}
    assert back == dict(rows)
    long_ = [(k, [r.randrange(0, 2 ** r.randrange(1, 40)) for _ in range(r.randrange(1, 30))]) for k in range(60)] + [(60, []), (61, [0]), (62, [5, 0, 3, 0, 0, 16, 15, 31, 32, 1024, 1023])]
    coded = spark.createDataFrame(long_, "obj long, counts array<bigint>").withColumn("rle", M.compressed(F.col("counts")))
    assert {x["obj"]: list(x["counts"]) for x in M.decompressed(coded.select("obj", "rle"), ["obj"], "rle").collect()} == dict(long_)
    for x in coded.collect():
        assert x["rle"] == text_form(x["counts"])


def text_form(counts):
    """The text form number by number, in Python's own integers."""
    out = ""
    for i, c in enumerate(counts):
        x = c - (counts[i - 2] if i > 2 else 0)
        while True:
            low, x = x & 31, x >> 5
            done = x == (-1 if low & 16 else 0)
            out += chr(48 + low + (0 if done else 32))
            if done:
                break
    return out


def inside(x, y, part):
    n, odd = len(part) // 2, False
    for i in range(n):
        x1, y1, x2, y2 = part[2 * i], part[2 * i + 1], part[2 * (i + 1) % (2 * n)], part[(2 * (i + 1) + 1) % (2 * n)]
        if (x1 <= x) != (x2 <= x) and y1 + (x - x1) * (y2 - y1) / (x2 - x1) <= y:
            odd = not odd
    return odd


def test_polygons(spark):
    r = random.Random(7)
    h, w = 9, 12
    shapes = [[[r.uniform(-3, 15) for _ in range(2 * r.randrange(3, 7))] for _ in range(r.randrange(1, 4))] for _ in range(40)]
    shapes += [[[2, 2, 6, 2, 6, 5, 2, 5]], [[0.5, 0.5, 5.5, 0.5, 5.5, 4.5, 0.5, 4.5]], [[0, 0, 12, 0, 12, 9, 0, 9]], [[1, 1, 3, 3]], [[1, 1, 1, 1, 1, 1]], [[-9, -9, -5, -9, -5, -5]], [], None]
    rows = [(k, None if s is None else [[float(v) for v in p] for p in s]) for k, s in enumerate(shapes)]
    out = M.polygon_runs(spark.createDataFrame(rows, "obj long, parts array<array<double>>"), ["obj"], "parts", h, w).collect()
    for k, s in rows:
        want = np.array([[any(inside(x + 0.5, y + 0.5, p) for p in s or [] if len(p) >= 6) for x in range(w)] for y in range(h)])
        got = decoded([(x["start"], x["stop"]) for x in out if x["obj"] == k], h * w).reshape((h, w), order="F")
        assert (got == want).all(), (k, s)
    assert sum(x["stop"] - x["start"] for x in out if x["obj"] == 40) == 12


def test_empty_tables(spark):
    none = spark.createDataFrame([], RUN)
    assert M.owned_runs(none, ["image"], "obj", "score").count() == 0 and M.ious(none, ["image"], "obj").count() == 0 and M.united(none, ["image"]).count() == 0
