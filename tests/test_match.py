import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import match, metrics


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 5), st.integers(1, 5), st.integers(0, 10**6))
def test_assign_is_optimal(n, m, seed):
    cost = np.random.default_rng(seed).integers(0, 20, (n, m)).astype(float)
    got = sum(cost[r, c] for r, c in match.assign(cost))
    if n <= m:
        best = min(sum(cost[r, c] for r, c in enumerate(p)) for p in itertools.permutations(range(m), n))
    else:
        best = min(sum(cost[r, c] for c, r in enumerate(p)) for p in itertools.permutations(range(n), m))
    assert got == best and len(match.assign(cost)) == min(n, m)


def test_iou_symmetric_and_zero_union():
    a = np.array([[0, 0, 2, 2], [1, 1, 1, 1]], float)
    m = match.iou_matrix(a, a)
    assert m[0, 0] == 1 and m[1, 1] == 0 and (m == m.T).all()


def test_nms_keeps_at_threshold_and_is_idempotent(spark):
    rows = [("a", 1, [0.0, 0.0, 2.0, 1.0], 0.9), ("a", 2, [0.0, 0.0, 1.0, 1.0], 0.8), ("a", 3, [0.0, 0.0, 2.0, 1.1], 0.7), ("b", 4, [0.0, 0.0, 1.0, 1.0], 0.5)]
    df = spark.createDataFrame(rows, "k string, id long, box array<double>, score double")
    kept = match.box_nms(df, ["k"], "id", 0.5, 1.0).where("keep").drop("keep")
    assert sorted(r["id"] for r in kept.collect()) == [1, 2, 4]  # IoU of 1 and 2 is exactly 0.5
    assert sorted(r["id"] for r in match.box_nms(kept, ["k"], "id", 0.5, 1.0).where("keep").collect()) == [1, 2, 4]
    assert sorted(r["id"] for r in match.box_nms(df, ["k"], "id", 0.5, 1.0, inclusive=True).where("keep").collect()) == [1, 4]


def test_suppressed_box_suppresses_no_other(spark):
    rows = [("a", 1, [0.0, 0.0, 10.0, 1.0], 0.9), ("a", 2, [4.0, 0.0, 14.0, 1.0], 0.8), ("a", 3, [8.0, 0.0, 18.0, 1.0], 0.7)]
    df = spark.createDataFrame(rows, "k string, id long, box array<double>, score double")
    assert sorted(r["id"] for r in match.box_nms(df, ["k"], "id", 0.3, 4.0).where("keep").collect()) == [1, 3]


def test_perfect_predictions_score_one(spark):
    keys = spark.createDataFrame([("a", 0.5, 2, 2, 2), ("b", 0.5, 0, 0, 0), ("c", 0.5, 1, 1, 1)], "key string, iou_thr double, n_gt long, n_dt long, tp long")
    r = metrics.classification_gated_f1(keys).first()
    assert (r["tp"], r["tn"], r["fp"], r["fn"]) == (2, 1, 0, 0)
    assert abs(r["micro_f1"] - 1) < 1e-3 and abs(r["macro_f1"] - 1) < 1e-3 and abs(r["il_mcc"] - 1) < 1e-3
    assert {x["f1"] for x in metrics.video_phrase_f1(keys).collect()} == {1.0}


def test_hota_of_equal_tracks(spark):
    gt = spark.createDataFrame([(1, f, g) for f in range(3) for g in (0, 1)], "seq long, frame long, g long")
    dt = gt.withColumnRenamed("g", "d")
    pairs = gt.join(dt, ["seq", "frame"]).where("g = d").withColumn("iou", F.lit(1.0))
    out = metrics.combined_hota(metrics.hota(pairs, gt, dt, "seq")).collect()
    assert len(out) == 19 and all(abs(r["hota"] - 1) < 1e-9 and r["fp"] == r["fn"] == 0 for r in out)


def test_average_precision(spark):
    d = spark.createDataFrame([("c", 0.9, 1, True), ("c", 0.8, 2, False), ("c", 0.7, 3, True)], "cls string, score double, dt_id long, matched boolean")
    n = spark.createDataFrame([("c", 2)], "cls string, n long")
    expected = (51 * 1.0 + 50 * (2 / 3)) / 101
    assert abs(metrics.average_precision(d, n, ["cls"]).first()["ap"] - expected) < 1e-9


def test_all_detections_of_a_key_that_is_no_image(spark):
    rows = [(1, k, 20.0 * k, 0.0, 20.0 * k + 10, 10.0, 1.0 / (k + 1)) for k in range(150)]
    d = spark.createDataFrame(rows, "k long, dt_id long, x0 double, y0 double, x1 double, y1 double, score double")
    g = spark.createDataFrame([(*r[:6], False) for r in rows], "k long, gt_id long, x0 double, y0 double, x1 double, y1 double, ignored boolean")
    assert match.coco_match(g, d, ["k"], [0.5], max_dets=None).where("matched").count() == 150
    assert match.coco_match(g, d, ["k"], [0.5]).count() == 100


def test_balanced_is_repeated_argmin(spark):
    from pyspark.sql import functions as F

    from tessera.operators import rank

    loads = {"a": [3, 0, 0, 5], "b": [1, 1, 1, 1]}
    items = spark.createDataFrame([(g, i) for g in loads for i in range(9)], "g string, item int")
    workers = spark.createDataFrame([(g, w, n) for g, own in loads.items() for w, n in enumerate(own)], "g string, worker int, load long")
    got = {(r["g"], r["item"]): r["worker"] for r in rank.balanced(items, workers, ["g"], F.asc("item")).collect()}
    for g, own in loads.items():
        at = list(own)
        for i in range(9):
            w = at.index(min(at))
            at[w] += 1
            assert got[g, i] == w


def test_single_refuses_several_rows(spark):
    from tessera.operators import annotations

    rows = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z")], "k long, v string")
    assert [tuple(r) for r in annotations.single(rows.where("k = 1"), ["k"]).collect()] == [(1, "x", 1)]
    with pytest.raises(Exception, match="several rows of 2"):
        annotations.single(rows, ["k"]).collect()


def test_cost_matching_against_all_assignments(spark):
    """Both class costs, more targets than predictions, images of one side only."""
    import itertools

    r = np.random.default_rng(4)
    box = lambda: [*r.uniform(0.2, 0.8, 2).tolist(), *r.uniform(0.1, 0.4, 2).tolist()]
    sizes = [(4, 3), (2, 4), (0, 2), (3, 0), (1, 1)]
    preds = [(i, k, r.uniform(0, 1, 3).tolist(), box()) for i, (n, _) in enumerate(sizes) for k in range(n)]
    targets = [(i, k, int(r.integers(3)), box()) for i, (_, n) in enumerate(sizes) for k in range(n)]
    p = spark.createDataFrame(preds, "image long, pred_id long, probs array<double>, box array<double>")
    t = spark.createDataFrame(targets, "image long, target_id long, label int, box array<double>")
    for focal in (False, True):
        out = match.cost_matched(p, t, ["image"], 1.0, 2.0, 3.0, focal).collect()
        for i, (n, m) in enumerate(sizes):
            mine = [x for x in out if x["image"] == i]
            assert len(mine) == min(n, m)
            corners = lambda b: np.array([[b[0] - b[2] / 2, b[1] - b[3] / 2, b[0] + b[2] / 2, b[1] + b[3] / 2]])

            def cost(a, b):
                c = a[2][b[2]]
                by_class = 0.25 * (1 - c) ** 2 * -np.log(c + 1e-8) - 0.75 * c**2 * -np.log(1 - c + 1e-8) if focal else -c
                return by_class + 2 * sum(abs(x - y) for x, y in zip(a[3], b[3], strict=True)) - 3 * match.giou_matrix(corners(a[3]), corners(b[3]))[0, 0]

            ps, ts = [x for x in preds if x[0] == i], [x for x in targets if x[0] == i]
            few, many, flip = (ps, ts, False) if n <= m else (ts, ps, True)
            best = min((sum(cost(*((b, a) if flip else (a, b))) for a, b in zip(few, chosen, strict=True)) for chosen in itertools.permutations(many, len(few))), default=0)
            assert abs(sum(x["cost"] for x in mine) - best) < 1e-9
