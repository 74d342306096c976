"""Detection and tracking metrics from counts; the small constants are part of the definitions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators.match import assign, coco_match
from tessera.operators.rank import global_rank

# The metrics' thresholds and constants.
IOU_THRESHOLDS = [0.5 + 0.05 * k for k in range(10)]
HOTA_ALPHAS = [0.05 * k for k in range(1, 20)]
EPS, MCC_EPS = 1e-4, 1e-6


def image_outcome(n_gt: Column, n_dt: Column) -> Column:
    """TP, FP, FN or TN by whether truth and detections exist."""
    return F.when((n_gt > 0) & (n_dt > 0), "TP").when(n_dt > 0, "FP").when(n_gt > 0, "FN").otherwise("TN")


def mcc(tp: Column, fp: Column, fn: Column, tn: Column) -> Column:
    tp, fp, fn, tn = (c.cast("double") for c in (tp, fp, fn, tn))
    return (tp * tn - fp * fn) / (F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)) + MCC_EPS)


def f1(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    """precision, recall and F1 with the constant that keeps them finite."""
    p, r = tp / (tp + fp + EPS), tp / (tp + fn + EPS)
    return p, r, 2 * p * r / (p + r + EPS)


def classification_gated_f1(keys: DataFrame) -> DataFrame:
    """From ``iou_thr, n_gt, n_dt, tp`` per key: counts, micro and macro F1 of positives, image-level MCC and their products, per threshold."""
    n_gt, n_dt, tp = F.col("n_gt"), F.col("n_dt"), F.col("tp")
    fp, fn, pos = n_dt - tp, n_gt - tp, n_gt > 0
    local = f1(tp, fp, fn)[2]
    kind = image_outcome(n_gt, n_dt)
    sums = keys.groupBy("iou_thr").agg(
        F.sum(F.when(pos, tp).otherwise(0)).alias("ptp"), F.sum(F.when(pos, fp).otherwise(0)).alias("pfp"), F.sum(F.when(pos, fn).otherwise(0)).alias("pfn"),
        F.coalesce(F.sum(F.when(pos & (n_dt > 0), local)), F.lit(0.0)).alias("local"), F.count_if(pos & (n_dt > 0)).alias("both"),
        *(F.count_if(kind == k).alias(k.lower()) for k in ("TP", "FP", "FN", "TN")))
    micro = f1(F.col("ptp"), F.col("pfp"), F.col("pfn"))[2]
    macro = F.when(F.col("both") > 0, F.col("local") / F.col("both")).otherwise(F.lit(0.0))
    out = sums.withColumn("micro_f1", micro).withColumn("macro_f1", macro).withColumn("il_mcc", mcc(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")))
    return out.withColumn("cgf1_micro", F.col("micro_f1") * F.col("il_mcc")).withColumn("cgf1_macro", F.col("macro_f1") * F.col("il_mcc")).drop("local", "both")


def video_phrase_f1(keys: DataFrame) -> DataFrame:
    """Per key 2TP/(2TP+FP+FN), 1 where nothing was to be found nor was: mean over thresholds, at .5 and at .75."""
    den = F.col("n_gt") + F.col("n_dt")
    value = F.when(den > 0, 2 * F.col("tp") / den).otherwise(F.lit(1.0))
    at = lambda t: F.max(F.when(F.abs(F.col("iou_thr") - t) < 1e-6, F.col("v")))
    return keys.withColumn("v", value).groupBy("key").agg(F.avg("v").alias("f1"), at(0.5).alias("f1_50"), at(0.75).alias("f1_75"))


def average_precision(dets: DataFrame, truths: DataFrame, group: list[str]) -> DataFrame:
    """Interpolated at 101 recalls from ``score, dt_id, matched`` and the number of truths ``n`` per group.

    Precision at a recall is the best at that recall or beyond; recalls never
    reached count 0. Places among all detections and among the matched ones are
    ranks dealt by range; of each hundredth of recall the best precision is
    kept, so a group's window holds 101 rows at most.
    """
    ranked = global_rank(dets.select(*group, "score", "dt_id", "matched"), F.desc("score"), F.asc("dt_id"), name="k", keys=group)
    hits = global_rank(ranked.where("matched").select(*group, "k"), F.asc("k"), name="tp", keys=group).join(truths, group)
    best = hits.groupBy(*group, F.floor(F.col("tp") / F.col("n") * 100 + 1e-9).alias("r")).agg(F.max(F.col("tp") / F.col("k")).alias("p"))
    down = W.partitionBy(*group).orderBy(F.desc("r"))
    # A hundredth stands for the recalls above the one reached before it.
    best = best.withColumn("w", F.col("r") - F.coalesce(F.lead("r").over(down), F.lit(-1))).withColumn("p", F.max("p").over(down.rowsBetween(W.unboundedPreceding, 0)))
    ap = best.groupBy(*group).agg((F.sum(F.col("p") * F.col("w")) / 101).alias("ap"))
    return ranked.select(*group).distinct().join(truths.select(*group), group).join(ap, group, "left").withColumn("ap", F.coalesce("ap", F.lit(0.0)))


# The area ranges, in pixels, the end not included.
AREA_RANGES = {"all": (0.0, 1e10), "small": (0.0, 128.0**2), "medium": (128.0**2, 256.0**2), "large": (256.0**2, 1e10)}


def ap_by_area(gt: DataFrame, dt: DataFrame, image: list[str], thresholds: list[float], ranges: dict[str, tuple[float, float]] = AREA_RANGES, max_dets: tuple[int | None, ...] = (100,), cell: float = 64.0) -> DataFrame:
    """``area_range, max_det, iou_thr, truths, ap``: one table of the average precision over area ranges and numbers of detections an image.

    Truth outside a range is ignored, as are detections outside it that match
    nothing; what matches ignored truth counts neither way. Ranges are a key of
    the matching, so all of them are matched at once. A range without truth has an ``ap`` of -1.
    """
    spans = F.explode(F.array(*(F.struct(F.lit(name).alias("area_range"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for name, (lo, hi) in ranges.items())))
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    ranged = lambda df: df.withColumn("r", spans).select(*df.columns, "r.*").withColumn("out", (area < F.col("lo")) | (area >= F.col("hi")))
    truth = ranged(gt).withColumn("ignored", F.col("ignored") | F.col("out")).drop("lo", "hi", "out")
    found = ranged(dt).drop("lo", "hi")
    n = truth.where(~F.col("ignored")).groupBy("area_range").agg(F.count("*").alias("n"))
    names = dt.sparkSession.createDataFrame([(k,) for k in ranges], "area_range string")
    out = None
    for most in max_dets:
        met = coco_match(truth, found.drop("out"), [*image, "area_range"], thresholds, most, cell)
        counted = met.join(found.select(*image, "area_range", "dt_id", "out"), [*image, "area_range", "dt_id"]).where(~F.col("ignored") & (F.col("matched") | ~F.col("out")))
        one = counted.select("area_range", "iou_thr", "score", F.struct(*image, "dt_id").alias("dt_id"), "matched")
        each = names.crossJoin(dt.sparkSession.createDataFrame([(float(t),) for t in thresholds], "iou_thr double")).join(n, "area_range", "left")
        ap = average_precision(one, each.where("n > 0"), ["area_range", "iou_thr"])
        row = each.join(ap, ["area_range", "iou_thr"], "left").select("area_range", F.lit(most).cast("long").alias("max_det"), "iou_thr", F.coalesce("n", F.lit(0)).cast("long").alias("truths"), F.when(F.col("n") > 0, F.coalesce("ap", F.lit(0.0))).otherwise(F.lit(-1.0)).alias("ap"))
        out = row if out is None else out.unionByName(row)
    return out


def weighted(value: str, weight: str) -> Column:
    return F.sum(F.col(value) * F.col(weight)) / F.greatest(F.lit(1.0), F.sum(weight).cast("double"))


def combined_hota(parts: DataFrame) -> DataFrame:
    """Sequences to one row per alpha: counts add, association is averaged by matches, the final fields follow."""
    out = parts.groupBy("alpha").agg(*(F.sum(c).alias(c) for c in ("tp", "fn", "fp")), *(weighted(c, "tp").alias(c) for c in ("loc", "ass_a", "ass_re", "ass_pr")))
    one = lambda c: F.greatest(F.lit(1.0), c.cast("double"))
    tp, fn, fp = F.col("tp"), F.col("fn"), F.col("fp")
    out = out.withColumn("det_re", tp / one(tp + fn)).withColumn("det_pr", tp / one(tp + fp)).withColumn("det_a", tp / one(tp + fn + fp))
    return out.withColumn("hota", F.sqrt(F.col("det_a") * F.col("ass_a"))).withColumn("owta", F.sqrt(F.col("det_re") * F.col("ass_a")))


def _frames(rows: pd.DataFrame, g_ids: np.ndarray, d_ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The tracks of each frame and their similarities."""
    out = []
    for _, f in rows.groupby("frame", sort=True):
        g, gi = np.unique(f["g"], return_inverse=True)
        d, di = np.unique(f["d"], return_inverse=True)
        sim = np.zeros((len(g), len(d)))
        sim[gi, di] = f["iou"]
        out.append((np.searchsorted(g_ids, g), np.searchsorted(d_ids, d), sim))
    return out


def hota(pairs: DataFrame, gt: DataFrame, dt: DataFrame, key: str, alphas: list[float] = HOTA_ALPHAS) -> DataFrame:
    """``key, alpha, tp, fn, fp, loc, ass_a, ass_re, ass_pr`` per sequence.

    ``pairs`` has key, frame, g, d, iou for boxes that overlap; ``gt`` and
    ``dt`` have key, frame and g or d. In a frame with one pair nothing is to
    be assigned: such frames are counted by tracks and by the number of
    ``alphas`` (rising) they reach. A sequence's counts and the pairs of its
    other frames are one group.
    """
    kind = gt.schema[key].dataType.simpleString()
    eps = float(np.finfo(float).eps)
    reached = lambda iou: sum((F.when(iou >= a - eps, 1).otherwise(0) for a in alphas), F.lit(0))
    null = lambda t: F.lit(None).cast(t)
    none = {"frame": null("long"), "g": null("long"), "d": null("long"), "iou": null("double"), "reached": null("int"), "n": null("long")}
    row = lambda df, *more: df.select(key, *(c.alias(k) for k, c in (none | {k: F.col(k) for k in more}).items()))
    met = pairs.select(key, "frame", "g", "d", F.col("iou").cast("double").alias("iou")).withColumn("n", F.count("*").over(W.partitionBy(key, "frame")))
    alone = F.col("n") == 1
    met = met.where("iou > 0 or n > 1").select(key, F.when(~alone, F.col("frame")).alias("frame"), "g", "d", "iou", F.when(alone, reached(F.col("iou"))).alias("reached"))
    met = met.groupBy(key, "frame", "g", "d", "reached").agg(F.sum("iou").alias("iou"), F.count("*").alias("n"))
    rows = row(gt.groupBy(key, "g").agg(F.count("*").alias("n")), "g", "n").unionByName(row(dt.groupBy(key, "d").agg(F.count("*").alias("n")), "d", "n"))
    rows = rows.unionByName(row(met, "frame", "g", "d", "iou", "reached", "n"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        g, d, iou, n, frame, most = (rows[c].to_numpy() for c in ("g", "d", "iou", "n", "frame", "reached"))
        counts, one = np.isnan(iou), ~pd.isna(most)
        of = lambda x, own: (x[own].astype(np.int64), n[own].astype(np.int64))
        (g_ids, n_g), (d_ids, n_d) = of(g, counts & ~pd.isna(g)), of(d, counts & ~pd.isna(d))
        (g_ids, n_g), (d_ids, n_d) = ((x[o], m[o]) for x, m in ((g_ids, n_g), (d_ids, n_d)) for o in [np.argsort(x)])
        shape = (len(g_ids), len(d_ids))
        together, hits = np.zeros(shape), np.zeros((len(alphas) + 1, *shape), dtype=np.int64)
        loc = np.zeros(len(alphas) + 1)
        at = np.searchsorted(g_ids, g[one].astype(np.int64)), np.searchsorted(d_ids, d[one].astype(np.int64))
        np.add.at(together, at, n[one])
        np.add.at(hits, (most[one].astype(np.int64), *at), n[one].astype(np.int64))
        np.add.at(loc, most[one].astype(np.int64), iou[one])
        if (several := ~pd.isna(frame)).any():
            frames = _frames(rows.loc[several, ["frame", "g", "d", "iou"]], g_ids, d_ids)
            for r, c, sim in frames:
                den = sim.sum(1, keepdims=True) + sim.sum(0, keepdims=True) - sim
                together[np.ix_(r, c)] += np.divide(sim, den, out=np.zeros_like(sim), where=den > 0)
            den = n_g[:, None] + n_d[None] - together
            align = np.divide(together, den, out=np.zeros(shape), where=den > 0)
            for r, c, sim in frames:
                for i, j in assign(-(align[np.ix_(r, c)] * sim)):
                    k = int(sum(sim[i, j] >= a - eps for a in alphas))
                    hits[k, r[i], c[j]] += 1
                    loc[k] += sim[i, j]
        # What reaches an alpha reaches those before it.
        c, loc = np.cumsum(hits[::-1], axis=0)[::-1][1:].astype(float), np.cumsum(loc[::-1])[::-1][1:]
        tp = c.sum((1, 2))
        per = np.maximum(1, tp)
        over = lambda den: (c * c / np.maximum(1, den)).sum((1, 2)) / per
        g_side, d_side = n_g[:, None] + np.zeros(shape), n_d[None] + np.zeros(shape)
        return pd.DataFrame({key: [rows[key].iloc[0]] * len(alphas), "alpha": alphas, "tp": tp.astype(np.int64), "fn": int(n_g.sum()) - tp.astype(np.int64), "fp": int(n_d.sum()) - tp.astype(np.int64), "loc": loc / per, "ass_a": over(g_side + d_side - c), "ass_re": over(g_side), "ass_pr": over(d_side)})

    return rows.groupBy(key).applyInPandas(run, f"{key} {kind}, alpha double, tp long, fn long, fp long, loc double, ass_a double, ass_re double, ass_pr double")


def teta(parts: DataFrame) -> DataFrame:
    """Localisation, association and classification over one threshold's counts, and their mean."""
    one = lambda c: F.greatest(F.lit(1.0), c.cast("double"))
    s = parts.groupBy("iou_thr").agg(*(F.sum(c).alias(c) for c in ("loc_tp", "loc_fn", "loc_fp", "cls_tp", "cls_fn", "cls_fp")), weighted("assoc_a", "loc_tp").alias("assoc_a"))
    s = s.withColumn("loc_a", F.col("loc_tp") / one(F.col("loc_tp") + F.col("loc_fn") + F.col("loc_fp"))).withColumn("cls_a", F.col("cls_tp") / one(F.col("cls_tp") + F.col("cls_fn") + F.col("cls_fp")))
    return s.withColumn("teta", (F.col("loc_a") + F.col("assoc_a") + F.col("cls_a")) / 3)


def group_means(rows: DataFrame, group: str, value: str) -> DataFrame:
    """The mean of group means beside the mean of all; missing values are skipped."""
    per = rows.groupBy(group).agg(F.avg(value).alias("m"), F.sum(value).alias("s"), F.count(value).alias("n"))
    return per.agg(F.avg("m").alias("macro_avg"), (F.sum("s") / F.sum("n")).alias("overall_avg"), F.count("*").alias("groups"))


def merged_metrics(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Metrics of two evaluators side by side, keys of either."""
    return a.join(b, keys, "full_outer")
