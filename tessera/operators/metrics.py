"""Evaluation: row measures, confusion, landmark and handedness reports, sweeps, baselines and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import points as P
from ..functions.stats import finite_mean, is_finite, safe_div
from .lineage import written
from .ranks import percentiles_of_sets, with_percentiles

PCK = (0.05, 0.10, 0.15)
DIMENSIONS = ("dataset_id", "capture_source_id", "proposal_variant", "source_group_id", "distance", "lighting")
COLLAPSE_PX = 0.05 * (255.0**2 + 255.0**2) ** 0.5


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _n(c: Column) -> Column:
    return F.count_if(_flag(c))


def row_measures(rows: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Labels joined with predictions -> their errors in pixels, NME, PCK hits, collapse and class decisions.

    Landmarks count for present hands; a missing prediction leaves its errors null. PCK compares errors
    with the diagonal of the labelled points.
    """
    expected, predicted = F.col("points"), F.col("predicted")
    side = P.ROI_SIDE_PX
    counted = F.col("present") & predicted.isNotNull()
    rows = rows.withColumn("errors_px", F.when(counted, F.transform(P.point_errors(expected, predicted), lambda e: e * side)))
    rows = rows.withColumn("diagonal_px", F.greatest(P.diagonal(expected) * side, F.lit(1e-6)))
    error = F.aggregate("errors_px", F.lit(0.0), lambda a, x: a + x) / P.N_POINTS
    rows = rows.withColumn("error_px", error).withColumn("nme", F.col("error_px") / F.col("diagonal_px"))
    hits = [P.within(F.col("errors_px"), F.col("diagonal_px") * t).alias(f"hits_{round(100 * t):03d}") for t in PCK]
    score = F.col("handedness_score")
    return rows.select(
        "*",
        *hits,
        (F.col("hand_flag") >= threshold).alias("predicted_present"),
        F.when(score >= 0.5, "Right").otherwise("Left").alias("predicted_handedness"),
        _flag(P.diagonal(predicted) * side < COLLAPSE_PX).alias("collapsed"),
    )


def confusion_aggregates(truth: Column, predicted: Column, prefix: str = "") -> list[Column]:
    tp, fp, tn, fn = _n(truth & predicted), _n(~truth & predicted), _n(~truth & ~predicted), _n(truth & ~predicted)
    precision, recall = safe_div(tp, tp + fp), safe_div(tp, tp + fn)
    values = {
        "tp": tp, "fp": fp, "tn": tn, "fn": fn,
        "accuracy": safe_div(tp + tn, tp + fp + tn + fn), "precision": precision, "recall": recall,
        "f1": safe_div(2 * precision * recall, precision + recall), "fpr": safe_div(fp, fp + tn), "fnr": safe_div(fn, fn + tp),
    }
    return [v.alias(prefix + k) for k, v in values.items()]


def confusion(rows: DataFrame, truth: str, predicted: str, by: tuple[str, ...] = ()) -> DataFrame:
    """tp, fp, tn, fn and their ratios; a ratio without a denominator is 0."""
    return rows.groupBy(*by).agg(*confusion_aggregates(F.col(truth), F.col(predicted)))


def landmark_aggregates() -> list[Column]:
    """A present hand without a prediction adds 21 misses to each PCK."""
    positives, given = _n(F.col("present")), F.count("error_px")
    out = [positives.alias("gt_positive"), given.alias("n_predicted"), safe_div(given, positives).alias("coverage"), F.avg("error_px").alias("mean_px"), F.avg("nme").alias("mean_nme")]
    return out + [safe_div(F.sum(f"hits_{round(100 * t):03d}"), positives * P.N_POINTS).alias(f"pck_{round(100 * t):03d}") for t in PCK]


#: The percentiles of a landmark report.
LANDMARK_PERCENTILES = {"median_px": ("error_px", 0.5), "p90_px": ("error_px", 0.9), "p95_px": ("error_px", 0.95), "median_nme": ("nme", 0.5)}


def landmark_metrics(measured: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return with_percentiles(measured.groupBy(*by).agg(*landmark_aggregates()), measured, LANDMARK_PERCENTILES, by)


def handedness_aggregates() -> list[Column]:
    """Right is the positive class; rows of unknown handedness count as excluded only."""
    known = F.col("present") & F.col("handedness").isin("Left", "Right")
    right, said = F.col("handedness") == "Right", F.col("predicted_handedness") == "Right"
    return [
        _n(known).alias("hand_eligible"),
        _n(F.col("present") & ~F.coalesce(F.col("handedness").isin("Left", "Right"), F.lit(False))).alias("hand_excluded"),
        safe_div(_n(known & (right == said)), _n(known)).alias("hand_accuracy"),
        safe_div(_n(known & ~right & ~said), _n(known & ~right)).alias("left_recall"),
        safe_div(_n(known & right & said), _n(known & right)).alias("right_recall"),
    ]


def handedness_metrics(measured: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return measured.groupBy(*by).agg(*handedness_aggregates())


def collapse_aggregates() -> list[Column]:
    hit = F.col("present") & F.col("collapsed")
    return [_n(hit).alias("collapse_count"), safe_div(_n(hit), _n(F.col("present"))).alias("collapse_rate")]


def collapse_rate(measured: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return measured.groupBy(*by).agg(*collapse_aggregates())


def grouped_report(measured: DataFrame, dims: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """All reports for all rows and for each value of each dimension, in one pass of grouping sets, and the percentiles by rank.

    dimension is "all" or a name; empty and missing values are "unknown". The measures are written once, as both passes read them.
    """
    needed = ["present", "predicted_present", "error_px", "nme", *(c for c in measured.columns if c.startswith("hits_")), "handedness", "predicted_handedness", "collapsed"]
    filled = measured.select(*needed, *(F.coalesce(F.nullif(F.col(d), F.lit("")), F.lit("unknown")).alias(d) for d in dims))
    filled = written(filled, "measured")
    sets = [[], *([F.col(d)] for d in dims)]
    aggregates = [F.count("*").alias("n"), *confusion_aggregates(F.col("present"), F.col("predicted_present")), *landmark_aggregates(), *handedness_aggregates(), *collapse_aggregates()]
    report = filled.groupingSets(sets, *(F.col(d) for d in dims)).agg(*aggregates, *(F.grouping(d).alias(f"_{d}") for d in dims))
    dimension = F.coalesce(*(F.when(F.col(f"_{d}") == 0, d) for d in dims), F.lit("all"))
    value = F.coalesce(*(F.when(F.col(f"_{d}") == 0, F.col(d)) for d in dims), F.lit("all"))
    report = report.select(dimension.alias("dimension"), value.alias("value"), *(c for c in report.columns if c.lstrip("_") not in dims))
    shares = percentiles_of_sets(filled, dims, LANDMARK_PERCENTILES)
    return report.join(shares, ["dimension", "value"], "left")


def per_landmark_error(measured: DataFrame) -> DataFrame:
    """Mean error of each of the 21 points."""
    return measured.select(F.posexplode("errors_px").alias("landmark_id", "e")).groupBy("landmark_id").agg(F.count("*").alias("n"), F.avg("e").alias("mean_px"))


def threshold_sweep(rows: DataFrame, truth: str, score: str, thresholds: list[float]) -> DataFrame:
    """Confusion at each threshold (score >= threshold), from one count per class and interval: work doesn't grow with the thresholds."""
    steps = sorted({float(t) for t in thresholds})
    passed = F.size(F.filter(F.array(*map(F.lit, steps)), lambda t: F.col(score) >= t))
    cells = rows.groupBy(passed.alias("passed"), F.col(truth).alias("truth")).agg(F.count("*").alias("n"))
    grid = cells.select("truth", "n", "passed", F.posexplode(F.array(*map(F.lit, steps))).alias("k", "threshold"))
    said, truth_, n = F.col("passed") > F.col("k"), F.col("truth"), F.col("n")

    def count(c: Column) -> Column:
        return F.coalesce(F.sum(F.when(c, n)), F.lit(0)).cast("long")

    out = grid.groupBy("threshold").agg(count(truth_ & said).alias("tp"), count(~truth_ & said).alias("fp"), count(~truth_ & ~said).alias("tn"), count(truth_ & ~said).alias("fn"))
    precision, recall = safe_div(F.col("tp"), F.col("tp") + F.col("fp")), safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    return out.withColumns({"precision": precision, "recall": recall, "f1": safe_div(2 * precision * recall, precision + recall)})


def run_summary(decorated: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Means over the rows of a run: error (and its p90, the value nearest to the rank), NME, bone error, collapse (spread below 0.10), accuracies, PCK of 255 pixels."""
    known = F.col("handedness").isin("Left", "Right")
    needed = ("error_px", "nme", "bone_error", "predicted_spread", "present", "predicted_present", "handedness", "predicted_handedness")
    hits = {f"_h{k}": P.within(F.col("errors_px"), t * P.ROI_SIDE_PX) for k, t in enumerate(PCK)}
    decorated = written(decorated.select(*by, *needed, F.col("errors_px").isNotNull().alias("_counted"), *(c.alias(n) for n, c in hits.items())), "decorated")
    errors = [safe_div(F.sum(n), F.count_if("_counted") * P.N_POINTS).alias(f"pck_{round(100 * t):03d}") for n, t in zip(hits, PCK)]
    report = decorated.groupBy(*by).agg(
        F.count("*").alias("records"),
        F.count("error_px").alias("positive_records"),
        finite_mean(F.col("error_px")).alias("mean_px"),
        finite_mean(F.col("nme")).alias("mean_nme"),
        finite_mean(F.col("bone_error")).alias("mean_bone_error"),
        _n(F.col("predicted_spread") < 0.10).alias("collapse_count"),
        F.avg((F.col("present") == F.col("predicted_present")).cast("double")).alias("presence_accuracy"),
        F.avg(F.when(known, (F.col("handedness") == F.col("predicted_handedness")).cast("double"))).alias("handedness_accuracy"),
        *errors,
    )
    return with_percentiles(report, decorated, {"p90_px": ("error_px", 0.9)}, by, nearest=True)


def gold_relative(rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Skeleton length and box area of predictions as ratios to the gold points; shares below 0.7 and 0.5."""
    length = P.skeleton_length(F.col("predicted")) / F.nullif(P.skeleton_length(F.col("points")), F.lit(0.0))
    area = P.bbox_area(F.col("predicted")) / F.nullif(P.bbox_area(F.col("points")), F.lit(0.0))
    rows = rows.withColumn("length_ratio", length).withColumn("area_ratio", area)
    return rows.groupBy(*by).agg(
        F.count("length_ratio").alias("n"), F.avg("length_ratio").alias("mean_length_ratio"), F.avg("area_ratio").alias("mean_area_ratio"),
        _n(F.col("length_ratio") < 0.7).alias("below_070"), _n(F.col("length_ratio") < 0.5).alias("below_050"),
    )


def occupancy_stats(rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Width, height and least margin of the points in their crop, and the share of rows with points outside it."""
    p = F.col("points")
    xs, ys = F.transform(p, lambda q: q["x"]), F.transform(p, lambda q: q["y"])
    margin = F.least(F.array_min(xs), F.array_min(ys), 1 - F.array_max(xs), 1 - F.array_max(ys))
    rows = rows.select("*", P.extent(p, "x").alias("_w"), P.extent(p, "y").alias("_h"), margin.alias("_m"), (P.out_of_range(p) > 0).alias("_o"))
    out = [F.count("*").alias("n"), F.avg(F.col("_o").cast("double")).alias("out_of_range_rate")]
    sizes = {"width": "_w", "height": "_h", "margin": "_m"}
    out += [F.avg(c).alias(f"mean_{n}") for n, c in sizes.items()]
    return with_percentiles(rows.groupBy(*by).agg(*out), rows, {f"median_{n}": (c, 0.5) for n, c in sizes.items()}, by)


def low_quantile_flags(train: DataFrame, gold: DataFrame, p: float = 0.01) -> DataFrame:
    """Training rows whose skeleton length, box area or palm width lies below the gold rows' p-quantile."""
    measures = {"skeleton_length": P.skeleton_length, "bbox_area": P.bbox_area, "palm_width": P.palm_width}
    measured = train.select("*", *(f(F.col("points")).alias(n) for n, f in measures.items()))
    gold = gold.select(*(f(F.col("points")).alias(n) for n, f in measures.items()))
    limits = with_percentiles(gold.agg(F.count("*").alias("_gold")), gold, {f"least_{n}": (n, p) for n in measures}).drop("_gold")
    flagged = measured.crossJoin(F.broadcast(limits))  # one row
    flags = F.array_compact(F.array(*(F.when(F.col(n) < F.col(f"least_{n}"), n) for n in measures)))
    return flagged.withColumn("low", flags).where(F.size("low") > 0).drop(*(f"least_{n}" for n in measures))


def abstain_report(gold: DataFrame, teacher: DataFrame) -> DataFrame:
    """Of gold rows with and without a teacher's answer: how many, and the mean error of a student where known."""
    joined = gold.join(teacher.select("roi_id", F.lit(True).alias("answered")).distinct(), "roi_id", "left")
    return joined.groupBy(F.coalesce("answered", F.lit(False)).alias("answered")).agg(F.count("*").alias("n"), F.avg("error_px").alias("mean_px"))


def constant_pose_baseline(train: DataFrame, test: DataFrame) -> DataFrame:
    """Landmark metrics of the mean training pose as the answer to every test row."""
    mean = train.select(F.posexplode("points").alias("id", "p")).groupBy("id").agg(F.avg("p.x").alias("x"), F.avg("p.y").alias("y"))
    pose = mean.agg(F.array_sort(F.collect_list(F.struct("id", "x", "y"))).alias("predicted"))
    rows = test.drop("predicted", "hand_flag", "handedness_score").crossJoin(F.broadcast(pose)).withColumn("hand_flag", F.lit(1.0)).withColumn("handedness_score", F.lit(1.0))  # one row
    return landmark_metrics(row_measures(rows))


def weighted_losses(rows: DataFrame, delta: float = 0.05, epsilon: float = 1e-6) -> DataFrame:
    """Weighted means of Huber, bone-vector, spread log-ratio and cross-entropy losses; weight sums are floored."""
    e = P.point_errors(F.col("points"), F.col("predicted"))
    huber = F.aggregate(F.transform(e, lambda d: F.when(d <= delta, d * d / 2).otherwise(delta * (d - delta / 2))), F.lit(0.0), lambda a, x: a + x) / P.N_POINTS
    bone = P.bone_vector_error(F.col("points"), F.col("predicted"))
    spread = F.abs(F.log(F.greatest(P.diagonal(F.col("predicted")), F.lit(epsilon)) / F.greatest(P.diagonal(F.col("points")), F.lit(epsilon))))
    p = F.greatest(F.lit(1e-7), F.least(F.lit(1 - 1e-7), F.col("hand_flag")))
    t = F.col("present").cast("double")
    entropy = -(t * F.log(p) + (1 - t) * F.log(1 - p))
    w = F.col("weight")

    def mean(loss: Column) -> Column:
        return F.coalesce(F.sum(w * loss), F.lit(0.0)) / F.greatest(F.coalesce(F.sum(F.when(loss.isNotNull(), w)), F.lit(0.0)), F.lit(epsilon))

    return rows.agg(mean(huber).alias("huber"), mean(bone).alias("bone_vector"), mean(spread).alias("spread_log_ratio"), mean(entropy).alias("presence_bce"))


def multitask_score(mae: Column, flag_error: Column, hand_error: Column) -> Column:
    """MAE + 0.02 flag error + 0.005 hand error; null if one is missing."""
    return mae + 0.02 * flag_error + 0.005 * hand_error


def best_epoch(history: DataFrame, mode: str | None = None, stride: int = 1) -> DataFrame:
    """(run, epoch, metric, value) -> per run and metric the first epoch with the best value, on every stride-th epoch.

    Without a mode, metrics named like accuracy, recall, precision, f1, auc or pck are maximised, others minimised.
    """
    up = F.lit(mode == "max") if mode else F.lower("metric").rlike("acc|recall|precision|f1|auc|pck")
    signed = F.when(up, -F.col("value")).otherwise(F.col("value"))
    rows = history.where((F.col("epoch") % stride == 0) & is_finite(F.col("value")))
    return rows.groupBy("run", "metric").agg(F.min(F.struct(signed.alias("s"), F.col("epoch").alias("epoch"), F.col("value").alias("value"))).alias("b")).select("run", "metric", "b.epoch", "b.value")


def fit_gate(rows: DataFrame, limits: dict[str, float]) -> DataFrame:
    """Coordinate MAE of each row's points: mean, p90 and max over the rows, with a check per limit."""
    mae = F.aggregate(F.zip_with("points", "predicted", lambda a, b: F.abs(a["x"] - b["x"]) + F.abs(a["y"] - b["y"])), F.lit(0.0), lambda s, v: s + v) / (2 * P.N_POINTS)
    rows = rows.select(mae.alias("mae"))
    report = with_percentiles(rows.agg(F.avg("mae").alias("mean"), F.max("mae").alias("max")), rows, {"p90": ("mae", 0.9)})
    return report.withColumns({f"{k}_ok": F.coalesce(F.col(k) <= v, F.lit(False)) for k, v in limits.items()})


def multihead_gate(rows: DataFrame) -> DataFrame:
    """Masked cross-entropy (clipped at 1e-7) and accuracy of presence and handedness."""
    out = []
    for head, t, p, mask in (("presence", F.col("present"), F.col("hand_flag"), F.lit(True)), ("handedness", F.col("handedness") == "Right", F.col("handedness_score"), F.col("present") & F.col("handedness").isin("Left", "Right"))):
        q, y = F.greatest(F.lit(1e-7), F.least(F.lit(1 - 1e-7), p)), t.cast("double")
        out += [F.avg(F.when(mask, -(y * F.log(q) + (1 - y) * F.log(1 - q)))).alias(f"{head}_bce"), F.avg(F.when(mask, (t == (p >= 0.5)).cast("double"))).alias(f"{head}_accuracy"), _n(mask).alias(f"{head}_n")]
    return rows.agg(*out)


def roi_count_table(detections: DataFrame, thresholds: list[float]) -> DataFrame:
    """(image, score) -> per threshold the images with 0, 1 and 2 or more detections, and all detections."""
    passed = detections.groupBy("image").agg(*(_n(F.col("score") >= t).alias(f"t{k}") for k, t in enumerate(thresholds)))
    rows = passed.select(F.explode(F.array(*(F.struct(F.lit(float(t)).alias("threshold"), F.col(f"t{k}").alias("n")) for k, t in enumerate(thresholds)))).alias("r")).select("r.*")
    return rows.groupBy("threshold").agg(_n(F.col("n") == 0).alias("none"), _n(F.col("n") == 1).alias("one"), _n(F.col("n") >= 2).alias("two_or_more"), F.sum("n").alias("total"))


def output_health(rows: DataFrame) -> DataFrame:
    """Largest absolute coordinate, and how many rows and coordinates lie outside [0, 1]."""
    out = P.out_of_range(F.col("predicted"))
    given = F.col("predicted").isNotNull()
    return rows.agg(F.count("predicted").alias("n_predicted"), F.max(P.max_abs(F.col("predicted"))).alias("max_abs"), _n(given & (out > 0)).alias("rows_out"), F.coalesce(F.sum(F.when(given, out)), F.lit(0)).cast("long").alias("coordinates_out"))
