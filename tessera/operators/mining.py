"""Hard-example mining: scores, difficulty, source reports, rounds that never repeat, review queues."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import points as P
from ..functions.stats import safe_div
from .lineage import written
from .ranks import mid_rank, with_percentiles

# fixed values
WEIGHTS = {"landmark": 0.80, "presence": 0.10, "handedness": 0.10}
DISAGREEMENT = {"mean_nme": 1.0, "p90_nme": 0.5, "collapse_log_ratio": 0.5, "bone_vector_nme": 0.5, "hand_flag_error": 0.0}


def score_rows(rows: DataFrame) -> DataFrame:
    """Present, predicted training rows with their student's errors in pixels, PCK of unit errors, collapse and class errors.

    Unknown handedness has an error of 0.
    """
    rows = rows.where(F.col("present") & F.col("predicted").isNotNull() & (F.col("split") == "train"))
    rows = rows.withColumn("_e", F.array_sort(P.point_errors(F.col("points"), F.col("predicted"))))
    known = F.coalesce(F.col("handedness").isin("Left", "Right"), F.lit(False))
    right = F.when(F.col("handedness") == "Right", F.col("handedness_score")).otherwise(1 - F.col("handedness_score"))
    n = P.N_POINTS
    return rows.select(
        "*",
        (F.aggregate("_e", F.lit(0.0), lambda a, x: a + x) / n * P.ROI_SIDE_PX).alias("error_px"),
        (F.col("_e")[10] * P.ROI_SIDE_PX).alias("median_px"),
        (F.col("_e")[18] * P.ROI_SIDE_PX).alias("p90_px"),
        (P.within(F.col("_e"), 0.05) / n).alias("pck_005"),
        (P.within(F.col("_e"), 0.10) / n).alias("pck_010"),
        ((P.diagonal(F.col("predicted")) < 0.05) | (F.col("hand_flag") < 0.5)).alias("collapse"),
        (1 - F.col("hand_flag")).alias("presence_error"),
        known.alias("hand_known"),
        F.when(known, 1 - right).otherwise(0.0).alias("handedness_error"),
        P.diagonal(F.col("points")).alias("pose_span"),
    ).drop("_e")


def difficulty(scored: DataFrame) -> DataFrame:
    """Scored rows with the mid-rank of their error and the difficulty: 0.8 rank + 0.1 presence error + 0.1 handedness error."""
    ranked = mid_rank(scored, "error_px", "error_rank")
    return ranked.withColumn("difficulty", WEIGHTS["landmark"] * F.col("error_rank") + WEIGHTS["presence"] * F.col("presence_error") + WEIGHTS["handedness"] * F.col("handedness_error"))


def disagreement_score(rows: DataFrame, weights: dict[str, float] | None = None, id_col: str = "roi_id") -> DataFrame:
    """Rows (id, points, predicted, hand_flag) with the twelve disagreement measures and the weighted sum of five mid-ranks; collapse by absolute value.

    All measures are ranked together, by measure, in one pass.
    """
    weights = {k: v for k, v in (weights or DISAGREEMENT).items() if v}
    rows = rows.withColumns(P.disagreement(F.col("points"), F.col("predicted"), F.col("hand_flag")))
    values = [F.struct(F.lit(n).alias("measure"), F.lit(float(w)).alias("weight"), (F.abs(n) if n == "collapse_log_ratio" else F.col(n)).alias("value")) for n, w in weights.items()]
    long = rows.select(id_col, F.explode(F.array(*values)).alias("e")).select(id_col, "e.*")
    ranked = mid_rank(long, "value", "rank", ("measure",))
    return rows.join(ranked.groupBy(id_col).agg(F.sum(F.col("weight") * F.col("rank")).alias("disagreement")), id_col)


def source_report(scored: DataFrame, by: str = "capture_source_id", eligible: str | None = None) -> DataFrame:
    """Per source: counts, mean, median and p90 error, PCK, collapse and class error rates, difficulty; ranked by p90 difficulty, then p90 error.

    Of brightness, distance and lighting those that the rows have are reported, too: the mean, and the value of the first id.
    eligible names a flag of the rows that a round may take; they are counted.
    """
    needed = {by, "roi_id", "error_px", "pck_005", "pck_010", "collapse", "difficulty", "hand_flag", "hand_known", "handedness_error", "pose_span", "brightness", "distance", "lighting", eligible}
    scored = written(scored.select(*(c for c in scored.columns if c in needed)), "scored")  # read by the report and the percentiles
    more = [F.avg("brightness").alias("mean_brightness")] if "brightness" in scored.columns else []
    more += [F.min_by(c, "roi_id").alias(c) for c in ("distance", "lighting") if c in scored.columns]
    more += [F.count_if(eligible).alias("eligible")] if eligible else []
    report = scored.groupBy(by).agg(
        F.count("*").alias("n"),
        F.avg("error_px").alias("mean_px"),
        F.avg("pck_005").alias("pck_005"),
        F.avg("pck_010").alias("pck_010"),
        F.avg(F.col("collapse").cast("double")).alias("collapse_rate"),
        F.avg("difficulty").alias("mean_difficulty"),
        F.avg((F.col("hand_flag") < 0.5).cast("double")).alias("presence_error_rate"),
        safe_div(F.count_if(F.col("hand_known") & (F.col("handedness_error") > 0.5)), F.count_if("hand_known")).alias("handedness_error_rate"),
        F.avg("pose_span").alias("mean_pose_span"),
        *more,
    )
    shares = {"median_px": ("error_px", 0.5), "p90_px": ("error_px", 0.9), "p90_difficulty": ("difficulty", 0.9), "median_pose_span": ("pose_span", 0.5)}
    report = with_percentiles(report, scored, shares, (by,))
    order = Window.orderBy(F.round("p90_difficulty", 9).desc(), F.round("p90_px", 9).desc(), by)  # a row per source
    return report.withColumn("source_rank", F.row_number().over(order))


def mine_round(scored: DataFrame, ledger: DataFrame, k: int, round_id: int, id_col: str = "roi_id") -> DataFrame:
    """The k hardest rows that no earlier round took, by difficulty, error, id; a round of the ledger can't be mined again."""
    if ledger.where(F.col("round_id") == round_id).limit(1).count():
        raise ValueError(f"round {round_id} is in the ledger")
    fresh = scored.join(ledger.select(id_col).distinct(), id_col, "left_anti")
    return fresh.orderBy(F.col("difficulty").desc(), F.col("error_px").desc(), id_col).limit(k).withColumn("round_id", F.lit(round_id))


def review_queues(paired: DataFrame, inferred: DataFrame, limit: int, collapse_below: float = 0.10) -> DataFrame:
    """(category, position, key, value): up to `limit` cases for review, a quarter of them (1 at least) from each category, in this order:
    student_collapse (smallest spread), high_landmark_error, improved_vs_baseline (largest fall of the error), palm_or_roi_failure.

    paired: roi_id, candidate_px, delta_px, candidate_spread; inferred: image, failure_score (joins.paired_detections). Spreads
    must be below collapse_below and failure scores positive; missing values are not cases. A case may be in several categories.
    """
    each = max(1, limit // 4)
    found = [
        ("student_collapse", paired.where(F.col("candidate_spread") < collapse_below), "roi_id", F.col("candidate_spread")),
        ("high_landmark_error", paired.where("candidate_px is not null"), "roi_id", -F.col("candidate_px")),
        ("improved_vs_baseline", paired.where("delta_px is not null"), "roi_id", F.col("delta_px")),
        ("palm_or_roi_failure", inferred.where("failure_score > 0"), "image", -F.col("failure_score")),
    ]
    tops = [rows.select(F.lit(name).alias("category"), F.lit(k).alias("_k"), F.col(key).alias("key"), order.alias("_o")).orderBy("_o", "key").limit(each) for k, (name, rows, key, order) in enumerate(found)]
    queue = reduce(DataFrame.unionByName, tops)  # limit rows, about
    own, all_ = Window.partitionBy("category").orderBy("_o", "key"), Window.orderBy("_k", "_o", "key")
    queue = queue.withColumn("position", F.row_number().over(own)).withColumn("_n", F.row_number().over(all_)).where(F.col("_n") <= limit)
    return queue.select("category", "position", "key", F.abs("_o").alias("value"))
