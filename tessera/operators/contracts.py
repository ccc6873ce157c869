"""Row contracts and canonical rows: errors, warnings, reason codes, weights, actions and export rows as columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import points as P
from ..functions.text import capture_parts, first_filled, salted_digest

POINTS = "array<struct<id:int,x:double,y:double>>"
RECT = "struct<x_center:double,y_center:double,width:double,height:double,rotation_rad:double>"

#: Names of the two row forms, unless a caller gives its own.
TRAIN_SCHEMA, EVALUATION_SCHEMA = "canonical_train_v1", "canonical_evaluation_v1"
# fixed values: names in label files
SAMPLE_TYPES = ("POS_RUNTIME", "POS_LOW_PALM", "NEG_RUNTIME_CANDIDATE", "NEG_LOW_PALM_CANDIDATE")
QUALITY_TIERS = ("HIGH", "MEDIUM", "PRESENCE_ONLY")
HEAD_MASKS = ("hand_presence_loss_weight", "landmark_loss_weight", "handedness_loss_weight")
QUALITY_WEIGHTS = ("presence_quality_weight", "landmark_quality_weight", "handedness_quality_weight")
POINT_LISTS = ("points", "points_px", "points_image")


def codes(checks: dict[str, Column]) -> Column:
    """Sorted names of the checks that are true."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in checks.items())))))


def sample_type(present: Column, palm_valid: Column) -> Column:
    """Positive or negative, at runtime or of a low palm score; missing presence means absent."""
    p, v = F.coalesce(present, F.lit(False)), F.coalesce(palm_valid, F.lit(False))
    return F.when(p & v, SAMPLE_TYPES[0]).when(p, SAMPLE_TYPES[1]).when(v, SAMPLE_TYPES[2]).otherwise(SAMPLE_TYPES[3])


def provenance(tier: Column, origin: Column) -> Column:
    """Who made a label: gold rows and those of human origin or correction are human."""
    human = (tier == "gold") | (origin == "human") | origin.endswith("_human_corrected")
    return F.when(F.coalesce(human, F.lit(False)), "human_gold").otherwise("mediapipe_pseudo")


def canonicalize(raw: DataFrame, stage: str | None, mix_role: str = "base", schema: str | None = None) -> DataFrame:
    """Published rows as canonical rows of a training stage, or of evaluation where stage is null.

    Expects roi_id, dataset_id, capture_source_id, split, present, handedness, points; uses proposal_kind (runtime where absent),
    label_origin (mediapipe), dataset_weight (1), crop_relpath and the pixel point lists where the rows have them. Other columns stay,
    but for those that begin with an underscore. All ids become roi_id and the source group the capture; points are sorted by
    id. Training rows get tier (gold for the hard role, else pseudo), provenance, sample type and the bucket tier:sample_type.
    """
    has = lambda c, default: F.coalesce(F.col(c), F.lit(default)) if c in raw.columns else F.lit(default)
    present, runtime = F.coalesce("present", F.lit(False)), has("proposal_kind", "runtime") == "runtime"
    known = F.lower("handedness")
    values = {
        "schema_version": F.lit(schema or (TRAIN_SCHEMA if stage else EVALUATION_SCHEMA)),
        **{c: F.col("roi_id") for c in ("global_crop_id", "crop_id", "source_crop_id")},
        "source_group_id": F.col("capture_source_id"),
        "warehouse_crop_relpath": F.coalesce(*(F.col(c) for c in ("crop_relpath", "crop_path") if c in raw.columns), F.lit(None).cast("string")),
        "width": F.lit(256),
        "height": F.lit(256),
        "present": present,
        "palm_valid": runtime if stage else F.lit(True),
        "handedness": F.when(known.isin("left", "right"), F.initcap("handedness")).otherwise(F.coalesce(known, F.lit("unknown"))),
        "ignore_for_training": F.lit(False),
        "selection_action": F.lit("include"),
        "quality_tier": F.lit("HIGH"),
        "quality_flags": F.array().cast("array<string>"),
        **{c: F.lit(1.0) for c in (HEAD_MASKS[0], "supervision_loss_weight", *QUALITY_WEIGHTS)},
        **{c: present.cast("double") for c in HEAD_MASKS[1:]},
        "sampling_weight": has("dataset_weight", 1.0).cast("double"),
        "capture": capture_parts(F.col("capture_source_id")),
        **{c: F.when(present, F.coalesce(P.canonical_points(F.col(c)), F.col(c))) for c in POINT_LISTS if c in raw.columns},
    }
    if stage:
        tier, kind = F.lit("gold" if mix_role == "hard" else "pseudo"), sample_type(present, runtime)
        values |= {
            "training_stage": F.lit(stage),
            "mix_role": F.lit(mix_role),
            "supervision_tier": tier,
            "annotation_provenance": provenance(tier, has("label_origin", "mediapipe")),
            "sample_type": kind,
            "sampling_bucket": F.concat_ws(":", tier, kind),
        }
    else:
        values["ground_truth_valid"] = F.lit(True)
    return raw.select(*(c for c in raw.columns if c not in values and not c.startswith("_")), *(v.alias(c) for c, v in values.items()))


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))


def _point_checks(name: str, pts: Column) -> dict[str, Column]:
    """Of one point list of a positive: 21 points, ids 0 to 20 once each, finite."""
    full = F.coalesce(F.size(pts) == P.N_POINTS, F.lit(False))
    ids = F.array_sort(F.transform(pts, lambda p: p["id"]))
    return {
        f"{name}_not_21": ~full,
        f"{name}_bad_ids": full & ~F.coalesce(ids == F.sequence(F.lit(0), F.lit(P.N_POINTS - 1)), F.lit(False)),
        f"{name}_not_finite": full & F.exists(pts, lambda p: ~(_finite(p["x"]) & _finite(p["y"]))),
    }


def row_errors(rows: DataFrame, stage: str | None = None, split: str | None = None, image_size: tuple[int, int] = (256, 256), schema: str | None = None) -> DataFrame:
    """Canonical rows with errors and warnings, sorted arrays of codes; empty for a row that keeps the contract.

    A column that the rows lack counts as null. With a stage the rules of training rows hold, with a split those of evaluation rows.
    """
    types = {**{c: POINTS for c in POINT_LISTS}, "quality_flags": "array<string>", "corners": "array<array<double>>", "rect": RECT, "present": "boolean", "palm_valid": "boolean", "ignore_for_training": "boolean", "ground_truth_valid": "boolean"}
    types |= dict.fromkeys(("palm_score", "label_score", "supervision_loss_weight", "sampling_weight", *HEAD_MASKS, *QUALITY_WEIGHTS), "double")
    col = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast(types.get(c, "string"))
    true = lambda c: F.coalesce(c, F.lit(False))
    empty = lambda c: col(c).isNull() | (col(c).cast("string") == "")
    present, hand, pts = true(col("present")), col("handedness"), {c: col(c) for c in POINT_LISTS}
    checks = {f"missing_{c}": empty(c) for c in ("global_crop_id", "crop_id", "dataset_id", "source_crop_id", "source_group_id", "crop_path")}
    checks |= {
        "crop_id_differs": ~empty("global_crop_id") & ~empty("crop_id") & (col("crop_id") != col("global_crop_id")),
        "wrong_size": ~true((col("width").cast("int") == image_size[0]) & (col("height").cast("int") == image_size[1])),
        "ignored_row": true(col("ignore_for_training")),
        "missing_presence": col("present").isNull(),
        "bad_handedness": ~true(hand.isin("Left", "Right", "unknown")),
        "bad_handedness_score": col("label_score").isNotNull() & ~_finite(col("label_score")),
        "bad_palm_score": ~_finite(col("palm_score").cast("double")),
        "missing_palm_valid": col("palm_valid").isNull(),
    }
    wanted = schema or (TRAIN_SCHEMA if stage else EVALUATION_SCHEMA if split else None)
    if wanted:
        checks["wrong_schema_version"] = ~col("schema_version").eqNullSafe(F.lit(wanted))
    if "capture_source_id" in rows.columns:
        checks["bad_capture_id"] = ~capture_parts(col("capture_source_id"))["valid"]
        checks["capture_split_differs"] = F.get(F.split("capture_source_id", "-"), 4) != col("split")
    for name in POINT_LISTS:
        checks |= {k: present & c for k, c in _point_checks(name, pts[name]).items()}
        checks[f"{name}_on_negative"] = ~present & (F.coalesce(F.size(pts[name]), F.lit(0)) > 0)
    norm, px = P.canonical_points(pts["points"]), P.canonical_points(pts["points_px"])
    far = lambda a, b: (F.abs(a["x"] * (image_size[0] - 1) - b["x"]) > 0.08) | (F.abs(a["y"] * (image_size[1] - 1) - b["y"]) > 0.08)
    checks["points_px_disagree"] = present & F.exists(F.zip_with(norm, px, far), lambda v: v)
    checks["negative_with_hand"] = ~present & (~hand.eqNullSafe(F.lit("unknown")) | col("label_score").isNotNull())
    checks["negative_with_hand_id"] = ~present & col("hand_id").isNotNull()
    rect, corners = col("rect"), col("corners")
    sides = ("x_center", "y_center", "width", "height", "rotation_rad")
    finite_rect = reduce(lambda a, b: a & b, (_finite(rect[c]) for c in sides))
    checks["bad_rect"] = ~true(finite_rect)
    checks["rect_without_area"] = true(_finite(rect["width"]) & (rect["width"] <= 0)) | true(_finite(rect["height"]) & (rect["height"] <= 0))
    checks["bad_corners"] = ~true((F.size(corners) == 4) & F.forall(corners, lambda c: (F.size(c) == 2) & _finite(c[0]) & _finite(c[1])))
    weights = [*HEAD_MASKS]
    if stage:
        weights += ["supervision_loss_weight", *QUALITY_WEIGHTS, "sampling_weight"]
        tier, kind = col("supervision_tier"), col("sample_type")
        by_tier = F.when(tier.isin("pseudo", "gold"), provenance(tier, col("label_origin")))
        checks |= {
            "wrong_stage": ~col("training_stage").eqNullSafe(F.lit(stage)),
            "not_included": ~col("selection_action").eqNullSafe(F.lit("include")),
            "bad_supervision_tier": ~true(tier.isin("pseudo", "gold")),
            "provenance_conflicts": by_tier.isNotNull() & ~col("annotation_provenance").eqNullSafe(by_tier),
            "bad_quality_tier": ~true(col("quality_tier").isin(*QUALITY_TIERS)),
            "missing_quality_flags": col("quality_flags").isNull(),
            "missing_sampling_bucket": empty("sampling_bucket"),
            "bad_sample_type": ~true(kind.isin(*SAMPLE_TYPES)),
            "wrong_sample_type": true(kind.isin(*SAMPLE_TYPES)) & col("palm_valid").isNotNull() & (kind != sample_type(col("present"), col("palm_valid"))),
        }
    if split:
        checks |= {"wrong_split": ~col("split").eqNullSafe(F.lit(split)), "invalid_ground_truth": ~true(col("ground_truth_valid")), "palm_not_valid": ~true(col("palm_valid"))}
    checks |= {f"bad_{c}": ~(_finite(col(c)) & (col(c) >= 0)) for c in weights}
    checks |= {f"{c}_not_a_mask": _finite(col(c)) & ~col(c).isin(0.0, 1.0) for c in HEAD_MASKS}
    return rows.withColumn("errors", codes(checks)).withColumn("warnings", codes({"points_out_of_range": present & (P.out_of_range(pts["points"]) > 0)}))


def eval_row_errors(rows: DataFrame, split: str) -> DataFrame:
    """row_errors() of evaluation rows, which must be valid ground truth of one split."""
    return row_errors(rows, split=split)


def violations(checked: DataFrame, key: str = "roi_id") -> DataFrame:
    """(key, error) of every row that breaks its contract."""
    return checked.select(key, F.explode("errors").alias("error"))


def positive_reasons(rows: DataFrame, tiers: tuple[str, ...] = (), low: float = -0.05, high: float = 1.05) -> DataFrame:
    """Positives with reason codes against their use; crop_found (of an inventory) and needs_review are used where the rows have them.

    Fixed values: the codes, which reports and reviews share.
    """
    column = lambda c, kind: F.col(c) if c in rows.columns else F.lit(None).cast(kind)
    lists = [F.col(c) for c in POINT_LISTS if c in rows.columns]
    whole = reduce(lambda a, b: a & b, (F.coalesce(P.canonical_points(p).isNotNull(), F.lit(False)) for p in lists))
    outside = F.exists("points", lambda p: (p["x"] < low) | (p["x"] > high) | (p["y"] < low) | (p["y"] > high))
    checks = {
        "INVALID_POSITIVE_SAMPLE_TYPE": ~F.coalesce(column("sample_type", "string").isin(*SAMPLE_TYPES[:2]), F.lit(False)),
        "DISALLOWED_QUALITY_TIER": ~F.coalesce(column("quality_tier", "string").isin(*tiers), F.lit(False)) if tiers else F.lit(False),
        "SOURCE_MARKED_NEEDS_REVIEW": F.coalesce(column("needs_review", "boolean"), F.lit(False)),
        "INVALID_LANDMARKS": ~whole,
        "LANDMARK_OUT_OF_ALLOWED_RANGE": whole & outside,
        "MISSING_CROP_IMAGE": ~F.coalesce(column("crop_found", "boolean"), F.lit("crop_found" not in rows.columns)),
    }
    return rows.withColumn("reasons", codes(checks))


def head_weights(rows: DataFrame, tier_weights: dict[str, float] | None = None) -> DataFrame:
    """Loss weights of the presence, landmark and handedness heads: mask times supervision times quality (1 where the rows lack one) times
    the weight of the tier. Negatives weigh on presence only, unknown hands not on handedness. A tier without a weight raises."""
    part = lambda c: F.coalesce(F.col(c), F.lit(1.0)) if c in rows.columns else F.lit(1.0)
    whole = part("supervision_loss_weight")
    if tier_weights is not None:
        if any(not 0 < w < float("inf") for w in tier_weights.values()):
            raise ValueError("tier weights must be finite and positive")
        tier = F.lower("supervision_tier")
        of_tier = F.create_map(*(x for k, v in tier_weights.items() for x in (F.lit(k), F.lit(float(v)))))[tier]
        whole = whole * F.coalesce(of_tier, F.raise_error(F.concat(F.lit("no weight for tier "), F.coalesce(tier, F.lit("null")))).cast("double"))
    present = F.coalesce("present", F.lit(False))
    counted = {"presence": F.lit(True), "landmark": present, "handedness": present & F.coalesce(F.lower("handedness").isin("left", "right"), F.lit(False))}
    return rows.withColumns({f"{h}_weight": F.when(c, part(m) * whole * part(q)).otherwise(0.0) for (h, c), m, q in zip(counted.items(), HEAD_MASKS, QUALITY_WEIGHTS)})


def identity(*columns: str) -> Column:
    """The first id that is filled."""
    return first_filled(*map(F.col, columns))


def drop_internal(rows: DataFrame) -> DataFrame:
    """Rows without the columns whose names begin with an underscore."""
    return rows.select(*(c for c in rows.columns if not c.startswith("_")))


def smoke_category(rows: DataFrame) -> DataFrame:
    """Rows with one of five categories by presence, tier and sample type, null where none fits (a violation)."""
    tier, kind, present = F.lower("supervision_tier"), F.col("sample_type"), F.col("present")
    pseudo = tier == "pseudo"
    category = F.when(present.isNotNull() & (tier == "gold"), F.when(present, "gold_positive").otherwise("gold_negative")).when(pseudo & present, "pseudo_positive")
    category = category.when(pseudo & ~present & (kind == SAMPLE_TYPES[2]), "pseudo_neg_runtime").when(pseudo & ~present & (kind == SAMPLE_TYPES[3]), "pseudo_neg_low")
    return rows.withColumn("category", category)


def score_filter(rows: DataFrame, threshold: float, score: str = "score") -> DataFrame:
    """Rows with a finite score of at least the threshold."""
    s = F.col(score)
    return rows.where(s.isNotNull() & ~F.isnan(s) & (F.abs(s) != float("inf")) & (s >= threshold))


def augment_points(rows: DataFrame, seed: int, id_col: str = "roi_id", flip: float = 0.5, degrees: float = 15.0, scale: float = 0.1, shift: float = 0.05) -> DataFrame:
    """Points flipped, turned, scaled and moved about the centre by amounts that depend on seed and id; a flip swaps the hand. Nothing is clipped."""
    from ..functions.text import uniform

    u = [uniform(F.lit(seed), F.col(id_col), F.lit(k)) for k in range(5)]
    angle, size = F.radians((2 * u[1] - 1) * degrees), 1 + (2 * u[2] - 1) * scale
    c, s = F.cos(angle) * size, F.sin(angle) * size
    flipped = u[0] < flip

    def move(p: Column) -> Column:
        x, y = F.when(flipped, 0.5 - p["x"]).otherwise(p["x"] - 0.5), p["y"] - 0.5
        return F.struct(p["id"].alias("id"), (c * x - s * y + 0.5 + (2 * u[3] - 1) * shift).alias("x"), (s * x + c * y + 0.5 + (2 * u[4] - 1) * shift).alias("y"))

    hand = F.when(~flipped, F.col("handedness")).when(F.col("handedness") == "Left", "Right").when(F.col("handedness") == "Right", "Left").otherwise(F.col("handedness"))
    return rows.withColumn("flipped", flipped).withColumn("points", F.transform("points", move)).withColumn("handedness", hand)


def confirmed_negative(present: Column, action: Column, decision: Column, *evidence: Column) -> Column:
    """Whether review confirms a negative: by action and decision, and with every piece of evidence (reviewer, time, method, digest) filled."""
    filled = reduce(lambda a, b: a & b, (F.trim(F.coalesce(e.cast("string"), F.lit(""))) != "" for e in evidence), F.lit(True))
    agreed = (action == "INCLUDE_CONFIRMED_NEGATIVE") & (decision == "CONFIRMED_NEGATIVE")
    return ~F.coalesce(present, F.lit(False)) & F.coalesce(agreed, F.lit(False)) & filled


def decision_rows(rows: DataFrame, overlap_from: int = 3) -> DataFrame:
    """Rows with action and reasons. Rows: present, sample_type, reasons (positive_reasons), overlap (joins.negative_overlap), decision (of a
    review) and held_out (quotas.group_holdout); missing columns are null.

    Positives without reasons are included, or evaluate the teacher where their dataset is held out; others are quarantined.
    A negative is included where a review confirms it and nothing speaks against it; else it is held, or excluded with its
    held-out dataset. Fixed values: actions and codes.
    """
    column = lambda c, kind: F.col(c) if c in rows.columns else F.lit(None).cast(kind)
    present, out = F.coalesce("present", F.lit(False)), F.coalesce(column("held_out", "boolean"), F.lit(False))
    own = F.when(present, F.coalesce(column("reasons", "array<string>"), F.array())).otherwise(F.array().cast("array<string>"))
    said, typed = column("decision", "string"), F.coalesce(column("sample_type", "string").isin(*SAMPLE_TYPES[2:]), F.lit(False))
    against = F.array_compact(F.array(F.when(~typed, "INVALID_NEGATIVE_SAMPLE_TYPE"), F.when(typed & (F.coalesce(column("overlap", "int"), F.lit(0)) >= overlap_from), "NEGATIVE_OVERLAPS_CONFIRMED_HAND")))
    confirmed = F.coalesce(said == "CONFIRMED_NEGATIVE", F.lit(False))
    answer = F.when(confirmed, "REVIEW_CONFLICTS_CONFIRMED_HAND_OVERLAP").when(said == "FALSE_NEGATIVE_HAND_VISIBLE", "HUMAN_CONFIRMED_FALSE_NEGATIVE").when(said == "HOLD", "HUMAN_REQUESTED_HOLD").otherwise("UNVERIFIED_TEACHER_NEGATIVE")
    good = confirmed & (F.size(against) == 0)
    negative = F.when(good, F.array(F.lit("HUMAN_CONFIRMED_NEGATIVE"))).otherwise(F.concat(against, F.array(answer)))
    clean = F.size(own) == 0
    action = F.when(out & present & clean, "HOLDOUT_TEACHER_EVAL").when(out & present, "QUARANTINE_HOLDOUT_POSITIVE").when(out, "EXCLUDE_HOLDOUT_DATASET")
    action = action.when(present & clean, "INCLUDE_LANDMARKS").when(present, "QUARANTINE_POSITIVE").when(good, "INCLUDE_CONFIRMED_NEGATIVE").otherwise("HOLD_NEGATIVE_CANDIDATE")
    reasons = F.when(out, F.concat(F.array(F.lit("AUTOMATIC_TEACHER_HOLDOUT")), own)).when(present, own).otherwise(negative)
    return rows.withColumns({"action": action, "reasons": reasons})


def gold_row_errors(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Gold rows with errors against their source's descriptor and review: rows have presence_decision, handedness_decision,
    source_sha256 and task_sha256 beside the canonical columns; sources: dataset_id, sha256, source_kind."""
    known = sources.select("dataset_id", F.col("sha256").alias("_sha"), F.col("source_kind").alias("_kind"), F.lit(True).alias("_known"))
    joined = head_weights(rows.join(known, "dataset_id", "left"))
    present, hand = F.coalesce("present", F.lit(False)), F.lower("handedness")
    sided = F.coalesce(hand.isin("left", "right"), F.lit(False))
    checks = {
        "unknown_source": F.col("_known").isNull(),
        "not_gold": ~(F.col("supervision_tier").eqNullSafe(F.lit("gold")) & F.col("annotation_provenance").eqNullSafe(F.lit("human_gold"))),
        "presence_not_decided": ~F.col("presence_decision").eqNullSafe(F.when(present, "hand").otherwise("no_hand")),
        "handedness_not_decided": ~F.lower("handedness_decision").eqNullSafe(hand),
        "source_digest_differs": F.col("_known") & ~F.col("source_sha256").eqNullSafe(F.col("_sha")),
        "task_digest_missing": (F.coalesce("_kind", F.lit("")) != "external_gold") & (F.coalesce("task_sha256", F.lit("")) == ""),
        "presence_without_weight": F.col("presence_weight") <= 0,
        "positive_without_landmark_weight": present & (F.col("landmark_weight") <= 0),
        "known_hand_without_weight": present & sided & (F.col("handedness_weight") <= 0),
        "bad_sample_type": ~F.coalesce(F.col("sample_type").isin(*SAMPLE_TYPES), F.lit(False)),
        "bucket_differs": ~F.col("sampling_bucket").eqNullSafe(F.concat(F.lit("gold:"), F.col("sample_type"))),
    }
    return joined.withColumn("errors", codes(checks)).drop("_sha", "_kind", "_known", "presence_weight", "landmark_weight", "handedness_weight")


def decode_landmark_vectors(rows: DataFrame, vector: str = "vector", flag: str = "hand_flag", handedness: str = "handedness_score") -> DataFrame:
    """Flat 42-number outputs as points, with errors: wrong length or values not finite, scores outside [0, 1]."""
    pts = P.decode_vector(F.col(vector))
    outside = lambda c: ~F.coalesce(F.col(c).between(0.0, 1.0), F.lit(False)) | F.isnan(c)
    return rows.withColumn("predicted", pts).withColumn("errors", codes({"bad_vector": pts.isNull(), "bad_flag": outside(flag), "bad_handedness": outside(handedness)}))


def review_request(rows: DataFrame, role: str, fields: list[str], evidence: list[str], id_col: str = "roi_id", salt: str = "review") -> tuple[DataFrame, DataFrame]:
    """Rows in the export form (id, role, fields, evidence struct, tie_break digest), and (id, missing) of rows that lack a field."""
    missing = F.array_compact(F.array(*(F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), F.lit(c)) for c in fields)))
    held = rows.withColumn("_missing", missing)
    names = [c for c in dict.fromkeys([id_col, *fields]) if c in rows.columns]
    good = held.where(F.size("_missing") == 0).select(*names, F.lit(role).alias("role"), F.struct(*evidence).alias("evidence"), salted_digest(salt, F.col(id_col)).alias("tie_break"))
    return good, held.where(F.size("_missing") > 0).select(id_col, F.col("_missing").alias("missing"))
