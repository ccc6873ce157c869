"""Registered queries on rows of snapshots: contracts, canonical rows, registry, review, leakage and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import points as P
from ..functions import text as X
from ..operators import contracts, joins, sets
from . import adapters as A
from .registry import query, rounded

_PLANT_EVERY = 61
#: Violations put into canonical rows: column, expression, which rows (all, positives, negatives), and the codes they must give.
PLANTS = (
    ("global_crop_id", "''", "true", ["missing_global_crop_id"]),
    ("crop_id", "'other'", "true", ["crop_id_differs"]),
    ("dataset_id", "null", "true", ["missing_dataset_id"]),
    ("source_crop_id", "''", "true", ["missing_source_crop_id"]),
    ("source_group_id", "null", "true", ["missing_source_group_id"]),
    ("crop_path", "''", "true", ["missing_crop_path"]),
    ("width", "255", "true", ["wrong_size"]),
    ("schema_version", "'old'", "true", ["wrong_schema_version"]),
    ("training_stage", "'other'", "true", ["wrong_stage"]),
    ("selection_action", "'hold'", "true", ["not_included"]),
    ("supervision_tier", "'silver'", "true", ["bad_supervision_tier"]),
    ("annotation_provenance", "'nobody'", "true", ["provenance_conflicts"]),
    ("quality_tier", "'LOW'", "true", ["bad_quality_tier"]),
    ("quality_flags", "null", "true", ["missing_quality_flags"]),
    ("sampling_bucket", "''", "true", ["missing_sampling_bucket"]),
    ("sample_type", "'POS'", "true", ["bad_sample_type"]),
    ("palm_valid", "not palm_valid", "true", ["wrong_sample_type"]),
    ("palm_valid", "null", "true", ["missing_palm_valid"]),
    ("ignore_for_training", "true", "true", ["ignored_row"]),
    ("present", "null", "not present", ["missing_presence"]),
    ("handedness", "'both'", "present", ["bad_handedness"]),
    ("handedness", "'Left'", "not present", ["negative_with_hand"]),
    ("label_score", "double('nan')", "present", ["bad_handedness_score"]),
    ("palm_score", "double('inf')", "true", ["bad_palm_score"]),
    ("points", "slice(points, 1, 20)", "present", ["points_not_21"]),
    ("points_px", "transform(points_px, p -> named_struct('id', p.id div 2, 'x', p.x, 'y', p.y))", "present", ["points_px_bad_ids"]),
    ("points_image", "transform(points_image, p -> named_struct('id', p.id, 'x', double('nan'), 'y', p.y))", "present", ["points_image_not_finite"]),
    ("points_px", "transform(points_px, p -> named_struct('id', p.id, 'x', p.x + 1, 'y', p.y))", "present", ["points_px_disagree"]),
    ("points", "array(named_struct('id', 0, 'x', 0D, 'y', 0D))", "not present", ["points_on_negative"]),
    ("hand_id", "'h'", "not present", ["negative_with_hand_id"]),
    ("rect", "named_struct('x_center', double('inf'), 'y_center', 0D, 'width', 1D, 'height', 1D, 'rotation_rad', 0D)", "true", ["bad_rect"]),
    ("rect", "named_struct('x_center', 0D, 'y_center', 0D, 'width', 0D, 'height', 1D, 'rotation_rad', 0D)", "true", ["rect_without_area"]),
    ("corners", "slice(corners, 1, 3)", "true", ["bad_corners"]),
    ("capture_source_id", "'x'", "true", ["bad_capture_id"]),
    ("split", "'other'", "true", ["capture_split_differs"]),
    ("hand_presence_loss_weight", "null", "true", ["bad_hand_presence_loss_weight"]),
    ("landmark_loss_weight", "0.5D", "true", ["landmark_loss_weight_not_a_mask"]),
    ("handedness_loss_weight", "-1D", "true", ["bad_handedness_loss_weight", "handedness_loss_weight_not_a_mask"]),
    ("supervision_loss_weight", "-1D", "true", ["bad_supervision_loss_weight"]),
    ("presence_quality_weight", "double('nan')", "true", ["bad_presence_quality_weight"]),
    ("landmark_quality_weight", "-1D", "true", ["bad_landmark_quality_weight"]),
    ("handedness_quality_weight", "null", "true", ["bad_handedness_quality_weight"]),
    ("sampling_weight", "double('inf')", "true", ["bad_sampling_weight"]),
)


def _planted(rows: DataFrame) -> DataFrame:
    values = {}
    for k, (column, value, where, _) in enumerate(PLANTS):
        own = F.expr(value).cast(rows.schema[column].dataType.simpleString())  # by name: planted fields may be nullable
        values[column] = F.when((F.col("v") % _PLANT_EVERY == k) & F.expr(where), own).otherwise(values.get(column, F.col(column)))
    return rows.withColumns(values)


@query(f"""{A.with_sql('labels', 'published')}, found as (select roi_id, unnest(case v % {_PLANT_EVERY} {' '.join(f"when {k} then case when {where} then {codes} else [] end" for k, (_, _, where, codes) in enumerate(PLANTS))} else [] end) as error from published)
select roi_id, error from found""")
def row_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical training rows into which one violation of each code was put."""
    rows = _planted(contracts.canonicalize(A.published(spark, sf_dir), "geometry"))
    return contracts.violations(contracts.row_errors(rows, "geometry"))


@query(f"""{A.with_sql('labels', 'published')}, found as (select roi_id, unnest(list_filter([case when split <> 'val' then 'wrong_split' end, case when v % 7 = 3 then 'invalid_ground_truth' end, case when v % 7 = 5 then 'palm_not_valid' end], lambda x: x is not null)) as error from published)
select roi_id, error from found""")
def eval_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contracts.canonicalize(A.published(spark, sf_dir), None)
    rows = rows.withColumns({"ground_truth_valid": F.col("v") % 7 != 3, "palm_valid": F.col("v") % 7 != 5})
    return contracts.violations(contracts.eval_row_errors(rows, "val"))


_TYPE_SQL = "case when present then case when palm_valid then 'POS_RUNTIME' else 'POS_LOW_PALM' end when palm_valid then 'NEG_RUNTIME_CANDIDATE' else 'NEG_LOW_PALM_CANDIDATE' end"


@query(f"""{A.with_sql('labels', 'published')}, t as (select *, {_TYPE_SQL} as sample_type from published)
select roi_id as global_crop_id, capture_source_id as source_group_id, sample_type, 'pseudo:' || sample_type as sampling_bucket, case when label_origin = 'mediapipe' then 'mediapipe_pseudo' else 'human_gold' end as annotation_provenance,
  palm_valid, handedness, present::int::double as landmark_loss_weight, split_part(capture_source_id, '-', 7) as performer, coalesce(len(points), 0)::integer as n_points,
  len(list_filter(coalesce(points, []), lambda p: p.x < 0 or p.x > 1)) + len(list_filter(coalesce(points, []), lambda p: p.y < 0 or p.y > 1)) as n_outside from t""")
def canonical_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contracts.canonicalize(contracts.drop_internal(A.published(spark, sf_dir).withColumn("_row", F.lit(1))), "multitask")
    names = ("global_crop_id", "source_group_id", "sample_type", "sampling_bucket", "annotation_provenance", "palm_valid", "handedness", "landmark_loss_weight")
    n = F.coalesce(F.size("points"), F.lit(0))
    return rows.select(*names, F.col("capture.performer").alias("performer"), n.alias("n_points"), F.coalesce(P.out_of_range(F.col("points")), F.lit(0)).cast("long").alias("n_outside"))


def _reasoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contracts.canonicalize(A.published(spark, sf_dir), "geometry")
    v = F.col("v")
    rows = rows.withColumns({"needs_review": v % 13 == 1, "crop_found": v % 17 != 2, "quality_tier": F.when(v % 19 == 3, "LOW").otherwise("HIGH"), "points": F.when(v % 23 == 4, F.slice("points", 1, 5)).otherwise(F.col("points"))})
    return contracts.positive_reasons(rows.where("present"), ("HIGH", "MEDIUM"))


_REASONS_SQL = """list_filter([case when v % 19 = 3 then 'DISALLOWED_QUALITY_TIER' end, case when v % 23 = 4 then 'INVALID_LANDMARKS' end,
  case when v % 23 <> 4 and len(list_filter(points, lambda p: p.x < -0.05 or p.x > 1.05 or p.y < -0.05 or p.y > 1.05)) > 0 then 'LANDMARK_OUT_OF_ALLOWED_RANGE' end,
  case when v % 17 = 2 then 'MISSING_CROP_IMAGE' end, case when v % 13 = 1 then 'SOURCE_MARKED_NEEDS_REVIEW' end], lambda x: x is not null)"""


@query(f"""{A.with_sql('labels', 'published')}, r as (select roi_id, unnest({_REASONS_SQL}) as reason from published where present) select reason, count(*) as n from r group by 1""")
def positive_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.reason_counts(_reasoned(spark, sf_dir))


@query(f"""{A.with_sql('labels', 'published')}, r as (select *, case when present then {_REASONS_SQL} else [] end as own, v % 8 as overlap, case v % 5 when 0 then 'CONFIRMED_NEGATIVE' when 1 then 'HOLD' when 2 then 'FALSE_NEGATIVE_HAND_VISIBLE' end as decision, dataset_id = 'ds-3' as held_out from published),
d as (select *, case when held_out and present and len(own) = 0 then 'HOLDOUT_TEACHER_EVAL' when held_out and present then 'QUARANTINE_HOLDOUT_POSITIVE' when held_out then 'EXCLUDE_HOLDOUT_DATASET' when present and len(own) = 0 then 'INCLUDE_LANDMARKS' when present then 'QUARANTINE_POSITIVE'
  when decision = 'CONFIRMED_NEGATIVE' and overlap < 3 then 'INCLUDE_CONFIRMED_NEGATIVE' else 'HOLD_NEGATIVE_CANDIDATE' end as action from r)
select roi_id, action, array_to_string(case when held_out then list_concat(['AUTOMATIC_TEACHER_HOLDOUT'], own) when present then own when decision = 'CONFIRMED_NEGATIVE' and overlap < 3 then ['HUMAN_CONFIRMED_NEGATIVE']
  else list_concat(case when overlap >= 3 then ['NEGATIVE_OVERLAPS_CONFIRMED_HAND'] else [] end, [case when decision = 'CONFIRMED_NEGATIVE' then 'REVIEW_CONFLICTS_CONFIRMED_HAND_OVERLAP' when decision = 'FALSE_NEGATIVE_HAND_VISIBLE' then 'HUMAN_CONFIRMED_FALSE_NEGATIVE' when decision = 'HOLD' then 'HUMAN_REQUESTED_HOLD' else 'UNVERIFIED_TEACHER_NEGATIVE' end]) end, ',') as reasons from d""")
def curation_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contracts.canonicalize(A.published(spark, sf_dir), "geometry").select("roi_id", "present", "sample_type", "dataset_id", "v")
    rows = rows.join(_reasoned(spark, sf_dir).select("roi_id", "reasons"), "roi_id", "left")
    v = F.col("v")
    decision = F.when(v % 5 == 0, "CONFIRMED_NEGATIVE").when(v % 5 == 1, "HOLD").when(v % 5 == 2, "FALSE_NEGATIVE_HAND_VISIBLE")
    rows = rows.withColumns({"overlap": (v % 8).cast("int"), "decision": decision, "held_out": F.col("dataset_id") == "ds-3"})
    return contracts.decision_rows(rows).select("roi_id", "action", F.array_join("reasons", ",").alias("reasons"))


@query(f"""{A.with_sql('labels', 'published')}, w as (select *, case when v % 2 = 0 then 2.0 else 0.5 end * (1 + v % 3)::double as tier_part, handedness in ('Left', 'Right') as sided from published)
select roi_id, tier_part as presence_weight, case when present then tier_part * (v % 4)::double else 0 end as landmark_weight, case when present and sided then tier_part else 0.0 end as handedness_weight from w""")
def head_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contracts.canonicalize(A.published(spark, sf_dir), "geometry")
    v = F.col("v")
    rows = rows.withColumns({"supervision_tier": F.when(v % 2 == 0, "gold").otherwise("pseudo"), "supervision_loss_weight": (1 + v % 3).cast("double"), "landmark_quality_weight": (v % 4).cast("double")})
    return contracts.head_weights(rows, {"gold": 2.0, "pseudo": 0.5}).select("roi_id", "presence_weight", "landmark_weight", "handedness_weight")


@query(f"""{A.with_sql('labels', 'published')}, g as (select *, {_TYPE_SQL} as sample_type from published),
e as (select roi_id, unnest(list_filter([case when dataset_id = 'ds-3' then 'unknown_source' end, case when v % 29 = 0 then 'not_gold' end, case when present <> (v % 5 <> 1) then 'presence_not_decided' end, case when v % 11 = 3 then 'handedness_not_decided' end,
  case when dataset_id <> 'ds-3' and v % 13 = 4 then 'source_digest_differs' end, case when dataset_id <> 'ds-1' and v % 7 = 5 then 'task_digest_missing' end, case when v % 31 = 6 then 'bucket_differs' end], lambda x: x is not null)) as error from g)
select roi_id, error from e""")
def gold_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contracts.canonicalize(A.published(spark, sf_dir), "geometry", "hard")
    v = F.col("v")
    rows = rows.withColumns({
        "annotation_provenance": F.when(v % 29 == 0, "mediapipe_pseudo").otherwise(F.col("annotation_provenance")),
        "presence_decision": F.when(v % 5 != 1, "hand").otherwise("no_hand"),
        "handedness_decision": F.when(v % 11 == 3, "other").otherwise(F.upper("handedness")),
        "source_sha256": F.when(v % 13 == 4, "old").otherwise(F.concat(F.lit("sha-"), "dataset_id")),
        "task_sha256": F.when(v % 7 == 5, "").otherwise("t"),
        "sampling_bucket": F.when(v % 31 == 6, "pseudo:x").otherwise(F.col("sampling_bucket")),
    })
    sources = rows.select("dataset_id").distinct().where("dataset_id <> 'ds-3'").select("dataset_id", F.concat(F.lit("sha-"), "dataset_id").alias("sha256"), F.when(F.col("dataset_id") == "ds-1", "external_gold").otherwise("reviewed").alias("source_kind"))
    return contracts.violations(contracts.gold_row_errors(rows, sources))


@query(f"""{A.with_sql('labels', 'published')} select roi_id, (case v % 3 when 0 then 255 when 1 then 256 end)::integer as scale from published where present""")
def pixel_scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which pixel scale explains the pixel points: every third row has 255, 256, or none."""
    rows = A.published(spark, sf_dir).where("present")
    factor = F.when(F.col("v") % 3 == 0, 255.0).when(F.col("v") % 3 == 1, 256.0).otherwise(300.0)
    px = F.transform("points", lambda p: F.struct(p["id"].alias("id"), (p["x"] * factor + 0.01).alias("x"), (p["y"] * factor - 0.01).alias("y")))
    return rows.select("roi_id", P.pixel_convention(F.col("points"), px)["scale"].alias("scale"))


@query(f"""{A.with_sql('strata')} select id, case when id % 3 > 0 then 'crop-' || id when id % 2 = 0 then source_sequence_id else '' end as identity,
  array_to_string(list_filter(['parent:' || lower('CROP-' || id), case when id % 2 = 0 then 'source_image:' || dataset_id || ':' || source_sequence_id end, case when id % 5 = 0 then 'native:root-a:' || id end], lambda x: x is not null), ',') as tokens,
  array_to_string(list_filter(['global_crop_lineage:CROP-' || id, case when id % 2 = 0 then 'roi_image_sha256:' || sha256(id::varchar) end, 'session_id:' || status], lambda x: x is not null), ',') as lineage from strata""")
def identity_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identities and tokens of rows some of whose ids are missing or empty."""
    i = F.col("id")
    rows = A.strata_rows(spark, sf_dir).select(
        "id", "dataset_id", F.concat(F.lit("CROP-"), i).alias("global_crop_id"), F.when(i % 3 > 0, F.concat(F.lit("crop-"), i)).otherwise("").alias("own_id"), F.when(i % 2 == 0, F.col("source_sequence_id")).alias("image"),
        F.when(i % 5 == 0, i.cast("string")).alias("native_source_crop_id"), F.lit(" Root-A ").alias("native_source_root"), F.when(i % 2 == 0, F.sha2(i.cast("string"), 256)).alias("crop_image_sha256"), F.col("status").alias("session_id"),
    )
    tokens = F.filter(X.identity_tokens(rows.columns), lambda t: ~t.startswith("roi_sha256"))
    return rows.select("id", contracts.identity("own_id", "image").alias("identity"), F.array_join(tokens, ",").alias("tokens"), F.array_join(X.lineage_tokens(rows.columns, groups=True), ",").alias("lineage"))


@query(f"""{A.with_sql('boxes')} select image, box_id from boxes where box_id % 11 > 2 and score >= 0.5""")
def score_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = F.when(F.col("box_id") % 11 == 0, float("nan")).when(F.col("box_id") % 11 == 1, float("inf")).when(F.col("box_id") % 11 > 2, F.col("score"))
    return contracts.score_filter(A.boxes(spark, sf_dir).withColumn("score", bad), 0.5).select("image", "box_id")


_U = "('0x' || substr(sha256('5' || chr(31) || roi_id || chr(31) || '{}'), 1, 12))::bigint / 281474976710656.0"


@query(f"""{A.with_sql('labels', 'published')}, u as (select roi_id, points, handedness, {', '.join(f'{_U.format(k)} as u{k}' for k in range(5))} from published where present),
m as (select *, radians((2 * u1 - 1) * 15) as a, 1 + (2 * u2 - 1) * 0.1 as s, u0 < 0.5 as flipped from u),
p as (select roi_id, handedness, flipped, a, s, u3, u4, i, case when flipped then 0.5 - points[i].x else points[i].x - 0.5 end as x, points[i].y - 0.5 as y from m, range(1, 22) t(i))
select roi_id, case when not flipped or handedness = 'unknown' then handedness when handedness = 'Left' then 'Right' else 'Left' end as handedness, round(sum(cos(a) * s * x - sin(a) * s * y + 0.5 + (2 * u3 - 1) * 0.05), 6) as sum_x, round(sum(sin(a) * s * x + cos(a) * s * y + 0.5 + (2 * u4 - 1) * 0.05), 6) as sum_y from p group by 1, 2""")
def augmented_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contracts.augment_points(A.published(spark, sf_dir).where("present"), 5)
    total = lambda c: F.aggregate("points", F.lit(0.0), lambda s, p: s + p[c])
    return rounded(rows.select("roi_id", "handedness", total("x").alias("sum_x"), total("y").alias("sum_y")))


@query(f"""{A.with_sql('labels', 'published')}, c as (select *, {_TYPE_SQL} as kind, case when present then v % 23 <> 0 else v % 31 <> 0 and v % 29 <> 0 end as included, v % 7 <> 1 and v % 37 <> 0 as whole from published),
n as (select count(*) filter (present) as positives, count(*) filter (not present and included and whole) as confirmed, count(*) filter (not included or (not present and not whole)) as wrong, count(*) filter (not present and included and whole and kind = 'NEG_RUNTIME_CANDIDATE') as runtime, count(*) filter (not present and included and whole and kind = 'NEG_LOW_PALM_CANDIDATE') as low from c)
select "check", n, minimum, case when minimum is null then n = 0 else n >= minimum end as passed from n, lateral (values ('has_positive_geometry', positives, 1), ('minimum_confirmed_negatives', confirmed, 12), ('minimum_confirmed:NEG_RUNTIME_CANDIDATE', runtime, 10), ('minimum_confirmed:NEG_LOW_PALM_CANDIDATE', low, 1000000), ('no_unreviewed_negative', wrong, null), ('authenticated_negative_review_transaction', 1, 1)) t("check", n, minimum)""")
def negative_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate of a multitask snapshot: rows that aren't included or reviewed as they must be, and minimums of confirmed negatives."""
    v = F.col("v")
    rows = contracts.canonicalize(A.published(spark, sf_dir), "multitask")
    rows = rows.withColumns({
        "action": F.when(F.col("present"), F.when(v % 23 != 0, "INCLUDE_LANDMARKS").otherwise("HOLD")).otherwise(F.when(v % 31 != 0, "INCLUDE_CONFIRMED_NEGATIVE")),
        "negative_evidence": F.lit("human_confirmed"), "decision": F.when(v % 29 != 0, "CONFIRMED_NEGATIVE").otherwise("HOLD"),
        "reviewer": F.when(v % 7 == 1, " ").otherwise("me"), "review_method": F.when(v % 37 == 0, "glance").otherwise("visual"),
    })
    return joins.negative_gate(rows, 12, {"NEG_RUNTIME_CANDIDATE": 10, "NEG_LOW_PALM_CANDIDATE": 1_000_000}, True, ("reviewer",), "visual")


@query("""with e as (select vec_id as v, embedding as e from embeddings), p as (select v, unnest(list_filter([case when v % 9 = 4 then 'bad_flag' end, case when v % 9 = 7 then 'bad_handedness' end, case when v % 10 < 2 then 'bad_vector' end], lambda x: x is not null)) as error from e)
select v, error from p""")
def decoded_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat model outputs as points; some are too short, not finite, or have scores outside [0, 1]."""
    v, e = F.col("v"), F.transform(F.slice("embedding", 1, 42), lambda x: x.cast("double"))
    rows = A.table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "v")
    rows = rows.withColumn("vector", F.when(v % 10 == 0, F.slice(e, 1, 41)).when(v % 10 == 1, F.transform(e, lambda x, i: F.when(i == 3, float("inf")).otherwise(x))).otherwise(e))
    rows = rows.withColumns({"hand_flag": F.when(v % 9 == 4, 1.5).otherwise(0.5), "handedness_score": F.when(v % 9 == 7, float("nan")).otherwise(0.5)})
    return contracts.violations(contracts.decode_landmark_vectors(rows), "v")


@query(f"""{A.with_sql('strata')}, a as (select id, case when dataset_id in ('ds-5', 'ds-6') then 'source_disabled' when id % 6 = 1 then 'ignored' else 'included' end as action from strata) select action, count(*) as n, min(id) as first from a group by 1""")
def routed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.strata_rows(spark, sf_dir).withColumn("ignore", F.col("id") % 6 == 1)
    sources = rows.select("dataset_id").distinct().where("dataset_id <> 'ds-6'").withColumn("active", F.col("dataset_id") != "ds-5")
    return joins.route_rows(rows, sources).groupBy("action").agg(F.count("*").alias("n"), F.min("id").alias("first"))


@query(f"""{A.with_sql('labels', 'published')}, e as (select *, case when v % 5 = 2 then '' else handedness end as hand, case when v % 7 = 3 then null else dataset_id end as ds from published)
select roi_id, ds as dataset_id, hand as handedness, 'check' as role, raw_image_id as evidence, sha256('review' || chr(31) || roi_id) as tie_break, null as missing from e where hand <> '' and ds is not null
union all select roi_id, null, null, null, null, null, array_to_string(list_filter([case when ds is null then 'dataset_id' end, case when hand = '' then 'handedness' end], lambda x: x is not null), ',') from e where hand = '' or ds is null""")
def review_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("v")
    rows = A.published(spark, sf_dir).withColumns({"handedness": F.when(v % 5 == 2, "").otherwise(F.col("handedness")), "dataset_id": F.when(v % 7 != 3, F.col("dataset_id"))})
    sent, lacking = contracts.review_request(rows, "check", ["dataset_id", "handedness"], ["raw_image_id"])
    sent = sent.withColumn("evidence", F.col("evidence.raw_image_id"))
    return sets.union_all(sent, lacking.withColumn("missing", F.array_join("missing", ",")))


@query(f"""{A.with_sql('labels', 'published')} select category, count(*) as n from (select case when v % 3 = 0 then case when present then 'gold_positive' else 'gold_negative' end when v % 3 = 1 then case when present then 'pseudo_positive' when palm_valid then 'pseudo_neg_runtime' else 'pseudo_neg_low' end end as category from published) group by 1""")
def smoke_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contracts.canonicalize(A.published(spark, sf_dir), "geometry")
    tier = F.when(F.col("v") % 3 == 0, "GOLD").when(F.col("v") % 3 == 1, "pseudo").otherwise("silver")
    return contracts.smoke_category(rows.withColumn("supervision_tier", tier)).groupBy("category").agg(F.count("*").alias("n"))


# registry, coverage, leakage

def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rois table: without every eleventh ROI, with another image for every thirteenth."""
    v = F.col("v")
    image = F.when(v % 13 == 1, "other").otherwise(F.col("raw_image_id"))
    return A.published(spark, sf_dir).where("v % 11 <> 0").select("roi_id", image.alias("raw_image_id"), "capture_source_id", "proposal_variant", F.concat(F.lit("store/"), v).alias("crop_relpath"))


@query(f"""{A.with_sql('labels', 'published')} select roi_id, case when v % 11 = 0 then 'unregistered' else 'different' end as problem from published where v % 11 = 0 or v % 13 = 1""")
def registry_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.registry_mismatch(A.published(spark, sf_dir), _registry(spark, sf_dir), "roi_id", ["raw_image_id", "capture_source_id", "proposal_variant"])


@query(f"""{A.with_sql('labels', 'published')} select roi_id, case when v % 11 <> 0 and v % 13 <> 1 then 'store/' || v end as crop_relpath, v % 11 <> 0 and v % 13 <> 1 as restored from published""")
def restored_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = joins.restore_provenance(A.published(spark, sf_dir).select("roi_id", "raw_image_id"), _registry(spark, sf_dir), "roi_id", ["crop_relpath"], ["raw_image_id"])
    return sets.union_all(good.select("roi_id", "crop_relpath", F.lit(True).alias("restored")), bad.select("roi_id", F.lit(False).alias("restored")))


@query(f"""{A.with_sql('assets')} select id, sample_type, id % 3 = 0 as known from assets where id % 2 = 0""")
def catalog_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence (even ids) with the rows of a catalog (ids that 3 divides), and the evidence that it lacks."""
    assets = A.asset_rows(spark, sf_dir)
    found, orphans = joins.catalog_lookup(assets.where("id % 2 = 0").select("id", "sample_type"), assets.where("id % 3 = 0").select("id", "digest"), "id")
    return found.select("id", "sample_type", F.lit(True).alias("known")).union(orphans.select("id", "sample_type", F.lit(False)))


def _tokens():
    return F.array(F.concat(F.lit("d:"), "digest"), F.concat(F.lit("p:"), F.floor(F.col("id") / 3)))


_TOKENS_SQL = "['d:' || digest, 'p:' || id // 3]"


@query(f"""{A.with_sql('assets')}, t as (select id, split, unnest({_TOKENS_SQL}) as token from assets), e as (select distinct token from t where split <> 'train')
select id, 'leaks' as kind, min(token) as token from t join e using (token) where split = 'train' group by 1
union all select id, 'free', null from assets where split = 'train' and id not in (select id from t join e using (token) where split = 'train')
union all select null, 'conflict', token from t group by token having count(distinct id) > 1""")
def token_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training assets that share a token with others, those that share none, and tokens of several assets."""
    assets = A.asset_rows(spark, sf_dir).withColumn("tokens", _tokens())
    train, rest = assets.where("split = 'train'"), assets.where("split <> 'train'")
    leaks = joins.check_leakage(train, rest, "id").withColumn("kind", F.lit("leaks"))
    free = joins.exclude_occupied(train, sets.all_tokens(rest.select(F.explode("tokens").alias("token"))), "id").select("id", F.lit("free").alias("kind"))
    conflicts = joins.token_conflicts(assets, "id").select("token", F.lit("conflict").alias("kind"))
    return sets.union_all(leaks, free, conflicts)


@query(f"""{A.with_sql('assets')} select "group", count(*) as n_rows, count(distinct t) as n_tokens from (select "group", id, unnest({_TOKENS_SQL}) as t from assets) join (select "group" as g, count(*) as c from assets group by 1) on g = "group" group by 1""".replace("count(*) as n_rows", "any_value(c) as n_rows"))
def identity_occupancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.identity_occupancy(A.asset_rows(spark, sf_dir).withColumn("tokens", _tokens()), "group")


_PARTS_SQL = """c as (select id, digest, "group", case when id % 10 <> 3 then sample_type end as sample_type from assets), ch as (select id, case when id % 10 = 4 then 'x' else digest end as digest, case when id % 10 <> 3 then "group" end as "group", case when id % 10 = 3 then "group" else sample_type end as sample_type from c),
i as (select * from ch where id % 10 < 5 union all select -id - 1, digest, "group", sample_type from ch where id % 97 = 0 union all select * from ch where id % 211 = 2), e as (select * from ch where id % 10 between 5 and 8 or id % 10 = 1)"""


@query(f"""{A.with_sql('assets')}, {_PARTS_SQL}, k as (select id, (select count(*) from c where c.id = u.id) as n_c, (select count(*) from i where i.id = u.id) as n_i, (select count(*) from e where e.id = u.id) as n_e from (select id from c union select id from i union select id from e) u),
d as (select p.id from (select * from i union all select * from e) p join c using (id) where p.digest is distinct from c.digest or p."group" is distinct from c."group" or p.sample_type is distinct from c.sample_type),
q as (select id, case when greatest(n_c, n_i, n_e) > 1 then 'repeated' when n_i > 0 and n_e > 0 then 'in_both' when n_c > 0 and n_i + n_e = 0 then 'in_none' when n_c = 0 then 'not_in_catalog' when id in (select id from d) then 'different' end as problem from k) select id, problem from q where problem is not null""")
def partition_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog against its included and excluded parts: ids in both, in none, repeated, unknown, changed, or with a value in another column."""
    i = F.col("id")
    catalog = A.asset_rows(spark, sf_dir).select("id", "digest", "group", F.when(i % 10 != 3, F.col("sample_type")).alias("sample_type"))
    moved = {"digest": F.when(i % 10 == 4, "x").otherwise(F.col("digest")), "group": F.when(i % 10 != 3, F.col("group")), "sample_type": F.when(i % 10 == 3, F.col("group")).otherwise(F.col("sample_type"))}
    changed = catalog.withColumns(moved)
    included = changed.where("id % 10 < 5").union(changed.where("id % 97 = 0").withColumn("id", -i - 1)).union(changed.where("id % 211 = 2"))
    return joins.partition_check(catalog, included, changed.where("id % 10 between 5 and 8 or id % 10 = 1"), "id")


_LEAVES_SQL = """select id, unnest([{{'c': 'meta.type', 'v': to_json({type})::varchar}}, {{'c': 'meta.where.group', 'v': to_json("group")::varchar}}, {{'c': 'tags.lang', 'v': to_json(sample_type)::varchar}}, {{'c': 'path', 'v': to_json(['a', {last}])::varchar}}{more}]) as e"""


@query(f"""{A.with_sql('assets')}, l as ({_LEAVES_SQL.format(type='sample_type', last="split", more=", {'c': 'note', 'v': to_json(digest)::varchar}")} from assets),
r as ({_LEAVES_SQL.format(type="case when id % 7 <> 0 then sample_type end", last="case when id % 5 = 0 then 'b' else split end", more=", {'c': case when id % 4 = 0 then 'tags.split' else 'tags.' || split end, 'v': to_json(id::varchar)::varchar}")} from assets where id % 3 > 0)
select coalesce(l.id, r.id) as id, coalesce(l.e.c, r.e.c) as "column", coalesce(l.e.v, case when l.id is null then '<missing>' else 'null' end) as left_value, coalesce(r.e.v, case when r.id is null then '<missing>' else 'null' end) as right_value
from l full outer join r on l.id = r.id and l.e.c = r.e.c where l.id is null or r.id is null or l.e.v is distinct from r.e.v""")
def row_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A derived table against the full one, leaf by leaf: nested values, keys of maps and columns that one side lacks, missing rows."""
    i = F.col("id")

    def made(rows: DataFrame, kind, last, *tags) -> DataFrame:
        meta = F.struct(kind.alias("type"), F.struct("group").alias("where")).alias("meta")
        return rows.select("id", meta, F.create_map(F.lit("lang"), F.col("sample_type"), *tags).alias("tags"), F.array(F.lit("a"), last).alias("path"), "digest")

    assets = A.asset_rows(spark, sf_dir)
    left = made(assets, F.col("sample_type"), F.col("split")).withColumnRenamed("digest", "note")
    derived = assets.where("id % 3 > 0")
    right = made(derived, F.when(i % 7 != 0, F.col("sample_type")), F.when(i % 5 == 0, "b").otherwise(F.col("split")), F.when(i % 4 == 0, "split").otherwise(F.col("split")), i.cast("string")).drop("digest")
    return joins.row_diff(left, right, "id")


@query(f"""{A.with_sql('assets')} select id, case when id % 5 = 0 then 'keep' when id % 5 = 2 and id % 7 > 0 then 'drop' else 'hold' end as decision, null as problem from assets
union all select id, null, case when id % 5 = 2 then 'repeated' else 'unknown' end from assets where (id % 5 = 2 and id % 7 = 0) or id % 5 = 4 union all select -id - 1, null, 'no_row' from assets where id % 97 = 0""")
def applied_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review decisions on assets: some are repeated, unknown, or for no row."""
    assets = A.asset_rows(spark, sf_dir).select("id")
    i = F.col("id")
    made = assets.withColumn("decision", F.when(i % 5 == 0, "keep").when(i % 5 == 2, "drop").when(i % 5 == 4, "maybe")).where("decision is not null")
    made = made.union(made.where("id % 5 = 2 and id % 7 = 0")).union(assets.where("id % 97 = 0").select(-i - 1, F.lit("keep")))
    rows, bad = joins.apply_decisions(assets, made, "id")
    return sets.union_all(rows, bad)


@query(f"""{A.with_sql('assets')}, m as (select 'f' || id as path, digest, 'k' || id as crop_id, id, sample_type from assets), c as (select path, case when id % 83 = 1 then 'y' else digest end as digest from m where id % 89 <> 2 union all select 'extra' || id, digest from m where id % 101 = 0),
r as (select path, case when id % 10 = 4 then 'x' else digest end as digest from m where id % 10 < 5 union all select 'new' || id, digest from m where id % 97 = 0), k as (select distinct crop_id from m where sample_type = 'de'),
s as (select m.path is not null as in_m, c.path is not null as in_c, r.path is not null as in_r, m.digest is distinct from c.digest as c_changed, m.digest is distinct from r.digest as r_changed, k.crop_id is not null as conflict from m full outer join c using (path) full outer join r on r.path = coalesce(m.path, c.path) left join k on k.crop_id = m.crop_id),
t as (select in_m, in_m and in_r and r_changed as modified, in_m and not in_r as removed, in_m and in_r and not r_changed and conflict as quarantined, in_m and in_r and not r_changed and not conflict as admitted, not in_m or not in_c or c_changed or (in_r and r_changed) as problem from s)
select count(*) filter (in_m) as expected, count(*) filter (admitted) as admitted, count(*) filter (quarantined) as quarantined, count(*) filter (removed) as removed, count(*) filter (modified) as modified, count(*) filter (not in_m) as unknown,
  count(*) filter (problem) as problems, count(*) filter (in_m) = count(*) filter (admitted or quarantined or removed) and count(*) filter (problem) = 0 as conserved from t""")
def review_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of a review's files: admitted, quarantined as their language conflicts, removed; some are changed, missing or unknown."""
    i = F.col("id")
    files = A.asset_rows(spark, sf_dir).select(F.concat(F.lit("f"), "id").alias("path"), "digest", F.concat(F.lit("k"), "id").alias("crop_id"), "id", "sample_type")
    candidates = files.where("id % 89 <> 2").withColumn("digest", F.when(i % 83 == 1, "y").otherwise(F.col("digest"))).unionByName(files.where("id % 101 = 0").withColumn("path", F.concat(F.lit("extra"), "id")))
    reviewed = files.where("id % 10 < 5").withColumn("digest", F.when(i % 10 == 4, "x").otherwise(F.col("digest"))).unionByName(files.where("id % 97 = 0").withColumn("path", F.concat(F.lit("new"), "id")))
    return joins.conservation_check(joins.review_partition(files, candidates, reviewed, files.where("sample_type = 'de'")))


@query(f"""{A.with_sql('assets')} select distinct 'digest' as "column", digest as value from assets where id % 2 = 0 and digest in (select digest from assets where id % 2 = 1)
union all select distinct 'group', "group" from assets where id % 2 = 0 and "group" in (select "group" from assets where id % 2 = 1)""")
def ignored_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    assets = A.asset_rows(spark, sf_dir)
    return joins.included_ignored_overlap(assets.where("id % 2 = 0"), assets.where("id % 2 = 1"), ["digest", "group"])


@query(f"""{A.with_sql('assets')}, f as (select 'store/' || id // 20 || '/' || id % 50 || '.png' as path from assets where id % 3 > 0), n as (select regexp_extract(path, '[^/]*$') as name, count(distinct path) as n, min(path) as only_ from f group by 1)
select id, l.path, case when f.path is not null then l.path when n.n = 1 then only_ end as found_path, case when f.path is not null then 'recorded' when n.n = 1 then 'renamed' when n.n > 1 then 'ambiguous' else 'missing' end as how
from (select id, 'store/' || id // 20 || '/' || id % 50 || '.png' as path from assets) l left join (select distinct path from f) f using (path) left join n on n.name = regexp_extract(l.path, '[^/]*$')""")
def rebased_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded paths against an inventory that lacks some files."""
    i = F.col("id")
    labels = A.asset_rows(spark, sf_dir).select("id", F.concat(F.lit("store/"), F.floor(i / 20), F.lit("/"), i % 50, F.lit(".png")).alias("path"))
    return joins.rebase_paths(labels, labels.where("id % 3 > 0").select("path")).select("id", "path", "found_path", "how")


@query(f"""{A.with_sql('assets')} select 'f' || id as path, case when id % 9 = 0 then 'missing' when id % 7 = 0 then 'digest' else 'rows' end as problem from assets where id % 9 = 0 or id % 7 = 0 or id % 5 = 0""")
def digest_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared files against those that are there, their digests and numbers of rows."""
    i = F.col("id")
    manifest = A.asset_rows(spark, sf_dir).select("id", F.concat(F.lit("f"), "id").alias("path"), "digest", F.length("digest").alias("n_rows"))
    there = manifest.where("id % 9 <> 0")
    files = there.select("path", F.when(i % 7 == 0, "x").otherwise(F.col("digest")).alias("digest"))
    return joins.verify_digests(manifest, files, there.select("path", F.when(i % 5 == 0, 1).otherwise(F.col("n_rows")).alias("n_rows")))


@query(f"""{A.with_sql('strata')}, s as (select distinct dataset_id, role, dataset_id <> 'ds-2' and role <> 'role-1' as active from strata), r(role, required) as (values ('role-0', true), ('role-1', true), ('role-2', true), ('role-9', false))
select role, required, count(s.dataset_id) as discovered, count(*) filter (active) as enabled, count(s.dataset_id) - count(*) filter (active) as disabled, case when count(*) filter (active) > 0 then 'present' when required then 'required_missing' else 'absent' end as status from r left join s using (role) group by 1, 2""")
def role_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = A.strata_rows(spark, sf_dir).select("dataset_id", "role").distinct().withColumn("active", (F.col("dataset_id") != "ds-2") & (F.col("role") != "role-1"))
    roles = spark.createDataFrame([("role-0", True), ("role-1", True), ("role-2", True), ("role-9", False)], "role string, required boolean")
    return joins.role_status(sources, roles)


@query(f"""{A.with_sql('assets')}, a as (select digest, sample_type from assets where id % 2 = 0), b as (select digest, sample_type from assets where id % 3 = 0)
select 'union' as op, count(*) as n from (select * from a union all select * from b) union all select 'common', count(*) from (select * from a intersect select * from b) union all select 'only_left', count(*) from (select * from a except select * from b)
union all select 'only_left_rows', count(*) from (select * from a except all select * from b) union all select 'distinct', count(*) from (select * from a union select * from b) union all select 'first_differs', sum((r <> 1)::int)::bigint from (select row_number() over (order by digest, id) as r, id from assets qualify r = 1)""")
def set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    assets = A.asset_rows(spark, sf_dir)
    a, b = (assets.where(f"id % {k} = 0").select("digest", "sample_type") for k in (2, 3))
    made = {"union": sets.union_all(a, b), "common": sets.common(a, b), "only_left": sets.only_left(a, b), "only_left_rows": sets.only_left(a, b, True), "distinct": sets.all_tokens(a, b)}
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(op).alias("op"), "n") for op, df in made.items()]
    ordered = sets.ordered_output(assets, "digest", "id")
    least = assets.agg(F.min_by("id", F.struct("digest", "id")).alias("m"))
    differs = sets.first_ordered(ordered).crossJoin(least).agg(F.sum((F.col("id") != F.col("m")).cast("int")).alias("n")).select(F.lit("first_differs").alias("op"), "n")
    return sets.union_all(*counts, differs)


@query(f"""{A.with_sql('assets')} select id, row_number() over (order by digest, id) as position from assets""")
def export_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every row in a stable export."""
    return sets.ordered_positions(A.asset_rows(spark, sf_dir), "digest", "id").select("id", "position")


@query("""select event_id, value, case when event_id % 4 = 0 then '../x' when event_id % 4 = 1 then '/abs' when event_id % 4 = 2 then 'a/b' else '' end as path, event_id % 4 <> 2 as unsafe, event_id % 3 <> 1 as timed,
  '{"a":' || event_id || ',"b":{"c":"x","d":[1,2]}}' as canonical, sha256('[{"k":' || event_id || ',"n":2}]') as cells from events""".replace("event_id, value,", "event_id,"))
def text_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths, timestamps, canonical JSON and digests of cells."""
    i = F.col("event_id")
    path = F.when(i % 4 == 0, "../x").when(i % 4 == 1, "/abs").when(i % 4 == 2, "a/b").otherwise("")
    when = F.when(i % 3 == 0, "2026-07-14T10:00:00Z").when(i % 3 == 1, "2026-17-14T10:00:00Z").otherwise("2026-07-14 10:00")
    json = F.format_string('{ "b": {"d": [1, 2], "c": "x"}, "a": %d }', i)
    cells = F.array(F.struct(i.alias("k"), F.lit(2).alias("n")))
    return A.table(spark, sf_dir, "events").select("event_id", path.alias("path"), X.unsafe_path(path).alias("unsafe"), X.is_timestamp(when).alias("timed"), X.canonical_json(json).alias("canonical"), X.cells_digest(cells).alias("cells"))


@query("""with p as (select page_id, regexp_replace(url, '^[a-z]+://[^/]*', '') as own from pages), q as (select page_id, case page_id % 4 when 0 then own when 1 then own[2:] when 2 then '../' || own[2:] else replace(own[2:], '/', '/../') end as path from p)
select page_id, path, path = '' or starts_with(path, '/') or list_contains(string_split(path, '/'), '..') as unsafe from q""")
def url_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of pages' addresses, with and without what makes them unsafe in a manifest."""
    k = F.col("page_id") % 4
    at = F.regexp_replace("url", "^[a-z]+://[^/]*", "")
    own = F.substring("at", 2, 1 << 20)
    path = F.when(k == 0, F.col("at")).when(k == 1, own).when(k == 2, F.concat(F.lit("../"), own)).otherwise(F.regexp_replace(own, "/", "/../"))
    rows = A.table(spark, sf_dir, "pages").select("page_id", at.alias("at")).withColumn("path", path)
    return rows.select("page_id", "path", X.unsafe_path(F.col("path")).alias("unsafe"))


@query("""with e as (select event_id, json_extract_string(props, '$.k') as k, value::integer % 40 + 1 as d from events)
select event_id, '{"props":{"k":' || k || '},"z":[{"a":' || k || ',"b":null},2]}' as canonical, d <= 31 as timed from e""")
def event_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events' JSON inside other JSON, in canonical form, and dates of which some don't exist."""
    json = F.concat(F.lit('{"z": [ {"b": null, "a": '), F.get_json_object("props", "$.k"), F.lit(' }, 2 ],  "props": '), "props", F.lit("}"))
    day = F.format_string("2024-01-%02dT10:00:00Z", F.bround("value", 0).cast("int") % 40 + 1)
    return A.table(spark, sf_dir, "events").select("event_id", X.canonical_json(json).alias("canonical"), X.is_timestamp(day).alias("timed"))


@query(f"""{A.with_sql('assets')} select id, count(*) as n from (select id from assets union all select id from assets where id % 17 = 0 union all select id from assets where id % 34 = 0) group by 1 having count(*) > 1""")
def repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    assets = A.asset_rows(spark, sf_dir).select("id")
    return joins.duplicate_ids(assets.union(assets.where("id % 17 = 0")).union(assets.where("id % 34 = 0")), "id")


@query("""with i as (select vec_id, list_transform(range(0, 21), lambda k: (k * (vec_id % 22))::bigint % 21) as ids from embeddings) select vec_id, len(list_distinct(ids)) < 21 as repeated from i""")
def repeated_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points whose ids are made by steps; some steps come to an id twice."""
    step = F.col("vec_id") % 22
    points = F.transform(F.sequence(F.lit(0), F.lit(20)), lambda k: F.struct((k * step % 21).alias("id"), F.col("embedding")[k].alias("x")))
    return A.table(spark, sf_dir, "embeddings").select("vec_id", P.has_duplicate_ids(points).alias("repeated"))
