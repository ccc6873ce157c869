"""The driver's tables as the tables of this library, in Spark and, with equal values, in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.points import N_POINTS, corners


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _points(offset: int = 0, noise: float = 0.0):
    """21 points from 64 numbers: 0.5 + e[2i], 0.5 + e[2i + 1]; with noise * e[(2i + 43) % 64], e[(2i + 44) % 64] added."""
    def at(k: Column) -> Column:
        return F.get("embedding", k).cast("double")

    def one(i: Column) -> Column:
        x, y = 0.5 + at(2 * i), 0.5 + at(2 * i + 1)
        if noise:
            x, y = x + noise * at((2 * i + 43) % 64), y + noise * at((2 * i + 44) % 64)
        return F.struct(i.alias("id"), x.alias("x"), y.alias("y"))

    return F.transform(F.sequence(F.lit(0), F.lit(N_POINTS - 1)), one)


def roi_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, label = F.col("vec_id"), F.col("label")
    split = F.when(v % 10 < 8, "train").when(v % 10 == 8, "val").otherwise("test")
    distance = F.when(F.floor(v / 2) % 2 == 0, "near").otherwise("mid")
    lighting = F.when(label % 2 == 0, "bright").otherwise("dark")
    source = F.concat_ws("-", F.when(v % 2 == 0, "white").otherwise("complex"), distance, lighting, F.concat(F.lit("c"), label), split, F.concat(F.lit("s0"), label % 3), F.concat(F.lit("p"), label % 3))
    e = F.col("embedding")
    rect = F.struct(
        (0.5 + e[42].cast("double")).alias("x_center"),
        (0.5 + e[43].cast("double")).alias("y_center"),
        (2 * (0.05 + F.abs(e[44].cast("double")))).alias("width"),
        (2 * (0.05 + F.abs(e[44].cast("double")))).alias("height"),
        (6 * e[45].cast("double")).alias("rotation_rad"),
    )
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("roi-"), v).alias("roi_id"),
        F.concat(F.lit("ds-"), label % 4).alias("dataset_id"),
        split.alias("split"),
        source.alias("capture_source_id"),
        F.concat(F.lit("raw-"), F.floor(v / 3)).alias("raw_image_id"),
        F.when(v % 17 == 0, "v2").otherwise("v1").alias("proposal_variant"),
        F.concat(F.lit("g-"), F.floor(v / 4)).alias("source_group_id"),
        (v % 5 != 0).alias("present"),
        (v % 3 != 0).alias("palm_valid"),
        F.when(v % 7 == 0, "unknown").when(v % 2 == 0, "Left").otherwise("Right").alias("handedness"),
        distance.alias("distance"),
        lighting.alias("lighting"),
        _points().alias("points"),
        rect.alias("rect"),
    )


def roi_predictions(spark: SparkSession, sf_dir: str, run: str = "candidate") -> DataFrame:
    v = F.col("vec_id")
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("roi-"), v).alias("roi_id"),
        F.when(v % 13 != 0, _points(noise={"baseline": 0.20, "candidate": 0.10}[run])).alias("predicted"),
        (v * 37 % 100 / 100).alias("hand_flag"),
        (v * 53 % 100 / 100).alias("handedness_score"),
    )


#: What part of a detector's time each of its details takes here.
PALM_SHARES = {
    "palm_preprocess_ms": 0.3, "palm_preprocess_transform_ms": 0.2, "palm_preprocess_manual_load_ms": 0.1, "palm_input_load_ms": 0.1, "palm_inference_ms": 0.4,
    "palm_getoutput_ms": 0.05, "palm_output_meta_ms": 0.02, "palm_decode_ms": 0.05, "palm_verbose_log_ms": 0.01, "palm_accounted_ms": 0.93,
}


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """roi_labels as rows come from an annotation tool: pixel points, corners, origin; negatives without points and hand; v is the row's number."""
    rows = roi_labels(spark, sf_dir)
    v = F.substring("roi_id", 5, 20).cast("long")
    px = F.transform("points", lambda p: F.struct(p["id"].alias("id"), (p["x"] * 255).alias("x"), (p["y"] * 255).alias("y")))
    held = lambda c: F.when(F.col("present"), c)
    return rows.select(
        "roi_id", "dataset_id", "capture_source_id", "split", "raw_image_id", "proposal_variant", "present", "rect", v.alias("v"),
        F.concat(F.lit("crops/"), v, F.lit(".png")).alias("crop_path"),
        F.lit(0.9).alias("palm_score"),
        corners(F.col("rect")).alias("corners"),
        held(F.col("points")).alias("points"),
        held(px).alias("points_px"),
        held(px).alias("points_image"),
        F.coalesce(held(F.col("handedness")), F.lit("unknown")).alias("handedness"),
        F.when(v % 11 == 0, "human").when(v % 13 == 0, "tool_human_corrected").otherwise("mediapipe").alias("label_origin"),
        F.when(F.col("palm_valid"), "runtime").otherwise("low_palm").alias("proposal_kind"),
        F.lit(None).cast("string").alias("hand_id"),
        F.lit(None).cast("double").alias("label_score"),
    )


def detection_rows(spark: SparkSession, sf_dir: str, run: str = "candidate") -> DataFrame:
    """(image, rendered, error, detections): three ROIs of a raw image as its detections; the candidate run misses some, fails on some images, and lacks others."""
    v = F.col("vec_id")
    made = F.transform(_points(), lambda p: F.array(p["x"], p["y"]))
    shrunk = F.transform(made, lambda p: F.when(v % 9 == 0, F.transform(p, lambda c: 0.5 + (c - 0.5) / 50)).otherwise(p if run == "baseline" else F.transform(p, lambda c: c + 0.01)))
    rows = table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("raw-"), F.floor(v / 3)).alias("image"), v.alias("v"), F.struct(((v * 37 % 100) / 100).alias("hand_flag_score"), shrunk.alias("landmarks_roi_norm")).alias("d")
    )
    if run == "candidate":
        rows = rows.where("v % 7 <> 0 and (v div 3) % 10 <> 1")
    found = rows.groupBy("image").agg(F.transform(F.array_sort(F.collect_list(F.struct("v", "d"))), lambda x: x["d"]).alias("detections"))
    number = F.substring("image", 5, 20).cast("long")
    error = F.when((number % 10 == 3) & F.lit(run == "candidate"), "decode failed")
    return found.select("image", F.concat("image", F.lit(".png")).alias("rendered"), error.alias("error"), "detections")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    value, kind = F.col("value"), F.col("event_type")
    palm = F.when(kind.isin("click", "view"), value / 30).otherwise(0.0)
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"),
        (F.row_number().over(order) - 1).cast("long").alias("frame_index"),
        (2 + value / 20 - value / 25).alias("get_image_ms"),
        F.lit(1.0).alias("draw_ms"),
        (5 + value / 20).alias("loop_ms"),
        (3 + value / 25).alias("process_ms"),
        palm.alias("palm_total_ms"),
        F.when(kind == "purchase", value / 40).otherwise(0.0).alias("hand_total_ms"),
        *((palm * share).alias(name) for name, share in PALM_SHARES.items()),
    )


def perf_lines(spark: SparkSession, sf_dir: str, n: int = 20) -> DataFrame:
    """(run_id, line_no, line): an orphan stage line for even runs, then three lines for each full window."""
    window = F.floor(F.col("frame_index") / n)
    full = frames(spark, sf_dir).groupBy("run_id", window.alias("w")).agg(F.count("*").alias("n"), F.avg("loop_ms").alias("loop"), F.avg("palm_total_ms").alias("palm"), F.max("loop_ms").alias("top")).where(f"n = {n}")
    fmt = "%.6f"
    lines = F.array(
        F.format_string("[PERF][summary] frame=%d total_frames=%d window_frames=%d", (F.col("w") + 1) * n - 1, (F.col("w") + 1) * n, F.lit(n)),
        F.format_string(f"[PERF][stage_ms] loop_avg={fmt} palm_avg={fmt}", F.col("loop"), F.col("palm")),
        F.format_string(f'[PERF][latency] loop_max={fmt} note="w %d"', F.col("top"), F.col("w")),
    )
    rows = full.select("run_id", "w", F.posexplode(lines).alias("k", "line")).select("run_id", (F.col("w") * 3 + F.col("k") + 1).alias("line_no"), "line")
    orphans = full.where("run_id % 2 = 0").select("run_id").distinct().select("run_id", F.lit(0).cast("long").alias("line_no"), F.lit("[PERF][stage_ms] loop_avg=0.000 palm_avg=0.000").alias("line"))
    return rows.unionByName(orphans)


def strata_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        k.alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").alias("weight"),
        F.concat(F.lit("q-"), c).alias("source_sequence_id"),
        F.concat(F.lit("ds-"), c % 7).alias("dataset_id"),
        F.concat(F.lit("role-"), c % 7 % 3).alias("role"),
        F.concat(F.lit("type-"), k % 4).alias("sample_type"),
        F.concat(F.lit("tier-"), k % 2).alias("tier"),
    )


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    x, y = k % 61 / 100, k % 53 / 100
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("image"), k.alias("box_id"), x.alias("x1"), y.alias("y1"), (x + 0.2 + k % 7 / 50).alias("x2"), (y + 0.2 + k % 5 / 50).alias("y2"), (k % 997 / 997).alias("score"), (k % 2).cast("int").alias("head")
    )


def asset_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        v.alias("id"), F.sha2(F.col("text").cast("binary"), 256).alias("digest"), F.when(v % 10 < 8, "train").when(v % 10 == 8, "val").otherwise("test").alias("split"), F.col("source").alias("group"), F.col("lang").alias("sample_type")
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy(F.col("user_id") % 20).orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").select((F.col("user_id") % 20).alias("run"), F.row_number().over(order).alias("epoch"), F.col("event_type").alias("metric"), "value")


_XY = "list_transform(range(0, 21), lambda i: {{'x': 0.5 + e[2*i+1]::double{0}, 'y': 0.5 + e[2*i+2]::double{1}}})"


def _noisy(s: float) -> str:
    return _XY.format(f" + {s} * e[(2*i+43)%64+1]::double", f" + {s} * e[(2*i+44)%64+1]::double")


#: Common table expressions with the same names and columns.
SQL = {
    "labels": f"""labels as (
      select 'roi-' || v as roi_id, 'ds-' || l % 4 as dataset_id, split,
        concat_ws('-', case when v % 2 = 0 then 'white' else 'complex' end, distance, lighting, 'c' || l, split, 's0' || l % 3, 'p' || l % 3) as capture_source_id,
        'raw-' || v // 3 as raw_image_id, case when v % 17 = 0 then 'v2' else 'v1' end as proposal_variant, 'g-' || v // 4 as source_group_id,
        v % 5 <> 0 as present, v % 3 <> 0 as palm_valid, case when v % 7 = 0 then 'unknown' when v % 2 = 0 then 'Left' else 'Right' end as handedness,
        distance, lighting, {_XY.format('', '')} as points, e
      from (select vec_id as v, label as l, embedding as e,
        case when vec_id % 10 < 8 then 'train' when vec_id % 10 = 8 then 'val' else 'test' end as split,
        case when vec_id // 2 % 2 = 0 then 'near' else 'mid' end as distance, case when label % 2 = 0 then 'bright' else 'dark' end as lighting from embeddings))""",
    "candidate": f"""candidate as (
      select 'roi-' || vec_id as roi_id, case when vec_id % 13 <> 0 then {_noisy(0.1)} end as predicted, (vec_id * 37 % 100) / 100 as hand_flag, (vec_id * 53 % 100) / 100 as handedness_score
      from (select *, embedding as e from embeddings))""",
    "baseline": f"""baseline as (
      select 'roi-' || vec_id as roi_id, case when vec_id % 13 <> 0 then {_noisy(0.2)} end as predicted, (vec_id * 37 % 100) / 100 as hand_flag, (vec_id * 53 % 100) / 100 as handedness_score
      from (select *, embedding as e from embeddings))""",
    "frames": f"""frames as (
      select *, {', '.join(f'palm_total_ms * {v}::double as {k}' for k, v in PALM_SHARES.items())} from (select user_id as run_id, row_number() over (partition by user_id order by ts, event_id) - 1 as frame_index, 2 + value / 20 - value / 25 as get_image_ms, 1.0::double as draw_ms,
        5 + value / 20 as loop_ms, 3 + value / 25 as process_ms, case when event_type in ('click', 'view') then value / 30 else 0 end as palm_total_ms, case when event_type = 'purchase' then value / 40 else 0 end as hand_total_ms
      from events))""",
    "published": """published as (
      select roi_id, dataset_id, capture_source_id, split, raw_image_id, present, v, case when present then points end as points, case when present then handedness else 'unknown' end as handedness,
        case when v % 11 = 0 then 'human' when v % 13 = 0 then 'tool_human_corrected' else 'mediapipe' end as label_origin, palm_valid, case when palm_valid then 'runtime' else 'low_palm' end as proposal_kind
      from (select *, roi_id[5:]::bigint as v from labels))""",
    **{
        f"{run}_detections": f"""{run}_detections as (
      select 'raw-' || n as image, case when n % 10 = 3 and {run == 'candidate'} then 'decode failed' end as error, list({{'flag': f, 'pts': pts}} order by v) as detections from (
        select vec_id as v, vec_id // 3 as n, (vec_id * 37 % 100) / 100 as f, list_transform(range(0, 21), lambda i: list_transform([0.5 + embedding[2*i+1]::double, 0.5 + embedding[2*i+2]::double],
          lambda c: case when vec_id % 9 = 0 then 0.5 + (c - 0.5) / 50 else c + {0.01 if run == 'candidate' else 0}::double end)) as pts from embeddings{' where vec_id % 7 <> 0 and vec_id // 3 % 10 <> 1' if run == 'candidate' else ''})
      group by n)"""
        for run in ("baseline", "candidate")
    },
    "strata": """strata as (
      select o_orderkey as id, o_orderstatus as status, o_orderpriority as priority, o_totalprice as weight, 'q-' || o_custkey as source_sequence_id, 'ds-' || o_custkey % 7 as dataset_id,
        'role-' || o_custkey % 7 % 3 as role, 'type-' || o_orderkey % 4 as sample_type, 'tier-' || o_orderkey % 2 as tier from orders)""",
    "assets": """assets as (
      select doc_id as id, sha256(text) as digest, case when doc_id % 10 < 8 then 'train' when doc_id % 10 = 8 then 'val' else 'test' end as split, source as "group", lang as sample_type from documents)""",
    "history": """history as (
      select user_id % 20 as run, row_number() over (partition by user_id % 20 order by ts, event_id)::integer as epoch, event_type as metric, value from events)""",
    "boxes": """boxes as (
      select o_custkey as image, o_orderkey as box_id, (o_orderkey % 61) / 100 as x1, (o_orderkey % 53) / 100 as y1, (o_orderkey % 61) / 100 + 0.2 + (o_orderkey % 7) / 50 as x2,
        (o_orderkey % 53) / 100 + 0.2 + (o_orderkey % 5) / 50 as y2, (o_orderkey % 997) / 997 as score, (o_orderkey % 2)::integer as head from orders)""",
}


def with_sql(*names: str, recursive: bool = False) -> str:
    return "with " + ("recursive " if recursive else "") + ", ".join(SQL[n] for n in names)
