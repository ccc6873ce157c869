"""Frame timings in fixed count windows, and the log lines that report them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import ceil_percentile, lower_median, safe_div
from ..functions.text import key_values, typed

#: The 16 timings of a frame. Names of a device's fields.
TIMINGS = (
    "get_image_ms", "palm_total_ms", "palm_preprocess_ms", "palm_preprocess_transform_ms",
    "palm_preprocess_manual_load_ms", "palm_input_load_ms", "palm_inference_ms", "palm_getoutput_ms",
    "palm_output_meta_ms", "palm_decode_ms", "palm_verbose_log_ms", "palm_accounted_ms",
    "hand_total_ms", "draw_ms", "loop_ms", "process_ms",
)
#: What a detector's time is shown as, and the timings that it adds up. A device's stages.
PALM_PARTS = {
    "palm_transform": ("palm_preprocess_transform",),
    "palm_tensor_load": ("palm_preprocess_manual_load", "palm_input_load"),
    "palm_inference": ("palm_inference",),
    "palm_postprocess": ("palm_getoutput", "palm_output_meta", "palm_decode", "palm_verbose_log"),
}
SENSOR_FPS = 90.0


def frame_windows(frames: DataFrame, n: int = 120, timings: tuple[str, ...] = TIMINGS) -> DataFrame:
    """Windows of n frames by run and frame index: average, median, p95 and maximum of each timing that the frames have. Incomplete windows are left out."""
    timings = tuple(t for t in timings if t in frames.columns)
    keyed = frames.withColumn("window", F.floor(F.col("frame_index") / n))
    out = [F.count("*").alias("frames"), F.max("frame_index").alias("frame_index"), F.sum("loop_ms").alias("window_ms")]
    for t in timings:
        v = F.col(t)
        out += [F.avg(v).alias(f"{t}_avg"), lower_median(v).alias(f"{t}_p50"), ceil_percentile(v, 0.95).alias(f"{t}_p95"), F.max(v).alias(f"{t}_max")]
    fps = F.when(F.col("loop_ms") > 0, 1000 / F.col("loop_ms"))
    out += [F.avg(fps).alias("fps_avg"), ceil_percentile(fps, 0.95).alias("fps_p95")]
    return keyed.groupBy("run_id", "window").agg(*out).where(F.col("frames") == n)


def window_scores(windows: DataFrame, sensor_fps: float = SENSOR_FPS) -> DataFrame:
    """Windows with frame rates, realtime ratio and score, estimated drop rate, latency score and jitter.

    Elapsed time is the sum of the loop times so far.
    """
    so_far = Window.partitionBy("run_id").orderBy("window").rowsBetween(Window.unboundedPreceding, 0)
    rows = windows.withColumn("total_frames", F.sum("frames").over(so_far)).withColumn("elapsed_s", F.sum("window_ms").over(so_far) / 1000)
    fps_window = safe_div(F.col("frames") * 1000, F.col("window_ms"))
    ratio = fps_window / sensor_fps
    expected = F.col("elapsed_s") * sensor_fps

    def clamp(v, low, high):
        return F.greatest(F.lit(low), F.least(F.lit(high), v))

    def jitter(name: str):
        return safe_div(100 * F.abs(F.col(f"{name}_p95") - F.col(f"{name}_avg")), F.col(f"{name}_avg"))

    return rows.withColumns({
        "fps_total": safe_div(F.col("total_frames").cast("double"), F.col("elapsed_s")),
        "fps_window": fps_window,
        "realtime_ratio": ratio,
        "realtime_score": F.floor(10 * clamp(ratio, 0.0, 1.0)).cast("int"),
        "drop_pct": 100 * clamp(safe_div(expected - F.col("total_frames"), expected), 0.0, 1.0),
        "latency_score": clamp(F.floor(11 - F.col("loop_ms_p95") * sensor_fps / 1000).cast("double"), 0.0, 10.0).cast("int"),
        "loop_jitter_pct": jitter("loop_ms"),
        "fps_jitter_pct": jitter("fps"),
    })


#: Lines of a log whose summaries are counted together.
LINE_RANGE = 1 << 14


def parse_lines(lines: DataFrame, line_range: int = LINE_RANGE) -> DataFrame:
    """(run_id, line_no, line) -> run_id, line_no, section, values (map), window: the number of the last summary at or before the line, 0 if none (an orphan).

    A line's report may begin anywhere in it (after a timestamp, say); configuration lines belong to the run. Summaries are counted
    per range of lines, ranges are added up per run, and lines are numbered inside their range, so a log of any length is many tasks' work.
    """
    pattern = r"\[PERF\]\[([^\]]+)\]\s*(.*)"
    rows = lines.withColumn("section", F.regexp_extract("line", pattern, 1)).where("section <> ''")
    rows = rows.select("run_id", "line_no", "section", key_values(F.regexp_extract("line", pattern, 2)).alias("values"), F.expr(f"line_no div {line_range}").alias("_r"))
    summary = (F.col("section") == "summary").cast("int")
    earlier = Window.partitionBy("run_id").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    ranges = rows.groupBy("run_id", "_r").agg(F.sum(summary).alias("_s")).select("run_id", "_r", F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_b"))
    upto = Window.partitionBy("run_id", "_r").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("_n", F.sum(summary).over(upto)).join(ranges, ["run_id", "_r"]).select("run_id", "line_no", "section", "values", (F.col("_b") + F.col("_n")).alias("window"))


def last_config(parsed: DataFrame) -> DataFrame:
    """(run_id, key, value): of each configuration key the last value."""
    rows = parsed.where("section = 'config'").select("run_id", "line_no", F.explode("values").alias("key", "value"))
    return rows.groupBy("run_id", "key").agg(F.max_by("value", "line_no").alias("value"))


def log_metrics(parsed: DataFrame) -> DataFrame:
    """(run_id, window, metric, value): the numbers of the lines attached to a summary. A section that is repeated replaces the one before it, whole."""
    rows = parsed.where("window > 0 and section <> 'config'").groupBy("run_id", "window", "section").agg(F.max_by("values", "line_no").alias("values"))
    rows = rows.select("run_id", "window", "section", F.explode("values").alias("key", "text"))
    return rows.select("run_id", "window", F.concat_ws(".", "section", "key").alias("metric"), typed(F.col("text"))["number"].alias("value")).where("value is not null")


def window_rollup(metrics: DataFrame) -> DataFrame:
    """Mean, median, p95 (linear), least, most and latest of each metric of a run."""
    return metrics.groupBy("run_id", "metric").agg(
        F.count("*").alias("windows"), F.avg("value").alias("mean"), F.percentile("value", F.lit(0.5)).alias("p50"), F.percentile("value", F.lit(0.95)).alias("p95"),
        F.min("value").alias("least"), F.max("value").alias("most"), F.max_by("value", "window").alias("latest"),
    )


def orphans(parsed: DataFrame) -> DataFrame:
    """Lines other than configuration before a run's first summary."""
    return parsed.where("window = 0 and section <> 'config'")


def infer_counts(windows: DataFrame, k: int, mode: str = "palm_hand") -> DataFrame:
    """Windows with n_infer: the multiples of k among their frame indexes, from the first frame of the run on, and n_hand_calls: as many where
    the mode also runs the hand model, else 0."""
    first = F.greatest(F.col("frame_index") - F.col("frames") + 1, F.lit(0))
    n = F.greatest(F.floor(F.col("frame_index") / k) - F.ceil(first / k) + 1, F.lit(0)).cast("long")
    return windows.withColumn("n_infer", n).withColumn("n_hand_calls", F.when(F.lit(mode == "palm_hand"), n).otherwise(0).cast("long"))


def per_inference(rollup: DataFrame, k: int) -> DataFrame:
    """The latest averages as times of one inference, k frames each; p95 values stay."""
    return rollup.withColumn("per_inference", F.when(F.col("metric").rlike("p95"), F.col("latest")).otherwise(F.col("latest") * k))


def run_metrics(windows: DataFrame, k: int = 1, mode: str = "palm_hand") -> DataFrame:
    """Totals of a run's windows: frames, inferences (every k-th frame) and hand calls among them, and the last frame index."""
    counted = infer_counts(windows, k, mode)
    return counted.groupBy("run_id").agg(
        F.count("*").alias("windows"), F.sum("frames").alias("frames"), (F.max("frame_index") + 1).alias("last_total_frames"), F.sum("n_infer").alias("inferences"), F.sum("n_hand_calls").alias("hand_calls"),
        F.sum("window_ms").alias("total_ms"), safe_div(F.sum("frames") * 1000.0, F.sum("window_ms")).alias("fps"), F.max("loop_ms_max").alias("slowest_ms"),
    )


def p95_breakdown(windows: DataFrame, mode: str = "palm_hand", least_ms: float = 0.20, least_share: float = 0.025) -> DataFrame:
    """(run_id, segment, ms): what an iteration's p95 is made of, by the mean p95 of each timing over the windows in which it is positive.

    The detector is shown in the parts of PALM_PARTS and palm_other, what they leave of its total; process_overhead is what
    detector, hand model (in mode palm_hand) and drawing leave of process_ms, loop_overhead what loop_ms has beyond image
    and process. A rest is 0 at least, and absent where one of its totals is. Segments below least_ms or below least_share of
    the sum of all are merged into small_stages; timings that the windows lack are absent.
    """
    names = [t.removesuffix("_ms") for t in TIMINGS if f"{t}_p95" in windows.columns]
    means = windows.groupBy("run_id").agg(*(F.avg(F.when(F.col(f"{n}_ms_p95") > 0, F.col(f"{n}_ms_p95"))).alias(n) for n in names))
    value = lambda n: F.col(n) if n in names else F.lit(None).cast("double")
    total = lambda ns: sum((F.coalesce(value(n), F.lit(0.0)) for n in ns), F.lit(0.0))
    rest = lambda whole, parts: F.when(whole.isNotNull(), F.greatest(whole - parts, F.lit(0.0)))
    hand = value("hand_total") if mode == "palm_hand" else F.lit(None).cast("double")
    outer = F.when(value("get_image").isNotNull() & value("process").isNotNull(), value("loop"))
    segments = {"get_image": value("get_image")} | {label: total(ns) for label, ns in PALM_PARTS.items()}
    segments |= {"palm_other": rest(value("palm_total"), total([n for ns in PALM_PARTS.values() for n in ns])), "hand_total": hand, "draw": value("draw")}
    segments |= {"process_overhead": rest(value("process"), total(["palm_total", "draw"]) + F.coalesce(hand, F.lit(0.0))), "loop_overhead": rest(outer, value("get_image") + value("process"))}
    rows = means.select("run_id", F.explode(F.array(*(F.struct(F.lit(n).alias("segment"), v.alias("ms")) for n, v in segments.items()))).alias("e")).select("run_id", "e.*").where("ms > 0")
    small = (F.col("ms") < least_ms) | (F.col("ms") / F.sum("ms").over(Window.partitionBy("run_id")) < least_share)
    return rows.withColumn("segment", F.when(small, "small_stages").otherwise(F.col("segment"))).groupBy("run_id", "segment").agg(F.sum("ms").alias("ms"))
