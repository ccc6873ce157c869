"""Detection tables: suppression per image, anchors, rotated overlap, nested detections."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.points import N_POINTS


def _staying(iou: float, cross_iou: float | None, k: int):
    """Rows sorted by image, head and score, as a stream: those that stay. Only the kept boxes of one image are held.

    Without a cross limit the first k stay. With one, all of head 0 stay that no better one covers, and boxes of head 1 until
    one of them makes k.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        image, kept, n, full = None, np.empty((16, 4)), 0, False
        for batch in batches:
            boxes, rows = batch[["x1", "y1", "x2", "y2"]].to_numpy(float), []
            for i, (own, head) in enumerate(zip(batch["image"], batch["head"])):
                if own != image:
                    image, n, full = own, 0, False
                if full:
                    continue
                box, held = boxes[i], kept[:n]
                sides = np.clip(np.minimum(box[2:], held[:, 2:]) - np.maximum(box[:2], held[:, :2]), 0, None)
                both = sides[:, 0] * sides[:, 1]
                areas = np.clip(held[:, 2:] - held[:, :2], 0, None).prod(axis=1) + np.clip(box[2:] - box[:2], 0, None).prod()
                if (both / (areas - both + 1e-6) > (iou if head == 0 else cross_iou)).any():
                    continue
                if n == len(kept):
                    kept = np.concatenate([kept, np.empty_like(kept)])
                kept[n], n = box, n + 1
                rows.append(i)
                full = n >= k and (cross_iou is None or head == 1)
            yield batch.iloc[rows]

    return run


def _streamed(boxes: DataFrame, head: Column, iou: float, cross_iou: float | None, k: int) -> DataFrame:
    kind = boxes.schema["image"].dataType.simpleString()
    rows = boxes.where(F.col("image").isNotNull()).select("image", "box_id", head.cast("int").alias("head"), *(F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2", "score")))
    rows = rows.where(~F.isnan("score") & (F.abs("score") != float("inf")))
    n = int(boxes.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ordered = rows.repartition(n, "image").sortWithinPartitions("image", "head", F.col("score").desc(), "box_id")
    stay = ordered.mapInPandas(_staying(iou, cross_iou, k), f"image {kind}, box_id long, head int, x1 double, y1 double, x2 double, y2 double, score double")
    best = Window.partitionBy("image").orderBy(F.col("score").desc(), "box_id")
    return stay.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def nms(boxes: DataFrame, iou: float, k: int) -> DataFrame:
    """Greedy suppression per image: (image, box_id, x1, y1, x2, y2, score, rank); boxes with an overlap above `iou` with a better one go; k stay at most.

    Scores that aren't finite and null images take no part; equal scores go by box_id. Boxes pass as a stream in the order
    of image and score, so an image may have any number of them.
    """
    return _streamed(boxes, F.lit(0), iou, None, k).drop("head")


def nms_two_stage(boxes: DataFrame, iou: float, cross_iou: float, k: int) -> DataFrame:
    """Suppression by iou inside head 0, then boxes of head 1 by score, unless their overlap with any kept box passes cross_iou, until
    there are k; of all that stay the k best by score. Among boxes of head 1 alone cross_iou holds, too."""
    return _streamed(boxes, F.when(F.col("head") == 0, 0).otherwise(1), iou, cross_iou, k)


def anchors(spark, levels: list[tuple[int, int, int]]) -> DataFrame:
    """(anchor_id, cx, cy): centres of the cells of each level (rows, columns, anchors per cell), by row, column, anchor."""
    table, first = None, 0
    for rows, columns, per in levels:
        level = spark.range(rows * columns * per).select(
            (F.col("id") + first).alias("anchor_id"), ((F.floor(F.col("id") / per) % columns + 0.5) / columns).alias("cx"), ((F.floor(F.col("id") / per / columns) + 0.5) / rows).alias("cy")
        )
        table, first = level if table is None else table.union(level), first + rows * columns * per
    return table


def decode_boxes(raw: DataFrame, anchor_table: DataFrame) -> DataFrame:
    """Raw outputs (image, anchor_id, dx, dy, w, h, logit) as boxes around their anchors, w and h as exponents clipped to +-10, with sigmoid scores.

    Anchors are joined by id; Spark broadcasts them where its own size limit allows it.
    """
    clip = lambda c: F.exp(F.greatest(F.lit(-10.0), F.least(F.lit(10.0), F.col(c))))
    rows = raw.join(anchor_table, "anchor_id")
    cx, cy, w, h = F.col("cx") + F.col("dx"), F.col("cy") + F.col("dy"), clip("w"), clip("h")
    return rows.select("image", "anchor_id", (cx - w / 2).alias("x1"), (cy - h / 2).alias("y1"), (cx + w / 2).alias("x2"), (cy + h / 2).alias("y2"), (1 / (1 + F.exp(-F.col("logit")))).alias("score"))


def _areas(polygons: np.ndarray) -> np.ndarray:
    """Twice the areas of polygons (n, corners, 2), positive where the corners go round from x to y."""
    ahead = np.roll(polygons, -1, axis=1)
    return (polygons[..., 0] * ahead[..., 1] - ahead[..., 0] * polygons[..., 1]).sum(axis=1)


def _cut(polygons: np.ndarray, start: np.ndarray, step: np.ndarray) -> np.ndarray:
    """The part of each convex polygon on the left of its edge (start, step): a corner more at most; spare places repeat the last corner."""
    ahead = np.roll(polygons, -1, axis=1)
    side = step[:, None, 0] * (polygons[..., 1] - start[:, None, 1]) - step[:, None, 1] * (polygons[..., 0] - start[:, None, 0])
    side_ahead = np.roll(side, -1, axis=1)
    crosses = side * side_ahead < 0
    share = np.divide(side, side - side_ahead, out=np.zeros_like(side), where=crosses)
    corners = np.stack([polygons, polygons + share[..., None] * (ahead - polygons)], axis=2).reshape(len(polygons), 2 * polygons.shape[1], 2)
    taken = np.stack([side >= 0, crosses], axis=2).reshape(len(polygons), 2 * polygons.shape[1])
    place = np.cumsum(taken, axis=1) - 1
    n = place[:, -1] + 1
    width = int(n.max(initial=1))
    out = np.zeros((len(polygons), width, 2))
    row, at = np.nonzero(taken)
    out[row, place[row, at]] = corners[row, at]
    last = np.take_along_axis(out, np.maximum(n - 1, 0)[:, None, None], axis=1)
    return np.where((np.arange(width) < n[:, None])[..., None], out, last)


def _overlaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Overlap of pairs of rectangles (n, 4, 2), in doubles; 0 without areas. Only pairs whose bounds meet are cut."""
    b = np.where((_areas(b) < 0)[:, None, None], b[:, ::-1], b)
    met = ((a.max(axis=1) >= b.min(axis=1)) & (b.max(axis=1) >= a.min(axis=1))).all(axis=1)
    part, edges = a[met], b[met]
    steps = np.roll(edges, -1, axis=1) - edges
    for k in range(4):
        part = _cut(part, edges[:, k], steps[:, k])
    both = np.zeros(len(a))
    both[met] = np.abs(_areas(part)) / 2
    union = np.abs(_areas(a)) / 2 + np.abs(_areas(b)) / 2 - both
    return np.divide(both, union, out=np.zeros_like(both), where=union != 0)


#: Rectangles that are cut at a time.
CUT_ROWS = 1 << 13


def _overlap(rows: pd.DataFrame) -> pd.Series:
    out = np.empty(len(rows))
    numbers = rows.to_numpy("float64").reshape(-1, 2, 4, 2)
    for k in range(0, len(rows), CUT_ROWS):
        out[k : k + CUT_ROWS] = _overlaps(numbers[k : k + CUT_ROWS, 0], numbers[k : k + CUT_ROWS, 1])
    return pd.Series(np.where(np.isnan(out), 0.0, out))


def rotated_iou(pairs: DataFrame, a: str = "quad_a", b: str = "quad_b", out: str = "iou") -> DataFrame:
    """Overlap of pairs of rotated rectangles, given as arrays of four [x, y] corners that go round in either sense; 0 without areas.

    The first is cut by the four edges of the second, one after another, for a batch of pairs at a time.
    """
    numbers = (F.get(F.get(c, F.lit(k)), F.lit(i)).cast("double").alias(f"{s}{k}{i}") for s, c in (("a", a), ("b", b)) for k in range(4) for i in range(2))
    return pairs.withColumn(out, F.pandas_udf(_overlap, "double")(F.struct(*numbers)))


def roi_spread(points: Column) -> Column:
    """Diagonal of the bounding box of 21 [x, y] points; null for another number of points."""
    width, height = (F.array_max(v) - F.array_min(v) for v in (F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])))
    return F.when(F.size(points) == N_POINTS, F.hypot(width, height))


def flagged(detections: Column, threshold: float = 0.5) -> Column:
    """How many detections have a hand flag of at least the threshold."""
    return F.size(F.filter(detections, lambda d: F.coalesce(d["hand_flag_score"], F.lit(0.0)) >= threshold))


def collapsed(detections: Column, below: float = 0.10) -> Column:
    """How many detections have points that spread over less than `below`."""
    return F.size(F.filter(detections, lambda d: roi_spread(d["landmarks_roi_norm"]) < below))


def inference_summary(rows: DataFrame) -> DataFrame:
    """(image, error, detections) -> images, failed images, detections, hands (flag of 0.5 or more), collapsed detections and their mean spread."""
    found = F.coalesce("detections", F.array().cast(rows.schema["detections"].dataType))
    rows = rows.withColumn("_d", found)
    spreads = F.filter(F.transform("_d", lambda d: roi_spread(d["landmarks_roi_norm"])), lambda v: v.isNotNull() & ~F.isnan(v))
    rows = rows.select(F.size("_d").alias("n"), flagged(F.col("_d")).alias("h"), collapsed(F.col("_d")).alias("c"), F.size(spreads).alias("k"), F.aggregate(spreads, F.lit(0.0), lambda s, v: s + v).alias("s"), (F.coalesce("error", F.lit("")) != "").alias("e"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return rows.agg(F.count("*").alias("images"), F.count_if("e").alias("failed"), total("n").alias("detections"), total("h").alias("hands"), total("c").alias("collapsed"), (F.sum("s") / F.nullif(F.sum("k"), F.lit(0))).alias("mean_spread"))
