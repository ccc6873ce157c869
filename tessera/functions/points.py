"""Column expressions on keypoints: arrays of struct<id, x, y> sorted by id, and on boxes and rotated rectangles."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values
N_POINTS = 21
ROI_SIDE_PX = 255.0
#: Start and end point of the 20 bones.
BONES = (
    (0, 1), (1, 2), (2, 3), (3, 4),
    (0, 5), (5, 6), (6, 7), (7, 8),
    (0, 9), (9, 10), (10, 11), (11, 12),
    (0, 13), (13, 14), (14, 15), (15, 16),
    (0, 17), (17, 18), (18, 19), (19, 20),
)
#: Start and end point of the 20 lines that an edge length adds up.
EDGES = (
    (0, 1), (1, 2), (2, 3), (3, 4),
    (0, 5), (5, 6), (6, 7), (7, 8),
    (5, 9), (9, 10), (10, 11), (11, 12),
    (9, 13), (13, 14), (14, 15), (15, 16),
    (13, 17), (17, 18), (18, 19), (19, 20),
)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _pairs(pairs: tuple[tuple[int, int], ...]) -> Column:
    return F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs))


def canonical_points(points: Column) -> Column:
    """Points sorted by id if their ids are exactly 0 to 20, in any order; else null."""
    ids = F.array_sort(F.transform(points, lambda p: p["id"]))
    return F.when(ids == F.sequence(F.lit(0), F.lit(N_POINTS - 1)), F.array_sort(points, lambda a, b: a["id"] - b["id"]))


def has_duplicate_ids(points: Column) -> Column:
    return F.size(F.array_distinct(F.transform(points, lambda p: p["id"]))) < F.size(points)


def extent(points: Column, axis: str) -> Column:
    values = F.transform(points, lambda p: p[axis])
    return F.array_max(values) - F.array_min(values)


def diagonal(points: Column) -> Column:
    """Diagonal of the bounding box (the spread)."""
    return F.hypot(extent(points, "x"), extent(points, "y"))


def bbox_area(points: Column) -> Column:
    return extent(points, "x") * extent(points, "y")


def point_errors(expected: Column, predicted: Column) -> Column:
    return F.zip_with(expected, predicted, lambda a, b: F.hypot(b["x"] - a["x"], b["y"] - a["y"]))


def mean_error(expected: Column, predicted: Column) -> Column:
    return _sum(point_errors(expected, predicted)) / N_POINTS


def within(errors: Column, limit: Column | float) -> Column:
    """How many errors are at most the limit."""
    return F.size(F.filter(errors, lambda e: e <= limit))


def bone_vector_error(expected: Column, predicted: Column) -> Column:
    """Mean length of the difference of the 20 bone vectors."""

    def one(bone: Column) -> Column:
        a, b = bone["a"], bone["b"]
        return F.hypot((predicted[b]["x"] - predicted[a]["x"]) - (expected[b]["x"] - expected[a]["x"]), (predicted[b]["y"] - predicted[a]["y"]) - (expected[b]["y"] - expected[a]["y"]))

    return _sum(F.transform(_pairs(BONES), one)) / len(BONES)


def edge_length(points: Column) -> Column:
    return _sum(F.transform(_pairs(EDGES), lambda e: F.hypot(points[e["a"]]["x"] - points[e["b"]]["x"], points[e["a"]]["y"] - points[e["b"]]["y"])))


def skeleton_length(points: Column) -> Column:
    return _sum(F.transform(_pairs(BONES), lambda e: F.hypot(points[e["a"]]["x"] - points[e["b"]]["x"], points[e["a"]]["y"] - points[e["b"]]["y"])))


def palm_width(points: Column) -> Column:
    return F.hypot(points[5]["x"] - points[17]["x"], points[5]["y"] - points[17]["y"])


def out_of_range(points: Column, low: float = 0.0, high: float = 1.0) -> Column:
    """How many coordinates lie outside [low, high]."""
    return F.size(F.filter(F.flatten(F.transform(points, lambda p: F.array(p["x"], p["y"]))), lambda v: (v < low) | (v > high)))


def max_abs(points: Column) -> Column:
    return F.array_max(F.flatten(F.transform(points, lambda p: F.array(F.abs(p["x"]), F.abs(p["y"])))))


def disagreement(teacher: Column, student: Column, hand_flag: Column) -> dict[str, Column]:
    """Twelve measures of how far a student's points are from a teacher's; the scale is the palm width, 0.05 at least."""
    scale = F.greatest(palm_width(teacher), F.lit(0.05))
    errors = F.array_sort(point_errors(teacher, student))
    t_edge, s_edge = edge_length(teacher), edge_length(student)
    return {
        "mean_l2": _sum(errors) / N_POINTS,
        "mean_nme": _sum(errors) / N_POINTS / scale,
        "p90_nme": errors[math.ceil(0.9 * N_POINTS) - 1] / scale,
        "max_nme": errors[N_POINTS - 1] / scale,
        "teacher_palm_width": palm_width(teacher),
        "teacher_edge_length": t_edge,
        "student_edge_length": s_edge,
        "collapse_log_ratio": F.log(F.greatest(s_edge, F.lit(1e-8)) / F.greatest(t_edge, F.lit(1e-8))),
        "bone_vector_nme": bone_vector_error(teacher, student) / scale,
        "teacher_bbox_area": bbox_area(teacher),
        "student_bbox_area": bbox_area(student),
        "hand_flag_error": F.abs(1 - hand_flag),
    }


def normalise_angle(angle: Column) -> Column:
    """The angle in [-pi, pi)."""
    return angle - 2 * math.pi * F.floor((angle + math.pi) / (2 * math.pi))


def _axes(x: Column, y: Column, width: Column, height: Column, angle: Column) -> tuple[Column, ...]:
    """A turned rectangle as its centre and its two half axes: cx, cy, ux, uy, vx, vy."""
    c, s = F.cos(angle), F.sin(angle)
    return x, y, width / 2 * c, width / 2 * s, -height / 2 * s, height / 2 * c


def _quad_axes(quad: Column) -> tuple[Column, ...]:
    """The same of a parallelogram, given by its corners 0, 1 and 3."""
    return *((quad[1][k] + quad[3][k]) / 2 for k in (0, 1)), *((quad[1][k] - quad[0][k]) / 2 for k in (0, 1)), *((quad[3][k] - quad[0][k]) / 2 for k in (0, 1))


def _at(axes: tuple[Column, ...], a: Column | float, b: Column | float) -> tuple[Column, Column]:
    """The place a half axes along and b half axes across from the centre."""
    cx, cy, ux, uy, vx, vy = axes
    return cx + ux * a + vx * b, cy + uy * a + vy * b


def corners(rect: Column) -> Column:
    """The four corners of a struct (x_center, y_center, width, height, rotation_rad), as arrays [x, y]."""
    axes = _axes(*(rect[n] for n in ("x_center", "y_center", "width", "height", "rotation_rad")))
    return F.array(*(F.array(*_at(axes, a, b)) for a, b in ((-1, -1), (1, -1), (1, 1), (-1, 1))))


def roi_rect(box: Column, wrist: Column, middle: Column, image_width: Column, image_height: Column, scale: float = 1.8, shift: tuple[float, float] = (0.0, -0.1)) -> Column:
    """A square ROI around a palm box [x1, y1, x2, y2] cut at the image's border, turned so that wrist to middle finger points up.

    The centre moves by `shift` widths and heights of the box along the turned axes.
    """
    spans = []
    for k, size in ((0, image_width), (1, image_height)):
        low, high = (F.greatest(F.lit(0.0), F.least(size - 1.0, pick(box[k], box[k + 2]))) for pick in (F.least, F.greatest))
        spans.append(((low + high) / 2, F.greatest(high - low, F.lit(1.0))))
    (x, width), (y, height) = spans
    angle = normalise_angle(F.atan2(middle["y"] - wrist["y"], middle["x"] - wrist["x"]) + math.pi / 2)
    cx, cy = _at(_axes(x, y, width, height, angle), 2 * shift[0], 2 * shift[1])
    side = F.greatest(width, height) * scale
    return F.struct(cx.alias("x_center"), cy.alias("y_center"), side.alias("width"), side.alias("height"), angle.alias("rotation_rad"))


def _mapped(points: Column, place) -> Column:
    """Points moved by place(x, y) -> (x, y)."""

    def one(p: Column) -> Column:
        x, y = place(p["x"], p["y"])
        return F.struct(p["id"].alias("id"), x.alias("x"), y.alias("y"))

    return F.transform(points, one)


def project(points: Column, quad: Column) -> Column:
    """Points of the unit square on the parallelogram with corners 0, 1 and 3 of the quad."""
    return _mapped(points, lambda x, y: _at(_quad_axes(quad), 2 * x - 1, 2 * y - 1))


def unproject(points: Column, quad: Column) -> Column:
    """The inverse of project(), by the dual axes; null for a quad whose sides span no area."""
    cx, cy, ux, uy, vx, vy = _quad_axes(quad)
    area = 4 * (ux * vy - uy * vx)

    def place(x: Column, y: Column) -> tuple[Column, Column]:
        along, across = (x - cx) * vy - (y - cy) * vx, (y - cy) * ux - (x - cx) * uy
        return 0.5 + 2 * along / area, 0.5 + 2 * across / area

    return F.when(F.abs(area) >= 1e-12, _mapped(points, place))


def in_polygon(x: Column, y: Column, quad: Column, corners_n: int = 4, epsilon: float = 1e-6) -> Column:
    """Whether a point lies in a convex polygon of [x, y] corners; its border counts as inside.

    The point is on one side of all edges (products of edge and way to the point have one sign) and inside the bounding box,
    which matters for polygons without area.
    """
    ends = [(quad[k], quad[(k + 1) % corners_n]) for k in range(corners_n)]
    sides = [(b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0]) for a, b in ends]
    boxed = F.lit(True)
    for k, v in ((0, x), (1, y)):
        values = [a[k] for a, _ in ends]
        boxed = boxed & v.between(F.least(*values) - epsilon, F.greatest(*values) + epsilon)
    return boxed & ((F.least(*sides) >= -epsilon) | (F.greatest(*sides) <= epsilon))


def box_iou(a: Column, b: Column) -> Column:
    """Intersection over union of boxes (x1, y1, x2, y2), with 1e-6 added below."""
    w = F.greatest(F.lit(0.0), F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"]))
    h = F.greatest(F.lit(0.0), F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]))

    def area(p: Column) -> Column:
        return F.greatest(F.lit(0.0), p["x2"] - p["x1"]) * F.greatest(F.lit(0.0), p["y2"] - p["y1"])

    return w * h / (area(a) + area(b) - w * h + 1e-6)


def to_pixel(v: Column, size: Column) -> Column:
    """A unit coordinate as a pixel: scaled by size - 1, rounded half up."""
    return F.floor(v * (size - 1) + 0.5)


def pixel_convention(norm: Column, px: Column, limit: float = 0.08) -> Column:
    """Which scale, 255 or 256, explains pixel points from unit points best: struct(scale, error); scale is null above the limit."""

    def worst(scale: int) -> Column:
        return F.array_max(F.zip_with(norm, px, lambda a, b: F.greatest(F.abs(a["x"] * scale - b["x"]), F.abs(a["y"] * scale - b["y"]))))

    a, b = worst(255), worst(256)
    best = F.least(a, b)
    return F.struct(F.when(best <= limit, F.when(a <= b, 255).otherwise(256)).alias("scale"), best.alias("error"))


def decode_vector(vector: Column) -> Column:
    """21 points from 42 numbers x0, y0, x1, ...; null unless there are 42 finite ones."""
    ok = (F.size(vector) == 2 * N_POINTS) & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return F.when(ok, F.transform(F.sequence(F.lit(0), F.lit(N_POINTS - 1)), lambda i: F.struct(i.alias("id"), vector[2 * i].alias("x"), vector[2 * i + 1].alias("y"))))
