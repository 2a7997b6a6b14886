"""Boxes (left, bottom, right, top) as Column expressions.

A box is a struct column; every function is plain arithmetic and stays in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SAME_BASELINE = 0.35


def box(left: Column, bottom: Column, right: Column, top: Column) -> Column:
    return F.struct(left.cast("double").alias("left"), bottom.cast("double").alias("bottom"),
                    right.cast("double").alias("right"), top.cast("double").alias("top"))


def width(b: Column) -> Column:
    return b["right"] - b["left"]


def height(b: Column) -> Column:
    return b["top"] - b["bottom"]


def area(b: Column) -> Column:
    return width(b) * height(b)


def _overlap(a: Column, b: Column, low: str, high: str) -> Column:
    return F.greatest(F.lit(0.0), F.least(a[high], b[high]) - F.greatest(a[low], b[low]))


def shared_area(a: Column, b: Column) -> Column:
    return _overlap(a, b, "left", "right") * _overlap(a, b, "bottom", "top")


def same_baseline(a: Column, b: Column) -> Column:
    """Vertical overlap of at least 35 % of the lower box; true where a box is missing."""
    least = F.least(height(a), height(b))
    ratio = F.when(least > 0, _overlap(a, b, "bottom", "top") / least)
    return F.when(a.isNull() | b.isNull() | (least <= 0), True).otherwise(ratio >= SAME_BASELINE)


def horizontal_overlap(a: Column, b: Column) -> Column:
    """Shared width by the narrower box's width; 0 for boxes without width."""
    least = F.least(width(a), width(b))
    return F.when(least > 0, _overlap(a, b, "left", "right") / least).otherwise(0.0)


def overlap_fraction(subject: Column, other: Column) -> Column:
    """Shared area by the subject's area."""
    return F.when(area(subject) > 0, shared_area(subject, other) / area(subject)).otherwise(0.0)


def overlap_score(a: Column, b: Column) -> Column:
    """Shared area by the smaller area; boxes without area score 1 if equal, else 0."""
    least = F.least(area(a), area(b))
    return F.when(least > 0, shared_area(a, b) / least).otherwise((a == b).cast("double"))


def page_fraction(b: Column, page: Column) -> Column:
    """The box in fractions of the page, clipped to it; null for non-finite or empty ones."""
    def place(x, low, high):
        return F.least(F.lit(1.0), F.greatest(F.lit(0.0), (x - page[low]) / (page[high] - page[low])))

    sides = [b[s] for s in ("left", "bottom", "right", "top")]
    finite = ~(F.isnan(sides[0]) | F.isnan(sides[1]) | F.isnan(sides[2]) | F.isnan(sides[3]))
    for s in sides:
        finite = finite & (F.abs(s) < F.lit(float("inf")))
    out = box(place(b["left"], "left", "right"), place(b["bottom"], "bottom", "top"),
              place(b["right"], "left", "right"), place(b["top"], "bottom", "top"))
    return F.when(finite & (b["right"] >= b["left"]) & (b["top"] >= b["bottom"]), out)


def center_distance(a: Column, b: Column) -> Column:
    """Squared distance of the centres."""
    def mid(x, low, high):
        return (x[low] + x[high]) / 2

    dx = mid(a, "left", "right") - mid(b, "left", "right")
    dy = mid(a, "bottom", "top") - mid(b, "bottom", "top")
    return dx * dx + dy * dy


def nearest_anchor(position: Column, anchors: Column) -> Column:
    """Index (from 0) of the nearest of an array of positions, the lowest on ties."""
    gaps = F.transform(anchors, lambda a: F.abs(a - position))
    return (F.array_position(gaps, F.array_min(gaps)) - 1).cast("int")


def union(boxes: Column) -> Column:
    """Aggregate: the box around all boxes of a group."""
    return F.struct(F.min(boxes["left"]).alias("left"), F.min(boxes["bottom"]).alias("bottom"),
                    F.max(boxes["right"]).alias("right"), F.max(boxes["top"]).alias("top"))
