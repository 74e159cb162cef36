"""Boxes (x0, y0, x1, y1): areas, overlaps, containment, crops, suppression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .series import fold


def clip(x: Column, low, high) -> Column:
    return F.least(F.greatest(x, F.lit(low) if not isinstance(low, Column) else low), F.lit(high) if not isinstance(high, Column) else high)


def area(p: str = "") -> Column:
    return F.greatest(F.lit(0.0), F.col(p + "x1") - F.col(p + "x0")) * F.greatest(F.lit(0.0), F.col(p + "y1") - F.col(p + "y0"))


def intersection(p: str, q: str) -> Column:
    w = F.least(F.col(p + "x1"), F.col(q + "x1")) - F.greatest(F.col(p + "x0"), F.col(q + "x0"))
    h = F.least(F.col(p + "y1"), F.col(q + "y1")) - F.greatest(F.col(p + "y0"), F.col(q + "y0"))
    return F.greatest(F.lit(0.0), w) * F.greatest(F.lit(0.0), h)


def iou(p: str, q: str) -> Column:
    both = intersection(p, q)
    return F.try_divide(both, area(p) + area(q) - both)


def contains(p: str, x: Column, y: Column) -> Column:
    return (F.col(p + "x0") <= x) & (x <= F.col(p + "x1")) & (F.col(p + "y0") <= y) & (y <= F.col(p + "y1"))


def smallest_container(points: DataFrame, boxes: DataFrame, keys: Sequence[str], point: str, box: str) -> DataFrame:
    """Each point (px, py) with the smallest box of its group that holds it, or null."""
    met = points.join(boxes, list(keys)).where(contains("", F.col("px"), F.col("py")))
    best = met.groupBy(*keys, point).agg(F.min_by(box, F.struct(area(), box)).alias(box))
    return points.select(*keys, point).join(best, [*keys, point], "left")


def suppress(df: DataFrame, keys: Sequence[str], box: str, limit: float = 0.55) -> DataFrame:
    """Greedy non-maximum suppression by score (then id) in each group; the state is the kept boxes."""

    def step(kept, cols):
        kept = kept or []
        out = []
        for name, x0, y0, x1, y1 in zip(*cols):
            a = max(0.0, x1 - x0) * max(0.0, y1 - y0)
            for k in kept:
                both = max(0.0, min(x1, k[2]) - max(x0, k[0])) * max(0.0, min(y1, k[3]) - max(y0, k[1]))
                whole = a + k[4] - both
                if whole > 0 and both / whole > limit:
                    break
            else:
                kept.append((x0, y0, x1, y1, a))
                out.append(name)
        return kept, [out]

    return fold(df.withColumn("__rank", -F.col("score")), keys, ["__rank", box], step, [box, "x0", "y0", "x1", "y1"], f"`{box}` {dict(df.dtypes)[box]}")


def square_crop(width: Column, height: Column, margin: float, lift: float, least: int) -> Column:
    """A square around the box, lifted by a share of its size, kept inside the picture; null if too small."""
    cx, cy = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    side = F.least(F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) * margin, width, height)
    left, top = clip(cx - side / 2, 0.0, width - side), clip(cy - side * lift - side / 2, 0.0, height - side)
    return F.when(side >= least, F.struct(left.alias("left"), top.alias("top"), side.alias("side")))


def cover_crop(width: Column, height: Column, aspect: float, pad: float = 0.06) -> Column:
    """The padded box, widened to ``aspect`` (width over height), shifted inside the picture."""
    w, h = (F.col("x1") - F.col("x0")) * (1 + 2 * pad), (F.col("y1") - F.col("y0")) * (1 + 2 * pad)
    w2, h2 = F.least(F.greatest(w, h * aspect), width), F.least(F.greatest(h, w / aspect), height)
    cx, cy = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    return F.struct(clip(cx - w2 / 2, 0.0, width - w2).alias("left"), clip(cy - h2 / 2, 0.0, height - h2).alias("top"), w2.alias("width"), h2.alias("height"))


def panels(n: Column, width: float, height: float) -> Column:
    """Places of 1, 2 or 3 and more pictures on a sheet."""
    one = lambda x, y, w, h: F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.lit(w).alias("w"), F.lit(h).alias("h"))
    half, low = width / 2, height / 2
    return F.when(n <= 1, F.array(one(0.0, 0.0, width, height))).when(n == 2, F.array(one(0.0, 0.0, half, height), one(half, 0.0, half, height))).otherwise(F.array(one(0.0, 0.0, half, height), one(half, 0.0, half, low), one(half, low, half, low)))


def place_back(x: Column, y: Column, crop_left: Column, crop_top: Column, crop_side: Column, size: float) -> Column:
    """A point of a resized crop in the whole picture."""
    return F.struct((crop_left + x * crop_side / size).alias("x"), (crop_top + y * crop_side / size).alias("y"))


def orientation(points: Column) -> Column:
    """Signed place of the third point along the first two's axis, in -1..1; null if undefined."""
    a, b, c = points[0], points[1], points[2]
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    span = F.sqrt(dx * dx + dy * dy)
    mx, my = (a["x"] + b["x"]) / 2, (a["y"] + b["y"]) / 2
    side = ((c["x"] - mx) * dx + (c["y"] - my) * dy) / (span * span)
    return F.when((F.size(points) >= 3) & (span >= 1e-3), clip(2 * side, -1.0, 1.0))
