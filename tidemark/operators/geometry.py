"""Picture geometry as column expressions: fits, targets, crops, grids, and the plan of a moving crop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .intervals import to_sixteen


def whole(x: Column) -> Column:
    """Rounded half to even."""
    return F.bround(x, 0).cast("long")


def fit(width: Column, height: Column, sar: Column, to_width: Column, to_height: Column) -> Column:
    """One scale for both axes, even sizes, equal padding; nothing is distorted."""
    shown = width * sar
    scale = F.least(to_width / shown, to_height / height)
    w, h = whole(shown * scale), whole(height * scale)
    w, h = w - w % 2, h - h % 2
    return F.struct(w.alias("scale_w"), h.alias("scale_h"), F.floor((to_width - w) / 2).alias("pad_x"), F.floor((to_height - h) / 2).alias("pad_y"), scale.alias("scale"), (1 - w * h / (to_width * to_height)).alias("pad_fraction"))


def matching_target(width: Column, height: Column, sar: Column, to_width: Column, to_height: Column) -> Column:
    """Sizes of the source's aspect in multiples of 16 with about the given number of pixels."""
    ratio = width * sar / height
    h = to_sixteen(whole(F.sqrt(to_width * to_height / ratio)).cast("double"))
    return F.struct(to_sixteen(whole(h * ratio).cast("double")).alias("width"), h.alias("height"))


def short_edge(width: Column, height: Column, wanted: Column) -> Column:
    """Even sizes at which the shorter edge is ``wanted``; never smaller than they are."""
    scale = F.greatest(F.lit(1.0), wanted / F.least(width, height))
    return F.struct((whole(width * scale / 2) * 2).alias("width"), (whole(height * scale / 2) * 2).alias("height"))


def bucket_view(width: Column, height: Column, bucket: Column) -> Column:
    """The shorter edge at ``bucket``, then the square in the middle: sizes, and where the square is."""
    s = bucket / F.least(width, height)
    w, h = F.greatest(F.lit(1), whole(width * s)), F.greatest(F.lit(1), whole(height * s))
    return F.struct(w.alias("width"), h.alias("height"), F.floor((w - bucket) / 2).alias("left"), F.floor((h - bucket) / 2).alias("top"))


def span_crop(points: Column, width: Column, height: Column, wanted: Column, margin: float = 2.6, least: int = 16) -> Column:
    """A square of ``margin`` spans to each side of the first two points' middle, cut to the picture, and the
    sizes at which their distance is ``wanted``; null if the span is 1 or less, or the square too small."""
    a, b = points[0], points[1]
    span = F.sqrt((a["x"] - b["x"]) * (a["x"] - b["x"]) + (a["y"] - b["y"]) * (a["y"] - b["y"]))
    cx, cy, half = (a["x"] + b["x"]) / 2, (a["y"] + b["y"]) / 2, span * margin
    left, top = F.greatest(F.lit(0), whole(cx - half)), F.greatest(F.lit(0), whole(cy - half))
    right, bottom = F.least(width, whole(cx + half)), F.least(height, whole(cy + half))
    factor = wanted / span
    sized = lambda n: F.greatest(F.lit(least), whole(n * factor))
    good = (F.size(points) >= 2) & (span > 1) & (right - left >= least) & (bottom - top >= least) & (factor > 0)
    return F.when(good, F.struct(left.alias("left"), top.alias("top"), right.alias("right"), bottom.alias("bottom"), sized(right - left).alias("width"), sized(bottom - top).alias("height"), factor.alias("factor")))


def grid_columns(n: Column, most: int = 4) -> Column:
    """The largest divisor of ``n`` from 2 to ``most``; ``n`` itself if there is none."""
    out = n
    for c in range(2, most + 1):
        out = F.when((n >= c) & (n % c == 0), F.lit(c)).otherwise(out)
    return out


def view_of(box: Column, anchor: Column, height: Column) -> Column:
    """detail, anchor, full_extent or upper_extent, by how a box and the anchor inside it fill the picture."""
    w, h = box["x1"] - box["x0"], box["y1"] - box["y0"]
    return (
        F.when(box.isNull(), "detail")
        .when(anchor.isNotNull() & ((anchor["y1"] - anchor["y0"]) / F.greatest(h, F.lit(1)) > 0.45), "anchor")
        .when((h / height > 0.80) & (h / F.greatest(w, F.lit(1)) > 1.7), "full_extent")
        .when(h / height > 0.55, "upper_extent")
        .otherwise("detail")
    )


def needs_user(confidence: Column, margin: Column, evidence: Column, accept: float = 0.42, ambiguous: float = 0.08) -> Column:
    """Why a match has to be looked at, or null: no evidence, then low confidence, then two alike."""
    doubtful = (confidence < accept) | (margin < ambiguous) | (evidence == 0)
    return F.when(doubtful, F.when(evidence == 0, "no match evidence").when(confidence < accept, "low confidence").otherwise("ambiguous"))


def crop_plan(boxes: DataFrame, keys: Sequence[str], width: Column, height: Column, out_width: Column, out_height: Column, fraction: float = 0.78, margin: float = 0.25, at: float = 0.9, keep: float = 0.95) -> DataFrame:
    """crop_w, crop_h (even) per series of boxes (x0, y0, x1, y1): one size for all frames.

    The box's ``at`` percentile on either axis is to fill ``fraction`` of the crop, the
    ``keep`` percentile with its margin has to fit, and the crop stays inside the frame.
    Sizes are columns of the group's keys or literals.
    """
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    p = lambda c, q: F.percentile(c, F.lit(q))
    g = boxes.groupBy(*keys).agg(p(h, at).alias("__h"), p(w, at).alias("__w"), p(h * (1 + margin), keep).alias("__nh"), p(w * (1 + margin), keep).alias("__nw"))
    tall = F.greatest(F.col("__h") / max(fraction, 1e-3), F.col("__w") / max(fraction, 1e-3) * (out_height / out_width), F.col("__nh"), F.col("__nw") * (out_height / out_width))
    g = g.withColumn("__ch", tall).withColumn("__cw", F.col("__ch") * (out_width / out_height))
    k = F.when((F.col("__cw") > width) | (F.col("__ch") > height), F.least(width / F.col("__cw"), height / F.col("__ch"))).otherwise(F.lit(1.0))
    return g.withColumn("__k", k).select(*keys, (whole(F.col("__cw") * F.col("__k") / 2) * 2).alias("crop_w"), (whole(F.col("__ch") * F.col("__k") / 2) * 2).alias("crop_h"))
