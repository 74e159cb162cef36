"""Picture kernels in numpy, as plain functions over arrays and as pandas UDFs over ``pixels BINARY, height, width``."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def laplacian_variance(a: np.ndarray, mask: np.ndarray | None = None) -> float:
    """Sharpness: population variance of the 4-neighbour Laplacian, inside ``mask`` if given; NaN without pixels."""
    p = np.pad(a.astype(np.float64), 1, mode="edge")
    v = p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]
    v = v if mask is None else v[mask]
    return float(v.var()) if v.size else float("nan")


def blur(a: np.ndarray, sigma: float) -> np.ndarray:
    """Separable Gaussian with repeated edges."""
    r = max(1, int(round(3 * sigma)))
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    k /= k.sum()
    out = a.astype(np.float64)
    for axis in (0, 1):
        pad = [(r, r) if i == axis else (0, 0) for i in range(2)]
        p = np.pad(out, pad, mode="edge")
        out = sum(w * np.take(p, range(i, i + a.shape[axis]), axis) for i, w in enumerate(k))
    return out


def high_frequency(a: np.ndarray, sigma: float = 2.0) -> np.ndarray:
    return a - blur(a, sigma)


def dilate(m: np.ndarray, r: int) -> np.ndarray:
    """Grow by r pixels in the eight directions, one at a time."""
    m = m.astype(bool)
    for _ in range(r):
        p = np.pad(m, 1)
        m = np.any([p[i : i + m.shape[0], j : j + m.shape[1]] for i in range(3) for j in range(3)], axis=0)
    return m


def erode(m: np.ndarray, r: int) -> np.ndarray:
    return ~dilate(~m.astype(bool), r)


def edge(m: np.ndarray) -> np.ndarray:
    """Pixels of the mask that touch its outside."""
    return m.astype(bool) & ~erode(np.pad(m.astype(bool), 1), 1)[1:-1, 1:-1]


def ring(m: np.ndarray, r: int) -> np.ndarray:
    return dilate(m, r) & ~erode(m, r)


def boundary_f(a: np.ndarray, b: np.ndarray, reach: int = 2) -> float:
    """F-score of edge pixels within ``reach``; NaN if a side has no edge."""
    ea, eb = edge(a), edge(b)
    if not ea.any() or not eb.any():
        return float("nan")
    p, r = (ea & dilate(eb, reach)).sum() / ea.sum(), (eb & dilate(ea, reach)).sum() / eb.sum()
    return float(2 * p * r / (p + r)) if p + r else 0.0


def mask_iou(a: np.ndarray, b: np.ndarray) -> float:
    return float((a & b).sum() / max(1, (a | b).sum()))


def ramp(m: np.ndarray, band: int) -> np.ndarray:
    """Soft alpha: the mask drawn in by half the band, then blurred over it."""
    return np.clip(blur(erode(m, band // 2).astype(float), max(0.5, band / 3)), 0, 1)


def one_sided_ramp(m: np.ndarray, band: int) -> np.ndarray:
    """Alpha that is one in the mask and falls outside only."""
    return np.maximum(m.astype(float), np.clip(blur(dilate(m, band // 2).astype(float), max(0.5, band / 3)), 0, 1))


def composite(base: np.ndarray, top: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    return (1 - alpha) * base + alpha * top


def layered(back: np.ndarray, subject: np.ndarray, alpha: np.ndarray, front: np.ndarray | None = None) -> np.ndarray:
    """Three layers: the subject over the background, and whatever is in front of it hides the subject.

    ``front`` is the share of the subject that is left at a pixel (1 where nothing stands before it).
    """
    a = alpha if front is None else alpha * front
    return composite(back, subject, a[..., None] if back.ndim == 3 else a)


def chroma(rgb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Red and blue differences of 8-bit RGB around 128, full range."""
    x = rgb.astype(np.float64)
    luma = 0.299 * x[..., 0] + 0.587 * x[..., 1] + 0.114 * x[..., 2]
    return (x[..., 0] - luma) * 0.713 + 128, (x[..., 2] - luma) * 0.564 + 128


def chroma_energy(frames: list[np.ndarray], masks: list[np.ndarray], least: int = 64) -> float:
    """Median over frames of the mean sharpness of both colour channels inside the mask; NaN without a mask of ``least`` pixels."""
    found = [np.mean([laplacian_variance(c, m) for c in chroma(f)]) for f, m in zip(frames, masks) if m.sum() >= least]
    return float(np.median(found)) if found else float("nan")


def shrink(a: np.ndarray, height: int = 96, width: int = 160) -> np.ndarray:
    """Bilinear resize with pixel centres aligned."""
    y = np.clip((np.arange(height) + 0.5) * a.shape[0] / height - 0.5, 0, a.shape[0] - 1)
    x = np.clip((np.arange(width) + 0.5) * a.shape[1] / width - 0.5, 0, a.shape[1] - 1)
    i, j = np.minimum(y.astype(int), max(0, a.shape[0] - 2)), np.minimum(x.astype(int), max(0, a.shape[1] - 2))
    u, v = (y - i)[:, None], (x - j)[None, :]
    p = a.astype(np.float64)
    i1, j1 = np.minimum(i + 1, a.shape[0] - 1), np.minimum(j + 1, a.shape[1] - 1)
    return (1 - u) * ((1 - v) * p[np.ix_(i, j)] + v * p[np.ix_(i, j1)]) + u * ((1 - v) * p[np.ix_(i1, j)] + v * p[np.ix_(i1, j1)])


def motion_and_texture(frames: list[np.ndarray], stride: int = 1) -> list[tuple[float, float]]:
    """Per sampled grey frame, at 160 x 96: mean difference to the one before (0 for the first), and sharpness."""
    out, last = [], None
    for a in frames[::stride]:
        small = shrink(a)
        out.append((0.0 if last is None else motion(small, last), laplacian_variance(small)))
        last = small
    return out


def motion(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.abs(a.astype(float) - b.astype(float)).mean())


def orientation_histogram(a: np.ndarray, bins: int = 16) -> np.ndarray:
    """Gradient orientations modulo pi, weighted by magnitude, summing to one (zeros if flat)."""
    gy, gx = np.gradient(a.astype(float))
    w = np.hypot(gx, gy)
    i = np.minimum((np.mod(np.arctan2(gy, gx), np.pi) / np.pi * bins).astype(int), bins - 1)
    h = np.bincount(i.ravel(), w.ravel(), bins)
    return h / h.sum() if h.sum() else h


def chi_square(a: np.ndarray, b: np.ndarray) -> float:
    return float(0.5 * ((a - b) ** 2 / (a + b + 1e-9)).sum())


def mean_hash(a: np.ndarray, side: int = 16) -> np.ndarray:
    """side*side bits: cells of the shrunk picture above their mean, as uint64 lanes."""
    ys, xs = np.linspace(0, a.shape[0], side + 1).astype(int), np.linspace(0, a.shape[1], side + 1).astype(int)
    cells = np.array([[a[y0 : max(y1, y0 + 1), x0 : max(x1, x0 + 1)].mean() for x0, x1 in zip(xs, xs[1:])] for y0, y1 in zip(ys, ys[1:])])
    return np.packbits((cells > cells.mean()).ravel()).view(np.uint64)


def components(m: np.ndarray) -> tuple[np.ndarray, int]:
    """Labels of 4-connected parts (0 outside) and their number."""
    lab = np.where(m, np.arange(1, m.size + 1).reshape(m.shape), 0)
    while True:
        p = np.pad(lab, 1)
        near = np.max([p[1:-1, 1:-1], p[:-2, 1:-1], p[2:, 1:-1], p[1:-1, :-2], p[1:-1, 2:]], axis=0)
        new = np.where(m, near, 0)
        if (new == lab).all():
            break
        lab = new
    names, flat = np.unique(lab, return_inverse=True)
    first = 0 if names[0] == 0 else 1
    return flat.reshape(m.shape) + first, len(names) - (1 - first)


def occluding_parts(m: np.ndarray, depth: np.ndarray, edge_depth: float, least: int = 16, nearer: float = 6.0) -> np.ndarray:
    """Parts of at least ``least`` pixels whose median depth lies ``nearer`` above the edge's."""
    lab, n = components(m)
    keep = [k for k in range(1, n + 1) if (lab == k).sum() >= least and np.median(depth[lab == k]) > edge_depth + nearer]
    return np.isin(lab, keep)


def select_classes(labels: np.ndarray, confidence: np.ndarray, wanted: list[int], protected: np.ndarray, least: float = 0.7, grow: int = 2) -> np.ndarray:
    return np.isin(labels, wanted) & (confidence >= least) & ~dilate(protected, grow)


def polarity(inside: float, outside: float, least: float = 1.8) -> str:
    """Whether the changed half is the masked one."""
    ratio = inside / (outside + 1e-6)
    return "as expected" if ratio >= least else "inverted" if ratio <= 1 / least else "undecided"


def crop_resize(a: np.ndarray, left: float, top: float, side: float, size: int) -> np.ndarray:
    """Bilinear crop of a square to size x size with repeated edges."""
    at = (np.arange(size) + 0.5) * side / size - 0.5
    y, x = np.clip(top + at, 0, a.shape[0] - 1), np.clip(left + at, 0, a.shape[1] - 1)
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    y1, x1 = np.minimum(y0 + 1, a.shape[0] - 1), np.minimum(x0 + 1, a.shape[1] - 1)
    fy, fx = (y - y0)[:, None], (x - x0)[None, :]
    a = a.astype(float)
    return (1 - fy) * ((1 - fx) * a[np.ix_(y0, x0)] + fx * a[np.ix_(y0, x1)]) + fy * ((1 - fx) * a[np.ix_(y1, x0)] + fx * a[np.ix_(y1, x1)])


def _decoded(pixels: pd.Series, height: pd.Series, width: pd.Series):
    for p, h, w in zip(pixels, height, width):
        yield None if p is None or h is None or len(p) != int(h) * int(w) else np.frombuffer(p, np.uint8).reshape(int(h), int(w))


@F.pandas_udf(T.DoubleType())
def sharpness(pixels: pd.Series, height: pd.Series, width: pd.Series) -> pd.Series:
    return pd.Series([None if a is None else laplacian_variance(a) for a in _decoded(pixels, height, width)], dtype="float64")


@F.pandas_udf(T.ArrayType(T.LongType()))
def picture_hash(pixels: pd.Series, height: pd.Series, width: pd.Series) -> pd.Series:
    return pd.Series([None if a is None else mean_hash(a).view(np.int64).tolist() for a in _decoded(pixels, height, width)])
