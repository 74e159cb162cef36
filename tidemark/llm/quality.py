"""Quality classifier: regularised quadratic discriminant analysis.

Each text becomes a handful of transformed statistics (logs and logits of shares).
Spark sums up over *all* labelled rows, first the means of the classes and the pooled
spread of each statistic, then, around the class means and in units of that spread, the
covariances.  Each covariance is shrunk towards a multiple of the identity (Ledoit and
Wolf's intensity, and at least ``least_shrinkage``).  The score is the logistic of the
difference of the classes' Gaussian log densities plus the log of the class prior;
each density is a Mahalanobis distance by a Cholesky factor that is taken and inverted
once.

Defined results: null text is empty text, which is scored like any other; unlabelled
rows are scored only; with one class or none every score is that class's share (0.5
without labels); repeated rows are scored each and repeated labels count each; an
empty table gives an empty result; columns other than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .host_rules import signals
from .io import cut, documents, table

_UPPER, _DIGIT, _PUNCT, _ALPHA, _STOP = (np.zeros(256, bool) for _ in range(5))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_STOP[list(b".!?")] = True
_PUNCT[list(b"!\"#$%&'()*+-/:;<=>?@[\\]^_`{|}~")] = True
_ALPHA[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
FEATURES = ("word_length", "word_spread", "line_words", "upper", "digits", "punctuation", "stops", "repeated_words", "repeated_lines", "distinct_words", "top_word")


#: What is assumed of ordinary text before any is seen: the share, and the number of units that this counts for.
#: Short texts stay near it, so that they are judged by evidence and not by noise.  The shares are round figures
#: chosen for running prose, not fitted; with a few hundred words they hardly matter.
ORDINARY = {"upper": (0.03, 100), "digits": (0.003, 100), "punctuation": (0.004, 100), "stops": (0.013, 100), "repeated_words": (0.01, 30), "repeated_lines": (0.01, 5), "top_word": (0.06, 30), "distinct_words": (0.8, 30)}


def _logit(name: str, part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    share, units = ORDINARY[name]
    return np.log((part + share * units) / (whole - part + (1 - share) * units))


def statistics(b: K.Block) -> np.ndarray:
    """One row of transformed statistics per document."""
    s = signals(b)
    start, end, first = b.words()
    n = np.diff(first).astype(float)
    size = np.diff(b.off).astype(float)

    def count(which: np.ndarray) -> np.ndarray:
        c = np.concatenate([[0], np.cumsum(which[b.data])])
        return (c[b.off[1:]] - c[b.off[:-1]]).astype(float)

    alpha = count(_ALPHA)
    doc = b.doc_of(first)
    word = K.mix(b.lowered().hashes(start, end) ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    often, later = K.repeats(word)
    distinct = np.bincount(doc[~later], minlength=b.n).astype(float)
    top = np.zeros(b.n)
    np.maximum.at(top, doc, often)
    width = (end - start).astype(float)
    mean = K.per_doc(width, first) / n.clip(1)
    spread = np.sqrt((K.per_doc(width * width, first) / n.clip(1) - mean * mean).clip(0))
    lines = np.diff(b.lines()[2]).astype(float)
    top = np.minimum(top, n)
    return np.column_stack([
        np.log((K.per_doc(width, first) + 200) / (n + 30)), np.log(spread * n / (n + 30) + 1), np.log((n + 30) / (lines + 1)),
        _logit("upper", count(_UPPER), alpha), _logit("digits", count(_DIGIT), size), _logit("punctuation", count(_PUNCT), size), _logit("stops", count(_STOP), size),
        _logit("repeated_words", s["n_repeat_words"].astype(float), n), _logit("repeated_lines", s["n_dup_lines"].astype(float), lines),
        _logit("distinct_words", distinct, n), _logit("top_word", top, n),
    ])


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and the statistics as an array."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [statistics(b) for b in K.blocks(batch["text"])]
            if parts:
                yield pa.RecordBatch.from_arrays([batch["id"], pa.array(list(np.concatenate(parts)), pa.list_(pa.float64()))], ["id", "x"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, x array<double>")


@dataclass
class Model:
    means: np.ndarray  # 2 x features
    scale: np.ndarray  # of each feature
    factors: np.ndarray  # inverse Cholesky factors of the shrunk covariances of the scaled features
    priors: np.ndarray
    shares: tuple[float, float] = (0.0, 0.0)  # how far each covariance was shrunk
    constant: float | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        logs = []
        for mean, inverse, prior in zip(self.means, self.factors, self.priors):
            z = inverse @ ((x - mean) / self.scale).T
            logs.append(np.log(prior) + np.log(np.diag(inverse)).sum() - 0.5 * (z * z).sum(0))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def _totals(rows: DataFrame, size: int, of: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of a vector that ``of`` makes of a batch's statistics and labels."""
    d = len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += of(batch["x"].flatten().to_numpy().reshape(-1, d), batch["label"].to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["i", "v"])

    got = rows.mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros(size)
    out[got["i"].to_numpy()] = got["v"].to_numpy()
    return out


def fit(labelled: DataFrame, least_shrinkage: float = 0.02) -> Model:
    """``labelled``: x array<double>, label 0 or 1.

    Every row counts.  Each task sums its own moments (a few hundred numbers a class),
    so neither rows nor classes meet in one place.  The rows are read twice.
    """
    d = len(FEATURES)
    rows = labelled.select("x", F.col("label").cast("int").alias("label")).where("label IN (0, 1)")

    def first(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        parts = [x[y == k] for k in (0, 1)]
        return np.concatenate([[len(v) for v in parts], *(v.sum(0) for v in parts), (x * x).sum(0)])

    flat = _totals(rows, 2 + 3 * d, first)
    n, s = flat[:2], flat[2 : 2 + 2 * d].reshape(2, d)
    if (n < 2).any():
        return Model(s, np.ones(d), s, n, constant=0.5 if not n.sum() else float(n[1] / n.sum()))
    means = s / n[:, None]
    spread = np.sqrt((flat[2 + 2 * d :] / n.sum() - (s.sum(0) / n.sum()) ** 2).clip(0))
    scale = np.where(spread > 1e-9, spread, 1.0)

    def second(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        parts = [(x[y == k] - means[k]) / scale for k in (0, 1)]
        return np.concatenate([*((v.T @ v).ravel() for v in parts), [((v * v).sum(1) ** 2).sum() for v in parts]])

    flat = _totals(rows, 2 * d * d + 2, second)
    factors, shares = [], []
    for k in (0, 1):
        cov = flat[k * d * d : (k + 1) * d * d].reshape(d, d) / n[k]
        level = np.trace(cov) / d
        away = ((cov - level * np.eye(d)) ** 2).sum()
        noise = max(0.0, flat[k - 2] / n[k] - (cov * cov).sum()) / n[k]  # expected squared error of the covariance
        share = min(1.0, max(least_shrinkage, noise / away if away > 0 else 1.0))
        factors.append(np.linalg.inv(np.linalg.cholesky((1 - share) * cov + (share * level + 1e-6) * np.eye(d))))
        shares.append(share)
    return Model(means, scale, np.array(factors), n / n.sum(), tuple(shares))


def score(measured: DataFrame, model: Model, cut_at: float = 0.7) -> DataFrame:
    """``measured`` with score and predicted in place of x.  Nothing is shuffled."""
    shared = measured.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(x: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(np.stack(x.to_numpy())) if len(x) else np.zeros(0))

    return measured.withColumn("score", run("x")).withColumn("predicted", (F.col("score") >= cut_at).cast("int")).drop("x")


def op1_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir, "doc_id", "text"), table(spark, sf_dir, "labels")
    rows = cut(measure(docs))
    out = F.coalesce(F.pmod(F.crc32(F.col("id").cast("string")), F.lit(4)) == 2, F.lit(False))
    rows = rows.withColumn("held_out", out)
    learn = cut(rows.where(~F.col("held_out")).join(labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("label")), "id").select("x", "label"))
    return score(rows, fit(learn)).select(F.col("id").alias("doc_id"), "held_out", "score", "predicted")
