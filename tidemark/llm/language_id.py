"""Language identification: sparse multinomial logistic regression on character n-grams.

Text is lower-cased, everything but letters becomes one boundary mark, and 1- to
3-grams of code points are hashed into ``BUCKETS``.  Term frequencies are damped by a
logarithm, weighted by inverse document frequency (counted over *all* training
documents) and scaled to unit length.  Weights are learned by
follow-the-regularised-leader with L1 and L2 penalties, which leaves most of them at
exactly zero (only the others are kept), on a bounded sample per language
(``per_language`` documents, by hash of the id); a tenth of the sample is held back to
fit one softmax temperature.  Texts are counted by the block; a language is a class, and
more than ``most_languages`` of them are an error, as the model grows with their number.

Defined results: null text or text without a letter is ``und`` with score 0; with no
training document everything is ``und``; rows without a language are predicted but
not learned from; repeated rows are predicted each; an empty table gives an empty
result; columns other than id, text and language are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .io import documents

BUCKETS = 1 << 15
_MUL = np.int64(0x5851F42D4C957F2D)
_ALPHA: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _ALPHA
    if _ALPHA is None:
        _ALPHA = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _ALPHA


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-gram buckets of one text (ascending) and their counts; empty without letters."""
    none = np.zeros(0, np.int64)
    if not text:
        return none, none
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    c = np.where(_letters()[c], c, 0)
    if not c.any():
        return none, none
    c = np.concatenate([[0], c, [0]])
    c = c[(c != 0) | np.concatenate([[True], c[:-1] != 0])]  # one mark between words
    one = c[c != 0]
    two = c[:-1] * 0x110000 + c[1:]
    three = two[:-1] * 0x1F35 + c[2:] + (1 << 50)
    with np.errstate(over="ignore"):
        h = np.concatenate([one, two + (1 << 45), three]) * _MUL
    count = np.bincount(((h >> 40) & (BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
    at = np.flatnonzero(count)
    return at, count[at]


def weigh(at: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = (1 + np.log(count)) * idf[at]
    norm = np.sqrt((v * v).sum())
    return v / norm if norm else v


#: Texts, and characters unless one text is longer, that are counted in one go.
CHUNK_TEXTS, CHUNK_CHARS = 64, 1 << 18


@dataclass
class Counts:
    """Texts of a chunk as a sparse matrix: ``row`` and ``at`` (bucket) ascend, and ``count`` is not zero."""

    n: int
    row: np.ndarray
    at: np.ndarray
    count: np.ndarray


def chunk_counts(texts: list[str | None]) -> Iterator[Counts]:
    """Counts of all texts, some texts at a time; a text without letters has none.

    Letters are hashed for a chunk at once; each text is counted in a table of its own
    size, which stays in the processor's cache.
    """
    at = 0
    while at < len(texts):
        part, size = [], 0
        while at < len(texts) and len(part) < CHUNK_TEXTS and (not part or size + len(texts[at] or "") <= CHUNK_CHARS):
            size += len(texts[at] or "")
            part.append((texts[at] or "").lower())
            at += 1
        c = np.frombuffer(("\0" + "\0\0".join(part) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        c = np.where(_letters()[c], c, 0)
        first = np.concatenate([[0], np.cumsum([len(t) + 2 for t in part])])
        keep = c != 0
        keep[1:] |= c[:-1] != 0  # one mark between words
        keep[first[:-1]] = True
        first = np.concatenate([[0], np.cumsum(keep)])[first]
        c = c[keep]
        two = c[:-1] * 0x110000 + c[1:]
        with np.errstate(over="ignore"):
            named = [((g * _MUL) >> 40) & (BUCKETS - 1) for g in (c, two + (1 << 45), two[:-1] * 0x1F35 + c[2:] + (1 << 50))]
        letter = c != 0
        rows, ats, counts = [], [], []
        for i, (x, y) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
            own = letter[x:y]
            if not own.any():
                continue
            count = np.bincount(np.concatenate([named[0][x:y][own], named[1][x : y - 1], named[2][x : max(x, y - 2)]]), minlength=BUCKETS)
            some = np.flatnonzero(count)
            rows.append(np.full(len(some), i))
            ats.append(some)
            counts.append(count[some])
        z = [np.zeros(0, np.int64)]
        yield Counts(len(part), *(np.concatenate(z + v) for v in (rows, ats, counts)))


@dataclass
class Model:
    classes: list[str]
    idf: np.ndarray
    used: np.ndarray  # buckets in which some class has a weight
    weights: np.ndarray  # classes x used
    bias: np.ndarray
    temperature: float

    def logits(self, c: Counts) -> np.ndarray:
        """Texts x classes, before calibration."""
        v = (1 + np.log(c.count)) * self.idf[c.at]
        norm = np.sqrt(np.bincount(c.row, v * v, minlength=c.n))
        norm[norm == 0] = 1
        place = np.full(BUCKETS, -1)
        place[self.used] = np.arange(len(self.used))
        hit = place[c.at] >= 0
        row, at, v = c.row[hit], place[c.at[hit]], v[hit] / norm[c.row[hit]]
        return np.column_stack([np.bincount(row, v * w[at], minlength=c.n) for w in self.weights]) + self.bias

    def probabilities(self, c: Counts) -> np.ndarray:
        z = self.logits(c) / self.temperature
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def fit(samples: list[tuple[np.ndarray, np.ndarray, str]], idf: np.ndarray, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.05, l2: float = 0.05, passes: int = 3, seed: int = 1) -> Model:
    """FTRL-proximal with elastic net, one document at a time, then temperature by bisection."""
    classes = sorted({s[2] for s in samples})
    code = {c: i for i, c in enumerate(classes)}
    k = len(classes)
    order = np.random.default_rng(seed).permutation(len(samples))
    held = [samples[i] for i in order[: len(order) // 10]]
    learn = [samples[i] for i in order[len(order) // 10 :]]
    z, n = np.zeros((k, BUCKETS + 1)), np.zeros((k, BUCKETS + 1))

    def leader(at: np.ndarray) -> np.ndarray:
        zz = z[:, at]
        return np.where(np.abs(zz) <= l1, 0.0, -(zz - np.sign(zz) * l1) / ((beta + np.sqrt(n[:, at])) / alpha + l2))

    for _ in range(passes):
        for at, count, label in learn:
            at1, x = np.append(at, BUCKETS), np.append(weigh(at, count, idf), 1.0)
            w = leader(at1)
            s = w @ x
            p = np.exp(s - s.max())
            p /= p.sum()
            p[code[label]] -= 1
            g = np.outer(p, x)
            old = n[:, at1]
            new = old + g * g
            z[:, at1] += g - (np.sqrt(new) - np.sqrt(old)) / alpha * w
            n[:, at1] = new
    w = leader(np.arange(BUCKETS + 1))
    used = np.flatnonzero(w[:, :-1].any(0))
    model = Model(classes, idf, used, np.ascontiguousarray(w[:, used]), w[:, -1].copy(), 1.0)
    rows = [(w[:, at] @ weigh(at, c, idf) + model.bias, code[y]) for at, c, y in held]
    if rows:
        s, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])

        def slope(t: float) -> float:  # of the log loss by 1/t; it rises with 1/t
            p = np.exp((s - s.max(1, keepdims=True)) / t)
            p /= p.sum(1, keepdims=True)
            return float(((p * s).sum(1) - s[np.arange(len(y)), y]).sum())

        low, high = np.log(0.25), np.log(20.0)
        for _ in range(40):
            mid = (low + high) / 2
            low, high = (low, mid) if slope(np.exp(mid)) < 0 else (mid, high)
        model.temperature = float(np.exp((low + high) / 2))
    return model


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 400, most_languages: int = 256) -> Model | None:
    """A model of the languages in ``docs``; None if there is nothing to learn from.

    Document frequencies come from every row (one vector of counts per task leaves the
    executors).  The sample is bounded by ``per_language`` times ``most_languages``.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, total = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for c in chunk_counts(batch["text"].to_pylist()):
                df += np.bincount(c.at, minlength=BUCKETS)
                total += c.n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], total))], ["bucket", "df"])

    counted = rows.select("text").mapInArrow(frequencies, "bucket long, df long").groupBy("bucket").agg(F.sum("df").alias("df")).toPandas()
    df = np.zeros(BUCKETS)
    inside = counted[counted.bucket >= 0]
    df[inside.bucket.to_numpy()] = inside.df.to_numpy()
    total = int(counted.df[counted.bucket < 0].sum())
    if not total:
        return None
    idf = np.log((1 + total) / (1 + df)) + 1
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(most_languages + 1).collect()}
    if len(sizes) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    share = None  # of a language's rows that are taken, by hash of the id, with some room
    for lang, n in sizes.items():
        part = F.lit(min(1.0, 1.5 * per_language / n + 20.0 / n))
        share = F.when(F.col("lang") == lang, part) if share is None else share.when(F.col("lang") == lang, part)
    luck = F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1 << 30)) / float(1 << 30)
    picked = rows.withColumn("luck", luck).where(F.col("luck") < share)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [gram_counts(t.as_py()) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["id"], batch["lang"], batch["luck"], pa.array([g[0] for g in got], pa.list_(pa.int64())), pa.array([g[1] for g in got], pa.list_(pa.int64()))], ["id", "lang", "luck", "at", "count"])

    frame: pd.DataFrame = picked.mapInArrow(features, "id string, lang string, luck double, at array<long>, count array<long>").toPandas()
    frame = frame.sort_values(["lang", "luck", "id"]).groupby("lang").head(per_language)
    samples = [(np.asarray(a), np.asarray(c), y) for a, c, y in zip(frame["at"], frame["count"], frame["lang"]) if len(a)]
    return fit(samples, idf) if samples else None


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", lang_name: str = "lang_pred", score_name: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its calibrated probability.  Nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by languages and buckets

    @F.pandas_udf("lang string, score double")
    def guess(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        lang, score = np.full(len(texts), "und", object), np.zeros(len(texts))
        at = 0
        for c in chunk_counts(texts.tolist()) if m is not None else ():
            known = np.unique(c.row)
            if len(known):
                p = m.probabilities(c)[known]
                best = p.argmax(1)
                lang[at + known], score[at + known] = np.array(m.classes, object)[best], p[np.arange(len(known)), best]
            at += c.n
        return pd.DataFrame({"lang": lang, "score": score})

    cols = [c for c in docs.columns if c not in (lang_name, score_name)]
    return docs.select(*cols, guess(F.col(text_col)).alias("__guess")).select(*cols, F.col("__guess.lang").alias(lang_name), F.col("__guess.score").alias(score_name))


def held_out(id_col: str, folds: int, fold: int) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds)) == fold


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    docs = docs.withColumn("held_out", F.coalesce(held_out("doc_id", 3, 1), F.lit(False)))
    model = train(docs.where(~F.col("held_out")))
    return predict(docs.select("doc_id", "held_out", "text"), model).drop("text")
