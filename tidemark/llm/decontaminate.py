"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters and digits, lower-cased.  The corpus is counted once for
every n-gram of the test items; in each window of ``span`` neighbouring n-grams an
item keeps the rarest as a seed, so any ``n + span - 1`` words taken over unchanged
hold one, however frequent the item is in the corpus.  A seed found in a document
marks the passage around it, passages of one item that overlap are joined, and the
item is aligned to each passage word by word (match 1, mismatch and gap -1).  A
document is contaminated by an item whose best alignment scores at least
``least_score`` of the item's own length.

Test items are a query set: they go to the executors in blocks of at most
``block_words`` words, one pass over the documents a block, so what is broadcast has
a fixed bound.  Documents are never shuffled, and verdicts stay with their rows, so no
id is needed to bring them together.

Defined results: null and empty texts are clean; items of fewer than ``n`` words are
too short to recognise and match nothing; equal items are scored each; repeated rows, rows
that share an id and rows with a null id are judged each; rows of one item id count as one
item; empty tables give clean documents or an empty result; columns other than ids and
texts are ignored by ``judge`` and passed through by ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernel as K
from .io import documents, table

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def word_hashes(b: K.Block) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of a block's words and the per-document first index; A-Z and the capitals of Latin-1 count as small."""
    data = K.LOWER[b.data]
    if len(data):
        capital = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        data[capital] += 0x20
    low = K.Block(data, b.off, b.rows)
    start, end, first = low.runs(_WORD[data])
    return low.hashes(start, end), first


class Items:
    """A block of test items: words, n-grams, seeds."""

    def __init__(self, ids: list, texts: list[str | None], n: int):
        parts = [word_hashes(b) for b in K.blocks(pa.array(texts, pa.large_string()), 1 << 40)] or [(np.zeros(0, np.uint64), np.zeros(1, np.int64))]
        (self.words, self.first), self.ids, self.n = parts[0], ids, n
        self.grams, self.gfirst = K.shingles(self.words, self.first, n, whole=False)
        self.all = np.unique(self.grams)
        self.seeds = self.all
        self.places: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def choose(self, frequency: np.ndarray, span: int) -> None:
        """Keep, in each window of ``span`` n-grams, the one that is rarest in the corpus (the first of equals)."""
        f = frequency[np.searchsorted(self.all, self.grams)]
        take = np.zeros(len(f), bool)
        for a, z in zip(self.gfirst[:-1], self.gfirst[1:]):
            for i in range(a, max(a + 1, z - span + 1) if z > a else a):
                take[i + int(np.argmin(f[i : min(i + span, z)]))] = True
        at = np.flatnonzero(take)
        item = np.searchsorted(self.gfirst, at, "right") - 1
        order = np.argsort(self.grams[at], kind="stable")
        at, item = at[order], item[order]
        self.seeds, start = np.unique(self.grams[at], return_index=True)
        self.places = (np.append(start, len(at)), item, at - self.gfirst[item])


def _found(gram: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``gram`` that are in sorted ``wanted``, and where there."""
    if not len(wanted) or not len(gram):
        z = np.zeros(0, np.int64)
        return z, z
    sieve = np.zeros(1 << 18, bool)
    sieve[wanted >> np.uint64(46)] = True
    at = np.flatnonzero(sieve[gram >> np.uint64(46)])
    i = np.minimum(np.searchsorted(wanted, gram[at]), len(wanted) - 1)
    good = wanted[i] == gram[at]
    return at[good], i[good]


def align(item: np.ndarray, passages: np.ndarray) -> np.ndarray:
    """Best local alignment score of an item's words with each row of ``passages``."""
    m, width = passages.shape
    score, best = np.zeros((m, width + 1), np.int32), np.zeros(m, np.int32)
    ramp = np.arange(width + 1, dtype=np.int32)
    for w in item:
        step = np.where(passages == w, 1, -1).astype(np.int32)
        base = np.zeros_like(score)
        base[:, 1:] = np.maximum(0, np.maximum(score[:, :-1] + step, score[:, 1:] - 1))
        score = np.maximum.accumulate(base + ramp, axis=1) - ramp
        np.maximum(best, score.max(1), out=best)
    return best


def scan(b: K.Block, items: Items, least_score: float) -> list[tuple[int, int, float]]:
    """(document, item, score) of a block's matches."""
    word, first = word_hashes(b)
    gram, gfirst = K.shingles(word, first, items.n, whole=False)
    at, seed = _found(gram, items.seeds)
    if not len(at):
        return []
    start, item_of, place = items.places
    many = start[seed + 1] - start[seed]
    k = np.repeat(start[seed], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    at = np.repeat(at, many)
    doc = np.searchsorted(gfirst, at, "right") - 1
    pos = at - gfirst[doc] + first[doc]
    item, off = item_of[k], place[k]
    size = np.diff(items.first)[item]
    slack = size // 4 + 3
    lo = np.maximum(first[doc], pos - off - slack)
    hi = np.minimum(first[doc + 1], pos - off + size + slack)
    order = np.lexsort((lo, doc, item))
    doc, item, lo, hi = doc[order], item[order], lo[order], hi[order]
    new = np.ones(len(doc), bool)
    same = (doc[1:] == doc[:-1]) & (item[1:] == item[:-1])
    new[1:] = ~(same & (lo[1:] <= hi[:-1]))  # passages of one item and document rise together
    head = np.flatnonzero(new)
    lo, hi = lo[head], np.maximum.reduceat(hi, head)
    doc, item = doc[head], item[head]
    out = []
    edge = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]])).tolist() + [len(item)]
    for a, z in zip(edge[:-1], edge[1:]):
        own = items.words[items.first[item[a]] : items.first[item[a] + 1]]
        width = hi[a:z] - lo[a:z]
        by_width = a + np.argsort(width, kind="stable")
        for c in np.array_split(by_width, max(1, -(-int(width.sum()) // (1 << 16)))):
            if not len(c):
                continue
            w = int((hi[c] - lo[c]).max())
            grid = np.arange(w)[None, :] + lo[c][:, None]
            inside = grid < hi[c][:, None]
            rows = np.where(inside, word[np.minimum(grid, len(word) - 1)], np.uint64(0))
            score = align(own, rows) / len(own)
            out += [(int(doc[i]), int(item[i]), float(s)) for i, s in zip(c, score) if s >= least_score]
    return out


def _item_blocks(docs: DataFrame, bench: DataFrame, text_col: str, item_col: str, item_text: str, n: int, span: int, block_words: int) -> Iterator[Broadcast]:
    """The test items in blocks, with the seeds that are rarest in ``docs``, on every executor."""
    spark = docs.sparkSession
    rows = docs.select(F.col(text_col).alias("text"))
    items_in = bench.select(F.col(item_col).cast("long").alias("item"), F.col(item_text).alias("text")).where("text IS NOT NULL")
    total = items_in.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] // 2
    blocks = int(total // block_words) + 1
    for i in range(blocks):
        got = items_in.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == i).orderBy("item", "text").collect()
        if not got:
            continue
        items = Items([r["item"] for r in got], [r["text"] for r in got], n)
        wanted = spark.sparkContext.broadcast(items.all)

        def count(batches: Iterator[pa.RecordBatch], wanted=wanted) -> Iterator[pa.RecordBatch]:
            seen = np.zeros(len(wanted.value), np.int64)
            for batch in batches:
                for b in K.blocks(batch["text"]):
                    word, first = word_hashes(b)
                    gram, _ = K.shingles(word, first, n, whole=False)
                    seen += np.bincount(_found(gram, wanted.value)[1], minlength=len(seen))
            at = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["i", "n"])

        counted = rows.mapInArrow(count, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toPandas()
        frequency = np.zeros(len(items.all), np.int64)
        frequency[counted["i"].to_numpy()] = counted["n"].to_numpy()
        items.choose(frequency, span)
        yield spark.sparkContext.broadcast(items)


def _best(b: K.Block, items: Items, least_score: float) -> dict[tuple[int, int], float]:
    """The best score of each (document, item) of a block that match."""
    best: dict[tuple[int, int], float] = {}
    for d, k, s in scan(b, items, least_score):
        best[d, k] = max(s, best.get((d, k), 0.0))
    return best


def matches(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", n: int = 3, span: int = 4, least_score: float = 0.5, block_words: int = 1 << 20) -> DataFrame:
    """id, item_id, score: the best alignment of each document and each item it is contaminated by."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("item_id", T.LongType()), T.StructField("score", T.DoubleType())])
    out = docs.sparkSession.createDataFrame([], schema)
    for shared in _item_blocks(docs, bench, text_col, item_col, item_text, n, span, block_words):

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for b in K.blocks(batch["text"], K.BLOCK_BYTES):
                    best = _best(b, shared.value, least_score)
                    if best:
                        doc = pa.array([b.rows.start + d for d, _ in best])
                        yield pa.RecordBatch.from_arrays([batch["id"].take(doc), pa.array([shared.value.ids[k] for _, k in best], pa.int64()), pa.array(list(best.values()))], ["id", "item_id", "score"])

        out = out.union(rows.mapInArrow(search, schema))
    return out.withColumnRenamed("id", id_col)


def judge(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", n: int = 3, span: int = 4, least_score: float = 0.5, block_words: int = 1 << 20) -> DataFrame:
    """One row per document: id, contaminated, n_items, best_item (the smallest of equals), best_score."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.lit(0).cast("long").alias("n_items"), F.lit(None).cast("long").alias("best_item"), F.lit(0.0).alias("best_score"))
    for shared in _item_blocks(docs, bench, text_col, item_col, item_text, n, span, block_words):

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                count, item, score = (batch[c].to_pylist() for c in ("n_items", "best_item", "best_score"))
                for b in K.blocks(batch["text"], K.BLOCK_BYTES):
                    by_doc: dict[int, dict] = {}
                    for (d, k), s in _best(b, shared.value, least_score).items():
                        own, name = by_doc.setdefault(b.rows.start + d, {}), shared.value.ids[k]
                        own[name] = max(s, own.get(name, 0.0))
                    for d, own in by_doc.items():
                        count[d] += len(own)
                        for name, s in own.items():
                            if (s, -(name or 0)) > (score[d], -(item[d] or 0)):
                                score[d], item[d] = s, name
                yield pa.RecordBatch.from_arrays([batch["id"], batch["text"], pa.array(count, pa.int64()), pa.array(item, pa.int64()), pa.array(score, pa.float64())], ["id", "text", "n_items", "best_item", "best_score"])

        rows = rows.mapInArrow(search, rows.schema)
    return rows.select(F.col("id").alias(id_col), (F.col("n_items") > 0).alias("contaminated"), "n_items", "best_item", "best_score")


def clean(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", n: int = 3, span: int = 4, least_score: float = 0.5, block_words: int = 1 << 20) -> DataFrame:
    """``docs`` without contaminated documents."""
    out = docs
    for shared in _item_blocks(docs, bench, text_col, item_col, item_text, n, span, block_words):

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good = np.ones(batch.num_rows, bool)
                for b in K.blocks(batch[text_col], K.BLOCK_BYTES):
                    good[[b.rows.start + d for d, _ in _best(b, shared.value, least_score)]] = False
                yield batch.filter(pa.array(good))

        out = out.mapInArrow(search, docs.schema)
    return out


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir, "doc_id", "text"), table(spark, sf_dir, "benchmark"))
