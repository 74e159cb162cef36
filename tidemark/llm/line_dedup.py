"""Line de-duplication by distinct-site spread.

Every line's fingerprint gathers a HyperLogLog sketch of the sites it stands on; the
sketches merge by aggregation, on the map side first, so a line on a third of all
documents sends one sketch per task.  Lines whose estimate is far above
``min_sites`` are boilerplate, lines far below are not, and lines within four
standard errors of it are counted exactly.  Boilerplate is removed everywhere but in
the document with the smallest id that has it, so no content leaves the corpus.

Lines are few that stand on many sites.  As long as the list of them is at most
``most_listed`` entries, which is checked, it goes to the tasks that read the texts and
no text is shuffled; beyond that, occurrences meet the list, and texts their lost lines,
by joins on their keys.

Defined results: lines without a word are kept and not counted; null text stays
null; a null site is no site; a null id keeps its lines; repeated rows and other rows
that share an id are one document; an empty table gives an empty result; columns
other than the three that are named pass through unread.
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
from .io import cut, documents

_SALT = np.uint64(0x51ED270B35AE4D39)
#: log2 of the sketch's registers and four of its relative standard errors.
LG_K, BAND = 12, 4 * 1.04 / 64


def _keyed(b: K.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Line starts, ends, per-document first index, fingerprints, and whether a line has a word."""
    start, _, _ = b.words()
    ls, le, first = b.lines()
    has = np.searchsorted(start, ls) < np.searchsorted(start, le)
    return ls, le, first, b.hashes(ls, le), has


def distinct_lines(docs: DataFrame, id_col: str, text_col: str, site_col: str, listed: Broadcast | None = None) -> DataFrame:
    """key, id, site: each line with a word (of those ``listed``, if given), once a document."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(site_col)).alias("site"), F.col(site_col).isNull().alias("none"), F.col(text_col).alias("text")).where("text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in K.blocks(batch["text"]):
                _, _, first, key, has = _keyed(b)
                if listed is not None:
                    has &= _place(listed.value[0], key)[1]
                doc, key = b.doc_of(first)[has], key[has]
                keep = ~K.repeats(K.mix(key ^ (doc.astype(np.uint64) * _SALT)))[1]
                at = pa.array(doc[keep] + b.rows.start)
                yield pa.RecordBatch.from_arrays([pa.array(key[keep].view(np.int64)), batch["id"].take(at), batch["site"].take(at), batch["none"].take(at)], ["key", "id", "site", "none"])

    return rows.mapInArrow(run, "key long, id long, site long, none boolean").select("key", "id", F.when(~F.col("none"), F.col("site")).alias("site"))


def _place(known: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key stands in sorted ``known``, and whether it does."""
    if not len(known):
        return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
    at = np.minimum(np.searchsorted(known, key), len(known) - 1)
    return at, known[at] == key


def _listed(keys: DataFrame, most: int) -> Broadcast | None:
    """``key, first`` as sorted arrays on every executor, or None if there are more than ``most``."""
    if keys.count() > most:
        return None
    got = keys.select("key", "first").toPandas()
    key = got["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(key)
    # lines of documents without ids only have no first one; they are removed nowhere
    first = got["first"].fillna(0).to_numpy(np.int64) if got["first"].isna().any() else got["first"].to_numpy(np.int64)
    return keys.sparkSession.sparkContext.broadcast((key[order], first[order]))


def boilerplate(docs: DataFrame, id_col: str, text_col: str, site_col: str, min_sites: int, most_listed: int) -> DataFrame:
    """key, first: the lines to remove and the smallest id that has each."""
    lines = distinct_lines(docs, id_col, text_col, site_col)
    spread = lines.groupBy("key").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("sites"), F.min("id").alias("first"))
    likely = cut(spread.where(F.col("sites") >= min_sites * (1 - BAND)))
    near = likely.where(F.col("sites") <= min_sites * (1 + BAND))
    listed = _listed(near, most_listed)
    if listed is None:
        seen = lines.join(near.select("key"), "key", "left_semi")
    else:
        seen = distinct_lines(docs, id_col, text_col, site_col, listed)
    exact = seen.select("key", "site").distinct().groupBy("key").agg(F.count("site").alias("exact"))
    return cut(likely.join(exact, "key", "left").where(F.coalesce("exact", "sites") >= min_sites).select("key", "first"))


def remove_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = 10, most_listed: int = 1 << 20) -> DataFrame:
    """``docs`` with boilerplate lines taken out of the text, plus n_lines and n_removed."""
    common = boilerplate(docs, id_col, text_col, site_col, min_sites, most_listed)
    listed = _listed(common, most_listed)
    others = [c for c in docs.columns if c not in (text_col, "n_lines", "n_removed")]
    own = F.col(id_col).cast("long").alias("__id")
    if listed is None:
        met = distinct_lines(docs, id_col, text_col, site_col).select("key", "id").join(common, "key").where("id <> first")
        lost = met.groupBy(F.col("id").alias("__lost_id")).agg(F.collect_set("key").alias("__lost"))
        met = docs.join(lost, F.col(id_col).cast("long") == F.col("__lost_id"), "left").select(*others, F.col(text_col).alias("__text"), own, "__lost")
    else:
        met = docs.select(*others, F.col(text_col).alias("__text"), own)
    schema = T.StructType([*met.select(*others).schema, T.StructField(text_col, T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())])

    def gone_of(batch: pa.RecordBatch, b: K.Block, first: np.ndarray, key: np.ndarray) -> np.ndarray:
        doc = b.doc_of(first)
        if listed is not None:
            ids = batch["__id"][b.rows]
            null = ids.is_null().to_numpy(zero_copy_only=False)
            at, known = _place(listed.value[0], key)
            if not known.any():
                return known
            return known & ~null[doc] & (listed.value[1][at] != ids.fill_null(0).to_numpy()[doc])
        col = batch["__lost"][b.rows]
        sizes = np.nan_to_num(pa.compute.list_value_length(col).to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
        lost = np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.int64).view(np.uint64)
        mine = lambda k, d: K.mix(k ^ (d.astype(np.uint64) * _SALT))
        return np.isin(mine(key, doc), mine(lost, np.repeat(np.arange(b.n), sizes)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lines, removed = [], [], []
            for b in K.blocks(batch["__text"]):
                ls, le, first, key, has = _keyed(b)
                gone = has & gone_of(batch, b, first, key)
                lines += np.diff(first).tolist()
                removed += K.per_doc(gone, first).tolist()
                raw = b.data.tobytes()
                for i in range(b.n):
                    x, y = first[i], first[i + 1]
                    if gone[x:y].any():
                        texts.append(b"\n".join(raw[s:e] for s, e in zip(ls[x:y][~gone[x:y]], le[x:y][~gone[x:y]])).decode())
                    else:
                        texts.append(raw[b.off[i] : b.off[i + 1]].decode())
            text = pa.compute.if_else(pa.compute.is_null(batch["__text"]), pa.scalar(None, pa.string()), pa.array(texts, pa.string()))
            cols = [batch[c] for c in others]
            yield pa.RecordBatch.from_arrays([*cols, text, pa.array(lines, pa.int64()), pa.array(removed, pa.int64())], [*others, text_col, "n_lines", "n_removed"])

    return met.mapInArrow(run, schema)


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    kept = remove_lines(documents(spark, sf_dir, "doc_id", "text", "source"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


SQL = r"""
WITH line AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents
), spread AS (
  SELECT line, count(DISTINCT source) AS sites, min(doc_id) AS first FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY line
), judged AS (
  SELECT l.*, coalesce(s.sites >= 10 AND l.doc_id <> s.first, false) AS gone FROM line l LEFT JOIN spread s USING (line)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
