"""Quality rules judged per host.

Every document is measured whole; rule failures are summed by host, each host's
failure rate is shrunk towards the corpus by an empirical beta prior, and the
host's verdict is joined back to its documents.

Defined results: null or empty text has no words and fails the length rule; a
null host has no verdict of its own, so its documents stand by their own rules;
repeated rows are measured and counted each; an empty table gives an empty
result; columns other than the three that are named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernel as K
from .io import cut

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
SIGNALS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def signals(b: K.Block) -> dict[str, np.ndarray]:
    """Word, symbol, line and repetition counts of each document of a block."""
    start, end, first = b.words()
    head = np.concatenate([[0], np.cumsum((b.data & 0xC0) != 0x80)])  # code points before a byte
    word = b.hashes(start, end)
    gram, gfirst = K.shingles(word, first, 3, whole=False)
    count, _ = K.repeats(K.mix(gram ^ (b.doc_of(gfirst).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))))
    covered = np.zeros(len(word) + 3, bool)
    at = np.arange(len(gram)) - np.repeat(gfirst[:-1] - first[:-1], np.diff(gfirst))
    for j in range(3):
        covered[at[count > 1] + j] = True
    ls, le, lfirst = b.lines()
    has = np.searchsorted(start, ls) < np.searchsorted(start, le)
    ldoc = b.doc_of(lfirst)[has]
    _, later = K.repeats(K.mix(b.hashes(ls[has], le[has]) ^ (ldoc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))))
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[b.data])])
    return {
        "n_words": np.diff(first),
        "word_chars": K.per_doc(head[end] - head[start], first),
        "n_symbols": symbols[b.off[1:]] - symbols[b.off[:-1]],
        "n_dup_lines": np.bincount(ldoc[later], minlength=b.n).astype(np.int64),
        "n_repeat_words": K.per_doc(covered[: len(word)], first),
    }


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per input row: id, host and the signals."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [signals(b) for b in K.blocks(batch["text"])]
            if parts:
                cols = [pa.array(np.concatenate([p[s] for p in parts]).astype(np.int64)) for s in SIGNALS]
                yield pa.RecordBatch.from_arrays([batch["id"], batch["host"], *cols], ["id", "host", *SIGNALS])

    schema = T.StructType([rows.schema["id"], rows.schema["host"], *(T.StructField(s, T.LongType()) for s in SIGNALS)])
    return rows.mapInArrow(run, schema)


def base_failed(min_words: int, max_repeat_percent: int):
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def shrunk_rates(counts: DataFrame) -> DataFrame:
    """``counts`` (host, n, failed) with ``rate``: the failure rate under the fitted beta prior.

    The prior's mean is the corpus rate, its strength comes from the spread of the
    hosts' rates (method of moments) and stays within 1 and 1000 documents.
    """
    total = counts.agg(F.sum("n").alias("n"), F.sum("failed").alias("failed")).first()
    if not total["n"]:
        return counts.withColumn("rate", F.lit(None).cast("double"))
    mean = total["failed"] / total["n"]
    gap = F.col("failed") / F.col("n") - F.lit(mean)
    spread = counts.agg(F.sum(F.col("n") * gap * gap) / F.lit(total["n"])).first()[0]
    strength = 1000.0 if spread <= 0 else min(1000.0, max(1.0, mean * (1 - mean) / spread - 1))
    return counts.withColumn("rate", (F.col("failed") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength)))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", min_words: int = 50, max_repeat_percent: int = 50, max_host_rate: float = 0.5) -> DataFrame:
    """Signals, own rules and host verdict of every document.

    The signals (a few numbers a row) are cut to the shared folder once and read
    twice.  Host counts combine on the map side, so a host with a third of all
    rows sends one row per task; Spark broadcasts the host table where it is small
    and otherwise joins it by host with skewed hosts split.
    """
    rows = cut(measure(docs, id_col, text_col, host_col).withColumn("base_failed", base_failed(min_words, max_repeat_percent)))
    counts = rows.where("host IS NOT NULL").groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    hosts = shrunk_rates(counts).select("host", F.col("rate").alias("host_rate"))
    rejected = F.coalesce(F.col("host_rate") > max_host_rate, F.lit(False))
    return rows.join(hosts, "host", "left").withColumn("kept", ~F.col("base_failed") & ~rejected).withColumnRenamed("id", id_col).withColumnRenamed("host", host_col)


def op10_host_rules(spark, sf_dir: str) -> DataFrame:
    from .io import documents

    return judge(documents(spark, sf_dir, "doc_id", "text", "source")).select("doc_id", *SIGNALS, "base_failed", "kept")


SQL = r"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), word AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w
), tri AS (
  SELECT doc_id, i, word || ' ' || lead(word, 1) OVER d || ' ' || lead(word, 2) OVER d AS tri FROM word WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), hit AS (
  SELECT doc_id, i, tri IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, tri) > 1 AS hit FROM tri
), covered AS (
  SELECT doc_id, hit OR coalesce(lag(hit, 1) OVER d, false) OR coalesce(lag(hit, 2) OVER d, false) AS yes FROM hit WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), rep AS (
  SELECT doc_id, count(*) FILTER (WHERE yes) AS n FROM covered GROUP BY doc_id
), base AS (
  SELECT doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
            - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN rep USING (doc_id)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base
), host AS (
  SELECT source, count(*)::DOUBLE AS n, count(*) FILTER (WHERE base_failed)::DOUBLE AS f FROM judged WHERE source IS NOT NULL GROUP BY source
), mean AS (
  SELECT sum(f) / sum(n) AS m, sum(n) AS total FROM host
), spread AS (
  SELECT any_value(m) AS m, sum(n * (f / n - m) * (f / n - m)) / any_value(total) AS v FROM host, mean
), prior AS (
  SELECT m, CASE WHEN v <= 0 THEN 1000.0 ELSE least(1000.0, greatest(1.0, m * (1 - m) / v - 1)) END AS k FROM spread
), verdict AS (
  SELECT source, (f + m * k) / (n + k) > 0.5 AS rejected FROM host, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(rejected, false) AS kept
FROM judged LEFT JOIN verdict USING (source)
"""
