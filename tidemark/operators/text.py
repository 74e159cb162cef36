"""Text scans: forbidden needles, withheld clauses, exempted patterns, allow-lists, file finds."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from ..functions import scalars as S


def needles(phrases: DataFrame, phrase: str, stop: DataFrame | None = None, least: int = 6) -> DataFrame:
    """Distinct tokens of at least ``least`` characters of the phrases, without stop words (column ``word``)."""
    x = phrases.select(F.explode(S.tokens(F.col(phrase), least)).alias("needle")).distinct()
    return x if stop is None else x.join(stop.select(F.col("word").alias("needle")), "needle", "left_anti")


def needle_hits(docs: DataFrame, key: str, text: str, wanted: DataFrame, least: int = 6, most: int = 1 << 17) -> DataFrame:
    """key, hits: documents that have a needle as a token, and how many distinct ones.

    Up to ``most`` needles, which is checked, go to the tasks that read the texts, so that
    only hits are shuffled; more of them meet the tokens in an equi-join.
    """
    t = docs.select(key, F.explode(F.array_distinct(S.tokens(F.col(text), least))).alias("needle"))
    few = wanted.limit(most + 1).count() <= most
    return t.join(F.broadcast(wanted) if few else wanted, "needle", "left_semi").groupBy(key).agg(F.count("*").alias("hits"))


def passage_hits(docs: DataFrame, key: str, text: str, phrases: DataFrame, phrase_key: str, phrase: str, lower: bool = False, block_chars: int = 1 << 24) -> DataFrame:
    """key, phrase_key of every document that contains a phrase literally, or but for case if ``lower``.

    Phrases are a query set: they go to the executors as an automaton, in blocks of about
    ``block_chars`` characters with one pass over the texts each.  A pass finds all its
    phrases, short ones too, in one walk over a text, and nothing is shuffled.  Null and
    empty phrases are in no text; several rows of one phrase are found each.
    """
    put = F.lower(F.col(phrase)) if lower else F.col(phrase)
    wanted = phrases.select(F.col(phrase_key).alias("k"), put.alias("p")).where("p <> ''")
    out = StructType([docs.schema[key], StructField(phrase_key, phrases.schema[phrase_key].dataType)])
    types = [to_arrow_type(f.dataType) for f in out]
    rows = docs.select(key, F.lower(text) if lower else F.col(text))
    blocks = int((wanted.agg(F.coalesce(F.sum(F.length("p")), F.lit(0))).first()[0]) // block_chars) + 1
    hits = docs.sparkSession.createDataFrame([], out)
    for i in range(blocks):
        some = [(r["k"], r["p"]) for r in wanted.where(F.pmod(F.xxhash64("p"), F.lit(blocks)) == i).collect()]
        if not some:
            continue
        shared = docs.sparkSession.sparkContext.broadcast(some)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            import ahocorasick

            names: dict[str, list] = {}
            for k, p in shared.value:
                names.setdefault(p, []).append(k)
            found = ahocorasick.Automaton()
            for p in names:
                found.add_word(p, p)
            found.make_automaton()
            for batch in batches:
                at, own = [], []
                for j, t in enumerate(batch.column(1)):
                    for p in {p for _, p in found.iter(t.as_py() or "")}:
                        own += names[p]
                        at += [j] * len(names[p])
                if at:
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(own, types[1])], names=out.names)

        hits = hits.union(rows.mapInArrow(run, out))
    return hits


def exempted(text: Column, pattern: str, exemption: str) -> Column:
    return text.rlike(pattern) & ~text.rlike(exemption)


def sections(lines: DataFrame, keys: Sequence[str], order: str, line: str) -> DataFrame:
    """Lines with the ``[name]`` header they stand under; headers and lines before the first are left out."""
    w = Window.partitionBy(*keys).orderBy(order)
    header = F.when(F.col(line).rlike(r"^\[[^\]]+\]$"), F.substring(line, 2, 1 << 20))
    x = lines.withColumn("section", F.rtrim(F.last(header, True).over(w), F.lit("]")))
    return x.where(F.col("section").isNotNull() & header.isNull())


def allowed(requests: DataFrame, grants: DataFrame, key: Sequence[str], path: str, slack: float = 1e-6) -> DataFrame:
    """Requests (low, high) with a decision: any grant of the path that holds the closed interval permits it.

    A grant without bounds holds everything.
    """
    g = grants.select(F.col(path), F.col("low").alias("__lo"), F.col("high").alias("__hi"), F.lit(1).alias("__seen"))
    met = requests.join(g, path, "left")
    inside = (F.col("__seen") == 1) & (F.col("__lo").isNull() | ((F.col("low") >= F.col("__lo") - slack) & (F.col("high") <= F.col("__hi") + slack)))
    x = met.groupBy(*key).agg(F.max(F.coalesce(inside, F.lit(False)).cast("int")).alias("ok"), F.max(F.coalesce("__seen", F.lit(0))).alias("seen"))
    return x.select(*key, F.when(F.col("ok") == 1, "permitted").when(F.col("seen") == 1, "outside interval").otherwise("not listed").alias("decision"))


def readable(files: DataFrame, content: str = "content", most: int = 2_000_000) -> DataFrame:
    """Binary files with ``text``: those of at most ``most`` bytes, without a zero byte, that are UTF-8; others are left out."""
    x = files.where((F.octet_length(content) <= most) & (F.position(F.lit(b"\0"), F.col(content)) == 0))
    return x.withColumn("text", F.try_validate_utf8(F.col(content).cast("string"))).where(F.col("text").isNotNull())


def find_files(files: DataFrame, path: str, name: str | None = None, extension: str | None = None, content: Column | None = None) -> DataFrame:
    base = F.substring_index(F.col(path), "/", -1)
    x = files
    if name:
        x = x.where(S.like_glob(base, name))
    if extension:
        x = x.where(F.lower(base).endswith("." + extension.lower()))
    return x if content is None else x.where(content)
