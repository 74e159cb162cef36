"""URL filter: a weighted vocabulary found by Aho-Corasick, under host and path rules.

The automaton walks each lower-cased url once; a term counts where no ASCII letter
or digit touches it on either side.  One strict term, or soft terms whose distinct
weights reach the limit, reject the url.  Rules of host and path come first: the
longest rule that fits decides (of equally long ones the first given).  The vocabulary is
read from a file on the driver.

Defined results: a null url, or one without ``://``, has empty host and path; a
null url hits nothing; repeated rows are judged each; an empty table gives an empty
result; columns other than id and url are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from importlib.resources import files
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T



def read_vocabulary(path: str | Path | None = None) -> dict[str, float]:
    """Terms and weights of a file of lines ``weight = term term ...``; the one that comes with this module by default."""
    out: dict[str, float] = {}
    for line in (Path(path) if path else files(__package__) / "url_terms.txt").read_text(encoding="utf-8").splitlines():
        if line.strip() and not line.startswith("#"):
            weight, terms = line.split("=", 1)
            out |= {t.lower(): float(weight) for t in terms.split()}
    return out


VOCABULARY = read_vocabulary()
#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule (ties: the one given first) and its verdict, else nulls."""
    name = verdict = None
    for h, p, v in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def vocabulary_hits(pages: DataFrame, id_col: str, url_col: str, vocabulary: Mapping[str, float]) -> DataFrame:
    """id, url, the distinct terms found (sorted) and the sum of their weights."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    terms = dict(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        found = ahocorasick.Automaton()
        for t, w in terms.items():
            found.add_word(t, (t, w))
        if terms:
            found.make_automaton()
        word = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
        for batch in batches:
            hits, weights = [], []
            for url in batch["url"].to_pylist():
                u, own = (url or "").lower(), {}
                for last, (t, w) in found.iter(u) if terms and u else ():
                    i = last - len(t)
                    if (i < 0 or u[i] not in word) and (last + 1 == len(u) or u[last + 1] not in word):
                        own[t] = w
                hits.append(sorted(own))
                weights.append(float(sum(own.values())))
            yield pa.RecordBatch.from_arrays([batch["id"], batch["url"], pa.array(hits, pa.list_(pa.string())), pa.array(weights, pa.float64())], ["id", "url", "terms", "weight"])

    return rows.mapInArrow(run, T.StructType([rows.schema["id"], rows.schema["url"], T.StructField("terms", T.ArrayType(T.StringType())), T.StructField("weight", T.DoubleType())]))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", vocabulary: Mapping[str, float] = VOCABULARY, rules=RULES, reject_weight: float = 1.0) -> DataFrame:
    """One row per page: id, host, path, terms, weight, rule, verdict.  Nothing is shuffled."""
    rows = vocabulary_hits(pages, id_col, url_col, vocabulary)
    at = "instr(url, '://')"
    rest = F.expr(f"CASE WHEN {at} > 0 THEN substring(url, {at} + 3) ELSE '' END")
    rest = F.coalesce(rest, F.lit(""))
    rows = rows.withColumn("host", F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)).withColumn("path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("weight") >= reject_weight, "block").otherwise("allow")
    return rows.select(F.col("id").alias(id_col), "host", "path", "terms", "weight", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"))


def op5_url_filter(spark, sf_dir: str) -> DataFrame:
    from .io import table

    return judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    hit = lambda t: f"CASE WHEN regexp_matches(lower(url), '(^|[^a-z0-9]){t}([^a-z0-9]|$)') THEN {VOCABULARY[t]} ELSE 0 END"
    return rf"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), q AS (
  SELECT *, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM p
), r AS (
  SELECT *, CASE WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                 WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                 WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                 WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM q
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/de/', 'net/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN {" + ".join(hit(t) for t in VOCABULARY)} >= 1 THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""


SQL = _sql()
