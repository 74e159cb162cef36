"""Licence scan by sentence rules, in DataFrame functions only.

A text is normalised to lower-case words, with marks where a sentence must end (blank
lines, and blanks or a line end after ``.``, ``!`` or ``?``) and where it may (other line
ends).  Known licence sentences are those that begin and end at marks; they may run on
over line ends, with comment signs there or not, but not over a sentence's end.
The identifiers found, in text order, are matched against ordered rules: a rule holds
if its identifiers occur in that order with anything between them, and the first rule
that holds names the licence; all licences of which a rule holds are listed too.  An
SPDX tag counts as a sentence of its own.  Texts without any of ``KEYWORDS`` (every
known sentence has one) skip that.  Sentences and rules are read from a file on the
driver.  Nothing is shuffled and no Python runs on the executors.

Defined results: null and empty texts have no sentences and no licence; a sentence
that occurs again is listed again; repeated rows are scanned each; an empty table
gives an empty result; columns other than id and text are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from importlib.resources import files
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .io import documents

#: Every known sentence holds one of these.
KEYWORDS = ("license", "permission", "redistribution", "rights reserved", "public domain", "the software is provided as is")


@dataclass
class Rules:
    sentences: dict[str, str]  # normalised sentence: identifier
    rules: list[tuple[str, str, tuple[str, ...]]]  # licence, kind, identifiers in order; the first that holds decides

    @property
    def licences(self) -> list[str]:
        return list(dict.fromkeys(r[0] for r in self.rules))


def load(path: str | Path | None = None) -> Rules:
    """Sentences, rules and tags of a file; the one that comes with this module by default."""
    sentences: dict[str, str] = {}
    rules, tagged, section = [], [], ""
    for line in (Path(path) if path else files(__package__) / "license_rules.txt").read_text(encoding="utf-8").splitlines():
        line = line.strip()
        if line.startswith("["):
            section = line.strip("[]")
        elif line and not line.startswith("#"):
            left, right = (x.strip() for x in line.split("=", 1))
            if section == "sentences":
                sentences[right] = left
            elif section == "rules":
                rules.append((*left.split(), tuple(right.split())))
            elif section == "tags":
                name = f"spdx-{left.lower()}"
                sentences["spdx license identifier " + re.sub("[^a-z0-9]+", " ", left.lower())] = name
                tagged.append((*right.split(), (name,)))
    # a tag stands where its licence's rules stand
    order = list(dict.fromkeys(r[0] for r in [*rules, *tagged]))
    found = Rules(sentences, sorted([*rules, *tagged], key=lambda r: order.index(r[0])))
    lost = [s for s in sentences if not any(k in s for k in KEYWORDS)]
    if lost:
        raise ValueError(f"no keyword in: {lost[0]}")
    return found


RULES = load()


def sentence_ids(text: Column, known_: Rules = RULES) -> Column:
    """Identifiers of the known sentences in text order."""
    known = F.create_map(*(F.lit(x) for pair in known_.sentences.items() for x in pair))
    # | ends a sentence, _ is the end of a line inside one
    marked = F.regexp_replace(F.lower(text), r"[|_]", " ")
    for pattern, mark in ((r"\r\n?", "\n"), (r"([.!?])[ \t\f\x0B]+|[.!?][^a-z0-9\n]*\n|\n[^a-z0-9]*\n", "|"), (r"\n", "_"), (r"[^a-z0-9|_]+", " "), (r"[ _]*[|][ _|]*", "|"), (r" ?_ ?", "_"), (r"^[ _]+|[ _]+$", "")):
        marked = F.regexp_replace(marked, pattern, mark)
    # longest first, as one may begin another
    names = "|".join(s.replace(" ", "[ _]") for s in sorted(known_.sentences, key=len, reverse=True))
    found = F.regexp_extract_all(marked, F.lit(f"(?<![^|_])({names})(?![^|_])"), 1)
    ids = F.transform(found, lambda s: F.element_at(known, F.translate(s, "_", " ")))
    keyword = "|".join(KEYWORDS).replace(" ", "[^a-z0-9]+")
    return F.when(F.lower(text).rlike(keyword), ids).otherwise(F.array().cast("array<string>"))


def _holds(sequence: Column, ids: tuple[str, ...]) -> Column:
    return sequence.like("%" + "%".join(f"<{i}>" for i in ids) + "%")


def rule_column(sequence: Column, value: int, known: Rules = RULES) -> Column:
    """Licence (0) or kind (1) of the first rule that a sequence like ``<a><b>`` fulfils."""
    out = None
    for rule in known.rules:
        holds = _holds(sequence, rule[2])
        out = F.when(holds, rule[value]) if out is None else out.when(holds, rule[value])
    return out


def all_licences(sequence: Column, known: Rules = RULES) -> Column:
    """Every licence of which a rule holds, in the order of the rules."""
    each = []
    for name in known.licences:
        some = None
        for rule in known.rules:
            if rule[0] == name:
                some = _holds(sequence, rule[2]) if some is None else some | _holds(sequence, rule[2])
        each.append(F.when(some, name))
    return F.when(sequence == "", F.array().cast("array<string>")).otherwise(F.filter(F.array(*each), lambda x: x.isNotNull()))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: Rules = RULES) -> DataFrame:
    """One row per input row: id, n_sentences (known ones), sequence, license, kind, licenses."""
    rows = docs.select(F.col(id_col), F.coalesce(sentence_ids(F.col(text_col), known), F.array().cast("array<string>")).alias("ids"))
    sequence = F.concat_ws("", F.transform("ids", lambda s: F.concat(F.lit("<"), s, F.lit(">"))))
    rows = rows.select(id_col, F.size("ids").cast("long").alias("n_sentences"), sequence.alias("sequence"))
    found = F.col("sequence")
    return rows.select(id_col, "n_sentences", "sequence", rule_column(found, 0, known).alias("license"), rule_column(found, 1, known).alias("kind"), all_licences(found, known).alias("licenses"))


def op8_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir, "doc_id", "text")).withColumn("licenses", F.array_join("licenses", ","))


def _sql() -> str:
    known = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in RULES.sentences.items()) + "}"
    holds = lambda r: f"sequence LIKE '%{'%'.join(f'<{i}>' for i in r[2])}%'"
    case = lambda v: "CASE " + " ".join(f"WHEN {holds(r)} THEN '{r[v]}'" for r in RULES.rules) + " END"
    each = ", ".join(f"CASE WHEN {' OR '.join(holds(r) for r in RULES.rules if r[0] == n)} THEN '{n}' END" for n in RULES.licences)
    return rf"""
WITH p AS (
  SELECT doc_id, list_transform(string_split(regexp_replace(coalesce(text, ''), '([.!?])[ \t\r\f\x0B]+', '\1' || chr(10), 'g'), chr(10)),
         lambda s: trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))) AS parts FROM documents
), q AS (
  SELECT doc_id, list_filter(list_transform(parts, lambda s: {known}[s]), lambda s: s IS NOT NULL) AS ids FROM p
), r AS (
  SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_sentences, coalesce(array_to_string(list_transform(ids, lambda s: '<' || s || '>'), ''), '') AS sequence FROM q
)
SELECT doc_id, n_sentences, sequence, {case(0)} AS license, {case(1)} AS kind, array_to_string(list_filter([{each}], lambda x: x IS NOT NULL), ',') AS licenses FROM r
"""


SQL = _sql()
