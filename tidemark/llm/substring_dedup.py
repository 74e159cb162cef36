"""Exact substring de-duplication by prefix-free parsing, to a bounded depth.

A byte is removed when a string of ``length`` bytes that covers it also starts
earlier in the corpus (smaller id, or earlier in the same document); strings never
cross documents.

Parsing.  A rolling hash over ``trigger`` bytes is minimised over every string of
``length`` bytes; the minimum is the string's trigger and depends on nothing outside
it.  Consecutive string starts with one trigger occurrence form a phrase (with the
``length - 1`` bytes that follow the last start), so phrases tile the starts of a
document and repeated text repeats its phrases: a document is its parse, the distinct
phrases are the dictionary, and no string runs over a phrase's end.

Parse.  The parse is put in order by trigger, phrase and document, in ranges that divide
hot triggers too: all occurrences of a phrase but those in its first document are
repeats.  A trigger with one phrase is settled by that; in highly repetitive text that is
nearly all of it.

Dictionary.  The phrases of a trigger that has several, each from its first document, are
sorted as suffixes that begin at the trigger, to the depth of ``length`` bytes that
matters, and once more as the reversed prefixes that end there.  Both suffix arrays are
in byte order, with the lengths of the prefixes that neighbours have in common.  Two
phrases share the string that begins j bytes before the trigger where they lie in one
stretch of at least ``length - j`` common bytes in the one array and of at least j in the
other; of such strings the first in corpus order stays.  So every start in the
dictionary is decided against all others with its trigger, and together with the parse
the whole corpus is.

Hot triggers.  A trigger with more than ``most_phrases`` phrases, such as stands at the edge
of a passage that very many documents share, is no task's group: its strings are ordered
one by one by their fingerprints instead, after each batch of documents has kept only the
first occurrence of each.  The same goes for the triggers at the ends of a range, of
which no task sees all.

The texts are shuffled twice, to meet the parse's verdicts and the dictionary's; names and
triggers are fingerprints (62 bits; the dictionary compares bytes).

Defined results: null text is empty; texts under ``length`` bytes lose nothing;
repeated rows and other rows that share an id do not remove from each other; a null
id takes no part and keeps its text; an empty table gives an empty result; columns
other than id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .io import cut, documents, width

_DOC = np.uint64(0x9E3779B97F4A7C15)


def _low(g: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values."""
    size, m = 1, g
    while 2 * size <= w:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    n = len(g) - w + 1
    return np.minimum(m[:n], m[w - size : w - size + n])


#: Phrases of one trigger up to which they are sorted together.
MOST_PHRASES = 4096
PARSE, DICTIONARY, STRINGS = 0, 1, 2


class Parts:
    """Runs of string starts: ``start``, ``count``, ``doc``, their trigger's ``place``, a ``key`` that equal strings share, and a ``name``."""

    def __init__(self, b: K.Block, length: int, reach: int, level: int, start, count, doc, place, key):
        self.b, self.length, self.reach, self.level = b, length, reach, level
        self.start, self.count, self.doc, self.place, self.key = start, count, doc, place, key
        self.name = K.mix(b.hashes(start, start + count - 1 + length) + np.uint64(level))
        self.mine = K.mix(self.name ^ (doc.astype(np.uint64) * _DOC))
        self.later = K.repeats(self.mine)[1]  # parts that the same document has had before

    def among(self, names: np.ndarray, owner: np.ndarray) -> np.ndarray:
        return np.isin(self.mine, K.mix(names ^ (owner.astype(np.uint64) * _DOC)))

    def strings(self, take: np.ndarray) -> Parts:
        """The marked parts string by string; a string is its own key."""
        which = np.repeat(np.flatnonzero(take), self.count[take])
        first = np.cumsum(self.count[take]) - self.count[take]
        start = self.start[which] + np.arange(len(which)) - np.repeat(first, self.count[take])
        out = Parts(self.b, self.length, self.reach, self.level + 1, start, np.ones(len(start), np.int64), self.doc[which], self.place[which], np.zeros(0, np.uint64))
        out.key = out.name
        return out


def parse(b: K.Block, length: int, trigger: int) -> Parts:
    """The phrases of a block."""
    n, w = len(b.data) - length + 1, length - trigger + 1
    if n <= 0:
        z = np.zeros(0, np.int64)
        return Parts(b, length, w, 0, z, z, z, z, np.zeros(0, np.uint64))
    gram = b.grams(trigger)
    low = _low(gram, w)
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, np.minimum(b.off[:-1], n), 1)
    np.add.at(step, np.minimum(np.maximum(b.off[:-1], b.off[1:] - length + 1), n), -1)
    valid = np.cumsum(step[:n]) > 0
    new = valid.copy()
    new[1:] &= (low[1:] != low[:-1]) | ~valid[:-1]
    at = b.off[:-1][b.off[:-1] < n]
    new[at] |= valid[at]
    # where triggers stand; a string that starts after one and has the same minimum has the next one
    pad = np.zeros(w - 1, np.uint64)
    stands = np.flatnonzero(~_low(~np.concatenate([pad, np.where(valid, low, np.uint64(0)), pad]), w) == gram)
    at = stands[stands < n - 1]
    at = at[low[at + 1] == gram[at]] + 1
    new[at] |= valid[at]
    start = np.flatnonzero(new)
    total = np.concatenate([[0], np.cumsum(valid)])
    count = total[np.concatenate([start[1:], [n]])] - total[start]
    i = np.searchsorted(stands, start + count - 1)
    for _ in range(w):
        wrong = gram[stands[i]] != low[start]
        if not wrong.any():
            break
        i += wrong
    return Parts(b, length, w, 0, start, count, np.searchsorted(b.off, start, "right") - 1, stands[i], low[start])


def _ids(batch: pa.RecordBatch, b: K.Block) -> np.ndarray:
    return batch["id"].to_numpy(zero_copy_only=False)[b.rows]


def _lists(batch: pa.RecordBatch, name: str, b: K.Block) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column for the block's documents, and each value's document."""
    col = batch[name].slice(b.rows.start, b.n)
    sizes = np.nan_to_num(pa.compute.list_value_length(col).to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
    values = col.flatten().to_numpy(zero_copy_only=False)
    return values.view(np.uint64) if values.dtype == np.int64 else values, np.repeat(np.arange(b.n), sizes)


def _first_of_batch(name: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which rows are not an occurrence after another with a smaller id in the batch."""
    order = np.lexsort((ids, name))
    n, i = name[order], ids[order]
    new = np.concatenate([[True], n[1:] != n[:-1]]) if len(n) else np.zeros(0, bool)
    keep = np.zeros(len(n), bool)
    keep[order] = i == i[new][np.cumsum(new) - 1] if len(n) else new
    return keep


def _table(**cols: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v.view(np.int64) if v.dtype == np.uint64 else v) for v in cols.values()], list(cols))


def _parse_verdicts(rows: DataFrame, parts: int, most: int) -> DataFrame:
    """id, name, kind: PARSE for an occurrence of a phrase after its first document; else for phrases whose
    trigger has several, DICTIONARY, or STRINGS if it has more than ``most`` or is at an end of the range.

    ``rows`` are key, name, id, settled (an occurrence known to be a later one).  A task
    streams over a range in order and holds the first occurrences of one trigger's
    phrases, ``most`` of them at most.
    """
    ordered = rows.repartitionByRange(parts, "key", "name").sortWithinPartitions("key", "name", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = np.zeros(0, np.int64)
        key = run_of = None  # the open trigger, and the open phrase as (name, first id)
        held, ends, begun = (z, z), False, False  # its first occurrences; whether it goes by strings in any case

        def out(ids, names, kind) -> pa.RecordBatch:
            return _table(id=ids, name=names, kind=np.full(len(ids), kind, np.int32))

        for batch in batches:
            lead, name, ids, done = (batch[c].to_numpy(zero_copy_only=False) for c in ("key", "name", "id", "settled"))
            if done.any():
                yield out(ids[done], name[done], PARSE)
                lead, name, ids = lead[~done], name[~done], ids[~done]
            if not len(lead):
                continue
            new = np.concatenate([[key is None or lead[0] != key or name[0] != run_of[0]], (lead[1:] != lead[:-1]) | (name[1:] != name[:-1])])
            of = np.cumsum(new)
            first = np.concatenate([[run_of[1] if run_of else 0], ids[new]])[of]
            again = ids > first
            if again.any():
                yield out(ids[again], name[again], PARSE)
            fk, fn, fi = lead[new], name[new], ids[new]
            if key is not None:
                fk, fn, fi = np.concatenate([np.full(len(held[0]), key), fk]), np.concatenate([held[0], fn]), np.concatenate([held[1], fi])
            edge = np.concatenate([[True], fk[1:] != fk[:-1]]) if len(fk) else np.zeros(0, bool)
            group = np.cumsum(edge) - 1
            size = np.bincount(group)
            by_strings = size > most
            if len(fk):
                if not begun or (fk[0] == key and ends):
                    by_strings[0] = True
                still = fk == lead[-1]
                for kind, take in ((DICTIONARY, ~by_strings & (size > 1)), (STRINGS, by_strings)):
                    take = take[group] & ~still
                    if take.any():
                        yield out(fi[take], fn[take], kind)
                ends = bool(by_strings[group[-1]]) if still.any() else ends
                held = (fn[still], fi[still])
                if ends and len(held[0]):
                    yield out(held[1], held[0], STRINGS)
                    held = (z, z)
            begun = True
            key, run_of = lead[-1], (name[-1], first[-1])
        if len(held[0]):
            yield out(held[1], held[0], STRINGS)

    return ordered.mapInArrow(run, "id long, name long, kind int")


def _common(words: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte order of rows of big-endian words within groups, and how many bytes each has in common with the row before it."""
    order = np.lexsort((*words.T[::-1], group))
    w = words[order]
    differ = np.zeros(w.shape, bool)
    differ[1:] = w[1:] != w[:-1]
    at = differ.argmax(1)
    x = np.zeros(len(w), np.uint64)
    rows = np.arange(len(w))
    x[1:] = w[rows[1:], at[1:]] ^ w[rows[:-1], at[1:]]
    lead = 7 - np.floor(np.log2(np.maximum(x, 1).astype(np.float64))).astype(np.int64) // 8
    # the logarithm of a value just below a power of 256 may be rounded up
    lead += (x >> (np.clip(7 - lead, 0, 7) * 8).astype(np.uint64)) == 0
    common = np.where(differ.any(1), at * 8 + lead, w.shape[1] * 8)
    g = group[order]
    common[np.concatenate([[True], g[1:] != g[:-1]])] = -1
    return order, common


def decide(group: np.ndarray, ids: np.ndarray, tag: np.ndarray, start: np.ndarray, lead: np.ndarray, count: np.ndarray, data: np.ndarray, off: np.ndarray, length: int, reach: int) -> np.ndarray:
    """Which string starts (phrases x reach) of the dictionary's phrases are repeats.

    Phrase p is ``data[off[p]:off[p + 1]]``, stands at ``start`` of document (``ids``,
    ``tag``) and has its trigger ``lead`` bytes after its start; ``group`` numbers triggers.
    """
    order = np.lexsort((start + lead, tag, ids))  # corpus order of the triggers' places
    group, ids, tag, lead, count, begin = group[order], ids[order], tag[order], lead[order], count[order], off[:-1][order]
    place, size = (start[order] + lead), np.diff(off)[order]
    m = len(order)
    wide, high = -(-length // 8) * 8, -(-reach // 8) * 8
    at = np.arange(wide)[None, :] + lead[:, None]
    right = np.where(at < size[:, None], data[np.minimum(begin[:, None] + at, len(data) - 1)], 0).astype(np.uint8)
    at = lead[:, None] - 1 - np.arange(high)[None, :]
    left = np.where(at >= 0, data[np.maximum(begin[:, None] + at, 0)], 0).astype(np.uint8)
    by_right, common_right = _common(right.view(">u8").astype(np.uint64), group)
    by_left, common_left = _common(left.view(">u8").astype(np.uint64), group)
    out = np.zeros((m, reach), bool)
    cls_r, cls_l = np.zeros(m, np.int64), np.zeros(m, np.int64)
    for j in range(reach):
        some = np.flatnonzero((lead >= j) & (lead - count < j))
        if len(some) < 2:
            continue
        cls_r[by_right], cls_l[by_left] = np.cumsum(common_right < length - j), np.cumsum(common_left < j)
        cls = cls_r[some] * (m + 1) + cls_l[some]
        o = np.argsort(cls, kind="stable")
        cls, p = cls[o], some[o]
        new = np.concatenate([[True], cls[1:] != cls[:-1]])
        if new.all():
            continue
        head = np.maximum.accumulate(np.where(new, np.arange(len(p)), 0))
        doc = new.copy()
        doc[1:] |= (ids[p][1:] != ids[p][:-1]) | (tag[p][1:] != tag[p][:-1])
        top = np.maximum.accumulate(np.where(doc, np.arange(len(p)), 0))
        again = (ids[p] > ids[p[head]]) | (place[p] > place[p[top]])
        out[p[again], lead[p[again]] - j] = True
    back = np.zeros_like(out)
    back[order] = out
    return back


_FOUND = "id long, name long, bits binary"


def _dictionary_verdicts(rows: DataFrame, parts: int, length: int, reach: int) -> DataFrame:
    """id, name, bits: repeated starts of dictionary phrases as bits, and strings that are repeats (null bits).

    ``rows`` are kind, key, name, id, settled, and for phrases tag, start, lead, count, bytes.
    """
    ordered = rows.repartition(parts, "key").sortWithinPartitions("kind", "key", "name", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        last = None  # the open string as (name, first id)

        def found(ids: np.ndarray, names: np.ndarray, bits: list | None) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(names), pa.array(bits if bits is not None else [None] * len(ids), pa.binary())], ["id", "name", "bits"])

        def phrases(t: pa.Table) -> Iterator[pa.RecordBatch]:
            t = t.combine_chunks()
            c = {n: t[n].to_numpy() for n in ("key", "name", "id", "tag", "start", "lead", "count")}
            raw = t["bytes"].combine_chunks().cast(pa.large_binary())
            off = np.frombuffer(raw.buffers()[1], np.int64, len(raw) + 1, raw.offset * 8)
            data = np.frombuffer(raw.buffers()[2], np.uint8)
            got = decide(np.unique(c["key"], return_inverse=True)[1], c["id"], c["tag"], c["start"], c["lead"], c["count"], data, off, length, reach)
            some = np.flatnonzero(got.any(1))
            if len(some):
                bits = np.packbits(got[some], axis=1)
                yield found(c["id"][some], K.mix(c["name"][some].view(np.uint64) ^ c["tag"][some].view(np.uint64)).view(np.int64), [x.tobytes() for x in bits])

        for batch in batches:
            t = pa.Table.from_batches([batch])
            mine = t.filter(pa.compute.equal(t["kind"], DICTIONARY))
            if mine.num_rows:
                rest = mine if rest is None else pa.concat_tables([rest, mine])
                key = rest["key"].combine_chunks().to_numpy()
                whole = int(np.searchsorted(key, key[-1]))
                if whole and rest.get_total_buffer_size() > 1 << 23:
                    yield from phrases(rest.slice(0, whole))
                    rest = rest.slice(whole)
            t = t.filter(pa.compute.equal(t["kind"], STRINGS))
            if not t.num_rows:
                continue
            name, ids, done = (t[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("name", "id", "settled"))
            if done.any():
                yield found(ids[done], name[done], None)
                name, ids = name[~done], ids[~done]
            if len(name):
                new = np.concatenate([[last is None or name[0] != last[0]], name[1:] != name[:-1]])
                first = np.concatenate([[last[1] if last else 0], ids[new]])[np.cumsum(new)]
                again = ids > first
                if again.any():
                    yield found(ids[again], name[again], None)
                last = (name[-1], first[-1])
        if rest is not None:
            yield from phrases(rest)

    return ordered.mapInArrow(run, _FOUND)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, trigger: int = 32, with_text: bool = True, most_phrases: int = MOST_PHRASES) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256 and, on demand, the kept bytes."""
    parts, reach = width(docs.sparkSession), length - trigger + 1
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = []
            for b in K.blocks(batch["text"]):
                p = parse(b, length, trigger)
                cols.append((p.key[~p.later], p.name[~p.later], _ids(batch, b)[p.doc[~p.later]]))
            if cols:
                key, name, ids = (np.concatenate(c) for c in zip(*cols))
                keep = _first_of_batch(name, ids)
                # what is settled may go anywhere
                yield _table(key=np.where(keep, key, K.mix(name ^ ids.view(np.uint64))), name=name, id=ids, settled=~keep)

    rows = texts.where("id IS NOT NULL").mapInArrow(parsed, "key long, name long, id long, settled boolean")
    names = lambda kind: F.collect_list(F.when(F.col("kind") == kind, F.col("name")))
    known = cut(_parse_verdicts(rows, parts, most_phrases).groupBy("id").agg(names(PARSE).alias("again"), names(DICTIONARY).alias("open"), names(STRINGS).alias("hot")))

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = ["kind", "key", "name", "id", "settled", "tag", "start", "lead", "count", "bytes"]
        for batch in batches:
            strings = []
            for b in K.blocks(batch["text"]):
                p, ids = parse(b, length, trigger), _ids(batch, b)
                new = ~p.later & ~p.among(*_lists(batch, "again", b))
                at = np.flatnonzero(new & p.among(*_lists(batch, "open", b)))
                if len(at):
                    tag = b.hashes(b.off[:-1], b.off[1:]).view(np.int64)
                    raw = b.data.tobytes()
                    own = [raw[x:y] for x, y in zip(p.start[at].tolist(), (p.start[at] + p.count[at] - 1 + length).tolist())]
                    doc = p.doc[at]
                    values = [np.full(len(at), DICTIONARY, np.int32), p.key[at].view(np.int64), p.name[at].view(np.int64), ids[doc], np.zeros(len(at), bool), tag[doc], p.start[at] - b.off[doc], p.place[at] - p.start[at], p.count[at]]
                    yield pa.RecordBatch.from_arrays([*(pa.array(v) for v in values), pa.array(own, pa.binary())], fields)
                q = p.strings(new & p.among(*_lists(batch, "hot", b)))
                strings.append((q.name[~q.later], ids[q.doc[~q.later]]))
            if strings:
                name, ids = (np.concatenate(c) for c in zip(*strings))
                keep = _first_of_batch(name, ids)
                none = pa.nulls(len(name), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(name), STRINGS, np.int32)), pa.array(np.where(keep, name, K.mix(name ^ ids.view(np.uint64))).view(np.int64)), pa.array(name.view(np.int64)), pa.array(ids), pa.array(~keep), none, none, none, none, pa.nulls(len(name), pa.binary())], fields)

    met = texts.join(known.where("size(open) + size(hot) > 0"), "id").select("id", "text", "again", "open", "hot")
    found = _dictionary_verdicts(met.mapInArrow(spelled, "kind int, key long, name long, id long, settled boolean, tag long, start long, lead long, count long, bytes binary"), parts, length, reach)
    found = found.groupBy("id").agg(F.collect_list(F.when(F.col("bits").isNotNull(), F.struct("name", "bits"))).alias("starts"), F.collect_list(F.when(F.col("bits").isNull(), F.col("name"))).alias("strings"))
    known = cut(known.join(found, "id", "left").select("id", "again", "hot", F.col("starts.name").alias("named"), F.col("starts.bits").alias("bits"), "strings"))

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in K.blocks(batch["text"]):
                change = np.zeros(len(b.data) + 1, np.int32)

                def lose(start: np.ndarray, count: np.ndarray) -> None:
                    np.add.at(change, start, 1)
                    np.add.at(change, start + count - 1 + length, -1)

                p = parse(b, length, trigger)
                lost = p.later | p.among(*_lists(batch, "again", b))
                lose(p.start[lost], p.count[lost])
                q = p.strings(~lost & p.among(*_lists(batch, "hot", b)))
                gone = q.later | q.among(*_lists(batch, "strings", b))
                lose(q.start[gone], q.count[gone])
                named, owner = _lists(batch, "named", b)
                if len(named):
                    tag = b.hashes(b.off[:-1], b.off[1:])
                    known_as = K.mix(named ^ (owner.astype(np.uint64) * _DOC))
                    mine = K.mix(K.mix(p.name ^ tag[p.doc]) ^ (p.doc.astype(np.uint64) * _DOC))
                    order = np.argsort(known_as)
                    i = np.minimum(np.searchsorted(known_as[order], mine), len(order) - 1)
                    hit = np.flatnonzero((known_as[order][i] == mine) & ~lost)
                    bits = np.frombuffer(b"".join(batch["bits"][b.rows].flatten().to_pylist()), np.uint8).reshape(len(named), -1)
                    which, start = np.nonzero(np.unpackbits(bits[order[i[hit]]], axis=1, count=reach))
                    lose(p.start[hit[which]] + start, np.ones(len(which), np.int64))
                covered = np.cumsum(change[:-1]) > 0
                null = pa.compute.is_null(batch["id"].slice(b.rows.start, b.n)).to_numpy(zero_copy_only=False)
                if null.any():
                    covered &= ~null[np.repeat(np.arange(b.n), np.diff(b.off))]
                first = b.runs(covered)[2]
                removed = np.concatenate([[0], np.cumsum(covered)])
                left = [b.data[x:y][~covered[x:y]].tobytes() for x, y in zip(b.off[:-1], b.off[1:])]
                cols = [batch["id"].slice(b.rows.start, b.n), pa.array(np.diff(b.off).astype(np.int64)), pa.array((removed[b.off[1:]] - removed[b.off[:-1]]).astype(np.int64)), pa.array(np.diff(first).astype(np.int64)), pa.array([hashlib.sha256(x).hexdigest() for x in left])]
                names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if with_text:
                    cols.append(pa.array(left, pa.binary()))
                    names.append("kept")
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    met = texts.join(known, "id", "left").select("id", "text", "again", "hot", "named", "bits", "strings")
    return met.mapInArrow(cut_out, schema).withColumnRenamed("id", id_col)


def op6_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir, "doc_id", "text"), with_text=False)
