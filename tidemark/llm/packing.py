"""Order-preserving packing of token streams into fixed windows.

Documents keep their order within an input partition.  Their tokens form one
stream per partition; a window may end after a document, after a sentence, or, in
stretches without either, at a coarse grid of forced cuts.  The cuts minimise
padding plus truncation penalties: with ``best[j]`` the cost up to cut j and
``pos`` its token position, a padded window costs ``limit - (pos[j] - pos[i])``, so
the best predecessor is the minimum of ``best[i] + pos[i]`` over a sliding range
and a monotone queue finds it in constant time; windows of a power of two are not
padded and are looked up one by one.

Tokens come from a vocabulary file by the tokenizers library.  Blocks of text are
split into the vocabulary's pre-token pieces on bytes, each distinct piece is
encoded once, and ids are gathered; documents with characters that the byte
classes do not know (or with a special token's string) are encoded whole.  In either
case a sentence ends with a piece that ends in one of ``STOPS``.

Nothing is shuffled and state is bounded: a partition is packed in runs of about
``run_tokens``.  Each run is packed to its end, all but its last four windows are settled,
and those are packed again with the next run; the cuts are the best of a run, not of the
stream, which costs next to nothing as the best cuts of a prefix soon agree with those of
the whole.

Defined results: null and empty text is the end token alone; every id is in
exactly one piece; repeated rows are packed each; an empty table gives an empty
result; columns other than id and text are ignored.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernel as K

DOC_END, SENTENCE, FORCED = 0, 1, 2

_LETTER, _DIGIT, _SPACE, _OTHER = 0, 1, 2, 3
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_CLASS[48:58] = _DIGIT
_CLASS[K.IS_SPACE] = _SPACE
#: Bytes that need the tokenizer's own splitting: control characters and lead bytes other than of U+00C0 to U+017F.
_STRANGE = np.zeros(256, bool)
_STRANGE[[*range(9), *range(14, 32), 127]] = True
_STRANGE[0xC0:] = True
_STRANGE[[0xC3, 0xC4, 0xC5]] = False


#: What ends a sentence: the line feed and full stops, question and exclamation marks of many scripts.
STOPS = tuple(".!?\n\u2026\u203c\u203d\u2047\u2048\u2049\u3002\uff0e\uff61\uff01\uff1f\u061f\u06d4\u037e\u0589\u055c\u055e\u0964\u0965\u104a\u104b\u1362\u1367\u1368\u17d4\u17d5\u2028\u2029")
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: The vocabulary's character for each byte.
_CHAR_OF = {x: chr(x) for x in _PLAIN} | {x: chr(256 + i) for i, x in enumerate(x for x in range(256) if x not in _PLAIN)}
_STOPS = tuple("".join(_CHAR_OF[x] for x in c.encode()) for c in STOPS)


def _ranked(path: str):
    """The vocabulary file's merges as a function of one piece's bytes, if its ids are in merge order; else None."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    byte_of = {c: x for x, c in _CHAR_OF.items()}
    as_bytes = lambda t: bytes(byte_of[c] for c in t)
    vocab = model["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [vocab.get(a + b, -1) for a, b in merges]
    if model.get("ignore_merges") or any(y <= x for x, y in zip(ids, ids[1:])) or len(vocab) < len(ids) + 256:
        return None
    made = {a + b for a, b in merges}
    ranks = {as_bytes(t): i for t, i in vocab.items() if t in made or t in byte_of}
    # not a public name of that library; without it every piece goes to the tokenizer itself
    core = getattr(tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}), "_core_bpe", None)
    return getattr(core, "encode_single_piece", None)


class PieceTokenizer:
    """Ids of whole blocks of text, equal to encoding each document by ``tokenizers``."""

    CACHE = 1 << 18

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.own.get_added_tokens_decoder().values()]
        self.seen: dict[int, bytes] = {}  # fingerprint of a piece: its ids
        self.single = _ranked(path)

    def whole(self, text: str) -> list[int]:
        return self.own.encode(text, add_special_tokens=False).ids

    def marked(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a text encoded whole, and marks of ids that end a sentence."""
        got = self.own.encode(text, add_special_tokens=False)
        words, tokens = got.word_ids, got.tokens
        close = np.zeros(len(tokens), bool)
        tail = ""  # of the piece so far; a stop has at most three bytes, which may be several tokens
        for i, token in enumerate(tokens):
            tail = (tail + token)[-3:]
            if i + 1 == len(tokens) or words[i] != words[i + 1] or words[i] is None:
                close[i] = tail.endswith(_STOPS)
                tail = ""
        return np.array(got.ids, np.uint32), close

    def pieces(self, b: K.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the pre-token pieces and the per-document first index."""
        d, n = b.data, len(b.data)
        cls = _CLASS[d]
        head = np.zeros(n + 1, bool)
        head[1:n] = cls[1:] != cls[:-1]
        head[b.off] = True
        at = np.flatnonzero(head)  # runs of one class; the last entry is n
        run, nxt = at[:-1], at[1:]
        last = np.zeros(n + 1, bool)
        last[b.off] = True
        blank = (cls[run] == _SPACE) & ~last[nxt]  # white space before something else
        tail = nxt[blank] - 1
        head[tail] = True
        joins = tail[d[tail] == 32] + 1  # a space goes with what follows
        head[joins] = False
        # contractions: a lone apostrophe that no space precedes, and the letters after it
        lone = run[(cls[run] == _OTHER) & (nxt - run == 1) & (d[run] == 39) & head[run] & ~last[nxt]]
        lone = lone[cls[lone + 1] == _LETTER]
        if len(lone):
            one = d[lone + 1]
            two = d[np.minimum(lone + 2, n - 1)]
            inside = ~last[lone + 2]
            short = np.isin(one, list(b"stmd"))
            long = inside & (((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l"))))
            for take, width in ((short, 2), (long & ~short, 3)):
                head[lone[take] + 1] = False
                head[lone[take] + width] = True
        head[b.off] = True
        at = np.flatnonzero(head)
        start, end = at[:-1], at[1:]
        return start, end, np.searchsorted(start, b.off)

    def encode(self, b: K.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, per-document first index, and marks of ids that end a sentence."""
        raw = b.data.tobytes()
        odd = np.zeros(b.n, bool)
        strange = np.flatnonzero(_STRANGE[b.data])
        signs = np.flatnonzero((b.data[:-1] == 0xC3) & ((b.data[1:] == 0x97) | (b.data[1:] == 0xB7))) if len(b.data) else strange
        for at in (strange, signs):
            odd[np.searchsorted(b.off, at, "right") - 1] = True
        for mark in self.special:
            i = raw.find(mark)
            while i >= 0:
                odd[np.searchsorted(b.off, i, "right") - 1] = True
                i = raw.find(mark, i + 1)
        start, end, first = self.pieces(b)
        keep = ~odd[b.doc_of(first)]
        s, e, owner = start[keep], end[keep], b.doc_of(first)[keep]
        h = b.hashes(s, e)
        uniq, at, inv = np.unique(h, return_index=True, return_inverse=True)
        known = self.seen
        if len(known) > self.CACHE:
            known.clear()
        keys = uniq.tolist()
        new = [i for i, k in enumerate(keys) if k not in known]
        if new:
            where = at[new]
            for i, x, y in zip(new, s[where].tolist(), e[where].tolist()):
                ids = self.single(raw[x:y]) if self.single else self.whole(raw[x:y].decode())
                known[keys[i]] = array("I", ids).tobytes()
        ids = [known[k] for k in keys]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), np.uint32)
        base = np.cumsum(size) - size
        width = size[inv]
        total = int(width.sum())
        out_at = np.cumsum(width) - width
        tokens = flat[np.arange(total) - np.repeat(out_at - base[inv], width)]
        close = np.zeros(total, bool)
        stop = np.isin(b.data[e - 1], list(b".!?\n")) if len(e) else np.zeros(0, bool)
        close[out_at[stop] + width[stop] - 1] = True
        doc_first = np.concatenate([[0], np.cumsum(np.bincount(owner, weights=width, minlength=b.n).astype(np.int64))])
        if odd.any():
            parts, marks, counts = [], [], []
            for i in range(b.n):
                if odd[i]:
                    got, ends = self.marked(raw[b.off[i] : b.off[i + 1]].decode())
                    parts.append(got)
                    marks.append(ends)
                else:
                    parts.append(tokens[doc_first[i] : doc_first[i + 1]])
                    marks.append(close[doc_first[i] : doc_first[i + 1]])
                counts.append(len(parts[-1]))
            return np.concatenate(parts), np.concatenate([[0], np.cumsum(counts)]), np.concatenate(marks)
        return tokens, doc_first, close


@lru_cache(maxsize=1)
def tokenizer(path: str) -> PieceTokenizer:
    """The tokenizer of a file; a worker process reads it once and keeps it, with the pieces it has seen."""
    made = PieceTokenizer(path)
    K.tidy()
    return made


def best_cuts(pos: np.ndarray, kind: np.ndarray, limit: int, penalty: tuple[float, float, float]) -> list[int]:
    """Indices into ``pos`` (ascending, from 0 to the stream's end) of the cheapest cuts.

    Neighbouring positions must lie at most ``limit`` apart.
    """
    p, cost_at = pos.tolist(), np.array(penalty)[kind].tolist()
    m = len(p)
    free: dict[int, list[int]] = {}
    power = 1
    while power < limit:
        want = pos - power
        i = np.searchsorted(pos, want)
        for j in np.flatnonzero(pos[np.minimum(i, m - 1)] == want).tolist():
            if want[j] >= 0:
                free.setdefault(j, []).append(int(i[j]))
        power *= 2
    full = limit & (limit - 1)  # 0: a full window is a power of two, its padding is 0 anyway
    assert full == 0, "the window must be a power of two"
    best, back = [0.0] * m, [0] * m
    queue: deque[int] = deque([0])
    for j in range(1, m):
        pj = p[j]
        while p[queue[0]] < pj - limit:
            queue.popleft()
        i = queue[0]
        c = best[i] + p[i] + limit - pj
        for f in free.get(j, ()):
            if best[f] < c:
                c, i = best[f], f
        best[j], back[j] = c + cost_at[j], i
        v = best[j] + pj
        while queue and best[queue[-1]] + p[queue[-1]] >= v:
            queue.pop()
        queue.append(j)
    cuts, j = [m - 1], m - 1
    while j:
        j = back[j]
        cuts.append(j)
    return cuts[::-1]


def candidates(length: int, ends: np.ndarray, sentences: np.ndarray, grid: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a window may end and their kinds; gaps of more than ``grid`` get forced cuts."""
    pos = np.concatenate([[0], sentences, ends, [length]])
    kind = np.concatenate([[DOC_END], np.full(len(sentences), SENTENCE), np.full(len(ends), DOC_END), [DOC_END]])
    order = np.lexsort((kind, pos))
    pos, kind = pos[order], kind[order]
    first = np.concatenate([[True], pos[1:] != pos[:-1]])
    pos, kind = pos[first], kind[first]
    gap = np.diff(pos)
    extra = (gap - 1) // grid
    if extra.any():
        base = np.repeat(pos[:-1], extra)
        step = np.arange(extra.sum()) - np.repeat(np.cumsum(extra) - extra, extra) + 1
        pos = np.concatenate([pos, base + step * grid])
        kind = np.concatenate([kind, np.full(len(base), FORCED)])
        order = np.argsort(pos)
        pos, kind = pos[order], kind[order]
    return pos, kind


class Packer:
    """Packs one partition's stream run by run; ``add`` and ``finish`` return piece rows."""

    def __init__(self, limit: int, penalty: tuple[float, float, float], grid: int, first_sequence: int):
        self.limit, self.penalty, self.grid, self.sequence = limit, penalty, grid, first_sequence
        self.ids = np.zeros(0, np.uint32)
        self.marks = np.zeros(0, bool)
        self.docs: list[tuple] = []  # (id, tokens of the document already settled, tokens here, all its tokens)

    def add(self, ids: np.ndarray, marks: np.ndarray, docs: list[tuple], last: bool = False) -> list[tuple]:
        self.ids, self.marks = np.concatenate([self.ids, ids]), np.concatenate([self.marks, marks])
        self.docs += docs
        n = len(self.ids)
        if not n:
            return []
        ends = np.cumsum([d[2] for d in self.docs])
        pos, kind = candidates(n, ends, np.flatnonzero(self.marks) + 1, self.grid)
        cuts = pos[best_cuts(pos, kind, self.limit, self.penalty)]
        if not last:
            cuts = cuts[: np.searchsorted(cuts, max(0, n - 4 * self.limit), "right")]
        return self._settle(cuts, ends)

    def _settle(self, cuts: np.ndarray, ends: np.ndarray) -> list[tuple]:
        if len(cuts) < 2:
            return []
        stop = cuts[-1]
        edges = np.union1d(cuts, np.concatenate([[0], ends[ends <= stop]]))
        a, z = edges[:-1], edges[1:]
        doc = np.searchsorted(ends, a, "right")
        window = np.searchsorted(cuts, a, "right") - 1
        begin = ends - [d[2] for d in self.docs]
        rows = []
        for x, y, k, w in zip(a.tolist(), z.tolist(), doc.tolist(), window.tolist()):
            d = self.docs[k]
            rows.append((d[0], d[1] + x - int(begin[k]), y - x, zlib.crc32(self.ids[x:y].tobytes()), d[3], self.sequence + w, x - int(cuts[w])))
        self.sequence += len(cuts) - 1
        k = int(np.searchsorted(ends, stop, "right"))
        rest = self.docs[k:]
        if rest:
            used = stop - int(begin[k])
            rest[0] = (rest[0][0], rest[0][1] + used, rest[0][2] - used, rest[0][3])
        self.ids, self.marks, self.docs = self.ids[stop:], self.marks[stop:], rest
        return rows


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048, end_id: int = 1, sentence_penalty: float = 4.0, forced_penalty: float = 16.0, grid: int = 64, run_tokens: int = 1 << 20) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from pyspark import TaskContext

        tok = tokenizer(tokenizer_path)
        context = TaskContext.get()
        packer = Packer(limit, (0.0, sentence_penalty, forced_penalty), grid, (context.partitionId() if context else 0) << 40)
        ids, marks, held, count = [], [], [], 0
        kind = rows_id

        def out(found: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*found))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], kind), *(pa.array(c, pa.int64()) for c in cols[1:])], ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            names = batch["id"].to_pylist()
            for b in K.blocks(batch["text"], 2 * K.BLOCK_BYTES):
                t, first, close = tok.encode(b)
                n = np.diff(first) + 1
                at = first[1:] + np.arange(b.n)  # places of the end ids
                full, mark = np.empty(len(t) + b.n, np.uint32), np.zeros(len(t) + b.n, bool)
                body = np.ones(len(full), bool)
                body[at] = False
                full[at], full[body], mark[body] = end_id, t, close
                ids.append(full)
                marks.append(mark)
                held += [(x, 0, k, k) for x, k in zip(names[b.rows], n.tolist())]
                count += len(full)
                if count >= run_tokens:
                    found = packer.add(np.concatenate(ids), np.concatenate(marks), held)
                    ids, marks, held, count = [], [], [], 0
                    if found:
                        yield out(found)
        z = np.zeros(0, np.uint32)
        found = packer.add(np.concatenate([z, *ids]), np.concatenate([z.astype(bool), *marks]), held, last=True)
        if found:
            yield out(found)

    from pyspark.sql.pandas.types import to_arrow_type

    rows_id = to_arrow_type(rows.schema["id"].dataType)
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_packing(spark, sf_dir: str) -> DataFrame:
    from .io import table

    return pack(table(spark, sf_dir, "documents"), default_tokenizer())
