"""MinHash near-duplicates by an LSH forest, confirmed on whole shingle sets.

1.  Every text becomes its set of distinct k-word shingles; rows with equal sets
    form one class, so copies are never paired with each other.
2.  A class has a signature of ``PERMS`` one-byte minima.  Each tree of the forest
    sorts signatures in its own order of coordinates; neighbours there share a long
    prefix.  A region is a shared prefix of ``DEPTHS[0]`` coordinates.
3.  Inside a region signatures are compared in numpy.  First each member proposes its
    most similar partner and the best connected one; proposals are confirmed on full
    sets and joined into components.  For this step alone, regions of more than
    ``REGION`` members are taken deeper, level by level, and what still is larger at the
    deepest level is dealt into blocks with the region's smallest id; this finds most
    links of a dense group cheaply and need not find all.
4.  Then the members with a pair between *different* components whose signatures are
    within four standard errors of the threshold meet again with their full sets and
    decide those pairs inside the region.  A region of more than ``REGION`` members is
    searched whole for this: everybody outside its largest component meets every
    member, in pairs of blocks.  That leaves no candidate of the forest undecided and
    never writes out the pairs of a group; only a region whose members stay apart costs
    the square of its size.

At similarity s a pair shares a region in none of the trees with probability
``(1 - s**4) ** TREES``: 2e-8 at 0.85 and 3e-6 at 0.8.

Defined results: null or empty text and text without words has an empty set, is
linked with nothing and is its own component; fewer words than k make one shingle;
repeated rows are equal texts and so one component; rows that share an id but not
their text are judged each; a null id has a null component and is kept; an empty table gives an empty
result; columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.components import connected_components
from . import kernel as K
from .io import cut, documents, width

PERMS, TREES, DEPTHS, REGION = 128, 24, (4, 8, 16, 32), 1024
#: Shingles, in all members' sets together, up to which a region is decided at once (8 bytes each).
WEIGHT = 1 << 22
_rng = np.random.default_rng(7)
_MUL = _rng.integers(1, 1 << 63, PERMS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = _rng.integers(1, 1 << 63, PERMS, dtype=np.uint64)
#: Coordinate orders: tree t begins with four coordinates of its own, the others follow shuffled.
ORDERS = [np.concatenate([own := np.arange(4 * t, 4 * t + 4), _rng.permutation(np.setdiff1d(np.arange(PERMS), own))]) for t in range(TREES)]


def shingle_sets(b: K.Block, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle fingerprints, grouped by document, and the per-document first index."""
    b = b.lowered()
    start, end, first = b.words()
    gram, gfirst = K.shingles(b.hashes(start, end), first, k)
    doc = b.doc_of(gfirst)
    _, later = K.repeats(K.mix(gram ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))))
    keep = ~later
    return gram[keep], np.concatenate([[0], np.cumsum(np.bincount(doc[keep], minlength=b.n))])


def signatures(gram: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One byte per permutation and document; zeros for an empty set."""
    n = len(first) - 1
    out = np.zeros((n, PERMS), np.uint8)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        at = first[full]
        for p in range(PERMS):
            low = np.minimum.reduceat((gram ^ _XOR[p]) * _MUL[p], at)
            out[full, p] = K.mix(low) >> np.uint64(56)
    return out


def _sums(gram: np.ndarray, first: np.ndarray, salt: int) -> np.ndarray:
    s = np.concatenate([np.zeros(1, np.uint64), np.cumsum(K.mix(gram ^ np.uint64(salt)))])
    return (s[first[1:]] - s[first[:-1]]).view(np.int64)


def _profiles(docs: DataFrame, k: int) -> DataFrame:
    """id, text_hash, n, h1, h2 (128 bits that name the set) and the signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in K.blocks(batch["text"]):
                gram, first = shingle_sets(b, k)
                sig = signatures(gram, first)
                raw = pa.Array.from_buffers(pa.binary(), b.n, [None, pa.py_buffer(np.arange(0, (b.n + 1) * PERMS, PERMS, dtype=np.int32)), pa.py_buffer(sig.tobytes())])
                yield pa.RecordBatch.from_arrays([batch["id"][b.rows], batch["text_hash"][b.rows], pa.array(np.diff(first).astype(np.int64)), pa.array(_sums(gram, first, 0x1234567)), pa.array(_sums(gram, first, 0xABCDEF01)), raw], ["id", "text_hash", "n", "h1", "h2", "sig"])

    return docs.select("*", F.xxhash64("text").alias("text_hash")).mapInArrow(run, "id long, text_hash long, n long, h1 long, h2 long, sig binary")


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """Each text's class name and its sorted shingle fingerprints as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in K.blocks(batch["text"]):
                gram, first = shingle_sets(b, k)
                sets = [np.sort(gram[x:y]).tobytes() for x, y in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(_sums(gram, first, 0x1234567)), pa.array(sets, pa.binary())], ["id", "grams"])

    return docs.mapInArrow(run, "id long, grams binary")


def _prefix(tree: int, depth: int) -> F.Column:
    """Name of a signature's prefix of ``depth`` coordinates in a tree's order."""
    take = F.concat(*(F.expr(f"substring(sig, {int(c) + 1}, 1)") for c in ORDERS[tree][:depth]))
    return F.xxhash64(F.lit(tree), F.lit(depth), take)


def _regions(classes: DataFrame) -> DataFrame:
    """rep, region, tree, level of every class in a region of at least two members.

    Level -1 are the regions of the first depth that are too large to be compared at once,
    by their members or by their members' sets.
    """
    kept = None
    rows = None
    for level, depth in enumerate(DEPTHS):
        if level == 0:
            names = F.array(*(F.struct(F.lit(t).alias("tree"), _prefix(t, depth).alias("region")) for t in range(TREES)))
            rows = classes.select("rep", "n", F.explode(names).alias("x")).select("rep", "n", "x.tree", "x.region")
        else:
            by_tree = F.array(*(_prefix(t, depth) for t in range(TREES)))
            rows = rows.join(classes.select("rep", by_tree.alias("names")), "rep").select("rep", "n", "tree", F.element_at("names", F.col("tree") + 1).alias("region"))
        sizes = rows.groupBy("region").agg(F.count("*").alias("size"), F.sum("n").alias("weight"), F.min("rep").alias("low")).where("size > 1")
        # cut, so that sizes are not grouped where they are joined: adaptive execution splits a hot region only then
        rows = cut(rows.join(cut(sizes), "region"))
        at_once = F.col("size") <= REGION
        if level == 0:
            at_once &= F.col("weight") <= WEIGHT
        small = rows.where(at_once).select("rep", "tree", "region", F.lit(level).alias("level"))
        kept = small if kept is None else kept.union(small)
        rows = rows.where(~at_once)
        if level == 0:
            kept = kept.union(rows.select("rep", "tree", "region", F.lit(-1).alias("level")))
        if not rows.limit(1).count():
            return kept
        rows = rows if level + 1 == len(DEPTHS) else rows.select("rep", "n", "tree", "region")
    blocks = F.ceil(F.col("size") / REGION)
    block = F.xxhash64("region", F.pmod(F.xxhash64("region", "rep"), blocks))
    low = rows.select(F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("i"), "region", "low", "tree").distinct().select(F.col("low").alias("rep"), "tree", F.xxhash64("region", "i").alias("region"))
    deep = rows.select("rep", "tree", block.alias("region")).union(low).distinct()
    return kept.union(deep.select("rep", "tree", "region", F.lit(len(DEPTHS)).alias("level")))


def _groups(batches: Iterator[pa.RecordBatch], fields: tuple[str, ...], lists: tuple[str, ...] = ()) -> Iterator[dict[str, np.ndarray]]:
    """Runs of one region in rows sorted by region."""
    held: list[dict] = []
    name = None

    def joined() -> dict[str, np.ndarray]:
        return {f: np.concatenate([h[f] for h in held]) for f in held[0]}

    for batch in batches:
        if not batch.num_rows:
            continue
        region = batch["region"].to_numpy(zero_copy_only=False)
        cols = {f: batch[f].to_numpy(zero_copy_only=False) for f in fields}
        for f in lists:
            cols[f] = np.array([*batch[f].to_pylist(), None], object)[:-1]
        raw = batch["sig"].cast(pa.large_binary())
        cols["sig"] = np.frombuffer(b"".join(raw.to_pylist()), np.uint8).reshape(-1, PERMS)
        edge = np.flatnonzero(region[1:] != region[:-1]) + 1
        for x, y in zip([0, *edge], [*edge, len(region)]):
            if held and region[x] != name:
                yield joined()
                held = []
            name = region[x]
            held.append({f: v[x:y] for f, v in cols.items()})
    if held:
        yield joined()


def _alike(sig: np.ndarray, other: np.ndarray) -> np.ndarray:
    return (sig[:, None, :] == other[None, :, :]).sum(2, dtype=np.uint8 if PERMS < 256 else np.int32)


def _proposals(rows: DataFrame, percent: int, least: int) -> DataFrame:
    """a, kind, b, alike: per member its most similar and its best connected partner in each region."""
    sure = percent * PERMS // 100

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, ("rep", "n")):
            rep, n, sig, m = g["rep"], g["n"], g["sig"], len(g["rep"])
            step = max(1, (1 << 22) // (m * PERMS))
            degree, best = np.zeros(m, np.int64), np.zeros(m, np.int64)
            like = np.zeros((m, m), np.uint8)
            for i in range(0, m, step):
                like[i : i + step] = _alike(sig[i : i + step], sig)
            fits = 100 * np.minimum(n[:, None], n[None, :]) >= percent * np.maximum(n[:, None], n[None, :])
            like[~fits | (rep[:, None] == rep[None, :])] = 0
            near = like >= least
            degree = (like >= sure).sum(1)
            at = np.flatnonzero(near.any(1))
            if not len(at):
                continue
            best = like[at].argmax(1)
            hub = np.where(near[at], degree[None, :] + 1, 0).argmax(1)
            a = np.concatenate([rep[at], rep[at]])
            b = np.concatenate([rep[best], rep[hub]])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(np.repeat(np.array([0, 1], np.int32), len(at))), pa.array(b), pa.array(np.concatenate([like[at, best].astype(np.int64), degree[hub] * 256 + like[at, hub]]))], ["a", "kind", "b", "alike"])

    return rows.mapInArrow(run, "a long, kind int, b long, alike long")


def _near(g: dict[str, np.ndarray], percent: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places and likeness of a region's pairs in different components that come near the threshold.

    Where a region has sides 1 and 2, only pairs between them count.  A pair that shares
    several top regions belongs to the first of them only, as each is searched whole.
    """
    rep, n, sig, comp, side, tree = g["rep"], g["n"], g["sig"], g["component"], g["side"], int(g["tree"][0])
    if (comp == comp[0]).all():
        return
    both = side[0] > 0
    left, right = np.flatnonzero(side < 2), np.flatnonzero(side != 1)
    if not len(left) or not len(right):
        return
    step = max(1, (1 << 22) // (len(right) * PERMS))
    for i in range(0, len(left), step):
        rows = left[i : i + step]
        like = _alike(sig[rows], sig[right])
        open_ = (like >= least) & (comp[rows, None] != comp[None, right])
        if not both:
            open_ &= rep[rows, None] < rep[None, right]
        x, y = np.nonzero(open_)
        like = like[x, y]
        x, y = rows[x], right[y]
        keep = 100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])
        for t in range(tree):
            own = ORDERS[t][: DEPTHS[0]]
            keep[keep] = (sig[x[keep]][:, own] != sig[y[keep]][:, own]).any(1)
        if keep.any():
            yield x[keep], y[keep], like[keep]


def _dealt(rows: DataFrame) -> DataFrame:
    """Large regions as pairs of blocks in which everybody outside a region's largest component meets every member.

    Blocks of outsiders come first, then those of the largest component; blocks p <= q
    meet if p is one of outsiders.  Regions of one component are left out.  There are as
    many blocks as keep both the members and the shingles of two of them within what a
    region decided at once may have, on average.
    """
    sizes = rows.groupBy("region", "component").agg(F.count("*").alias("size"), F.sum("n").alias("weight"))
    top = F.max_by(F.struct("component", "size", "weight"), F.struct("size", "component"))
    sizes = sizes.groupBy("region").agg(F.sum("size").alias("size"), F.sum("weight").alias("weight"), top.alias("most")).where("most.size < size")
    half, heavy = max(1, REGION // 2), max(1, WEIGHT // 2)
    deal = lambda size, weight: F.greatest(F.ceil(size / half), F.least(size, F.ceil(weight / heavy)))
    outside = deal(F.col("size") - F.col("most.size"), F.col("weight") - F.col("most.weight"))
    blocks = sizes.select("region", F.col("most.component").alias("top"), outside.alias("out"), deal(F.col("most.size"), F.col("most.weight")).alias("in"))
    blocks = cut(blocks)  # as in _regions
    salted = F.xxhash64("region", "rep")
    outside = F.col("component") != F.col("top")
    rows = rows.join(blocks, "region").withColumn("block", F.when(outside, F.pmod(salted, F.col("out"))).otherwise(F.col("out") + F.pmod(salted, F.col("in"))))
    lower = F.transform(F.sequence(F.lit(0).cast("long"), F.least(F.col("block"), F.col("out") - 1)), lambda p: F.struct(p.alias("p"), F.col("block").alias("q")))
    upper = F.transform(F.sequence(F.col("block"), F.col("out") + F.col("in") - 1), lambda q: F.struct(F.col("block").alias("p"), q.alias("q")))
    meets = F.when(outside, F.array_union(lower, upper)).otherwise(lower)
    rows = rows.withColumn("meet", F.explode(meets))
    side = F.when(F.col("meet.p") == F.col("meet.q"), 0).when(F.col("block") == F.col("meet.p"), 1).otherwise(2)
    return rows.withColumn("side", side).withColumn("region", F.xxhash64("region", "meet.p", "meet.q")).drop("top", "out", "in", "block", "meet")


_OPEN = ("region", "rep", "n", "component", "tree", "side")


def _undecided(rows: DataFrame, percent: int, least: int) -> DataFrame:
    """region, rep: who has an undecided pair in a region (the pairs themselves are not written)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, _OPEN):
            at = [np.unique(np.concatenate([x, y])) for x, y, _ in _near(g, percent, least)]
            if at:
                rep = g["rep"][np.unique(np.concatenate(at))]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rep), g["region"][0])), pa.array(rep)], ["region", "rep"])

    return rows.mapInArrow(run, "region long, rep long")


def _alike_enough(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    both = len(p) + len(q) - len(np.union1d(p, q))
    return 100 * both >= percent * (len(p) + len(q) - both)


def _settled(rows: DataFrame, percent: int, least: int) -> DataFrame:
    """a, b: links between components, decided on full sets inside each region.

    The likeliest pairs come first, and a pair whose components have met by then is
    skipped, so a region writes fewer links than it has members.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, _OPEN, ("grams",)):
            found = list(_near(g, percent, least))
            if not found:
                continue
            x, y, like = (np.concatenate(c) for c in zip(*found))
            comp, rep = g["component"].tolist(), g["rep"].tolist()
            sets = [np.frombuffer(v, np.uint64) for v in g["grams"]]
            open_ = np.bincount(x, minlength=len(sets))
            rows: dict[int, np.ndarray] = {}  # whom a member with many open pairs is alike enough
            size, first, flat = np.array([len(v) for v in sets]), None, None
            up: dict[int, int] = {}

            def top(c: int) -> int:
                while c in up:
                    c = up[c]
                return c

            def alike(a: int, b: int) -> bool:
                nonlocal first, flat
                if open_[a] < 16:
                    return _alike_enough(sets[a], sets[b], percent)
                if a not in rows:
                    if flat is None:
                        flat = np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.int32)
                        first = np.concatenate([[0], np.cumsum(size)])
                    mine = np.zeros(int(flat.max()) + 1, bool)
                    mine[flat[first[a] : first[a + 1]]] = True
                    both = np.add.reduceat(mine[flat], first[:-1], dtype=np.int64)
                    rows[a] = 100 * both >= percent * (size + size[a] - both)
                return bool(rows[a][b])

            links = []
            for i in np.argsort(-like.astype(np.int64), kind="stable").tolist():
                a, b = int(x[i]), int(y[i])
                p, q = top(comp[a]), top(comp[b])
                if p != q and alike(a, b):
                    up[max(p, q)] = min(p, q)
                    links.append((rep[a], rep[b]))
            if links:
                a, b = zip(*links)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("grams").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("grams").alias("y")), "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [_alike_enough(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent) for x, y in zip(batch["x"], batch["y"])]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Links hold where 100 * intersection >= percent * union of the full sets.
    """
    return _judged(docs, id_col, text_col, k, percent).withColumnRenamed("id", id_col).drop("text_hash")


def _judged(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """id, text_hash, n_shingles, component_id, kept of every row."""
    spark = docs.sparkSession
    parts = width(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = cut(_profiles(texts, k))
    # a class is named by h1; its smallest id comes back in at the end
    classes = cut(rows.where("n > 0 AND id IS NOT NULL").groupBy("h1", "h2").agg(F.min("id").alias("id"), F.any_value("n").alias("n"), F.any_value("sig").alias("sig")))
    nodes = classes.select(F.col("h1").alias("rep"), "n", "sig")
    members = cut(_regions(nodes))
    least = int(np.floor(PERMS * (percent / 100 - 4 * np.sqrt(percent / 100 * (1 - percent / 100) / PERMS))))
    full = members.join(nodes, "rep")
    proposed = cut(_proposals(full.where("level >= 0").repartition(parts, "region").sortWithinPartitions("region", "rep"), percent, least).groupBy("a", "kind").agg(F.max_by("b", F.struct("alike", -F.col("b"))).alias("b")))
    pairs = proposed.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    some = proposed.select(F.col("a").alias("id")).distinct()
    ids = classes.join(some.withColumnRenamed("id", "h1"), "h1", "left_semi").select("id").distinct()
    sets = cut(_sets(texts.join(ids, "id", "left_semi"), k))
    links = cut(_confirmed(pairs, sets, percent))
    labels = connected_components(links, cut)
    # without a proposal in a region that was compared at once nobody has a candidate there
    open_ = full.where("level = 0").join(some.withColumnRenamed("id", "rep"), "rep", "left_semi").withColumn("side", F.lit(0))
    large = full.where("level = -1")
    by_rep = labels.withColumnRenamed("node", "rep")
    fields = ["region", "tree", "rep", "n", "sig", "component", "side"]
    open_ = open_.join(by_rep, "rep", "left").withColumn("component", F.coalesce("component", "rep")).select(fields)
    dense = large.limit(1).count() > 0
    if dense:
        large = cut(large.join(by_rep, "rep", "left").withColumn("component", F.coalesce("component", "rep")))
        open_ = open_.union(_dealt(large).select(fields))
    open_ = cut(open_)
    sort = ["region", "rep"]
    part = _undecided(open_.repartition(parts, "region").sortWithinPartitions(*sort), percent, least)
    if dense:
        part = cut(part)
        more = classes.join(part.select(F.col("rep").alias("h1")).distinct(), "h1", "left_semi").join(some.withColumnRenamed("id", "h1"), "h1", "left_anti").select("id").distinct()
        if more.limit(1).count():
            sets = sets.union(cut(_sets(texts.join(more, "id", "left_semi"), k)))
    part = open_.join(part, sort).join(sets.dropDuplicates(["id"]).withColumnRenamed("id", "rep"), "rep")
    links2 = cut(_settled(part.repartition(parts, "region").sortWithinPartitions(*sort), percent, least))
    labels2 = connected_components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(links2), cut)
    named = classes.select("h1", "h2", "id").join(labels2.withColumnRenamed("node", "h1"), "h1", "left").select("h1", "h2", "id", F.coalesce("component", "h1").alias("component"))
    lowest = named.groupBy("component").agg(F.min("id").alias("lowest"))
    named = named.join(lowest, "component").select("h1", "h2", "lowest")
    out = rows.select("id", "text_hash", "n", "h1", "h2").join(named, ["h1", "h2"], "left")
    component = F.when(F.col("id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("lowest", "id"))
    out = out.select("id", "text_hash", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each near-duplicate group, the one with the smallest id.

    Rows are told apart by id and text, so a row that only shares its id with a kept one goes.
    """
    lost = _judged(docs, id_col, text_col, k, percent).where("NOT kept").select(F.col("id").alias("__lost"), "text_hash").distinct()
    same = (F.col(id_col).cast("long") == F.col("__lost")) & (F.xxhash64(F.col(text_col)) == F.col("text_hash"))
    return docs.join(lost, same, "left_anti")


def op7_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Three-word shingles at 85 in 100, as the contract of this query states."""
    return near_duplicates(documents(spark, sf_dir, "doc_id", "text"), k=3, percent=85)
