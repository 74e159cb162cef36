import itertools
import json
import random
import struct
import zlib
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import pixels as P
from tidemark.functions import scalars as S
from tidemark.operators import boxes as B
from tidemark.operators import checks as K
from tidemark.operators import intervals as I
from tidemark.operators import metrics as M
from tidemark.operators import quality as Q
from tidemark.operators import selection as C
from tidemark.operators import series as R
from tidemark.operators import state as T
from tidemark.operators import text as X
from tidemark.operators import vectors as V
from tidemark.operators.components import connected_components
from tidemark.operators.graphs import chain, depths
from tidemark.plans.vector import cut
from tidemark.sources import files as SRC
from tidemark.streaming import events as ST


def text_rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_windows_are_legal_and_cover(spark):
    n = spark.range(1, 1001).select(F.col("id").alias("key"), F.col("id").alias("len"))
    got: dict = {}
    for key, k, at, size in rows(I.windows(n, "len", 81, 8).select("key", "k", "offset", "n"), "key", "k"):
        got.setdefault(key, []).append((at, size))
    for key in range(5, 1001):
        seen = np.zeros(key, bool)
        for at, size in got[key]:
            assert size % 4 == 1 and size <= 81 and 0 <= at and at + size <= key
            seen[at : at + size] = True
        assert seen.all()
    assert not set(got) & set(range(5))


def test_stitch_plan_tiles_every_subset(spark):
    spans = [(0, 21), (13, 34), (26, 47), (39, 60), (60, 70)]
    cases = [(i, *s, 0, 75) for i, c in enumerate(c for n in range(1, 6) for c in itertools.combinations(spans, n)) for s in c]
    df = spark.createDataFrame(cases, "case long, start long, stop long, low long, high long")
    plan: dict = {}
    for c, *op in rows(I.stitch_plan(df, ["case"], "low", "high"), "case", "seq"):
        plan.setdefault(c, []).append(op)
    for c, ops in plan.items():
        own = sorted((s[1], s[2]) for s in cases if s[0] == c)
        at = 0
        for _, op, where, n, span, prev in ops:
            assert where == at and n > 0
            for side in (span, prev):
                if side >= 0:
                    assert own[side][0] <= where and where + n <= own[side][1]
            if op == "source":
                assert not any(a < where + n and where < b for a, b in own)
            at += n
        assert at == 75


def test_series_edges(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([0.0, 5.0, 5.0, 16.0, 0.0, 0.0, 7.0, 7.0])] + [("b", 0, 9.0)], "k string, f long, v double")
    assert rows(R.runs(df, F.col("v") <= 0, ["k"], "f").select("k", "start", "stop")) == [("a", 0, 1), ("a", 4, 6)]
    got = rows(R.track_events(df.withColumn("s", F.lit(1.0)), F.col("v") > 0, "v", "s", ["k"], "f"), "k", "f")
    assert got == [("a", 0, "disappeared"), ("a", 1, "reappeared"), ("a", 3, "area_jump"), ("a", 4, "disappeared"), ("a", 6, "reappeared")]
    assert [r[0] for r in rows(R.centred_mean(df, "v", ["k"], "f", 3).select("smooth", "k", "f"), "k", "f")][-1] == 9.0
    gone = df.where("false")
    assert rows(R.deadband(gone, "v", ["k"], "f", 1.0)) == []
    assert rows(R.runs(gone, F.col("v") <= 0, ["k"], "f")) == []


def test_overlaps_once_each(spark):
    rng = np.random.default_rng(3)
    a = [(0, int(x), int(x + n)) for x, n in zip(rng.integers(0, 500, 60), rng.integers(0, 200, 60))]
    b = [(0, int(x), int(x + n)) for x, n in zip(rng.integers(0, 500, 40), rng.integers(0, 90, 40))]
    A = spark.createDataFrame(a, "k int, start long, stop long").withColumn("i", F.monotonically_increasing_id())
    Bf = spark.createDataFrame(b, "k int, b_start long, b_stop long").withColumn("j", F.monotonically_increasing_id())
    want = sum(x[1] < x[2] and y[1] < y[2] and x[1] < y[2] and y[1] < x[2] for x in a for y in b)
    got = rows(I.overlaps(A, Bf, ["k"], 50).select("i", "j"))
    assert len(got) == len(set(got)) == want


def test_components_and_graphs(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7), (None, 3)], "a long, b long")
    got = dict(rows(connected_components(e, cut)))
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in (100, 101, 102)} == {100}
    assert rows(connected_components(e.where("false"), cut)) == []
    with pytest.raises(ValueError):
        depths(spark.createDataFrame([(0, 1), (1, 2), (2, 1)], "a long, b long"), most=6)
    assert rows(chain(spark.createDataFrame([("a", "b"), ("b", None)], "n string, u string"), "n", "u")) == [("a", "a>b", False), ("b", "b", False)]


def test_duplicate_impostors_do_not_vouch_for_themselves(spark):
    m = spark.createDataFrame([(0, 1), (0, 1), (0, 1), (0, 1), (9, 2), (9, 3), (9, 4)], "component long, image long")
    assert rows(V.dominant(m, "image")) == [(9, 3, 3)]


def test_pairs_match_numpy(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(120, 8))
    v /= np.linalg.norm(v, axis=1)[:, None]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    s = v @ v.T
    want = {(i, j) for i in range(120) for j in range(i + 1, 120) if s[i, j] >= 0.6}
    assert {r[:2] for r in rows(V.similar_pairs(df, "id", "v", 0.6, block=25))} == want


def test_staleness_truth_table(spark):
    cases = [(s, a, b) for s in ("skipped", "done", "failed", None) for a in ("x", "y", None) for b in ("x",)]
    df = spark.createDataFrame(cases, "s string, a string, b string")
    for s, a, b, needs in df.select("s", "a", "b", T.needs_run(F.col("s"), F.col("a"), F.col("b"))).collect():
        assert needs == (False if s == "skipped" else not (s == "done" and a == b))


def test_versions_conflict(spark, tmp_path):
    p = str(tmp_path / "t")
    df = spark.range(3)
    assert T.save_if_unchanged(df, p, -1) == 0 and T.save_if_unchanged(df, p, 0) == 1
    with pytest.raises(T.Conflict):
        T.save_if_unchanged(df, p, 0)
    assert T.load_current(spark, p)[1] == 1


def test_expectations(spark):
    bad = Q.violations(spark.createDataFrame([(1, 5), (2, None), (3, 9)], "id int, n int"), "id", {"odd": F.col("n") % 2 == 1, "small": F.col("n") < 8})
    assert rows(bad) == [("2", "odd"), ("2", "small"), ("3", "small")]
    with pytest.raises(ValueError):
        Q.require(bad)
    Q.require(bad.where("false"))


def test_text_scans(spark):
    lines = spark.createDataFrame([(1, "x"), (2, "[one]"), (3, "a"), (4, "[two"), (5, "[two]"), (6, "b")], "n int, line string")
    assert [(r["section"], r["line"]) for r in X.sections(lines.withColumn("f", F.lit(0)), ["f"], "n", "line").orderBy("n").collect()] == [("one", "a"), ("one", "[two"), ("two", "b")]
    g = spark.createDataFrame([("p", 0.0, 1.0), ("p", 5.0, 6.0), ("q", None, None)], "path string, low double, high double")
    r = spark.createDataFrame([(1, "p", 5.0, 6.0), (2, "p", 2.0, 3.0), (3, "q", 7.0, 9.0), (4, "z", 0.0, 0.0)], "i int, path string, low double, high double")
    assert rows(X.allowed(r, g, ["i"], "path"), "i") == [(1, "permitted"), (2, "outside interval"), (3, "permitted"), (4, "not listed")]
    one = spark.range(1)
    assert one.select(S.like_glob(F.lit("Foo.TXT"), "*.txt"), S.like_glob(F.lit("Foo"), "oo"), S.has_word(F.lit("a b.c d"), "b.c"), S.has_word(F.lit("ab.cd"), "b.c")).first() == (True, True, True, False)
    assert one.select(S.stem(F.lit("--A b!C_")), S.human_time(F.lit(3725)), S.tag({"v": F.lit(True), "x": F.lit(True)}, "v_")).first() == ("a_b_c", "1h02m05s", "x")


def test_boxes(spark):
    b = spark.createDataFrame([("i", 1, 0.0, 0.0, 10.0, 10.0, 0.9), ("i", 2, 0.0, 0.0, 10.0, 10.0, 0.8), ("i", 3, 20.0, 0.0, 30.0, 10.0, 0.1)], "image string, box int, x0 double, y0 double, x1 double, y1 double, score double")
    assert rows(B.suppress(b, ["image"], "box")) == [("i", 1), ("i", 3)]
    pts = lambda k, dx: F.array(*(F.struct(F.lit(k * x + dx).alias("x"), F.lit(k * y + dx).alias("y")) for x, y in ((0.0, 0.0), (10.0, 0.0), (7.0, 4.0))))
    one = spark.range(1).select(B.orientation(pts(1.0, 0.0)).alias("a"), B.orientation(pts(2.0, 30.0)).alias("b")).first()
    assert one["a"] == pytest.approx(one["b"]) == pytest.approx(0.4)


def test_pixels():
    m = np.zeros((200, 200), bool)
    m[60:140, 60:140] = True
    near, far = np.roll(m, 1, 1), np.roll(m, 8, 1)
    assert P.boundary_f(m, m) == 1 and P.boundary_f(m, near) > 0.9 and P.boundary_f(m, far) < 0.7
    assert P.mask_iou(m, far) > 0.8 and np.isnan(P.boundary_f(m, m & ~m))
    x = np.arange(120) // 3 % 2 * 255.0
    v, h = np.tile(x, (120, 1)), np.tile(x, (120, 1)).T
    hv, hh = P.orientation_histogram(v), P.orientation_histogram(h)
    assert P.chi_square(hv, hh) > 0.5 and P.chi_square(hv, P.orientation_histogram(v / 2)) < 1e-6
    one = P.one_sided_ramp(m, 8)
    assert (one[m] == 1).all() and one[59, 100] < 1
    lab, n = P.components(np.array([[1, 0, 1], [1, 0, 0], [0, 1, 1]], bool))
    assert n == 3 and lab[0, 0] == lab[1, 0] != lab[2, 1]
    assert P.laplacian_variance(v) > P.laplacian_variance(P.blur(v, 2))
    assert len(P.mean_hash(v)) == 4


def test_sources(spark, tmp_path):
    (tmp_path / "list.txt").write_text("# c\n\nfoo.jpg\nbar.png  # t\nfoo.jpg\n")
    assert rows(SRC.read_list(spark, str(tmp_path / "list.txt"))) == [("bar.png",), ("foo.jpg",)]
    (tmp_path / "allow.txt").write_text("a.mp4 1.5-2\nb.mp4\n")
    assert rows(SRC.read_allow_list(spark, str(tmp_path / "allow.txt"))) == [("a.mp4", 1.5, 2.0), ("b.mp4", None, None)]
    head = json.dumps({"__metadata__": {"a": "b"}, "w": {"dtype": "F16", "shape": [2, 3], "data_offsets": [0, 12]}}).encode()
    (tmp_path / "m.safetensors").write_bytes(struct.pack("<Q", len(head)) + head + b"\0" * 12)
    assert [tuple(r)[1:5] for r in SRC.read_tensor_headers(spark, str(tmp_path)).collect()] == [("w", "F16", [2, 3], 6)]
    (tmp_path / "s.pgm").write_bytes(b"P5 3 2 255\n" + bytes(range(6)))
    (tmp_path / "t.pgm").write_bytes(b"P5 3 2 255\nxx")
    got = {r["path"][-5:]: r["pixels"] for r in SRC.read_stills(spark, str(tmp_path)).collect()}
    assert bytes(got["s.pgm"]) == bytes(range(6)) and got["t.pgm"] is None
    probe = {"format": {"filename": "x", "duration": "2.0"}, "streams": [{"codec_type": "video", "width": 4, "height": 3, "r_frame_rate": "30000/1001", "avg_frame_rate": "25/1"}, {"codec_type": "audio", "codec_name": "aac", "channels": 2}]}
    (tmp_path / "p.json").write_text(json.dumps(probe))
    r = SRC.read_probes(spark, str(tmp_path / "p.json")).first()
    assert r["frames"] == 60 and r["frames_from"] == "estimated" and r["variable_rate"] and r["audio"][0]["codec"] == "aac"
    assert SRC.single_file(spark, str(tmp_path), [".safetensors"], "model").endswith("m.safetensors")
    with pytest.raises(FileNotFoundError):
        SRC.single_file(spark, str(tmp_path), [".pgm"], "still")
    with pytest.raises(ValueError):
        SRC.write_nonempty(spark.range(0), str(tmp_path / "none"))
    assert SRC.merge_config({"a": {"x": 1, "y": 2}, "b": [1]}, {"a": {"y": 3}, "b": [2]}) == {"a": {"x": 1, "y": 3}, "b": [2]}
    assert SRC.stack([{"name": "a", "strength": 2}, "b"]) == [{"name": "a", "strength": 2.0}, {"name": "b", "strength": 1.0}]
    for wrong in (["a", "a"], "../a", [{"name": "a", "strength": "1"}], [3]):
        with pytest.raises(ValueError):
            SRC.stack(wrong)
    assert SRC.markdown(spark.range(1)).endswith("| 0 |")


def test_streams_equal_batch(spark, data, tmp_path):
    batch = spark.read.parquet(f"{data}/events.parquet")
    src = str(tmp_path / "in")
    batch.orderBy("ts").coalesce(1).write.parquet(src)
    s = ST.read_files(spark, src, batch.schema)
    b = batch.withColumn("ts", F.col("ts").cast("timestamp"))
    for i, f in enumerate((lambda x: ST.tumbling(x, "6 hours", "event_type", "value"), lambda x: ST.sliding(x, "6 hours", "2 hours", "event_type", "value"), lambda x: ST.sessions(x, "6 hours", "user_id", "value"))):
        got = ST.drain(f(s), f"w{i}", str(tmp_path / f"c{i}"), "complete" if i < 2 else "append")
        want = f(b)
        r = lambda df: sorted(tuple(str(round(v, 4) if isinstance(v, float) else v) for v in x) for x in df.collect())
        have, need = r(got), r(want)
        assert have == need if i < 2 else set(have) <= set(need) and len(have) > 0.9 * len(need)
    twice = ST.once(s, ["event_type", "user_id"], late="60 days")
    assert ST.drain(twice, "once", str(tmp_path / "co")).count() == batch.select("event_type", "user_id").distinct().count()
    for every in (1, 2, 99):  # whole tables after each batch, after every second, never
        q = ST.upsert_into(s, str(tmp_path / f"table{every}"), ["user_id"], ["ts", "event_id"], str(tmp_path / f"cu{every}"), every)
        q.awaitTermination()
    assert T.current_version(spark, str(tmp_path / "table99")) == -1 < T.current_version(spark, str(tmp_path / "table1"))
    for every in (1, 2, 99):
        table = ST.upserted(spark, str(tmp_path / f"table{every}"), ["user_id"], ["ts", "event_id"])
        assert rows(table.select("user_id", "event_id")) == rows(T.latest(b, ["user_id"], "ts", "event_id").select("user_id", "event_id"))
    table = ST.upserted(spark, str(tmp_path / "table2"), ["user_id"], ["ts", "event_id"])
    assert rows(table.select("user_id", "event_id")) == rows(T.latest(b, ["user_id"], "ts", "event_id").select("user_id", "event_id"))
    runs = ST.presence_runs(s.select("user_id", "event_id", "value"), "user_id", "event_id", "value", 20.0)
    assert ST.drain(runs, "runs", str(tmp_path / "cr")).count() > 0


def test_selection(spark, tmp_path):
    import zipfile

    from tidemark.operators import selection as C

    df = spark.createDataFrame([(1, "pending"), (2, "done")], "k int, status string")
    with pytest.raises(ValueError):
        C.choose(df, "k")
    with pytest.raises(ValueError):
        C.choose(df, "k", only=[1], everything=True)
    assert rows(C.choose(df, "k", only=[2])) == [(2, "done")]
    with pytest.raises(KeyError):
        C.update_point(df, "k", 9, status="x")
    assert rows(C.update_point(df, "k", 1, status="x")) == [(1, "x"), (2, "done")]
    nodes = spark.createDataFrame([("10", "load", {"a": "1"}), ("9", "load", {"a": "1"})], "id string, kind string, inputs map<string,string>")
    assert {r["id"]: r["inputs"]["a"] for r in C.patch_nth(nodes, "load", 1, "a", "2").collect()} == {"9": "1", "10": "2"}
    with pytest.raises(KeyError):
        C.patch_nth(nodes, "load", 2, "a", "2")
    links = spark.createDataFrame([("9", "b", "10", 0)], "id string, field string, source string, slot int")
    assert {r["id"]: json.loads(r["json"])["inputs"] for r in C.graph_json(nodes, links).collect()} == {"10": {"a": "1"}, "9": {"a": "1", "b": '["10","0"]'}}
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/y.txt", "hello")
    assert [tuple(r)[1:] for r in SRC.list_archives(spark, str(tmp_path)).collect()] == [("x/y.txt", 5)]


def test_fold_keeps_null_keys_and_exact_integers(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(None, i, v) for i, v in enumerate([0.0, 1.0, 0.5])] + [(big, i, v) for i, v in enumerate([5.0, 30.0, 31.0])] + [(7, 0, None), (7, 1, 2.0), (7, 2, None)], "k long, t long, v double")
    got = {(r["k"], r["t"]): r["held"] for r in R.deadband(df, "v", ["k"], "t", 10.0).collect()}
    assert got == {(None, 0): 0.0, (None, 1): 0.0, (None, 2): 0.0, (big, 0): 5.0, (big, 1): 30.0, (big, 2): 30.0, (7, 0): None, (7, 1): 2.0, (7, 2): 2.0}
    assert {(r["k"], r["t"]): r["smooth"] for r in R.smoothed(df, "v", ["k"], "t", 0.5).collect()}[None, 2] == 0.75
    assert R.deadband(df.where("false"), "v", ["k"], "t", 10.0).count() == 0


def test_fold_over_batches(spark):
    """Series that run on over Arrow batches, and their ends."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        df = spark.range(40).select((F.col("id") % 3).alias("k"), F.concat(F.lit("g"), F.col("id") % 3).alias("s"), F.col("id").alias("t"))
        got = R.fold(df, ["k", "s"], ["t"], lambda s, c: ((s or 0) + len(c[0]), None), ["t"], "n long", lambda s: [[s]])
        assert text_rows(got) == [("0", "g0", "14"), ("1", "g1", "13"), ("2", "g2", "13")]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_joint_leaders_equal_a_plain_loop(spark):
    r = random.Random(8)
    items = []
    for i in range(60):
        v = np.array([r.gauss(1, 0.4), r.gauss(0, 0.6)])
        items.append((i, (v / np.linalg.norm(v)).tolist(), {c: [r.choice([10.0, 40.0]), 0.0, r.random() * 9] for c in "abc" if r.random() < 0.5}))
    df = spark.createDataFrame([(1, *x) for x in items], "g int, id long, v array<double>, p map<string,array<double>>")
    got = {x["id"]: x["leader"] for x in V.joint_leaders(df, ["g"], ["id"], "id", "v", "p", 0.6, 12.0).collect()}
    led, want = [], {}
    for i, v, p in items:
        for leader, w, theirs in led:
            both = set(p) & set(theirs)
            if both and np.dot(v, w) > 0.6 and np.mean([np.linalg.norm(np.subtract(p[c], theirs[c])) for c in both]) < 12.0:
                theirs.update({c: x for c, x in p.items() if c not in theirs})
                want[i] = leader
                break
        else:
            led.append((i, v, dict(p)))
            want[i] = i
    assert got == want and 3 < len(led) < 55


def test_exact_percentiles(spark):
    r = np.random.default_rng(2)
    data = [(k, float(v)) for k, n in ((None, 7), (1, 1), (2, 500), (3, 40)) for v in (r.normal(size=n) if k != 3 else [4.0] * n)] + [(4, None), (2, None)]
    got = {x["k"]: (x["p01"], x["p50"], x["p99"]) for x in M.exact_percentiles(spark.createDataFrame(data, "k int, v double"), "v", ["k"], (0.01, 0.5, 0.99), bins=16).collect()}
    want = {k: tuple(np.percentile([v for j, v in data if j == k and v is not None], (1, 50, 99))) for k in (None, 1, 2, 3)}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_nearest_value(spark):
    r = random.Random(3)
    left = [(i, r.randrange(3), r.randrange(100) / 100 + i % 2 * 0.002) for i in range(80)] + [(100, 9, 0.5), (101, 0, 0.5), (101, 0, 0.5)]
    bank = [(i, r.randrange(3), r.randrange(100) / 100, r.randrange(3)) for i in range(90)]
    got = C.nearest_value(spark.createDataFrame(left, "id long, g long, v double"), spark.createDataFrame(bank, "b long, g long, at double, size long"), ["g"], "v", "at", [-F.col("size"), F.col("b")], 2)
    want = []
    for i, g, v in left:
        best = min(((round(abs(v - at), 2), -size, b) for b, h, at, size in bank if h == g), default=(None, None, None))
        want.append((i, best[2]))
    assert sorted((x["id"], x["b"] if x["b"] is not None else -1) for x in got.collect()) == sorted((i, -1 if b is None else b) for i, b in want)


def test_likely_pairs_and_agreement(spark):
    r = np.random.default_rng(6)
    base = r.normal(size=(40, 24))
    m = np.concatenate([base, base + 0.25 * r.normal(size=base.shape), base[:20] + 0.5 * r.normal(size=(20, 24))])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, i % 7, v.tolist()) for i, v in enumerate(m)], "id long, g long, v array<double>")
    sim = m @ m.T
    want = {(i, j) for i in range(len(m)) for j in range(i + 1, len(m)) if sim[i, j] >= 0.8}
    for block in (2048, 4):
        got = [(x["a"], x["b"]) for x in V.likely_pairs(df, "id", "v", 0.8, block=block).collect()]
        assert len(got) == len(set(got)) and set(got) <= want and len(got) >= 0.9 * len(want)
    assert V.bucket_recall(0.8) > 0.8 and V.bucket_recall(1.0) == 1.0
    members = df.where("id % 2 = 0")
    for cells in (1 << 24, 300):
        got = {x["id"]: x["agreement"] for x in V.median_agreement(df, members, "id", "g", "v", cells).collect()}
        for i in range(len(m)):
            assert got[i] == pytest.approx(np.median([sim[i, j] for j in range(0, len(m), 2) if j % 7 != i % 7]))
    assert V.median_agreement(df.where("g = 0"), df.where("g = 0"), "id", "g", "v").count() == 0


def test_passages(spark):
    docs = spark.createDataFrame([(1, "a bc ABC"), (2, None), (None, "xabcx"), (3, "")], "id long, text string")
    p = spark.createDataFrame([("p", "abc"), ("q", "abc"), ("r", "b"), ("s", ""), (None, "x"), ("t", None)], "k string, p string")
    for chars in (1 << 24, 1):
        assert text_rows(X.passage_hits(docs, "id", "text", p, "k", "p", block_chars=chars)) == sorted([("1", "r"), ("None", "None"), ("None", "p"), ("None", "q"), ("None", "r")])
    assert ("1", "p") in text_rows(X.passage_hits(docs, "id", "text", p, "k", "p", lower=True))
    files = spark.createDataFrame([(1, bytearray(b"ok")), (2, bytearray(b"a\0b")), (3, bytearray(b"\xff")), (4, bytearray(b"x" * 50)), (5, bytearray(b""))], "id int, content binary")
    assert [r["id"] for r in X.readable(files, most=49).orderBy("id").collect()] == [1, 5]


def test_one_of_many_writers_wins(spark, tmp_path):
    p = str(tmp_path / "t")
    T.save_if_unchanged(spark.range(2), p, -1)

    def write(i):
        try:
            return T.save_if_unchanged(spark.range(100 + i), p, 0)
        except T.Conflict:
            return None

    with ThreadPoolExecutor(6) as pool:
        got = list(pool.map(write, range(6)))
    assert sorted(x for x in got if x is not None) == [1] and T.load_current(spark, p)[0].count() == 100 + got.index(1)
    (tmp_path / "t/_claims/v=2").touch()  # a writer that died
    with pytest.raises(T.Conflict):
        T.save_if_unchanged(spark.range(5), p, 1)
    assert T.save_if_unchanged(spark.range(5), p, 1, stale_after=-1.0) == 2


def test_guards_and_bindings(spark):
    p = spark.createDataFrame([("a", "x+"), ("a", "(("), ("b", " "), ("c", "y")], "s string, p string")
    assert text_rows(K.broken_guards(p, "s", "p", ["a", "b", "c", "d"])) == [("a", "not a pattern"), ("b", "missing or empty"), ("d", "missing or empty")]
    df = spark.createDataFrame([(1, 5), (1, 5), (2, 5), (2, None)], "k int, n int")
    assert text_rows(K.unequal(df, ["k"], ["n"])) == [("2", "n", "2")]
    with pytest.raises(ValueError):
        K.require_equal(df, ["k"], ["n"])


def encode_png(a, filters):
    """An 8-bit PNG with one filter a row, by the format's rules."""
    h, w, c = a.shape
    x = np.zeros((h + 1, w + 1, c), int)
    x[1:, 1:] = a
    lines = b""
    for y in range(1, h + 1):
        f = filters[y % len(filters)]
        left, up, both = x[y, :-1], x[y - 1, 1:], x[y - 1, :-1]
        p = left + up - both
        near = np.abs(np.stack([p - left, p - up, p - both])).argmin(0)
        guess = (0 * left, left, up, (left + up) // 2, np.choose(near, [left, up, both]))[f]
        lines += bytes([f]) + ((x[y, 1:] - guess) % 256).astype(np.uint8).tobytes()
    part = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, {1: 0, 2: 4, 3: 2, 4: 6}[c], 0, 0, 0)) + part(b"IDAT", zlib.compress(lines)) + part(b"IEND", b"")


def test_pictures(spark, tmp_path):
    r = np.random.default_rng(3)
    want = {}
    for c in (1, 2, 3, 4):
        a = r.integers(0, 256, (9, 7, c)).astype(np.uint8)
        (tmp_path / f"{c}.png").write_bytes(encode_png(a, [0, 1, 2, 3, 4]))
        want[f"{c}.png"] = np.broadcast_to(a[..., :1] if c < 3 else a[..., :3], (9, 7, 3))
    want["p.ppm"] = want["3.png"]
    (tmp_path / "p.ppm").write_bytes(b"P6\n7 9\n255\n" + want["3.png"].tobytes())
    (tmp_path / "q.pgm").write_bytes(b"P5 7 9 255\n" + b"\n" * 63)
    want["q.pgm"] = np.full((9, 7, 3), 10)
    (tmp_path / "broken.png").write_bytes(encode_png(want["3.png"], [1])[:-20])
    (tmp_path / "other.png").write_bytes(b"GIF89a")
    got = {x["path"].rsplit("/", 1)[1]: x for x in SRC.read_pictures(spark, str(tmp_path)).collect()}
    assert got["broken.png"]["pixels"] is None and got["other.png"]["height"] is None
    for name, a in want.items():
        assert (np.frombuffer(got[name]["pixels"], np.uint8).reshape(got[name]["height"], got[name]["width"], 3) == a).all(), name


def test_pixel_layers_and_energies():
    r = np.random.default_rng(4)
    back, subject = np.zeros((4, 4, 3)), np.full((4, 4, 3), 100.0)
    alpha, front = np.full((4, 4), 0.5), np.ones((4, 4))
    front[0] = 0
    got = P.layered(back, subject, alpha, front)
    assert (got[0] == 0).all() and (got[1:] == 50).all()
    grey = np.repeat(r.integers(0, 256, (20, 20, 1)), 3, 2)
    mask = np.ones((20, 20), bool)
    assert P.chroma_energy([grey], [mask]) == pytest.approx(0, abs=1e-9) and np.isnan(P.chroma_energy([grey], [mask & False]))
    colour = grey.copy()
    colour[..., 0] = r.integers(0, 256, (20, 20))
    assert P.chroma_energy([colour, colour], [mask, mask]) > 1
    flat = np.full((96, 160), 7.0)
    assert P.shrink(flat).shape == (96, 160) and P.motion_and_texture([flat, flat + 2]) == [(0.0, 0.0), (2.0, 0.0)]
    big = np.add.outer(np.arange(192.0), np.arange(320.0))
    assert P.shrink(big) == pytest.approx(np.add.outer(np.arange(96) * 2 + 0.5, np.arange(160) * 2 + 0.5))


def test_yaml_settings(tmp_path):
    (tmp_path / "a.yaml").write_text("x: {y: 1, z: [1]}\nw: a\n")
    (tmp_path / "b.yml").write_text("extends: a.yaml\nx: {y: 2}\n")
    assert SRC.load_config(str(tmp_path / "b.yml")) == {"x": {"y": 2, "z": [1]}, "w": "a"}
