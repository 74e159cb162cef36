"""Queries: picture geometry, decisions over it, and checks with messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import checks as K
from ..operators import geometry as G
from .common import table

QUERIES: dict = {}


def query(name: str, sql: str | None):
    def put(fn):
        QUERIES[name] = (fn, sql)
        return fn

    return put


# a part is a picture: width and height from its key and size
_PIC = "p AS (SELECT p_partkey AS id, 200 + p_partkey % 1700 AS w, 160 + p_size * 37 AS h, CASE WHEN p_partkey % 3 = 0 THEN 4.0::DOUBLE / 3 ELSE 1.0::DOUBLE END AS sar FROM part)"


def pictures(spark, d):
    k = F.col("p_partkey")
    return table(spark, d, "part").select(k.alias("id"), (200 + k % 1700).alias("w"), (160 + F.col("p_size") * 37).alias("h"), F.when(k % 3 == 0, F.lit(4.0) / 3).otherwise(F.lit(1.0)).alias("sar"))


@query("scale_and_pad", f"""WITH {_PIC}, s AS (SELECT *, least(1280 / (w * sar), 720.0::DOUBLE / h) AS f FROM p), r AS (SELECT *, CAST(round_even(w * sar * f, 0) AS BIGINT) AS a, CAST(round_even(h * f, 0) AS BIGINT) AS b FROM s), e AS (SELECT *, a - a % 2 AS x, b - b % 2 AS y FROM r)
SELECT id, x AS scale_w, y AS scale_h, (1280 - x) // 2 AS pad_x, (720 - y) // 2 AS pad_y, CAST(floor((1 - x * y / (1280 * 720.0::DOUBLE)) * 1000000 + 0.01::DOUBLE) AS BIGINT) AS pad_millionths FROM e""")
def _(spark, d):
    f = G.fit(F.col("w"), F.col("h"), F.col("sar"), F.lit(1280), F.lit(720))
    return pictures(spark, d).withColumn("f", f).select("id", "f.scale_w", "f.scale_h", "f.pad_x", "f.pad_y", F.floor(F.col("f.pad_fraction") * 1000000 + 0.01).alias("pad_millionths"))


@query("aspect_targets", f"""WITH {_PIC}, r AS (SELECT id, w * sar / h AS r FROM p), t AS (SELECT id, r, CAST(greatest(16, round_even(round_even(sqrt(1280 * 720 / r), 0) / 16, 0) * 16) AS BIGINT) AS height FROM r)
SELECT id, CAST(greatest(16, round_even(round_even(height * r, 0) / 16, 0) * 16) AS BIGINT) AS width, height FROM t""")
def _(spark, d):
    return pictures(spark, d).withColumn("t", G.matching_target(F.col("w"), F.col("h"), F.col("sar"), F.lit(1280), F.lit(720))).select("id", "t.width", "t.height")


@query("resize_targets", f"""WITH {_PIC}, s AS (SELECT *, greatest(1.0::DOUBLE, 1080.0::DOUBLE / least(w, h)) AS f, 512.0::DOUBLE / least(w, h) AS g FROM p), v AS (SELECT *, CAST(greatest(1, round_even(w * g, 0)) AS BIGINT) AS vw, CAST(greatest(1, round_even(h * g, 0)) AS BIGINT) AS vh FROM s)
SELECT id, CAST(round_even(w * f / 2, 0) AS BIGINT) * 2 AS width, CAST(round_even(h * f / 2, 0) AS BIGINT) * 2 AS height, vw, vh, CAST(floor((vw - 512) / 2.0) AS BIGINT) AS "left", CAST(floor((vh - 512) / 2.0) AS BIGINT) AS top FROM v""")
def _(spark, d):
    x = pictures(spark, d).withColumn("t", G.short_edge(F.col("w"), F.col("h"), F.lit(1080))).withColumn("v", G.bucket_view(F.col("w"), F.col("h"), F.lit(512)))
    return x.select("id", "t.width", "t.height", F.col("v.width").alias("vw"), F.col("v.height").alias("vh"), "v.left", "v.top")


@query("span_crops", f"""WITH {_PIC}, q AS (SELECT *, (id * 7 % w)::DOUBLE AS ax, (id * 11 % h)::DOUBLE AS ay, (id * 7 % w + id % 90)::DOUBLE AS bx, (id * 11 % h + id % 40)::DOUBLE AS by_ FROM p), s AS (SELECT *, sqrt((ax - bx) * (ax - bx) + (ay - by_) * (ay - by_)) AS span FROM q),
c AS (SELECT *, greatest(0, CAST(round_even((ax + bx) / 2 - span * 2.6::DOUBLE, 0) AS BIGINT)) AS l, greatest(0, CAST(round_even((ay + by_) / 2 - span * 2.6::DOUBLE, 0) AS BIGINT)) AS t, least(w, CAST(round_even((ax + bx) / 2 + span * 2.6::DOUBLE, 0) AS BIGINT)) AS r, least(h, CAST(round_even((ay + by_) / 2 + span * 2.6::DOUBLE, 0) AS BIGINT)) AS b FROM s), g AS (SELECT *, span > 1 AND r - l >= 16 AND b - t >= 16 AS good FROM c)
SELECT id, CASE WHEN good THEN l END AS l, CASE WHEN good THEN t END AS t, CASE WHEN good THEN greatest(16, CAST(round_even((r - l) * (96 / span), 0) AS BIGINT)) END AS width, CASE WHEN good THEN greatest(16, CAST(round_even((b - t) * (96 / span), 0) AS BIGINT)) END AS height FROM g""")
def _(spark, d):
    k, w, h = F.col("id"), F.col("w"), F.col("h")
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    points = F.array(point(k * 7 % w, k * 11 % h), point(k * 7 % w + k % 90, k * 11 % h + k % 40))
    return pictures(spark, d).withColumn("c", G.span_crop(points, w, h, F.lit(96.0))).select("id", F.col("c.left").alias("l"), F.col("c.top").alias("t"), "c.width", "c.height")


@query("grid_layout", "SELECT o_custkey, n, CASE WHEN n % 4 = 0 THEN 4 WHEN n % 3 = 0 THEN 3 WHEN n % 2 = 0 THEN 2 ELSE n END AS columns FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)")
def _(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).withColumn("columns", G.grid_columns(F.col("n")))


_BOXES = "b AS (SELECT l_orderkey AS image, l_linenumber AS box, (l_partkey % 300)::DOUBLE AS x0, (l_suppkey % 90)::DOUBLE AS y0, l_partkey % 300 + 20 + l_quantity * 2 AS x1, l_suppkey % 90 + 40 + l_quantity * 4 + l_partkey % 200 AS y1 FROM lineitem)"


def boxes(spark, d):
    x, y, n = (F.col("l_partkey") % 300).cast("double"), (F.col("l_suppkey") % 90).cast("double"), F.col("l_quantity")
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("image"), F.col("l_linenumber").alias("box"), x.alias("x0"), y.alias("y0"), (x + 20 + n * 2).alias("x1"), (y + 40 + n * 4 + F.col("l_partkey") % 200).alias("y1"))


@query("view_classes", f"""WITH {_BOXES} SELECT image, box, CASE WHEN box % 5 = 0 THEN 'detail' WHEN box % 3 = 0 AND 120 / greatest(y1 - y0, 1) > 0.45::DOUBLE THEN 'anchor' WHEN (y1 - y0) / 400 > 0.80::DOUBLE AND (y1 - y0) / greatest(x1 - x0, 1) > 1.7::DOUBLE THEN 'full_extent' WHEN (y1 - y0) / 400 > 0.55::DOUBLE THEN 'upper_extent' ELSE 'detail' END AS view, count(*) AS n FROM b GROUP BY ALL""")
def _(spark, d):
    box = F.when(F.col("box") % 5 != 0, F.struct("x0", "y0", "x1", "y1"))
    anchor = F.when(F.col("box") % 3 == 0, F.struct(F.lit(0.0).alias("y0"), F.lit(120.0).alias("y1")))
    return boxes(spark, d).withColumn("view", G.view_of(box, anchor, F.lit(400.0))).groupBy("image", "box", "view").agg(F.count("*").alias("n"))


@query("crop_plan", f"""WITH {_BOXES}, g AS (SELECT image, quantile_cont(y1 - y0, 0.9) AS h, quantile_cont(x1 - x0, 0.9) AS w, quantile_cont((y1 - y0) * 1.2503::DOUBLE, 0.95) AS nh, quantile_cont((x1 - x0) * 1.2503::DOUBLE, 0.95) AS nw FROM b GROUP BY 1),
c AS (SELECT image, greatest(h / 0.7801::DOUBLE, w / 0.7801::DOUBLE * (720 / 1280.0::DOUBLE), nh, nw * (720 / 1280.0::DOUBLE)) AS ch FROM g), k AS (SELECT *, ch * (1280 / 720.0::DOUBLE) AS cw FROM c), f AS (SELECT *, CASE WHEN cw > 640 OR ch > 480 THEN least(640 / cw, 480 / ch) ELSE 1.0::DOUBLE END AS k FROM k)
SELECT image, CAST(round_even(cw * k / 2, 0) AS BIGINT) * 2 AS crop_w, CAST(round_even(ch * k / 2, 0) AS BIGINT) * 2 AS crop_h FROM f""")
def _(spark, d):
    return G.crop_plan(boxes(spark, d), ["image"], F.lit(640.0), F.lit(480.0), F.lit(1280.0), F.lit(720.0), fraction=0.7801, margin=0.2503)


@query("match_decisions", """WITH m AS (SELECT user_id, max(value) / 400 AS conf, (max(value) - coalesce(list_sort(list(value), 'DESC')[2], 0)) / 100 AS margin, count(*) FILTER (WHERE event_type = 'purchase') AS evidence FROM events GROUP BY 1)
SELECT user_id, CASE WHEN evidence = 0 THEN 'no match evidence' WHEN conf < 0.42::DOUBLE THEN 'low confidence' WHEN margin < 0.08::DOUBLE THEN 'ambiguous' END AS reason FROM m""")
def _(spark, d):
    from ..operators.series import margin

    e = table(spark, d, "events")
    m = margin(e, "value", ["user_id"], "event_id").join(e.groupBy("user_id").agg(F.count_if(F.col("event_type") == "purchase").alias("evidence")), "user_id")
    return m.select("user_id", G.needs_user(F.col("best") / 400, F.col("margin") / 100, F.col("evidence")).alias("reason"))


@query("setting_violations", """WITH s AS (SELECT o_orderkey, CAST(o_totalprice AS BIGINT) % 90 + 1 AS n, o_custkey * 4 AS w, o_orderkey * 8 AS h, o_custkey % 80 AS o, CASE WHEN o_orderstatus = 'P' THEN 'black' WHEN o_orderstatus = 'F' THEN 'white_is_regenerate' END AS p FROM (SELECT * REPLACE (floor(o_totalprice) AS o_totalprice) FROM orders))
SELECT o_orderkey, array_to_string(list_filter([CASE WHEN (n - 1) % 4 <> 0 THEN 'length' END, CASE WHEN w % 16 <> 0 THEN 'width' END, CASE WHEN h % 16 <> 0 THEN 'height' END, CASE WHEN o >= n THEN 'overlap' END, CASE WHEN p IS DISTINCT FROM 'white_is_regenerate' THEN 'polarity' END], lambda x: x IS NOT NULL), ',') AS problems FROM s""")
def _(spark, d):
    n = F.floor("o_totalprice") % 90 + 1
    p = F.when(F.col("o_orderstatus") == "P", "black").when(F.col("o_orderstatus") == "F", "white_is_regenerate")
    return table(spark, d, "orders").select("o_orderkey", F.array_join(K.setting_problems(n, F.col("o_custkey") * 4, F.col("o_orderkey") * 8, F.col("o_custkey") % 80, p), ",").alias("problems"))


@query("illegal_chunks", "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS n, (CAST(l_quantity AS BIGINT) - 1) // 4 * 4 + 1 AS legal FROM lineitem WHERE (CAST(l_quantity AS BIGINT) - 1) % 4 <> 0")
def _(spark, d):
    return K.illegal_chunks(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("long").alias("n")), "n")


@query("clip_verification", """WITH c AS (SELECT l_orderkey, l_linenumber, l_quantity AS q, l_partkey % 7 AS a, l_suppkey % 5 AS b, l_discount AS x, l_linenumber % 2 = 0 AS wanted, l_returnflag = 'N' AS got FROM lineitem)
SELECT l_orderkey, l_linenumber, count(*) AS n, CASE WHEN q = 1 THEN 'missing' ELSE array_to_string(list_filter([CASE WHEN abs(a - 3) > 2 THEN 'frames' END, CASE WHEN b <> 2 THEN 'size' END, CASE WHEN x > 0.02::DOUBLE THEN 'rate' END, CASE WHEN x * 4 > 0.2::DOUBLE THEN 'duration' END, CASE WHEN wanted AND NOT got THEN 'audio' END], lambda p: p IS NOT NULL), ',') END AS problems FROM c GROUP BY ALL""")
def _(spark, d):
    clip = lambda frames, width, fps, duration, audio: F.struct(frames.alias("frames"), width.alias("width"), F.lit(720).alias("height"), fps.alias("fps"), duration.alias("duration"), audio.alias("audio"))
    x = F.col("l_discount")
    got = F.when(F.col("l_quantity") != 1, clip(F.col("l_partkey") % 7 + 47, F.col("l_suppkey") % 5, x, x * 4, F.col("l_returnflag") == "N"))
    want = clip(F.lit(50), F.lit(2), F.lit(0.0), F.lit(0.0), F.col("l_linenumber") % 2 == 0)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.array_join(K.clip_problems(got, want), ",").alias("problems")).groupBy("l_orderkey", "l_linenumber", "problems").agg(F.count("*").alias("n"))


@query("sync_verification", """SELECT o_orderkey, array_to_string(list_filter([CASE WHEN abs(v - a) > 0.15::DOUBLE THEN 'drift' END, CASE WHEN abs(v - e) > 0.25::DOUBLE THEN 'length' END], lambda p: p IS NOT NULL), ',') AS problems
FROM (SELECT o_orderkey, o_totalprice / 1000 AS v, CASE WHEN o_custkey % 3 <> 0 THEN o_totalprice / 1000 + o_custkey % 4 * 0.1::DOUBLE END AS a, o_totalprice / 1000 - o_orderkey % 5 * 0.1::DOUBLE AS e FROM orders)""")
def _(spark, d):
    v, c = F.col("o_totalprice") / 1000, F.col("o_custkey")
    return table(spark, d, "orders").select("o_orderkey", F.array_join(K.sync_problems(v, F.when(c % 3 != 0, v + c % 4 * 0.1), v - F.col("o_orderkey") % 5 * 0.1), ",").alias("problems"))


@query("module_binding", """WITH m AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem WHERE l_discount > 0.05), h AS (SELECT DISTINCT l_suppkey, l_partkey, 1 AS bound FROM lineitem WHERE l_quantity > 10)
SELECT l_suppkey, count(*) AS modules, count(*) FILTER (WHERE bound IS NULL) AS unbound, count(*) FILTER (WHERE bound IS NULL) = 0 AS ok FROM m LEFT JOIN h USING (l_suppkey, l_partkey) GROUP BY 1""")
def _(spark, d):
    li = table(spark, d, "lineitem")
    return K.unbound(li.where("l_discount > 0.05").select("l_suppkey", "l_partkey").distinct(), li.where("l_quantity > 10"), ["l_suppkey"], "l_partkey", "l_partkey")


@query("geometry_agreement", "SELECT l_partkey, field, n AS \"values\" FROM (SELECT l_partkey, count(DISTINCT l_returnflag) AS a, count(DISTINCT l_linestatus) AS b FROM lineitem GROUP BY 1), LATERAL (VALUES ('l_returnflag', a), ('l_linestatus', b)) v(field, n) WHERE n > 1")
def _(spark, d):
    return K.unequal(table(spark, d, "lineitem"), ["l_partkey"], ["l_returnflag", "l_linestatus"])


@query("role_bindings", """WITH w(role, key) AS (VALUES ('F', '1-URGENT'), ('F', '9-NONE'), ('P', '5-LOW'), ('X', '1-URGENT')) SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = role AND o_orderpriority = key)""")
def _(spark, d):
    have = table(spark, d, "orders").select("o_orderstatus", F.col("o_orderpriority").alias("key"), F.col("o_orderkey").cast("string").alias("value"))
    return K.binding_problems(have, "o_orderstatus", {"F": ["1-URGENT", "9-NONE"], "P": ["5-LOW"], "X": ["1-URGENT"]})


@query("presence_checklist", "SELECT p_partkey, used.p IS NOT NULL AS ok, CASE WHEN used.p IS NULL THEN 'missing' END AS detail FROM part LEFT JOIN (SELECT DISTINCT l_partkey AS p FROM lineitem WHERE l_quantity > 45) used ON used.p = p_partkey")
def _(spark, d):
    have = table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return K.presence(table(spark, d, "part"), have, "p_partkey")


@query("guard_of_guards", "SELECT section, problem FROM (VALUES ('alpha', 'not a pattern'), ('gamma', 'missing or empty')) v(section, problem) WHERE EXISTS (SELECT 1 FROM benchmark)")
def _(spark, d):
    b = table(spark, d, "benchmark")
    p = b.select(F.lit("beta").alias("section"), F.regexp_replace("text", "[^a-z ]", "").alias("pattern")).union(b.select(F.lit("alpha"), F.concat(F.lit("("), F.regexp_replace("text", "[^a-z ]", "")))).union(b.select(F.lit("gamma"), F.lit("  ")))
    return K.broken_guards(p, "section", "pattern", ["alpha", "beta", "gamma"])


@query("shortened_messages", "SELECT doc_id, left(text, 2000) AS message, length(text) > 2000 AS cut FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", S.shortened(F.col("text"), 2000).alias("message"), (F.char_length("text") > 2000).alias("cut"))
