"""Queries: metric roll-ups, incremental state, data quality, boxes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import boxes as B
from ..operators import metrics as M
from ..operators import quality as Q
from ..operators import selection as C
from ..operators import state as T
from .common import r6, table

QUERIES: dict = {}


def query(name: str, sql: str | None):
    def put(fn):
        QUERIES[name] = (fn, sql)
        return fn

    return put


@query("ratio_of_sums_rollup", """WITH x AS (SELECT l_returnflag, l_linestatus, sum(l_extendedprice) AS seconds, sum(l_quantity) AS frames, max(l_discount) AS peak FROM lineitem GROUP BY ALL)
SELECT l_returnflag, l_linestatus, round(seconds / frames, 6) AS per_frame, peak, round(seconds / frames * 28800, 4) AS projected, l_linestatus = arg_min(l_linestatus, seconds) OVER (PARTITION BY l_returnflag) AS cheapest FROM x""")
def _(spark, d):
    x = table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_extendedprice").alias("s"), F.sum("l_quantity").alias("f"), F.max("l_discount").alias("peak"))
    low = F.min_by("l_linestatus", "s").over(Window.partitionBy("l_returnflag"))
    return x.select("l_returnflag", "l_linestatus", F.round(F.col("s") / F.col("f"), 6).alias("per_frame"), "peak", F.round(F.col("s") / F.col("f") * 28800, 4).alias("projected"), (F.col("l_linestatus") == low).alias("cheapest"))


@query("mean_of_means", """WITH f AS (SELECT l_suppkey, l_shipdate, avg(l_quantity) AS m FROM lineitem WHERE l_discount > 0.04 GROUP BY ALL), v AS (SELECT l_suppkey, var_pop(l_quantity) FILTER (WHERE l_discount > 0.04) AS inside, var_pop(l_quantity) FILTER (WHERE l_discount <= 0.04) AS outside FROM lineitem GROUP BY 1)
SELECT l_suppkey, round(avg(m), 6) AS mean, round(any_value(inside), 6) AS var_in, round(any_value(outside), 6) AS var_out FROM f JOIN v USING (l_suppkey) GROUP BY 1""")
def _(spark, d):
    li = table(spark, d, "lineitem")
    v = li.groupBy("l_suppkey").agg(F.var_pop(F.when(F.col("l_discount") > 0.04, F.col("l_quantity"))).alias("a"), F.var_pop(F.when(F.col("l_discount") <= 0.04, F.col("l_quantity"))).alias("b"))
    m = M.mean_of_means(li, "l_quantity", ["l_suppkey", "l_shipdate"], ["l_suppkey"], F.col("l_discount") > 0.04)
    return m.join(v, "l_suppkey").select("l_suppkey", r6("mean"), F.round("a", 6).alias("var_in"), F.round("b", 6).alias("var_out"))


@query("masked_percentiles", """SELECT l_linestatus, l_returnflag, round(quantile_cont(l_extendedprice, 0.01), 6) AS p01, round(quantile_cont(l_extendedprice, 0.25), 6) AS p25, round(quantile_cont(l_extendedprice, 0.9), 6) AS p90, round(quantile_cont(l_extendedprice, 0.95), 6) AS p95, round(quantile_cont(l_extendedprice, 0.99), 6) AS p99,
round(median(l_extendedprice), 6) AS middle, min(l_extendedprice) AS worst, max(l_extendedprice) AS best FROM lineitem WHERE l_tax > 0.02 GROUP BY ALL""")
def _(spark, d):
    x = table(spark, d, "lineitem").where("l_tax > 0.02").groupBy("l_linestatus", "l_returnflag")
    out = x.agg(*M.percentiles("l_extendedprice", (0.01, 0.25, 0.9, 0.95, 0.99)), F.median("l_extendedprice").alias("middle"), F.min("l_extendedprice").alias("worst"), F.max("l_extendedprice").alias("best"))
    return out.select("l_linestatus", "l_returnflag", *(r6(c) for c in ("p01", "p25", "p90", "p95", "p99", "middle")), "worst", "best")


@query("within_tolerance_fraction", """SELECT l_returnflag, round(avg(CAST(abs(l_quantity - 25) <= 1 AS DOUBLE)), 6) AS within_1, round(avg(CAST(abs(l_quantity - 25) <= 2 AS DOUBLE)), 6) AS within_2, round(avg(CAST(abs(l_quantity - 25) <= 4 AS DOUBLE)), 6) AS within_4, max(abs(l_quantity - 25)) AS drift FROM lineitem GROUP BY 1""")
def _(spark, d):
    v = F.col("l_quantity") - 25
    x = table(spark, d, "lineitem").groupBy("l_returnflag").agg(*M.within(v, (1, 2, 4)), F.max(F.abs(v)).alias("drift"))
    return x.select("l_returnflag", r6("within_1"), r6("within_2"), r6("within_4"), "drift")


@query("median_palette", """WITH f AS (SELECT *, hour(ts) // 6 AS part FROM events), p AS (SELECT event_type, part, median(value) AS m, count(*) AS n FROM f GROUP BY ALL), t AS (SELECT count(*) AS t FROM events),
g AS (SELECT event_type, median(m) AS level, count(*) AS seen, sum(n) AS n FROM p GROUP BY 1), s AS (SELECT event_type, avg(abs(m - level)) AS spread FROM p JOIN g USING (event_type) GROUP BY 1)
SELECT event_type, round(level, 6) AS level, round(n / t, 6) AS share, round(spread, 6) AS spread, spread < 8 AS stable FROM g JOIN s USING (event_type), t WHERE seen >= greatest(2, 4 // 3) AND n >= greatest(64, 0.001 * t)""")
def _(spark, d):
    f = table(spark, d, "events").withColumn("part", F.floor(F.hour("ts") / 6))
    p = f.groupBy("event_type", "part").agg(F.median("value").alias("m"), F.count("*").alias("n"))
    g = p.groupBy("event_type").agg(F.median("m").alias("level"), F.count("*").alias("seen"), F.sum("n").alias("n"))
    s = p.join(g.select("event_type", "level"), "event_type").groupBy("event_type").agg(F.avg(F.abs(F.col("m") - F.col("level"))).alias("spread"))
    share = M.palette(f, ["event_type"], ["value"], 0.001, 64).select("event_type", "share")
    return g.join(s, "event_type").join(share, "event_type").where("seen >= 2").select("event_type", r6("level"), r6("share"), r6("spread"), (F.col("spread") < 8).alias("stable"))


@query("weighted_delta", """WITH c AS (SELECT l_returnflag AS k, l_suppkey % 10 AS class, avg(l_quantity) AS a, avg(l_discount * 100) AS b, avg(l_tax * 100) AS c, count(*) AS n FROM lineitem GROUP BY ALL),
x AS (SELECT p.k, p.class, p.n, sqrt((p.a - q.a) ** 2 + (p.b - q.b) ** 2 + (p.c - q.c) ** 2) AS de FROM c p JOIN c q USING (class) WHERE q.k = 'N')
SELECT k, round(sum(n * de) / sum(n), 6) AS delta, round(max(de), 6) AS worst FROM x GROUP BY 1""")
def _(spark, d):
    li = table(spark, d, "lineitem").withColumn("class", F.col("l_suppkey") % 10)
    c = li.groupBy(F.col("l_returnflag").alias("k"), "class").agg(F.array(F.avg("l_quantity"), F.avg(F.col("l_discount") * 100), F.avg(F.col("l_tax") * 100)).alias("v"), F.count("*").alias("n"))
    base = c.where("k = 'N'").select("class", F.col("v").alias("w"))
    x = c.join(base, "class").withColumn("de", S.distance(F.col("v"), F.col("w")))
    return x.groupBy("k").agg(F.round(F.sum(F.col("n") * F.col("de")) / F.sum("n"), 6).alias("delta"), F.round(F.max("de"), 6).alias("worst"))


@query("iou_by_class", """WITH x AS (SELECT source, quality = 1 AS a, toxic = 1 AS b FROM documents JOIN labels USING (doc_id)), g AS (SELECT source, count(*) FILTER (WHERE a AND b) AS n_both, count(*) FILTER (WHERE a OR b) AS n_either, avg(CAST(a AS DOUBLE)) AS sa, avg(CAST(b AS DOUBLE)) AS sb FROM x GROUP BY 1)
SELECT source, n_both, n_either, round(n_both / greatest(1, n_either), 6) AS iou, sb > 0.01 AND sa < 0.002 AS invented, sa > 0.01 AND sb < 0.002 AS dropped FROM g""")
def _(spark, d):
    x = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").select("source", (F.col("quality") == 1).alias("a"), (F.col("toxic") == 1).alias("b"))
    share = lambda c: F.avg(F.col(c).cast("double"))
    g = x.groupBy("source").agg(*M.overlap(F.col("a"), F.col("b")), share("a").alias("sa"), share("b").alias("sb"))
    return g.select("source", F.col("both").alias("n_both"), F.col("either").alias("n_either"), r6("iou"), ((F.col("sb") > 0.01) & (F.col("sa") < 0.002)).alias("invented"), ((F.col("sa") > 0.01) & (F.col("sb") < 0.002)).alias("dropped"))


_HIST = """e AS (SELECT label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), a AS (SELECT label, unnest(range(1, 33)) AS i, v FROM e), p AS (SELECT label, atan2(v[2 * i], v[2 * i - 1]) AS t, sqrt(v[2 * i] ** 2 + v[2 * i - 1] ** 2) AS w FROM a),
b AS (SELECT label, least(15, floor((t - floor(t / 3.141592653589793) * 3.141592653589793) / 3.141592653589793 * 16)) AS bin, w FROM p), g AS (SELECT label, bin, sum(w) AS w FROM b GROUP BY ALL), h AS (SELECT label, bin, w / (sum(w) OVER (PARTITION BY label) + 1e-9) AS p FROM g)"""


@query("orientation_histogram_chi2", f"WITH {_HIST} SELECT h.label, round(0.5 * sum((h.p - o.p) ** 2 / (h.p + o.p + 1e-9)), 6) AS distance FROM h JOIN h o USING (bin) WHERE o.label = 0 GROUP BY h.label")
def _(spark, d):
    x = table(spark, d, "embeddings").select("label", F.transform("embedding", lambda v: v.cast("double")).alias("v"))
    x = x.select("label", F.explode(F.transform(F.sequence(F.lit(0), F.lit(62), F.lit(2)), lambda i: F.struct(F.get("v", i).alias("x"), F.get("v", i + 1).alias("y")))).alias("g")).select("label", "g.x", "g.y")
    h = M.histogram(x, ["label"], F.atan2("y", "x"), F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y")), 16)
    base = h.where("label = 0").select("bin", F.col("p").alias("q"))
    return h.join(base, "bin").groupBy("label").agg(F.round(M.chi_square(F.col("p"), F.col("q")), 6).alias("distance"))


@query("variant_vs_baseline", """WITH m AS (SELECT o_orderpriority AS variant, avg(o_totalprice) AS price, count(*)::DOUBLE AS n FROM orders GROUP BY 1)
SELECT m.variant, round(100 * (m.price / b.price - 1), 1) AS price_change, round(100 * (m.n / b.n - 1), 1) AS n_change FROM m, m b WHERE b.variant = '3-MEDIUM'""")
def _(spark, d):
    m = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("variant")).agg(F.avg("o_totalprice").alias("price"), F.count("*").cast("double").alias("n"))
    return M.against_baseline(m, "variant", "3-MEDIUM", ["price", "n"])


@query("two_candidate_verdict", """WITH m AS (SELECT l_linestatus AS c, avg(l_extendedprice) AS e, stddev_pop(l_quantity) AS s FROM lineitem GROUP BY 1)
SELECT round(a.e / b.e, 4) AS energy, round(a.s / b.s, 4) AS instability, CASE WHEN a.e / b.e > 1.15 AND a.s / b.s <= 1.2 THEN 'first' WHEN b.e / a.e > 1.15 AND b.s / a.s <= 1.2 THEN 'second' ELSE 'tie' END AS verdict FROM m a, m b WHERE a.c = 'F' AND b.c = 'O'""")
def _(spark, d):
    pick = lambda s, c: F.when(F.col("l_linestatus") == s, F.col(c))
    x = table(spark, d, "lineitem").agg(*(f(pick(s, c)).alias(f"{n}{s}") for s in "FO" for n, f, c in (("e", F.avg, "l_extendedprice"), ("s", F.stddev_pop, "l_quantity"))))
    e, s = F.col("eF") / F.col("eO"), F.col("sF") / F.col("sO")
    return x.select(F.round(e, 4).alias("energy"), F.round(s, 4).alias("instability"), F.when((e > 1.15) & (s <= 1.2), "first").when((1 / e > 1.15) & (1 / s <= 1.2), "second").otherwise("tie").alias("verdict"))


@query("dtype_census", """WITH g AS (SELECT l_returnflag AS dtype, sum(l_quantity) AS elements, count(*) AS tensors, arg_max(l_orderkey, (l_extendedprice, l_orderkey)) AS largest FROM lineitem GROUP BY 1)
SELECT dtype, tensors, elements, round(elements / sum(elements) OVER (), 6) AS share, dtype = arg_max(dtype, elements) OVER () AS dominant FROM g""")
def _(spark, d):
    g = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("dtype")).agg(F.count("*").alias("tensors"), F.sum("l_quantity").alias("elements"))
    one = g.agg(F.sum("elements").alias("all"), F.max_by("dtype", "elements").alias("top"))
    x = g.join(F.broadcast(one))  # one row
    return x.select("dtype", "tensors", "elements", F.round(F.col("elements") / F.col("all"), 6).alias("share"), (F.col("dtype") == F.col("top")).alias("dominant"))


@query("remaining_cost", """SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS done, count(*) FILTER (WHERE o_orderstatus = 'P') AS failed, count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'P')) AS pending,
round(coalesce(sum(o_totalprice) FILTER (WHERE o_orderstatus <> 'F'), 0) * 12.0982, 2) AS seconds, CAST(ceil(count(*) / 73.0) AS BIGINT) AS chunks FROM orders GROUP BY 1""")
def _(spark, d):
    o, s = table(spark, d, "orders"), F.col("o_orderstatus")
    return o.groupBy("o_orderpriority").agg(F.count_if(s == "F").alias("done"), F.count_if(s == "P").alias("failed"), F.count_if(~s.isin("F", "P")).alias("pending"), F.round(F.coalesce(F.sum(F.when(s != "F", F.col("o_totalprice"))), F.lit(0.0)) * 12.0982, 2).alias("seconds"), F.ceil(F.count("*") / 73.0).cast("long").alias("chunks"))


@query("group_checksum", "SELECT conv_id, md5(array_to_string(list_sort(list(md5(text))), ',')) AS checksum, count(*) AS members FROM conversations GROUP BY 1")
def _(spark, d):
    return M.group_checksum(table(spark, d, "conversations"), ["conv_id"], F.col("text"))


@query("span_bounds", "SELECT o_custkey, min(o_orderdate) AS low, max(o_orderdate) AS high, least(greatest(round(min(o_totalprice) * 0.85, 6), 1000), 400000) AS padded, count(DISTINCT o_orderpriority) AS sources FROM orders GROUP BY 1")
def _(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("low"), F.max("o_orderdate").alias("high"), B.clip(F.round(F.min("o_totalprice") * 0.85, 6), 1000, 400000).alias("padded"), F.count_distinct("o_orderpriority").alias("sources"))


@query("coverage_and_shimmer", """WITH x AS (SELECT l_suppkey, l_discount AS alpha, CAST(l_quantity > 20 AS INT) AS fg, l_extendedprice AS v, lag(l_extendedprice) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_partkey, l_linenumber, l_extendedprice) AS p FROM lineitem)
SELECT l_suppkey, round(sum(alpha * fg) / sum(alpha), 6) AS coverage, round(avg(abs(v - p)) / avg(v), 4) AS shimmer FROM x GROUP BY 1""")
def _(spark, d):
    w = Window.partitionBy("l_suppkey").orderBy("l_shipdate", "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    x = table(spark, d, "lineitem").withColumn("p", F.lag("l_extendedprice").over(w)).withColumn("fg", (F.col("l_quantity") > 20).cast("int"))
    return x.groupBy("l_suppkey").agg(F.round(F.sum(F.col("l_discount") * F.col("fg")) / F.sum("l_discount"), 6).alias("coverage"), F.round(F.avg(F.abs(F.col("l_extendedprice") - F.col("p"))) / F.avg("l_extendedprice"), 4).alias("shimmer"))


@query("composition_rule", """WITH g AS (SELECT l_suppkey, l_shipdate, sum(l_quantity) FILTER (WHERE l_returnflag = 'A') AS covered, sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS exposed FROM lineitem GROUP BY ALL)
SELECT l_suppkey, round(median(covered / (exposed + 1e-6)), 6) AS ratio, median(covered / (exposed + 1e-6)) > 1 AS ok FROM g GROUP BY 1""")
def _(spark, d):
    part = lambda f: F.sum(F.when(F.col("l_returnflag") == f, F.col("l_quantity")))
    g = table(spark, d, "lineitem").groupBy("l_suppkey", "l_shipdate").agg(part("A").alias("c"), part("R").alias("e"))
    x = g.groupBy("l_suppkey").agg(F.median(S.guarded(F.col("c"), F.col("e"))).alias("ratio"))
    return x.select("l_suppkey", r6("ratio"), (F.col("ratio") > 1).alias("ok"))


# incremental state


@query("content_digest", "SELECT doc_id, substr(sha256(text), 1, 16) AS digest, substr(sha256('{\"lang\":\"' || lang || '\",\"source\":\"' || source || '\"}'), 1, 16) AS key, substr(sha256(text), 1, 12) AS anonymous FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", T.digest(F.col("text")).alias("digest"), T.content_key(["source", "lang"]).alias("key"), T.digest(F.col("text"), 12).alias("anonymous"))


_RUNS = """x AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'pending' ELSE 'skipped' END AS status, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE CAST(o_custkey % 5 AS VARCHAR) END AS stored, CAST(o_orderkey % 5 AS VARCHAR) AS cur FROM orders)"""


def runs(spark, d):
    status = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "pending").otherwise("skipped")
    return table(spark, d, "orders").select("o_orderkey", status.alias("status"), F.when(F.col("o_custkey") % 7 != 0, (F.col("o_custkey") % 5).cast("string")).alias("stored"), (F.col("o_orderkey") % 5).cast("string").alias("cur"))


@query("needs_run_truth", f"""WITH {_RUNS} SELECT o_orderkey, NOT (status = 'skipped' OR (status = 'done' AND coalesce(stored = cur, false))) AS needs_run, coalesce(stored <> '' AND cur <> '' AND stored <> cur, false) AS changed, CASE WHEN stored IS NOT DISTINCT FROM cur THEN 'done' ELSE 'stale' END AS settled FROM x""")
def _(spark, d):
    s, k, c = F.col("status"), F.col("stored"), F.col("cur")
    return runs(spark, d).select("o_orderkey", T.needs_run(s, k, c).alias("needs_run"), T.changed(k, c).alias("changed"), T.settled(k, c).alias("settled"))


@query("selected_work", f"WITH {_RUNS} SELECT o_orderkey FROM x WHERE NOT (status = 'skipped' OR (status = 'done' AND coalesce(stored = cur, false))) ORDER BY o_orderkey LIMIT 100")
def _(spark, d):
    return runs(spark, d).where(T.needs_run(F.col("status"), F.col("stored"), F.col("cur"))).orderBy("o_orderkey").limit(100).select("o_orderkey")


@query("upsert_latest", "SELECT user_id, event_type, last(value ORDER BY ts, event_id) AS value, max(event_id) FILTER (WHERE true) IS NOT NULL AS known FROM events GROUP BY ALL")
def _(spark, d):
    e = table(spark, d, "events").select("user_id", "event_type", "ts", "event_id", "value")
    old, new = e.where("event_id % 3 <> 0"), e.where("event_id % 3 = 0")
    x = T.latest(T.upsert(T.latest(old, ["user_id", "event_type"], "ts", "event_id"), T.latest(new.unionByName(old), ["user_id", "event_type"], "ts", "event_id"), ["user_id", "event_type"]), ["user_id", "event_type"], "ts", "event_id")
    return x.select("user_id", "event_type", "value", F.col("event_id").isNotNull().alias("known"))


@query("legacy_adoption", "WITH n AS (SELECT l_orderkey, max(l_shipdate) AS newest FROM lineitem GROUP BY 1) SELECT o_orderkey FROM orders JOIN n ON o_orderkey = l_orderkey WHERE newest <= o_orderdate + INTERVAL 700 DAY")
def _(spark, d):
    o = table(spark, d, "orders").withColumn("out", F.col("o_orderdate") + F.expr("INTERVAL 700 DAYS"))
    return T.adoptable(o, table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"], "out", "l_shipdate").select("o_orderkey")


@query("approval_valid", "SELECT doc_id, substr(sha256(text), 1, 1) < '8' AND quality = 1 AS approved, coalesce(lang, 'none') AS lang FROM labels LEFT JOIN documents USING (doc_id)")
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", T.digest(F.col("text"), 1).alias("g"))
    return table(spark, d, "labels").join(docs, "doc_id", "left").select("doc_id", ((F.col("g") < "8") & (F.col("quality") == 1)).alias("approved"), F.coalesce("lang", F.lit("none")).alias("lang"))


@query("status_machine", f"""WITH {_RUNS} SELECT o_orderkey, CASE WHEN status = 'skipped' THEN 'skipped' WHEN status = 'pending' THEN CASE o_orderkey % 3 WHEN 0 THEN 'running' WHEN 1 THEN 'pending' ELSE 'pending' END WHEN o_orderkey % 3 = 2 THEN 'stale' ELSE 'done' END AS status FROM x""")
def _(spark, d):
    event = F.element_at(F.array(F.lit("start"), F.lit("ok"), F.lit("change")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    return runs(spark, d).select("o_orderkey", T.next_status(F.col("status"), event).alias("status"))


@query("result_cache_misses", "SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'O' AND (o_custkey, o_orderpriority) NOT IN (SELECT (o_custkey, o_orderpriority) FROM orders WHERE o_orderstatus = 'F')")
def _(spark, d):
    o = table(spark, d, "orders")
    keys = ["o_custkey", "o_orderpriority"]
    return T.uncached(o.where("o_orderstatus = 'O'").select(*keys).distinct(), o.where("o_orderstatus = 'F'"), keys)


# data quality and sets


@query("schema_diff", """WITH p AS (SELECT p_partkey AS k, CAST(p_size % 2 AS VARCHAR) AS s FROM part), l AS (SELECT l_partkey AS k, CAST(min(l_linenumber) % 2 AS VARCHAR) AS s FROM lineitem WHERE l_partkey % 3 <> 0 GROUP BY 1)
SELECT coalesce(p.k, l.k) AS k, CASE WHEN l.k IS NULL THEN 'missing' WHEN p.k IS NULL THEN 'extra' WHEN p.s <> l.s THEN 'mismatch' ELSE 'same' END AS status FROM p FULL JOIN l ON p.k = l.k""")
def _(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("k"), (F.col("p_size") % 2).cast("string").alias("s"))
    li = table(spark, d, "lineitem").where("l_partkey % 3 <> 0").groupBy(F.col("l_partkey").alias("k")).agg((F.min("l_linenumber") % 2).cast("string").alias("s"))
    return Q.schema_diff(p, li, "k", "s")


@query("set_operations", """SELECT 'both' AS kind, count(*) AS n FROM (SELECT l_partkey FROM lineitem INTERSECT SELECT p_partkey FROM part WHERE p_size > 20)
UNION ALL SELECT 'only', count(*) FROM (SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 40) UNION ALL SELECT 'either', count(*) FROM (SELECT n_regionkey FROM nation UNION SELECT r_regionkey FROM region)""")
def _(spark, d):
    li, p = table(spark, d, "lineitem"), table(spark, d, "part")
    both = li.select("l_partkey").intersect(p.where("p_size > 20").select("p_partkey"))
    only = p.select("p_partkey").subtract(li.where("l_quantity > 40").select("l_partkey"))
    either = table(spark, d, "nation").select("n_regionkey").union(table(spark, d, "region").select("r_regionkey")).distinct()
    one = lambda df, k: df.agg(F.count("*").alias("n")).select(F.lit(k).alias("kind"), "n")
    return one(both, "both").union(one(only, "only")).union(one(either, "either"))


@query("exclusion_anti_join", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def _(spark, d):
    return table(spark, d, "documents").join(table(spark, d, "labels").where("toxic = 1").select("doc_id"), "doc_id", "left_anti").select("doc_id", "source")


@query("uniqueness_violations", "SELECT text, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def _(spark, d):
    return Q.duplicates(table(spark, d, "documents"), ["text"])


@query("stream_alignment_violations", """WITH c AS (SELECT conv_id, count(*) AS n, max(turn) AS last, count(DISTINCT role) AS roles, count(*) FILTER (WHERE text IS NULL OR text = '') AS blank FROM conversations GROUP BY 1)
SELECT CAST(conv_id AS VARCHAR) AS subject, 'dense turns' AS problem FROM c WHERE NOT (last + 1 = n) UNION ALL SELECT CAST(conv_id AS VARCHAR), 'two roles' FROM c WHERE roles <> 2 UNION ALL SELECT CAST(conv_id AS VARCHAR), 'no blank' FROM c WHERE blank > 0 UNION ALL SELECT CAST(conv_id AS VARCHAR), 'even length' FROM c WHERE n % 2 <> 0""")
def _(spark, d):
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"), F.max("turn").alias("last"), F.count_distinct("role").alias("roles"), F.count_if(F.col("text").isNull() | (F.col("text") == "")).alias("blank"))
    return Q.violations(c, "conv_id", {"dense turns": F.col("last") + 1 == F.col("n"), "two roles": F.col("roles") == 2, "no blank": F.col("blank") == 0, "even length": F.col("n") % 2 == 0})


@query("gate_booleans", """WITH g AS (SELECT l_suppkey, avg(l_discount) * 10 AS iou, avg(l_tax) * 100 AS drift, max(l_quantity) / 20 AS ratio FROM lineitem GROUP BY 1)
SELECT l_suppkey, iou >= 0.75 AND drift < 8 AS keeps, CASE WHEN ratio > 2.3 THEN 'high' WHEN ratio < 1 THEN 'low' ELSE 'fine' END AS level FROM g""")
def _(spark, d):
    g = table(spark, d, "lineitem").groupBy("l_suppkey").agg((F.avg("l_discount") * 10).alias("iou"), (F.avg("l_tax") * 100).alias("drift"), (F.max("l_quantity") / 20).alias("ratio"))
    return g.select("l_suppkey", ((F.col("iou") >= 0.75) & (F.col("drift") < 8)).alias("keeps"), F.when(F.col("ratio") > 2.3, "high").when(F.col("ratio") < 1, "low").otherwise("fine").alias("level"))


@query("missing_assets", "SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def _(spark, d):
    used = table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return Q.missing(table(spark, d, "part").select("p_partkey", "p_name"), used, ["p_partkey"])


# boxes; derived from lineitem: a picture is an order

_BOX = "b AS (SELECT l_orderkey AS image, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice) AS box, (l_partkey % 40)::DOUBLE AS x0, (l_suppkey % 40)::DOUBLE AS y0, l_partkey % 40 + 10 + l_quantity AS x1, l_suppkey % 40 + 10 + l_quantity / 2 AS y1, l_extendedprice AS score FROM lineitem)"


def boxes(spark, d):
    li = table(spark, d, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_extendedprice")
    x, y = (F.col("l_partkey") % 40).cast("double"), (F.col("l_suppkey") % 40).cast("double")
    return li.select(F.col("l_orderkey").alias("image"), F.row_number().over(w).cast("long").alias("box"), x.alias("x0"), y.alias("y0"), (x + 10 + F.col("l_quantity")).alias("x1"), (y + 10 + F.col("l_quantity") / 2).alias("y1"), F.col("l_extendedprice").alias("score"))


@query("point_in_box_smallest", f"""WITH {_BOX}, p AS (SELECT o_orderkey AS image, 1 AS point, (o_custkey % 60)::DOUBLE AS px, (o_orderkey % 45)::DOUBLE AS py FROM orders),
m AS (SELECT p.image, p.point, b.box, row_number() OVER (PARTITION BY p.image ORDER BY (x1 - x0) * (y1 - y0), box) AS r FROM p JOIN b ON b.image = p.image AND x0 <= px AND px <= x1 AND y0 <= py AND py <= y1)
SELECT p.image, p.point, m.box FROM p LEFT JOIN m ON m.image = p.image AND r = 1""")
def _(spark, d):
    p = table(spark, d, "orders").select(F.col("o_orderkey").alias("image"), F.lit(1).alias("point"), (F.col("o_custkey") % 60).cast("double").alias("px"), (F.col("o_orderkey") % 45).cast("double").alias("py"))
    return B.smallest_container(p, boxes(spark, d), ["image"], "point", "box")


@query("nms_boxes", f"""WITH RECURSIVE {_BOX}, r AS (SELECT *, row_number() OVER (PARTITION BY image ORDER BY score DESC, box) AS r FROM b),
k(image, r, kept) AS (SELECT image, 1::BIGINT, [box] FROM r WHERE r = 1
UNION ALL SELECT k.image, k.r + 1, CASE WHEN (SELECT count(*) FROM r o WHERE o.image = n.image AND list_contains(k.kept, o.box) AND greatest(0, least(o.x1, n.x1) - greatest(o.x0, n.x0)) * greatest(0, least(o.y1, n.y1) - greatest(o.y0, n.y0)) / ((o.x1 - o.x0) * (o.y1 - o.y0) + (n.x1 - n.x0) * (n.y1 - n.y0) - greatest(0, least(o.x1, n.x1) - greatest(o.x0, n.x0)) * greatest(0, least(o.y1, n.y1) - greatest(o.y0, n.y0))) > 0.55) > 0 THEN k.kept ELSE list_append(k.kept, n.box) END FROM k JOIN r n ON n.image = k.image AND n.r = k.r + 1)
SELECT image, unnest(arg_max(kept, r)) AS box FROM k GROUP BY image""")
def _(spark, d):
    return B.suppress(boxes(spark, d), ["image"], "box")


@query("box_crops", f"WITH {_BOX}, s AS (SELECT *, least(greatest(x1 - x0, y1 - y0) * 1.5::DOUBLE, 110, 90) AS side FROM b) SELECT image, box, CASE WHEN side >= 40 THEN round(least(greatest((x0 + x1) / 2 - side / 2, 0), 110 - side), 6) END AS l, CASE WHEN side >= 40 THEN round(least(greatest((y0 + y1) / 2 - side * 0.1::DOUBLE - side / 2, 0), 90 - side), 6) END AS t, round((x1 - x0) * (y1 - y0), 6) AS area FROM s")
def _(spark, d):
    c = B.square_crop(F.lit(110.0), F.lit(90.0), 1.5, 0.1, 40)
    return boxes(spark, d).withColumn("c", c).select("image", "box", F.round("c.left", 6).alias("l"), F.round("c.top", 6).alias("t"), F.round(B.area(), 6).alias("area"))


@query("top_boxes", f"WITH {_BOX} SELECT image, box, r AS rank FROM (SELECT *, row_number() OVER (PARTITION BY image ORDER BY (x1 - x0) * (y1 - y0) DESC, box) AS r FROM b WHERE x1 - x0 >= 12 AND y1 - y0 >= 12 AND (x1 - x0) * (y1 - y0) < 0.8::DOUBLE * 60 * 35) WHERE r <= 5")
def _(spark, d):
    x = boxes(spark, d).where((F.col("x1") - F.col("x0") >= 12) & (F.col("y1") - F.col("y0") >= 12) & (B.area() < 0.8 * 60 * 35))
    r = F.row_number().over(Window.partitionBy("image").orderBy(B.area().desc(), "box"))
    return x.select("image", "box", r.cast("long").alias("rank")).where("rank <= 5")


@query("nearest_value_join", """WITH x AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, p_partkey, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_suppkey, l_partkey, l_extendedprice ORDER BY round(abs(l_extendedprice / 50 - p_retailprice), 2), p_size DESC, p_partkey) AS r FROM lineitem JOIN part ON p_partkey % 100 = l_suppkey % 100)
SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, p_partkey FROM x WHERE r = 1""")
def _(spark, d):
    li = table(spark, d, "lineitem").withColumn("g", F.col("l_suppkey") % 100).withColumn("value", F.col("l_extendedprice") / 50)
    p = table(spark, d, "part").select((F.col("p_partkey") % 100).alias("g"), F.col("p_retailprice").alias("at"), "p_partkey", "p_size")
    x = C.nearest_value(li, p, ["g"], "value", "at", [-F.col("p_size"), F.col("p_partkey")], digits=2)
    return x.select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "p_partkey")


@query("quality_score_topn", """WITH s AS (SELECT doc_id, 0.45::DOUBLE * least(1, n_chars / 2000.0::DOUBLE) + 0.30::DOUBLE * least(1, length(source) / 8.0::DOUBLE) + 0.25::DOUBLE * least(1, (doc_id % 100) / 100.0::DOUBLE * 2.5) AS score FROM documents)
SELECT doc_id, round(score, 6) AS score FROM s ORDER BY round(score, 9) DESC, doc_id LIMIT 50""")
def _(spark, d):
    n = F.col("n_chars") / 2000.0
    s = 0.45 * F.least(F.lit(1.0), n) + 0.30 * F.least(F.lit(1.0), F.length("source") / 8.0) + 0.25 * F.least(F.lit(1.0), (F.col("doc_id") % 100) / 100.0 * 2.5)
    x = table(spark, d, "documents").select("doc_id", F.round(s, 9).alias("s"))
    return x.orderBy(F.desc("s"), "doc_id").limit(50).select("doc_id", F.round("s", 6).alias("score"))


@query("priority_quota_pick", """WITH v AS (SELECT doc_id, n_chars, CASE WHEN n_chars > 6000 THEN 'wide' WHEN n_chars > 2500 THEN 'full' WHEN n_chars > 800 THEN 'half' ELSE 'close' END AS view FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY view ORDER BY n_chars DESC, doc_id) AS k FROM v), p AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN k = 1 THEN 0 ELSE 1 END, n_chars DESC, doc_id) AS n FROM r)
SELECT doc_id, view, n AS pick FROM p WHERE n <= 12""")
def _(spark, d):
    n = F.col("n_chars")
    v = table(spark, d, "documents").select("doc_id", "n_chars", F.when(n > 6000, "wide").when(n > 2500, "full").when(n > 800, "half").otherwise("close").alias("view"))
    best = v.groupBy("view").agg(F.max_by("doc_id", F.struct("n_chars", -F.col("doc_id"))).alias("doc_id")).withColumn("tier", F.lit(0)).select("doc_id", "tier")
    x = v.join(best, "doc_id", "left").withColumn("tier", F.coalesce("tier", F.lit(1)))
    top = x.orderBy("tier", F.desc("n_chars"), "doc_id").limit(12)  # a few rows; the rank below sees no more
    return top.select("doc_id", "view", F.row_number().over(Window.orderBy("tier", F.desc("n_chars"), "doc_id")).cast("long").alias("pick"))


@query("notable_sample", """WITH f AS (SELECT user_id, event_id, value > 150 AS notable, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events),
s AS (SELECT user_id, event_id, i, notable FROM f WHERE notable OR i IN (SELECT (k * (f.n - 1)) // 11 FROM range(12) t(k)))
SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY notable DESC, i) AS r FROM s) WHERE r <= 12""")
def _(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    f = table(spark, d, "events").select("user_id", "event_id", (F.col("value") > 150).alias("notable"), (F.row_number().over(w) - 1).alias("i"), F.count("*").over(Window.partitionBy("user_id")).alias("n"))
    wanted = F.transform(F.sequence(F.lit(0), F.lit(11)), lambda k: F.floor(k * (F.col("n") - 1) / 11).cast("int"))
    s = f.where(F.col("notable") | F.array_contains(wanted, F.col("i")))
    r = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("notable"), "i"))
    return s.withColumn("r", r).where("r <= 12").select("user_id", "event_id")
