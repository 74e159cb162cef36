"""Queries: runs by variant, fallbacks, narrowed classes, needles of globs, per-frame agreement."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import records as R
from .common import FRAMES, frames, table

QUERIES: dict = {}


def query(name: str, sql: str | None):
    def put(fn):
        QUERIES[name] = (fn, sql)
        return fn

    return put


# an order is a record with an own status; some have runs of the baseline or of a variant
_REC = "rec AS (SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'pending' END AS status, o_custkey % 3 AS kind, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'done' END AS run_status, CAST(o_totalprice AS DOUBLE) * (o_orderkey % 2) AS seconds FROM orders)"


def records(spark, d):
    k = F.col("o_orderkey")
    run = F.struct(F.when(k % 4 != 0, "done").alias("status"), (F.col("o_totalprice").cast("double") * (k % 2)).alias("seconds"))
    runs = F.when(F.col("o_custkey") % 3 == 1, F.create_map(F.lit("baseline"), run)).when(F.col("o_custkey") % 3 == 2, F.create_map(F.lit("wide"), run))
    status = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "pending")
    return table(spark, d, "orders").select(k.alias("id"), status.alias("status"), runs.alias("runs"))


@query("variant_status", f"""WITH {_REC} SELECT id, CASE WHEN kind = 1 THEN coalesce(run_status, 'pending') ELSE coalesce(status, 'pending') END AS baseline, CASE WHEN kind = 2 THEN coalesce(run_status, 'pending') ELSE 'pending' END AS wide FROM rec""")
def _(spark, d):
    of = lambda v: R.run_field(F.col("runs"), F.col("status"), F.lit(v), "status", F.lit("pending")).alias(v)
    return records(spark, d).select("id", of("baseline"), of("wide"))


@query("mirrored_update", f"""WITH {_REC} SELECT id, 'failed' AS status, 'failed' AS baseline, CASE WHEN kind = 1 THEN seconds END AS seconds, CASE WHEN kind = 2 THEN run_status END AS wide, 'stale' AS other FROM rec""")
def _(spark, d):
    x = R.record_run(R.record_run(records(spark, d), "runs", "baseline", {"status": F.lit("failed")}), "runs", "other", {"status": F.lit("stale")})
    run = lambda v: F.try_element_at(F.col("runs"), F.lit(v))
    return x.select("id", "status", run("baseline")["status"].alias("baseline"), run("baseline")["seconds"].alias("seconds"), run("wide")["status"].alias("wide"), run("other")["status"].alias("other"))


@query("completed_runs", f"WITH {_REC} SELECT id, CASE kind WHEN 1 THEN 'baseline' ELSE 'wide' END AS variant, run_status AS status, seconds FROM rec WHERE kind > 0 AND run_status = 'done' AND seconds > 0")
def _(spark, d):
    return R.completed_runs(records(spark, d), ["id"], "runs")


@query("pilot_or_whole", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 AND o_custkey % 2 = 0 THEN o_custkey ELSE 0 END AS start, CASE WHEN o_orderkey % 3 = 0 AND o_custkey % 2 = 0 THEN o_custkey + 90 ELSE 1000 END AS stop FROM orders")
def _(spark, d):
    c = F.col("o_custkey")
    i = R.interval_or_whole(F.when(F.col("o_orderkey") % 3 == 0, c), F.when(c % 2 == 0, c + 90), F.lit(1000))
    return table(spark, d, "orders").select("o_orderkey", i.alias("i")).select("o_orderkey", "i.start", "i.stop")


@query("narrowed_classes", """SELECT o_orderkey, array_to_string(list_sort(CASE WHEN o_custkey % 5 = 0 THEN ['x'] WHEN o_custkey % 5 = 1 THEN ['a', 'b', 'c'] ELSE list_filter(['a', 'b', 'c'], lambda c: list_contains(['b', 'c', 'd'], c)) END), ',') AS classes, array_to_string(list_filter(['a', 'b', 'c', 'd'], lambda c: NOT list_contains(['a', 'b', 'c'], c)), ',') AS others FROM orders""")
def _(spark, d):
    word = lambda s: F.array(*(F.lit(c) for c in s))
    c = F.col("o_custkey") % 5
    x = R.narrowed(word("abc"), F.when(c != 1, word("bcd")), F.when(c == 0, word("x")))
    return table(spark, d, "orders").select("o_orderkey", F.array_join(F.array_sort(x), ",").alias("classes"), F.array_join(F.array_except(word("abcd"), word("abc")), ",").alias("others"))


@query("glob_needles", """WITH g AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'dir/' || p_brand WHEN 1 THEN '**/' || p_brand WHEN 2 THEN 'dir/' || p_brand || '/*.bin' ELSE p_brand END AS g FROM part)
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN g || ',' || split_part(g, '/', 2) WHEN 1 THEN split_part(g, '/', 2) WHEN 2 THEN regexp_replace(g, '/\\*.*$', '') ELSE g END AS needles FROM g""".replace("\\\\", "\\"))
def _(spark, d):
    k, b = F.col("p_partkey") % 4, F.col("p_brand")
    g = F.when(k == 0, F.concat(F.lit("dir/"), b)).when(k == 1, F.concat(F.lit("**/"), b)).when(k == 2, F.concat(F.lit("dir/"), b, F.lit("/*.bin"))).otherwise(b)
    return table(spark, d, "part").select("p_partkey", F.array_join(S.glob_needles(g), ",").alias("needles"))


@query("iou_by_frame_median", "WITH f AS (SELECT l_returnflag, l_shipdate, count(*) FILTER (WHERE l_quantity > 20 AND l_discount > 0.04) / greatest(1, count(*) FILTER (WHERE l_quantity > 20 OR l_discount > 0.04)) AS iou FROM lineitem GROUP BY ALL) SELECT l_returnflag, round(median(iou), 6) AS iou FROM f GROUP BY 1")
def _(spark, d):
    x = R.iou_by_frame(table(spark, d, "lineitem"), ["l_returnflag"], "l_shipdate", F.col("l_quantity") > 20, F.col("l_discount") > 0.04)
    return x.select("l_returnflag", F.round("iou", 6).alias("iou"))


@query("crop_motion", f"""WITH {FRAMES}, x AS (SELECT user_id, abs(value - lag(value) OVER w) AS dx, abs(event_id % 50 - lag(event_id % 50) OVER w) AS dy FROM frames WINDOW w AS (PARTITION BY user_id ORDER BY frame)) SELECT user_id, round(avg(dx) + avg(dy), 6) AS motion FROM x GROUP BY 1 HAVING count(*) > 1""")
def _(spark, d):
    from ..operators.series import abs_difference

    x = frames(spark, d, "event_id").withColumn("y", F.col("event_id") % 50)
    x = x.select("user_id", abs_difference("value", ["user_id"], ["frame"]).alias("dx"), abs_difference("y", ["user_id"], ["frame"]).alias("dy"))
    return x.groupBy("user_id").agg(F.round(F.avg("dx") + F.avg("dy"), 6).alias("motion"), F.count("*").alias("n")).where("n > 1").drop("n")


@query("local_stamps", "SELECT o_orderkey, strftime(o_orderdate + INTERVAL 150 MINUTE, '%Y-%m-%d %H:%M') AS here FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", S.local_stamp(F.col("o_orderdate").cast("timestamp"), "+02:30").alias("here"))


@query("large_crops", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem WHERE l_quantity >= 12 AND l_quantity * 1.5::DOUBLE >= 24 GROUP BY ALL")
def _(spark, d):
    x = table(spark, d, "lineitem").where(S.at_least(F.col("l_quantity"), F.col("l_quantity") * 1.5, 12, 24))
    return x.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"))


@query("sorted_pages", "SELECT page_id, strlen(html) AS length FROM pages ORDER BY length DESC, url, page_id LIMIT 25")
def _(spark, d):
    x = table(spark, d, "pages").select("page_id", "url", F.octet_length("html").cast("long").alias("length"))
    return R.sorted_hits(x.withColumn("path", F.concat("url", F.lit("\t"), F.lpad(F.col("page_id").cast("string"), 12, "0"))), "size", limit=25).select("page_id", "length")


@query("sparse_fields", """SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 AND o_orderkey % 3 = 0 THEN '{"a":"x","b":' || o_orderkey || '}' WHEN o_custkey % 2 = 0 THEN '{"a":"x"}' WHEN o_orderkey % 3 = 0 THEN '{"b":' || o_orderkey || '}' ELSE '{}' END AS fields FROM orders""")
def _(spark, d):
    f = R.with_value({"a": F.when(F.col("o_custkey") % 2 == 0, "x").otherwise(""), "b": F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey"))})
    return table(spark, d, "orders").select("o_orderkey", f.alias("fields"))
