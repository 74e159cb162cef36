"""Queries: selection, cascades, first matches, fallbacks, synthetic series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import selection as C
from ..sources.files import generate_frames
from .common import table

QUERIES: dict = {}


def query(name: str, sql: str | None):
    def put(fn):
        QUERIES[name] = (fn, sql)
        return fn

    return put


@query("work_selection", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus IN ('P', 'O')")
def _(spark, d):
    o = table(spark, d, "orders")
    return C.choose(o, "o_orderkey", failed=F.col("o_orderstatus").isin("P", "O")).select("o_orderkey", "o_custkey")


@query("threshold_cascade", "WITH x AS (SELECT *, max(CAST(value >= 120 AND event_type = 'purchase' AS INT)) OVER (PARTITION BY user_id) AS ok FROM events WHERE value >= 60) SELECT event_id, user_id FROM x WHERE ok = 0 OR value >= 120")
def _(spark, d):
    return C.cascade(table(spark, d, "events"), ["user_id"], "value", F.col("event_type") == "purchase", 120.0, 60.0).select("event_id", "user_id")


@query("first_provenance", "WITH r AS (SELECT l_partkey, l_orderkey, l_suppkey, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey) AS r FROM lineitem) SELECT p_partkey, l_orderkey AS origin, l_suppkey AS supplier FROM part LEFT JOIN r ON l_partkey = p_partkey AND r = 1")
def _(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.col("l_orderkey").alias("origin"), F.col("l_suppkey").alias("supplier"), "l_shipdate", "l_linenumber")
    x = C.first_match(table(spark, d, "part").select("p_partkey"), li, ["p_partkey"], "l_shipdate", "origin", "l_linenumber", "supplier")
    return x.select("p_partkey", "origin", "supplier")


@query("special_or_general", "WITH s AS (SELECT o_custkey, o_orderpriority, max(o_totalprice) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL), g AS (SELECT o_custkey, max(o_totalprice) AS v FROM orders GROUP BY 1), k AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders) SELECT k.o_custkey, k.o_orderpriority, coalesce(s.v, g.v) AS v FROM k LEFT JOIN s USING (o_custkey, o_orderpriority) LEFT JOIN g ON g.o_custkey = k.o_custkey")
def _(spark, d):
    o = table(spark, d, "orders")
    s = o.where("o_orderstatus = 'F'").groupBy("o_custkey", "o_orderpriority").agg(F.max("o_totalprice").alias("v"))
    g = o.groupBy("o_custkey").agg(F.max("o_totalprice").alias("v"))
    k = o.select("o_custkey", "o_orderpriority").distinct()
    return C.with_fallback(k, s, g, ["o_custkey", "o_orderpriority"], "v").select("o_custkey", "o_orderpriority", "v")


@query("skipped_pending", "SELECT o_orderkey, CASE WHEN o_custkey % 4 = 0 AND o_orderstatus = 'O' THEN 'skipped' WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'done' END AS status FROM orders")
def _(spark, d):
    o = table(spark, d, "orders").withColumn("status", F.when(F.col("o_orderstatus") == "O", "pending").otherwise("done"))
    return C.skip_pending(o, F.col("o_custkey") % 4 == 0).select("o_orderkey", "status")


@query("synthetic_series", "SELECT s AS stream, count(*) AS n, count(*) FILTER (WHERE f >= 30) AS after FROM range(5) a(s), range(100) b(f) GROUP BY 1")
def _(spark, d):
    x = generate_frames(spark, 5, 100, 30)
    return x.groupBy("stream").agg(F.count("*").alias("n"), F.count_if(F.col("value") >= 90).alias("after"))


@query("group_roll_call", "SELECT o_custkey, list_sort(list(o_orderkey)) AS members, round(sum(o_totalprice), 4) AS total FROM orders GROUP BY 1")
def _(spark, d):
    x = table(spark, d, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list("o_orderkey")).alias("members"), F.round(F.sum("o_totalprice"), 4).alias("total"))
    return x
