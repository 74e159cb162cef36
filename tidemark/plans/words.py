"""Queries: text scans, scalar functions, configuration chains, graphs, event windows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import text as X
from ..operators.graphs import chain, depths
from ..session import spread
from .common import table

QUERIES: dict = {}


def query(name: str, sql: str | None):
    def put(fn):
        QUERIES[name] = (fn, sql)
        return fn

    return put


@query("exact_duplicate_docs", "SELECT substr(sha256(text), 1, 16) AS digest, count(*) AS copies, min(doc_id) AS kept FROM documents GROUP BY 1 HAVING count(*) > 1")
def _(spark, d):
    x = table(spark, d, "documents").groupBy(F.substring(F.sha2("text", 256), 1, 16).alias("digest")).agg(F.count("*").alias("copies"), F.min("doc_id").alias("kept"))
    return x.where("copies > 1")


@query("needle_scan", """WITH n AS (SELECT DISTINCT unnest(list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda t: length(t) >= 6)) AS w FROM benchmark), s AS (SELECT DISTINCT lower(source) AS w FROM documents),
t AS (SELECT doc_id, unnest(list_distinct(list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda t: length(t) >= 6))) AS w FROM documents) SELECT doc_id, count(*) AS hits FROM t WHERE w IN (SELECT w FROM n WHERE w NOT IN (SELECT w FROM s)) GROUP BY 1""")
def _(spark, d):
    docs = table(spark, d, "documents")
    n = X.needles(table(spark, d, "benchmark"), "text", docs.select(F.lower("source").alias("word")).distinct())
    return X.needle_hits(spread(docs.select("doc_id", "text")), "doc_id", "text", n)


@query("passage_scan", "SELECT doc_id, item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)")
def _(spark, d):
    return X.passage_hits(spread(table(spark, d, "documents").select("doc_id", "text")), "doc_id", "text", table(spark, d, "benchmark"), "item_id", "text")


_CLAUSES = "unnest(list_filter(list_transform(string_split_regex(lower(text), '[,\n]'), lambda c: trim(regexp_replace(regexp_replace(c, '\\{[^}]*\\}', '', 'g'), '\\s+', ' ', 'g'))), lambda c: length(c) >= 12)) AS clause"


@query("withheld_clause_scan", f"""WITH c AS (SELECT DISTINCT {_CLAUSES} FROM benchmark), public AS (SELECT DISTINCT {_CLAUSES} FROM conversations)
SELECT doc_id, count(*) AS clauses FROM documents JOIN (SELECT clause FROM c EXCEPT SELECT clause FROM public) w ON contains(lower(text), clause) GROUP BY 1""")
def _(spark, d):
    split = lambda df: df.select(F.explode(S.clauses(F.lower("text"))).alias("clause")).distinct()
    wanted = split(table(spark, d, "benchmark")).join(split(table(spark, d, "conversations")), "clause", "left_anti").withColumn("name", F.col("clause"))
    return X.passage_hits(spread(table(spark, d, "documents").select("doc_id", "text")), "doc_id", "text", wanted, "name", "clause", lower=True).groupBy("doc_id").agg(F.count("*").alias("clauses"))


@query("glob_find", "SELECT page_id, url FROM pages WHERE regexp_matches(lower(url), '/[0-9]+\\.html$') AND regexp_matches(html, '(?i)<nav') ORDER BY page_id LIMIT 40".replace("\\\\", "\\"))
def _(spark, d):
    p = table(spark, d, "pages").withColumn("path", F.regexp_replace("url", "[?#].*$", "")).where(F.col("path") == F.col("url"))
    return X.find_files(p, "path", "[0-9]*.html", content=F.col("html").rlike("(?i)<nav")).where(F.col("path").rlike("/[0-9]+\\.html$")).orderBy("page_id").limit(40).select("page_id", "url")


@query("exempted_pattern_scan", "SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)licen[sc]e') AND NOT regexp_matches(text, '(?i)mit license')")
def _(spark, d):
    return table(spark, d, "documents").where(X.exempted(F.col("text"), "(?i)licen[sc]e", "(?i)mit license")).select("doc_id")


@query("size_cap", "SELECT doc_id, len(string_split(text, chr(10))) AS lines, strlen(text) AS bytes, len(string_split(text, chr(10))) > 8 OR strlen(text) > 4000 AS too_large FROM documents")
def _(spark, d):
    n, b = F.size(F.split("text", "\n")).cast("long"), F.octet_length("text").cast("long")
    return table(spark, d, "documents").select("doc_id", n.alias("lines"), b.alias("bytes"), ((n > 8) | (b > 4000)).alias("too_large"))


@query("allowlist_containment", """WITH r AS (SELECT event_id, user_id, value AS low, value + 5 AS high FROM events), g AS (SELECT o_custkey AS user_id, o_totalprice / 5000 AS low, o_totalprice / 2000 AS high FROM orders WHERE o_custkey % 3 <> 0),
m AS (SELECT r.event_id, max(CASE WHEN r.low >= g.low - 1e-6 AND r.high <= g.high + 1e-6 THEN 1 ELSE 0 END) AS ok, count(g.user_id) AS seen FROM r LEFT JOIN g USING (user_id) GROUP BY 1)
SELECT event_id, CASE WHEN ok = 1 THEN 'permitted' WHEN seen > 0 THEN 'outside interval' ELSE 'not listed' END AS decision FROM m""")
def _(spark, d):
    r = table(spark, d, "events").select("event_id", "user_id", F.col("value").alias("low"), (F.col("value") + 5).alias("high"))
    g = table(spark, d, "orders").where("o_custkey % 3 <> 0").select(F.col("o_custkey").alias("user_id"), (F.col("o_totalprice") / 5000).alias("low"), (F.col("o_totalprice") / 2000).alias("high"))
    return X.allowed(r, g, ["event_id"], "user_id")


@query("json_leaf_values", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, coalesce(json_extract_string(props, '$.missing'), 'none') AS other FROM events")
def _(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.coalesce(F.get_json_object("props", "$.missing"), F.lit("none")).alias("other"))


@query("json_leaves_exploded", "SELECT event_id, 'k' AS key, json_extract_string(props, '$.k') AS leaf FROM events")
def _(spark, d):
    m = F.from_json("props", "map<string,string>")
    return table(spark, d, "events").select("event_id", F.explode(m).alias("key", "leaf"))


_PARTS = "x AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN CAST(o_custkey AS VARCHAR) || '/' || CAST(o_orderkey % 7 AS VARCHAR) WHEN 1 THEN CAST(o_custkey AS VARCHAR) WHEN 2 THEN 'n/a' WHEN 3 THEN NULL ELSE '30000/1001' END AS s FROM orders)"


def odd_strings(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    s = F.when(k % 5 == 0, F.concat(c, F.lit("/"), (k % 7).cast("string"))).when(k % 5 == 1, c).when(k % 5 == 2, "n/a").when(k % 5 == 3, F.lit(None)).otherwise("30000/1001")
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", s.alias("s"))


@query("fraction_parse", f"WITH {_PARTS}, p AS (SELECT o_orderkey, try_cast(split_part(s, '/', 1) AS DOUBLE) AS a, CASE WHEN contains(s, '/') THEN try_cast(split_part(s, '/', 2) AS DOUBLE) ELSE 1 END AS b FROM x) SELECT o_orderkey, round(coalesce(CASE WHEN b <> 0 THEN a / b END, 0), 6) AS v FROM p")
def _(spark, d):
    return odd_strings(spark, d).select("o_orderkey", F.round(S.fraction(F.col("s")), 6).alias("v"))


@query("scalar_strings", """SELECT p_partkey, printf('shot%04d', p_partkey % 10000) AS id, trim(split_part(p_name || ' # note', '#', 1)) AS bare, regexp_replace(regexp_replace(lower('_' || p_type || ' ' || p_name), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS stem,
CASE WHEN p_size > 10 THEN CASE WHEN p_size > 30 THEN 'big_deep' ELSE 'big' END ELSE CASE WHEN p_size < 3 THEN 'flat' ELSE '' END END AS tag, nullif(trim(CASE WHEN p_size % 2 = 0 THEN '  ' ELSE p_brand END), '') AS brand, left(p_name || p_name || p_name, 20) AS cut FROM part""")
def _(spark, d):
    n = F.col("p_size")
    tag = S.tag({"big": n > 10, "deep": n > 30, "flat": n < 3})
    return table(spark, d, "part").select("p_partkey", F.format_string("shot%04d", F.col("p_partkey") % 10000).alias("id"), S.without_comment(F.concat("p_name", F.lit(" # note"))).alias("bare"), S.stem(F.concat(F.lit("_"), "p_type", F.lit(" "), "p_name")).alias("stem"), tag.alias("tag"), S.blank_to_null(F.when(n % 2 == 0, "  ").otherwise(F.col("p_brand"))).alias("brand"), F.left(F.concat("p_name", "p_name", "p_name"), F.lit(20)).alias("cut"))


@query("scalar_parsing", """SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS low, CAST(o_custkey + 5 AS DOUBLE) AS high, CAST(o_custkey AS INT) AS x, CAST(o_orderkey AS INT) AS y, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS sign, CASE WHEN o_orderkey % 4 = 0 THEN 1.0 ELSE round(4.0::DOUBLE / 3, 6) END AS sar, array_to_string(list_slice(['a', 'b', CAST(o_custkey AS VARCHAR), 'w', 'alpha'], 1, 3), '.') AS module FROM orders""")
def _(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    pair = S.number_pair(F.concat(c.cast("string"), F.lit(" - "), (c + 5).cast("string")))
    point = S.signed_point(F.concat_ws(",", c.cast("string"), k.cast("string"), F.when(k % 2 == 0, "+").otherwise("-")))
    sar = S.aspect(F.when(k % 4 == 0, "0:1").otherwise("4:3"))
    return table(spark, d, "orders").withColumn("p", pair).withColumn("q", point).select("o_orderkey", "p.low", "p.high", "q.x", "q.y", "q.sign", F.round(sar, 6).alias("sar"), S.parent_name(F.concat(F.lit("a.b."), c.cast("string"), F.lit(".w.alpha"))).alias("module"))


@query("scalar_formats", """SELECT o_orderkey, CASE WHEN v < 1024 THEN printf('%d B', v) WHEN v < 1048576 THEN printf('%.1f KiB', round(v / 1024.0::DOUBLE, 1)) ELSE printf('%.1f MiB', round(v / 1048576.0::DOUBLE, 1)) END AS size, CASE WHEN v >= 3600 THEN printf('%dh%02dm%02ds', v // 3600, v % 3600 // 60, v % 60) WHEN v >= 60 THEN printf('%dm%02ds', v // 60, v % 60) ELSE printf('%ds', v) END AS span,
strftime(o_orderdate, '%Y%m%dT%H%M%SZ') AS stamp, v // 16 AS frame_of FROM (SELECT o_orderkey, o_orderdate, CAST(floor(o_totalprice) AS BIGINT) % 2000000 * (o_orderkey % 3) AS v FROM orders)""")
def _(spark, d):
    v = F.floor("o_totalprice") % 2000000 * (F.col("o_orderkey") % 3)
    return table(spark, d, "orders").withColumn("v", v).select("o_orderkey", S.human_size(F.col("v")).alias("size"), S.human_time(F.col("v")).alias("span"), F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss'Z'").alias("stamp"), F.floor(F.col("v") / 16).alias("frame_of"))


@query("legal_lengths", "SELECT p_partkey AS n, ((greatest(p_partkey, 1) - 1) // 4) * 4 + 1 AS legal, CAST(greatest(16, round_even(p_partkey / 16.0, 0) * 16) AS BIGINT) AS sixteen, CAST(ceil(p_partkey / 73.0) AS BIGINT) AS chunks FROM part")
def _(spark, d):
    from ..operators.intervals import snap_length, to_sixteen

    n = F.col("n")
    return table(spark, d, "part").select(F.col("p_partkey").alias("n")).select("n", snap_length(n).alias("legal"), to_sixteen(n.cast("double")).alias("sixteen"), F.ceil(n / 73.0).alias("chunks"))


# settings that build on others: a customer's is a third of its number, some have none, the first two run in a circle
_CFG = "cfg(name, up) AS (SELECT c_custkey, CASE WHEN c_custkey % 97 = 0 THEN NULL WHEN c_custkey <= 2 THEN 3 - c_custkey ELSE c_custkey // 3 END FROM customer)"


@query("config_chain", f"WITH RECURSIVE {_CFG}, c(name, nxt, path) AS (SELECT name, up, [name] FROM cfg UNION ALL SELECT c.name, p.up, list_append(c.path, p.name) FROM c JOIN cfg p ON p.name = c.nxt WHERE NOT list_contains(c.path, p.name)), f AS (SELECT name, arg_max(path, len(path)) AS path, arg_max(coalesce(nxt, 0), len(path)) AS nxt FROM c GROUP BY name) SELECT name, array_to_string(path, '>') AS path, nxt <> 0 AS looped FROM f")
def _(spark, d):
    k = F.col("c_custkey")
    return chain(table(spark, d, "customer").select(k.alias("name"), F.when(k % 97 == 0, None).when(k <= 2, 3 - k).otherwise(F.expr("c_custkey div 3")).alias("up")), "name", "up")


_EDG = "edge(a, b) AS (SELECT p_partkey // 2, p_partkey FROM part WHERE p_partkey >= 2 UNION SELECT p_partkey // 3, p_partkey FROM part WHERE p_partkey >= 3)"


@query("topological_depth", f"WITH RECURSIVE {_EDG}, n AS (SELECT a AS node FROM edge UNION SELECT b FROM edge), w(node, depth) AS (SELECT node, 0 FROM n WHERE node NOT IN (SELECT b FROM edge) UNION SELECT b, depth + 1 FROM w JOIN edge ON a = node) SELECT CAST(node AS BIGINT) AS node, CAST(max(depth) AS BIGINT) AS depth FROM w GROUP BY 1")
def _(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("b"))
    return depths(p.where("b >= 2").select(F.expr("b div 2").alias("a"), F.col("b").cast("long").alias("b")).union(p.where("b >= 3").select(F.expr("b div 3"), F.col("b").cast("long"))))


@query("ranked_dates", "SELECT o_orderkey, date_trunc('month', o_orderdate) AS month, rank() OVER (PARTITION BY date_trunc('month', o_orderdate) ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders")
def _(spark, d):
    m = F.date_trunc("month", "o_orderdate").cast("timestamp_ntz")
    return table(spark, d, "orders").withColumn("month", m).select("o_orderkey", "month", F.rank().over(Window.partitionBy("month").orderBy(F.desc("o_totalprice"), "o_orderkey")).cast("long").alias("r"))


# windows over event time, in batch; the streaming package runs the same expressions


def _ts(spark, d):
    return table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query("tumbling_events", "SELECT epoch(time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01'))::BIGINT AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def _(spark, d):
    x = _ts(spark, d).groupBy(F.window("ts", "6 hours").alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return x.select(F.unix_seconds("w.start").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("sliding_events", "WITH x AS (SELECT event_type, value, epoch_us(time_bucket(INTERVAL 2 HOUR, ts, TIMESTAMP '1970-01-01')) // 1000000 AS t FROM events), y AS (SELECT t - 7200 * unnest(range(3)) AS start, event_type, value FROM x) SELECT CAST(start AS BIGINT) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM y GROUP BY ALL")
def _(spark, d):
    x = _ts(spark, d).groupBy(F.window("ts", "6 hours", "2 hours").alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return x.select(F.unix_seconds("w.start").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("session_events", """WITH x AS (SELECT user_id, ts, value, event_id, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM x)
SELECT user_id, epoch_us(min(ts)) AS start, count(*) AS n, round(sum(value), 4) AS total FROM s GROUP BY user_id, s""")
def _(spark, d):
    x = _ts(spark, d).groupBy("user_id", F.session_window("ts", "6 hours").alias("w")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return x.select("user_id", F.unix_micros("w.start").alias("start"), "n", F.round("total", 4).alias("total"))
