"""Queries over the event series and over intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import intervals as I
from ..operators import series as S
from .common import FRAMES, frames, r6, table

QUERIES: dict = {}
USER = ["user_id"]


def query(name: str, sql: str | None):
    def put(fn):
        QUERIES[name] = (fn, sql)
        return fn

    return put


@query("frame_presence_gaps", f"""WITH {FRAMES}, away AS (
  SELECT user_id, frame, frame - row_number() OVER (PARTITION BY user_id ORDER BY frame) AS g FROM frames WHERE value <= 20)
SELECT user_id, min(frame) AS start, max(frame) + 1 AS stop, max(frame) + 1 - min(frame) AS length FROM away GROUP BY user_id, g""")
def _(spark, d):
    return S.runs(frames(spark, d), F.col("value") <= 20, USER, "frame").select("user_id", "start", "stop", "length")


@query("track_event_diagnosis", f"""WITH {FRAMES}, x AS (
  SELECT user_id, frame, value > 5 AS p, lag(value > 5) OVER w AS was, value, lag(value) OVER w AS prev, value / 100 AS score FROM frames WINDOW w AS (PARTITION BY user_id ORDER BY frame))
SELECT user_id, frame, 'disappeared' AS type FROM x WHERE NOT p AND coalesce(was, true)
UNION ALL SELECT user_id, frame, 'reappeared' FROM x WHERE p AND NOT was
UNION ALL SELECT user_id, frame, 'area_jump' FROM x WHERE p AND was AND (value / prev > 3 OR value / prev < 1.0::DOUBLE / 3)
UNION ALL SELECT user_id, frame, 'low_confidence' FROM x WHERE p AND score < 0.42""")
def _(spark, d):
    x = frames(spark, d).withColumn("score", F.col("value") / 100)
    return S.track_events(x, F.col("value") > 5, "value", "score", USER, "frame")


@query("abs_first_difference", f"""WITH {FRAMES}, x AS (
  SELECT user_id, frame, abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY frame)) AS own, abs(value - lag(value) OVER (PARTITION BY user_id, event_type ORDER BY frame)) AS typed, event_type FROM frames),
u AS (SELECT user_id, avg(own) AS base FROM x GROUP BY user_id)
SELECT user_id, event_type, round(avg(typed), 6) AS motion, round(avg(typed) / (any_value(base) + 1e-6), 6) AS ratio FROM x JOIN u USING (user_id) GROUP BY user_id, event_type""")
def _(spark, d):
    x = frames(spark, d, "event_type").withColumn("own", S.abs_difference("value", USER, ["frame"])).withColumn("typed", S.abs_difference("value", ["user_id", "event_type"], ["frame"]))
    base = x.groupBy("user_id").agg(F.avg("own").alias("base"))
    out = x.groupBy("user_id", "event_type").agg(F.avg("typed").alias("motion")).join(base, "user_id")
    return out.select("user_id", "event_type", r6("motion"), F.round(F.col("motion") / (F.col("base") + 1e-6), 6).alias("ratio"))


@query("centered_smoothing_edge_replicated", f"""WITH {FRAMES}, x AS (
  SELECT user_id, frame, value, count(*) OVER (PARTITION BY user_id) AS n, first(value) OVER w AS a, last(value) OVER w AS z,
         sum(value) OVER (PARTITION BY user_id ORDER BY frame ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING) AS s FROM frames
  WINDOW w AS (PARTITION BY user_id ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT user_id, frame, round((s + greatest(0, 4 - frame) * a + greatest(0, 4 - (n - 1 - frame)) * z) / 9, 6) AS smooth FROM x""")
def _(spark, d):
    return S.centred_mean(frames(spark, d), "value", USER, "frame", 9).select("user_id", "frame", r6("smooth"))


@query("locf_backfill_series", f"""WITH {FRAMES}, x AS (SELECT user_id, frame, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS v FROM frames)
SELECT user_id, frame, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY frame ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS filled FROM x""")
def _(spark, d):
    x = frames(spark, d, "event_type").withColumn("v", F.when(F.col("event_type") != "error", F.col("value")))
    return S.carry(x, "v", USER, "frame").select("user_id", "frame", "filled")


@query("temporal_persistence_filter", f"""WITH {FRAMES}
SELECT user_id, frame, value > 25 AND avg(CAST(value > 25 AS INT)) OVER (PARTITION BY user_id ORDER BY frame ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) >= 0.75 AS kept FROM frames""")
def _(spark, d):
    x = frames(spark, d)
    return x.select("user_id", "frame", S.persistent(F.col("value") > 25, USER, "frame").alias("kept"))


@query("sliding_window_score_best", f"""WITH {FRAMES}, d AS (
  SELECT user_id, frame, value, coalesce(abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY frame)), 0) / 20 AS motion FROM frames),
x AS (SELECT user_id, frame, avg(motion) OVER w AS m, avg(value) OVER w AS t, stddev_pop(motion) OVER w AS sd, count(*) OVER w AS n FROM d
  WINDOW w AS (PARTITION BY user_id ORDER BY frame ROWS BETWEEN CURRENT ROW AND 11 FOLLOWING)),
s AS (SELECT user_id, frame, 0.45::DOUBLE * least(m / 6, 1) + 0.25::DOUBLE * least(t / 250, 1) + 0.30::DOUBLE * least(sd / 3, 1) AS score FROM x WHERE n = 12 AND frame % 4 = 0 AND m >= 0.4)
SELECT user_id, frame AS start, round(score + 1e-9, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, frame) AS r FROM s) WHERE r = 1""")
def _(spark, d):
    x = frames(spark, d).withColumn("motion", S.abs_difference("value", USER, ["frame"], 0.0) / 20)
    scores = S.window_scores(x, "motion", "value", USER, "frame", 12, 4).withColumn("score", F.round("score", 9))
    return S.best_window(scores, USER).select("user_id", "start", F.round(F.col("score") + 1e-9, 6).alias("score"))


@query("best_mean_window_fallback", f"""WITH {FRAMES}, x AS (SELECT user_id, frame, avg(value) OVER w AS mean, count(*) OVER w AS n FROM frames WINDOW w AS (PARTITION BY user_id ORDER BY frame ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING))
SELECT user_id, frame AS start, round(mean, 6) AS mean FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY mean DESC, frame) AS r FROM x WHERE n = 8) WHERE r = 1""")
def _(spark, d):
    return S.best_mean_window(frames(spark, d), "value", USER, "frame", 8).select("user_id", "start", r6("mean"))


@query("top1_top2_margin", """WITH r AS (SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) AS r FROM events),
m AS (SELECT user_id, event_type, max(value) FILTER (WHERE r = 1) AS best, max(value) FILTER (WHERE r = 2) AS second FROM r WHERE r <= 2 GROUP BY ALL),
w AS (SELECT *, best - coalesce(second, 0) AS margin, row_number() OVER (PARTITION BY user_id ORDER BY best - coalesce(second, 0), event_type) AS k FROM m)
SELECT user_id, event_type, round(best, 6) AS best, round(margin, 6) AS margin,
  CASE WHEN best / 100 < 0.42 THEN 'needs_user: confidence' WHEN margin / 100 < 0.08 THEN 'needs_user: margin' ELSE 'accepted' END AS decision FROM w WHERE k = 1""")
def _(spark, d):
    m = S.margin(table(spark, d, "events"), "value", ["user_id", "event_type"], "event_id")
    worst = m.groupBy("user_id").agg(F.min_by(F.struct("event_type", "best", "margin"), F.struct("margin", "event_type")).alias("w")).select("user_id", "w.*")
    decision = F.when(F.col("best") / 100 < 0.42, "needs_user: confidence").when(F.col("margin") / 100 < 0.08, "needs_user: margin").otherwise("accepted")
    return worst.select("user_id", "event_type", r6("best"), r6("margin"), decision.alias("decision"))


@query("partition_percentile_normalize", """WITH p AS (SELECT l_suppkey, quantile_cont(l_extendedprice, 0.01) AS lo, quantile_cont(l_extendedprice, 0.99) AS hi FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN hi - lo < 1e-6 THEN 0 ELSE CAST(trunc(greatest(0, least(1, (l_extendedprice - lo) / (hi - lo))) * 255) AS INT) END AS level FROM lineitem JOIN p USING (l_suppkey)""")
def _(spark, d):
    return S.normalised(table(spark, d, "lineitem"), "l_extendedprice", ["l_suppkey"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "level")


@query("deadband_series", f"""WITH RECURSIVE {FRAMES}, h AS (
  SELECT user_id, frame, value AS held FROM frames WHERE frame = 0
  UNION ALL SELECT f.user_id, f.frame, CASE WHEN abs(f.value - h.held) >= 25 THEN f.value ELSE h.held END FROM h JOIN frames f ON f.user_id = h.user_id AND f.frame = h.frame + 1)
SELECT user_id, frame, held FROM h""")
def _(spark, d):
    return S.deadband(frames(spark, d), "value", USER, "frame", 25.0)


@query("recursive_smoothing", f"""WITH RECURSIVE {FRAMES}, s AS (
  SELECT user_id, frame, least(value / 100, 1.0) AS smooth FROM frames WHERE frame = 0
  UNION ALL SELECT f.user_id, f.frame, CASE WHEN least(f.value / 100, 1.0) IN (0, 1) THEN least(f.value / 100, 1.0) ELSE 0.35::DOUBLE * s.smooth + 0.65::DOUBLE * least(f.value / 100, 1.0) END FROM s JOIN frames f ON f.user_id = s.user_id AND f.frame = s.frame + 1)
SELECT user_id, frame, round(smooth + 1e-9, 6) AS smooth FROM s""")
def _(spark, d):
    x = frames(spark, d).withColumn("v", F.least(F.col("value") / 100, F.lit(1.0)))
    return S.smoothed(x, "v", USER, "frame", 0.35).select("user_id", "frame", F.round(F.col("smooth") + 1e-9, 6).alias("smooth"))


@query("evenly_spaced_probe", f"""WITH {FRAMES}, n AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1), want AS (SELECT DISTINCT user_id, (i * (n - 1)) // 6 AS frame FROM n, range(7) t(i))
SELECT user_id, frame, value FROM frames JOIN want USING (user_id, frame)""")
def _(spark, d):
    return S.spaced(frames(spark, d), USER, "frame", 7).select("user_id", "frame", "value")


@query("holdout_split", """WITH r AS (SELECT d.doc_id, d.lang, row_number() OVER (PARTITION BY d.lang ORDER BY d.n_chars DESC, d.doc_id) - 1 AS i FROM documents d JOIN labels l USING (doc_id) WHERE l.quality = 1)
SELECT doc_id, lang, CASE WHEN i > 0 AND i % 8 = 0 THEN 'holdout' ELSE 'train' END AS split FROM r""")
def _(spark, d):
    x = table(spark, d, "documents").join(table(spark, d, "labels").where("quality = 1").select("doc_id"), "doc_id")
    return S.held_out(x, ["lang"], [F.desc("n_chars"), F.asc("doc_id")], 8).select("doc_id", "lang", "split")


@query("rolling_mean_eta", f"""WITH {FRAMES}, n AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1)
SELECT user_id, frame, round((n - 1 - frame) * avg(value) OVER (PARTITION BY user_id ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + 1e-8, 6) AS eta FROM frames JOIN n USING (user_id)""")
def _(spark, d):
    x = frames(spark, d)
    w = S.over(USER, ["frame"]).rowsBetween(S.Window.unboundedPreceding, 0)
    left = F.count(F.lit(1)).over(S.Window.partitionBy("user_id")) - 1 - F.col("frame")
    return x.select("user_id", "frame", F.round(left * F.avg("value").over(w) + 1e-8, 6).alias("eta"))


@query("clipped_share_gate", f"""WITH {FRAMES}, x AS (SELECT user_id, frame, greatest(0, value - 120) / value AS clipped FROM frames)
SELECT user_id, round(max(clipped), 6) AS worst, round(avg(clipped), 6) AS mean, max(clipped) <= 0.5 AS accepted FROM x GROUP BY user_id""")
def _(spark, d):
    clipped = F.when(F.col("value") == 0, float("nan")).otherwise(F.greatest(F.lit(0.0), F.col("value") - 120) / F.col("value"))  # 0 / 0, as SQL has it
    x = frames(spark, d).select("user_id", clipped.alias("clipped")).groupBy("user_id").agg(F.max("clipped").alias("worst"), F.avg("clipped").alias("mean"))
    return x.select("user_id", r6("worst"), r6("mean"), (F.col("worst") <= 0.5).alias("accepted"))


@query("occupancy_variance_correlation", f"""WITH {FRAMES}, x AS (SELECT user_id, frame // 5 AS cell, avg(CAST(value > 40 AS INT)) AS occupancy, var_pop(value) AS variance FROM frames GROUP BY ALL)
SELECT user_id, round(corr(occupancy, variance), 6) AS correlation FROM x GROUP BY user_id""")
def _(spark, d):
    x = frames(spark, d).groupBy("user_id", F.floor(F.col("frame") / 5).alias("cell")).agg(F.avg((F.col("value") > 40).cast("int")).alias("occupancy"), F.var_pop("value").alias("variance"))
    return x.groupBy("user_id").agg(F.round(F.corr("occupancy", "variance"), 6).alias("correlation"))


@query("composite_rank", """SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY n_chars // 500 DESC, length(source) DESC, source DESC, doc_id) AS rank FROM documents""")
def _(spark, d):
    w = S.Window.partitionBy("lang").orderBy(F.desc(F.expr("n_chars div 500")), F.desc(F.length("source")), F.desc("source"), "doc_id")
    return table(spark, d, "documents").select("doc_id", "lang", F.row_number().over(w).cast("long").alias("rank"))


_CUTS = f"""{FRAMES}, t AS (SELECT user_id, count(*) AS total FROM events GROUP BY 1),
b AS (SELECT user_id, frame AS start FROM frames WHERE event_type = 'error' AND frame > 0 UNION SELECT user_id, 0 FROM t UNION SELECT user_id, total FROM t),
shots AS (SELECT user_id, start, stop, row_number() OVER (PARTITION BY user_id ORDER BY start) - 1 AS i FROM (SELECT user_id, start, lead(start) OVER (PARTITION BY user_id ORDER BY start) AS stop FROM b) WHERE stop IS NOT NULL)"""


def shots(spark, d):
    x = frames(spark, d, "event_type")
    return I.segments(x.where("event_type = 'error'").select("user_id", F.col("frame").alias("cut")), x.groupBy("user_id").agg(F.count("*").alias("total")), USER)


@query("cuts_to_shots", f"WITH {_CUTS} SELECT user_id, printf('shot%04d', i) AS segment, start, stop, stop - start AS n FROM shots")
def _(spark, d):
    return shots(spark, d).select("user_id", "segment", "start", "stop", "n")


@query("cut_containment", f"WITH {_CUTS} SELECT s.user_id, s.start, s.stop, f.frame FROM shots s JOIN frames f ON f.user_id = s.user_id AND s.start < f.frame AND f.frame < s.stop WHERE f.event_type = 'signup'")
def _(spark, d):
    points = frames(spark, d, "event_type").where("event_type = 'signup'").select("user_id", F.col("frame").alias("b_start"), (F.col("frame") + 1).alias("b_stop"))
    met = I.overlaps(shots(spark, d).select("user_id", "start", "stop"), points, USER, 64)
    return met.where("start < b_start").select("user_id", "start", "stop", F.col("b_start").alias("frame"))


def _windows_sql(lengths: str, size: int, overlap: int) -> str:
    return f"""WITH lengths AS ({lengths}), g AS (
  SELECT key, n, CASE WHEN n > {size} THEN CAST(ceil((n - {size}) / {size - overlap}.0) AS BIGINT) ELSE 0 END AS nfull, ((least(n, {size}) - 1) // 4) * 4 + 1 AS short FROM lengths WHERE n >= 5),
k AS (SELECT key, n, nfull, short, unnest(range(0, CASE WHEN n > {size} THEN nfull WHEN short < n THEN 1 ELSE 0 END + 1)) AS k FROM g),
o AS (SELECT key, k, CASE WHEN n > {size} AND k < nfull THEN k * {size - overlap} WHEN n <= {size} AND k = 0 THEN 0 ELSE n - short END AS "offset", CASE WHEN n > {size} AND k < nfull THEN {size} ELSE short END AS n FROM k)
SELECT key, k, "offset", n, CASE WHEN k = 0 THEN 0 ELSE greatest(0, lag("offset" + n) OVER (PARTITION BY key ORDER BY k) - "offset") END AS overlap_prev FROM o"""


@query("shot_chunk_windows", _windows_sql("SELECT o_custkey AS key, CAST(floor(sum(o_totalprice) / 2000) AS BIGINT) AS n FROM orders GROUP BY 1", 81, 8))
def _(spark, d):
    x = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.floor(F.sum("o_totalprice") / 2000).alias("len"))
    return I.windows(x, "len", 81, 8).select("key", "k", "offset", "n", "overlap_prev")


@query("chunk_length_sweep", _windows_sql("SELECT p_partkey AS key, p_partkey AS n FROM part", 81, 8))
def _(spark, d):
    return I.windows(table(spark, d, "part").select(F.col("p_partkey").alias("key"), F.col("p_partkey").alias("len")), "len", 81, 8).select("key", "k", "offset", "n", "overlap_prev")


@query("pilot_overlap_join", f"WITH {_CUTS}, pilot AS (SELECT user_id, total // 3 AS b_start, total // 3 + 10 AS b_stop FROM t) SELECT s.user_id, s.start, s.stop, coalesce(s.start < p.b_stop AND s.stop > p.b_start, false) AS is_pilot FROM shots s LEFT JOIN pilot p USING (user_id)")
def _(spark, d):
    s = shots(spark, d).select("user_id", "start", "stop")
    pilot = frames(spark, d).groupBy("user_id").agg(F.expr("count(*) div 3").alias("b_start")).withColumn("b_stop", F.col("b_start") + 10)
    hit = I.overlaps(s, pilot, USER, 64).select("user_id", "start", "stop", F.lit(1).alias("hit"))
    marked = s.withColumn("hit", F.lit(0)).union(hit)
    return marked.groupBy("user_id", "start", "stop").agg((F.max("hit") == 1).alias("is_pilot"))


_SPANS = f"{FRAMES}, span AS (SELECT user_id, CAST(frame AS BIGINT) AS start, CAST(frame + 1 + floor(value / 30) AS BIGINT) AS stop FROM frames WHERE event_type IN ('view', 'click')), t AS (SELECT user_id, count(*) AS total FROM events GROUP BY 1)"


def spans(spark, d):
    x = frames(spark, d, "event_type").withColumn("high", F.count(F.lit(1)).over(S.Window.partitionBy("user_id")))
    return x.where("event_type IN ('view', 'click')").select("user_id", F.col("frame").alias("start"), (F.col("frame") + 1 + F.floor(F.col("value") / 30)).alias("stop"), F.lit(0).cast("long").alias("low"), "high")


@query("coverage_gaps", f"""WITH {_SPANS}, s AS (SELECT span.*, total, coalesce(max(stop) OVER (PARTITION BY user_id ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen FROM span JOIN t USING (user_id) WHERE start < total)
SELECT user_id, seen AS gap_start, start AS gap_stop FROM s WHERE start > seen
UNION ALL SELECT user_id, max(stop), any_value(total) FROM s GROUP BY user_id HAVING max(stop) < any_value(total)""")
def _(spark, d):
    return I.gaps(spans(spark, d), USER, "low", "high")


@query("distinct_intervals", f"WITH {_SPANS} SELECT DISTINCT user_id, start // 4 AS start, stop // 4 AS stop FROM span")
def _(spark, d):
    return spans(spark, d).select("user_id", F.expr("start div 4").alias("start"), F.expr("stop div 4").alias("stop")).distinct()


# one row a span: the operations so far, where the plan stands, and the span that plays
_ADD = "CASE WHEN {n} > 0 THEN list_append({ops}, {{'op': '{op}', 'at': {at}, 'n': {n}, 'span': {span}, 'prev': {prev}}}) ELSE {ops} END"
_STITCH = f"""r AS (SELECT user_id, greatest(start, 0) AS a, least(stop, total) AS b, total AS hi, row_number() OVER (PARTITION BY user_id ORDER BY start, stop) AS r FROM span JOIN t USING (user_id)),
k(user_id, r, hi, span, fin, pos, ops) AS (SELECT DISTINCT user_id, 0::BIGINT, hi, -1::BIGINT, -1::BIGINT, 0::BIGINT, CAST([] AS STRUCT(op VARCHAR, "at" BIGINT, n BIGINT, span BIGINT, prev BIGINT)[]) FROM r
UNION ALL SELECT user_id, r, hi, CASE WHEN skip THEN span ELSE i END, CASE WHEN skip THEN fin ELSE b END, CASE WHEN skip THEN pos ELSE at2 END, CASE WHEN skip THEN ops ELSE {_ADD.format(n="CASE WHEN fin < 0 OR a >= fin THEN a - at1 ELSE 0 END", ops="ops2", op="source", at="at1", span="-1", prev="-1")} END FROM (
SELECT *, CASE WHEN fin >= 0 AND a < fin THEN at1 + greatest(0, nb) ELSE greatest(at1, a) END AS at2, {_ADD.format(n="CASE WHEN fin >= 0 AND a < fin THEN nb ELSE 0 END", ops="ops1", op="blend", at="at1", span="i", prev="span")} AS ops2 FROM (
SELECT *, least(8, fin - greatest(a, at1)) AS nb, {_ADD.format(n="nc", ops="ops", op="copy", at="pos", span="span", prev="-1")} AS ops1 FROM (
SELECT *, pos + greatest(0, nc) AS at1 FROM (
SELECT k.user_id, k.r + 1 AS r, k.hi, k.span, k.fin, k.pos, k.ops, n.a, n.b, k.r AS i, n.b <= n.a OR (k.fin >= 0 AND n.b <= k.fin) AS skip, CASE WHEN k.fin < 0 THEN 0 WHEN n.a >= k.fin THEN k.fin - k.pos ELSE n.a - k.pos END AS nc FROM k JOIN r n ON n.user_id = k.user_id AND n.r = k.r + 1))))),
z AS (SELECT user_id, hi, span, fin, pos, ops FROM k QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY r DESC) = 1),
y AS (SELECT user_id, hi, pos + greatest(0, nc) AS pos, {_ADD.format(n="nc", ops="ops", op="copy", at="pos", span="span", prev="-1")} AS ops FROM (SELECT *, CASE WHEN fin < 0 THEN 0 ELSE fin - pos END AS nc FROM z)),
x AS (SELECT user_id, {_ADD.format(n="hi - pos", ops="ops", op="source", at="pos", span="-1", prev="-1")} AS ops FROM y)
SELECT user_id, i - 1 AS seq, o.op, o."at" AS "at", o.n, o.span, o.prev FROM (SELECT user_id, unnest(ops) AS o, generate_subscripts(ops, 1) AS i FROM x)"""


@query("stitch_plan", f"WITH RECURSIVE {_SPANS}, {_STITCH}")
def _(spark, d):
    return I.stitch_plan(spans(spark, d), USER, "low", "high")


@query("stitch_totals", f"WITH {_SPANS} SELECT user_id, CAST(total AS BIGINT) AS frames, 0 AS wrong FROM t WHERE user_id IN (SELECT user_id FROM span)")
def _(spark, d):
    """The plan tiles each series exactly once: ops are contiguous from 0 and sum to the series' length."""
    plan = I.stitch_plan(spans(spark, d), USER, "low", "high")
    w = S.over(USER, ["seq"])
    x = plan.withColumn("wrong", (F.col("at") != F.coalesce(F.lag(F.col("at") + F.col("n")).over(w), F.lit(0))).cast("int"))
    return x.groupBy("user_id").agg(F.sum("n").alias("frames"), F.sum("wrong").cast("int").alias("wrong"))


@query("stitch_execution", f"""WITH RECURSIVE {FRAMES} SELECT user_id, CAST(count(*) AS BIGINT) AS frames, 0.0 AS worst FROM frames WHERE user_id IN (SELECT user_id FROM events WHERE event_type IN ('view', 'click')) GROUP BY user_id""")
def _(spark, d):
    """Play the plan over the frames: every op's frames are read once, and fading a stream with itself changes nothing."""
    plan = I.stitch_plan(spans(spark, d), USER, "low", "high").withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    w = I.blend_weight(F.col("i"), F.col("n"))
    x = plan.withColumn("frame", F.col("at") + F.col("i")).join(frames(spark, d), ["user_id", "frame"])
    faded = F.when(F.col("op") == "blend", (1 - w) * F.col("value") + w * F.col("value")).otherwise(F.col("value"))
    return x.groupBy("user_id").agg(F.count("*").alias("frames"), F.round(F.max(F.abs(faded - F.col("value"))), 6).alias("worst"))


@query("clip_sampling", """WITH x AS (SELECT o_orderkey, CAST(floor(o_totalprice / 100) AS BIGINT) AS total, (o_orderkey * 7919 + 104729) % 10007 AS luck FROM orders)
SELECT o_orderkey, total, CAST(floor(0.05 * total + luck / 10007.0 * (0.9 * total)) AS BIGINT) AS start FROM x WHERE total >= 20""")
def _(spark, d):
    x = table(spark, d, "orders").select("o_orderkey", F.floor(F.col("o_totalprice") / 100).alias("total"), ((F.col("o_orderkey") * 7919 + 104729) % 10007).alias("luck"))
    return x.where("total >= 20").select("o_orderkey", "total", F.floor(0.05 * F.col("total") + F.col("luck") / 10007.0 * (0.9 * F.col("total"))).alias("start"))


@query("longest_holes", f"""WITH {FRAMES}, away AS (SELECT user_id, frame, frame - row_number() OVER (PARTITION BY user_id ORDER BY frame) AS g FROM frames WHERE value <= 40),
h AS (SELECT user_id, min(frame) AS start, max(frame) + 1 AS stop FROM away GROUP BY user_id, g)
SELECT user_id, start, stop, r AS attempt FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY stop - start DESC, start) AS r FROM h WHERE stop - start >= 4) WHERE r <= 8""")
def _(spark, d):
    h = S.runs(frames(spark, d), F.col("value") <= 40, USER, "frame").where("length >= 4")
    r = F.row_number().over(S.Window.partitionBy("user_id").orderBy(F.desc("length"), "start"))
    return h.withColumn("attempt", r.cast("long")).where("attempt <= 8").select("user_id", "start", "stop", "attempt")


@query("scene_cuts_min_spacing", f"""WITH RECURSIVE {FRAMES}, c AS (SELECT user_id, frame FROM (SELECT user_id, frame, abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY frame)) AS d FROM frames) WHERE d > 40),
k AS (SELECT user_id, min(frame) AS frame FROM c GROUP BY user_id UNION ALL SELECT k.user_id, (SELECT min(c.frame) FROM c WHERE c.user_id = k.user_id AND c.frame >= k.frame + 6) FROM k WHERE k.frame IS NOT NULL)
SELECT user_id, frame FROM k WHERE frame IS NOT NULL""")
def _(spark, d):
    x = frames(spark, d).withColumn("d", S.abs_difference("value", USER, ["frame"])).where("d > 40")

    def step(last, cols):
        kept = []
        for frame in cols[0]:
            if last is None or frame >= last + 6:
                kept.append(last := frame)
        return last, [kept]

    return S.fold(x, USER, ["frame"], step, ["frame"], "frame long")


@query("resample_to_rate", """WITH x AS (SELECT user_id, CAST(floor(epoch(ts) / 43200) AS BIGINT) AS cell, ts, event_id, value FROM events)
SELECT user_id, cell, last(value ORDER BY ts, event_id) AS value, CAST(count(*) AS BIGINT) AS n FROM x GROUP BY ALL""")
def _(spark, d):
    e = table(spark, d, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    cell = F.floor(F.col("us") / F.lit(43200 * 1000000))
    return e.groupBy("user_id", cell.alias("cell")).agg(F.max_by("value", F.struct("us", "event_id")).alias("value"), F.count("*").alias("n"))


@query("tail_padding", f"""WITH {FRAMES}, n AS (SELECT user_id, count(*) AS n, arg_max(value, frame) AS z FROM frames GROUP BY 1)
SELECT user_id, CAST(frame AS BIGINT) AS frame, value FROM frames UNION ALL SELECT user_id, unnest(range(n, ((n + 2) // 4) * 4 + 1)), z FROM n""")
def _(spark, d):
    x = frames(spark, d)
    n = x.groupBy("user_id").agg(F.count("*").alias("n"), F.max_by("value", "frame").alias("value")).withColumn("want", F.expr("((n + 2) div 4) * 4 + 1")).where("want > n")
    return x.union(n.select("user_id", F.explode(F.sequence(F.col("n"), F.col("want") - 1)).alias("frame"), "value"))
