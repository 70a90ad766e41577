"""Derivatives, islands, sliding windows, state edges."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import windows as ops
from ..operators.chunked import Series, carried_value, over_chunks
from ..operators.islands import merge_events, number_islands, runs, sparse_runs, summarise
from .base import by_time, EV, SQL_BY_TIME, events, query, query_in_chunks, table

W = f"OVER {SQL_BY_TIME}"
HOUR, DAY = 3600.0, 86_400.0
#: Some runs and windows of the events reach over several pieces of this length, and many pieces hold no row of a drive.
CHUNK = 0.75 * DAY


def in_time(chunk: float | None) -> Series:
    return Series(("drive_id",), ("t", "event_id"), chunk)


@query_in_chunks(f"""WITH {EV}, d AS (SELECT event_id, t, value, t - lag(t) {W} AS dt, value - lag(value) {W} AS dv FROM ev)
    SELECT event_id, dv / dt AS rate, t - dt / 2 AS mid FROM d WHERE dt > 0 AND dt <= 86400""", CHUNK)
def derivative_mid(spark, sf_dir, chunk=None):
    d = over_chunks(events(spark, sf_dir), in_time(chunk), lambda rows, w: rows.withColumns({"rate": ops.derivative(w, "value", max_dt=DAY)[0], "mid": F.col("t") - ops.gap(w) / 2}), 1)
    return d.select("event_id", "rate", "mid").filter("rate IS NOT NULL")


@query_in_chunks(f"""WITH {EV}, m AS (SELECT drive_id, median(dt) AS dt FROM (SELECT drive_id, t - lag(t) {W} AS dt FROM ev) WHERE dt > 0 GROUP BY drive_id),
    d AS (SELECT event_id, value, lag(value) {W} AS p, lead(value) {W} AS n, m.dt FROM ev JOIN m USING (drive_id))
    SELECT event_id, CASE WHEN p IS NULL THEN (n - value) / dt WHEN n IS NULL THEN (value - p) / dt ELSE (n - p) / (2 * dt) END AS slope FROM d""", CHUNK)
def central_diff(spark, sf_dir, chunk=None):
    ev = events(spark, sf_dir)
    both = ev.join(ops.median_step(ev, ["drive_id"]).select("drive_id", "dt"), "drive_id")
    d = over_chunks(both, in_time(chunk), lambda rows, w: rows.withColumn("slope", ops.central_difference(w, "value", F.col("dt"))), 1, 1)
    return d.select("event_id", "slope")


@query(f"""WITH {EV}, s AS (SELECT drive_id, t - lag(t) {W} AS dt FROM ev) SELECT drive_id, median(dt) AS dt, least(greatest(1 / median(dt), 1.0), 100.0) AS rate FROM s WHERE dt > 0 GROUP BY drive_id""")
def sampling_rate_median(spark, sf_dir):
    return ops.median_step(events(spark, sf_dir), ["drive_id"]).select("drive_id", "dt", "rate")


@query(f"""WITH {EV}, g AS (SELECT drive_id, t AS from_t, lead(t) {W} AS to_t FROM ev) SELECT drive_id, from_t, to_t, to_t - from_t AS gap, to_t - from_t > 86400 AS flagged FROM g WHERE to_t - from_t > 3600""")
def time_gaps(spark, sf_dir):
    g = events(spark, sf_dir).select("drive_id", F.col("t").alias("from_t"), F.lead("t").over(by_time()).alias("to_t"))
    return g.withColumn("gap", F.col("to_t") - F.col("from_t")).filter(f"gap > {HOUR}").withColumn("flagged", F.col("gap") > DAY)


_ISLANDS = """i AS (SELECT *, sum(CASE WHEN brk THEN 1 ELSE 0 END) OVER (PARTITION BY drive_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS island FROM b)"""
_EVENT = "drive_id, min(t) AS start_ts, max(t) AS end_ts, count(*) AS frame_count, arg_max(value, abs(value)) AS peak"


def _as_events(rows, *more):
    out = summarise(rows, ["drive_id"], F.col("value"), "t", "abs_max")
    return out.select("drive_id", "start_ts", "end_ts", "frame_count", "peak", *more)


@query_in_chunks(f"""WITH {EV}, b AS (SELECT *, lag(is_auto) {W} IS DISTINCT FROM is_auto AS brk FROM ev), {_ISLANDS}
    SELECT {_EVENT} FROM i WHERE is_auto GROUP BY drive_id, island HAVING max(t) - min(t) >= 3600""", CHUNK)
def islands_threshold_min_dur(spark, sf_dir, chunk=None):
    rows = runs(events(spark, sf_dir), ["drive_id"], ["t", "event_id"], F.col("is_auto"), chunk=chunk)
    return _as_events(rows).filter(f"end_ts - start_ts >= {HOUR}")


@query_in_chunks(f"""WITH {EV}, b AS (SELECT *, lag(is_auto) {W} IS DISTINCT FROM is_auto OR coalesce(t - lag(t) {W} > 43200, false) AS brk FROM ev), {_ISLANDS}
    SELECT {_EVENT} FROM i WHERE is_auto GROUP BY drive_id, island""", CHUNK)
def islands_gap_break(spark, sf_dir, chunk=None):
    return _as_events(runs(events(spark, sf_dir), ["drive_id"], ["t", "event_id"], F.col("is_auto"), max_gap=DAY / 2, chunk=chunk))


@query_in_chunks(f"""WITH {EV}, n AS (SELECT *, row_number() {W} AS rn FROM ev), f AS (SELECT * FROM n WHERE value > 60),
    b AS (SELECT *, coalesce(rn - lag(rn) {W} > 3 OR t - lag(t) {W} > 86400, true) AS brk FROM f), {_ISLANDS} SELECT {_EVENT} FROM i GROUP BY drive_id, island""", CHUNK)
def islands_index_gap(spark, sf_dir, chunk=None):
    return _as_events(sparse_runs(events(spark, sf_dir), ["drive_id"], ["t", "event_id"], F.col("value") > 60, max_rows=3, max_gap=DAY, chunk=chunk))


@query_in_chunks(f"""WITH {EV}, f AS (SELECT * FROM ev WHERE value > 20), b AS (SELECT *, coalesce(topic <> lag(topic) {W} OR t - lag(t) {W} > 172800, true) AS brk FROM f), {_ISLANDS}
    SELECT drive_id, min(t) AS start_ts, max(t) AS end_ts, count(*) AS frame_count, min(topic) AS class FROM i GROUP BY drive_id, island""", CHUNK)
def islands_by_class(spark, sf_dir, chunk=None):
    rows = sparse_runs(events(spark, sf_dir), ["drive_id"], ["t", "event_id"], F.col("value") > 20, max_gap=2 * DAY, same=["topic"], chunk=chunk)
    out = summarise(rows, ["drive_id"], F.col("value"), "t", "max", F.min("topic").alias("class"))
    return out.select("drive_id", "start_ts", "end_ts", "frame_count", "class")


_RUNS = f"""b AS (SELECT *, lag(value > 40) {W} IS DISTINCT FROM (value > 40) AS brk FROM ev), {_ISLANDS}, e AS (SELECT {_EVENT} FROM i WHERE value > 40 GROUP BY drive_id, island)"""


@query_in_chunks(f"""WITH {EV}, {_RUNS}, g AS (SELECT *, coalesce(start_ts - lag(end_ts) OVER (PARTITION BY drive_id ORDER BY start_ts, end_ts) > 43200, true) AS nb FROM e),
    m AS (SELECT *, sum(CASE WHEN nb THEN 1 ELSE 0 END) OVER (PARTITION BY drive_id ORDER BY start_ts, end_ts ROWS UNBOUNDED PRECEDING) AS mg FROM g)
    SELECT drive_id, min(start_ts) AS start_ts, max(end_ts) AS end_ts, CAST(sum(frame_count) AS BIGINT) AS frame_count, max(peak) AS peak FROM m GROUP BY drive_id, mg""", CHUNK)
def merge_events_gap(spark, sf_dir, chunk=None):
    found = _as_events(runs(events(spark, sf_dir), ["drive_id"], ["t", "event_id"], F.col("value") > 40, chunk=chunk))
    merged = merge_events(found, ["drive_id"], DAY / 2, chunk=chunk)
    return merged.groupBy("drive_id", "merged").agg(F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts"), F.sum("frame_count").alias("frame_count"), F.max("peak").alias("peak")).drop("merged")


@query_in_chunks(f"""WITH {EV}, k AS (SELECT drive_id, t AS start_ts, t + 3600 AS end_ts, 'rate' AS kind, value FROM ev WHERE value > 70 UNION ALL SELECT drive_id, t, t + 1800, 'acc', value FROM ev WHERE topic = 'error' AND value > 30),
    g AS (SELECT *, coalesce(start_ts - lag(end_ts) OVER (PARTITION BY drive_id ORDER BY start_ts, end_ts) > 21600, true) AS nb FROM k),
    m AS (SELECT *, sum(CASE WHEN nb THEN 1 ELSE 0 END) OVER (PARTITION BY drive_id ORDER BY start_ts, end_ts ROWS UNBOUNDED PRECEDING) AS mg FROM g)
    SELECT drive_id, min(start_ts) AS start_ts, max(end_ts) AS end_ts, count(*) AS parts, CASE WHEN count(DISTINCT kind) > 1 THEN 'both' ELSE min(kind) END AS kind, max(value) AS peak FROM m GROUP BY drive_id, mg""", CHUNK)
def union_merge_events(spark, sf_dir, chunk=None):
    ev = events(spark, sf_dir)
    kind = lambda cond, dur, name: ev.filter(cond).select("drive_id", F.col("t").alias("start_ts"), (F.col("t") + dur).alias("end_ts"), F.lit(name).alias("kind"), "value")
    both = kind("value > 70", HOUR, "rate").unionByName(kind("topic = 'error' AND value > 30", HOUR / 2, "acc"))
    merged = merge_events(both, ["drive_id"], DAY / 4, chunk=chunk)
    name = F.when(F.countDistinct("kind") > 1, "both").otherwise(F.min("kind"))
    return merged.groupBy("drive_id", "merged").agg(F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts"), F.count(F.lit(1)).alias("parts"), name.alias("kind"), F.max("value").alias("peak")).drop("merged")


@query(f"""WITH {EV}, b AS (SELECT *, coalesce(t - lag(t) {W} > 86400, true) AS brk FROM ev), {_ISLANDS},
    s AS (SELECT drive_id, island, min(t) AS start_ts, max(t) AS end_ts, min(value) AS least, count(*) AS n FROM i GROUP BY drive_id, island)
    SELECT drive_id, start_ts, end_ts, least, n FROM s ORDER BY least, drive_id, start_ts LIMIT 30""")
def session_by_track_topk(spark, sf_dir):
    ev = events(spark, sf_dir).withColumn("ts", F.timestamp_micros((F.col("t") * 1e6).cast("bigint")))
    gap = F.coalesce(F.col("t") - F.lag("t").over(by_time()) > DAY, F.lit(True))
    rows = number_islands(ev.withColumn("_b", gap), ["drive_id"], ["t", "event_id"], F.col("_b"))
    out = rows.groupBy("drive_id", "island").agg(F.min("t").alias("start_ts"), F.max("t").alias("end_ts"), F.min("value").alias("least"), F.count(F.lit(1)).alias("n")).drop("island")
    return out.orderBy("least", "drive_id", "start_ts").limit(30)


@query(f"""WITH {EV}, s AS (SELECT drive_id, min(t) AS start_ts, max(t) AS end_ts, count(*) AS n FROM (SELECT *, sum(CASE WHEN nb THEN 1 ELSE 0 END) OVER (PARTITION BY drive_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS k
    FROM (SELECT *, coalesce(t - lag(t) OVER (PARTITION BY drive_id ORDER BY t) >= 86400, true) AS nb FROM ev)) GROUP BY drive_id, k) SELECT * FROM s""")
def session_window_by_track(spark, sf_dir):
    ev = events(spark, sf_dir).withColumn("ts", F.timestamp_micros(F.round(F.col("t") * 1e6).cast("bigint")))
    return ev.groupBy("drive_id", F.session_window("ts", "1 day")).agg(F.min("t").alias("start_ts"), F.max("t").alias("end_ts"), F.count(F.lit(1)).alias("n")).drop("session_window")


@query_in_chunks(f"""WITH {EV}, d AS (SELECT event_id, value, sqrt(avg(value * value) OVER (PARTITION BY drive_id ORDER BY t, event_id ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)) AS rms,
    count(*) OVER (PARTITION BY drive_id ORDER BY t, event_id ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS n FROM ev) SELECT event_id, round(rms, 6) AS rms FROM d WHERE n = 5""", CHUNK)
def sliding_rms_rows(spark, sf_dir, chunk=None):
    d = over_chunks(events(spark, sf_dir), in_time(chunk), lambda rows, w: rows.withColumn("rms", F.round(ops.sliding_rms(w, "value", 5), 6)), 0, 4)
    return d.select("event_id", "rms").filter("rms IS NOT NULL")


@query(f"""WITH {EV}, d AS (SELECT event_id, drive_id, row_number() {W} AS rn, sqrt(avg(value * value) OVER (PARTITION BY drive_id ORDER BY t, event_id ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING)) AS rms,
    count(*) OVER (PARTITION BY drive_id ORDER BY t, event_id ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS n, nth_value(t, 6) OVER (PARTITION BY drive_id ORDER BY t, event_id ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS centre FROM ev)
    SELECT event_id, centre, round(rms, 6) AS rms FROM d WHERE n = 10 AND (rn - 1) % 5 = 0""")
def sliding_rms_step(spark, sf_dir):
    d = events(spark, sf_dir).select("event_id", F.row_number().over(by_time()).alias("rn"), F.lead("t", 5).over(by_time()).alias("centre"), F.round(ops.sliding_rms(by_time(), "value", 10), 6).alias("rms"))
    return d.filter("rms IS NOT NULL AND (rn - 1) % 5 = 0").drop("rn")


@query(f"""WITH {EV}, d AS (SELECT event_id, row_number() {W} AS rn, avg(value) OVER f AS mean, max(value) OVER f - min(value) OVER f AS span, avg(CASE WHEN value >= 10 THEN 1.0 ELSE 0 END) OVER f AS share
    FROM ev WINDOW f AS (PARTITION BY drive_id ORDER BY t, event_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)) SELECT event_id, mean >= 40 AND share >= 0.8 AND span >= 50 AS flagged FROM d WHERE rn > 10""")
def trailing_window_flags(spark, sf_dir):
    f = by_time().rowsBetween(-10, -1)
    v = F.col("value")
    flagged = (F.avg(v).over(f) >= 40) & (F.avg(F.when(v >= 10, 1.0).otherwise(0.0)).over(f) >= 0.8) & (F.max(v).over(f) - F.min(v).over(f) >= 50)
    return events(spark, sf_dir).select("event_id", flagged.alias("flagged"), F.row_number().over(by_time()).alias("rn")).filter("rn > 10").drop("rn")


@query_in_chunks(f"""WITH {EV} SELECT event_id, round(sum(value) OVER (PARTITION BY drive_id ORDER BY t, event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) / 5, 6) AS smooth FROM ev""", CHUNK)
def moving_average(spark, sf_dir, chunk=None):
    d = over_chunks(events(spark, sf_dir), in_time(chunk), lambda rows, w: rows.withColumn("smooth", F.round(ops.moving_average(w, "value", 5), 6)), 2, 2)
    return d.select("event_id", "smooth")


@query_in_chunks(f"""WITH {EV}, c AS (SELECT *, CASE WHEN abs(value - 40) < 5 THEN 0 ELSE value - 40 END AS x FROM ev)
    SELECT event_id, CAST(coalesce(last_value(CASE WHEN x <> 0 THEN sign(x) END IGNORE NULLS) OVER (PARTITION BY drive_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING), 0) AS DOUBLE) AS sgn FROM c""", CHUNK)
def sign_ffill(spark, sf_dir, chunk=None):
    x = F.when(F.abs(F.col("value") - 40) < 5, 0.0).otherwise(F.col("value") - 40)
    s = in_time(chunk)
    sign = F.signum("x")
    d = carried_value(s.cut(events(spark, sf_dir).withColumn("x", x)), s, F.when(sign != 0, sign), "sgn")
    return d.select("event_id", F.coalesce("sgn", F.lit(0.0)).alias("sgn"))


@query(f"""WITH {EV}, c AS (SELECT *, value - 40 AS x FROM ev WHERE abs(value - 40) >= 10), d AS (SELECT drive_id, t, CASE WHEN sign(x) <> lag(sign(x)) {W} THEN 1 ELSE 0 END AS flip FROM c)
    SELECT drive_id, round(sum(flip) / (max(t) - min(t)) * 86400, 6) AS flips_per_day FROM d GROUP BY drive_id HAVING max(t) > min(t)""")
def sign_flip_rate(spark, sf_dir):
    c = events(spark, sf_dir).withColumn("x", F.col("value") - 40).filter("abs(x) >= 10")
    flips = c.select("drive_id", "t", F.when(F.signum("x") != F.lag(F.signum("x")).over(by_time()), 1).otherwise(0).alias("flip"))
    out = flips.groupBy("drive_id").agg(F.sum("flip").alias("n"), (F.max("t") - F.min("t")).alias("span")).filter("span > 0")
    return out.select("drive_id", F.round(F.col("n") / F.col("span") * DAY, 6).alias("flips_per_day"))


@query_in_chunks(f"""WITH {EV}, c AS (SELECT *, value - 40 AS x FROM ev), d AS (SELECT event_id, sign(x) <> lag(sign(x)) {W} AS flip,
    max(abs(x)) OVER (PARTITION BY drive_id ORDER BY t, event_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS pb, max(abs(x)) OVER (PARTITION BY drive_id ORDER BY t, event_id ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS pa FROM c)
    SELECT event_id, pb, pa FROM d WHERE flip AND pb >= 15 AND pa >= 15""", CHUNK)
def effective_crossings(spark, sf_dir, chunk=None):
    c = events(spark, sf_dir).withColumn("x", F.col("value") - 40)
    peak = lambda w, a, b: F.max(F.abs("x")).over(w.rowsBetween(a, b))
    d = over_chunks(c, in_time(chunk), lambda rows, w: rows.withColumns({"flip": F.signum("x") != F.lag(F.signum("x")).over(w), "pb": peak(w, -5, -1), "pa": peak(w, 0, 4)}), 5, 4)
    return d.filter("flip AND pb >= 15 AND pa >= 15").select("event_id", "pb", "pa")


@query_in_chunks(f"""WITH {EV}, j AS (SELECT *, coalesce(abs(value - lag(value) {W}) > 30, false) AS jump FROM ev)
    SELECT event_id, last_value(CASE WHEN NOT jump THEN value END IGNORE NULLS) OVER (PARTITION BY drive_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS repaired FROM j""", CHUNK)
def jump_repair(spark, sf_dir, chunk=None):
    s = in_time(chunk)
    jumps = over_chunks(events(spark, sf_dir), s, lambda rows, w: rows.withColumn("jump", F.coalesce(F.abs(ops.change(w, "value")) > 30.0, F.lit(False))), 1)
    return carried_value(s.cut(jumps), s, F.when(~F.col("jump"), F.col("value")), "repaired").select("event_id", "repaired")


@query(f"""WITH {EV}, d AS (SELECT event_id, drive_id, t, row_number() {W} AS rn, count(*) OVER (PARTITION BY drive_id) AS n, max(value) OVER f - min(value) OVER f AS span
    FROM ev WINDOW f AS (PARTITION BY drive_id ORDER BY t, event_id ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)) SELECT event_id, span FROM d WHERE rn <= n - 8 AND span > 80""")
def oscillation_windows(spark, sf_dir):
    f, v = by_time().rowsBetween(0, 7), F.col("value")
    d = events(spark, sf_dir).select("event_id", F.row_number().over(by_time()).alias("rn"), F.count(F.lit(1)).over(Window.partitionBy("drive_id")).alias("n"), (F.max(v).over(f) - F.min(v).over(f)).alias("span"))
    return d.filter("rn <= n - 8 AND span > 80").select("event_id", "span")


@query(f"""WITH {EV}, a AS (SELECT drive_id, list(value ORDER BY t, event_id) AS vs FROM ev GROUP BY drive_id)
    SELECT drive_id, round(list_reduce(vs, lambda a, x: a * 0.7 + x * 0.3), 6) AS ema FROM a""")
def ema(spark, sf_dir):
    series = events(spark, sf_dir).groupBy("drive_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("t", "event_id", "value"))), lambda s: s["value"]).alias("vs"))
    return series.select("drive_id", F.round(ops.exponential_average(F.col("vs"), 0.3), 6).alias("ema"))


_MODE = f"""b AS (SELECT *, coalesce(is_auto <> lag(is_auto) {W} OR t - lag(t) {W} > 86400, true) AS brk, lead(is_auto) {W} AS next_auto, lead(t) {W} AS next_t FROM ev), {_ISLANDS},
    r AS (SELECT drive_id, island, is_auto, min(t) AS start_ts, max(t) AS end_ts, arg_max(next_auto, (t, event_id)) AS next_auto, arg_max(next_t, (t, event_id)) AS next_t FROM i GROUP BY drive_id, island, is_auto),
    e AS (SELECT drive_id, next_t AS "at", end_ts - start_ts AS prior, end_ts - start_ts >= 3600 AS valid FROM r WHERE is_auto AND NOT next_auto AND next_t - end_ts <= 86400)"""


def _takeovers(spark, sf_dir, chunk=None):
    from ..plans.takeover import edges

    return edges(events(spark, sf_dir), max_gap=DAY, min_prior=HOUR, order=("t", "event_id"), chunk=chunk)


@query_in_chunks(f'WITH {EV}, {_MODE} SELECT drive_id, "at", prior, valid FROM e', CHUNK)
def takeover_edges(spark, sf_dir, chunk=None):
    return _takeovers(spark, sf_dir, chunk).select("drive_id", "at", "prior", "valid")


@query(f"""WITH {EV}, {_MODE}, v AS (SELECT drive_id, "at" - lag("at") OVER (PARTITION BY drive_id ORDER BY "at") AS d FROM e WHERE valid) SELECT drive_id, round(avg(d), 6) AS mean_interval FROM v WHERE d <= 864000 GROUP BY drive_id""")
def takeover_interval(spark, sf_dir):
    step = F.col("at") - F.lag("at").over(Window.partitionBy("drive_id").orderBy("at"))
    return _takeovers(spark, sf_dir).filter("valid").withColumn("d", step).filter(f"d <= {10 * DAY}").groupBy("drive_id").agg(F.round(F.avg("d"), 6).alias("mean_interval"))


@query_in_chunks(f"""WITH {EV}, d AS (SELECT drive_id, t - lag(t) {W} AS dt, lag(is_auto) {W} AS was FROM ev) SELECT drive_id, round(sum(dt), 6) AS auto_s FROM d WHERE was AND dt > 0 AND dt <= 86400 GROUP BY drive_id""", CHUNK)
def auto_time_prev_state(spark, sf_dir, chunk=None):
    d = over_chunks(events(spark, sf_dir), in_time(chunk), lambda rows, w: rows.withColumns({"dt": ops.gap(w), "was": F.lag("is_auto").over(w)}), 1)
    return d.filter(f"was AND dt > 0 AND dt <= {DAY}").groupBy("drive_id").agg(F.round(F.sum("dt"), 6).alias("auto_s"))


_HAV = """2 * 6371000.0 * atan2(sqrt(a), sqrt(1 - a))"""
_STEPS = f"""p AS (SELECT *, t - lag(t) {W} AS dt, lag(lat) {W} AS plat, lag(lon) {W} AS plon FROM ev),
    h AS (SELECT *, pow(sin(radians(lat - plat) / 2), 2) + cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lon - plon) / 2), 2) AS a FROM p), st AS (SELECT *, {_HAV} AS d FROM h)"""


@query_in_chunks(f"""WITH {EV}, {_STEPS} SELECT is_auto, round(sum(d) / 1000, 4) AS km, round(sum(dt), 4) AS seconds, count(*) AS steps FROM st WHERE dt > 0 AND dt <= 86400 AND d / dt * 3.6 <= 200 GROUP BY is_auto""", CHUNK)
def mileage_by_state(spark, sf_dir, chunk=None):
    from ..plans.mileage import steps

    s = steps(events(spark, sf_dir), max_dt=DAY, order=("t", "event_id"), chunk=chunk).filter("valid")
    return s.groupBy("is_auto").agg(F.round(F.sum("d") / 1000, 4).alias("km"), F.round(F.sum("dt"), 4).alias("seconds"), F.count(F.lit(1)).alias("steps"))


@query_in_chunks(f"""WITH {EV}, s AS (SELECT *, is_auto AND value > 50 AS fast FROM ev), b AS (SELECT *, lag(fast) {W} IS DISTINCT FROM fast AS brk FROM s), {_ISLANDS}
    SELECT drive_id, min(t) AS start_ts, max(t) AS end_ts, count(*) AS frame_count, max(value / 50) AS ratio FROM i WHERE fast GROUP BY drive_id, island HAVING max(t) - min(t) >= 1""", CHUNK)
def speeding_runs(spark, sf_dir, chunk=None):
    rows = runs(events(spark, sf_dir), ["drive_id"], ["t", "event_id"], F.col("is_auto") & (F.col("value") > 50), chunk=chunk)
    out = rows.groupBy("drive_id", "island").agg(F.min("t").alias("start_ts"), F.max("t").alias("end_ts"), F.count(F.lit(1)).alias("frame_count"), F.max(F.col("value") / 50).alias("ratio"))
    return out.filter("end_ts - start_ts >= 1").drop("island")


@query_in_chunks(f"""WITH {EV}, j AS (SELECT *, CASE WHEN topic IN ('view', 'click') THEN topic END AS junction FROM ev), b AS (SELECT *, lag(junction) {W} IS DISTINCT FROM junction OR lag(t) {W} IS NULL AS brk, lead(t) {W} AS next_t FROM j), {_ISLANDS}
    SELECT drive_id, junction, min(t) AS enter_ts, max(next_t) AS exit_ts, arg_max(value, (t, event_id)) AS last_value FROM i WHERE junction IS NOT NULL GROUP BY drive_id, junction, island""", CHUNK)
def junction_intervals(spark, sf_dir, chunk=None):
    from ..plans.scene import occupancy

    ev = events(spark, sf_dir).withColumn("junction", F.when(F.col("topic").isin("view", "click"), F.col("topic")))
    return occupancy(ev, "junction", ("t", "event_id"), F.max_by("value", F.struct("t", "event_id")).alias("last_value"), chunk=chunk).select("drive_id", "junction", "enter_ts", "exit_ts", "last_value")


@query("""WITH o AS (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) SELECT o_orderkey, o_totalprice FROM o WHERE (rn - 1) % 100 = 0""")
def systematic_sample(spark, sf_dir):
    from ..operators.sampling import every_nth

    return every_nth(table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"], 100, F.to_date("o_orderdate")).select("o_orderkey", "o_totalprice")
