"""As-of joins, interpolation, interval and band joins, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.asof import Right, align, interpolate, neighbours
from ..operators.intervals import locate, meet
from .base import EV, events, query, query_in_chunks, table

DAY = 86_400.0


def _topic(ev, name):
    return ev.filter(F.col("topic") == name).select("drive_id", "t", "event_id", "value")


def _nearest_sql(tolerance: float | None, tie: str) -> str:
    within = f"AND abs(r.t - b.t) <= {tolerance}" if tolerance else ""
    order = "r.t < b.t DESC" if tie == "earlier" else "r.t < b.t"
    return f"""WITH {EV}, c AS (
        SELECT b.event_id, b.drive_id, b.t, r.event_id AS near_id, r.value AS near_value,
               row_number() OVER (PARTITION BY b.event_id ORDER BY abs(r.t - b.t), {order}, CASE WHEN r.t < b.t THEN -r.event_id ELSE r.event_id END) AS k
        FROM ev b LEFT JOIN ev r ON b.drive_id = r.drive_id AND r.topic = 'click' {within} WHERE b.topic = 'view')
        SELECT event_id, near_id, near_value FROM c WHERE k = 1"""


@query(_nearest_sql(DAY, "earlier"))
def asof_nearest_tol(spark, sf_dir):
    ev = events(spark, sf_dir)
    out = align(_topic(ev, "view"), [Right(_topic(ev, "click"), "near", DAY)])
    return out.select("event_id", F.col("near.event_id").alias("near_id"), F.col("near.value").alias("near_value"))


@query(_nearest_sql(DAY, "earlier"))
def asof_nearest_chunked(spark, sf_dir):
    ev = events(spark, sf_dir)
    out = align(_topic(ev, "view"), [Right(_topic(ev, "click"), "near", DAY)], chunk=5 * DAY)
    return out.select("event_id", F.col("near.event_id").alias("near_id"), F.col("near.value").alias("near_value"))


@query_in_chunks(_nearest_sql(None, "later"), DAY, 3600.0)
def asof_nearest_unbounded_tie_later(spark, sf_dir, chunk=None):
    """In chunks of an hour most chunks hold no row of either side, so what is carried comes from many chunks away."""
    ev = events(spark, sf_dir)
    out = align(_topic(ev, "view"), [Right(_topic(ev, "click"), "near", None, "later")], chunk=chunk)
    return out.select("event_id", F.col("near.event_id").alias("near_id"), F.col("near.value").alias("near_value"))


@query(f"""WITH {EV} SELECT b.event_id, r.event_id AS prev_id, r.value AS prev_value
    FROM (SELECT * FROM ev WHERE topic = 'view') b ASOF LEFT JOIN (SELECT * FROM ev WHERE topic = 'purchase') r ON b.drive_id = r.drive_id AND b.t > r.t""")
def asof_prev(spark, sf_dir):
    ev = events(spark, sf_dir)
    out = neighbours(_topic(ev, "view"), _topic(ev, "purchase"))
    return out.select("event_id", F.col("prev.event_id").alias("prev_id"), F.col("prev.value").alias("prev_value"))


def _synced(spark, sf_dir):
    ev = events(spark, sf_dir)
    return align(_topic(ev, "view"), [Right(_topic(ev, "click"), "loc", DAY), Right(_topic(ev, "purchase"), "chassis", DAY), Right(_topic(ev, "signup"), "control", DAY)])


_SYNC = f"WITH {EV}, " + ", ".join(
    f"""{n} AS (SELECT event_id, rid FROM (SELECT b.event_id, r.event_id AS rid, row_number() OVER (PARTITION BY b.event_id ORDER BY abs(r.t - b.t), r.t) AS k
        FROM ev b JOIN ev r ON b.drive_id = r.drive_id AND r.topic = '{topic}' AND abs(r.t - b.t) <= {DAY} WHERE b.topic = 'view') WHERE k = 1)"""
    for n, topic in (("loc", "click"), ("cha", "purchase"), ("con", "signup"))
) + """, frames AS (SELECT b.event_id, loc.rid AS loc_id, cha.rid AS chassis_id, con.rid AS control_id
    FROM (SELECT * FROM ev WHERE topic = 'view') b LEFT JOIN loc USING (event_id) LEFT JOIN cha USING (event_id) LEFT JOIN con USING (event_id))"""


@query(_SYNC + " SELECT * FROM frames")
def asof_three_topics(spark, sf_dir):
    return _synced(spark, sf_dir).select("event_id", *[F.col(f"{n}.event_id").alias(f"{n}_id") for n in ("loc", "chassis", "control")])


@query(_SYNC + """ SELECT count(*) AS frames, round(avg(CASE WHEN loc_id IS NOT NULL THEN 100.0 ELSE 0 END), 6) AS loc_pct, round(avg(CASE WHEN chassis_id IS NOT NULL THEN 100.0 ELSE 0 END), 6) AS chassis_pct,
    round(avg(CASE WHEN control_id IS NOT NULL THEN 100.0 ELSE 0 END), 6) AS control_pct, avg(CASE WHEN loc_id IS NOT NULL THEN 100.0 ELSE 0 END) < 80 AS loc_flagged FROM frames""")
def sync_coverage(spark, sf_dir):
    pct = lambda n: F.avg(F.when(F.col(n).isNotNull(), 100.0).otherwise(0.0))
    return _synced(spark, sf_dir).agg(F.count(F.lit(1)).alias("frames"), *[F.round(pct(n), 6).alias(f"{n}_pct") for n in ("loc", "chassis", "control")], (pct("loc") < 80).alias("loc_flagged"))


@query_in_chunks(f"""WITH {EV}, b AS (SELECT * FROM ev WHERE topic = 'view'), r AS (SELECT * FROM ev WHERE topic = 'click'),
    p AS (SELECT b.event_id, b.drive_id, b.t, r.t AS pt, r.value AS pv FROM b ASOF LEFT JOIN r ON b.drive_id = r.drive_id AND b.t > r.t),
    n AS (SELECT p.*, r.t AS nt, r.value AS nv FROM p ASOF LEFT JOIN r ON p.drive_id = r.drive_id AND p.t <= r.t)
    SELECT event_id, CASE WHEN pt IS NULL THEN nv WHEN nt IS NULL THEN pv WHEN nt = t THEN nv ELSE pv + (nv - pv) * ((t - pt) / (nt - pt)) END AS value_at FROM n""", DAY)
def interp_linear(spark, sf_dir, chunk=None):
    ev = events(spark, sf_dir)
    return interpolate(_topic(ev, "view"), _topic(ev, "click"), "value", "value_at", chunk=chunk).select("event_id", "value_at")


def _intervals(ev):
    """The recordings (bags) of a drive: what its click events span within five days."""
    piece = F.floor(F.col("t") / (5 * DAY))
    spans = ev.filter("topic = 'click'").groupBy("drive_id", piece.alias("piece")).agg(F.min("t").alias("start_ts"), F.max("t").alias("end_ts"))
    return spans.select("drive_id", F.concat_ws("-", "drive_id", "piece").alias("name"), "start_ts", "end_ts")


_IV = f"""iv AS (SELECT drive_id, drive_id || '-' || CAST(floor(t / {5 * DAY}) AS BIGINT) AS name, min(t) AS start_ts, max(t) AS end_ts
    FROM ev WHERE topic = 'click' GROUP BY drive_id, floor(t / {5 * DAY}))"""


def _contained(spark, sf_dir):
    ev = events(spark, sf_dir)
    at = ev.filter("topic = 'error'").select("event_id", "drive_id", "t")
    return locate(at, _intervals(ev), DAY)


@query(f"""WITH {EV}, {_IV} SELECT e.event_id, arg_min(name, start_ts) AS inside FROM (SELECT * FROM ev WHERE topic = 'error') e
    LEFT JOIN iv ON e.drive_id = iv.drive_id AND e.t BETWEEN start_ts AND end_ts GROUP BY e.event_id""")
def interval_contain(spark, sf_dir):
    return _contained(spark, sf_dir).select("event_id", "inside")


@query(f"""WITH {EV}, {_IV}, c AS (SELECT e.event_id, name, row_number() OVER (PARTITION BY e.event_id ORDER BY CASE WHEN e.t BETWEEN start_ts AND end_ts THEN 0 ELSE 1 END,
    CASE WHEN e.t BETWEEN start_ts AND end_ts THEN 0 ELSE least(abs(e.t - start_ts), abs(e.t - end_ts)) END, start_ts, name) AS k
    FROM (SELECT * FROM ev WHERE topic = 'error') e LEFT JOIN iv ON e.drive_id = iv.drive_id) SELECT event_id, name AS bag FROM c WHERE k = 1""")
def interval_nearest_fallback(spark, sf_dir):
    return _contained(spark, sf_dir).select("event_id", F.coalesce("inside", "nearest").alias("bag"))


#: Intervals from a minute to the whole month of a drive.
_UNEVEN = f"""{_IV}, un AS (SELECT drive_id, name, start_ts, end_ts FROM iv UNION ALL SELECT drive_id, 'all-' || drive_id, min(t), max(t) FROM ev GROUP BY drive_id
    UNION ALL SELECT drive_id, 'minute-' || event_id, t, t + 60 FROM ev WHERE topic = 'purchase' UNION ALL SELECT drive_id, 'day-' || event_id, t - {DAY}, t + {DAY} FROM ev WHERE topic = 'signup')"""


def _uneven(ev):
    around = lambda topic, name, before, after: ev.filter(F.col("topic") == topic).select("drive_id", F.concat(F.lit(name), "event_id").alias("name"), (F.col("t") - before).alias("start_ts"), (F.col("t") + after).alias("end_ts"))
    whole = ev.groupBy("drive_id").agg(F.concat(F.lit("all-"), F.first("drive_id")).alias("name"), F.min("t").alias("start_ts"), F.max("t").alias("end_ts"))
    return _intervals(ev).unionByName(whole).unionByName(around("purchase", "minute-", 0, 60)).unionByName(around("signup", "day-", DAY, DAY))


@query(f"""WITH {EV}, {_UNEVEN} SELECT e.event_id, count(name) AS held, min(name) AS least, max(end_ts - start_ts) AS longest FROM (SELECT * FROM ev WHERE topic = 'error') e
    LEFT JOIN un ON e.drive_id = un.drive_id AND e.t BETWEEN start_ts AND end_ts GROUP BY e.event_id""")
def interval_contain_uneven(spark, sf_dir):
    """All intervals that hold a point, where some last a minute and some a month."""
    ev = events(spark, sf_dir)
    at = ev.filter("topic = 'error'").select("event_id", "drive_id", "t")
    held = meet(at, _uneven(ev), 60.0).groupBy("event_id").agg(F.count(F.lit(1)).alias("held"), F.min("name").alias("least"), F.max(F.col("end_ts") - F.col("start_ts")).alias("longest"))
    return at.select("event_id").join(held, "event_id", "left").fillna(0, ["held"])


@query(f"""WITH {EV}, {_UNEVEN}, c AS (SELECT e.event_id, name, row_number() OVER (PARTITION BY e.event_id ORDER BY CASE WHEN e.t BETWEEN start_ts AND end_ts THEN 0 ELSE 1 END,
    CASE WHEN e.t BETWEEN start_ts AND end_ts THEN 0 ELSE least(abs(e.t - start_ts), abs(e.t - end_ts)) END, start_ts, name) AS k
    FROM (SELECT * FROM ev WHERE topic = 'error') e LEFT JOIN (SELECT * FROM un WHERE name NOT LIKE 'all-%') un ON e.drive_id = un.drive_id) SELECT event_id, name AS bag FROM c WHERE k = 1""")
def interval_nearest_uneven(spark, sf_dir):
    """The first interval that holds a point, else the nearest, in chunks of a day."""
    ev = events(spark, sf_dir)
    at = ev.filter("topic = 'error'").select("event_id", "drive_id", "t")
    found = locate(at, _uneven(ev).filter("name NOT LIKE 'all-%'"), 60.0, chunk=DAY)
    return found.select("event_id", F.coalesce("inside", "nearest").alias("bag"))


def _band(spark, sf_dir, how):
    ev = events(spark, sf_dir)
    iv = _intervals(ev)
    bad = ev.filter((F.col("topic") == "error") & (F.col("value") > 60)).select("drive_id", F.col("t").alias("bad_t"))
    reach = iv.select("drive_id", "name", (F.col("start_ts") - 600).alias("from_t"), (F.col("end_ts") + 600).alias("to_t"))
    hit = meet(bad, reach, 600.0, "bad_t", start="from_t", end="to_t").select("name").distinct()
    return iv.select("name", "start_ts").join(hit, "name", how)


_EXISTS = "EXISTS (SELECT 1 FROM ev e WHERE e.drive_id = iv.drive_id AND topic = 'error' AND value > 60 AND e.t BETWEEN iv.start_ts - 600 AND iv.end_ts + 600)"


@query(f"WITH {EV}, {_IV} SELECT name, start_ts FROM iv WHERE {_EXISTS}")
def band_theta_semi(spark, sf_dir):
    return _band(spark, sf_dir, "left_semi")


@query(f"WITH {EV}, {_IV} SELECT name, start_ts FROM iv WHERE NOT {_EXISTS}")
def band_theta_anti(spark, sf_dir):
    return _band(spark, sf_dir, "left_anti")


@query(f"""WITH {EV}, km AS (SELECT drive_id, count(*) AS n_auto FROM ev WHERE is_auto GROUP BY drive_id)
    SELECT e.event_id, e.value, coalesce(km.n_auto, 0) AS n_auto FROM ev e LEFT JOIN km USING (drive_id) WHERE topic = 'purchase'""")
def topic_equi_join(spark, sf_dir):
    ev = events(spark, sf_dir)
    km = ev.filter("is_auto").groupBy("drive_id").agg(F.count(F.lit(1)).alias("n_auto"))
    return ev.filter("topic = 'purchase'").join(km, "drive_id", "left").select("event_id", "value", F.coalesce("n_auto", F.lit(0)).alias("n_auto"))


@query("""SELECT c_custkey, coalesce(n_name, 'UNKNOWN') AS lane FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 4) n ON c_nationkey = n_nationkey""")
def map_lookup(spark, sf_dir):
    lanes = table(spark, sf_dir, "nation").filter("n_regionkey < 4").agg(F.map_from_entries(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("lanes"))
    joined = table(spark, sf_dir, "customer").crossJoin(F.broadcast(lanes))
    return joined.select("c_custkey", F.coalesce(F.try_element_at("lanes", F.col("c_nationkey")), F.lit("UNKNOWN")).alias("lane"))


@query(f"""WITH {EV} SELECT drive_id, t, arg_max(value, event_id) AS value FROM ev GROUP BY drive_id, t""")
def union_last_writer(spark, sf_dir):
    return events(spark, sf_dir).groupBy("drive_id", "t").agg(F.max_by("value", "event_id").alias("value"))
