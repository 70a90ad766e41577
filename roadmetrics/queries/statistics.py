"""Aggregates, percentiles, ratios, histograms, top-k, merging of partial results."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import bands
from ..operators import sampling, stats
from .base import EV, OB, events, obstacles, query, query_in_chunks, table


@query(f"""WITH {EV} SELECT topic, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, min(value) AS min_value, max(value) AS max_value, round(median(value), 6) AS median,
    round(avg(abs(value)), 6) AS abs_mean, round(sqrt(avg(value * value)), 6) AS rms, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99 FROM ev GROUP BY topic""")
def stats_bundle(spark, sf_dir):
    parts = stats.bundle(F.col("value"))
    exact = {"min_value", "max_value"}
    return events(spark, sf_dir).groupBy("topic").agg(*[c if k in exact else F.round(c, 6).alias(k) for k, c in parts.items()])


@query(f"""WITH {EV} SELECT drive_id, {", ".join(f"round(quantile_cont(value, {p / 100}), 6) AS p{p}" for p in (5, 10, 25, 50, 95, 99))} FROM ev GROUP BY drive_id""")
def percentiles(spark, sf_dir):
    return events(spark, sf_dir).groupBy("drive_id").agg(*[F.round(F.percentile("value", F.lit(p / 100)), 6).alias(f"p{p}") for p in (5, 10, 25, 50, 95, 99)])


@query(f"""WITH {EV} SELECT drive_id, {", ".join(f"round(avg(CASE WHEN value > {x} THEN 100.0 ELSE 0 END), 6) AS over_{x}, count(*) FILTER (value > {x}) AS n_{x}" for x in (10, 20, 30))} FROM ev GROUP BY drive_id""")
def rate_exceed(spark, sf_dir):
    over = lambda x: [F.round(stats.rate(F.col("value") > x), 6).alias(f"over_{x}"), F.count_if(F.col("value") > x).alias(f"n_{x}")]
    return events(spark, sf_dir).groupBy("drive_id").agg(*[c for x in (10, 20, 30) for c in over(x)])


_BINS = "CASE WHEN value < 10 THEN 0 WHEN value < 20 THEN 1 WHEN value < 30 THEN 2 WHEN value < 40 THEN 3 WHEN value < 50 THEN 4 WHEN value < 60 THEN 5 WHEN value < 70 THEN 6 ELSE 7 END"


@query(f"""WITH {EV} SELECT {_BINS} AS bin, count(*) AS n, round(sqrt(avg(value * value)), 6) AS rms, round(quantile_cont(value, 0.95), 6) AS p95 FROM ev GROUP BY 1""")
def speed_bin_stats(spark, sf_dir):
    v = F.col("value")
    speed_bin = bands.by_ceiling(v, [(10.0 * (i + 1), i) for i in range(7)], 7).cast("int")
    return events(spark, sf_dir).groupBy(speed_bin.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sqrt(F.avg(v * v)), 6).alias("rms"), F.round(F.percentile(v, F.lit(0.95)), 6).alias("p95"))


@query(f"""WITH {EV} SELECT drive_id, topic, CASE WHEN count(*) >= 20 THEN round(quantile_cont(value, 0.05), 6) ELSE min(value) END AS low FROM ev GROUP BY drive_id, topic""")
def group_p5_small_n(spark, sf_dir):
    v = F.col("value")
    low = F.when(F.count(v) >= 20, F.round(stats.low_percentile(v), 6)).otherwise(F.min(v))
    return events(spark, sf_dir).groupBy("drive_id", "topic").agg(low.alias("low"))


@query(f"""WITH {EV}, c AS (SELECT drive_id, topic, count(*) AS n, min(t) AS first_t FROM ev GROUP BY drive_id, topic), r AS (SELECT *, row_number() OVER (PARTITION BY drive_id ORDER BY n DESC, first_t) AS k FROM c)
    SELECT drive_id, topic AS mode, n FROM r WHERE k = 1""")
def mode_per_group(spark, sf_dir):
    c = events(spark, sf_dir).groupBy("drive_id", "topic").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("first_t"))
    return c.groupBy("drive_id").agg(F.max_by("topic", F.struct("n", -F.col("first_t"))).alias("mode"), F.max("n").alias("n"))


@query(f"""WITH {EV}, r AS (SELECT *, row_number() OVER (PARTITION BY drive_id ORDER BY value, t) AS lo, row_number() OVER (PARTITION BY drive_id ORDER BY value DESC, t) AS hi FROM ev)
    SELECT drive_id, max(CASE WHEN lo = 1 THEN event_id END) AS least_event, max(CASE WHEN hi = 1 THEN event_id END) AS peak_event FROM r GROUP BY drive_id""")
def argmin_row(spark, sf_dir):
    return events(spark, sf_dir).groupBy("drive_id").agg(F.min_by("event_id", F.struct("value", "t")).alias("least_event"), F.max_by("event_id", F.struct("value", -F.col("t"))).alias("peak_event"))


@query("""WITH e AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
    SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin, count(*) AS n FROM lineitem, e GROUP BY 1""")
def histogram50(spark, sf_dir):
    return stats.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 50)


@query(f"""WITH {EV}, b AS (SELECT CAST(floor(value / 10) AS BIGINT) AS bin, count(*) AS n FROM ev GROUP BY 1)
    SELECT bin, n, round(sum(n) OVER (ORDER BY bin) / CAST(sum(n) OVER () AS DOUBLE), 9) AS cdf FROM b""")
def cdf(spark, sf_dir):
    b = events(spark, sf_dir).groupBy(F.floor(F.col("value") / 10).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return b.select("bin", "n", F.round(F.sum("n").over(Window.orderBy("bin")) / F.sum("n").over(whole), 9).alias("cdf"))


@query("""SELECT coalesce(o_orderpriority, 'total') AS turn, count(*) AS total, count(*) FILTER (o_orderstatus <> 'F') AS passed, count(*) FILTER (o_orderstatus = 'F') AS failed,
    round(count(*) FILTER (o_orderstatus <> 'F') * 100.0 / count(*), 6) AS rate FROM orders GROUP BY GROUPING SETS ((), (o_orderpriority))""")
def rollup_pass_rate(spark, sf_dir):
    ok = F.col("o_orderstatus") != "F"
    out = table(spark, sf_dir, "orders").rollup("o_orderpriority").agg(F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("passed"), F.count_if(~ok).alias("failed"), F.round(stats.rate(ok), 6).alias("rate"))
    return out.withColumn("turn", F.coalesce("o_orderpriority", F.lit("total"))).drop("o_orderpriority")


_WAYS = ["sum", "average", "weighted_avg", "max", "min", "last", "custom"]


@query(f"""WITH {EV}, r AS (SELECT w.s AS strategy, 'drive' || (drive_id % 10) AS metric, value, CAST(event_id AS DOUBLE) AS weight, event_id AS ord FROM ev, (SELECT unnest({_WAYS}) AS s) w)
    SELECT metric, strategy, count(*) AS n, round(CASE strategy WHEN 'sum' THEN sum(value) WHEN 'custom' THEN sum(value) WHEN 'average' THEN avg(value) WHEN 'weighted_avg' THEN sum(value * weight) / sum(weight)
    WHEN 'max' THEN max(value) WHEN 'min' THEN min(value) ELSE arg_max(value, ord) END, 4) AS value FROM r GROUP BY metric, strategy""")
def merge_strategies(spark, sf_dir):
    ways = F.explode(F.array(*map(F.lit, _WAYS)))
    r = events(spark, sf_dir).select(ways.alias("strategy"), F.concat(F.lit("drive"), F.col("drive_id") % 10).alias("metric"), "value", F.col("event_id").cast("double").alias("weight"), F.col("event_id").alias("ord"))
    return stats.merge_results(r)


@query(f"""WITH {EV}, k AS (SELECT drive_id, count(*) FILTER (topic = 'error' AND value > 40) AS events, count(*) FILTER (is_auto) * 0.5 AS km FROM ev GROUP BY drive_id)
    SELECT drive_id, events, CAST(km AS DOUBLE) AS km, round(CASE WHEN km > 0 THEN events * 100.0 / km ELSE 0 END, 6) AS per_100, CASE WHEN events = 0 THEN NULL ELSE round(km / events, 6) END AS km_per_event, CASE WHEN events = 0 THEN 'inf' END AS text FROM k""")
def ratio_per_100(spark, sf_dir):
    k = events(spark, sf_dir).groupBy("drive_id").agg(F.count_if((F.col("topic") == "error") & (F.col("value") > 40)).alias("events"), (F.count_if("is_auto") * F.lit(0.5)).alias("km"))
    value, text = stats.km_per_event(F.col("events"), F.col("km"))
    return k.select("drive_id", "events", "km", F.round(stats.per_100(F.col("events"), F.col("km")), 6).alias("per_100"), F.round(value, 6).alias("km_per_event"), text.alias("text"))


@query(f"""WITH {EV}, d AS (SELECT *, row_number() OVER (PARTITION BY drive_id, floor(t / 86400) ORDER BY t) AS k FROM ev) SELECT event_id, t FROM d WHERE k = 1""")
def decimate_bucket(spark, sf_dir):
    return sampling.decimate(events(spark, sf_dir), ["drive_id"], "t", 86_400.0).select("event_id", "t")


@query_in_chunks(f"""WITH RECURSIVE {EV}, n AS (SELECT *, row_number() OVER (PARTITION BY drive_id ORDER BY t) AS rn FROM ev),
    g AS (SELECT drive_id, rn, event_id, t AS kept, true AS keep FROM n WHERE rn = 1 UNION ALL
          SELECT n.drive_id, n.rn, n.event_id, CASE WHEN n.t - g.kept >= 86400 THEN n.t ELSE g.kept END, n.t - g.kept >= 86400 FROM g JOIN n ON n.drive_id = g.drive_id AND n.rn = g.rn + 1)
    SELECT event_id FROM g WHERE keep""", 200_000.0, 7 * 86_400.0)
def decimate_greedy(spark, sf_dir, chunk=None):
    return sampling.decimate_greedy(events(spark, sf_dir).select("event_id", "drive_id", "t"), "drive_id", "t", 86_400.0, ("event_id",), chunk).select("event_id")


@query(f"""WITH {EV}, r AS (SELECT *, row_number() OVER (PARTITION BY drive_id ORDER BY t, event_id) AS k FROM ev WHERE value > 30) SELECT event_id, drive_id, k FROM r WHERE k <= 20""")
def top_n_per_group(spark, sf_dir):
    w = Window.partitionBy("drive_id").orderBy("t", "event_id")
    rows = sampling.first_per_group(events(spark, sf_dir).filter("value > 30"), ["drive_id"], ["t", "event_id"], 20)
    return rows.select("event_id", "drive_id", F.row_number().over(w).alias("k"))


@query(f"""WITH {EV}, d AS (SELECT event_id, value - lag(value) OVER (PARTITION BY drive_id ORDER BY t, event_id) AS rate FROM ev) SELECT event_id, rate FROM d WHERE rate IS NOT NULL ORDER BY abs(rate) DESC, event_id LIMIT 50""")
def top50_abs_rate(spark, sf_dir):
    d = events(spark, sf_dir).select("event_id", (F.col("value") - F.lag("value").over(Window.partitionBy("drive_id").orderBy("t", "event_id"))).alias("rate"))
    return d.filter("rate IS NOT NULL").orderBy(F.abs("rate").desc(), "event_id").limit(50)


@query(f"""WITH {EV} SELECT event_id, CASE WHEN value < 20 THEN 3.5 WHEN value >= 20 AND value < 40 THEN 3.0 WHEN value >= 40 AND value < 60 THEN 2.5 ELSE 2.0 END AS lo_hi,
    CASE WHEN value >= 70 THEN 60.0 WHEN value >= 40 THEN 120.0 WHEN value >= 10 THEN 180.0 ELSE 200.0 END AS by_floor, CASE WHEN value > 80 THEN 150.0 WHEN value > 30 THEN 250.0 ELSE 600.0 END AS by_floor_strict,
    CASE WHEN value < 30 THEN 20.0 WHEN value < 60 THEN 15.0 ELSE 10.0 END AS by_ceiling FROM ev""")
def threshold_case_bands(spark, sf_dir):
    v = F.col("value")
    return events(spark, sf_dir).select(
        "event_id", bands.by_band(v, [(-1e9, 20, 3.5), (20, 40, 3.0), (40, 60, 2.5)], 2.0).alias("lo_hi"), bands.by_floor(v, {10: 180, 40: 120, 70: 60}, 200).alias("by_floor"),
        bands.by_floor(v, {30: 250, 80: 150}, 600, strict=True).alias("by_floor_strict"), bands.by_ceiling(v, [(30, 20.0), (60, 15.0)], 10.0).alias("by_ceiling"),
    )


@query(f"""WITH {EV}, l AS (SELECT event_id, CAST(event_id % 9 AS INTEGER) AS status, value / 50 AS e, value / 80 AS n FROM ev)
    SELECT CASE WHEN status = 2 THEN 'waiting' WHEN status NOT IN (3, 7) THEN 'unknown' WHEN greatest(e, n) > 1.0 THEN 'drift' WHEN greatest(e, n) > 0.2 THEN 'possible' ELSE 'normal' END AS class, count(*) AS n FROM l GROUP BY 1""")
def status_class(spark, sf_dir):
    status = bands.localization_class((F.col("event_id") % 9).cast("int"), F.col("value") / 50, F.col("value") / 80)
    return events(spark, sf_dir).groupBy(status.alias("class")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {EV}, d AS (SELECT event_id, value - lag(value) OVER (PARTITION BY drive_id ORDER BY t, event_id) AS x FROM ev) SELECT event_id, least(greatest(x, -50.0), 50.0) AS clipped, abs(x) > 50 AS outlier,
    CASE WHEN abs(x) <= 15 THEN x END AS physical FROM d WHERE x IS NOT NULL""")
def clip_outliers(spark, sf_dir):
    d = events(spark, sf_dir).select("event_id", (F.col("value") - F.lag("value").over(Window.partitionBy("drive_id").orderBy("t", "event_id"))).alias("x")).filter("x IS NOT NULL")
    return d.select("event_id", F.least(F.greatest("x", F.lit(-50.0)), F.lit(50.0)).alias("clipped"), (F.abs("x") > 50).alias("outlier"), F.when(F.abs("x") <= 15, F.col("x")).alias("physical"))


@query(f"""WITH {OB} SELECT kind, motion, count(*) AS n FROM ob GROUP BY kind, motion""")
def category_counts(spark, sf_dir):
    return obstacles(spark, sf_dir).groupBy("kind", "motion").agg(F.count(F.lit(1)).alias("n"))
