"""The metric programs on telemetry that is derived from the driver's tables by fixed rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as limits
from .. import plans
from ..config import Config
from ..operators.islands import merge_events  # noqa: F401  (part of the public surface of the queries)
from ..plans.base import Telemetry
from .base import EV, SQL_BY_TIME, query, query_in_chunks, table
from .geometry import utm_steps

#: Rows of orders and lineitem become 10 Hz and 50 Hz samples: a drive is 500 consecutive samples.
PER_DRIVE = 500


def _sample(df: DataFrame, key: str, rate: float) -> DataFrame:
    """drive_id and t of a sample from its whole-number key."""
    k = F.col(key) - 1
    return df.withColumns({"drive_id": F.concat(F.lit("d"), F.floor(k / PER_DRIVE).cast("string")), "t": 1_700_000_000.0 + (k % PER_DRIVE) / rate})


def telemetry(spark, sf_dir, config: Config = Config()) -> Telemetry:
    o = _sample(table(spark, sf_dir, "orders"), "o_orderkey", 10.0)
    price, phase = F.col("o_totalprice"), F.col("t") - 1_700_000_000.0
    wave = lambda period: F.sin(2 * 3.141592653589793 * phase / period)
    noise: Column = ((F.col("o_orderkey") * 7919) % 2000 - 1000) / 1000.0
    base = o.select("drive_id", "t", F.lit("bag").alias("bag"), "o_orderkey", price.alias("price"), phase.alias("phase"), noise.alias("noise"), wave(7.0).alias("w7"), wave(2.0).alias("w2"), (F.col("o_custkey") % 7).alias("cust"))
    lat, lon = 31.0 + F.col("phase") * 1e-4, 121.0 + F.col("phase") * 5e-5
    tables = {
        "function_manager": base.select("drive_id", F.concat("bag", F.floor(F.col("phase") / 20)).alias("bag"), "t", F.when((F.floor(F.col("phase") / 8) % 3) < 2, 2).otherwise(0).alias("operator_type")),
        "localization": base.select("drive_id", "bag", "t", lat.alias("lat"), lon.alias("lon"), F.abs("noise").alias("sd_east"), (F.abs("noise") / 3).alias("sd_north"), F.when(F.col("cust") == 0, 2).when(F.col("cust") == 1, 7).otherwise(3).alias("status"), F.lit(12.0).alias("velocity_x")),
        "chassis": base.select("drive_id", "bag", "t", (F.col("w2") * 35 + F.col("noise")).alias("steering_angle"), (F.col("w7") * 10).alias("steering_rate"), (F.lit(45.0) + F.col("w7") * 30).alias("speed"), F.col("noise").alias("lon_acc"), (F.col("w2") * 1.2).alias("lat_acc")),
        "control": base.select("drive_id", "bag", "t", (F.col("w7") * 3 + F.col("noise") * 2).alias("target_lon_acc")),
        "control_debug": base.select("drive_id", "bag", "t", (F.col("w7") * 0.3 + F.col("noise") * 0.1).alias("lateral_error"), F.col("noise").alias("heading_error"), (F.col("w7") * 0.01).alias("ref_kappa")),
        "trajectory": base.select(
            "drive_id", "bag", "t", F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.struct((309_000.0 + i * 5 + F.col("phase") * 5).alias("x"), (3_431_000.0 + F.col("phase") * 11 + i * 2).alias("y"), (F.col("w7") * 0.01 + i * 1e-4).alias("kappa"))).alias("path"),
            F.array(F.lit(""), F.concat(F.lit("lane"), (F.floor(F.col("phase") / 5) % 4).cast("string"))).alias("lane_id"), F.when(F.col("cust") == 3, F.lit(None)).otherwise(50.0).alias("speed_limit"),
        ),
        "map": base.filter("phase % 10 = 0").select("drive_id", "bag", "t", F.map_from_arrays(F.array(*[F.lit(f"lane{i}") for i in range(4)]), F.array(*[F.struct(F.lit(turn).alias("turn"), F.lit(j).alias("junction_id"), F.lit(1).alias("lane_type")) for turn, j in ((1, ""), (2, "j1"), (1, "j1"), (3, "j2"))])).alias("lanes")),
    }
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.struct(F.col("l_partkey").alias("track_id"), (F.col("l_quantity") - 15).alias("x"), (F.col("l_discount") * 100 - 5).alias("y"), (F.col("l_tax") * 100).alias("vx"), F.lit(0.0).alias("vy"), (0.5 + F.col("l_tax") * 50).alias("length"), (0.5 + F.col("l_linenumber") * 0.3).alias("width"), (F.col("l_extendedprice") / 10000).alias("heading"), F.when(F.col("l_returnflag") == "A", 3).otherwise(1).alias("motion"), (F.col("l_linenumber") % 6 * 30).cast("int").alias("type")).alias("item"),
    )
    items = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("item")).alias("items"))
    tables["obstacles"] = _sample(items, "l_orderkey", 10.0).select("drive_id", F.lit("bag").alias("bag"), "t", "items")
    return Telemetry(tables, config)


def _rounded(df: DataFrame) -> DataFrame:
    return df.select("drive_id", "metric", F.round("value", 5).alias("value"), "value_text", "unit")


#: The same telemetry in SQL: every topic has one row per sample, so a frame is a row of each.
_FRAMES = """b AS (SELECT 'd' || CAST(floor((o_orderkey - 1) / 500) AS BIGINT) AS drive_id, 1700000000.0::DOUBLE + CAST((o_orderkey - 1) % 500 AS DOUBLE) / 10 AS t,
        CAST((o_orderkey * 7919) % 2000 - 1000 AS DOUBLE) / 1000 AS noise, o_custkey % 7 AS cust FROM orders),
    p AS (SELECT *, t - 1700000000.0::DOUBLE AS phase FROM b),
    f AS (SELECT drive_id, t, (floor(phase / 8) % 3) < 2 AS is_auto, 31.0::DOUBLE + phase * 1e-4 AS lat, 121.0::DOUBLE + phase * 5e-5 AS lon, abs(noise) AS sd,
        CASE cust WHEN 0 THEN 2 WHEN 1 THEN 7 ELSE 3 END AS status, 45 + sin(2 * 3.141592653589793 * phase / 7) * 30 AS speed, CASE WHEN cust <> 3 THEN 50.0 END AS speed_limit,
        sin(2 * 3.141592653589793 * phase / 7) * 0.3 + noise * 0.1 AS err, abs(sin(2 * 3.141592653589793 * phase / 7) * 0.01) AS kappa FROM p),
    h AS (SELECT *, lag(t) OVER w AS t0, lag(is_auto) OVER w AS auto0, radians(lat) AS la, radians(lag(lat) OVER w) AS la0, radians(lon - lag(lon) OVER w) AS dlon, lead(is_auto) OVER w AS auto1, lead(t) OVER w AS t1
        FROM f WINDOW w AS (PARTITION BY drive_id ORDER BY t)),
    s AS (SELECT *, t - t0 AS dt, pow(sin((la - la0) / 2), 2) + cos(la) * cos(la0) * pow(sin(dlon / 2), 2) AS a FROM h),
    d AS (SELECT *, 2 * 6371000.0 * atan2(sqrt(a), sqrt(1 - a)) AS m FROM s),
    mileage AS (SELECT drive_id, coalesce(sum(m) FILTER (ok AND is_auto), 0) / 1000 AS auto_km, coalesce(sum(m) FILTER (ok AND NOT is_auto), 0) / 1000 AS manual_km,
        coalesce(sum(dt) FILTER (ok AND is_auto), 0) AS auto_s, coalesce(sum(dt) FILTER (ok AND NOT is_auto), 0) AS manual_s
        FROM (SELECT *, coalesce(dt > 0 AND dt <= 1 AND m / dt * 3.6 <= 200, false) AS ok FROM d) GROUP BY drive_id)"""


def _sql(parts: str, source: str, metrics: dict[str, tuple[str, ...]]) -> str:
    """One SELECT per metric: (value, unit) or (value, unit, text)."""
    rows = [f"SELECT drive_id, '{name}' AS metric, round(CAST({m[0]} AS DOUBLE), 5) AS value, CAST({m[2] if len(m) > 2 else 'NULL'} AS VARCHAR) AS value_text, '{m[1]}' AS unit FROM {source}" for name, m in metrics.items()]
    return f"WITH RECURSIVE {_FRAMES}{', ' if parts else ''}{parts} " + " UNION ALL ".join(rows)


#: The obstacles of the nearest frame within 0.3 s, measured, and per frame the nearest and the first to be hit.
_SEEN = """o AS (SELECT DISTINCT l_orderkey AS k, 'd' || CAST(floor((l_orderkey - 1) / 500) AS BIGINT) AS drive_id, 1700000000.0::DOUBLE + CAST((l_orderkey - 1) % 500 AS DOUBLE) / 10 AS t FROM lineitem),
    n AS (SELECT f.drive_id, f.t, f.speed / 3.6::DOUBLE AS ego, o.k FROM f LEFT JOIN o ON o.drive_id = f.drive_id AND abs(o.t - f.t) <= 0.3::DOUBLE QUALIFY row_number() OVER (PARTITION BY f.drive_id, f.t ORDER BY abs(o.t - f.t), o.t) = 1),
    ob AS (SELECT l_orderkey AS k, l_partkey AS track_id, l_quantity - 15 AS x, l_discount * 100 - 5 AS y, l_tax * 100 AS vx, 0.5 + l_tax * 50 AS len, 0.5 + l_linenumber * 0.3::DOUBLE AS wid, l_extendedprice / 10000 AS heading,
        CASE WHEN l_returnflag = 'A' THEN 3 ELSE 1 END AS motion, l_linenumber % 6 * 30 AS type FROM lineitem),
    bx AS (SELECT *, (len * abs(cos(heading)) + wid * abs(sin(heading))) / 2 AS hx, (len * abs(sin(heading)) + wid * abs(cos(heading))) / 2 AS hy, row_number() OVER (PARTITION BY k ORDER BY track_id, x, y, vx, len, wid, heading, motion, type) AS i FROM ob),
    xy AS (SELECT *, x - hx AS x0, x + hx AS x1, y - hy AS y0, y + hy AS y1 FROM bx),
    seen AS (SELECT n.drive_id, n.t, n.ego, xy.*, sqrt(pow(greatest(-1.0 - x1, x0 - 3.8, 0.0), 2) + pow(greatest(-0.95 - y1, y0 - 0.95, 0.0), 2)) AS distance,
        x * x + y * y < 25 OR pow(greatest(x0, least(0.0, x1)), 2) + pow(greatest(y0, least(0.0, y1)), 2) <= 25 AS near, NOT (x1 < -6.0 OR x0 > 13.8 OR y1 < -3.95 OR y0 > 3.95) AS mid, NOT (x1 < -11.0 OR x0 > 53.8 OR y1 < -5.95 OR y0 > 5.95) AS far,
        CASE WHEN x0 > 3.8 AND y0 <= 1.25 AND y1 >= -1.25 AND ego > 0.5 AND ego - vx > 0.1 AND (x0 - 3.8) / (ego - vx) < 30 THEN (x0 - 3.8) / (ego - vx) END AS ttc FROM n LEFT JOIN xy ON n.k = xy.k),
    fr AS (SELECT drive_id, t, count(x0) AS obstacles, min(distance) AS distance, min(ttc) AS ttc, first(type ORDER BY distance, i) AS near_type, first(type ORDER BY ttc, i) FILTER (ttc IS NOT NULL) AS ttc_type, first(track_id ORDER BY distance, i) AS track_id,
        __COUNTS__ FROM seen GROUP BY drive_id, t)""".replace(
    "__COUNTS__", ", ".join(f"count(*) FILTER ({a}) AS {a}_total, count(*) FILTER ({a} AND motion = 3) AS {a}_static, count(*) FILTER ({a} AND motion <> 3) AS {a}_moving" for a in ("near", "mid", "far"))
)
_AREAS = [f"{a}_{k}" for a in ("near", "mid", "far") for k in ("total", "static", "moving")]


def _typed_sql(value: str, kind: str, unit: str) -> str:
    """The low percentile of a value by obstacle type, or its minimum over fewer than 20 frames."""
    return f"""SELECT drive_id, '{value}_p5_type_' || {kind} AS metric, round(CASE WHEN count(*) >= 20 THEN quantile_cont({value}, 0.05) ELSE min({value}) END, 5) AS value, CAST(NULL AS VARCHAR) AS value_text, '{unit}' AS unit
        FROM fr WHERE {value} IS NOT NULL GROUP BY drive_id, {kind}"""


def low_pass_ctes(name: str, source: str) -> str:
    """Table expressions up to one of the given name (sid, i, y), the zero-phase low-pass of source (sid, i from 1 to n, n, v,
    cut in units of the Nyquist rate): a recursive pass over each series with odd extensions of nine rows, and one from
    the other end over its result. The coefficients of the second-order Butterworth filter are worked out by the bilinear
    transform. Series of fewer than ten rows, and cutoffs beyond the Nyquist rate, pass unchanged."""

    def turn(to: str, rows: str, first: str, sign: str) -> str:
        return f"""{to}(sid, i, y, z1, z2) AS (
            SELECT x.sid, x.i, b0 * v + s1 * v, b1 * v - a1 * (b0 + s1) * v + s2 * v, b2 * v - a2 * (b0 + s1) * v FROM {rows} x JOIN {name}_co c ON c.sid = x.sid WHERE x.i = {first}
            UNION ALL SELECT x.sid, x.i, b0 * x.v + p.z1, b1 * x.v - a1 * (b0 * x.v + p.z1) + p.z2, b2 * x.v - a2 * (b0 * x.v + p.z1)
            FROM {to} p JOIN {rows} x ON x.sid = p.sid AND x.i = p.i {sign} 1 JOIN {name}_co c ON c.sid = x.sid)"""

    return f"""{name}_w AS (SELECT DISTINCT sid, tan(pi() * cut / 2) AS w FROM {source} WHERE n >= 10 AND cut > 0 AND cut < 1),
        {name}_k AS (SELECT sid, w * w / (1 + sqrt(2) * w + w * w) AS g, 2 * (w * w - 1) / (1 + sqrt(2) * w + w * w) AS a1, (1 - sqrt(2) * w + w * w) / (1 + sqrt(2) * w + w * w) AS a2 FROM {name}_w),
        {name}_co AS (SELECT sid, g AS b0, 2 * g AS b1, g AS b2, a1, a2, 2 * g - a1 * 4 * g / (1 + a1 + a2) + g - a2 * 4 * g / (1 + a1 + a2) AS s1, g - a2 * 4 * g / (1 + a1 + a2) AS s2 FROM {name}_k),
        {name}_x AS (SELECT sid, i, v FROM {source} WHERE sid IN (SELECT sid FROM {name}_co)
            UNION ALL SELECT o.sid, 2 - o.i, 2 * e.v - o.v FROM {source} o JOIN {source} e ON e.sid = o.sid AND e.i = 1 WHERE o.i BETWEEN 2 AND 10 AND o.n >= 10
            UNION ALL SELECT o.sid, 2 * o.n - o.i, 2 * e.v - o.v FROM {source} o JOIN {source} e ON e.sid = o.sid AND e.i = e.n WHERE o.i BETWEEN o.n - 9 AND o.n - 1 AND o.n >= 10),
        {turn(f"{name}_f", f"{name}_x", "-8", "+")}, {name}_m AS (SELECT sid, i, y AS v, max(i) OVER (PARTITION BY sid) AS top FROM {name}_f),
        {turn(f"{name}_b", f"{name}_m", "top", "-")},
        {name} AS (SELECT s.sid, s.i, coalesce(y, v) AS y FROM {source} s LEFT JOIN {name}_b b ON b.sid = s.sid AND b.i = s.i)"""


def _band_sql(speed: str, bands: list[tuple[float, float, float]], default: float) -> str:
    return "CASE " + " ".join(f"WHEN {speed} >= {lo} AND {speed} < {hi} THEN {float(v)}" for lo, hi, v in bands) + f" ELSE {float(default)} END"


_PER = ("CASE WHEN auto_km > 0 THEN n * 100.0 / auto_km ELSE 0 END", "1/100 km")
_KM = ("CASE WHEN n > 0 THEN auto_km / n END", "km", "CASE WHEN n = 0 THEN 'inf' END")
PROGRAM_SQL = {
    "mileage": _sql(
        "", "mileage",
        {"total_km": ("auto_km + manual_km", "km"), "auto_km": ("auto_km", "km"), "manual_km": ("manual_km", "km"), "auto_min": ("auto_s / 60", "min"), "manual_min": ("manual_s / 60", "min"),
         "auto_kmh": ("CASE WHEN auto_s > 0 THEN auto_km / (auto_s / 3600) END", "km/h"), "auto_pct": ("CASE WHEN auto_km + manual_km > 0 THEN auto_km * 100 / (auto_km + manual_km) END", "%")},
    ),
    "takeover": _sql(
        """i AS (SELECT *, sum(CASE WHEN auto0 IS NULL OR auto0 <> is_auto OR dt > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY drive_id ORDER BY t) AS island FROM d),
        g AS (SELECT drive_id, min(t) AS began, max(t) AS ended, arg_max_null(auto1, t) AS auto1, arg_max_null(t1, t) AS stop FROM i WHERE is_auto GROUP BY drive_id, island),
        e AS (SELECT drive_id, stop, ended - began >= 1 AS valid FROM g WHERE NOT auto1 AND stop - ended <= 1),
        v AS (SELECT drive_id, stop - lag(stop) OVER (PARTITION BY drive_id ORDER BY stop) AS apart FROM e WHERE valid),
        k AS (SELECT *, coalesce((SELECT count(*) FROM e WHERE e.drive_id = mileage.drive_id), 0) AS every, coalesce((SELECT count(*) FROM e WHERE e.drive_id = mileage.drive_id AND valid), 0) AS n,
              (SELECT avg(apart) FROM v WHERE v.drive_id = mileage.drive_id AND apart <= 60) AS apart FROM mileage)""",
        "k",
        {"takeovers": ("n", ""), "takeovers_invalid": ("every - n", ""), "takeovers_per_100km": _PER, "km_per_takeover": _KM, "takeover_interval": ("coalesce(apart, CASE WHEN n > 0 THEN auto_s / n END, auto_s) / 60", "min")},
    ),
    "speeding": _sql(
        """r AS (SELECT *, coalesce(is_auto AND speed_limit > 0 AND speed > 1.15 * speed_limit AND speed > 50, false) AS fast, CASE WHEN auto0 AND m < 100 THEN m END AS step FROM d),
        i AS (SELECT *, row_number() OVER (PARTITION BY drive_id ORDER BY t) - row_number() OVER (PARTITION BY drive_id, fast ORDER BY t) AS island FROM r),
        j AS (SELECT *, row_number() OVER (PARTITION BY drive_id, island ORDER BY t) AS rn FROM i WHERE fast),
        e AS (SELECT drive_id, coalesce(sum(step) FILTER (rn > 1), 0) AS m, max(speed / speed_limit) AS peak FROM j GROUP BY drive_id, island HAVING max(t) - min(t) >= 1),
        c AS (SELECT drive_id, count(*) AS n, sum(m) / 1000 AS over_km, max(peak) AS ratio FROM e GROUP BY drive_id),
        k AS (SELECT mileage.*, coalesce(n, 0) AS n, coalesce(over_km, 0) AS over_km, ratio FROM mileage LEFT JOIN c USING (drive_id))""",
        "k",
        {"speeding_events": ("n", ""), "speeding_km": ("over_km", "km"), "speeding_per_100km": _PER, "km_per_speeding": _KM, "speeding_ratio": ("ratio", "")},
    ),
    "localization": _sql(
        """c AS (SELECT *, CASE WHEN status = 2 THEN 'waiting' WHEN sd > 1.0 THEN 'drift' WHEN sd > 0.2 THEN 'possible' ELSE 'normal' END AS class FROM f),
        k AS (SELECT drive_id, avg(CASE WHEN class = 'normal' THEN 100.0 ELSE 0 END) AS normal, avg(CASE WHEN class = 'drift' THEN 100.0 ELSE 0 END) AS drift, avg(CASE WHEN class = 'possible' THEN 100.0 ELSE 0 END) AS possible,
              avg(sd) AS sd, count(*) FILTER (class = 'drift') AS high, count(*) FILTER (class = 'possible') AS mid FROM c GROUP BY drive_id)""",
        "k",
        {"loc_normal": ("normal", "%"), "loc_drift": ("drift", "%"), "loc_possible": ("possible", "%"), "loc_sd": ("sd", "m"), "loc_high_frames": ("high", ""), "loc_mid_frames": ("mid", "")},
    ),
    "lane_keeping": _sql(
        """k AS (SELECT drive_id, avg(abs(err)) AS mean, quantile_cont(abs(err), 0.95) AS p95, max(abs(err)) AS most, avg(abs(err)) FILTER (kappa < 0.003) AS straight, avg(abs(err)) FILTER (kappa >= 0.003) AS curve,
              avg(CASE WHEN abs(err) > 0.1 THEN 100.0 ELSE 0 END) AS o10, avg(CASE WHEN abs(err) > 0.2 THEN 100.0 ELSE 0 END) AS o20, avg(CASE WHEN abs(err) > 0.3 THEN 100.0 ELSE 0 END) AS o30
              FROM f WHERE is_auto AND status IN (3, 7) AND sd <= 0.2 GROUP BY drive_id HAVING count(*) >= 10)""",
        "k",
        {f"lane_error_{n}": (f"{c} * 100", "cm") for n, c in (("mean", "mean"), ("p95", "p95"), ("max", "most"), ("straight", "straight"), ("curve", "curve"))} | {f"lane_over_{x}cm": (f"o{x}", "%") for x in (10, 20, 30)},
    ),
}

PROGRAM_SQL["quality"] = _sql(
    f"""{_SEEN.split("    ob AS")[0].rstrip().rstrip(",")}, q AS (SELECT drive_id, avg(CASE WHEN k IS NOT NULL THEN 100.0 ELSE 0 END) AS seen FROM n GROUP BY drive_id)""",
    "q",
    {f"coverage_{t}": ("100", "%") for t in ("localization", "chassis", "trajectory", "control_debug")} | {"coverage_obstacles": ("seen", "%"), "coverage_low_topics": ("CASE WHEN seen < 80 THEN 1 ELSE 0 END", "")},
)
PROGRAM_SQL["roi"] = _sql(
    f"""{_SEEN}, g AS (SELECT drive_id, {", ".join(f"avg({a}) AS {a}" for a in _AREAS)}, max(near_total) AS near_max, quantile_cont(near_total, 0.95) AS near_p95, quantile_cont(distance, 0.05) AS nearest_p5,
        avg(CASE WHEN distance < 1.5 THEN 100.0 ELSE 0 END) AS danger, quantile_cont(ttc, 0.05) AS ttc_p5 FROM fr GROUP BY drive_id)""",
    "g",
    {a: (a, "") for a in [*_AREAS, "near_max", "near_p95"]} | {"nearest_p5": ("nearest_p5", "m"), "danger_pct": ("danger", "%"), "ttc_p5": ("ttc_p5", "s")},
) + " UNION ALL " + _typed_sql("distance", "near_type", "m") + " UNION ALL " + _typed_sql("ttc", "ttc_type", "s")
#: The path point nearest to the vehicle, and the shorter perpendicular on the two segments that meet there.
PROGRAM_SQL["curvature"] = _sql(
    f"""au AS (SELECT drive_id, t, lat, lon, t - 1700000000.0::DOUBLE AS phase FROM f WHERE is_auto), {utm_steps("au")},
        pt AS (SELECT drive_id, t, easting, northing, i, 309000.0::DOUBLE + i * 5 + phase * 5 AS x, 3431000.0::DOUBLE + phase * 11 + i * 2 AS y, sin(2 * 3.141592653589793 * phase / 7) * 0.01 + i * 1e-4 AS k FROM utm, generate_series(0, 9) g(i)),
        nx AS (SELECT *, lead(x) OVER w - x AS dx, lead(y) OVER w - y AS dy, (k + lead(k) OVER w) / 2 AS k2, row_number() OVER (PARTITION BY drive_id, t ORDER BY pow(x - easting, 2) + pow(y - northing, 2), i) AS place FROM pt WINDOW w AS (PARTITION BY drive_id, t ORDER BY i)),
        sh AS (SELECT *, dx * dx + dy * dy AS l2, greatest(0.0, least(1.0, ((easting - x) * dx + (northing - y) * dy) / (dx * dx + dy * dy))) AS share FROM nx),
        sg AS (SELECT *, sqrt(pow(easting - x - share * dx, 2) + pow(northing - y - share * dy, 2)) AS d FROM sh),
        lg AS (SELECT *, lag(i) OVER w AS i1, lag(d) OVER w AS d1, lag(k2) OVER w AS bend1, lag(l2) OVER w AS l1 FROM sg WINDOW w AS (PARTITION BY drive_id, t ORDER BY i)),
        bt AS (SELECT drive_id, abs(k) AS k, coalesce(l1, l2) AS l, CASE WHEN i1 IS NULL OR (i < 9 AND d < d1) THEN d ELSE d1 END AS d, abs(CASE WHEN i1 IS NULL OR (i < 9 AND d < d1) THEN k2 ELSE bend1 END) AS bend FROM lg WHERE place = 1),
        g AS (SELECT drive_id, avg(k) AS kappa, stddev_pop(k) AS std, avg(CASE WHEN k < 0.003 THEN 100.0 ELSE 0 END) AS straight, avg(CASE WHEN k >= 0.003 THEN 100.0 ELSE 0 END) AS curve,
              avg(CASE WHEN k >= 0.003 AND k < 0.02 THEN 100.0 ELSE 0 END) AS small, avg(CASE WHEN k >= 0.02 THEN 100.0 ELSE 0 END) AS large, avg(greatest(0.0, d - CASE WHEN bend > 0.003 THEN l * bend / 8 * 0.5 ELSE 0 END)) AS distance FROM bt GROUP BY drive_id)""",
    "g",
    {"kappa_mean": ("kappa", "1/m"), "kappa_std": ("std", "1/m"), "straight_pct": ("straight", "%"), "curve_pct": ("curve", "%"), "small_curve_pct": ("small", "%"), "large_curve_pct": ("large", "%"), "match_distance": ("distance", "m")},
)


#: Autonomous accelerations by continuous segment, and their jerk: central differences of the low-passed series.
_JERK = f"""ac AS (SELECT f.drive_id, f.t, f.speed, sin(2 * 3.141592653589793 * (f.t - 1700000000.0::DOUBLE) / 7) * 3 + b.noise * 2 AS acc FROM f JOIN b USING (drive_id, t) WHERE is_auto),
    br AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY drive_id ORDER BY t) > 1 THEN 1 ELSE 0 END AS brk FROM __ROWS__),
    sg AS (SELECT *, drive_id || '-' || CAST(sum(brk) OVER (PARTITION BY drive_id ORDER BY t) AS BIGINT) AS sid FROM br),
    nu AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY t) AS i, count(*) OVER (PARTITION BY sid) AS n, t - lag(t) OVER (PARTITION BY sid ORDER BY t) AS dt FROM sg),
    sp AS (SELECT sid, median(dt) AS step FROM nu WHERE dt > 0 GROUP BY sid),
    ja AS (SELECT nu.sid, i, n, acc AS v, least(10.0::DOUBLE, 0.99::DOUBLE / (2 * step)) / (1 / step / 2) AS cut FROM nu JOIN sp USING (sid)),
    {low_pass_ctes("jl", "ja")},
    jd AS (SELECT nu.*, step, y, lag(y) OVER w AS y0, lead(y) OVER w AS y1 FROM nu LEFT JOIN sp USING (sid) LEFT JOIN jl ON jl.sid = nu.sid AND jl.i = nu.i WINDOW w AS (PARTITION BY nu.sid ORDER BY nu.i)),
    jr AS (SELECT drive_id, sid, t, speed, acc, i, n, CASE WHEN n <= 2 OR step IS NULL THEN 0.0 WHEN i = 1 THEN (y1 - y) / step WHEN i = n THEN (y - y0) / step ELSE (y1 - y0) / (2 * step) END AS raw FROM jd),
    jk AS (SELECT *, CASE WHEN abs(raw) <= 15 THEN raw END AS jerk FROM jr)"""

PROGRAM_SQL["comfort"] = _sql(
    _JERK.replace("__ROWS__", "(SELECT * FROM ac QUALIFY count(*) FILTER (speed >= 5) OVER (PARTITION BY drive_id) < 10 OR speed >= 5)") + f""",
    pk AS (SELECT *, abs(jerk) > {_band_sql("speed", limits.JERK_PEAK, 3.0)} AS high FROM jk),
    per AS (SELECT drive_id, count(*) AS n, avg(abs(jerk)) AS mean, quantile_cont(abs(jerk), 0.95) AS p95, quantile_cont(abs(jerk), 0.99) AS p99, avg(speed) AS v, avg(CASE WHEN high THEN 100.0 WHEN NOT high THEN 0 END) AS over,
        max(acc) FILTER (acc > 0) AS up, avg(CASE WHEN acc > {_band_sql("speed", limits.ACC_WARN, 3.0)} THEN 100.0 ELSE 0 END) FILTER (acc > 0) AS up_over,
        max(-acc) FILTER (acc < 0) AS down, avg(CASE WHEN -acc > {_band_sql("speed", limits.DEC_WARN, 3.0)} THEN 100.0 ELSE 0 END) FILTER (acc < 0) AS down_over FROM pk GROUP BY drive_id HAVING count(*) >= 10),
    wd AS (SELECT drive_id, CAST(greatest(1, round(least(greatest(1 / median(dt), 1.0), 100.0))) AS BIGINT) AS width FROM (SELECT drive_id, t - lag(t) OVER (PARTITION BY drive_id ORDER BY t) AS dt FROM jk) WHERE dt > 0 GROUP BY drive_id),
    wn AS (SELECT drive_id, sid, jerk, width, greatest(1, width // 2) AS hop, unnest(generate_series(greatest(0, CAST(ceil((i - width) / CAST(greatest(1, width // 2) AS DOUBLE)) AS BIGINT)), (i - 1) // greatest(1, width // 2))) AS k FROM jk JOIN wd USING (drive_id)),
    wf AS (SELECT drive_id, sqrt(avg(jerk * jerk)) AS rms FROM wn GROUP BY drive_id, sid, k, width HAVING count(jerk) = width),
    wa AS (SELECT * FROM wf UNION ALL SELECT drive_id, sqrt(avg(jerk * jerk)) FROM jk WHERE jerk IS NOT NULL AND drive_id NOT IN (SELECT drive_id FROM wf) GROUP BY drive_id),
    wr AS (SELECT drive_id, max(rms) AS rms_max, quantile_cont(rms, 0.95) AS rms_p95 FROM wa GROUP BY drive_id),
    ev AS (SELECT drive_id, count(*) AS events FROM (SELECT drive_id, t - lag(t) OVER (PARTITION BY drive_id ORDER BY t) AS dt FROM pk WHERE high) WHERE dt IS NULL OR dt > 2 GROUP BY drive_id),
    al AS (SELECT per.*, rms_max, rms_p95, coalesce(events, 0) AS events, {_band_sql("v", limits.JERK_RMS, 1.5)} AS rms_limit, {_band_sql("v", limits.JERK_PEAK, 3.0)} AS peak_limit FROM per LEFT JOIN wr USING (drive_id) LEFT JOIN ev USING (drive_id)),
    k AS (SELECT *, greatest(0.0, least(100.0, 100 - coalesce(least(40.0, greatest(0.0, (rms_max - rms_limit) * 10)), 0) - coalesce(least(30.0, greatest(0.0, (p99 - peak_limit) * 5)), 0) - coalesce(least(20.0, greatest(0.0, mean * 10 - rms_limit * 5)), 0))) AS score FROM al)""",
    "k",
    {"jerk_mean": ("mean", "m/s3"), "jerk_p95": ("p95", "m/s3"), "jerk_rms_max": ("rms_max", "m/s3"), "jerk_rms_p95": ("rms_p95", "m/s3"), "jerk_over_pct": ("over", "%"), "acc_peak": ("up", "m/s2"), "acc_over_pct": ("up_over", "%"),
     "dec_peak": ("down", "m/s2"), "dec_over_pct": ("down_over", "%"), "jerk_events": ("events", ""), "comfort_score": ("score", "", "CASE WHEN score >= 90 THEN 'A' WHEN score >= 75 THEN 'B' WHEN score >= 60 THEN 'C' ELSE 'D' END")},
)


def _floor_sql(speed: str, steps: dict[float, float], default: float, strict: bool = False) -> str:
    return "CASE " + " ".join(f"WHEN {speed} {'>' if strict else '>='} {key} THEN {float(steps[key])}" for key in sorted(steps, reverse=True)) + f" ELSE {float(default)} END"


def _runs_sql(name: str, source: str, flag: str, gap: float | None, least: float, more: str = "") -> str:
    """Runs of flagged rows of a drive as a table (drive_id, start_ts, end_ts and more)."""
    far = f" OR apart > {gap}" if gap is not None else ""
    return f"""{name}_g AS (SELECT *, t - lag(t) OVER w AS apart, coalesce({flag}, false) AS flagged, lag(coalesce({flag}, false)) OVER w AS before FROM {source} WINDOW w AS (PARTITION BY drive_id ORDER BY t)),
        {name}_i AS (SELECT *, sum(CASE WHEN before IS NULL OR before <> flagged{far} THEN 1 ELSE 0 END) OVER (PARTITION BY drive_id ORDER BY t) AS island FROM {name}_g),
        {name} AS (SELECT drive_id, min(t) AS start_ts, max(t) AS end_ts{more} FROM {name}_i WHERE flagged GROUP BY drive_id, island HAVING max(t) - min(t) >= {least})"""


def _merged_sql(name: str, source: str, gap: float, more: str = "") -> str:
    """Events of a drive merged where the next starts at most gap after the one before it ends."""
    return f"""{name}_m AS (SELECT *, sum(CASE WHEN start_ts - upto <= {gap} THEN 0 ELSE 1 END) OVER (PARTITION BY drive_id ORDER BY start_ts, end_ts ROWS UNBOUNDED PRECEDING) AS merged
            FROM (SELECT *, lag(end_ts) OVER (PARTITION BY drive_id ORDER BY start_ts, end_ts) AS upto FROM {source})),
        {name} AS (SELECT drive_id, min(start_ts) AS start_ts, max(end_ts) AS end_ts{more} FROM {name}_m GROUP BY drive_id, merged)"""


def _cut_sql(hz: float, step: str) -> str:
    """A cutoff in units of the Nyquist rate, at least 0.1 Hz below it."""
    rate = f"least(100.0, greatest(1.0, 1 / {step}))"
    return f"least({hz}::DOUBLE, {rate} / 2 - 0.1) / ({rate} / 2)"


#: Filtered steering rates by continuous segment: the angle is low-passed, differentiated at the steps' middle times, and
#: low-passed again.
_STEERING = f"""sa AS (SELECT f.drive_id, f.t, f.speed, sin(2 * 3.141592653589793 * (f.t - 1700000000.0::DOUBLE) / 2) * 35 + b.noise AS angle FROM f JOIN b USING (drive_id, t) WHERE is_auto AND speed >= 1),
    sb AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY drive_id ORDER BY t) > 1 THEN 1 ELSE 0 END AS brk FROM sa),
    ss AS (SELECT *, drive_id || '-' || CAST(sum(brk) OVER (PARTITION BY drive_id ORDER BY t) AS BIGINT) AS sid FROM sb),
    sn AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY t) AS i, count(*) OVER (PARTITION BY sid) AS n, t - lag(t) OVER (PARTITION BY sid ORDER BY t) AS dt FROM ss),
    s1 AS (SELECT sid, coalesce(median(dt), 0.02) AS step FROM sn GROUP BY sid),
    sv AS (SELECT sn.sid, i, n, angle AS v, {_cut_sql(10.0, "step")} AS cut FROM sn JOIN s1 USING (sid)), {low_pass_ctes("sl", "sv")},
    sd AS (SELECT drive_id, sn.sid, speed, CASE WHEN dt > 0 AND dt <= 1 THEN (y - lag(y) OVER (PARTITION BY sn.sid ORDER BY sn.i)) / dt END AS raw, t - dt / 2 AS mid, (t + lag(t) OVER (PARTITION BY sn.sid ORDER BY sn.i)) / 2 AS t FROM sn JOIN sl ON sl.sid = sn.sid AND sl.i = sn.i),
    sm AS (SELECT drive_id, sid, speed, raw AS v, t, row_number() OVER (PARTITION BY sid ORDER BY t) AS i, count(*) OVER (PARTITION BY sid) AS n, t - lag(t) OVER (PARTITION BY sid ORDER BY t) AS dt FROM sd WHERE raw IS NOT NULL),
    s2 AS (SELECT sid, coalesce(median(dt), 0.02) AS step FROM sm GROUP BY sid), sw AS (SELECT sm.*, {_cut_sql(15.0, "step")} AS cut FROM sm JOIN s2 USING (sid)), {low_pass_ctes("sf", "sw")},
    sr AS (SELECT drive_id, sw.sid, sw.i, n, t, speed, y AS rate FROM sw JOIN sf ON sf.sid = sw.sid AND sf.i = sw.i)"""

_BIN = "CASE WHEN speed < 10 THEN 0 WHEN speed < 20 THEN 1 WHEN speed < 30 THEN 2 WHEN speed < 40 THEN 3 WHEN speed < 50 THEN 4 WHEN speed < 60 THEN 5 WHEN speed < 80 THEN 6 ELSE 7 END"
PROGRAM_SQL["steering"] = _sql(
    _STEERING + f""", z AS (SELECT drive_id, CAST(floor(rate * 1.0) AS BIGINT) AS size, CAST(greatest(floor(rate * 0.1), 1) AS BIGINT) AS hop FROM (SELECT drive_id, least(greatest(1 / median(dt), 1.0), 100.0) AS rate FROM (SELECT drive_id, t - lag(t) OVER (PARTITION BY drive_id ORDER BY t) AS dt FROM sr) WHERE dt > 0 GROUP BY drive_id)),
    wi AS (SELECT drive_id, sid, size, unnest(generate_series(0, max(n) - size, hop)) AS first FROM sr JOIN z USING (drive_id) GROUP BY drive_id, sid, size, hop HAVING max(n) >= size),
    wr AS (SELECT wi.drive_id, wi.sid, first, sqrt(avg(rate * rate)) AS rms FROM wi JOIN sr ON sr.sid = wi.sid AND sr.i BETWEEN first + 1 AND first + size GROUP BY wi.drive_id, wi.sid, first),
    hi AS (SELECT drive_id, t, sign(rate) AS s, lag(sign(rate)) OVER (PARTITION BY drive_id ORDER BY t) AS s0 FROM sr WHERE abs(rate) >= 5),
    fl AS (SELECT drive_id, coalesce(sum(CASE WHEN s <> s0 THEN 1 ELSE 0 END) / nullif(max(t) - min(t), 0), 0) AS flips FROM hi GROUP BY drive_id),
    ta AS (SELECT drive_id, quantile_cont(abs(rate), 0.95) AS rate_p95 FROM sr GROUP BY drive_id),
    k AS (SELECT drive_id, avg(rms) AS mean, max(rms) AS most, quantile_cont(rms, 0.95) AS p95, any_value(rate_p95) AS rate_p95, any_value(flips) AS flips FROM wr LEFT JOIN ta USING (drive_id) LEFT JOIN fl USING (drive_id) GROUP BY drive_id)""",
    "k",
    {"steering_rms_mean": ("mean", "deg/s"), "steering_rms_max": ("most", "deg/s"), "steering_rms_p95": ("p95", "deg/s"), "steering_rate_p95": ("rate_p95", "deg/s"), "steering_flip_rate": ("flips", "1/s")},
) + "".join(
    f""" UNION ALL SELECT drive_id, 'steering_{n}_bin' || {_BIN} AS metric, round({v}, 5) AS value, CAST(NULL AS VARCHAR) AS value_text, 'deg/s' AS unit FROM sr GROUP BY drive_id, {_BIN}"""
    for n, v in (("rms", "sqrt(avg(rate * rate))"), ("p95", "quantile_cont(abs(rate), 0.95)"))
)
PROGRAM_SQL["emergency"] = _sql(
    _JERK.replace("__ROWS__", "ac") + ", " + _STEERING + ", " + _runs_sql("hb", "ac", "acc < " + _band_sql("speed", limits.DEC_FAIL, -3.0), 0.5, 0.1) + ", "
    + "jn AS (SELECT * FROM jk WHERE jerk IS NOT NULL), " + _runs_sql("jv", "jn", "abs(jerk) > " + _band_sql("speed", limits.JERK_PEAK, 2.5), 0.5, 0.2) + ", " + _merged_sql("je", "jv", 0.4) + ", "
    + "sc AS (SELECT drive_id, speed, (t + t0) / 2 AS t, (rate - rate0) / (t - t0) AS acc FROM (SELECT *, lag(t) OVER w AS t0, lag(rate) OVER w AS rate0 FROM sr WINDOW w AS (PARTITION BY sid ORDER BY i)) WHERE t - t0 > 0 AND t - t0 <= 1), "
    + _runs_sql("lr", "sr", "abs(rate) > " + _floor_sql("speed", limits.LATERAL_RATE, 200), 0.5, 0.1) + ", " + _runs_sql("la", "sc", "abs(acc) > " + _floor_sql("speed", limits.LATERAL_ACC, 600, True), 0.5, 0.1) + ", "
    + "lb AS (SELECT *, 'rate' AS kind FROM lr UNION ALL SELECT *, 'acc' FROM la), " + _merged_sql("lt", "lb", 0.3, ", CASE WHEN count(DISTINCT kind) > 1 THEN 'both' ELSE min(kind) END AS kind") + """,
    k AS (SELECT mileage.*, coalesce((SELECT count(*) FROM hb WHERE hb.drive_id = mileage.drive_id), 0) AS brakes, coalesce((SELECT count(*) FROM je WHERE je.drive_id = mileage.drive_id), 0) AS jerks, coalesce((SELECT count(*) FROM lt WHERE lt.drive_id = mileage.drive_id), 0) AS laterals,
        coalesce((SELECT count(*) FROM lt WHERE lt.drive_id = mileage.drive_id AND kind <> 'acc'), 0) AS lateral_rate, coalesce((SELECT count(*) FROM lt WHERE lt.drive_id = mileage.drive_id AND kind <> 'rate'), 0) AS lateral_acc FROM mileage)""",
    "k",
    {n: (n, "") for n in ("brakes", "jerks", "laterals", "lateral_rate", "lateral_acc")}
    | {f"{n}_per_100km": (_PER[0].replace("n * 100.0", f"{n} * 100.0"), _PER[1]) for n in ("brakes", "jerks")}
    | {f"km_per_{n}": (f"CASE WHEN {n} > 0 THEN auto_km / {n} END", "km", f"CASE WHEN {n} = 0 THEN 'inf' END") for n in ("brakes", "jerks")},
)


_BRAKES = _runs_sql("hb", "ac", "acc < " + _band_sql("speed", limits.DEC_FAIL, -3.0), 0.5, 0.1) + ", jn AS (SELECT * FROM jk WHERE jerk IS NOT NULL), " + _runs_sql("jv", "jn", "abs(jerk) > " + _band_sql("speed", limits.JERK_PEAK, 2.5), 0.5, 0.2) + ", " + _merged_sql("je", "jv", 0.4)
_TAKEN = """i AS (SELECT *, sum(CASE WHEN auto0 IS NULL OR auto0 <> is_auto OR dt > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY drive_id ORDER BY t) AS island FROM d),
    tg AS (SELECT drive_id, min(t) AS began, max(t) AS ended, arg_max_null(auto1, t) AS auto1, arg_max_null(t1, t) AS stop FROM i WHERE is_auto GROUP BY drive_id, island),
    te AS (SELECT drive_id, stop AS start_ts FROM tg WHERE NOT auto1 AND stop - ended <= 1 AND ended - began >= 1)"""
#: Junction intervals of autonomous frames: the lanes of a drive with a map change every five seconds, in turn without a
#: junction, left in j1, straight in j1, right in j2.
PROGRAM_SQL["junctions"] = _sql(
    _JERK.replace("__ROWS__", "ac") + ", " + _BRAKES + ", " + _TAKEN + """,
    mp AS (SELECT DISTINCT drive_id FROM p WHERE phase % 10 = 0),
    jf AS (SELECT drive_id, t, CAST(floor((t - 1700000000.0::DOUBLE) / 5) AS BIGINT) % 4 AS lane, drive_id IN (SELECT drive_id FROM mp) AS mapped FROM f WHERE is_auto),
    jw AS (SELECT drive_id, t, CASE WHEN mapped AND lane IN (1, 2) THEN 'j1' WHEN mapped AND lane = 3 THEN 'j2' END AS junction, CASE WHEN mapped AND lane = 1 THEN 'left' WHEN mapped AND lane = 3 THEN 'right' END AS turn FROM jf),
    jx AS (SELECT *, lag(junction) OVER w IS DISTINCT FROM junction OR lag(t) OVER w IS NULL AS brk, lead(t) OVER w AS next_t FROM jw WINDOW w AS (PARTITION BY drive_id ORDER BY t)),
    jy AS (SELECT *, sum(CASE WHEN brk THEN 1 ELSE 0 END) OVER (PARTITION BY drive_id ORDER BY t) AS island FROM jx),
    jz AS (SELECT drive_id, island, min(t) AS enter_ts, coalesce(max(next_t), max(t)) AS until, coalesce(arg_max(turn, t) FILTER (turn IS NOT NULL), 'straight') AS turn FROM jy WHERE junction IS NOT NULL GROUP BY drive_id, junction, island),
    bad AS (SELECT drive_id, start_ts FROM te UNION ALL SELECT drive_id, start_ts FROM hb UNION ALL SELECT drive_id, start_ts FROM je),
    pa AS (SELECT jz.drive_id, turn, EXISTS (SELECT 1 FROM bad WHERE bad.drive_id = jz.drive_id AND start_ts >= enter_ts - 0.5 AND start_ts <= until + 0.5) AS failed FROM jz),
    k AS (SELECT drive_id, count(*) AS total, count(*) FILTER (NOT failed) AS passed, """ + ", ".join(f"count(*) FILTER (turn = '{x}') AS n_{x}, count(*) FILTER (turn = '{x}' AND NOT failed) AS ok_{x}" for x in ("straight", "left", "right", "u_turn")) + " FROM pa GROUP BY drive_id)",
    "k",
    {"junctions": ("total", ""), "junctions_passed": ("passed", ""), "junction_pass_rate": ("passed * 100.0 / total", "%")} | {f"junction_pass_rate_{x}": (f"CASE WHEN n_{x} > 0 THEN ok_{x} * 100.0 / n_{x} END", "%") for x in ("straight", "left", "right", "u_turn")},
)


def _rate_sql(topic: str, rows: str) -> str:
    return f"SELECT drive_id, '{topic}' AS topic, 1 / median(dt) AS rate FROM (SELECT drive_id, t - lag(t) OVER (PARTITION BY drive_id ORDER BY t) AS dt FROM {rows}) WHERE dt > 0 AND dt < 1 GROUP BY drive_id"


_FAST = ("localization", "chassis", "control", "control_debug")
PROGRAM_SQL["recordings"] = _sql(
    _SEEN.split("n AS (SELECT f.drive_id")[0].rstrip().rstrip(",") + ", rt AS (" + " UNION ALL ".join(_rate_sql(t, "o" if t == "obstacles" else "f") for t in ("function_manager", *_FAST, "trajectory", "obstacles")) + f"""),
    bg AS (SELECT drive_id, min(t) AS a, max(t) AS z FROM f GROUP BY drive_id, CAST(floor((t - 1700000000.0::DOUBLE) / 20) AS BIGINT)),
    gp AS (SELECT drive_id, lead(a) OVER (PARTITION BY drive_id ORDER BY a) - z AS gap FROM bg),
    gs AS (SELECT drive_id, count(*) AS gaps, count(*) FILTER (gap > 1) AS long, sum(gap) AS seconds FROM gp WHERE gap > 0 GROUP BY drive_id),
    lo AS (SELECT drive_id, count(*) FILTER (rate < CASE WHEN topic IN {_FAST} THEN 20 ELSE 5 END) AS low FROM rt GROUP BY drive_id),
    k AS (SELECT dr.drive_id, coalesce(gaps, 0) AS gaps, coalesce(long, 0) AS long, coalesce(seconds, 0) AS seconds, coalesce(low, 0) AS low FROM (SELECT DISTINCT drive_id FROM f) dr LEFT JOIN gs USING (drive_id) LEFT JOIN lo USING (drive_id))""",
    "k",
    {"bag_gaps": ("gaps", ""), "bag_gaps_long": ("long", ""), "bag_gap_s": ("seconds", "s"), "rate_low_topics": ("low", ""), "topics_missing": ("1", "", "'planning_debug'")},
) + " UNION ALL SELECT drive_id, 'rate_' || topic, round(rate, 5), CAST(NULL AS VARCHAR), 'Hz' FROM rt"


def _program(name: str):
    def build(spark, sf_dir):
        return _rounded(plans.PROGRAMS[name][0](telemetry(spark, sf_dir).shared(whole=False)).metrics)

    build.__name__ = f"metrics_{name}"
    return query(PROGRAM_SQL.get(name))(build)


for _name in plans.PROGRAMS:
    _program(_name)


@query(f"""WITH {_FRAMES}, {_SEEN} SELECT drive_id, round(t, 5) AS t, round(distance, 5) AS distance, track_id, near_type AS type, obstacles, CASE WHEN distance < 1 THEN 1 WHEN distance < 1.5 THEN 2 WHEN distance < 2 THEN 3 ELSE 4 END AS level,
    row_number() OVER (ORDER BY distance, t, drive_id) AS rank FROM fr WHERE distance < 3 ORDER BY rank LIMIT 20""")
def near_scenes(spark, sf_dir):
    """The twenty frames with the nearest obstacles (a top-k report)."""
    from ..plans.roi import near_scenes as scenes

    return scenes(telemetry(spark, sf_dir).narrow()).select("drive_id", F.round("t", 5).alias("t"), F.round("distance", 5).alias("distance"), "track_id", "type", F.col("obstacles").cast("bigint").alias("obstacles"), "level", F.col("rank").cast("bigint").alias("rank"))


@query(f"""WITH {_FRAMES}, a AS (SELECT drive_id, t, speed, sin(2 * 3.141592653589793 * (t - 1700000000.0::DOUBLE) / 7) * 3 + noise * 2 AS acc FROM f JOIN b USING (drive_id, t) WHERE is_auto),
    o AS (SELECT *, acc < CASE WHEN speed >= 0 AND speed < 10 THEN -4.0 WHEN speed >= 10 AND speed < 30 THEN -3.5 WHEN speed >= 60 AND speed < 999 THEN -2.5 ELSE -3.0 END AS hard FROM a),
    g AS (SELECT *, lag(hard) OVER w AS hard0, t - lag(t) OVER w AS dt FROM o WINDOW w AS (PARTITION BY drive_id ORDER BY t)),
    i AS (SELECT *, sum(CASE WHEN hard0 IS NULL OR hard0 <> hard OR dt > 0.5 THEN 1 ELSE 0 END) OVER (PARTITION BY drive_id ORDER BY t) AS island FROM g)
    SELECT drive_id, round(min(t), 5) AS start_ts, round(max(t), 5) AS end_ts, count(*) AS frame_count, round(min(acc), 5) AS peak, round(avg(acc), 5) AS mean_value, round(avg(speed), 5) AS speed FROM i WHERE hard GROUP BY drive_id, island HAVING max(t) - min(t) >= 0.1""")
def hard_braking_events(spark, sf_dir):
    """Runs of autonomous rows that brake harder than the limit at their speed."""
    from ..plans import comfort, emergency

    tel = telemetry(spark, sf_dir)
    found = emergency.hard_braking(comfort.accelerations(tel), tel.config.run_gap_s, tel.config.brake_min_s)
    return found.select("drive_id", *[F.round(c, 5).alias(c) for c in ("start_ts", "end_ts")], "frame_count", *[F.round(c, 5).alias(c) for c in ("peak", "mean_value", "speed")])


@query()
def all_events(spark, sf_dir):
    """Every program's events with the scene of their start."""
    from ..plans.scene import annotate
    from ..sources.shared import written

    tel = telemetry(spark, sf_dir).shared()
    parts = [r.events for r in map(tel.result, plans.PROGRAMS) if r.events is not None]
    found = written(reduce(DataFrame.unionByName, parts), "events")
    return annotate(found, tel).select("drive_id", "family", F.round("start_ts", 5).alias("start_ts"), F.round("end_ts", 5).alias("end_ts"), "frame_count", F.round("peak", 5).alias("peak"), "lane", "turn", "junction")


_LOW_PASS = f"""WITH RECURSIVE {EV}, series AS (SELECT event_id, drive_id AS sid, value AS v, 4.0::DOUBLE / 10 AS cut, row_number() OVER {SQL_BY_TIME} AS i, count(*) OVER (PARTITION BY drive_id) AS n FROM ev),
    {low_pass_ctes("lp", "series")} SELECT event_id, round(y, 6) AS smooth FROM series JOIN lp USING (sid, i)"""


@query_in_chunks(_LOW_PASS, 86_400.0)
def low_pass_filter(spark, sf_dir, chunk=None):
    """Zero-phase low-pass of each series in the order of time; a series is one chunk unless chunks are given."""
    from ..operators.recurrence import lowpass_series
    from .base import events

    out = lowpass_series(events(spark, sf_dir).select("event_id", "drive_id", "t", "value"), "drive_id", "t", "value", "smooth", 4.0, 20.0, chunk or 1e12, ("event_id",))
    return out.select("event_id", F.round("smooth", 6).alias("smooth"))


#: Weights of a cubic fit over seven rows, for its first to its last row.
_CUBIC_7 = """[[39, 8, -4, -4, 1, 4, -2], [8, 19, 16, 6, -4, -7, 4], [-4, 16, 19, 12, 2, -4, 1], [-4, 6, 12, 14, 12, 6, -4],
    [1, -4, 2, 12, 19, 16, -4], [4, -7, -4, 6, 16, 19, 8], [-2, 4, 1, -4, -4, 8, 39]]"""


@query(f"""WITH {EV}, n AS (SELECT event_id, drive_id, value, row_number() OVER {SQL_BY_TIME} AS i, count(*) OVER (PARTITION BY drive_id) AS n FROM ev),
    p AS (SELECT *, greatest(1, least(i - 3, n - 6)) AS first FROM n),
    s AS (SELECT p.event_id, sum(o.value * list_extract(list_extract({_CUBIC_7}, p.i - p.first + 1), o.i - p.first + 1)) / 42 AS smooth FROM p JOIN n o ON o.drive_id = p.drive_id AND o.i BETWEEN p.first AND p.first + 6 GROUP BY p.event_id)
    SELECT p.event_id, round(CASE WHEN p.n < 7 THEN p.value ELSE s.smooth END, 6) AS smooth FROM p JOIN s USING (event_id)""")
def savitzky_golay(spark, sf_dir):
    from ..operators.windows import polynomial_smoothing
    from .base import by_time, events

    return events(spark, sf_dir).select("event_id", F.round(polynomial_smoothing(by_time(), "value", 7, 3), 6).alias("smooth"))


@query()
def curvature_geojson(spark, sf_dir):
    """Vehicle and path points of the autonomous frames, and the lines between them, as GeoJSON features."""
    from ..plans.curvature import map_features

    return map_features(telemetry(spark, sf_dir).narrow(), 51)
