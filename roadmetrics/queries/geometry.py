"""Distances, boxes around the vehicle, projections."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import boxes, geo
from .base import by_time, EV, OB, events, obstacles, query, table
from .sequences import _STEPS

_BOX = OB + """, bx AS (SELECT *, x - (length * abs(cos(heading)) + width * abs(sin(heading))) / 2 AS x0, x + (length * abs(cos(heading)) + width * abs(sin(heading))) / 2 AS x1,
    y - (length * abs(sin(heading)) + width * abs(cos(heading))) / 2 AS y0, y + (length * abs(sin(heading)) + width * abs(cos(heading))) / 2 AS y1 FROM ob),
    dd AS (SELECT *, greatest(-1.0 - x1, x0 - 3.8, 0.0) AS dx, greatest(-0.95 - y1, y0 - 0.95, 0.0) AS dy FROM bx)"""


def _boxed(spark, sf_dir):
    ob = obstacles(spark, sf_dir)
    return ob, boxes.bounds(F.col("x"), F.col("y"), F.col("length"), F.col("width"), F.col("heading"))


@query(f"WITH {EV}, {_STEPS} SELECT event_id, round(d, 4) AS d FROM st WHERE d IS NOT NULL")
def haversine_steps(spark, sf_dir):
    d = geo.haversine(F.lag("lat").over(by_time()), F.lag("lon").over(by_time()), F.col("lat"), F.col("lon"))
    return events(spark, sf_dir).select("event_id", F.round(d, 4).alias("d")).filter("d IS NOT NULL")


def utm_steps(source: str) -> str:
    """Common table expressions that end in utm: the rows of source (with lat, lon) and their easting and northing in zone 51."""
    e = 2 * geo._N**0.5 / (1 + geo._N)
    east = " + ".join(f"{a!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(geo._ALPHA, 1))
    north = " + ".join(f"{a!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(geo._ALPHA, 1))
    k = geo._K0 * geo._RECTIFYING
    return f"""ua AS (SELECT *, sinh(atanh(sin(radians(lat))) - {e!r} * atanh({e!r} * sin(radians(lat)))) AS tt, radians(lon) - radians(CAST(123 AS DOUBLE)) AS lam FROM {source}),
        ub AS (SELECT *, atan2(tt, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + tt * tt)) AS eta FROM ua),
        utm AS (SELECT *, 500000.0 + {k!r} * (eta + {east}) AS easting, {k!r} * (xi + {north}) AS northing FROM ub)"""


@query(f"WITH {EV}, {utm_steps('ev')} SELECT event_id, round(easting, 3) AS easting, round(northing, 3) AS northing FROM utm")
def utm_forward(spark, sf_dir):
    x, y = geo.utm_forward(F.col("lat"), F.col("lon"), 51)
    return events(spark, sf_dir).select("event_id", F.round(x, 3).alias("easting"), F.round(y, 3).alias("northing"))


@query(f"WITH {EV} SELECT event_id, round(lat, 8) AS lat, round(lon, 8) AS lon FROM ev")
def utm_round_trip(spark, sf_dir):
    x, y = geo.utm_forward(F.col("lat"), F.col("lon"), 51)
    there = events(spark, sf_dir).select("event_id", x.alias("x"), y.alias("y"))
    lat, lon = geo.utm_inverse(F.col("x"), F.col("y"), 51)
    return there.select("event_id", F.round(lat, 8).alias("lat"), F.round(lon, 8).alias("lon"))


@query(f"WITH {_BOX} SELECT frame_id, track_id, round(sqrt(dx * dx + dy * dy), 6) AS distance FROM dd")
def obb_aabb_distance(spark, sf_dir):
    ob, box = _boxed(spark, sf_dir)
    return ob.select("frame_id", "track_id", F.round(boxes.box_distance(box), 6).alias("distance"))


@query(f"""WITH {_BOX}, f AS (SELECT *, x * x + y * y < 25 OR pow(greatest(x0, least(0.0, x1)), 2) + pow(greatest(y0, least(0.0, y1)), 2) <= 25 AS near, NOT (x1 < -6.0 OR x0 > 13.8 OR y1 < -3.95 OR y0 > 3.95) AS mid,
    NOT (x1 < -11.0 OR x0 > 53.8 OR y1 < -5.95 OR y0 > 5.95) AS far FROM dd), c AS (SELECT frame_id, {", ".join(f"count(*) FILTER ({r}) AS {r}_total, count(*) FILTER ({r} AND motion = 'A') AS {r}_static" for r in ("near", "mid", "far"))}, min(sqrt(dx * dx + dy * dy)) AS least FROM f GROUP BY frame_id)
    SELECT o_orderkey AS frame_id, {", ".join(f"coalesce({r}_{k}, 0) AS {r}_{k}" for r in ("near", "mid", "far") for k in ("total", "static"))}, round(least, 6) AS least FROM orders LEFT JOIN c ON o_orderkey = frame_id""")
def roi_counts_per_frame(spark, sf_dir):
    ob, box = _boxed(spark, sf_dir)
    ego = boxes.Ego()
    areas = {"near": boxes.in_circle(box, F.col("x"), F.col("y"), 5.0), "mid": boxes.in_rect(box, ego.roi(10, 5, 3, 3)), "far": boxes.in_rect(box, ego.roi(50, 10, 5, 5))}
    flags = ob.select("frame_id", "motion", boxes.box_distance(box).alias("distance"), *[c.alias(n) for n, c in areas.items()])
    still = F.col("motion") == "A"
    counts = flags.groupBy("frame_id").agg(*[a for n in areas for a in (F.count_if(n).alias(f"{n}_total"), F.count_if(F.col(n) & still).alias(f"{n}_static"))], F.min("distance").alias("least"))
    frames = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("frame_id")).join(counts, "frame_id", "left")
    return frames.select("frame_id", *[F.coalesce(f"{n}_{k}", F.lit(0)).alias(f"{n}_{k}") for n in areas for k in ("total", "static")], F.round("least", 6).alias("least"))


@query(f"""WITH {_BOX}, t AS (SELECT *, (x0 - 3.8) / nullif(12.0 - vx, 0) AS ttc FROM dd WHERE x0 > 3.8 AND y0 <= 1.25 AND y1 >= -1.25 AND 12.0 - vx > 0.1)
    SELECT frame_id, round(min(ttc), 6) AS ttc FROM t WHERE ttc < 30 GROUP BY frame_id""")
def ttc_min_per_frame(spark, sf_dir):
    ob, box = _boxed(spark, sf_dir)
    ttc = boxes.time_to_collision(box, F.lit(12.0), F.col("vx"))
    return ob.select("frame_id", ttc.alias("ttc")).filter("ttc IS NOT NULL").groupBy("frame_id").agg(F.round(F.min("ttc"), 6).alias("ttc"))


@query(f"""WITH {_BOX} SELECT CASE WHEN x0 > 3.8 AND inside THEN 'front' WHEN x0 > 3.8 THEN 'front_' || side WHEN x1 < -1.0 AND inside THEN 'rear' WHEN x1 < -1.0 THEN 'rear_' || side ELSE side END AS direction, count(*) AS n
    FROM (SELECT *, y0 <= 1.15 AND y1 >= -1.15 AS inside, CASE WHEN y > 0 THEN 'left' ELSE 'right' END AS side FROM dd) GROUP BY 1""")
def direction_8way(spark, sf_dir):
    ob, box = _boxed(spark, sf_dir)
    return ob.groupBy(boxes.direction(box, F.col("y")).alias("direction")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_BOX}, i AS (SELECT *, greatest(least(x1, 10.0) - greatest(x0, -5.0), 0.0) * greatest(least(y1, 2.0) - greatest(y0, -2.0), 0.0) AS shared, (x1 - x0) * (y1 - y0) AS own FROM dd)
    SELECT frame_id, track_id, round(shared / (own + 60.0 - shared), 6) AS iou FROM i""")
def iou_aabb(spark, sf_dir):
    ob, box = _boxed(spark, sf_dir)
    fixed = boxes.Box(*[F.lit(v) for v in (-5.0, 10.0, -2.0, 2.0)])
    return ob.select("frame_id", "track_id", F.round(boxes.iou(box, fixed), 6).alias("iou"))


@query(f"""WITH {OB}, p AS (SELECT *, greatest(0.0, least(1.0, ((x + 10) * 30 + (y + 2) * 4) / 916)) AS s FROM ob) SELECT frame_id, track_id, round(sqrt(pow(x - (-10 + s * 30), 2) + pow(y - (-2 + s * 4), 2)), 6) AS d FROM p""")
def point_segment(spark, sf_dir):
    d = boxes.point_segment(F.col("x"), F.col("y"), *[F.lit(v) for v in (-10.0, -2.0, 20.0, 2.0)])
    return obstacles(spark, sf_dir).select("frame_id", "track_id", F.round(d, 6).alias("d"))


@query("""WITH p AS (SELECT vec_id, unnest(generate_series(1, 64)) AS i, embedding FROM embeddings), d AS (SELECT vec_id, i - 1 AS i, pow(CAST(embedding[i] AS DOUBLE) - 0.1, 2) + pow((i - 1) / 64.0 - 0.5, 2) AS d2 FROM p),
    r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, i) AS k FROM d) SELECT vec_id, CAST(i AS INTEGER) AS nearest, round(d2, 9) AS d2 FROM r WHERE k = 1""")
def nearest_point_array(spark, sf_dir):
    path = F.transform("embedding", lambda e, i: F.struct(e.cast("double").alias("x"), (i / 64.0).alias("y")))
    found = boxes.nearest_point(F.lit(0.1), F.lit(0.5), path)
    return table(spark, sf_dir, "embeddings").select("vec_id", found.alias("n")).select("vec_id", F.col("n.i").alias("nearest"), F.round("n.d2", 9).alias("d2"))


@query(f"""WITH {OB} SELECT frame_id, track_id, abs(x * cos(heading) + y * sin(heading)) <= length / 2 AND abs(-x * sin(heading) + y * cos(heading)) <= width / 2 AS holds_ego, round(abs(length * width), 6) AS area FROM ob""")
def obb_contains_and_area(spark, sf_dir):
    ob, _ = _boxed(spark, sf_dir)
    c = [F.col(n) for n in ("x", "y", "length", "width", "heading")]
    return ob.select("frame_id", "track_id", boxes.point_in_box(F.lit(0.0), F.lit(0.0), *c).alias("holds_ego"), F.round(boxes.shoelace(boxes.corners(*c)), 6).alias("area"))


@query(f"WITH {EV} SELECT event_id, round(tan(radians((value - 40) / 16)) / 2.85, 9) AS kappa, CASE WHEN abs(tan(radians((value - 40) / 16)) / 2.85) < 0.003 THEN 'straight' WHEN abs(tan(radians((value - 40) / 16)) / 2.85) < 0.02 THEN 'small_curve' ELSE 'large_curve' END AS road FROM ev")
def steering_curvature(spark, sf_dir):
    from ..functions.bands import road_class

    kappa = boxes.steering_curvature(F.col("value") - 40)
    return events(spark, sf_dir).select("event_id", F.round(kappa, 9).alias("kappa"), road_class(kappa).alias("road"))


#: The corners and edges of obstacles and of the vehicle, all distances of corners from edges, and the projections on the
#: normals of all edges.
_POLYGONS = f"""{OB}, o AS (SELECT *, row_number() OVER () AS r FROM ob), q(k, i, j) AS (VALUES (0, -1, -1), (1, -1, 1), (2, 1, 1), (3, 1, -1)),
    c AS (SELECT r, k, x + i * length / 2 * cos(heading) - j * width / 2 * sin(heading) AS x, y + i * length / 2 * sin(heading) + j * width / 2 * cos(heading) AS y FROM o, q),
    g AS (SELECT k, 1.4::DOUBLE + i * 2.4::DOUBLE AS x, j * 0.95::DOUBLE AS y FROM q),
    ce AS (SELECT a.r, a.x AS ax, a.y AS ay, b.x - a.x AS dx, b.y - a.y AS dy FROM c a JOIN c b ON a.r = b.r AND b.k = (a.k + 1) % 4),
    ge AS (SELECT a.x AS ax, a.y AS ay, b.x - a.x AS dx, b.y - a.y AS dy FROM g a JOIN g b ON b.k = (a.k + 1) % 4),
    ps AS (SELECT r, c.x AS px, c.y AS py, ax, ay, dx, dy FROM c, ge UNION ALL SELECT r, g.x, g.y, ax, ay, dx, dy FROM ce, g),
    sh AS (SELECT *, greatest(0.0, least(1.0, ((px - ax) * dx + (py - ay) * dy) / (dx * dx + dy * dy))) AS u FROM ps),
    reach AS (SELECT r, min(sqrt(pow(px - ax - u * dx, 2) + pow(py - ay - u * dy, 2))) AS d FROM sh GROUP BY r),
    ax AS (SELECT r, dy AS nx, -dx AS ny FROM ce UNION ALL SELECT o.r, dy, -dx FROM o, ge),
    pr AS (SELECT ax.r, nx, ny, min(nx * c.x + ny * c.y) AS lo, max(nx * c.x + ny * c.y) AS hi FROM ax JOIN c ON c.r = ax.r GROUP BY ax.r, nx, ny),
    pg AS (SELECT pr.r, pr.lo, pr.hi, min(nx * g.x + ny * g.y) AS glo, max(nx * g.x + ny * g.y) AS ghi FROM pr, g GROUP BY pr.r, nx, ny, pr.lo, pr.hi),
    apart AS (SELECT r, bool_or(hi < glo OR ghi < lo) AS apart FROM pg GROUP BY r),
    pd AS (SELECT frame_id, track_id, CASE WHEN apart THEN d ELSE 0 END AS distance FROM o JOIN reach USING (r) JOIN apart USING (r))"""


def _turned(ob):
    return boxes.Turned(*[F.col(n) for n in ("x", "y", "length", "width", "heading")])


@query(f"WITH {_POLYGONS} SELECT frame_id, track_id, round(distance, 6) AS distance FROM pd")
def polygon_distance(spark, sf_dir):
    ob = obstacles(spark, sf_dir)
    return ob.select("frame_id", "track_id", F.round(boxes.turned_distance(_turned(ob), boxes.as_turned()), 6).alias("distance"))


@query(f"WITH {_POLYGONS} SELECT frame_id, round(min(distance), 6) AS distance FROM pd GROUP BY frame_id")
def nearest_polygon_per_frame(spark, sf_dir):
    """Filter and refine: an obstacle's bounds are no further than it is, and its nearest corner is no nearer, so the exact
    distance is worked out only for those whose bounds are as near as the frame's nearest corner."""
    ob, box = _boxed(spark, sf_dir)
    turned = _turned(ob)
    reach = F.least(*[boxes.point_box_distance(x, y) for x, y in turned.corners()])
    bounded = ob.withColumns({"least": boxes.box_distance(box), "most": reach})
    nearest = bounded.withColumn("best", F.min("most").over(Window.partitionBy("frame_id")))
    open_ = nearest.filter(F.col("least") <= F.col("best") + 1e-9)
    return open_.groupBy("frame_id").agg(F.round(F.min(boxes.turned_distance(turned, boxes.as_turned())), 6).alias("distance"))
