"""Plane geometry of boxes on plain columns. x points forward from the ego vehicle, y to its left."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Ego:
    """Extents of the ego vehicle from its reference point, in metres."""

    front: float = 3.8
    rear: float = 1.0
    left: float = 0.95
    right: float = 0.95

    @property
    def half_width(self) -> float:
        return (self.left + self.right) / 2

    def roi(self, front: float, rear: float, left: float, right: float) -> tuple[float, float, float, float]:
        """x_min, x_max, y_min, y_max of the region that reaches these margins beyond the vehicle."""
        return -self.rear - rear, self.front + front, -self.right - right, self.left + left


@dataclass(frozen=True)
class Box:
    """Bounds of an axis-aligned box as columns."""

    x_min: Column
    x_max: Column
    y_min: Column
    y_max: Column


def bounds(x: Column, y: Column, length: Column, width: Column, heading: Column | float = 0.0) -> Box:
    """Axis-aligned bounds of a box turned by heading (radians)."""
    heading = F.lit(heading) if isinstance(heading, float) else heading
    c, s = F.abs(F.cos(heading)), F.abs(F.sin(heading))
    half_x, half_y = (length * c + width * s) / 2, (length * s + width * c) / 2
    return Box(x - half_x, x + half_x, y - half_y, y + half_y)


def corners(x: Column, y: Column, length: Column, width: Column, heading: Column) -> Column:
    """Array of the four corners (x, y), in turn around the box."""
    c, s = F.cos(heading), F.sin(heading)
    def corner(a, b):
        return F.struct((x + a * length / 2 * c - b * width / 2 * s).alias("x"), (y + a * length / 2 * s + b * width / 2 * c).alias("y"))
    return F.array(corner(-1, -1), corner(-1, 1), corner(1, 1), corner(1, -1))


def box_distance(box: Box, ego: Ego = Ego()) -> Column:
    """Distance of the bounds from the ego vehicle; 0 if they overlap."""
    dx = F.greatest(F.lit(-ego.rear) - box.x_max, box.x_min - ego.front, F.lit(0.0))
    dy = F.greatest(F.lit(-ego.right) - box.y_max, box.y_min - ego.left, F.lit(0.0))
    return F.sqrt(dx * dx + dy * dy)


def point_box_distance(x: Column, y: Column, ego: Ego = Ego()) -> Column:
    dx, dy = F.greatest(-ego.rear - x, F.lit(0.0), x - ego.front), F.greatest(-ego.right - y, F.lit(0.0), y - ego.left)
    return F.sqrt(dx * dx + dy * dy)


def nearest_corner(points: Column, ego: Ego = Ego()) -> Column:
    """The corner nearest to the ego vehicle, the first of equals."""
    return F.array_min(F.transform(points, lambda p, i: F.struct(point_box_distance(p["x"], p["y"], ego).alias("distance"), i.alias("i"), p["x"].alias("x"), p["y"].alias("y"))))


def in_rect(box: Box, roi: tuple[float, float, float, float]) -> Column:
    x_min, x_max, y_min, y_max = roi
    return ~((box.x_max < x_min) | (box.x_min > x_max) | (box.y_max < y_min) | (box.y_min > y_max))


def in_circle(box: Box, x: Column, y: Column, radius: float) -> Column:
    """Whether the centre is inside the circle around the origin or the bounds touch it."""
    near_x, near_y = F.greatest(box.x_min, F.least(F.lit(0.0), box.x_max)), F.greatest(box.y_min, F.least(F.lit(0.0), box.y_max))
    return (x * x + y * y < radius * radius) | (near_x * near_x + near_y * near_y <= radius * radius)


def point_in_rect(x: Column, y: Column, rect: tuple[float, float, float, float]) -> Column:
    return x.between(rect[0], rect[1]) & y.between(rect[2], rect[3])


def point_in_box(px: Column, py: Column, x: Column, y: Column, length: Column, width: Column, heading: Column) -> Column:
    """Whether a point lies in a turned box."""
    dx, dy = px - x, py - y
    along, across = dx * F.cos(heading) + dy * F.sin(heading), -dx * F.sin(heading) + dy * F.cos(heading)
    return (F.abs(along) <= length / 2) & (F.abs(across) <= width / 2)


def overlap_area(a: Box, b: Box) -> Column:
    wide = F.least(a.x_max, b.x_max) - F.greatest(a.x_min, b.x_min)
    high = F.least(a.y_max, b.y_max) - F.greatest(a.y_min, b.y_min)
    return F.greatest(wide, F.lit(0.0)) * F.greatest(high, F.lit(0.0))


def iou(a: Box, b: Box) -> Column:
    """Intersection over union of two axis-aligned boxes."""
    area = lambda q: (q.x_max - q.x_min) * (q.y_max - q.y_min)
    shared = overlap_area(a, b)
    return F.coalesce(F.try_divide(shared, area(a) + area(b) - shared), F.lit(0.0))


def shoelace(points: Column) -> Column:
    """Area of a polygon given as an array of (x, y)."""
    n = F.size(points)
    terms = F.transform(points, lambda p, i: p["x"] * F.get(points, (i + 1) % n)["y"] - F.get(points, (i + 1) % n)["x"] * p["y"])
    return F.abs(F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)) / 2


def _edges(points: Column) -> Column:
    n = F.size(points)
    return F.transform(points, lambda p, i: F.struct(p.alias("a"), F.get(points, (i + 1) % n).alias("b")))


def separated(a: Column, b: Column) -> Column:
    """Whether some edge normal of two convex polygons separates them."""
    def gap_along(edges: Column) -> Column:
        def apart(e):
            nx, ny = e["b"]["y"] - e["a"]["y"], e["a"]["x"] - e["b"]["x"]
            on = lambda pts: F.transform(pts, lambda p: p["x"] * nx + p["y"] * ny)
            return (F.array_max(on(a)) < F.array_min(on(b))) | (F.array_max(on(b)) < F.array_min(on(a)))
        return F.exists(edges, apart)
    return gap_along(_edges(a)) | gap_along(_edges(b))


def polygon_distance(a: Column, b: Column) -> Column:
    """Exact distance of two convex polygons: 0 if they meet, else the least vertex-to-edge distance."""
    def reach(points: Column, edges: Column) -> Column:
        return F.array_min(F.flatten(F.transform(points, lambda p: F.transform(edges, lambda e: point_segment(p["x"], p["y"], e["a"]["x"], e["a"]["y"], e["b"]["x"], e["b"]["y"])))))
    return F.when(separated(a, b), F.least(reach(a, _edges(b)), reach(b, _edges(a)))).otherwise(0.0)


@dataclass(frozen=True)
class Turned:
    """A box turned by heading about its centre, as columns."""

    x: Column
    y: Column
    length: Column
    width: Column
    heading: Column

    def corners(self) -> list[tuple[Column, Column]]:
        c, s, a, b = F.cos(self.heading), F.sin(self.heading), self.length / 2, self.width / 2
        return [(self.x + i * a * c - j * b * s, self.y + i * a * s + j * b * c) for i, j in ((-1, -1), (-1, 1), (1, 1), (1, -1))]

    def away(self, px: Column, py: Column) -> Column:
        """Distance of a point from the box, 0 inside."""
        dx, dy, c, s = px - self.x, py - self.y, F.cos(self.heading), F.sin(self.heading)
        along = F.greatest(F.abs(dx * c + dy * s) - self.length / 2, F.lit(0.0))
        across = F.greatest(F.abs(dy * c - dx * s) - self.width / 2, F.lit(0.0))
        return F.sqrt(along * along + across * across)


def turned_apart(a: Turned, b: Turned) -> Column:
    """Whether one of the four side directions of two turned boxes separates them: along it the centres are further apart
    than both half extents together."""
    dx, dy = b.x - a.x, b.y - a.y
    c, s = F.abs(F.cos(a.heading - b.heading)), F.abs(F.sin(a.heading - b.heading))

    def apart(of: Turned, other: Turned) -> Column:
        along, across = F.abs(dx * F.cos(of.heading) + dy * F.sin(of.heading)), F.abs(dy * F.cos(of.heading) - dx * F.sin(of.heading))
        return (2 * along > of.length + other.length * c + other.width * s) | (2 * across > of.width + other.length * s + other.width * c)

    return apart(a, b) | apart(b, a)


def turned_distance(a: Turned, b: Turned) -> Column:
    """Exact distance of two turned boxes, 0 if they meet. Boxes that don't meet are nearest at a corner of one of them, and
    a corner's distance from a box needs no edges, so eight distances in plain arithmetic are enough."""
    reach = [a.away(x, y) for x, y in b.corners()] + [b.away(x, y) for x, y in a.corners()]
    return F.when(turned_apart(a, b), F.least(*reach)).otherwise(0.0)


def as_turned(ego: Ego = Ego()) -> Turned:
    lit = lambda v: F.lit(float(v))
    return Turned(lit((ego.front - ego.rear) / 2), lit((ego.left - ego.right) / 2), lit(ego.front + ego.rear), lit(ego.left + ego.right), lit(0.0))


def point_segment(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Distance of a point from a segment; a segment of no length is a point."""
    dx, dy = bx - ax, by - ay
    share = F.coalesce(F.try_divide((px - ax) * dx + (py - ay) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), share))
    ex, ey = px - (ax + t * dx), py - (ay + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def in_path(box: Box, ego: Ego = Ego(), margin: float = 0.3) -> Column:
    """Whether a box lies wholly ahead and reaches into the corridor of the vehicle's width and a margin."""
    return (box.x_min > ego.front) & (box.y_min <= ego.half_width + margin) & (box.y_max >= -ego.half_width - margin)


def time_to_collision(box: Box, ego_speed: Column, obstacle_vx: Column, ego: Ego = Ego(), most: float = 30.0) -> Column:
    """Seconds until the gap ahead closes, for boxes in the path, ego faster than 0.5 m/s and closing by more than 0.1."""
    ahead, closing = box.x_min - ego.front, ego_speed - F.coalesce(obstacle_vx, F.lit(0.0))
    ttc = F.try_divide(ahead, closing)
    return F.when(in_path(box, ego) & (ego_speed > 0.5) & (ahead > 0) & (closing > 0.1) & (ttc < most), ttc)


def direction(box: Box, y: Column, ego: Ego = Ego(), margin: float = 0.2) -> Column:
    """One of eight directions of a box around the vehicle."""
    inside = (box.y_min <= ego.half_width + margin) & (box.y_max >= -ego.half_width - margin)
    side = F.when(y > 0, "left").otherwise("right")
    ahead, behind = box.x_min > ego.front, box.x_max < -ego.rear
    return (
        F.when(ahead & inside, "front").when(ahead, F.concat(F.lit("front_"), side)).when(behind & inside, "rear").when(behind, F.concat(F.lit("rear_"), side)).otherwise(side)
    )


def nearest_point(x: Column, y: Column, points: Column) -> Column:
    """Struct of the squared distance and number (0-based) of the array point nearest to (x, y), the first of equals."""
    return F.array_min(F.transform(points, lambda p, i: F.struct(((p["x"] - x) * (p["x"] - x) + (p["y"] - y) * (p["y"] - y)).alias("d2"), i.alias("i"))))


def path_distance(x: Column, y: Column, points: Column, nearest: Column, bend: float = 0.003) -> Column:
    """Distance from a path of (x, y, kappa): the shorter of the perpendiculars on the two segments at the nearest point,
    less half the chord error of the first of them where the segment bends."""
    at, n = nearest, F.size(points)
    def segment(i):
        a, b = F.get(points, i), F.get(points, i + 1)
        length = F.sqrt((b["x"] - a["x"]) * (b["x"] - a["x"]) + (b["y"] - a["y"]) * (b["y"] - a["y"]))
        return F.when((i >= 0) & (i < n - 1), F.struct(point_segment(x, y, a["x"], a["y"], b["x"], b["y"]).alias("d"), ((a["kappa"] + b["kappa"]) / 2).alias("k"), length.alias("l")))
    one, two = segment(at - 1), segment(at)
    first = F.coalesce(one, two)
    best = F.when(one.isNull() | (two["d"] < one["d"]), F.coalesce(two, one)).otherwise(one)
    chord = F.when(F.abs(best["k"]) > bend, first["l"] * first["l"] * F.abs(best["k"]) / 8 * 0.5).otherwise(0.0)
    p = F.get(points, at)
    alone = F.sqrt((p["x"] - x) * (p["x"] - x) + (p["y"] - y) * (p["y"] - y))
    return F.when(n <= 1, alone).otherwise(F.greatest(F.lit(0.0), best["d"] - chord))


def steering_curvature(angle_deg: Column, ratio: float = 16.0, wheelbase: float = 2.85) -> Column:
    return F.tan(F.radians(angle_deg / ratio)) / wheelbase
