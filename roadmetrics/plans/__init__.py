"""Metric programs over the telemetry tables. Importing this package registers all of them."""

from . import comfort, curvature, emergency, lane_keeping, localization, mileage, quality, roi, scene, speeding, steering, takeover, weaving
from .base import PROGRAMS, Result, Telemetry, run

__all__ = ["PROGRAMS", "Result", "Telemetry", "run", "comfort", "curvature", "emergency", "lane_keeping", "localization", "mileage", "quality", "roi", "scene", "speeding", "steering", "takeover", "weaving"]
