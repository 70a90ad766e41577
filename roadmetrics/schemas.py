"""Schemas of the telemetry tables (one per topic) and of the results."""

from __future__ import annotations

COMMON = "drive_id STRING, bag STRING, t DOUBLE"
TOPICS = {
    "function_manager": f"{COMMON}, operator_type INT",
    "localization": f"{COMMON}, lat DOUBLE, lon DOUBLE, sd_east DOUBLE, sd_north DOUBLE, status INT, velocity_x DOUBLE",
    "chassis": f"{COMMON}, steering_angle DOUBLE, steering_rate DOUBLE, speed DOUBLE, lon_acc DOUBLE, lat_acc DOUBLE",
    "control": f"{COMMON}, target_lon_acc DOUBLE",
    "control_debug": f"{COMMON}, lateral_error DOUBLE, heading_error DOUBLE, ref_kappa DOUBLE",
    "trajectory": f"{COMMON}, path ARRAY<STRUCT<x: DOUBLE, y: DOUBLE, kappa: DOUBLE>>, lane_id ARRAY<STRING>, speed_limit DOUBLE",
    "obstacles": f"{COMMON}, items ARRAY<STRUCT<track_id: BIGINT, x: DOUBLE, y: DOUBLE, vx: DOUBLE, vy: DOUBLE, length: DOUBLE, width: DOUBLE, heading: DOUBLE, motion: INT, type: INT>>",
    "map": f"{COMMON}, lanes MAP<STRING, STRUCT<turn: INT, junction_id: STRING, lane_type: INT>>",
    "planning_debug": f"{COMMON}, present_status STRING, trajectory_type INT, is_replan BOOLEAN",
}
BAGS = "drive_id STRING, name STRING, start_ts DOUBLE, end_ts DOUBLE"
METRICS = "drive_id STRING, metric STRING, value DOUBLE, value_text STRING, unit STRING"
EVENTS = "drive_id STRING, family STRING, start_ts DOUBLE, end_ts DOUBLE, frame_count BIGINT, peak DOUBLE"
#: Obstacle types and turns by code, the message rate expected of each topic (Hz).
OBSTACLE_TYPES = {0: "unknown", 30: "pedestrian", 60: "bicycle", 90: "car", 120: "truck", 150: "bus", 180: "other"}
TURNS = {1: "straight", 2: "left", 3: "right", 4: "u_turn"}
RATES = {"function_manager": 10, "localization": 50, "chassis": 50, "control": 50, "control_debug": 50, "trajectory": 10, "obstacles": 10}
