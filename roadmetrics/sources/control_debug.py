"""Decoding of the control module's debug payload: a serialised message with one part per controller."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Numbers of the fields read, by part. The lateral error that the metrics use is the nearest one.
LONGITUDINAL, LATERAL = 1, 2
FIELDS = {
    "lateral_error": (LATERAL, 3),
    "heading_error": (LATERAL, 4),
    "lateral_error_raw": (LATERAL, 5),
    "heading_error_raw": (LATERAL, 6),
    "ref_kappa": (LATERAL, 7),
    "vehicle_speed": (LATERAL, 2),
    "current_speed": (LONGITUDINAL, 6),
    "current_acceleration": (LONGITUDINAL, 7),
    "acceleration_command": (LONGITUDINAL, 17),
    "jerk_command": (LONGITUDINAL, 19),
}


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value, at, shift = value | (byte & 127) << shift, at + 1, shift + 7
        if byte < 128:
            return value, at


def fields(data: bytes) -> dict[int, bytes]:
    """The eight-byte and the length-prefixed fields of a message by number. Of a repeated eight-byte field the last
    counts; parts of a repeated message are joined, which merges them."""
    found, at = {}, 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            _, at = _varint(data, at)
            continue
        if kind not in (1, 2, 5):
            raise ValueError(f"wire type {kind}")
        size, at = _varint(data, at) if kind == 2 else (8 if kind == 1 else 4, at)
        if at + size > len(data):
            raise ValueError("cut off")
        part, at = data[at : at + size], at + size
        if kind != 5:
            found[key >> 3] = found.get(key >> 3, b"") + part if kind == 2 else part
    return found


def values(data: bytes | None) -> tuple[float, ...] | None:
    """The doubles in the order of FIELDS, 0 for one that is absent; None if there is no payload or it can't be read."""
    if not data:
        return None
    try:
        outer = fields(bytes(data))
        parts = {n: fields(outer.get(n, b"")) for n in (LONGITUDINAL, LATERAL)}
        return tuple(struct.unpack("<d", parts[part][n])[0] if n in parts[part] else 0.0 for part, n in FIELDS.values())
    except (ValueError, IndexError, struct.error):
        return None


def decode(rows: DataFrame, payload: str = "reserved0") -> DataFrame:
    """rows with the ten doubles in place of the payload. Rows with an empty or unreadable payload go, as they hold no
    measurement; columns of the same names are replaced."""

    @F.pandas_udf(", ".join(f"{n} double" for n in ("ok", *FIELDS)))
    def read(data: pd.Series) -> pd.DataFrame:
        got = [values(x) for x in data]
        return pd.DataFrame([(0.0, *[0.0] * len(FIELDS)) if v is None else (1.0, *v) for v in got], columns=["ok", *FIELDS])

    kept = [F.col(f"`{c}`") for c in rows.columns if c != payload and c not in FIELDS]
    return rows.select(*kept, read(F.col(f"`{payload}`")).alias("_read")).filter("_read.ok = 1").select(*kept, *[F.col(f"_read.{n}").alias(n) for n in FIELDS])
