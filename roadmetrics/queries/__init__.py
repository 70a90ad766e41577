"""Queries that apply the operators to the driver's tables, each with equivalent SQL where SQL can express it."""

from . import alignment, catalogue, geometry, programs, sequences, statistics, streams
from .base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "alignment", "catalogue", "geometry", "programs", "sequences", "statistics", "streams"]
