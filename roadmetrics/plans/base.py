"""What the metric programs share: their inputs, their results, their registry and the runner."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import cached_property

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Config
from ..operators.asof import Right, align
from ..sources.shared import written

SYNC_TOLERANCE = 0.3


class MissingTopic(KeyError):
    """These recordings lack a topic that a program needs."""


@dataclass
class Telemetry:
    """Tables by topic name (see schemas.TOPICS), and the configuration."""

    tables: dict[str, DataFrame]
    config: Config = field(default_factory=Config)
    keep: bool = False
    #: Whether frames hold all topics and fields, so that all programs share them, or those that a program asks for.
    whole: bool = True
    _frames: dict[frozenset[str], DataFrame] = field(default_factory=dict)
    _made: dict[str, DataFrame] = field(default_factory=dict)
    _results: dict[str, Result] = field(default_factory=dict)

    def narrow(self) -> Telemetry:
        """The same telemetry whose frames hold what a program asks for."""
        return replace(self, whole=False, _frames={}, _made={}, _results={})

    def topic(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise MissingTopic(name)
        return self.tables[name]

    def shared(self, whole: bool = True) -> Telemetry:
        """The same telemetry whose aligned tables are written to the shared folder when first asked for, so that several
        programs, or several parts of one, read them instead of aligning again. For a single program frames need not be
        whole."""
        return replace(self, keep=True, whole=whole, _frames={}, _made={}, _results={})

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._made:
            self._made[name] = written(build(), name) if self.keep else build()
        return self._made[name]

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table that several programs rest on, by its name: written when first asked for if results are shared."""
        return self._once(name, build)

    def result(self, name: str) -> Result:
        """Another program's result; if results are shared, it is built once, and its tables are written when asked for."""
        if name not in self._results:
            found = PROGRAMS[name][0](self)
            self._results[name] = Kept(found, name) if self.keep else found
        return self._results[name]

    def frames(self) -> DataFrame:
        """One row per function message with the nearest message of the other topics (structs), within 0.3 s; one exchange."""
        return self._once("frames", lambda: self._aligned(self._fields()))

    def frames_with(self, *fields: str) -> DataFrame:
        """The frames with these fields at least ("chassis.speed"; "chassis.t" for its presence alone). Unless frames are whole,
        other topics are not aligned, and other fields take no part in the exchange."""
        if self.whole:
            return self.frames()
        wanted = frozenset(f for f in self._fields() if f in fields or f.endswith(".t") and f[:-1] in {x.split(".")[0] + "." for x in fields})
        for have, found in self._frames.items():
            if wanted <= have:
                return found
        self._frames[wanted] = written(self._aligned(wanted, slim=True), "frames") if self.keep and wanted else self._aligned(wanted)
        return self._frames[wanted]

    def _fields(self) -> frozenset[str]:
        return frozenset(f"{name}.{c}" for name in ALIGNED if name in self.tables for c in self.topic(name).columns if c != "bag")

    def _aligned(self, fields: frozenset[str], slim: bool = False) -> DataFrame:
        """Frames with these fields; slim ones without the topics' drive_id and key."""
        base, rights = self.topic("function_manager").select("drive_id", "t", "operator_type").withColumn("key", F.lit(0).cast("bigint")), []
        for name, tolerance in ALIGNED.items():
            own = [c for c in self.tables[name].columns if f"{name}.{c}" in fields and not (slim and c == "drive_id")] if name in self.tables else []
            if own:
                # Of rows at the same time the whole content decides, whatever is asked for; their time alone is the same in all.
                rows = self.topic(name).drop("bag")
                keyed = rows.withColumn("key", F.lit(0).cast("bigint")) if own == ["t"] else by_content(rows)
                rights.append(Right(keyed.select(*dict.fromkeys(["drive_id", *own, "key"])), name, tolerance, fields=tuple(own) if slim else None))
        joined = (align(base, rights, key="key", chunk=self.config.chunk_s) if rights else base).drop("key")
        return joined.withColumn("is_auto", F.col("operator_type") == self.config.auto_operator)

    def _with_state(self, name: str, columns: list[str]) -> DataFrame:
        """High-frequency rows with the driving mode of the nearest function message, however far (ties: the later)."""
        rows = self.topic(name).select("drive_id", "t", *columns).withColumn("key", F.lit(0).cast("bigint"))
        state = by_content(self.topic("function_manager").select("drive_id", "t", "operator_type"))
        joined = align(rows, [Right(state, "fm", None, "later", ("t", "operator_type"))], key="key", chunk=self.config.chunk_s)
        auto = F.coalesce(F.col("fm.operator_type") == self.config.auto_operator, F.lit(False))
        return joined.withColumn("is_auto", auto).drop("key", "fm")

    def chassis_hf(self) -> DataFrame:
        return self._once("chassis_hf", lambda: self._with_state("chassis", ["steering_angle", "steering_rate", "speed", "lat_acc"]))

    def control_hf(self) -> DataFrame:
        return self._once("control_hf", lambda: self._with_state("control", ["target_lon_acc"]))


#: Topics of frames with the farthest time of their nearest message (s).
ALIGNED = {"localization": SYNC_TOLERANCE, "chassis": SYNC_TOLERANCE, "trajectory": SYNC_TOLERANCE, "obstacles": SYNC_TOLERANCE, "control_debug": 0.05}


def by_content(rows: DataFrame) -> DataFrame:
    """rows with a key by which rows of equal time come in the same order however the files are laid out."""
    return rows.withColumn("key", F.xxhash64(*[F.col(f"`{f.name}`") for f in rows.schema.fields if not isinstance(f.dataType, T.MapType)]))


@dataclass
class Result:
    metrics: DataFrame
    events: DataFrame | None = None


class Kept:
    """A result whose metrics and events are each written when first asked for."""

    def __init__(self, found: Result, name: str):
        self._found, self._name = found, name

    @cached_property
    def metrics(self) -> DataFrame:
        return written(self._found.metrics, f"{self._name}-metrics")

    @cached_property
    def events(self) -> DataFrame | None:
        return written(self._found.events, f"{self._name}-events") if self._found.events is not None else None


def metric_rows(per_drive: DataFrame, metrics: dict[str, tuple[Column, str]], texts: dict[str, Column] | None = None) -> DataFrame:
    """One row (drive_id, metric, value, value_text, unit) per drive and metric."""
    texts = texts or {}
    rows = F.array(*[F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"), texts.get(name, F.lit(None)).cast("string").alias("value_text"), F.lit(unit).alias("unit")) for name, (value, unit) in metrics.items()])
    return per_drive.select("drive_id", F.explode(rows).alias("m")).select("drive_id", "m.*")


def event_rows(found: DataFrame, family: str) -> DataFrame:
    """Events in the common layout."""
    return found.select("drive_id", F.lit(family).alias("family"), "start_ts", "end_ts", F.col("frame_count").cast("bigint").alias("frame_count"), F.col("peak").cast("double").alias("peak"))


#: Programs by name, with the programs whose results they need. Each builds plans only; nothing runs before the write.
PROGRAMS: dict[str, tuple[Callable[[Telemetry], Result], tuple[str, ...]]] = {}


def program(name: str, needs: tuple[str, ...] = ()):
    def register(build):
        PROGRAMS[name] = (build, needs)
        return build

    return register


def closure(names: list[str]) -> list[str]:
    """The programs whose names contain one of the given texts, with all they need, in an order that respects needs."""
    order: list[str] = []

    def visit(name: str, path: tuple[str, ...]):
        if name in path:
            raise ValueError("programs need each other: " + " -> ".join((*path, name)))
        for need in PROGRAMS[name][1]:
            visit(need, (*path, name))
        if name not in order:
            order.append(name)

    for name in PROGRAMS:
        if any(n in name for n in names):
            visit(name, ())
    return order


def run(telemetry: Telemetry, names: list[str] | None = None) -> tuple[DataFrame, DataFrame | None, dict[str, str]]:
    """Metrics and events of the programs as two DataFrames, and what failed to build (name: reason)."""
    metrics, events, failed, telemetry = [], [], {}, telemetry.shared()
    for name in closure(names or list(PROGRAMS)):
        try:
            result = telemetry.result(name)
        except MissingTopic as missing:
            failed[name] = f"no topic {missing}"
            continue
        metrics.append(result.metrics.withColumn("program", F.lit(name)))
        if result.events is not None:
            events.append(result.events)
    union = lambda parts: None if not parts else parts[0] if len(parts) == 1 else union([parts[0].unionByName(parts[1]), *parts[2:]])
    return union(metrics), union(events), failed


def _cause(broken: Exception) -> str:
    """The innermost cause that Spark names, else the first line."""
    lines = [x.strip() for x in str(broken).splitlines() if x.strip()] or [type(broken).__name__]
    return next((x for x in reversed(lines) if x.startswith("Caused by:")), next((x for x in lines if "Exception:" in x), lines[0]))[:500]


LEDGER = "program string, status string, reason string, seconds double, rows bigint"


def run_each(telemetry: Telemetry, to: str, names: list[str] | None = None, again: bool = False) -> DataFrame:
    """Run the programs one by one and write each one's metrics and events in folders of its own; return (and write) the
    ledger: per program done, failed (with the reason) or skipped (a program that it needs failed).

    A program that fails, be it in a task, leaves the others' results; what it had begun to write is not left behind as
    a result, as Spark commits a folder as a whole. Programs that an earlier ledger in the same place has as done are not run
    again, unless ``again`` is set.
    """
    spark = next(iter(telemetry.tables.values())).sparkSession
    telemetry, rows, done = telemetry.shared(), [], {}
    if not again:
        try:
            done = {r.program: r for r in spark.read.schema(LEDGER).parquet(f"{to}/ledger").collect() if r.status == "done"}  # a row for each program
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    failed: set[str] = set()
    for name in closure(names or list(PROGRAMS)):
        began, status, reason, n = time.time(), "done", None, None
        lacking = sorted(failed & set(PROGRAMS[name][1]))
        if name in done:
            rows.append(tuple(done[name]))
            continue
        if lacking:
            status, reason = "skipped", "needs " + ", ".join(lacking)
        else:
            try:
                result = telemetry.result(name)
                result.metrics.write.mode("overwrite").parquet(f"{to}/metrics/program={name}")
                if result.events is not None:
                    result.events.write.mode("overwrite").parquet(f"{to}/events/program={name}")
                n = spark.read.parquet(f"{to}/metrics/program={name}").count()
            except MissingTopic as missing:
                status, reason = "failed", f"no topic {missing}"
            except (PySparkException, Py4JJavaError) as broken:
                status, reason = "failed", _cause(broken)
        if status != "done":
            failed.add(name)
        rows.append((name, status, reason, time.time() - began, n))
    ledger = spark.createDataFrame(rows, LEDGER)
    ledger.coalesce(1).write.mode("overwrite").parquet(f"{to}/ledger")
    return ledger
